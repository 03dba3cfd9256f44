"""Operators on documents against plain Python, and their defined edge cases."""

import math
import random
import re
from collections import Counter

import duckdb
import brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from ebbtide.llm import decontaminate, exact_dedup, language, mixing, ngram_join, pii, resample, substring_dedup

ROOT = "/root/testdata/sf0.001"


def by_id(frame, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in frame.collect()}


@pytest.mark.parametrize("counters", [exact_dedup.COUNTERS, 4])
def test_exact_duplicates(docs, texts, counters):
    got = by_id(exact_dedup.exact_duplicates(docs, counters=counters), "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute.exact(texts)


def test_exact_duplicates_keep_one_of_repeated_rows(spark, docs):
    twice = docs.where("doc_id < 10").unionByName(docs.where("doc_id < 10"))
    kept = exact_dedup.drop_exact_duplicates(twice)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6, 7, 8, 9]
    no_ids = spark.createDataFrame([(None, "t"), (None, "T"), (3, "t"), (None, "u")], "doc_id long, text string")
    marked = exact_dedup.exact_duplicates(no_ids).where("kept")
    assert sorted((r.keep_id or 0, r.group_size) for r in marked.collect()) == [(0, 1), (3, 3)]


def test_mixing_meets_targets(docs, texts):
    got = by_id(mixing.mix_sources(docs.withColumn("size", F.lit("clash")), range_rows=5), "size", "source_size", "target", "taken")
    source = {d: ["b", "a", None, "c"][d % 4] for d, _ in texts}
    sizes = {}
    for d, t in texts:
        assert got[d][0] == len(brute.SPACED.findall(t or ""))
        sizes[source[d]] = sizes.get(source[d], 0) + got[d][0]
    want = brute.targets(sizes)
    for s, target in want.items():
        mine = [got[d] for d in got if source[d] == s]
        assert all(g[1] == sizes[s] and g[2] == pytest.approx(target) and 0 <= g[3] <= 3 * g[0] for g in mine)
        assert sum(g[3] for g in mine) == pytest.approx(target, abs=0.51)
    assert got == by_id(mixing.mix_sources(docs.repartition(3), range_rows=7), "size", "source_size", "target", "taken")


def test_mixed_documents_repeat_epochs(docs):
    plan = by_id(mixing.mix_sources(docs), "size", "taken")
    rows = mixing.mixed_documents(docs).groupBy("doc_id").agg(F.sum("epoch_words").alias("words"), F.max("epoch").alias("epochs")).collect()
    assert {r.doc_id: r.words for r in rows} == {d: t for d, (_, t) in plan.items() if t}
    assert all(1 <= r.epochs <= 3 for r in rows)


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 8])
def test_benchmark_hits(spark, docs, texts, block_words):
    items = [(1, " ".join((texts[20][1] or "").split()[:14])), (2, None), (3, ""), (4, "one two"), (5, texts[30][1]), (1, texts[41][1]), (None, texts[42][1]), (12, "Éé 日本")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.benchmark_hits(docs, bench, block_words=block_words)
    got = {r.doc_id: (r.n_words, sum(x["end"] - x["start"] for x in r.runs), list(r["items"])) for r in found.collect()}
    want = brute.hits(texts, [i for i in items if i[0] is not None])
    assert got == want
    clean = decontaminate.drop_contaminated(docs, bench, block_words=block_words)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, w in want.items() if not w[1]}


@pytest.mark.parametrize("limits", [(ngram_join.REGION_SHINGLES, ngram_join.REGION_DOCS), (300, 3)])
def test_jaccard_components(docs, texts, limits):
    got = by_id(ngram_join.jaccard_components(docs, limits=limits), "n_shingles", "component_id")
    assert got == brute.near(texts)


def test_jaccard_join_leaves_rows_without_id_alone(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (2, "A B C D E F"), (2, "x y"), (9, "x y"), (11, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in ngram_join.jaccard_components(frame).collect())
    assert got == [(0, 0), (0, 0), (2, 2), (2, 2), (5, 2), (9, 2), (11, 11)]
    assert sorted(r.doc_id or 0 for r in ngram_join.one_of_each_group(frame).collect()) == [0, 0, 2, 2, 11]


@pytest.mark.parametrize("group_segments", [substring_dedup.GROUP_SEGMENTS, 2])
def test_remove_repeats(docs, texts, group_segments):
    kept = substring_dedup.remove_repeats(docs, group_segments=group_segments).withColumn("sha", F.sha2("kept_text", 256))
    want = brute.repeats(texts)
    assert sum(w[1] for w in want.values()) > 1000
    assert by_id(kept, "n_words", "n_removed", "sha") == want


def test_language_accuracy_and_rejection(spark, docs):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(real.where(~language.held_out()))
    found = language.identify(real, model).join(real.select("doc_id", "lang", language.held_out().alias("held")), "doc_id")
    held = [r for r in found.collect() if r.held]
    assert len(held) > 150 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in held)
    edge = {r.doc_id: r for r in language.identify(docs, model).collect()}
    for k in (0, 1, 2, 9):
        assert (edge[k].lang_pred, edge[k].score, edge[k].rejected) == ("und", 0.0, True)
    assert edge[75].lang_pred in {"en", "de", "fr", "es"}
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns and {0, 1, 2, 8, 9}.isdisjoint(r.doc_id for r in kept.collect())
    nothing = language.fit(real.limit(0))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}


def test_personal_spans_and_sanitised_text(spark):
    rows = [(k, f"call zorblat about {v} now") for k, v in enumerate(["jo.x@mail.org"] * 3)]
    rows += [(10 + k, "call now about nothing") for k in range(30)] + [(50, None), (51, ""), (52, "1.2.3.999 +1234 4111 1111 1111 1112")]
    frame = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, spans string")
    found = pii.personal_spans(frame)
    got = {r.doc_id: r for r in pii.span_columns(found).collect()}
    assert got[0].n_email == 1 and got[0].spans == "email:19:32,term:5:12"
    assert got[0].base_sha256 == brute.sha("email:19:32")
    assert all(got[k].spans == "" and got[k].base_sha256 == brute.sha("") for k in (10, 50, 51, 52))
    clean = by_id(pii.sanitised(found), "text")
    assert clean[0] == "call  about [EMAIL] now" and clean[10] == "call now about nothing"


def disclosing_spans(texts):
    """Term spans per document by plain counting of whole documents; emails are the only values here."""
    mails = [{m.lower() for m in re.findall(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", t or "")} for t in texts]
    words = [{w.lower() for w in re.findall(r"[^\W\d_]+", t or "")} for t in texts]
    n, out = len(texts), []
    for k, text in enumerate(texts):
        shown = set()
        for v in mails[k]:
            n_value = sum(v in m for m in mails)
            for w in words[k]:
                both = sum(v in m and w in s for m, s in zip(mails, words))
                if both >= 2 and n_value < n:
                    mutual = math.log(both * n / (n_value * sum(w in s for s in words)))
                    if round(mutual / math.log(n / n_value), 6) >= 0.9:
                        shown.add(w)
        held = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text or "")]
        spans = [m.span() for m in re.finditer(r"[^\W\d_]+", text or "") if m.group().lower() in shown]
        out.append([f"term:{a}:{b}" for a, b in spans if not any(x < b and y > a for x, y in held)])
    return out


def test_terms_disclose_from_anywhere_in_the_document(spark):
    far = "common words " * 40
    texts = [f"Quaxil {far}write to al@mail.org" if k % 2 else f"write to al@mail.org quaxil {far}" for k in range(6)]
    # A name inside one address and outside another's; long documents that are copies; numbers that are no cards beside a value.
    texts += ["brimlow writes from brimlow@host.net today"] * 2 + ["born 1984, brimlow at brimlow@host.net"]
    long_text = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)} u{k}@x{k % 7}.com" for k in range(300))
    texts += [long_text, long_text, None, "", "no value here, quaxilo"] + [f"common words write to here {k}" for k in range(30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = by_id(pii.span_columns(pii.personal_spans(frame)), "spans")
    for k, want in enumerate(disclosing_spans(texts)):
        assert [s for s in got[k].split(",") if s.startswith("term")] == want, k
    assert got[0].count("term:") == got[1].count("term:") == 1 and got[6].count("term:") >= 1
    # A very long text, and rows that repeat an id: each keeps the spans of its own text.
    rows = [(1, "al@mail.org " + "z " * 200_000 + "quaxil"), (1, "quaxil al@mail.org"), (1, "plain")] + [(9 + k, f"other {k}") for k in range(40)]
    again = pii.span_columns(pii.personal_spans(spark.createDataFrame(rows, "doc_id long, text string"))).where("doc_id = 1").collect()
    assert sorted(r.spans for r in again) == ["", "email:0:11,term:400012:400018", "email:7:18,term:0:6"]


def test_resampling_prefers_target_text(spark):
    rows = [(k, ("good fine text here " if k % 2 else "bad awful junk words ") * 20) for k in range(200)]
    rows += [(300, None), (301, ""), (302, "good"), (302, "good")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(k,) for k in range(1, 100, 2)], "doc_id long")
    got = resample.resample(frame, resample.fit(frame, target), 100).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) == 100
    assert all(r.doc_id % 2 for r in got if r.kept and r.doc_id < 300)
    assert next(r for r in got if r.doc_id == 300).log_weight == 0.0
    cut = min(r.key for r in got if r.kept)
    assert all(r.kept == (r.key >= cut) for r in got if r.key != cut)
    assert resample.resample(frame.limit(0), resample.fit(frame, target), 5).count() == 0


def plain_resample(rows, targets, k, hashed):
    """(log weight, key) per row and the smallest key kept, from counted n-grams; ``hashed`` gives the noise of an id."""
    named = {}

    def bucket(gram):
        if gram not in named:
            named[gram] = int(next(resample.ngram_buckets(pa.array([" ".join(gram)])))[-1])
        return named[gram]

    grams = []
    for _, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        grams.append([bucket((a,)) for a in w] + [bucket(pair) for pair in zip(w, w[1:])])
    raw, target = Counter(g for own in grams for g in own), Counter(g for (d, _), own in zip(rows, grams) if d in targets for g in own)
    share = sum(target.values()) / max(1, sum(raw.values()))
    ratio = {g: math.log((target[g] + resample.PRIOR) / (n * share + resample.PRIOR)) for g, n in raw.items()}
    out = []
    for (d, _), own in zip(rows, grams):
        weight = sum(ratio[g] for g in own)
        noise = -math.log(-math.log((hashed[d] % 2**52 + 0.5) / 2**52))
        out.append((len(own), weight, weight + noise if own else -math.inf))
    return out, sorted((key for n, _, key in out if n), reverse=True)[:k]


def test_resampling_equals_plain_counting(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").where("doc_id IS NOT NULL").collect()]
    # Null, wordless and very long texts, repeated rows, one id with two texts, equal texts of different ids.
    rows += [(900_001, None), (900_002, " ..."), (900_003, "Long tale " * 60_000), (900_004, "same words"), (900_004, "same words"), (900_004, "other words"), (900_005, "same words")]
    targets = {d for d, _ in rows if d % 3 == 0} | {900_004}
    frame = spark.createDataFrame([(d, t, 0.5, True) for d, t in rows], "doc_id long, text string, key double, kept boolean").repartition(6)
    wanted = spark.createDataFrame([(d,) for d in targets], "doc_id long")
    seeded = F.xxhash64("doc_id", F.lit(resample.SEED))
    hashed = {r[0]: r[1] for r in frame.select("doc_id", seeded).distinct().collect()}
    for k in (1, len(rows) // 4, len(rows) + 5):
        plain, best = plain_resample(rows, targets, k, hashed)
        got = resample.resample(frame, resample.fit(frame, wanted), k).collect()
        assert sorted((r.doc_id, r.n_grams) for r in got) == sorted((d, n) for (d, _), (n, _, _) in zip(rows, plain))
        mine = sorted((r.doc_id, r.n_grams, r.log_weight, r.key) for r in got)
        for have, want in zip(mine, sorted((d, *p) for (d, _), p in zip(rows, plain))):
            assert have[:2] == want[:2] and have[2:] == pytest.approx(want[2:], rel=1e-6, abs=1e-6)
        assert sorted((r.key for r in got if r.kept), reverse=True) == pytest.approx(best, rel=1e-6, abs=1e-6)
        assert not any(r.kept for r in got if r.doc_id in (900_001, 900_002))


def test_threshold_with_ties(spark):
    values = [3.0] * 7 + [1.5] * 4 + [-2.0, 9.0, 1e-9, 0.0] + [2.0 + n / 1e12 for n in range(50)]
    keys = spark.createDataFrame([(v,) for v in values], "key double").repartition(4)
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 5, 8, 30, 58, 60, len(values), len(values) + 3):
        cut, ties = resample.threshold(keys, k)
        k = min(k, len(values))
        assert cut == ordered[k - 1] and ties == k - sum(v > cut for v in values)
    assert resample.threshold(keys, 0) is None and resample.threshold(keys.limit(0), 3) is None


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert mixing.mix_sources(none).count() == 0
    assert ngram_join.jaccard_components(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
    assert pii.personal_spans(none).count() == 0
    assert decontaminate.benchmark_hits(none, bench).count() == 0
    assert decontaminate.drop_contaminated(docs, bench).count() == docs.count()


SQL_TABLES = ["documents", "pages", "benchmark", "labels"]


@pytest.mark.parametrize("name", ["op2_mix_sources", "op3_decontaminate", "op4_personal_data", "op8_warc", "op10_exact_dedup"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in SQL_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    result = con.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in result.description]
    want = sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in result.fetchall()), key=str)
    got = entry_module.queries()[name](spark, ROOT)
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(r[c] for c in sorted(names)) for r in got.collect()), key=str) == want


def test_language_fit_takes_one_text_of_a_repeated_id(spark):
    texts = [("en", f"the quick brown fox number {k} runs over the lazy dog") for k in range(40)] + [("fr", f"le chat noir {k} dort sur la chaise verte") for k in range(40)]
    rows = [(k, t, l) for k, (l, t) in enumerate(texts)]
    hot = [(None, f"zz hot text {k} of no id", "en") for k in range(300)] + [(7, f"zz more of seven {k}", "en") for k in range(300)]
    frame = spark.createDataFrame(rows + hot, "doc_id long, text string, lang string").repartition(4)
    once = spark.createDataFrame(rows + [min(hot[:300], key=lambda r: r[1])], "doc_id long, text string, lang string")
    for sample in (50, 12):
        got, want = language.fit(frame, sample=sample), language.fit(once, sample=sample)
        assert got.languages == want.languages and got.idf.tolist() == want.idf.tolist(), sample
        assert abs(got.centroids - want.centroids).max() < 1e-9, sample


def test_language_rejects_what_it_has_not_learned(spark):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    unlearned = [r.text for r in real.where("lang = 'de'").collect() if len(r.text or "") >= 200]
    model = language.fit(real.where(~language.held_out() & (F.col("lang") != "de")))
    held = [r.text for r in real.where(language.held_out() & (F.col("lang") != "de")).collect() if language.counts(r.text) is not None]
    rng = random.Random(3)

    def made(letters, n):
        return ["".join(rng.choice(letters) for _ in range(n)) for _ in range(40)]

    def rejected(texts):
        return sum(model.predict(t)[2] for t in texts) / len(texts)

    assert len(unlearned) > 50 and rejected(unlearned) > 0.95
    assert rejected([t[:64] for t in unlearned]) > 0.95
    for n in (40, 400, 4000):
        assert rejected(made("абвгдежзиклмнопрстуфх    ", n)) == 1
        assert rejected(made("abcdefghijklmnopqrstuvwxyz     ", n)) > 0.95
    assert len(held) > 150 and rejected(held) < 0.04
    long_enough = [t for t in held if len(t) >= 200]
    assert rejected([t[:40] for t in long_enough]) < 0.04 and rejected([t[:200] for t in long_enough]) < 0.04


def test_rows_that_repeat_an_id_lose_their_own_spans_only(spark):
    p, other = (" ".join(f"{w}{k}" for k in range(90)) for w in "pq")
    rows = [(1, p), (5, p), (5, other), (5, p), (7, other), (None, p), (None, None), (9, p + " " + "z" * 100_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(frame).collect())
    assert got == [(0, 0, 0), (0, 90, 0), (1, 90, 0), (5, 90, 0), (5, 90, 90), (5, 90, 90), (7, 90, 90), (9, 91, 90)]


def test_resampling_leaves_out_texts_without_words(spark):
    rows = [(k, "good words here " * 3) for k in range(30)] + [(k, f"junk {k} noise") for k in range(30, 180)] + [(k, ["", None, " . "][k % 3]) for k in range(180, 200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    ratio = resample.fit(frame, spark.range(30))
    kept = [r.doc_id for r in resample.resample(frame, ratio, 50).collect() if r.kept]
    assert len(kept) == 50 and max(kept) < 180
    every = resample.resample(frame, ratio, 1000).collect()
    assert len(every) == 200 and {r.doc_id for r in every if r.kept} == set(range(180))
    wordless = frame.where("doc_id >= 180")
    assert not any(r.kept for r in resample.resample(wordless, ratio, 5).collect())


def test_dropping_exact_duplicates_keeps_columns_of_clashing_names(spark):
    rows = [(1, "T", "a", 7, "x"), (2, "t", "b", 8, "y"), (3, "u", None, 9, "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept string, Group_Size int, keep_id string")
    got = exact_dedup.drop_exact_duplicates(frame)
    assert got.columns == frame.columns and sorted(map(tuple, got.collect())) == [tuple(r) for r in rows[1:]]
    assert [r[0] for r in exact_dedup.drop_exact_duplicates(frame.select("Group_Size", "kept"), "Group_Size", "kept").orderBy(F.col("Group_Size")).collect()] == [7, 8, 9]
