"""Personal data: base patterns, and terms that disclose what the patterns protect.

Base spans are email addresses, IP addresses, card and phone numbers. Information
theory adds terms: the corpus tells how many documents hold a term together with a
protected value, anywhere in the text, and how many hold it at all. When the pointwise
mutual information of both comes near the information content of the value itself, the
term reveals the value; it is then sanitised in every document that holds the value,
generalised if other documents use it too, removed if none does.

Values held by the same documents disclose alike, and so do terms: both are joined as
classes, named by their number of documents and two exclusive-or sums of hashes of
those, so a long document that is copied gives one pair and not all of its pairs.

Everything is DataFrame functions. A text is cut by a pattern into matches and the
pieces between them; running sums of their lengths are the positions. Repeated
patterns are written as runs of one character class, on a copy of the text in which
separators that cannot be part of a match are replaced one for one, so the matcher
needs no recursion on long runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage
from ebbtide.llm.common import q

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# Documents that must hold a term and a value together for evidence.
MIN_DOCUMENTS = 2
# Part of a value's information that a term may disclose.
THRESHOLD = 0.9
LETTERS = r"\p{L}+"

LOCAL = "A-Za-z0-9._%+-"
LABEL = "A-Za-z0-9-"


def _prepared(text: Column, kind: str) -> tuple[Column, str]:
    """A copy of the text with the same positions, and the pattern that finds the kind in it."""
    if kind == "email":
        # Dots outside labels become another character of local parts, so a domain is one run.
        marked = F.regexp_replace(text, rf"(?<![{LABEL}])\.|\.(?![{LABEL}])", "%")
        return marked, rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[{LABEL}]++\.[{LABEL}.]++"
    if kind == "ip":
        return text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
    if kind == "card":
        return F.regexp_replace(text, r"(?<![0-9])[\x20-]|[\x20-](?![0-9])", "_"), r"[0-9][0-9\x20-]++"
    return text, r"\+[0-9][\x20().0-9-]+[0-9]"


def _luhn(digits: Column) -> Column:
    """Sum of the digits from the right, every second one doubled, less 9 above 9."""
    backwards = F.reverse(digits)

    def add(total, place):
        digit = F.substring(backwards, place, F.lit(1)).cast("int")
        twice = F.when(digit * 2 > 9, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits) % 10 == 0).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _cut(rows: DataFrame, text: Column, pattern: str) -> DataFrame:
    """(row, value, start, end) for each match of ``pattern``; rows are keyed by ``row``."""
    pieces, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = rows.select("row", pieces.alias("pieces"), values.alias("values")).where(F.size("values") > 0)
    flat = parts.select("row", F.posexplode(F.arrays_zip("pieces", "values")).alias("at", "z")).where("z.values IS NOT NULL")
    short = flat.select("row", "at", F.length("z.pieces").alias("gap"), F.length("z.values").alias("size"), F.col("z.values").alias("value"))
    upto = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    return short.withColumn("end", end).select("row", "value", (F.col("end") - F.col("size")).alias("start"), "end")


def base_matches(rows: DataFrame) -> DataFrame:
    """(row, kind, start, end, value) of all base spans of (row, text); values are lower case."""
    found = None
    for number, kind in enumerate(KINDS):
        text, pattern = _prepared(F.col("text"), kind)
        # Only texts that can hold the kind are cut.
        some = rows.where(F.col("text").rlike({"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}[kind]))
        matches = _cut(some, text, pattern).where(_valid(kind, F.col("value")))
        spans = matches.select("row", F.lit(number).alias("kind"), "start", "end", F.lower("value").alias("value"))
        found = spans if found is None else found.unionByName(spans)
    return found


def _words(text: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(LETTERS), F.lit(0)))


def _same_rows(prefix: str) -> list[Column]:
    """Two exclusive-or sums of hashes: equal for groups of the same distinct rows."""
    return [F.bit_xor(F.xxhash64("row", F.lit(k))).alias(f"{prefix}{k}") for k in (1, 2)]


VALUE, TERMS = ["n_value", "v1", "v2"], ["n_term", "t1", "t2"]


def value_classes(base: DataFrame, min_documents: int, total: int) -> DataFrame:
    """(row, n_value, v1, v2) of the values that ``min_documents`` rows or more, but not all, hold."""
    held = base.select("row", "kind", "value").distinct()
    classes = held.groupBy("kind", "value").agg(F.count("*").alias("n_value"), *_same_rows("v"))
    wanted = classes.where((F.col("n_value") >= min_documents) & (F.col("n_value") < total))
    return held.join(wanted, ["kind", "value"]).select("row", *VALUE).distinct()


def term_classes(asked: DataFrame, texts: DataFrame, min_documents: int) -> DataFrame:
    """(row, term, n_term, t1, t2) of the words that ``min_documents`` rows of ``asked`` or more hold; all texts count."""
    words = asked.select("row", F.explode(_words("text")).alias("term"))
    sets = words.groupBy("term").agg(F.count("*").alias("n_asked"), *_same_rows("t")).where(F.col("n_asked") >= min_documents)
    # Words are counted where they are read, then joined.
    spread = texts.select(F.explode(_words("text")).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    return words.join(sets.join(spread, "term"), "term").select("row", "term", *TERMS)


def disclosing_terms(held: DataFrame, words: DataFrame, total: int, min_documents: int, threshold: float) -> DataFrame:
    """(row, term, disclosure) of the terms that disclose ``threshold`` or more of a value that the row holds.

    With document frequencies N, n(value), n(term) and n(value, term) the disclosure is
    log(n(value, term) N / (n(value) n(term))) / log(N / n(value)). As n(value, term) is at
    most n(value), a term of many documents is passed over before it is paired.
    """
    information = F.log(F.lit(float(total)) / F.col("n_value"))
    can_reach = F.log(F.lit(float(total)) / F.col("n_term")) >= (threshold - 1e-5) * information
    together = held.join(words.select("row", *TERMS).distinct(), "row").where(can_reach)
    counted = together.groupBy(*VALUE, *TERMS).agg(F.count("*").alias("both")).where(F.col("both") >= min_documents)
    mutual = F.log(F.col("both") * float(total) / (F.col("n_value") * F.col("n_term")))
    scored = counted.withColumn("disclosure", F.round(mutual / information, 6)).where(F.col("disclosure") >= threshold)
    best = held.join(scored, VALUE).groupBy("row", *TERMS).agg(F.max("disclosure").alias("disclosure"))
    return words.join(best, ["row", *TERMS]).select("row", "term", "disclosure")


def term_matches(rows: DataFrame, base: DataFrame, terms: DataFrame) -> DataFrame:
    """(row, kind, start, end, disclosure) of a row's disclosing terms, wherever it has them outside base spans."""
    asked = rows.join(terms.select("row").distinct(), "row", "left_semi")
    words = _cut(asked, F.col("text"), LETTERS).select("row", F.lower("value").alias("term"), "start", "end")
    spans = base.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    apart = ~F.exists("spans", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    found = words.join(terms, ["row", "term"]).join(spans, "row").where(apart)
    return found.select("row", F.lit(len(KINDS)).alias("kind"), "start", "end", "disclosure")


def _named(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    texts = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_documents: int = MIN_DOCUMENTS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, text and all spans as kind number, start, end and disclosure.

    Spans are sorted by kind, then start; positions are code points, ends exclusive.
    Null texts are empty and have no spans. Rows that repeat an id keep their own spans;
    equal rows each count as a document. A term is a run of letters, compared in lower
    case; it counts wherever the text has it, inside values too, and gives spans outside
    base spans. Documents without a base span get no term spans. Other columns are not
    read; an empty input gives no rows.
    """
    texts = docs.select(F.col(q(id_col)).alias("doc_id"), F.coalesce(F.col(q(text_col)), F.lit("")).alias("text"))
    maybe = F.col("text").rlike("@|[0-9]")
    rows = stage(texts.where(maybe).withColumn("row", F.monotonically_increasing_id()), "texts")
    base = stage(base_matches(rows.select("row", "text")), "spans")
    total = texts.count()
    held = stage(value_classes(base, min_documents, total), "held")
    asked = rows.select("row", "text").join(held.select("row").distinct(), "row", "left_semi")
    words = stage(term_classes(asked, texts, min_documents), "words")
    disclosing = stage(disclosing_terms(held, words, total, min_documents, threshold), "disclosing")
    terms = term_matches(rows.select("row", "text"), base, disclosing)
    spans = base.select("row", "kind", "start", "end", F.lit(None).cast("double").alias("disclosure")).unionByName(terms)
    per_row = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end", "disclosure"))).alias("spans"))
    kind = "array<struct<kind: int, start: bigint, end: bigint, disclosure: double>>"
    with_spans = rows.join(per_row, "row", "left").select("doc_id", "text", F.coalesce(F.col("spans").cast(kind), F.array().cast(kind)).alias("spans"))
    return with_spans.unionByName(texts.where(~maybe).select("doc_id", "text", F.array().cast(kind).alias("spans")))


def span_columns(found: DataFrame) -> DataFrame:
    """doc_id, counts per base kind, base_sha256 and spans of the result of ``personal_spans``."""

    def count(number: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    return found.select("doc_id", *counts, F.sha2(_named(base), 256).alias("base_sha256"), _named(F.col("spans")).alias("spans"))


def sanitised(found: DataFrame) -> DataFrame:
    """doc_id and text with base spans as ``[KIND]``, terms generalised to ``[WORD]`` or, if wholly disclosing, removed."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def put(state, s):
        gap = F.substring(F.col("text"), (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        word = F.when(s["disclosure"] >= 1, F.lit("")).otherwise(F.lit("[WORD]"))
        shown = F.when(s["kind"] < len(KINDS), F.get(names, s["kind"])).otherwise(word)
        # Of overlapping spans the first stands for all.
        done = F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["text"].alias("text"))
        return F.when(s["start"] < state["at"], done).otherwise(
            F.struct(s["end"].alias("at"), F.concat(state["text"], gap, shown).alias("text"))
        )

    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["disclosure"].alias("disclosure"))))
    folded = F.aggregate(by_start, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text")), put)
    cleaned = found.withColumn("folded", folded)
    rest = F.expr("substring(text, cast(folded.at + 1 as int))")
    return cleaned.select("doc_id", F.concat("folded.text", rest).alias("text"))
