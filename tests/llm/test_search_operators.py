"""Lexical search, vector search and the conversation trie against plain Python, and their defined edge cases."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from ebbtide.llm import lexical, turn_trie, vectors

ROOT = "/root/testdata/sf0.001"


# op11

def plain_ranks(rows, items, top=20):
    docs = [(d, collections.Counter(lexical.terms_of(t))) for d, t in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n, words = len(docs), sum(size for _, _, size in docs)
    held = collections.Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in set(items):
        wanted = collections.Counter(lexical.terms_of(text))
        scores = []
        for d, c, size in docs:
            m = 75 + (25 * size * n) // words
            score = sum(
                k * math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, k in wanted.items() if t in c
            )
            if score > 0:
                scores.append((-score, d is None, d))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(scores[:top])]
    return sorted(out, key=str)


def ranks(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def items(texts):
    long = " ".join((texts[75][1] or "").split()[:300])  # more terms than one mask word has bits
    return [(1, texts[20][1]), (2, None), (3, ""), (4, "One two TWO"), (5, long), (6, "nowhere"), (None, texts[30][1]), (7, "日本 éé x y"), (1, texts[20][1])]


@pytest.mark.parametrize("block_docs, first_share, item_chars", [(lexical.BLOCK_DOCS, lexical.FIRST_SHARE, lexical.ITEM_CHARS), (7, 2, 900), (1, 1, lexical.ITEM_CHARS)])
def test_ranked_documents(spark, docs, texts, items, monkeypatch, block_docs, first_share, item_chars):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block_docs)
    bench = spark.createDataFrame([(i, t, "clash", i) for i, t in items], "item_id long, text string, rank string, doc_id long")
    got = lexical.ranked_documents(docs, bench, first_share=first_share, item_chars=item_chars)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert ranks(got) == plain_ranks(texts, items)


def test_ranked_documents_ties_repeats_and_empties(spark):
    rows = [(k % 40, "same words here") for k in range(120)] + [(None, "same words here"), (None, None), (900, "other")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(1, "words"), (2, "other words")], "item_id int, text string")
    assert ranks(lexical.ranked_documents(frame, bench)) == plain_ranks(rows, [(1, "words"), (2, "other words")])
    for empty in (lexical.ranked_documents(frame.limit(0), bench), lexical.ranked_documents(frame, bench.limit(0)), lexical.ranked_documents(frame.where("text IS NULL"), bench)):
        assert empty.count() == 0 and dict(empty.dtypes)["rank"] == "int"


def test_groups_are_left_out_when_no_better(spark, monkeypatch):
    """Masks below the twentieth score are not scored."""
    scored = []
    original = lexical.Block.scores
    monkeypatch.setattr(lexical.Block, "scores", lambda self, rows, *a: scored.append(len(rows)) or original(self, rows, *a))
    texts = ["rare common"] * 30 + ["common filler"] * 500 + ["filler"] * 100
    vocabulary, place = lexical.Vocabulary.of(["common", "rare"])
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"id": k, "text": t} for k, t in enumerate(texts)], pa.schema([("id", pa.int64()), ("text", pa.string())]))
    (row,) = [r for b in lexical.posting_blocks([batch], vocabulary) for r in b.to_pylist()]
    best = lexical.Best.none()
    item = lexical.Item(np.arange(2), np.ones(2, np.int64))
    weights = np.zeros(2, np.int64)
    weights[place["rare"]], weights[place["common"]] = 3000, 100
    lexical.search_block(lexical.Block(row, 630, 1160), item, weights, best, 0, 20)
    assert best.ids.tolist() == list(range(20)) and sum(scored) == 30


# op13

def plain_neighbours(rows, top=10):
    kept = [(k, v) for k, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = collections.defaultdict(list)
    for a, (k, v) in enumerate(kept):
        if k is not None and k % 100 == 0:
            near = sorted((math.dist(v, w), j is None, j or 0) for b, (j, w) in enumerate(kept) if b != a)
            out[k].append([round(d, 9) for d, _, _ in near[:top]])
    return out


def vector_frame(spark, rows):
    return spark.createDataFrame([(k, v, "clash", 1) for k, v in rows], "vec_id long, embedding array<double>, list string, row int").repartition(3)


def found(frame):
    out = collections.defaultdict(list)
    for r in frame.orderBy("query_id", "rank").collect():
        out[r.query_id].append(round(r.score, 9))
    return out


def test_nearest_edges(spark):
    rng = random.Random(3)
    vector = lambda: [rng.gauss(0, 1) for _ in range(20)]
    rows = [(k, vector()) for k in range(95, 130)] + [(0, None), (200, [0.0] * 20), (300, [1.0] * 19 + [None]), (400, [float("nan")] + [1.0] * 19), (500, [float("inf")] * 20), (600, [1.0] * 7), (None, vector())]
    got = vectors.nearest(vector_frame(spark, rows))
    plain = plain_neighbours([r for r in rows if r[0] != 600])
    assert found(got) == {k: v[0] for k, v in plain.items()}  # all lists are visited where there are few rows
    assert [r.vec_id for r in got.where("query_id = 100").collect() if r.vec_id == 100] == []
    few = [(100, [1.0, 2.0]), (7, [1.0, 2.0]), (3, [1.0, 2.0]), (None, [1.0, 2.0]), (9, [4.0, 6.0])]
    assert [(r["rank"], r.vec_id, r.score) for r in vectors.nearest(vector_frame(spark, few)).orderBy("rank").collect()] == [(1, 3, 0.0), (2, 7, 0.0), (3, None, 0.0), (4, 9, 5.0)]
    assert vectors.nearest(vector_frame(spark, few).limit(0)).count() == 0
    assert vectors.nearest(vector_frame(spark, [(1, None), (100, [0.0])])).count() == 0
    assert vectors.nearest(vector_frame(spark, few[1:])).count() == 0


def test_nearest_ties_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 1)  # blocks of 64 rows, several pieces to a list
    monkeypatch.setattr(vectors, "PIECE_BLOCKS", 1)
    monkeypatch.setattr(vectors, "GROUP_QUERIES", 2)
    monkeypatch.setattr(vectors, "OPEN_GROUPS", 1)
    rows = [(k, [1.0, 2.0, 3.0, 4.0]) for k in range(1, 700)] + [(100, [5.0, 1.0, 1.0, 1.0])] + [(k, [k / 100, 1.0, 1.0, 1.0]) for k in range(1000, 1100)]
    got = vectors.nearest(vector_frame(spark, rows)).collect()
    of = lambda k: [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: (r["rank"], r.score)) if r.query_id == k]
    assert of(200) == [(k, k, 0.0) for k in range(1, 11)]
    assert len(of(100)) == 20  # the id comes twice, each row with ranks 1 to 10


def test_nearest_recall(spark):
    frame = spark.read.parquet("/root/testdata/check_s/embeddings.parquet")
    got = found(vectors.nearest(frame))
    rows = frame.collect()
    ids, points = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    hits = wanted = 0
    for k in np.flatnonzero(ids % 100 == 0):
        gaps = vectors.distances(points, points[k])
        gaps[k] = np.inf
        true = np.sort(gaps)[:10]
        hits += sum(s <= round(true[-1], 9) for s in got[ids[k]])
        wanted += len(true)
    assert hits / wanted >= 0.95


# op12

def plain_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            key = hashlib.md5(f"{role or ''}\0{text or ''}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, key), (role or "", text or "")))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    members = collections.defaultdict(list)
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - c % 5, [])[:h] + turns[h:]
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, cs in members.items():
        cost = (len(cs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += cost
            leaves[node[:d]] += node not in children
    sha = lambda node: hashlib.sha256(",".join(map(str, sorted(c for c in members[node] if len(whole[c]) == len(node)))).encode()).hexdigest()
    return sorted(
        (min(cs), len(node), min(members[node[:-1]]) if node else -1, len(cs), children[node], leaves[node], saved[node], sha(node)) for node, cs in members.items()
    )


def trie(frame):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *r[3:]) for r in turn_trie.prefix_trie(frame).collect())


SCHEMA = "conv_id long, turn long, role string, text string, d long, s string"


def turn_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def chats():
    rng = random.Random(11)
    rows = []
    for c in range(0, 60):
        first = rng.choice(["hello", "hi", "hello", None])
        for k in range(rng.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, k if rng.random() > 0.05 else None, ["user", "assistant", None][k % 2 if c % 7 else 2], first if k == 0 else rng.choice(["a", "b", "é" * 50, "", "z" * 3000])))
    rows += [(200 + k, 0, "user", "one talk that many have") for k in range(40)]  # copies, and families whose first has no such turn
    rows += [(301, 0, "user", "x"), (301, 0, "user", "x"), (301, 0, "user", "w"), (302, 1, None, None), (None, 0, "user", "lost"), (None, 1, "user", "lost")]
    long = [(400, k, "user", f"t{k}") for k in range(60)]
    rows += long + [(405, k, r, t if k < 41 else t + "!") for _, k, r, t in long] + [(410, k, r, t) for _, k, r, t in long[:20]] + [(415, k, r, t) for _, k, r, t in long]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_prefix_trie(spark, chats, monkeypatch, small):
    if small:
        for name in ("BLOCK_TURNS", "EDGE_DEPTHS", "CHUNK_IDS"):
            monkeypatch.setattr(turn_trie, name, 3)
    assert trie(turn_frame(spark, chats)) == plain_trie(chats)


@pytest.mark.parametrize("steps", [6, 2])
def test_prefix_trie_asks_for_many_steps_at_once(spark, monkeypatch, steps):
    asked, exits = [], turn_trie._exits
    monkeypatch.setattr(turn_trie, "_exits", lambda pending, nodes, prefix, rounds: asked.append(rounds) or exits(pending, nodes, prefix, rounds))
    if steps < 6:
        monkeypatch.setattr(turn_trie, "STEPS", steps)
    long = [(400, k, "user", f"t{k}") for k in range(60)]
    rows = long + [(405, k, r, x if k < 41 else x + "!") for _, k, r, x in long] + [(410, k, r, x) for _, k, r, x in long[:20]]
    assert trie(turn_frame(spark, rows)) == plain_trie(rows)
    assert max(asked) == 6 // steps  # a search of up to 63 turns has six steps


def test_prefix_trie_of_little(spark):
    assert trie(turn_frame(spark, []).limit(0)) == []
    lost = [(None, 0, "user", "x")]
    assert trie(turn_frame(spark, lost)) == []
    turnless = [c for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1][:3]
    rows = [(c, 0, "user", "short") for c in turnless]  # the first turn belongs to an absent conversation
    assert trie(turn_frame(spark, rows)) == plain_trie(rows)
    assert len(plain_trie(rows)) == 1


def test_two_fattest(spark):
    rows = [(a, b) for a in range(0, 20) for b in range(a + 1, 40)]
    got = spark.createDataFrame(rows, "a long, b long").select("a", "b", turn_trie.two_fattest(F.col("a"), F.col("b")).alias("f")).collect()
    fattest = lambda a, b: max(range(a + 1, b + 1), key=lambda x: x & -x)
    assert all(r.f == fattest(r.a, r.b) for r in got)


def test_new_operators_are_registered():
    names = entry_module.queries()
    assert {"op11_ranked_search", "op12_prefix_trie", "op13_nearest_vectors"} <= set(names)
    assert {"op11_ranked_search", "op12_prefix_trie"} <= set(entry_module.oracle_sql())
