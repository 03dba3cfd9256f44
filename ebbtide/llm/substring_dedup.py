"""Substring deduplication with prefix-partitioned suffix trees.

Every window of ``WINDOW`` words has one anchor: its smallest-hashed run of ``GRAM``
words. Only suffixes at anchors are kept (a sparse suffix tree), about one word in
twenty; neighbouring windows with the same anchor form a segment, the anchor's
context. Suffixes are partitioned by their prefix, the anchor's run of words;
prefixes found in one segment text only need no tree, as all copies of that text
agree. For the others the distinct segment texts of a prefix form one group, and a
tree over the window suffixes of the group, cut at ``WINDOW`` words, tells by its
nodes of that depth which windows other documents hold: runs of them are the maximal
repeats. A prefix with more segments than a task should hold is lengthened by the
words of the windows themselves and counted by an ordinary aggregate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage
from ebbtide.llm import words as W
from ebbtide.llm.common import q, small_batches

WINDOW = 50
GRAM = 8
# Distinct segment texts of one prefix that one task turns into a tree.
GROUP_SEGMENTS = 20_000


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` grams the position of its smallest, the first of equals."""
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    # Doubling: best[i] is the place of the smallest among `span` grams from i.
    best, span = np.arange(len(grams)), 1
    while span < width:
        step = min(span, width - span)
        left, right = best[:-step], best[step:]
        best = np.where(grams[right] < grams[left], right, left)
        span += step
    return best[:n]


def segments(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor gram, first window and number of windows of each segment of one text."""
    grams = W.gram_hashes(hashes, gram)
    places = anchors(grams, window - gram + 1)
    if not len(places):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
    return grams[places[first]], first, np.diff(np.concatenate((first, [len(places)])))


def _sums(hashes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums for the hash of any run of words, and the factors that move a run to the origin."""
    n = len(hashes) + 1
    steps, back = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    steps[0] = back[0] = 1
    power, inverse = np.multiply.accumulate(steps), np.multiply.accumulate(back)
    total = np.zeros(n, np.uint64)
    np.cumsum(hashes * power[:-1], out=total[1:])
    return total, inverse


BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def run_hashes(hashes: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each run of words."""
    out = []
    for base in BASES:
        total, inverse = _sums(hashes, base)
        out.append(W.mix((total[first + length] - total[first]) * inverse[first] + length.astype(np.uint64)))
    return out[0], out[1]


def _occurrences(texts: DataFrame, window: int, gram: int, id_type: str) -> DataFrame:
    """(doc_id, version, segments): prefix, two hashes of the text, first window and windows of each segment."""
    names = ["prefix", "h1", "h2", "first", "windows"]

    def cut(batches):
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in names]
            lengths = []
            for chunk in W.chunks(batch.column("text"), W.SPACED):
                hashes = W.word_hashes(chunk)
                for row in range(chunk.rows):
                    own = hashes[chunk.words_of(row)]
                    prefix, first, windows = segments(own, window, gram)
                    h1, h2 = run_hashes(own, first, windows + window - 1) if len(first) else (prefix, prefix)
                    lengths.append(len(first))
                    for k, values in enumerate((prefix.view(np.int64), h1.view(np.int64), h2.view(np.int64), first, windows)):
                        columns[k].append(values.astype(np.int64, copy=False))
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            fields = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in columns]
            fields[3], fields[4] = fields[3].cast(pa.int32()), fields[4].cast(pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, names))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("version"), lists], ["doc_id", "version", "segments"])

    kind = "array<struct<prefix: long, h1: long, h2: long, first: int, windows: int>>"
    return texts.mapInArrow(cut, f"doc_id {id_type}, version long, segments {kind}")


def depth_nodes(texts: list[np.ndarray], owners: list, window: int) -> list[list[tuple[int, int, object]]]:
    """For each segment text the runs [a, b) of its windows with the smallest owner that holds them.

    The window suffixes of all texts are sorted by their first ``window`` words; equal
    neighbours hang below one node of that depth. The smallest owner below a node goes
    to each of its windows, and neighbouring windows with the same owner are one run.
    """
    lengths = np.array([len(t) - window + 1 for t in texts])
    text_of = np.repeat(np.arange(len(texts)), lengths)
    place = np.concatenate([np.arange(n) for n in lengths])
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])[:-1]))
    joined = np.concatenate(texts)
    at = starts[text_of] + place
    # Words as ranks, then ranks of runs of 1, 2, 4, ... words, until the rank orders whole windows.
    _, rank = np.unique(joined, return_inverse=True)
    span = 1
    while span < window:
        step = min(span, window - span)
        pair = rank[:-step].astype(np.int64) * (int(rank.max()) + 1) + rank[step:]
        _, rank = np.unique(pair, return_inverse=True)
        span += step
    node = rank[at]
    order = sorted(set(owners))
    index = {o: k for k, o in enumerate(order)}
    owner = np.array([index[o] for o in owners])[text_of]
    least = np.full(int(node.max()) + 1, len(order), np.int64)
    np.minimum.at(least, node, owner)
    found = least[node]
    result = []
    for k, n in enumerate(lengths):
        part = found[text_of.searchsorted(k) :][:n]
        edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        ends = np.concatenate((edges[1:], [n]))
        result.append([(int(a), int(b), order[part[a]]) for a, b in zip(edges, ends)])
    return result


RUNS = "array<struct<a: int, b: int, owner: {}>>"


def _trees(rows: DataFrame, window: int, id_type: str) -> DataFrame:
    """(prefix, h1, h2, runs) from rows (prefix, h1, h2, owner, words) grouped by prefix."""

    def build(batches):
        prefix, group = None, []

        def flush():
            texts = [np.frombuffer(g[3], np.uint64) for g in group]
            runs = depth_nodes(texts, [g[2] for g in group], window)
            return [(prefix, g[0], g[1], r) for g, r in zip(group, runs)]

        def rows_of(found, kind):
            runs = pa.array([[{"a": a, "b": b, "owner": o} for a, b, o in f[3]] for f in found], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("owner", kind)])))
            return pa.RecordBatch.from_arrays([*(pa.array([f[k] for f in found], pa.int64()) for k in range(3)), runs], ["prefix", "h1", "h2", "runs"])

        for batch in batches:
            found = []
            kind = batch.column("owner").type
            for p, *rest in zip(*(batch.column(c).to_pylist() for c in ("prefix", "h1", "h2", "owner", "words"))):
                if p != prefix:
                    if group:
                        found += flush()
                    prefix, group = p, []
                group.append(rest)
            yield rows_of(found, kind)
        if group:
            yield rows_of(flush(), kind)

    placed = rows.repartition("prefix").sortWithinPartitions("prefix")
    return placed.mapInArrow(build, f"prefix long, h1 long, h2 long, runs {RUNS.format(id_type)}")


def _segment_words(rows: DataFrame, id_type: str, window: int) -> DataFrame:
    """Word hashes of the asked segments: (prefix, h1, h2, owner, words) from (doc_id, asked, text)."""

    def read(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            owners, asked = batch.column("doc_id"), batch.column("asked").to_pylist()
            source, row = [], 0
            for chunk in W.chunks(batch.column("text"), W.SPACED):
                hashes = W.word_hashes(chunk)
                for k in range(chunk.rows):
                    own = hashes[chunk.words_of(k)]
                    for s in asked[row]:
                        end = s["first"] + s["windows"] + window - 1
                        if end > len(own):  # a row with the same id and another text
                            continue
                        h1, h2 = run_hashes(own[s["first"] : end], np.zeros(1, np.int64), np.array([end - s["first"]]))
                        if (int(h1.view(np.int64)[0]), int(h2.view(np.int64)[0])) != (s["h1"], s["h2"]):
                            continue
                        for column, value in zip(out, (s["prefix"], s["h1"], s["h2"], None, own[s["first"] : end].tobytes())):
                            column.append(value)
                        source.append(row)
                    row += 1
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(out[k], pa.int64()) for k in range(3)), owners.take(pa.array(source, pa.int64())), pa.array(out[4], pa.binary())],
                ["prefix", "h1", "h2", "owner", "words"],
            )

    return rows.mapInArrow(read, f"prefix long, h1 long, h2 long, owner {id_type}, words binary")


def _windows_of(rows: DataFrame, window: int, id_type: str) -> DataFrame:
    """(prefix, h1, h2, owner, place, w1, w2): one row per window, for prefixes too large for one task."""

    def split(batches):
        for batch in batches:
            source, place, hashes = [], [], ([], [])
            for k, blob in enumerate(batch.column("words").to_pylist()):
                own = np.frombuffer(blob, np.uint64)
                n = len(own) - window + 1
                w = run_hashes(own, np.arange(n), np.full(n, window))
                source.append(np.full(n, k))
                place.append(np.arange(n))
                hashes[0].append(w[0].view(np.int64))
                hashes[1].append(w[1].view(np.int64))
            if not source:
                continue
            taken = batch.select(["prefix", "h1", "h2", "owner"]).take(pa.array(np.concatenate(source)))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(np.concatenate(place), pa.int32()), *(pa.array(np.concatenate(h), pa.int64()) for h in hashes)],
                ["prefix", "h1", "h2", "owner", "place", "w1", "w2"],
            )

    return rows.mapInArrow(split, f"prefix long, h1 long, h2 long, owner {id_type}, place int, w1 long, w2 long")


def repeated_runs(texts: DataFrame, window: int, gram: int, group_segments: int, id_type: str) -> DataFrame:
    """(doc_id, version, first, runs): for segments with windows of smaller documents, the runs of windows and their smallest owner."""
    occurrences = stage(_occurrences(texts, window, gram, id_type), "suffixes")
    flat = occurrences.select("doc_id", "version", F.explode("segments").alias("s")).select("doc_id", "version", "s.*")
    # Equal segment texts are one leaf with the smallest document that holds it.
    leaves = flat.groupBy("prefix", "h1", "h2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.min_by(F.struct("first", "windows"), "doc_id").alias("at"))
    leaves = stage(leaves, "leaves")
    sizes = leaves.groupBy("prefix").agg(F.count("*").alias("leaves"), F.min("owner").alias("low"), F.max("last").alias("high")).where("low < high")
    sizes = stage(sizes.where("leaves > 1"), "prefixes")
    grouped = leaves.join(sizes.select("prefix", (F.col("leaves") > group_segments).alias("large")), "prefix")
    asked = grouped.groupBy(F.col("owner").alias("doc_id")).agg(
        F.collect_list(F.struct("prefix", "h1", "h2", "at.first", "at.windows")).alias("asked")
    )
    contents = stage(
        _segment_words(texts.join(asked, "doc_id").select("doc_id", "asked", "text"), id_type, window).join(grouped.select("prefix", "h1", "h2", "large"), ["prefix", "h1", "h2"]),
        "contents",
    )
    trees = _trees(contents.where("NOT large").drop("large"), window, id_type)
    # Lone texts of a prefix: every window has the leaf's own smallest document.
    lone = leaves.where("owner < last").join(sizes.select("prefix"), "prefix", "left_anti").select(
        "prefix", "h1", "h2", F.array(F.struct(F.lit(0).alias("a"), F.col("at.windows").alias("b"), F.col("owner"))).alias("runs")
    )
    results = [trees, lone]
    if not sizes.where(F.col("leaves") > group_segments).isEmpty():
        single = _windows_of(contents.where("large").drop("large"), window, id_type)
        least = single.groupBy("prefix", "w1", "w2").agg(F.min("owner").alias("least"))
        owned = single.join(least, ["prefix", "w1", "w2"]).groupBy("prefix", "h1", "h2")
        results.append(owned.agg(F.collect_list(F.struct(F.col("place").alias("a"), (F.col("place") + 1).alias("b"), F.col("least").alias("owner"))).alias("runs")))
    runs = results[0]
    for more in results[1:]:
        runs = runs.unionByName(more)
    owned = flat.join(runs, ["prefix", "h1", "h2"])
    earlier = owned.select("doc_id", "version", "first", F.filter("runs", lambda r: r["owner"] < F.col("doc_id")).alias("runs"))
    return earlier.where(F.size("runs") > 0)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, group_segments: int = GROUP_SEGMENTS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_text, spans.

    A word goes when a window of ``window`` words that covers it also starts in a document
    with a smaller id; windows are judged on the input. ``spans`` are the removed
    [start, end) word ranges; ``kept_text`` joins the kept words by one space. Null and
    empty texts have no words, texts shorter than a window keep all. Rows that repeat
    an id never count as a smaller document for each other, and each loses its own spans
    only; a row without id keeps all and counts for none. Other columns are not read; an empty input gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.col(q(text_col))
    # Rows of one id are told apart by a hash of their text; rows equal in both lose the same words.
    texts = docs.select(F.col(q(id_col)).alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))
    named = texts.where("doc_id IS NOT NULL")
    runs = repeated_runs(named, window, gram, group_segments, id_type)
    flat = runs.select("doc_id", "version", F.explode(F.transform("runs", lambda r: F.struct((F.col("first") + r["a"]).alias("a"), (F.col("first") + r["b"]).alias("b")))).alias("r"))
    spans = flat.groupBy("doc_id", "version").agg(F.collect_set("r").alias("spans"))
    joined = texts.join(spans, ["doc_id", "version"], "left").select("doc_id", "text", "spans")

    def remove(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(4)]
            row, asked = 0, batch.column("spans").to_pylist()
            for chunk in W.chunks(batch.column("text"), W.SPACED):
                raw = chunk.data.tobytes()
                for k in range(chunk.rows):
                    part = chunk.words_of(k)
                    starts, ends = chunk.starts[part], chunk.ends[part]
                    n = len(starts)
                    change = np.zeros(n + 1, np.int64)
                    for r in asked[row] or ():
                        a, b = min(r["a"], n), min(r["b"] + window - 1, n)
                        change[a] += 1
                        change[b] -= 1
                    gone = np.cumsum(change[:n]) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    kept = np.flatnonzero(~gone)
                    out[0].append(n)
                    out[1].append(int(gone.sum()))
                    out[2].append(b" ".join([raw[a:b] for a, b in zip(starts[kept].tolist(), ends[kept].tolist())]))
                    out[3].append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
                    row += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()).cast(pa.string()),
                 pa.array(out[3], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", "n_words", "n_removed", "kept_text", "spans"],
            )

    return joined.mapInArrow(remove, f"doc_id {id_type}, n_words long, n_removed long, kept_text string, spans array<struct<start: long, end: long>>")
