"""N-gram Jaccard join in metric space.

Jaccard distance d = 1 - similarity is a metric. Documents that can be linked share
one of the first tokens of their shingle sets in a common order (rare tokens
first); the smallest document with that token is the pivot of all of them, so every
linked pair meets in the region of a common pivot. Inside a region, distances to
pivots decide by the triangle inequality which documents can still have a partner:
if d(x, p) + t is below the distance of every unlinked document to p, all partners
of x are linked to p already. Regions beyond a task's memory are first cut into
rings around their pivot, one link length wide, with each ring repeated beside its
neighbour, and joined in the same way; a region that rings cannot cut is joined
block by block. All of this is exact (up to 64-bit hashes of shingles); no document
or candidate is dropped, and copies with equal sets are joined as one.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage
from ebbtide.llm import words as W
from ebbtide.llm.common import merged_arrays, q, small_batches
from ebbtide.llm.components import components

SHINGLE = 5
PERCENT = 80
# Buckets of the frequency sketch: a broadcast of 4 MB at any input size.
SKETCH = 1 << 20
# Bits of the filter over documents whose texts are needed: a broadcast of 4 MB at any input size.
FILTER_BITS = 1 << 25
# What one task holds of a region.
REGION_SHINGLES = 3_000_000
REGION_DOCS = 8192
RING_LEVELS = 3


def shingle_sets(column: pa.Array, size: int = SHINGLE):
    """Sorted distinct shingle hashes of each text, in order; empty for a text without words."""
    for chunk in W.chunks(column, W.SPACED, W.LOWERED):
        hashes = W.word_hashes(chunk)
        grams = W.gram_hashes(hashes, size)
        for row in range(chunk.rows):
            part = chunk.words_of(row)
            n = part.stop - part.start
            if n >= size:
                found = np.sort(grams[part.start : part.stop - size + 1])
                yield found[np.concatenate(([True], found[1:] != found[:-1]))]
            elif n:
                yield np.array([W.sequence_hash(hashes[part])], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def prefix_length(n, percent: int):
    """Tokens of which one at least is shared with any linked set."""
    return n - (-(-n * percent // 100)) + 1


def _summaries(texts: DataFrame, size: int, id_type: str) -> DataFrame:
    """(doc_id, n, digest) per row; one more row per task holds its part of the frequency sketch."""

    def summarise(batches):
        sketch = np.zeros(SKETCH, np.uint32)
        schema = None
        for batch in batches:
            ids, sizes, digests = batch.column("doc_id"), [], []
            schema = ids.type
            tokens = []
            for s in shingle_sets(batch.column("text"), size):
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                tokens.append(s)
            if tokens:
                sketch += np.bincount((np.concatenate(tokens) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.nulls(len(sizes), pa.binary())],
                ["doc_id", "n", "digest", "sketch"],
            )
        if schema is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, schema), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([zlib.compress(sketch.tobytes(), 1)], pa.binary())],
                ["doc_id", "n", "digest", "sketch"],
            )

    return texts.mapInArrow(summarise, f"doc_id {id_type}, n long, digest binary, sketch binary")


def _filter_bits(keys: DataFrame):
    """One bit per hash of the long column ``h``, in an array of fixed size."""

    def mark(batches):
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            bits[batch.column("h").to_numpy().view(np.uint64) % np.uint64(FILTER_BITS)] = True
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())], ["blob"])

    merged = merged_arrays(stage(keys.mapInArrow(mark, "blob binary"), "bits"), np.bitwise_or, np.uint8)
    return np.zeros(FILTER_BITS // 8, np.uint8) if merged is None else merged


def _asked_texts(texts: DataFrame, bits, id_type: str) -> DataFrame:
    """(doc_id, packed) of documents that may be in the filter: the texts that are shuffled, compressed."""

    def keep(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            at = batch.column("h").to_numpy().view(np.uint64) % np.uint64(FILTER_BITS)
            hit = (bits.value[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & np.uint8(1)
            asked = batch.filter(pa.array(hit.astype(bool), pa.bool_()))
            packed = [pack(t.as_buffer()) if t.is_valid else None for t in asked.column("text")]
            yield pa.RecordBatch.from_arrays([asked.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "packed"])

    return texts.withColumn("h", F.xxhash64("doc_id")).mapInArrow(keep, f"doc_id {id_type}, packed binary")


def packed_sets(column: pa.Array, size: int):
    """Shingle sets of compressed texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    for k in range(len(column)):
        value = column[k]
        text = pa.array([unpack(value.as_buffer()) if value.is_valid else None], pa.binary()).cast(pa.string())
        yield from shingle_sets(text, size)


def _prefixes(texts: DataFrame, load, size: int, percent: int, id_type: str) -> DataFrame:
    """(doc_id, tokens): the first tokens of each set, those in the least loaded buckets first."""

    def choose(batches):
        for batch in batches:
            rows = []
            for s in shingle_sets(batch.column("text"), size):
                order = np.lexsort((s, load.value[(s & np.uint64(SKETCH - 1)).astype(np.int64)]))
                rows.append(s[order[: prefix_length(len(s), percent)]].view(np.int64) if len(s) else np.zeros(0, np.int64))
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
            values = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], ["doc_id", "tokens"]
            )

    return texts.mapInArrow(choose, f"doc_id {id_type}, tokens array<long>")


def region_links(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links (i, j) that connect exactly the sets which chains of linked sets connect."""
    links: list[tuple[int, int]] = []
    group = np.arange(len(sets))
    live = np.array([k for k, s in enumerate(sets) if len(s)], np.int64)
    reach = 1 - percent / 100 + 1e-9
    tokens = owners = None
    while len(live) > 1:
        sizes = np.array([len(sets[k]) for k in live])
        if tokens is None:
            values = np.concatenate([sets[k] for k in live])
            _, tokens, counts = np.unique(values, return_inverse=True, return_counts=True)
            # Tokens of no other set come first in the local order: a set whose prefix holds only such has no link.
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            alone = np.add.reduceat((counts[tokens] == 1).astype(np.int64), starts)
            active = alone < prefix_length(sizes, percent)
            if not active.all():
                live, tokens = live[active], None
                continue
            vocabulary, owners = len(counts), starts
            marks = np.zeros(vocabulary, bool)
        pivot = tokens[: sizes[0]]
        marks[pivot] = True
        common = np.add.reduceat(marks[tokens].astype(np.int64), owners)
        marks[pivot] = False
        union = sizes[0] + sizes - common
        linked = 100 * common >= percent * union
        linked[0] = False
        # A link inside a group that is connected already adds nothing.
        joined = group == group[live[0]]
        for other in np.unique(group[live[linked]]):
            if other != group[live[0]]:
                links.append((int(live[0]), int(live[linked][group[live[linked]] == other][0])))
                joined |= group == other
        group[joined] = group[live[0]]
        distance = 1 - common / union
        others = ~linked
        others[0] = False
        nearest = distance[others].min() if others.any() else np.inf
        keep = others | (linked & (distance + reach >= nearest))
        live = live[keep]
        if keep[1:].all():
            tokens, owners = tokens[sizes[0] :], owners[1:] - sizes[0]
        else:
            tokens = None
    return links


def possible_partners(
    tokens: list[np.ndarray], places: list[np.ndarray], last: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, load: np.ndarray, percent: int = PERCENT
) -> np.ndarray:
    """Which sets may be linked with another one, by what their first tokens have in common.

    ``tokens`` are those first tokens of each set that other sets have too, in order, with
    their places; ``last`` and ``lengths`` say where the first tokens end. Up to the point of
    the common order where those of either set end, all shared tokens are known; beyond
    it two sets share at most what one of them has left there.
    """
    found = np.zeros(len(tokens), bool)
    flat = np.concatenate([*tokens, last]).view(np.uint64)
    distinct, values = np.unique(flat, return_inverse=True)
    order = np.empty(len(distinct), np.int64)
    order[np.lexsort((distinct, load[(distinct & np.uint64(SKETCH - 1)).astype(np.int64)]))] = np.arange(len(distinct))
    ranks = order[values]
    counts = np.array([len(t) for t in tokens])
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    ends = ranks[counts.sum() :]
    parts = [ranks[a : a + n] for a, n in zip(starts, counts)]
    joined = ranks[: counts.sum()]
    marks = np.zeros(len(distinct), bool)

    def known(k: int, upto: int) -> int:
        """At least so many tokens of set k lie up to a point of the order."""
        if upto >= ends[k]:
            return lengths[k]
        at = np.searchsorted(parts[k], upto, "right")
        return places[k][at - 1] + 1 if at else 0

    for k, part in enumerate(parts):
        marks[part] = True
        common = np.add.reduceat(marks[joined].astype(np.int64), starts)
        marks[part] = False
        for j in np.flatnonzero(common > 0):
            # Each pair once; a pair of which both are found already needs no look.
            if j <= k or found[j] and found[k]:
                continue
            upto = min(ends[j], ends[k])
            most = common[j] + min(sizes[k] - known(k, upto), sizes[j] - known(j, upto))
            # Linked sets share at least percent / (100 + percent) of their joint size.
            if (100 + percent) * most >= percent * (sizes[j] + sizes[k]):
                found[j] = found[k] = True
    return found


def _prune(rows: DataFrame, load, percent: int, id_type: str) -> DataFrame:
    """(region, doc_id, n) of the rows (region, doc_id, n, length, last, shared) that may have a link in their region."""

    def prune(batches):
        region, held = None, []

        def flush():
            if len(held) < 2:
                return []
            columns = list(zip(*held))
            may = possible_partners(columns[2], columns[3], np.array(columns[4], np.int64), np.array(columns[5]), np.array(columns[1]), load.value, percent)
            return [(region, h[0], h[1]) for h, m in zip(held, may) if m]

        def rows_of(found, kind):
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], kind), pa.array([f[2] for f in found], pa.int64())],
                ["region", "doc_id", "n"],
            )

        for batch in batches:
            kind, found = batch.column("doc_id").type, []
            shared = batch.column("shared")
            names = ("region", "doc_id", "n", "last", "length")
            for k, (name, doc, n, last, length) in enumerate(zip(*(batch.column(c).to_pylist() for c in names))):
                if name != region:
                    found += flush()
                    region, held = name, []
                pairs = shared[k].values
                held.append((doc, n, pairs.field("token").to_numpy().copy(), pairs.field("place").to_numpy().copy(), last, length))
            yield rows_of(found, kind)
        if held:
            yield rows_of(flush(), kind)

    placed = rows.select("region", "doc_id", "n", "last", "length", "shared").repartition("region").sortWithinPartitions("region")
    return placed.mapInArrow(prune, f"region string, doc_id {id_type}, n long")


def _outer_regions(members: DataFrame) -> DataFrame:
    """Members of the regions that do not lie wholly within the region of a smaller pivot.

    ``members`` is (pivot, doc_id, n). If all documents of a region are in the region of
    one smaller pivot they meet there.
    """
    sizes = members.groupBy("pivot").agg(F.count("*").alias("size"))
    homes = members.select(F.col("doc_id").alias("pivot"), F.col("pivot").alias("outer")).where("outer < pivot")
    both = members.join(homes, "pivot").select("pivot", "doc_id", "outer")
    also = members.select("doc_id", F.col("pivot").alias("outer"))
    inside = both.join(also, ["doc_id", "outer"]).groupBy("pivot", "outer").agg(F.count("*").alias("size"))
    nested = inside.join(sizes, ["pivot", "size"], "left_semi").select("pivot").distinct()
    return members.join(nested, "pivot", "left_anti")


def _in_tasks(rows: DataFrame, size: int, percent: int, id_type: str) -> DataFrame:
    """Links (u, v) of all regions in (region, doc_id, packed), each held by one task."""

    def join(batches):
        region, ids, sets = None, [], []

        def flush():
            pairs = [(ids[i], ids[j]) for i, j in region_links(sets, percent)]
            return [p for p in pairs if p[0] != p[1]]

        for batch in batches:
            kind = batch.column("doc_id").type
            found = []
            names, docs = batch.column("region").to_pylist(), batch.column("doc_id").to_pylist()
            for name, doc, s in zip(names, docs, packed_sets(batch.column("packed"), size)):
                if name != region:
                    found += flush()
                    region, ids, sets = name, [], []
                ids.append(doc)
                sets.append(s.copy())
            yield _links(found, kind)
        if ids:
            yield _links(flush(), kind)

    def _links(pairs, kind):
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], kind), pa.array([p[1] for p in pairs], kind)], ["u", "v"])

    placed = rows.select("region", "doc_id", "packed").repartition("region").sortWithinPartitions("region", "doc_id")
    return placed.mapInArrow(join, f"u {id_type}, v {id_type}")


def _distances(rows: DataFrame, size: int, id_type: str) -> DataFrame:
    """(region, doc_id, n, pivot, common, pivot_n) from rows with packed and pivot_packed."""

    def measure(batches):
        for batch in batches:
            known: dict = {}
            common, pivot_n = [], []
            pivots = batch.column("pivot").to_pylist()
            pivot_texts = batch.column("pivot_packed")
            for k, s in enumerate(packed_sets(batch.column("packed"), size)):
                if pivots[k] not in known:
                    known = {pivots[k]: next(packed_sets(pivot_texts.slice(k, 1), size))}
                p = known[pivots[k]]
                common.append(len(np.intersect1d(s, p, assume_unique=True)))
                pivot_n.append(len(p))
            names = ["region", "doc_id", "n", "pivot"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(common, pa.int64()), pa.array(pivot_n, pa.int64())],
                [*names, "common", "pivot_n"],
            )

    return rows.mapInArrow(measure, f"region string, doc_id {id_type}, n long, pivot {id_type}, common long, pivot_n long")


def _cut(members: DataFrame, texts: DataFrame, level: int, size: int, percent: int, id_type: str, limits: tuple[int, int]) -> tuple[DataFrame | None, DataFrame]:
    """Links to the pivots of too large regions, and the members of the smaller regions that replace them."""
    if level >= RING_LEVELS:
        sizes = members.groupBy("region").agg(F.sum("n").alias("all_n"), F.count("*").alias("docs"))
        half = F.ceil(F.greatest(F.col("all_n") / (limits[0] // 2 + 1), F.col("docs") / (limits[1] // 2 + 1), F.lit(1))).cast("int")
        blocks = members.join(sizes.select("region", half.alias("blocks")), "region")
        own = F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
        other = blocks.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        name = F.concat_ws("/", "region", F.least("own", "other"), F.greatest("own", "other"))
        return None, other.select(name.alias("region"), "doc_id", "n")
    pivots = members.groupBy("region").agg(F.min(F.struct(F.xxhash64("doc_id", F.lit(level)), "doc_id")).alias("p"))
    chosen = pivots.select("region", F.col("p.doc_id").alias("pivot"))
    pivot_texts = chosen.join(texts.select(F.col("doc_id").alias("pivot"), F.col("packed").alias("pivot_packed")), "pivot").dropDuplicates(["region"])
    paired = members.join(texts, "doc_id").join(pivot_texts, "region")
    measured = stage(_distances(paired, size, id_type), "distances")
    union = F.col("n") + F.col("pivot_n") - F.col("common")
    distance = 1 - F.col("common") / union
    t = 1 - percent / 100
    ring = F.when(100 * F.col("common") >= percent * union, 0).otherwise(F.greatest(F.lit(1), F.ceil((distance - 1e-9) / t) - 1))
    ringed = measured.select("region", "doc_id", "n", "pivot", distance.alias("d"), ring.cast("int").alias("ring"))
    links = ringed.where("ring = 0").select(F.col("doc_id").alias("u"), F.col("pivot").alias("v"))
    nearest = ringed.where("ring > 0").groupBy("region").agg(F.min("d").alias("nearest"))
    # Linked documents stay only where an unlinked one can be their partner; the pivot's own links are all known.
    open_rows = ringed.join(nearest, "region").where((F.col("doc_id") != F.col("pivot")) & ((F.col("ring") > 0) | (F.col("d") + t + 1e-9 >= F.col("nearest"))))
    sides = open_rows.withColumn("side", F.explode(F.array(F.col("ring"), F.col("ring") - 1))).where("side >= 0")
    return links, sides.select(F.concat_ws(":", "region", "side").alias("region"), "doc_id", "n").distinct()


def join_regions(members: DataFrame, texts: DataFrame, size: int, percent: int, id_type: str, limits: tuple[int, int]) -> list[DataFrame]:
    """Links of all regions in (region, doc_id, n)."""
    found: list[DataFrame] = []
    for level in range(RING_LEVELS + 2):
        sizes = members.groupBy("region").agg(F.sum("n").alias("all_n"), F.count("*").alias("docs")).where("docs > 1")
        large = (F.col("all_n") > limits[0]) | (F.col("docs") > limits[1])
        marked = members.join(sizes.select("region", large.alias("large")), "region")
        last = level > RING_LEVELS
        fits = marked if last else marked.where("NOT large")
        found.append(_in_tasks(fits.join(texts, "doc_id"), size, percent, id_type))
        if last or sizes.where(large).isEmpty():
            break
        links, cut = _cut(marked.where("large").drop("large"), texts, level, size, percent, id_type, limits)
        members = stage(cut, "regions")
        if links is not None:
            found.append(links)
    return found


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT,
    limits: tuple[int, int] = (REGION_SHINGLES, REGION_DOCS),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Sets are the distinct ``size``-word shingles of the text, lower-cased in A-Z; a text
    of fewer words is one shingle; null and empty texts have no shingles and no links.
    ``component_id`` is the smallest id reachable over links with similarity of
    ``percent`` per cent or more. Rows that repeat an id are one document, with the
    links of any of them; a row without id has no links and no component. Other
    columns are not read; an empty input gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(q(id_col)).alias("doc_id"), F.col(q(text_col)).alias("text"))
    summary = stage(_summaries(texts, size, id_type), "sets")
    sketch = merged_arrays(summary.where("sketch IS NOT NULL").select(F.col("sketch").alias("blob")), np.add, np.uint32)
    load = spark.sparkContext.broadcast(np.zeros(SKETCH, np.uint32) if sketch is None else sketch)
    sets = summary.where("sketch IS NULL").select("doc_id", "n", "digest")
    named = sets.where("doc_id IS NOT NULL AND n > 0")

    # Equal sets are linked to the smallest id among them, which stands for them below.
    same = named.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = stage(named.join(same, "digest").select("doc_id", "rep", "n").distinct(), "reps")
    equal = reps.where("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))

    prefixes = stage(_prefixes(texts.where("doc_id IS NOT NULL"), load, size, percent, id_type), "prefixes")
    tokens = prefixes.select("doc_id", F.posexplode("tokens").alias("place", "token"))
    pivots = tokens.groupBy("token").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last")).where("pivot < last").drop("last")
    met_tokens = stage(tokens.join(pivots, "token").select("doc_id", "place", "token", "pivot"), "tokens")
    near = met_tokens.select("doc_id", "pivot").distinct()
    # The first tokens of a document that others have too, and where its first tokens end.
    shared = met_tokens.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("place", "token"))).alias("shared"))
    ends = prefixes.where(F.size("tokens") > 0).select("doc_id", F.size("tokens").cast("long").alias("length"), F.element_at("tokens", -1).alias("last"))
    by_rep = reps.select("doc_id", "rep", "n")
    pivot_rep = by_rep.select(F.col("doc_id").alias("pivot"), F.col("rep").alias("pivot_rep")).distinct()
    pairs = near.join(by_rep, "doc_id").join(pivot_rep, "pivot").where("rep <> pivot_rep").select("pivot_rep", "rep", "n")
    homes = by_rep.where("doc_id = rep").select(F.col("rep").alias("pivot_rep"), "rep", "n").join(pairs.select("pivot_rep").distinct(), "pivot_rep", "left_semi")
    met = stage(
        pairs.unionByName(homes).groupBy(F.col("pivot_rep").alias("pivot"), F.col("rep").alias("doc_id")).agg(F.max("n").alias("n")), "met"
    )
    members = stage(_outer_regions(met).select(F.col("pivot").cast("string").alias("region"), "doc_id", "n"), "members")
    # An id on rows with different sets has no single order of tokens; its regions go on unpruned.
    several = reps.groupBy("doc_id").agg(F.lit(True).alias("several"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    sizes = members.join(several, "doc_id", "left").groupBy("region").agg(
        F.sum("n").alias("all_n"), F.count("*").alias("docs"), F.coalesce(F.max("several"), F.lit(False)).alias("several")
    ).where("docs > 1")
    large = (F.col("all_n") > limits[0]) | (F.col("docs") > limits[1]) | F.col("several")
    marked = members.join(sizes.select("region", large.alias("large")), "region")
    fits = marked.where("NOT large").drop("large")
    held = fits.join(ends, "doc_id").join(shared, "doc_id")
    members = stage(_prune(held, load, percent, id_type).unionByName(marked.where("large").drop("large")).distinct(), "members")
    asked = members.select("doc_id").distinct()
    bits = spark.sparkContext.broadcast(_filter_bits(asked.select(F.xxhash64("doc_id").alias("h"))))
    wanted = _asked_texts(texts, bits, id_type).join(asked, "doc_id", "left_semi")
    edges = equal
    for links in join_regions(members, wanted, size, percent, id_type, limits):
        edges = edges.unionByName(links)
    found = components(edges)
    return sets.join(found, sets["doc_id"] == found["node"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, in its own columns.

    Texts without words, null ones too, are linked with nothing and stay, and so do rows
    without id. Rows that repeat an id stay or go together; an empty input gives no rows.
    """
    found = jaccard_components(docs, id_col, text_col).where("component_id <> doc_id").select(F.col("doc_id").alias("dropped_id")).distinct()
    return docs.join(found, docs[id_col] == found["dropped_id"], "left_anti")
