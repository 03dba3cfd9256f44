"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors are put into lists by their nearest centroid. All are turned by one random
rotation, so that any prefix of the turned dimensions is a fair sample of the whole
distance. A list is kept in blocks that hold the turned vectors by columns of a few
dimensions. A query goes through the blocks of its nearest lists column by column:
after each, a hypothesis test on the partial distances abandons the candidates whose
whole distance is above the query's radius with near certainty. What is left is
measured on the original vectors in double precision.

Lists are cut into pieces, blocks and groups of queries, all of bounded size, so a
list of any share of the rows spreads over tasks.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage
from ebbtide.llm.common import batches_of, q

TOP = 10
# Rows that centroids, the number of probed lists and first radii are fitted on, at most.
SAMPLE_ROWS = 16_384
# Sampled rows per list, at least; lists are about the square root of the rows in number.
ROWS_PER_LIST = 32
ROUNDS = 12
# Share of the sample's own nearest neighbours that the probed lists must hold.
COVERED = 0.985
# Sampled rows that stand in as queries where the number of probed lists is set.
TRIALS = 512
# Standard deviations by which a partial distance must exceed the radius.
CERTAINTY = 2.1
COLUMNS = 16
BLOCK_BYTES = 1 << 20
PIECE_BLOCKS = 16
GROUP_QUERIES = 256
# Groups of queries whose best are kept at once by one task.
OPEN_GROUPS = 64
SEED = 20

_GROUP = "list int, group_row long, query_rows binary, query_ids binary, queries binary, radii binary"
_FOUND = "query_row long, query_id long, vec_row long, vec_id long, score double"


def usable(vector: Column, size: int) -> Column:
    """Whole, finite, not all zero, and of the table's size."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce((F.size(vector) == size) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def distances(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(points - query).sum(axis=1))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(np.square(a).sum(1)[:, None] + np.square(b).sum(1)[None, :] - 2 * a @ b.T, 0)


@dataclass
class Index:
    """What is fitted on the sample; bounded by SAMPLE_ROWS."""

    centroids: np.ndarray
    rotation: np.ndarray
    scale: float
    probes: int
    sample: np.ndarray
    sample_rows: np.ndarray
    sample_ids: list

    @staticmethod
    def fit(points: np.ndarray, rows: np.ndarray, ids: list, total: int, top: int) -> Index:
        rng = np.random.default_rng(SEED)
        size = points.shape[1]
        scale = 1 / np.sqrt(np.square(points).sum(1)).mean()
        points, kept = points * scale, points
        distinct = np.unique(points, axis=0)
        lists = int(max(1, min(round(total**0.5), len(points) // ROWS_PER_LIST, len(distinct))))
        centroids = distinct[rng.choice(len(distinct), lists, replace=False)]
        for _ in range(ROUNDS):
            nearest = squared(distinct, centroids).argmin(1)
            counts = np.bincount(nearest, minlength=lists)
            sums = np.zeros_like(centroids)
            np.add.at(sums, nearest, distinct)
            centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
        rotation, _ = np.linalg.qr(rng.standard_normal((size, size)))
        # How far down a query's lists its neighbours in the sample are.
        trials = rng.choice(len(points), min(TRIALS, len(points)), replace=False)
        gaps = squared(points[trials], points)
        gaps[np.arange(len(trials)), trials] = np.inf
        near = np.argsort(gaps, axis=1)[:, : min(top, len(points) - 1)]
        home = squared(points, centroids).argmin(1)
        place = np.argsort(np.argsort(squared(points[trials], centroids), axis=1), axis=1)
        depth = np.take_along_axis(place, home[near], axis=1)
        probes = int(np.quantile(depth, COVERED, method="higher")) + 1 if depth.size else lists
        return Index(centroids, rotation, scale, probes, kept, rows, ids)

    def lists(self, points: np.ndarray) -> np.ndarray:
        return squared(points * self.scale, self.centroids).argmin(1)

    def turned(self, points: np.ndarray) -> np.ndarray:
        return ((points * self.scale) @ self.rotation).astype(np.float32)


def points_of(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(-1, size)


def packed(batches, limit: int):
    """(list, table) of up to ``limit`` consecutive rows of one list."""
    held, key, n = [], None, 0
    for batch in batches:
        lists = np.asarray(batch.column("list"))
        cuts = [0, *(np.flatnonzero(np.diff(lists)) + 1).tolist(), len(lists)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if n and lists[a] != key:
                yield key, pa.Table.from_batches(held)
                held, n = [], 0
            key = int(lists[a])
            while a < b:
                take = min(limit - n, b - a)
                held.append(batch.slice(a, take))
                a, n = a + take, n + take
                if n == limit:
                    yield key, pa.Table.from_batches(held)
                    held, n = [], 0
    if n:
        yield key, pa.Table.from_batches(held)


def scan_block(block: np.ndarray, raw: np.ndarray, query: np.ndarray, turned: np.ndarray, radius: float, scale: float, own: np.ndarray):
    """Rows of a block within ``radius`` of the query, with their distances.

    ``block`` holds the turned vectors by dimension. The partial distance over the
    first d of D dimensions estimates d/D of the whole; a candidate goes if its
    estimate exceeds the radius by more than CERTAINTY / sqrt(d) of it. The slack
    covers rounding of single-precision columns.
    """
    size = len(turned)
    slack = 1e-5 * (float(np.sqrt(np.square(turned).sum(dtype=np.float64))) + radius * scale)
    limit = (radius * scale + slack) ** 2
    alive, partial = None, 0
    for first in range(0, size, COLUMNS):
        last = min(first + COLUMNS, size)
        column = block[first:last] if alive is None else block[first:last, alive]
        partial = partial + np.square(column - turned[first:last, None]).sum(axis=0)
        wide = limit * (last / size) * (1 + CERTAINTY / last**0.5) ** 2 if last < size else limit
        keep = np.flatnonzero(~(partial > wide))
        alive, partial = keep if alive is None else alive[keep], partial[keep]
        if not len(alive):
            break
    alive = alive[~own[alive]]
    return alive, distances(raw[alive], query)


class Best:
    """The nearest found so far of each query of a group."""

    def __init__(self, row: dict, index: Index, top: int):
        self.rows, self.ids = np.frombuffer(row["query_rows"], np.int64), np.frombuffer(row["query_ids"], np.int64)
        self.queries = np.frombuffer(row["queries"], np.float64).reshape(len(self.rows), -1)
        self.turned, self.radii = index.turned(self.queries), np.frombuffer(row["radii"], np.float64).copy()
        self.scale, self.top = index.scale, top
        self.found = [(np.zeros(0), np.zeros(0, np.bool_), np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(self.rows)

    def add(self, block: np.ndarray, raw: np.ndarray, rows: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        for k, query in enumerate(self.queries):
            at, gaps = scan_block(block, raw, query, self.turned[k], self.radii[k], self.scale, rows == self.rows[k])
            if len(at):
                scores, unknown, names, places = (np.append(a, b) for a, b in zip(self.found[k], (gaps, ~known[at], ids[at], rows[at])))
                order = np.lexsort((names, unknown, scores))[: self.top]
                self.found[k] = scores[order], unknown[order], names[order], places[order]
                if len(order) == self.top:
                    self.radii[k] = min(self.radii[k], scores[order[-1]])

    def batch(self) -> pa.RecordBatch:
        counts = [len(f[0]) for f in self.found]
        scores, unknown, names, places = (np.concatenate([f[c] for f in self.found]) for c in range(4))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.rows, counts)), pa.array(np.repeat(self.ids, counts)), pa.array(places),
             pa.array(names, mask=unknown.astype(bool)), pa.array(scores)],
            ["query_row", "query_id", "vec_row", "vec_id", "score"],
        )


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, top: int = TOP) -> DataFrame:
    """The ``top`` nearest rows of every row whose id is divisible by ``every``: query_id, rank, vec_id, score.

    Ids are integers. A vector that is null, all zero, or holds a null or non-finite
    component takes no part, nor does one of another length than most have (the
    shorter on a tie). Rows that repeat an id are candidates and queries of their own,
    so their query_id comes once per row. A row without id is a candidate, never a
    query, and goes last among equal distances; else the smaller id goes first.
    Other columns are not read. Fewer candidates than ``top`` all come; an empty
    input gives no rows. ``score`` is the Euclidean distance.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col(q(id_col)).cast("long").alias("id"), F.col(q(vector_col)).alias("vector"))
    size = given.where("size(vector) > 0").groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if size is None:
        return empty
    size = size["n"]
    kind = given.schema["vector"].dataType.simpleString()
    rows = stage(given.where(usable(F.col("vector"), size)).withColumn("row", F.monotonically_increasing_id()), "vectors")
    total = rows.count()
    if not total:
        return empty
    mixed = F.pmod(F.xxhash64("row"), F.lit(1 << 30))
    share = min(1.0, 1.2 * SAMPLE_ROWS / total)
    some = rows.where(mixed < int(share * (1 << 30))).limit(SAMPLE_ROWS).toArrow()
    index = spark.sparkContext.broadcast(Index.fit(points_of(some["vector"], size), np.asarray(some["row"]), some["id"].to_pylist(), total, top))
    probes = index.value.probes

    def assign(batches):
        for batch in batches:
            if len(batch):
                lists = index.value.lists(points_of(batch.column("vector"), size))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists.astype(np.int32))], [*batch.schema.names, "list"])

    listed = stage(rows.mapInArrow(assign, f"id long, vector {kind}, row long, list int"), "lists")
    held = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}  # one row per list
    sizes = spark.sparkContext.broadcast(np.array([held.get(k, 0) for k in range(len(index.value.centroids))]))

    def visits(batches):
        """Each query with the lists that it visits, its nearest rows of the sample, and their distance as first radius."""
        fit = index.value
        for batch in batches:
            points, own = points_of(batch.column("vector"), size), np.asarray(batch.column("row"))
            radii, lists, near_rows, near_ids, near_scores = [], [], [], [], []
            for first in range(0, len(points), 128):
                part = points[first : first + 128]
                order = np.argsort(squared(part * fit.scale, fit.centroids), axis=1)
                enough = (np.cumsum(sizes.value[order], axis=1) <= 4 * top).sum(1) + 1
                gaps = squared(part * fit.scale, fit.sample * fit.scale)
                gaps[own[first : first + 128][:, None] == fit.sample_rows[None, :]] = np.inf
                near = np.argsort(gaps, axis=1)[:, :top]
                for k, query in enumerate(part):
                    seen = near[k][np.isfinite(gaps[k][near[k]])]
                    scores = distances(fit.sample[seen], query)
                    radii.append(scores.max() if len(seen) == top else np.inf)
                    lists.append(order[k][: max(probes, int(enough[k]))].astype(np.int32))
                    near_rows.append(fit.sample_rows[seen])
                    near_ids.append([fit.sample_ids[j] for j in seen.tolist()])
                    near_scores.append(scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), batch.column("vector"), pa.array(radii, pa.float64()), pa.array(lists, pa.list_(pa.int32())),
                 pa.array(near_rows, pa.list_(pa.int64())), pa.array(near_ids, pa.list_(pa.int64())), pa.array(near_scores, pa.list_(pa.float64()))],
                ["row", "id", "vector", "radius", "lists", "vec_row", "vec_id", "score"],
            )

    block_rows = max(64, BLOCK_BYTES // (size * 12))

    def blocks(batches):
        for key, table in packed(batches, block_rows):
            points = points_of(table["vector"], size)
            known = np.asarray(table["id"].is_valid())
            yield pa.RecordBatch.from_pylist([{
                "list": key, "rows": np.asarray(table["row"], np.int64).tobytes(), "ids": np.asarray(table["id"].fill_null(0), np.int64).tobytes(),
                "known": known.tobytes(), "raw": points.tobytes(), "turned": np.ascontiguousarray(index.value.turned(points).T).tobytes(),
            }], pa.schema([("list", pa.int32())] + [(c, pa.binary()) for c in ("rows", "ids", "known", "raw", "turned")]))

    def groups(batches):
        for key, table in packed(batches, GROUP_QUERIES):
            yield pa.RecordBatch.from_pylist([{
                "list": key, "group_row": table["row"][0].as_py(), "query_rows": np.asarray(table["row"], np.int64).tobytes(),
                "query_ids": np.asarray(table["id"], np.int64).tobytes(), "queries": points_of(table["vector"], size).tobytes(),
                "radii": np.asarray(table["radius"], np.float64).tobytes(),
            }], pa.schema([("list", pa.int32()), ("group_row", pa.int64())] + [(c, pa.binary()) for c in ("query_rows", "query_ids", "queries", "radii")]))

    def search(batches):
        open_groups: OrderedDict = OrderedDict()
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["list"], row["group_row"])
                if key not in open_groups:
                    open_groups[key] = Best(row, index.value, top)
                    if len(open_groups) > OPEN_GROUPS:
                        yield open_groups.popitem(last=False)[1].batch()
                read = lambda c, t, row=row: np.frombuffer(row[c], t)
                open_groups[key].add(
                    read("turned", np.float32).reshape(size, -1), read("raw", np.float64).reshape(-1, size),
                    read("rows", np.int64), read("ids", np.int64), read("known", np.bool_),
                )
        for group in open_groups.values():
            yield group.batch()

    by_list = lambda frame: frame.repartitionByRange("list", F.xxhash64("row")).sortWithinPartitions("list")
    asking = stage(
        listed.where(F.pmod("id", F.lit(every)) == 0).mapInArrow(
            visits, f"row long, id long, vector {kind}, radius double, lists array<int>, vec_row array<long>, vec_id array<long>, score array<double>"
        ),
        "queries",
    )
    sampled = asking.select(
        F.col("row").alias("query_row"), F.col("id").alias("query_id"), F.explode(F.arrays_zip("vec_row", "vec_id", "score")).alias("near")
    ).select("query_row", "query_id", "near.*")
    pieces = spark.createDataFrame([(k, -(-n // (block_rows * PIECE_BLOCKS))) for k, n in held.items()], "list int, pieces int")
    dealt = by_list(listed).mapInArrow(blocks, "list int, rows binary, ids binary, known binary, raw binary, turned binary")
    dealt = dealt.join(F.broadcast(pieces), "list").withColumn("piece", F.pmod(F.xxhash64("rows"), F.col("pieces")).cast("int")).drop("pieces")
    visited = asking.select("row", "id", "vector", "radius", F.explode("lists").alias("list"))
    asked = by_list(visited).mapInArrow(groups, _GROUP).join(F.broadcast(pieces), "list")
    asked = asked.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
    best = Window.partitionBy("query_row").orderBy("score", F.col("vec_id").asc_nulls_last())
    with batches_of(spark, 16):
        found = stage(asked.join(dealt, ["list", "piece"]).mapInArrow(search, _FOUND), "found")
    once = found.unionByName(sampled).groupBy("query_row", "query_id", "vec_row", "vec_id").agg(F.min("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
