"""Quality by importance resampling.

Two generative models over hashed word 1- and 2-grams, one of target text and one of
the raw corpus, give every document the log of its importance weight. Gumbel noise
added to it turns the largest keys into a sample without replacement by weight.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage
from ebbtide.llm import words as W
from ebbtide.llm.common import merged_arrays, q, small_batches

BUCKETS = 1 << 18
# Counts that every bucket's ratio is shrunk by: rare n-grams say little, whoever holds them.
PRIOR = 50.0
# Bound of the target sample the target model is fitted on: documents with the smallest hash of their id.
TARGET_SAMPLE = 20_000
SEED = 20_240_601
BINS = 4096


def ngram_buckets(column: pa.Array, buckets: int = BUCKETS):
    """Buckets of all 1- and 2-grams of each text, repeats included."""
    for chunk in W.chunks(column, W.ALNUM, W.LOWERED):
        hashes = W.word_hashes(chunk)
        single = (W.mix(hashes) % np.uint64(buckets)).astype(np.int64)
        double = (W.gram_hashes(hashes, 2) % np.uint64(buckets)).astype(np.int64)
        for row in range(chunk.rows):
            part = chunk.words_of(row)
            yield np.concatenate((single[part], double[part.start : max(part.start, part.stop - 1)]))


def fit(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, sample: int = TARGET_SAMPLE) -> np.ndarray:
    """Log ratio per bucket of the target and raw models, shrunk towards 0 where counts are low.

    The raw model counts every row; the target model those whose id is among the
    ``sample`` ids of ``target_ids`` (one column) with the smallest hash.
    """
    small_batches(docs.sparkSession)
    target = target_ids.toDF("target_id").where("target_id IS NOT NULL").distinct()
    target = target.orderBy(F.xxhash64("target_id"), "target_id").limit(sample).withColumn("is_target", F.lit(True))
    rows = docs.select(F.col(q(id_col)).alias("id"), F.col(q(text_col)).alias("text")).join(F.broadcast(target), F.col("id") == F.col("target_id"), "left")

    def count(batches):
        sums = np.zeros(2 * buckets, np.int64)
        for batch in batches:
            marked = batch.column("is_target").to_pylist()
            for k, found in enumerate(ngram_buckets(batch.column("text"), buckets)):
                own = np.bincount(found, minlength=buckets)
                sums[buckets:] += own
                if marked[k]:
                    sums[:buckets] += own
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(sums.tobytes(), 1)], pa.binary())], ["blob"])

    sums = merged_arrays(stage(rows.select("text", "is_target").mapInArrow(count, "blob binary"), "counts"), np.add, np.int64)
    sums = np.zeros(2 * buckets, np.int64) if sums is None else sums
    found, raw = sums[:buckets], sums[buckets:]
    expected = raw * (found.sum() / max(1, raw.sum()))
    return np.log((found + PRIOR) / (expected + PRIOR))


def weigh(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_grams, log_weight. Null and wordless texts have no grams and weight 0."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    id_type = docs.schema[id_col].dataType.simpleString()

    def score(batches):
        for batch in batches:
            sizes, sums = [], []
            for found in ngram_buckets(batch.column("text"), len(shared.value)):
                sizes.append(len(found))
                sums.append(float(shared.value[found].sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())], ["doc_id", "n_grams", "log_weight"])

    rows = docs.select(F.col(q(id_col)).alias("doc_id"), F.col(q(text_col)).alias("text"))
    return rows.mapInArrow(score, f"doc_id {id_type}, n_grams long, log_weight double")


def threshold(keys: DataFrame, k: int) -> tuple[float, int] | None:
    """The k-th largest value of the double column ``key`` and how many equal ones belong to the top k.

    Ranges around the answer are counted in bins and narrowed until a bin holds one
    value; each round is one aggregate over the narrow table.
    """
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("*")).first()
    if k <= 0 or not n:
        return None
    k = min(k, n)
    while low < high:
        width = (high - low) / BINS
        place = F.least(F.floor((F.col("key") - low) / width), F.lit(BINS - 1)) if width > 0 else F.lit(0)
        bins = keys.where(F.col("key").between(low, high)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        for row in sorted(bins.collect(), key=lambda r: -r["bin"]):  # at most BINS rows
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
    return low, k


def resample(docs: DataFrame, ratio: np.ndarray, k: int, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_grams, log_weight, key, kept.

    ``kept`` marks the ``k`` rows with the largest keys. The noise comes from a hash of
    the id, so reruns agree; among equal keys the smaller ids come first, and rows that
    repeat an id and its weight are taken in any order. A null or wordless text has the
    key minus infinity and is never kept, so fewer than ``k`` rows are where the others are fewer.
    An empty input gives no rows.
    """
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2**52)) + 0.5) / float(2**52)
    keyed = weigh(docs, ratio, id_col, text_col).withColumn("key", F.when(F.col("n_grams") > 0, F.col("log_weight") - F.log(-F.log(uniform))).otherwise(float("-inf")))
    rows = stage(keyed, "keys")
    found = threshold(rows.where("n_grams > 0").select("key"), k)
    if found is None:
        return rows.withColumn("kept", F.lit(False))
    cut, ties = found
    # Only rows equal to the cut are ordered among themselves.
    above = rows.where(F.col("key") != cut).withColumn("kept", F.col("key") > cut)
    equal = rows.where(F.col("key") == cut).withColumn("kept", F.row_number().over(Window.partitionBy("key").orderBy("doc_id")) <= ties)
    return above.unionByName(equal)


def sample_size(docs: DataFrame, labelled: DataFrame) -> int:
    """Rows of ``docs`` times the share of ``labelled`` (boolean column ``is_target``) that is target; 0 without labels."""
    share = labelled.agg(F.avg(F.col("is_target").cast("int"))).first()[0]
    return round(docs.count() * (share or 0.0))
