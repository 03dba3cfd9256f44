"""Language identification by the nearest of several centroids per language.

Texts become TF-IDF vectors of hashed character 1- to 3-grams, scaled to length one.
Per language the fitting sample is clustered (spherical k-means), and a text gets
the language of the centroid with the largest cosine. A text further from its
centroid than that centroid's radius is rejected. Short texts have small cosines, so a
centroid has a radius for each length, learned from the starts of the fitting texts.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage
from ebbtide.llm.common import q, small_batches

DIMENSIONS = 4096
CENTROIDS = 4
ROUNDS = 10
# Bound of the fitting sample: texts per language, those with the smallest hash of their id.
SAMPLE = 300
# A text is rejected when its cosine is below this quantile of those of fitting texts cut to its length.
QUANTILE = 0.01
# Radii are learned for lengths of 1, 2, 4 and so on characters, so many lengths; longer texts take the last.
LENGTHS = 14
# Fitting texts that a radius needs.
LEAST = 20
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter, for all code points."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


# Characters that are hashed at a time.
BLOCK = 1 << 20


def counts(text: str | None) -> np.ndarray | None:
    """Hashed 1- to 3-gram counts of the whole text; runs of non-letters are one space. None without a letter."""
    total = None
    for start in range(0, len(text or ""), BLOCK):
        # Two characters of the block before complete the grams across the border.
        lead = min(start, 2)
        codes = np.frombuffer(text[start - lead : start + BLOCK].lower().encode("utf-32-le", "replace"), np.uint32).copy()
        is_letter = _letters()[codes]
        codes[~is_letter] = 32
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]
        codes = codes[keep].astype(np.uint64)
        if not is_letter.any():
            continue
        part = np.zeros(DIMENSIONS)
        h = np.zeros(len(codes), np.uint64)
        for n in range(1, 4):
            if len(codes) < n:
                break
            h = h[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(n)
            spread = (h * np.uint64(0xD1342543DE82EF95)) >> np.uint64(52)
            part += np.bincount(spread.astype(np.int64), minlength=DIMENSIONS)
        total = part if total is None else total + part
    return total


def _scaled(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.sqrt(found) * idf
    length = np.linalg.norm(weighted)
    return weighted / length if length > 0 else weighted


def vector(text: str | None, idf: np.ndarray) -> np.ndarray | None:
    found = counts(text)
    return None if found is None else _scaled(found, idf)


def length_class(found: np.ndarray) -> int:
    """Of the lengths with a radius, the last that a text with these counts reaches; a character counts in about three grams."""
    return min(LENGTHS, max(1, int(found.sum()) // 3).bit_length()) - 1


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    radii: np.ndarray  # least cosine that is accepted, by centroid and length
    idf: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine cut to [0, 1], and whether the text is rejected."""
        found = counts(text) if self.languages else None
        if found is None:
            return UNKNOWN, 0.0, True
        cosines = self.centroids @ _scaled(found, self.idf)
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        return self.languages[best], score, bool(score < self.radii[best, length_class(found)])


def _radii(texts: list[str], centers: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Least accepted cosine by centroid and length, from the starts of the fitting texts of one language.

    A centroid with few starts takes the quantile over its language. NaN where that has few too.
    """
    radii = np.full((len(centers), LENGTHS), np.nan)
    classes = [length_class(found) if (found := counts(t)) is not None else -1 for t in texts]
    for k in range(LENGTHS):
        starts = [vector(t[: 1 << k], idf) for t, c in zip(texts, classes) if c >= k]
        starts = [v for v in starts if v is not None]
        if len(starts) < LEAST:
            # Longer texts have larger cosines: the radius of the length before is no larger than theirs would be.
            radii[:, k] = radii[:, k - 1] if k else np.nan
            continue
        cosines = np.array(starts) @ centers.T
        home, best = np.argmax(cosines, axis=1), cosines.max(axis=1)
        for c in range(len(centers)):
            own = best[home == c]
            radii[c, k] = np.quantile(own if len(own) >= LEAST else best, QUANTILE)
    return radii


def _document_frequencies(sample: DataFrame) -> tuple[np.ndarray, int]:
    def count(frames):
        seen, n = np.zeros(DIMENSIONS), 0
        for frame in frames:
            for text in frame["text"]:
                found = counts(text)
                if found is not None:
                    seen += found > 0
                    n += 1
        yield pd.DataFrame({"seen": [seen.tolist()], "n": [n]})

    rows = sample.select("text").mapInPandas(count, "seen array<double>, n long").collect()
    return np.sum([r.seen for r in rows], axis=0) if rows else np.zeros(DIMENSIONS), sum(r.n for r in rows)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, k: int = CENTROIDS) -> Model:
    """Centroids from at most ``sample`` texts per language, chosen by a hash of their id.

    Rows with a null text or language, or without a letter, do not count. An id that
    repeats in a language counts once, with its smallest text; so do rows without id.
    Without any usable row the model knows no language and rejects all.
    """
    spark = docs.sparkSession
    small_batches(spark)
    order = F.struct(F.xxhash64(q(id_col)), F.col(q(id_col)).cast("string"))
    usable = docs.where(F.col(q(lang_col)).isNotNull() & F.col(q(text_col)).rlike(r"\p{L}"))
    keys = usable.select(F.col(q(lang_col)).alias("lang"), order.alias("rank"))
    bound = _smallest(keys, sample)
    chosen = usable.select(F.col(q(lang_col)).alias("lang"), F.col(q(text_col)).alias("text"), order.alias("rank")).join(
        F.broadcast(bound), "lang"
    ).where("rank <= cut")
    # One text an id, taken before rows meet: an id that repeats, or is missing, may be that of a third of all rows.
    chosen = stage(chosen.groupBy("lang", "rank").agg(F.min("text").alias("text")), "lang-sample")
    seen, n = _document_frequencies(chosen)
    idf = np.log((1 + n) / (1 + seen)) + 1
    shared = spark.sparkContext.broadcast(idf)

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("name").iloc[:sample]
        vectors = np.array([vector(t, shared.value) for t in frame["text"]])
        centers = _spread(vectors, min(k, len(vectors)))
        for _ in range(ROUNDS):
            home = np.argmax(vectors @ centers.T, axis=1)
            sums = np.array([vectors[home == c].sum(axis=0) if (home == c).any() else centers[c] for c in range(len(centers))])
            centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        radii = _radii(list(frame["text"]), centers, shared.value)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "part": range(len(centers)), "center": centers.tolist(), "radii": radii.tolist()})

    named = chosen.select("lang", "text", F.concat_ws(" ", F.col("rank.col1").cast("string"), F.col("rank.col2")).alias("name"))
    fitted = named.groupBy("lang").applyInPandas(cluster, "lang string, part int, center array<double>, radii array<double>").collect()
    fitted = sorted(fitted, key=lambda r: (r.lang, r.part))
    radii = np.array([r.radii for r in fitted], float).reshape(-1, LENGTHS)
    # A language with too few texts for radii of its own takes the least of the others, or rejects nothing if there are none.
    least = np.where(np.isnan(radii), np.inf, radii).min(axis=0, initial=np.inf)
    radii = np.where(np.isnan(radii), np.where(np.isinf(least), 0.0, least), radii)
    return Model([r.lang for r in fitted], np.array([r.center for r in fitted]).reshape(-1, DIMENSIONS), radii, idf)


def _smallest(keys: DataFrame, sample: int) -> DataFrame:
    """(lang, cut): the rank of the last chosen row of each language.

    Hashes are uniform, so the smallest lie below a bound set by the language's count of ids,
    estimated within a few hundredths; only ids below it, some 16 times the sample however many
    there are, are ranked.
    """
    counts = keys.groupBy("lang").agg(F.approx_count_distinct("rank.col1").alias("n"))
    share = F.least(F.lit(1.0), F.lit(16.0 * sample) / F.col("n"))
    below = F.col("rank.col1").cast("double") <= F.lit(-(2.0**63)) + share * F.lit(2.0**64)
    few = keys.join(F.broadcast(counts), "lang").where(below).select("lang", "rank").distinct()
    numbered = few.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("rank"))).where(F.col("n") <= sample)
    return numbered.groupBy("lang").agg(F.max("rank").alias("cut"))


def _spread(vectors: np.ndarray, k: int) -> np.ndarray:
    """k start centers: the first text, then each time the text least like those chosen."""
    centers = [vectors[0]]
    while len(centers) < k:
        centers.append(vectors[int(np.argmin((vectors @ np.array(centers).T).max(axis=1)))])
    return np.array(centers)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, rejected.

    The whole text counts. A null text, or one without a letter, is `und` with score 0
    and rejected; only the text is read for a prediction. An empty input gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def predict(batches):
        for batch in batches:
            found = [shared.value.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col(q(id_col)).alias("doc_id"), F.col(q(text_col)).alias("text"))
    return rows.mapInArrow(predict, f"doc_id {id_type}, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, in its own columns.

    Null texts and texts without a letter are rejected; repeated rows share their fate; an
    empty input gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def keep(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array([not shared.value.predict(t)[2] for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def held_out(id_col: str = "doc_id"):
    """Rows kept from learning: crc32 of the id as text leaves 2 when divided by 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(q(id_col)).cast("string"), F.lit("")).cast("binary")) % 4 == 2
