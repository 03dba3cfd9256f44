"""Fitted segment models that outlive the driver.

A bundle of a segment and run week holds the feature list, the fits of the
transform and the scaling, and the model. All of it is written to a folder of its
own; the manifest, written last, names that folder. So a reader finds the last whole
bundle whatever happens to a writer, and a repeated week replaces its bundle at once.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.plans.flagship import LinearModel, SegmentModel
from ebbtide.sources import sinks

MANIFEST = "segment string, run_week int, kind string, folder string, fits array<string>, weights array<double>"


def _manifest(path: str, segment: str, run_week: int | str) -> str:
    return f"{path}/{segment}/{run_week}/manifest"


def save_model(spark: SparkSession, fitted: SegmentModel, path: str, segment: str, run_week: int) -> None:
    """Write ``fitted`` as the bundle of (segment, run_week) below ``path``, a folder that all machines share."""
    folder = f"{path}/{segment}/{run_week}/data-{uuid.uuid4().hex}"
    names = spark.createDataFrame([(segment, list(fitted.columns))], "name string, features array<string>")
    sinks.write_feature_lists(names, f"{folder}/features")
    fits = {"lambdas": fitted.lambdas, "spread": fitted.spread}
    for name, frame in fits.items():
        if frame is not None:
            frame.write.parquet(f"{folder}/{name}")
    linear = isinstance(fitted, LinearModel)
    if not linear:
        fitted.model.write().overwrite().save(f"{folder}/model")
    weights = [float(fitted.weights[c]) for c in fitted.columns] if linear else None
    row = (segment, int(run_week), "linear" if linear else "pipeline", folder, [n for n, f in fits.items() if f is not None], weights)
    sinks.write_params(spark.createDataFrame([row], MANIFEST), _manifest(path, segment, run_week))


def saved_models(spark: SparkSession, path: str, segment: str) -> DataFrame:
    """The manifests of a segment, one row per run week."""
    return spark.read.schema(MANIFEST).json(_manifest(path, segment, "*"))


def load_model(spark: SparkSession, path: str, segment: str, run_week: int | None = None) -> SegmentModel:
    """The bundle of a run week, by default the latest of the segment."""
    found = saved_models(spark, path, segment)
    found = found if run_week is None else found.where(F.col("run_week") == run_week)
    entry = found.orderBy(F.desc("run_week")).first()
    if entry is None:
        raise FileNotFoundError(f"no model of {segment} for run week {run_week or 'any'} below {path}")
    columns = list(sinks.read_feature_lists(spark, f"{entry.folder}/features").first().features)
    lambdas, spread = (spark.read.parquet(f"{entry.folder}/{n}") if n in entry.fits else None for n in ("lambdas", "spread"))
    if entry.kind == "linear":
        return LinearModel(dict(zip(columns, entry.weights)), lambdas, spread)
    return SegmentModel(columns, lambdas, spread, PipelineModel.load(f"{entry.folder}/model"))
