"""Saved models: what is loaded scores as what was saved."""

import numpy as np
import pytest

from ebbtide.functions.staging import stage
from ebbtide.modelling import prepare, train
from ebbtide.plans import bundle, flagship


@pytest.fixture(scope="module")
def batch(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 5))
    y = (x[:, 0] - x[:, 2] > 0).astype(int)
    names = ["a.1", "b", "c", "d", "e"]
    rows = [(f"p{k}", int(y[k]), *map(float, x[k])) for k in range(200)]
    return spark.createDataFrame(rows, "parentname string, churn_flag int, " + ", ".join(f"`{c}` double" for c in names)).coalesce(2), names


def scores(model, rows):
    return {r.parentname: (r.churn_prob, r.churn_rank, r.churn_flag_predicted) for r in model.scores(rows).collect()}


@pytest.mark.parametrize("algorithm", ["LogisticRegression", "GBTClassifier"])
def test_a_loaded_model_scores_as_the_saved_one(spark, batch, tmp_path, algorithm):
    rows, names = batch
    lambdas = stage(prepare.power_fit(rows, names), "lambdas")
    spread = stage(prepare.scale_statistics(prepare.power_transform(rows, names, lambdas), names), "spread")
    scaled = prepare.standard_scale(prepare.power_transform(rows, names, lambdas), names, spread)
    chosen = ["c", "a.1", "e"]  # the order of the list is that of the model's vector
    saved = flagship.SegmentModel(chosen, lambdas, spread, train.train_segment(scaled, chosen, algorithm, max_iter=5, trees=3))
    want = scores(saved, saved.prepare(rows))
    bundle.save_model(spark, saved, str(tmp_path), "small", 202401)
    del saved
    loaded = bundle.load_model(spark, str(tmp_path), "small")
    assert loaded.columns == chosen and scores(loaded, loaded.prepare(rows)) == want


def test_the_latest_week_is_loaded_and_a_broken_write_is_not(spark, tmp_path, monkeypatch):
    path, model = str(tmp_path), lambda w: flagship.LinearModel({"b": w, "a.1": 0.5})
    bundle.save_model(spark, model(1.0), path, "large", 202352)
    bundle.save_model(spark, model(2.0), path, "large", 202401)
    assert bundle.load_model(spark, path, "large").weights == {"b": 2.0, "a.1": 0.5}
    assert bundle.load_model(spark, path, "large", 202352).weights["b"] == 1.0
    bundle.save_model(spark, model(3.0), path, "large", 202401)
    assert bundle.load_model(spark, path, "large").weights["b"] == 3.0

    def broken(*_):
        raise OSError("lost")

    monkeypatch.setattr(bundle.sinks, "write_params", broken)
    with pytest.raises(OSError):
        bundle.save_model(spark, model(4.0), path, "large", 202401)
    assert bundle.load_model(spark, path, "large").weights["b"] == 3.0
    with pytest.raises(FileNotFoundError):
        bundle.load_model(spark, path, "large", 202301)
