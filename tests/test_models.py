import numpy as np
import pytest
from pyspark.sql import functions as F

from canopycast.operators import models


@pytest.fixture(scope="module")
def rows(spark):
    source = np.random.default_rng(5)
    x = source.normal(0, 1, (400, 3))
    y = x @ [3.0, -2.0, 0.5] + source.normal(0, 0.1, 400) + 50
    data = [(f"k{i}", *[float(v) for v in r], float(t), "test" if i % 5 == 0 else "train") for i, (r, t) in enumerate(zip(x, y))]
    data[1] = ("k1", None, *data[1][2:])
    return spark.createDataFrame(data, "cod_cg_zafra string, u double, v double, w double, tch double, split string")


def test_ridge_has_the_closed_form(rows):
    fitted = models.fit_model(rows, ["v", "w"], "tch", "ridge", {"alpha": 25.0})
    pdf = rows.select("v", "w", "tch").toPandas().to_numpy()
    x, y = pdf[:, :2] - pdf[:, :2].mean(0), pdf[:, 2] - pdf[:, 2].mean()
    want = np.linalg.solve(x.T @ x + 25.0 * np.eye(2), x.T @ y)
    assert np.allclose(fitted.model.coefficients.toArray(), want, atol=1e-8)


def test_forest_quantiles_come_from_the_trees(rows):
    features = ["u", "v", "w"]
    fitted = models.fit_model(rows, features, "tch", "forest", {"n_estimators": 7, "max_depth": 4})
    got = models.forest_quantiles(fitted, rows).orderBy("cod_cg_zafra").toPandas()
    joined = models.forest_quantiles(fitted, rows, most_nodes=0).orderBy("cod_cg_zafra").toPandas()
    assert np.allclose(got[list(models.ALPHAS)], joined[list(models.ALPHAS)]) and (got.pred_tch_p10 <= got.pred_tch_p50).all()
    vectors = models.vectors(rows, features, fitted.medians).orderBy("cod_cg_zafra").collect()
    each = np.array([[tree.predict(r["_features"]) for tree in fitted.model.trees] for r in vectors])
    assert np.allclose(got[list(models.ALPHAS)], np.quantile(each, [0.1, 0.5, 0.9], axis=1).T)


def test_importance_finds_the_strong_feature(rows):
    fitted = models.fit_model(rows, ["u", "v", "w"], "tch", "ridge", {"alpha": 0.1})
    found = {r["feature"]: r["rmse_increase"] for r in models.permutation_importance(fitted, rows).collect()}
    assert found["u"] > found["v"] > found["w"] > 0


def test_rows_without_target_are_scored_and_models_reload(spark, rows, tmp_path):
    fitted = models.fit_model(rows, ["u", "v"], "tch", "boosted", {"n_estimators": 3})
    open_rows = rows.withColumn("tch", F.lit(None).cast("double"))
    first = models.score_rows(fitted, open_rows).agg(F.sum("pred_tch")).first()[0]
    models.save_model(fitted, str(tmp_path))
    again = models.load_model(spark, str(tmp_path))
    assert models.score_rows(again, open_rows).agg(F.sum("pred_tch")).first()[0] == pytest.approx(first)
    with pytest.raises(ValueError):
        models.build_model("other", {}, "tch")
    with pytest.raises(ValueError, match="max_depth"):
        models.build_model("forest", {"max_depth": 99}, "tch")


def test_interval_by_season(spark):
    data = [("validation", s, float(i), 0.0) for s in ("a", "b") for i in range(11 if s == "a" else 21)] + [("test", "a", 0.0, 100.0)]
    df = spark.createDataFrame(data, "split string, zafra_norm string, actual_tch double, pred_tch double")
    row = models.interval_forecast(df, by=["zafra_norm"]).where("split = 'test'").first()
    assert (row["pred_tch_p10"], row["pred_tch_p50"], row["pred_tch_p90"]) == (101.0, 105.0, 109.0)


def test_trees_take_categories(spark, tmp_path):
    effect = {"a": 10.0, "b": 50.0, "c": 30.0}
    data = [(f"k{i}", c, float(i % 7), effect[c] + i % 7) for i in range(300) for c in ["abc"[i % 3]]]
    rows = spark.createDataFrame(data, "cod_cg_zafra string, soil string, u double, tch double")
    fitted = models.fit_model(rows, ["soil", "u"], "tch", "forest", {"n_estimators": 5, "max_depth": 6})
    new = spark.createDataFrame([("x", "a", 1.0, None), ("y", "b", 1.0, None), ("z", "never seen", 1.0, None)], rows.schema)
    models.save_model(fitted, str(tmp_path))
    for own in (fitted, models.load_model(spark, str(tmp_path))):
        found = {r["cod_cg_zafra"]: r["pred_tch"] for r in models.score_rows(own, new).collect()}
        assert abs(found["x"] - 11) < 3 and abs(found["y"] - 51) < 3 and found["z"] is not None
    assert models.score_rows(fitted, new).columns == [*[c if c != "tch" else "actual_tch" for c in rows.columns], "pred_tch"]
    assert models.forest_quantiles(fitted, new).count() == 3
    with pytest.raises(ValueError, match="ridge"):
        models.fit_model(rows, ["soil", "u"], "tch", "ridge")


def test_feature_reports_before_encoding(spark):
    from canopycast.operators.features import Matrix
    from canopycast.plans import training

    data = [(f"k{i}", f"{2000 + i % 4}_{2001 + i % 4}", float(i % 11), float(i % 5), "ab"[i % 2], float(i % 11) + 50) for i in range(200)]
    df = spark.createDataFrame(data, "cod_cg_zafra string, zafra_norm string, u double, v double, soil string, tch double")
    seasons = [f"{y}_{y + 1}" for y in range(2000, 2004)]
    matrix = Matrix(df, ["u", "v"], ["soil"], ["cod_cg_zafra", "zafra_norm"])
    options = training.Options(train=seasons[:2], validation=seasons[2:3], test=seasons[3:])
    found = training.diagnose_features(matrix, options)
    rows = {r["feature"]: r["target_association_score"] for r in found["feature_univariate_target_association"].collect()}
    assert rows["u"] > 0.99 > rows["v"] and found["feature_missing_rate"].count() == 3
