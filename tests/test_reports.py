import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from canopycast.operators import ranks, reports, splits


def predictions(spark, rows):
    df = spark.createDataFrame(rows, "split string, zafra_norm string, area double, actual_tch double, pred_tch double")
    return reports.prediction_error(df)


def test_bins(spark):
    df = spark.createDataFrame([(v,) for v in (70.0, 70.01, 130.0, 130.01)] + [(None,)], "v double")
    found = [r[0] for r in df.select(reports.bins(F.col("v"), reports.RANGE_LIMITS, reports.RANGE_LABELS)).collect()]
    assert found == ["<=70", "70-85", "115-130", ">130", None]


def test_zero_actual_total(spark):
    rows = predictions(spark, [("test", "s", 1.0, 0.0, 5.0), ("test", "s", 1.0, 0.0, 1.0)])
    assert rows.agg(reports.pct_difference(F.col("actual_tch"), F.col("pred_tch"))).first()[0] == 0.0
    row = reports.season_metrics(rows).first()
    assert row["tch_sum_pct_diff"] is None and row["actual_tch_sum"] == 0.0
    assert reports.aggregate_season_metrics(reports.season_metrics(rows)).first()["tch_sum_pct_diff"] is None
    assert rows.first()["tch_pct_error"] is None


def test_r2_of_constant_target(spark):
    exact = predictions(spark, [("a", "s", 1.0, 5.0, 5.0)] * 2)
    wrong = predictions(spark, [("a", "s", 1.0, 5.0, 6.0)] * 2)
    assert reports.regression_metrics(exact).first()["r2"] == 1.0
    assert reports.regression_metrics(wrong).first()["r2"] == 0.0


def test_empty_ranges_are_kept(spark):
    rows = reports.range_metrics(predictions(spark, [("a", "s", 1.0, 60.0, 61.0), (None, "s", 1.0, 90.0, 61.0)])).collect()
    assert len(rows) == 12
    counts = {(r["split"], r["actual_tch_range"]): r["rows"] for r in rows}
    assert counts[("a", "<=70")] == 1 and counts[(None, "85-100")] == 1 and sum(counts.values()) == 2


def test_null_group_is_not_a_rolled_up_one(spark):
    rows = predictions(spark, [("a", None, 1.0, 60.0, 61.0), ("a", "s", 1.0, 90.0, 61.0), ("a", "s", 1.0, 80.0, 61.0)])
    found = reports.error_summary(rows, [("one", ["split"]), ("two", ["split", "zafra_norm"])]).collect()
    seen = {(r["grouping"], r["zafra_norm"]): (r["rows"], r["actual_tch_median"]) for r in found}
    assert seen == {("one", None): (3, 80.0), ("two", None): (1, 60.0), ("two", "s"): (2, 85.0)}


def test_missing_error_is_not_within(spark):
    row = reports.lot_error_metrics(predictions(spark, [("a", "s", 1.0, 60.0, 61.0), ("a", "s", 1.0, 60.0, None)])).first()
    assert row["pct_within_5_tch"] == 50.0 and row["rows"] == 2


def test_folds_never_look_ahead():
    for fold, season, role in splits.fold_table(["a", "b", "c"]):
        assert (season < fold) if role == "train" else season == fold
    assert len(splits.fold_table(["a", "b", "c"])) == 5


def test_splits(spark):
    df = spark.createDataFrame([(s,) for s in "abcde"], "zafra_norm string")
    rows = splits.temporal_split(df, ["a", "b"], ["c"], ["d"], ["b"])
    assert {r[0]: r[1] for r in rows.collect()} == {"a": "train", "b": "external", "c": "validation", "d": "test", "e": None}
    with pytest.raises(ValueError, match="validation"):
        splits.require_splits(splits.temporal_split(df, ["a"], ["x"], ["d"]))


def test_objective_modes():
    assert reports.resolve_objective("auto", True) == "walk_forward_r2"
    for mode, walk in (("walk_forward_r2", False), ("lot_rmse", True), ("best", True)):
        with pytest.raises(ValueError):
            reports.resolve_objective(mode, walk)


@pytest.fixture(scope="module")
def values(spark):
    source = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": source.choice(["a", "b", None], 4000, p=[0.7, 0.2, 0.1]), "v": source.integers(0, 300, 4000).astype(float)})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("pieces", [2, 64])
def test_average_ranks(values, pieces, monkeypatch):
    monkeypatch.setattr(ranks, "RANGES", pieces)
    pdf, df = values
    found = ranks.average_ranks(df, ["g"], "v").toPandas()
    pdf = pdf.assign(g=pdf["g"].fillna("-"))
    pdf["r"] = pdf.groupby("g")["v"].rank()
    want = pdf.groupby(["g", "v"])["r"].agg(["first", "size"])
    found = found.assign(g=found["g"].fillna("-")).set_index(["g", "v"]).sort_index()
    assert np.allclose(found["avg_rank"], want["first"]) and (found["n"] == want["size"]).all()


@pytest.mark.parametrize("pieces", [2, 64])
def test_exact_quantiles(values, pieces, monkeypatch):
    monkeypatch.setattr(ranks, "RANGES", pieces)
    pdf, df = values
    counts = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    found = ranks.exact_quantiles(counts, ["g"], "v", {"low": 0.1, "mid": 0.5, "high": 0.9}).collect()
    for r in found:
        mine = pdf["v"][pdf["g"].isna() if r["g"] is None else pdf["g"] == r["g"]]
        assert (r["low"], r["mid"], r["high"]) == pytest.approx(tuple(np.quantile(mine, [0.1, 0.5, 0.9])))
    total = ranks.exact_quantiles(df.groupBy("v").agg(F.count("*").alias("n")), [], "v", {"mid": 0.5}).first()
    assert total["mid"] == pdf["v"].median()


@pytest.mark.parametrize("parts, most", [(1, 10), (7, 10), (4096, 10), (4096, 200_000)])
def test_quantiles_of_rows_by_parts(spark, values, parts, most, monkeypatch):
    """Few and many parts, sorted whole or ranked by ranges; outliers, one value, and scales of their own."""
    monkeypatch.setattr(ranks, "PARTS", parts)
    monkeypatch.setattr(ranks, "SORTED", most)
    rng = np.random.default_rng(3)
    own = {"skew": np.concatenate([rng.exponential(1, 3000), [1e300, -1e300]]), "one": np.full(700, 4.5), "two": np.array([1.0, 2.0]), "tiny": rng.normal(0, 1e-9, 501)}
    df = spark.createDataFrame([(g, float(x)) for g, v in own.items() for x in v] + [("none", None)], "g string, v double")
    for scale in ([], ["g"]):
        found = ranks.exact_quantiles(df, ["g"], "v", {"low": 0.1, "mid": 0.5, "top": 1.0}, scale).collect()
        assert {r["g"] for r in found} == set(own)
        for r in found:
            assert (r["low"], r["mid"], r["top"]) == pytest.approx(tuple(np.quantile(own[r["g"]], [0.1, 0.5, 1.0])), rel=1e-12)
    assert ranks.exact_quantiles(df.limit(0), ["g"], "v", {"mid": 0.5}).collect() == []


def test_ranks_of_skewed_and_constant_groups(spark):
    rng = np.random.default_rng(3)
    skewed = np.concatenate([rng.exponential(1, 3000), [1e9] * 5, rng.normal(1e-9, 1e-12, 500)])
    pdf = pd.concat([pd.DataFrame({"g": "skew", "v": skewed}), pd.DataFrame({"g": "one", "v": [4.5] * 700}), pd.DataFrame({"g": "few", "v": [1.0, 2.0]})])
    found = ranks.average_ranks(spark.createDataFrame(pdf), ["g"], "v").toPandas().set_index(["g", "v"]).sort_index()
    pdf["r"] = pdf.groupby("g")["v"].rank()
    assert np.allclose(found["avg_rank"], pdf.groupby(["g", "v"])["r"].first())
