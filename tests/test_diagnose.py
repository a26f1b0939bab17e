import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from canopycast.operators import diagnose as dg
from canopycast.plans import diagnostics as plan

NUMBERS = ["a", "b", "c", "d", "flat"]


@pytest.fixture(scope="module")
def data(spark):
    source = np.random.default_rng(3)
    n = 900
    a = source.integers(0, 50, n).astype(float)
    pdf = pd.DataFrame({"k": [f"k{i}" for i in range(n)], "a": a, "b": a * 2 + source.normal(0, 0.5, n), "c": source.normal(0, 1, n)})
    pdf["d"] = np.where(source.random(n) < 0.3, np.nan, a ** 3)
    pdf["flat"] = 1.0
    pdf["y"] = a + source.normal(0, 5, n)
    pdf["split"] = source.choice(["train", "validation", "test"], n)
    pdf.loc[0, "c"] = np.nan
    clean = pdf.astype(object).where(pdf.notna(), None)
    schema = "k string, a double, b double, c double, d double, flat double, y double, split string"
    return pdf, spark.createDataFrame([tuple(r) for r in clean.to_numpy()], schema)


def test_pairs_match_pairwise_complete_correlation(data):
    pdf, df = data
    train = pdf[pdf["split"] == "train"][["a", "b", "c", "d"]]
    for method, run in (("pearson", dg.correlation_pairs(df, NUMBERS, 0.0)), ("spearman", dg.spearman_pairs(df, "k", NUMBERS, 0.0))):
        want = train.corr(method=method).abs()
        rows = run.collect()
        assert len(rows) == 6
        for r in rows:
            assert r["abs_corr"] == pytest.approx(want.loc[r["feature_a"], r["feature_b"]], abs=1e-9)


def test_association(data):
    pdf, df = data
    rows = {r["feature"]: r for r in dg.target_association(df, NUMBERS, "y").collect()}
    train = pdf[pdf["split"] == "train"]
    for c in "abcd":
        assert rows[c]["pearson"] == pytest.approx(train[c].corr(train["y"]))
        assert rows[c]["spearman"] == pytest.approx(train[[c, "y"]].corr(method="spearman").iloc[0, 1])
    assert rows["flat"]["pearson"] is None and rows["flat"]["target_association_score"] == 0.0
    assert rows["a"]["mutual_info"] > rows["c"]["mutual_info"] > 0


def test_wide_stats_in_batches(data, monkeypatch):
    _, df = data
    whole = sorted(map(str, dg.missing_rate(df, NUMBERS).collect()))
    monkeypatch.setattr(dg, "COLUMNS_PER_AGG", 2)
    assert sorted(map(str, dg.missing_rate(df, NUMBERS).collect())) == whole


def test_components(spark):
    chain = [(f"n{i:02d}", f"n{i + 1:02d}") for i in range(20)]
    pairs = spark.createDataFrame(chain[::-1] + [("y", "x")], "feature_a string, feature_b string")
    found = {r["feature"]: r["root"] for r in dg.connected_components(pairs).collect()}
    assert {v for k, v in found.items() if k.startswith("n")} == {"n00"} and found["y"] == found["x"] == "x"


def test_cluster_ids_follow_the_smallest_member(spark):
    pairs = spark.createDataFrame([("x", "y", 0.99), ("b", "c", 0.98), ("a", "b", 0.99)], "feature_a string, feature_b string, abs_corr double")
    names = [(f, 0.1 * i, 0.1, 0.1) for i, f in enumerate("abcxy")]
    association = spark.createDataFrame(names, "feature string, target_association_score double, spearman_abs double, mutual_info double")
    missing = spark.createDataFrame([(f, 0.0, 10) for f in "abcxy"], "feature string, missing_rate double, non_null_count long")
    stability = spark.createDataFrame([(f, None) for f in "abcxy"], "feature string, max_abs_mean_shift_std double")
    rows = {r["feature"]: r for r in dg.correlation_clusters(pairs, missing, stability, association).collect()}
    assert {f: r["cluster_id"] for f, r in rows.items()} == {"a": 1, "b": 1, "c": 1, "x": 2, "y": 2}
    assert rows["a"]["recommended_keep_feature"] == "c" and rows["b"]["max_abs_corr_to_cluster"] == 0.99
    assert {f for f, r in rows.items() if r["is_recommended_keep"]} == {"c", "y"}


def test_stable_sample_ignores_partitioning(data):
    _, df = data
    first = {r["k"] for r in dg.stable_sample(df.repartition(7), "k", 50).collect()}
    assert first == {r["k"] for r in dg.stable_sample(df.coalesce(1), "k", 50).collect()} and len(first) == 50


def test_diagnostics_without_redundant_features(data):
    _, df = data
    found = plan.diagnose(df, "k", "y", ["a", "c"])
    assert found.reports["feature_correlation_clusters"].isEmpty()
    row = found.sets.where("feature = 'a'").first()
    assert row["correlated"] is False


def test_recommendations(data):
    _, df = data
    df = df.withColumn("gone", F.when(F.col("k") == "k1", 1.0))
    found = plan.diagnose(df, "k", "y", [*NUMBERS, "gone"], threshold=0.95)
    advice = {r["feature"]: r["recommendation"] for r in found.reports["feature_pruning_recommendations"].collect()}
    assert advice["gone"] == "drop_high_missing" and advice["flat"] == "drop_near_zero_variance"
    assert "drop_correlated_redundant" in advice.values()


def test_target_ranks_of_wide_rows_equal_those_of_tall_ones(spark):
    """Gaps in different rows, equal targets, missing and non-finite values: one shared order of the target gives the ranks of each feature."""
    y = [3.0, 1.0, 1.0, None, 2.0, float("nan"), 5.0, 1.0, -0.0, 0.0]
    a = [1.0, None, 2.0, 4.0, 2.0, 7.0, None, 2.0, float("nan"), 1.0]
    b = [None, 1.0, 1.0, 1.0, 3.0, 3.0, 2.0, None, 2.0, 2.0]
    df = spark.createDataFrame(list(zip(y, a, b, [None] * 10)), "y double, a double, b double, empty double")
    numeric = ["a", "b", "empty"]
    tall = dg.rank_target(dg.value_pairs(df, numeric, "y"), ["feature"], "y")
    want = sorted((r["feature"], str(r["x"]), r["ry"], r["rows_y"]) for r in tall.collect() for _ in range(r["n"]))
    assert sorted((r["feature"], str(r["x"]), r["ry"], r["rows_y"]) for r in dg.target_ranks(df, numeric, "y").collect()) == want


def test_rows_stay_wide_until_they_are_ranked(spark):
    """The shuffles of the target's ranks have a row per row, not one per feature."""
    df = spark.range(100).selectExpr("id % 10D AS y", *[f"cast(id % {i + 2} AS double) AS f{i}" for i in range(9)])
    ranked = dg.target_ranks(df, [f"f{i}" for i in range(9)], "y")
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Join ")
    assert ranked.count() == 900
