import datetime as dt

from pyspark.sql import functions as F

from canopycast.functions import names, scalars as sc


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_canonical_key(spark):
    keys = ["A-007", "A-7", "A-7 ", "A7", "A-x", "A-7-b", "A-7\n", None]
    assert column(spark, keys, sc.canonical_key) == ["A-7", "A-7", "A-7", None, None, "A-7", None, None]


def test_season_label(spark):
    labels = ["Zafra 2023-2024", "zafra  2023-2024", "2023-2024"]
    assert column(spark, labels, sc.season_label) == ["2023_2024"] * 3


def test_parse_date_multi(spark):
    texts = ["2024-02-29", "29/02/2024", "2024-02-30", "30/02/2024", "2024-2-1", "later", None]
    leap = dt.date(2024, 2, 29)
    assert column(spark, texts, sc.parse_date_multi) == [leap, leap, None, None, None, None, None]


def test_season_edge(spark):
    days = [dt.date(2024, 5, 31), dt.date(2024, 6, 1), dt.date(2024, 1, 1), None]
    assert column(spark, days, sc.season_of_date, "date") == ["2023_2024", "2024_2025", "2023_2024", None]


def test_baseline_start_rounds_half_to_even(spark):
    closing = F.lit("2024-01-31").cast("date")
    ages = [0.5, 1.5, 2.5, -1.0]
    starts = column(spark, ages, lambda v: sc.baseline_start(closing, v, 1.0), "double")
    assert [(dt.date(2024, 1, 31) - s).days for s in starts] == [0, 2, 2, 0]


def test_age_window_edges(spark):
    ages = [0.0, 90.0, 91.0, 180.0, 181.0, 301.0, None]
    found = column(spark, ages, lambda v: sc.age_window(v, F.lit(300.0)), "double")
    assert found == ["age_000_090", "age_000_090", "age_091_180", "age_091_180", "age_181_asof", "outside", "outside"]
    last = column(spark, ages, lambda v: sc.in_last_days(v, F.lit(300.0), 30), "double")
    assert last == [False] * 5 + [True, False]


def test_missing_numbers(spark):
    assert column(spark, ["1.5", "NaN", "x", None], sc.nan_to_null) == [1.5, None, None, None]
    values = [1.0, float("inf"), float("-inf"), float("nan"), None]
    assert column(spark, values, sc.scrub_inf, "double") == [1.0, None, None, None, None]


def test_degree_days_of_missing_temperature_is_zero(spark):
    assert column(spark, [None, 8.0, 12.0], sc.degree_days, "double") == [0.0, 0.0, 10.0]


def test_feature_names():
    assert names.feature_names(["a", " a!", "a_1", "9 (x)", "%", "b__c_"]) == ["a", "a_2", "a_1", "f_9_x", "feature", "b_c"]
    assert names.unique_names(["x", "x", "x"]) == ["x", "x_1", "x_2"]
