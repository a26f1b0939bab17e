import datetime as dt

import pytest
from pyspark.sql import functions as F

from canopycast.operators import encode as enc, features as ft

RULES = {"c": {"strategy": "min_count", "min_count": 2}}


@pytest.fixture(scope="module")
def rows(spark):
    data = [("train", "a"), ("train", "a"), ("train", "b"), ("validation", "c"), ("validation", "c"), ("validation", None)]
    return spark.createDataFrame(data, "split string, c string")


def test_vocabulary_sees_training_rows_only(rows, monkeypatch):
    vocab = enc.fit_vocab(rows.where("split = 'train'"), ["c"], RULES)
    assert [tuple(r) for r in vocab.collect()] == [("c", "a", 2)]
    want = ["__MISSING__", "__OTHER__", "__OTHER__", "__OTHER__", "a", "a"]
    assert sorted(r["c"] for r in enc.apply_vocab(rows, vocab, ["c"]).collect()) == want
    monkeypatch.setattr(enc, "HOT_SHARE", 2.0)
    assert sorted(r["c"] for r in enc.apply_vocab(rows, vocab, ["c"]).collect()) == want


def test_one_hot_always_has_the_markers(rows):
    lists = enc.vocab_lists(enc.fit_vocab(rows.where("split = 'train'"), ["c"], RULES))
    df = enc.one_hot(rows, lists, ["c"])
    assert df.columns == ["split", "c_a", "c_OTHER", "c_MISSING"]
    assert sorted(tuple(r)[1:] for r in df.collect()) == [(0, 0, 1)] + [(0, 1, 0)] * 3 + [(1, 0, 0)] * 2


def test_one_hot_query_with_hundreds_of_columns(spark, monkeypatch):
    """Four columns of 150 values each: 0/1 columns by the hundred, of which four are 1 in each row."""
    from canopycast.catalog import feature_queries as q
    from canopycast.catalog.registry import QUERIES, Views

    text = [F.concat(F.lit("v"), (F.col("id") % 150).cast("string")).alias(c) for c in q.ENCODED]
    rows = spark.range(4500).select(F.col("id").cast("string").alias("cod_cg_zafra"), F.lit("train").alias("split"), *text)
    monkeypatch.setattr(Views, "feature_matrix", rows, raising=False)
    counts = QUERIES["one_hot"](spark, "").groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    found = {r["name"]: (r["n"], r["low"], r["high"]) for r in counts.collect()}
    # prod_variedad and prod_codigo_zae keep values of at least 30 rows, and so do all here
    width = 4 * (150 + 2)
    assert found.pop("zeros") == (4500, width - 4, width - 4)
    assert len(found) == 600 and set(found.values()) == {(30, 1, 1)}


def test_top_n_or_min_count(spark):
    values = ["a"] * 5 + ["b"] * 4 + ["d"] * 4 + ["e"]
    df = spark.createDataFrame([(v,) for v in values], "c string")

    def words(**rule):
        return sorted(r["category"] for r in enc.fit_vocab(df, ["c"], {"c": rule}).collect())

    assert words(strategy="top_n", top_n=2) == ["a", "b"]
    assert words(strategy="top_n_or_min_count", top_n=1, min_count=4) == ["a", "b", "d"]
    assert words(strategy="all") == ["a", "b", "d", "e"] and words(strategy="drop") == []
    with pytest.raises(ValueError):
        words(strategy="some")


def test_modes(rows):
    with pytest.raises(ValueError):
        enc.resolve_mode("other")
    with pytest.raises(ValueError):
        enc.check_mode("native", "ridge")
    assert enc.resolve_mode("Native") == "native" and enc.resolve_mode(None) == "controlled"
    df = rows.withColumns({"flag": F.col("c") == "a", "prod_finca": F.lit("x")})
    spec = enc.encoder_spec(["c", "flag", "prod_finca"], "native")
    out = enc.encode(df, spec, keep=["split"])
    assert out.columns == ["split", "c", "flag"]
    assert {r["flag"] for r in out.collect()} == {"True", "False", "__MISSING__"}


def test_state_round_trip(spark, rows, tmp_path):
    vocab, spec = enc.fit_vocab(rows, ["c"], {}), enc.encoder_spec(["c"], "controlled")
    enc.save_state(spec, vocab, str(tmp_path))
    loaded, table = enc.load_state(spark, str(tmp_path))
    assert loaded == spec and sorted(table.collect()) == sorted(vocab.collect())


def longitudinal(spark, rows):
    schema = "cod_cg_zafra string, cod_cg string, zafra_norm string, fecha_stac date, edad_de_cultivo double, tch double, tc double, area double, stac_ndvi_promedio double, prod_variedad string"
    return spark.createDataFrame([("k", "L", "s", d, a, 80.0, 1.0, 2.0, v, t) for d, a, v, t in rows], schema)


def test_undated_row_is_last(spark):
    day = dt.date(2022, 1, 1)
    df = longitudinal(spark, [(None, 50.0, 9.0, "late"), (day, 10.0, 1.0, None), (day + dt.timedelta(9), 19.0, None, "first")])
    row = ft.aggregated_dataset(df).df.first()
    assert row["stac_ndvi_promedio_last"] == 9.0 and row["prod_variedad"] == "first"
    assert row["stac_ndvi_promedio_count"] == 2 and row["stac_ndvi_promedio_slope"] == pytest.approx(0.2)
    assert row["stac_ndvi_promedio_late_mean"] is None and row["stac_ndvi_promedio_early_max"] == 9.0


def test_feature_table_guards(spark):
    with pytest.raises(ValueError, match="area"):
        ft.feature_table(spark.createDataFrame([("k", "s", 1.0)], "cod_cg_zafra string, zafra string, tch double"))
    df = spark.createDataFrame(
        [("k", "s", 1.0, 2.0, 3.0, 5.0, "x"), ("k", "s", 1.0, 2.0, 2.0, 6.0, "x"), ("m", "s", None, 2.0, 1.0, float("inf"), "x")],
        "cod_cg_zafra string, zafra string, tch double, area double, w_min double, w_max double, cod_cg_zafra_original string",
    )
    matrix = ft.feature_table(df, order_by=["w_min"])
    rows = matrix.df.collect()
    assert [(r["w_min"], r["w_range"]) for r in rows] == [(2.0, 4.0)]
    assert matrix.numeric == ["w_min", "w_max", "w_range"] and matrix.categorical == []
    assert ft.feature_table(df, roles="reference").categorical == ["cod_cg_zafra_original"]
    assert ft.feature_table(df, keep_unlabelled=True).df.count() == 2


def test_a_column_of_many_values_is_refused_by_name(spark):
    vocab = spark.createDataFrame([("note", f"v{i}", 1) for i in range(30)] + [("kind", "a", 30)], "feature string, category string, n long")
    assert enc.vocab_lists(vocab)["kind"] == ["a"]
    with pytest.raises(ValueError, match="'note' has 30 values"):
        enc.vocab_lists(vocab, 20)
