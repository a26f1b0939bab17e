import datetime as dt

from pyspark.sql import functions as F

from canopycast.config import Settings
from canopycast.operators import cycles, keys
from canopycast.plans.dataset import DATED, Tables, build_spine, eligible_spine

COLUMNS = (
    "lote string, cod_cg_zafra string, zafra string, tch double, tc double, area double, edad double, cierre string, "
    "ingenio string, grupo_de_suelo string, grupo_de_humedad string, codigo_zae string, familia_de_suelo string, "
    "variedad string, no_corte string"
)


def production(spark, rows):
    full = [(lot, key, "Zafra 2022-2023", tch, 1.0, 2.0, age, day, *"abcdefg") for lot, key, day, age, tch in rows]
    return spark.createDataFrame(full, COLUMNS)


def test_ambiguous_key_is_not_matched(spark):
    source = keys.with_canonical(spark.createDataFrame([("A-07",), ("A-7",), ("B-01",)], "source_lote string"))
    target = keys.with_canonical(spark.createDataFrame([("A-007",), ("A-7",), ("B-1",), ("C",)], "source_lote string"))
    found = {r["cod_cg"]: r[1:] for r in keys.key_match(target, source, "stac").collect()}
    assert found == {
        "A-007": (None, "no_match"), "A-7": ("A-7", "exact"), "B-1": ("B-01", "canonical"), "C": (None, "no_match"),
    }


def test_previous_closing_with_ties_and_copies(spark):
    raw = production(
        spark,
        [
            ("L-1", "k1", "2022-01-10", 12.0, 80.0),
            ("L-1", "k3", "2023-02-01", 12.0, 80.0),
            ("L-1", "k2", "01/02/2023", 12.0, 90.0),
            ("L-1", "k2", "01/02/2023", 12.0, 90.0),
            ("L-1", "k4", "2024-01-01", 12.0, 80.0),
            ("L-1", "bad", "soon", 12.0, 80.0),
            ("L-1", "low", "2024-03-01", 12.0, 19.9),
        ],
    )
    every = sorted((r["cod_cg_zafra_original"], r["previous_fecha_cierre"]) for r in cycles.closed_cycles(cycles.production_rows(raw)).where("cod_cg_zafra_original <> 'k1'").collect())
    assert every == [("k2", dt.date(2022, 1, 10)), ("k2", dt.date(2023, 2, 1)), ("k3", dt.date(2023, 2, 1)), ("k4", dt.date(2023, 2, 1))]
    rows = cycles.closed_cycles(cycles.production_rows(raw), drop_copies=True).collect()
    found = {r["cod_cg_zafra_original"]: r["previous_fecha_cierre"] for r in rows}
    assert len(rows) == 4
    assert found == {
        "k1": None, "k2": dt.date(2022, 1, 10), "k3": dt.date(2023, 2, 1), "k4": dt.date(2023, 2, 1),
    }


def test_previous_closing_reads_the_rows_once(spark):
    """One scan of the rows, and no date is parsed once more to filter them."""
    raw = production(spark, [("L-1", "k1", "2022-01-10", 12.0, 80.0), ("L-1", "k2", "soon", 12.0, 80.0), ("L-1", "k3", "2023-01-10", 12.0, 80.0)])
    closed = cycles.closed_cycles(cycles.production_rows(raw))
    found = {r["cod_cg_zafra_original"]: r["previous_fecha_cierre"] for r in closed.collect()}
    assert found == {"k1": None, "k3": dt.date(2022, 1, 10)}
    text = closed._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text and text.count("LogicalRDD") == 1, text
    assert all("yyyy-MM-dd" not in line for line in text.splitlines() if "Filter" in line), text


def test_start_is_moved_behind_the_previous_closing(spark):
    raw = production(spark, [("L-1", "k1", "2022-01-10", 12.0, 80.0), ("L-1", "k2", "2022-12-01", 12.0, 80.0)])
    row = cycles.closed_cycles(cycles.production_rows(raw)).where("cod_cg_zafra_original = 'k2'").first()
    assert row["fecha_inicio_ciclo"] == dt.date(2022, 1, 31)
    assert row["start_correction_days"] == (dt.date(2022, 1, 31) - row["fecha_inicio_baseline"]).days > 0


def tables(spark, raw, optical_days=("2024-08-01",)):
    optical = spark.createDataFrame([("L-1", d) for d in optical_days], "lote string, fecha string")
    optical = optical.withColumn("fecha", F.to_date("fecha"))
    for i in ("ndvi", "evi2", "gndvi", "ndre", "lswi", "ndvire", "cire", "ndwi11", "msi11"):
        optical = optical.withColumn(f"{i}_promedio", F.lit(0.5))
    climate = spark.createDataFrame([], "cod_cg string, fecha_inicio date, precipitacion_sum double, eto_sum double, radiacion_sum double, temperatura_mean double, temperatura_max double, temperatura_min double, humedad_relativa double")
    ocean = spark.createDataFrame([(dt.date(2022, 1, 1), 0.1, 0.2, 0.3)], "date date, oni double, nino34 double, soi double")
    return Tables(raw, optical, climate, ocean)


def test_open_cycle_follows_the_last_closing(spark):
    raw = production(spark, [("L-1", "k1", "2024-01-10", 12.0, 80.0), ("L-2", "k2", "2024-01-12", 12.0, 80.0)])
    spine = build_spine(tables(spark, raw))
    row = spine.where("cycle_status = 'open'").collect()
    assert [r["cod_cg_zafra"] for r in row] == ["L-1_2024-2025_open"]
    assert row[0]["fecha_inicio_ciclo"] == dt.date(2024, 1, 11)
    assert row[0]["natural_asof_limit_date"] == dt.date(2024, 8, 1)
    assert row[0]["previous_tch"] == 80.0 and row[0]["tch"] is None


def test_cycles_without_what_describes_them(spark):
    """The columns that features depend on come out the same, and no others are staged."""
    raw = production(
        spark,
        [
            ("L-1", "k1", "2022-01-10", 12.0, 80.0), ("L-1", "k2", "2024-01-10", 12.0, 80.0), ("L-1", "k2", "2024-01-10", 13.0, 70.0),
            ("L-2", "k3", "2024-01-12", 12.0, 80.0),
        ],
    )
    t = tables(spark, raw)
    whole, dated = eligible_spine(t), eligible_spine(t, described=False)
    assert set(dated.columns) == set(DATED) < set(whole.columns)
    assert sorted(map(str, dated.collect())) == sorted(map(str, whole.select(*DATED).collect()))
    whole, dated = build_spine(t), build_spine(t, described=False)
    assert sorted(map(str, dated.collect())) == sorted(map(str, whole.select(*dated.columns).collect()))
    assert not {"tch", "area", "previous_tch", "prod_variedad"} & set(dated.columns)


def test_open_cycle_needs_an_observation_after_its_start(spark):
    raw = production(spark, [("L-1", "k1", "2024-01-10", 12.0, 80.0)])
    assert build_spine(tables(spark, raw, ["2023-08-01"])).where("cycle_status = 'open'").isEmpty()


def test_eligible_cycles_age_limits(spark):
    raw = production(spark, [("L-1", "k1", "2022-01-10", 5.8, 80.0), ("L-2", "k2", "2022-01-10", 6.0, 80.0), ("L-3", "k3", "2022-01-10", 14.0, 80.0)])
    closed = F.col("cycle_status") == "closed"
    rows = {r["cod_cg"]: r for r in eligible_spine(tables(spark, raw)).where(closed).collect()}
    assert set(rows) == {"L-2", "L-3"}
    assert rows["L-2"]["as_of_age_days"] == 183.0
    assert rows["L-3"]["as_of_age_days"] == 340.0 and rows["L-3"]["cycle_duration_days"] == 426.0
    young = eligible_spine(tables(spark, raw), Settings(min_age_days=100))
    assert young.where(closed).count() == 3
