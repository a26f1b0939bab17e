import datetime as dt

import pytest
from pyspark.sql import functions as F

from canopycast.config import FLAG_OUTPUT, OPTICAL_INDEXES, Settings, dataset_output
from canopycast.operators import asof, cycles
from canopycast.plans import dataset as plan
from test_cycles import production, tables

START = dt.date(2022, 1, 1)


def cycle(spark, days=340):
    rows = [("c", "L", START, START + dt.timedelta(days), float(days))]
    return spark.createDataFrame(rows, "cycle_uid string, stac_lote_matched string, fecha_inicio_ciclo date, as_of_date date, as_of_age_days double")


def optical(spark, points, lot="L"):
    df = spark.createDataFrame([(lot, START + dt.timedelta(a), v) for a, v in points], "lote string, fecha date, v double")
    return df.select("lote", "fecha", *[F.col("v").alias(f"{i}_promedio") for i in OPTICAL_INDEXES])


def features(spark, points, days=340):
    spine = cycle(spark, days)
    daily = asof.optical_daily(optical(spark, points))
    rows = asof.series_features(asof.join_daily(spine, daily, "stac_lote_matched")).where("index_name = 'ndvi'").collect()
    return rows[0].asDict() if rows else None


def test_no_slope_with_one_age(spark):
    assert features(spark, [(10, 1.0)])["slope_0_asof"] is None
    assert features(spark, [(10, 1.0), (10, 2.0)])["slope_0_asof"] is None
    assert features(spark, [(10, 1.0), (20, 2.0)])["slope_0_asof"] == pytest.approx(0.1)


def test_several_values_on_one_day(spark):
    found = features(spark, [(10, 1.0), (10, 3.0), (40, 5.0), (200, 7.0), (200, 6.0), (200, None)])
    assert found["obs_count_0_asof"] == 3.0 and found["obs_count_0_180"] == 2.0
    assert found["obs_count_181_asof"] == 2.0
    assert found["mean_0_asof"] == pytest.approx(22 / 5)
    assert found["max_gap_days_0_180"] == 30.0 and found["max_gap_days_0_asof"] == 160.0
    assert found["last_value_before_asof"] == 7.0
    assert features(spark, [(10, 1.0), (10, 3.0)])["max_gap_days_0_asof"] == 0.0
    assert features(spark, [(10, 1.0)])["max_gap_days_0_asof"] is None


def test_slope_matches_least_squares(spark):
    import numpy as np

    points = [(1, 0.3), (1, 0.4), (50, 0.9), (120, 0.2), (300, 0.7)]
    x, y = np.array(points).T
    assert features(spark, points)["slope_0_asof"] == pytest.approx(np.polyfit(x, y, 1)[0])


def test_nan_and_rows_outside_the_cycle_are_ignored(spark):
    assert features(spark, [(-1, 1.0), (341, 1.0), (5, float("nan"))]) is None


def test_long_and_wide_optical_features_agree(spark):
    points = [(3, 0.3), (60, 0.8), (170, 0.5), (230, None), (300, 0.6)]
    joined = asof.join_daily(cycle(spark), asof.optical_daily(optical(spark, points)), "stac_lote_matched")
    wide, long = asof.optical_core(joined).collect(), asof.pivot_core(asof.series_features(joined)).collect()
    assert [r.asDict() for r in wide] == [r.asDict() for r in long]


def test_daily_rows_are_shuffled_once_before_they_meet_cycles(spark):
    """One shuffle of the raw rows serves the fold and the join; days before the cycle are no previous days."""
    rows = optical(spark, [(-5, 1.0), (10, 1.0), (90, 2.0), (90, 3.0), (300, 1.0)])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = asof.join_daily(cycle(spark), asof.optical_daily(rows), "stac_lote_matched")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 2, plan  # raw rows and cycles
    days = {str(r["day"]): r["ndvi_previous"] for r in asof.with_previous(joined, ["ndvi"]).collect()}
    assert list(days) == sorted(days) and len(days) == 3
    first, second, third = sorted(days)
    assert (days[first], str(days[second]), str(days[third])) == (None, first, second)
    assert "evi2_previous" not in asof.with_previous(joined, ["ndvi"]).columns


def test_lineitem_is_shuffled_by_its_order_only(spark, tmp_path):
    """Orders meet their customers before the larger lineitem meets either."""
    from canopycast.catalog import bridge

    spark.sql("SELECT 1L AS l_orderkey, 1 AS l_linenumber, timestamp '2020-01-01' AS l_shipdate, 1D AS l_quantity, 1D AS l_discount, 1D AS l_tax, 1D AS l_extendedprice").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT 1L AS o_orderkey, 3L AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT 3L AS c_custkey, 'A' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    for name in ("stac_indices", "clima_lots"):
        df = bridge.view(spark, str(tmp_path), name)
        assert [r[0] for r in df.collect()] == ["A-000003"]
        last = df._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")
        assert len(last) == 3 and "l_orderkey" in last[1].splitlines()[0] and "o_custkey" in last[2].splitlines()[0]


@pytest.mark.parametrize("how, rows", [("inner", 2), ("left", 3)])
def test_interval_join(spark, how, rows):
    spine = cycle(spark).unionByName(cycle(spark).withColumns({"cycle_uid": F.lit("d"), "stac_lote_matched": F.lit("M")}))
    joined = asof.interval_join(spine, optical(spark, [(-1, 1.0), (0, 1.0), (340, 1.0), (341, 1.0)]), "stac_lote_matched", "lote", "fecha", how)
    assert joined.count() == rows
    assert "lote" not in joined.columns and "fecha_inicio_ciclo" in joined.columns


def build(spark, days=(), partitions=None, extra=None):
    raw = production(spark, [("L-1", "k1", "2022-01-10", 12.0, 80.0), ("L-2", "k2", "2022-12-12", 11.0, 90.0)])
    t = tables(spark, raw, [str(START - dt.timedelta(d)) for d in days])
    if extra is not None:
        t = extra(t)
    if partitions:
        t = plan.Tables(*[x.repartition(partitions) if x is not None else None for x in (t.production, t.optical, t.climate, t.ocean)])
    return plan.dataset(t)


def values(df):
    return sorted((str(r.asDict()) for r in df.collect()))


def test_chosen_columns_are_those_of_the_whole_build(spark):
    raw = production(spark, [("L-1", "k1", "2022-01-10", 12.0, 80.0), ("L-2", "k2", "2022-12-12", 11.0, 90.0)])
    t = tables(spark, raw, [str(START - dt.timedelta(d)) for d in (50, 90, 200)])
    whole = plan.dataset(t)
    for columns in (["cycle_uid", *FLAG_OUTPUT], ["cycle_uid", "duplicate_key", "optical_ndvi_peak_0_180"], ["cycle_uid", "prod_variedad", "asof_valid"]):
        chosen = plan.dataset(t, columns=columns)
        assert chosen.columns == columns
        assert values(chosen) == values(whole.select(*columns))


def test_climate_rows_are_shuffled_once_before_they_meet_cycles(spark):
    day = START + dt.timedelta(31)
    names = "precipitacion_sum", "eto_sum", "radiacion_sum", "temperatura_mean", "temperatura_max", "temperatura_min", "humedad_relativa"
    measures = ", ".join(f"{name} double" for name in names)
    raw = spark.createDataFrame([("L", day, 1.5, 0.5, 2.0, 20.0, 25.0, 15.0, 60.0)] * 3, f"cod_cg string, fecha_inicio date, {measures}")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = asof.join_daily(cycle(spark), asof.climate_daily(raw), "stac_lote_matched")
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("Exchange hashpartitioning") == 2, text  # raw rows and cycles
    row = asof.climate_core(joined).first()
    assert row["climate_pentad_count_0_asof"] == 3.0 and row["climate_precip_acc_0_180"] == 4.5


def test_cycle_without_series(spark):
    row = build(spark, [50]).where("cod_cg = 'L-2'").first()
    assert row["climate_pentad_count_0_asof"] == 0.0 and row["climate_precip_acc_0_asof"] is None
    assert row["climate_gdd_10c_acc_0_asof"] == 0.0 and row["climate_gdd_10c_acc_0_180"] is None
    assert row["optical_obs_count_0_180"] is None and row["asof_ndvi_shape_ok"] is None
    assert row["asof_optical_obs_ok"] is False and row["asof_valid"] is False


def test_output_contract(spark):
    df = build(spark, [50])
    assert df.columns == [*dataset_output(), "cycle_uid", "duplicate_key"]
    assert len(dataset_output()) == 131


def test_nothing_after_the_as_of_date_counts(spark):
    def later(t):
        row = t.optical.withColumn("fecha", F.to_date(F.lit("2022-01-11")))
        return plan.Tables(t.production, t.optical.unionByName(row), t.climate, t.ocean.withColumn("oni", F.col("oni")))

    only = "cod_cg = 'L-1' AND cycle_status = 'closed'"
    assert values(build(spark, [50, 90, 200]).where(only)) == values(build(spark, [50, 90, 200], extra=later).where(only))


def test_partitioning_does_not_matter(spark):
    days = [5, 20, 20, 60, 150, 300]
    first = values(build(spark, days, 1))
    assert first == values(build(spark, days, 4)) == values(build(spark, days, 16))


def test_ocean_range_has_both_ends(spark):
    windows = spark.createDataFrame([(START, START + dt.timedelta(200))], "fecha_inicio_ciclo date, as_of_date date")
    days = [-181, -180, -1, 0, 200, 201]
    ocean = spark.createDataFrame([(START + dt.timedelta(d), float(d), 0.0, 0.0) for d in days], "date date, oni double, nino34 double, soi double")
    row = asof.ocean_core(windows, ocean).first()
    assert row["enso_month_count_asof"] == 4.0
    assert row["enso_oni_precycle_mean"] == -90.5 and row["enso_oni_asof_mean"] == 100.0
    assert row["enso_oni_abs_max_asof"] == 200.0


def test_one_station_for_most_cycles(spark):
    """Windows that many cycles share are worked out once; results are those of the plain join."""
    days = "sequence(date '2020-01-01', date '2021-12-31', interval 5 days)"
    raw = spark.sql(
        f"SELECT s AS cod_cg, explode({days}) AS fecha_inicio, 1.5D AS precipitacion_sum, 0.5D AS eto_sum, 2D AS radiacion_sum,"
        " 20D AS temperatura_mean, 25D AS temperatura_max, 15D AS temperatura_min, 60D AS humedad_relativa FROM values ('hot'), ('cold') AS t(s)"
    )
    cycles = spark.range(900).selectExpr(
        "concat('c', id) AS cycle_uid", "CASE WHEN id % 30 = 0 THEN 'cold' WHEN id % 31 = 0 THEN NULL ELSE 'hot' END AS climate_lote_matched",
        "date_add(date '2020-02-01', cast(id % 7 AS int)) AS fecha_inicio_ciclo", "date_add(date '2020-12-01', cast(id % 5 AS int)) AS as_of_date",
    ).withColumn("as_of_age_days", F.datediff("as_of_date", "fecha_inicio_ciclo").cast("double"))
    daily = asof.climate_daily(raw)
    got = asof.climate_features(cycles, daily).toPandas().set_index("cycle_uid").sort_index()
    want = asof.climate_core(asof.join_daily(cycles, daily, "climate_lote_matched")).toPandas().set_index("cycle_uid").sort_index()
    assert len(got) == cycles.where("climate_lote_matched IS NOT NULL").count()
    assert ((got[want.columns] - want).abs().fillna(0) < 1e-9).all().all()


def shuffles(spark, df):
    """What each shuffle deals rows by and the columns that it carries, when no table is small."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    blocks = [b.splitlines() for b in text.split("\n\n") if b.strip().startswith("(") and ") Exchange\n" in b + "\n"]
    return [(b[-1].split("Arguments: ")[1], b[1]) for b in blocks if len(b) > 2 and "hashpartitioning" in b[-1]]


def test_shuffles_carry_no_more_than_they_need(spark):
    """Finished rows stay where their cycle is, and raw rows travel without what can be worked out again."""
    raw = production(spark, [("L-1", "k1", "2022-12-10", 12.0, 80.0)])
    days = asof.join_daily(cycle(spark), asof.optical_daily(optical(spark, [(10, 1.0)])), "stac_lote_matched")
    climate = asof.climate_daily(tables(spark, raw).climate)
    spine = cycle(spark).withColumns({"climate_lote_matched": F.lit("S"), "cycle_duration_days": F.lit(300.0)})
    ocean = asof.ocean_core(spine, tables(spark, raw).ocean)
    found = shuffles(spark, plan.assemble(spine, asof.optical_core(days), asof.climate_features(spine, climate), ocean))
    assert found and not [keys for keys, carried in found if "fecha_inicio_ciclo" in keys and "optical_" in carried]
    rows = [carried for keys, carried in found if "source_lote" in keys]
    assert len(rows) == 2 and not any("_deal" in c or "water_balance" in c for c in rows), rows


def test_previous_closing_and_shared_ids_take_one_shuffle(spark):
    raw = production(spark, [("L-1", "k1", "2022-12-10", 12.0, 80.0)])
    closed = cycles.closed_cycles(cycles.production_rows(raw))
    found = shuffles(spark, closed)
    assert len(found) == 1 and found[0][0].startswith("hashpartitioning(cod_cg")
    shared = cycles.flag_duplicate_keys(cycles.eligible_cycles(cycles.closed_spine(closed)))
    assert len(shuffles(spark, shared)) == 1


def test_each_row_of_an_id_has_the_ocean_of_its_dates(spark):
    schema = "cycle_uid string, fecha_inicio_ciclo date, as_of_date date"
    day = lambda n: START + dt.timedelta(n)
    rows = spark.createDataFrame([("a", day(0), day(200)), ("a", day(0), day(200)), ("a", day(0), day(230)), ("b", day(5), day(900))], schema)
    values = spark.createDataFrame([(day(0), day(200), 1.0), (day(0), day(230), 2.0)], "fecha_inicio_ciclo date, as_of_date date, v double")
    got = asof.with_ocean(rows, asof.per_cycle(rows, values))
    assert got.columns == [*rows.columns, "v"]
    assert sorted((r.cycle_uid, r.as_of_date, r.v) for r in got.collect()) == [("a", day(200), 1.0), ("a", day(200), 1.0), ("a", day(230), 2.0), ("b", day(900), None)]


def test_a_cycle_meets_two_time_buckets_at_most(spark):
    starts = spark.range(800).select(F.expr("date_add(date '2020-01-01', cast(id AS int))").alias("s"))
    ends = starts.withColumn("e", F.date_add("s", Settings().max_age_days))
    assert ends.agg(F.max(asof.day_bucket("e") - asof.day_bucket("s"))).first()[0] == 1
