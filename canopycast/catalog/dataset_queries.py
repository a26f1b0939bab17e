"""Queries over the dataset half: keys, cycles, series, flags and the whole build."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import (
    CLIMATE_OUTPUT, CYCLE_OUTPUT, FLAG_OUTPUT, MATCH_OUTPUT, OCEAN_OUTPUT, OPTICAL_INDEXES, PROD_COLUMNS,
    Settings, dataset_output, optical_output,
)
from ..functions import scalars as sc
from ..functions.weighted import slope_sql
from ..operators import asof, cycles, keys
from ..plans import dataset as plan
from . import oracle as o
from .registry import Views, query

S = Settings(first_season="1995_1996")
YOUNG = Settings(first_season="1995_1996", min_age_days=60)


def tables(v: Views) -> plan.Tables:
    return plan.Tables(v.productividad, v.stac_indices, v.clima, v.enso, v.clima_lookup)


def closed(v: Views):
    return cycles.closed_cycles(cycles.production_rows(v.productividad, S), S)


def stac_lookup(v: Views):
    return keys.key_match(
        keys.distinct_keys(v.productividad, "lote"), keys.distinct_keys(v.stac_indices, "lote"), "stac"
    )


def spine(v: Views, s: Settings = S):
    """Eligible cycles with their matches. Open cycles are old enough under YOUNG only."""
    return plan.eligible_spine(tables(v), s)


def by_key(v: Views) -> plan.Tables:
    """Tables whose climate keys are spelled like lots and matched by the build itself."""
    return plan.Tables(v.productividad, v.stac_indices, v.clima_lots, v.enso)


def optical_days(v: Views, s: Settings = S):
    return asof.join_daily(spine(v, s), asof.optical_daily(v.stac_indices), "stac_lote_matched")


def climate(v: Views, eligible, raw=None, s: Settings = S):
    """Climate features of every eligible cycle, those without climate rows included."""
    core = asof.climate_features(eligible, asof.climate_daily(v.clima if raw is None else raw, s), s)
    return asof.fill_no_climate(eligible.select("cycle_uid").join(core, "cycle_uid", "left"))


# ---------------------------------------------------------------- scalars


@query("canonical_key", f"SELECT lote, {o.canon('lote')} AS canonical FROM stac_indices")
def _(v):
    return v.stac_indices.select("lote", sc.canonical_key(F.col("lote")).alias("canonical"))


@query("season_label", "SELECT cod_cg_zafra, replace(replace(zafra, 'Zafra ', ''), '-', '_') AS label FROM productividad")
def _(v):
    return v.productividad.select("cod_cg_zafra", sc.season_label(F.col("zafra")).alias("label"))


@query(
    "parse_date_multi",
    """SELECT cod_cg_zafra, coalesce(CAST(try_strptime(cierre, '%Y-%m-%d') AS DATE),
    CAST(try_strptime(cierre, '%d/%m/%Y') AS DATE)) AS day FROM productividad""",
)
def _(v):
    return v.productividad.select("cod_cg_zafra", sc.parse_date_multi(F.col("cierre")).alias("day"))


@query("season_of_date", f"SELECT DISTINCT fecha, {o.season('fecha')} AS season FROM stac_indices")
def _(v):
    days = v.stac_indices.select("fecha").distinct()
    return days.select("fecha", sc.season_of_date(F.col("fecha")).alias("season"))


@query(
    "cycle_id",
    "SELECT cod_cg_zafra_original, cod_cg || '_' || replace(zafra_norm, '_', '-') AS cod_cg_zafra FROM closed",
)
def _(v):
    return closed(v).select(
        "cod_cg_zafra_original", sc.cycle_id(F.col("cod_cg"), F.col("zafra_norm")).alias("cod_cg_zafra")
    )


@query(
    "nan_to_null",
    f"SELECT lote, fecha, {o.no_nan('ndvi_promedio')} AS ndvi, ndre_promedio AS ndre FROM stac_indices",
    ["ndvi", "ndre"],
)
def _(v):
    return v.stac_indices.select(
        "lote", "fecha",
        sc.nan_to_null(F.col("ndvi_promedio")).alias("ndvi"),
        sc.nan_to_null(F.col("ndre_promedio").cast("string")).alias("ndre"),
    )


@query("baseline_start", "SELECT cod_cg_zafra_original, fecha_inicio_baseline FROM dated")
def _(v):
    rows = cycles.production_rows(v.productividad, S).where(F.col("fecha_cierre_real").isNotNull())
    return rows.select(
        "cod_cg_zafra_original",
        sc.baseline_start(F.col("fecha_cierre_real"), F.col("prod_edad_meses")).alias("fecha_inicio_baseline"),
    )


@query(
    "start_correction",
    "SELECT cod_cg_zafra_original, fecha_inicio_ciclo, start_correction_days FROM closed",
)
def _(v):
    return closed(v).select("cod_cg_zafra_original", "fecha_inicio_ciclo", "start_correction_days")


@query(
    "age_windows",
    """SELECT cycle_uid, fecha, age_days, CASE WHEN age_days <= 90 THEN 'age_000_090' WHEN age_days <= 180 THEN 'age_091_180'
    ELSE 'age_181_asof' END AS age_window, age_days >= as_of_age_days - 30 AS in_last_30d,
    age_days >= as_of_age_days - 60 AS in_last_60d FROM optical_rows""",
    ["age_days"],
)
def _(v):
    joined = asof.interval_join(spine(v), v.stac_indices, "stac_lote_matched", "lote", "fecha")
    return asof.with_age(joined, "fecha", S).select(
        "cycle_uid", "fecha", "age_days", "age_window", "in_last_30d", "in_last_60d"
    )


@query(
    "climate_derive",
    "SELECT source_lote, day, precip, eto, tmean, water_balance, gdd_10c FROM climate_clean",
    ["precip", "eto", "tmean", "water_balance", "gdd_10c"],
)
def _(v):
    return asof.climate_rows(v.clima, S).select(
        "source_lote", "day", "precip", "eto", "tmean", "water_balance", "gdd_10c"
    )


_RATES = [f"climate_{n}_per_day_0_asof" for n in ("precip", "eto", "rad", "water_balance", "gdd_10c")]


@query(
    "per_day_rates",
    "SELECT cycle_uid, "
    + ", ".join(f"climate_{n}_acc_0_asof / as_of_age_days AS {r}" for n, r in zip(("precip", "eto", "rad", "water_balance", "gdd_10c"), _RATES))
    + " FROM climate_wide JOIN eligible USING (cycle_uid)",
    _RATES,
)
def _(v):
    eligible = spine(v)
    rows = eligible.join(climate(v, eligible), "cycle_uid")
    return rows.select(
        "cycle_uid",
        *[sc.per_day(F.col(r.replace("per_day", "acc")), F.col("as_of_age_days")).alias(r) for r in _RATES],
    )


_PRODUCTION = ["tch", "tc", "area", "prod_edad_meses"]


@query("row_filters", "SELECT * FROM production", _PRODUCTION)
def _(v):
    return cycles.production_rows(v.productividad, S)


_AGE = ["tch", "tc", "area", "prod_edad_meses", "previous_tch", "previous_tc"]


@query("eligible_cycles", "SELECT * FROM eligible", [*_AGE, "as_of_age_days", "cycle_duration_days"])
def _(v):
    return plan.eligible_spine(tables(v), S)


# ---------------------------------------------------------------- joins


@query("distinct_keys", "SELECT * FROM stac_keys")
def _(v):
    return keys.distinct_keys(v.stac_indices, "lote")


@query("unique_canonical", "SELECT * FROM stac_unique")
def _(v):
    return keys.unique_canonical(keys.distinct_keys(v.stac_indices, "lote"))


@query("key_match", "SELECT * FROM stac_lookup")
def _(v):
    return stac_lookup(v)


def _latest_sources(v: Views):
    return [
        (keys.dated_keys(v.stac_indices, "lote", "fecha"), stac_lookup(v), "stac_lote_matched"),
        (keys.dated_keys(v.clima, "cod_cg", "fecha_inicio"), v.clima_lookup, "climate_lote_matched"),
    ]


@query("latest_observation", "SELECT cod_cg, fecha_inicio_ciclo, latest_observation_date FROM observed")
def _(v):
    starts = cycles.open_starts(cycles.latest_closed(closed(v)), S).select("cod_cg", "fecha_inicio_ciclo")
    return cycles.latest_observation(starts, _latest_sources(v))


@query("open_cycles", "SELECT * FROM opened", ["area", "previous_tch", "previous_tc"])
def _(v):
    return cycles.open_cycles(closed(v), _latest_sources(v), S)


_OPTICAL_RAW = [f"{i}_promedio" for i in OPTICAL_INDEXES]
_CLIMATE_RAW = ["precipitacion_sum", "eto_sum", "radiacion_sum", "temperatura_mean", "temperatura_max", "temperatura_min", "humedad_relativa"]


@query(
    "interval_join_inner",
    f"SELECT cycle_uid, fecha, {', '.join(_OPTICAL_RAW)} FROM optical_rows",
    _OPTICAL_RAW,
)
def _(v):
    joined = asof.interval_join(spine(v), v.stac_indices, "stac_lote_matched", "lote", "fecha")
    return joined.select("cycle_uid", "fecha", *_OPTICAL_RAW)


@query(
    "interval_join_left",
    f"""SELECT e.cycle_uid, c.fecha_inicio, {', '.join(f'c.{m}' for m in _CLIMATE_RAW)} FROM eligible e
    LEFT JOIN clima c ON c.cod_cg = e.climate_lote_matched AND c.fecha_inicio BETWEEN e.fecha_inicio_ciclo AND e.as_of_date""",
    _CLIMATE_RAW,
)
def _(v):
    climate = v.clima.withColumnRenamed("cod_cg", "station")
    joined = asof.interval_join(spine(v), climate, "climate_lote_matched", "station", "fecha_inicio", "left")
    return joined.select("cycle_uid", "fecha_inicio", *_CLIMATE_RAW)


@query(
    "range_join_global",
    "SELECT cycle_uid, date AS ocean_day, oni, nino34, soi FROM ocean_rows",
    ["oni", "nino34", "soi"],
)
def _(v):
    cycles_ = spine(v).select("cycle_uid", asof.START, asof.AS_OF)
    # distinct date pairs meet the ocean series, then an equi-join brings the rows to the cycles
    windows = asof.ocean_join(cycles_.select(asof.START, asof.AS_OF).distinct(), v.enso, S)
    joined = cycles_.join(windows, [asof.START, asof.AS_OF], "left")
    return joined.select("cycle_uid", "ocean_day", "oni", "nino34", "soi")


# ---------------------------------------------------------------- aggregations and windows

_STATS = list(o.STATS)


@query("series_features", f"SELECT cycle_uid, index_name, {', '.join(_STATS)} FROM optical_series", _STATS)
def _(v):
    return asof.series_features(optical_days(v), S).select("cycle_uid", "index_name", *_STATS)


@query(
    "regr_slope",
    "SELECT cycle_uid, index_name, slope_0_asof, slope_0_180, slope_181_asof FROM optical_series",
    ["slope_0_asof", "slope_0_180", "slope_181_asof"],
)
def _(v):
    joined = asof.interval_join(spine(v), v.stac_indices, "stac_lote_matched", "lote", "fecha")
    tall = asof.unpivot_indexes(asof.with_age(joined, "fecha", S), ["cycle_uid", "age_days"])
    spans = {"slope_0_asof": "true", "slope_0_180": "age_days <= 180", "slope_181_asof": "age_days > 180"}
    slopes = [F.expr(slope_sql("age_days", "1", "index_value", where)).alias(name) for name, where in spans.items()]
    return tall.where("index_value IS NOT NULL").groupBy("cycle_uid", "index_name").agg(*slopes)


@query("pivot_core", "SELECT * FROM optical_wide", optical_output())
def _(v):
    return asof.pivot_core(asof.series_features(optical_days(v), S), S)


@query("optical_core", "SELECT * FROM optical_wide", optical_output())
def _(v):
    return asof.optical_core(optical_days(v), S)


_CLIMATE = [c for c in CLIMATE_OUTPUT if "per_day" not in c]


@query("climate_core", "SELECT * FROM climate_wide", _CLIMATE)
def _(v):
    return climate(v, spine(v))


@query("enso_core", "SELECT * FROM ocean_wide", list(OCEAN_OUTPUT))
def _(v):
    eligible = spine(v)
    core = asof.ocean_core(eligible, v.enso, S)
    rows = eligible.select("cycle_uid", asof.START, asof.AS_OF).join(core, [asof.START, asof.AS_OF], "left")
    return rows.fillna(0.0, ["enso_month_count_asof"]).select("cycle_uid", *OCEAN_OUTPUT)


@query("quality_flags", "SELECT * FROM flags")
def _(v):
    return plan.dataset(tables(v), S, columns=["cycle_uid", *FLAG_OUTPUT])


@query("prev_closing", "SELECT cod_cg_zafra_original, cod_cg, fecha_cierre_real, previous_fecha_cierre FROM dated")
def _(v):
    rows = cycles.production_rows(v.productividad, S).where(F.col("fecha_cierre_real").isNotNull())
    return cycles.previous_closing(rows).select(
        "cod_cg_zafra_original", "cod_cg", "fecha_cierre_real", "previous_fecha_cierre"
    )


@query(
    "obs_gap",
    "SELECT cycle_uid, index_name, max_gap_days_0_180, max_gap_days_0_asof FROM optical_series",
    ["max_gap_days_0_180", "max_gap_days_0_asof"],
)
def _(v):
    return asof.series_features(optical_days(v), S).select(
        "cycle_uid", "index_name", "max_gap_days_0_180", "max_gap_days_0_asof"
    )


@query("latest_closed", "SELECT * FROM latest", ["previous_tch", "previous_tc", "area"])
def _(v):
    return cycles.latest_closed(closed(v))


@query(
    "last_value",
    "SELECT cycle_uid, index_name, last_value_before_asof FROM optical_series",
    ["last_value_before_asof"],
)
def _(v):
    return asof.series_features(optical_days(v), S).select("cycle_uid", "index_name", "last_value_before_asof")


@query("cycle_spine", "SELECT * FROM spine", _AGE)
def _(v):
    rows = closed(v)
    return cycles.cycle_spine(rows, cycles.open_cycles(rows, _latest_sources(v), S))


@query("open_cycle_rows", "SELECT * FROM eligible_young WHERE cycle_status = 'open'",
       [*_AGE, "as_of_age_days", "cycle_duration_days"])
def _(v):
    return plan.eligible_spine(tables(v), YOUNG).where("cycle_status = 'open'")


@query(
    "unpivot_indices",
    "SELECT lote, fecha, index_name, v FROM ("
    + " UNION ALL ".join(
        f"SELECT lote, fecha, '{i}' AS index_name, {o.no_nan(f'{i}_promedio')} AS v FROM stac_indices" for i in OPTICAL_INDEXES
    )
    + ")",
    ["v"],
)
def _(v):
    return asof.unpivot_indexes(v.stac_indices, ["lote", "fecha"]).withColumnRenamed("index_value", "v")


# ---------------------------------------------------------------- whole build

_TEXT = {
    *PROD_COLUMNS, *MATCH_OUTPUT, *FLAG_OUTPUT, "cod_cg_zafra", "cod_cg", "zafra_norm", "dataset_role", "cycle_status",
    "has_target_tch", "start_rule", "zafra_assignment_method", "cod_cg_zafra_original", "zafra_norm_original",
    "previous_zafra_norm",
}
_DATES = {c for c in CYCLE_OUTPUT if "fecha" in c} | {"as_of_date"}
_INTS = {"min_prediction_age_days", "max_prediction_age_days", "start_correction_days"}
DATASET_DOUBLES = [c for c in dataset_output() if c not in _TEXT | _DATES | _INTS]
DATASET_SQL = (
    "SELECT " + ", ".join(c for c in dataset_output())
    + ", cycle_uid, count(*) OVER (PARTITION BY cod_cg_zafra) > 1 AS duplicate_key FROM eligible"
    " LEFT JOIN optical_wide USING (cycle_uid) LEFT JOIN climate_wide USING (cycle_uid)"
    " LEFT JOIN ocean_wide USING (cycle_uid) LEFT JOIN flags USING (cycle_uid)"
)
for _r in _RATES:
    DATASET_SQL = DATASET_SQL.replace(_r, f"{_r.replace('per_day', 'acc')} / as_of_age_days AS {_r}", 1)


@query("assemble_features", DATASET_SQL, DATASET_DOUBLES)
def _(v):
    return plan.dataset(tables(v), S)


@query(
    "dataset_build",
    f"SELECT * FROM ({DATASET_SQL}) WHERE asof_valid",
    DATASET_DOUBLES,
)
def _(v):
    return plan.dataset(tables(v), S, valid_only=True)


# ---------------------------------------------------------------- open cycles, and climate matched by key


@query("series_features_open", o.varied(f"SELECT cycle_uid, index_name, {', '.join(_STATS)} FROM optical_series", "_young"), _STATS)
def _(v):
    return asof.series_features(optical_days(v, YOUNG), YOUNG).select("cycle_uid", "index_name", *_STATS)


@query("climate_core_open", o.varied("SELECT * FROM climate_wide", "_young"), _CLIMATE)
def _(v):
    return climate(v, spine(v, YOUNG), s=YOUNG)


@query("key_match_climate", "SELECT * FROM climate_by_key")
def _(v):
    return keys.key_match(keys.distinct_keys(v.productividad, "lote"), keys.distinct_keys(v.clima_lots, "cod_cg"), "climate")


@query("climate_core_by_key", o.varied("SELECT * FROM climate_wide", "_by_key"), _CLIMATE)
def _(v):
    return climate(v, plan.eligible_spine(by_key(v), S), v.clima_lots)


@query("dataset_build_by_key", o.varied(DATASET_SQL, "_by_key"), DATASET_DOUBLES)
def _(v):
    return plan.dataset(by_key(v), S)
