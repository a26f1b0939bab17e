"""Lot cycles: closed, open, their union and the eligible ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import AGRONOMY, KEY, LOT, PROD_COLUMNS, SEASON, Settings
from ..functions.scalars import (
    baseline_start,
    corrected_start,
    cycle_id,
    parse_date_multi,
    season_label,
    season_of_date,
)

DEFAULTS = Settings()
CLOSING = "fecha_cierre_real"
START = "fecha_inicio_ciclo"
#: Columns of a closed cycle that the features of cycles depend on; the others describe it.
DATED = (LOT, SEASON, "cod_cg_zafra_original", START, CLOSING, "fecha_fin_ciclo")


def production_rows(raw: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Usable production records with parsed closing date and season label."""
    number = {"tch": "tch", "tc": "tc", "area": "area", "edad": "prod_edad_meses"}
    return raw.where(
        F.col(KEY).isNotNull()
        & F.col("lote").isNotNull()
        & F.col("tch").between(s.min_tch, s.max_tch)
        & F.col("cierre").isNotNull()
        & F.col("edad").isNotNull()
    ).select(
        F.col("lote").cast("string").alias(LOT),
        F.col(KEY).alias("cod_cg_zafra_original"),
        season_label(F.col("zafra")).alias("zafra_norm_original"),
        F.col("zafra").alias("zafra_productividad_raw"),
        *[F.col(old).cast("double").alias(new) for old, new in number.items()],
        *[F.col(old).alias(new) for old, new in zip(AGRONOMY, PROD_COLUMNS)],
        F.col("cierre"),
        parse_date_multi(F.col("cierre")).alias(CLOSING),
    )


def previous_closing(rows: DataFrame, tiebreak: str = "cod_cg_zafra_original") -> DataFrame:
    """Add the closing date before this one in the same lot.

    Rows closing on the same day follow the tiebreak: the first looks back to an earlier day, the
    others to the shared day. Either is the day of the row before, so the rows are dealt by lot and
    sorted once; a lot's records are few, one for each harvest.

    Rows without lot or closing date are left out, at the end: a test of the closing date before the
    window would move to the scan, where Spark would parse the text of every date once more.
    """
    tied = rows.withColumn("_tie", F.xxhash64(*rows.columns))
    before = F.lag(CLOSING).over(Window.partitionBy(LOT).orderBy(CLOSING, tiebreak, "_tie"))
    return (
        tied.withColumn("previous_fecha_cierre", before)
        .where(F.col(LOT).isNotNull() & F.col(CLOSING).isNotNull())
        .drop("_tie")
    )


def closed_cycles(production: DataFrame, s: Settings = DEFAULTS, drop_copies: bool = False) -> DataFrame:
    """One row per production record with a closing date; with ``drop_copies`` exact copies count once."""
    rows = previous_closing(production.dropDuplicates() if drop_copies else production)
    rows = rows.withColumn(
        "fecha_inicio_baseline", baseline_start(F.col(CLOSING), F.col("prod_edad_meses"), s.days_per_month)
    ).withColumn(
        START, corrected_start(F.col("fecha_inicio_baseline"), F.col("previous_fecha_cierre"), s.restart_gap_days)
    )
    return rows.select(
        LOT,
        season_of_date(F.col(CLOSING), s.season_start_month).alias(SEASON),
        "cod_cg_zafra_original",
        "zafra_norm_original",
        F.lit("training").alias("dataset_role"),
        F.lit("closed").alias("cycle_status"),
        F.lit(True).alias("has_target_tch"),
        "tch",
        "tc",
        "area",
        START,
        "fecha_inicio_baseline",
        CLOSING,
        F.col(CLOSING).alias("fecha_fin_ciclo"),
        "previous_fecha_cierre",
        F.lit("closed_baseline_or_previous_cierre_plus_21d").alias("start_rule"),
        F.datediff(START, "fecha_inicio_baseline").alias("start_correction_days"),
        F.lit("real_cierre_productiva").alias("zafra_assignment_method"),
        "prod_edad_meses",
        *PROD_COLUMNS,
    )


def latest_closed(closed: DataFrame) -> DataFrame:
    """The last closed cycle of each lot; the larger original key wins a tie.

    ``closed`` may have its ``DATED`` columns alone: they order before the others, so they come out the same.
    """
    names = {
        SEASON: "previous_zafra_norm",
        START: "previous_fecha_inicio_ciclo",
        "tch": "previous_tch",
        "tc": "previous_tc",
        "area": "area",
        **{c: c for c in PROD_COLUMNS},
    }
    carried = [F.col(c).alias(name) for c, name in names.items() if c in closed.columns]
    # one aggregation buffer; the ordering fields lead the struct
    last = F.max(F.struct(F.col(CLOSING).alias("previous_fecha_cierre"), "cod_cg_zafra_original", *carried))
    return closed.groupBy(LOT).agg(last.alias("_last")).select(LOT, "_last.*").drop("cod_cg_zafra_original")


def latest_observation(starts: DataFrame, sources: list[tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Latest date observed on or after the start of each cycle, over several series.

    ``starts`` has the lot and its start. Each source is (dated keys, lookup, matched column). As
    only the maximum counts, one date per source key is enough and no series row is joined.
    """
    never = F.lit("1900-01-01").cast("date")
    result, found = starts, []
    for position, (dates, lookup, matched) in enumerate(sources):
        name = f"_last_{position}"
        per_lot = lookup.select(LOT, F.col(matched).alias("source_lote")).join(dates, "source_lote").select(
            LOT, F.col("last_date").alias(name)
        )
        result = result.join(per_lot, LOT, "left")
        found.append(F.coalesce(F.when(F.col(name) >= F.col(START), F.col(name)), never))
    latest: Column = F.greatest(*found) if len(found) > 1 else found[0]
    return result.withColumn("latest_observation_date", latest).drop(*[f"_last_{i}" for i in range(len(sources))])


def open_starts(latest: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Start and estimated closing of the cycle that follows the last closed one."""
    return latest.withColumn(START, F.date_add("previous_fecha_cierre", s.open_gap_days)).withColumn(
        "fecha_cierre_estimada", F.date_add(START, s.open_cycle_days)
    )


def open_cycles(
    closed: DataFrame, sources: list[tuple[DataFrame, DataFrame, str]], s: Settings = DEFAULTS
) -> DataFrame:
    """Cycles observed since the last closing, in a season after every closed one.

    Like :func:`latest_closed` it takes ``DATED`` columns alone, and leaves out what describes a cycle.
    """
    last_season = closed.agg(F.max(SEASON))
    rows = latest_observation(open_starts(latest_closed(closed), s), sources)
    rows = rows.withColumn(SEASON, season_of_date(F.col("fecha_cierre_estimada"), s.season_start_month))
    described = [c for c in ("area", *PROD_COLUMNS, "previous_tch", "previous_tc") if c in rows.columns]
    return rows.where(
        (F.col("latest_observation_date") >= F.col(START)) & (F.col(SEASON) > last_season.scalar())
    ).select(
        LOT,
        SEASON,
        F.lit("scoring").alias("dataset_role"),
        F.lit("open").alias("cycle_status"),
        F.lit(False).alias("has_target_tch"),
        *[c for c in described if c == "area"],
        START,
        "fecha_cierre_estimada",
        F.col("fecha_cierre_estimada").alias("fecha_fin_ciclo"),
        "previous_fecha_cierre",
        F.lit("open_previous_cierre_plus_1d").alias("start_rule"),
        F.lit("estimated_cierre_productiva").alias("zafra_assignment_method"),
        *[c for c in described if c in PROD_COLUMNS],
        "previous_zafra_norm",
        "previous_fecha_inicio_ciclo",
        *[c for c in described if c.startswith("previous_")],
        "latest_observation_date",
    )


def closed_spine(closed: DataFrame) -> DataFrame:
    """Closed cycles with their public id; they may be observed until they close."""
    return closed.select(
        cycle_id(F.col(LOT), F.col(SEASON)).alias(KEY),
        "*",
        F.col("fecha_fin_ciclo").alias("natural_asof_limit_date"),
    )


def cycle_spine(closed: DataFrame, opened: DataFrame) -> DataFrame:
    """Closed and open cycles in one table; columns of only one side are NULL on the other."""
    right = opened.select(
        cycle_id(F.col(LOT), F.col(SEASON), "_open").alias(KEY),
        "*",
        F.col("latest_observation_date").alias("natural_asof_limit_date"),
    ).drop("latest_observation_date")
    return closed_spine(closed).unionByName(right, allowMissingColumns=True)


def eligible_cycles(spine: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Cycles old enough on their as-of date, from the first season on.

    ``cycle_uid`` tells apart two cycles of one lot that close in the same season.
    """
    as_of = F.least("natural_asof_limit_date", F.date_add(START, s.max_age_days))
    age = F.datediff("as_of_date", START)
    end = F.coalesce(F.col(CLOSING).cast("string"), F.lit("open"))
    return (
        spine.where(F.col("natural_asof_limit_date").isNotNull() & (F.col(SEASON) >= s.first_season))
        .withColumn("as_of_date", as_of)
        .where(age >= s.min_age_days)
        .select(
            "*",
            F.lit(s.min_age_days).alias("min_prediction_age_days"),
            F.lit(s.max_age_days).alias("max_prediction_age_days"),
            age.cast("double").alias("as_of_age_days"),
            F.datediff("fecha_fin_ciclo", START).cast("double").alias("cycle_duration_days"),
            F.concat_ws("|", LOT, F.col(START).cast("string"), end).alias("cycle_uid"),
        )
    )


def flag_duplicate_keys(cycles: DataFrame) -> DataFrame:
    """Mark public ids shared by several cycles; their number is bounded by the season's length.

    An id belongs to one lot, so rows already dealt by lot are not shuffled again.
    """
    return cycles.withColumn("duplicate_key", F.count(F.lit(1)).over(Window.partitionBy(LOT, KEY)) > 1)
