"""Joins of dated series to cycles, up to the as-of date, and the features taken from them.

A series is first folded to one row per key and day. Days are bounded by the calendar, so a key
holding a third of all observations becomes as small as any other before its rows meet in a join
or a window, and distinct-day counts become plain counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import COVERAGE_OUTPUT, OPTICAL_INDEXES, OPTICAL_OUTPUT, Settings
from ..functions.scalars import age_window, degree_days, in_last_days, nan_to_null, water_balance
from ..functions.weighted import slope_sql

DEFAULTS = Settings()
UID = "cycle_uid"
START = "fecha_inicio_ciclo"
AS_OF = "as_of_date"

# ---------------------------------------------------------------- joins on raw rows


def interval_join(
    cycles: DataFrame,
    series: DataFrame,
    cycle_key: str,
    series_key: str,
    date: str,
    how: str = "inner",
    bucket_days: int = 128,
) -> DataFrame:
    """Rows of a series dated between start and as-of date of the cycle with the same key.

    Key and time bucket are the equi-join key, so the rows of one hot key spread over its buckets
    and each is compared with nearby cycles only. ``how="left"`` keeps cycles without rows.
    """
    day = F.unix_date(F.col(date))
    rows = series.where(F.col(date).isNotNull()).withColumn("_bucket", F.floor(day / bucket_days))
    first, last = (F.floor(F.unix_date(F.col(c)) / bucket_days) for c in (START, AS_OF))
    carried = [c for c in cycles.columns if c not in series.columns or c == series_key]
    wanted = cycles.select(
        F.col(cycle_key).alias("_key"),
        F.col(START).alias("_start"),
        F.col(AS_OF).alias("_as_of"),
        F.col(UID).alias("_uid"),
        *([F.struct(*carried).alias("_cycle")] if how == "inner" else []),
        F.explode(F.sequence(first, last)).alias("_cycle_bucket"),
    )
    matched = wanted.join(
        rows,
        (F.col("_key") == F.col(series_key))
        & (F.col("_cycle_bucket") == F.col("_bucket"))
        & F.col(date).between(F.col("_start"), F.col("_as_of")),
    )
    values = [F.col(c) for c in series.columns if c != series_key]
    if how == "inner":
        return matched.select("_cycle.*", *values)
    return cycles.select(*carried).join(matched.select("_uid", *values), F.col(UID) == F.col("_uid"), how).drop("_uid")


def with_age(rows: DataFrame, date: str, s: Settings = DEFAULTS) -> DataFrame:
    """Add age in days, window name and the flags of the last 30 and 60 days."""
    age, limit = F.col("age_days"), F.col("as_of_age_days")
    return rows.withColumn("age_days", F.datediff(date, START).cast("double")).select(
        "*",
        age_window(age, limit, s).alias("age_window"),
        in_last_days(age, limit, 30).alias("in_last_30d"),
        in_last_days(age, limit, 60).alias("in_last_60d"),
    )


def unpivot_indexes(rows: DataFrame, keep: Iterable[str], suffix: str = "_promedio") -> DataFrame:
    """One row per observation and index; NULL and NaN values stay as NULL rows."""
    clean = rows.select(*keep, *[nan_to_null(F.col(f"{i}{suffix}")).alias(i) for i in OPTICAL_INDEXES])
    return clean.unpivot(list(keep), list(OPTICAL_INDEXES), "index_name", "index_value")


# ---------------------------------------------------------------- daily series


#: Days of a time bucket. A cycle is seen for 340 days at most, so it meets two buckets at most.
DAY_BUCKET = 360


def day_bucket(day: str) -> Column:
    return F.floor(F.unix_date(F.col(day)) / DAY_BUCKET)


def dealt_by(key: str, bucket: Column) -> Column:
    """Number that stands before key and bucket when rows are sorted for a join.

    Keys that begin alike are compared letter by letter; numbers settle nearly all comparisons at once.
    """
    return F.hash(F.col(key), bucket)


def with_bucket(daily: DataFrame) -> DataFrame:
    """Add what :func:`join_daily` joins by besides the key."""
    bucket = day_bucket("day")
    return daily.select("*", bucket.alias("_bucket"), dealt_by("source_lote", bucket).alias("_deal"))


def dealt(values: DataFrame) -> DataFrame:
    """Rows dealt by number, key and time bucket. Number and bucket are worked out again behind the shuffle, not carried through it."""
    bucket = day_bucket("day")
    return with_bucket(values.repartition(dealt_by("source_lote", bucket), F.col("source_lote"), bucket))


def optical_daily(raw: DataFrame) -> DataFrame:
    """Per source key and day: count, sum, minimum and maximum of each index.

    Rows are dealt by key and time bucket, as :func:`join_daily` wants them, so that one shuffle of the raw rows serves the
    fold and the join, and the rows of one hot key spread over its buckets. Of a day with one row, sums, minima and maxima
    are the same; side by side as blocks they shrink well when they are shuffled.
    """
    values = raw.select(
        F.col("lote").cast("string").alias("source_lote"),
        F.col("fecha").cast("date").alias("day"),
        *[nan_to_null(F.col(f"{i}_promedio")).alias(i) for i in OPTICAL_INDEXES],
    ).where(F.col("source_lote").isNotNull() & F.col("day").isNotNull())
    folds = (("n", F.count), ("sum", F.sum), ("min", F.min), ("max", F.max))
    return dealt(values).groupBy("_deal", "source_lote", "_bucket", "day").agg(
        *[fold(i).alias(f"{i}_{name}") for name, fold in folds for i in OPTICAL_INDEXES]
    )


def with_previous(joined: DataFrame, gaps_for: Iterable[str] = OPTICAL_INDEXES) -> DataFrame:
    """Add to the daily rows of each cycle the previous day of the cycle with a value, for each index of ``gaps_for``.

    The days of a cycle are bounded by the calendar. The features are grouped by cycle too, so they need no further shuffle.
    """
    days = F.unix_date("day")
    before = Window.partitionBy(UID).orderBy(days).rangeBetween(Window.unboundedPreceding, -1)
    return joined.select(
        "*",
        *[
            F.last(F.when(F.col(f"{i}_n") > 0, F.col("day")), ignorenulls=True).over(before).alias(f"{i}_previous")
            for i in gaps_for
        ],
    )


# climate measure -> source column
CLIMATE_SOURCE = {
    "precip": "precipitacion_sum",
    "eto": "eto_sum",
    "rad": "radiacion_sum",
    "tmean": "temperatura_mean",
    "tmax": "temperatura_max",
    "tmin": "temperatura_min",
    "rh": "humedad_relativa",
}


def climate_values(raw: DataFrame) -> DataFrame:
    """Climate rows with clean values."""
    return raw.select(
        F.col("cod_cg").cast("string").alias("source_lote"),
        F.col("fecha_inicio").cast("date").alias("day"),
        *[nan_to_null(F.col(column)).alias(name) for name, column in CLIMATE_SOURCE.items()],
    )


def with_derived(rows: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Add water balance and degree days."""
    return rows.select(
        "*",
        water_balance(F.col("precip"), F.col("eto")).alias("water_balance"),
        degree_days(F.col("tmean"), s).alias("gdd_10c"),
    )


def climate_rows(raw: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Climate rows with clean values, water balance and degree days."""
    return with_derived(climate_values(raw), s)


def climate_daily(raw: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Per station and day: number of rows, and sum and count of each measure.

    Rows are dealt like those of :func:`optical_daily`, and shuffled once, without what is derived from their values.
    """
    names = [*CLIMATE_SOURCE, "water_balance", "gdd_10c"]
    values = climate_values(raw).where(F.col("source_lote").isNotNull() & F.col("day").isNotNull())
    return (
        with_derived(dealt(values), s)
        .groupBy("_deal", "source_lote", "_bucket", "day")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(name).alias(f"{name}_sum") for name in names],
            *[F.count(name).alias(f"{name}_n") for name in names],
        )
    )


def dated_between(raw: DataFrame, date: str, cycles: DataFrame) -> DataFrame:
    """Rows dated within the span of all cycles.

    The two limits are scalar subqueries, which Spark turns into filters of the parquet scan.
    """
    first, last = cycles.agg(F.min(START)).scalar(), cycles.agg(F.max(AS_OF)).scalar()
    return raw.where(F.col(date).cast("date").between(first, last))


def join_daily(cycles: DataFrame, daily: DataFrame, matched: str) -> DataFrame:
    """Daily rows inside each cycle, with their age.

    Key and time bucket are the equi-join key, so the cycles of a key with a long history, such as a shared station,
    spread over its buckets, and each meets the days near it only.
    """
    wanted = cycles.where(F.col(matched).isNotNull()).select(UID, START, AS_OF, "as_of_age_days", matched)
    wanted = wanted.withColumn("_cycle_bucket", F.explode(F.sequence(day_bucket(START), day_bucket(AS_OF))))
    wanted = wanted.withColumn("_cycle_deal", dealt_by(matched, F.col("_cycle_bucket")))
    rows = daily if "_bucket" in daily.columns else with_bucket(daily)
    return (
        wanted.join(
            rows,
            (F.col("_cycle_deal") == F.col("_deal"))
            & (F.col(matched) == F.col("source_lote"))
            & (F.col("_cycle_bucket") == F.col("_bucket"))
            & F.col("day").between(F.col(START), F.col(AS_OF)),
        )
        .withColumn("age_days", F.datediff("day", START).cast("double"))
        .drop(matched, "source_lote", "_bucket", "_cycle_bucket", "_deal", "_cycle_deal")
    )


def per_window(cycles: DataFrame, matched: str, core: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Features of each cycle that depend on its matched key and two dates only.

    ``core`` sees every distinct window once, so a station that many cycles share costs no more than its windows, which
    the calendar bounds. Cycles without a match have no row.
    """
    own = cycles.where(F.col(matched).isNotNull()).withColumn("_window", F.concat_ws("|", matched, START, AS_OF))
    windows = own.groupBy(F.col("_window").alias(UID)).agg(*[F.first(c).alias(c) for c in (START, AS_OF, "as_of_age_days", matched)])
    return own.select(UID, "_window").join(core(windows).withColumnRenamed(UID, "_window"), "_window").drop("_window")


# ---------------------------------------------------------------- optical features


def age_spans(s: Settings = DEFAULTS) -> dict[str, str]:
    """SQL tests for the age spans of a daily row inside its cycle."""
    return {
        "0_asof": "true",
        "0_180": f"age_days <= {s.mid_end}",
        "181_asof": f"age_days > {s.mid_end}",
        "last30": "age_days >= greatest(0, as_of_age_days - 30)",
        "last60": "age_days >= greatest(0, as_of_age_days - 60)",
    }


def series_stats(index: str | None = None, s: Settings = DEFAULTS) -> dict[str, str]:
    """SQL aggregates over the daily rows of a cycle, for one index or for generic column names.

    Text, as Spark parses a hundred such expressions faster than Python can assemble them.
    """
    n, total, low, high, previous = (
        f"{index}_{part}" if index else part for part in ("n", "sum", "min", "max", "previous")
    )
    seen = {span: f"{n} > 0 AND {test}" for span, test in age_spans(s).items()}
    # a second value on the same day is a gap of 0 days
    gap = (
        f"cast(greatest(CASE WHEN {previous} >= {START} THEN datediff(day, {previous}) END, "
        f"CASE WHEN {n} > 1 THEN 0 END) AS double)"
    )

    def over(aggregate: str, span: str) -> str:
        return f"({aggregate} FILTER (WHERE {seen[span]}))"

    stats: dict[str, str] = {}
    for span in ("0_asof", "0_180"):
        stats[f"obs_count_{span}"] = f"cast({over('count(1)', span)} AS double)"
        stats[f"first_obs_age_{span}"] = over("min(age_days)", span)
        stats[f"last_obs_age_{span}"] = over("max(age_days)", span)
        stats[f"max_gap_days_{span}"] = over(f"max({gap})", span)
        stats[f"peak_{span}"] = over(f"max({high})", span)
        stats[f"min_{span}"] = over(f"min({low})", span)
        stats[f"amplitude_{span}"] = f"{stats[f'peak_{span}']} - {stats[f'min_{span}']}"
    for span in ("181_asof", "last30", "last60"):
        stats[f"obs_count_{span}"] = f"cast(coalesce({over(f'sum({n})', span)}, 0) AS double)"
    for span in seen:
        stats[f"mean_{span}"] = f"{over(f'sum({total})', span)} / {over(f'sum({n})', span)}"
    for span in ("0_asof", "0_180", "181_asof"):
        stats[f"slope_{span}"] = slope_sql("age_days", n, total, seen[span])
    # several values on the last day: the largest one
    stats["last_value_before_asof"] = over(f"max_by({high}, age_days)", "0_asof")
    return stats


def series_features(joined: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """All statistics of every index: one row per cycle and index with at least one value."""
    parts = ("n", "sum", "min", "max", "previous")
    rows = with_previous(joined).select(
        UID, START, "as_of_age_days", "age_days", "day",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("index_name"), *[F.col(f"{i}_{p}").alias(p) for p in parts])
                    for i in OPTICAL_INDEXES
                ]
            )
        ),
    ).where(F.col("n") > 0)
    stats = [F.expr(f"{sql} AS {name}") for name, sql in series_stats(s=s).items()]
    return rows.groupBy(UID, "index_name").agg(*stats)


def boundary_gap(first: str, gap: str, last: str, s: Settings = DEFAULTS) -> str:
    """Longest stretch without a value from the start to day 180, both ends included."""
    return f"greatest({first}, {gap}, {s.mid_end} - {last})"


def optical_columns(stats: dict[str, dict[str, str]], s: Settings = DEFAULTS) -> list[Column]:
    """Optical columns of the dataset, given the SQL of each statistic of each index."""
    ndvi = stats["ndvi"]
    edge = boundary_gap(ndvi["first_obs_age_0_180"], ndvi["max_gap_days_0_180"], ndvi["last_obs_age_0_180"], s)
    coverage = {**ndvi, "boundary_max_gap_days_0_180": edge}
    return [F.expr(f"{coverage[c]} AS optical_{c}") for c in COVERAGE_OUTPUT] + [
        F.expr(f"{stats[i][c]} AS optical_{i}_{c}") for i, names in OPTICAL_OUTPUT.items() for c in names
    ]


def pivot_core(series: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Turn the long table of :func:`series_features` into the optical columns of the dataset."""
    stats = {
        i: {c: f"(max({c}) FILTER (WHERE index_name = '{i}'))" for c in series.columns if c not in (UID, "index_name")}
        for i in OPTICAL_INDEXES
    }
    return series.groupBy(UID).agg(*optical_columns(stats, s))


def optical_core(joined: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Optical columns of the dataset straight from the daily rows, without the long table."""
    stats = {i: series_stats(i, s) for i in OPTICAL_INDEXES}
    # without a single value an index has no row in the long table, so its counts are NULL
    for name in COVERAGE_OUTPUT:
        if "count" in name:
            stats["ndvi"][name] = f"CASE WHEN sum(ndvi_n) > 0 THEN {stats['ndvi'][name]} END"
    # only ndvi has a gap output
    return with_previous(joined, ["ndvi"]).groupBy(UID).agg(*optical_columns(stats, s))


# ---------------------------------------------------------------- climate features


def climate_core(joined: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Counts, sums, means and slopes of the climate rows of a cycle."""
    spans = age_spans(s)

    def total(column: str, span: str) -> str:
        return f"(sum({column}) FILTER (WHERE {spans[span]}))"

    stats = {
        f"pentad_count_{span}": f"cast(coalesce({total('n', span)}, 0) AS double)"
        for span in ("0_asof", "0_180", "181_asof")
    }
    stats |= {f"precip_acc_{span}": total("precip_sum", span) for span in spans}
    stats |= {
        f"{name}_acc_{span}": total(f"{name}_sum", span)
        for name in ("eto", "rad", "water_balance", "gdd_10c")
        for span in ("0_asof", "0_180")
    }
    stats |= {
        f"{name}_mean_0_asof": f"try_divide(sum({name}_sum), sum({name}_n))" for name in ("tmean", "tmax", "tmin", "rh")
    }
    stats |= {
        f"{name}_slope_0_asof": slope_sql("age_days", f"{name}_n", f"{name}_sum")
        for name in ("water_balance", "precip", "rad")
    }
    return joined.groupBy(UID).agg(*[F.expr(f"{sql} AS climate_{name}") for name, sql in stats.items()])


def climate_features(cycles: DataFrame, daily: DataFrame, s: Settings = DEFAULTS, matched: str = "climate_lote_matched") -> DataFrame:
    """Climate features of each matched cycle, worked out once per distinct station and dates."""
    return per_window(cycles, matched, lambda windows: climate_core(join_daily(windows, daily, matched), s))


def fill_no_climate(rows: DataFrame) -> DataFrame:
    """Values of a cycle without climate rows: counts 0 and degree days 0, the rest stays NULL."""
    zero = [f"climate_pentad_count_{span}" for span in ("0_asof", "0_180", "181_asof")]
    return rows.fillna(0.0, [*zero, "climate_gdd_10c_acc_0_asof"])


# ---------------------------------------------------------------- ocean indices


def ocean_join(windows: DataFrame, ocean: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Rows of a key-less series inside each window, widened by the lead time before the start.

    Windows are cut into calendar months, which makes the range join an equi-join on the month.
    """
    begin = F.date_sub(START, s.ocean_lead_days)
    months = F.sequence(F.trunc(begin, "month"), F.trunc(AS_OF, "month"), F.expr("interval 1 month"))
    rows = ocean.select(
        F.col("date").cast("date").alias("ocean_day"),
        *[nan_to_null(F.col(c)).alias(c) for c in ("oni", "nino34", "soi")],
    ).withColumn("_month", F.trunc("ocean_day", "month"))
    return (
        windows.withColumn("_wanted", F.explode(months))
        .join(
            rows,
            (F.col("_wanted") == F.col("_month"))
            & F.col("ocean_day").between(F.date_sub(START, s.ocean_lead_days), F.col(AS_OF)),
        )
        .drop("_wanted", "_month")
    )


def ocean_core(cycles: DataFrame, ocean: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Ocean features of each (start, as-of date) pair.

    They depend on the two dates only. Distinct pairs are bounded by the calendar, so the range
    join does not grow with the number of cycles.
    """
    windows = cycles.select(START, AS_OF).distinct()
    before = F.col("ocean_day") < F.col(START)

    def means(name: str) -> list[Column]:
        return [
            F.avg(F.when(before, F.col(name))).alias(f"enso_{name}_precycle_mean"),
            F.avg(F.when(~before, F.col(name))).alias(f"enso_{name}_asof_mean"),
        ]

    return ocean_join(windows, ocean, s).groupBy(START, AS_OF).agg(
        F.count(F.lit(1)).cast("double").alias("enso_month_count_asof"),
        *means("oni"),
        F.max(F.abs(F.col("oni"))).alias("enso_oni_abs_max_asof"),
        *means("nino34"),
        *means("soi"),
    )


def per_cycle(cycles: DataFrame, ocean: DataFrame) -> DataFrame:
    """Ocean features of each cycle, dealt by cycle: only its id and dates meet the date pairs.

    A cycle id that has several rows may have several dates, one row each.
    """
    wanted = cycles.select(UID, START, AS_OF).join(ocean, [START, AS_OF])
    return wanted.repartition(UID).dropDuplicates([UID, START, AS_OF])


def with_ocean(rows: DataFrame, ocean: DataFrame) -> DataFrame:
    """Add the ocean features of the same cycle and dates. Dates are compared after the join on the id, as rows are dealt by it."""
    own = ocean.withColumnsRenamed({UID: "_ocean_uid", START: "_ocean_start", AS_OF: "_ocean_as_of"})
    same = (F.datediff(START, "_ocean_start") == 0) & (F.datediff(AS_OF, "_ocean_as_of") == 0)
    return rows.join(own, (F.col(UID) == F.col("_ocean_uid")) & same, "left").drop("_ocean_uid", "_ocean_start", "_ocean_as_of")


# ---------------------------------------------------------------- flags


def quality_flags(s: Settings = DEFAULTS) -> dict[str, Column]:
    """Quality flags of a dataset row."""
    seen = F.col("optical_obs_count_0_180")
    obs = F.coalesce(seen, F.lit(0.0)) >= s.min_optical_days
    gap = F.coalesce("optical_boundary_max_gap_days_0_180", F.lit(9999.0)) <= s.max_optical_gap
    climate = F.coalesce("climate_pentad_count_0_180", F.lit(0.0)) >= s.min_pentads
    duration = F.col("cycle_duration_days").between(180, s.max_duration_months * s.days_per_month)
    shape = (F.col("optical_ndvi_peak_0_180") > s.min_ndvi_peak) & (
        F.col("optical_ndvi_amplitude_0_180") > s.min_ndvi_amplitude
    )
    return {
        "asof_valid": (seen >= s.min_optical_days) & gap & climate & duration,
        "asof_optical_obs_ok": obs,
        "asof_optical_gap_ok": gap,
        "asof_climate_coverage_ok": climate,
        "asof_cycle_duration_ok": duration,
        "asof_ndvi_shape_ok": shape,
    }
