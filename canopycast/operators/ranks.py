"""Ranks and exact quantiles from value counts, without collecting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.staging import staged

#: Value ranges per group. Their limits are estimates of even cuts; results do not depend on them.
RANGES = 64
#: Parts of the range of all values in the first round of a quantile, and rows of a part that one task sorts.
PARTS, SORTED = 4096, 200_000


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on keys that may be NULL; the columns of ``left`` come first, keys once."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(other, on, how).drop(*[f"_right_{k}" for k in keys])


def running_counts(counts: DataFrame, keys: list[str], value: str, n: str = "n") -> DataFrame:
    """Add ``before``: how many rows of the group have a smaller value.

    ``counts`` has one row per group and distinct numeric value. Each group is cut into value ranges; each range counts
    on its own and is shifted by the total of the ranges below, so no task sorts a whole group.
    """
    cuts = [i / RANGES for i in range(1, RANGES)]
    limits = counts.groupBy(*keys).agg(F.percentile_approx(value, cuts).alias("_limits"))
    # written once: both uses below must see the same limits, and there is one row per group
    limits = staged(limits, "limits")
    rows = join_null_safe(counts, limits, keys) if keys else counts.withColumn("_limits", limits.scalar())
    rows = rows.withColumn("_range", F.size(F.filter("_limits", lambda x: x < F.col(value)))).drop("_limits")
    lower = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, "_range").agg(F.sum(n).alias("_total"))
    totals = totals.withColumn("_shift", F.coalesce(F.sum("_total").over(lower), F.lit(0))).drop("_total")
    inside = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    joined = join_null_safe(rows, totals, [*keys, "_range"])
    return joined.select(*counts.columns, (F.col("_inside") + F.col("_shift")).alias("before"))


def running_totals(counts: DataFrame, value: str, columns: Sequence[str]) -> DataFrame:
    """Add ``before_<column>`` for each of the columns: its sum over the rows of smaller value.

    ``counts`` has one row per distinct numeric value and should be staged. All columns share one order, cut into value ranges as
    in :func:`running_counts`.
    """
    cuts = [i / RANGES for i in range(1, RANGES)]
    limits = staged(counts.agg(F.percentile_approx(value, cuts).alias("_limits")), "limits")
    rows = counts.withColumn("_limits", limits.scalar())
    rows = rows.withColumn("_range", F.size(F.filter("_limits", lambda x: x < F.col(value)))).drop("_limits")
    totals = rows.groupBy("_range").agg(*[F.sum(c).alias(c) for c in columns])
    lower = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # at most RANGES rows
    totals = totals.select("_range", *[F.coalesce(F.sum(c).over(lower), F.lit(0)).alias(f"_shift_{c}") for c in columns])
    inside = Window.partitionBy("_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"_inside_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in columns})
    return rows.join(totals, "_range").select(
        *counts.columns, *[(F.col(f"_inside_{c}") + F.col(f"_shift_{c}")).alias(f"before_{c}") for c in columns]
    )


def average_ranks(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Average rank of each distinct value in its group, with the number of rows that have it."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_counts(counts, keys, value)
    return ranked.select(*keys, value, "n", (F.col("before") + (F.col("n") + 1) / 2).alias("avg_rank"))


def exact_quantiles(
    rows: DataFrame,
    keys: list[str],
    value: str,
    probabilities: dict[str, float],
    scale: list[str] = [],  # noqa: B006
    n: str = "n",
) -> DataFrame:
    """Exact quantiles per group with linear interpolation; one column per name in ``probabilities``.

    ``rows`` hold one value each, or as many equal ones as their column ``n`` says. NULL values are left out. The values are counted in ``PARTS`` equal parts of their whole range, or of the range of those that
    share the keys ``scale``. That tells in which parts the wanted places lie, and only rows of these parts are ranked. Parts of few
    rows are sorted whole; larger ones, which many close values or far outliers make, are ranked by :func:`running_counts`.
    """
    many = F.col(n) if n in rows.columns else F.lit(1)
    rows = rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_value"), many.alias("_rows"))
    # one row per scale; written once, as both passes below must cut alike
    ranges = staged(rows.groupBy(*scale).agg(F.min("_value").alias("_low"), F.max("_value").alias("_high")), "ranges")
    if scale:
        rows = join_null_safe(rows, ranges, scale)
    else:
        rows = rows.withColumns({c: ranges.select(c).scalar() for c in ("_low", "_high")})
    share = (F.col("_value") - F.col("_low")) / (F.col("_high") - F.col("_low"))
    part = F.when((F.col("_high") > F.col("_low")) & (F.col("_high") - F.col("_low") < float("inf")), F.floor(share * PARTS)).otherwise(0)
    rows = rows.select(*keys, "_value", "_rows", F.least(part, F.lit(PARTS - 1)).cast("int").alias("_part"))

    upto = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, "_part").agg(F.sum("_rows").alias("_here"))
    counts = counts.select("*", F.coalesce(F.sum("_here").over(upto), F.lit(0)).alias("_below"), F.sum("_here").over(Window.partitionBy(*keys)).alias("_all"))
    places = {name: (F.col("_all") - 1) * F.lit(p) for name, p in probabilities.items()}

    def holds(position, before: str, many: str):  # noqa: ANN001, ANN202
        return (F.col(before) <= position) & (position < F.col(before) + F.col(many))

    sides = [f(place) for place in places.values() for f in (F.floor, F.ceil)]
    # one row per group and wanted place; written once, as its size decides how it is joined and ranked
    wanted = staged(counts.where(reduce(lambda a, b: a | b, [holds(x, "_below", "_here") for x in sides])), "wanted-parts")
    left = join_null_safe(rows, wanted, [*keys, "_part"]).groupBy(*keys, "_part", "_below", "_all", "_value").agg(F.sum("_rows").alias("_n"))
    group = [*keys, "_part", "_below", "_all"]
    if (wanted.agg(F.max("_here")).first()[0] or 0) <= SORTED:
        inside = Window.partitionBy(*group).orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
        ranked = left.withColumn("before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    else:
        ranked = running_counts(left.select(*group, "_value", "_n"), group, "_value", "_n")
    ranked = ranked.withColumn("_before", F.col("before") + F.col("_below"))
    columns = []
    for name, place in places.items():
        ends = [F.max(F.when(holds(f(place), "_before", "_n"), F.col("_value"))) for f in (F.floor, F.ceil)]
        columns.append((ends[0] + (ends[1] - ends[0]) * F.max(place - F.floor(place))).alias(name))
    return ranked.groupBy(*keys).agg(*columns)
