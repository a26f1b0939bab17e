"""Forecast-error reports per row, split, range and season."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..config import KEY, LOT, SEASON
from ..functions.scalars import pct, scrub_inf
from . import ranks

# Right-closed upper limits and labels of the target ranges, and error tolerances.
RANGE_LIMITS = (70, 85, 100, 115, 130)
RANGE_LABELS = ("<=70", "70-85", "85-100", "100-115", "115-130", ">130")
TAIL_LIMITS = (85, 115)
TAIL_LABELS = ("low", "middle", "high")
TOLERANCES = (5, 10, 15)
CONTEXT = (
    "prod_ingenio", "prod_cosecha", "prod_no_corte", "prod_variedad",
    "prod_grupo_de_suelo", "prod_grupo_de_humedad", "prod_codigo_zae", "prod_familia_de_suelo",
)
QUANTILES = ("pred_tch_p10", "pred_tch_p50", "pred_tch_p90")
LEADING = (
    "split", KEY, LOT, SEASON, "area", "actual_tch", "pred_tch", "tch_error", "tch_abs_error", "tch_pct_error",
)


def bins(value: Column, limits: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin; NULL for a missing value."""
    label = F.when(value <= limits[0], labels[0])
    for limit, name in zip(limits[1:], labels[1:]):
        label = label.when(value <= limit, name)
    return label.when(value > limits[-1], labels[-1])


def with_ranges(df: DataFrame) -> DataFrame:
    """Add the range and the tail group of the target."""
    actual = F.col("actual_tch")
    return df.withColumns(
        {
            "actual_tch_range": bins(actual, RANGE_LIMITS, RANGE_LABELS),
            "tail_group": bins(actual, TAIL_LIMITS, TAIL_LABELS),
        }
    )


def prediction_error(df: DataFrame) -> DataFrame:
    """Error, absolute error and error relative to the actual value; leading columns first."""
    error = F.col("pred_tch") - F.col("actual_tch")
    rows = df.withColumns(
        {
            "tch_error": error,
            "tch_abs_error": F.abs(error),
            "tch_pct_error": scrub_inf(F.try_divide(error, F.col("actual_tch"))),
        }
    )
    first = [c for c in LEADING if c in rows.columns]
    return rows.select(*first, *[c for c in rows.columns if c not in first])


# ---------------------------------------------------------------- building blocks


def rmse(error: Column) -> Column:
    return F.sqrt(F.avg(error * error))


def r2(actual: Column, predicted: Column) -> Column:
    """1 - SSE / SST; with a constant target 1 if every prediction is exact, else 0."""
    error = predicted - actual
    sse, sst = F.sum(error * error), F.var_pop(actual) * F.count(actual)
    return F.when(sst > 0, 1 - sse / sst).when(sse == 0, 1.0).when(sse.isNotNull(), 0.0)


def within(error: Column, label: str = "pct_within_{}_tch") -> list[Column]:
    """Percent of rows within each tolerance; a missing error is not within."""
    rows = F.count(F.lit(1))
    return [pct(F.count(F.when(error <= t, 1)), rows).alias(label.format(t)) for t in TOLERANCES]


def total(column: str) -> Column:
    """Sum that is 0, not NULL, when every value is missing."""
    return F.coalesce(F.sum(column), F.lit(0.0))


def basic(prefix: str = "tch") -> list[Column]:
    return [
        F.avg("tch_error").alias(f"{prefix}_bias"),
        F.avg("tch_abs_error").alias(f"{prefix}_mae"),
        rmse(F.col("tch_error")).alias(f"{prefix}_rmse"),
    ]


# ---------------------------------------------------------------- reports


def regression_metrics(df: DataFrame, keys: Sequence[str] = (), actual="actual_tch", predicted="pred_tch") -> DataFrame:
    """rmse, mae, r2 and bias, overall or per key."""
    a, p = F.col(actual), F.col(predicted)
    return df.groupBy(*keys).agg(
        rmse(p - a).alias("rmse"),
        F.avg(F.abs(p - a)).alias("mae"),
        r2(a, p).alias("r2"),
        F.avg(p - a).alias("bias"),
    )


def lot_error_metrics(predictions: DataFrame) -> DataFrame:
    """Error per split."""
    return predictions.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), *basic(), *within(F.col("tch_abs_error"))
    )


def range_metrics(predictions: DataFrame) -> DataFrame:
    """Error per split and target range; ranges without rows are kept for every split."""
    found = with_ranges(predictions).groupBy("split", "actual_tch_range").agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("actual_tch").alias("actual_tch_mean"),
        F.avg("pred_tch").alias("pred_tch_mean"),
        *basic(),
        *within(F.col("tch_abs_error")),
    )
    labels = F.explode(F.array(*[F.lit(x) for x in RANGE_LABELS]))
    cells = predictions.select("split").distinct().withColumn("actual_tch_range", labels)
    cells = cells.unionByName(found.where(F.col("actual_tch_range").isNull()).select("split", "actual_tch_range"))
    return ranks.join_null_safe(cells, found, ["split", "actual_tch_range"], "left").fillna(0, ["rows"])


def error_summary(
    df: DataFrame, groupings: Sequence[tuple[str, Sequence[str]]], min_rows: int = 0, exact: bool = True
) -> DataFrame:
    """The same error summary for several groupings in one pass.

    The grouping id tells a NULL group from a column that is not part of the grouping. Medians are
    exact unless ``exact`` is false.
    """
    columns = list(dict.fromkeys(c for _, group in groupings for c in group))
    sets = [list(group) for _, group in groupings]

    def label(gid: Column) -> Column:
        # bit of a column is set when the column is rolled up; the first column is the highest bit
        name = None
        for text, group in groupings:
            bits = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in group)
            name = (F.when(gid == bits, text)) if name is None else name.when(gid == bits, text)
        return name

    rows = F.count(F.lit(1))
    medians = [] if exact else [
        F.approx_percentile("actual_tch", 0.5).alias("actual_tch_median"),
        F.approx_percentile("pred_tch", 0.5).alias("pred_tch_median"),
    ]
    error = F.col("tch_error")
    summary = df.groupingSets(sets, *columns).agg(
        F.grouping_id().alias("_gid"),
        rows.alias("rows"),
        F.avg("actual_tch").alias("actual_tch_mean"),
        F.avg("pred_tch").alias("pred_tch_mean"),
        *medians,
        F.avg("tch_error").alias("tch_bias"),
        F.avg("tch_abs_error").alias("tch_mae"),
        pct(F.count(F.when(error > 0, 1)), rows).alias("overprediction_pct"),
        pct(F.count(F.when(error < 0, 1)), rows).alias("underprediction_pct"),
        rmse(error).alias("tch_rmse"),
        *within(F.col("tch_abs_error")),
    ).where(F.col("rows") >= min_rows).withColumn("grouping", label(F.col("_gid"))).drop("_gid")
    if exact:
        keys = ["grouping", *columns]
        middle = grouped_medians(df, groupings, columns, ["actual_tch", "pred_tch"])
        summary = ranks.join_null_safe(summary, middle, keys, "left")
    measures = [c for c in summary.columns if c not in columns and c != "grouping"]
    return summary.select("grouping", *columns, *measures)


def grouped_medians(df: DataFrame, groupings: Sequence[tuple[str, Sequence[str]]], columns: list[str], values: list[str]) -> DataFrame:
    """Exact medians of several columns for several groupings; a column that is not part of a grouping is NULL there."""
    tall = df.select(*columns, *values).unpivot(columns, values, "_which", "_value").where(F.col("_value").isNotNull())
    sets = [
        F.struct(F.lit(name).alias("grouping"), *[(F.col(c) if c in group else F.lit(None).cast(df.schema[c].dataType)).alias(c) for c in columns])
        for name, group in groupings
    ]
    each = tall.select(F.explode(F.array(*sets)).alias("_set"), "_which", "_value").select("_set.*", "_which", "_value")
    keys = ["grouping", *columns]
    medians = ranks.exact_quantiles(each, [*keys, "_which"], "_value", {"_median": 0.5}, ["_which"])
    return medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_which") == v, F.col("_median"))).alias(f"{v}_median") for v in values]
    )


def tail_groupings(columns: Sequence[str]) -> list[tuple[str, list[str]]]:
    """The three fixed groupings and one for each context column present."""
    groups = [
        ("split_x_tch_range", ["split", "actual_tch_range"]),
        ("split_x_tail_group", ["split", "tail_group"]),
        ("split_x_zafra_x_tch_range", ["split", SEASON, "actual_tch_range"]),
    ]
    return groups + [(f"split_x_{c}_x_tail_group", ["split", c, "tail_group"]) for c in CONTEXT if c in columns]


def tail_error_report(predictions: DataFrame, min_rows: int = 30, exact: bool = True) -> DataFrame:
    """Error summary of the tails of the target, by split, season and context."""
    return error_summary(with_ranges(predictions), tail_groupings(predictions.columns), min_rows, exact)


def interval_metrics(predictions: DataFrame) -> DataFrame:
    """Coverage, width and crossing of the p10-p90 interval and error of p50, per split."""
    low, mid, high = (F.col(c) for c in QUANTILES)
    actual, rows = F.col("actual_tch"), F.count(F.lit(1))
    error = mid - actual
    summary = predictions.groupBy("split").agg(
        rows.alias("rows"),
        pct(F.count(F.when(actual.between(low, high), 1)), rows).alias("p10_p90_coverage_pct"),
        F.avg(high - low).alias("p10_p90_width_mean"),
        pct(F.count(F.when(low > high, 1)), rows).alias("quantile_crossing_pct"),
        F.avg(error).alias("p50_bias"),
        F.avg(F.abs(error)).alias("p50_mae"),
        rmse(error).alias("p50_rmse"),
    )
    widths = predictions.select("split", (high - low).alias("_width"))
    medians = ranks.exact_quantiles(widths, ["split"], "_width", {"p10_p90_width_median": 0.5})
    return ranks.join_null_safe(summary, medians, ["split"], "left")


def season_interval_metrics(predictions: DataFrame) -> DataFrame:
    """Season totals of the quantile forecasts against the actual total."""
    names = ("p10", "p50", "p90")
    sums = predictions.groupBy("split", SEASON).agg(
        total("actual_tch").alias("_actual"),
        *[total(q).alias(f"pred_tch_{n}_sum") for n, q in zip(names, QUANTILES)],
    )
    actual = F.col("_actual")
    low, high = F.col("pred_tch_p10_sum"), F.col("pred_tch_p90_sum")
    derived = {f"{n}_tch_sum_diff": F.col(f"pred_tch_{n}_sum") - actual for n in names}
    derived |= {
        f"{n}_tch_sum_pct_diff": F.try_divide(F.col(f"pred_tch_{n}_sum") - actual, actual) for n in names
    }
    derived |= {
        "p10_p90_tch_sum_width": high - low,
        "p10_p90_tch_sum_width_pct": F.try_divide(high - low, actual),
        "actual_tch_sum_within_p10_p90": actual.between(low, high),
    }
    return sums.withColumns(derived).drop("_actual")


def season_metrics(predictions: DataFrame, exact: bool = True) -> DataFrame:
    """Totals, area-weighted totals, means, medians and errors per split and season."""
    area = F.col("area") if "area" in predictions.columns else F.lit(None).cast("double")
    rows = predictions.withColumns(
        {
            "_actual_area": F.col("actual_tch") * area,
            "_pred_area": F.col("pred_tch") * area,
        }
    )
    keys = ["split", SEASON]
    medians = [] if exact else [
        F.approx_percentile(f"{side}_tch", 0.5).alias(f"{side}_tch_median") for side in ("actual", "pred")
    ]
    summary = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        total("actual_tch").alias("actual_tch_sum"),
        total("pred_tch").alias("pred_tch_sum"),
        total("_actual_area").alias("actual_area_weighted_tch_sum"),
        total("_pred_area").alias("pred_area_weighted_tch_sum"),
        F.avg("actual_tch").alias("actual_tch_mean"),
        F.avg("pred_tch").alias("pred_tch_mean"),
        *medians,
        *basic(),
        F.when(F.count(F.lit(1)) >= 2, r2(F.col("actual_tch"), F.col("pred_tch"))).alias("r2"),
    )
    if exact:
        middle = grouped_medians(predictions, [("season", keys)], keys, ["actual_tch", "pred_tch"])
        summary = ranks.join_null_safe(summary, middle.drop("grouping"), keys, "left")

    def diff(name: str, left: str, right: str, share: str) -> dict[str, Column]:
        gap = F.col(left) - F.col(right)
        return {name: gap, share: F.try_divide(gap, F.col(right))}

    return summary.withColumns(
        {
            **diff("tch_sum_diff", "pred_tch_sum", "actual_tch_sum", "tch_sum_pct_diff"),
            **diff(
                "area_weighted_tch_sum_diff", "pred_area_weighted_tch_sum",
                "actual_area_weighted_tch_sum", "area_weighted_tch_sum_pct_diff",
            ),
            **diff("tch_mean_error", "pred_tch_mean", "actual_tch_mean", "tch_mean_pct_error"),
        }
    )


def aggregate_season_metrics(seasons: DataFrame) -> DataFrame:
    """Season totals summed over all seasons and per split; the overall row is called ``all``."""
    actual, predicted = F.col("actual_tch_sum"), F.col("pred_tch_sum")
    diff = predicted - actual
    rows = seasons.groupingSets([[], ["split"]], "split").agg(
        F.grouping_id().alias("_gid"),
        F.count(F.lit(1)).alias("zafras"),
        F.sum(actual).alias("_actual"),
        F.sum(predicted).alias("_pred"),
        F.sum(diff).alias("tch_sum_diff"),
        F.avg(F.abs(diff)).alias("zafra_tch_sum_mae"),
        rmse(diff).alias("zafra_tch_sum_rmse"),
        F.avg(diff).alias("zafra_tch_sum_bias"),
        F.when(F.count(F.lit(1)) >= 2, r2(actual, predicted)).alias("aggregate_zafra_r2"),
    )
    return rows.select(
        F.when(F.col("_gid") == 1, F.lit("all")).otherwise(F.col("split")).alias("split"),
        "zafras",
        F.col("_actual").alias("actual_tch_sum"),
        F.col("_pred").alias("pred_tch_sum"),
        "tch_sum_diff",
        F.try_divide("tch_sum_diff", "_actual").alias("tch_sum_pct_diff"),
        "zafra_tch_sum_mae", "zafra_tch_sum_rmse", "zafra_tch_sum_bias", "aggregate_zafra_r2",
    )


def pct_difference(actual: Column, predicted: Column) -> Column:
    """Aggregate: percent by which the predicted total misses the actual one; 0 if that is 0."""
    a, p = F.coalesce(F.sum(actual), F.lit(0.0)), F.coalesce(F.sum(predicted), F.lit(0.0))
    return F.coalesce(F.try_divide((p - a) * 100.0, a), F.lit(0.0))


def walk_forward_metrics(folds: DataFrame) -> DataFrame:
    """Error and totals of the validation rows of each fold, with the size of its training rows.

    ``folds`` has ``fold``, ``role``, ``actual_tch`` and, for validation rows, ``pred_tch``.
    Folds missing one of the two roles are left out.
    """
    held = F.col("role") == "validation"
    a, p = F.when(held, F.col("actual_tch")), F.when(held, F.col("pred_tch"))
    rows = folds.groupBy(F.col("fold").alias("validation_zafra")).agg(
        rmse(p - a).alias("rmse"),
        F.avg(F.abs(p - a)).alias("mae"),
        r2(a, p).alias("r2"),
        F.avg(p - a).alias("bias"),
        F.count(F.when(~held, 1)).alias("train_rows"),
        F.count(F.when(held, 1)).alias("validation_rows"),
        F.sum(a).alias("actual_tch_sum"),
        F.sum(p).alias("pred_tch_sum"),
    ).where((F.col("train_rows") > 0) & (F.col("validation_rows") > 0))
    share = F.try_divide(F.col("pred_tch_sum") - F.col("actual_tch_sum"), F.col("actual_tch_sum"))
    return rows.withColumns(
        {
            "tch_sum_diff": F.col("pred_tch_sum") - F.col("actual_tch_sum"),
            "tch_sum_pct_diff": share,
            "abs_tch_sum_pct_diff": F.abs(share),
        }
    )


OBJECTIVES = ("auto", "lot_rmse", "walk_forward_r2", "aggregate_tch_sum")


def resolve_objective(mode: str, walk_forward: bool) -> str:
    """Objective to use; a mode that does not fit the validation scheme is an error."""
    if mode not in OBJECTIVES:
        raise ValueError(f"unknown objective {mode!r}, expected one of {OBJECTIVES}")
    if mode == "auto":
        return "walk_forward_r2" if walk_forward else "lot_rmse"
    if (mode == "walk_forward_r2" and not walk_forward) or (mode == "lot_rmse" and walk_forward):
        raise ValueError(f"objective {mode!r} does not fit walk_forward={walk_forward}")
    return mode


def objective_score(folds: DataFrame, mode: str, penalty: float, keys: Sequence[str] = ()) -> DataFrame:
    """Score over validation folds (or the one validation split), overall or per key.

    ``folds`` has rmse, r2 and the share by which totals differ. Only ``walk_forward_r2`` is better
    when larger.
    """
    spread = F.avg(F.abs(F.col("tch_sum_pct_diff"))) * 100.0
    scores = {
        "lot_rmse": F.avg("rmse"),
        "walk_forward_r2": F.avg("r2") - penalty * F.stddev_pop("r2"),
        "aggregate_tch_sum": F.avg("rmse") + penalty * spread,
    }
    return folds.groupBy(*keys).agg(
        F.avg("rmse").alias("mean_rmse"),
        F.avg("r2").alias("mean_r2"),
        F.stddev_pop("r2").alias("std_r2"),
        spread.alias("mean_abs_pct_diff"),
        scores[mode].alias("score"),
    )
