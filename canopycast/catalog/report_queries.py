"""Queries over splits and forecast-error reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import SEASON
from ..operators import ranks, reports, splits
from . import oracle as o
from .registry import Views, query

SEASONS = tuple(f"{y}_{y + 1}" for y in range(1995, 2002))
TRAIN, VALIDATION, TEST, EXTERNAL = SEASONS[:4], SEASONS[4:5], SEASONS[5:6], SEASONS[6:]

o.CTES["scored"] = """SELECT *, pred_tch - actual_tch AS tch_error, abs(pred_tch - actual_tch) AS tch_abs_error,
 CASE WHEN actual_tch <> 0 THEN (pred_tch - actual_tch) / actual_tch END AS tch_pct_error FROM predictions"""
_RANGE = "CASE " + " ".join(
    f"WHEN actual_tch <= {limit} THEN '{label}'" for limit, label in zip(reports.RANGE_LIMITS, reports.RANGE_LABELS)
) + " WHEN actual_tch IS NOT NULL THEN '>130' END"
o.CTES["ranged"] = f"""SELECT *, {_RANGE} AS actual_tch_range,
 CASE WHEN actual_tch <= 85 THEN 'low' WHEN actual_tch <= 115 THEN 'middle' WHEN actual_tch > 115 THEN 'high' END AS tail_group FROM scored"""
_WITHIN = ", ".join(
    f"100.0 * count(*) FILTER (tch_abs_error <= {t}) / count(*) AS pct_within_{t}_tch" for t in reports.TOLERANCES
)
_BASIC = "avg(tch_error) AS tch_bias, avg(tch_abs_error) AS tch_mae, sqrt(avg(tch_error ** 2)) AS tch_rmse"
_WITHIN_NAMES = [f"pct_within_{t}_tch" for t in reports.TOLERANCES]
_BASIC_NAMES = ["tch_bias", "tch_mae", "tch_rmse"]
_SUMMARY = f"""count(*) AS rows, avg(actual_tch) AS actual_tch_mean, avg(pred_tch) AS pred_tch_mean,
 median(actual_tch) AS actual_tch_median, median(pred_tch) AS pred_tch_median,
 100.0 * count(*) FILTER (tch_error > 0) / count(*) AS overprediction_pct,
 100.0 * count(*) FILTER (tch_error < 0) / count(*) AS underprediction_pct, {_BASIC}, {_WITHIN}"""
_SUMMARY_NAMES = [
    "actual_tch_mean", "pred_tch_mean", "actual_tch_median", "pred_tch_median", "overprediction_pct",
    "underprediction_pct", *_BASIC_NAMES, *_WITHIN_NAMES,
]
_ERRORS = ["tch_error", "tch_abs_error", "tch_pct_error"]
_PREDICTED = ["area", "actual_tch", "pred_tch", "pred_tch_p10", "pred_tch_p50", "pred_tch_p90"]


def r2_sql(actual: str, predicted: str, where: str = "true") -> str:
    sse = f"sum(({predicted} - {actual}) ** 2) FILTER ({where})"
    return f"1 - {sse} / nullif(var_pop({actual}) FILTER ({where}) * count({actual}) FILTER ({where}), 0)"


def scored(v: Views):
    return reports.prediction_error(v.predictions)


@query("prediction_error", "SELECT * FROM scored", [*_PREDICTED, *_ERRORS])
def _(v):
    return scored(v)


@query("bin_target", "SELECT cod_cg_zafra, actual_tch_range, tail_group FROM ranged")
def _(v):
    return reports.with_ranges(v.predictions).select("cod_cg_zafra", "actual_tch_range", "tail_group")


@query(
    "regression_metrics",
    f"""SELECT sqrt(avg(tch_error ** 2)) AS rmse, avg(tch_abs_error) AS mae, {r2_sql('actual_tch', 'pred_tch')} AS r2,
    avg(tch_error) AS bias FROM scored""",
    ["rmse", "mae", "r2", "bias"],
)
def _(v):
    return reports.regression_metrics(v.predictions)


@query(
    "lot_error_metrics",
    f"SELECT split, count(*) AS rows, {_BASIC}, {_WITHIN} FROM scored GROUP BY split",
    [*_BASIC_NAMES, *_WITHIN_NAMES],
)
def _(v):
    return reports.lot_error_metrics(scored(v))


@query(
    "range_metrics",
    f"""SELECT s.split, l.label AS actual_tch_range, ifnull(m.rows, 0) AS rows, m.* EXCLUDE (split, actual_tch_range, rows)
    FROM (SELECT DISTINCT split FROM scored) s CROSS JOIN (SELECT unnest({list(reports.RANGE_LABELS)}) AS label) l
    LEFT JOIN (SELECT split, actual_tch_range, count(*) AS rows, avg(actual_tch) AS actual_tch_mean, avg(pred_tch) AS pred_tch_mean,
    {_BASIC}, {_WITHIN} FROM ranged GROUP BY split, actual_tch_range) m ON m.split = s.split AND m.actual_tch_range = l.label""",
    ["actual_tch_mean", "pred_tch_mean", *_BASIC_NAMES, *_WITHIN_NAMES],
)
def _(v):
    return reports.range_metrics(scored(v))


@query(
    "error_summary",
    f"SELECT 'by_season' AS \"grouping\", zafra_norm, prod_ingenio, {_SUMMARY} FROM scored GROUP BY zafra_norm, prod_ingenio",
    _SUMMARY_NAMES,
)
def _(v):
    return reports.error_summary(scored(v), [("by_season", [SEASON, "prod_ingenio"])])


_TAIL_COLUMNS = ["split", "actual_tch_range", "tail_group", SEASON, "prod_ingenio", "prod_no_corte", "prod_grupo_de_humedad"]
_TAIL = " UNION ALL ".join(
    f"SELECT '{name}' AS \"grouping\", "
    + ", ".join(c if c in group else f"NULL AS {c}" for c in _TAIL_COLUMNS)
    + f", {_SUMMARY} FROM ranged GROUP BY {', '.join(group)} HAVING count(*) >= 30"
    for name, group in reports.tail_groupings(_TAIL_COLUMNS)
)


@query("tail_error_report", _TAIL, _SUMMARY_NAMES)
def _(v):
    return reports.tail_error_report(scored(v))


@query(
    "multi_grouping",
    f"""SELECT 'by_split' AS "grouping", split, prod_variedad, {_SUMMARY} FROM joined GROUP BY split HAVING count(*) >= 30
    UNION ALL SELECT 'by_variety', NULL, prod_variedad, {_SUMMARY} FROM joined GROUP BY prod_variedad HAVING count(*) >= 30""".replace(
        "split, prod_variedad, count", "split, NULL AS prod_variedad, count", 1
    ).replace("FROM joined", "FROM (SELECT s.*, p.variedad AS prod_variedad FROM scored s JOIN productividad p USING (cod_cg_zafra))"),
    _SUMMARY_NAMES,
)
def _(v):
    # the variety is NULL in places, so a NULL group and a rolled-up column both occur
    variety = v.productividad.select("cod_cg_zafra", F.col("variedad").alias("prod_variedad"))
    rows = scored(v).join(variety, "cod_cg_zafra")
    return reports.error_summary(rows, [("by_split", ["split"]), ("by_variety", ["prod_variedad"])], 30)


_INTERVAL = [
    "p10_p90_coverage_pct", "p10_p90_width_mean", "quantile_crossing_pct", "p50_bias", "p50_mae", "p50_rmse",
    "p10_p90_width_median",
]


@query(
    "interval_metrics",
    """SELECT split, count(*) AS rows,
    100.0 * count(*) FILTER (actual_tch >= pred_tch_p10 AND actual_tch <= pred_tch_p90) / count(*) AS p10_p90_coverage_pct,
    avg(pred_tch_p90 - pred_tch_p10) AS p10_p90_width_mean, median(pred_tch_p90 - pred_tch_p10) AS p10_p90_width_median,
    100.0 * count(*) FILTER (pred_tch_p10 > pred_tch_p90) / count(*) AS quantile_crossing_pct,
    avg(pred_tch_p50 - actual_tch) AS p50_bias, avg(abs(pred_tch_p50 - actual_tch)) AS p50_mae,
    sqrt(avg((pred_tch_p50 - actual_tch) ** 2)) AS p50_rmse FROM predictions GROUP BY split""",
    _INTERVAL,
)
def _(v):
    return reports.interval_metrics(v.predictions)


_Q = ("p10", "p50", "p90")
_SEASON_INTERVAL = (
    "SELECT split, zafra_norm, "
    + ", ".join(f"{q} AS pred_tch_{q}_sum, {q} - a AS {q}_tch_sum_diff, ({q} - a) / a AS {q}_tch_sum_pct_diff" for q in _Q)
    + ", p90 - p10 AS p10_p90_tch_sum_width, (p90 - p10) / a AS p10_p90_tch_sum_width_pct, a BETWEEN p10 AND p90 AS actual_tch_sum_within_p10_p90"
    " FROM (SELECT split, zafra_norm, sum(actual_tch) AS a, " + ", ".join(f"sum(pred_tch_{q}) AS {q}" for q in _Q)
    + " FROM predictions GROUP BY ALL)"
)
_SEASON_INTERVAL_NAMES = (
    [f"pred_tch_{q}_sum" for q in _Q] + [f"{q}_tch_sum_diff" for q in _Q] + [f"{q}_tch_sum_pct_diff" for q in _Q]
    + ["p10_p90_tch_sum_width", "p10_p90_tch_sum_width_pct"]
)


@query("season_interval_metrics", _SEASON_INTERVAL, _SEASON_INTERVAL_NAMES, 4)
def _(v):
    return reports.season_interval_metrics(v.predictions)


o.CTES["seasons"] = f"""SELECT *, pred_tch_sum - actual_tch_sum AS tch_sum_diff, (pred_tch_sum - actual_tch_sum) / actual_tch_sum AS tch_sum_pct_diff,
 pred_area_weighted_tch_sum - actual_area_weighted_tch_sum AS area_weighted_tch_sum_diff,
 (pred_area_weighted_tch_sum - actual_area_weighted_tch_sum) / actual_area_weighted_tch_sum AS area_weighted_tch_sum_pct_diff,
 pred_tch_mean - actual_tch_mean AS tch_mean_error, (pred_tch_mean - actual_tch_mean) / actual_tch_mean AS tch_mean_pct_error
 FROM (SELECT split, zafra_norm, count(*) AS rows, sum(actual_tch) AS actual_tch_sum, sum(pred_tch) AS pred_tch_sum,
 sum(actual_tch * area) AS actual_area_weighted_tch_sum, sum(pred_tch * area) AS pred_area_weighted_tch_sum,
 avg(actual_tch) AS actual_tch_mean, avg(pred_tch) AS pred_tch_mean, median(actual_tch) AS actual_tch_median,
 median(pred_tch) AS pred_tch_median, {_BASIC}, {r2_sql('actual_tch', 'pred_tch')} AS r2 FROM scored GROUP BY split, zafra_norm)"""
SEASON_NAMES = [
    "actual_tch_sum", "pred_tch_sum", "actual_area_weighted_tch_sum", "pred_area_weighted_tch_sum", "actual_tch_mean",
    "pred_tch_mean", "actual_tch_median", "pred_tch_median", *_BASIC_NAMES, "r2", "tch_sum_diff", "tch_sum_pct_diff",
    "area_weighted_tch_sum_diff", "area_weighted_tch_sum_pct_diff", "tch_mean_error", "tch_mean_pct_error",
]


@query("season_metrics", "SELECT * FROM seasons", SEASON_NAMES, 4)
def _(v):
    return reports.season_metrics(scored(v))


_AGGREGATE = f"""count(*) AS zafras, sum(actual_tch_sum) AS actual_tch_sum, sum(pred_tch_sum) AS pred_tch_sum,
 sum(tch_sum_diff) AS tch_sum_diff, sum(tch_sum_diff) / nullif(sum(actual_tch_sum), 0) AS tch_sum_pct_diff,
 avg(abs(tch_sum_diff)) AS zafra_tch_sum_mae, sqrt(avg(tch_sum_diff ** 2)) AS zafra_tch_sum_rmse, avg(tch_sum_diff) AS zafra_tch_sum_bias,
 CASE WHEN count(*) > 1 THEN {r2_sql('s.actual_tch_sum', 's.pred_tch_sum')} END AS aggregate_zafra_r2 FROM seasons s"""


@query(
    "aggregate_season_metrics",
    f"SELECT 'all' AS split, {_AGGREGATE} UNION ALL SELECT split, {_AGGREGATE} GROUP BY split",
    ["actual_tch_sum", "pred_tch_sum", "tch_sum_diff", "tch_sum_pct_diff", "zafra_tch_sum_mae", "zafra_tch_sum_rmse",
     "zafra_tch_sum_bias", "aggregate_zafra_r2"],
    4,
)
def _(v):
    return reports.aggregate_season_metrics(reports.season_metrics(scored(v)))


@query(
    "aggregate_pct_diff",
    """SELECT split, 100 * (sum(pred_tch) / sum(actual_tch) - 1) AS pct_diff FROM predictions GROUP BY split
    UNION ALL SELECT 'zero', 0""",
    ["pct_diff"],
)
def _(v):
    diff = reports.pct_difference(F.col("actual_tch"), F.col("pred_tch")).alias("pct_diff")
    zero = v.predictions.select(F.lit("zero").alias("split"), (F.col("actual_tch") * 0).alias("actual_tch"), "pred_tch")
    return v.predictions.groupBy("split").agg(diff).unionByName(zero.groupBy("split").agg(diff))


# ---------------------------------------------------------------- splits and folds

_IN = {n: ", ".join(f"'{s}'" for s in names) for n, names in (("train", TRAIN), ("validation", VALIDATION), ("test", TEST[:1]), ("external", EXTERNAL))}


@query(
    "temporal_split",
    f"""SELECT cod_cg_zafra, zafra_norm, CASE WHEN zafra_norm IN ({_IN['train']}) THEN 'train' WHEN zafra_norm IN ({_IN['validation']}) THEN 'validation'
    WHEN zafra_norm IN ({_IN['test']}) THEN 'test' END AS split FROM predictions""",
)
def _(v):
    rows = v.predictions.select("cod_cg_zafra", SEASON)
    return splits.temporal_split(rows, TRAIN, VALIDATION, TEST)


@query(
    "external_holdout",
    f"""SELECT cod_cg_zafra, zafra_norm, CASE WHEN zafra_norm IN ({_IN['external']}, '1996_1997') THEN 'external'
    WHEN zafra_norm IN ({_IN['train']}) THEN 'train' WHEN zafra_norm IN ({_IN['validation']}) THEN 'validation'
    WHEN zafra_norm IN ({_IN['test']}) THEN 'test' END AS split FROM predictions""",
)
def _(v):
    rows = v.predictions.select("cod_cg_zafra", SEASON)
    rows = splits.temporal_split(rows, TRAIN, VALIDATION, TEST, [*EXTERNAL, "1996_1997"])
    splits.require_splits(rows)
    return rows


o.CTES["folded"] = """SELECT p.*, f.fold, CASE WHEN p.zafra_norm = f.fold THEN 'validation' ELSE 'train' END AS role FROM predictions p
 JOIN (SELECT DISTINCT zafra_norm AS fold FROM predictions WHERE zafra_norm BETWEEN '1996_1997' AND '2000_2001') f
 ON p.zafra_norm <= f.fold AND p.zafra_norm >= '1995_1996'"""


@query("walk_forward_folds", "SELECT cod_cg_zafra, fold, role FROM folded")
def _(v):
    return splits.walk_forward_folds(v.predictions, SEASONS[:6]).select("cod_cg_zafra", "fold", "role")


_HELD = "role = 'validation'"
o.CTES["fold_metrics"] = f"""SELECT fold AS validation_zafra, sqrt(avg((pred_tch - actual_tch) ** 2) FILTER ({_HELD})) AS rmse,
 avg(abs(pred_tch - actual_tch)) FILTER ({_HELD}) AS mae, {r2_sql('actual_tch', 'pred_tch', _HELD)} AS r2,
 avg(pred_tch - actual_tch) FILTER ({_HELD}) AS bias, count(*) FILTER (role = 'train') AS train_rows, count(*) FILTER ({_HELD}) AS validation_rows,
 sum(actual_tch) FILTER ({_HELD}) AS actual_tch_sum, sum(pred_tch) FILTER ({_HELD}) AS pred_tch_sum,
 sum(pred_tch - actual_tch) FILTER ({_HELD}) AS tch_sum_diff, tch_sum_diff / actual_tch_sum AS tch_sum_pct_diff,
 abs(tch_sum_pct_diff) AS abs_tch_sum_pct_diff FROM folded GROUP BY fold"""


def fold_metrics(v: Views):
    return reports.walk_forward_metrics(splits.walk_forward_folds(v.predictions, SEASONS[:6]))


@query(
    "walk_forward_metrics",
    "SELECT * FROM fold_metrics",
    ["rmse", "mae", "r2", "bias", "actual_tch_sum", "pred_tch_sum", "tch_sum_diff", "tch_sum_pct_diff", "abs_tch_sum_pct_diff"],
    4,
)
def _(v):
    return fold_metrics(v)


@query(
    "objective_score",
    " UNION ALL ".join(
        f"SELECT '{mode}' AS objective, {score} AS score FROM fold_metrics"
        for mode, score in (
            ("lot_rmse", "avg(rmse)"),
            ("walk_forward_r2", "avg(r2) - 0.5 * stddev_pop(r2)"),
            ("aggregate_tch_sum", "avg(rmse) + 2 * avg(100 * abs_tch_sum_pct_diff)"),
        )
    ),
    ["score"],
)
def _(v):
    folds = fold_metrics(v)
    result = None
    for mode, penalty in (("lot_rmse", 0.0), ("walk_forward_r2", 0.5), ("aggregate_tch_sum", 2.0)):
        score = reports.objective_score(folds, mode, penalty).select(F.lit(mode).alias("objective"), "score")
        result = score if result is None else result.unionByName(score)
    return result


@query(
    "avg_rank",
    "SELECT split, pred_tch, count(*) AS n, any_value(r) AS avg_rank FROM (SELECT split, pred_tch, rank() OVER w + (count(*) OVER (PARTITION BY split, pred_tch) - 1) / 2.0 AS r"
    " FROM (SELECT split, floor(pred_tch * 4) AS pred_tch FROM predictions) WINDOW w AS (PARTITION BY split ORDER BY pred_tch)) GROUP BY split, pred_tch",
    ["avg_rank", "pred_tch"],
)
def _(v):
    rows = v.predictions.select("split", F.floor(F.col("pred_tch") * 4).cast("double").alias("pred_tch"))
    return ranks.average_ranks(rows, ["split"], "pred_tch")


@query(
    "union_reports",
    """SELECT split, zafra_norm, rows, tch_sum_diff, NULL AS tch_bias FROM seasons UNION ALL
    SELECT split, NULL, count(*), NULL, avg(tch_error) FROM scored GROUP BY split""",
    ["tch_sum_diff", "tch_bias"],
    4,
)
def _(v):
    rows = scored(v)
    left = reports.season_metrics(rows).select("split", SEASON, "rows", "tch_sum_diff")
    right = reports.lot_error_metrics(rows).select("split", "rows", "tch_bias")
    return left.unionByName(right, allowMissingColumns=True)


@query(
    "evidence_join",
    f"SELECT s.split, s.zafra_norm, s.tch_sum_pct_diff, q.p50_tch_sum_pct_diff, q.p10_p90_tch_sum_width FROM seasons s LEFT JOIN ({_SEASON_INTERVAL}) q USING (split, zafra_norm)",
    ["tch_sum_pct_diff", "p50_tch_sum_pct_diff", "p10_p90_tch_sum_width"],
    4,
)
def _(v):
    seasons, quantiles = reports.season_metrics(scored(v)), reports.season_interval_metrics(v.predictions)
    return ranks.join_null_safe(seasons, quantiles, ["split", SEASON], "left").select(
        "split", SEASON, "tch_sum_pct_diff", "p50_tch_sum_pct_diff", "p10_p90_tch_sum_width"
    )


@query(
    "report_order",
    f"SELECT split, zafra_norm, rows, r2 FROM seasons",
    ["r2"],
)
def _(v):
    rows = reports.season_metrics(scored(v)).select("split", SEASON, "rows", "r2")
    return rows.orderBy(F.col("r2").desc_nulls_last(), "split", SEASON)
