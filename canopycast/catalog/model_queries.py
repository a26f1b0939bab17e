"""Queries over models and the training run."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..config import KEY
from ..operators import models, reports, search
from ..operators.features import Matrix
from ..operators.splits import fold_table
from ..plans import training
from . import oracle as o
from .registry import Views, query
from .report_queries import EXTERNAL, SEASONS, TEST, TRAIN, VALIDATION

FEATURES = ["ndvi_peak", "rain_acc", "gap_mid", "trend"]
_F2 = ["rain_acc", "gap_mid"]
_MEDIANS = ", ".join(
    f"ifnull({c}, (SELECT median({c}) FROM feature_matrix WHERE split = 'train' AND tch IS NOT NULL)) AS {c}" for c in FEATURES
)
o.CTES["imputed"] = f"SELECT {KEY}, split, tch, {_MEDIANS} FROM feature_matrix"
# ridge with two features has a closed form on centred sums
o.CTES["ridge"] = """SELECT ((s22 + 10) * s1y - s12 * s2y) / d AS b1, ((s11 + 10) * s2y - s12 * s1y) / d AS b2, my - b1 * m1 - b2 * m2 AS b0 FROM (
 SELECT *, (s11 + 10) * (s22 + 10) - s12 * s12 AS d FROM (SELECT var_pop(rain_acc) * count(*) AS s11, var_pop(gap_mid) * count(*) AS s22,
 covar_pop(rain_acc, gap_mid) * count(*) AS s12, covar_pop(rain_acc, tch) * count(*) AS s1y, covar_pop(gap_mid, tch) * count(*) AS s2y,
 avg(rain_acc) AS m1, avg(gap_mid) AS m2, avg(tch) AS my FROM imputed WHERE split = 'train' AND tch IS NOT NULL))"""


def matrix(v: Views):
    return v.feature_matrix


def train_rows(v: Views):
    return matrix(v).where("split = 'train'")


def ridge(v: Views) -> models.Fitted:
    return models.fit_model(train_rows(v), _F2, "tch", "ridge", {"alpha": 10.0})


@query("median_impute", "SELECT * FROM imputed", ["tch", *FEATURES])
def _(v):
    medians = models.column_medians(train_rows(v).where("tch IS NOT NULL"), FEATURES)
    return models.median_impute(matrix(v).select(KEY, "split", "tch", *FEATURES), medians)


@query("fit_ridge", "SELECT 'intercept' AS term, b0 AS value FROM ridge UNION ALL SELECT 'rain_acc', b1 FROM ridge UNION ALL SELECT 'gap_mid', b2 FROM ridge", ["value"], 5)
def _(v):
    fitted = ridge(v)
    terms = [("intercept", fitted.model.intercept), *zip(_F2, [float(x) for x in fitted.model.coefficients])]
    return v.spark.createDataFrame(terms, "term string, value double")


@query("score_rows", f"SELECT {KEY}, split, tch AS actual_tch, b0 + b1 * rain_acc + b2 * gap_mid AS pred_tch FROM imputed, ridge", ["actual_tch", "pred_tch"], 4)
def _(v):
    return models.score_rows(ridge(v), matrix(v)).select(KEY, "split", "actual_tch", "pred_tch")


def _fit(v: Views, kind: str, **params):
    fitted = models.fit_model(train_rows(v), FEATURES, "tch", kind, params)
    rows = models.score_rows(fitted, matrix(v).where("tch IS NOT NULL"))
    return reports.regression_metrics(rows, ["split"])


@query("fit_forest")
def _(v):
    return _fit(v, "forest", n_estimators=20, max_depth=5)


@query("forest_quantiles")
def _(v):
    fitted = models.fit_model(train_rows(v), FEATURES, "tch", "forest", {"n_estimators": 20, "max_depth": 5})
    return models.forest_quantiles(fitted, matrix(v)).select(KEY, "split", *models.ALPHAS)


o.CTES["residuals"] = "SELECT " + ", ".join(
    f"quantile_cont(actual_tch - pred_tch, {a}) AS q{i}" for i, a in enumerate(models.ALPHAS.values())
) + " FROM predictions WHERE split = 'validation'"


@query(
    "interval_forecast",
    f"SELECT {KEY}, split, pred_tch, " + ", ".join(f"pred_tch + q{i} AS {n}" for i, n in enumerate(models.ALPHAS)) + " FROM predictions, residuals",
    ["pred_tch", *models.ALPHAS],
)
def _(v):
    rows = v.predictions.drop(*models.ALPHAS)
    return models.interval_forecast(rows).select(KEY, "split", "pred_tch", *models.ALPHAS)


def _prepare(part, whole):
    return whole, _F2, []


# ridge with two features in every fold: medians, centred sums, coefficients and errors per fold and penalty
_ALPHAS = (0.1, 1000.0, 1e6)
_FOLDS = ", ".join(f"('{fold}', '{season}', '{role}')" for fold, season, role in fold_table(SEASONS))
o.CTES["sp_rows"] = f"SELECT fold, role, tch, {', '.join(_F2)} FROM feature_matrix JOIN (VALUES {_FOLDS}) AS folds(fold, zafra_norm, role) USING (zafra_norm) WHERE tch IS NOT NULL"
o.CTES["sp_median"] = f"SELECT fold, {', '.join(f'median({c}) AS {c}' for c in _F2)} FROM sp_rows WHERE role = 'train' GROUP BY fold"
o.CTES["sp_full"] = f"SELECT fold, role, tch, {', '.join(f'coalesce(r.{c}, m.{c}) AS x{k}' for k, c in enumerate(_F2, 1))} FROM sp_rows r JOIN sp_median m USING (fold)"
o.CTES["sp_sums"] = """SELECT fold, var_pop(x1) * count(*) AS s11, var_pop(x2) * count(*) AS s22, covar_pop(x1, x2) * count(*) AS s12, covar_pop(x1, tch) * count(*) AS s1y,
 covar_pop(x2, tch) * count(*) AS s2y, avg(x1) AS m1, avg(x2) AS m2, avg(tch) AS my FROM sp_full WHERE role = 'train' GROUP BY fold"""
o.CTES["sp_fit"] = f"""SELECT *, my - b1 * m1 - b2 * m2 AS b0 FROM (
 SELECT *, ((s22 + a) * s1y - s12 * s2y) / ((s11 + a) * (s22 + a) - s12 * s12) AS b1, ((s11 + a) * s2y - s12 * s1y) / ((s11 + a) * (s22 + a) - s12 * s12) AS b2
 FROM sp_sums, (VALUES {', '.join(f'({k}, {a})' for k, a in enumerate(_ALPHAS))}) AS alphas(trial, a))"""
o.CTES["sp_errors"] = """SELECT trial, fold, sqrt(avg(power(p - tch, 2))) AS rmse, 1 - sum(power(p - tch, 2)) / (var_pop(tch) * count(*)) AS r2, (sum(p) - sum(tch)) / sum(tch) AS diff
FROM (SELECT trial, fold, tch, b0 + b1 * x1 + b2 * x2 AS p FROM sp_full JOIN sp_fit USING (fold) WHERE role = 'validation') GROUP BY trial, fold"""


@query(
    "search_params",
    f"""SELECT trial, CASE trial {' '.join(f"WHEN {k} THEN '{json.dumps({'alpha': a})}'" for k, a in enumerate(_ALPHAS))} END AS params, 'walk_forward_r2' AS objective,
 count(*) AS folds, avg(rmse) AS mean_rmse, avg(r2) AS mean_r2, stddev_pop(r2) AS std_r2, avg(abs(diff)) * 100 AS mean_abs_pct_diff, avg(r2) - 0.5 * stddev_pop(r2) AS score
FROM sp_errors GROUP BY trial""",
    ["mean_rmse", "mean_r2", "std_r2", "mean_abs_pct_diff", "score"],
    5,
)
def _(v):
    """Three penalties in the walk-forward folds of all seasons."""
    rows = matrix(v).where("tch IS NOT NULL")
    return search.search(rows, _prepare, "tch", "ridge", [{"alpha": a} for a in _ALPHAS], "walk_forward_r2", 0.5, SEASONS)[1]


def _rise(feature: str, x1: str, x2: str) -> str:
    error = "sqrt(avg(power(b0 + b1 * {} + b2 * {} - tch, 2)))"
    return f"SELECT '{feature}' AS feature, {error.format(x1, x2)} - {error.format('rain_acc', 'gap_mid')} AS rmse_increase FROM mated, ridge"


# the next row in the order of a hash lends its value, the first one to the last
o.CTES["placed"] = f"SELECT *, row_number() OVER (ORDER BY md5('42:' || {KEY}), {KEY}) AS place FROM imputed WHERE split = 'test' AND tch IS NOT NULL"
o.CTES["mated"] = "SELECT a.*, b.rain_acc AS other1, b.gap_mid AS other2 FROM placed a JOIN placed b ON b.place = a.place % (SELECT count(*) FROM placed) + 1"


@query("permutation_importance", f"{_rise('rain_acc', 'other1', 'gap_mid')} UNION ALL {_rise('gap_mid', 'rain_acc', 'other2')}", ["rmse_increase"], 4)
def _(v):
    return models.permutation_importance(ridge(v), matrix(v).where("split = 'test'"))


def run(v: Views, **more) -> training.Run:
    df = matrix(v).drop("split").where("tch IS NOT NULL")
    m = Matrix(df, [*FEATURES, "area"], ["prod_ingenio", "prod_variedad", "prod_finca"], [KEY, "cod_cg", "zafra_norm", "area", "prod_ingenio"])
    options = training.Options(
        train=TRAIN, validation=VALIDATION, test=TEST, external=EXTERNAL, walk_forward=True, **more
    )
    return training.train(m, options)


@query("training_run")
def _(v):
    """Season metrics of a ridge run with encoded text columns, quantiles and walk-forward folds."""
    done = run(v, params={"alpha": 1.0})
    folds = done.reports["walk_forward_metrics"].select(F.col("validation_zafra").alias("zafra_norm"), "rmse", "r2")
    seasons = done.reports["metrics_by_zafra"]
    return seasons.withColumn("report", F.lit("season")).unionByName(
        folds.withColumn("report", F.lit("fold")), allowMissingColumns=True
    )
