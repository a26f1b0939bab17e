"""Regressors: fit, score, intervals, parameter search and importance."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..config import KEY
from ..sources.staging import staged, staged_path, together
from . import boosting
from .diagnose import column_medians
from .encode import Statistics, apply_statistics, category_statistics, check_mode, ordered_statistics
from .ranks import exact_quantiles, join_null_safe

FEATURES, PREDICTION = "_features", "pred_tch"
#: Boosted trees grown by levels, by leaves, and with random strength on text columns as they are.
BOOSTED = ("boosted", "leafwise", "ordered")
MODELS = ("ridge", "forest", *BOOSTED)
ALPHAS = {"pred_tch_p10": 0.10, "pred_tch_p50": 0.50, "pred_tch_p90": 0.90}
SEED = 42
#: Of Spark's trees.
MAX_DEPTH = 30
#: Nodes of a forest whose leaves go to every task.
MOST_NODES = 2_000_000

# Search ranges (low, high, scale) of each model.
SPACES = {
    "ridge": {"alpha": (1e-3, 1e3, "log")},
    "forest": {"n_estimators": (200, 800, "int"), "max_depth": (3, 30, "int"), "min_samples_leaf": (1, 20, "int")},
    "boosted": {
        "n_estimators": (200, 1200, "int"), "max_depth": (3, 10, "int"), "learning_rate": (1e-3, 0.2, "log"),
        "subsample": (0.6, 1.0, "real"), "colsample_bytree": (0.6, 1.0, "real"), "min_child_weight": (1.0, 20.0, "real"),
        "reg_alpha": (1e-8, 10.0, "log"), "reg_lambda": (1e-4, 20.0, "log"),
    },
    "leafwise": {
        "n_estimators": (200, 1200, "int"), "num_leaves": (16, 256, "int"), "max_depth": (3, 12, "int"),
        "learning_rate": (1e-3, 0.2, "log"), "subsample": (0.6, 1.0, "real"), "colsample_bytree": (0.6, 1.0, "real"),
        "min_child_samples": (5, 100, "int"), "reg_alpha": (1e-8, 10.0, "log"), "reg_lambda": (1e-4, 20.0, "log"),
    },
    "ordered": {
        "iterations": (300, 800, "int"), "depth": (3, 10, "int"), "learning_rate": (1e-3, 0.2, "log"),
        "l2_leaf_reg": (1e-3, 20.0, "log"), "random_strength": (1e-3, 10.0, "log"),
    },
}
DEFAULTS = {
    "boosted": {"max_depth": 5, "learning_rate": 0.1},
    "leafwise": {"max_depth": 12, "num_leaves": 31, "min_samples_leaf": 20, "reg_lambda": 0.0},
    "ordered": {"max_depth": 6, "learning_rate": 0.03, "reg_lambda": 3.0, "random_strength": 1.0},
}
#: Parameters of the quantile trees of models that are not boosted themselves.
QUANTILE_PARAMS = {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 3, "reg_lambda": 0.0}


@dataclass(frozen=True)
class Fitted:
    """A fitted regressor with the columns and fill values it needs."""

    kind: str
    model: Model | boosting.Boosted
    features: list[str]
    medians: dict[str, float]
    statistics: Statistics | None = None
    texts: tuple[str, ...] = ()

    def vectors(self, df: DataFrame) -> DataFrame:
        rows = apply_statistics(df, self.statistics, self.texts) if self.texts else df
        return vectors(rows, self.features, self.medians, self.texts)


def median_impute(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """Fill missing values with the medians of the training rows; columns without any get 0."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in medians.items()})


def vectors(df: DataFrame, features: Sequence[str], medians: Mapping[str, float], texts: Sequence[str] = ()) -> DataFrame:
    """Assembled features; what has no median and is missing becomes NaN. Text features enter by their statistics (``_stat_<column>``)."""
    inputs = [f"_stat_{c}" if c in texts else c for c in features]
    rows = median_impute(df, medians)
    return VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="keep").transform(rows).drop(*[f"_stat_{c}" for c in texts])


def build_model(kind: str, params: Mapping, target: str, rows: int = 0, deviation: float = 0.0):
    """Unfitted regressor. Ridge needs the number of rows and the population deviation of the target.

    Ridge takes ``solver`` from the parameters: ``normal``, the default, holds one number per pair of columns on the driver
    and Spark refuses more than 4096 columns; ``l-bfgs`` takes any number.
    """
    common = {"featuresCol": FEATURES, "labelCol": target, "predictionCol": PREDICTION}
    if kind == "ridge":
        solver = params.get("solver", "normal")
        if solver not in ("normal", "l-bfgs"):
            raise ValueError(f"unknown ridge solver {solver!r}")
        # Spark divides the label by its deviation: the population one in the normal equation
        scale = deviation if solver == "normal" or rows < 2 else deviation * math.sqrt(rows / (rows - 1))
        return LinearRegression(
            **common, elasticNetParam=0.0, standardization=False, solver=solver,
            regParam=float(params.get("alpha", 1.0)) / max(rows, 1) * scale,
        )
    leaf, depth = int(params.get("min_samples_leaf", 1)), int(params.get("max_depth", 12))
    if depth > MAX_DEPTH:
        raise ValueError(f"max_depth is at most {MAX_DEPTH}, not {depth}")
    if kind == "forest":
        return RandomForestRegressor(
            **common, numTrees=int(params.get("n_estimators", 100)), maxDepth=depth,
            minInstancesPerNode=leaf, featureSubsetStrategy="all", seed=SEED,
        )
    raise ValueError(f"unknown model {kind!r}, expected one of {MODELS}")


@dataclass(frozen=True)
class Prepared:
    """Training rows as a kind of model reads them, written once for any number of fits."""

    kind: str
    features: list[str]
    target: str
    data: DataFrame | boosting.Binned
    medians: dict[str, float]
    statistics: Statistics | None
    texts: tuple[str, ...]
    rows: int = 0
    deviation: float = 0.0


def prepare_fit(
    train: DataFrame, features: Sequence[str], target: str, kind: str, complete: Sequence[str] = (), max_bins: int = boosting.Settings.max_bins
) -> Prepared:
    """What does not depend on the parameters: medians, statistics of text features, ranges of boosted trees. Rows without a target are left out."""
    rows, statistics, texts = _with_statistics(train.where(F.col(target).isNotNull()), features, target, kind)
    if kind in BOOSTED:
        columns = [f"_stat_{c}" if c in texts else c for c in features]
        data = boosting.bin_rows(rows, columns, target, max_bins, KEY if KEY in rows.columns else None)
        return Prepared(kind, list(features), target, data, {}, statistics, texts)
    gaps = [c for c in features if c not in {*complete, *texts}]
    medians = column_medians(rows, gaps) if gaps else {}
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(target).alias("sd")).first()
    data = staged(vectors(rows, features, medians, texts).select(FEATURES, target), "vectors")
    return Prepared(kind, list(features), target, data, medians, statistics, texts, stats["n"], stats["sd"] or 0.0)


def fit_prepared(p: Prepared, params: Mapping | None = None) -> Fitted:
    if p.kind in BOOSTED:
        model = boosting.fit_binned(p.data, {"seed": SEED, **DEFAULTS[p.kind], **_named(params or {}), "max_bins": p.data.bins})
    else:
        model = build_model(p.kind, params or {}, p.target, p.rows, p.deviation).fit(p.data)
    return Fitted(p.kind, model, p.features, p.medians, p.statistics, p.texts)


def fit_model(
    train: DataFrame, features: Sequence[str], target: str, kind: str, params: Mapping | None = None,
    complete: Sequence[str] = (),
) -> Fitted:
    """Fit on rows with a target.

    Ridge and forest take the median of the training rows for a missing feature; boosted trees send it to the better side.
    ``complete`` names features that are never missing, such as 0/1 columns. Trees take text features by statistics of the
    target: in training those of the rows before, in scoring those of all training rows.
    """
    return fit_prepared(prepare_fit(train, features, target, kind, complete, int((params or {}).get("max_bins", boosting.Settings.max_bins))), params)


def _with_statistics(rows: DataFrame, features: Sequence[str], target: str, kind: str) -> tuple[DataFrame, Statistics | None, tuple[str, ...]]:
    """Training rows with the ordered statistics of their text features."""
    texts = tuple(c for c in features if isinstance(rows.schema[c].dataType, (T.StringType, T.BooleanType)))
    if not texts:
        return rows, None, texts
    check_mode("native", kind)
    found = category_statistics(rows, texts, target)
    return staged(ordered_statistics(rows, texts, target, KEY, found, SEED), "statistics-of-rows"), found, texts


def _named(params: Mapping) -> dict:
    return {boosting.ALIASES.get(k, k): v for k, v in params.items()}


def score_rows(fitted: Fitted, df: DataFrame, target: str = "tch") -> DataFrame:
    """Predictions of every row in one pass, with ``actual_tch``; rows without target are scored too."""
    rows = fitted.model.transform(fitted.vectors(df)).drop(FEATURES)
    return rows.withColumnRenamed(target, "actual_tch")


def save_model(fitted: Fitted, path: str) -> None:
    spark = SparkSession.active()
    if fitted.kind in BOOSTED:
        _one_text(spark, fitted.model.text(), f"{path}/model")
    else:
        fitted.model.write().overwrite().save(f"{path}/model")
    if fitted.statistics:
        fitted.statistics.table.write.mode("overwrite").parquet(f"{path}/statistics")
    found = {"kind": fitted.kind, "features": fitted.features, "medians": fitted.medians, "texts": fitted.texts}
    _one_text(spark, json.dumps(found | {"mean": fitted.statistics.mean if fitted.statistics else None}), f"{path}/inputs")


def _one_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_model(spark: SparkSession, path: str) -> Fitted:
    from pyspark.ml.regression import LinearRegressionModel, RandomForestRegressionModel

    found = json.loads(spark.read.text(f"{path}/inputs").first()["value"])
    if found["kind"] in BOOSTED:
        model = boosting.Boosted.read(spark.read.text(f"{path}/model").first()["value"])
    else:
        model = {"ridge": LinearRegressionModel, "forest": RandomForestRegressionModel}[found["kind"]].load(f"{path}/model")
    statistics = Statistics(spark.read.parquet(f"{path}/statistics"), found["mean"]) if found["texts"] else None
    return Fitted(found["kind"], model, found["features"], found["medians"], statistics, tuple(found["texts"]))


# ---------------------------------------------------------------- intervals


LEAVES = "_leaves"


def forest_leaves(model: Model) -> DataFrame:
    """(tree, leaf, prediction) of a fitted forest; ``leaf`` is the number that Spark's leaf column holds."""
    spark = SparkSession.active()
    path = staged_path(spark, "forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    # Spark numbers the leaves of a tree in the order of a walk from the left, as its node ids run
    order = Window.partitionBy("treeID").orderBy("id")
    leaves = nodes.where("leftChild < 0").withColumn("leaf", (F.row_number().over(order) - 1).cast("double"))
    return leaves.select(F.col("treeID").alias("tree"), "leaf", "prediction")


def forest_quantiles(fitted: Fitted, df: DataFrame, alphas: Mapping[str, float] = ALPHAS, most_nodes: int = MOST_NODES) -> DataFrame:
    """Quantiles over the predictions of the trees, linearly interpolated.

    Spark says which leaf of each tree a row falls into. The leaves' predictions are one value, a list per tree, that every row
    is looked up in, so no row is shuffled. A forest of more than ``most_nodes`` nodes joins rows and leaves instead.
    """
    if fitted.kind != "forest":
        raise ValueError("tree quantiles need a forest")
    leaves = staged(forest_leaves(fitted.model), "leaves")
    rows = fitted.model.transform(fitted.vectors(df), {fitted.model.leafCol: LEAVES}).drop(FEATURES, PREDICTION)
    rows = rows.withColumn(LEAVES, vector_to_array(LEAVES))

    def quantiles(sorted_values: str) -> dict[str, Column]:
        size, found = F.size(sorted_values), {}
        for name, alpha in alphas.items():
            place = (size - 1) * F.lit(float(alpha))
            low, high = F.get(sorted_values, F.floor(place).cast("int")), F.get(sorted_values, F.ceil(place).cast("int"))
            found[name] = low + (high - low) * (place - F.floor(place))
        return found

    if fitted.model.totalNumNodes <= most_nodes:
        by_leaf = F.transform(F.sort_array(F.collect_list(F.struct("leaf", "prediction"))), lambda x: x["prediction"])
        trees = leaves.groupBy("tree").agg(by_leaf.alias("p"))
        table = trees.agg(F.transform(F.sort_array(F.collect_list(F.struct("tree", "p"))), lambda x: x["p"]).alias("t")).scalar()
        looked_up = F.transform(F.col(LEAVES), lambda leaf, tree: F.get(F.get(F.col("_table"), tree), leaf.cast("int")))
        rows = rows.withColumn("_table", table).withColumn("_p", F.sort_array(looked_up))
        return rows.withColumns(quantiles("_p")).drop("_p", "_table", LEAVES)
    rows = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "leaves-of-rows")
    each = rows.select("_row", F.posexplode(LEAVES).alias("tree", "leaf"))
    found = each.join(leaves, ["tree", "leaf"]).groupBy("_row").agg(F.sort_array(F.collect_list("prediction")).alias("_p"))
    spread = found.select("_row", *[c.alias(name) for name, c in quantiles("_p").items()])
    return rows.drop(LEAVES).join(spread, "_row").drop("_row")


def interval_forecast(
    predictions: DataFrame, alphas: Mapping[str, float] = ALPHAS, by: Sequence[str] = (), split: str = "validation"
) -> DataFrame:
    """Prediction plus the quantiles of the residuals of one held-out split, overall or per key."""
    residual = F.col("actual_tch") - F.col(PREDICTION)
    held = predictions.where(F.col("split") == split).select(*by, residual.alias("_residual"))
    shifts = exact_quantiles(held, list(by), "_residual", {f"_{name}": a for name, a in alphas.items()})
    if by:
        rows = join_null_safe(predictions, shifts, list(by), "left")
    else:
        one = shifts.select(F.struct(*shifts.columns).alias("_shift"))
        rows = predictions.withColumn("_shift", one.scalar()).select("*", "_shift.*").drop("_shift")
    made = {name: F.col(PREDICTION) + F.col(f"_{name}") for name in alphas}
    return rows.withColumns(made).drop(*[f"_{name}" for name in alphas])


def fit_quantiles(
    train: DataFrame, features: Sequence[str], target: str, kind: str, params: Mapping | None = None, alphas: Mapping[str, float] = ALPHAS
) -> dict[str, Fitted]:
    """One boosted model of the pinball loss per quantile. Their leaves hold exact quantiles, so widths differ by row.

    Boosted kinds take the parameters of the model, others those of ``QUANTILE_PARAMS``.
    """
    given = dict(params or {}) if kind in BOOSTED else {**QUANTILE_PARAMS, **(params or {})}
    data = prepare_fit(train, features, target, kind if kind in BOOSTED else "boosted", (), int(given.get("max_bins", boosting.Settings.max_bins)))
    fits = [lambda a=a: fit_prepared(data, {**given, "loss": "pinball", "alpha": a}) for a in alphas.values()]
    return dict(zip(alphas, together(train.sparkSession, fits)))


def quantile_forecast(fitted: Mapping[str, Fitted], df: DataFrame) -> DataFrame:
    """Every row with the quantiles of ``fit_quantiles``. They are fitted apart, so they may cross (see ``crossings``)."""
    first = next(iter(fitted.values()))
    rows = first.vectors(df)
    for name, one in fitted.items():
        rows = one.model.transform(rows).withColumnRenamed(PREDICTION, name)
    return rows.drop(FEATURES)


def crossings(rows: DataFrame, by: Sequence[str] = ("split",), alphas: Mapping[str, float] = ALPHAS) -> DataFrame:
    """Rows per group, and how many of them have a quantile above the next one."""
    names = sorted(alphas, key=alphas.get)
    crossed = reduce(lambda a, b: a | b, [F.col(low) > F.col(high) for low, high in zip(names, names[1:])])
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum(crossed.cast("long")).alias("crossed"))


# ---------------------------------------------------------------- importance


def permutation_importance(fitted: Fitted, df: DataFrame, key: str = KEY, target: str = "tch", seed: int = SEED) -> DataFrame:
    """Rise of the error when one feature is taken from another row, over all rows with a target, in one job.

    The other row is the next one in the order of a hash of the key; the last row takes the first.
    """
    rows = fitted.vectors(df.where(F.col(target).isNotNull()))
    rows = rows.select(F.col(key).alias("_key"), F.col(target).alias("_y"), vector_to_array(FEATURES).alias("_x"))
    rows = staged(hash_place(rows, "_key", seed), "importance")
    total = rows.count()
    mates = rows.select(F.pmod(F.col("_place") - 1, F.lit(max(total, 1))).alias("_place"), F.col("_x").alias("_other"))
    width = len(fitted.features)
    trials = rows.join(mates, "_place").withColumn("_f", F.explode(F.sequence(F.lit(-1), F.lit(width - 1))))
    mixed = F.transform("_x", lambda x, i: F.when(i == F.col("_f"), F.get("_other", i)).otherwise(x))
    scored = fitted.model.transform(trials.withColumn(FEATURES, array_to_vector(mixed)))
    error = F.col(PREDICTION) - F.col("_y")
    errors = scored.groupBy("_f").agg(F.sqrt(F.avg(error * error)).alias("rmse"))
    base = errors.where("_f = -1").select("rmse").scalar()
    names = F.array(*[F.lit(c) for c in fitted.features])
    return errors.where("_f >= 0").select(
        F.get(names, F.col("_f")).alias("feature"), (F.col("rmse") - base).alias("rmse_increase")
    )


def hash_place(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """Add ``_place``: the place of each row, from 0, when ordered by md5 of seed and key, then key.

    Rows are counted within parts of even size that the first digits of the hash give.
    """
    mark = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    parted = rows.withColumn("_mark", mark).withColumn("_part", F.substring("_mark", 1, 3))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part, 4096 at most
    parts = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_mark", key)) - 1
    return parted.withColumn("_in", inside).join(parts, "_part").withColumn("_place", F.col("_in") + F.col("_base")).drop("_mark", "_part", "_in", "_base")
