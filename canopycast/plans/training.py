"""The training run: matrix, split, encoding, search, fit, reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..config import KEY, SEASON, TARGET
from ..functions.names import feature_names
from ..operators import attribution, encode as enc, models, reports, search, splits
from ..operators.features import Matrix
from ..operators.ranks import join_null_safe
from ..sources.io import write_reports
from ..sources.staging import staged
from . import diagnostics


@dataclass(frozen=True)
class Options:
    """Choices of a training run."""

    kind: str = "ridge"
    mode: str = "controlled"
    target: str = TARGET
    train: Sequence[str] = splits.TRAIN_SEASONS
    validation: Sequence[str] = splits.VALIDATION_SEASONS
    test: Sequence[str] = splits.TEST_SEASONS
    external: Sequence[str] = ()
    params: Mapping = field(default_factory=dict)
    trials: int = 0
    trials_at_once: int = 4
    # share of the trials of a round that go on to the next fold
    keep_trials: float = 1.0
    objective: str = "auto"
    penalty: float = 0.0
    walk_forward: bool = False
    # seasons of the walk-forward folds; by default the test and external seasons stay out
    fold_seasons: Sequence[str] | None = None
    refit_encoder: bool = True
    quantiles: bool = True
    # "residuals" shifts the prediction by validation residuals, "pinball" fits boosted trees per quantile; a forest has its own
    intervals: str = "residuals"
    importance: bool = False
    # contribution of each feature to each prediction of the test rows, for tree models
    attributions: bool = False
    min_rows: int = 30
    # report on the features too, next to the model
    diagnostics: bool = False


@dataclass(frozen=True)
class Run:
    fitted: models.Fitted
    encoder: enc.EncoderSpec
    vocab: DataFrame
    params: dict
    rows: dict[str, int]
    reports: dict[str, DataFrame]


def split_rows(matrix: Matrix, o: Options) -> DataFrame:
    """The columns that are used, with the split of each row, staged."""
    used = list(dict.fromkeys([KEY, SEASON, *matrix.metadata, o.target, *matrix.numeric, *matrix.categorical]))
    df = splits.temporal_split(matrix.df, o.train, o.validation, o.test, o.external)
    return staged(df.select(*[c for c in used if c in df.columns], "split"), "matrix")


def diagnose_features(matrix: Matrix, options: Options = Options(), df: DataFrame | None = None) -> dict[str, DataFrame]:
    """Feature reports before any encoding; a step of its own, or part of a run with ``diagnostics``."""
    df = split_rows(matrix, options) if df is None else df
    return diagnostics.diagnose(df, KEY, options.target, matrix.numeric, matrix.categorical).reports


def train(matrix: Matrix, options: Options = Options()) -> Run:
    """Fit on the training split and report every split, the external seasons included."""
    o = options
    enc.check_mode(enc.resolve_mode(o.mode), o.kind)
    if o.intervals not in ("residuals", "pinball"):
        raise ValueError(f"unknown intervals {o.intervals!r}")
    if o.walk_forward:
        reports.resolve_objective(o.objective, True)
    df = split_rows(matrix, o)
    rows = splits.require_splits(df)

    spec = enc.encoder_spec(matrix.categorical, o.mode)
    base_vocab = staged(enc.fit_vocab(df.where(F.col("split") == "train"), spec.columns), "vocabulary")
    carried = list(dict.fromkeys([KEY, *matrix.metadata, "split", o.target]))

    def prepare(part: DataFrame, whole: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
        """Encoded rows, feature names and complete ones, with the vocabulary of ``part``."""
        vocab = enc.fit_vocab(part, spec.columns) if o.refit_encoder and spec.columns else base_vocab
        return encode_rows(whole, vocab)

    def encode_rows(whole: DataFrame, vocab: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
        # text metadata may also be a feature, so features are encoded next to the carried columns
        inputs = [c for c in matrix.numeric if c not in carried]
        texts = [c for c in spec.columns if c not in carried]
        both = {f"x_{c}": F.col(c) for c in [*matrix.numeric, *spec.columns] if c in carried}
        wide = whole.withColumns(both).select(*carried, *both, *inputs, *texts)
        encoded = enc.encode(wide, _renamed(spec, both), _vocab(vocab, both), keep=carried)
        features = [c for c in encoded.columns if c not in carried]
        numbers = set(feature_names([*inputs, *[c for c in both if c[2:] in matrix.numeric]]))
        return encoded, features, [c for c in features if c not in numbers]

    params = dict(o.params)
    seasons = list(o.fold_seasons or [*o.train, *o.validation])
    trials = None
    if o.trials:
        params, trials = search.search(
            df, prepare, o.target, o.kind, o.trials, o.objective, o.penalty, seasons if o.walk_forward else None,
            at_once=o.trials_at_once, keep=o.keep_trials,
        )

    encoded, features, complete = encode_rows(df, base_vocab)
    encoded = staged(encoded, "encoded")
    fitted = models.fit_model(encoded.where(F.col("split") == "train"), features, o.target, o.kind, params, complete)
    scored = models.score_rows(fitted, encoded.where(F.col("split").isNotNull()), o.target)
    predictions = staged(
        reports.prediction_error(scored.select(*[c for c in carried if c != o.target], "actual_tch", "pred_tch")), "predictions"
    )
    found = make_reports(predictions, o)
    if trials is not None:
        found["search_trials"] = trials
    if o.diagnostics:
        found |= diagnose_features(matrix, o, df)
    if o.quantiles:
        found |= quantile_reports(fitted, encoded, predictions, found["metrics_by_zafra"], o)
    found["metrics_by_zafra_aggregate"] = reports.aggregate_season_metrics(found["metrics_by_zafra"])
    if o.walk_forward:
        folds = search.walk_forward_predictions(df.where("split IS NULL OR split <> 'external'"), seasons, prepare, o.target, o.kind, params)
        found["walk_forward_metrics"] = reports.walk_forward_metrics(folds)
    if o.importance:
        found["feature_importance"] = models.permutation_importance(
            fitted, encoded.where(F.col("split") == "test"), target=o.target
        )
    if o.attributions:
        rows_of = staged(attribution.attributions(fitted, encoded.where(F.col("split") == "test"), KEY), "attributions")
        found["attributions"] = rows_of
        found["mean_attributions"] = attribution.mean_attributions(rows_of, features)
    return Run(fitted, spec, base_vocab, params, rows, found)


def _renamed(spec: enc.EncoderSpec, both: Mapping) -> enc.EncoderSpec:
    names = {c[2:]: c for c in both}
    return enc.EncoderSpec(spec.mode, [names.get(c, c) for c in spec.columns], spec.rules, spec.dropped)


def _vocab(vocab: DataFrame, both: Mapping) -> DataFrame:
    name = F.col("feature")
    renamed = F.when(name.isin(*[c[2:] for c in both]), F.concat(F.lit("x_"), name)).otherwise(name) if both else name
    return vocab.withColumn("feature", renamed)


def make_reports(predictions: DataFrame, o: Options) -> dict[str, DataFrame]:
    """Reports that need predictions only."""
    seasons = reports.season_metrics(predictions)
    return {
        "predictions_by_lot": predictions,
        "predictions_external": predictions.where(F.col("split") == "external"),
        "metrics": reports.regression_metrics(predictions, ["split"]),
        "metrics_by_lot_error": reports.lot_error_metrics(predictions),
        "metrics_by_tch_range": reports.range_metrics(predictions),
        "tail_error_report": reports.tail_error_report(predictions, o.min_rows),
        "metrics_by_zafra": seasons,
        "metrics_by_zafra_external": seasons.where(F.col("split") == "external"),
    }


def quantile_reports(
    fitted: models.Fitted, encoded: DataFrame, predictions: DataFrame, seasons: DataFrame, o: Options
) -> dict[str, DataFrame]:
    """Interval forecast of every row and its reports."""
    names = ["split", KEY, "cod_cg", SEASON, "area", "actual_tch", *models.ALPHAS]
    if fitted.kind == "forest":
        rows = models.forest_quantiles(fitted, encoded.where(F.col("split").isNotNull()))
        rows = rows.withColumnRenamed(o.target, "actual_tch")
    elif o.intervals == "pinball":
        train_rows = encoded.where(F.col("split") == "train")
        models_of = models.fit_quantiles(train_rows, fitted.features, o.target, fitted.kind, o.params if fitted.kind in models.BOOSTED else None)
        rows = models.quantile_forecast(models_of, encoded.where(F.col("split").isNotNull())).withColumnRenamed(o.target, "actual_tch")
    else:
        rows = models.interval_forecast(predictions)
    rows = staged(rows.select(*[c for c in names if c in rows.columns]), "quantiles")
    by_season = reports.season_interval_metrics(rows)
    return {
        "predictions_by_lot_quantiles": rows,
        "metrics_by_quantile_interval": reports.interval_metrics(rows),
        "metrics_by_zafra": join_null_safe(seasons, by_season, ["split", SEASON], "left"),
    }


def write_run(run: Run, folder: str) -> dict[str, str]:
    """Write model, encoder, feature list and split sizes next to the reports."""
    models.save_model(run.fitted, f"{folder}/model")
    enc.save_state(run.encoder, run.vocab, f"{folder}/encoder")
    spark = run.vocab.sparkSession
    lists = {
        "feature_list": spark.createDataFrame([(c,) for c in run.fitted.features], "feature string"),
        "split_rows": spark.createDataFrame([(k, v) for k, v in run.rows.items()], "split string, rows long"),
        "best_params": spark.createDataFrame([(k, str(v)) for k, v in run.params.items()], "name string, value string"),
    }
    return write_reports({**run.reports, **lists}, folder)
