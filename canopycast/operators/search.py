"""Walk-forward folds and the search for parameters.

A fold is encoded, imputed or binned once, whatever the number of trials. Trials run as concurrent jobs over these tables.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..config import KEY, SEASON
from ..sources.staging import staged, together
from . import reports
from .models import PREDICTION, SEED, SPACES, Fitted, Prepared, fit_prepared, prepare_fit, score_rows
from .splits import fold_table

#: ``prepare(train, rows)`` returns the encoded rows, their feature names and which of these are never missing.
Prepare = Callable[[DataFrame, DataFrame], tuple[DataFrame, list[str], list[str]]]


@dataclass(frozen=True)
class Fold:
    name: str
    train: DataFrame
    held: DataFrame
    prepared: Prepared


def make_folds(df: DataFrame, prepare: Prepare, target: str, kind: str, seasons: Sequence[str] | None = None) -> list[Fold]:
    """Folds with rows on both sides, encoded from their training rows and staged, as concurrent jobs.

    With seasons each fold validates one and trains on those before it; without, ``split`` tells training from validation.
    """
    season = F.col(SEASON)
    if seasons is None:
        parts = {"validation": (F.col("split") == "train", F.col("split") == "validation")}
    else:
        present = {r[SEASON] for r in df.where(season.isin(*seasons)).select(SEASON).distinct().collect()}
        before: dict[str, list[str]] = {}
        for fold, name, role in fold_table(seasons):
            if fold in present and name in present and role == "train":
                before.setdefault(fold, []).append(name)
        parts = {fold: (season.isin(*names), season == fold) for fold, names in before.items()}

    def make(name: str, train, held) -> Fold:  # noqa: ANN001
        encoded, features, complete = prepare(df.where(train), df.where(train | held))
        encoded = staged(encoded, "fold")
        return Fold(name, encoded.where(train), encoded.where(held), prepare_fit(encoded.where(train), features, target, kind, complete))

    folds = together(df.sparkSession, [lambda n=n, p=p: make(n, *p) for n, p in parts.items()])
    if not folds:
        raise ValueError("no fold has both training and validation rows")
    return folds


def walk_forward_predictions(df: DataFrame, seasons: Sequence[str], prepare: Prepare, target: str, kind: str, params: Mapping) -> DataFrame:
    """Validation predictions of each fold, and its training rows without prediction."""
    folds = make_folds(df, prepare, target, kind, seasons)
    fitted = together(df.sparkSession, [lambda f=f: fit_prepared(f.prepared, params) for f in folds])
    result = None
    for fold, model in zip(folds, fitted):
        held = score_rows(model, fold.held, target).select(KEY, SEASON, "actual_tch", PREDICTION, F.lit("validation").alias("role"))
        base = fold.train.select(KEY, SEASON, F.col(target).alias("actual_tch"), F.lit(None).cast("double").alias(PREDICTION), F.lit("train").alias("role"))
        rows = held.unionByName(base).withColumn("fold", F.lit(fold.name))
        result = rows if result is None else result.unionByName(rows)
    return result


# ---------------------------------------------------------------- samplers


class DensitySampler:
    """Draws parameters where finished trials were good.

    The first ``startup`` sets are drawn evenly. Then the best ``share`` of the finished trials and the others each give a density
    per parameter: a normal curve around every value, as wide as the values are spread, and an even part as one more value. A
    value is drawn from the density of the good ones; of several ``draws`` that with the highest ratio of both densities is
    taken, which finds a narrow best sooner and may stay at the edge of a range. The same seed and the same finished trials give the same sets.
    """

    def __init__(self, space: Mapping[str, tuple], seed: int = SEED, startup: int = 10, share: float = 0.15, draws: int = 1):
        self.space, self.seed, self.startup, self.share, self.draws = dict(space), seed, startup, share, draws

    def _to_unit(self, name: str, value: float) -> float:
        low, high, scale = self.space[name]
        if scale == "log":
            return (math.log(value) - math.log(low)) / (math.log(high) - math.log(low))
        return (value - low + 0.5) / (high - low + 1) if scale == "int" else (value - low) / (high - low)

    def _from_unit(self, name: str, unit: float) -> float:
        low, high, scale = self.space[name]
        if scale == "log":
            return math.exp(math.log(low) + unit * (math.log(high) - math.log(low)))
        return min(high, low + int(unit * (high - low + 1))) if scale == "int" else low + unit * (high - low)

    @staticmethod
    def _width(points: Sequence[float]) -> float:
        mean = sum(points) / len(points)
        spread = math.sqrt(sum((x - mean) ** 2 for x in points) / len(points))
        return min(1.0, max(0.05, 1.06 * spread * len(points) ** -0.2))

    @classmethod
    def density(cls, points: Sequence[float], x: float) -> float:
        """On [0, 1]; the curves are cut off there and made whole again."""
        total = 1.0
        if points:
            w = cls._width(points)
            whole = lambda p: (math.erf((1 - p) / w / math.sqrt(2)) + math.erf(p / w / math.sqrt(2))) / 2
            total += sum(math.exp(-(((x - p) / w) ** 2) / 2) / (w * math.sqrt(2 * math.pi)) / whole(p) for p in points)
        return total / (len(points) + 1)

    def _draw(self, points: Sequence[float], source: random.Random) -> float:
        at = source.randrange(len(points) + 1)
        if at == len(points):
            return source.random()
        while not 0 <= (x := source.gauss(points[at], self._width(points))) <= 1:
            pass
        return x

    def ask(self, finished: Sequence[tuple[Mapping, float]], count: int) -> list[dict]:
        """``count`` sets, given the finished ones with their loss (less is better)."""
        source = random.Random(f"{self.seed}:{len(finished)}")
        ranked = [p for p, _ in sorted(finished, key=lambda x: x[1])]
        best = math.ceil(self.share * len(ranked))
        sets = []
        for _ in range(count):
            chosen = {}
            for name in self.space:
                if len(ranked) < self.startup:
                    unit = source.random()
                else:
                    good, rest = ([self._to_unit(name, p[name]) for p in part] for part in (ranked[:best], ranked[best:]))
                    tries = [self._draw(good, source) for _ in range(self.draws)]
                    unit = max(tries, key=lambda x: self.density(good, x) / self.density(rest, x))
                chosen[name] = self._from_unit(name, unit)
            sets.append(chosen)
        return sets


# ---------------------------------------------------------------- search


def fold_error(fold: Fold, fitted: Fitted, target: str) -> tuple[str, float, float, float]:
    """Fold, error, share of variance explained, and share by which the total is missed, of the rows held out."""
    a, p = F.col("actual_tch"), F.col(PREDICTION)
    rows = score_rows(fitted, fold.held.where(F.col(target).isNotNull()), target)
    share = F.try_divide(F.sum(p) - F.sum(a), F.sum(a))
    return (fold.name, *rows.agg(reports.rmse(p - a), reports.r2(a, p), share).first())


FOLDS = "trial int, fold string, rmse double, r2 double, tch_sum_pct_diff double"
TRIALS = "trial int, params string, objective string, folds int, mean_rmse double, mean_r2 double, std_r2 double, mean_abs_pct_diff double, score double"


def search(
    df: DataFrame,
    prepare: Prepare,
    target: str,
    kind: str,
    trials: int | Sequence[Mapping],
    objective: str = "auto",
    penalty: float = 0.0,
    seasons: Sequence[str] | None = None,
    space: Mapping | None = None,
    at_once: int = 4,
    keep: float = 1.0,
    seed: int = SEED,
) -> tuple[dict, DataFrame]:
    """Best parameters and one row per trial.

    ``trials`` is a number of sets, drawn ``at_once`` at a time by the density sampler, or the sets themselves. With seasons
    every set is fitted in each walk-forward fold, otherwise once. ``keep`` below 1 goes on to the next fold with that share of
    the sets of a round only; the others have no score.
    """
    mode = reports.resolve_objective(objective, seasons is not None)
    spark, sign = df.sparkSession, -1 if mode == "walk_forward_r2" else 1
    folds = make_folds(df, prepare, target, kind, seasons)
    sampler = DensitySampler(space or SPACES[kind], seed)
    given = None if isinstance(trials, int) else [dict(p) for p in trials]
    total, rows, finished = trials if given is None else len(given), [], []

    def scores(errors: Mapping[int, list]) -> dict[int, tuple]:
        """The objective of each trial over the folds it has been through."""
        table = spark.createDataFrame([(n, *e) for n, found in errors.items() for e in found], FOLDS)
        found = reports.objective_score(table, mode, penalty, ["trial"]).collect()
        return {r["trial"]: tuple(r[c] for c in ("mean_rmse", "mean_r2", "std_r2", "mean_abs_pct_diff", "score")) for r in found}

    while len(rows) < total:
        count = min(at_once, total - len(rows)) if given is None else total
        sets = sampler.ask(finished, count) if given is None else given
        numbers = range(len(rows), len(rows) + count)
        errors: dict[int, list] = {n: [] for n in numbers}
        alive = list(numbers)
        for fold, last in zip(folds, [False] * (len(folds) - 1) + [True]):
            jobs = [lambda n=n: fold_error(fold, fit_prepared(fold.prepared, sets[n - numbers[0]]), target) for n in alive]
            for n, found in zip(alive, together(spark, jobs, at_once)):
                errors[n].append(found)
            if keep < 1 and not last:
                now = scores({n: errors[n] for n in alive})
                ranked = sorted(alive, key=lambda n: math.inf if now[n][-1] is None else sign * now[n][-1])
                alive = sorted(ranked[: max(1, math.ceil(keep * len(alive)))])
        found = scores(errors)
        for n in numbers:
            params, whole = sets[n - numbers[0]], len(errors[n]) == len(folds)
            score = found[n][-1] if whole else None
            rows.append((n, json.dumps(params, sort_keys=True), mode, len(errors[n]), *found[n][:-1], score))
            if score is not None:
                finished.append((params, sign * score))
    if not finished:
        raise ValueError("no trial has a score")
    best = min(finished, key=lambda x: x[1])[0]
    return best, spark.createDataFrame(rows, TRIALS)
