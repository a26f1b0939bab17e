"""Folds, the density sampler and the search."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from canopycast.operators import models, search

SEASONS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    data = []
    for i in range(800):
        x = rng.normal(0, 1, 3)
        data.append((f"k{i}", SEASONS[i % 4], "validation" if i % 4 == 3 else "train", *map(float, x), float(x @ [2, -1, 0] + rng.normal(0, 0.3) + 20)))
    data[7] = (*data[7][:3], None, *data[7][4:])
    return spark.createDataFrame(data, "cod_cg_zafra string, zafra_norm string, split string, u double, v double, w double, tch double")


def prepare_counting(calls):
    def prepare(train, whole):
        calls.append(1)
        return whole, ["u", "v", "w"], ["v", "w"]

    return prepare


def test_folds_are_prepared_once_for_all_trials(rows):
    calls = []
    best, table = search.search(rows, prepare_counting(calls), "tch", "ridge", [{"alpha": a} for a in (0.1, 1e4, 1e7)], "walk_forward_r2", 0.5, SEASONS)
    assert len(calls) == 3 and best == {"alpha": 0.1}
    got = table.orderBy("trial").collect()
    assert [r.folds for r in got] == [3, 3, 3] and got[0].score > got[1].score > got[2].score
    for r in got:
        folds = search.walk_forward_predictions(rows, SEASONS, prepare_counting([]), "tch", "ridge", json.loads(r.params))
        assert folds.where("role = 'validation'").groupBy("fold").count().count() == 3
        errors = folds.where("role = 'validation'").groupBy("fold").agg(F.sqrt(F.avg((F.col("pred_tch") - F.col("actual_tch")) ** 2)).alias("e")).collect()
        assert r.mean_rmse == pytest.approx(np.mean([e.e for e in errors]))


def test_only_the_better_share_goes_on(rows):
    alphas = [1e6, 0.1, 1e5, 1.0]
    best, table = search.search(rows, prepare_counting([]), "tch", "ridge", [{"alpha": a} for a in alphas], "auto", 0.0, SEASONS, keep=0.5)
    got = {json.loads(r.params)["alpha"]: r for r in table.collect()}
    assert [got[a].folds for a in alphas] == [1, 3, 1, 2] or [got[a].folds for a in alphas] == [1, 2, 1, 3]
    assert sum(r.score is not None for r in got.values()) == 1 and best["alpha"] in (0.1, 1.0)


def test_search_on_one_validation_split_with_boosted_trees(rows):
    space = {"n_estimators": (2, 6, "int"), "learning_rate": (0.05, 0.5, "log"), "subsample": (0.6, 1.0, "real")}
    run = lambda: search.search(rows, prepare_counting([]), "tch", "boosted", 3, space=space, at_once=2)
    best, table = run()
    found = table.orderBy("trial").collect()
    assert [r.objective for r in found] == ["lot_rmse"] * 3 and json.loads(min(found, key=lambda r: r.score).params) == best
    again = run()[1].orderBy("trial").collect()
    assert [r.params for r in again] == [r.params for r in found] and [r.score for r in again] == pytest.approx([r.score for r in found])
    with pytest.raises(ValueError, match="no fold"):
        search.search(rows.where("split = 'train'"), prepare_counting([]), "tch", "ridge", 2, seasons=["a"])


def test_densities_are_whole(rows):
    for points in ([], [0.0], [0.3, 0.31, 0.9], [1.0, 1.0]):
        x = np.linspace(0, 1, 20001)
        assert np.trapezoid([search.DensitySampler.density(points, v) for v in x], x) == pytest.approx(1, abs=1e-4)


def test_the_sampler_keeps_to_its_space_and_finds_the_minimum():
    loss = lambda p: (math.log10(p["alpha"]) - 1) ** 2 + (p["depth"] - 7) ** 2 / 10 + abs(p["share"] - 0.8)
    space = {"alpha": (1e-3, 1e3, "log"), "depth": (3, 10, "int"), "share": (0.6, 1.0, "real")}
    better = 0
    for seed in range(8):
        sampler, done = search.DensitySampler(space, seed), []
        while len(done) < 60:
            sets = sampler.ask(done, 4)
            assert sets == sampler.ask(done, 4)
            done += [(p, loss(p)) for p in sets]
        assert all(1e-3 <= p["alpha"] <= 1e3 and p["depth"] in range(3, 11) and 0.6 <= p["share"] <= 1 for p, _ in done)
        source = random.Random(seed)
        even = min(loss({k: sampler._from_unit(k, source.random()) for k in space}) for _ in range(60))
        better += min(x for _, x in done) < even
    assert better >= 6


def test_every_space_gives_parameters_that_its_model_takes():
    for kind, space in models.SPACES.items():
        sets = search.DensitySampler(space).ask([], 3)
        for params in sets:
            if kind in models.BOOSTED:
                models.boosting.Settings.of({**models.DEFAULTS[kind], **models._named(params)})
            else:
                models.build_model(kind, params, "tch", 10, 1.0)
