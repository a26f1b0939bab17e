"""Boosted trees, quantile trees and statistics of the target against plain loops."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from canopycast.operators import boosting, encode, models

COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(0, 1, (900, 4)), 1)
    x[:, 3] = 7.0
    y = 3 * x[:, 0] + np.where(x[:, 1] > 0, 5, 0) + x[:, 2] ** 2 + rng.normal(0, 0.5, 900) + 50
    x[rng.random((900, 4)) < 0.1] = np.nan
    return x, y


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y = data
    rows = [(f"k{i}", *[None if math.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    rows += [("open", 1.0, 1.0, 1.0, 1.0, None), ("nan", 1.0, 1.0, 1.0, 1.0, float("nan"))]
    return spark.createDataFrame(rows, "cod_cg_zafra string, a double, b double, c double, d double, tch double").repartition(5)


def predictions(model, rows):
    found = model.transform(VectorAssembler(inputCols=COLUMNS, outputCol="_features", handleInvalid="keep").transform(rows))
    return {r.cod_cg_zafra: r.pred_tch for r in found.collect()}


def slow_fit(x, y, edges, s):
    """One node at a time: the leaf of highest gain, or any, is split until none may be."""
    bins = boosting.to_bins(x, edges)
    slope = (lambda rest: -rest) if s.loss == "squared" else (lambda rest: np.where(rest > 0, -s.alpha, 1 - s.alpha))
    place = lambda v: np.sort(v)[max(1, math.ceil(s.alpha * len(v) - 1e-9)) - 1]
    lean = lambda g: max(abs(g) - s.reg_alpha, 0)
    p = np.full(len(y), y.mean() if s.loss == "squared" else place(y))
    least = max(1, s.min_samples_leaf, s.min_child_weight)
    for number in range(1, s.n_estimators + 1):
        g = slope(y - p)
        columns = boosting.drawn_columns(x.shape[1], s.colsample_bytree, s.seed, number)

        def best(use, depth):
            top = None
            for c in columns if depth < s.max_depth else []:
                for cut in np.unique(bins[use, c]):
                    for missing in (True, False):
                        code = bins[use, c]
                        if cut == 0 or not missing and not (code == 0).any():
                            continue
                        left = np.where(code == 0, missing, code <= cut)
                        sides = use[left], use[~left]
                        if min(map(len, sides)) < least:
                            continue
                        score = [lean(g[z].sum()) ** 2 / (len(z) + s.reg_lambda) for z in (*sides, use)]
                        gain = round((score[0] + score[1] - score[2]) / 2, 9)
                        if gain > 0 and (top is None or gain > top[0] + 1e-8):
                            top = (gain, *sides, depth + 1)
            return top

        leaves = [(np.arange(len(y)), best(np.arange(len(y)), 0))]
        while any(b for _, b in leaves) and (s.num_leaves is None or len(leaves) < s.num_leaves):
            k = max((i for i, (_, b) in enumerate(leaves) if b), key=lambda i: leaves[i][1][0])
            _, (_, left, right, depth) = leaves.pop(k)
            leaves += [(left, best(left, depth)), (right, best(right, depth))]
        step = np.zeros(len(y))
        for use, _ in leaves:
            rest = (y - p)[use]
            step[use] = -np.sign(g[use].sum()) * lean(g[use].sum()) / (len(use) + s.reg_lambda) if s.loss == "squared" else place(rest)
        p = p + s.learning_rate * step
    return p


@pytest.mark.parametrize(
    "params",
    [
        {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3},
        {"iterations": 2, "depth": 6, "num_leaves": 5, "reg_alpha": 2.0, "l2_leaf_reg": 3.0, "min_child_samples": 30, "colsample_bytree": 0.5},
        {"n_estimators": 2, "max_depth": 4, "min_child_weight": 60.0, "max_bins": 8},
        {"n_estimators": 2, "max_depth": 2, "loss": "pinball", "alpha": 0.9, "learning_rate": 0.5, "max_bins": 10},
        {"n_estimators": 1, "max_depth": 0},
    ],
)
def test_trees_are_those_of_plain_loops(rows, data, params):
    x, y = data
    model = boosting.fit_boosted(rows, COLUMNS, "tch", [params], "cod_cg_zafra")[0]
    want = slow_fit(x, y, model.edges, boosting.Settings.of(params))
    got = predictions(model, rows)
    assert np.allclose([got[f"k{i}"] for i in range(len(y))], want, atol=1e-7) and "open" in got


def test_predictions_written_between_trees_change_nothing(rows, monkeypatch):
    params = {"n_estimators": 5, "max_depth": 2, "subsample": 0.7, "loss": "pinball", "alpha": 0.3}
    want = predictions(boosting.fit_boosted(rows, COLUMNS, "tch", [params], "cod_cg_zafra")[0], rows)
    monkeypatch.setattr(boosting, "TREES_PER_STAGE", 2)
    monkeypatch.setattr(boosting, "CELLS", 1)
    monkeypatch.setattr(boosting, "LEFT", 3)
    assert predictions(boosting.fit_boosted(rows, COLUMNS, "tch", [params], "cod_cg_zafra")[0], rows) == pytest.approx(want)


def test_samples_and_noise(rows):
    params = {"n_estimators": 4, "max_depth": 3}
    plain, part, noise = boosting.fit_boosted(rows, COLUMNS, "tch", [params, {**params, "subsample": 0.5}, {**params, "random_strength": 50.0}], "cod_cg_zafra")
    assert [t.rows[0] for t in plain.trees] == [900] * 4
    sizes = [t.rows[0] for t in part.trees]
    assert all(350 < n < 550 for n in sizes) and len(set(sizes)) > 1
    assert plain.nodes() != noise.nodes() and all(g > 0 for t in noise.trees for g, c in zip(t.gain, t.column) if c >= 0)
    assert boosting.Boosted.read(noise.text()).nodes() == noise.nodes()
    with pytest.raises(ValueError, match="unknown parameters"):
        boosting.Settings.of({"gamma": 1})


def test_constant_and_empty_columns_and_tables(spark, rows):
    none = rows.withColumns({"a": F.lit(None).cast("double"), "b": F.lit(1.0)})
    model = boosting.fit_boosted(none, ["a", "b"], "tch", [{"n_estimators": 2}])[0]
    assert [len(t.column) for t in model.trees] == [1, 1]
    empty = boosting.fit_boosted(rows.limit(0), COLUMNS, "tch", [{"n_estimators": 1}, {"n_estimators": 1, "loss": "pinball"}])
    assert [m.base for m in empty] == [0.0, 0.0]


@given(st.lists(st.floats(allow_nan=False), max_size=50))
@settings(max_examples=200, deadline=None)
def test_whole_numbers_keep_the_order_of_doubles(values):
    x = np.array(values, float)
    assert (np.sort(boosting.ordered(x)) == boosting.ordered(np.sort(x))).all() and (boosting.unordered(boosting.ordered(x)) == x).all()


def test_quantile_models_hold_their_share(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 1, 4000)
    y = x * 10 + rng.normal(0, 1, 4000) * (0.2 + 3 * x)
    df = spark.createDataFrame([(f"k{i}", float(a), float(b), "test" if i % 2 else "train") for i, (a, b) in enumerate(zip(x, y))], "cod_cg_zafra string, x double, tch double, split string")
    fitted = models.fit_quantiles(df.where("split = 'train'"), ["x"], "tch", "boosted", {"n_estimators": 20, "max_depth": 3, "learning_rate": 0.2})
    got = models.quantile_forecast(fitted, df).where("split = 'test'").toPandas()
    for name, alpha in models.ALPHAS.items():
        assert abs((got.tch <= got[name]).mean() - alpha) < 0.04
    width = got.pred_tch_p90 - got.pred_tch_p10
    assert width[got.x > 0.8].mean() > 2 * width[got.x < 0.2].mean()
    crossed = models.crossings(models.quantile_forecast(fitted, df)).where("split = 'test'").first()
    assert crossed.rows == 2000 and crossed.crossed == ((got.pred_tch_p10 > got.pred_tch_p50) | (got.pred_tch_p50 > got.pred_tch_p90)).sum()


@pytest.fixture(scope="module")
def categories(spark):
    rng = np.random.default_rng(8)
    rows = [(f"k{i % 1900}", "hot" if i % 3 == 0 else f"c{rng.integers(40)}", bool(i % 2), float(rng.normal(10, 2)) if i % 11 else None) for i in range(2000)]
    rows[5] = (*rows[5][:1], None, None, 9.0)
    return rows, spark.createDataFrame(rows, "cod_cg_zafra string, t string, u boolean, tch double").repartition(6)


@pytest.mark.parametrize("part_rows", [100, 100_000])
def test_ordered_statistics_see_only_rows_before(categories, part_rows):
    rows, df = categories
    found = encode.category_statistics(df, ["t", "u"], "tch")
    got = encode.ordered_statistics(df, ["t", "u"], "tch", "cod_cg_zafra", found, part_rows=part_rows)
    mean = np.mean([y for *_, y in rows if y is not None])
    assert found.mean == pytest.approx(mean)
    want, sums = [], {}
    for key, t, u, y in sorted(rows, key=lambda r: (hashlib.md5(f"42:{r[0]}".encode()).hexdigest(), -math.inf if r[3] is None else r[3])):
        stats = []
        for pair in (("t", str(t)), ("u", str(u))):
            total, n = sums.get(pair, (0.0, 0))
            stats.append((total + mean) / (n + 1))
            if y is not None:
                sums[pair] = total + y, n + 1
        want.append((key, -1.0 if y is None else y, *stats))
    values = sorted((r.cod_cg_zafra, -1.0 if r.tch is None else r.tch, r._stat_t, r._stat_u) for r in got.collect())
    assert [v[:2] for v in values] == [w[:2] for w in sorted(want)] and np.allclose([v[2:] for v in values], [w[2:] for w in sorted(want)])


def test_statistics_of_all_rows(spark, categories):
    rows, df = categories
    found = encode.category_statistics(df, ["t", "u"], "tch")
    more = df.unionByName(spark.createDataFrame([("new", "never seen", None, None)], df.schema))
    got = {r.cod_cg_zafra: r for r in encode.apply_statistics(more, found, ["t", "u"]).collect()}
    hot = [y for _, t, _, y in rows if t == "hot" and y is not None]
    assert got["k150"]._stat_t == pytest.approx((sum(hot) + found.mean) / (len(hot) + 1)) and got["new"]._stat_t == found.mean


@pytest.mark.parametrize("kind", ["forest", "ordered"])
def test_trees_take_text_columns(spark, tmp_path, kind):
    rng = np.random.default_rng(2)
    rows = [(f"k{i}", f"c{i % 7}", float(rng.normal()), (i % 7) * 3.0 + float(rng.normal(0, 0.2))) for i in range(1400)]
    df = spark.createDataFrame(rows, "cod_cg_zafra string, t string, x double, tch double")
    fitted = models.fit_model(df, ["x", "t"], "tch", kind, {"n_estimators": 10, "learning_rate": 0.5} if kind == "ordered" else {"n_estimators": 5})
    got = models.score_rows(fitted, df).toPandas()
    assert np.sqrt(((got.pred_tch - got.actual_tch) ** 2).mean()) < 1.5 and set(got.t) == {f"c{k}" for k in range(7)}
    models.save_model(fitted, str(tmp_path))
    again = models.score_rows(models.load_model(spark, str(tmp_path)), df).toPandas()
    assert again.pred_tch.sum() == pytest.approx(got.pred_tch.sum())
    with pytest.raises(ValueError, match="text columns"):
        models.fit_model(df, ["x", "t"], "tch", "ridge")


def slow_shares(nodes, base, x, width):
    """Attributions by all sets of features; what is absent follows both branches with the shares of their rows."""
    from itertools import combinations

    by_tree = {}
    for n in nodes:
        by_tree.setdefault(n[0], {})[n[1]] = n

    def value(tree, node, known):
        _, _, column, threshold, missing_left, left, right, v, cover = tree[node]
        if column is None:
            return v
        if column in known:
            goes = missing_left if math.isnan(x[column]) else x[column] <= (math.inf if threshold is None else threshold)
            return value(tree, left if goes else right, known)
        return sum(tree[c][8] / cover * value(tree, c, known) for c in (left, right))

    game = {}
    for k in range(width + 1):
        for known in combinations(range(width), k):
            game[known] = base + sum(value(t, 0, known) for t in by_tree.values())
    out = []
    for i in range(width):
        others = [j for j in range(width) if j != i]
        out.append(sum(
            math.factorial(k) * math.factorial(width - 1 - k) / math.factorial(width) * (game[tuple(sorted((*known, i)))] - game[known])
            for k in range(width) for known in combinations(others, k)
        ))
    return out, game[()]


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_attributions_are_those_of_all_sets_of_features(rows, kind):
    from canopycast.operators import attribution

    complete = rows if kind == "boosted" else rows.fillna(0.25, COLUMNS)
    params = {"n_estimators": 4, "max_depth": 5, "learning_rate": 0.3, "min_samples_leaf": 5} if kind == "boosted" else {"n_estimators": 3, "max_depth": 4}
    fitted = models.fit_model(complete.where("cod_cg_zafra <> 'nan'"), COLUMNS, "tch", kind, params)
    got = {r.cod_cg_zafra: r for r in attribution.attributions(fitted, complete).collect()}
    scored = models.score_rows(fitted, complete).collect()
    nodes, mean = attribution.node_rows(fitted), attribution.expected(fitted)
    for r in scored:
        assert sum(got[r.cod_cg_zafra][c] for c in COLUMNS) + mean == pytest.approx(r.pred_tch)
    base = fitted.model.base if kind == "boosted" else 0.0
    for r in scored[:25]:
        want, start = slow_shares(nodes, base, [math.nan if r[c] is None else r[c] for c in COLUMNS], 4)
        assert [got[r.cod_cg_zafra][c] for c in COLUMNS] == pytest.approx(want, abs=1e-9) and start == pytest.approx(mean)
    table = {r.feature: r.mean_abs_attribution for r in attribution.mean_attributions(attribution.attributions(fitted, complete), COLUMNS).collect()}
    assert table["b"] > table["d"] and table["a"] == pytest.approx(np.mean([abs(r["a"]) for r in got.values()]))
