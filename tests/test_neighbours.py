"""Mutual information from nearest neighbours against distances of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from canopycast.operators import neighbours


def psi(m):
    return -np.euler_gamma + sum(1 / i for i in range(1, int(m)))


def slow(x, y, k):
    use = ~(np.isnan(x) | np.isnan(y))
    x, y = x[use], y[use]
    if len(x) <= k or x.std() == 0 or y.std() == 0:
        return 0.0
    x, y = x / x.std(), y / y.std()
    dx, dy = np.abs(x[:, None] - x), np.abs(y[:, None] - y)
    both = np.maximum(dx, dy)
    np.fill_diagonal(both, np.inf)
    r = np.nextafter(np.sort(both, 1)[:, k - 1], 0)[:, None]
    return max(0.0, psi(len(x)) + psi(k) - np.mean([psi(c) for c in (dx <= r).sum(1)]) - np.mean([psi(c) for c in (dy <= r).sum(1)]))


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(12)
    y = rng.normal(0, 1, 2000)
    x = {
        "linear": y + rng.normal(0, 0.5, 2000),
        "curved": y**2 + rng.normal(0, 0.1, 2000),
        "noise": rng.normal(0, 1, 2000),
        "ties": np.round(y),
        "hot": np.where(rng.random(2000) < 0.4, 3.0, y),
        "outlier": np.where(np.arange(2000) == 5, 1e12, y),
        "constant": np.full(2000, 4.0),
        "few": np.where(np.arange(2000) < 3, 1.0 + np.arange(2000), np.nan),
        "gaps": np.where(rng.random(2000) < 0.3, np.nan, y * 2),
    }
    y[:300] = np.round(y[:300], 1)
    return x, y


@pytest.mark.parametrize("cell", [60, 4000])
def test_neighbours_are_those_of_all_pairs(spark, data, cell):
    x, y = data
    rows = [tuple([float(y[i])] + [None if math.isnan(v[i]) else float(v[i]) for v in x.values()]) for i in range(len(y))]
    df = spark.createDataFrame(rows, "y double, " + ", ".join(f"{c} double" for c in x)).withColumn("none", F.lit(None).cast("double")).repartition(5)
    got = {r.feature: r.mutual_info for r in neighbours.neighbour_mutual_info(df, [*x, "none"], "y", cell=cell).collect()}
    want = {c: slow(v, y, 3) for c, v in x.items()}
    assert got == pytest.approx(want, abs=1e-9) and want["linear"] > 0.5 > want["noise"]


def test_the_nearest_of_many_leaves(monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 7)
    rng = np.random.default_rng(1)
    points, asking = np.round(rng.normal(0, 1, (300, 2)), 1), rng.normal(0, 2, (90, 2))
    want = np.sort(np.abs(asking[:, None] - points).max(2), 1)[:, :4]
    assert np.allclose(neighbours.nearest(points, asking, 4), want)
    assert np.isinf(neighbours.nearest(points[:2], asking, 4)[:, 2:]).all()


def test_a_point_is_compared_with_few_others(monkeypatch):
    rng = np.random.default_rng(3)
    points, seen, partition = rng.normal(0, 1, (6000, 2)), [], np.partition
    monkeypatch.setattr(np, "partition", lambda a, *args, **more: seen.append(a.size) or partition(a, *args, **more))
    found = neighbours.nearest(points, points, 4)
    assert sum(seen) < 200 * len(points)
    some = slice(0, 200)
    assert np.array_equal(found[some], np.sort(np.abs(points[some, None] - points).max(2), 1)[:, :4])


def test_only_distances_within_reach_are_wanted():
    rng = np.random.default_rng(4)
    points, asking = np.round(rng.normal(0, 1, (400, 2)), 1), rng.normal(0, 3, (150, 2))
    reach = rng.uniform(0, 1, 150)
    got, want = neighbours.nearest(points, asking, 3, reach), neighbours.nearest(points, asking, 3)
    near = want < reach[:, None]
    assert near.any() and np.array_equal(got[near], want[near])


def test_places_inside_are_told_as_differences_tell():
    rng = np.random.default_rng(5)
    values = np.unique(np.round(rng.normal(0, 1, 900), 2) / 3)
    x = rng.choice(values, 3000)
    r = np.where(rng.random(3000) < 0.2, 0.0, np.abs(x - rng.choice(values, 3000)))  # as a neighbour is: often right at an end
    low, high = neighbours.inside(values, x, r)
    here = np.abs(values - x[:, None]) < r[:, None]
    here[r == 0] = values == x[r == 0, None]
    assert np.array_equal(high - low, here.sum(1)) and np.array_equal(low, here.argmax(1))


def test_a_frequent_value_is_dealt_to_many_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "RANGE", 1)
    rng = np.random.default_rng(6)
    x, y = np.where(rng.random(900) < 0.5, 2.0, rng.normal(0, 1, 900)), rng.normal(0, 1, 900)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    cuts, made = [], neighbours.Cuts
    monkeypatch.setattr(neighbours, "Cuts", lambda *args: cuts.append(made(*args)) or cuts[0])
    got = neighbours.neighbour_mutual_info(df, ["x"], "y", cell=40).first().mutual_info
    assert got == pytest.approx(slow(x, y, 3), abs=1e-9)
    assert cuts[0].axes[1, 0][1].max() > 5


def test_thresholds_are_the_last_doubles_inside():
    rng = np.random.default_rng(2)
    x, r = rng.normal(0, 100, 2000), 10.0 ** rng.uniform(-8, 6, 2000)
    low, high = neighbours.thresholds(x, r)
    assert (np.abs(high - x) < r).all() and (np.abs(np.nextafter(high, np.inf) - x) >= r).all()
    assert (np.abs(low - x) < r).all() and (np.abs(np.nextafter(low, -np.inf) - x) >= r).all()
    assert [t.tolist() for t in neighbours.thresholds(np.array([2.0]), np.array([0.0]))] == [[2.0], [2.0]]


def test_digamma(spark):
    got = [r[0] for r in spark.range(1, 200).select(neighbours.digamma(F.col("id"))).collect()]
    assert np.allclose(got, [psi(m) for m in range(1, 200)], atol=1e-12)


def frame(spark, data):
    x, y = data
    rows = [tuple([float(y[i])] + [None if math.isnan(v[i]) else float(v[i]) for v in x.values()]) for i in range(len(y))]
    return spark.createDataFrame(rows, "y double, " + ", ".join(f"{c} double" for c in x)).repartition(5)


@pytest.mark.parametrize("listed", [0, 60, 1 << 20])
def test_lists_of_values_and_ranges_count_alike(spark, data, monkeypatch, listed):
    """No axis is listed, those of few values are, or all."""
    x, y = data
    monkeypatch.setattr(neighbours, "LISTED", listed)
    monkeypatch.setattr(neighbours, "RANGE", 1)
    ranges, count = [], neighbours._range_counts
    monkeypatch.setattr(neighbours, "_range_counts", lambda points, cuts, axes: ranges.append(axes) or count(points, cuts, axes))
    got = {r.feature: r.mutual_info for r in neighbours.neighbour_mutual_info(frame(spark, data), list(x), "y", cell=60).collect()}
    assert got == pytest.approx({c: slow(v, y, 3) for c, v in x.items()}, abs=1e-9)
    assert len(ranges) == (listed < 1000) and (listed or len(ranges[0]) == 14)
    assert listed != 60 or len(ranges[0]) == 13  # the rounded column alone has few


def test_axes_of_fewest_values_are_listed(monkeypatch):
    monkeypatch.setattr(neighbours, "LISTED", 100)
    monkeypatch.setattr(neighbours, "LISTED_IN_ALL", 150)
    assert neighbours.short_axes({(1, 0): 90, (1, 1): 101, (2, 0): 20, (2, 1): 60}) == [(2, 0), (2, 1)]
    assert neighbours.short_axes({}) == []


def test_no_feature_that_varies(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 9, "x double, y double")
    assert neighbours.neighbour_mutual_info(df, ["x"], "y").first().mutual_info == 0.0


def test_a_point_beside_room_asks_no_other_strip(spark):
    """Whole numbers end their strips, yet nothing is near on the other side."""
    rng = np.random.default_rng(8)
    rows = [(1, float(i % 8), float(v), 1) for i, v in enumerate(rng.permutation(8000) / 2000)]
    points = spark.createDataFrame(rows, "f int, x double, y double, n long")
    cuts = neighbours.Cuts(points, 3, 1)
    assert cuts.lows[1].tolist() == [0.0, *[v + 1 for v in cuts.strips[1]]]
    own = neighbours._within(points, cuts, 3)
    assert own.where("near IS NOT NULL").count() < 400
    wide = neighbours._within(points.withColumn("y", F.col("y") * 4000), cuts, 3)
    assert wide.where("near IS NOT NULL").count() > 4000


def test_few_pairs_need_no_leaves(monkeypatch):
    rng = np.random.default_rng(9)
    points, asking = np.round(rng.normal(0, 1, (300, 2)), 1), rng.normal(0, 2, (90, 2))
    want = neighbours.nearest(points, asking, 4), neighbours.nearest(points[:2], asking, 4), neighbours.nearest(points[:0], asking, 4)
    monkeypatch.setattr(neighbours, "FEW", 0)
    got = neighbours.nearest(points, asking, 4), neighbours.nearest(points[:2], asking, 4), neighbours.nearest(points[:0], asking, 4)
    assert all(np.array_equal(a, b) for a, b in zip(got, want))
    assert np.isinf(got[1][:, 2:]).all() and np.isinf(got[2]).all()


def test_rows_of_each_feature_come_together(monkeypatch):
    monkeypatch.setattr(neighbours, "BATCH", 25)
    rows = neighbours.pa.RecordBatch.from_pydict({"f": np.array([2, 1, 2, 3] * 10, np.int32), "x": np.arange(40.0)})
    found = [(f, x.tolist()) for f, x, _ in neighbours.by_feature([rows.slice(i, 4) for i in range(0, 40, 4)], "x")]
    assert [f for f, _ in found] == [1, 2, 3, 1, 2, 3] and sorted(v for _, x in found for v in x) == list(range(40))
    assert found[0][1] == [1.0 + 4 * i for i in range(7)]
