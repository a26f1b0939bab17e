"""Exact top-k search against brute force."""

import random

import numpy as np
import pytest

from canopycast.llm import mtree
from check import compare, duck

SCHEMA = "vec_id long, embedding array<float>, v string, router int, subtree string"


def brute(rows, k, every):
    whole = {i: np.floor(64 * np.array(x, np.float32).astype(float)).astype(np.int64) for i, x in rows.items()}
    dim = max(map(len, whole.values()), default=0)
    whole = {i: np.pad(v, (0, dim - len(v))) for i, v in whole.items()}
    out = set()
    for q in whole:
        if q % every == 0:
            best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:k]
            out.update((q, rank + 1, i, -s) for rank, (s, i) in enumerate(best))
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, x, "v", 1, "s") for i, x in rows], SCHEMA)


@pytest.mark.parametrize("small", [False, True])
def test_top_k(spark, monkeypatch, small):
    if small:
        for name, value in (("SAMPLE", 40), ("ROUTERS", 5), ("SUBTREE", 30), ("PAGE", 4), ("BLOCK", 3)):
            monkeypatch.setattr(mtree, name, value)
    rng = random.Random(5)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i - 100, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(150)]  # equal vectors: ties go to the smaller id
    got = mtree.top_k(table(spark, rows)).collect()
    assert {tuple(r) for r in got} == brute(dict(rows), 20, 20) and len(got) == 20 * sum(i % 20 == 0 for i, _ in rows)


def test_odd_vectors(spark):
    good = [(0, [1.0, -2.0]), (1, [3.0]), (2, []), (20, [0.0, 0.0, 1.5]), (40, [1.0, 1.0]), (40, [1.0, 1.0])]
    bad = [(60, None), (61, [1.0, None]), (80, [float("nan")]), (81, [float("inf"), 0.0]), (82, [float("-inf")]), (None, [1.0])]
    got = mtree.top_k(table(spark, good + bad)).collect()
    assert {tuple(r) for r in got} == brute(dict(good), 20, 20)
    assert mtree.top_k(table(spark, [])).collect() == [] and mtree.top_k(table(spark, bad)).collect() == []
    assert mtree.top_k(table(spark, [(0, [1.0])])).collect() == []


def test_large_components(spark):
    rows = [(i, [float(i) * 1e7, 3e8]) for i in range(60)]
    assert {tuple(r) for r in mtree.top_k(table(spark, rows), k=5).collect()} == brute(dict(rows), 5, 20)


def test_equals_sql(spark):
    from canopycast.llm.queries import ORACLES, QUERIES

    sf = "/root/testdata/sf0.01"
    assert compare(QUERIES["op2_mtree_search"](spark, sf).toPandas(), duck(sf).execute(ORACLES["op2_mtree_search"]).df()) == ""


def test_bounds_spare_work():
    """Clustered vectors: most pages are never opened."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8)) * 300
    vectors = (centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 8)) * 3).astype(np.int64)
    top = int((vectors**2).sum(axis=1).max())
    space = mtree.Space(8, top, int(np.abs(vectors).max()))
    looked = []
    space_scores = space.scores
    space.scores = lambda v, q: looked.append(len(v)) or space_scores(v, q)
    tree = mtree.Subtree(mtree.build_subtree(np.arange(3000), vectors, space), space)
    far = vectors[(vectors**2).sum(axis=1).argmax()]
    best = tree.search(-1, far, 5, None)
    scores = vectors @ far
    assert sorted(s for s, _ in best) == sorted(scores)[-5:] and sum(looked) < 600
