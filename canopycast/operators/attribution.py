"""How far each feature moves the prediction of a row away from the mean, for tree models.

A tree is a table of paths from the root to its leaves. On a path every feature stands once: with the range of its values that
leads on, and with the share of training rows that its splits let through. A leaf's value is shared out among the features of its
path as in the game in which a feature that is absent passes with that share; the sums over sets of features are the
coefficients of a polynomial, so a path of m features costs m products and not two to the power of m. Attributions and the
expected value add up to the prediction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import KEY
from ..sources.staging import staged_path

from .models import BOOSTED, FEATURES, MOST_NODES, Fitted

PATHS = "tree int, leaf int, value double, feature int, low double, high double, missing boolean, share double"


@dataclass(frozen=True)
class Path:
    """Of each feature on the way to a leaf: which values pass (above ``low``, up to ``high``, missing ones) and the share of rows."""

    tree: int
    leaf: int
    value: float
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    missing: np.ndarray
    share: np.ndarray


def node_rows(fitted: Fitted) -> list[tuple]:
    """``tree, node, column, threshold, missing_left, left, right, value, cover`` of a tree model, at most ``MOST_NODES``."""
    if fitted.kind in BOOSTED:
        return [n[:9] for n in fitted.model.nodes()]
    if fitted.kind != "forest":
        raise ValueError("attributions need a tree model")
    if fitted.model.totalNumNodes > MOST_NODES:
        raise ValueError(f"the model has {fitted.model.totalNumNodes} nodes; attributions hold at most {MOST_NODES}")
    spark = SparkSession.active()
    path = staged_path(spark, "forest")
    fitted.model.write().save(path)
    each = 1.0 / fitted.model.getNumTrees
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    return [
        (n.treeID, n.id, n.split.featureIndex, n.split.leftCategoriesOrThreshold[0], False, n.leftChild, n.rightChild, n.prediction * each, n.impurityStats[0])
        if n.leftChild >= 0
        else (n.treeID, n.id, None, None, None, None, None, n.prediction * each, n.impurityStats[0])
        for n in nodes
    ]


def paths(nodes: Sequence[tuple]) -> Iterator[Path]:
    """The paths of all trees, without leaves that no training row reached."""
    of_node = {(n[0], n[1]): n for n in nodes}
    for tree in sorted({n[0] for n in nodes}):
        waiting = [(0, {})]
        while waiting:
            node, tests = waiting.pop()
            _, _, column, threshold, missing_left, left, right, value, cover = of_node[tree, node]
            if column is None:
                names = list(tests)
                low, high, missing, share = (np.array([tests[c][k] for c in names]) for k in range(4))
                yield Path(tree, node, value, np.array(names, int), low, high, missing.astype(bool), share)
                continue
            threshold = math.inf if threshold is None else threshold
            for child, goes_left in ((left, True), (right, False)):
                part = of_node[tree, child][8] / cover if cover else 0.0
                if not part:
                    continue
                low, high, missing, share = tests.get(column, (-math.inf, math.inf, True, 1.0))
                low, high = (low, min(high, threshold)) if goes_left else (max(low, threshold), high)
                waiting.append((child, {**tests, column: (low, high, missing and missing_left == goes_left, share * part)}))


def path_table(fitted: Fitted) -> DataFrame:
    """One row per path and feature; ``feature`` is the place in the model's list. A tree of one leaf has no row."""
    rows = [
        (p.tree, p.leaf, p.value, int(f), float(a), float(b), bool(m), float(s))
        for p in paths(node_rows(fitted))
        for f, a, b, m, s in zip(p.feature, p.low, p.high, p.missing, p.share)
    ]
    return SparkSession.active().createDataFrame(rows, PATHS)


def shared_out(passes: np.ndarray, share: np.ndarray) -> np.ndarray:
    """How much of a leaf's value goes to each feature, for each row of ``passes`` (does the row pass the feature's tests).

    The polynomial of the other features has the passing ones as ``share + t`` and the others as ``share``; the coefficient of
    ``t^k`` counts sets of k passing features and is weighted with the share of orders in which just these come first.
    """
    m = len(share)
    weight = np.array([math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)])
    out = np.empty(passes.shape)
    for i in range(m):
        terms = np.zeros((len(passes), m))
        terms[:, 0] = 1.0
        for j in range(m):
            if j != i:
                terms[:, 1:], terms[:, 0] = terms[:, 1:] * share[j] + passes[:, [j]] * terms[:, :-1], terms[:, 0] * share[j]
        out[:, i] = (terms @ weight) * (passes[:, i] - share[i])
    return out


def expected(fitted: Fitted) -> float:
    """The mean of the predictions of the training rows, as the trees hold it."""
    base = fitted.model.base if fitted.kind in BOOSTED else 0.0
    return base + sum(p.value * math.prod(p.share) for p in paths(node_rows(fitted)))


def attributions(fitted: Fitted, df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and one column per feature: how far it moves the row's prediction away from ``expected``.

    The paths go to every task; a path's rows are looked at by which of its tests they pass, so equal patterns are worked out once.
    """
    every, width = [p for p in paths(node_rows(fitted)) if len(p.feature)], len(fitted.features)
    # single features are compared as the model does
    as_seen = (lambda x: x) if fitted.kind in BOOSTED else (lambda x: np.nan_to_num(x, nan=0.0))

    @F.pandas_udf("array<double>")
    def share_out(vectors):  # noqa: ANN001, ANN202
        import pandas as pd

        out = np.zeros((len(vectors), width))
        if len(vectors):
            values = as_seen(np.stack(vectors.to_numpy()))
            gaps = np.isnan(values)
            for p in every:
                x, gap = values[:, p.feature], gaps[:, p.feature]
                passes = np.where(gap, p.missing, (x > p.low) & (x <= p.high))
                code = passes @ (1 << np.arange(len(p.feature), dtype=np.int64))
                _, first, pattern = np.unique(code, return_index=True, return_inverse=True)
                out[:, p.feature] += p.value * shared_out(passes[first].astype(float), p.share)[pattern]
        return pd.Series(list(out))

    rows = fitted.vectors(df).withColumn("_shares", share_out(vector_to_array(F.col(FEATURES))))
    kept = keep or (KEY,)
    return rows.select(*kept, *[F.get("_shares", k).alias(c) for k, c in enumerate(fitted.features) if c not in kept])


def mean_attributions(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, mean_abs_attribution`` of ``attributions`` rows, in one pass."""
    means = rows.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in features])
    return means.unpivot([], list(features), "feature", "mean_abs_attribution")
