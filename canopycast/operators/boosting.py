"""Boosted regression trees of the second order, fitted on a binned column table.

Every column is cut into at most ``bins`` ranges once, and a row becomes one byte string. To look for splits each task adds up
slopes and rows by (node, column, range) in one array; Spark adds the tasks' sums, takes running sums over the ranges and
returns one row per node. The driver holds the trees and nothing that grows with the rows.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, fields

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources.staging import discard, staged, together

#: Range 0 holds missing values.
MISSING = 0
#: Sums of one search that a task holds; more nodes are looked at in turn.
CELLS = 4_000_000
#: Trees after which the predictions so far are written next to the rows.
TREES_PER_STAGE = 16
#: Columns whose limits are estimated in one job, and accuracy of the estimate (exact for as many rows).
COLUMNS_PER_JOB, ACCURACY = 64, 10_000
#: Ranges that one round of the exact selection cuts the values of a leaf into, and values that are left to be sorted.
PARTS, LEFT = 512, 256
#: Gains are compared after rounding to this many digits; of equal ones the first column, then the first range wins.
DIGITS = 9

# Other names of the same parameters.
ALIASES = {"iterations": "n_estimators", "depth": "max_depth", "l2_leaf_reg": "reg_lambda", "min_child_samples": "min_samples_leaf"}
LOSSES = ("squared", "pinball")


@dataclass(frozen=True)
class Settings:
    """What a fit can be given. ``subsample`` and ``colsample_bytree`` draw anew for each tree, by hashes.

    ``num_leaves`` grows the leaf of highest gain first, up to that number; without it every level is grown whole.
    ``random_strength`` adds noise to the order of the splits, which fades with the number of trees.
    """

    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    min_child_weight: float = 0.0
    min_samples_leaf: int = 1
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    num_leaves: int | None = None
    random_strength: float = 0.0
    max_bins: int = 64
    loss: str = "squared"
    alpha: float = 0.5
    seed: int = 42

    @classmethod
    def of(cls, params: Mapping) -> Settings:
        named = {ALIASES.get(k, k): v for k, v in params.items()}
        unknown = sorted(set(named) - {f.name for f in fields(cls)})
        if unknown:
            raise ValueError(f"unknown parameters of boosted trees: {', '.join(unknown)}")
        found = cls(**named)
        if found.loss not in LOSSES:
            raise ValueError(f"unknown loss {found.loss!r}, expected one of {LOSSES}")
        if not 2 <= found.max_bins <= 255 or found.max_depth < 0 or not 0 < found.alpha < 1:
            raise ValueError("max_bins is 2 to 255, max_depth is not negative, alpha lies between 0 and 1")
        return found


@dataclass
class Tree:
    """Nodes by number, the root first. A row goes left if its range is at most ``cut``; ``column`` is -1 in a leaf."""

    column: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float, rows: int) -> int:
        for name, x in (("column", -1), ("cut", 0), ("missing_left", True), ("left", -1), ("right", -1), ("value", value), ("rows", rows), ("gain", 0.0)):
            getattr(self, name).append(x)
        return len(self.column) - 1

    def split(self, node: int, best: Best, sides: tuple[int, int]) -> None:
        self.column[node], self.cut[node], self.missing_left[node], self.gain[node] = best.column, best.cut, best.missing_left, best.gain
        self.left[node], self.right[node] = sides

    def walk(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of a matrix of ranges."""
        column, cut, missing, left, right = (np.array(x) for x in (self.column, self.cut, self.missing_left, self.left, self.right))
        node, at = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(at := at[column[node[at]] >= 0]):
            here = node[at]
            code = bins[at, column[here]]
            node[at] = np.where(np.where(code == MISSING, missing[here], code <= cut[here]), left[here], right[here])
        return node

    def pruned(self, kept: set[int]) -> Tree:
        """The tree in which only the nodes of ``kept`` are split."""
        small, number = Tree(), {}
        waiting = [0]
        for old in waiting:
            number[old] = small.add(self.value[old], self.rows[old])
            if old in kept:
                waiting += [self.left[old], self.right[old]]
        for old in kept:
            best = Best(self.column[old], self.cut[old], self.missing_left[old], self.gain[old])
            small.split(number[old], best, (number[self.left[old]], number[self.right[old]]))
        return small


@dataclass(frozen=True)
class Best:
    """The best split of a node, with sums of slopes and numbers of rows on both sides."""

    column: int
    cut: int
    missing_left: bool
    gain: float
    left: tuple[float, int] = (0.0, 0)
    right: tuple[float, int] = (0.0, 0)


# ---------------------------------------------------------------- ranges


def limits(rows: DataFrame, columns: Sequence[str], bins: int, accuracy: int = ACCURACY) -> list[np.ndarray]:
    """Upper limits of the ranges of each column: distinct places ``k / bins`` of its values; a column without values has none."""
    shares, found = [k / bins for k in range(1, bins)], []
    for at in range(0, len(columns), COLUMNS_PER_JOB):
        part = columns[at : at + COLUMNS_PER_JOB]
        number = [F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in part]
        found += rows.agg(*[F.percentile_approx(x, shares, accuracy).alias(f"c{k}") for k, x in enumerate(number)]).first()
    return [np.unique(np.array(x if x is not None else [], float)) for x in found]


def to_bins(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Range numbers of a matrix of values: 0 if missing, else one more than the number of limits below the value."""
    out = np.empty(values.shape, np.uint8)
    for k, edge in enumerate(edges):
        x = values[:, k]
        out[:, k] = np.where(np.isnan(x), MISSING, np.searchsorted(edge, x, side="left") + 1)
    return out


def _numbers(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)


def binned(rows: DataFrame, columns: Sequence[str], target: str, edges: Sequence[np.ndarray], key: str | None) -> DataFrame:
    """``bins`` (one byte per column), ``y``, ``mark`` (hash of the key, or of the whole row) and ``base``, staged."""
    mark = F.xxhash64(*[F.col(c) for c in ([key] if key else [*columns, target])])
    inputs = rows.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(columns)], F.col(target).cast("double").alias("y"), mark.alias("mark"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.column_stack([_numbers(batch.column(k)) for k in range(len(edges))]) if edges else np.empty((batch.num_rows, 0))
            codes = pa.array([x.tobytes() for x in to_bins(values, edges)], pa.binary())
            zero = pa.array(np.zeros(batch.num_rows))
            yield pa.RecordBatch.from_arrays([codes, batch.column("y"), batch.column("mark"), zero], ["bins", "y", "mark", "base"])

    return staged(inputs.mapInArrow(run, "bins binary, y double, mark long, base double"), "binned")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    rows = len(column)
    offset = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if rows else 0
    return np.frombuffer(column.buffers()[2], np.uint8, rows * width, offset).reshape(rows, width) if rows and width else np.zeros((rows, width), np.uint8)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Evenly spread 64-bit hashes of whole numbers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        z = np.asarray(x).view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def drawn_columns(count: int, share: float, seed: int, tree: int) -> list[int]:
    """The columns of a tree: those of least hash, at least one."""
    take = max(1, math.ceil(share * count - 1e-9))
    order = np.argsort(mixed(np.arange(count), seed * 1_000_003 + tree + 1), kind="stable")
    return sorted(order[:take].tolist()) if take < count else list(range(count))


# ---------------------------------------------------------------- one fit


class Fit:
    """Rows, settings and the trees so far."""

    def __init__(self, rows: DataFrame, width: int, settings: Settings):
        # the first rows may be shared with other fits; those written later belong to this one
        self.rows, self.shared, self.width, self.s = rows, rows, width, settings
        self.trees: list[Tree] = []
        self.new: list[Tree] = []
        self.base = 0.0

    def batches(self, number: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]:
        """Reads batches as (ranges, target less prediction) of the rows that tree ``number`` may see."""
        base, new, width, rate, s = self.base, list(self.new), self.width, self.s.learning_rate, self.s
        below = np.uint64(min(2**64 - 1, int(s.subsample * 2**64)))

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                bins, y = _matrix(batch.column("bins"), width), batch.column("y").to_numpy()
                rest = y - batch.column("base").to_numpy() - base
                if s.subsample < 1:
                    use = mixed(batch.column("mark").to_numpy(), s.seed * 7919 + number) < below
                    bins, rest = bins[use], rest[use]
                for tree in new:
                    rest = rest - rate * np.array(tree.value)[tree.walk(bins)]
                yield bins, rest

        return read

    def slope(self) -> Callable[[np.ndarray], np.ndarray]:
        """Slope of the loss in the prediction; its curvature counts as 1 in both losses."""
        if self.s.loss == "squared":
            return lambda rest: -rest
        alpha = self.s.alpha
        return lambda rest: np.where(rest > 0, -alpha, 1 - alpha)

    def sums(self, tree: Tree, nodes: Sequence[int], columns: Sequence[int], number: int) -> DataFrame:
        """``slot, column, bin, g, n``: slopes and rows by node (its place in ``nodes``), column and range."""
        read, slope, width = self.batches(number), self.slope(), 256
        slot = np.full(len(tree.column), -1)
        slot[list(nodes)] = np.arange(len(nodes))
        shape = len(columns), len(nodes), width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g, n = np.zeros(shape), np.zeros(shape, np.int64)
            for bins, rest in read(batches):
                at = slot[tree.walk(bins)]
                use = at >= 0
                at, bins, d = at[use] * width, bins[use], slope(rest[use])
                for k, column in enumerate(columns):
                    cell = at + bins[:, column]
                    g[k] += np.bincount(cell, d, len(nodes) * width).reshape(shape[1:])
                    n[k] += np.bincount(cell, minlength=len(nodes) * width).reshape(shape[1:])
            k, node, code = np.nonzero(n)
            found = [node, np.array(columns, np.int64)[k], code, g[k, node, code], n[k, node, code]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["slot", "column", "bin", "g", "n"])

        each = self.rows.select("bins", "y", "mark", "base").mapInArrow(run, "slot long, column long, bin long, g double, n long")
        return each.groupBy("slot", "column", "bin").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))

    def search(self, tree: Tree, nodes: Sequence[int], columns: Sequence[int], number: int) -> dict[int, Best | None]:
        """The best split of each node, if one is allowed."""
        found: dict[int, Best | None] = {}
        at_once = max(1, CELLS // (256 * max(1, len(columns))))
        for at in range(0, len(nodes), at_once):
            part = list(nodes[at : at + at_once])
            found |= dict.fromkeys(part)
            if not columns:
                continue
            table = best_splits(self.sums(tree, part, columns, number), self.s, number, len(self.trees))
            for r in table.collect():  # one row per node
                best = r["best"]
                found[part[r["slot"]]] = Best(
                    -best["column"], -best["bin"], best["missing_left"], best["gain"], (best["gl"], best["nl"]), (best["gr"], best["nr"])
                )
        return found

    def weight(self, side: tuple[float, int]) -> float:
        g, n = side
        return -math.copysign(max(abs(g) - self.s.reg_alpha, 0.0), g) / (n + self.s.reg_lambda) if n else 0.0

    def totals(self, number: int) -> tuple[float, int]:
        """Sum of slopes and number of the rows that a tree sees."""
        read, slope = self.batches(number), self.slope()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [(slope(rest).sum(), len(rest)) for _, rest in read(batches)]
            yield pa.RecordBatch.from_pydict({"g": [float(sum(g for g, _ in parts))], "n": [sum(n for _, n in parts)]})

        row = self.rows.mapInArrow(run, "g double, n long").agg(F.sum("g"), F.sum("n")).first()
        return row[0] or 0.0, row[1] or 0

    def grow(self) -> Tree:
        """One tree. Leaves are split in the order of their gains; a node is looked at once that order reaches its parent.

        The order is played through with what is known. Nodes whose children have not been looked at yet get them in one
        search for all, and the order is played again, until it meets known nodes only.
        """
        s, number = self.s, len(self.trees) + 1
        columns = drawn_columns(self.width, s.colsample_bytree, s.seed, number) if self.width else []
        tree, depth = Tree(), {0: 0}
        tree.add(0.0, 0)
        known = self.search(tree, [0], columns, number) if s.max_depth else {0: None}
        top = known[0]
        side = (top.left[0] + top.right[0], top.left[1] + top.right[1]) if top else self.totals(number)
        tree.value[0], tree.rows[0] = self.weight(side), side[1]
        while True:
            taken, heap = [], [(-known[0].gain, 0)] if known[0] else []
            while heap and (s.num_leaves is None or len(taken) + 1 < s.num_leaves):
                _, node = heapq.heappop(heap)
                taken.append(node)
                for child in (tree.left[node], tree.right[node]):
                    if child >= 0 and known[child]:
                        heapq.heappush(heap, (-known[child].gain, child))
            fresh = [node for node in taken if tree.left[node] < 0]
            if not fresh:
                break
            new = []
            for node in fresh:
                sides = []
                for half in (known[node].left, known[node].right):
                    child = tree.add(self.weight(half), half[1])
                    depth[child] = depth[node] + 1
                    known[child] = None
                    if depth[child] < s.max_depth and half[1] >= 2 * s.min_samples_leaf:
                        new.append(child)
                    sides.append(child)
                tree.split(node, known[node], tuple(sides))
            if new:
                known |= self.search(tree, new, columns, number)
        tree = tree.pruned(set(taken))
        if s.loss == "pinball":
            leaves = [k for k, c in enumerate(tree.column) if c < 0]
            found = self.leaf_quantiles(tree, leaves, number)
            tree.value = [found.get(k, 0.0) for k in range(len(tree.column))]
        return tree

    def leaf_quantiles(self, tree: Tree, leaves: Sequence[int], number: int) -> dict[int, float]:
        """The value at place ``ceil(alpha * rows)`` of what is left in each leaf, exactly.

        Doubles are compared as whole numbers of the same order. A round counts each leaf's values in ``PARTS`` equal ranges of
        these numbers and keeps the range with the wanted place; once at most ``LEFT`` values are in it they are sorted.
        """
        read, alpha = self.batches(number), self.s.alpha
        span = {leaf: (-(2**63), 2**63 - 1, None, None) for leaf in leaves}  # low, high, place wanted within, rows within
        result: dict[int, float] = {}

        def table(work: Callable[[np.ndarray, np.ndarray], np.ndarray], low: np.ndarray, high: np.ndarray, schema: str) -> DataFrame:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for bins, rest in read(batches):
                    leaf, order = tree.walk(bins), ordered(rest)
                    use = (order >= low[leaf]) & (order <= high[leaf])
                    cells, counts = np.unique(work(leaf[use], order[use]), axis=0, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(cells[:, 0]), pa.array(cells[:, 1]), pa.array(counts)], ["leaf", "part", "n"])

            return self.rows.mapInArrow(run, schema).groupBy("leaf", "part").agg(F.sum("n").alias("n"))

        while span:
            low, high = np.ones(len(tree.column), np.int64), np.zeros(len(tree.column), np.int64)
            for leaf, (a, b, *_) in span.items():
                low[leaf], high[leaf] = a, b
            step = np.maximum((high.astype(float) - low.astype(float)) / PARTS, 1).astype(np.uint64) + np.uint64(1)

            def part(leaf: np.ndarray, order: np.ndarray) -> np.ndarray:
                with np.errstate(over="ignore"):
                    from_low = order.view(np.uint64) - low[leaf].view(np.uint64)
                return np.stack([leaf, (from_low // step[leaf]).astype(np.int64)], 1)

            small = all(n is not None and n <= LEFT for *_, n in span.values())
            found = table((lambda leaf, order: np.stack([leaf, order], 1)) if small else part, low, high, "leaf long, part long, n long")
            by_leaf: dict[int, list[tuple[int, int]]] = {}
            for r in found.orderBy("leaf", "part").collect():  # PARTS rows a leaf at most
                by_leaf.setdefault(r["leaf"], []).append((r["part"], r["n"]))
            ongoing = {}
            for leaf, (a, _, place, _) in span.items():
                counts = by_leaf.get(leaf, [])
                if place is None:
                    place = max(1, math.ceil(alpha * sum(n for _, n in counts) - 1e-9))
                for where, n in counts:
                    if place <= n:
                        break
                    place -= n
                else:
                    continue  # a leaf without rows
                if small:
                    result[leaf] = float(unordered(np.array([where]))[0])
                    continue
                size = int(step[leaf])
                begin = a + where * size
                if size == 1:
                    result[leaf] = float(unordered(np.array([begin]))[0])
                else:
                    ongoing[leaf] = (begin, min(begin + size - 1, 2**63 - 1), place, n)
            span = ongoing
        return result

    def start(self) -> None:
        """The first prediction: the mean of the target, or its quantile."""
        if self.s.loss == "squared":
            self.base = self.rows.agg(F.avg("y")).first()[0] or 0.0
        else:
            stump = Tree()
            stump.add(0.0, 0)
            whole = Fit(self.rows, self.width, Settings(loss="pinball", alpha=self.s.alpha))
            self.base = whole.leaf_quantiles(stump, [0], 0).get(0, 0.0)

    def write_predictions(self) -> None:
        """Put the predictions of the new trees next to the rows."""
        new, width, rate = list(self.new), self.width, self.s.learning_rate

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins, base = _matrix(batch.column("bins"), width), batch.column("base").to_numpy()
                for tree in new:
                    base = base + rate * np.array(tree.value)[tree.walk(bins)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("bins", "y", "mark")), pa.array(base)], ["bins", "y", "mark", "base"])

        before = self.rows
        self.rows = staged(before.select("bins", "y", "mark", "base").mapInArrow(run, before.schema), "binned")
        if before is not self.shared:
            discard(before)
        self.new = []

    def run(self) -> Fit:
        self.start()
        while len(self.trees) < self.s.n_estimators:
            tree = self.grow()
            self.trees.append(tree)
            self.new.append(tree)
            if len(self.new) == TREES_PER_STAGE and len(self.trees) < self.s.n_estimators:
                self.write_predictions()
        if self.rows is not self.shared:
            discard(self.rows)
        return self


def ordered(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles; minus zero counts as zero."""
    bits = (x + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def unordered(x: np.ndarray) -> np.ndarray:
    return np.where(x < 0, x ^ np.int64(0x7FFFFFFFFFFFFFFF), x).view(np.float64)


def best_splits(sums: DataFrame, s: Settings, number: int, before: int) -> DataFrame:
    """``slot, best``: of every node the split of highest gain, of its ``sums`` by column and range.

    Missing values are tried on both sides; on the left if nothing tells. Columns and ranges are stored as negative numbers, so
    that the first of equal splits is the largest.
    """
    whole = Window.partitionBy("slot", "column")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    present = F.col("bin") != MISSING
    rows = sums.select(
        "*", F.sum("g").over(whole).alias("g_all"), F.sum("n").over(whole).alias("n_all"),
        *[F.coalesce(F.sum(F.when(~present, F.col(c))).over(whole), F.lit(0)).alias(f"{c}0") for c in ("g", "n")],
        *[F.sum(F.when(present, F.col(c))).over(upto).alias(f"{c}1") for c in ("g", "n")],
    ).where(present)
    left = F.explode(F.array(F.lit(True), F.lit(False))).alias("missing_left")
    rows = rows.select("*", left).where("missing_left OR n0 > 0")
    with_missing = F.when(F.col("missing_left"), F.lit(1)).otherwise(F.lit(0))
    gl, nl = F.col("g1") + F.col("g0") * with_missing, F.col("n1") + F.col("n0") * with_missing
    rows = rows.select("slot", "column", "bin", "missing_left", "g_all", "n_all", gl.alias("gl"), nl.alias("nl"))
    rows = rows.select("*", (F.col("g_all") - F.col("gl")).alias("gr"), (F.col("n_all") - F.col("nl")).alias("nr"))

    def score(g: str, n: str) -> Column:
        lean = F.greatest(F.abs(F.col(g)) - F.lit(float(s.reg_alpha)), F.lit(0.0))
        return lean * lean / (F.col(n) + F.lit(float(s.reg_lambda)))

    least = max(s.min_samples_leaf, s.min_child_weight, 1)
    gain = F.round((score("gl", "nl") + score("gr", "nr") - score("g_all", "n_all")) / 2, DIGITS)
    rows = rows.where((F.col("nl") >= F.lit(least)) & (F.col("nr") >= F.lit(least))).withColumn("gain", gain).where("gain > 0")
    rank = F.col("gain")
    if s.random_strength:
        draw = lambda k: (F.pmod(F.xxhash64(F.lit(s.seed), F.lit(number), "slot", "column", F.lit(k)), F.lit(1_000_003)) + 1) / 1_000_004.0
        normal = F.sqrt(-2 * F.log(draw(0))) * F.cos(2 * math.pi * draw(1))
        rank = F.sqrt("gain") + F.lit(s.random_strength / (1 + before)) * normal
    minus = [(-F.col(c)).alias(c) for c in ("column", "bin")]
    best = F.max(F.struct(rank.alias("rank"), *minus, "missing_left", "gain", "gl", "nl", "gr", "nr"))
    return rows.groupBy("slot").agg(best.alias("best"))


# ---------------------------------------------------------------- the fitted model


@dataclass(frozen=True)
class Boosted:
    """Fitted trees over named columns, with the limits of their ranges."""

    base: float
    rate: float
    edges: list[np.ndarray]
    trees: list[Tree]
    features_col: str = "_features"
    prediction_col: str = "pred_tch"

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the prediction of every row, read from its feature vector; NaN is a missing value."""
        base, rate, edges, trees = self.base, self.rate, self.edges, self.trees

        @F.pandas_udf("double")
        def predict(vectors):  # noqa: ANN001, ANN202
            import pandas as pd

            values = np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, len(edges)))
            bins = to_bins(values, edges)
            out = np.full(len(bins), base)
            for tree in trees:
                out += rate * np.array(tree.value)[tree.walk(bins)]
            return pd.Series(out)

        return df.withColumn(self.prediction_col, predict(vector_to_array(F.col(self.features_col))))

    def nodes(self) -> list[tuple]:
        """One row per node: ``tree, node, column, threshold, missing_left, left, right, value, cover, gain``. A value up to the
        threshold goes left, a null threshold sends all values left; ``value`` holds the learning rate."""
        out = []
        for t, tree in enumerate(self.trees):
            for k, c in enumerate(tree.column):
                edge = None if c < 0 or tree.cut[k] > len(self.edges[c]) else float(self.edges[c][tree.cut[k] - 1])
                inner = c >= 0
                out.append(
                    (t, k, c if inner else None, edge, tree.missing_left[k] if inner else None, tree.left[k] if inner else None,
                     tree.right[k] if inner else None, self.rate * tree.value[k], int(tree.rows[k]), float(tree.gain[k]))
                )
        return out

    def text(self) -> str:
        return json.dumps({"base": self.base, "rate": self.rate, "edges": [e.tolist() for e in self.edges], "trees": [vars(t) for t in self.trees]})

    @classmethod
    def read(cls, text: str) -> Boosted:
        found = json.loads(text)
        return cls(found["base"], found["rate"], [np.array(e, float) for e in found["edges"]], [Tree(**t) for t in found["trees"]])


NODES = "tree int, node int, column int, threshold double, missing_left boolean, left int, right int, value double, cover long, gain double"


def node_table(model: Boosted, spark: SparkSession | None = None) -> DataFrame:
    return (spark or SparkSession.active()).createDataFrame(model.nodes(), NODES)


@dataclass(frozen=True)
class Binned:
    """The rows with a target as ranges of their columns; any number of fits read it."""

    table: DataFrame
    edges: list[np.ndarray]
    bins: int


def bin_rows(rows: DataFrame, columns: Sequence[str], target: str, bins: int = Settings.max_bins, key: str | None = None) -> Binned:
    """Cut the numeric ``columns`` into ranges and write the rows with a target. Missing values go to the better side of every split."""
    rows = rows.where(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double")))
    edges = limits(rows, columns, bins)
    return Binned(binned(rows, columns, target, edges, key), edges, bins)


def fit_binned(data: Binned, params: Mapping) -> Boosted:
    settings = Settings.of(params)
    if settings.max_bins != data.bins:
        raise ValueError(f"the table has {data.bins} ranges a column, not max_bins={settings.max_bins}")
    fit = Fit(data.table, len(data.edges), settings).run()
    return Boosted(fit.base, settings.learning_rate, data.edges, fit.trees)


def fit_boosted(rows: DataFrame, columns: Sequence[str], target: str, params: Sequence[Mapping], key: str | None = None) -> list[Boosted]:
    """Trees for each set of parameters, as concurrent jobs on one binned table; the sets share ``max_bins``."""
    data = bin_rows(rows, columns, target, Settings.of(params[0]).max_bins, key)
    found = together(rows.sparkSession, [lambda p=p: fit_binned(data, p) for p in params])
    discard(data.table)
    return found
