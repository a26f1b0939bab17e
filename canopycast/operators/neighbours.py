"""Mutual information of two continuous columns from nearest neighbours, without a task that holds a column.

Distances are the larger of the two coordinates' differences, after each column is divided by its deviation. The plane of each
feature is cut into cells of about even numbers of points. A cell finds the nearest neighbours within; points whose
distance reaches beyond the cell ask the cells that it reaches. How many points lie nearer on one axis alone is counted among the
points of a range of that axis, or looked up in a list of its values if they are few. Equal points are one point with a number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.staging import staged
from .boosting import ordered, unordered

#: Neighbours, points of a cell, points of a leaf, which are compared with each of the points that ask at a time, and cells' worth of a range.
NEIGHBOURS, CELL, LEAF, ASKING, RANGE = 3, 4000, 32, 1024, 16
#: Pairs of points that are compared without leaves.
FEW = 1 << 18
#: Points that reach beyond their cell, as many as ask at a time.
SLICE = 256
#: Values of an axis, and of all axes together, that are listed with their counts and go to all tasks.
LISTED, LISTED_IN_ALL = 1 << 20, 1 << 22
#: Rows that a task splits by feature at a time, and values of a strip that one stands for where limits of cells are sought.
BATCH, THIN = 200_000, 16
#: What a row of a range is there for: it is counted and asks, it only asks, it is only counted, or it is an end of a longer interval.
BOTH, ASKED, COUNTED, LOWER, UPPER = range(5)


def leaves(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Index arrays of at most ``size`` near points: halves at the median of the wider side."""
    waiting, found = [np.arange(len(points))], []
    while waiting:
        part = waiting.pop()
        if len(part) <= size:
            if len(part):
                found.append(part)
            continue
        own = points[part]
        order = np.argsort(own[:, np.argmax(np.ptp(own, axis=0))], kind="stable")
        waiting += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
    return found


def nearest(points: np.ndarray, asking: np.ndarray, k: int, reach: np.ndarray | None = None) -> np.ndarray:
    """The ``k`` least distances of every asking point to the points, ascending; infinite where there are fewer.

    With ``reach``, only distances below that of the asking point are wanted; others may be infinite.
    """
    out = np.full((len(asking), k), np.inf)
    if len(asking) * len(points) <= FEW:
        # all pairs: cheaper than leaves of the points
        block = np.abs(points[:, 0] - asking[:, 0, None])
        np.maximum(block, np.abs(points[:, 1] - asking[:, 1, None]), out=block)
        many = min(k, len(points))
        if many:
            out[:, :many] = np.sort(np.partition(block, many - 1, axis=1)[:, :many], axis=1)
        return out
    parts = leaves(points, LEAF)
    if not parts or not len(asking):
        return out
    width = max(map(len, parts))
    there = np.full((len(parts), width, 2), np.inf)
    for i, part in enumerate(parts):
        there[i, : len(part)] = points[part]
    lows, highs = there.min(1), np.array([points[part].max(0) for part in parts])
    for part in leaves(asking, ASKING):
        own = asking[part]
        limit = np.full(len(part), np.inf) if reach is None else reach[part]
        near = np.maximum(np.maximum(lows - own.max(0), own.min(0) - highs), 0).max(1) < limit.max()
        boxes = np.flatnonzero(near)
        if not len(boxes):
            continue
        gaps = np.zeros((len(part), len(boxes)))
        for axis in (0, 1):
            x = own[:, axis, None]
            np.maximum(gaps, np.maximum(lows[boxes, axis] - x, x - highs[boxes, axis]), out=gaps)
        best = np.full((len(part), k), np.inf)
        rows, columns = np.arange(len(part)), gaps.argmin(1)
        # the nearest leaf first, then one more a round for the points that it may still serve
        while len(rows):
            block = np.abs(there[boxes[columns], :, 0] - own[rows, 0, None])
            np.maximum(block, np.abs(there[boxes[columns], :, 1] - own[rows, 1, None]), out=block)
            best[rows] = np.partition(np.concatenate([best[rows], block], 1), k - 1, axis=1)[:, :k]
            gaps[rows, columns] = np.inf
            columns = gaps[rows].argmin(1)
            ask = gaps[rows, columns] < np.minimum(best[rows].max(1), limit[rows])
            rows, columns = rows[ask], columns[ask]
        out[part] = np.sort(best, axis=1)
    return out


def _list(values: np.ndarray) -> pa.ListArray:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(values.ravel()))


def thresholds(x: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest number whose difference from ``x``, as doubles differ, is below ``r``; ``x`` itself where that is 0."""
    top, one, ends = np.uint64(1 << 63), np.uint64(1), []
    place = lambda v: ordered(v).view(np.uint64) ^ top
    value = lambda u: unordered((u ^ top).view(np.int64))
    for sign in (-1, 1):
        # halving in the order of the doubles, from a number inside to one outside
        step = (lambda u, n: u + n) if sign > 0 else (lambda u, n: u - n)
        apart = (lambda u, v: v - u) if sign > 0 else (lambda u, v: u - v)
        inside, outside = place(x), place(x + sign * 2 * r)
        outside = np.where(outside == inside, step(inside, one), outside)
        while (open_ := apart(inside, outside) > one).any():
            middle = step(inside, apart(inside, outside) // np.uint64(2))
            nearer = np.abs(value(middle) - x) < r
            inside, outside = np.where(open_ & nearer, middle, inside), np.where(open_ & ~nearer, middle, outside)
        ends.append(np.where(r > 0, value(inside), x))
    return ends[0], ends[1]


def digamma(m: Column) -> Column:
    """Digamma of whole numbers from 1: harmonic numbers up to 16, the asymptotic series beyond."""
    harmonic = [-np.euler_gamma]
    for k in range(1, 17):
        harmonic.append(harmonic[-1] + 1 / k)
    x = m.cast("double")
    series = F.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6) + 1 / (240 * x**8)
    return F.when(m <= 16, F.get(F.array(*[F.lit(float(h)) for h in harmonic]), (m - 1).cast("int"))).otherwise(series)


def inside(values: np.ndarray, x: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ascending values of the first whose difference from ``x``, as doubles differ, is below ``r`` and behind the last.

    Where ``r`` is 0, of ``x`` itself.
    """
    low, high = np.searchsorted(values, x - r), np.searchsorted(values, x + r, "right")
    ends, apart = np.append(values, np.inf), r > 0
    # sums are rounded, differences too: steps back or on until both ends are right
    for place, near, step in (
        (low, lambda: (low > 0) & (x - ends[low - 1] < r), -1),
        (low, lambda: (low < len(values)) & (x - ends[low] >= r), 1),
        (high, lambda: (high < len(values)) & (ends[high] - x < r), 1),
        (high, lambda: (high > 0) & (ends[high - 1] - x >= r), -1),
    ):
        while (move := apart & near()).any():
            place += step * move
    return low, high


class Cuts:
    """Limits of each feature: of strips, with the least number of each, of the cells of each strip, and of the ranges of both axes.

    There is about one number per cell. A range whose upper limit came out several times holds a frequent value; its
    rows are dealt to as many parts.
    """

    def __init__(self, points: DataFrame, side: int, ranges: int):
        shares = [[i / many for i in range(1, many)] or [1.0] for many in (side, ranges)]
        found = points.groupBy("f").agg(F.percentile_approx("x", shares[0] + shares[1]).alias("x"), F.percentile_approx("y", shares[1]).alias("y"))
        self.strips, self.lows, self.axes, self.cells, self.first, cells, parts = {}, {}, {}, {}, {}, 0, 0
        for row in sorted(found.collect()):
            self.strips[row.f] = np.unique(row.x[: len(shares[0])])
            for axis, limits in ((0, row.x[len(shares[0]) :]), (1, row.y)):
                limits, times = np.unique(limits, return_counts=True)
                times = np.append(times, 1)
                self.axes[row.f, axis] = limits, times, parts + np.concatenate([[0], times.cumsum()[:-1]])
                parts += int(times.sum())
            self.first[row.f], cells = cells, cells + (len(self.strips[row.f]) + 1) * (side + 1)
        self.side = side
        limits = points.mapInArrow(self._strips, "f int, strip int, x double, y double").groupBy("f", "strip")
        limits = limits.agg(F.min("x").alias("x"), F.percentile_approx("y", shares[0]).alias("y"))
        for f, strips in self.strips.items():
            self.cells[f], self.lows[f] = np.full((len(strips) + 1, side), np.inf), np.full(len(strips) + 1, np.inf)
        for row in limits.collect():
            own = np.unique(row.y)
            self.cells[row.f][row.strip, : len(own)] = own
            self.lows[row.f][row.strip] = row.x

    def _strips(self, batches):  # noqa: ANN001, ANN202
        """Of the ascending values of each strip among the rows at hand, every sixteenth: enough for limits, which results do not depend on.

        With them goes the least ``x`` of the strip, of all rows at hand.
        """
        for f, x, y, _ in by_feature(batches, "x", "y"):
            strip = np.searchsorted(self.strips[f], x)
            order = np.lexsort((y, strip))
            strip, x, y = strip[order], x[order], y[order]
            first = np.flatnonzero(np.append(True, strip[1:] != strip[:-1]))
            size = np.diff(np.append(first, len(y)))
            kept = (np.arange(len(y)) - np.repeat(first, size)) % THIN == np.repeat(np.minimum(THIN, size) // 2, size)
            yield pa.RecordBatch.from_pydict({
                "f": np.full(kept.sum(), f, np.int32), "strip": strip[kept].astype(np.int32),
                "x": np.repeat(np.minimum.reduceat(x, first), size)[kept], "y": y[kept],
            })

    def reached(self, f: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last strip with a point of ``x`` from ``low`` to ``high``; between two strips there is often room, as between whole numbers."""
        return np.searchsorted(self.strips[f], low), np.searchsorted(self.lows[f], high, "right") - 1

    def cell(self, f: int, strip: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many cells of the strip end below ``y``."""
        return (self.cells[f][strip] < y[:, None]).sum(1)

    def number(self, f: int, strip: np.ndarray, cell: np.ndarray) -> np.ndarray:
        return self.first[f] + strip * (self.side + 1) + cell


def by_feature(batches, *columns: str):  # noqa: ANN001, ANN201
    """The rows of each feature, many batches at a time: its number, the wanted columns as arrays, and the rows themselves."""

    def split(waiting: list[pa.RecordBatch]):  # noqa: ANN202
        rows = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        features = rows.column("f").to_numpy()
        order = np.argsort(features, kind="stable")
        rows, (found, first) = rows.take(pa.array(order)), np.unique(features[order], return_index=True)
        for f, start, end in zip(found, first, [*first[1:], len(order)]):
            own = rows.slice(start, end - start)
            yield int(f), *(own.column(c).to_numpy() for c in columns), own

    waiting, many = [], 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            many += batch.num_rows
        if many >= BATCH:
            yield from split(waiting)
            waiting, many = [], 0
    if waiting:
        yield from split(waiting)


def _within(points: DataFrame, cuts: Cuts, k: int) -> DataFrame:
    """Points with the number ``at`` of their cell, the distance ``r`` to the ``k``-th of the other rows there, and ``near``, all
    ``k`` distances, where that reaches beyond the cell."""

    def place(batches):  # noqa: ANN001, ANN202
        for f, x, y, rows in by_feature(batches, "x", "y"):
            strip = np.searchsorted(cuts.strips[f], x)
            at = cuts.number(f, strip, cuts.cell(f, strip, y))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("f", "x", "y", "n")), pa.array(at)], ["f", "x", "y", "n", "at"])

    def run(table: pa.Table) -> pa.Table:
        own = np.column_stack([table.column(c).to_numpy() for c in ("x", "y")])
        times = np.minimum(table.column("n").to_numpy(), k + 1)
        near = nearest(np.repeat(own, times, axis=0), own, k + 1)[:, 1:]  # the first is the row itself
        f, (x, y), r = table.column("f")[0].as_py(), own.T, near[:, -1]
        strip = np.searchsorted(cuts.strips[f], x[:1])
        cell = cuts.cell(f, strip, y[:1])
        left, right = cuts.reached(f, x - r, x + r)
        beyond = (left < strip) | (right > strip)
        limits = cuts.cells[f][strip[0]]
        beyond |= (np.searchsorted(limits, y - r) < cell) | (np.searchsorted(limits, y + r) > cell)
        lists = _list(near).take(pa.array(np.arange(len(r)), mask=~beyond))
        return table.append_column("r", pa.array(r)).append_column("near", lists)

    placed = points.mapInArrow(place, "f int, x double, y double, n long, at long")
    return placed.groupBy("at").applyInArrow(run, "f int, x double, y double, n long, at long, r double, near array<double>")


def _beyond(points: DataFrame, cuts: Cuts, k: int) -> DataFrame:
    """``f, x, y, near``: distances to rows of other cells that a point's own distance reaches."""

    def spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pair each place between its ends belongs to, and the places."""
        many = last - first + 1
        row = np.repeat(np.arange(len(first)), many)
        return row, np.arange(len(row)) - np.repeat(many.cumsum() - many, many) + first[row]

    def ask(batches):  # noqa: ANN001, ANN202
        for f, x, y, r, at, _ in by_feature(batches, "x", "y", "r", "at"):
            for i in range(0, len(x), SLICE):
                px, py, pr, home = (c[i : i + SLICE] for c in (x, y, r, at))
                row, strip = spread(*cuts.reached(f, px - pr, px + pr))
                one, cell = spread(cuts.cell(f, strip, (py - pr)[row]), cuts.cell(f, strip, (py + pr)[row]))
                there, row = cuts.number(f, strip[one], cell), row[one]
                other = there != home[row]
                there, row = there[other], row[other]
                yield pa.RecordBatch.from_pydict({
                    "at": there, "f": np.full(len(row), f, np.int32), "x": px[row], "y": py[row], "n": np.zeros(len(row), np.int64), "r": pr[row],
                })

    schema = "at long, f int, x double, y double, n long, r double"
    asking = points.where("near IS NOT NULL").select("f", "x", "y", "r", "at").mapInArrow(ask, schema)
    rows = points.select("at", "f", "x", "y", "n", "r").union(asking)

    def run(table: pa.Table) -> pa.Table:
        own = np.column_stack([table.column(c).to_numpy() for c in ("x", "y")])
        n = table.column("n").to_numpy()
        here, asked = n > 0, np.flatnonzero(n == 0)
        found = table.take(pa.array(asked))
        near = nearest(np.repeat(own[here], np.minimum(n[here], k), axis=0), own[asked], k, found.column("r").to_numpy())
        return pa.table({"f": found.column("f"), "x": found.column("x"), "y": found.column("y"), "near": _list(near)})

    return rows.groupBy("at").applyInArrow(run, "f int, x double, y double, near array<double>")


def short_axes(sizes: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """Axes whose values may be listed, given about how many each has: those of fewest values first."""
    found, total = [], 0
    for axis, many in sorted(sizes.items(), key=lambda size: size[1]):
        total += many
        if many <= LISTED and total <= LISTED_IN_ALL:
            found.append(axis)
    return found


def _value_lists(points: DataFrame, axes: Sequence[tuple[int, int]]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """For each of the axes its ascending values, and how many rows lie below each, with all of them at the end."""
    if not axes:
        return {}
    counts = [
        points.where(F.col("f").isin([f for f, own in axes if own == axis])).groupBy("f", F.lit(axis).alias("axis"), F.col(c).alias("v")).agg(F.sum("n").alias("n"))
        for axis, c in enumerate("xy")
    ]
    found = counts[0].union(counts[1]).toArrow()
    f, axis, v, n = (found.column(c).to_numpy() for c in ("f", "axis", "v", "n"))
    lists = {}
    for one in axes:
        own = (f == one[0]) & (axis == one[1])
        order = np.argsort(v[own])
        lists[one] = v[own][order], np.concatenate([[0], n[own][order].cumsum()])
    return lists


def _axis_counts(points: DataFrame, cuts: Cuts, short: Sequence[tuple[int, int]] = ()) -> DataFrame:
    """``f, c, n``: of ``n`` rows, the number of rows ``c`` nearer on one axis than the row's distance ``r``, both axes together.

    Where an axis is ``short``, its values with their counts go to all tasks and every row is counted where it is.
    """
    points = staged(points, "radius")
    lists = _value_lists(points, short)

    def look_up(batches):  # noqa: ANN001, ANN202
        for f, x, y, r, n, _ in by_feature(batches, "x", "y", "r", "n"):
            for axis, v in ((0, x), (1, y)):
                if (f, axis) in lists:
                    values, upto = lists[f, axis]
                    low, high = inside(values, v, r)
                    c, where = np.unique(upto[high] - upto[low], return_inverse=True)
                    many = np.zeros(len(c), np.int64)
                    np.add.at(many, where, n)
                    yield pa.RecordBatch.from_pydict({"f": np.full(len(c), f, np.int32), "c": c, "n": many})

    found = [points.mapInArrow(look_up, "f int, c long, n long")] if lists else []
    long = {axis for axis in cuts.axes if axis not in lists}
    if long or not lists:
        found.append(_range_counts(points, cuts, long))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def _range_counts(points: DataFrame, cuts: Cuts, axes: set[tuple[int, int]]) -> DataFrame:
    """What :func:`_axis_counts` gives, for axes of any number of values.

    The rows of a range of an axis are counted together. Only a row whose distance leaves the range asks elsewhere, for how
    many rows lie below its two ends.
    """

    def weigh(batches):  # noqa: ANN001, ANN202
        # rows by value where a range has several parts, else by range alone
        for f, x, y, n, _ in by_feature(batches, "x", "y", "n"):
            for axis, v in ((0, x), (1, y)):
                if (f, axis) not in axes:
                    continue
                limits, times, starts = cuts.axes[f, axis]
                at = np.searchsorted(limits, v)
                many = times[at] > 1
                for rows, value in ((many, v), (~many, np.zeros(len(v)))):
                    if rows.any():
                        pairs, where = np.unique(np.column_stack([at[rows], value[rows]]), axis=0, return_inverse=True)
                        total = np.zeros(len(pairs), np.int64)
                        np.add.at(total, where.ravel(), n[rows])
                        own = pairs[:, 0].astype(np.int64)
                        yield pa.RecordBatch.from_pydict({
                            "at": starts[own], "times": times[own], "v": pairs[:, 1], "n": total,
                        })

    weights = points.mapInArrow(weigh, "at long, times long, v double, n long")
    weights = staged(weights.groupBy("at", "times", "v").agg(F.sum("n").alias("n")), "range-counts")
    totals = dict(weights.groupBy("at").agg(F.sum("n")).collect())
    below, owner = {}, {}
    for (f, axis), (_, _, starts) in cuts.axes.items():
        if (f, axis) not in axes:
            continue
        total = 0
        for at in starts.tolist():
            below[at], owner[at], total = total, (f, axis), total + totals.get(at, 0)

    def deal(batches):  # noqa: ANN001, ANN202
        for f, x, y, r, n, _ in by_feature(batches, "x", "y", "r", "n"):
            for axis, v in ((0, x), (1, y)):
                if (f, axis) not in axes:
                    continue
                limits, times, starts = cuts.axes[f, axis]
                at, one = np.searchsorted(limits, v), np.flatnonzero
                out = (np.searchsorted(limits, v - r) < at) | (np.searchsorted(limits, v + r) > at)
                alone = times[at] == 1
                bits = (x + y).view(np.uint64)
                part = starts[at] + ((bits ^ (bits >> np.uint64(29))) % times[at].astype(np.uint64)).astype(np.int64)
                kind = np.where(out, COUNTED, np.where(alone, BOTH, ASKED))
                rows = one(~out | alone)
                low, high = thresholds(v[out], r[out])
                ends = [starts[np.searchsorted(limits, e)] for e in (low, high)]
                yield pa.RecordBatch.from_pydict({
                    "part": np.concatenate([part[rows], *ends]),
                    "at": np.concatenate([starts[at[rows]], *ends]),
                    "kind": np.concatenate([kind[rows], np.full(len(low), LOWER), np.full(len(high), UPPER)]).astype(np.int32),
                    "v": np.concatenate([v[rows], low, high]), "r": np.concatenate([r[rows], r[out], r[out]]),
                    "n": np.concatenate([n[rows], n[out], n[out]]),
                    "x": np.concatenate([x[rows], x[out], x[out]]), "y": np.concatenate([y[rows], y[out], y[out]]),
                })

    shared = weights.where("times > 1").select(
        F.explode(F.expr("sequence(at, at + times - 1)")).alias("part"), "at", F.lit(COUNTED).alias("kind"), "v",
        F.lit(0.0).alias("r"), "n", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"),
    )
    rows = points.mapInArrow(deal, "part long, at long, kind int, v double, r double, n long, x double, y double").union(shared)

    def run(table: pa.Table) -> pa.Table:
        kind, v, r, n, x, y = (table.column(c).to_numpy() for c in ("kind", "v", "r", "n", "x", "y"))
        at = table.column("at")[0].as_py()
        f, axis = owner[at]
        counted = (kind == BOTH) | (kind == COUNTED)
        order = np.argsort(v[counted], kind="stable")
        values, first = np.unique(v[counted][order], return_index=True)
        upto = np.concatenate([[0], n[counted][order].cumsum()])[np.append(first, counted.sum())]
        own = (kind == BOTH) | (kind == ASKED)
        low, high = inside(values, v[own], r[own])
        c, where = np.unique(upto[high] - upto[low], return_inverse=True)
        many = np.zeros(len(c), np.int64)
        np.add.at(many, where, n[own])
        lower, upper = np.flatnonzero(kind == LOWER), np.flatnonzero(kind == UPPER)
        ends = np.concatenate([lower, upper])
        places = np.concatenate([
            -(below[at] + upto[np.searchsorted(values, v[lower])]), below[at] + upto[np.searchsorted(values, v[upper], "right")],
        ])
        empty, rows = np.zeros(len(c)), len(c) + len(ends)
        return pa.table({
            "f": np.full(rows, f, np.int32), "axis": np.full(rows, axis, np.int32),
            "x": pa.array(np.concatenate([empty, x[ends]]), mask=np.arange(rows) < len(c)), "y": np.concatenate([empty, y[ends]]),
            "n": np.concatenate([many, n[ends]]), "c": np.concatenate([c, places]),
        })

    counted = staged(rows.groupBy("part").applyInArrow(run, "f int, axis int, x double, y double, n long, c long"), "axis-counts")
    ends = counted.where("x IS NOT NULL").groupBy("f", "axis", "x", "y", "n").agg(F.sum("c").alias("c"))
    return counted.where("x IS NULL").select("f", "c", "n").union(ends.select("f", "c", "n"))


def neighbour_mutual_info(df: DataFrame, numeric: Sequence[str], y: str, k: int = NEIGHBOURS, cell: int = CELL) -> DataFrame:
    """``feature, mutual_info`` in nats of each numeric column with ``y``, by the distance to the ``k``-th neighbour.

    Of a row with ``a`` rows nearer on the first axis than its ``k``-th neighbour and ``b`` on the second, itself included, the
    estimate takes the mean of ``digamma(rows) + digamma(k) - digamma(a) - digamma(b)``, at least 0. Where the ``k``-th
    neighbour is an equal point, equal values count as nearer. Rows without one of the values are left out; a constant column
    and one of at most ``k`` rows have 0.
    """
    rows = df.select(F.col(y).cast("double").alias("y"), *[F.col(f"`{c}`").cast("double").alias(c) for c in numeric])
    tall = rows.unpivot(["y"], list(numeric), "feature", "x").where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    size = staged(tall.groupBy("feature").agg(F.count(F.lit(1)).alias("rows"), F.stddev_pop("x").alias("sx"), F.stddev_pop("y").alias("sy")), "deviations")
    numbers = F.array_position(F.array(*[F.lit(c) for c in numeric]), F.col("feature")).cast("int").alias("f")
    size = size.select("*", numbers)
    used = size.where((F.col("rows") > k) & (F.col("sx") > 0) & (F.col("sy") > 0))
    points = tall.join(used, "feature").groupBy("f", (F.col("x") / F.col("sx")).alias("x"), (F.col("y") / F.col("sy")).alias("y"))
    points = staged(points.agg(F.count(F.lit(1)).alias("n")), "points")
    many = points.groupBy("f").agg(F.count(F.lit(1)).alias("m"), F.approx_count_distinct("x").alias("x"), F.approx_count_distinct("y").alias("y")).collect()
    most = max((row.m for row in many), default=0)
    short = short_axes({(row.f, axis): row[c] for row in many for axis, c in enumerate("xy")})
    cuts = Cuts(points, max(1, math.ceil(math.sqrt(most / cell))), max(1, math.ceil(most / (cell * RANGE))))
    own = staged(_within(points, cuts, k), "within-cells")
    every = own.where("near IS NOT NULL").select("f", "x", "y", "n", "near").union(_beyond(own, cuts, k).select("f", "x", "y", F.lit(0).cast("long"), "near"))
    reached = every.groupBy("f", "x", "y").agg(F.max("n").alias("n"), F.sort_array(F.flatten(F.collect_list("near")))[k - 1].alias("r"))
    counts = _axis_counts(own.where("near IS NULL").select("f", "x", "y", "n", "r").union(reached), cuts, short)
    mean = counts.groupBy("f").agg((F.sum(F.col("n") * digamma(F.col("c"))) / (F.sum("n") / 2)).alias("both"))
    info = digamma(F.col("rows")) + digamma(F.lit(k)) - F.col("both")
    return size.join(mean, "f", "left").select("feature", F.greatest(F.coalesce(info, F.lit(0.0)), F.lit(0.0)).alias("mutual_info"))
