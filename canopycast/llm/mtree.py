"""Operator 2: exact top-k search by inner product, best first in M-trees.

With one more component that brings every vector to the same length, the largest inner product is the smallest distance,
and distances obey the triangle inequality. The tree has three kinds of nodes: routers, a fixed number of points from a
bounded sample; below each, subtrees of at most SUBTREE vectors; in each subtree pages of PAGE vectors around one of them. A
node stores its covering radius, an entry the distance to its parent. A query opens nodes by least possible distance, and
stored distances spare it the entries that cannot come near enough.

Scores are whole numbers and exact; distances only decide what need not be looked at, with an allowance for rounding.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.staging import staged
from .common import arrow_map, equal_runs

#: Rows of the sample, routers among them, vectors of a subtree, entries of a page, queries of a block.
SAMPLE, ROUTERS, SUBTREE, PAGE, BLOCK = 2048, 32, 4096, 256, 256
#: Relative allowance for the rounding of distances.
SLACK = 1e-7


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, v``: floor(scale * x) of each component as double, for vectors without null or non-finite components.

    Components beyond 64 bits, and rows without an id, take no part either.
    """
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    rows = rows.where(F.coalesce(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < 9.2e18)), F.lit(False)))
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of whole numbers; shorter vectors are filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(size), dim), np.int64)
    out[np.arange(dim)[None, :] < size[:, None]] = lists.flatten().to_numpy()
    return out


class Space:
    """Distances between vectors brought to one length, and exact scores."""

    def __init__(self, dim: int, top: int, largest: int):
        self.dim, self.top = dim, float(top)
        # sums of products below 2**53 are exact in double
        self.exact = dim * largest * largest < 2**53

    def lifted(self, v: np.ndarray) -> np.ndarray:
        v = v.astype(np.float64)
        return np.concatenate([v, np.sqrt(np.maximum(0, self.top - (v * v).sum(axis=1)))[:, None]], axis=1)

    def query(self, v: np.ndarray) -> np.ndarray:
        v = v.astype(np.float64)
        return np.concatenate([v, np.zeros((len(v), 1))], axis=1)

    def scores(self, vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Beyond 64 bits they wrap around, as long does."""
        if self.exact:
            return (vectors.astype(np.float64, copy=False) @ query.astype(np.float64)).astype(np.int64)
        return vectors @ query

    def distance(self, points: np.ndarray, one: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, ((points - one) ** 2).sum(axis=-1)))

    def reach(self, query: np.ndarray, score: float) -> float:
        """Distance from the query within which a vector must lie to score so much."""
        far = float(query @ query) + self.top - 2 * score
        return float(np.sqrt(max(0.0, far)) + SLACK * (1 + np.sqrt(float(query @ query) + self.top)))


def spread(points: np.ndarray, n: int) -> np.ndarray:
    """Indices of ``n`` distinct points, each the farthest from those before it; fewer if there are no more."""
    chosen = [0]
    far = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.sqrt(((points - points[chosen[-1]]) ** 2).sum(axis=1)))
    return np.array(chosen)


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    square = (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)[None, :]
    at = square.argmin(axis=1)
    return at, np.sqrt(np.maximum(0, ((points - centres[at]) ** 2).sum(axis=1)))


def build_subtree(ids: np.ndarray, vectors: np.ndarray, space: Space) -> bytes:
    """Pages of a subtree: points around a spread of centres, cut into pages of PAGE by distance from the centre."""
    points = space.lifted(vectors)
    centres = points[spread(points, -(-len(ids) // PAGE))]
    at, far = nearest(points, centres)
    order = np.lexsort((far, at))
    cuts = [0]
    for c in range(len(centres)):
        low, high = np.searchsorted(at[order], (c, c + 1))
        cuts += [min(high, k) for k in range(low + PAGE, high + PAGE, PAGE)] if high > low else []
    first = np.array(cuts[:-1])
    page_centre = centres[at[order][first]]
    radius = np.array([far[order][a:b].max() for a, b in zip(cuts, cuts[1:])])
    inner = np.array([far[order][a:b].min() for a, b in zip(cuts, cuts[1:])])
    root = points.mean(axis=0)
    to_root = space.distance(page_centre, root)
    small = np.result_type(np.min_scalar_type(vectors.min()), np.min_scalar_type(vectors.max()), np.int8)
    out = io.BytesIO()
    np.savez(out, ids=ids[order], vectors=vectors[order].astype(small if small.kind == "i" else np.int64), far=far[order], cuts=np.array(cuts), centre=page_centre, radius=radius, inner=inner, root=root, to_root=to_root)
    return out.getvalue()


class Subtree:
    def __init__(self, data: bytes, space: Space):
        with np.load(io.BytesIO(data)) as z:
            self.part = {k: z[k] for k in z.files}
        self.part["vectors"] = self.part["vectors"].astype(np.float64 if space.exact else np.int64)
        self.space = space

    def search(self, vec_id: int, query: np.ndarray, k: int, least: int | None) -> list[tuple[int, int]]:
        """The best ``k`` as (score, id), of those that score at least ``least``; not the vector itself."""
        p, space = self.part, self.space
        point = space.query(query[None, :])[0]
        whole = query.astype(np.float64)
        best: list[tuple[int, int]] = []  # a heap of (score, -id), the worst first
        reach = space.reach(whole, least) if least is not None else np.inf
        to_root = float(space.distance(p["root"], point))
        slack = SLACK * (1 + to_root)
        # a page whose stored distance from the root shows it too far needs no distance of its own
        open_pages = np.flatnonzero(np.abs(p["to_root"] - to_root) - p["radius"] - slack <= reach)
        to_centre = space.distance(p["centre"][open_pages], point)
        nearest_point = np.maximum(0, np.maximum(to_centre - p["radius"][open_pages], p["inner"][open_pages] - to_centre))
        queue = [(float(d), int(page), float(c)) for d, page, c in zip(nearest_point, open_pages, to_centre)]
        heapq.heapify(queue)
        while queue:
            bound, page, centre = heapq.heappop(queue)
            if bound - slack > reach:
                break
            low, high = p["cuts"][page], p["cuts"][page + 1]
            near = low + np.flatnonzero(np.abs(p["far"][low:high] - centre) - slack <= reach)
            if not len(near):
                continue
            score = space.scores(p["vectors"][near], query)
            floor = best[0][0] if len(best) == k else least
            passing = np.flatnonzero(score >= floor) if floor is not None else np.arange(len(score))
            for i in passing:
                entry = (int(score[i]), -int(p["ids"][near[i]]))
                if -entry[1] == vec_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                reach = min(reach, space.reach(whole, best[0][0]))
        return [(s, -i) for s, i in best]


def top_k(table: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: of every row whose id is divisible by ``every`` the ``k`` other rows of largest inner
    product of floor(scale * x), ties to the smaller id; all rows if there are fewer.

    Vectors that are null or hold a null or non-finite component take no part. Shorter vectors count as filled with zeros.
    Rows of one id are one vector, that of least value. No vectors: no rows.
    """
    spark = table.sparkSession
    rows = staged(whole_vectors(table, id_col, vector_col, scale).groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    about = rows.agg(F.max(F.size("v")).alias("dim"), F.max(norm).alias("top"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest"), F.count(F.lit(1)).alias("n")).first()
    if not about["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = max(1, about["dim"])
    space = Space(dim, about["top"], about["largest"] or 0)

    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()  # bounded by SAMPLE
    sample_ids, sample_vectors = sample.column("vec_id").to_numpy(), matrix(sample.column("v"), dim)
    points = space.lifted(sample_vectors)
    shared = spark.sparkContext.broadcast((space, points[spread(points, ROUTERS)], sample_ids, sample_vectors))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, routers, *_ = shared.value
        for batch in batches:
            at, far = nearest(space.lifted(matrix(batch.column("v"), dim)), routers)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32)), pa.array(far)], ["vec_id", "v", "router", "far"])

    routed = staged(arrow_map(rows, assign, "vec_id long, v array<long>, router int, far double"), "routed")
    sizes = routed.groupBy("router").agg(F.count(F.lit(1)).alias("m"), F.max("far").alias("radius"))  # at most ROUTERS rows
    sizes = sizes.select("router", F.ceil(F.col("m") / SUBTREE).cast("int").alias("parts"), "radius").collect()
    parts, radius = {r["router"]: r["parts"] for r in sizes}, {r["router"]: r["radius"] for r in sizes}
    shape = spark.createDataFrame([(r["router"], r["parts"]) for r in sizes], "router int, parts int")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value[0]
        for key, own in equal_runs(batches, "subtree"):
            tree = build_subtree(own.column("vec_id").to_numpy(), matrix(own.column("v"), dim), space)
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([tree], pa.binary())], ["subtree", "tree"])

    subtree = (F.col("router").cast("long") * (1 << 40) + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).alias("subtree")
    keyed = routed.join(F.broadcast(shape), "router").select(subtree, "vec_id", "v")
    trees = staged(arrow_map(keyed.repartition("subtree").sortWithinPartitions("subtree"), build, "subtree long, tree binary"), "subtrees")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The subtrees a query may need: its k-th best in the sample bounds the score, the routers' radii the distance."""
        space, routers, ids, vectors = shared.value
        for batch in batches:
            found: list[tuple[int, int, int | None, int]] = []
            queries = matrix(batch.column("v"), dim)
            for row, (vec_id, q) in enumerate(zip(batch.column("vec_id").to_pylist(), queries)):
                score = np.sort(space.scores(vectors[ids != vec_id], q))
                least = int(score[-k]) if len(score) >= k else None
                reach = space.reach(q.astype(np.float64), least) if least is not None else np.inf
                to = space.distance(routers, space.query(q[None, :])[0])
                for r, n in parts.items():
                    if to[r] - radius[r] - SLACK * (1 + to[r]) <= reach:
                        found += [(row, vec_id, least, (r << 40) + c) for c in range(n)]
            take = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[3] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), batch.column("v").take(take), pa.array([f[2] for f in found], pa.int64())],
                ["subtree", "query_id", "v", "least"],
            )

    wanted = arrow_map(rows.where(F.pmod("vec_id", F.lit(every)) == 0), route, "subtree long, query_id long, v array<long>, least long")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, last, tree = shared.value[0], None, None
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for row, (key, data) in enumerate(zip(batch.column("subtree").to_pylist(), batch.column("tree"))):
                if key != last:
                    last, tree = key, Subtree(data.as_py(), space)
                queries = batch.column("queries")[row].as_py()
                for q in queries:
                    v = np.zeros(dim, np.int64)
                    v[: len(q["v"])] = q["v"]
                    out += [(q["query_id"], i, s) for s, i in tree.search(q["query_id"], v, k, q["least"])]
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(3)], ["query_id", "vec_id", "score"])

    # about BLOCK queries meet a subtree at a time, however many there are
    blocks = max(1, -(-about["n"] // (every * BLOCK)))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    packed = wanted.groupBy("subtree", block.alias("block")).agg(F.collect_list(F.struct("query_id", "v", "least")).alias("queries"))
    met = trees.join(packed, "subtree").select("subtree", "tree", "queries")
    found = arrow_map(met, search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
