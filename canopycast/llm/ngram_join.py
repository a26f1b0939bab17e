"""Operator 4: Jaccard self-join on word n-grams by multiple global orders.

Two sets of the wanted similarity differ in so few shingles that, under any one order of all shingles, their prefixes share
one. Documents that share prefix shingles are grouped under each of two orders; two similar documents are in one group under
both, so only pairs within the intersections of the groups are verified, exactly, on whole sets.

Both orders put first the shingles of a fixed part of the hash space, the least frequent first and ties by one hash or the
other, then the remaining shingles, and last those found to be very frequent in a sample. A frequency of one needs no row
in any later step, since a shingle of one document cannot be shared. The sample decides the order only, never the result.

Equal sets are one node throughout. Copies, and a shingle of a third of all documents, thus cost no more than others: hot
shingles are never counted, and are grouped by salted parts first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.staging import staged
from .common import arrow_map, components, equal_runs, fresh, text_table

#: Rows of the sample that finds hot shingles, and the share of them that makes a shingle hot.
SAMPLE, HOT = 4096, 0.01
#: Parts in which the documents of a hot shingle are grouped first.
SALTS = 64
#: Sets that one task has seen and does not send again.
SEEN = 200_000
#: Bits of the filter that spares sets without a partner; false positives cost time only.
FILTER_BITS = 1 << 24
#: Documents and shingles of a block; two blocks are compared in one task at a time.
BLOCK_DOCS, BLOCK_SHINGLES = 1000, 500_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x + np.uint64(salt * int(_ODD) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def words(text: str) -> np.ndarray:
    """Hashes of the runs of characters other than ASCII white space, A-Z in lower case."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, text.encode().lower().split()), np.uint64)


def grams(word: np.ndarray, n: int) -> np.ndarray:
    """The hash of each n-gram, by place."""
    last = len(word) - n + 1
    out = mixed(word[:last], n)
    for k in range(1, n):
        out = mixed(out * _ODD + word[k : last + k])
    return out


def shingles(text: str, n: int) -> np.ndarray:
    """Sorted distinct n-grams of words; of fewer words the whole sequence as one."""
    word = words(text)
    return np.unique(grams(word, min(n, len(word)))) if len(word) else word


def set_hash(own: np.ndarray) -> int:
    value = xxhash.xxh3_64_intdigest(own.tobytes())
    return value - (1 << 64) if value >> 63 else value


def prefix_length(size: int, percent: int) -> int:
    return size - -(-size * percent // 100) + 1


class _Seen(set):
    """Remembers a bounded number of sets."""

    def first(self, node: int) -> bool:
        if node in self:
            return False
        if len(self) >= SEEN:
            self.clear()
        self.add(node)
        return True


def sets(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, n_shingles, node``; equal sets have one node, empty ones none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingles(t, n) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(map(len, own)), pa.int64()), pa.array([set_hash(s) if len(s) else None for s in own], pa.int64())], ["doc_id", "n_shingles", "node"]
            )

    return arrow_map(docs, run, "doc_id long, n_shingles long, node long")


def hot_shingles(docs: DataFrame, n: int, rows: int) -> np.ndarray:
    """Sorted shingles of at least HOT of a sample of about SAMPLE documents: at most 1 / HOT times a document's mean number."""
    rate = min(1.0, SAMPLE / max(rows, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text, n).view(np.int64))], ["token"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30)) < int(rate * (1 << 30)))
    least = max(8, math.ceil(HOT * rate * rows))
    found = arrow_map(sample, run, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= least)
    return np.sort(found.select("token").toArrow().column("token").to_numpy().view(np.uint64))


def _is_in(own: np.ndarray, found: np.ndarray) -> np.ndarray:
    if not len(found):
        return np.zeros(len(own), bool)
    return found[np.minimum(np.searchsorted(found, own), len(found) - 1)] == own


#: cold rows have turn 0; exposed ones the number of the order. need: prefix length, and how many cold rows the node has.
_TOKENS = "token long, node long, turn int, hot boolean, need int, cold int"


def _prefix_rows(docs: DataFrame, n: int, percent: int, hot: np.ndarray) -> DataFrame:
    """The counted shingles of each set, and the later ones that its prefix reaches under either order."""
    # a tenth more of the shingles than a prefix holds, so that most sets fill theirs from counted ones
    part = np.uint64(min(1.0, 1.1 - percent / 100) * (2**64 - 1025))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, frequent = _Seen(), shared.value
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in range(6)]

            def add(token: np.ndarray, node: int, turn: int, is_hot: np.ndarray, need: int, cold: int) -> None:
                for column, value in zip(columns, (token, *[np.full(len(token), v) for v in (node, turn)], is_hot, *[np.full(len(token), v) for v in (need, cold)])):
                    column.append(value)

            for text in batch.column("text").to_pylist():
                own = shingles(text, n)
                if not len(own) or not seen.first(node := set_hash(own)):
                    continue
                place, is_hot = mixed(own, 1), _is_in(own, frequent)
                first = (place <= part) & ~is_hot
                cold, need = int(first.sum()), prefix_length(len(own), percent)
                add(own[first], node, 0, is_hot[first], need, cold)
                if cold < need:
                    late, late_hot = own[~first], is_hot[~first]
                    for turn in (1, 2):
                        chosen = np.lexsort((mixed(late, turn), late_hot))[: need - cold]
                        add(late[chosen], node, turn, late_hot[chosen], need, cold)
            if columns[0]:
                token, node, turn, is_hot, need, cold = map(np.concatenate, columns)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token.view(np.int64)), pa.array(node, pa.int64()), pa.array(turn, pa.int32()), pa.array(is_hot), pa.array(need, pa.int32()), pa.array(cold, pa.int32())],
                    [c.split()[0] for c in _TOKENS.split(", ")],
                )

    return arrow_map(docs.select("text"), run, _TOKENS)


def _exposed(rows: DataFrame) -> DataFrame:
    """``token, node, turn, hot``: the prefix of each node under each order, without shingles that only it has."""
    late = F.col("turn") > 0
    salt = F.when(late, F.pmod("node", F.lit(SALTS))).otherwise(F.lit(0))
    counted = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("token", "turn", salt))).where(late | (F.col("n") > 1))
    own = Window.partitionBy("node", "late")
    ranked = counted.withColumn("late", late)
    for turn in (1, 2):
        ranked = ranked.withColumn(f"rank{turn}", F.dense_rank().over(own.orderBy("n", F.xxhash64("token", F.lit(turn)), "token")))
    # of the counted shingles as many are its own as the rank of the last shared one leaves
    left = F.col("need") - F.col("cold") + F.max("rank1").over(own)
    turns = F.array_compact(F.array(*[F.when(F.col(f"rank{turn}") <= F.col("left"), turn) for turn in (1, 2)]))
    ranked = ranked.withColumn("left", left).withColumn("turns", F.when(late, F.array("turn")).otherwise(turns))
    return ranked.select("token", "node", F.explode("turns").alias("turn"), "hot")


def _families(exposed: DataFrame) -> DataFrame:
    """``node, family``: nodes of one family are in one group of shared prefix shingles under every order."""
    salt = F.when(F.col("hot"), F.pmod("node", F.lit(SALTS))).otherwise(F.lit(0))
    first = exposed.withColumn("rep", F.min("node").over(Window.partitionBy("turn", "token", salt)))
    links = first.where("node <> rep").select("turn", F.col("node").alias("a"), F.col("rep").alias("b"))
    heads = first.where("hot").select("turn", "token", "rep").distinct()
    heads = heads.withColumn("top", F.min("rep").over(Window.partitionBy("turn", "token"))).where("rep <> top")
    links = staged(links.union(heads.select("turn", F.col("rep").alias("a"), F.col("top").alias("b"))).distinct(), "prefix-links")
    # both orders at once: a node under an order is a node of its own
    own = lambda c: F.xxhash64("turn", c)
    label = components(links.select(own("a").alias("a"), own("b").alias("b")))
    nodes = links.select("turn", F.col("a").alias("node")).union(links.select("turn", F.col("b").alias("node"))).distinct()
    placed = nodes.withColumn("own", own("node")).join(label.withColumnRenamed("node", "own"), "own")
    both = placed.groupBy("node").agg(*[F.max(F.when(F.col("turn") == turn, F.col("component"))).alias(f"c{turn}") for turn in (1, 2)])
    return both.where("c1 IS NOT NULL AND c2 IS NOT NULL").select("node", F.xxhash64("c1", "c2").alias("family"))


def _blocks(members: DataFrame, percent: int) -> DataFrame:
    """``node, n, copies, key, side``: each row takes a node to a comparison of one or two blocks.

    A small family is one block. A large one is cut by size class, a step of which is the largest ratio of sizes that can be
    similar, and within it into parts; only parts of one class or of neighbouring ones are compared.
    """
    step = math.log(100 / percent) * (1 + 1e-9) if percent < 100 else None
    own = members.join(members.groupBy("family").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total")), "family").where("m > 1")
    large = (F.col("m") > BLOCK_DOCS) | (F.col("total") > BLOCK_SHINGLES)
    own = own.withColumn("size", F.when(large, F.floor(F.log("n") / step) if step else F.col("n")).otherwise(F.lit(0)).cast("int")).drop("m", "total")
    classes = own.groupBy("family", "size").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
    parts = F.greatest(F.ceil(F.col("m") / BLOCK_DOCS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    classes = classes.select("family", "size", F.when((F.col("m") <= BLOCK_DOCS) & (F.col("total") <= BLOCK_SHINGLES), 1).otherwise(parts).alias("parts"))
    near = [classes.select("family", (F.col("size") - d).alias("size"), F.col("parts").alias(f"p{d + 1}")) for d in (-1, 0, 1)]
    for other in near:
        own = own.join(other, ["family", "size"], "left")
    own = own.withColumn("part", F.pmod(F.xxhash64("node"), F.col("p1")).cast("int"))
    block = lambda size, part: F.struct(size.alias("size"), part.alias("part"))

    def parts_of(d: int):
        """All parts of the size class d steps away."""
        number = F.sequence(F.lit(0), F.coalesce(f"p{d + 1}", F.lit(1)) - 1)
        every = F.transform(number, lambda c: block((F.col("size") + d).cast("int"), c.cast("int")))
        return F.when(F.col(f"p{d + 1}").isNull(), F.slice(every, 1, 0)).otherwise(every)

    partners = F.concat(*[parts_of(d) for d in (-1, 0, 1)])
    rows = own.withColumn("me", block(F.col("size"), F.col("part"))).withColumn("other", F.explode(partners))
    low, high = F.least("me", "other"), F.greatest("me", "other")
    return rows.select("node", "n", "copies", F.xxhash64("family", low["size"], low["part"], high["size"], high["part"]).alias("key"), (F.col("me") == low).alias("low"), (low == high).alias("one"))


def _filter(nodes: DataFrame) -> np.ndarray:
    """FILTER_BITS bits, set where a node falls."""
    bit = F.pmod(F.col("node"), F.lit(FILTER_BITS))
    words = nodes.groupBy(F.shiftright(bit, 5).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(node, {FILTER_BITS}) & 31 AS int))")).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out


def _wanted_sets(docs: DataFrame, n: int, nodes: DataFrame) -> DataFrame:
    """``node, shingles`` of the nodes, and of a few others."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, bits = _Seen(), shared.value
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                own = shingles(text, n)
                node = set_hash(own) if len(own) else 0
                at = node % FILTER_BITS
                if len(own) and int(bits[at >> 5]) >> (at & 31) & 1 and seen.first(node):
                    found.append((node, own.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.binary())], ["node", "shingles"])

    return arrow_map(docs.select("text"), run, "node long, shingles binary")


def overlaps(own: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections: products of 0/1 rows over the shingles that occur twice."""
    owner = np.repeat(np.arange(len(own)), [len(s) for s in own])
    token, place, times = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    twice = times > 1
    index = np.cumsum(twice) - 1
    keep = twice[place]
    owner, place = owner[keep], index[place[keep]]
    out = np.zeros((len(own), len(own)), np.float32)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for low in range(0, int(twice.sum()), columns):
        a, b = np.searchsorted(place, (low, low + columns))
        matrix = np.zeros((len(own), columns), np.float32)
        matrix[owner[a:b], place[a:b] - low] = 1
        out += matrix @ matrix.T
    return out.astype(np.int64)


def _verify(percent: int):
    def compare(nodes: list[int], own: list[np.ndarray], copies: np.ndarray, low: np.ndarray, one: bool) -> list[tuple[int, int, int]]:
        """Node, least node it is linked with through others here, and the number of documents linked with it."""
        both = overlaps(own)
        size = np.array([len(s) for s in own])
        link = 100 * both >= percent * (size[:, None] + size[None, :] - both)
        if not one:
            link &= low[:, None] != low[None, :]
        np.fill_diagonal(link, False)
        found, label = link @ copies, np.full(len(nodes), -1)
        for start in np.argsort(nodes):
            if label[start] < 0 and link[start].any():
                reach, label[start] = [start], start
                while reach:
                    new = np.flatnonzero(link[reach].any(axis=0) & (label < 0))
                    label[new] = start
                    reach = new.tolist()
        return [(nodes[i], nodes[label[i]], int(found[i])) for i in range(len(nodes)) if label[i] >= 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in equal_runs(batches, "key"):
            nodes, place = np.unique(table.column("node").to_numpy(), return_index=True)
            table = table.take(pa.array(place))
            own = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
            rows = compare(nodes.tolist(), own, table.column("copies").to_numpy(), table.column("low").to_numpy(), table.column("one")[0].as_py()) if len(own) > 1 else []
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["node", "rep", "links"])

    return run


def similar(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links``, one row per row of ``docs``.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of word ``n``-grams (A-Z in lower case).
    ``component_id`` is the smallest id reachable by links, itself included; ``n_links`` counts the other rows linked with
    the row. Null and empty texts and those without words have empty sets and link with nothing. A row without an id
    links as any other and is never a component's id, unless no row of the component has one. Equal rows link.
    """
    rows = text_table(docs, id_col, text_col)
    every = staged(sets(rows, n), "sets")
    classes = staged(every.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n")), "classes")
    hot = hot_shingles(rows, n, every.count())
    family = staged(_families(staged(_exposed(_prefix_rows(rows, n, percent, hot)), "exposed")), "families")
    blocks = staged(_blocks(family.join(classes, "node"), percent), "blocks")
    wanted = _wanted_sets(rows, n, blocks.select("node"))
    pairs = blocks.join(wanted, "node").repartition("key").sortWithinPartitions("key")
    found = staged(arrow_map(pairs, _verify(percent), "node long, rep long, links long"), "found")
    whole = components(found.select(F.col("node").alias("a"), F.col("rep").alias("b")))
    least = whole.join(classes, "node").groupBy("component").agg(F.min("least").alias("component_id"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = classes.join(whole, "node", "left").join(least, "component", "left").join(links, "node", "left")
    nodes = nodes.select("node", F.coalesce("component_id", "least").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return every.join(nodes, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the row of least id of every group of linked documents; of rows with one id that of least text.

    Documents without words, and rows without an id, stay.
    """
    groups = similar(docs, n, percent, id_col, text_col)
    key, turn = fresh(docs, "_id"), fresh(docs, "_turn")
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    own = F.col(f"`{id_col}`")
    order = Window.partitionBy(key).orderBy(f"`{text_col}`")
    rows = docs.join(kept, own == F.col(key)).withColumn(turn, F.row_number().over(order)).where(F.col(turn) == 1)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns]).union(docs.where(own.isNull()))
