"""Operator 11: alignment of the tokens of two tokenizers over the same bytes.

A is a byte-level BPE read by the tokenizers library, B a sentencepiece model with byte fallback that adds a space before
the text. Offsets where a token of A and one of B both end cut the bytes into groups. Nearly all groups hold one token of
each, and then both have the same bytes: an array from A id to the B id of the same bytes names the pair, and documents
are counted in vectors as long as A's vocabulary. Only pairs of the other groups are shuffled to be counted.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import staged
from .common import arrow_map, text_table
from .segments import MARK, WHITE, WORD

#: Segments that a worker remembers, and that are looked up at a time.
REMEMBERED, AT_ONCE = 300_000, 400_000
#: A pair in more than this share of the documents is hot; there are at most this many times a document's mean number of pairs.
HOT = 200

# White space that begins no longer piece of B; any other may be part of the piece before it.
_CUT = " \t\n"
_ODD = f"(?![{_CUT}])[{WHITE}]"
SEGMENT = re.compile(f"[{WHITE}]*[{WORD}]++(?=[{MARK}])|[{WHITE}]*[^{WHITE}]+(?:{_ODD}[{WHITE}]*[^{WHITE}]*)*|[{WHITE}]+")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 characters stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Rows:
    """Lists of (key, number of links) by segment number, in flat arrays that grow."""

    def __init__(self):
        self.start, self.length = [_EMPTY], [_EMPTY]
        self.key, self.times, self.size = [_EMPTY], [_EMPTY], 0

    def add(self, segments: int, owner: np.ndarray, key: np.ndarray, times: np.ndarray) -> None:
        """The next ``segments`` numbers, with the keys that each owns (by its place among them, ascending)."""
        length = np.bincount(owner, minlength=segments)
        self.start.append(self.size + np.cumsum(length) - length)
        self.length.append(length)
        self.key.append(key)
        self.times.append(times)
        self.size += len(key)

    def of(self, place: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The keys of the segments ``place`` with their rows, added up by (row, key)."""
        for name in ("start", "length", "key", "times"):
            setattr(self, name, [np.concatenate(getattr(self, name))])
        many = self.length[0][place]
        at = np.repeat(self.start[0][place] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return _distinct(np.repeat(row, many), self.key[0][at], self.times[0][at])


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        letter = byte_letters()
        with open(path_a, encoding="utf-8") as file:
            added = {x["id"] for x in json.load(file)["added_tokens"]}
        self.size_a, self.size_b = self.a.get_vocab_size(), self.b.get_piece_size()
        if self.size_a * self.size_b > 1 << 31:
            raise ValueError("a pair of ids does not fit into 31 bits")
        entries = [self.a.id_to_token(i) for i in range(self.size_a)]
        self.bytes_a = [e.encode() if i in added else bytes(map(letter.__getitem__, e)) for i, e in enumerate(entries)]
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        of_bytes = {}
        for i in sorted(range(self.size_b), key=lambda i: (self.b.is_byte(i), i)):
            if not self.b.is_control(i) and not self.b.is_unknown(i):
                of_bytes.setdefault(self.bytes_b[i], i)
        #: The B id of the same bytes by A id, or -1.
        self.same = np.array([of_bytes.get(x, -1) for x in self.bytes_a], np.int64)
        self.length_a, self.length_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.lead = len(self.b.encode("\n"))
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.texts: list[str | None] = []
        self.counts, self.regular, self.pairs = [np.zeros((0, 4), np.int64)], Rows(), Rows()

    def ids(self, segments: list[str]) -> list[tuple[list[int], list[int]]]:
        """The ids of both tokenizers; a leading space is the one that B adds, other segments are encoded behind a line end, which joins nothing."""
        a = [x.ids for x in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        spaced = [s.startswith(" ") for s in segments]
        b = self.b.encode([s[1:] if cut else "\n" + s for s, cut in zip(segments, spaced)], num_threads=1)
        # nothing is left of a single space: B alone adds its space to other characters only
        b = [(x if s != " " else self.b.encode("\n")[:-1]) if cut else x[self.lead :] for x, s, cut in zip(b, segments, spaced)]
        return list(zip(a, b))

    def joined(self, a: list[int], b: list[int]) -> tuple[bytes, bytes]:
        return b"".join(map(self.bytes_a.__getitem__, a)), b"".join(map(self.bytes_b.__getitem__, b))

    def learn(self, segments: list[str]) -> None:
        """Number the segments, and keep the groups and linked pairs of each; a null text marks tokens of other bytes."""
        n, found = len(segments), self.ids(segments)
        fits = np.ones(n, bool)
        for k, (segment, (a, b)) in enumerate(zip(segments, found)):
            data = segment.encode()
            if self.joined(a, b) != (data, data):
                fits[k], found[k] = False, ([], [])
        many = [np.array([len(x[side]) for x in found], np.int64) for side in (0, 1)]
        ids = [np.fromiter(chain.from_iterable(x[side] for x in found), np.int64, many[side].sum()) for side in (0, 1)]
        ends = np.cumsum(self.length_a[ids[0]]), np.cumsum(self.length_b[ids[1]])
        # both sides hold the same bytes, so an offset where both end closes a group, and every segment ends with one
        group_end = np.intersect1d(*ends, assume_unique=True)
        group = [np.searchsorted(group_end, x) for x in ends]
        size = [np.bincount(g, minlength=len(group_end)) for g in group]
        first = [np.cumsum(x) - x for x in size]
        owner = np.repeat(np.arange(n), many[0])[first[0]] if len(group_end) else _EMPTY
        a, b = ids
        name_a, name_b = ([str(i) for i in x.tolist()] for x in ids)
        texts = [
            f"{name_a[x]}|{name_b[y]}" if p == q == 1 else f"{','.join(name_a[x : x + p])}|{','.join(name_b[y : y + q])}"
            for x, y, p, q in zip(*(v.tolist() for v in (*first, *size)))
        ]
        cut = np.searchsorted(owner, np.arange(n + 1)).tolist()
        self.texts += [";".join(texts[x:y]) if ok else None for x, y, ok in zip(cut, cut[1:], fits.tolist())]
        self.number.update(zip(segments, range(len(self.number), len(self.number) + n)))
        groups = np.bincount(owner, minlength=n)
        links = np.bincount(owner, size[0] * size[1], minlength=n).astype(np.int64)
        self.counts.append(np.stack([*many, groups, links], 1))
        # one row per A token and distinct B id of its group, so that a long group of few ids stays small
        other, other_b, other_n = _distinct(group[1], b, np.ones(len(b), np.int64))
        mine, mine_a, mine_n = _distinct(group[0], a, np.ones(len(a), np.int64))
        width = np.bincount(other, minlength=len(group_end))
        from_b = (np.cumsum(width) - width)[mine]
        wide = width[mine]
        at = np.repeat(from_b - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())
        pair_a, pair_b = np.repeat(mine_a, wide), other_b[at]
        times, of = np.repeat(mine_n, wide) * other_n[at], np.repeat(owner[mine], wide)
        same = self.same[pair_a] == pair_b
        for into, use, key in ((self.regular, same, pair_a), (self.pairs, ~same, pair_a * self.size_b + pair_b)):
            into.add(n, *_distinct(of[use], key[use], times[use]))

    def places(self, segments: list[list[str]]) -> list[list[int]]:
        """The numbers of the segments; the memory is emptied before it holds too much."""
        if len(self.number) > REMEMBERED or self.pairs.size + self.regular.size > 8 * REMEMBERED:
            self.forget()
        new = list(set(chain.from_iterable(segments)).difference(self.number))
        for at in range(0, len(new), 20_000):
            self.learn(new[at : at + 20_000])
        self.counts = [np.concatenate(self.counts)]
        return [list(map(self.number.__getitem__, x)) for x in segments]

    def whole_text_fits(self, text: str) -> bool:
        """Whether the bytes of a whole text's tokens are the space and the text on both sides."""
        data = b" " + text.encode()
        return self.joined(self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)) == (data, data)

    def documents(self, texts: list[str | None]) -> dict[str, list | np.ndarray]:
        """Counts, digests and linked ids with their number of links, as flat arrays with the place of the text they belong to."""
        n = len(texts)
        counts, digests, fits = np.zeros((n, 4), np.int64), [hashlib.sha256() for _ in texts], [bool(t) for t in texts]
        begun, found = [False] * n, {"regular": [(_EMPTY,) * 3], "pairs": [(_EMPTY,) * 3]}

        def look_up(parts: list[tuple[int, list[str]]]) -> None:
            places = self.places([segments for _, segments in parts])
            for (row, _), at in zip(parts, places):
                counts[row] += self.counts[0][at].sum(0)
                words = list(map(self.texts.__getitem__, at))
                fits[row] = fits[row] and None not in words
                if fits[row]:
                    digests[row].update(((";" if begun[row] else "") + ";".join(words)).encode())
                    begun[row] = True
            row = np.repeat(np.array([row for row, _ in parts]), [len(x) for x in places])
            place = np.fromiter(chain.from_iterable(places), np.int64, len(row))
            for name, into in found.items():
                into.append(getattr(self, name).of(place, row))

        parts, size = [], 0
        for row, text in enumerate(texts):
            if not text:
                continue
            for part in _parts(" " + text):
                parts.append((row, part))
                size += len(part)
                if size >= AT_ONCE:
                    look_up(parts)
                    parts, size = [], 0
        if parts:
            look_up(parts)
        for row, text in enumerate(texts):
            if text and not fits[row] and self.whole_text_fits(text):
                raise ValueError("a text's segments differ from their bytes though the whole text does not")
        kept = np.array(fits, bool)
        counts[~kept] = 0
        out = {"counts": counts, "digest": [d.hexdigest() if ok else "" for d, ok in zip(digests, fits)]}
        for name, parts in found.items():
            row, key, times = _distinct(*map(np.concatenate, zip(*parts)))
            use = kept[row]
            out[name] = row[use], key[use], times[use]
        return out


_EMPTY = np.zeros(0, np.int64)


def _parts(text: str) -> Iterator[list[str]]:
    """The segments of a text, at most ``AT_ONCE`` at a time."""
    if len(text) <= AT_ONCE:
        yield SEGMENT.findall(text)
        return
    walk = (m.group() for m in SEGMENT.finditer(text))
    while part := list(islice(walk, AT_ONCE)):
        yield part


def _distinct(owner: np.ndarray, key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Add up ``times`` by (owner, key), in this order; both are below 2^31."""
    if not len(owner):
        return (_EMPTY,) * 3
    both = owner << 31 | key
    order = np.argsort(both)
    both = both[order]
    first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
    return both[first] >> 31, both[first] & 0x7FFFFFFF, np.add.reduceat(times[order], first)


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per Python worker."""
    return Aligner(path_a, path_b)


def _lists(n: int, row: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), pa.array(values, pa.int64()))


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``row`` (a number of its own), ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256`` and the linked pairs.

    ``regular`` lists the A ids linked with the B id of the same bytes, ``pairs`` the other pairs as ``a * size of B + b``,
    ``regular_n`` and ``pairs_n`` their links. A null or empty text, or one whose tokens have other bytes than a space and the
    text, has zeros, empty lists and an empty digest. Equal rows each count; a null id stays null; texts of any length are
    taken in parts of ``AT_ONCE`` segments; further columns are not read. The rows are written to the shared folder.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            n, x = batch.num_rows, own.documents(batch.column("text").to_pylist())
            columns = [pa.array(x["counts"][:, k]) for k in range(4)]
            lists = [_lists(n, x[name][0], x[name][k]) for name in ("regular", "pairs") for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *columns, pa.array(x["digest"], pa.string()), *lists], names)

    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    schema += "regular array<long>, regular_n array<long>, pairs array<long>, pairs_n array<long>"
    names = [x.split()[0] for x in schema.split(", ")]
    return staged(arrow_map(text_table(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), run, schema), "aligned")


def _vector_counts(rows: DataFrame, size: int) -> DataFrame:
    """``a, docs``: each task counts in one vector as long as A's vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("regular").flatten().to_numpy(), minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["a", "docs"])

    return arrow_map(rows.select("regular"), run, "a long, docs long").groupBy("a").agg(F.sum("docs").alias("docs"))


def pair_counts(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``a, b, docs, same, best`` of ``aligned`` rows: how many documents hold each pair linked, whether both ids have the same
    bytes, and whether no other pair of ``a`` is in more documents (ties included). No rows without links. Written to the shared folder."""
    own = aligner(path_a, path_b)
    size, same = own.size_b, own.same
    pairs = rows.select(F.explode("pairs").alias("key")).groupBy("key").agg(F.count("*").alias("docs"))
    pairs = pairs.select(F.floor(F.col("key") / size).alias("a"), F.col("key") % size, "docs", F.lit(False))
    identity = rows.sparkSession.createDataFrame(pa.table({"a": np.flatnonzero(same >= 0), "b": same[same >= 0]}))
    regular = _vector_counts(rows, own.size_a).join(identity, "a").select("a", "b", "docs", F.lit(True))
    both = staged(pairs.toDF("a", "b", "docs", "same").union(regular.toDF("a", "b", "docs", "same")), "pair-counts")
    most = both.groupBy("a").agg(F.max("docs").alias("most"))
    return staged(both.join(most, "a").select("a", "b", "docs", "same", (F.col("docs") == F.col("most")).alias("best")), "pair-best")


def document_links(rows: DataFrame, counts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of ``aligned`` rows, given their ``pair_counts``.

    The counts of pairs of the same bytes are two vectors as long as A's vocabulary, held by every task. Other pairs are joined:
    the hot ones, whose number is bounded (``HOT``), as a broadcast table, so that none of them fills a partition.
    """
    own = aligner(path_a, path_b)
    size, size_a = own.size_b, own.size_a
    docs, best = np.zeros(size_a, np.int64), np.zeros(size_a, np.int64)
    for a, n, top in counts.where("same").select("a", "docs", F.col("best").cast("int")).collect():  # at most A's vocabulary
        docs[a], best[a] = n, top

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n = (batch.column(c).flatten().to_numpy() for c in ("regular", "regular_n"))
            end = np.r_[0, np.cumsum(batch.column("regular").value_lengths().to_numpy())]
            sums = [np.diff(np.r_[0, np.cumsum(n * of[ids])][end]) for of in (best, docs)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in plain), *map(pa.array, sums)], [*plain, "best_0", "sum_0"])

    plain = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, best_0 long, sum_0 long"
    out = arrow_map(rows.select(*plain, "regular", "regular_n"), run, schema)

    limit = rows.count() / HOT
    other = counts.where("NOT same").select((F.col("a") * size + F.col("b")).alias("key"), "docs", F.col("best").cast("long").alias("top"))
    hot = other.where(F.col("docs") > limit).toDF("key", "hot_docs", "hot_top")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "pairs_n")).alias("p")).select("row", F.col("p.pairs").alias("key"), F.col("p.pairs_n").alias("n"))
    links = links.join(F.broadcast(hot), "key", "left")
    sums = F.sum(F.col("n") * F.col("top")).alias("best_1"), F.sum(F.col("n") * F.col("docs")).alias("sum_1")
    met = links.where("hot_docs IS NOT NULL").select("row", "n", F.col("hot_top").alias("top"), F.col("hot_docs").alias("docs"))
    rest = links.where("hot_docs IS NULL").select("row", "key", "n").join(other.where(F.col("docs") <= limit), "key").select("row", "n", "top", "docs")
    more = met.union(rest).groupBy("row").agg(*sums)
    add = lambda name: (F.col(f"{name}_0") + F.coalesce(f"{name}_1", F.lit(0))).alias("n_best" if name == "best" else "count_sum")
    return out.join(more, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", add("best"), add("sum"), "groups_sha256")


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``document_links`` of a table: encoding, counting and looking up in turn."""
    rows = aligned(docs, path_a, path_b, id_col, text_col)
    return document_links(rows, pair_counts(rows, path_a, path_b), path_a, path_b)
