"""Operator 5: language identification by interpolated Kneser-Ney character models.

Spark counts the character n-grams of a bounded sample of labelled rows. From the counts come, for each order, a sorted
array of n-gram hashes with the log probability under every language, and one of context hashes with the log weight of the
shorter model. A text goes to the language of least cross-entropy per character, unless that is larger than texts of the
calibration sample allow.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import arrow_map, text_table

#: Characters of an n-gram: 16 bits each make up a 64-bit key.
ORDER = 4
#: Rows of each language in the sample, about: its bound. A third of them calibrate, the others fit.
SAMPLE_ROWS = 3000
#: Share of the calibration texts that the limit keeps; slack in nats; standard errors that short texts may exceed it by.
KEPT, SLACK, ERRORS = 0.999, 0.25, 4
#: Kneser-Ney discount.
DISCOUNT = 0.75
#: Characters scored at a time.
CHUNK = 1_000_000
SPACE = 1
_ODD = np.uint64(0x9E3779B97F4A7C15)


@cache
def symbols() -> np.ndarray:
    """By code point: the lower-case letter's symbol, or SPACE for all that is no letter. Letters beyond 16 bits share symbols."""
    table = np.full(sys.maxunicode + 1, SPACE, np.uint16)
    for i in range(sys.maxunicode + 1):
        if (c := chr(i)).isalpha():
            low = c.lower()
            table[i] = (ord(low) if len(low) == 1 else i) % 65521 + 2
    return table


def sequence(text: str) -> np.ndarray:
    """Symbols of the text, runs of other characters as one SPACE, with SPACEs before it as context and one behind."""
    own = symbols()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    gap = own == SPACE
    own = own[np.concatenate([[True], ~(gap[1:] & gap[:-1])])] if len(own) else own
    pad = np.full(ORDER - 1, SPACE, np.uint16)
    return np.concatenate([pad, own, pad[:1]])


def keys(symbol: np.ndarray, n: int) -> np.ndarray:
    """Packed n-gram that ends at each place from ORDER - 1 on."""
    out = np.zeros(len(symbol) - ORDER + 1, np.uint64)
    for k in range(n):
        low = ORDER - n + k
        out = out << np.uint64(16) | symbol[low : low + len(out)].astype(np.uint64)
    return out


def hashed(key: np.ndarray) -> np.ndarray:
    """One to one."""
    return key * _ODD


@dataclass
class Level:
    """N-grams of one order: sorted hashes with log probabilities, and contexts with the log weight of the level below."""

    grams: np.ndarray
    log_p: np.ndarray
    contexts: np.ndarray
    log_back: np.ndarray


def _find(array: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.searchsorted(array, wanted)
    place[place == len(array)] = 0
    return place, array[place] == wanted


class Model:
    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        """``counts``: by language the packed ORDER-grams and how often they occur."""
        self.languages = sorted(counts)
        self.levels: list[Level] = []
        grams = {lang: {ORDER: counts[lang]} for lang in self.languages}
        for own in grams.values():
            for n in range(ORDER - 1, 0, -1):  # in how many longer n-grams each one ends
                shorter = own[n + 1][0] & np.uint64((1 << (16 * n)) - 1)
                own[n] = tuple(np.unique(shorter, return_counts=True))
        letters = np.unique(np.concatenate([own[1][0] for own in grams.values()]))
        self.floor = -float(np.log(len(letters) + 1))
        for n in range(1, ORDER + 1):
            every = np.unique(np.concatenate([own[n][0] for own in grams.values()]))
            contexts = np.unique(every >> np.uint64(16))
            back = np.zeros((len(contexts), len(self.languages)))
            p = np.zeros((len(every), len(self.languages)))
            for j, lang in enumerate(self.languages):
                gram, count = grams[lang][n]
                at = np.searchsorted(contexts, gram >> np.uint64(16))
                total = np.bincount(at, count, len(contexts))
                kinds = np.bincount(at, minlength=len(contexts))
                known = total > 0
                weight = np.ones(len(contexts))
                weight[known] = DISCOUNT * kinds[known] / total[known]
                back[:, j] = np.log(weight)
                p[np.searchsorted(every, gram), j] = (count - DISCOUNT) / total[at]
            below = self._below(every, n)
            p += np.exp(back[np.searchsorted(contexts, every >> np.uint64(16))] + below)
            order, by_context = np.argsort(hashed(every)), np.argsort(hashed(contexts))
            self.levels.append(Level(hashed(every)[order], np.log(p)[order].astype(np.float32), hashed(contexts)[by_context], back[by_context].astype(np.float32)))
        self.limit, self.short = np.inf, 0.0

    def _below(self, gram: np.ndarray, n: int) -> np.ndarray:
        return self.log_p(gram & np.uint64((1 << (16 * (n - 1))) - 1), n - 1)

    def log_p(self, gram: np.ndarray, n: int) -> np.ndarray:
        """Interpolated log probability of each n-gram's last character, a column for each language."""
        if n == 0:
            return np.full((len(gram), len(self.languages)), self.floor, np.float32)
        level = self.levels[n - 1]
        place, hit = _find(level.grams, hashed(gram))
        out = level.log_p[place]
        miss = np.flatnonzero(~hit)
        if len(miss):
            rest = gram[miss]
            at, seen = _find(level.contexts, hashed(rest >> np.uint64(16)))
            out[miss] = np.where(seen[:, None], level.log_back[at], 0) + self._below(rest, n)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character under each language, and the number of characters; whole texts."""
        total, sizes = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        waiting: list[tuple[int, np.ndarray]] = []

        def flush() -> None:
            log_p = self.log_p(np.concatenate([g for _, g in waiting]), ORDER)
            at = np.cumsum([0, *[len(g) for _, g in waiting[:-1]]])
            sums = np.add.reduceat(log_p, at, axis=0, dtype=np.float64)
            for (k, _), row in zip(waiting, sums):
                total[k] += row
            waiting.clear()

        size = 0
        for k, text in enumerate(texts):
            gram = keys(sequence(text), ORDER)
            sizes[k] = len(gram)
            for low in range(0, len(gram), CHUNK):
                waiting.append((k, gram[low : low + CHUNK]))
                size += len(waiting[-1][1])
                if size >= CHUNK:
                    flush()
                    size = 0
        if waiting:
            flush()
        return -total / np.maximum(sizes, 1)[:, None], sizes

    def calibrate(self, entropy: np.ndarray, size: np.ndarray) -> None:
        """Set the largest accepted entropy, and what short texts may exceed it by, from texts in the learned languages."""
        if len(entropy):
            self.limit = float(np.quantile(entropy, KEPT)) + SLACK
            self.short = ERRORS * float(np.std((entropy - np.average(entropy, weights=size)) * np.sqrt(size)))

    def predict(self, texts: list[str]) -> list[tuple[str, float, float | None, bool]]:
        """Language, score, entropy and whether rejected. Without a letter: und, 0, null, rejected."""
        entropy, size = self.entropies(texts)
        out = []
        for text, row, n in zip(texts, entropy, size):
            if not self.languages or not any(map(str.isalpha, text)):
                out.append(("und", 0.0, None, True))
                continue
            best = int(np.argmin(row))
            score = 1 / np.exp(-(row - row[best]) * min(n, 20)).sum()
            out.append((self.languages[best], float(score), float(row[best]), bool(row[best] > self.limit + self.short / np.sqrt(n))))
        return out


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents, by crc32 of the id as text; documents without an id too. They are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def _samples(docs: DataFrame) -> DataFrame:
    """``lang, text, fit``: about SAMPLE_ROWS of each language's learnable rows, by a hash of the id."""
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) / (1 << 30) * F.col("n")
    rows = rows.join(F.broadcast(sizes), "lang").withColumn("turn", share)
    fit = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(3)) > 0
    return rows.where(F.col("turn") < SAMPLE_ROWS).select("lang", "text", fit.alias("fit"))


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_language: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by_language.setdefault(lang, []).append(keys(sequence(text), ORDER))
        for lang, found in by_language.items():
            gram, count = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram.view(np.int64)), pa.array(count)], ["lang", "gram", "n"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit and calibrate on the samples; the n-gram counts, bounded by them, are all that reaches the driver."""
    rows = _samples(text_table(docs, id_col, text_col, lang_col).withColumnRenamed(lang_col, "lang"))
    counts = arrow_map(rows.where("fit").select("lang", "text"), _gram_counts, "lang string, gram long, n long")
    found = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = np.array(found.column("lang").to_pylist(), object)
    gram = found.column("gram").to_numpy().view(np.uint64)
    number = found.column("n").to_numpy()
    by_language = {}
    for lang in set(langs.tolist()):
        own = langs == lang
        order = np.argsort(gram[own])
        by_language[lang] = (gram[own][order], number[own][order])
    model = Model(by_language) if by_language else _Nothing()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            entropy, size = own.entropies(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(entropy.min(axis=1)), pa.array(size)], ["entropy", "size"])

    if by_language:
        letters = rows.where("NOT fit").where(F.col("text").rlike(r"\p{L}")).select("text")
        seen = arrow_map(letters, measure, "entropy double, size long").toArrow()
        model.calibrate(seen.column("entropy").to_numpy(), seen.column("size").to_numpy())
    return model


class _Nothing(Model):
    """No labelled rows: every text is und."""

    def __init__(self):
        self.languages, self.levels, self.floor, self.limit, self.short = [], [], 0.0, np.inf, 0.0

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros((len(texts), 0)), np.zeros(len(texts), np.int64)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, entropy, rejected`` of every whole text, one row per row, from the text alone.

    Null texts and texts without a letter are ``und``, score 0, rejected. A rejected text with letters keeps its language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = own.predict(batch.column("text").to_pylist())
            columns = [pa.array(list(c), t) for c, t in zip(zip(*found) if found else [()] * 4, (pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "lang_pred", "score", "entropy", "rejected"])

    return arrow_map(text_table(docs, id_col, text_col), run, "doc_id long, lang_pred string, score double, entropy double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text the model does not reject, unchanged; without a learned language all rows stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array([not rejected for *_, rejected in own.predict(texts)], pa.bool_()))

    return arrow_map(docs, run, docs.schema) if model.languages else docs
