"""Operator 1: substring dedup by MinHash banding of paragraphs.

The paragraphs are the text's lines of GRAM words or more, whole. Those that share a band of their MinHash signature are
compared by exact Jaccard similarity of their 5-grams, and similar ones are joined into components. Of a component that occurs in
several documents the lines of the first document stay and all others go.

Passages repeat within lines and across them too. A further net, for exact repeats, are windows of PARAGRAPH words that begin
where the text itself says: at the least 5-gram hash of any SPREAD neighbouring ones. A passage of SPREAD - 1 + PARAGRAPH = 50
words or more has the same windows wherever it stands. Windows that an earlier document has go too, and with them the words
beside them as far as they agree with the first document that has the next word too.

A text is read three times: for its paragraphs, for the 5-grams of lines that met and the words beside windows, and to cut it.
A row is known by a hash of its id and text, so rows of one id may differ and equal rows are treated alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.staging import discard, staged
from .common import arrow_map, components, fresh
from .ngram_join import _blocks, _verify, grams, mixed

#: Words of a window, how many 5-grams in a row have one that begins a window, and words of the shortest line.
PARAGRAPH, SPREAD, GRAM = 24, 27, 5
#: Least similarity, in percent, and the recall that the bands must have for it.
PERCENT, RECALL = 80, 0.95
#: Hashes of a band: so many that what shares a band key is mostly similar.
ROWS = 3
#: Words of a match beside a window that no other window may cover: a window begins in any SPREAD neighbouring places.
REACH = SPREAD + PARAGRAPH - 2
#: Where a row without an id stands: after all others, with all of its kind as one document.
LAST = 2**63 - 1
#: A content of more than one in HOT paragraphs is hot.
HOT = 1000
#: Words whose positions are handled at a time.
STRETCH = 1 << 22
#: Lines whose signature one task has sent and does not send again.
SENT = 200_000
_BASE = np.uint64(0xD1342543DE82EF95)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))


def tune_bands(percent: int = PERCENT, recall: float = RECALL, rows: int = 1) -> int:
    """The fewest bands of ``rows`` hashes that bring pairs of just this similarity together with the wanted probability."""
    bands = 1
    while 1 - (1 - (percent / 100) ** rows) ** bands < recall:
        bands += 1
    return bands


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    out, size = x, 1
    while 2 * size <= width:
        out, size = np.minimum(out[:-size], out[size:]), 2 * size
    return np.minimum(out[: len(x) - width + 1], out[width - size : len(x) - size + 1]) if size < width else out


def begins(gram: np.ndarray) -> np.ndarray:
    """Places where paragraphs begin: of the least hash, the leftmost on ties, of every SPREAD 5-grams."""
    found = [np.zeros(0, np.int64)]
    bits = np.uint64(24)
    for start in range(0, max(1, len(gram)), STRETCH):
        part = mixed(gram[start : start + STRETCH + SPREAD - 1], 7)
        place = np.arange(len(part), dtype=np.uint64)
        order = (part >> bits << bits) | place
        least = _least(order, min(SPREAD, len(order))) if len(order) else order
        found.append(np.unique(least & np.uint64((1 << 24) - 1)).astype(np.int64) + start)
    return np.unique(np.concatenate(found))


def joined_hash(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums and powers from which ``run_hash`` has the hash of any run of words."""
    power = np.full(len(word) + 1, _BASE)
    power[0] = 1
    total = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word * np.cumprod(power)[:-1], out=total[1:])
    power[1:] = _UNBASE
    return total, np.cumprod(power)


def run_hash(joined: tuple[np.ndarray, np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of the words from ``low`` to before ``high``, for whole arrays of places."""
    total, back = joined
    return mixed(mixed((total[high] - total[low]) * back[low], 11) + (high - low).astype(np.uint64), 11)


def words_of(text: str) -> list[list[bytes]]:
    """The words of each line."""
    return [x.split() for x in re.split(b"[\r\n]+", text.lower().encode().lower())]


def hashes(lines: list[list[bytes]]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(lines)), np.uint64)


def units(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The text's 5-grams; where its lines and then its windows begin, how many words they have, the hash of these; and how many are lines."""
    lines = words_of(text)
    word = hashes(lines)
    size = np.fromiter(map(len, lines), np.int64)
    at = np.cumsum(size) - size
    at, size = at[size >= GRAM], size[size >= GRAM]
    gram = grams(word, GRAM) if len(word) >= GRAM else word[:0]
    window = begins(gram)
    window = window[window + PARAGRAPH <= len(word)]
    n = len(at)
    at, size = np.concatenate([at, window]), np.concatenate([size, np.full(len(window), PARAGRAPH)])
    joined = joined_hash(word)
    return gram, at, size, run_hash(joined, at, at + size), n


def signatures(gram: np.ndarray, low: np.ndarray, high: np.ndarray, bands: int) -> list[np.ndarray]:
    """A key per band of every run ``low`` to ``high`` of the 5-grams: the least of ROWS hashes each."""
    salt = mixed(np.arange(2 * bands * ROWS, dtype=np.uint64), 17) | np.uint64(1)
    ends, keys = np.stack([low, high], 1).ravel(), []
    for band in range(bands):
        key = np.full(len(low), band, np.uint64)
        for k in range(2 * band * ROWS, 2 * (band + 1) * ROWS, 2):
            x = np.append((gram ^ salt[k]) * salt[k + 1], np.uint64(2**64 - 1))
            key = mixed(key * np.uint64(3) + np.minimum.reduceat(x, ends)[::2], 13)
        keys.append(key)
    return keys


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, doc_id, text`` of rows with a text; ``row`` is the same for equal rows only."""
    text = F.col(f"`{text_col}`").cast("string")
    own = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("doc_id"), text.alias("text")).where("text <> ''")
    return own.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), "doc_id", "text")


def row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(F.coalesce(doc_id.cast("long"), F.lit(LAST)), text.cast("string"))


def _paragraphs(rows: DataFrame, bands: int) -> DataFrame:
    """``row, doc_id, line, content, at, size`` and a key per band, ``b0`` and on, which a window and a line sent before do not have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            parts: list[list[np.ndarray]] = [[] for _ in range(7)]
            signed: list[list[np.ndarray]] = [[], [], []]  # 5-grams of texts with a new line, and where these lines begin and end
            start = 0
            for row, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                gram, at, size, content, n = units(text)
                if not len(at):
                    continue
                if len(sent) > SENT:
                    sent.clear()
                new = np.zeros(len(at), bool)
                for k, c in enumerate(content[:n].tolist()):
                    if c not in sent:
                        sent.add(c)
                        new[k] = True
                if new.any():
                    for column, value in zip(signed, (gram, start + at[new], start + at[new] + size[new] - GRAM + 1)):
                        column.append(value)
                    start += len(gram)
                whole = np.full(len(at), row, np.int64), np.full(len(at), doc_id, np.int64), np.arange(len(at)) < n
                for column, value in zip(parts, (*whole, content.view(np.int64), at, size, new)):
                    column.append(value)
            if parts[0]:
                row, doc_id, line, content, at, size, new = map(np.concatenate, parts)
                keys = np.zeros((bands, len(at)), np.uint64)
                if new.any():  # once a batch, as texts are short
                    keys[:, new] = signatures(*map(np.concatenate, signed), bands)
                columns = [pa.array(row), pa.array(doc_id), pa.array(line), pa.array(content), pa.array(at, pa.int32()), pa.array(size, pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(k.view(np.int64), mask=~new) for k in keys)], names)

    schema = "row long, doc_id long, line boolean, content long, at int, size int, " + ", ".join(f"b{k} long" for k in range(bands))
    names = [x.split()[0] for x in schema.split(", ")]
    return arrow_map(rows, run, schema)


def _families(lines: DataFrame, bands: int) -> DataFrame:
    """``family, node``: the contents of each band key that has several; keys with the same contents are one family."""
    every = lines.groupBy("content").agg(*[F.max(f"b{k}").alias(f"b{k}") for k in range(bands)])
    rows = every.select("content", F.explode(F.array(*[F.xxhash64(F.lit(k), F.col(f"b{k}")) for k in range(bands)])).alias("key"))
    mark = F.xxhash64(F.count(F.lit(1)), F.bit_xor(F.xxhash64("content")), F.sum(F.shiftright("content", 20)))
    keys = rows.groupBy("key").agg(mark.alias("family"), F.min("content").alias("least"), F.max("content").alias("most")).where("least < most")
    return rows.join(keys.select("key", "family"), "key").select("family", F.col("content").alias("node")).distinct()


def _occurrences(every: DataFrame, several: DataFrame, total: int) -> DataFrame:
    """The paragraphs among ``several``, with ``kept``. Contents of more than 1 / HOT of all paragraphs, fewer than HOT, are joined as a
    broadcast table, so that none of them fills a partition."""
    hot = several.where(F.col("rows") * HOT > total).select("line", "content", F.col("kept").alias("hot_kept"))
    met = every.join(F.broadcast(hot), ["line", "content"], "left")
    columns = ["line", "row", "doc_id", "content", "at", "size"]
    rest = met.where("hot_kept IS NULL").select(*columns).join(several.where(F.col("rows") * HOT <= total).drop("rows"), ["line", "content"])
    return met.where("hot_kept IS NOT NULL").select(*columns, F.col("hot_kept").alias("kept")).unionByName(rest.select(*columns, "kept"))


def _looked_up(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, n, shingles`` of wanted lines and ``row, doc_id, content, side, place, own, near`` of wanted window ends.

    ``wanted`` has ``row, content, at, size, side, own``: side -1 asks for the 5-grams of the line, 0 and 1 for the up to REACH words
    before or after the window; ``own`` is handed on. Only texts with something wanted are taken apart.
    """
    asked = wanted.groupBy("row").agg(F.collect_list(F.struct("content", "at", "size", "side", "own")).alias("asked"))
    joined = rows.join(asked, "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # equal rows are looked up once by a task
        for batch in batches:
            lines: list[list] = [[], [], []]
            ends: list[list] = [[] for _ in names[3:]]
            asked = batch.column("asked")
            offset, fields = asked.offsets.to_pylist(), asked.flatten()
            first = offset[0]
            content, at, size, side, own = (fields.field(k).to_pylist() for k in range(5))
            for k, (row, doc_id, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text")))):
                if row in done:
                    continue
                if len(done) > SENT:
                    done.clear()
                done.add(row)
                word = hashes(words_of(text))
                ahead = word.astype(np.uint32).view(np.int32)
                back, n = ahead[::-1], len(word)
                for j in range(offset[k] - first, offset[k + 1] - first):
                    low, high = at[j], at[j] + size[j]
                    if side[j] < 0:
                        gram = np.unique(grams(word[low:high], GRAM))
                        values, out = (content[j], len(gram), gram.tobytes()), lines
                    else:
                        place = high if side[j] else low
                        near = ahead[high : high + REACH] if side[j] else back[n - low : n - low + REACH]
                        values, out = (row, doc_id, content[j], side[j], place, own[j], near), ends
                    for column, value in zip(out, values):
                        column.append(value)
            for found, low in ((lines, 0), (ends, 3)):
                count = len(found[0])
                columns = [pa.nulls(count, t) for t in types]
                columns[low : low + len(found)] = [pa.array(v, t) for v, t in zip(found, types[low:])]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "node long, n long, shingles binary, row long, doc_id long, content long, side int, place int, own boolean, near array<int>"
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int32())]
    return arrow_map(joined, run, schema)


def _line_links(families: DataFrame, gram: DataFrame, percent: int) -> DataFrame:
    """``node, component`` of the lines that are similar to another one, whatever documents they stand in.

    All contents of a band key are compared with one another, those of a large one block by block as in operator 4.
    """
    members = families.join(gram.select("node", "n"), "node").withColumn("copies", F.lit(1).cast("long"))
    pairs = _blocks(members, percent).join(gram.select("node", "shingles"), "node").repartition("key").sortWithinPartitions("key")
    found = staged(arrow_map(pairs, _verify(percent), "node long, rep long, links long"), "line-links")
    label = components(found.select(F.col("node").alias("a"), F.col("rep").alias("b")))
    discard(found)
    return label


def _further(beside: DataFrame) -> DataFrame:
    """``row, side, place, more``: how many words beside an ``own`` end agree with an earlier document that has the end's window.

    ``beside`` has the words beside all windows of these contents. The document is the first that has the next word too.
    """
    rows = beside.where(F.size("near") > 0).withColumn("h", F.xxhash64("content", "side", F.get("near", 0)))
    first = rows.groupBy("h").agg(F.min("doc_id").alias("first"), F.min_by("near", F.struct("doc_id", F.xxhash64("near"))).alias("other"))
    met = rows.where("own").select("row", "doc_id", "side", "place", "near", "h").join(first, "h").where("first < doc_id")
    equal = F.zip_with(F.slice("near", 1, F.size("other")), F.slice("other", 1, F.size("near")), lambda x, y: x == y)
    upto = F.array_position(equal, F.lit(False)).cast("int")
    agreed = F.when(upto > 0, upto - 1).otherwise(F.size(equal))
    return met.groupBy("row", "side", "place").agg(F.max(agreed).alias("more"))


def _stretches(runs: DataFrame) -> DataFrame:
    """``runs`` (``row, removed, at, end``) with ``first`` and ``last`` of those of one decision that overlap or touch."""
    order = Window.partitionBy("row", "removed").orderBy("at", "end")
    new = F.col("at") > F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    own = runs.withColumn("new", F.coalesce(new, F.lit(True)).cast("int")).withColumn("stretch", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    stretch = Window.partitionBy("row", "removed", "stretch")
    return own.withColumn("first", F.min("at").over(stretch)).withColumn("last", F.max("end").over(stretch)).drop("new", "stretch")


def stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, recall: float = RECALL) -> DataFrame:
    """``row, doc_id, at, end, component, kept, removed``: the repeats of ``repeats``, by the row's hash; written to the shared folder."""
    rows, bands = _rows(docs, id_col, text_col), tune_bands(percent, recall, ROWS)
    every = staged(_paragraphs(rows, bands), "paragraphs")
    line = every.where("line")

    # windows and lines that stand in several documents as they are; where a window ends a stretch of them, the words beside it count
    total = every.count()
    several = every.groupBy("line", "content").agg(F.min("doc_id").alias("kept"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("rows"))
    several = staged(several.where("kept < most").select("line", "content", "kept", "rows"), "several")
    found = _occurrences(every, several, total).select(
        "line", "row", "doc_id", "content", "at", (F.col("at") + F.col("size")).alias("end"), "kept", (F.col("kept") < F.col("doc_id")).alias("removed")
    )
    exact = found = staged(_stretches(found.distinct()), "exact")
    found = found.where("NOT line").withColumns(
        {"own0": F.col("removed") & (F.col("at") == F.col("first")), "own1": F.col("removed") & (F.col("end") == F.col("last"))}
    )
    own = found.select("content", F.explode(F.array(F.when(F.col("own0"), 0), F.when(F.col("own1"), 1))).alias("side")).where("side IS NOT NULL").distinct()
    beside = found.join(own, "content").select(
        "row", "content", "at", (F.col("end") - F.col("at")).alias("size"), "side", F.when(F.col("side") == 0, F.col("own0")).otherwise(F.col("own1")).alias("own")
    )

    # lines that share a band key, one place of each
    families = staged(_families(line, bands), "families")
    nodes = families.select(F.col("node").alias("content")).distinct()
    one = F.min(F.struct("row", "at", "size"))
    place = line.join(nodes, "content").groupBy("content").agg(one.alias("p")).select("p.row", "content", "p.at", "p.size", F.lit(-1).alias("side"), F.lit(False).alias("own"))
    looked_up = staged(_looked_up(rows, beside.unionByName(place)), "looked-up")
    label = _line_links(families, looked_up.where("node IS NOT NULL").select("node", "n", "shingles").dropDuplicates(["node"]), percent)

    # the first document of each component keeps its lines; components of one document are no repeats
    own = line.groupBy("content").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).join(label.withColumnRenamed("node", "content"), "content", "left")
    own = staged(own.where("low < high OR component IS NOT NULL").select("content", F.coalesce("component", "content").alias("component"), "low", "high"), "contents")
    reach = own.groupBy("component").agg(F.min("low").alias("kept"), F.max("high").alias("most")).where("kept < most")
    kept = own.join(reach, "component").select("content", "component", "kept")
    lines = line.join(kept, "content").select(
        "row", "doc_id", (F.col("kept") < F.col("doc_id")).alias("removed"), "at", (F.col("at") + F.col("size")).alias("end"), "component", "kept"
    )

    more = _further(looked_up.where("node IS NULL"))
    grown = found.select("row", "doc_id", "removed", "at", "end", F.col("content").alias("component"), "kept")
    for side, at in enumerate(("at", "end")):
        step = more.where(F.col("side") == side).select("row", F.lit(True).alias("removed"), F.col("place").alias(at), F.col("more").alias(f"more{side}"))
        grown = grown.join(step, ["row", "removed", at], "left")
    grown = grown.withColumns({"at": F.col("at") - F.coalesce("more0", F.lit(0)), "end": F.col("end") + F.coalesce("more1", F.lit(0))})
    merged = _stretches(lines.unionByName(grown.select(*lines.columns)))
    result = merged.groupBy("row", "removed", F.col("first").alias("at"), F.col("last").alias("end")).agg(
        F.min("doc_id").alias("doc_id"), F.min("component").alias("component"), F.min("kept").alias("kept")
    )
    result = staged(result, "stretches")
    discard(every, several, exact, families, looked_up, label, own)
    return result


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, recall: float = RECALL) -> DataFrame:
    """Passages that occur in several documents: ``doc_id, start_word, end_word, component_id, kept_doc_id, removed``.

    One row per stretch of words (from 0, end exclusive) of a row of ``docs``. ``removed`` are all but those in ``kept_doc_id``: of a
    component of similar lines the document of smallest id, also where they are like it only through others between; of a
    window of words the first document that has it. Stretches of one decision that overlap or touch are one. A
    removed window goes on as far as the words beside it agree with the first document that has the window and the next word, so no word goes but those of lines that
    are similar and of runs that an earlier document has. ``component_id`` is one of the stretch's components. Equal rows count once; rows of
    one id are one document, and so are, after all others, the rows without an id. Null, empty and texts below GRAM words have no
    paragraph. A row without a repeated passage is not listed.
    """
    doc_id = F.when(F.col("doc_id") < LAST, F.col("doc_id")).alias("doc_id")
    return stretches(docs, id_col, text_col, percent, recall).select(
        doc_id, F.col("at").cast("long").alias("start_word"), F.col("end").cast("long").alias("end_word"),
        F.col("component").alias("component_id"), F.col("kept").alias("kept_doc_id"), "removed",
    )


_WORD = re.compile("[^\t-\r ]+")


def cut(text: str, stretches: list[tuple[int, int]]) -> str:
    """The text without these stretches of words and the white space behind them."""
    place = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    kept, at = [], 0
    for low, high in sorted(stretches):
        kept.append(text[at : place[low]])
        at = max(at, place[min(high, len(place) - 1)])
    return "".join([*kept, text[at:]])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every removed stretch cut out of the text; the same columns, and ``n_chars`` kept right if there is one.

    A row of which no word is left stays, without a word; rows without a removed stretch are untouched.
    """
    key, mark = fresh(docs, "_row"), fresh(docs, "_cuts")
    places = F.collect_list(F.struct(F.col("at").alias("start_word"), F.col("end").alias("end_word")))  # of one row
    found = stretches(docs, id_col, text_col).where("removed").groupBy(F.col("row").alias(key)).agg(places.alias(mark))
    own = docs.withColumn(key, row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    joined = own.join(found, key, "left").drop(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts, texts = batch.column(mark).to_pylist(), batch.column(text_col).to_pylist()
            texts = [t if not c or t is None else cut(t, [(x["start_word"], x["end_word"]) for x in c]) for t, c in zip(texts, cuts)]
            columns = {}
            for name in batch.schema.names:
                if name == text_col:
                    columns[name] = pa.array(texts, pa.string())
                elif name == "n_chars" and text_col == "text":
                    columns[name] = pa.array([n if not c or t is None else len(t) for n, t, c in zip(batch.column(name).to_pylist(), texts, cuts)], batch.schema.field(name).type)
                elif name != mark:
                    columns[name] = batch.column(name)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return arrow_map(joined, run, docs.schema)
