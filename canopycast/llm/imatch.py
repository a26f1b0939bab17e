"""Operator 6: I-Match document fingerprints, with DataFrame functions only.

The lexicon holds the terms whose inverse document frequency lies in a band. Each of several random subsets of the lexicon
gives one hash of the document's distinct terms in it, in order; the fingerprint is those hashes.

The lexicon is bounded whatever the corpus: a term in it occurs in at least 1/RAREST of the documents, so there are at
most RAREST times the mean number of distinct terms of a document. Terms are counted exactly, but only those in hash
buckets that are common enough to hold such a term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.staging import staged
from .common import text_table

#: The band: a term occurs in at least 1/RAREST and at most 1/COMMONEST of all documents.
RAREST, COMMONEST = 500, 5
#: Number of lexicon subsets. A term is in one if two digits of a hash are below the limit: even subsets hold 1/64 of the
#: lexicon, odd ones 1/256, so that short and long documents both leave some subsets alike after an edit.
SUBSETS, BELOW = 32, ("04", "01")
#: Hash buckets for the first count of terms, and of the lexicon table.
COUNT_BUCKETS, TABLE_BUCKETS = 1 << 18, 1 << 14
#: Id ranges, FAN squared, in which documents find their neighbour.
FAN = 32


def terms(text: Column) -> Column:
    """The distinct runs of letters and digits of the lower-case text."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != ""))


def _bucket(term: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(n)).cast("int")


def lexicon(docs: DataFrame, rarest: int = RAREST, commonest: int = COMMONEST, subsets: int = SUBSETS, below: tuple[str, str] = BELOW) -> DataFrame:
    """``term, df, subsets`` of the band over all rows of ``docs`` (column ``text``); ``subsets`` lists the subsets it is in."""
    n = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    each = docs.select(F.explode(terms(F.col("text"))).alias("term")).withColumn("bucket", _bucket(F.col("term"), COUNT_BUCKETS))
    # at most COUNT_BUCKETS rows
    heavy = staged(each.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") * rarest >= n).select("bucket"), "heavy")
    counts = each.join(F.broadcast(heavy), "bucket").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # written before the subsets are worked out, so that this is done once per term and not once per occurrence
    words = staged(counts.where((F.col("df") * rarest >= n) & (F.col("df") * commonest <= n)), "lexicon")
    member = F.filter(F.sequence(F.lit(0), F.lit(subsets - 1)), lambda k: F.substring(F.md5(F.concat_ws(":", k, "term")), 1, 2) < F.when(k % 2 == 0, below[0]).otherwise(below[1]))
    return words.withColumn("subsets", member)


def lexicon_table(words: DataFrame) -> Column:
    """The lexicon as one array of TABLE_BUCKETS lists, found by the hash of a term."""
    own = words.where(F.size("subsets") > 0).groupBy(_bucket(F.col("term"), TABLE_BUCKETS).cast("long").alias("id"))
    lists = own.agg(F.collect_list(F.struct("term", "subsets")).alias("words"))
    every = words.sparkSession.range(TABLE_BUCKETS).join(lists, "id", "left")
    ordered = F.array_sort(F.collect_list(F.struct("id", F.coalesce("words", F.array().cast(lists.schema["words"].dataType)).alias("words"))))
    return every.agg(F.transform(ordered, lambda x: x["words"]).alias("t")).scalar()


def known_terms(text: Column, table: Column) -> Column:
    """The document's terms in any subset, in order, with the subsets each is in."""
    found = F.flatten(F.transform(terms(text), lambda t: F.filter(F.get(table, _bucket(t, TABLE_BUCKETS)), lambda x: x["term"] == t)))
    return F.array_sort(found)


def fingerprint(known: Column, subsets: int = SUBSETS) -> Column:
    """Array of one hash per subset, null where the document has no term in it."""

    def one(k: Column) -> Column:
        own = F.transform(F.filter(known, lambda x: F.array_contains(x["subsets"], k)), lambda x: x["term"])
        return F.when(F.size(own) > 0, F.substring(F.md5(F.array_join(own, " ")), 1, 8))

    return F.transform(F.sequence(F.lit(0), F.lit(subsets - 1)), one)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that either document has terms in; without such, null."""
    both = F.arrays_zip(a.alias("a"), b.alias("b"))
    informed = F.size(F.filter(both, lambda x: x["a"].isNotNull() | x["b"].isNotNull()))
    equal = F.size(F.filter(both, lambda x: x["a"] == x["b"]))
    return F.when(informed > 0, equal / informed)


def _range_of(doc_id: Column, bounds: list[int], fan: int) -> Column:
    """How many of the ascending ``bounds`` are not above the id, found in two steps."""
    every = F.array(*[F.lit(b) for b in bounds])
    coarse = F.array(*[F.lit(b) for b in bounds[fan - 1 :: fan]])
    low = lambda array: F.size(F.filter(array, lambda b: b <= doc_id))
    start = low(coarse) * fan
    return start + low(F.slice(every, start + 1, F.lit(fan)))


def with_next(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """One row per distinct id, with ``next_id`` and ``next_text``: of the document that follows by descending id, after the
    last the first. Of rows with one id that of the least text counts. Rows without an id have no place and are dropped.

    Documents are sorted within ranges of ids; the last of each range is also given to the range that needs it.
    """
    rows = docs.where("doc_id IS NOT NULL")
    shares = [i / (fan * fan) for i in range(1, fan * fan)]
    bounds = rows.agg(F.percentile_approx("doc_id", shares, 100_000).alias("b")).first()["b"] or []
    rows = rows.withColumn("part", _range_of(F.col("doc_id"), bounds, fan) if bounds else F.lit(0))
    # at most FAN squared rows
    last = {r["part"]: r["id"] for r in rows.groupBy("part").agg(F.max("doc_id").alias("id")).collect()}
    parts = sorted(last)
    guests = [(last[p], parts[(k + 1) % len(parts)]) for k, p in enumerate(parts)]
    guest = docs.sparkSession.createDataFrame(guests, "doc_id long, part int")
    lent = rows.drop("part").join(F.broadcast(guest), "doc_id").select("doc_id", "text", "part", F.lit(0).alias("own"))
    every = rows.select("doc_id", "text", "part", F.lit(1).alias("own")).union(lent)
    # a guest has a lower id than its hosts, but for the highest id, which must come before all
    wrapped = (F.col("own") == 0) & (F.col("part") == (parts[0] if parts else 0))
    every = every.withColumn("turn", F.when(wrapped, 0).otherwise(1))
    order = Window.partitionBy("part").orderBy("turn", "doc_id", "text")
    again = (F.lag("doc_id").over(order) == F.col("doc_id")) & (F.lag("turn").over(order) == F.col("turn"))
    single = every.withColumn("again", F.coalesce(again, F.lit(False))).where("NOT again")
    return single.select(
        "doc_id", "text", "own", F.lag("doc_id").over(order).alias("next_id"), F.lag("text").over(order).alias("next_text")
    ).where("own = 1").drop("own")


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last third replaced by the beginning of the next one."""
    third = F.floor(F.char_length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - third), F.substring(next_text, F.lit(1), third))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, one row per distinct id.

    A fingerprint is the hashes, eight digits each, a run of hyphens for a subset without terms. A document whose subsets are
    all empty gets ``=`` and the digest of its text instead, and is like equal texts only. See ``with_next`` for repeated
    rows and missing ids. A single document follows itself.
    """
    rows = text_table(docs, id_col, text_col)
    table = lexicon_table(lexicon(rows))
    pair = with_next(rows).withColumn("edited", edited(F.col("text"), F.col("next_text"))).drop("next_text")
    pair = pair.select("doc_id", "next_id", "text", "edited", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    for name in ("text", "edited"):
        # the optimizer puts the subquery's result in the column's place, so no row carries the table
        pair = pair.withColumn("_table", table).withColumn(f"{name}_hashes", known_terms(F.col(name), F.col("_table"))).drop("_table")
        pair = pair.withColumn(name, F.sha2(name, 256))
        pair = pair.withColumn(f"{name}_hashes", fingerprint(F.col(f"{name}_hashes")))
    # a few hundred bytes a document
    done = staged(pair, "fingerprints")
    own = done.select(F.col("doc_id").alias("next_id"), F.col("text").alias("next"), F.col("text_hashes").alias("next_hashes"))
    done = done.join(own, "next_id")
    empty = lambda hashes: F.size(F.array_compact(hashes)) == 0
    written = lambda text, hashes: F.when(empty(hashes), F.concat(F.lit("="), text)).otherwise(F.concat(*[F.coalesce(F.get(hashes, F.lit(k)), F.lit("-" * 8)) for k in range(SUBSETS)]))
    near = lambda a, b: F.coalesce(likeness(F.col(f"{a}_hashes"), F.col(f"{b}_hashes")), (F.col(a) == F.col(b)).cast("double"))
    return done.select(
        "doc_id", "n_chars", "edited_sha256",
        written(F.col("text"), F.col("text_hashes")).alias("fingerprint"), written(F.col("edited"), F.col("edited_hashes")).alias("edited_fingerprint"),
        near("text", "edited").alias("near_edited"), near("text", "next").alias("near_next"),
    )
