"""Operator 9: secret scans by ownership frequency, with DataFrame functions only.

Candidates are found by patterns in every whole text. The same value in the repositories of many owners is a copied
example; a value that few owners have looks live.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.staging import staged
from .common import fresh, text_table

# The kinds in their order, with pattern, group that holds the value, and shortest value.
BASE = [
    ("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
]
# A private key from its first line to its last, or as far as lines of base64 go; possessive, so that no text is too long.
_KEY = r"[A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
_BREAK = r"(?:\s|\\[nrt])*+"
_KEY_BLOCK = (
    rf"-----BEGIN {_KEY}((?:[^-]++|-(?!----))*+(?=-----END {_KEY})"
    rf"|(?:\s*+[A-Za-z][A-Za-z0-9-]*+:[^\r\n]*+(?=[\r\n]))*+(?:{_BREAK}[A-Za-z0-9+/=]{{16,}}+(?![A-Za-z0-9+/=.,;:!?-]))++"
    rf"(?:{_BREAK}[A-Za-z0-9+/]*+={{1,2}}|\s*[\r\n]\s*[A-Za-z0-9+/]++(?=[ \t]*(?:[\r\n]|$)))?|)(?:-----END {_KEY})?"
)
# Further credential formats, reported only where ownership says they are not copied examples.
MORE = [
    ("key_block", _KEY_BLOCK, 1, 20),
    ("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 28),
    ("live_key", r"[sr]k_live_[A-Za-z0-9]{16,}", 0, 24),
]
#: A value that at least so many owners have is a copied example.
EXAMPLE_OWNERS = 3


def key_body(value: Column) -> Column:
    return F.regexp_replace(value, r"\\[nrt]|[^A-Za-z0-9+/=]", "")


def _matches(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of (start, end, kind, value) of the non-overlapping matches; code points, end exclusive.

    The text between the matches, which split gives, places them. For runs of one class a least length within the pattern
    finds the same matches and spares the short ones.
    """
    if kind == "hex":
        pattern = f"[0-9a-f]{{{least},}}"
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    if kind == "key_block":
        # the key itself, however its lines are broken; a first line without a key stands for itself
        value = F.zip_with(whole, value, lambda w, v: F.when(F.char_length(key_body(v)) >= least, key_body(v)).otherwise(w))
    gaps = F.split(text, pattern, -1)
    rows = F.arrays_zip(whole.alias("w"), value.alias("v"), F.slice(gaps, 1, F.size(whole)).alias("g"))
    empty = F.array().cast("array<struct<start:int,end:int,kind:string,value:string>>")
    placed = F.aggregate(
        rows,
        F.struct(F.lit(0).alias("at"), empty.alias("found")),
        lambda acc, x: F.struct(
            (acc["at"] + F.char_length(x["g"]) + F.char_length(x["w"])).alias("at"),
            F.when(
                F.char_length(x["v"]) >= least,
                F.concat(
                    acc["found"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.char_length(x["g"])).alias("start"),
                            (acc["at"] + F.char_length(x["g"]) + F.char_length(x["w"])).alias("end"),
                            F.lit(kind).alias("kind"),
                            x["v"].alias("value"),
                        )
                    ),
                ),
            ).otherwise(acc["found"]).alias("found"),
        ),
        lambda acc: acc["found"],
    )
    return F.when(text.rlike(pattern), placed).otherwise(empty)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """``doc_id, row, owner, found``: one row per document, with every candidate in it by start, then kind as listed.

    ``row`` numbers the rows, so that equal ids stay apart.
    """
    rows = text_table(docs, id_col, text_col, owner_col).withColumnRenamed(owner_col, "owner")
    found = F.concat(*[_matches(F.col("text"), *kind) for kind in [*BASE, *MORE]])
    names = F.array(*[F.lit(k[0]) for k in [*BASE, *MORE]])
    order = lambda x: F.struct(x["start"].alias("start"), F.array_position(names, x["kind"]).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"), x["value"].alias("value"))
    return rows.select("doc_id", F.monotonically_increasing_id().alias("row"), F.col("owner").cast("string").alias("owner"), F.array_sort(F.transform(found, order)).alias("found"))


def ownership(found: DataFrame) -> DataFrame:
    """``value_hash, repositories, owners``: in how many documents and at how many owners a candidate value occurs.

    A null owner counts as one owner of its own. The values are hashed, and each owner's occurrences are added up before
    the owners are counted, so a value in a third of all rows is one row per owner by then.
    """
    values = found.select("row", "owner", F.explode(F.array_distinct(F.transform("found", lambda x: F.sha2(x["value"], 256)))).alias("value_hash"))
    owned = values.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return owned.groupBy("value_hash").agg(F.sum("n").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """``doc_id, spans``: every row of ``docs`` with an array of (start, kind, end, value_hash, owners, repositories, live).

    ``live`` is true below ``example_owners`` owners. Base kinds are always listed, the others only if live. A null or empty
    text has no spans. Spans of different kinds may overlap.
    """
    found = staged(candidates(docs, id_col, text_col, owner_col), "candidates")
    owners = ownership(found)
    spread = found.select("row", F.explode("found").alias("x")).withColumn("value_hash", F.sha2("x.value", 256))
    base = F.array(*[F.lit(k[0]) for k in BASE])
    joined = spread.join(owners, "value_hash").withColumn("live", F.col("owners") < example_owners)
    joined = joined.where(F.col("live") | F.array_contains(base, F.col("x.kind")))
    span = F.struct("x.start", "x.rank", "x.end", "x.kind", "value_hash", "owners", "repositories", "live")
    spans = joined.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return found.select("doc_id", "row").join(spans, "row", "left").select("doc_id", F.coalesce("spans", empty).alias("spans"))


def joined_spans(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with ``mark`` in place of every live span; copied examples stay. Overlapping spans become one mark.

    Rows of one id must be equal; rows without an id, and all other columns, are untouched.
    """
    key, found, clean = (fresh(docs, name) for name in ("_id", "_spans", "_clean"))
    spans = scan(docs, id_col, text_col, owner_col).select(F.col("doc_id").alias(key), F.filter("spans", lambda x: x["live"]).alias(found))
    spans = spans.where(F.size(found) > 0).groupBy(key).agg(F.first(found).alias(found))
    last = lambda acc: F.try_element_at(acc, F.lit(-1))
    part = lambda start, end: F.array(F.struct(start.alias("start"), end.alias("end")))
    merged = F.aggregate(
        found,
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (last(acc)["end"] > x["start"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), part(last(acc)["start"], F.greatest(last(acc)["end"], x["end"]))),
        ).otherwise(F.concat(acc, part(x["start"], x["end"]))),
    )
    text = F.col(f"`{text_col}`")
    masked = F.aggregate(
        merged,
        F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda acc, x: F.struct(F.concat(acc["done"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark)).alias("done"), x["end"].alias("at")),
        lambda acc: F.concat(acc["done"], F.substring(text, acc["at"] + 1, F.char_length(text))),
    )
    out = docs.join(spans, F.col(f"`{id_col}`") == F.col(key), "left").withColumn(clean, F.when(F.col(found).isNull(), text).otherwise(masked))
    return out.select(*[F.col(clean).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def digests(spans: DataFrame) -> DataFrame:
    """The counts and digests of op9 from scan's rows."""
    base = lambda kind: F.filter("spans", lambda x: x["kind"] == kind)
    counts = [F.size(base(kind)).cast("long").alias(f"n_{kind}") for kind, *_ in BASE]
    in_base = F.filter("spans", lambda x: reduce(lambda a, b: a | b, [x["kind"] == k for k, *_ in BASE]))
    return spans.select("doc_id", *counts, F.sha2(joined_spans(in_base), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))
