"""Encoding of text features by a vocabulary learned from training rows."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.names import feature_names
from ..sources.staging import staged

# Markers, the column always dropped, and the rule of each column.
OTHER = "__OTHER__"
MISSING = "__MISSING__"
DROPPED = ("prod_finca",)
MODES = ("controlled", "native", "none")
STRATEGIES = ("all", "min_count", "top_n", "top_n_or_min_count", "drop")
DEFAULT_RULE = {"strategy": "all"}
RULES = {
    "prod_familia_de_suelo": {"strategy": "min_count", "min_count": 30},
    "prod_variedad": {"strategy": "top_n_or_min_count", "top_n": 30, "min_count": 30},
    "prod_codigo_zae": {"strategy": "min_count", "min_count": 30},
}
# models that take text columns as they are
NATIVE_MODELS = ("forest", "boosted", "leafwise", "ordered")
#: A value with at least this share of a column's counted rows is spread over SALTS parts when it meets the vocabulary.
HOT_SHARE, SALTS = 0.01, 32
#: Values of a column that become one-hot columns.
MOST_CATEGORIES = 2000

#: Rows of one part of the hash order of ``ordered_statistics``, and how many rows the mean of the target counts for.
PART_ROWS, PRIOR_ROWS = 100_000, 1.0


@dataclass
class EncoderSpec:
    """What the encoder does; the vocabulary itself is a DataFrame."""

    mode: str
    columns: list[str] = field(default_factory=list)
    rules: dict[str, dict] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)


def resolve_mode(mode: str | None) -> str:
    """Encoding mode in lower case; ``controlled`` without one."""
    found = mode.lower() if mode else "controlled"
    if found not in MODES:
        raise ValueError(f"unknown encoding mode {mode!r}, expected one of {MODES}")
    return found


def check_mode(mode: str, model: str) -> None:
    if mode == "native" and model not in NATIVE_MODELS:
        raise ValueError(f"model {model!r} cannot take text columns; use mode 'controlled'")


def text_value(df: DataFrame, name: str) -> Column:
    """Text form of a value, with a marker for missing ones; booleans read True and False."""
    text = F.col(name).cast("string")
    if isinstance(df.schema[name].dataType, T.BooleanType):
        text = F.initcap(text)
    return F.coalesce(text, F.lit(MISSING))


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column and value in one pass over all columns; missing values are not counted."""
    texts = df.select(*[text_value(df, c).alias(c) for c in columns])
    tall = texts.unpivot([], list(columns), "feature", "category")
    return tall.where(F.col("category") != MISSING).groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))


def top_categories(counts: DataFrame, n: int | Mapping[str, int]) -> DataFrame:
    """Most frequent values of each column; of equally frequent ones the smaller text.

    Spark cuts each map task to the limit before it shuffles, so a column with many values is safe.
    """
    limits = n if isinstance(n, Mapping) else None
    most = max(limits.values()) if limits else n
    window = Window.partitionBy("feature").orderBy(F.desc("n"), "category")
    ranked = counts.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= most)
    if limits:
        allowed = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        ranked = ranked.where(F.col("rank") <= allowed[F.col("feature")])
    return ranked


def fit_vocab(train: DataFrame, columns: Sequence[str], rules: Mapping[str, dict] = RULES) -> DataFrame:
    """Vocabulary (feature, category, n) of the training rows, after the rule of each column."""
    chosen = {c: dict(rules.get(c, DEFAULT_RULE)) for c in columns}
    unknown = {r["strategy"] for r in chosen.values()} - set(STRATEGIES)
    if unknown:
        raise ValueError(f"unknown encoding strategy: {', '.join(sorted(unknown))}")
    feature, n = F.col("feature"), F.col("n")
    keep, limits = F.lit(False), {}
    for column, rule in chosen.items():
        strategy = rule["strategy"]
        if strategy == "all":
            keep = keep | (feature == column)
        if "min_count" in strategy:
            keep = keep | ((feature == column) & (n >= int(rule["min_count"])))
        if "top_n" in strategy:
            limits[column] = int(rule["top_n"])
    counts = category_counts(train, columns)
    result = counts.where(keep)
    if limits:
        top = top_categories(counts.where(feature.isin(*limits)), limits).drop("rank")
        result = result.unionByName(top).distinct()
    return result


def vocab_lists(vocab: DataFrame, most: int = MOST_CATEGORIES) -> dict[str, list[str]]:
    """Sorted values of each column, as one-hot columns need them: one entry per column that will be made, at most ``most`` of a column."""
    lists: dict[str, list[str]] = {}
    large = vocab.groupBy("feature").count().where(F.col("count") > most).orderBy("feature").first()
    if large:
        raise ValueError(f"column {large['feature']!r} has {large['count']} values, more than {most} one-hot columns; use a rule or mode 'native'")
    for row in vocab.select("feature", "category").collect():
        lists.setdefault(row["feature"], []).append(row["category"])
    return {feature: sorted(values) for feature, values in lists.items()}


def apply_vocab(df: DataFrame, vocab: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace values outside the vocabulary by a marker; missing values keep theirs.

    Every column is joined with its vocabulary, whatever its size. Missing values take no part in the join, and the
    frequent ones, known from the counts, are spread over several parts.
    """
    vocab = staged(vocab, "vocabulary")
    total = Window.partitionBy("feature")
    parts = F.when(F.col("n") >= HOT_SHARE * F.sum("n").over(total), SALTS).otherwise(1)
    known = vocab.withColumn("_parts", parts).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    # at most 1 / HOT_SHARE values a column
    hot: dict[str, list[str]] = {c: [] for c in columns}
    for row in known.where("_parts > 1 AND _salt = 0").where(F.col("feature").isin(*columns)).collect():
        hot[row["feature"]].append(row["category"])
    result = df.withColumns({c: text_value(df, c) for c in columns})
    for c in columns:
        values = known.where(F.col("feature") == c).select(F.col("category").alias("_known"), "_salt")
        salt = F.when(F.col(c).isin(*hot[c]), F.floor(F.rand(seed=7) * SALTS)).otherwise(0).cast("int")
        rows = result.withColumns({"_value": F.when(F.col(c) != MISSING, F.col(c)), "_at": salt})
        joined = rows.join(values, (F.col("_value") == F.col("_known")) & (F.col("_at") == F.col("_salt")), "left")
        value = F.when(F.col("_known").isNotNull() | (F.col(c) == MISSING), F.col(c)).otherwise(OTHER)
        result = joined.withColumn(c, value).drop("_known", "_salt", "_value", "_at")
    return result


def one_hot(df: DataFrame, lists: Mapping[str, Sequence[str]], columns: Sequence[str]) -> DataFrame:
    """Replace each column by 0/1 columns, one per known value and one each for other and missing."""
    kept = [c for c in df.columns if c not in columns]
    values = {c: [*lists.get(c, []), *[m for m in (OTHER, MISSING) if m not in lists.get(c, [])]] for c in columns}
    # the place of the value in its list first, so that each 0/1 column compares one number
    place = {}
    for c in columns:
        other = values[c].index(OTHER)
        text = text_value(df, c)
        place[f"_at_{c}"] = F.array_position(F.array(*[F.lit(v) for v in values[c]]), text) - 1
        place[f"_at_{c}"] = F.when(text.isin(*values[c]), place[f"_at_{c}"]).otherwise(other)
    made = [(f"{c}_{v}", f"CASE WHEN `_at_{c}` = {i} THEN 1 ELSE 0 END") for c in columns for i, v in enumerate(values[c])]
    names = feature_names([*kept, *[name for name, _ in made]])
    texts = [f"`{c}`" for c in kept] + [sql for _, sql in made]
    return df.withColumns(place).select(*[F.expr(f"{sql} AS {name}") for sql, name in zip(texts, names)])


def encoder_spec(
    columns: Sequence[str], mode: str, rules: Mapping[str, dict] = RULES, dropped: Sequence[str] = DROPPED
) -> EncoderSpec:
    used = [c for c in columns if c not in dropped]
    return EncoderSpec(
        resolve_mode(mode), used, {c: dict(rules.get(c, DEFAULT_RULE)) for c in used},
        [c for c in columns if c in dropped],
    )


def encode(df: DataFrame, spec: EncoderSpec, vocab: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Apply the encoder. ``keep`` names text columns, such as keys, that are not features."""
    rows = df.drop(*spec.dropped)
    columns = [c for c in spec.columns if c in rows.columns and c not in keep]
    if spec.mode == "none":
        rows = rows.drop(*columns)
    elif spec.mode == "native":
        rows = rows.withColumns({c: text_value(rows, c) for c in columns})
    else:
        return one_hot(rows, vocab_lists(vocab), columns)
    return rows.toDF(*feature_names(rows.columns))


# ---------------------------------------------------------------- statistics of the target


@dataclass(frozen=True)
class Statistics:
    """Sum of the target and rows of each category (``feature, category, total, n``), and the mean of the target."""

    table: DataFrame
    mean: float

    def value(self, total: Column, n: Column) -> Column:
        return (total + F.lit(PRIOR_ROWS * self.mean)) / (n + F.lit(PRIOR_ROWS))


def _tall(df: DataFrame, columns: Sequence[str], *kept: Column) -> DataFrame:
    texts = df.select(*kept, *[text_value(df, c).alias(f"_text_{c}") for c in columns])
    names = [c for c in texts.columns if not c.startswith("_text_")]
    tall = texts.unpivot(names, [f"_text_{c}" for c in columns], "feature", "category")
    return tall.withColumn("feature", F.substring("feature", len("_text_") + 1, 1_000_000))


def category_statistics(df: DataFrame, columns: Sequence[str], target: str) -> Statistics:
    """Statistics of all rows with a target, staged. A missing text is a category of its own."""
    rows = df.where(F.col(target).isNotNull())
    mean = rows.agg(F.avg(target)).first()[0] or 0.0
    tall = _tall(rows, columns, F.col(target).cast("double").alias("_y"))
    sums = tall.groupBy("feature", "category").agg(F.sum("_y").alias("total"), F.count(F.lit(1)).alias("n"))
    return Statistics(staged(sums, "statistics"), mean)


def ordered_statistics(
    df: DataFrame, columns: Sequence[str], target: str, key: str, found: Statistics, seed: int = 42, part_rows: int = PART_ROWS
) -> DataFrame:
    """Add ``_stat_<column>``: the category's statistic over the rows before this one, so that no row sees its own target.

    Rows are ordered by md5 of seed and key, then by target. The order is cut into parts of even size by the first digits of
    the hash. Each part of a category adds up on its own and takes the sums of the parts before it from a table of sums, so
    that one category may hold all rows. Rows without a target get the statistic of the rows before them too.
    """
    rows = staged(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    parts = max(1, -(-rows.count() // part_rows))
    mark = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    tall = _tall(rows, columns, F.col("_row"), mark.alias("_mark"), F.col(target).cast("double").alias("_y"))
    place = F.floor(F.conv(F.substring("_mark", 1, 8), 16, 10).cast("long") * parts / F.lit(1 << 32))
    tall = tall.withColumn("_part", place)
    one = F.when(F.col("_y").isNotNull(), 1).otherwise(0)
    before = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("feature", "category", "_part").orderBy("_mark", "_y").rowsBetween(*before)
    tall = tall.withColumns({"_sum": F.coalesce(F.sum("_y").over(inside), F.lit(0.0)), "_n": F.coalesce(F.sum(one).over(inside), F.lit(0))})
    lower = Window.partitionBy("feature", "category").orderBy("_part").rowsBetween(*before)  # at most as many rows as parts
    sums = tall.groupBy("feature", "category", "_part").agg(F.sum("_y").alias("_s"), F.sum(one).alias("_c"))
    sums = sums.select(
        "feature", "category", "_part", F.coalesce(F.sum("_s").over(lower), F.lit(0.0)).alias("_sum0"), F.coalesce(F.sum("_c").over(lower), F.lit(0)).alias("_n0")
    )
    value = found.value(F.col("_sum") + F.col("_sum0"), F.col("_n") + F.col("_n0"))
    each = tall.join(sums, ["feature", "category", "_part"]).select("_row", "feature", value.alias("_value"))
    wide = each.groupBy("_row").agg(*[F.max(F.when(F.col("feature") == c, F.col("_value"))).alias(f"_stat_{c}") for c in columns])
    return rows.join(wide, "_row").drop("_row")


def apply_statistics(df: DataFrame, found: Statistics, columns: Sequence[str]) -> DataFrame:
    """Add ``_stat_<column>``: the statistic of the category over all training rows; unknown ones get the mean.

    Frequent categories (at least ``HOT_SHARE`` of the rows) are looked up in a map, the others in a join.
    """
    values = found.table.withColumn("_value", found.value(F.col("total"), F.col("n")))
    share = F.col("n") >= HOT_SHARE * F.sum("n").over(Window.partitionBy("feature"))
    values = values.withColumn("_hot", share)
    hot: dict[str, dict[str, float]] = {c: {} for c in columns}
    for r in values.where("_hot").where(F.col("feature").isin(*columns)).collect():  # at most 1 / HOT_SHARE a column
        hot[r["feature"]][r["category"]] = r["_value"]
    result = df
    for c in columns:
        text = text_value(df, c)
        known = F.create_map(*[F.lit(x) for pair in hot[c].items() for x in pair]) if hot[c] else None
        direct = known[text] if known is not None else F.lit(None).cast("double")
        # what the map knows must match nothing in the join, and must not meet in one partition
        away = F.concat(F.lit("\x00"), F.floor(F.rand(seed=7) * 4096).cast("string"))
        result = result.withColumn("_direct", direct).withColumn("_text", F.when(F.col("_direct").isNull(), text).otherwise(away))
        rare = values.where((F.col("feature") == c) & ~F.col("_hot")).select(F.col("category").alias("_text"), F.col("_value").alias("_rare"))
        result = result.join(rare, "_text", "left").withColumn(f"_stat_{c}", F.coalesce("_direct", "_rare", F.lit(found.mean)))
        result = result.drop("_text", "_direct", "_rare")
    return result


def save_state(spec: EncoderSpec, vocab: DataFrame, path: str) -> None:
    """Write the vocabulary as parquet and the rest as one JSON line."""
    vocab.write.mode("overwrite").parquet(f"{path}/vocabulary")
    spark = vocab.sparkSession
    text = json.dumps({**asdict(spec), "other": OTHER, "missing": MISSING})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")


def load_state(spark: SparkSession, path: str) -> tuple[EncoderSpec, DataFrame]:
    found = json.loads(spark.read.text(f"{path}/spec").first()["value"])
    spec = EncoderSpec(**{k: v for k, v in found.items() if k not in ("other", "missing")})
    return spec, spark.read.parquet(f"{path}/vocabulary")
