"""Splits by season and walk-forward folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..config import SEASON

# Default seasons of each split, in time order.
TRAIN_SEASONS = ("2020_2021", "2021_2022", "2022_2023")
VALIDATION_SEASONS = ("2023_2024",)
TEST_SEASONS = ("2024_2025",)
MAIN_SPLITS = ("train", "validation", "test")


def temporal_split(
    df: DataFrame,
    train: Sequence[str] = TRAIN_SEASONS,
    validation: Sequence[str] = VALIDATION_SEASONS,
    test: Sequence[str] = TEST_SEASONS,
    external: Sequence[str] = (),
) -> DataFrame:
    """Add ``split``; external seasons win over the others, unlisted seasons get NULL."""
    season = F.col(SEASON)
    split = F.when(season.isin(*external), "external") if external else F.when(F.lit(False), "external")
    for name, seasons in (("train", train), ("validation", validation), ("test", test)):
        split = split.when(season.isin(*seasons), name)
    return df.withColumn("split", split)


def require_splits(df: DataFrame) -> dict[str, int]:
    """Rows per split; raises if one of the three main splits is empty."""
    rows = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    empty = [name for name in MAIN_SPLITS if not rows.get(name)]
    if empty:
        raise ValueError(f"no rows in split: {', '.join(empty)}")
    return rows


def fold_table(seasons: Sequence[str]) -> list[tuple[str, str, str]]:
    """(fold, season, role): each fold validates one season and trains on those listed before it."""
    return [
        (fold, season, "validation" if season == fold else "train")
        for place, fold in enumerate(seasons)
        if place
        for season in seasons[: place + 1]
    ]


def walk_forward_folds(df: DataFrame, seasons: Sequence[str]) -> DataFrame:
    """One row per input row and fold it takes part in, with ``fold`` and ``role``.

    The folds of a season come from a map literal, so no join is needed.
    """
    by_season: dict[str, list[str]] = {}
    for fold, season, role in fold_table(seasons):
        by_season.setdefault(season, []).append(f"named_struct('fold', '{fold}', 'role', '{role}')")
    if not by_season:
        raise ValueError("walk-forward needs at least two seasons")
    branches = " ".join(f"WHEN '{season}' THEN array({', '.join(folds)})" for season, folds in by_season.items())
    return df.select("*", F.inline(F.expr(f"CASE {SEASON} {branches} END")))
