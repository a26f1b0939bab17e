"""All feature diagnostics in order."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from ..operators import diagnose as dg
from ..sources.io import write_reports
from ..sources.staging import staged, staged_together


class Diagnostics(NamedTuple):
    reports: dict[str, DataFrame]
    sets: DataFrame


def diagnose(
    df: DataFrame,
    key: str,
    target: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    threshold: float = dg.MIN_CORRELATION,
) -> Diagnostics:
    """Reports by name. Tables with one row per feature or pair are staged, as later reports join them."""
    matrix = staged(df.select(key, "split", target, *numeric, *categorical), "matrix")
    first = staged_together(
        {
            "missing": dg.missing_rate(matrix, [*numeric, *categorical]),
            "stability": dg.split_stability(matrix, numeric),
            "variance": dg.feature_variance(matrix, numeric),
            "association": dg.target_association(matrix, numeric, target),
            "pairs": dg.correlation_pairs(matrix, numeric, threshold),
        }
    )
    missing, stability, variance, association, pairs = first.values()
    rank_pairs = dg.spearman_pairs(matrix, key, numeric, threshold)
    later = staged_together(
        {
            "clusters": dg.correlation_clusters(pairs, missing, stability, association),
            "interactions": dg.interaction_candidates(matrix, target, association),
        }
    )
    clusters, interactions = later["clusters"], later["interactions"]
    sets = dg.feature_sets(missing, stability, variance, clusters, association, interactions)
    reports = {
        "feature_missing_rate": missing,
        "feature_stability_by_split": stability,
        "feature_variance": variance,
        "feature_univariate_target_association": dg.by_association(association),
        "feature_correlation_pairs": pairs,
        "feature_spearman_correlation_pairs": rank_pairs,
        "feature_correlation_clusters": clusters,
        "feature_interaction_candidates": interactions,
        "feature_pruning_recommendations": dg.pruning_recommendations(sets),
    }
    return Diagnostics(reports, sets)


def write(found: Diagnostics, folder: str) -> dict[str, str]:
    """Write every report as CSV and return the paths."""
    return write_reports(found.reports, folder)
