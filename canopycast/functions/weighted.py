"""Least-squares and correlation formulas on rows that stand for several observations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def slope_sql(x: str, n: str, total: str, where: str = "true") -> str:
    """Least-squares slope where each row holds ``n`` observations at ``x`` with sum ``total``.

    NULL with fewer than two distinct ``x``.
    """
    def add(term: str) -> str:
        return f"(sum({term}) FILTER (WHERE {where}))"

    weight, sx = add(n), add(f"{n} * {x}")
    spread = f"({weight} * {add(f'{n} * {x} * {x}')} - {sx} * {sx})"
    return (
        f"CASE WHEN {spread} > 0 THEN "
        f"({weight} * {add(f'{x} * {total}')} - {sx} * {add(total)}) / {spread} END"
    )


def correlation(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """Pearson correlation from sums; NULL when a side is constant."""
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    r = (n * sxy - sx * sy) / F.sqrt(F.abs(vx)) / F.sqrt(F.abs(vy))
    return F.when((vx > 0) & (vy > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
