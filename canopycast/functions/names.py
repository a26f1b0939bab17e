"""Rules for feature column names."""

from __future__ import annotations

import re
from collections.abc import Iterable


def feature_name(name: object) -> str:
    """Letters, digits and single underscores; never empty, never starting with a digit."""
    words = [word for word in re.split(r"[^0-9A-Za-z]+", str(name)) if word]
    clean = "_".join(words) or "feature"
    return f"f_{clean}" if clean[0].isdigit() else clean


def unique_names(names: Iterable[str]) -> list[str]:
    """Repeated names get ``_1``, ``_2``...; a number already taken by another column is skipped."""
    names = list(names)
    taken, result = set(names), []
    used: set[str] = set()
    for name in names:
        pick, number = name, 0
        while pick in used or (number and pick in taken):
            number += 1
            pick = f"{name}_{number}"
        used.add(pick)
        result.append(pick)
    return result


def feature_names(names: Iterable[object]) -> list[str]:
    """Clean, unique names in the order given."""
    return unique_names([feature_name(name) for name in names])
