"""Identifier rules for Silver tables and columns."""

from __future__ import annotations

import re
from collections.abc import Iterable

_NON_ALNUM = re.compile(r"[^a-zA-Z0-9]")


def normalize_identifier(name: str) -> str:
    """Strip every character outside [a-zA-Z0-9] (underscores too): ``payment_id`` -> ``paymentid``."""
    return _NON_ALNUM.sub("", name)


def normalized_mapping(names: Iterable[str], skip_underscore: bool = False) -> dict[str, str]:
    """Old -> new name for every column whose normalised form differs.

    Raises on collisions (two columns normalising to one name, or a normalised
    name equal to another untouched column), which would otherwise silently
    shadow data.
    """
    names = list(names)
    final: dict[str, str] = {}
    for n in names:
        final[n] = n if (skip_underscore and n.startswith("_")) else normalize_identifier(n)
    seen: dict[str, str] = {}
    for old, new in final.items():
        if not new:
            raise ValueError(f"column {old!r} normalises to an empty name")
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {old!r} both normalise to {new!r}")
        seen[new] = old
    return {o: n for o, n in final.items() if o != n}
