"""Silver projection: rename, select, tolerate missing, drop, normalise names.

Two modes, as in the reference:

* explicit ``silver_columns`` (list of ``{"name": bronze, "rename": user}``):
  rename, select in the listed order, then normalise every user name;
* SELECT * (``silver_columns`` empty): keep all columns and normalise every
  name that does not start with ``_`` (audit columns keep their names).

Normalised names contain only [a-zA-Z0-9]. A collision (``a_b`` and ``ab``)
raises instead of silently shadowing a column. ``Projection.resolve`` maps a
Bronze or user-facing name to its final Silver name, resolved against the
actual output columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import normalized_mapping


def _entries(silver_columns) -> list[tuple[str, str]]:
    out = []
    for c in silver_columns or []:
        if isinstance(c, str):
            out.append((c, c))
            continue
        if not c.get("name"):
            raise ValueError("every silver_columns entry needs a 'name'")
        out.append((c["name"], c.get("rename") or c["name"]))
    return out


@dataclass
class Projection:
    df: DataFrame
    bronze_to_user: dict[str, str]
    user_to_final: dict[str, str]

    def resolve(self, name: str) -> str:
        user = self.bronze_to_user.get(name, name)
        final = self.user_to_final.get(user, user)
        if final not in self.df.columns:
            raise ValueError(f"{name!r} does not resolve to a Silver column (got {final!r})")
        return final

    def aliases(self) -> dict[str, str]:
        """user-facing name -> bronze name, for rules written against user names."""
        return {u: b for b, u in self.bronze_to_user.items() if u != b}


def project(df: DataFrame, silver_columns: Sequence | None = None, allow_missing: bool = False,
            exclude_columns: Sequence[str] = (), normalize: bool = True) -> Projection:
    entries = _entries(silver_columns)
    bronze_to_user = {b: u for b, u in entries}
    if entries:
        exprs = []
        for bronze, user in entries:
            if bronze in df.columns:
                exprs.append(F.col(f"`{bronze}`").alias(user))
            elif allow_missing:
                exprs.append(F.lit(None).cast("string").alias(user))
            else:
                raise ValueError(f"silver column {bronze!r} not in source (set allow_missing_columns)")
        df = df.select(*exprs)
    drop = [c for c in exclude_columns if c in df.columns]
    if drop:
        df = df.drop(*drop)
    renames: Mapping[str, str] = {}
    if normalize:
        renames = normalized_mapping(df.columns, skip_underscore=not entries)
        if renames:
            df = df.withColumnsRenamed(dict(renames))
    return Projection(df, bronze_to_user, dict(renames))
