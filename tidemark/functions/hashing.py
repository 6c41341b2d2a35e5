"""Row fingerprints.

A fingerprint is SHA-256 over the string forms of the chosen columns, taken in
name order so a physical column reorder at the source does not change it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must stay identical to keep fingerprints stable across
# runs and engines: the null marker and the separator between column values.
NULL_SENTINEL = "<<NULL>>"
HASH_SEP = "||"


def row_hash(columns: Iterable[str]) -> Column:
    """``sha2(concat_ws('||', coalesce(cast(c as string), '<<NULL>>') for c in sorted(cols)), 256)``.

    Null and empty string hash differently; the separator may collide for values
    that contain it (('a', 'b||c') == ('a||b', 'c')), which is accepted.
    """
    cols = sorted(columns)
    if not cols:
        raise ValueError("row_hash needs at least one column")
    # One SQL expression (one driver->JVM call however many columns there are).
    parts = ", ".join(f"coalesce(cast({quote(c)} as string), {sql_string(NULL_SENTINEL)})" for c in cols)
    return F.expr(f"sha2(concat_ws({sql_string(HASH_SEP)}, {parts}), 256)")


def select_names(df, names):
    """``df.select`` of plain column names in one driver->JVM call."""
    return df.selectExpr(*[quote(n) for n in names])


def quote(name: str) -> str:
    """Backtick-quoted identifier for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    """Single-quoted SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
