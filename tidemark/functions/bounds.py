"""Inclusive lower-bound predicates compared in the column's own type.

Comparing ``cast(col as timestamp) >= literal`` blocks parquet pushdown for
string or date columns; comparing in the native type keeps the predicate a
plain ``GreaterThanOrEqual`` on the scan.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ts_literal


def at_or_after(df: DataFrame, column: str, since: datetime) -> Column:
    """``column >= since`` (naive UTC ``since``), typed to the column."""
    dtype = df.schema[column].dataType
    c = F.col(f"`{column}`")
    if isinstance(dtype, T.TimestampNTZType):
        return c >= ts_literal(since)
    if isinstance(dtype, T.TimestampType):
        # Session time zone is UTC, so the wall-clock literal is the instant.
        return c >= ts_literal(since).cast("timestamp")
    if isinstance(dtype, T.DateType):
        # A date d qualifies iff midnight(d) >= since  <=>  d >= ceil_day(since).
        day = since.date() if since == datetime.combine(since.date(), datetime.min.time()) \
            else since.date() + timedelta(days=1)
        return c >= F.lit(day.isoformat()).cast("date")
    return c.cast("timestamp_ntz") >= ts_literal(since)
