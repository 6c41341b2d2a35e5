"""Batch loads of a table source: full, or incremental above a high-water mark.

The high-water mark is ``MAX(watermark)`` over the **append-only public
table** (everything loaded so far), not over the last delta: after an empty
delta the mark must not reset to null and trigger a full reload. The mark
travels to the driver as Spark's own string form of the value and is cast
back to the column type inside the plan, so timestamps, dates and numbers
round-trip exactly without Python time-zone conversion.

Order of operations: watermark filter -> user predicate -> projection (the
watermark column always survives the projection, also when ``select`` omits
it). The strict ``>`` means rows arriving later with a value equal to the
mark are not loaded, and rows with a null watermark load only on the first
run; ``null_watermarks`` reports how many there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rolling import with_null_provenance
from tidemark.session import RunStamp

# Column that materialises a watermark expression so the next run can read it back.
WATERMARK_COLUMN = "_federated_watermark"


def pin_columns(df: DataFrame, select: Sequence[str] | None, keep: str | None = None) -> DataFrame:
    if not select:
        return df
    cols = list(select)
    if keep and keep not in cols:
        cols.append(keep)
    return df.select(*[F.col(f"`{c}`") for c in cols])


def full_load(df: DataFrame, run: RunStamp, where: str | None = None,
              select: Sequence[str] | None = None) -> DataFrame:
    """Whole source every run (repeats every row on every run)."""
    if where:
        df = df.where(where)
    return with_null_provenance(pin_columns(df, select), run)


def watermark_column(column: str | None, expression: str | None) -> str:
    if bool(column) == bool(expression):
        raise ValueError("incremental load needs exactly one of watermark_column / watermark_expression")
    return column or WATERMARK_COLUMN


def incremental_load(df: DataFrame, run: RunStamp, last: str | None = None, column: str | None = None,
                     expression: str | None = None, where: str | None = None,
                     select: Sequence[str] | None = None) -> DataFrame:
    """Rows strictly above ``last`` (None = first run, everything)."""
    wm = watermark_column(column, expression)
    if expression:
        df = df.withColumn(WATERMARK_COLUMN, F.expr(expression))
    elif wm not in df.columns:
        raise ValueError(f"watermark column {wm!r} not in source")
    if last is not None:
        dtype = df.schema[wm].dataType
        df = df.where(F.col(f"`{wm}`") > F.lit(str(last)).cast(dtype))
    if where:
        df = df.where(where)
    return with_null_provenance(pin_columns(df, select, keep=wm), run)


def last_watermark(public: DataFrame | None, column: str) -> str | None:
    """``MAX(column)`` of everything loaded so far, as Spark's string form (None if empty)."""
    if public is None or column not in public.columns:
        return None
    row = public.agg(F.max(F.col(f"`{column}`")).cast("string").alias("m")).first()
    return None if row is None else row["m"]


def null_watermarks(df: DataFrame, column: str | None = None, expression: str | None = None) -> int:
    """Rows whose watermark is null (they never load after the first run)."""
    c = F.expr(expression) if expression else F.col(f"`{column}`")
    return int(df.agg(F.count_if(c.isNull()).alias("n")).first()["n"])


RUN_COLUMN = "_run"


def run_load(spark, source: DataFrame, public_path: str, run: RunStamp, mode: str = "full",
             column: str | None = None, expression: str | None = None, where: str | None = None,
             select: Sequence[str] | None = None) -> dict:
    """One persisted load into the append-only public table.

    Each run writes its own ``_run`` partition (dynamic overwrite: a retried
    run replaces itself). Incremental mode reads the mark from the public
    table, so an empty delta never resets it. Returns ``{"rows", "mark"}``;
    the row count rides along with the write (``observe``), no extra job.
    """
    from pyspark.sql import Observation

    from tidemark.sources import tables

    mode = mode.lower()
    if mode not in ("full", "incremental"):
        raise ValueError("load_mode must be 'full' or 'incremental'")
    public = tables.read(spark, public_path)
    if public is not None:
        public = public.where(F.col(RUN_COLUMN) < run.seq)        # replay-safe: ignore this run's rows
    mark = None
    if mode == "full":
        out = full_load(source, run, where, select)
    else:
        wm = watermark_column(column, expression)
        mark = last_watermark(public, wm)
        out = incremental_load(source, run, mark, column, expression, where, select)
    obs = Observation("load")
    out = out.withColumn(RUN_COLUMN, run.seq_col()).observe(obs, F.count(F.lit(1)).alias("rows"))
    tables.overwrite_partitions(out, public_path, [RUN_COLUMN])
    return {"rows": int(obs.get["rows"]), "mark": mark}
