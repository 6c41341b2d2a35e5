"""Helpers shared by the training-data operators.

Every operator nests the caller's row in one struct column (``ROW``) before it
adds columns of its own, so input columns may carry any name without clashing
with working columns; output columns replace input columns of the same name.
"""

from __future__ import annotations

import atexit
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

ROW = "_tm_row"
#: A run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there.

    The folder is the session's ``spark.checkpoint.dir``. The files stay while results
    may read them: until ``release``, or else until the Python session ends.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        scratch_dir(df.sparkSession)  # registers spark.checkpoint.dir
    done = df.checkpoint(eager=True)
    files = done._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if files.isDefined():
        if not _CUTS:
            atexit.register(release, df.sparkSession)
        _CUTS.append(files.get())
    return done


def cuts() -> int:
    """Number of cuts that are held, to ``release`` later ones only."""
    return len(_CUTS)


def release(spark: SparkSession, since: int = 0) -> None:
    """Remove the files of all cuts after the first ``since``; frames that read them can no longer be used."""
    held, _CUTS[since:] = _CUTS[since:], []
    for folder in held:
        try:
            drop_folder(spark, folder)
        except Exception:  # the session has ended before
            return


_CUTS: list[str] = []


def nest(df: DataFrame, columns: Iterable[str], **named: Column) -> DataFrame:
    """The columns to keep as one struct ``ROW`` beside the named working columns."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias(ROW),
                     *[c.alias(n) for n, c in named.items()])


def unnest(df: DataFrame, columns: Iterable[str], **named: Column) -> DataFrame:
    """The caller's columns again, except those that ``named`` replaces."""
    return df.select(*[F.col(f"{ROW}.`{c}`") for c in columns if c not in named],
                     *[c.alias(n) for n, c in named.items()])


def word_count(text: Column) -> Column:
    """Words of the whole text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_slice(id_col: Column, parts: int, left_out: int) -> Column:
    """True where crc32(id as text) mod ``parts`` is ``left_out``; a null id is never left out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % parts == left_out, F.lit(False))


def bucket_count(rows: int, rows_per_bucket: int = 256, most: int = 65_536) -> int:
    """Key ranges to split ``rows`` hash-keyed rows into.

    Small enough that a range is one light task even for a source that holds
    a third of the rows, and never more than ``most``, which bounds the table
    of ranges that prefix sums run over.
    """
    return max(1, min(most, -(-rows // rows_per_bucket)))


def key_range(key_hex: Column, buckets: int) -> Column:
    """Number of the equal-width range of 32-bit key prefixes that holds ``key_hex``."""
    head = F.conv(F.substring(key_hex, 1, 8), 16, 10).cast("long")
    return F.shiftright(head * buckets, 32).cast("int")


def running(rows: DataFrame, part: list[str], order: list[str], value: Column, totals: DataFrame,
            narrow: DataFrame, most_equal: int = 10_000) -> DataFrame:
    """Add the columns of ``totals`` (a row per ``part``) and _run, the sum of ``value`` up to each row of its part.

    Rows that agree in ``order`` must agree in ``value`` and are interchangeable.
    If more than ``most_equal`` of them agree, parts no longer bound a window:
    rows are then summed inside (order, input split) and shifted by the total of
    the groups before theirs. The rows are checkpointed for it, so that both
    branches see the same splits. ``narrow`` holds ``part`` and ``order`` of the same
    rows, to count them without reading ``rows``.
    """
    upto = (Window.unboundedPreceding, Window.currentRow)

    def crowded(columns: list[str]) -> bool:
        return bool(narrow.groupBy(*columns).agg(F.count("*").alias("_n")).filter(F.col("_n") > most_equal).take(1))

    if not (crowded(part) and crowded([*part, *order])):
        window = Window.partitionBy(*part).orderBy(*order).rowsBetween(*upto)
        return rows.withColumn("_run", F.sum(value).over(window)).join(totals, part)
    group = [*part, "_equal", "_split"]  # nulls in a struct are equal
    rows = cut(rows).withColumn("_equal", F.struct(*order)).withColumn("_split", F.spark_partition_id())
    before = Window.partitionBy(*part).orderBy("_equal", "_split").rowsBetween(Window.unboundedPreceding, -1)
    groups = (rows.groupBy(*group).agg(F.sum(value).alias("_sum"))
              .select(*group, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
              .join(totals, part))
    inside = Window.partitionBy(*group).orderBy(F.lit(0)).rowsBetween(*upto)
    return (rows.withColumn("_inside", F.sum(value).over(inside)).join(groups, group)
            .withColumn("_run", F.col("_before") + F.col("_inside")))


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder on whatever file system it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
