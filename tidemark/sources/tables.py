"""Table sinks: append, full overwrite, partition-atomic run appends, metadata.

All sinks are path-based parquet (no Delta / MERGE needed). A "run" append
replaces exactly the partitions the run produces (dynamic partition
overwrite), so retrying a run leaves one copy of its rows.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a table: a folder with at least one visible entry
    (data file or partition folder). Works for any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return False
    # Spark's own rule: "_x" and ".x" are hidden, "_x=v" is a partition folder.
    def visible(name: str) -> bool:
        return not name.startswith(".") and (not name.startswith("_") or "=" in name)
    return any(visible(s.getPath().getName()) for s in fs.listStatus(p))


def read(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if exists(spark, path) else None


def merged_schema(spark: SparkSession, path: str):
    """Columns of all files of a path: later files may be wider than the first."""
    return spark.read.option("mergeSchema", "true").parquet(path).schema


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the data files right inside a folder (none where there is no such folder)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(where) if s.isFile())
    return sorted(n for n in names if not n.startswith(("_", ".")))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right inside a folder (none where there is no such folder)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()) if fs.exists(where) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes under a path; 0 where there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(where).getLength()) if fs.exists(where) else 0


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole under its name, or raises where the name is taken."""
    new = spark._jvm.org.apache.hadoop.fs.Path
    target = new(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    made = new(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(made, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(target) or not fs.rename(made, target):
        fs.delete(made, False)
        raise FileExistsError(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_view(df: DataFrame, path: str) -> None:
    """Materialized view: full overwrite. ``path`` must not be read by ``df``
    (write a new version folder and switch readers to it instead)."""
    df.write.mode("overwrite").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                         sort_by: Sequence[str] = ()) -> None:
    """Replace only the partitions present in ``df`` (idempotent per partition).

    ``sort_by`` clusters rows inside each file (e.g. rowkey for key lookups).
    """
    out = df.sortWithinPartitions(*partition_by, *sort_by) if sort_by else df
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path))


def write_clustered(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Replace ``path``; with ``by``, its files are ranges of these columns and their bounds are kept beside it."""
    if not by:
        write_view(df, path)
        return
    cols = [F.col(f"`{c}`") for c in by]
    write_view(df.repartitionByRange(*cols).sortWithinPartitions(*cols), path)
    spark = df.sparkSession
    bounds = [f(F.col(f"`{c}`")).alias(f"{c}.{k}") for c in by for k, f in (("min", F.min), ("max", F.max))]
    write_view(spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(*bounds), f"{path}.ranges")


def read_clustered(spark: SparkSession, path: str, where: tuple) -> DataFrame | None:
    """The files of a clustered path whose bounds meet ``where = (column, low, high)``; all if it is not laid out by it."""
    whole, ranges = read(spark, path), read(spark, f"{path}.ranges")
    column, low, high = where
    if whole is None or ranges is None or f"{column}.min" not in ranges.columns:
        return whole
    hit = ranges.where((F.col(f"`{column}.max`") >= low) & (F.col(f"`{column}.min`") <= high))
    files = sorted(r["file"] for r in hit.select("file").collect())
    return spark.read.schema(whole.schema).parquet(*files) if files else whole.limit(0)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int,
                   partition_by: Sequence[str] = ()) -> DataFrame:
    """Catalog table bucketed (and sorted) by ``key`` at ``path``.

    Two tables bucketed on the same key with the same bucket count join on it
    without a shuffle (sort-merge join straight off the buckets), e.g. the
    Control-1 anti join between consecutive snapshots on ``rowkey``. Needs a
    catalog that keeps the bucket spec (a persistent metastore on a cluster).
    """
    w = df.write.mode("overwrite").bucketBy(int(buckets), key).sortBy(key).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)
    return df.sparkSession.table(table)


def register_table(spark: SparkSession, name: str, path: str, properties: Mapping[str, str] | None = None,
                   comment: str | None = None) -> None:
    """Expose a path as a catalog table and attach its properties / comment."""
    from tidemark.functions.hashing import sql_string

    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION {sql_string(path)}")
    props = dict(properties or {})
    if comment:
        props["comment"] = comment
    if props:
        body = ", ".join(f"{sql_string(str(k))} = {sql_string(str(v))}" for k, v in props.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({body})")


def describe(spark: SparkSession, path: str, about: tuple[str, Mapping[str, str]] | None) -> None:
    """Keep a table's (comment, properties) beside its data; None leaves what is there."""
    if about is not None:
        comment, properties = about
        write_properties(spark, path, {"comment": comment, **properties}, TABLE_FILE)


def description(spark: SparkSession, path: str) -> dict | None:
    """The comment and properties that a sink left at ``path``."""
    return read_properties(spark, path, TABLE_FILE)


TABLE_FILE = "_table.json"


def write_properties(spark: SparkSession, path: str, properties: Mapping[str, str], name: str = "_properties.json") -> None:
    """Sidecar file for path-only tables (written through Hadoop FS)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(os.path.join(path, name))
    fs = target.getFileSystem(conf)
    out = fs.create(target, True)
    out.write(bytearray(json.dumps(dict(properties), sort_keys=True).encode()))
    out.close()


def read_properties(spark: SparkSession, path: str, name: str = "_properties.json") -> dict | None:
    """The sidecar that ``write_properties`` left at ``path``, or None."""
    target = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, name))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
