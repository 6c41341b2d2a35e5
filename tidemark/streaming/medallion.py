"""Staging -> Bronze -> Silver as chained Structured Streaming queries.

* staging: file source appended to parquet, by ``sources.files.stream_files`` or, where
           files differ in their columns, in batches of files (``ingest_batches``);
* bronze:  append-only pass-through of staging + ``_bronze_ingested_at``;
* silver:  one ``foreachBatch`` per micro-batch that tags data-quality
           failures once, appends failing raw rows to the quarantine table,
           projects / renames / normalises the passing rows and folds them
           into the SCD1/2 table (``streaming.scd_stream.ScdSink``).

Every query uses ``Trigger.AvailableNow`` and its own checkpoint, so a chain
run processes what has arrived and stops; rerunning continues where it left
off. Timestamps default to ``current_timestamp`` and may be pinned to a run
stamp for reproducible output.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import normalize_identifier
from tidemark.operators import project as proj
from tidemark.operators import quality, scd
from tidemark.session import RunStamp
from tidemark.sources import files, properties, tables
from tidemark.streaming.change_capture import COMMIT_SCHEMA, ChangeStore
from tidemark.streaming.scd_stream import ScdSink


def _now(at: Column | None) -> Column:
    return at if at is not None else F.current_timestamp().cast("timestamp_ntz")


def write_stream(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()):
    """Append a streaming DataFrame to parquet until available input is consumed."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(path)
    q.awaitTermination()
    return q


def ingest_staging(spark: SparkSession, src: files.FileSource, target: str, checkpoint: str,
                   schema=None, ingested_at: Column | None = None):
    """Ingest the source's new files. Without a given ``schema`` the one stored beside the checkpoint is
    kept; it is inferred from all files at the first start only, and later the source's evolution mode
    decides what the columns of new files do to it. Sources with ``allow_overwrites`` go through
    ``ingest_listed``, files that are read by name or may widen the schema through ``ingest_batches``."""
    if src.allow_overwrites:
        done = ingest_listed(spark, src, target, f"{checkpoint.rstrip('/')}_ledger", schema, ingested_at,
                             checkpoint if schema is None else None)
    else:
        if src.include_existing_files is False:
            skip_existing(spark, src, target, checkpoint, schema, ingested_at)
        if in_batches(src, schema):
            done = ingest_batches(spark, src, target, checkpoint, schema, ingested_at)
        else:
            if schema is None:
                schema = stored_schema(spark, src, checkpoint)
            done = write_stream(files.stream_files(spark, src, schema, _now(ingested_at)), target, checkpoint)
    tables.describe(spark, target, src.about)
    return done


def in_batches(src: files.FileSource, schema) -> bool:
    """Whether the columns of new files must be looked at before they are read."""
    evolving = schema is None and src.schema_evolution_mode in ("addNewColumns", "failOnNewColumns")
    return files.by_name(src) or (evolving and src.file_format not in ("text", "binaryfile"))


def ingest_batches(spark: SparkSession, src: files.FileSource, target: str, checkpoint: str, schema=None,
                   ingested_at: Column | None = None):
    """Ingest new files in batches of at most ``BATCH_FILES`` (or the source's own number).

    The stream is one of paths. Each batch looks at the columns of its own files alone, lets the evolution
    mode act on them, and writes its rows to its ``_listing`` partition, so a repeated batch replaces itself.
    """
    refused: list[ValueError] = []

    def take(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.toLocalIterator()]
        if not paths:
            return
        try:
            stored = schema if schema is not None else stored_schema(spark, src, checkpoint, paths)
        except ValueError as new_columns:
            refused.append(new_columns)
            raise
        rows = files.read_files(spark, src, paths, stored, _now(ingested_at))
        rows = rows.select("*", F.lit(int(batch_id)).cast("long").alias(LISTING_COL))
        tables.overwrite_partitions(rows, target, [LISTING_COL])

    try:
        return _drain(files.stream_listing(spark, src), take, checkpoint)
    except Exception:
        if refused:
            raise refused[0]
        raise


def _drain(stream: DataFrame, take, checkpoint: str):
    """Run ``take`` over the batches of what has arrived."""
    q = (stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def skip_existing(spark: SparkSession, src: files.FileSource, target: str, checkpoint: str, schema=None,
                  ingested_at: Column | None = None) -> None:
    """On a source's first start, take the files already there into one batch without rows.

    The checkpoint then knows them, so the stream goes on with later files. A start that broke off before
    that batch was committed is repeated.
    """
    marker = f"{checkpoint.rstrip('/')}_start"
    if tables.read_properties(spark, marker) is not None:
        return
    if not tables.exists(spark, f"{checkpoint.rstrip('/')}/commits"):
        whole = replace(src, max_files_per_trigger=None)
        if in_batches(src, schema):
            _drain(files.stream_listing(spark, whole), lambda batch, batch_id: None, checkpoint)
        else:
            schema = schema if schema is not None else stored_schema(spark, src, checkpoint)
            rows = files.stream_files(spark, whole, schema, _now(ingested_at))
            write_stream(rows.where(F.lit(False)), target, checkpoint)
    tables.write_properties(spark, marker, {"existing_files": "skipped"})


def ingest_listed(spark: SparkSession, src: files.FileSource, target: str, ledger: str, schema=None,
                  ingested_at: Column | None = None, checkpoint: str | None = None) -> int:
    """Batch ingestion against a ledger of (path, modification time); returns the number of files taken.

    A file rewritten in place is taken again. Each listing writes its rows to its own ``_listing`` partition
    of ``target`` and its files to the ledger last, so a run that broke off is replaced by the next one.
    As in any Spark read, the paths of the files to read (not their rows) pass through the driver.
    Without ``schema`` the one stored beside ``checkpoint`` is used and evolves with the new files.
    """
    held = tables.read(spark, ledger)
    last = None if held is None else held.agg(F.max(LISTING_COL).alias("last")).first()["last"]
    listing = 0 if last is None else int(last) + 1
    at = F.lit(listing).cast("long").alias(LISTING_COL)
    if held is None and src.include_existing_files is False:
        taken, paths = files.list_files(spark, src), []
    else:
        # Written down, so that the rows read and the ledger follow one and the same listing.
        tables.write_view(files.discover_files(spark, src, held), f"{ledger}_found")
        taken = spark.read.parquet(f"{ledger}_found")
        paths = [r["path"] for r in taken.select("path").toLocalIterator()]
        if not paths:
            return 0
        if schema is None:
            schema = stored_schema(spark, src, checkpoint, paths)
        rows = files.read_files(spark, src, paths, schema, _now(ingested_at))
        tables.overwrite_partitions(rows.select("*", at), target, [LISTING_COL])
    tables.overwrite_partitions(taken.select("*", at), ledger, [LISTING_COL])
    return len(paths)


def stored_schema(spark: SparkSession, src: files.FileSource, checkpoint: str,
                  paths: Sequence[str] | None = None) -> T.StructType:
    """The schema kept beside the checkpoint, widened by the files at ``paths`` where the mode says so.

    Files are opened for it only where their columns matter: all (or those at ``paths``) at the first
    start, then those at ``paths`` in the modes that look for new columns, and none in the others.
    """
    folder = f"{checkpoint.rstrip('/')}_schema"
    held = tables.read_properties(spark, folder)
    if held is None:
        schema = files.resolve_schema(spark, src, paths)
        tables.write_properties(spark, folder, {"schema": schema.json()})
        return schema
    known = T.StructType.fromJson(json.loads(held["schema"]))
    if paths is None or src.schema_evolution_mode in ("rescue", "none"):
        return known
    schema = files.evolve_schema(known, files.resolve_schema(spark, src, paths), src.schema_evolution_mode)
    if schema != known:
        tables.write_properties(spark, folder, {"schema": schema.json()})
    return schema


def bronze_stream(spark: SparkSession, staging_path: str, ingested_at: Column | None = None) -> DataFrame:
    return _table_stream(spark, staging_path).withColumn("_bronze_ingested_at", _now(ingested_at))


def _table_stream(spark: SparkSession, path: str) -> DataFrame:
    """Stream of a table's rows, without the column that only keeps batches apart."""
    return spark.readStream.schema(tables.merged_schema(spark, path)).parquet(path).drop(LISTING_COL)


def ingest_bronze(spark: SparkSession, staging: str | ChangeStore, bronze_path: str, checkpoint: str,
                  ingested_at: Column | None = None, about: tuple[str, dict] | None = None):
    """Bronze of a staging folder, or of a change store's committed runs (``ingest_runs``).

    ``about``: the table's comment and properties (``sources.properties.bronze``)."""
    if isinstance(staging, ChangeStore):
        done = ingest_runs(spark, staging, bronze_path, checkpoint, ingested_at)
    else:
        done = write_stream(bronze_stream(spark, staging, ingested_at), bronze_path, checkpoint)
    tables.describe(spark, bronze_path, about)
    return done


def ingest_runs(spark: SparkSession, store: ChangeStore, bronze_path: str, checkpoint: str,
                ingested_at: Column | None = None):
    """Append a change store's events to Bronze, each exactly once and only when its run has committed.

    The stream follows the store's manifest and reads the files that new commits name, so files of a run
    that broke off, or is still being written, are never seen. A batch writes its own ``_listing``
    partition and a repeated batch replaces it.
    """
    if store.commits() is None:
        return None

    def take(batch: DataFrame, batch_id: int) -> None:
        entries = batch.collect()  # one row for each commit
        if entries:
            rows = store.read_commits(entries).withColumn("_bronze_ingested_at", _now(ingested_at))
            tables.overwrite_partitions(rows.withColumn(LISTING_COL, F.lit(int(batch_id)).cast("long")), bronze_path, [LISTING_COL])

    return _drain(spark.readStream.schema(COMMIT_SCHEMA).json(store.manifest_path), take, checkpoint)


LISTING_COL = "_listing"


@dataclass
class SilverSpec:
    source_table: str
    keys: Sequence[str]
    history_timestamp_source: str = "pipeline_timestamp"
    silver_columns: Sequence = ()
    allow_missing_columns: bool = False
    exclude_columns: Sequence[str] = ()
    data_quality_rules: Sequence = ()
    scd_type: int = 2
    scd_2_exclude_list: Sequence[str] = ()
    cluster_by: Sequence[str] = ()
    buckets: int = 64
    tags: Mapping[str, str] = field(default_factory=dict)
    description: str | None = None

    def __post_init__(self):
        if not self.source_table:
            raise ValueError("source_table is required")
        if not self.keys:
            raise ValueError("scd_2_key_list is required")
        if self.scd_type not in (1, 2):
            raise ValueError("scd_type must be 1 or 2")
        names = [c["name"] if isinstance(c, Mapping) else c for c in self.silver_columns]
        users = [(c.get("rename") or c["name"]) if isinstance(c, Mapping) else c for c in self.silver_columns]
        hts = self.history_timestamp_source
        if names and hts != "pipeline_timestamp" and hts not in names and hts not in users:
            raise ValueError("history_timestamp_source must be one of silver_columns[].name")
        if any(not isinstance(c, str) or not c for c in self.scd_2_exclude_list):
            raise ValueError("scd_2_exclude_list must hold non-empty strings")

    @classmethod
    def from_config(cls, src: dict, buckets: int = 64) -> "SilverSpec":
        """From a source dict with the reference's Silver keys."""
        for c in src.get("silver_columns") or []:
            if not c.get("name"):
                raise ValueError("every silver_columns entry needs a 'name'")
        for r in src.get("data_quality_rules") or []:
            if not r.get("description") or not r.get("expr"):
                raise ValueError("data_quality_rules entries need description and expr")
        if (src.get("federated_source") or {}).get("window_column"):
            check_rolling_history(src)
        scd_type = src.get("scd_type", 2)
        if scd_type not in (1, 2):
            raise ValueError("scd_type must be 1 or 2")
        return cls(
            source_table=src.get("source_table"), keys=tuple(src.get("scd_2_key_list") or ()),
            history_timestamp_source=src.get("history_timestamp_source") or "pipeline_timestamp",
            silver_columns=tuple(src.get("silver_columns") or ()),
            allow_missing_columns=bool(src.get("allow_missing_columns", False)),
            exclude_columns=tuple(src.get("exclude_columns") or ()),
            data_quality_rules=tuple((r["description"], r["expr"]) for r in src.get("data_quality_rules") or ()),
            scd_type=scd_type, scd_2_exclude_list=tuple(src.get("scd_2_exclude_list") or ()),
            cluster_by=tuple(src.get("cluster_by") or ()), buckets=buckets, tags=dict(src.get("tags") or {}),
            description=src.get("description"),
        )

    def settings(self) -> dict:
        """What comments and properties are made of."""
        return {"source_table": self.source_table, "scd_type": self.scd_type, "tags": self.tags, "description": self.description}

    @property
    def silver_table(self) -> str:
        return normalize_identifier(self.source_table)


def check_rolling_history(src: Mapping) -> None:
    """A rolling source's history: keyed by its row identity, in snapshot order, run stamps untracked."""
    problems = []
    if list(src.get("scd_2_key_list") or ()) != ["rowkey"]:
        problems.append("scd_2_key_list must be [rowkey], rolling rows have no other key")
    if src.get("history_timestamp_source") not in scd.SNAPSHOT_SEQUENCES:
        problems.append(f"history_timestamp_source must be one of {', '.join(scd.SNAPSHOT_SEQUENCES)}: "
                        "arrival time does not order snapshots")
    tracked = [c for c in scd.CHANGE_STREAM_UNTRACKED if c not in (src.get("scd_2_exclude_list") or ())]
    if tracked:
        problems.append(f"scd_2_exclude_list lacks {', '.join(tracked)}: they differ in every run, "
                        "so each run would open a version of every row")
    if problems:
        raise ValueError(f"{src.get('source_table')}: {'; '.join(problems)}")


def silver_frame(df: DataFrame, spec: SilverSpec, processed_at: Column | None = None):
    """Projected, renamed and normalised rows ready for SCD (+ the Projection)."""
    p = proj.project(df, spec.silver_columns, spec.allow_missing_columns, spec.exclude_columns)
    out = p.df
    if spec.history_timestamp_source == "pipeline_timestamp":
        out = out.withColumn("_silver_processed_at", _now(processed_at))
    return out, p


def scd_settings(columns: Sequence[str], spec: SilverSpec, p: proj.Projection) -> dict:
    keys = [p.resolve(k) for k in spec.keys]
    if spec.history_timestamp_source == "pipeline_timestamp":
        seq, except_cols = "_silver_processed_at", ["_silver_processed_at"]
    else:
        seq, except_cols = p.resolve(spec.history_timestamp_source), []
    excl = [p.resolve(c) for c in spec.scd_2_exclude_list]
    if spec.silver_columns:
        track = [c for c in columns if c not in set(excl) | set(keys) | {seq}]
        kw = {"track": track}
    else:
        kw = {"except_track": excl}
    return dict(keys=keys, seq=seq, except_columns=except_cols, **kw)


class SilverSink:
    """foreachBatch target: quarantine + SCD fold from one DQ evaluation."""

    def __init__(self, spark: SparkSession, spec: SilverSpec, silver_path: str, quarantine_path: str,
                 log_path: str, run: RunStamp | None = None):
        self.spark, self.spec, self.run = spark, spec, run
        self.silver_path, self.quarantine_path, self.log_path = silver_path, quarantine_path, log_path
        self._scd: ScdSink | None = None

    def _at(self) -> Column | None:
        return self.run.ts_col() if self.run else None

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spec = self.spec
        aliases = None
        if spec.silver_columns:
            aliases = proj.project(batch, spec.silver_columns, spec.allow_missing_columns,
                                   normalize=False).aliases()
        tagged = quality.tag(batch, spec.data_quality_rules, aliases).persist()
        try:
            if spec.data_quality_rules:
                failed = (tagged.where(F.size(quality.FAILED) > 0)
                          .withColumn("_quarantine_timestamp", _now(self._at()))
                          .withColumn("_source_table", F.lit(spec.source_table))
                          .withColumn(BATCH_COL, F.lit(int(batch_id)).cast("long")))
                tables.overwrite_partitions(failed, self.quarantine_path, [BATCH_COL])
                tables.describe(self.spark, self.quarantine_path, properties.quarantine(spec.settings()))
            passed = tagged.where(F.size(quality.FAILED) == 0).drop(quality.FAILED)
            rows, p = silver_frame(passed, spec, self._at())
            if self._scd is None:
                s = scd_settings(rows.columns, spec, p)
                self._scd = ScdSink(self.spark, self.log_path, self.silver_path, s["keys"], s["seq"],
                                    spec.scd_type, s.get("track"), s.get("except_track", ()),
                                    s["except_columns"], buckets=spec.buckets,
                                    cluster_by=[p.resolve(c) for c in spec.cluster_by])
            self._scd.process(rows, batch_id)
            tables.describe(self.spark, self.silver_path, properties.silver(spec.settings()))
        finally:
            tagged.unpersist()


BATCH_COL = "batch"


def silver_view(spark: SparkSession, bronze_path: str, spec: SilverSpec, name: str | None = None) -> DataFrame:
    """The gated, projected Silver stream as a session temp view (not persisted)."""
    stream = _table_stream(spark, bronze_path)
    aliases = None
    if spec.silver_columns:
        aliases = proj.project(stream, spec.silver_columns, spec.allow_missing_columns, normalize=False).aliases()
    gated = quality.gate(stream, spec.data_quality_rules, aliases)
    rows, _ = silver_frame(gated, spec)
    rows.createOrReplaceTempView(name or f"{spec.source_table}_silver_stream")
    return rows


def run_silver(spark: SparkSession, bronze_path: str, sink: SilverSink, checkpoint: str):
    stream = _table_stream(spark, bronze_path)
    q = (stream.writeStream.foreachBatch(sink.process).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def live_rows(spark: SparkSession, silver_path: str) -> DataFrame:
    from tidemark.streaming.scd_stream import read_target
    return scd.live_rows(read_target(spark, silver_path))
