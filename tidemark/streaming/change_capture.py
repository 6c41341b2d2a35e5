"""One run of the rolling change-capture job, persisted.

Store layout (all under one base path):

* ``stream/``    data files of the change stream, partitioned by ``snapshotseq``,
                 rows clustered by ``rowkey`` inside files;
* ``manifest/``  one JSON file for each commit of a run: its counts, its columns and
                 the names of the files it added;
* ``sweeps/``    sweep audit log (also the cadence state).

The manifest is the truth: the stream is the files that it names, never what a
listing of ``stream/`` shows, and a run without any row is a state of its own. A
commit is one file that appears under its final name at once, so readers (and the
Bronze stream, which follows the manifest) see a run whole or not at all.

A run writes its snapshot once, derives the deletes from the written files (lineage
cut, survives executor loss), adds the tombstones and commits both. The tombstones
of a sweep are a second commit of the same run. Files that a broken attempt left
behind are named by no commit; the run's next attempt removes them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import select_names
from tidemark.operators import reconcile as rc
from tidemark.operators import rolling
from tidemark.session import RunStamp, scratch_dir
from tidemark.sources import tables

#: One commit; ``files`` are relative to the stream folder, ``columns`` is its schema as JSON.
COMMIT_SCHEMA = ("snapshotseq bigint, phase string, upserts bigint, deletes bigint, reconciles bigint, "
                 "files array<string>, columns string")
COUNTS = ("upserts", "deletes", "reconciles")
#: Bytes of files in one bucket up to which readers take the table by its buckets; a bucket is one task, whatever it holds.
BUCKET_BYTES = 32 << 20


@dataclass(frozen=True)
class SweepSpec:
    enabled: bool = False
    cadence_days: int = 7
    weekday: str | None = None
    max_age_days: int | None = None
    max_delete_pct: float = 5.0
    min_source_rows: int = 1
    on_breach: str = "fail"
    force: bool = False


def sweep_from_config(src: dict, force: bool = False) -> SweepSpec:
    """SweepSpec from the reference's ``reconciliation.*`` keys (validated)."""
    rc_cfg = src.get("reconciliation") or {}
    spec = SweepSpec(
        enabled=bool(rc_cfg.get("enabled", False)),
        cadence_days=int(rc_cfg.get("cadence_days", 7)),
        weekday=rc_cfg.get("run_on_weekday"),
        max_age_days=rc_cfg.get("max_age_days"),
        max_delete_pct=float(rc_cfg.get("max_delete_pct", 5.0)),
        min_source_rows=int(rc_cfg.get("min_source_rows", 1)),
        on_breach=str(rc_cfg.get("on_breach", "fail")).lower(),
        force=force,
    )
    days = (src.get("federated_source") or {}).get("rolling_window_days", 7)
    rc.validate(spec.cadence_days, spec.weekday, spec.max_age_days, days, spec.max_delete_pct,
                spec.min_source_rows, spec.on_breach)
    return spec


class ChangeStore:
    """Where a rolling source keeps its change stream, manifest and sweep log.

    By default the stream is plain parquet files. With ``table`` (and ``buckets``)
    it is also a catalog table partitioned by ``snapshotseq`` and bucketed/sorted by
    ``rowkey``: consecutive snapshots then meet in the Control-1 anti join straight
    off their buckets, without a shuffle. Once what is read holds more than
    ``BUCKET_BYTES`` a bucket, the same files are read without their buckets, so that
    a shuffle makes as many tasks as the rows need.
    """

    def __init__(self, spark: SparkSession, base: str, table: str | None = None, buckets: int | None = None):
        if (table is None) != (buckets is None):
            raise ValueError("table and buckets go together")
        self.spark = spark
        self.base = base.rstrip("/")
        self.stream_path = f"{self.base}/stream"
        self.manifest_path = f"{self.base}/manifest"
        self.sweeps_path = f"{self.base}/sweeps"
        self.table, self.buckets = table, buckets

    # ── committed state ───────────────────────────────────────────────────────

    def commits(self) -> DataFrame | None:
        """The manifest: one row for each commit, None before the first."""
        if not tables.exists(self.spark, self.manifest_path):
            return None
        return self.spark.read.schema(COMMIT_SCHEMA).json(self.manifest_path)

    def _entries(self, seq: int | None = None) -> list[Row]:
        found = self.commits()
        if found is None:
            return []
        if seq is not None:
            found = found.where(F.col("snapshotseq") == seq)
        return sorted(found.collect(), key=lambda e: (e.snapshotseq, e.phase))

    def read_commits(self, entries: Iterable[Row]) -> DataFrame:
        """The events of some commits, with the columns that any of them has."""
        entries = list(entries)
        fields: dict[str, T.StructField] = {}
        for e in entries:
            for f in T.StructType.fromJson(json.loads(e.columns)).fields:
                fields.setdefault(f.name, f)
        return self._read([f for e in entries for f in e.files or []], T.StructType(list(fields.values())))

    def _read(self, names: list[str], schema: T.StructType) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.option("basePath", self.stream_path).schema(schema)
                .parquet(*[f"{self.stream_path}/{n}" for n in names]))

    def stream(self, seq: int | None = None) -> DataFrame | None:
        """All committed events, or one run's; None before the first commit."""
        entries = self._entries(seq)
        if not entries:
            return None
        if self.table is None or self._bucket_bytes(seq) > BUCKET_BYTES:
            return self.read_commits(entries)
        self.spark.catalog.refreshTable(self.table)
        runs = sorted({e.snapshotseq for e in entries})
        swept = sorted({e.snapshotseq for e in entries if e.phase != "run"})
        seen = F.col("snapshotseq").isin(runs)
        # A table shows every file of a partition: the tombstones of a sweep that broke off are not committed.
        return self.spark.table(self.table).where(seen & ((F.col("changetype") != "reconcile") | F.col("snapshotseq").isin(swept)))

    def _bucket_bytes(self, seq: int | None) -> float:
        """Bytes of one bucket in the files of a run or of the whole stream."""
        return tables.size(self.spark, self.stream_path if seq is None else f"{self.stream_path}/snapshotseq={seq}") / int(self.buckets)

    def run_tombstones(self, seq: int, changetype: str) -> DataFrame:
        """Rowkeys that one control closed in a committed run."""
        return self.read_commits(self._entries(seq)).where(F.col("changetype") == changetype).select("rowkey")

    def runs(self) -> DataFrame | None:
        """Run ledger: one row for each committed run with its counts over all its commits."""
        found = self.commits()
        if found is None:
            return None
        return found.groupBy("snapshotseq").agg(*[F.sum(c).alias(c) for c in COUNTS])

    def committed(self, run: RunStamp) -> dict | None:
        """The run's counts from the manifest, or None where it is not committed."""
        entries = self._entries(run.seq)
        return {c: sum(int(e[c]) for e in entries) for c in COUNTS} if entries else None

    def prior_seq(self, run: RunStamp):
        """Latest earlier committed run that wrote upserts."""
        runs = self.runs()
        if runs is None:
            return None
        row = (runs.where((F.col("snapshotseq") < run.seq) & (F.col("upserts") > 0))
               .agg(F.max("snapshotseq").alias("p")).first())
        return None if row is None else row["p"]

    def snapshots(self) -> list[int]:
        """Sequences of the committed runs that wrote upserts."""
        runs = self.runs()
        return [] if runs is None else sorted(r["snapshotseq"] for r in runs.where("upserts > 0").collect())

    def sweeps(self) -> DataFrame | None:
        return tables.read(self.spark, self.sweeps_path)

    def swept(self, run: RunStamp) -> str | None:
        """Status of the sweep that the log holds for this run."""
        log = self.sweeps()
        row = None if log is None else log.where(F.col("snapshotseq") == run.seq).first()
        return None if row is None else row["status"]

    # ── writing ───────────────────────────────────────────────────────────────

    def _pending(self, seq: int) -> list[str]:
        """Files of the run that no commit names yet."""
        known = {f for e in self._entries(seq) for f in e.files or []}
        folder = f"snapshotseq={seq}"
        names = (f"{folder}/{n}" for n in tables.file_names(self.spark, f"{self.stream_path}/{folder}"))
        return sorted(n for n in names if n not in known)

    def discard_pending(self, seq: int) -> None:
        """Remove what a broken attempt of the run left behind."""
        for name in self._pending(seq):
            tables.drop_path(self.spark, f"{self.stream_path}/{name}")

    def pending_events(self, seq: int, schema: T.StructType) -> DataFrame:
        """What this attempt has written so far."""
        return self._read(self._pending(seq), schema)

    def write_events(self, df: DataFrame) -> None:
        """Add files to the run's partition; they count once a commit names them."""
        if self.table is None:
            tables.append(df.sortWithinPartitions("rowkey"), self.stream_path, ["snapshotseq"])
            return
        if not self.spark.catalog.tableExists(self.table):
            (df.write.mode("overwrite").partitionBy("snapshotseq").bucketBy(int(self.buckets), "rowkey")
             .sortBy("rowkey").option("path", self.stream_path).saveAsTable(self.table))
        else:
            self.spark.catalog.refreshTable(self.table)
            df.select(*self.spark.table(self.table).columns).write.insertInto(self.table)  # positional
        self.spark.catalog.refreshTable(self.table)

    def commit(self, run: RunStamp, schema: T.StructType, **counts: int) -> None:
        """Name the run's pending files in one manifest file, the first time as ``run``, then as ``sweep-<n>``."""
        done = len(self._entries(run.seq))
        phase = "run" if done == 0 else f"sweep-{done}"
        entry = {"snapshotseq": run.seq, "phase": phase, **{c: int(counts.get(c, 0)) for c in COUNTS},
                 "files": self._pending(run.seq), "columns": schema.json()}
        tables.create_file(self.spark, f"{self.manifest_path}/{run.seq}-{phase}.json", json.dumps(entry) + "\n")


def _widened(events: DataFrame, schema: T.StructType) -> DataFrame:
    """Earlier events with the columns that the source has gained since, as nulls."""
    return events.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in events.columns})


def run_once(spark: SparkSession, source: DataFrame, store: ChangeStore, run: RunStamp,
             spec: rolling.RollingSpec, sweep: SweepSpec = SweepSpec(), silver: DataFrame | None = None,
             source_table: str = "source", about: tuple[str, dict] | None = None) -> dict:
    """Snapshot + Control 1 + (due) Control 2 for one run. Returns a run summary.

    The snapshot goes straight into the run's ``snapshotseq`` partition (written once,
    never copied), the tombstones are added to it, and one commit names both, also
    where there are none. So prior-snapshot lookups see a run whose sweep then fails
    its guards, and an empty window is a snapshot like any other. An attempt first
    removes what an earlier one left uncommitted; a committed run is never written
    again and only catches up on its sweep, whose tombstones are a commit of their
    own and whose audit row is written last. ``about`` is the stream's comment and
    properties (``sources.properties.rolling``), kept beside it.
    """
    rc.validate(sweep.cadence_days, sweep.weekday, sweep.max_age_days, spec.days,
                sweep.max_delete_pct, sweep.min_source_rows, sweep.on_breach)
    stage = scratch_dir(spark, "tidemark-runs", str(run.seq))
    ws = run.window_start(spec.days, spec.anchor)
    counts = store.committed(run)
    stream_before = store.stream()
    prior_seq = store.prior_seq(run)
    last = rc.last_sweep(store.sweeps(), run)
    summary = {"snapshotseq": run.seq, "prior_seq": prior_seq, "window_start": ws}

    def counted(df: DataFrame, name: str):
        obs = Observation(name)
        return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs

    store.discard_pending(run.seq)
    if counts is None:
        # 1. snapshot, written once into its own partition (identity is the expensive part)
        counts = dict.fromkeys(COUNTS, 0)
        snap_df, snap_obs = counted(rolling.snapshot(source, run, spec, f"{stage}/window"), "upserts")
        schema = snap_df.schema
        store.write_events(snap_df)
        snap = store.pending_events(run.seq, schema)
        counts["upserts"] = int(snap_obs.get["rows"])

        # 2. Control 1
        if spec.detect_deletes and prior_seq is not None:
            prior = rolling.prior_snapshot(_widened(store.stream(prior_seq), schema), prior_seq)
            already = rolling.deleted_since(stream_before, prior_seq, run)
            d_df, d_obs = counted(rolling.detect_deletes(snap, prior, run, spec, already), "deletes")
            store.write_events(d_df)
            counts["deletes"] = int(d_obs.get["rows"])

        # Committed before Control 2 is judged: a guard that raises below must not make the next run
        # compare against an older snapshot.
        store.commit(run, schema, **counts)
    schema = T.StructType.fromJson(json.loads(store._entries(run.seq)[0].columns))
    dels = store.run_tombstones(run.seq, "delete") if spec.detect_deletes and prior_seq is not None else None

    # 3. Control 2
    due, trigger = rc.sweep_due(last, run, sweep.enabled, sweep.cadence_days, sweep.weekday, sweep.force)
    summary.update(sweep_due=due, trigger=trigger)
    status = None
    done = store.swept(run)
    if done is not None:
        summary.update(sweep_status=done, sweep_metrics=None)
    elif due:
        status, metrics = "no_target", None
        if silver is not None:
            since = rc.sweep_scope_start(run, sweep.max_age_days)
            open_k = rc.open_keys(silver, rc.silver_column(silver, spec.window_column), since)
            live_k = rc.live_keys(source, run, spec, sweep.max_age_days, f"{stage}/scope")
            obs = Observation("sweep")
            flags = rc.compare(open_k, live_k, dels).observe(obs, *rc.metric_exprs())
            # One job: the join runs once, the counts ride along with the orphan write.
            tables.write_view(flags.where(F.col("_open") & ~F.col("_live") & ~F.col("_rolled"))
                              .select("rowkey"), f"{stage}/orphans")
            metrics = obs.get
            outcome = rc.check_guards(metrics, sweep.min_source_rows, sweep.max_delete_pct, sweep.on_breach)
            status = "completed" if outcome != "skipped_breach" else outcome
            if outcome == "ok" and stream_before is not None:
                # An attempt whose audit row got lost has closed some already.
                closed = store.run_tombstones(run.seq, "reconcile")
                orph = spark.read.parquet(f"{stage}/orphans").join(closed, "rowkey", "left_anti")
                t_df, t_obs = counted(rc.tombstones(stream_before, orph, run, spec, silver, store.snapshots(), f"{stage}/payload"),
                                      "reconciles")
                store.write_events(select_names(_widened(t_df, schema), schema.names))
                added = int(t_obs.get["rows"])
                if added:
                    store.commit(run, schema, reconciles=added)
                counts["reconciles"] += added
            # Orphans with no upsert history count toward the guard but get no tombstone.
            summary["no_payload"] = int(metrics["orphan_count"]) - counts["reconciles"] \
                if status == "completed" else None
        summary.update(sweep_status=status, sweep_metrics=metrics)

    # 4. the sweep audit row
    summary.update(counts)
    if status is not None:
        row = rc.log_row(spark, source_table, run, trigger, sweep.max_age_days, counts["reconciles"], status)
        tables.overwrite_partitions(row.withColumn("run", F.col("snapshotseq")), store.sweeps_path, ["run"])
    tables.describe(spark, store.stream_path, about)
    tables.drop_path(spark, stage)
    return summary
