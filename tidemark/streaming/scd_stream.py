"""Streaming SCD1/2 without MERGE: exact under late and out-of-order data.

A target is kept as segments. Each micro-batch (``foreachBatch``) adds one segment
with the versions that it changes, and readers merge: of the rows for one key and
start the latest segment's counts, and rows marked gone no longer exist. So a batch
writes in proportion to itself, not to the target. ``compact`` folds all segments
into a new base, by itself once they have grown as large as the base.

Each batch (type 2):

1. is appended to an event log partitioned by (``bkt``, ``batch``) where
   ``bkt = pmod(xxhash64(keys), buckets)``; the write replaces only the
   (bkt, batch=id) partitions, so a retried batch leaves one copy;
2. meets the open versions of its keys, which have a small table of their own.
   Where all its changes of a key come after the last one known, the open version
   and these changes alone give the new versions;
3. only for keys with late changes the history is read again (log pruned to their
   buckets, then ``left_semi`` on the keys) — merging into the target alone is not
   exact, a late event inside an island needs the original rows to split it. The
   versions before and after the batch are compared and the differences written.

Type 1 needs no history: the row that a key has and its changes give the new row.

A retried batch reads the state as it was before it and replaces its own segment.
``cluster_by`` lays out the base: its files are ranges of these columns and their
bounds are kept, so ``read_target`` with a range opens only the files that meet it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import scd
from tidemark.session import scratch_dir
from tidemark.sources import tables

BUCKET = "bkt"
BATCH = "batch"
SEGMENT = "seg"
GONE = "_gone"
#: A compaction is due once so many segments hold at least as many bytes as the base.
COMPACT_SEGMENTS = 16


class ScdSink:
    def __init__(self, spark: SparkSession, log_path: str, target_path: str, keys: Sequence[str], seq: str,
                 scd_type: int = 2, track: Sequence[str] | None = None, except_track: Sequence[str] = (),
                 except_columns: Sequence[str] = (), tie_break: Column | None = None, buckets: int = 64,
                 cluster_by: Sequence[str] = (), compact_segments: int | None = COMPACT_SEGMENTS):
        if scd_type not in (1, 2):
            raise ValueError("scd_type must be 1 or 2")
        self.spark, self.log_path, self.target_path = spark, log_path, target_path.rstrip("/")
        self.keys, self.seq, self.scd_type = list(keys), seq, scd_type
        self.track, self.except_track, self.except_columns = track, list(except_track), list(except_columns)
        self.tie_break, self.buckets = tie_break, int(buckets)
        self.cluster_by = list(cluster_by)
        self.compact_segments = compact_segments

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def versions(self, changes: DataFrame) -> DataFrame:
        """Versions with all columns; those not wanted are dropped by readers."""
        if self.scd_type == 1:
            return scd.scd1(changes, self.keys, self.seq, self.tie_break)
        return scd.scd2(changes, self.keys, self.seq, self.track, self.except_track, (), self.tie_break)

    # ── one batch ─────────────────────────────────────────────────────────────

    def process(self, batch: DataFrame, batch_id: int) -> None:
        batch_id = int(batch_id)
        self._check_buckets()
        state = _State(self.spark, self.target_path)
        state.begin(self.keys, self.scd_type, self.except_columns)
        if self.compact_segments and state.due(self.compact_segments, batch_id):
            state.compact(batch_id, self.cluster_by)
        if self.scd_type == 1:
            held = state.current(batch_id)
            rows = batch
            if held is not None:
                rows = batch.unionByName(held.join(batch.select(*self.keys).distinct(), self.keys, "left_semi"), allowMissingColumns=True)
            state.write(self.versions(rows).withColumn(GONE, F.lit(False)), batch_id)
            return
        tagged = batch.withColumn(BUCKET, self.bucket()).withColumn(BATCH, F.lit(batch_id).cast("long"))
        tables.overwrite_partitions(tagged, self.log_path, [BUCKET, BATCH])
        log = self.spark.read.option("mergeSchema", "true").parquet(self.log_path).where(F.col(BATCH) <= batch_id)
        mine = log.where(F.col(BATCH) == batch_id)
        if mine.isEmpty():
            return
        stage = scratch_dir(self.spark, "tidemark-scd", str(batch_id))
        opened = state.open(batch_id)
        seen = self._seen(mine, opened, stage)
        changed = self._on_time(mine.drop(BUCKET, BATCH), opened, seen)
        late = self._late_keys(seen)
        if late is not None:
            changed = changed.unionByName(self._rewritten(log, late, batch_id), allowMissingColumns=True)
        state.write(changed, batch_id)
        tables.drop_path(self.spark, stage)

    def _seen(self, rows: DataFrame, opened: DataFrame | None, stage: str) -> DataFrame | None:
        """Per known key of the batch, written once: its open version's start and sequence, and whether a change is late."""
        if opened is None:
            return None
        first = rows.groupBy(*self.keys).agg(F.min(F.col(f"`{self.seq}`")).alias("_first"))
        known = opened.select(*self.keys, F.col(scd.START_AT).alias("_since"), F.col(f"`{self.seq}`").alias("_last"))
        tables.write_view(first.join(known, self.keys).withColumn("_late", F.col("_first") <= F.col("_last")).drop("_first"), stage)
        return self.spark.read.parquet(stage)

    def _late_keys(self, seen: DataFrame | None) -> DataFrame | None:
        late = None if seen is None else seen.where("_late").select(*self.keys).withColumn(BUCKET, self.bucket())
        return None if late is None or late.isEmpty() else late

    def _on_time(self, rows: DataFrame, opened: DataFrame | None, seen: DataFrame | None) -> DataFrame:
        """Changed versions of the keys without late changes: the open version counts as their first change."""
        if opened is None:
            return self.versions(rows).withColumn(GONE, F.lit(False))
        late = seen.where("_late").select(*self.keys)
        before = opened.drop(scd.START_AT, scd.END_AT).join(seen.where("NOT _late").select(*self.keys), self.keys, "left_semi")
        found = self.versions(rows.join(late, self.keys, "left_anti").unionByName(before, allowMissingColumns=True))
        since = F.when(F.col(scd.START_AT) == F.col("_last"), F.col("_since"))
        return (found.join(seen.drop("_late"), self.keys, "left")
                .withColumn(scd.START_AT, F.coalesce(since, F.col(scd.START_AT)))
                .drop("_since", "_last").withColumn(GONE, F.lit(False)))

    def _rewritten(self, log: DataFrame, late: DataFrame, batch_id: int) -> DataFrame:
        """What differs between the versions of the late keys' whole histories with and without this batch.

        Each of the two is computed once and they meet in one join; a version that is gone keeps its key and start alone.
        """
        touched = sorted(r[BUCKET] for r in late.select(BUCKET).distinct().collect())  # <= buckets values
        history = log.where(F.col(BUCKET).isin(touched)).join(late.select(*self.keys), self.keys, "left_semi")
        on = [*self.keys, scd.START_AT]
        new = self.versions(history.drop(BUCKET, BATCH))
        old = self.versions(history.where(F.col(BATCH) < batch_id).drop(BUCKET, BATCH))
        was = old.select(*on, scd.content_order(old).alias("_was"))
        return (new.withColumn("_now", scd.content_order(new)).join(was, on, "full_outer")
                .where(~F.col("_now").eqNullSafe(F.col("_was")))
                .withColumn(GONE, F.col("_now").isNull()).drop("_now", "_was"))

    def compact(self) -> None:
        """Fold all segments into a new base, laid out by ``cluster_by``."""
        _State(self.spark, self.target_path).compact(None, self.cluster_by)

    def _check_buckets(self) -> None:
        """Keys hash into the bucket count that the log was begun with; another count would split their history."""
        known = tables.read_properties(self.spark, self.log_path)
        if known is None:
            tables.write_properties(self.spark, self.log_path, {"buckets": str(self.buckets)})
        elif int(known["buckets"]) != self.buckets:
            raise ValueError(f"the event log at {self.log_path} has {known['buckets']} buckets, not {self.buckets}")


class _State:
    """Base and segments of a target; ``_properties.json`` names the base that counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.about = tables.read_properties(spark, path) or {}

    def begin(self, keys: Sequence[str], scd_type: int, dropped: Sequence[str]) -> None:
        if not self.about:
            self._save({"upto": "-1", "keys": json.dumps(list(keys)), "scd_type": str(scd_type), "dropped": json.dumps(list(dropped))})

    def _save(self, about: dict) -> None:
        self.about = about
        tables.write_properties(self.spark, self.path, about)

    @property
    def upto(self) -> int:
        return int(self.about.get("upto", -1))

    @property
    def keys(self) -> list[str]:
        return json.loads(self.about["keys"])

    @property
    def on(self) -> list[str]:
        return self.keys + ([scd.START_AT] if self.about["scd_type"] == "2" else [])

    def base(self, kind: str) -> DataFrame | None:
        return tables.read(self.spark, f"{self.path}/{kind}_base/upto={self.upto}")

    def segments(self, kind: str, before: int | None) -> DataFrame | None:
        if not tables.exists(self.spark, f"{self.path}/{kind}"):
            return None
        found = self.spark.read.option("mergeSchema", "true").parquet(f"{self.path}/{kind}").where(F.col(SEGMENT) > self.upto)
        return found if before is None else found.where(F.col(SEGMENT) < before)

    def write(self, changed: DataFrame, batch_id: int) -> None:
        """The batch's segment, and from it the open versions it leaves."""
        segment = f"{self.path}/versions/{SEGMENT}={batch_id}"
        tables.write_view(changed, segment)
        if self.about["scd_type"] == "2":
            written = self.spark.read.parquet(segment).where(F.col(scd.END_AT).isNull() & ~F.col(GONE)).drop(GONE)
            tables.write_view(written, f"{self.path}/open/{SEGMENT}={batch_id}")

    def _last_rows(self, kind: str, on: list[str], before: int | None) -> DataFrame | None:
        """Of the segments' rows, the latest for each of ``on``, gone ones too."""
        segments = self.segments(kind, before)
        if segments is None:
            return None
        rest = [c for c in segments.columns if c not in (*on, SEGMENT)]
        return (segments.groupBy(*[F.col(f"`{c}`") for c in on])
                .agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col(SEGMENT)).alias("_last"))
                .select(*[F.col(f"`{c}`") for c in on], "_last.*"))

    def _merged(self, base: DataFrame | None, kind: str, on: list[str], before: int | None) -> DataFrame | None:
        last = self._last_rows(kind, on, before)
        if last is None:
            return base
        live = last.where(~F.col(GONE)).drop(GONE) if GONE in last.columns else last
        if base is None:
            return live
        return base.join(last.select(*on), on, "left_anti").unionByName(live, allowMissingColumns=True)

    def current(self, before: int | None = None) -> DataFrame | None:
        return self._merged(self.base("versions"), "versions", self.on, before)

    def inside(self, where: tuple) -> DataFrame | None:
        """``current`` from the base files that a range of a column may touch, and all segments."""
        base = tables.read_clustered(self.spark, f"{self.path}/versions_base/upto={self.upto}", where)
        return self._merged(base, "versions", self.on, None)

    def open(self, before: int | None = None) -> DataFrame | None:
        return self._merged(self.base("open"), "open", self.keys, before)

    def due(self, most: int, before: int) -> bool:
        names = tables.folder_names(self.spark, f"{self.path}/versions")
        live = [n for n in names if n.startswith(f"{SEGMENT}=") and self.upto < int(n.split("=")[1]) < before]
        if len(live) < most:
            return False
        held = sum(tables.size(self.spark, f"{self.path}/versions/{n}") for n in live)
        return held >= tables.size(self.spark, f"{self.path}/versions_base/upto={self.upto}")

    def compact(self, before: int | None, cluster_by: Sequence[str]) -> None:
        found = self.segments("versions", before)
        last = None if found is None else found.agg(F.max(SEGMENT).alias("m")).first()["m"]
        if last is None:
            return
        old = self.upto
        kinds = {"versions": (self.current(before), cluster_by)}
        if self.about["scd_type"] == "2":
            kinds["open"] = (self.open(before), ())
        for kind, (rows, by) in kinds.items():
            tables.write_clustered(rows, f"{self.path}/{kind}_base/upto={last}", by)
        self._save({**self.about, "upto": str(last)})  # from here on readers take the new base
        for kind in kinds:
            tables.drop_path(self.spark, f"{self.path}/{kind}_base/upto={old}")
            for name in tables.folder_names(self.spark, f"{self.path}/{kind}"):
                if name.startswith(f"{SEGMENT}=") and int(name.split("=")[1]) <= last:
                    tables.drop_path(self.spark, f"{self.path}/{kind}/{name}")


def read_target(spark: SparkSession, path: str, where: tuple | None = None) -> DataFrame:
    """The SCD table, base and segments merged.

    ``where = (column, low, high)`` keeps the rows with low <= column <= high; where the base is clustered by
    that column, its files outside the range are not opened.
    """
    state = _State(spark, path.rstrip("/"))
    if not state.about:
        raise ValueError(f"no SCD target at {path}")
    if where is None:
        out = state.current()
    else:
        out = state.inside(where)
        out = out if out is None else out.where(F.col(f"`{where[0]}`").between(where[1], where[2]))
    if out is None:
        raise ValueError(f"the SCD target at {path} has no version yet")
    return out.drop(*json.loads(state.about["dropped"]))


def scd2_stream(stream: DataFrame, sink: ScdSink, checkpoint: str, available_now: bool = True):
    """Run a streaming DataFrame into ``sink`` (blocks until available data is done)."""
    w = stream.writeStream.foreachBatch(sink.process).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
