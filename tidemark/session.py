"""Session settings, scratch storage and the per-run stamp."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Settings every entry point relies on. UTC keeps timestamp literals, hashing of
# timestamps and window bounds identical on every machine.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str = "local[8]", app: str = "tidemark", shuffle_partitions: int = 8,
              extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark (a cluster passes its own session)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_defaults(spark)
    return spark


def apply_session_defaults(spark: SparkSession) -> None:
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The directory comes from ``spark.checkpoint.dir`` (or a directory already
    set on the SparkContext). Only when neither is set — a local test session —
    a private temporary directory is registered as the checkpoint directory.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    path = os.path.join(base.rstrip("/"), *parts, uuid.uuid4().hex[:12])
    return path


@dataclass(frozen=True)
class RunStamp:
    """One constant (timestamp, sequence) per pipeline run.

    ``ts`` is a naive UTC datetime truncated to whole seconds; ``seq`` is its
    epoch milliseconds. Every row written by the run carries these literals, so
    a snapshot never splits across several sequence values (``current_timestamp``
    differs between queries of one run).
    """

    ts: datetime

    def __post_init__(self):
        ts = self.ts
        if ts.tzinfo is not None:
            ts = ts.astimezone(timezone.utc).replace(tzinfo=None)
        object.__setattr__(self, "ts", ts.replace(microsecond=0))

    @classmethod
    def now(cls) -> "RunStamp":
        return cls(datetime.now(timezone.utc))

    @classmethod
    def parse(cls, text: str) -> "RunStamp":
        return cls(datetime.fromisoformat(text))

    @property
    def seq(self) -> int:
        return int(self.ts.replace(tzinfo=timezone.utc).timestamp() * 1000)

    @property
    def text(self) -> str:
        return self.ts.strftime("%Y-%m-%d %H:%M:%S")

    def ts_col(self) -> Column:
        return ts_literal(self.ts)

    def seq_col(self) -> Column:
        return F.expr(f"CAST({self.seq} AS BIGINT)")

    def window_start(self, days: int = 7, anchor: str = "midnight_utc") -> datetime:
        """Inclusive lower bound of the trailing window: (run midnight | run time) - days."""
        if days < 1:
            raise ValueError("rolling_window_days must be >= 1")
        anchor = anchor.lower()
        if anchor not in ("midnight_utc", "run_time"):
            raise ValueError(f"window_start_anchor must be midnight_utc or run_time, got {anchor!r}")
        base = self.ts if anchor == "run_time" else self.ts.replace(hour=0, minute=0, second=0)
        return base - timedelta(days=days)

    def plus(self, **delta) -> "RunStamp":
        return RunStamp(self.ts + timedelta(**delta))


def ts_literal(ts: datetime) -> Column:
    """A TIMESTAMP_NTZ literal for a naive UTC datetime (exact, timezone-free)."""
    return F.expr(f"TIMESTAMP_NTZ'{ts.strftime('%Y-%m-%d %H:%M:%S.%f')}'")
