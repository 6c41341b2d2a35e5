"""Run-audit views re-aimed as data queries (all single-aggregation plans)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.quality import FAILED
from tidemark.operators.reconcile import sweep_trigger_col
from tidemark.operators.rolling import RollingSpec
from tidemark.operators.scd import END_AT


def ingest_summary(bronze: DataFrame, by: Sequence[str] = ("_source_file_name",)) -> DataFrame:
    """Per group: rows and first / last ingest time (staging and, if present, bronze)."""
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.min("_staging_ingested_at").alias("first_ingested_at"),
            F.max("_staging_ingested_at").alias("last_ingested_at")]
    if "_bronze_ingested_at" in bronze.columns:
        aggs.append(F.max("_bronze_ingested_at").alias("last_bronze_at"))
    return bronze.groupBy(*by).agg(*aggs)


def silver_summary(silver: DataFrame) -> DataFrame:
    """Version counts of an SCD2 table: total, open, closed, live, soft-deleted-open, keys."""
    has_del = "isdeleted" in silver.columns
    is_open = F.col(END_AT).isNull()
    deleted = F.col("isdeleted") if has_del else F.lit(False)
    return silver.agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if(is_open).cast("long").alias("open_versions"),
        F.count_if(~is_open).cast("long").alias("closed_versions"),
        F.count_if(is_open & ~deleted).cast("long").alias("live_rows"),
        F.count_if(is_open & deleted).cast("long").alias("deleted_rows"),
    )


def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    """Failures per rule from a quarantine table (a row failing two rules counts twice)."""
    return (quarantine.select(F.explode(FAILED).alias("rule"))
            .groupBy("rule").agg(F.count(F.lit(1)).alias("failed_rows")))


def snapshot_summary(stream: DataFrame) -> DataFrame:
    """Per run of a change stream: events by change type and the snapshot it diffed against.

    The final window runs over one row per run (bounded), so it needs no key.
    """
    per_run = stream.groupBy("snapshotseq", "snapshotts", "windowstart").agg(
        F.count_if(F.col("changetype") == "upsert").cast("long").alias("upserts"),
        F.count_if(F.col("changetype") == "delete").cast("long").alias("deletes"),
        F.count_if(F.col("changetype") == "reconcile").cast("long").alias("reconciles"),
    )
    w = Window.orderBy("snapshotseq").rowsBetween(Window.unboundedPreceding, -1)
    prior = F.max(F.when(F.col("upserts") > 0, F.col("snapshotseq"))).over(w)
    return per_run.withColumn("prior_snapshotseq", prior)


def run_audit(runs: DataFrame, sweeps: DataFrame | None, source_table: str, spec: RollingSpec, cadence_days: int = 7,
              weekday: str | None = None, enabled: bool = True, max_age_days: int | None = None, max_delete_pct: float = 5.0,
              min_source_rows: int = 1, on_breach: str = "fail") -> DataFrame:
    """One row for each committed run: its window, what it compared with, and the sweep's state as of that run.

    ``runs`` is the ledger (snapshotseq and counts), ``sweeps`` the sweep log; each run sees the last completed
    sweep before it, from which follow whether a sweep was due and why. Windows run over one row per run.
    """
    stamp = F.timestamp_millis("snapshotseq").cast("timestamp_ntz")
    anchor = stamp if spec.anchor == "run_time" else F.date_trunc("day", stamp).cast("timestamp_ntz")
    out = runs.select("snapshotseq", stamp.alias("snapshotts"), (anchor - F.expr(f"INTERVAL {int(spec.days)} DAYS")).alias("windowstart"),
                      "upserts", "deletes", "reconciles")
    if sweeps is None:
        logged = out.select("snapshotseq", F.lit(None).cast("timestamp_ntz").alias("sweepts"), F.lit(None).cast("string").alias("status"))
    else:
        logged = sweeps.where(F.col("source_table") == source_table).select("snapshotseq", "sweepts", "status")
    out = out.join(logged, "snapshotseq", "left")
    before = Window.orderBy("snapshotseq").rowsBetween(Window.unboundedPreceding, -1)
    prior = F.max(F.when(F.col("upserts") > 0, F.col("snapshotseq"))).over(before)
    last = F.last(F.when(F.col("status") == "completed", F.col("sweepts")), ignorenulls=True).over(before)
    out = out.withColumns({"prior_snapshotseq": prior, "last_sweep": last})
    trigger = sweep_trigger_col(F.col("snapshotts"), F.col("last_sweep"), cadence_days, weekday) if enabled else F.lit("disabled")
    return out.withColumn("reconcile_trigger", trigger).select(
        F.lit(source_table).alias("source_table"), "snapshotseq", "snapshotts", "windowstart", "upserts", "deletes", "reconciles",
        "prior_snapshotseq", "last_sweep", (~F.col("reconcile_trigger").isin("not_due", "disabled")).alias("reconcile_due"),
        "reconcile_trigger", F.col("status").alias("sweep_status"), F.lit(str(max_age_days or "full")).alias("reconcile_scope"),
        F.lit(f"min_rows={min_source_rows}, max_pct={max_delete_pct}, on_breach={on_breach}").alias("reconcile_guards"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count (partial aggregation)."""
    return (df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("dup_count"))
            .where(F.col("dup_count") > 1))
