"""Runs with empty windows, broken runs, one read of the source, payloads newest first, properties, the run audit."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import RollingSpec, audit, reconcile, rolling, scd
from tidemark.operators.identity import add_identity
from tidemark.plans import scenario as sc
from tidemark.sources import files, properties, tables
from tidemark.streaming import ChangeStore, ingest_bronze, medallion, run_once
from tidemark.streaming.change_capture import SweepSpec

ROWS = "id long, event_ts timestamp_ntz, v string"
SPEC = RollingSpec(window_column="event_ts")


def source(spark, ids, run):
    return spark.createDataFrame([(i, run.ts, f"v{i}") for i in ids], ROWS)


def events(store):
    return sorted((r.id, r.changetype, r.snapshotseq) for r in store.stream().collect())


def test_empty_first_run_is_a_state(spark, tmp):
    store = ChangeStore(spark, tmp)
    out = run_once(spark, source(spark, [], sc.run(0)), store, sc.run(0), SPEC)
    assert (out["upserts"], out["deletes"]) == (0, 0)
    assert store.stream().count() == 0 and "rowkey" in store.stream().columns
    assert store.committed(sc.run(0)) == {"upserts": 0, "deletes": 0, "reconciles": 0}
    run_once(spark, source(spark, [1], sc.run(1)), store, sc.run(1), SPEC)
    assert events(store) == [(1, "upsert", sc.run(1).seq)]


def test_empty_retry_replaces_what_the_broken_run_left(spark, tmp):
    store = ChangeStore(spark, f"{tmp}/store")
    run_once(spark, source(spark, [1, 2], sc.run(0)), store, sc.run(0), SPEC)
    store.write_events(rolling.snapshot(source(spark, [1, 2], sc.run(1)), sc.run(1), SPEC))  # broke off here
    ingest_bronze(spark, store, f"{tmp}/bronze", f"{tmp}/ck")
    out = run_once(spark, source(spark, [], sc.run(1)), store, sc.run(1), SPEC)
    assert (out["upserts"], out["deletes"]) == (0, 2)
    ingest_bronze(spark, store, f"{tmp}/bronze", f"{tmp}/ck")
    expected = sorted([(i, "upsert", sc.run(0).seq) for i in (1, 2)] + [(i, "delete", sc.run(1).seq) for i in (1, 2)])
    assert events(store) == expected
    assert sorted((r.id, r.changetype, r.snapshotseq) for r in spark.read.parquet(f"{tmp}/bronze").collect()) == expected


def test_a_commit_is_not_taken_twice(spark, tmp):
    tables.create_file(spark, f"{tmp}/m/a.json", "{}\n")
    with pytest.raises(FileExistsError):
        tables.create_file(spark, f"{tmp}/m/a.json", "{}\n")
    assert tables.file_names(spark, f"{tmp}/m") == ["a.json"]


def test_runs_with_other_columns_share_a_stream(spark, tmp):
    store = ChangeStore(spark, tmp)
    run_once(spark, source(spark, [1], sc.run(0)), store, sc.run(0), SPEC)
    run_once(spark, source(spark, [1], sc.run(1)).withColumn("late", F.lit("x")), store, sc.run(1), SPEC)
    got = {(r.snapshotseq, r.changetype): r.late for r in store.stream().collect()}
    assert got[(sc.run(0).seq, "upsert")] is None and got[(sc.run(1).seq, "upsert")] == "x"


def test_identity_reads_the_source_once(spark, tmp):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            seen.add(len(batch))
            yield batch

    rows = spark.range(0, 900, numPartitions=6).selectExpr("id % 50 AS k", "cast(id % 7 AS string) AS v")
    counted = rows.mapInPandas(count, "k long, v string")
    for mode in ({}, {"mode": "key_columns", "key_columns": ["k"], "with_contenthash": True}):
        seen.value = 0
        plain = add_identity(rows, **mode)
        staged = add_identity(counted, stage=f"{tmp}/{len(mode)}", **mode)
        plan = staged._jdf.queryExecution().executedPlan().toString()
        assert "MapInPandas" not in plan and all(f"{tmp}/{len(mode)}" in f.replace("file:", "") for f in staged.inputFiles())
        assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, plain.collect()))
        assert seen.value == 900


def test_payloads_are_searched_newest_first(spark, tmp):
    columns = "rowkey string, v string, changetype string, snapshotseq long"
    rows = [("a", f"a{s}", "upsert", s) for s in (1, 2, 9)] + [("b", "b1", "upsert", 1), ("b", "gone", "delete", 9), ("c", "c4", "upsert", 4)]
    spark.createDataFrame(rows, columns).write.partitionBy("snapshotseq").parquet(f"{tmp}/h")
    history = spark.read.parquet(f"{tmp}/h").select("rowkey", "v", "changetype", F.col("snapshotseq").cast("long").alias("snapshotseq"))
    orphans = spark.createDataFrame([("a",), ("c",)], "rowkey string")
    run = sc.run(0)
    found = reconcile.search_payload(history, orphans, run, [1, 2, 4, 9], f"{tmp}/s")
    assert sorted((r.rowkey, r.v) for r in found.collect()) == [("a", "a9"), ("c", "c4")]
    steps = tables.folder_names(spark, f"{tmp}/s")
    assert steps == ["found0", "found1", "left0", "left1"]  # 9, then 4 and 2; run 1 was never opened
    missing = spark.createDataFrame([("b",), ("x",)], "rowkey string")
    found = reconcile.search_payload(history, missing, run, [1, 2, 4, 9], f"{tmp}/s2")
    assert [(r.rowkey, r.v) for r in found.collect()] == [("b", "b1")]
    assert reconcile.search_payload(history, orphans, run, [], f"{tmp}/s3").count() == 0


SRC = {
    "source_table": "loans", "description": "All loans", "tags": {"owner": "ops", "tier": 1}, "scd_2_key_list": ["rowkey"],
    "history_timestamp_source": "snapshotseq", "scd_2_exclude_list": list(scd.CHANGE_STREAM_UNTRACKED),
    "federated_source": {"foreign_fqn": "db.s.loans", "window_column": "event_ts", "rolling_window_days": 7},
    "reconciliation": {"enabled": True, "max_delete_pct": 2.5, "run_on_weekday": "SUN"},
}


def test_rolling_properties_are_kept_with_the_stream(spark, tmp):
    store = ChangeStore(spark, f"{tmp}/store")
    run_once(spark, source(spark, [1], sc.run(0)), store, sc.run(0), SPEC, about=properties.rolling(SRC))
    assert tables.description(spark, store.stream_path) == {
        "comment": "All loans", "quality": "staging", "pipelines.autoOptimize.managed": "true", "ingestion.source_type": "federated",
        "ingestion.foreign_fqn": "db.s.loans", "ingestion.load_mode": "rolling_window", "ingestion.window_column": "event_ts",
        "ingestion.rolling_window_days": "7", "ingestion.window_start_anchor": "midnight_utc", "ingestion.row_identity_mode": "hash_all",
        "ingestion.row_identity_keys": "", "ingestion.delete_detection": "true", "ingestion.reconciliation": "true",
        "reconcile.cadence_days": "7", "reconcile.run_on_weekday": "SUN", "reconcile.max_age_days": "full", "reconcile.max_delete_pct": "2.5",
        "reconcile.min_source_rows": "1", "reconcile.on_breach": "fail", "source.owner": "ops", "source.tier": "1"}
    assert store.stream().count() == 1  # the sidecar is no data


def test_file_and_silver_properties(spark, tmp):
    src = {"source_table": "customers", "source_path": f"{tmp}/in", "file_format": "parquet", "tags": {"owner": "ops"},
           "scd_2_key_list": ["id"], "data_quality_rules": [{"description": "positive", "expr": "id > 0"}]}
    spark.range(-1, 3).write.parquet(f"{tmp}/in")
    medallion.ingest_staging(spark, files.FileSource.from_config(src), f"{tmp}/stg", f"{tmp}/c1")
    medallion.ingest_bronze(spark, f"{tmp}/stg", f"{tmp}/brz", f"{tmp}/c2", about=properties.bronze(src))
    sink = medallion.SilverSink(spark, medallion.SilverSpec.from_config(src, buckets=2), f"{tmp}/slv", f"{tmp}/qtn", f"{tmp}/log", sc.RUN0)
    medallion.run_silver(spark, f"{tmp}/brz", sink, f"{tmp}/c3")
    common = {"pipelines.autoOptimize.managed": "true", "source.owner": "ops"}
    assert tables.description(spark, f"{tmp}/stg") == {"comment": "Staging raw append table: customers", "quality": "staging",
                                                       "ingestion.file_discovery_mode": "directory_listing", **common}
    assert tables.description(spark, f"{tmp}/brz") == {"comment": "Bronze table: customers", "quality": "bronze", **common}
    assert tables.description(spark, f"{tmp}/slv") == {"comment": "Silver SCD2 table: customers", "quality": "silver",
                                                       "silver.scd_type": "2", **common}
    assert tables.description(spark, f"{tmp}/qtn")["quality"] == "quarantine" and "positive" not in str(common)
    about = tables.description(spark, f"{tmp}/slv")
    tables.register_table(spark, "tidemark_described", f"{tmp}/brz", {k: v for k, v in about.items() if k != "comment"}, about["comment"])
    try:
        held = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES tidemark_described").collect()}
        assert held["silver.scd_type"] == "2" and held["source.owner"] == "ops"
    finally:
        spark.sql("DROP TABLE tidemark_described")


def test_run_audit_as_of_each_run(spark):
    seqs = [sc.run(k).seq for k in (0, 1, 2, 9)]
    runs = spark.createDataFrame([(seqs[0], 5, 0, 0), (seqs[1], 0, 5, 1), (seqs[2], 3, 0, 0), (seqs[3], 3, 1, 0)],
                                 "snapshotseq long, upserts long, deletes long, reconciles long")
    log = spark.createDataFrame([("t", seqs[0], sc.run(0).ts, "initial", None, 0, "no_target"), ("t", seqs[1], sc.run(1).ts, "initial", None, 1, "completed"),
                                 ("other", seqs[2], sc.run(2).ts, "initial", None, 1, "completed")], reconcile.LOG_SCHEMA)
    got = audit.run_audit(runs, log, "t", SPEC).orderBy("snapshotseq").collect()
    assert [r.prior_snapshotseq for r in got] == [None, seqs[0], seqs[0], seqs[2]]
    assert [r.last_sweep for r in got] == [None, None, sc.run(1).ts, sc.run(1).ts]
    assert [(r.reconcile_due, r.reconcile_trigger) for r in got] == [(True, "initial"), (True, "initial"), (False, "not_due"), (True, "cadence")]
    assert [r.sweep_status for r in got] == ["no_target", "completed", None, None]
    assert [r.windowstart for r in got] == [sc.run(k).window_start(7) for k in (0, 1, 2, 9)]
    off = audit.run_audit(runs, None, "t", SPEC, enabled=False).collect()
    assert {(r.reconcile_due, r.reconcile_trigger) for r in off} == {(False, "disabled")}


def test_guard_outcomes_match_the_check(spark):
    cases = [(m, o, g, r, p, b) for m in (0, 5) for o, g in ((0, 0), (10, 0), (10, 1), (10, 9)) for r in (1, 4, 6) for p in (5.0, 50.0) for b in ("fail", "skip")]
    df = spark.createDataFrame(cases, "m long, o long, g long, r long, p double, b string")
    out = df.withColumn("got", reconcile.guard_outcome(*[F.col(c) for c in "mogrpb"]))
    for x in out.collect():
        try:
            expected = reconcile.check_guards({"source_count": x.m, "open_count": x.o, "orphan_count": x.g}, x.r, x.p, x.b)
        except ValueError as refused:
            expected = "refused_floor" if "min_source_rows" in str(refused) else "refused_ceiling"
        assert x.got == expected, x
