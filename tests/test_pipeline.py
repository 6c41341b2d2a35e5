from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rolling, scd
from tidemark.session import RunStamp
from tidemark.streaming.change_capture import ChangeStore, SweepSpec, run_once

SPEC = rolling.RollingSpec(window_column="ts", days=7)
R0 = RunStamp(datetime(2024, 1, 28, 6))


def src(spark, vals):
    t = datetime(2024, 1, 27)
    return spark.createDataFrame([(v, t) for v in vals], "v string, ts timestamp_ntz")


def test_empty_snapshot_does_not_reissue_tombstones(spark, tmp):
    store = ChangeStore(spark, tmp)
    run_once(spark, src(spark, ["a", "b"]), store, R0, SPEC)
    s1 = run_once(spark, src(spark, []), store, R0.plus(days=1), SPEC)
    s2 = run_once(spark, src(spark, []), store, R0.plus(days=2), SPEC)
    assert (s1["deletes"], s2["deletes"]) == (2, 0)


def test_rerun_of_a_run_replaces_itself(spark, tmp):
    store = ChangeStore(spark, tmp)
    run_once(spark, src(spark, ["a", "b", "b"]), store, R0, SPEC)
    run_once(spark, src(spark, ["a"]), store, R0.plus(days=1), SPEC)
    first = sorted(map(tuple, store.stream().drop("_staging_ingested_at").collect()))
    run_once(spark, src(spark, ["a"]), store, R0.plus(days=1), SPEC)        # retry
    again = sorted(map(tuple, store.stream().drop("_staging_ingested_at").collect()))
    assert first == again and len(first) == 3 + 1 + 2


def test_sweep_statuses(spark, tmp):
    store = ChangeStore(spark, tmp)
    run_once(spark, src(spark, ["a", "b", "c"]), store, R0, SPEC)
    s = run_once(spark, src(spark, ["a", "b", "c"]), store, R0.plus(days=1), SPEC, SweepSpec(enabled=True))
    assert (s["trigger"], s["sweep_status"]) == ("initial", "no_target")
    silver = scd.change_stream_scd2(store.stream())
    # 'c' vanishes from the full read while the rolling diff also sees it: not double-counted
    r2 = R0.plus(days=2)
    s = run_once(spark, src(spark, ["a", "b"]), store, r2, SPEC, SweepSpec(enabled=True, force=True), silver)
    assert s["deletes"] == 1 and s["reconciles"] == 0 and s["sweep_metrics"]["rolling_deleted"] == 1
    assert s["no_payload"] == 0
    log = store.sweeps().orderBy("snapshotseq").collect()
    assert [r.status for r in log] == ["no_target", "completed"]


def test_sweep_guard_breach(spark, tmp):
    store = ChangeStore(spark, tmp)
    run_once(spark, src(spark, ["a", "b", "c", "d"]), store, R0, SPEC)
    silver = scd.change_stream_scd2(store.stream())
    old = spark.createDataFrame([("a", datetime(2023, 1, 1))], "v string, ts timestamp_ntz")
    # the window read still has everything, the full read lost 'b','c','d' -> 75 % orphans
    window_src = src(spark, ["a", "b", "c", "d"]).unionByName(old)
    live_src = spark.createDataFrame([("a", datetime(2024, 1, 27))], "v string, ts timestamp_ntz")
    sweep = SweepSpec(enabled=True, force=True, on_breach="fail")
    from tidemark.operators import reconcile as rc
    open_k = rc.open_keys(silver)
    live_k = rc.live_keys(live_src, R0.plus(days=1), SPEC)
    m = rc.sweep_metrics(open_k, live_k).first().asDict()
    assert m["orphan_count"] == 3 and m["open_count"] == 4
    with pytest.raises(ValueError):
        rc.check_guards(m, 1, 5.0, "fail")
    assert rc.check_guards(m, 1, 5.0, "skip") == "skipped_breach"
    assert window_src.count() == 5 and sweep.on_breach == "fail"


def test_streaming_scd_retry_is_idempotent(spark, tmp):
    from tidemark.streaming.scd_stream import ScdSink, read_target
    sink = ScdSink(spark, f"{tmp}/log", f"{tmp}/t", ["k"], "seq", track=["s"], buckets=4)
    b0 = spark.createDataFrame([("a", 1, "A"), ("a", 5, "A"), ("b", 1, "X")], "k string, seq int, s string")
    b1 = spark.createDataFrame([("a", 3, "B")], "k string, seq int, s string")
    sink.process(b0, 0)
    sink.process(b1, 1)
    sink.process(b1, 1)                                   # retried micro-batch
    got = sorted((r.k, r.s, r["__START_AT"], r["__END_AT"]) for r in read_target(spark, f"{tmp}/t").collect())
    assert got == [("a", "A", 1, 3), ("a", "A", 5, None), ("a", "B", 3, 5), ("b", "X", 1, None)]


def test_medallion_chain_with_quarantine_and_views(spark, tmp):
    from tidemark.streaming import medallion
    from tidemark.sources import files
    rows = [(1, "a", 10.0), (2, "b", -3.0), (3, "c", None)]
    spark.createDataFrame(rows, "id bigint, name string, bal double").write.parquet(f"{tmp}/in")
    medallion.ingest_staging(spark, files.FileSource(f"{tmp}/in", "parquet"), f"{tmp}/stg", f"{tmp}/c1")
    medallion.ingest_bronze(spark, f"{tmp}/stg", f"{tmp}/brz", f"{tmp}/c2")
    spec = medallion.SilverSpec("my_table", ["id"], silver_columns=[{"name": "id"}, {"name": "bal", "rename": "bal ance"}],
                                data_quality_rules=[("non_negative", "`bal ance` >= 0")], buckets=4,
                                cluster_by=["id"])
    assert spec.silver_table == "mytable"
    sink = medallion.SilverSink(spark, spec, f"{tmp}/slv", f"{tmp}/qtn", f"{tmp}/log", R0)
    medallion.run_silver(spark, f"{tmp}/brz", sink, f"{tmp}/c3")
    silver = medallion.live_rows(spark, f"{tmp}/slv")
    assert sorted((r.id, r.balance) for r in silver.collect()) == [(1, 10.0), (3, None)]
    q = spark.read.parquet(f"{tmp}/qtn").collect()
    assert [(r.id, r._failed_dq_rules, r._source_table) for r in q] == [(2, ["non_negative"], "my_table")]
    view = medallion.silver_view(spark, f"{tmp}/brz", spec)
    assert view.isStreaming and "balance" in view.columns


def test_null_window_rows_are_reported(spark):
    df = spark.createDataFrame([("a", None), ("b", datetime(2024, 1, 27))], "v string, ts timestamp_ntz")
    assert rolling.null_window_rows(df, "ts") == 1
    assert rolling.snapshot(df, R0, SPEC).count() == 1


def test_bucketed_store_matches_folder_store_without_shuffle(spark, tmp):
    from tests.conftest import SF
    from tidemark.plans import scenario as sc
    ev = spark.read.parquet(f"{SF}/events.parquet")
    plain = ChangeStore(spark, f"{tmp}/plain")
    bucketed = ChangeStore(spark, f"{tmp}/bucketed", table="tidemark_cc_bucketed", buckets=8)
    for k in range(3):
        run_once(spark, sc.foreign(ev, k), plain, sc.run(k), sc.SPEC)
        s = run_once(spark, sc.foreign(ev, k), bucketed, sc.run(k), sc.SPEC)
    assert s["deletes"] == 3
    cols = plain.stream().columns
    a = sorted(map(tuple, plain.stream().select(*cols).collect()))
    b = sorted(map(tuple, bucketed.stream().select(*cols).collect()))
    assert a == b and len(a) == 214 + 206 + 197 + 4 + 3
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        st = bucketed.stream()
        prior = rolling.prior_snapshot(st, sc.run(1).seq)
        cur = rolling.prior_snapshot(st, sc.run(2).seq)
        plan = rolling.detect_deletes(cur, prior, sc.run(2), sc.SPEC)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_large_buckets_are_not_single_tasks(spark, tmp, monkeypatch):
    from tests.conftest import SF
    from tidemark.operators import scd
    from tidemark.plans import scenario as sc
    from tidemark.streaming import change_capture as cc
    ev = spark.read.parquet(f"{SF}/events.parquet")
    got = {}
    for name, most in (("small", cc.BUCKET_BYTES), ("large", 0)):
        monkeypatch.setattr(cc, "BUCKET_BYTES", most)
        store = ChangeStore(spark, f"{tmp}/{name}", table=f"tidemark_cc_{name}", buckets=2)
        for k in range(3):
            silver = scd.change_stream_scd2(store.stream()) if k == 2 else None
            run_once(spark, sc.foreign(ev, k), store, sc.run(k), sc.SPEC, cc.SweepSpec(enabled=k == 2), silver)
        rows = store.stream()
        plan = scd.change_stream_scd2(rows)._jdf.queryExecution().executedPlan().toString()
        got[name] = "Exchange hashpartitioning(rowkey" in plan, sorted(map(str, rows.select(*sorted(rows.columns)).collect()))
        one = store.stream(sc.run(1).seq)
        assert one.count() == 206 + 4 and one.select("snapshotseq").distinct().count() == 1
        spark.sql(f"DROP TABLE tidemark_cc_{name}")
    assert not got["small"][0] and got["large"][0]  # a shuffle makes the tasks where a bucket would be too large for one
    assert got["small"][1] == got["large"][1] and any("reconcile" in r for r in got["large"][1])
