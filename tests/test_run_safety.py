"""Runs that fail half-way, sessions without settings, ties in any order, bucket counts, scratch folders."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import RollingSpec, scd
from tidemark.plans import scenario as sc
from tidemark.session import scratch_dir
from tidemark.streaming import ChangeStore, run_once
from tidemark.streaming.change_capture import SweepSpec
from tidemark.streaming.scd_stream import ScdSink

ROWS = "id long, event_ts timestamp_ntz, v string"


def source(spark, ids, run):
    return spark.createDataFrame([(i, run.ts, f"v{i}") for i in ids], ROWS)


@pytest.fixture
def spec():
    return RollingSpec(window_column="event_ts")


def test_deletes_after_a_failed_guard(spark, tmp, spec):
    store, runs = ChangeStore(spark, tmp), [sc.run(k) for k in range(3)]
    run_once(spark, source(spark, [1, 2], runs[0]), store, runs[0], spec)
    silver = scd.change_stream_scd2(store.stream())
    with pytest.raises(ValueError):
        run_once(spark, source(spark, [1, 2, 3], runs[1]), store, runs[1], spec,
                 SweepSpec(enabled=True, min_source_rows=1000), silver)
    out = run_once(spark, source(spark, [1, 2], runs[2]), store, runs[2], spec)
    assert out["prior_seq"] == runs[1].seq and out["deletes"] >= 1
    gone = store.stream().where((F.col("changetype") == "delete") & (F.col("id") == 3)).count()
    assert gone == 1


def test_bucketed_store_keeps_history_in_a_plain_session(spark, tmp, spec):
    plain = spark.newSession()
    plain.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    name = "tidemark_plain_store"
    store = ChangeStore(plain, tmp, table=name, buckets=2)
    try:
        for k in range(3):
            run_once(plain, source(plain, [1, 2, 3][k:], sc.run(k)), store, sc.run(k), spec)
        assert store.stream().select("snapshotseq").distinct().count() == 3
        assert plain.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    finally:
        plain.sql(f"DROP TABLE IF EXISTS {name}")


def test_age_scoped_sweep_finds_the_normalised_column(spark, tmp, spec):
    store = ChangeStore(spark, tmp)
    run_once(spark, source(spark, [1, 2, 3], sc.run(0)), store, sc.run(0), spec)
    silver = scd.change_stream_scd2(store.stream()).withColumnRenamed("event_ts", "eventts")
    out = run_once(spark, source(spark, [1, 2, 3], sc.run(1)), store, sc.run(1), spec,
                   SweepSpec(enabled=True, max_age_days=30), silver)
    assert out["sweep_status"] == "completed"


@pytest.mark.parametrize("kind", [1, 2])
def test_equal_sequences_in_any_order(spark, kind):
    rows = [(k, s, f"a{v}", v) for k in range(40) for s in (1, 2) for v in range(3)]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k long, s long, a string, v long").repartition(1 + seed)
        out = scd.scd1(df, ["k"], "s") if kind == 1 else scd.scd2(df, ["k"], "s")
        results.add(frozenset(tuple(r) for r in out.collect()))
        assert kind == 1 or out.where("__START_AT = __END_AT").isEmpty()
    assert len(results) == 1


def test_hot_key_with_a_string_sequence(spark):
    rows = [("hot", f"2024-{i:05d}", i // 7) for i in range(300)] + [("cold", "2024-00001", 1)]
    df = spark.createDataFrame(rows, "k string, s string, a long")
    hot = scd.scd2(df, ["k"], "s", hot_key_rows=50, chunks=8)
    plain = scd.scd2(df, ["k"], "s", hot_key_rows=None)
    assert hot.exceptAll(plain).isEmpty() and hot.count() == plain.count()


def test_bucket_count_is_kept(spark, tmp):
    rows = spark.createDataFrame([(i, 1, "x") for i in range(20)], "k long, s long, a string")
    ScdSink(spark, f"{tmp}/log", f"{tmp}/t", ["k"], "s", buckets=4).process(rows, 0)
    ScdSink(spark, f"{tmp}/log", f"{tmp}/t", ["k"], "s", buckets=4).process(rows, 1)
    with pytest.raises(ValueError, match="buckets"):
        ScdSink(spark, f"{tmp}/log", f"{tmp}/t", ["k"], "s", buckets=8).process(rows, 2)


def test_no_private_scratch_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session())


def test_json_lines_with_partitions_and_late_columns(spark, tmp):
    from tidemark.sources import files
    from tidemark.streaming import medallion
    for day, rows in (("2024-01-01", ['{"id": 1}', "", '{"id": "x"}']), ("2024-01-02", ['{"id": 3, "late": "kept"}'])):
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(f"{tmp}/in/dt={day}")
    src = files.FileSource(f"{tmp}/in", "json", schema_hints="id long", partition_columns=["dt"])
    medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck")
    got = spark.read.parquet(f"{tmp}/out")
    assert got.count() == 3 and got.where("dt IS NULL").isEmpty()
    assert got.where("late = 'kept'").count() == 1


@pytest.mark.parametrize("mode", ["addNewColumns", "failOnNewColumns", "rescue", "none"])
def test_evolution_mode_acts_on_the_second_delivery(spark, tmp, mode):
    from tidemark.sources import files
    from tidemark.streaming import medallion

    def deliver(row):
        spark.createDataFrame([(row,)], "value string").coalesce(1).write.mode("append").text(f"{tmp}/in")

    src = files.FileSource(f"{tmp}/in", "json", schema_evolution_mode=mode)
    deliver('{"id": 1}')
    medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck")
    deliver('{"id": 2, "late": "x"}')
    if mode == "failOnNewColumns":
        with pytest.raises(ValueError, match="late"):
            medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck")
        return
    medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck")
    medallion.ingest_bronze(spark, f"{tmp}/out", f"{tmp}/bronze", f"{tmp}/ck2")
    got = spark.read.option("mergeSchema", "true").parquet(f"{tmp}/bronze")
    assert got.count() == 2 and ("late" in got.columns) == (mode == "addNewColumns")
    if mode == "rescue":
        assert "late" in got.where("id = 2").first()["_rescued_data"]


def put(path, *ids, age_days=0):
    import os
    import time
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.writelines('{"id": %d}\n' % i for i in ids)
    when = time.time() - age_days * 86_400
    os.utime(path, (when, when))


def ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def test_overwritten_files_are_taken_again(spark, tmp):
    from tidemark.sources import files
    from tidemark.streaming import medallion
    src = files.FileSource(f"{tmp}/in", "json", allow_overwrites=True)
    put(f"{tmp}/in/a.json", 1, age_days=2)
    put(f"{tmp}/in/b.json", 2, age_days=2)
    assert medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck") == 2
    assert medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck") == 0
    put(f"{tmp}/in/a.json", 3)
    assert medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck") == 1
    assert ids(spark, f"{tmp}/out") == [1, 2, 3]
    medallion.ingest_bronze(spark, f"{tmp}/out", f"{tmp}/bronze", f"{tmp}/ck2")
    assert ids(spark, f"{tmp}/bronze") == [1, 2, 3]


@pytest.mark.parametrize("overwrites", [False, True])
def test_existing_files_are_skipped_on_the_first_start_only(spark, tmp, overwrites):
    from tidemark.sources import files
    from tidemark.streaming import medallion
    src = files.FileSource(f"{tmp}/in", "json", include_existing_files=False, allow_overwrites=overwrites,
                           max_files_per_trigger=1)
    put(f"{tmp}/in/a.json", 1)
    put(f"{tmp}/in/b.json", 2)
    medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck")
    put(f"{tmp}/in/c.json", 3)
    medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck")
    put(f"{tmp}/in/d.json", 4)
    medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck")
    assert ids(spark, f"{tmp}/out") == [3, 4]


@pytest.mark.parametrize("interval", [None, "1 day"])
def test_backfill_finds_files_with_an_old_modification_time(spark, tmp, interval):
    from tidemark.sources import files
    from tidemark.streaming import medallion
    src = files.FileSource(f"{tmp}/in", "json", backfill_interval=interval)
    put(f"{tmp}/in/a.json", 1)
    medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck")
    put(f"{tmp}/in/late.json", 2, age_days=30)
    medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck")
    assert ids(spark, f"{tmp}/out") == ([1, 2] if interval else [1])


def test_rolling_history_settings_are_checked():
    from tidemark.streaming import SilverSpec
    good = {"source_table": "loans", "federated_source": {"window_column": "updated_at"},
            "scd_2_key_list": ["rowkey"], "history_timestamp_source": "snapshotseq",
            "scd_2_exclude_list": list(scd.CHANGE_STREAM_UNTRACKED)}
    assert SilverSpec.from_config(good).keys == ("rowkey",)
    for bad in ({"scd_2_key_list": ["id"]}, {"history_timestamp_source": None},
                {"scd_2_exclude_list": good["scd_2_exclude_list"][:-1]}):
        with pytest.raises(ValueError, match=next(iter(bad))):
            SilverSpec.from_config({**good, **bad})


def test_a_retry_after_bronze_adds_nothing(spark, tmp, spec):
    from tidemark.streaming import ingest_bronze
    store = ChangeStore(spark, f"{tmp}/store")
    for k in (0, 1, 1):
        run_once(spark, source(spark, [1, 2, 3][k:], sc.run(k)), store, sc.run(k), spec)
        ingest_bronze(spark, store.stream_path, f"{tmp}/bronze", f"{tmp}/ck")
    assert spark.read.parquet(f"{tmp}/bronze").count() == store.stream().count()


def test_a_retried_sweep_closes_each_key_once(spark, tmp, spec):
    store, now = ChangeStore(spark, tmp), sc.run(30)
    run_once(spark, source(spark, range(40), sc.run(0)), store, sc.run(0), spec)
    silver = scd.change_stream_scd2(store.stream())
    kept = spark.createDataFrame([(i, sc.run(0).ts, f"v{i}") for i in range(39)], ROWS)
    with pytest.raises(ValueError):
        run_once(spark, kept, store, now, spec, SweepSpec(enabled=True, max_delete_pct=1.0), silver)
    for _ in range(2):
        out = run_once(spark, kept, store, now, spec, SweepSpec(enabled=True), silver)
        assert (out["sweep_status"], out["reconciles"]) == ("completed", 1)
    assert store.stream().where("changetype = 'reconcile'").count() == 1
