"""Streaming SCD as segments: equal to one batch over everything, bytes bounded by the batch, files skipped by range."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scd
from tidemark.sources import tables
from tidemark.streaming.scd_stream import ScdSink, read_target

SCHEMA = "k string, s int, state string, v int"


def batches(seed, n, late, keys=12):
    r, rows, clock = random.Random(seed), [], 0
    for b in range(n):
        one = []
        for _ in range(r.randint(0, 25)):
            clock += r.randint(0, 1)
            at = clock - r.randint(0, 12) if r.random() < late else clock
            one.append((f"k{r.randrange(keys)}", max(0, at), r.choice("ABB"), r.randrange(99)))
        rows.append(one)
    return rows


@pytest.mark.parametrize("kind, late, compact", [(1, 0.4, 2), (2, 0.0, None), (2, 0.4, 2)])
def test_any_split_equals_one_batch(spark, tmp, kind, late, compact):
    all_rows = batches(5, 5, late)
    sink = ScdSink(spark, f"{tmp}/log", f"{tmp}/t", ["k"], "s", kind, track=["state"] if kind == 2 else None, buckets=4, compact_segments=compact)
    for i, rows in enumerate(all_rows):
        for _ in range(1 + (i % 3 == 1)):  # some batches are retried
            sink.process(spark.createDataFrame(rows, SCHEMA).repartition(3), i)
    whole = spark.createDataFrame([x for rows in all_rows for x in rows], SCHEMA)
    expected = scd.scd1(whole, ["k"], "s") if kind == 1 else scd.scd2(whole, ["k"], "s", track=["state"])
    got = read_target(spark, f"{tmp}/t").select(*expected.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    sink.compact()
    again = read_target(spark, f"{tmp}/t").select(*expected.columns)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    assert [n for n in tables.folder_names(spark, f"{tmp}/t/versions") if n.startswith("seg=")] == []


def test_bytes_of_a_batch_do_not_grow_with_the_target(spark, tmp):
    sink = ScdSink(spark, f"{tmp}/log", f"{tmp}/t", ["k"], "s", track=["state"], buckets=2, compact_segments=None)
    sizes = []
    for b in range(20):
        rows = spark.range(400).select(F.concat(F.lit("k"), (F.col("id") + 37 * b) % 3000).alias("k"), F.lit(b).alias("s"),
                                       F.concat(F.lit("st"), F.lit(b)).alias("state"), F.col("id").cast("int").alias("v"))
        sink.process(rows.coalesce(2), b)
        sizes.append(sum(tables.size(spark, f"{tmp}/t/{k}/seg={b}") for k in ("versions", "open")))
    assert max(sizes[10:]) < 2 * max(sizes[1:4])
    assert read_target(spark, f"{tmp}/t").count() == 20 * 400


def test_on_time_batches_do_not_read_the_history(spark, tmp):
    sink = ScdSink(spark, f"{tmp}/log", f"{tmp}/t", ["k"], "s", track=["state"], buckets=2)
    sink.process(spark.createDataFrame([("a", 1, "A", 0), ("b", 1, "B", 0)], SCHEMA), 0)
    tables.drop_path(spark, f"{tmp}/log/bkt=0")
    tables.drop_path(spark, f"{tmp}/log/bkt=1")   # the history is gone; on-time changes need none of it
    sink.process(spark.createDataFrame([("a", 2, "A", 7), ("b", 3, "C", 0)], SCHEMA), 1)
    got = sorted((r.k, r.state, r.v, r["__START_AT"], r["__END_AT"]) for r in read_target(spark, f"{tmp}/t").collect())
    assert got == [("a", "A", 7, 1, None), ("b", "B", 0, 1, 3), ("b", "C", 0, 3, None)]


def test_a_range_of_the_cluster_column_opens_few_files(spark, tmp):
    sink = ScdSink(spark, f"{tmp}/log", f"{tmp}/t", ["k"], "s", track=["state"], buckets=2, cluster_by=["v"])
    rows = spark.range(8000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("s"), F.lit("A").alias("state"),
                                    F.pmod(F.xxhash64("id"), F.lit(10_000)).cast("int").alias("v"))
    sink.process(rows, 0)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sink.compact()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    whole, some = read_target(spark, f"{tmp}/t"), read_target(spark, f"{tmp}/t", ("v", 100, 600))
    assert len(whole.inputFiles()) == 8 and 1 <= len(some.inputFiles()) <= 2
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.where("v BETWEEN 100 AND 600").collect()))
    # A row that a later segment moves out of the range, or into it, is judged by its last values.
    moved = [("0", 2, "A", 300), (some.first().k, 2, "A", 9999)]
    sink.process(spark.createDataFrame(moved, SCHEMA), 1)
    some, whole = read_target(spark, f"{tmp}/t", ("v", 100, 600)), read_target(spark, f"{tmp}/t")
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.where("v BETWEEN 100 AND 600").collect()))


def test_late_histories_are_versioned_once_with_and_once_without_the_batch(spark, tmp):
    from pyspark.sql import DataFrame
    sink = ScdSink(spark, f"{tmp}/log", f"{tmp}/t", ["k"], "s", track=["state"], buckets=2, compact_segments=None)
    sink.process(spark.createDataFrame([("a", 1, "A", 0), ("a", 5, "B", 1), ("a", 9, "A", 2), ("b", 1, "A", 0)], SCHEMA), 0)
    seen = []
    versions = sink.versions
    sink.versions = lambda changes: seen.append(changes) or versions(changes)
    plans = []
    rewritten = sink._rewritten
    sink._rewritten = lambda *a: plans.append(rewritten(*a)) or plans[-1]
    sink.process(spark.createDataFrame([("a", 3, "B", 7), ("a", 7, "A", 8), ("c", 2, "A", 0)], SCHEMA), 1)
    assert len(seen) == 3 and len(plans) == 1 and isinstance(plans[0], DataFrame)  # on time, with, without
    text = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    # Each history is folded once: one aggregate of islands for each of the two.
    assert len([x for x in text.splitlines() if "max_by(" in x and "Aggregate" in x and "_last" in x]) == 2
    got = sorted((r.k, r.state, r.v, r["__START_AT"], r["__END_AT"]) for r in read_target(spark, f"{tmp}/t").collect())
    assert got == [("a", "A", 0, 1, 3), ("a", "A", 2, 7, None), ("a", "B", 1, 3, 7), ("b", "A", 0, 1, None), ("c", "A", 0, 2, None)]
    sink.versions, sink._rewritten = versions, rewritten
    sink.process(spark.createDataFrame([("a", 5, "B", 1)], SCHEMA), 2)  # nothing changes
    assert read_target(spark, f"{tmp}/t").count() == 5
