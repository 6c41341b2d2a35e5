import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scd

SCHEMA = "k string, seq int, state string, payload int"


def versions(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = scd.scd2(df, ["k"], "seq", **kw).orderBy("k", "__START_AT").collect()
    return [(r.k, r.state, r.payload, r["__START_AT"], r["__END_AT"]) for r in out]


def test_untracked_change_updates_in_place(spark):
    got = versions(spark, [("a", 1, "s", 10), ("a", 2, "s", 20)], track=["state"])
    assert got == [("a", "s", 20, 1, None)]


def test_reappearance_opens_fresh_version(spark):
    rows = [("a", 1, "live", 1), ("a", 2, "deleted", 1), ("a", 3, "live", 1)]
    got = versions(spark, rows, track=["state"])
    assert [(g[1], g[3], g[4]) for g in got] == [("live", 1, 2), ("deleted", 2, 3), ("live", 3, None)]


def test_late_event_splits_island(spark):
    rows = [("a", 1, "A", 0), ("a", 5, "A", 0), ("a", 3, "B", 0)]
    got = versions(spark, rows, track=["state"])
    assert [(g[1], g[3], g[4]) for g in got] == [("A", 1, 3), ("B", 3, 5), ("A", 5, None)]


def test_order_invariance_and_non_overlap(spark):
    rnd = random.Random(7)
    rows = [(f"k{rnd.randint(0, 5)}", s, rnd.choice("xyz"), rnd.randint(0, 3)) for s in range(200)]
    base = versions(spark, rows, track=["state"])
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, SCHEMA).repartition(5)
    again = scd.scd2(df, ["k"], "seq", track=["state"]).orderBy("k", "__START_AT").collect()
    assert base == [(r.k, r.state, r.payload, r["__START_AT"], r["__END_AT"]) for r in again]
    by_key = {}
    for k, _, _, s, e in base:
        by_key.setdefault(k, []).append((s, e))
    for spans in by_key.values():
        assert sum(e is None for _, e in spans) == 1
        for (s1, e1), (s2, _) in zip(spans, spans[1:]):
            assert e1 == s2 and s1 < s2


def test_same_sequence_tie_break(spark):
    df = spark.createDataFrame([("a", 1, "upsert", 0), ("a", 1, "reconcile", 0)], SCHEMA)
    prio = F.when(F.col("state") == "upsert", 2).otherwise(1)
    out = scd.scd2(df, ["k"], "seq", track=["state"], tie_break=prio).collect()
    assert [r.state for r in out] == ["upsert"]


def test_null_key_fails(spark):
    df = spark.createDataFrame([(None, 1, "x", 0)], SCHEMA)
    with pytest.raises(Exception):
        scd.scd2(df, ["k"], "seq").collect()


def test_scd1_equals_open_scd2_rows(spark):
    rnd = random.Random(3)
    rows = [(f"k{rnd.randint(0, 9)}", s, rnd.choice("xy"), rnd.randint(0, 9)) for s in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    s1 = sorted(map(tuple, scd.scd1(df, ["k"], "seq").collect()))
    s2 = scd.scd2(df, ["k"], "seq").where("__END_AT IS NULL").drop("__START_AT", "__END_AT")
    assert s1 == sorted(map(tuple, s2.collect()))


def test_except_columns_dropped_and_lifespan(spark):
    df = spark.createDataFrame([("a", 1, "x", 0), ("a", 4, "y", 0)], SCHEMA)
    out = scd.scd2(df, ["k"], "seq", track=["state"], except_columns=["payload"])
    assert "payload" not in out.columns
    assert [r.lifespan for r in scd.lifespan(out).collect()] == [3]


def test_events_golden(spark):
    from tests.conftest import SF
    ev = spark.read.parquet(f"{SF}/events.parquet")
    out = scd.scd2(ev, ["user_id"], "ts", track=["event_type"])
    assert out.count() == 802 and out.where("__END_AT IS NULL").count() == 15


def _rows_sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_hot_key_chunked_path_matches_plain(spark):
    rnd = random.Random(5)
    rows = []
    for s in range(3000):                       # key 'hot' holds ~80 % of rows, many ties
        k = "hot" if rnd.random() < 0.8 else f"k{rnd.randint(0, 20)}"
        rows.append((k, rnd.randint(0, 900), rnd.choice("xxxyz"), s))     # payload: unique tie-break
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    prio = F.col("payload")
    plain = scd.scd2(df, ["k"], "seq", track=["state"], tie_break=prio, hot_key_rows=None)
    chunked = scd.scd2(df, ["k"], "seq", track=["state"], tie_break=prio, hot_key_rows=100, chunks=16)
    assert _rows_sorted(plain) == _rows_sorted(chunked)
    # every hot-key row went through the chunked path and versions still tile time
    hot = [r for r in chunked.where("k = 'hot'").orderBy("__START_AT").collect()]
    assert all(a["__END_AT"] == b["__START_AT"] for a, b in zip(hot, hot[1:]))


def test_hot_key_timestamps(spark):
    from tests.conftest import SF
    ev = spark.read.parquet(f"{SF}/events.parquet")
    plain = scd.scd2(ev, ["user_id"], "ts", track=["event_type"], hot_key_rows=None)
    chunked = scd.scd2(ev, ["user_id"], "ts", track=["event_type"], hot_key_rows=3, chunks=8)
    assert _rows_sorted(plain) == _rows_sorted(chunked)


ALONE = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}


def test_one_key_with_iso_dates_is_spread_over_tasks(spark):
    rows = [("hot", f"2024-01-{1 + i // 1440 % 28:02d} {i // 60 % 24:02d}:{i % 60:02d}", "AB"[i // 7 % 2], i) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k string, at string, state string, payload int").repartition(8)
    before = {k: spark.conf.get(k) for k in ALONE}
    for k, v in ALONE.items():
        spark.conf.set(k, v)
    try:
        out = scd.scd2(df, ["k"], "at", track=["state"], hot_key_rows=100).withColumn("task", F.spark_partition_id())
        tasks = [r["count"] for r in out.groupBy("task").count().collect()]
        plain = scd.scd2(df, ["k"], "at", track=["state"], hot_key_rows=None)
        assert _rows_sorted(out.drop("task")) == _rows_sorted(plain)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(tasks) == 8 and max(tasks) < 0.35 * sum(tasks)


@pytest.mark.parametrize("rows_, chunks", [(1, 1000), (1, 3), (5, 7), (50, 1)])
def test_islands_across_chunks(spark, rows_, chunks):
    rnd = random.Random(rows_)
    rows = [(rnd.choice("abc"), rnd.randint(0, 60), rnd.choice("xxxxxxy"), i) for i in range(400)]
    rows += [("long", s, "same", s) for s in range(300)] + [("one", 1, "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    plain = scd.scd2(df, ["k"], "seq", track=["state"], hot_key_rows=None)
    cut = scd.scd2(df, ["k"], "seq", track=["state"], hot_key_rows=rows_, chunks=chunks)
    assert _rows_sorted(plain) == _rows_sorted(cut)
    assert cut.where("k = 'long'").count() == 1


def test_no_job_while_planning(spark):
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    df = spark.createDataFrame([("a", 1, "x", 0)] * 3, SCHEMA)
    before = jobs()
    scd.scd2(df, ["k"], "seq", track=["state"])
    assert jobs() == before


@pytest.mark.parametrize("most", [1, 2, 5, 300])
def test_rows_meet_blocks_of_cuts_and_get_the_same_chunk(spark, most):
    rnd = random.Random(most)
    rows = [(rnd.choice("aab"), rnd.randint(0, 500), "x", i) for i in range(900)] + [("c", 1, "x", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    cuts = scd._cuts(df.where("k <> 'c'"), ["k"], "seq", 2, most)
    at = {r.k: list(r._cuts) for r in cuts.collect()}
    assert sum(map(len, at.values())) == min(most, len({r[:2] for r in rows if r[1] in at.get(r[0], [])})) > 0
    got = scd._chunked(df, cuts, ["k"], "seq", most, "left").collect()
    assert len(got) == len(rows)
    assert all(r._c == sum(c <= r.seq for c in at.get(r.k, [])) for r in got)
    only = scd._chunked(df, cuts, ["k"], "seq", most, "inner").collect()
    assert len(only) == sum(r[0] in at for r in rows)


def test_no_row_is_joined_with_all_cuts_of_its_key(spark):
    from tests.test_plans import formatted
    df = spark.createDataFrame([("a", i, "x", i) for i in range(50)], SCHEMA)
    nodes = re.split(r"\n\(", formatted(scd.scd2(df, ["k"], "seq", track=["state"], hot_key_rows=2)))
    sent = [n for n in nodes if " BroadcastExchange" in n.splitlines()[0] and "Input" in n]
    assert sent and not any("_cuts#" in n for n in sent)
