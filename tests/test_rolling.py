from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import rolling
from tidemark.session import RunStamp

SPEC = rolling.RollingSpec(window_column="ts", days=7)
R0 = RunStamp(datetime(2024, 1, 28, 6))
R1 = R0.plus(days=1)


def frame(spark, rows):
    return spark.createDataFrame([(v, t) for v, t in rows], "v string, ts timestamp_ntz")


def test_window_edge_is_inclusive(spark):
    ws = R0.window_start(7)
    snap = rolling.snapshot(frame(spark, [("edge", ws), ("before", ws - timedelta(seconds=1))]), R0, SPEC)
    assert [r.v for r in snap.collect()] == ["edge"]


def test_aged_out_row_is_not_deleted(spark):
    ws1 = R1.window_start(7)
    rows0 = [("old", ws1 - timedelta(seconds=1)), ("gone", ws1 + timedelta(hours=1)), ("stay", ws1 + timedelta(hours=2))]
    s0 = rolling.snapshot(frame(spark, rows0), R0, SPEC)
    s1 = rolling.snapshot(frame(spark, [rows0[2]]), R1, SPEC)
    dels = rolling.detect_deletes(s1, s0, R1, SPEC).collect()
    assert [r.v for r in dels] == ["gone"]
    d = dels[0]
    assert d.changetype == "delete" and d.isdeleted and d.snapshotseq == R1.seq
    assert [r.v for r in rolling.aged_out(s1, s0, R1, SPEC).collect()] == ["old"]


def test_multiset_delete_tombstones_last_copy(spark):
    t = R0.ts - timedelta(days=1)
    s0 = rolling.snapshot(frame(spark, [("x", t)] * 3), R0, SPEC)
    s1 = rolling.snapshot(frame(spark, [("x", t)] * 2), R1, SPEC)
    dels = rolling.detect_deletes(s1, s0, R1, SPEC).collect()
    assert [(r.v, r.rowoccurrence) for r in dels] == [("x", 3)]


def test_first_run_has_no_deletes(spark):
    s0 = rolling.snapshot(frame(spark, [("x", R0.ts)]), R0, SPEC)
    assert rolling.detect_deletes(s0, None, R0, SPEC).count() == 0


def test_window_bounds_and_anchor():
    r = RunStamp(datetime(2024, 1, 28, 6, 30, 15))
    assert r.window_start(7) == datetime(2024, 1, 21)
    assert r.window_start(7, "run_time") == datetime(2024, 1, 21, 6, 30, 15)
    assert r.seq == 1706423415000


def test_date_window_column_pushes_native_compare(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 21).date()), (2, datetime(2024, 1, 20).date())],
                               "id int, d date")
    got = rolling.read_window(df, "d", datetime(2024, 1, 21)).collect()
    assert [r.id for r in got] == [1]
    got = rolling.read_window(df, "d", datetime(2024, 1, 20, 6)).collect()   # ceil to next day
    assert [r.id for r in got] == [1]


def test_scenario_golden_counts(spark):
    from tests.conftest import SF
    from tidemark.plans import scenario as sc
    s = sc.Scenario(spark.read.parquet(f"{SF}/events.parquet"))
    assert [s.snap(k).count() for k in range(3)] == [214, 206, 197]
    assert [s.dels(k).count() for k in (1, 2)] == [4, 3]
    assert s.silver(2).count() == 280


def test_window_bound_on_ltz_and_string_columns(spark):
    ws = datetime(2024, 1, 21)
    ltz = spark.createDataFrame([(1, "2024-01-21 00:00:00"), (2, "2024-01-20 23:59:59")], "id int, s string") \
        .selectExpr("id", "to_timestamp(s) AS t", "s")
    assert [r.id for r in rolling.read_window(ltz, "t", ws).collect()] == [1]      # session zone is UTC
    assert [r.id for r in rolling.read_window(ltz, "s", ws).collect()] == [1]      # string: cast fallback
    with_null = ltz.unionByName(spark.createDataFrame([(3, None, None)], "id int, t timestamp, s string"))
    assert sorted(r.id for r in rolling.read_window(with_null, "t", None).collect()) == [1, 2]
