"""Plan-shape regression tests for the scale claims in the README."""

import re

from tidemark.operators import quality, rolling, scd
from tidemark.plans import scenario as sc
from tidemark.session import RunStamp
from tests.conftest import SF


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    """``explain("formatted")`` text: node details are printed untruncated."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_scd2_is_one_shuffle_on_the_key(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    plan = physical(scd.scd2(ev, ["user_id"], "ts", track=["event_type"], hot_key_rows=None))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^,]+)", plan)
    assert len(exchanges) == 1 and exchanges[0].startswith("user_id")


def test_window_bound_reaches_the_parquet_scan(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    snap = rolling.snapshot(sc.foreign(ev, 0), sc.run(0), sc.SPEC)
    plan = formatted(snap)
    assert "GreaterThanOrEqual(ts,2024-01-21T00:00)" in plan
    assert "LessThan(ts,2024-01-28T06:00)" in plan


def test_dq_quarantine_is_one_codegen_stage_without_shuffle(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    from tidemark.plans.catalog import DQ_RULES
    q = quality.quarantine(o, DQ_RULES, "orders", RunStamp.parse("2024-01-01 00:00:00"))
    plan = physical(q)
    assert "Exchange" not in plan
    assert re.search(r"\*\(\d+\) Filter", plan) and re.search(r"\*\(\d+\) Project", plan)


def test_scan_reads_only_needed_columns(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    snap = rolling.snapshot(li.select("l_returnflag", "l_linestatus", "l_shipdate"), sc.run(0),
                            rolling.RollingSpec(window_column="l_shipdate", days=7))
    plan = physical(snap)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(set(s.split(",")) <= {"l_returnflag:string", "l_linestatus:string",
                                                  "l_shipdate:timestamp_ntz"} for s in schemas)


def test_bucketed_snapshots_anti_join_without_shuffle(spark, tmp):
    from tidemark.sources import tables
    ev = spark.read.parquet(f"{SF}/events.parquet")
    snaps = [tables.write_bucketed(rolling.snapshot(sc.foreign(ev, k), sc.run(k), sc.SPEC),
                                   f"tidemark_bucket_snap{k}", f"{tmp}/s{k}", "rowkey", 8) for k in (0, 1)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")       # force the large-table path
    try:
        dels = rolling.detect_deletes(snaps[1], snaps[0], sc.run(1), sc.SPEC)
        plan = physical(dels)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert dels.count() == 4                                           # FIXTURES §3, sf0.001
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
