import pytest

from tidemark.operators import quality
from tidemark.session import RunStamp

RUN = RunStamp.parse("2024-01-28 06:00:00")


def test_three_valued_logic(spark):
    df = spark.createDataFrame([(5,), (-5,), (None,)], "v int")
    rules = [("positive", "v > 0")]
    assert sorted((r.v for r in quality.gate(df, rules).collect()), key=lambda x: (x is None, x)) == [5, None]
    q = quality.quarantine(df, rules, "t", RUN).collect()
    assert [(r.v, r._failed_dq_rules) for r in q] == [(-5, ["positive"])]


def test_split_is_a_partition(spark):
    df = spark.range(0, 500).selectExpr("id", "CASE WHEN id % 7 = 0 THEN NULL ELSE id % 13 END AS v")
    rules = [("r1", "v > 3"), ("r2", "id < 400")]
    passed, failed = quality.split(df, rules, "t", RUN)
    p = {r.id for r in passed.collect()}
    f = {r.id for r in failed.collect()}
    assert p | f == set(range(500)) and not (p & f)


def test_rule_descriptions_unique(spark):
    df = spark.createDataFrame([(1,)], "v int")
    with pytest.raises(ValueError):
        quality.gate(df, [("a", "v > 0"), ("a", "v < 9")])


def test_rules_by_user_name(spark):
    df = spark.createDataFrame([(1, 5), (2, -5)], "id int, raw_v int")
    out = quality.quarantine(df, [("pos", "`user v` > 0")], "t", RUN, aliases={"user v": "raw_v"})
    assert [r.id for r in out.collect()] == [2] and "user v" not in out.columns


def test_orders_golden(spark):
    from tests.conftest import SF
    from tidemark.plans.catalog import DQ_RULES
    o = spark.read.parquet(f"{SF}/orders.parquet")
    passed, failed = quality.split(o, DQ_RULES, "orders", RUN)
    assert (passed.count(), failed.count()) == (778, 722)
    got = {r.rule: r.failed_rows for r in quality.rule_failures(o, DQ_RULES).collect()}
    assert got == {"status_final": 514, "price_over_100k": 310}
