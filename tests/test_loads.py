from datetime import datetime

from tidemark.functions.names import normalize_identifier, normalized_mapping
from tidemark.operators import project
from tidemark.session import RunStamp
from tidemark.sources import incremental

import pytest

RUN = RunStamp(datetime(2024, 1, 1))


def test_empty_delta_does_not_reset_mark(spark):
    src = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "id int, t timestamp_ntz")
    first = incremental.incremental_load(src, RUN, None, column="t")
    mark = incremental.last_watermark(first, "t")
    second = incremental.incremental_load(src, RUN, mark, column="t")
    assert second.count() == 0
    public = first.unionByName(second)                 # marks come from the public table
    third = incremental.incremental_load(src, RUN, incremental.last_watermark(public, "t"), column="t")
    assert third.count() == 0


def test_watermark_column_survives_select(spark):
    src = spark.createDataFrame([(1, 10, "a")], "id int, w int, x string")
    out = incremental.incremental_load(src, RUN, None, column="w", select=["id"])
    assert out.columns[:2] == ["id", "w"]
    out = incremental.incremental_load(src, RUN, None, expression="w * 2", select=["id"])
    assert "_federated_watermark" in out.columns


def test_exactly_one_watermark_source(spark):
    src = spark.createDataFrame([(1,)], "w int")
    with pytest.raises(ValueError):
        incremental.incremental_load(src, RUN, None, column="w", expression="w")


def test_incremental_golden(spark):
    from tests.conftest import SF
    o = spark.read.parquet(f"{SF}/orders.parquet")
    first = incremental.incremental_load(o.where("o_orderdate <= TIMESTAMP_NTZ'2000-12-31 00:00:00'"), RUN, None,
                                         column="o_orderdate")
    mark = incremental.last_watermark(first, "o_orderdate")
    delta = incremental.incremental_load(o, RUN, mark, column="o_orderdate")
    assert (first.count(), delta.count()) == (1378, 122)
    assert incremental.last_watermark(first.unionByName(delta), "o_orderdate").startswith("2001-08-01")


def test_name_collision_raises():
    assert normalize_identifier("payment_id") == "paymentid"
    with pytest.raises(ValueError):
        normalized_mapping(["a_b", "ab"])


def test_projection_resolves_names(spark):
    df = spark.createDataFrame([(1, "x")], "c_id int, c_name string")
    p = project.project(df, [{"name": "c_id", "rename": "Customer ID"}, {"name": "c_name"}])
    assert p.df.columns == ["CustomerID", "cname"]
    assert p.resolve("c_id") == "CustomerID" and p.resolve("Customer ID") == "CustomerID"
    star = project.project(df.withColumn("_meta", df.c_id), None)
    assert star.df.columns == ["cid", "cname", "_meta"]


def test_persisted_incremental_survives_empty_delta(spark, tmp):
    src = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "id int, t timestamp_ntz")
    r = [RUN.plus(days=i) for i in range(4)]
    assert incremental.run_load(spark, src, tmp, r[0], "incremental", column="t")["rows"] == 2
    assert incremental.run_load(spark, src, tmp, r[1], "incremental", column="t")["rows"] == 0
    grown = src.unionByName(spark.createDataFrame([(3, datetime(2024, 1, 3))], "id int, t timestamp_ntz"))
    out = incremental.run_load(spark, grown, tmp, r[2], "incremental", column="t")
    assert out["rows"] == 1 and out["mark"].startswith("2024-01-02")
    # a retried run replaces its own partition
    incremental.run_load(spark, grown, tmp, r[2], "incremental", column="t")
    assert spark.read.parquet(tmp).count() == 3
    full = incremental.run_load(spark, grown, f"{tmp}-full", r[3], "full")
    assert full["rows"] == 3
