import os
import time

import pytest
from pyspark.sql import functions as F

from tidemark.sources import files


def test_options_validation():
    with pytest.raises(ValueError):
        files.FileSource("/x", "xml")
    with pytest.raises(ValueError):
        files.FileSource("/x", "csv")                      # csv needs csv_options
    with pytest.raises(ValueError):
        files.FileSource("/x", "json", use_managed_file_events=True, backfill_interval="1 day")
    o = files.FileSource("/x", "csv", csv_options={"header": True, "delimiter": ";"}).reader_options()
    assert o["sep"] == ";" and o["header"] == "true" and o["multiLine"] == "false"


def test_evolution_modes(spark):
    stored = files.parse_hints(spark, "a int")
    incoming = files.parse_hints(spark, "a bigint, b string")
    assert [f.name for f in files.evolve_schema(stored, incoming, "addNewColumns").fields] == ["a", "b"]
    assert files.evolve_schema(stored, incoming, "addNewColumns")["a"].dataType.simpleString() == "int"
    assert files.evolve_schema(stored, incoming, "none") == stored
    with pytest.raises(ValueError):
        files.evolve_schema(stored, incoming, "failOnNewColumns")


def test_rescue_json(spark):
    docs = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "oops"}',), ("not json",), ('{"a": 2}',)], "value string")
    out = files.rescue(docs, "value", files.parse_hints(spark, "a int")).collect()
    assert [(r.a, r._rescued_data) for r in out] == [
        (1, '{"b":"x"}'), (None, '{"a":"oops"}'), (None, '{"_corrupt_record":"not json"}'), (2, None)]


def test_rescue_csv(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "3")], "a string, b string")
    out = files.rescue_csv(df, files.parse_hints(spark, "a int, b double")).collect()
    assert [(r.a, r.b, r._rescued_data) for r in out] == [(1, 2.5, None), (None, 3.0, '{"a":"x"}')]


def test_discovery_ledger_and_overwrites(spark, tmp):
    d = f"{tmp}/in"
    os.makedirs(d)
    for name in ("a.txt", "b.txt"):
        with open(f"{d}/{name}", "w") as fh:
            fh.write("1\n")
    src = files.FileSource(d, "text", include_existing_files=False)
    assert files.discover_files(spark, src, None).count() == 0
    ledger = files.list_files(spark, src)
    ledger.write.parquet(f"{tmp}/ledger")
    ledger = spark.read.parquet(f"{tmp}/ledger")
    time.sleep(1.1)
    with open(f"{d}/a.txt", "w") as fh:                       # rewritten in place
        fh.write("2\n")
    with open(f"{d}/c.txt", "w") as fh:
        fh.write("3\n")
    plain = {os.path.basename(r.path) for r in files.discover_files(spark, src, ledger).collect()}
    assert plain == {"c.txt"}
    src.allow_overwrites = True
    over = {os.path.basename(r.path) for r in files.discover_files(spark, src, ledger).collect()}
    assert over == {"a.txt", "c.txt"}


def test_stream_with_provenance(spark, tmp):
    from tidemark.streaming import medallion
    spark.range(0, 20).selectExpr("id", "cast(id as string) AS s").write.json(f"{tmp}/in")
    src = files.FileSource(f"{tmp}/in", "json", schema_evolution_mode="none")
    medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck")
    out = spark.read.parquet(f"{tmp}/out")
    assert out.count() == 20
    assert out.where(F.col("_source_file_name").endswith(".json") & (F.col("_source_file_size") > 0)).count() == 20


def test_ignore_corrupt_files(spark, tmp):
    spark.range(0, 10).write.parquet(f"{tmp}/in")
    with open(f"{tmp}/in/part-99999-broken.parquet", "wb") as fh:
        fh.write(b"not a parquet file")
    src = files.FileSource(f"{tmp}/in", "parquet", ignore_corrupt_files=True)
    df = spark.read.options(**src.reader_options()).schema("id bigint").parquet(f"{tmp}/in")
    assert df.count() == 10


def test_table_properties(spark, tmp):
    from tidemark.sources import tables
    spark.range(0, 3).write.parquet(f"{tmp}/t")
    tables.register_table(spark, "tidemark_props_t", f"{tmp}/t", {"quality": "silver", "source.owner": "ops"},
                          comment="silver table")
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES tidemark_props_t").collect()}
    assert props["quality"] == "silver" and props["source.owner"] == "ops"
    tables.write_properties(spark, f"{tmp}/t", {"quality": "silver"})
    assert spark.read.parquet(f"{tmp}/t").count() == 3       # sidecar is hidden from readers


def test_expectation_counters_ride_along(spark):
    from tidemark.operators import quality
    df = spark.createDataFrame([(5,), (-5,), (None,), (-1,)], "v int")
    observed, obs = quality.expectation_observation(df, [("positive", "v > 0")])
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"positive": 2}


def test_csv_rescue_through_stream(spark, tmp):
    from tidemark.streaming import medallion
    import os
    os.makedirs(f"{tmp}/in")
    with open(f"{tmp}/in/a.csv", "w") as fh:
        fh.write("id|amount\n1|2.5\nx|3\n")
    src = files.FileSource(f"{tmp}/in", "csv", csv_options={"header": True, "delimiter": "|"})
    schema = files.parse_hints(spark, "id int, amount double")
    medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck", schema)
    got = sorted(((r.id, r.amount, r._rescued_data) for r in spark.read.parquet(f"{tmp}/out").collect()),
                 key=lambda t: t[1])
    assert got == [(1, 2.5, None), (None, 3.0, '{"id":"x"}')]
