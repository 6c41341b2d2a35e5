"""Files whose columns differ: read by name or by path, nothing lost; schemas inferred from new files only."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import files, tables
from tidemark.streaming import medallion

CSV = {"header": True, "delimiter": ","}


def put(path, text, opener=open):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with opener(path, "wt", encoding="utf-8") as fh:
        fh.write(text)


def ingest(spark, src, tmp, ddl=None):
    schema = files.parse_hints(spark, ddl) if ddl else None
    medallion.ingest_staging(spark, src, f"{tmp}/out", f"{tmp}/ck", schema)
    return spark.read.option("mergeSchema", "true").parquet(f"{tmp}/out")


def left(row):
    return None if row._rescued_data is None else json.loads(row._rescued_data)


def test_json_difference_by_path(spark):
    ddl = "id long, o struct<a: int, in: struct<x: string>>, l array<struct<n: int>>, m map<string,int>, v array<int>"
    docs = [
        '{"id": 1, "o": {"a": 2, "b": "lost?"}, "n": 2.5, "z": {"q": [1, null]}}',
        '{"id": 2, "o": {"a": "bad", "in": {"x": "ok", "y": true}}}',
        '{"id": 3, "l": [{"n": 1}, {"n": "two", "k": 3}, {"n": 4}]}',
        '{"id": "x", "o": [1], "l": {"n": 1}, "v": [1, "a"]}',
        '{"id": 5, "o": null, "l": [], "m": {"a": 1}, "v": [1]}',
        'no json', '[1, 2]', None, '{}']
    out = files.rescue(spark.createDataFrame([(d,) for d in docs], "value string"), "value", files.parse_hints(spark, ddl)).collect()
    assert [left(r) for r in out] == [
        {"n": 2.5, "o": {"b": "lost?"}, "z": {"q": [1, None]}}, {"o": {"a": "bad", "in": {"y": True}}},
        {"l": [None, {"n": "two", "k": 3}, None]}, {"id": "x", "o": [1], "l": {"n": 1}, "v": [1, "a"]}, None,
        {"_corrupt_record": "no json"}, {"_corrupt_record": "[1, 2]"}, None, None]
    assert out[0].o.a == 2 and out[1].o["in"].x == "ok" and [e.n for e in out[2].l] == [1, None, 4] and out[4].m == {"a": 1}


def test_json_with_a_repeated_key_keeps_the_record(spark):
    out = files.rescue(spark.createDataFrame([('{"a": 1, "a": 2}',)], "value string"), "value", files.parse_hints(spark, "a int")).first()
    assert left(out) == {"_corrupt_record": '{"a": 1, "a": 2}'}


def test_csv_headers_in_any_shape(spark, tmp):
    put(f"{tmp}/in/a.csv", "id,name,at\n1,one,2024-01-01\n")
    put(f"{tmp}/in/b.csv", "﻿name,at,id\ntwo,2024-01-02,2\n")           # reordered, with a byte order mark
    put(f"{tmp}/in/c.csv.gz", "id,extra,name\n3,more,three\nx,,four\n", gzip.open)  # unknown and missing columns, compressed
    put(f"{tmp}/in/d.csv", "id,name,Name\n5,five,again\n")                    # one name twice
    put(f"{tmp}/in/e.csv", "id,name,at\n6\n7,seven,2024-01-07,beyond\n")     # short and long lines
    put(f"{tmp}/in/f.csv", "")
    put(f"{tmp}/in/g.csv", "id,name,at\n")
    src = files.FileSource(f"{tmp}/in", "csv", csv_options=CSV, file_name_pattern="*.csv*")
    out = {(r.id, r.name): r for r in ingest(spark, src, tmp, "id int, name string, at date").collect()}
    assert len(out) == 7
    assert str(out[1, "one"]["at"]) == "2024-01-01" and str(out[2, "two"]["at"]) == "2024-01-02"
    assert left(out[1, "one"]) is None and left(out[2, "two"]) is None
    assert left(out[3, "three"]) == {"extra": "more"} and left(out[None, "four"]) == {"id": "x"}
    assert left(out[5, None]) == {"name1": "five", "Name2": "again"}
    assert left(out[6, None]) == {"_corrupt_record": "6"}
    assert left(out[7, "seven"]) == {"_corrupt_record": "7,seven,2024-01-07,beyond"}


def test_csv_without_header_by_position(spark, tmp):
    put(f"{tmp}/in/a.csv", "1,one\nx,two\n")
    src = files.FileSource(f"{tmp}/in", "csv", csv_options={"header": False})
    out = sorted(ingest(spark, src, tmp, "id int, name string").collect(), key=lambda r: r.name)
    assert [(r.id, r.name, left(r)) for r in out] == [(1, "one", None), (None, "two", {"id": "x"})]


def test_csv_inference_by_name(spark, tmp):
    put(f"{tmp}/in/a.csv", "id,n\n1,2\n")
    put(f"{tmp}/in/b.csv", "n,id,late\n2.5,7,x\n")
    src = files.FileSource(f"{tmp}/in", "csv", csv_options=CSV)
    assert files.resolve_schema(spark, src).simpleString() == "struct<id:int,n:double,late:string>"
    out = {r.id: (r.n, r.late, left(r)) for r in ingest(spark, src, tmp).collect()}
    assert out == {1: (2.0, None, None), 7: (2.5, "x", None)}


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_columnar_files_of_other_types(spark, tmp, fmt):
    def write(sql):
        spark.sql(sql).coalesce(1).write.mode("append").format(fmt).save(f"{tmp}/in")

    write("SELECT 1L AS id, 10 AS n, named_struct('a', 1, 'b', 'x') AS s, array(named_struct('k', 1)) AS l")
    src = files.FileSource(f"{tmp}/in", fmt)
    first = ingest(spark, src, tmp).first()
    assert first._rescued_data is None and first.s.b == "x"
    write("SELECT 2 AS id, 2.5D AS n, named_struct('b', 'y', 'c', true) AS s, array(named_struct('k', 'z', 'q', 1)) AS l, 'new' AS extra")
    write("SELECT 3L AS id, 7.0D AS n, 'flat' AS s")
    write("SELECT 4L AS id, binary('ab') AS n, date'2024-01-01' AS extra")
    out = {r.id: r for r in ingest(spark, src, tmp).collect()}
    assert left(out[1]) is None
    assert (out[2].n, out[2].s.a, out[2].s.b, out[2].l[0].k) == (None, None, "y", None)
    assert left(out[2]) == {"n": 2.5, "s": {"c": True}, "l": [{"k": "z", "q": 1}], "extra": "new"}
    assert out[3].n == 7 and out[3].s is None and left(out[3]) == {"s": "flat"}
    assert out[4].n is None and left(out[4]) == {"n": "YWI=", "extra": "2024-01-01"}


def test_merge_types():
    def of(a, b):
        return files.merge_types(T._parse_datatype_string(a), T._parse_datatype_string(b)).simpleString()
    assert of("int", "bigint") == "bigint" and of("double", "int") == "double" and of("float", "double") == "double"
    assert of("date", "int") == "string" and of("struct<a:int>", "struct<b:int,a:bigint>") == "struct<a:bigint,b:int>"
    assert of("array<int>", "array<string>") == "array<string>" and of("void", "date") == "date"


def opened(monkeypatch):
    """The paths that schema inference looks at, call by call."""
    seen, real = [], files._inferred

    def spy(spark, src, paths):
        seen.append(None if paths is None else sorted(os.path.basename(p) for p in paths))
        return real(spark, src, paths)
    monkeypatch.setattr(files, "_inferred", spy)
    return seen


@pytest.mark.parametrize("mode,expected", [("rescue", [None]), ("none", [None]), ("addNewColumns", [["a.json"], ["b.json"]])])
def test_a_start_opens_only_files_it_has_not_seen(spark, tmp, monkeypatch, mode, expected):
    seen = opened(monkeypatch)
    src = files.FileSource(f"{tmp}/in", "json", schema_evolution_mode=mode)
    for name, row in (("a", '{"id": 1}'), ("b", '{"id": 2, "late": "x"}')):
        put(f"{tmp}/in/{name}.json", row + "\n")
        ingest(spark, src, tmp)
    assert seen == expected
    got = ingest(spark, src, tmp)
    assert seen == expected and got.count() == 2 and ("late" in got.columns) == (mode == "addNewColumns")


def test_a_repeated_batch_replaces_itself(spark, tmp):
    put(f"{tmp}/in/a.csv", "id\n1\n")
    src = files.FileSource(f"{tmp}/in", "csv", csv_options=CSV)
    ingest(spark, src, tmp, "id int")
    put(f"{tmp}/in/b.csv", "id\n2\n")
    ingest(spark, src, tmp, "id int")
    tables.drop_path(spark, f"{tmp}/ck/commits/1")                          # the second batch's commit is lost
    tables.drop_path(spark, f"{tmp}/ck/commits/.1.crc")
    assert sorted(r.id for r in ingest(spark, src, tmp, "id int").collect()) == [1, 2]


def test_streams_by_name_are_refused(spark, tmp):
    with pytest.raises(ValueError, match="by name"):
        files.stream_files(spark, files.FileSource(tmp, "parquet"), files.parse_hints(spark, "id int"))


def test_partitioned_folders_by_name(spark, tmp):
    spark.range(2).withColumn("dt", F.lit("2024-01-01")).write.partitionBy("dt").parquet(f"{tmp}/in")
    src = files.FileSource(f"{tmp}/in", "parquet", partition_columns=["dt"])
    out = ingest(spark, src, tmp)
    spark.range(2, 3).selectExpr("id", "'x' AS extra", "'2024-01-02' AS dt").write.mode("append").partitionBy("dt").parquet(f"{tmp}/in")
    out = ingest(spark, src, tmp)
    assert sorted((r.id, str(r.dt), left(r)) for r in out.where("id < 2").collect()) == [(0, "2024-01-01", None), (1, "2024-01-01", None)]
    assert [(r.id, str(r.dt), left(r)) for r in out.where("id = 2").collect()] == [(2, "2024-01-02", {"extra": "x"})]
