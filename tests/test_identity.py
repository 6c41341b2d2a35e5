from pyspark.sql import functions as F

from tidemark.functions.hashing import row_hash
from tidemark.operators.identity import add_identity


def test_hash_ignores_column_order(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = a.select("b", "a")
    assert a.select(row_hash(a.columns)).first()[0] == b.select(row_hash(b.columns)).first()[0]


def test_null_and_empty_string_differ(spark):
    df = spark.createDataFrame([(None,), ("",)], "s string")
    hashes = {r[0] for r in df.select(row_hash(["s"])).collect()}
    assert len(hashes) == 2


def test_separator_collision_is_accepted(spark):
    df = spark.createDataFrame([("a", "b||c"), ("a||b", "c")], "x string, y string")
    hashes = {r[0] for r in df.select(row_hash(["x", "y"])).collect()}
    assert len(hashes) == 1


def test_reserved_column_rejected(spark):
    import pytest
    df = spark.createDataFrame([(1,)], "rowkey int")
    with pytest.raises(ValueError):
        add_identity(df)


def test_occurrences_are_1_to_n_across_many_partitions(spark):
    # one hot duplicate spread over 16 input partitions + some unique rows
    hot = spark.range(0, 4000).select(F.lit("hot").alias("v")).repartition(16)
    other = spark.range(0, 100).select(F.col("id").cast("string").alias("v"))
    out = add_identity(hot.unionByName(other))
    got = out.where("v = 'hot'").agg(F.min("rowoccurrence"), F.max("rowoccurrence"),
                                     F.countDistinct("rowkey"), F.count("*")).first()
    assert tuple(got) == (1, 4000, 4000, 4000)
    assert out.where("v <> 'hot'").agg(F.max("rowoccurrence")).first()[0] == 1


def test_key_columns_numbering_follows_contenthash(spark):
    rows = [(1, "a", i) for i in range(50)] + [(2, "b", 0)]
    df = spark.createDataFrame(rows, "k int, t string, payload int").repartition(7)
    out = add_identity(df, mode="key_columns", key_columns=["k"], with_contenthash=True)
    got = [r["rowoccurrence"] for r in out.where("k = 1").orderBy("contenthash").collect()]
    assert got == list(range(1, 51))


def test_rowkey_diff_equals_except_all(spark):
    prior = spark.createDataFrame([("x",), ("x",), ("x",), ("y",), ("z",)], "v string")
    cur = spark.createDataFrame([("x",), ("x",), ("z",)], "v string")
    p, c = add_identity(prior), add_identity(cur)
    diff = p.join(c.select("rowkey"), "rowkey", "left_anti").select("v", "rowoccurrence")
    assert sorted(map(tuple, diff.collect())) == [("x", 3), ("y", 1)]
    assert sorted(r.v for r in diff.collect()) == sorted(r.v for r in prior.exceptAll(cur).collect())


def test_matches_orders_golden_duplicates(spark):
    from tests.conftest import SF
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_returnflag", "l_linestatus", "l_shipdate")
    out = add_identity(li)
    r = out.agg(F.count("*"), F.max("rowoccurrence"), F.count_if(F.col("rowoccurrence") > 1)).first()
    assert tuple(r) == (6000, 5, 1049)          # FIXTURES §4


def test_equal_rows_are_dealt_once_and_without_their_fingerprint(spark, tmp):
    spark.range(0, 400).selectExpr("CAST(id % 150 AS STRING) AS v", "id % 3 AS n").write.parquet(tmp)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = add_identity(spark.read.parquet(tmp))
        plan = out._jdf.queryExecution().executedPlan()
        found = [plan.toString()]
        dealt = [line for line in found[0].splitlines() if "Exchange hashpartitioning" in line]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    # The rows' shuffle is reused for the group sizes; the two others move sizes by digest, none moves rowhash.
    assert "ReusedExchange" in found[0] and len(dealt) <= 3
    assert not any("rowhash" in line for line in dealt)
    got = sorted((r.v, r.n, r.rowoccurrence, r.rowkey) for r in out.collect())
    rows, seen, expected = [(str(i % 150), i % 3) for i in range(400)], {}, []
    hashes = {(r.v, r.n): r.h for r in spark.read.parquet(tmp).withColumn("h", row_hash(["v", "n"])).collect()}
    for row in rows:
        seen[row] = seen.get(row, 0) + 1
        expected.append((*row, seen[row], f"{hashes[row]}#{seen[row]}"))
    assert got == sorted(expected)


def test_staged_rows_number_like_unstaged_ones(spark, tmp):
    rows = spark.createDataFrame([("a", None), ("a", ""), ("a", None), (None, "a"), ("a", "b||c"), ("a||b", "c")] * 9,
                                 "x string, y string").repartition(5)
    rows.write.parquet(f"{tmp}/in")
    rows = spark.read.parquet(f"{tmp}/in")
    for kw in ({}, {"with_contenthash": True}, {"allow_duplicates": False}, {"exclude_columns": ["y"], "with_contenthash": True}):
        plain, staged = add_identity(rows, **kw), add_identity(rows, stage=f"{tmp}/{len(kw)}{'exclude_columns' in kw}{'allow_duplicates' in kw}", **kw)
        assert plain.columns == staged.columns and plain.count() == 54
        assert sorted(map(str, plain.collect())) == sorted(map(str, staged.collect()))
    assert add_identity(rows).where("x IN ('a||b', 'a') AND y IN ('c', 'b||c')").agg(F.countDistinct("rowkey")).first()[0] == 18
