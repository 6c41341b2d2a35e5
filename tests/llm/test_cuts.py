"""Where the mix cuts a source's stream: inside repeated rows, with many sources, without moving texts."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, sharding


def totals(out):
    taken, target, size = Counter(), {}, {}
    for r in out:
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
    return taken, target, size


@pytest.mark.parametrize("hot_id", [9, None])
@pytest.mark.parametrize("carry", [True, False])
def test_cut_inside_repeated_rows(spark, hot_id, carry):
    rows = [(hot_id, "five words in every row", "a")] * 1001 + [(i, "w " * (i % 7), "b") for i in range(2000)]
    docs = spark.sparkContext.parallelize(rows, 8).toDF("doc_id long, text string, source string")
    out = mixing.mix(docs, carry=carry).collect()
    assert len(out) == len(rows)
    hot = [r for r in out if r.source_size == 5005]
    whole, rest = divmod(math.floor(hot[0].target), 5005)
    full, part = divmod(rest, 5)
    assert rest and Counter(r.taken - 5 * whole for r in hot) == Counter({5: full, part: 1, 0: 1000 - full} if part
                                                                         else {5: full, 0: 1001 - full})
    assert sum(r.copies for r in hot) == 1001 * whole + full + (2 * part >= 5)


@pytest.mark.parametrize("most", [0, 50_000])
def test_shuffled_and_broadcast_sources_agree(spark, most):
    rows = [(i if i % 11 else None, "w " * (i % 9), None if i % 40 == 0 else f"s{i % 40}") for i in range(4000)]
    docs = spark.sparkContext.parallelize(rows, 5).toDF("doc_id long, text string, source string")
    taken, target, size = totals(mixing.mix(docs, broadcast_sources=most).collect())
    assert len(target) == 40 and sum(size.values()) == sum(i % 9 for i in range(4000))
    assert all(taken[s] == math.floor(target[s] + 1e-9) for s in target)


def test_no_text_is_shuffled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = mixing.mixed_rows(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_sharding_counts_need_no_second_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    narrow, whole = sharding.shard(docs, keep=["doc_id"]), sharding.shard(docs)
    assert "parquet" not in narrow._jdf.queryExecution().executedPlan().toString()
    same = ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert narrow.select(same).exceptAll(whole.select(same)).isEmpty() and narrow.count() == docs.count()


def test_sources_without_words_or_rows(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).collect() == []
    assert sharding.shard(spark.createDataFrame([], schema)).collect() == []
    out = mixing.mix(spark.createDataFrame([(1, None, "a"), (1, None, "a"), (2, " ", None)], schema))
    assert [(r.taken, r.target) for r in out.collect()] == [(0, 0.0)] * 3
    assert out.filter(F.col("source_size") != 0).isEmpty()
