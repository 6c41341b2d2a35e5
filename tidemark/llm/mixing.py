"""Mix sources to target weights (DataFrame operators only).

Each row gets a hash-random key. Keys are cut into equal ranges, and a source's
rows are ordered by (range, key), its shuffled stream. Word counts are summed
per (source, range) with map-side combining, and a prefix sum over that small
table finds the range in which the source's exact word budget ends: after
``budget // size`` whole epochs and the first ``budget % size`` words of one
more. Only that range is sorted, its repeated rows folded first, and running
sums over it give the place of the cut. Every other row lies before or after
that place by its own key, so rows meet one small record of their source and
no text is shuffled. Repeated rows that the cut divides are numbered per input
split, so that each of them is settled without meeting in one task.

Targets: sources ordered by code point (null last) take the weights of
``cycle`` in turn and share ``budget`` words (default: all words). No target
exceeds ``cap`` times its source's words; the excess goes to the others by
weight until none is above. That fixpoint is the water level

    target = least(cap * size, level * weight),  sum(target) = budget

found with two running sums over the sources ordered by cap * size / weight.

Defined results: a null text or one without words has size 0 and takes 0
words; a null source is a source of its own; a source without words has target
0; rows that agree in id and size are interchangeable, repeated rows count
each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, bucket_count, cut, key_range, nest, table, unnest, word_count

SOURCE = ["_src", "_null"]
RANGE = [*SOURCE, "_range"]
ORDER = ["_key", "_id", "_words"]


def _targets(by_source: DataFrame, cycle: Sequence[int], cap: int, budget: int | None) -> DataFrame:
    """One row per source: _size and _target."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_point = Window.orderBy("_null", "_src")
    cycle_sql = F.array(*[F.lit(float(w)) for w in cycle])
    ranked = by_source.select(
        *SOURCE, "_size",
        F.get(cycle_sql, ((F.row_number().over(by_point) - 1) % len(cycle)).cast("int")).alias("_weight"),
        (F.col("_size") * cap).cast("double").alias("_cap"),
        (F.lit(budget).cast("double") if budget is not None
         else F.sum("_size").over(everything).cast("double")).alias("_budget"))
    by_fill = Window.orderBy("_fill", "_null", "_src")
    filled = (ranked.withColumn("_fill", F.col("_cap") / F.col("_weight"))
              .withColumn("_before", F.coalesce(F.sum("_cap").over(
                  by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
              .withColumn("_open", F.sum("_weight").over(
                  by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
              .withColumn("_level", (F.col("_budget") - F.col("_before")) / F.col("_open")))
    level = F.max(F.when(F.col("_level") <= F.col("_fill"), F.col("_level"))).over(everything)
    return filled.select(*SOURCE, F.least(
        F.col("_cap"), F.coalesce(level, F.lit(float("inf"))) * F.col("_weight")).alias("_target"))


def _place() -> Column:
    """A row's place in its source's stream; nulls compare as values inside a struct."""
    return F.struct("_range", *ORDER)


def _cuts(narrow: DataFrame, cycle: Sequence[int], cap: int, budget: int | None) -> DataFrame:
    """One row per source: its size, target, whole epochs, and where the last epoch ends.

    That place is the row ``_at``, which stands ``_copies`` times and of which the
    last epoch takes ``_left`` words in all; null where the epochs come out even.
    """
    ranges = narrow.groupBy(*RANGE).agg(F.sum("_words").alias("_sum"))
    targets = _targets(ranges.groupBy(*SOURCE).agg(F.sum("_sum").alias("_size")), cycle, cap, budget)
    in_source = Window.partitionBy(*SOURCE)
    upto = (Window.unboundedPreceding, Window.currentRow)
    offsets = cut(ranges.select(*RANGE, F.sum("_sum").over(in_source).alias("_size"),
                                F.col("_sum"),
                                F.sum("_sum").over(in_source.orderBy("_range").rowsBetween(*upto)).alias("_end"))
                  .join(targets, SOURCE)
                  .withColumn("_offset", F.col("_end") - F.col("_sum"))
                  .withColumn("_budget", F.floor("_target").cast("long"))
                  .withColumn("_epochs", F.when(F.col("_size") > 0, F.expr("_budget div _size")).otherwise(F.lit(0)))
                  .withColumn("_rest", F.col("_budget") - F.col("_epochs") * F.col("_size")))
    sorted_range = Window.partitionBy(*RANGE).orderBy(*ORDER).rowsBetween(*upto)
    last = (narrow.join(offsets.filter("_offset < _rest AND _rest <= _end").select(*RANGE, "_offset", "_rest"), RANGE)
            .groupBy(*RANGE, *ORDER, "_offset", "_rest").agg(F.count("*").alias("_copies"))
            .withColumn("_upto", F.col("_offset") + F.sum(F.col("_words") * F.col("_copies")).over(sorted_range))
            .withColumn("_left", F.col("_rest") - F.col("_upto") + F.col("_words") * F.col("_copies"))
            .filter("_left > 0 AND _rest <= _upto")
            .select(*SOURCE, _place().alias("_at"), "_copies", "_left"))
    whole = offsets.groupBy(*SOURCE).agg(*[F.first(c).alias(c) for c in ("_size", "_target", "_epochs")])
    return whole.join(last, SOURCE, "left").fillna(1, ["_copies"])


def _number_equal(rows: DataFrame) -> DataFrame:
    """Add _number, which counts the rows of each source from 1 without putting them in one task."""
    rows = cut(rows).select("*", F.spark_partition_id().alias("_split"), F.monotonically_increasing_id().alias("_row"))
    before = Window.partitionBy(*SOURCE).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = (rows.groupBy(*SOURCE, "_split").agg(F.count("*").alias("_n"))
              .select(*SOURCE, "_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_earlier")))
    inside = F.row_number().over(Window.partitionBy(*SOURCE, "_split").orderBy("_row"))
    return (rows.withColumn("_inside", inside).join(splits, [*SOURCE, "_split"])
            .withColumn("_number", F.col("_earlier") + F.col("_inside")).drop("_split", "_row", "_inside", "_earlier"))


def mix(docs: DataFrame, *, cycle: Sequence[int] = (1, 2, 3), cap: int = 3, budget: int | None = None,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        carry: bool = True, broadcast_sources: int = 50_000, broadcast_bytes: int = 8 << 20) -> DataFrame:
    """Decide how many words the mix takes of every row.

    Adds size, source_size, target, taken (words, repeats counted) and copies
    (whole repeats of the row that come nearest to ``taken``). With ``carry``
    the caller's columns stay and the texts are read twice; without it only the
    id stays and they are read once. The record of each source is broadcast if
    there are at most ``broadcast_sources`` and their names hold at most
    ``broadcast_bytes``; more are joined by a shuffle.
    """
    buckets = bucket_count(docs.count())
    keep = docs.columns if carry else [id_col]
    rows = nest(docs, keep, _id=F.col(id_col), _words=word_count(F.col(text_col)),
                _src=F.coalesce(F.col(source_col), F.lit("")), _null=F.col(source_col).isNull())
    key = F.md5(F.concat_ws(":", F.col("_id").cast("string"), F.col("_words").cast("string")))
    rows = rows.withColumn("_key", key).withColumn("_range", key_range(F.col("_key"), buckets))
    narrow = cut(rows.drop(ROW) if carry else rows)
    if not carry:
        rows = narrow

    sources = cut(_cuts(narrow.select(*RANGE, *ORDER), cycle, cap, budget))
    known = sources.agg(F.count("*").alias("n"), F.sum(F.octet_length("_src")).alias("bytes"),
                        F.max("_copies").alias("copies")).first()
    if known.n <= broadcast_sources and (known.bytes or 0) <= broadcast_bytes:
        sources = F.broadcast(sources)
    rows = (rows.join(sources, SOURCE)
            .withColumn("_before", F.coalesce(_place() < F.col("_at"), F.lit(False)))
            .withColumn("_here", F.coalesce(_place() == F.col("_at"), F.lit(False))))
    divided = F.col("_here") & (F.col("_copies") > 1)
    placed = rows.withColumn("_number", F.lit(1).cast("long"))
    if (known.copies or 0) > 1:
        placed = placed.filter(~divided).unionByName(_number_equal(rows.filter(divided)))
    left = F.col("_left") - (F.col("_number") - 1) * F.col("_words")
    placed = placed.withColumn("_part", F.when(F.col("_before"), F.col("_words")).when(
        F.col("_here"), F.greatest(F.lit(0), F.least(F.col("_words"), left))).otherwise(F.lit(0)))
    nearer = F.col("_before") | ((F.col("_part") > 0) & (2 * F.col("_part") >= F.col("_words")))
    return unnest(placed, keep, size=F.col("_words"), source_size=F.col("_size"), target=F.col("_target"),
                  taken=F.col("_words") * F.col("_epochs") + F.col("_part"),
                  copies=(F.col("_epochs") + F.when(nearer, 1).otherwise(0)).cast("int"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as ``mix`` takes it, whole texts."""
    plan = mix(docs, **options)
    return plan.select(*[F.col(f"`{c}`") for c in docs.columns],
                       F.explode(F.expr("IF(copies > 0, sequence(1, copies), array())")).alias("_copy")).drop("_copy")


def op1_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), carry=False).select(
        "doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([1, 2, 3][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight,
             CAST(source_size * 3 AS DOUBLE) AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS budget FROM s),
f AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap, weight * max(CASE WHEN level <= cap / weight THEN level END) OVER ()) AS target
      FROM f),
b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
p AS (SELECT d.doc_id, d.source, d.size,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(concat_ws(':', CAST(d.doc_id AS VARCHAR), CAST(d.size AS VARCHAR))),
               d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM d)
SELECT p.doc_id, p.size, b.source_size, b.target,
       CAST(p.size * b.epochs + greatest(0, least(p.size,
         CAST(floor(b.target) AS BIGINT) - b.epochs * b.source_size - (p.run - p.size))) AS BIGINT) AS taken
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
"""
