"""Reproducible shuffle into shards (DataFrame operators only).

Rows are ordered by a hash of id and content and numbered 0..N-1 across the
cluster: the hash is cut into ranges, ranges are counted with map-side
combining, a prefix sum over the ranges (at most ``bucket_count`` rows) gives
each range its first number, and rows are numbered inside their range; many
repeats of one row, which share a hash, are numbered per input split first.

A Feistel network over pairs (left, right) in Z_a x Z_b with a * b >= N and
a, b about sqrt(N) permutes the numbers: each round adds a keyed function of
one half to the other, which is a bijection whatever the function. Values that
land at N or above walk on along their cycle until they land below N, which
restricts the bijection to 0..N-1. Fewer than a of the a * b values lie at N
or above; the longest walk among them is measured first, so a fixed number of
steps is exact. Place p then has shard p % shards and slot p // shards, so
shards differ by at most one row (law ``rows``) and slots have no gaps. Anyone
who knows N and the seed can compute a row's shard and slot from its number,
and the reverse by running the rounds backwards.

Defined results: a null text has size 16 and the checksum of an empty text;
rows that agree in id, size and checksum are interchangeable (so are repeated
rows, which count each); fewer rows than shards leave the last shards empty; an
empty table gives no rows. This law does not keep equal texts in one shard.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW, bucket_count, cut, key_range, nest, running, table, unnest

PRIME = 2_147_483_647
ROUNDS = 8


def halves(n: int) -> tuple[int, int]:
    """(a, b): the domain a * b holds n and exceeds it by less than a."""
    a = max(1, int(n ** 0.5))
    while a * a < n:
        a += 1
    return a, max(1, -(-n // a))


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    r = random.Random(seed)
    return [tuple(r.randrange(1, PRIME) for _ in range(3)) for _ in range(ROUNDS)]


def _once(value: str, a: int, b: int, seed: int) -> str:
    """SQL of one pass through the network."""
    keys = ", ".join(f"named_struct('side', {i % 2}, 'p', {p}L, 'q', {q}L, 'm', {m}L)"
                     for i, (p, q, m) in enumerate(round_keys(seed)))

    def mixed(half: str) -> str:
        return f"((({half} + k.p) * ({half} + k.q) % {PRIME}L) * k.m + k.p) % {PRIME}L"

    return (f"aggregate(array({keys}), named_struct('l', ({value}) div {b}L, 'r', ({value}) % {b}L), "
            f"(s, k) -> IF(k.side = 0, named_struct('l', (s.l + {mixed('s.r')}) % {a}L, 'r', s.r), "
            f"named_struct('l', s.l, 'r', (s.r + {mixed('s.l')}) % {b}L)), s -> s.l * {b}L + s.r)")


def longest_walk(spark: SparkSession, n: int, seed: int) -> int:
    """Most steps that a walk from below n can take at n or above.

    Values on a cycle that never falls below n are never reached from below;
    they are told by not falling in as many steps as there are values above.
    """
    a, b = halves(n)
    above, steps = a * b - n, 8
    while above:
        steps = min(steps, above)
        walked = F.expr(f"aggregate(sequence(1, {steps}), named_struct('y', id, 't', 0), (w, i) -> "
                        f"IF(w.y < {n}L, w, named_struct('y', {_once('w.y', a, b, seed)}, 't', w.t + 1)))")
        most = spark.range(n, a * b).select(walked.alias("w")).agg(
            F.max(F.when(F.col("w.y") < n, F.col("w.t"))).alias("t"), F.max("w.y").alias("y")).first()
        if most.y < n or steps == above:
            return most.t or 0
        steps *= 8
    return 0


def permuted(value: str, n: int, seed: int, walk: int) -> str:
    """SQL of the place of row number ``value`` (a column of 0..n-1)."""
    a, b = halves(n)
    return (f"aggregate(sequence(0, {walk}), {value}, (y, i) -> "
            f"IF(i > 0 AND y < {n}L, y, {_once('y', a, b, seed)}))")


def shard(docs: DataFrame, *, shards: int = 40, seed: int = 20_240_601, id_col: str = "doc_id",
          text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add size, text_crc32, law, shard, slot and grown_shard to the ``keep`` columns (default: all).

    Texts are read once if ``keep`` leaves them out, else twice: for the counts and to move the rows.
    """
    n = docs.count()
    keep = docs.columns if keep is None else keep
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = nest(docs, keep, _id=F.col(id_col), _size=(F.octet_length(text) + 16).cast("long"), _crc=F.crc32(text))
    key = F.md5(F.concat_ws(":", F.col("_id").cast("string"), F.col("_crc").cast("string")))
    rows = rows.withColumn("_key", key).withColumn("_range", key_range(F.col("_key"), bucket_count(n)))
    narrow = cut(rows.drop(ROW) if text_col in keep else rows)  # every count comes from here
    if text_col not in keep:
        rows = narrow
    first = (narrow.groupBy("_range").agg(F.count("*").alias("_n"))
             .select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(
                 Window.unboundedPreceding, -1)), F.lit(0)).alias("_first")))
    numbered = (running(rows, ["_range"], ["_key", "_id", "_size", "_crc"], F.lit(1), first, narrow)
                .withColumn("_number", F.col("_first") + F.col("_run") - 1))
    placed = numbered.withColumn("_place", F.expr(permuted(
        "_number", n, seed, longest_walk(docs.sparkSession, n, seed) if n else 0)))
    return unnest(placed, keep, size=F.col("_size"), text_crc32=F.col("_crc"), law=F.lit("rows"),
                  shard=(F.col("_place") % shards).cast("int"), slot=F.expr(f"_place div {shards}"),
                  grown_shard=F.lit(None).cast("int"))


def op8_sharding(spark, sf_dir):
    return shard(table(spark, sf_dir, "documents"), keep=["doc_id"])
