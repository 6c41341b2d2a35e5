"""SimHash near-duplicate groups through covering locality-sensitive hashing.

Fingerprints. A text's ASCII capitals are lowered, its words joined to 3-word
shingles (repeats included), and each shingle hashed with XXH64 (seed 42); a
fingerprint bit is set if more than half the hashes have it. Python does this
in Arrow batches, one pass over the texts; only (id, text hash, fingerprint)
goes on.

Candidates. Every one of the 64 bit positions gets a nonzero vector of
``radius + 1`` bits, and each nonzero vector v keeps the positions whose vector
has an odd product with v. Two fingerprints that differ at no more than
``radius`` positions span at most ``radius`` dimensions, so some v is orthogonal
to all of them: the pair agrees on that mask. With radius 3 that is 15 masks
of 32 to 36 bits, and every linked pair collides in one at least, without
exceptions or probability.

Links. Distinct fingerprints (copies are folded first, with map-side combining)
meet in (mask, masked value) buckets. A bucket's members are linked by a search
that absorbs each reached fingerprint once and returns a spanning forest, never
all pairs. Buckets above ``direct`` members are split again by covering masks
over the bits that their mask left out; such a part has at most 2 ** 16
members, so no task ever holds an unbounded group and no link is lost.

Groups. Forest edges are contracted by alternating large-star and small-star
steps (joins and minima, cut through the checkpoint folder each round) until
every node points at the smallest fingerprint of its group.

Defined results: null, empty and blank texts have fingerprint 0 and link like
any other; texts of one or two words are one shingle; repeated rows share a
group; a group whose ids are all null has a null component; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, nest, table, unnest

BITS = 64
_CHUNK = 1 << 16


def fingerprint(data: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of one UTF-8 text."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()  # bytes: lowers A-Z, splits at the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, 42)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size + 1) - size - 1
    first, last = start[:len(words) - shingle + 1], (start + size)[shingle - 1:]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(first), _CHUNK):
        hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in
                           zip(first[at:at + _CHUNK].tolist(), last[at:at + _CHUNK].tolist())], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(first), bitorder="little").view("<u8")[0])


def fingerprint_udf(shingle: int):
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t.encode(), shingle) if t else 0 for t in texts], np.uint64)
                            .view(np.int64))
    return run


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over ``positions`` such that any ``radius`` of them are missed together by one mask."""
    span = 1 << (radius + 1)
    return [sum(1 << p for i, p in enumerate(positions) if ((1 + i % (span - 1)) & v).bit_count() & 1)
            for v in range(1, span)]


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the link graph on the values, as (parent, child) edges."""
    rest, edges = np.unique(values.astype(np.int64).view(np.uint64)), []
    while rest.size:
        frontier, rest = rest[:1], rest[1:]
        while frontier.size and rest.size:
            reached = []
            step = max(1, (1 << 20) // max(1, rest.size))
            for at in range(0, frontier.size, step):
                block = frontier[at:at + step]
                near = np.bitwise_count(block[:, None] ^ rest[None, :]) <= radius
                hit = near.any(0)
                if hit.any():
                    child = rest[hit]
                    edges += zip(block[near.argmax(0)[hit]].view(np.int64).tolist(), child.view(np.int64).tolist())
                    reached.append(child)
                    rest = rest[~hit]
                if not rest.size:
                    break
            frontier = np.concatenate(reached) if reached else rest[:0]
    return edges


def forest_udf(radius: int):
    @F.pandas_udf("array<struct<a: long, b: long>>")
    def run(buckets: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in buckets:
            yield pd.Series([[{"a": a, "b": b} for a, b in forest(np.asarray(v), radius)] for v in batch],
                            dtype=object)
    return run


def _masked(masks: list[int], value: str) -> Column:
    """One struct (m, k) per mask: its number and the masked value."""
    return F.expr("array(" + ", ".join(f"struct({i} AS m, {value} & {signed(m)}L AS k)"
                                       for i, m in enumerate(masks)) + ")")


def links(nodes: DataFrame, radius: int = 3, direct: int = 4096) -> DataFrame:
    """Forest edges (a, b) between the distinct fingerprints in column ``fp``."""
    masks = covering_masks(list(range(BITS)), radius)
    keyed = nodes.select("fp", F.inline(_masked(masks, "fp")))
    crowded = keyed.groupBy("m", "k").agg(F.count("*").alias("n")).filter("n > 1")
    met = keyed.join(crowded, ["m", "k"])
    inner = [covering_masks([p for p in range(BITS) if not m >> p & 1], radius) for m in masks]
    parts = F.expr("CASE m " + " ".join(
        f"WHEN {i} THEN " + "array(" + ", ".join(f"struct({j} AS m2, fp & {signed(x)}L AS k2)"
                                                 for j, x in enumerate(sub)) + ")"
        for i, sub in enumerate(inner)) + " END")
    whole = met.filter(F.col("n") <= direct).select("m", "k", F.lit(-1).alias("m2"), F.lit(0).cast("long").alias("k2"), "fp")
    split = met.filter(F.col("n") > direct).select("m", "k", F.inline(parts), "fp")
    buckets = (whole.unionByName(split).repartition("m", "k", "m2", "k2")
               .groupBy("m", "k", "m2", "k2").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1))
    return (buckets.select(F.explode(forest_udf(radius)("fps")).alias("e"))
            .select(F.least("e.a", "e.b").alias("a"), F.greatest("e.a", "e.b").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node reachable."""
    stars = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"))
    last = None
    while True:
        # Large star: every larger neighbour of a node moves to the node's smallest neighbour.
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .distinct())
        # Small star: every smaller neighbour, and the node, move to the smallest one.
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (large.join(low, "u").select(F.inline(F.expr(
            "IF(v = low, array(struct(u, low AS v)), array(struct(u, low AS v), struct(v AS u, low AS v)))")))
            .distinct())
        stars = cut(small)
        state = stars.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == last:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        last = state


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp) per row."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                       fingerprint_udf(shingle)(F.col(text_col)).alias("fp"))


def groups(marks: DataFrame, radius: int = 3, direct: int = 4096) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of ``marks`` (id, fp)."""
    nodes = cut(marks.groupBy("fp").agg(F.min("id").alias("low")))
    roots = cut(components(links(nodes, radius, direct)))
    named = (roots.join(nodes, roots.node == nodes.fp).groupBy("root").agg(F.min("low").alias("group_low"))
             .join(roots, "root"))
    return cut(nodes.join(named, nodes.fp == named.node, "left")
               .select("fp", F.coalesce("root", "fp").alias("root"),
                       F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("group_low")).alias("component_id")))


def near_duplicates(docs: DataFrame, *, shingle: int = 3, radius: int = 3, direct: int = 4096,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fingerprint, component_id, root) per row; root identifies the group."""
    marks = cut(fingerprints(docs, shingle, id_col, text_col))
    return (marks.join(groups(marks, radius, direct), "fp")
            .select("id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id", "root"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group: the first by id, then by text hash.

    The choice is made on the narrow marks; texts are shuffled once, by (id,
    text hash), which also brings exact repeats of the chosen row together.
    """
    marks = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    chosen = (marks.filter(F.col("id").eqNullSafe(F.col("component_id")))
              .groupBy("root").agg(F.min(F.struct("id", "text_hash")).alias("c"))
              .select(F.coalesce(F.col("c.id").cast("string"), F.lit("")).alias("_id"),
                      F.col("c.text_hash").alias("_hash")))
    rows = nest(docs, docs.columns, _id=F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                _hash=F.xxhash64(text_col))
    first = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy(F.lit(0)))
    return unnest(rows.join(chosen, ["_id", "_hash"], "left_semi").withColumn("_n", first).filter("_n = 1"),
                  docs.columns)


def op4_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "fingerprint", "component_id")
