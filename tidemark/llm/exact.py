"""Exact deduplication through content-defined chunk recipes.

A text is normalised (each run of ASCII white space becomes one space) and cut
where a rolling hash of the last 32 bytes has its top bits clear, so equal
passages are cut alike wherever they stand. A chunk's identifier is a digest of
its bytes, used only once it is verified: the distinct chunks of the whole table
meet by digest, each moved at most once a task, and their bytes must agree. If
two different chunks share a digest, the digests are made twice as long and
verified anew. A document's recipe is the ordered list of its identifiers, as
bytes of fixed width each, and documents are equal exactly if their recipes are.
From there only recipes move, never texts.

A group of equal texts may hold a third of all rows: rows are counted inside
(recipe, input split) first, and the totals return to the rows by the same key,
so no task meets more of a group than one split holds.

Defined results: null is empty, and empty texts are equal to each other; a text
of white space alone is one space. Of equal texts the row with the smallest id
stays, null ids last, and exactly one row of several with that id; repeated rows
count as often as they occur; an empty table gives no rows. Texts of any length
are cut whole. Input columns may have any name; columns that the operator
returns replace those of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, nest, table, unnest

#: Fewest, usual and most bytes of a chunk (the usual number is a power of two).
LEAST, USUAL, MOST = 512, 2048, 16384


def gear() -> np.ndarray:
    """A 32-bit value for each byte, by the multiply-and-shift mixing of its number."""
    x = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(27))) >> np.uint64(32)).astype(np.uint32)


def normalised(text: bytes) -> bytes:
    """Runs of the six ASCII white-space bytes as one space each, at the ends too."""
    if not text:
        return b""
    inner = b" ".join(text.split())
    if not inner:
        return b" "
    return (b" " if text[:1].isspace() else b"") + inner + (b" " if text[-1:].isspace() else b"")


def ends(data: bytes, table_: np.ndarray, least: int = LEAST, usual: int = USUAL, most: int = MOST) -> list[int]:
    """End offsets of the chunks of ``data``."""
    out, start, n = [], 0, len(data)
    marks: list[int] = []
    if n > least:
        h = table_[np.frombuffer(data, np.uint8)]
        for step in (1, 2, 4, 8, 16):  # after each, h[i] covers the last 2 * step bytes
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        marks = (np.flatnonzero(h < (1 << 32) // usual) + 1).tolist()
    for at in [*marks, n]:
        while at - start > most:
            start += most
            out.append(start)
        if at - start >= least or (at == n and at > start):
            out.append(at)
            start = at
    return out


def chunks(data: bytes, table_: np.ndarray, digest_bytes: int, sizes: tuple[int, int, int]) -> Iterator[tuple[bytes, bytes]]:
    """(digest, bytes) of every chunk, in order."""
    start = 0
    for end in ends(data, table_, *sizes):
        piece = data[start:end]
        yield hashlib.blake2b(piece, digest_size=digest_bytes).digest(), piece
        start = end


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")


def distinct_chunks(docs: DataFrame, text_col: str, digest_bytes: int, sizes: tuple[int, int, int] = (LEAST, USUAL, MOST),
                    flush_bytes: int = 8 << 20) -> DataFrame:
    """(digest, content) of all texts, each pair once; copies meet in each task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, bytes] = {}
        mixed: list[tuple[bytes, bytes]] = []  # different bytes under a digest that is held already
        size, values = 0, gear()

        def emit() -> pa.RecordBatch:
            rows = [*held.items(), *mixed]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)],
                                              ["digest", "content"])

        for batch in batches:
            for text in batch.column(0):
                for digest, piece in chunks(normalised(text.as_py()), values, digest_bytes, sizes):
                    old = held.setdefault(digest, piece)
                    if old is piece:
                        size += len(piece)
                    elif old != piece:
                        mixed.append((digest, piece))
                        size += len(piece)
                if size >= flush_bytes:
                    yield emit()
                    held, mixed, size = {}, [], 0
        if held:
            yield emit()
    found = docs.select(_text(text_col).alias("text")).mapInArrow(run, "digest binary, content binary")
    return found.distinct()


def verified_width(docs: DataFrame, *, text_col: str = "text", digest_bytes: int = 16,
                   sizes: tuple[int, int, int] = (LEAST, USUAL, MOST)) -> int:
    """The first digest length, doubling from ``digest_bytes``, at which equal digests mean equal chunks."""
    while True:
        clash = (distinct_chunks(docs, text_col, digest_bytes, sizes).groupBy("digest").agg(F.count("*").alias("n"))
                 .filter("n > 1"))
        if not clash.take(1):
            return digest_bytes
        if digest_bytes >= 64:
            raise ValueError("different chunks share a digest of 64 bytes")
        digest_bytes *= 2


def recipe_udf(digest_bytes: int, sizes: tuple[int, int, int]):
    @F.pandas_udf("recipe: binary, n_chunks: int, text_sha256: string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        values = gear()
        for texts in batches:
            out = []
            for text in texts:
                data = normalised(text)
                ids = [d for d, _ in chunks(data, values, digest_bytes, sizes)]
                out.append((b"".join(ids), len(ids), hashlib.sha256(data).hexdigest()))
            yield pd.DataFrame(out, columns=["recipe", "n_chunks", "text_sha256"])
    return run


def mark_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None,
                digest_bytes: int = 16, sizes: tuple[int, int, int] = (LEAST, USUAL, MOST)) -> DataFrame:
    """``columns`` of every row (all but the text unless given) with keep_id, group_size, kept, n_chunks and text_sha256."""
    columns = [c for c in docs.columns if c != text_col] if columns is None else columns
    width = verified_width(docs, text_col=text_col, digest_bytes=digest_bytes, sizes=sizes)
    rows = nest(docs, columns, _id=F.col(id_col), _r=recipe_udf(width, sizes)(_text(text_col)),
                _at=F.monotonically_increasing_id(), _split=F.spark_partition_id())
    rows = cut(rows.select("*", F.col("_r.recipe").alias("_recipe")))
    best = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_at").alias("at"))
    parts = rows.groupBy("_recipe", "_split").agg(F.count("*").alias("_n"), F.min(best).alias("_best"))
    whole = parts.groupBy("_recipe").agg(F.sum("_n").alias("_size"), F.min("_best").alias("_first"))
    known = parts.select("_recipe", "_split").join(whole, "_recipe")
    return unnest(rows.join(known, ["_recipe", "_split"]), columns, keep_id=F.col("_first.id"), group_size=F.col("_size"),
                  kept=F.col("_at") == F.col("_first.at"), n_chunks=F.col("_r.n_chunks"),
                  text_sha256=F.col("_r.text_sha256"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One whole row of each group of equal texts, unchanged."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col(options.pop("id_col", "doc_id")).alias("doc_id"), F.col(options.pop("text_col", "text")).alias("text"))
    return mark_copies(packed, columns=["row"], **options).filter("kept").select("row.*")


def op13_exact_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mark_copies(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n
"""
