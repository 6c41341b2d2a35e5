"""Benchmark decontamination through Wu-Manber multi-pattern search.

Every window of ``window`` consecutive words of a benchmark item is a pattern;
an item of fewer words (but not none) is one pattern. Patterns of one length m
form a searcher over word numbers. A block is the last two words of the search
window (one word for m = 1). The shift table holds, for each block that occurs
in a pattern, how far the search may jump before that block could end a pattern;
a block that occurs in none jumps m - 1 words, so most of a clean text is never
looked at. At shift 0 the block's bucket lists the patterns that end in it, and
direct comparison of the words confirms occurrences.

Documents are searched in Arrow batches without a shuffle; other columns of the
row never enter Python. The benchmark is the stated pattern set: its distinct texts
are read in blocks of about ``block_bytes``, and each block is one pass over the
documents, for which it is sent to the executors, built once a worker, and dropped
again. So neither the driver nor a worker ever holds more than one block, however
large the benchmark is; with several blocks the documents are written once to the
shared folder, and only rows with occurrences leave a pass.

Defined results: null and empty texts have no words and are clean; items without
words never occur; repeated items and items that share a window all count; items
with a null id are searched like the others and count together as one item,
which stands as a null at the end of ``items``; an empty benchmark leaves every
document clean. Words are runs of a-z, 0-9 and non-ASCII characters after
lowering A-Z.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, nest, table, unnest

#: Byte table: capitals lowered, every other ASCII character outside 0-9 and a-z made a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

HITS = "n_words: long, n_hit: long, spans: array<struct<first: long, last: long>>, items: array<string>"


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


class Searcher:
    """Wu-Manber over word numbers for patterns of one length.

    A pattern is a place in a text's number list, so a window takes no copy of its words.
    """

    def __init__(self, length: int):
        self.length, self.block = length, min(2, length)
        self.most = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.bucket: dict[int, list[list]] = {}
        self._same: dict[int, list[list]] = {}  # patterns by the hash of their words, while building

    def add(self, seq: list[int], at: int, items: frozenset[str | None]) -> None:
        words_ = seq[at:at + self.length]
        alike = self._same.setdefault(hash(tuple(words_)), [])
        for pattern in alike:
            if pattern[0][pattern[1]:pattern[1] + self.length] == words_:
                pattern[2] = pattern[2] | items
                return
        pattern = [seq, at, items]
        alike.append(pattern)
        for end in range(self.block, self.length + 1):
            key = self.key(words_, end)
            self.shift[key] = min(self.shift.get(key, self.most), self.length - end)
        self.bucket.setdefault(self.key(words_, self.length), []).append(pattern)

    def built(self) -> "Searcher":
        self._same = {}
        return self

    def key(self, seq: list[int], end: int) -> int:
        """The block that ends before ``end``; never a known one if a word is unknown (-1)."""
        return seq[end - 1] if self.block == 1 else (seq[end - 2] << 32) + seq[end - 1]

    def occurrences(self, seq: list[int]) -> Iterator[tuple[int, frozenset[str | None]]]:
        """(first position, items) of every occurrence, by position."""
        shift, m, most, n, two = self.shift.get, self.length, self.most, len(seq), self.block == 2
        end = m
        while end <= n:
            key = (seq[end - 2] << 32) + seq[end - 1] if two else seq[end - 1]
            jump = shift(key, most)
            if jump:
                end += jump
                continue
            words_ = seq[end - m:end]
            for of, at, items in self.bucket[key]:
                if of[at:at + m] == words_:
                    yield end - m, items
            end += 1


class PatternSet:
    """The searchers of one block of items, and the numbers of their words."""

    def __init__(self, rows: list[tuple[str | None, str | None]], window: int):
        self.number: dict[bytes, int] = {}
        of_text: dict[str | None, set[str | None]] = defaultdict(set)
        for item, text in rows:
            of_text[text].add(item)
        by_length: dict[int, Searcher] = {}
        for text, items in of_text.items():
            seq = [self.number.setdefault(w, len(self.number)) for w in words(text)]
            m, items = min(window, len(seq)), frozenset(items)
            for at in range(len(seq) - m + 1 if m else 0):
                by_length.setdefault(m, Searcher(m)).add(seq, at, items)
        self.searchers = [by_length[m].built() for m in sorted(by_length)]

    def search(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        number = self.number.get
        seq = [number(w, -1) for w in found]
        spans, items = [], set()
        for s in self.searchers:
            for at, of in s.occurrences(seq):
                spans.append((at, at + s.length))
                items |= of
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of [first, last) spans as disjoint spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def search_udf(block, window: int):
    """``block``: broadcast of {'rows': [...]}, whose searchers stay built in the worker."""
    @F.pandas_udf(HITS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held = block.value
        built = held.setdefault("built", None) or PatternSet(held["rows"], window)
        held["built"] = built
        for texts in batches:
            out = []
            for text in texts:
                found = words(text)
                spans, items = built.search(found)
                spans = merged(spans)
                out.append((len(found), sum(b - a for a, b in spans), [{"first": a, "last": b} for a, b in spans],
                            sorted(items, key=lambda i: (i is None, i or ""))))
            yield pd.DataFrame(out, columns=["n_words", "n_hit", "spans", "items"])
    return run


def joined_udf():
    """The hits of one document's passes as one."""
    @F.pandas_udf("n_hit: long, spans: array<struct<first: long, last: long>>, items: array<string>")
    def run(spans: pd.Series, items: pd.Series) -> pd.DataFrame:
        out = []
        for some, of in zip(spans, items):
            union = merged([(x["first"], x["last"]) for x in some])
            out.append((sum(b - a for a, b in union), [{"first": a, "last": b} for a, b in union],
                        sorted(set(of), key=lambda i: (i is None, i or ""))))
        return pd.DataFrame(out, columns=["n_hit", "spans", "items"])
    return run


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """(block, t, ids) of the distinct item texts, and the number of blocks of about ``block_bytes``."""
    texts = (items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
             .groupBy("t").agg(F.collect_set(F.struct("i")).alias("ids")))
    total = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    return texts.withColumn("block", F.pmod(F.xxhash64("t"), F.lit(count))), count


def _sent(texts: DataFrame, block: int):
    """One block on the executors."""
    rows = texts.filter(F.col("block") == block).select("t", "ids").collect()
    return texts.sparkSession.sparkContext.broadcast({"rows": [(x.i, r.t) for r in rows for x in r.ids]})


def find_items(docs: DataFrame, items: DataFrame, *, window: int = 13, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 2 << 20) -> DataFrame:
    """Add n_words, n_hit, spans (disjoint word ranges [first, last)) and items (sorted ids, null last) to every row."""
    texts, count = item_blocks(items, item_col, item_text_col, block_bytes)
    columns = ("n_words", "n_hit", "spans", "items")
    if count == 1:
        rows = nest(docs, docs.columns, _hits=search_udf(_sent(texts, 0), window)(F.col(text_col)))
        return unnest(rows, docs.columns, **{c: F.col(f"_hits.{c}") for c in columns})
    texts = cut(texts)
    rows = cut(nest(docs, docs.columns, _text=F.col(text_col), _at=F.monotonically_increasing_id()))
    hits = None
    for block in range(count):
        sent = _sent(texts, block)
        found = rows.select("_at", search_udf(sent, window)("_text").alias("h"))
        if block == 0:  # every pass counts the same words
            found = cut(found)
            n_words = found.select("_at", F.col("h.n_words").alias("_n"))
        found = found.filter("h.n_hit > 0").select("_at", "h.spans", "h.items")
        found = found if block == 0 else cut(found)
        sent.destroy()
        hits = found if hits is None else hits.unionByName(found)
    whole = (hits.groupBy("_at").agg(F.flatten(F.collect_list("spans")).alias("s"), F.flatten(F.collect_list("items")).alias("i"))
             .select("_at", joined_udf()("s", "i").alias("_hits")))
    rows = rows.join(n_words, "_at").join(whole, "_at", "left")
    none = {"n_hit": F.lit(0).cast("long"), "spans": F.array().cast("array<struct<first: long, last: long>>"),
            "items": F.array().cast("array<string>")}
    return unnest(rows, docs.columns, n_words=F.col("_n"), **{c: F.coalesce(F.col(f"_hits.{c}"), x) for c, x in none.items()})


def is_contaminated(share: int = 20) -> Column:
    """At least one word in ``share`` of the document lies inside an occurrence."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def clean_rows(docs: DataFrame, items: DataFrame, *, share: int = 20, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    found = find_items(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                                   F.col(options.pop("text_col", "text")).alias("text")), items, **options)
    return found.filter(~is_contaminated(share)).select("row.*")


def op9_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_items(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        is_contaminated().alias("contaminated"))


ORACLE = r"""
WITH fold AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
sized AS (SELECT kind, id, coalesce(w, []) AS w, coalesce(len(w), 0) AS n FROM fold),
pat AS (SELECT id AS item, unnest(list_transform(range(1, n - least(n, 13) + 2), lambda i: array_to_string(w[i:i + least(n, 13) - 1], ' '))) AS p,
               least(n, 13) AS m FROM sized WHERE kind = 'b' AND n > 0),
len AS (SELECT DISTINCT m FROM pat),
win AS (SELECT s.id, len.m, unnest(range(1, s.n - len.m + 2)) AS st,
               unnest(list_transform(range(1, s.n - len.m + 2), lambda i: array_to_string(s.w[i:i + len.m - 1], ' '))) AS p
        FROM sized s, len WHERE s.kind = 'd' AND s.n >= len.m),
hit AS (SELECT win.id, win.st, win.m, pat.item FROM win JOIN pat USING (m, p)),
cover AS (SELECT id, count(DISTINCT pos) AS n_hit FROM (SELECT id, unnest(range(st, st + m)) AS pos FROM hit) GROUP BY id),
its AS (SELECT id, count(*) AS n_items, sha256(string_agg(CAST(item AS VARCHAR), ',' ORDER BY CAST(item AS VARCHAR))) AS sha
        FROM (SELECT DISTINCT id, item FROM hit) GROUP BY id)
SELECT s.id AS doc_id, CAST(s.n AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= s.n AS contaminated
FROM sized s LEFT JOIN cover USING (id) LEFT JOIN its USING (id) WHERE s.kind = 'd'
"""
