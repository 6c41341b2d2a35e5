"""Source divergence audit: how far each source's word use lies from its language's other sources.

One pass of ``bytes.translate`` lowers A-Z and turns every other ASCII character
but a-z into a blank, ``bytes.split`` gives the terms, and a ``Counter`` for each
document its term frequencies. A task adds the counters of its documents to
sparse counts by (lang, source, term), how often and in how many documents, and
hands them on whenever ``flush_terms`` of them are held; Spark sums them.

A language keeps its terms that ``min_docs`` of its documents hold. With V kept
terms, a group (lang, source) with ``count`` occurrences of a term out of N gives
it p = 1 + floor(1e9 * (count + 5) / (N + 5 V)); the language as a whole likewise.

* ``term`` rows: a group's kept terms that it uses more than its language does,
  by the difference, the first ``top``.
* ``pair`` rows: the sum over all kept terms of the difference between a group
  and each other source of its language. A term that neither uses adds the same
  amount throughout, so the sum is V times that amount plus corrections for terms
  that one of them uses. Terms and sources are dealt into blocks of bounded size
  and each (block of terms, pair of blocks of sources) is one small dense matrix
  in one task; its sums are added up by Spark. The result has a row for every
  two sources of a language, so it grows with their square, as asked.

All arithmetic is on integers. Defined results: null text, lang and source are
''; a group without terms stands with count 0; a language without kept terms has
``pair`` rows of 0 and no ``term`` rows, one with a single source has no ``pair``
rows; repeated rows count as documents of their own; an empty table gives no
rows. Other input columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

#: Byte table: capitals lowered, every other ASCII character outside a-z made a blank.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SPARSE = "lang string, source string, term string, n long, docs long"


def term_counts(text: bytes) -> Counter:
    """Occurrences of every term of one text."""
    return Counter(text.translate(FOLD).split())


def sparse_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                  flush_terms: int = 200_000) -> DataFrame:
    """(lang, source, term, n, docs), and a row with a null term for every group that occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list] = defaultdict(lambda: [Counter(), Counter()])

        def emit() -> pa.RecordBatch:
            langs, sources, terms, n, of = [], [], [], [], []
            for (lang, source), (count, in_docs) in held.items():
                langs += [lang] * (len(count) + 1)
                sources += [source] * (len(count) + 1)
                terms += [None, *count]
                n += [0, *count.values()]
                of += [0, *[in_docs[t] for t in count]]
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                 pa.array(n, pa.int64()), pa.array(of, pa.int64())], ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for text, lang, source in zip(batch.column(0), langs, sources):
                found = term_counts(text.as_py())
                count, in_docs = held[lang, source]
                count.update(found)
                in_docs.update(found.keys())
            if sum(len(c) for c, _ in held.values()) >= flush_terms:
                yield emit()
                held.clear()
        if held:
            yield emit()

    empty = F.lit("")
    read = docs.select(F.coalesce(F.col(text_col).cast("string"), empty).cast("binary").alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), empty).alias("lang"),
                       F.coalesce(F.col(source_col).cast("string"), empty).alias("source"))
    return (read.mapInArrow(run, SPARSE).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(count: Column, total: Column, terms: Column) -> Column:
    """p of a term, exact beyond 64 bits inside; 0 where the language keeps no term."""
    wide = "decimal(20,0)"
    return F.when(terms > 0, F.call_function(
        "div", (count + 5).cast(wide) * F.lit(1_000_000_000).cast("decimal(10,0)"), (total + 5 * terms).cast(wide)) + 1).otherwise(F.lit(0)).cast("long")


def block_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Corrections of the pairs of sources in one (block of terms, pair of blocks of sources).

    ``rows`` holds (number, rank, p0) of each source with a null term, and p of its terms.
    """
    marks = rows[rows.term.isna()].sort_values("number")
    used = rows[rows.term.notna()]
    at = {n: i for i, n in enumerate(marks.number)}
    base = marks.p0.to_numpy(np.int64)
    column, terms = pd.factorize(used.term)
    dense = np.repeat(base[:, None], len(terms), 1)
    dense[[at[n] for n in used.number], column] = used.p.to_numpy(np.int64)
    first = rows.iloc[0]
    side, numbers = marks.side.to_numpy(), marks.number.to_numpy()
    out = []
    for i in range(len(base)):
        if side[i] != first.a:
            continue
        others = np.flatnonzero((side == first.b) & (numbers > numbers[i]))
        flat = np.abs(base[others] - base[i])
        sums = np.abs(dense[others] - dense[i]).sum(1) - flat * len(terms)
        if first.tb == 0:
            sums = sums + flat * first.kept
        out.append(pd.DataFrame({"lang": first.lang, "x": numbers[i], "y": numbers[others], "value": sums}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"lang": [], "x": [], "y": [], "value": []})


def audit(docs: DataFrame, *, min_docs: int = 30, top: int = 50, block_terms: int = 256, block_sources: int = 128,
          **options) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank."""
    of_term = Window.partitionBy("lang", "term")
    counts = (sparse_counts(docs, **options)
              .select("*", F.sum("docs").over(of_term).alias("in_docs"), F.sum("n").over(of_term).alias("lang_n"))
              .filter(F.col("term").isNull() | (F.col("in_docs") >= min_docs)))
    counts = cut(counts.select("lang", "source", "term", "n", "lang_n"))
    terms = counts.filter("term IS NOT NULL")
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = (terms.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang")
             .agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total")))
    numbered = (groups.join(langs, "lang", "left").fillna(0, ["kept", "lang_total"])
                .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
                .withColumn("p0", share(F.lit(0), F.col("total"), F.col("kept")))
                .withColumn("side", F.floor(F.col("number") / block_sources).cast("int")))
    numbered = cut(numbered)  # one row for each source of a language
    shares = (terms.join(numbered, ["lang", "source"])
              .withColumn("p", share(F.col("n"), F.col("total"), F.col("kept"))))

    more = F.col("p") - share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    by_term = (shares.filter("n > 0").select("lang", "source", F.col("term").alias("item"), more.alias("value"))
               .filter("value > 0"))

    sides = numbered.groupBy("lang").agg(F.max("side").alias("last_side"))
    dealt = F.greatest(F.lit(1), F.ceil(F.col("kept") / block_terms)).cast("int")
    mark = numbered.select("lang", "number", "side", "p0", "kept", F.explode(F.sequence(F.lit(0), dealt - 1)).alias("tb"),
                           F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("p"))
    value = shares.select("lang", "number", "side", "p0", "kept", F.pmod(F.xxhash64("term"), dealt).cast("int").alias("tb"),
                          "term", "p")
    # A block of sources meets every block of its language, itself included.
    met = (mark.unionByName(value).join(sides, "lang")
           .withColumn("other", F.explode(F.sequence(F.lit(0), "last_side")))
           .withColumn("a", F.least("side", "other")).withColumn("b", F.greatest("side", "other")))
    sums = (met.groupBy("lang", "tb", "a", "b").applyInPandas(block_sums, "lang string, x long, y long, value long")
            .groupBy("lang", "x", "y").agg(F.sum("value").alias("value")))
    both = sums.select("lang", "value", F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("of"))
    name = numbered.select("lang", F.col("number").cast("long").alias("x"), "source")
    by_pair = (both.select("lang", F.col("of.x").alias("x"), F.col("of.y").alias("y"), "value").join(name, ["lang", "x"])
               .join(name.select("lang", F.col("x").alias("y"), F.col("source").alias("item")), ["lang", "y"])
               .select("lang", "source", "item", "value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(by_pair, "pair").unionByName(ranked(by_term, "term").filter(F.col("rank") <= top))


def op12_divergence(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
occ AS (SELECT row_id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30),
size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
cnt AS (SELECT lang, source, term, count(*) AS n FROM occ JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN cnt USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // CAST(g.total + 5 * s.v AS HUGEINT) AS BIGINT) AS p,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * (k.n + 5)) // CAST(s.total + 5 * s.v AS HUGEINT) AS BIGINT) AS q
  FROM grp g JOIN kept k USING (lang) JOIN size s USING (lang) LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS s1, y.source AS s2, sum(abs(x.p - y.p)) AS f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) m
    ON m.lang = a.lang AND m.s1 = a.source AND m.s2 = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
r AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
SELECT * FROM r WHERE part = 'pair' OR rank <= 50
"""
