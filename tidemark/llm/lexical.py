"""Ranked lexical search for many items at once, sharing the work that items have in common.

An item's score for a document is the sum of its terms' scores, so items are sums
over sets of terms, and sets that several items share need one sum for all. The
sharing is mined for each block of items (on the executors): terms that occur in
exactly the same items become one node, and then, time and again, the pair of nodes
that most items still hold together becomes a node of its own. The nodes form a
graph in which every shared set is added up once a document and used by all nodes
and items above it. Scores are integers, so the order of adding changes nothing.

A block's run: documents become sparse counts of the block's terms, written once to
the shared folder; N, L and the terms' df are aggregated from them; then each task
fills an accumulator matrix (nodes by a bounded slice of documents) from the leaves
up and keeps, for every item, the best ``top`` documents it has seen. Tasks hand on at
most ``top`` rows an item, which are ranked in two steps. Blocks hold about
``block_terms`` item terms, so what the driver and a worker hold of the items at a
time has a bound however many there are; items of one set of terms are one query.

Score: terms are maximal runs of a-z, 0-9 and non-ASCII characters after lowering A-Z.
A term's weight w is floor(1000 * ln((2 N + 2) / (2 df + 1))); a document of n terms
has m = 50 + (50 n N) div L, and each item term adds w * ((10^9 tf) div (1000 tf + 20 m)).

Defined results: documents or items that are null, empty or without terms match
nothing; equal scores go by ascending id, null ids last; repeated documents are ranked
each; repeated items get their own rows each, null item ids too; empty tables give no
rows. Whole texts of any length are read, other columns never.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table
from .decontamination import words


def mine(queries: list[list[int]], leaves: int, width: int = 64) -> tuple[list[list[int]], list[list[int]]]:
    """(sums, roots): the children of node ``leaves + j``, and the nodes that add up to each query.

    Children come before their parents. Pairs are mined among the ``width`` nodes of a
    query that most queries hold, which bounds the work for very long queries; the
    others are added singly.
    """
    held_by = defaultdict(list)
    for q, terms in enumerate(queries):
        for t in terms:
            held_by[t].append(q)
    sums: list[list[int]] = []
    roots: list[set[int]] = [set() for _ in queries]
    alike = defaultdict(list)
    for t in sorted(held_by):
        alike[tuple(held_by[t])].append(t)
    users: dict[int, int] = {}
    for of, terms in alike.items():
        node = terms[0]
        if len(terms) > 1 and len(of) > 1:
            node = leaves + len(sums)
            sums.append(terms)
            terms = [node]
        for t in terms:
            users[t] = len(of)
            for q in of:
                roots[q].add(t)
    # The nodes of each query that take part in mining, and the queries of each pair.
    active = [set(sorted((n for n in r if users[n] > 1), key=lambda n: (-users[n], n))[:width]) for r in roots]
    pairs: dict[tuple[int, int], set[int]] = defaultdict(set)
    for q, nodes in enumerate(active):
        order = sorted(nodes)
        for i, a in enumerate(order):
            for b in order[i + 1:]:
                pairs[a, b].add(q)
    heap = [(-len(of), p) for p, of in pairs.items() if len(of) > 1]
    heapq.heapify(heap)
    while heap:
        count, pair = heapq.heappop(heap)
        of = pairs.get(pair, ())
        if len(of) < 2:
            continue
        if len(of) != -count:  # others took some of its queries since
            heapq.heappush(heap, (-len(of), pair))
            continue
        node = leaves + len(sums)
        sums.append(list(pair))
        fresh = set()
        for q in list(of):
            for old in pair:
                active[q].discard(old)
                roots[q].discard(old)
                for other in active[q]:
                    pairs[min(old, other), max(old, other)].discard(q)
            for other in active[q]:
                pairs[other, node].add(q)
                fresh.add((other, node))
            active[q].add(node)
            roots[q].add(node)
        pairs.pop(pair, None)
        for p in fresh:
            if len(pairs[p]) > 1:
                heapq.heappush(heap, (-len(pairs[p]), p))
    return sums, [sorted(r) for r in roots]


def plan_block(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for a block of queries: its terms, the children of its sums, its queries and their nodes."""
    terms = sorted({t for of in rows.terms for t in of})
    number = {t: i for i, t in enumerate(terms)}
    rows = rows.sort_values("query")
    sums, roots = mine([[number[t] for t in of] for of in rows.terms], len(terms))
    return pd.DataFrame([{"block": rows.block.iloc[0], "terms": terms, "sums": sums, "queries": rows["query"].tolist(),
                          "roots": roots}])


def _terms_udf():
    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted({w.decode() for w in words(t)}) for t in texts], dtype=object)
    return run


def vectors_udf(sent):
    """n and the counts of the broadcast terms in each text."""
    @F.pandas_udf("n: long, codes: array<int>, tf: array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        number = {t.encode(): i for i, t in enumerate(sent.value["terms"])}
        for texts in batches:
            out = []
            for text in texts:
                found = words(text)
                kept = [(number[w], c) for w, c in Counter(found).items() if w in number]
                out.append((len(found), [k for k, _ in kept], [c for _, c in kept]))
            yield pd.DataFrame(out, columns=["n", "codes", "tf"])
    return run


class Best:
    """The ``top`` highest (score, then smallest id) of what is offered, id None last."""

    def __init__(self, top: int):
        self.top, self.rows, self.least = top, [], 1

    def offer(self, scores: np.ndarray, ids: list) -> None:
        for i in np.flatnonzero(scores >= self.least).tolist():
            self.rows.append((-int(scores[i]), ids[i] is None, ids[i]))
        if len(self.rows) >= 16 * self.top:
            self.prune()

    def prune(self) -> list:
        self.rows = heapq.nsmallest(self.top, self.rows, key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0))
        if len(self.rows) == self.top:
            self.least = -self.rows[-1][0]
        return self.rows


def scorer(sent, top: int, cells: int = 1 << 22):
    """mapInArrow function from (id, n, codes, tf) to each task's best (query, id, score)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = sent.value
        weight, sums, roots = np.array(plan["weights"], np.int64), plan["sums"], plan["roots"]
        nodes, leaves = len(weight) + len(sums), len(weight)
        best = [Best(top) for _ in roots]
        id_type = None
        step = max(1, cells // max(1, nodes))
        for whole in batches:
            for first in range(0, whole.num_rows, step):
                batch = whole.slice(first, step)
                id_type, ids = batch.column(0).type, batch.column(0).to_pylist()
                n = batch.column(1).to_numpy()
                long = np.repeat(np.arange(len(n)), batch.column(2).value_lengths().to_numpy())
                codes = batch.column(2).flatten().to_numpy()
                tf = batch.column(3).flatten().to_numpy()
                m = 50 + (50 * n * plan["N"]) // plan["L"]
                held = np.zeros((nodes, len(n)), np.int64)
                held[codes, long] = weight[codes] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[long]))
                for at, of in enumerate(sums, leaves):
                    if len(of) == 2:
                        np.add(held[of[0]], held[of[1]], out=held[at])
                    else:
                        held[of].sum(0, out=held[at])
                for b, of in zip(best, roots):
                    b.offer(held[of].sum(0), ids)
        for query, b in zip(plan["queries"], best):
            rows = b.prune()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([query] * len(rows), pa.int64()), pa.array([r[2] for r in rows], id_type),
                                                  pa.array([-r[0] for r in rows], pa.int64())], ["query", "id", "score"])
    return run


def weights(df: dict[int, int], terms: int, n_docs: int) -> list[int]:
    return [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(terms)]


def search_block(docs: DataFrame, plan: dict, top: int, id_col: str, text_col: str) -> DataFrame:
    """(query, id, score) of the best documents of every task, for one block of queries."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast({"terms": plan["terms"]})
    vectors = cut(docs.select(F.col(id_col).alias("id"), vectors_udf(sent)(F.col(text_col).cast("string")).alias("v"))
                  .select("id", "v.n", "v.codes", "v.tf"))
    sent.unpersist()
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    df = dict(map(tuple, vectors.select(F.explode("codes").alias("code")).groupBy("code").count().collect()))
    ready = {k: plan[k] for k in ("sums", "roots", "queries")}
    ready.update(weights=weights(df, len(plan["terms"]), n_docs), N=n_docs, L=max(1, n_terms or 0))
    kind = vectors.schema["id"].dataType.simpleString()
    return (vectors.filter(F.size("codes") > 0)
            .mapInArrow(scorer(spark.sparkContext.broadcast(ready), top), f"query long, id {kind}, score long"))


def search(docs: DataFrame, items: DataFrame, *, top: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_terms: int = 50_000) -> DataFrame:
    """The ``top`` documents of every item: the item's id, rank (from 1), the document's id, score."""
    spark = docs.sparkSession
    asked = cut(items.select(F.col(item_col).alias("item"), _terms_udf()(F.col(item_text_col).cast("string")).alias("terms"))
                .filter(F.size("terms") > 0).withColumn("row", F.monotonically_increasing_id()))
    queries = cut(asked.groupBy("terms").agg(F.min("row").alias("query")))
    blocks = max(1, -(-(queries.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms))
    plans = cut(queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")).groupBy("block").applyInPandas(
        plan_block, "block int, terms array<string>, sums array<array<int>>, queries array<long>, roots array<array<int>>"))
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    best = spark.createDataFrame([], f"query long, id {kind}, score long")
    for block in range(blocks):
        plan = plans.filter(F.col("block") == block).first()
        if plan is not None:
            found = search_block(docs, plan.asDict(), top, id_col, text_col)
            best = best.unionByName(found if blocks == 1 else cut(found))
    order = [F.desc("score"), F.asc_nulls_last("id")]
    # Tasks are many at scale, so their best rows are cut to ``top`` in groups of tasks first.
    near = Window.partitionBy("query", "part").orderBy(*order)
    last = Window.partitionBy("query").orderBy(*order)
    best = best.withColumn("part", F.floor(F.spark_partition_id() / 256))
    best = best.withColumn("_k", F.row_number().over(near)).filter(F.col("_k") <= top)
    best = best.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= top)
    mine_ = queries.join(asked.select("item", "terms"), "terms").select("query", "item")
    return best.join(mine_, "query").select(F.col("item").alias(item_col), "rank",
                                            F.col("id").alias(id_col), "score")


def op11_lexical(spark, sf_dir):
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH dw AS (SELECT doc_id, row_number() OVER () AS row_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, row_number() OVER () AS item_row,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
stat AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w)) AS l FROM dw),
it AS (SELECT DISTINCT item_id, item_row, unnest(w) AS term FROM iw),
tf AS (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(w) AS term FROM dw) WHERE term IN (SELECT term FROM it) GROUP BY ALL),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, stat GROUP BY term, n_docs),
m AS (SELECT row_id, doc_id, CAST(50 + (50 * len(w) * n_docs) // l AS BIGINT) AS m FROM dw, stat WHERE len(w) > 0),
part AS (SELECT tf.row_id, m.doc_id, tf.term, weight * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS s FROM tf JOIN wt USING (term) JOIN m USING (row_id)),
total AS (SELECT item_id, item_row, row_id, doc_id, CAST(sum(s) AS BIGINT) AS score FROM it JOIN part USING (term) GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM total WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""
