"""Toxicity scores from a counterfactual-regularised classifier.

The model is a logistic regression on which words, and beginnings of words, a
text contains (endings vary with inflection, stems tell). It is fitted on at most ``per_class`` labelled texts of each class (chosen by a hash
of the id, one per distinct text, weighted back to the class counts of all
labels), by accelerated proximal gradient steps on

    weighted log loss + l1 * |w| + cf * sum over swaps of (z(x) - z(x'))^2

where x' is a labelled text x with an identity term replaced by another of its
family throughout. A labelled text that names none gets a mention of one inserted
first (which, by a hash of the text), so that both classes take part in the penalty
whether or not the corpus speaks of groups. Every family holds a neutral word, which never is a feature, so a
term that is merely common in toxic texts is pulled towards no weight at all
instead of becoming evidence of its own; plain mentions of a group stay below
the limit.

Fitting needs a bounded sample and happens once, on the driver; scoring runs in
Arrow batches over the text column alone, without a shuffle.

Defined results: null and empty texts get the score of a text without known
words; without labels of both classes every score is the smoothed class share;
repeated labels of an id count as toxic if one says so; of an id's texts the one
with the smallest hash is learnt; null labels and labels
without a document are not used; repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, hash_slice, nest, table, unnest

_TOKEN = re.compile(r"[^\W\d_]+")

#: Identity terms by family; the first word of each family is its neutral member.
FAMILIES = (
    ("people", "women", "men", "girls", "boys", "transgender"),
    ("person", "woman", "man", "girl", "boy"),
    ("believers", "christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("religious", "christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("human", "black", "white", "asian", "african", "latino", "arab", "native"),
    ("someone", "gay", "lesbian", "bisexual", "straight", "queer"),
    ("residents", "immigrants", "refugees", "foreigners", "citizens"),
    ("patients", "disabled", "deaf", "blind", "autistic"),
    ("menschen", "frauen", "männer", "muslime", "juden", "christen", "ausländer"),
    ("gens", "femmes", "hommes", "musulmans", "juifs", "chrétiens", "étrangers"),
    ("personas", "mujeres", "hombres", "musulmanes", "judíos", "cristianos", "extranjeros"),
)


#: Lengths of the word beginnings that count as features beside whole words.
STEMS = (4, 5, 6)


NEUTRAL = frozenset(f[0] for f in FAMILIES)
IDENTITY = frozenset(t for f in FAMILIES for t in f)


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def features(text: str | None) -> set[str]:
    """Whole words, and beginnings of longer words marked with a hyphen.

    Neutral words are no features and identity terms have no stems, so a swap
    changes nothing but the term's own weight.
    """
    found = set(tokens(text)) - NEUTRAL
    return found | {w[:k] + "-" for w in found - IDENTITY for k in STEMS if len(w) > k}


@dataclass
class Model:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)
    swap_pairs: int = 0  # that the penalty summed over; 0 makes the fit a plain L1 logistic regression

    def score(self, text: str | None) -> float:
        z = self.bias + math.fsum(self.weights[t] for t in self.weights.keys() & features(text))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def swaps(text: str | None) -> Counter:
    """(term, replacement) pairs of a text: each identity term that it names, or an inserted one, by each of its
    family that the text lacks. The score sees which words a text has, so a pair's score change is the difference
    of the two weights."""
    present = set(tokens(text))
    if not present:
        return Counter()
    found = {t: f for f in FAMILIES for t in f[1:] if t in present}
    if not found:
        at = zlib.crc32(text.encode())
        family = FAMILIES[at % len(FAMILIES)]
        found = {family[1 + at // len(FAMILIES) % (len(family) - 1)]: family}
    return Counter((term, other) for term, family in found.items() for other in family if other != term and other not in present)


def fit(rows: Iterable[tuple[Iterable[str], Counter, int, float]], *, l1: float = 5e-6, cf: float = 0.05,
        steps: int = 400) -> Model:
    """``rows``: (features, swap pairs, label, weight) per labelled text."""
    rows = list(rows)
    y = np.array([r[2] for r in rows], float)
    c = np.array([r[3] for r in rows], float)
    share = (float(c @ y) + 1) / (float(c.sum()) + 2) if rows else 0.5
    prior = math.log(share / (1 - share))
    if not rows or y.min() == y.max():
        return Model(prior)
    c = c / c.sum()
    pairs = sum((r[1] for r in rows), Counter())
    identity = {t for p in pairs for t in p} - NEUTRAL
    vocabulary = sorted({t for r in rows for t in r[0]} | identity)
    number = {t: i for i, t in enumerate(vocabulary)}
    of_row = [[number[t] for t in r[0] if t in number] for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(x) for x in of_row])
    col = np.array([i for x in of_row for i in x], np.int64)
    size = len(vocabulary)
    # Neutral words share one extra place whose weight stays 0.
    first = np.array([number[a] for a, _ in sorted(pairs)], np.int64)
    second = np.array([number.get(b, size) for _, b in sorted(pairs)], np.int64)
    often = np.array([pairs[p] for p in sorted(pairs)], float)
    often = often / max(1.0, often.sum()) if len(often) else often

    # Step sizes from the diagonal of a curvature bound, so that rare words move as fast as common ones.
    width = np.bincount(row, minlength=len(rows)).astype(float) + 1
    curve = 0.25 * np.bincount(col, (c * width)[row], minlength=size) + 1e-9
    if len(often):
        curve += 4 * cf * (np.bincount(first, often, minlength=size) + np.bincount(second, often, minlength=size + 1)[:size])
    curve_b = 0.25 * float((c * width).sum())

    w, b = np.zeros(size), prior
    ahead, ahead_b, t = w.copy(), b, 1.0
    for _ in range(steps):
        z = ahead_b + np.bincount(row, ahead[col], minlength=len(rows))
        gap = c * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y)
        grad = np.bincount(col, gap[row], minlength=size).astype(float)
        if len(often):
            pull = 2 * cf * often * (ahead[first] - np.append(ahead, 0.0)[second])
            grad += np.bincount(first, pull, minlength=size) - np.bincount(second, pull, minlength=size + 1)[:size]
        moved = ahead - grad / curve
        new = np.sign(moved) * np.maximum(np.abs(moved) - l1 / curve, 0)
        new_b = ahead_b - float(gap.sum()) / curve_b
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_b = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new, new_b, t_next
    return Model(b, {vocabulary[i]: float(w[i]) for i in np.flatnonzero(w)}, sum(pairs.values()))


def features_udf():
    @F.pandas_udf("words: array<string>, swaps: array<struct<a: string, b: string, n: long>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame({
                "words": [sorted(features(t)) for t in texts],
                "swaps": [[{"a": a, "b": b, "n": n} for (a, b), n in sorted(swaps(t).items())] for t in texts]})
    return run


def train(docs: DataFrame, labels: DataFrame, *, per_class: int = 1500, least_df: int = 3, least_z: float = 4.5,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options) -> Model:
    """Fit on labels outside the held-out third; at most 2 * ``per_class`` texts take part.

    Features enter if ``least_df`` of these texts have them and their shares in
    the two classes lie ``least_z`` standard errors apart; identity terms always
    enter. Only the entering features of a text reach the driver.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~hash_slice(F.col("id"), 3, 1))
             .groupBy("id").agg(F.max("y").alias("y")))
    count = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    chosen = None
    for y in (0, 1):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(chosen), "id")  # at most 2 * per_class rows
             .groupBy("id", "y").agg(F.min(F.struct(F.col("text").isNull(), F.xxhash64("text").alias("h"), "text")).alias("t"))
             .select("id", "y", "t.text", "t.h").dropDuplicates(["h", "y"]))
    marked = cut(texts.select("id", "y", features_udf()("text").alias("f")).select("id", "y", "f.words", "f.swaps"))
    used = {r.y: r["count"] for r in marked.groupBy("y").count().collect()}
    vocabulary = set(IDENTITY - NEUTRAL)
    if len(used) == 2:
        n0, n1 = used[0], used[1]
        error = f"sqrt((a + b) / {n0 + n1} * (1 - (a + b) / {n0 + n1}) * {1 / n0 + 1 / n1}D)"
        vocabulary |= {r.word for r in
                       marked.select("y", F.explode("words").alias("word")).groupBy("word")
                       .agg(F.count_if(F.col("y") == 0).alias("a"), F.count_if(F.col("y") == 1).alias("b"))
                       .filter(F.expr(f"a + b >= {least_df} AND {error} > 0 AND abs(b / {n1} - a / {n0}) >= {least_z} * {error}"))
                       .select("word").collect()}
    entering = F.array(*[F.lit(w) for w in sorted(vocabulary)])
    rows = (marked.select("id", "y", "swaps", F.array_intersect("words", entering).alias("words"))
            .orderBy("id", "y", "words").collect())
    return fit([(r.words, Counter({(x.a, x.b): x.n for x in r.swaps}), r.y, count[r.y] / used[r.y]) for r in rows],
               **options)


def score_udf(model: Model):
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype=float)
    return run


def score(docs: DataFrame, model: Model, *, limit: float = 0.7, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Add held_out, score and predicted to every row."""
    rows = nest(docs, docs.columns, _id=F.col(id_col), _score=score_udf(model)(F.col(text_col)))
    return unnest(rows, docs.columns, held_out=hash_slice(F.col("_id"), 3, 1), score=F.col("_score"),
                  predicted=(F.col("_score") >= limit).cast("int"))


def accepted_rows(docs: DataFrame, model: Model, *, limit: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, unchanged."""
    rows = nest(docs, docs.columns, _score=score_udf(model)(F.col(text_col)))
    return unnest(rows.filter(F.col("_score") < limit), docs.columns)


def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", "held_out", "score", "predicted")
