"""Quality rules with risk-controlled cutoffs (DataFrame and SQL functions only).

Base rules use counts of the whole text. Further rules reject a text whose rate
exceeds a cutoff, and the cutoffs come from labelled data: in every stratum
(language) each rule takes the smallest cutoff of its fixed grid for which the
labelled good texts prove, by an exact binomial test, that at most ``risk`` of
the good texts would be rejected. The test accepts a cutoff if

    P(Binomial(n, risk) <= k) <= delta / (strata * rules)

for k rejected of n good texts, which is the same as a Clopper-Pearson upper
bound of at most ``risk`` at that level. Strata and rules are corrected by
Bonferroni; along a grid k only falls as the cutoff rises, so testing the grid
from its loosest cutoff downwards until the first failure needs no further
correction. With probability 1 - delta no rule rejects more than ``risk`` of the
good texts of any stratum. Where no cutoff can be proven the rule rejects
nothing.

The texts are read once into a narrow table of counts, checkpointed; labels and
cutoffs work on that table. Nothing is shuffled but (id, counts).

5-word windows are compared by the 64-bit hash of their words.

Defined results: a null or blank text has no words, zero counts and fails the
base rules; a null stratum is a stratum of its own; an id labelled twice is good
only if every label says so; null labels are not used; a stratum without labels
has no cutoffs; repeated rows get equal verdicts; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, SPACES, cut, nest, table, unnest

#: Rate of each rule (SQL over the counts) and its grid of cutoffs.
RULES = {
    "symbol": ("n_symbols / word_chars", (0.02, 0.05, 0.1, 0.2, 0.3)),
    "mark": ("n_marks / word_chars", (0.05, 0.08, 0.12, 0.2, 0.3)),
    "capital": ("n_capitals / word_chars", (0.1, 0.2, 0.3, 0.5, 0.7)),
    "dup_line": ("n_dup_lines / n_lines", (0.1, 0.2, 0.3, 0.5, 0.7)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_capitals")

def counts(text: Column) -> Column:
    """Struct of COUNTS for a text."""
    text = F.coalesce(text, F.lit(""))
    inner = F.btrim(text, F.lit(SPACES))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"{SPACE}+"))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), _repeat(w).alias("n_repeat_words"))

    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"),
                        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    return F.struct(
        F.transform(F.array(words), of_words)[0].alias("w"), F.transform(F.array(lines), of_lines)[0].alias("l"),
        (F.length(text) - count(SPACE)).alias("word_chars"), count(r"[#*$%&|<>]").alias("n_symbols"),
        count(r"[^\p{L}\p{N}\x20\x09-\x0D]").alias("n_marks"), count(r"\p{Lu}").alias("n_capitals"))


def _repeat(w: Column) -> Column:
    """Words inside 5-word windows that the text holds twice or more."""
    windows = F.transform(F.sequence(F.lit(1), F.size(w) - 4), lambda i: F.xxhash64(F.slice(w, i, F.lit(5))))

    def of_windows(h: Column) -> Column:
        # Inside equal hashes the words themselves are compared.
        keyed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), F.slice(w, i + 1, F.lit(5)).alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            F.transform(F.array(keyed), of_sorted)[0])

    def of_sorted(s: Column) -> Column:
        def same(a: Column, b: Column) -> Column:
            return (a["x"] == b["x"]) & (a["g"] == b["g"])

        again = F.filter(s, lambda e, j: same(e, F.get(s, j - 1)) | same(e, F.get(s, j + 1)))
        starts = F.sort_array(F.transform(again, lambda e: e["i"]))
        return F.aggregate(
            starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-5).alias("last")),
            lambda a, p: F.struct((a["n"] + F.least(F.lit(5), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"])

    return F.when(F.size(w) < 5, F.lit(0).cast("long")).otherwise(F.transform(F.array(windows), of_windows)[0])


def measured(docs: DataFrame, *, keep: list[str], text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """``keep`` columns (nested), _stratum, the COUNTS and base_failed per row."""
    rows = nest(docs, keep, _stratum=F.col(stratum_col), _c=counts(F.col(text_col)))
    where = {"n_words": "w.", "n_repeat_words": "w.", "n_lines": "l.", "n_dup_lines": "l."}
    rows = rows.select("_tm_row", "_stratum", *[F.col(f"_c.{where.get(c, '')}{c}").alias(c) for c in COUNTS])
    return rows.withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))


def _rate(rule: str) -> Column:
    return F.expr(f"coalesce(try_divide(CAST({RULES[rule][0].split(' / ')[0]} AS DOUBLE), "
                  f"{RULES[rule][0].split(' / ')[1]}), 0D)")


#: P(Binomial(n, risk) <= k): log of the last term, times the sum of the terms' ratios to it.
_CDF = """
exp(aggregate(IF(k > 0, sequence(1L, k), array()), 0D, (a, i) -> a + ln((n - i + 1) / i)) + k * ln({p}) + (n - k) * ln(1 - {p}))
* aggregate(IF(k > 0, sequence(k, 1L, -1L), array()), named_struct('s', 1D, 't', 1D),
    (a, i) -> named_struct('s', a.s + a.t * (i * (1 - {p}) / ((n - i + 1) * {p})), 't', a.t * (i * (1 - {p}) / ((n - i + 1) * {p}))),
    a -> a.s)"""


def cutoffs(good: DataFrame, *, risk: float = 0.004, delta: float = 0.05) -> DataFrame:
    """(_stratum, rule, cutoff) for the rules and strata with a proven cutoff, from measured good texts."""
    grid = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(float(c)).alias("cutoff"), _rate(name).alias("rate"))
                     for name, (_, cuts) in RULES.items() for c in cuts])
    tested = (good.select("_stratum", F.inline(grid)).groupBy("_stratum", "rule", "cutoff")
              .agg(F.count("*").alias("n"), F.count_if(F.col("rate") > F.col("cutoff")).alias("k")))
    p = f"{risk}D"
    # The table tested has a row per stratum, rule and cutoff; its strata are counted in place.
    return (tested.withColumn("rank", F.dense_rank().over(Window.orderBy("_stratum")))
            .withColumn("strata", F.max("rank").over(Window.rowsBetween(Window.unboundedPreceding,
                                                                       Window.unboundedFollowing)))
            .filter(F.col("k") < F.col("n") * risk)
            .filter(F.expr(f"{_CDF.format(p=p)} <= {delta}D / (strata * {len(RULES)})"))
            .groupBy("_stratum", "rule").agg(F.min("cutoff").alias("cutoff")))


def judged(rows: DataFrame, proven: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """Measured rows with kept: no base failure, and no rate above its stratum's cutoff."""
    wide = cut(proven.groupBy("_stratum").pivot("rule", list(RULES)).agg(F.min("cutoff"))
               .withColumnRenamed("_stratum", "_of"))
    if wide.count() <= broadcast_rows:  # a row per stratum
        wide = F.broadcast(wide)
    over = F.lit(False)
    for name in RULES:
        over = over | F.coalesce(_rate(name) > F.col(f"`{name}`"), F.lit(False))
    return (rows.join(wide, F.col("_stratum").eqNullSafe(F.col("_of")), "left")
            .withColumn("kept", ~F.col("base_failed") & ~over))


def quality(docs: DataFrame, labels: DataFrame, *, keep: list[str] | None = None, id_col: str = "doc_id",
            text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality",
            risk: float = 0.004, delta: float = 0.05) -> DataFrame:
    """The ``keep`` columns (default: all but the text) with COUNTS, base_failed and kept."""
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    ids = list(dict.fromkeys([*keep, id_col]))
    rows = cut(measured(docs, keep=ids, text_col=text_col, stratum_col=stratum_col))
    good = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
            .filter("_id IS NOT NULL AND _y IS NOT NULL").groupBy("_id").agg(F.min("_y").alias("_y")).filter("_y = 1"))
    held = (rows.filter("NOT base_failed").withColumn("_id", F.col(f"_tm_row.`{id_col}`"))
            .join(good, "_id", "left_semi"))
    out = judged(rows, cutoffs(held, risk=risk, delta=delta))
    return unnest(out, keep, **{c: F.col(c) for c in (*COUNTS, "base_failed", "kept")})


#: At 16 tests (four languages, four rules) 190 good labels without a false rejection prove a cutoff at this risk.
RISK = 0.03


def op2_quality_rules(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"], risk=RISK).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
d AS (SELECT doc_id, lang, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
        CAST(length(text) - len(regexp_extract_all(text, '[\x20\x09-\x0D]')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        CAST(len(regexp_extract_all(text, '[^\p{L}\p{N}\x20\x09-\x0D]')) AS BIGINT) AS n_marks,
        CAST(len(regexp_extract_all(text, '\p{Lu}')) AS BIGINT) AS n_capitals FROM t),
n AS (SELECT row_number() OVER () AS rid, *, CAST(len(w) AS BIGINT) AS n_words, CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines FROM d),
win AS (SELECT rid, unnest(range(1, n_words - 3)) AS st, unnest(list_transform(range(1, n_words - 3), lambda i: w[i:i + 4])) AS g FROM n),
rep AS (SELECT rid, st FROM (SELECT rid, st, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT pos) AS c FROM (SELECT rid, unnest(range(st, st + 5)) AS pos FROM rep) GROUP BY rid),
m AS (SELECT n.*, CAST(coalesce(cov.c, 0) AS BIGINT) AS n_repeat_words,
        n_words < 10 OR 100 * coalesce(cov.c, 0) > 20 * n_words AS base_failed FROM n LEFT JOIN cov USING (rid)),
rate AS (SELECT m.*, unnest([
   {'rule': 'symbol', 'rate': coalesce(n_symbols / nullif(word_chars, 0), 0), 'cuts': [0.02, 0.05, 0.1, 0.2, 0.3]},
   {'rule': 'mark', 'rate': coalesce(n_marks / nullif(word_chars, 0), 0), 'cuts': [0.05, 0.08, 0.12, 0.2, 0.3]},
   {'rule': 'capital', 'rate': coalesce(n_capitals / nullif(word_chars, 0), 0), 'cuts': [0.1, 0.2, 0.3, 0.5, 0.7]},
   {'rule': 'dup_line', 'rate': coalesce(n_dup_lines / nullif(n_lines, 0), 0), 'cuts': [0.1, 0.2, 0.3, 0.5, 0.7]}]) AS r FROM m),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
held AS (SELECT lang, r.rule AS rule, r.rate AS rate, unnest(r.cuts) AS cutoff FROM rate
         WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)),
tested AS (SELECT lang, rule, CAST(cutoff AS DOUBLE) AS cutoff, count(*) AS n, count(*) FILTER (rate > CAST(cutoff AS DOUBLE)) AS k
           FROM held GROUP BY ALL),
strata AS (SELECT count(*) AS strata FROM (SELECT DISTINCT lang FROM held)),
cdf AS (SELECT lang, rule, cutoff, strata, sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(@RISK) + (n - j) * ln(1 - @RISK))) AS p
        FROM (SELECT *, unnest(range(k + 1)) AS j FROM tested, strata WHERE k < n * @RISK) GROUP BY ALL),
cutoffs AS (SELECT lang, rule, min(cutoff) AS cutoff FROM cdf WHERE p <= 0.05 / (strata * 4) GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT bool_or(coalesce(r.rate > c.cutoff, false)) AS kept
FROM rate LEFT JOIN cutoffs c ON rate.lang IS NOT DISTINCT FROM c.lang AND r.rule = c.rule
GROUP BY rid, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed
""".replace("@RISK", str(RISK))
