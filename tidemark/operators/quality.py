"""Data-quality gate and quarantine.

Rules are ``(description, sql_expression)`` pairs evaluated with Spark SQL.
Three-valued logic: a row passes a rule unless the rule is FALSE, so a null
result passes and is never quarantined. Gate and quarantine are exact
complements computed from one array column, so
``gate ∪ quarantine = input`` and ``gate ∩ quarantine = ∅``.

Rules may name columns by their user-facing (renamed) names; ``with_aliases``
adds those names as extra columns of the raw frame so a rule resolves against
either name without rewriting its text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import RunStamp

FAILED = "_failed_dq_rules"


def _rules(rules: Sequence) -> list[tuple[str, str]]:
    out = []
    for r in rules or []:
        if isinstance(r, Mapping):
            desc, expr = r.get("description"), r.get("expr")
        else:
            desc, expr = r
        if not desc or not expr:
            raise ValueError("each data-quality rule needs a description and an expr")
        out.append((str(desc), str(expr)))
    descs = [d for d, _ in out]
    if len(set(descs)) != len(descs):
        raise ValueError("data-quality rule descriptions must be unique")
    return out


def with_aliases(df: DataFrame, aliases: Mapping[str, str] | None) -> tuple[DataFrame, list[str]]:
    """Add ``user_name`` columns that mirror ``raw_name`` (mapping user -> raw).

    Returns the frame and the list of added names (to drop after evaluation).
    """
    added = []
    for user, raw in (aliases or {}).items():
        if user == raw or user in df.columns:
            continue
        if raw not in df.columns:
            raise ValueError(f"alias target {raw!r} not in columns")
        df = df.withColumn(user, F.col(f"`{raw}`"))
        added.append(user)
    return df, added


def failed_rules(rules: Sequence) -> Column:
    """``array<string>`` of descriptions whose rule is FALSE (null results pass).

    Built as ``concat`` of per-rule CASE arrays (no lambda functions), so the
    projection stays inside whole-stage codegen.
    """
    parsed = _rules(rules)
    empty = F.array().cast("array<string>")
    if not parsed:
        return empty
    return F.concat(*[F.when(~F.expr(e), F.array(F.lit(d))).otherwise(empty) for d, e in parsed])


def fail_condition(rules: Sequence) -> Column:
    """TRUE when at least one rule is FALSE: the exact complement of the gate."""
    return ~gate_condition(rules)


def gate_condition(rules: Sequence) -> Column:
    cond = F.lit(True)
    for _, e in _rules(rules):
        cond = cond & F.coalesce(F.expr(e), F.lit(True))      # IS NOT FALSE
    return cond


def tag(df: DataFrame, rules: Sequence, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """The input plus ``_failed_dq_rules`` (evaluated once for both outputs)."""
    df2, added = with_aliases(df, aliases)
    return df2.withColumn(FAILED, failed_rules(rules)).drop(*added)


def gate(df: DataFrame, rules: Sequence, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Rows for which no rule is FALSE."""
    df2, added = with_aliases(df, aliases)
    return df2.where(gate_condition(rules)).drop(*added)


def quarantine(df: DataFrame, rules: Sequence, source_table: str, run: RunStamp,
               aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Raw rows failing at least one rule + failed-rule names, time and source."""
    df2, added = with_aliases(df, aliases)
    return (
        df2.where(fail_condition(rules))
        .withColumn(FAILED, failed_rules(rules))
        .drop(*added)
        .withColumn("_quarantine_timestamp", run.ts_col())
        .withColumn("_source_table", F.lit(source_table))
    )


def split(df: DataFrame, rules: Sequence, source_table: str, run: RunStamp,
          aliases: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(passed, quarantined) from one tagged frame; callers writing both should
    persist or write the tagged frame once (``streaming.medallion`` does)."""
    tagged = tag(df, rules, aliases)
    passed = tagged.where(F.size(FAILED) == 0).drop(FAILED)
    failed = (tagged.where(F.size(FAILED) > 0)
              .withColumn("_quarantine_timestamp", run.ts_col())
              .withColumn("_source_table", F.lit(source_table)))
    return passed, failed


def rule_failures(df: DataFrame, rules: Sequence, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """One row per rule: ``rule, failed_rows`` (rules with no failure report 0)."""
    parsed = _rules(rules)
    df2, _ = with_aliases(df, aliases)
    aggs = [F.count_if(~F.expr(e)).alias(f"_r{i}") for i, (_, e) in enumerate(parsed)]
    counts = df2.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(d).alias("rule"), F.col(f"_r{i}").alias("failed_rows"))
        for i, (d, _) in enumerate(parsed)
    ]))
    return counts.select(stack.alias("_s")).select("_s.rule", "_s.failed_rows")


def expectation_observation(df: DataFrame, rules: Sequence, name: str = "dq"):
    """Attach per-rule failure counters to a write (no extra job): returns (df, Observation)."""
    from pyspark.sql import Observation

    obs = Observation(name)
    parsed = _rules(rules)
    exprs = [F.count_if(~F.expr(e)).alias(d) for d, e in parsed] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *exprs), obs
