"""Query catalogue: one Spark plan per operator plus its DuckDB oracle text.

Every query reads the driver's tables (or data Spark derives from them) in
full; results grow with the scale factor. ``register`` keeps the Spark side
and the SQL side next to each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import audit, identity, quality, reconcile, scd
from tidemark.operators import project as proj
from tidemark.operators.rolling import PROVENANCE_COLUMNS
from tidemark.plans import scenario as sc
from tidemark.plans.sqlgen import PROVENANCE_NULLS, hash_sql, identity_sql, scd2_sql
from tidemark.session import scratch_dir
from tidemark.sources import files, incremental
from tidemark.streaming import medallion
from tidemark.streaming.scd_stream import read_target

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, Callable[[], str]] = {}

EVENTS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def register(name: str, sql: Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _cols(cols) -> str:
    return ", ".join(f'"{c}"' for c in cols)


# ── scenario SQL (FIXTURES §3) ─────────────────────────────────────────────────

def _fmt(dt) -> str:
    return dt.strftime("%Y-%m-%d %H:%M:%S")


def _ws(k: int) -> str:
    return _fmt(sc.run(k).window_start(sc.WINDOW_DAYS))


def _foreign_sql(k: int) -> str:
    return (f"SELECT * FROM events WHERE ts < TIMESTAMP '{sc.run(k).text}' "
            f"AND NOT (event_id % {sc.DELETE_MODULUS} < {k})")


def _stamps_sql(k: int) -> str:
    r = sc.run(k)
    return (f"CAST({r.seq} AS BIGINT) AS snapshotseq, TIMESTAMP '{r.text}' AS snapshotts, "
            f"TIMESTAMP '{_ws(k)}' AS windowstart, CAST({sc.WINDOW_DAYS} AS INTEGER) AS windowdays")


def snap_sql(k: int) -> str:
    src = f"{_foreign_sql(k)} AND ts >= TIMESTAMP '{_ws(k)}'"
    ident = identity_sql(src, EVENTS, EVENTS, with_contenthash=True)
    return (f"SELECT {_cols(EVENTS)}, rowhash, rowoccurrence, rowkey, contenthash, 'upsert' AS changetype, "
            f"FALSE AS isdeleted, CAST(NULL AS TIMESTAMP) AS deletedat, {_stamps_sql(k)}, "
            f"TIMESTAMP '{sc.run(k).text}' AS _staging_ingested_at, {PROVENANCE_NULLS} FROM ({ident}) _i")


def _tomb_cols(k: int, kind: str) -> str:
    return (f"{_cols(EVENTS)}, rowhash, rowoccurrence, rowkey, contenthash, '{kind}' AS changetype, "
            f"TRUE AS isdeleted, TIMESTAMP '{sc.run(k).text}' AS deletedat, {_stamps_sql(k)}, "
            f"TIMESTAMP '{sc.run(k).text}' AS _staging_ingested_at, {PROVENANCE_NULLS}")


def vanished_sql(k: int, inside: bool) -> str:
    cmp = ">=" if inside else "<"
    return (f"FROM ({snap_sql(k - 1)}) p WHERE p.ts {cmp} TIMESTAMP '{_ws(k)}' "
            f"AND NOT EXISTS (SELECT 1 FROM ({snap_sql(k)}) c WHERE c.rowkey = p.rowkey)")


def dels_sql(k: int) -> str:
    return f"SELECT {_tomb_cols(k, 'delete')} {vanished_sql(k, True)}"


def stream_sql(upto: int) -> str:
    parts = [snap_sql(0)]
    for k in range(1, upto + 1):
        parts += [dels_sql(k), snap_sql(k)]
    return " UNION ALL ".join(f"({p})" for p in parts)


STREAM_COLS = (EVENTS + ["rowhash", "rowoccurrence", "rowkey", "contenthash", "changetype", "isdeleted",
                         "deletedat", "snapshotseq", "snapshotts", "windowstart", "windowdays",
                         "_staging_ingested_at", "_source_file_path", "_source_file_name",
                         "_source_file_size", "_source_file_modified"])
STREAM_TRACKED = EVENTS + ["rowhash", "contenthash", "isdeleted"]
CHANGE_TIE = "CASE changetype WHEN 'upsert' THEN 3 WHEN 'delete' THEN 2 ELSE 1 END"


def silver_sql(upto: int) -> str:
    return scd2_sql(stream_sql(upto), STREAM_COLS, ["rowkey"], "snapshotseq", STREAM_TRACKED, tie=CHANGE_TIE)


def _open_sql(upto: int, since: str | None = None) -> str:
    scope = f" AND ts >= TIMESTAMP '{since}'" if since else ""
    return f"SELECT rowkey FROM ({silver_sql(upto)}) s WHERE __END_AT IS NULL AND NOT isdeleted{scope}"


def _live_sql(k: int, since: str | None = None) -> str:
    src = _foreign_sql(k) + (f" AND ts >= TIMESTAMP '{since}'" if since else " AND ts IS NOT NULL")
    return f"SELECT rowkey FROM ({identity_sql(src, EVENTS, EVENTS)}) _l"


def _sweep_flags_sql(k: int, since: str | None = None) -> str:
    return f"""
SELECT coalesce(o.rowkey, l.rowkey) AS rowkey, o.rowkey IS NOT NULL AS _open, l.rowkey IS NOT NULL AS _live,
       coalesce(r.rowkey IS NOT NULL, FALSE) AS _rolled
FROM ({_open_sql(k - 1, since)}) o FULL OUTER JOIN ({_live_sql(k, since)}) l ON o.rowkey = l.rowkey
LEFT JOIN (SELECT rowkey FROM ({dels_sql(k)}) _d) r ON r.rowkey = coalesce(o.rowkey, l.rowkey)"""


def _metrics_sql(k: int, since: str | None = None) -> str:
    return f"""
SELECT source_count, open_count, rolling_deleted, orphan_count,
       CASE WHEN open_count > 0 THEN round(100.0 * orphan_count / open_count, 6) END AS orphan_pct
FROM (SELECT CAST(count(*) FILTER (WHERE _live) AS BIGINT) AS source_count,
             CAST(count(*) FILTER (WHERE _open AND NOT _rolled) AS BIGINT) AS open_count,
             CAST(count(*) FILTER (WHERE _open AND _rolled) AS BIGINT) AS rolling_deleted,
             CAST(count(*) FILTER (WHERE _open AND NOT _live AND NOT _rolled) AS BIGINT) AS orphan_count
      FROM ({_sweep_flags_sql(k, since)}) f) m"""


SWEEP_RUN = 2
SCOPE_DAYS = 14


def _scope_since() -> str:
    return _fmt(reconcile.sweep_scope_start(sc.run(SWEEP_RUN), SCOPE_DAYS))


# ── identity ──────────────────────────────────────────────────────────────────

@register("row_fingerprint", lambda: f"SELECT {_cols(ORDERS)}, {hash_sql(ORDERS, 'rowhash')} FROM orders")
def q_row_fingerprint(spark, sf):
    from tidemark.functions.hashing import row_hash
    o = load(spark, sf, "orders")
    return o.withColumn("rowhash", row_hash(o.columns))


LI3 = ["l_returnflag", "l_linestatus", "l_shipdate"]


@register("identity_hash_all",
          lambda: identity_sql(f"SELECT {_cols(LI3)} FROM lineitem", LI3, LI3))
def q_identity_hash_all(spark, sf):
    return identity.add_identity(load(spark, sf, "lineitem").select(*LI3))


@register("identity_key_columns",
          lambda: identity_sql("SELECT * FROM events", EVENTS, ["user_id", "event_type"], with_contenthash=True))
def q_identity_key_columns(spark, sf):
    return identity.add_identity(load(spark, sf, "events"), mode="key_columns",
                                 key_columns=["user_id", "event_type"], with_contenthash=True)


@register("identity_multi_split",
          lambda: identity_sql(f"SELECT {_cols(LI3)} FROM lineitem", LI3, LI3))
def q_identity_multi_split(spark, sf):
    """Copies that lie in many input splits, from one read of the source: rows are tagged and written first."""
    rows = load(spark, sf, "lineitem").select(*LI3).repartition(16)
    return identity.add_identity(rows, stage=scratch_dir(spark, "tidemark-q", "tagged"))


ORD_ID = [c for c in ORDERS if c not in ("o_orderkey", "o_totalprice")]


@register("identity_exclude_columns",
          lambda: identity_sql("SELECT * FROM orders", ORDERS, ORD_ID))
def q_identity_exclude(spark, sf):
    return identity.add_identity(load(spark, sf, "orders"), exclude_columns=["o_orderkey", "o_totalprice"])


@register("multiset_diff", lambda: f"""
SELECT l.orderkey, l.rowoccurrence FROM ({identity_sql('SELECT l_orderkey AS orderkey FROM lineitem', ['orderkey'], ['orderkey'])}) l
WHERE NOT EXISTS (SELECT 1 FROM ({identity_sql('SELECT o_orderkey AS orderkey FROM orders', ['orderkey'], ['orderkey'])}) o
                  WHERE o.rowkey = l.rowkey)""")
def q_multiset_diff(spark, sf):
    """lineitem order keys EXCEPT ALL orders order keys, through rowkeys."""
    li = identity.add_identity(load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey")))
    od = identity.add_identity(load(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey")))
    on = ["_digest", "rowoccurrence"]  # rowkey, as its two parts
    return (identity.rowkey_parts(li).join(identity.rowkey_parts(od).select(*on), on, "left_anti")
            .select("orderkey", "rowoccurrence"))


# ── rolling window ────────────────────────────────────────────────────────────

@register("rolling_snapshot", lambda: snap_sql(0))
def q_rolling_snapshot(spark, sf):
    return sc.Scenario(load(spark, sf, "events")).snap(0)


@register("rolling_deletes", lambda: f"({dels_sql(1)}) UNION ALL ({dels_sql(2)})")
def q_rolling_deletes(spark, sf):
    s = sc.Scenario(load(spark, sf, "events"))
    return s.dels(1).unionByName(s.dels(2))


@register("aged_out_rows", lambda: f"SELECT * {vanished_sql(1, False)}")
def q_aged_out(spark, sf):
    return sc.Scenario(load(spark, sf, "events")).aged(1)


@register("change_stream", lambda: stream_sql(2))
def q_change_stream(spark, sf):
    return sc.Scenario(load(spark, sf, "events")).stream(2)


@register("prior_snapshot_seq", lambda: f"""
SELECT snapshotseq, max(_up) OVER (ORDER BY snapshotseq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
       AS prior_snapshotseq
FROM (SELECT snapshotseq, max(CASE WHEN changetype = 'upsert' THEN snapshotseq END) AS _up
      FROM ({stream_sql(2)}) s GROUP BY snapshotseq) g""")
def q_prior_snapshot_seq(spark, sf):
    """For every run in the stream, the snapshot its delete diff used.

    The window has no partition key on purpose: its input is one row per run.
    """
    from pyspark.sql import Window
    per_run = (sc.Scenario(load(spark, sf, "events")).stream(2)
               .groupBy("snapshotseq")
               .agg(F.max(F.when(F.col("changetype") == "upsert", F.col("snapshotseq"))).alias("_up")))
    w = Window.orderBy("snapshotseq").rowsBetween(Window.unboundedPreceding, -1)
    return per_run.select("snapshotseq", F.max("_up").over(w).alias("prior_snapshotseq"))


# ── SCD ───────────────────────────────────────────────────────────────────────

@register("scd1_latest", lambda: f"""
SELECT {_cols(EVENTS)} FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""")
def q_scd1(spark, sf):
    return scd.scd1(load(spark, sf, "events"), ["user_id"], "ts")


@register("scd2_events", lambda: scd2_sql("SELECT * FROM events", EVENTS, ["user_id"], "ts", ["event_type"]))
def q_scd2_events(spark, sf):
    return scd.scd2(load(spark, sf, "events"), ["user_id"], "ts", track=["event_type"])


@register("scd2_except_track", lambda: scd2_sql("SELECT * FROM events", EVENTS, ["user_id"], "ts",
                                                ["event_type", "props"], drop=["event_id"]))
def q_scd2_except(spark, sf):
    return scd.scd2(load(spark, sf, "events"), ["user_id"], "ts",
                    except_track=["ts", "value", "event_id"], except_columns=["event_id"])


# Events by day: every user has many changes of one sequence.
DAY_EVENTS = EVENTS + ["day"]
DAY_SQL = "SELECT *, CAST(ts AS DATE) AS day FROM events"


def _by_day(spark, sf) -> DataFrame:
    return load(spark, sf, "events").withColumn("day", F.to_date("ts"))


@register("scd1_ties", lambda: f"""
SELECT {_cols(DAY_EVENTS)} FROM ({DAY_SQL}) e
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY day DESC, event_id DESC) = 1""")
def q_scd1_ties(spark, sf):
    """Equal sequences: the tie-break decides, whatever the input order."""
    return scd.scd1(_by_day(spark, sf), ["user_id"], "day", tie_break=F.col("event_id"))


@register("scd2_ties", lambda: scd2_sql(DAY_SQL, DAY_EVENTS, ["user_id"], "day", ["event_type"], tie="event_id"))
def q_scd2_ties(spark, sf):
    """Equal sequences: one change per key and day stays, so no version is empty."""
    return scd.scd2(_by_day(spark, sf), ["user_id"], "day", track=["event_type"], tie_break=F.col("event_id"))


@register("scd2_string_seq", lambda: scd2_sql(
    "SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events", DAY_EVENTS, ["user_id"], "day", ["event_type"],
    tie="event_id"))
def q_scd2_string_seq(spark, sf):
    """History sequenced by a string."""
    ev = load(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return scd.scd2(ev, ["user_id"], "day", track=["event_type"], tie_break=F.col("event_id"))


ISO_SQL = "SELECT *, 1 AS k, strftime(ts, '%Y-%m-%d %H:%M') AS at FROM events"


@register("scd2_hot_iso_dates", lambda: scd2_sql(ISO_SQL, EVENTS + ["k", "at"], ["k"], "at", ["event_type"], tie="event_id"))
def q_scd2_hot_iso_dates(spark, sf):
    """All events are one key's history, ordered by ISO date strings with a long common head."""
    ev = load(spark, sf, "events").withColumn("k", F.lit(1)).withColumn("at", F.date_format("ts", "yyyy-MM-dd HH:mm"))
    return scd.scd2(ev, ["k"], "at", track=["event_type"], tie_break=F.col("event_id"), hot_key_rows=200)


@register("scd2_hot_key", lambda: scd2_sql("SELECT *, 1 AS k FROM events", EVENTS + ["k"], ["k"], "ts",
                                           ["event_type"], tie="event_id"))
def q_scd2_hot_key(spark, sf):
    """All events under one key: versioned in sequence chunks and stitched."""
    ev = load(spark, sf, "events").withColumn("k", F.lit(1))
    return scd.scd2(ev, ["k"], "ts", track=["event_type"], tie_break=F.col("event_id"), hot_key_rows=100)


@register("scd2_change_stream", lambda: silver_sql(2))
def q_scd2_change_stream(spark, sf):
    return sc.Scenario(load(spark, sf, "events")).silver(2)


@register("live_rows", lambda: f"SELECT * FROM ({silver_sql(2)}) s WHERE __END_AT IS NULL AND NOT isdeleted")
def q_live_rows(spark, sf):
    return scd.live_rows(sc.Scenario(load(spark, sf, "events")).silver(2))


@register("lifespans", lambda: f"""
SELECT *, CAST((epoch_us(__END_AT) - epoch_us(__START_AT)) // 1000000 AS BIGINT) AS lifespan
FROM ({scd2_sql('SELECT * FROM events', EVENTS, ['user_id'], 'ts', ['event_type'])}) s WHERE __END_AT IS NOT NULL""")
def q_lifespans(spark, sf):
    return scd.lifespan(scd.scd2(load(spark, sf, "events"), ["user_id"], "ts", track=["event_type"]))


# ── reconciliation sweep ──────────────────────────────────────────────────────

@register("sweep_orphans", lambda: f"""
SELECT rowkey, _rolled AS also_rolling_delete FROM ({_sweep_flags_sql(SWEEP_RUN)}) f WHERE _open AND NOT _live""")
def q_sweep_orphans(spark, sf):
    s = sc.Scenario(load(spark, sf, "events"))
    open_k, live_k, rolled = s.sweep_parts(SWEEP_RUN)
    return (reconcile.compare(open_k, live_k, rolled)
            .where(F.col("_open") & ~F.col("_live"))
            .select("rowkey", F.col("_rolled").alias("also_rolling_delete")))


@register("sweep_metrics", lambda: _metrics_sql(SWEEP_RUN))
def q_sweep_metrics(spark, sf):
    s = sc.Scenario(load(spark, sf, "events"))
    return reconcile.sweep_metrics(*s.sweep_parts(SWEEP_RUN))


@register("sweep_scoped", lambda: _metrics_sql(SWEEP_RUN, _scope_since()))
def q_sweep_scoped(spark, sf):
    s = sc.Scenario(load(spark, sf, "events"))
    return reconcile.sweep_metrics(*s.sweep_parts(SWEEP_RUN, max_age_days=SCOPE_DAYS))


@register("sweep_tombstones", lambda: f"""
SELECT {_tomb_cols(SWEEP_RUN, 'reconcile')} FROM (
  SELECT * FROM ({stream_sql(SWEEP_RUN - 1)}) h
  WHERE changetype = 'upsert' AND rowkey IN (SELECT rowkey FROM ({_sweep_flags_sql(SWEEP_RUN)}) f
                                             WHERE _open AND NOT _live AND NOT _rolled)
  QUALIFY row_number() OVER (PARTITION BY rowkey ORDER BY snapshotseq DESC) = 1) p""")
def q_sweep_tombstones(spark, sf):
    s = sc.Scenario(load(spark, sf, "events"))
    orph = reconcile.orphans(*s.sweep_parts(SWEEP_RUN))
    return reconcile.tombstones(s.stream(SWEEP_RUN - 1), orph, sc.run(SWEEP_RUN), sc.SPEC,
                                silver=s.silver(SWEEP_RUN - 1))


@register("sweep_due_matrix", lambda: """
SELECT event_id, ts AS run_ts, last_sweep,
  CASE WHEN last_sweep IS NULL THEN 'initial'
       WHEN dayofweek(ts) = 1 AND epoch_us(ts) - epoch_us(last_sweep) >= 72000000000 THEN 'weekday'
       WHEN epoch_us(ts) - epoch_us(last_sweep) >= 2 * 86400000000 THEN 'cadence'
       ELSE 'not_due' END AS "trigger"
FROM (SELECT event_id, ts, CASE WHEN event_type = 'signup' THEN NULL
                                ELSE ts - to_hours(CAST(floor(value) AS BIGINT)) END AS last_sweep
      FROM events) e""")
def q_sweep_due_matrix(spark, sf):
    """Trigger decision (weekday MON, cadence 2 days) for one (run, last completed
    sweep) pair per event: the run is the event time, the last sweep lies
    ``floor(value)`` hours earlier, and a signup stands for "never swept".
    A pure projection: no shuffle, so no key can be hot."""
    ev = load(spark, sf, "events")
    last = F.expr("CASE WHEN event_type = 'signup' THEN NULL "
                  "ELSE ts - make_dt_interval(0, CAST(floor(value) AS INT), 0, 0) END")
    e = ev.select("event_id", F.col("ts").alias("run_ts"), last.alias("last_sweep"))
    return e.withColumn("trigger", reconcile.sweep_trigger_col(F.col("run_ts"), F.col("last_sweep"),
                                                               cadence_days=2, weekday="MON"))


# ── data quality ──────────────────────────────────────────────────────────────

# Rules of the DQ fixture (FIXTURES §4): r1 is null for status P.
DQ_RULES = [("status_final", "nullif(o_orderstatus, 'P') = 'F'"),
            ("price_over_100k", "o_totalprice > 100000")]


def _dq_tagged_sql() -> str:
    arr = ", ".join(f"CASE WHEN NOT ({e}) THEN '{d}' END" for d, e in DQ_RULES)
    return f"SELECT *, list_filter([{arr}], lambda x: x IS NOT NULL) AS _failed_dq_rules FROM orders"


@register("dq_gate", lambda: "SELECT * FROM orders WHERE " +
          " AND ".join(f"(({e}) IS NOT FALSE)" for _, e in DQ_RULES))
def q_dq_gate(spark, sf):
    return quality.gate(load(spark, sf, "orders"), DQ_RULES)


@register("dq_quarantine", lambda: f"""
SELECT *, TIMESTAMP '{sc.RUN0.text}' AS _quarantine_timestamp, 'orders' AS _source_table
FROM ({_dq_tagged_sql()}) t WHERE len(_failed_dq_rules) > 0""")
def q_dq_quarantine(spark, sf):
    return quality.quarantine(load(spark, sf, "orders"), DQ_RULES, "orders", sc.RUN0)


@register("dq_metrics", lambda: " UNION ALL ".join(
    f"SELECT '{d}' AS rule, CAST(count(*) FILTER (WHERE NOT ({e})) AS BIGINT) AS failed_rows FROM orders"
    for d, e in DQ_RULES))
def q_dq_metrics(spark, sf):
    return quality.rule_failures(load(spark, sf, "orders"), DQ_RULES)


# Same rules written against user-facing (renamed) Silver names.
DQ_RENAMES = {"o_orderstatus": "status", "o_totalprice": "total price"}
DQ_RULES_RENAMED = [("status_final", "nullif(status, 'P') = 'F'"),
                    ("price_over_100k", "`total price` > 100000")]


@register("dq_renamed_rules", lambda: f"""
SELECT *, TIMESTAMP '{sc.RUN0.text}' AS _quarantine_timestamp, 'orders' AS _source_table
FROM ({_dq_tagged_sql()}) t WHERE len(_failed_dq_rules) > 0""")
def q_dq_renamed(spark, sf):
    aliases = {user: raw for raw, user in DQ_RENAMES.items()}
    return quality.quarantine(load(spark, sf, "orders"), DQ_RULES_RENAMED, "orders", sc.RUN0, aliases=aliases)


# ── incremental / full loads ──────────────────────────────────────────────────


LOAD_RUN = sc.RUN0
# The source as the first incremental run saw it (orders placed up to then).
FIRST_LOAD_UNTIL = "2000-12-31 00:00:00"
LOAD_WHERE = "o_orderstatus <> 'P'"
LOAD_SELECT = ["o_orderkey", "o_custkey", "o_totalprice"]
PROV_SQL = f"TIMESTAMP '{LOAD_RUN.text}' AS _staging_ingested_at, {PROVENANCE_NULLS}"


@register("load_full", lambda: f"SELECT o_orderkey, o_custkey, o_totalprice, {PROV_SQL} FROM orders WHERE {LOAD_WHERE}")
def q_load_full(spark, sf):
    return incremental.full_load(load(spark, sf, "orders"), LOAD_RUN, LOAD_WHERE, LOAD_SELECT)


def _first_load(spark, sf, **kw):
    o = load(spark, sf, "orders")
    return incremental.incremental_load(o.where(F.col("o_orderdate") <= F.lit(FIRST_LOAD_UNTIL).cast("timestamp_ntz")),
                                        LOAD_RUN, None, **kw)


_MARK_SQL = f"(SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '{FIRST_LOAD_UNTIL}')"


@register("load_incremental", lambda: f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, {PROV_SQL} FROM orders
WHERE o_orderdate > {_MARK_SQL} AND {LOAD_WHERE}""")
def q_load_incremental(spark, sf):
    """Second run: rows above the mark left by the first run (select omits the
    watermark column; it is kept anyway)."""
    first = _first_load(spark, sf, column="o_orderdate")
    mark = incremental.last_watermark(first, "o_orderdate")
    return incremental.incremental_load(load(spark, sf, "orders"), LOAD_RUN, mark, column="o_orderdate",
                                        where=LOAD_WHERE, select=LOAD_SELECT)


WM_EXPR = "to_date(o_orderdate)"


@register("load_incremental_expr", lambda: f"""
SELECT {_cols(ORDERS)}, CAST(o_orderdate AS DATE) AS _federated_watermark, {PROV_SQL} FROM orders
WHERE CAST(o_orderdate AS DATE) > CAST({_MARK_SQL} AS DATE)""")
def q_load_incremental_expr(spark, sf):
    first = _first_load(spark, sf, expression=WM_EXPR)
    mark = incremental.last_watermark(first, incremental.WATERMARK_COLUMN)
    return incremental.incremental_load(load(spark, sf, "orders"), LOAD_RUN, mark, expression=WM_EXPR)


@register("high_water_mark", lambda: f"""
SELECT max(o_orderdate) AS high_water_mark, CAST(count(*) AS BIGINT) AS rows_loaded FROM (
  SELECT o_orderdate FROM orders WHERE o_orderdate <= TIMESTAMP '{FIRST_LOAD_UNTIL}'
  UNION ALL SELECT o_orderdate FROM orders WHERE o_orderdate > {_MARK_SQL}) t""")
def q_high_water_mark(spark, sf):
    """Mark over the public table (first load + delta), never over the last delta alone."""
    first = _first_load(spark, sf, column="o_orderdate")
    mark = incremental.last_watermark(first, "o_orderdate")
    delta = incremental.incremental_load(load(spark, sf, "orders"), LOAD_RUN, mark, column="o_orderdate")
    public = first.unionByName(delta)
    return public.agg(F.max("o_orderdate").alias("high_water_mark"), F.count(F.lit(1)).alias("rows_loaded"))


def _load_run_sql(k: int, where: str) -> str:
    r = sc.run(k)
    return (f"SELECT {_cols(ORDERS)}, TIMESTAMP '{r.text}' AS _staging_ingested_at, {PROVENANCE_NULLS}, "
            f"CAST({r.seq} AS BIGINT) AS _run FROM orders WHERE {where}")


@register("load_runs", lambda: " UNION ALL ".join([
    _load_run_sql(0, f"o_orderdate <= TIMESTAMP '{FIRST_LOAD_UNTIL}'"),
    _load_run_sql(2, f"o_orderdate > {_MARK_SQL}")]))
def q_load_runs(spark, sf):
    """Three persisted incremental runs into one public table: the first sees
    orders up to 2000-12-31, the second the same source (empty delta), the
    third the whole table (only rows above the mark kept from run one)."""
    o = load(spark, sf, "orders")
    first = o.where(F.col("o_orderdate") <= F.lit(FIRST_LOAD_UNTIL).cast("timestamp_ntz"))
    path = scratch_dir(spark, "tidemark-q", "loads")
    for k, source in enumerate([first, first, o]):
        incremental.run_load(spark, source, path, sc.run(k), "incremental", column="o_orderdate")
    return spark.read.parquet(path)


# ── projection / names ────────────────────────────────────────────────────────


RENAME_COLS = [{"name": "c_custkey", "rename": "customer id"}, {"name": "c_name", "rename": "Name"},
               {"name": "c_acctbal"}]


@register("project_rename", lambda: 'SELECT c_custkey AS customerid, c_name AS "Name", c_acctbal AS cacctbal FROM customer')
def q_project_rename(spark, sf):
    return proj.project(load(spark, sf, "customer"), RENAME_COLS).df


@register("project_missing", lambda: "SELECT c_custkey AS ccustkey, CAST(NULL AS VARCHAR) AS cphone FROM customer")
def q_project_missing(spark, sf):
    return proj.project(load(spark, sf, "customer"), [{"name": "c_custkey"}, {"name": "c_phone"}],
                        allow_missing=True).df


@register("normalize_names", lambda: """
SELECT c_custkey AS ccustkey, c_name AS cname, c_nationkey AS cnationkey, c_acctbal AS cacctbal FROM customer""")
def q_normalize_names(spark, sf):
    return proj.project(load(spark, sf, "customer"), None, exclude_columns=["c_mktsegment"]).df


# ── files ─────────────────────────────────────────────────────────────────────


CUSTOMER_SQL = f"SELECT {_cols(CUSTOMER)} FROM customer"
CUSTOMER_RESCUED_SQL = f"SELECT {_cols(CUSTOMER)}, CAST(NULL AS VARCHAR) AS _rescued_data FROM customer"


def _ingest(spark, src: files.FileSource, base: str, schema=None) -> DataFrame:
    medallion.ingest_staging(spark, src, f"{base}/staging", f"{base}/ckpt", schema, sc.RUN0.ts_col())
    staged = spark.read.option("mergeSchema", "true").parquet(f"{base}/staging")
    return staged.drop(*PROVENANCE_COLUMNS, medallion.LISTING_COL)


@register("file_ingest_json", lambda: CUSTOMER_RESCUED_SQL)
def q_file_json(spark, sf):
    base = scratch_dir(spark, "tidemark-q", "json")
    load(spark, sf, "customer").write.json(f"{base}/in")
    return _ingest(spark, files.FileSource(f"{base}/in", "json", schema_hints="c_nationkey int"), base)


@register("file_ingest_csv", lambda: CUSTOMER_RESCUED_SQL)
def q_file_csv(spark, sf):
    base = scratch_dir(spark, "tidemark-q", "csv")
    load(spark, sf, "customer").write.option("header", True).option("sep", "|").csv(f"{base}/in")
    src = files.FileSource(f"{base}/in", "csv", schema_hints="c_custkey bigint",
                           csv_options={"header": True, "delimiter": "|"})
    return _ingest(spark, src, base)


@register("file_ingest_parquet", lambda: CUSTOMER_RESCUED_SQL)
def q_file_parquet(spark, sf):
    base = scratch_dir(spark, "tidemark-q", "parquet")
    load(spark, sf, "customer").write.parquet(f"{base}/in")
    return _ingest(spark, files.FileSource(f"{base}/in", "parquet"), base)


@register("file_ingest_orc", lambda: CUSTOMER_RESCUED_SQL)
def q_file_orc(spark, sf):
    base = scratch_dir(spark, "tidemark-q", "orc")
    load(spark, sf, "customer").write.orc(f"{base}/in")
    return _ingest(spark, files.FileSource(f"{base}/in", "orc"), base)


def _customer_line():
    return F.concat_ws("|", *[F.col(c).cast("string") for c in CUSTOMER])


@register("file_ingest_text", lambda: f"SELECT concat_ws('|', {_cols(CUSTOMER)}) AS value FROM customer")
def q_file_text(spark, sf):
    base = scratch_dir(spark, "tidemark-q", "text")
    load(spark, sf, "customer").select(_customer_line().alias("value")).write.text(f"{base}/in")
    return _ingest(spark, files.FileSource(f"{base}/in", "text"), base)


@register("file_ingest_binary", lambda: CUSTOMER_SQL)
def q_file_binary(spark, sf):
    """binaryFile ingestion, then the JSON lines inside each file's bytes are decoded."""
    base = scratch_dir(spark, "tidemark-q", "binary")
    cust = load(spark, sf, "customer")
    cust.write.json(f"{base}/in")
    raw = _ingest(spark, files.FileSource(f"{base}/in", "binaryfile", file_name_pattern="*.json"), base)
    lines = raw.select(F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line")).where("line <> ''")
    return lines.select(F.from_json("line", cust.schema).alias("r")).select("r.*")


@register("file_glob", lambda: CUSTOMER_RESCUED_SQL)
def q_file_glob(spark, sf):
    base = scratch_dir(spark, "tidemark-q", "glob")
    cust = load(spark, sf, "customer")
    cust.write.json(f"{base}/in")
    cust.write.mode("append").option("header", True).csv(f"{base}/in")      # noise: must be skipped
    src = files.FileSource(f"{base}/in", "json", file_name_pattern="*.json", schema_hints="c_nationkey int")
    return _ingest(spark, src, base)


@register("file_partitions", lambda: CUSTOMER_RESCUED_SQL)
def q_file_partitions(spark, sf):
    base = scratch_dir(spark, "tidemark-q", "parts")
    load(spark, sf, "customer").write.partitionBy("c_mktsegment").parquet(f"{base}/in")
    src = files.FileSource(f"{base}/in", "parquet", partition_columns=["c_mktsegment"])
    return _ingest(spark, src, base)


@register("file_discover", lambda: CUSTOMER_SQL)
def q_file_discover(spark, sf):
    """Files present at first start are skipped; files arriving later are taken."""
    base = scratch_dir(spark, "tidemark-q", "discover")
    cust = load(spark, sf, "customer")
    cust.write.json(f"{base}/in/first")
    src = files.FileSource(f"{base}/in", "parquet", include_existing_files=False, file_name_pattern="*.parquet")
    assert files.discover_files(spark, src, None).count() == 0
    files.list_files(spark, files.FileSource(f"{base}/in", "json")).write.parquet(f"{base}/ledger")
    cust.write.parquet(f"{base}/in/second")
    new = files.discover_files(spark, src, spark.read.parquet(f"{base}/ledger"))
    paths = [r["path"] for r in new.select("path").toLocalIterator()]
    return files.read_files(spark, src, paths, cust.schema).select(*CUSTOMER)


def _deliver(spark, df: DataFrame, base: str, modified_ms: int | None = None) -> None:
    """JSON files named by task under ``base/in``: a second delivery overwrites the first one's in place."""
    made = scratch_dir(spark, "tidemark-q", "delivery")
    df.write.json(f"{made}/out")
    new = spark._jvm.org.apache.hadoop.fs.Path
    fs = new(base).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(new(f"{base}/in"))
    for status in fs.globStatus(new(f"{made}/out/part-*")):
        target = new(f"{base}/in/{status.getPath().getName()[:10]}-{'late' if modified_ms else 'file'}.json")
        fs.delete(target, False)
        fs.rename(status.getPath(), target)
        if modified_ms:
            fs.setTimes(target, modified_ms, -1)


def _raised(cust: DataFrame) -> DataFrame:
    return cust.withColumn("c_acctbal", F.col("c_acctbal") + 1)


RAISED_SQL = f"SELECT {_cols(CUSTOMER)} FROM (SELECT * REPLACE (c_acctbal + 1 AS c_acctbal) FROM customer)"


@register("file_overwrite", lambda: f"{CUSTOMER_SQL} UNION ALL {RAISED_SQL}")
def q_file_overwrite(spark, sf):
    """Files rewritten in place between two ingestions are taken again."""
    base = scratch_dir(spark, "tidemark-q", "overwrite")
    cust = load(spark, sf, "customer").select(*CUSTOMER)
    src = files.FileSource(f"{base}/in", "json", schema_evolution_mode="none", allow_overwrites=True)
    _deliver(spark, cust, base)
    _ingest(spark, src, base, cust.schema)
    _deliver(spark, _raised(cust), base)
    return _ingest(spark, src, base, cust.schema)


@register("file_skip_existing", lambda: RAISED_SQL)
def q_file_skip_existing(spark, sf):
    """Files present at the first start are skipped by the stream, later ones are taken."""
    base = scratch_dir(spark, "tidemark-q", "skip")
    cust = load(spark, sf, "customer").select(*CUSTOMER)
    src = files.FileSource(f"{base}/in", "json", schema_evolution_mode="none", include_existing_files=False)
    cust.write.json(f"{base}/in")
    _ingest(spark, src, base, cust.schema)
    _raised(cust).write.mode("append").json(f"{base}/in")
    return _ingest(spark, src, base, cust.schema)


@register("file_backfill", lambda: f"{CUSTOMER_SQL} UNION ALL {RAISED_SQL}")
def q_file_backfill(spark, sf):
    """With a backfill interval, files that arrive with an old modification time are found."""
    base = scratch_dir(spark, "tidemark-q", "backfill")
    cust = load(spark, sf, "customer").select(*CUSTOMER)
    src = files.FileSource(f"{base}/in", "json", schema_evolution_mode="none", backfill_interval="1 day")
    _deliver(spark, cust, base)
    _ingest(spark, src, base, cust.schema)
    _deliver(spark, _raised(cust), base, modified_ms=1_000_000_000_000)
    return _ingest(spark, src, base, cust.schema)


@register("json_partitions", lambda: CUSTOMER_RESCUED_SQL)
def q_json_partitions(spark, sf):
    """Partition values of JSON folders come from the paths, also where misfits are rescued."""
    base = scratch_dir(spark, "tidemark-q", "json-parts")
    cust = load(spark, sf, "customer").select(*CUSTOMER)
    cust.write.partitionBy("c_mktsegment").json(f"{base}/in")
    src = files.FileSource(f"{base}/in", "json", partition_columns=["c_mktsegment"])
    return _ingest(spark, src, base, cust.schema)


@register("schema_evolve_two_runs", lambda: f"""
SELECT {_cols(CUSTOMER[:-1])}, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer UNION ALL {RAISED_SQL}""")
def q_schema_evolve_two_runs(spark, sf):
    """A column that first appears in the second delivery reaches Bronze."""
    base = scratch_dir(spark, "tidemark-q", "evolve")
    cust = load(spark, sf, "customer").select(*CUSTOMER)
    hints = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cust.schema.fields[:-1])
    src = files.FileSource(f"{base}/in", "json", schema_evolution_mode="addNewColumns", schema_hints=hints)
    for delivery in (cust.drop(CUSTOMER[-1]), _raised(cust)):
        delivery.write.mode("append").json(f"{base}/in")
        _ingest(spark, src, base)
        medallion.ingest_bronze(spark, f"{base}/staging", f"{base}/bronze", f"{base}/ck2", sc.RUN0.ts_col())
    return spark.read.option("mergeSchema", "true").parquet(f"{base}/bronze").select(*CUSTOMER)


# ── schema evolution / rescue ─────────────────────────────────────────────────

STORED = "event_id bigint, k int"


def _event_docs(spark, sf, base) -> str:
    ev = load(spark, sf, "events")
    doc = F.to_json(F.struct("event_id", F.from_json("props", "k int").getField("k").alias("k"),
                             "event_type", F.col("value").cast("string").alias("value")))
    ev.select(doc.alias("value")).write.text(f"{base}/in")
    return f"{base}/in"


K_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


@register("schema_rescue", lambda: f"""
SELECT event_id, {K_SQL} AS k, CAST(NULL AS INTEGER) AS value,
       '{{"event_type":"' || event_type || '","value":"' || CAST(value AS VARCHAR) || '"}}' AS _rescued_data
FROM events""")
def q_schema_rescue(spark, sf):
    """Unknown key (event_type) and mistyped value (string for an int) are rescued."""
    base = scratch_dir(spark, "tidemark-q", "rescue")
    path = _event_docs(spark, sf, base)
    schema = files.parse_hints(spark, STORED + ", value int")
    return _ingest(spark, files.FileSource(path, "json"), base, schema)


@register("schema_add", lambda: f"""
SELECT event_id, {K_SQL} AS k, event_type, CAST(value AS VARCHAR) AS value FROM events""")
def q_schema_add(spark, sf):
    base = scratch_dir(spark, "tidemark-q", "add")
    path = _event_docs(spark, sf, base)
    src = files.FileSource(path, "json", schema_evolution_mode="addNewColumns")
    schema = files.evolve_schema(files.parse_hints(spark, STORED), files.resolve_schema(spark, src),
                                 "addNewColumns")
    return _ingest(spark, src, base, schema)


@register("schema_none", lambda: f"SELECT event_id, {K_SQL} AS k FROM events")
def q_schema_none(spark, sf):
    base = scratch_dir(spark, "tidemark-q", "none")
    path = _event_docs(spark, sf, base)
    src = files.FileSource(path, "json", schema_evolution_mode="none")
    schema = files.evolve_schema(files.parse_hints(spark, STORED), files.resolve_schema(spark, src), "none")
    return _ingest(spark, src, base, schema)


@register("json_nested_rescue", lambda: f"""
SELECT event_id, user_id AS "user", CAST(NULL AS INTEGER) AS k, [event_type, 'all'] AS names,
       '{{"tags":[{{"level":' || (event_id % 7) || '}},null],"who":{{"k":"x' || event_id || '","score":1}}}}' AS _rescued_data
FROM events""")
def q_json_nested_rescue(spark, sf):
    """Inside objects and arrays of objects, unknown keys and mistyped values are rescued at their path."""
    base = scratch_dir(spark, "tidemark-q", "nested")
    ev = load(spark, sf, "events")
    who = F.struct(F.col("user_id").alias("user"), F.concat(F.lit("x"), "event_id").alias("k"), F.lit(1).alias("score"))
    tags = F.array(F.struct(F.col("event_type").alias("name"), (F.col("event_id") % 7).alias("level")),
                   F.struct(F.lit("all").alias("name"), F.lit(None).cast("bigint").alias("level")))
    ev.select("event_id", who.alias("who"), tags.alias("tags")).write.json(f"{base}/in")
    schema = files.parse_hints(spark, "event_id bigint, who struct<user: bigint, k: int>, tags array<struct<name: string>>")
    out = _ingest(spark, files.FileSource(f"{base}/in", "json"), base, schema)
    return out.select("event_id", "who.user", "who.k", F.col("tags.name").alias("names"), "_rescued_data")


CSV = {"header": True, "delimiter": "|"}


@register("csv_reordered", lambda: f"{CUSTOMER_RESCUED_SQL} UNION ALL {CUSTOMER_RESCUED_SQL}")
def q_csv_reordered(spark, sf):
    """Two deliveries whose headers name the columns in different orders are read by name."""
    base = scratch_dir(spark, "tidemark-q", "csv-order")
    cust = load(spark, sf, "customer").select(*CUSTOMER)
    for columns in (CUSTOMER, CUSTOMER[::-1]):
        cust.select(*columns).write.mode("append").option("header", True).option("sep", "|").csv(f"{base}/in")
    return _ingest(spark, files.FileSource(f"{base}/in", "csv", csv_options=CSV), base, cust.schema)


@register("csv_extra", lambda: f"""{CUSTOMER_RESCUED_SQL} UNION ALL
SELECT {_cols(CUSTOMER)}, '{{"c_level":"' || (c_custkey % 5) || '"}}' AS _rescued_data
FROM (SELECT * REPLACE (CAST(NULL AS VARCHAR) AS c_mktsegment) FROM customer)""")
def q_csv_extra(spark, sf):
    """A later delivery lacks one column and brings an unknown one, which is rescued."""
    base = scratch_dir(spark, "tidemark-q", "csv-extra")
    cust = load(spark, sf, "customer").select(*CUSTOMER)
    src = files.FileSource(f"{base}/in", "csv", csv_options=CSV)
    late = cust.drop("c_mktsegment").withColumn("c_level", F.col("c_custkey") % 5)
    for rows in (cust, late.select("c_level", *late.columns[:-1])):
        rows.write.mode("append").option("header", True).option("sep", "|").csv(f"{base}/in")
        out = _ingest(spark, src, base, cust.schema)
    return out


def _q_columnar_rescue(spark, sf, fmt: str) -> DataFrame:
    base = scratch_dir(spark, "tidemark-q", f"{fmt}-rescue")
    cust = load(spark, sf, "customer").select(*CUSTOMER)
    src = files.FileSource(f"{base}/in", fmt)
    odd = cust.withColumns({"c_nationkey": F.concat(F.lit("n"), "c_nationkey"),
                            "c_origin": F.struct(F.lit("web").alias("via"), (F.col("c_custkey") % 3).alias("step"))})
    for rows in (cust, odd):
        rows.write.mode("append").format(fmt).save(f"{base}/in")
        out = _ingest(spark, src, base)
    return out


COLUMNAR_RESCUE_SQL = f"""{CUSTOMER_RESCUED_SQL} UNION ALL
SELECT c_custkey, c_name, CAST(NULL AS INTEGER) AS c_nationkey, c_acctbal, c_mktsegment,
       '{{"c_nationkey":"n' || c_nationkey || '","c_origin":{{"via":"web","step":' || (c_custkey % 3) || '}}}}' AS _rescued_data
FROM customer"""


@register("parquet_rescue", lambda: COLUMNAR_RESCUE_SQL)
def q_parquet_rescue(spark, sf):
    """Files with a column of another type and an unknown nested column beside files of the stored schema."""
    return _q_columnar_rescue(spark, sf, "parquet")


@register("orc_rescue", lambda: COLUMNAR_RESCUE_SQL)
def q_orc_rescue(spark, sf):
    return _q_columnar_rescue(spark, sf, "orc")


# ── chained streams ───────────────────────────────────────────────────────────

CHAIN_RULES = [("positive_balance", "c_acctbal > 0")]


@register("bronze_chain", lambda: f"""
SELECT c_custkey AS ccustkey, c_name AS cname, c_nationkey AS cnationkey, c_acctbal AS cacctbal,
       c_mktsegment AS cmktsegment, TIMESTAMP '{sc.RUN0.text}' AS __START_AT, CAST(NULL AS TIMESTAMP) AS __END_AT
FROM customer WHERE (c_acctbal > 0) IS NOT FALSE""")
def q_bronze_chain(spark, sf):
    """customer files -> staging -> bronze -> silver (DQ gate, SELECT * names, SCD2)."""
    base = scratch_dir(spark, "tidemark-q", "chain")
    load(spark, sf, "customer").write.parquet(f"{base}/in")
    at = sc.RUN0.ts_col()
    medallion.ingest_staging(spark, files.FileSource(f"{base}/in", "parquet"), f"{base}/staging",
                             f"{base}/ck1", ingested_at=at)
    medallion.ingest_bronze(spark, f"{base}/staging", f"{base}/bronze", f"{base}/ck2", ingested_at=at)
    spec = medallion.SilverSpec("customer", ["c_custkey"], data_quality_rules=CHAIN_RULES, buckets=8)
    sink = medallion.SilverSink(spark, spec, f"{base}/silver", f"{base}/quarantine", f"{base}/log", sc.RUN0)
    medallion.run_silver(spark, f"{base}/bronze", sink, f"{base}/ck3")
    silver = read_target(spark, f"{base}/silver")
    return silver.select("ccustkey", "cname", "cnationkey", "cacctbal", "cmktsegment", "__START_AT", "__END_AT")


@register("scd2_stream_events", lambda: scd2_sql("SELECT * FROM events", EVENTS, ["user_id"], "ts", ["event_type"]))
def q_scd2_stream(spark, sf):
    """Events arrive in four files, one per micro-batch, out of time order per key."""
    from tidemark.streaming.scd_stream import ScdSink, scd2_stream
    base = scratch_dir(spark, "tidemark-q", "scdstream")
    ev = load(spark, sf, "events")
    # As many files as the input has, four at least, each with all users' events of any time.
    ev.repartition(max(4, len(ev.inputFiles())), "event_id").write.parquet(f"{base}/in")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    sink = ScdSink(spark, f"{base}/log", f"{base}/target", ["user_id"], "ts", track=["event_type"], buckets=8)
    scd2_stream(stream, sink, f"{base}/ckpt")
    return read_target(spark, f"{base}/target")


@register("scd1_stream_events", lambda: f"""
SELECT {_cols(EVENTS)} FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""")
def q_scd1_stream(spark, sf):
    """Streaming SCD type 1: four out-of-order micro-batches folded into latest rows."""
    from tidemark.streaming.scd_stream import ScdSink, scd2_stream
    base = scratch_dir(spark, "tidemark-q", "scd1stream")
    ev = load(spark, sf, "events")
    # As many files as the input has, four at least, each with all users' events of any time.
    ev.repartition(max(4, len(ev.inputFiles())), "event_id").write.parquet(f"{base}/in")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    sink = ScdSink(spark, f"{base}/log", f"{base}/target", ["user_id"], "ts", scd_type=1, buckets=8)
    scd2_stream(stream, sink, f"{base}/ckpt")
    return read_target(spark, f"{base}/target")


@register("change_capture_runs", lambda: f"""({stream_sql(2)}) UNION ALL (
SELECT {_tomb_cols(SWEEP_RUN, 'reconcile')} FROM (
  SELECT * FROM ({stream_sql(SWEEP_RUN - 1)}) h
  WHERE changetype = 'upsert' AND rowkey IN (SELECT rowkey FROM ({_sweep_flags_sql(SWEEP_RUN)}) f
                                             WHERE _open AND NOT _live AND NOT _rolled)
  QUALIFY row_number() OVER (PARTITION BY rowkey ORDER BY snapshotseq DESC) = 1) p)""")
def q_change_capture_runs(spark, sf):
    """Three persisted runs (snapshot + deletes, sweep at run 2) read back from the store."""
    return _cc_store(spark, sf).stream().select(*STREAM_COLS)


def _cc_store(spark, sf, bucketed: bool = False):
    import os
    from tidemark.streaming.change_capture import ChangeStore, SweepSpec, run_once
    ev = load(spark, sf, "events")
    base = scratch_dir(spark, "tidemark-q", "cc")
    table = f"tidemark_cc_{os.path.basename(base)}" if bucketed else None
    store = ChangeStore(spark, base, table=table, buckets=8 if bucketed else None)
    for k in range(3):
        sweep = SweepSpec(enabled=(k == SWEEP_RUN))
        silver = scd.change_stream_scd2(store.stream()) if k == SWEEP_RUN else None
        run_once(spark, sc.foreign(ev, k), store, sc.run(k), sc.SPEC, sweep, silver, "events")
    return store


@register("change_capture_bucketed", lambda: ORACLES["change_capture_runs"]())
def q_change_capture_bucketed(spark, sf):
    """The same three persisted runs with the rowkey-bucketed catalog store."""
    store = _cc_store(spark, sf, bucketed=True)
    rows = store.stream().select(*STREAM_COLS)
    path = scratch_dir(spark, "tidemark-q", "bucketed")
    rows.write.parquet(path)
    spark.sql(f"DROP TABLE {store.table}")  # the catalog entry; its files are the store's
    return spark.read.parquet(path)


@register("delete_after_guard_failure", lambda: stream_sql(2))
def q_delete_after_guard_failure(spark, sf):
    """A sweep guard fails run 1; run 2 still finds every row deleted since run 1's snapshot."""
    from tidemark.streaming.change_capture import ChangeStore, SweepSpec, run_once
    ev = load(spark, sf, "events")
    store = ChangeStore(spark, scratch_dir(spark, "tidemark-q", "guard"))
    for k in range(3):
        strict = SweepSpec(enabled=(k == 1), min_source_rows=10 ** 15)
        silver = scd.change_stream_scd2(store.stream()) if k == 1 else None
        try:
            run_once(spark, sc.foreign(ev, k), store, sc.run(k), sc.SPEC, strict, silver, "events")
        except ValueError as refused:
            if "min_source_rows" not in str(refused):
                raise
    return store.stream().select(*STREAM_COLS)


@register("rerun_to_bronze", lambda: stream_sql(1))
def q_rerun_to_bronze(spark, sf):
    """A committed run started again after Bronze has read it: Bronze holds each event once."""
    from tidemark.streaming.change_capture import ChangeStore, run_once
    ev = load(spark, sf, "events")
    base = scratch_dir(spark, "tidemark-q", "rerun")
    store = ChangeStore(spark, f"{base}/store")
    for k in (0, 1, 1):
        run_once(spark, sc.foreign(ev, k), store, sc.run(k), sc.SPEC, source_table="events")
        medallion.ingest_bronze(spark, store, f"{base}/bronze", f"{base}/ck", sc.RUN0.ts_col())
    return spark.read.parquet(f"{base}/bronze").select(*STREAM_COLS)


def _no_rows_before(ev: DataFrame, k: int) -> DataFrame:
    """Run ``k``'s source when nothing in it is recent enough for the window."""
    return sc.foreign(ev, k).where(F.col("ts") < F.lit(sc.run(k).window_start(sc.SPEC.days)))


@register("empty_first_run", lambda: f"SELECT * FROM ({stream_sql(1)}) s WHERE snapshotseq = {sc.run(1).seq} AND changetype = 'upsert'")
def q_empty_first_run(spark, sf):
    """The first run's window is empty; the second finds its rows and deletes none."""
    from tidemark.streaming.change_capture import ChangeStore, run_once
    ev = load(spark, sf, "events")
    store = ChangeStore(spark, scratch_dir(spark, "tidemark-q", "empty-first"))
    run_once(spark, _no_rows_before(ev, 0), store, sc.run(0), sc.SPEC)
    run_once(spark, sc.foreign(ev, 1), store, sc.run(1), sc.SPEC)
    return store.stream().select(*STREAM_COLS)


@register("empty_retry", lambda: f"""
SELECT * FROM ({stream_sql(0)}) s UNION ALL
SELECT {_tomb_cols(1, 'delete')} FROM (SELECT * FROM ({stream_sql(0)}) p
  WHERE ts >= TIMESTAMP '{sc.run(1).window_start(sc.SPEC.days)}') gone""")
def q_empty_retry(spark, sf):
    """Run 1 breaks off after its snapshot; its retry finds the window empty and deletes what run 0 held in it."""
    from tidemark.operators import rolling
    from tidemark.streaming.change_capture import ChangeStore, run_once
    ev = load(spark, sf, "events")
    store = ChangeStore(spark, scratch_dir(spark, "tidemark-q", "empty-retry"))
    run_once(spark, sc.foreign(ev, 0), store, sc.run(0), sc.SPEC)
    store.write_events(rolling.snapshot(sc.foreign(ev, 1), sc.run(1), sc.SPEC))  # and no commit
    run_once(spark, _no_rows_before(ev, 1), store, sc.run(1), sc.SPEC)
    return store.stream().select(*STREAM_COLS)


@register("broken_run_to_bronze", lambda: stream_sql(1))
def q_broken_run_to_bronze(spark, sf):
    """Bronze reads between a run that broke off and its retry, and holds each event once."""
    from tidemark.operators import rolling
    from tidemark.streaming.change_capture import ChangeStore, run_once
    ev = load(spark, sf, "events")
    base = scratch_dir(spark, "tidemark-q", "broken")
    store = ChangeStore(spark, f"{base}/store")

    def to_bronze():
        medallion.ingest_bronze(spark, store, f"{base}/bronze", f"{base}/ck", sc.RUN0.ts_col())

    run_once(spark, sc.foreign(ev, 0), store, sc.run(0), sc.SPEC)
    store.write_events(rolling.snapshot(sc.foreign(ev, 1), sc.run(1), sc.SPEC))  # and no commit
    to_bronze()
    run_once(spark, sc.foreign(ev, 1), store, sc.run(1), sc.SPEC)
    to_bronze()
    return spark.read.parquet(f"{base}/bronze").select(*STREAM_COLS)


@register("sweep_log", lambda: f"""
SELECT 'events' AS source_table, CAST({sc.run(SWEEP_RUN).seq} AS BIGINT) AS snapshotseq,
       TIMESTAMP '{sc.run(SWEEP_RUN).text}' AS sweepts, 'initial' AS "trigger", CAST(NULL AS INTEGER) AS scope_days,
       CAST(count(*) AS BIGINT) AS closed_count, 'completed' AS status
FROM ({_sweep_flags_sql(SWEEP_RUN)}) f WHERE _open AND NOT _live AND NOT _rolled""")
def q_sweep_log(spark, sf):
    """The sweep audit log after three persisted runs (one completed sweep at run 2)."""
    return _cc_store(spark, sf).sweeps().drop("run")


# Silver settings the change stream needs (keys, sequence, untracked stamps).
ROLLING_SILVER_EXCLUDE = ["snapshotseq", "snapshotts", "windowstart", "windowdays", "changetype", "rowoccurrence"]
SILVER_OUT = ["eventid", "ts", "userid", "eventtype", "value", "props", "rowhash", "rowoccurrence", "rowkey",
              "contenthash", "changetype", "isdeleted", "deletedat", "snapshotseq", "snapshotts", "windowstart",
              "windowdays", "__START_AT", "__END_AT"]


def _rolling_silver_sql() -> str:
    renames = {"event_id": "eventid", "user_id": "userid", "event_type": "eventtype"}
    cols = ", ".join(f'"{c}" AS "{renames.get(c, c)}"' for c in STREAM_COLS + ["__START_AT", "__END_AT"]
                     if not c.startswith("_s"))
    tracked = STREAM_TRACKED + ["deletedat"]
    return f"SELECT {cols} FROM ({scd2_sql(stream_sql(2), STREAM_COLS, ['rowkey'], 'snapshotseq', tracked)}) s"


@register("rolling_to_silver", _rolling_silver_sql)
def q_rolling_to_silver(spark, sf):
    """Entry point C end to end: three persisted rolling runs -> bronze stream ->
    Silver (SELECT * names, SCD2 on rowkey by snapshotseq) via foreachBatch."""
    from tidemark.streaming.change_capture import ChangeStore, run_once
    ev = load(spark, sf, "events")
    base = scratch_dir(spark, "tidemark-q", "rolling-silver")
    store = ChangeStore(spark, f"{base}/store")
    for k in range(3):
        run_once(spark, sc.foreign(ev, k), store, sc.run(k), sc.SPEC, source_table="events")
    medallion.ingest_bronze(spark, store, f"{base}/bronze", f"{base}/ck1", sc.RUN0.ts_col())
    spec = medallion.SilverSpec("events", ["rowkey"], history_timestamp_source="snapshotseq",
                                scd_2_exclude_list=ROLLING_SILVER_EXCLUDE, buckets=8)
    sink = medallion.SilverSink(spark, spec, f"{base}/silver", f"{base}/qtn", f"{base}/log", sc.RUN0)
    medallion.run_silver(spark, f"{base}/bronze", sink, f"{base}/ck2")
    return read_target(spark, f"{base}/silver").select(*SILVER_OUT)


FAILING = [("positive_balance", "c_acctbal > 0"), ("known_nation", "c_nationkey < 20")]


@register("quarantine_table", lambda: f"""
SELECT {_cols(CUSTOMER)}, _failed_dq_rules, TIMESTAMP '{sc.RUN0.text}' AS _quarantine_timestamp, 'customer' AS _source_table
FROM (SELECT *, list_filter([CASE WHEN NOT (c_acctbal > 0) THEN 'positive_balance' END,
                             CASE WHEN NOT (c_nationkey < 20) THEN 'known_nation' END], lambda x: x IS NOT NULL) AS _failed_dq_rules
      FROM customer) t WHERE len(_failed_dq_rules) > 0""")
def q_quarantine_table(spark, sf):
    """The quarantine table that the Silver stream fills, from two Bronze deliveries."""
    base = scratch_dir(spark, "tidemark-q", "quarantine")
    cust = load(spark, sf, "customer").select(*CUSTOMER)
    spec = medallion.SilverSpec("customer", ["c_custkey"], data_quality_rules=FAILING, buckets=4)
    half = F.col("c_custkey") % 2 == 0
    for rows in (cust.where(half), cust.where(~half)):
        rows.write.mode("append").parquet(f"{base}/bronze")
        sink = medallion.SilverSink(spark, spec, f"{base}/silver", f"{base}/qtn", f"{base}/log", sc.RUN0)
        medallion.run_silver(spark, f"{base}/bronze", sink, f"{base}/ck")
    return spark.read.parquet(f"{base}/qtn").select(*CUSTOMER, "_failed_dq_rules", "_quarantine_timestamp", "_source_table")


@register("silver_view", lambda: """
SELECT c_custkey AS ccustkey, c_name AS cname FROM customer WHERE (c_acctbal > 0) IS NOT FALSE""")
def q_silver_view(spark, sf):
    """The gated, projected Silver stream read through its session view."""
    base = scratch_dir(spark, "tidemark-q", "view")
    load(spark, sf, "customer").select(*CUSTOMER).write.parquet(f"{base}/bronze")
    spec = medallion.SilverSpec("customer", ["c_custkey"], data_quality_rules=CHAIN_RULES)
    medallion.silver_view(spark, f"{base}/bronze", spec, "tidemark_q_silver_view")
    try:
        medallion.write_stream(spark.table("tidemark_q_silver_view"), f"{base}/out", f"{base}/ck")
    finally:
        spark.catalog.dropTempView("tidemark_q_silver_view")
    return spark.read.parquet(f"{base}/out").select("ccustkey", "cname")


@register("provenance_files", lambda: f"""
SELECT {_cols(CUSTOMER)}, TIMESTAMP '{sc.RUN0.text}' AS _staging_ingested_at, TRUE AS named, TRUE AS sized, TRUE AS dated FROM customer""")
def q_provenance_files(spark, sf):
    """Each ingested row says which file it came from, how large that was and when it was written."""
    base = scratch_dir(spark, "tidemark-q", "provenance")
    load(spark, sf, "customer").select(*CUSTOMER).write.parquet(f"{base}/in")
    medallion.ingest_staging(spark, files.FileSource(f"{base}/in", "parquet"), f"{base}/staging", f"{base}/ck", None, sc.RUN0.ts_col())
    listed = files.list_files(spark, files.FileSource(f"{base}/in", "parquet")).select(
        F.col("path").alias("_source_file_path"), F.col("length").alias("size"), F.col("modificationTime").cast("timestamp_ntz").alias("at"))
    rows = spark.read.parquet(f"{base}/staging").join(listed, "_source_file_path", "left")
    named = F.col("_source_file_path").endswith(F.concat(F.lit("/"), F.col("_source_file_name")))
    return rows.select(*CUSTOMER, "_staging_ingested_at", named.alias("named"), (F.col("_source_file_size") == F.col("size")).alias("sized"),
                       (F.col("_source_file_modified") == F.col("at")).alias("dated"))


@register("unreadable_files", lambda: CUSTOMER_RESCUED_SQL)
def q_unreadable_files(spark, sf):
    """A broken file among good ones is skipped where the source says so."""
    base = scratch_dir(spark, "tidemark-q", "unreadable")
    cust = load(spark, sf, "customer").select(*CUSTOMER)
    cust.write.parquet(f"{base}/in")
    cust.select(F.lit("this is no parquet file").alias("value")).limit(1).coalesce(1).write.mode("append").text(f"{base}/in")
    return _ingest(spark, files.FileSource(f"{base}/in", "parquet", ignore_corrupt_files=True), base, cust.schema)


@register("refused_columns", lambda: f"SELECT {_cols(CUSTOMER[:-1])} FROM customer")
def q_refused_columns(spark, sf):
    """With failOnNewColumns a delivery with a new column stops the ingestion and leaves the first one."""
    base = scratch_dir(spark, "tidemark-q", "refused")
    cust = load(spark, sf, "customer").select(*CUSTOMER)
    hints = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cust.schema.fields[:-1])
    src = files.FileSource(f"{base}/in", "json", schema_evolution_mode="failOnNewColumns", schema_hints=hints)
    for delivery in (cust.drop(CUSTOMER[-1]), cust):
        delivery.write.mode("append").json(f"{base}/in")
        try:
            out = _ingest(spark, src, base)
        except ValueError as refused:
            if CUSTOMER[-1] not in str(refused):
                raise
    return out


@register("replaced_view", lambda: RAISED_SQL)
def q_replaced_view(spark, sf):
    """A materialised view holds its last refresh alone."""
    from tidemark.sources import tables
    path = scratch_dir(spark, "tidemark-q", "replaced")
    cust = load(spark, sf, "customer").select(*CUSTOMER)
    for rows in (cust, _raised(cust)):
        tables.write_view(rows, path)
    return spark.read.parquet(path)


@register("first_run_deletes", lambda: f"SELECT * FROM ({stream_sql(1)}) s WHERE snapshotseq = 0")
def q_first_run_deletes(spark, sf):
    """The first run has no prior snapshot: an empty frame of the stream's columns."""
    return sc.Scenario(load(spark, sf, "events")).dels(0).select(*STREAM_COLS)


@register("unpinned_stamp", lambda: f"SELECT {_cols(CUSTOMER)}, 1 AS stamps, TRUE AS recent FROM customer")
def q_unpinned_stamp(spark, sf):
    """Without a pinned stamp a batch's rows all carry the one time at which it ran."""
    base = scratch_dir(spark, "tidemark-q", "stamp")
    load(spark, sf, "customer").select(*CUSTOMER).write.json(f"{base}/in")
    src = files.FileSource(f"{base}/in", "json", schema_evolution_mode="none", schema_hints="c_nationkey int")
    medallion.ingest_staging(spark, src, f"{base}/staging", f"{base}/ck")
    rows = spark.read.parquet(f"{base}/staging")
    stamps = rows.agg(F.count_distinct("_staging_ingested_at").cast("int").alias("stamps"), F.max("_staging_ingested_at").alias("at"))
    now = F.current_timestamp().cast("timestamp_ntz")
    recent = (F.col("at") <= now) & (F.col("at") > now - F.expr("INTERVAL 1 DAY"))
    return rows.join(F.broadcast(stamps)).select(*CUSTOMER, "stamps", recent.alias("recent"))  # one row of stamps


GUARDS = [(1, 5.0, "fail"), (1, 100.0, "fail"), (1, 0.001, "skip"), (10 ** 9, 5.0, "skip")]


@register("guards_matrix", lambda: f"""
SELECT CAST(rows AS BIGINT) AS min_rows, CAST(pct AS DOUBLE) AS max_pct, breach AS on_breach,
  CASE WHEN source_count < rows THEN 'refused_floor' WHEN open_count = 0 OR orphan_count = 0 THEN 'nothing'
       WHEN 100.0 * orphan_count / open_count <= pct THEN 'ok' WHEN breach = 'skip' THEN 'skipped_breach' ELSE 'refused_ceiling' END AS outcome
FROM ({_metrics_sql(SWEEP_RUN)}) m, (VALUES {', '.join(str(g) for g in GUARDS)}) g(rows, pct, breach)""")
def q_guards_matrix(spark, sf):
    """What the source floor and the delete ceiling make of one sweep, for several settings."""
    s = sc.Scenario(load(spark, sf, "events"))
    metrics = reconcile.sweep_metrics(*s.sweep_parts(SWEEP_RUN))
    settings = F.array(*[F.struct(F.lit(r).cast("long").alias("min_rows"), F.lit(p).alias("max_pct"), F.lit(b).alias("on_breach")) for r, p, b in GUARDS])
    return metrics.select("*", F.inline(settings)).select(
        "min_rows", "max_pct", "on_breach",
        reconcile.guard_outcome(F.col("source_count"), F.col("open_count"), F.col("orphan_count"), F.col("min_rows"), F.col("max_pct"),
                                F.col("on_breach")).alias("outcome"))


@register("sweep_payload_history", lambda: ORACLES["change_capture_runs"]())
def q_sweep_payload_history(spark, sf):
    """Silver keeps keys and flags alone, so the sweep's tombstones take their payload from the snapshots, newest first."""
    from tidemark.streaming.change_capture import ChangeStore, SweepSpec, run_once
    ev = load(spark, sf, "events")
    store = ChangeStore(spark, scratch_dir(spark, "tidemark-q", "payload"))
    for k in range(3):
        silver = scd.change_stream_scd2(store.stream()).select("rowkey", "ts", "isdeleted", scd.END_AT) if k == SWEEP_RUN else None
        run_once(spark, sc.foreign(ev, k), store, sc.run(k), sc.SPEC, SweepSpec(enabled=(k == SWEEP_RUN)), silver, "events")
    return store.stream().select(*STREAM_COLS)


def _audit_row_sql(k: int, prior: str, last: str, trigger: str, status: str, reconciles: str) -> str:
    counts = ", ".join(f"(SELECT CAST(count(*) AS BIGINT) FROM ({stream_sql(k)}) s WHERE snapshotseq = {sc.run(k).seq} AND changetype = '{c[:-1]}') AS {c}"
                       for c in ("upserts", "deletes"))
    return (f"SELECT 'events' AS source_table, CAST({sc.run(k).seq} AS BIGINT) AS snapshotseq, TIMESTAMP '{sc.run(k).text}' AS snapshotts, "
            f"TIMESTAMP '{_ws(k)}' AS windowstart, {counts}, CAST({reconciles} AS BIGINT) AS reconciles, CAST({prior} AS BIGINT) AS prior_snapshotseq, "
            f"CAST({last} AS TIMESTAMP) AS last_sweep, {trigger != 'not_due'} AS reconcile_due, '{trigger}' AS reconcile_trigger, "
            f"'{status}' AS sweep_status, 'full' AS reconcile_scope, 'min_rows=1, max_pct=100.0, on_breach=fail' AS reconcile_guards")


def _orphans_sql(k: int) -> str:
    return f"SELECT rowkey FROM ({_sweep_flags_sql(k)}) f WHERE _open AND NOT _live AND NOT _rolled"


def _snapshot_audit_sql() -> str:
    at = {k: f"TIMESTAMP '{sc.run(k).text}'" for k in range(3)}
    return " UNION ALL ".join([
        _audit_row_sql(0, "NULL", "NULL", "initial", "no_target", "0"),
        _audit_row_sql(1, str(sc.run(0).seq), "NULL", "initial", "completed", f"(SELECT count(*) FROM ({_orphans_sql(1)}) a)"),
        _audit_row_sql(2, str(sc.run(1).seq), at[1], "cadence", "completed",
                       f"(SELECT count(*) FROM ({_orphans_sql(2)}) a WHERE rowkey NOT IN ({_orphans_sql(1)}))")])


@register("snapshot_audit", _snapshot_audit_sql)
def q_snapshot_audit(spark, sf):
    """Three runs with two completed sweeps: what each compared with and the sweep's state as of that run."""
    from tidemark.streaming.change_capture import ChangeStore, SweepSpec, run_once
    ev = load(spark, sf, "events")
    store = ChangeStore(spark, scratch_dir(spark, "tidemark-q", "audit"))
    sweep = SweepSpec(enabled=True, cadence_days=1, max_delete_pct=100.0)
    for k in range(3):
        silver = scd.change_stream_scd2(store.stream()) if k else None
        run_once(spark, sc.foreign(ev, k), store, sc.run(k), sc.SPEC, sweep, silver, "events")
    return audit.run_audit(store.runs(), store.sweeps(), "events", sc.SPEC, sweep.cadence_days, max_delete_pct=sweep.max_delete_pct)


# ── audit summaries ───────────────────────────────────────────────────────────

@register("snapshot_summary", lambda: f"""
SELECT snapshotseq, snapshotts, windowstart, upserts, deletes, reconciles,
       max(CASE WHEN upserts > 0 THEN snapshotseq END) OVER (ORDER BY snapshotseq
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_snapshotseq
FROM (SELECT snapshotseq, snapshotts, windowstart,
             CAST(count(*) FILTER (WHERE changetype = 'upsert') AS BIGINT) AS upserts,
             CAST(count(*) FILTER (WHERE changetype = 'delete') AS BIGINT) AS deletes,
             CAST(count(*) FILTER (WHERE changetype = 'reconcile') AS BIGINT) AS reconciles
      FROM ({stream_sql(2)}) s GROUP BY snapshotseq, snapshotts, windowstart) g""")
def q_snapshot_summary(spark, sf):
    return audit.snapshot_summary(sc.Scenario(load(spark, sf, "events")).stream(2))


@register("silver_summary", lambda: f"""
SELECT CAST(count(*) AS BIGINT) AS versions,
       CAST(count(*) FILTER (WHERE __END_AT IS NULL) AS BIGINT) AS open_versions,
       CAST(count(*) FILTER (WHERE __END_AT IS NOT NULL) AS BIGINT) AS closed_versions,
       CAST(count(*) FILTER (WHERE __END_AT IS NULL AND NOT isdeleted) AS BIGINT) AS live_rows,
       CAST(count(*) FILTER (WHERE __END_AT IS NULL AND isdeleted) AS BIGINT) AS deleted_rows
FROM ({silver_sql(2)}) s""")
def q_silver_summary(spark, sf):
    return audit.silver_summary(sc.Scenario(load(spark, sf, "events")).silver(2))


@register("ingest_summary", lambda: f"""
SELECT changetype, CAST(count(*) AS BIGINT) AS rows, min(_staging_ingested_at) AS first_ingested_at,
       max(_staging_ingested_at) AS last_ingested_at FROM ({stream_sql(2)}) s GROUP BY changetype""")
def q_ingest_summary(spark, sf):
    return audit.ingest_summary(sc.Scenario(load(spark, sf, "events")).stream(2), ["changetype"])


@register("quarantine_summary", lambda: f"""
SELECT rule, CAST(count(*) AS BIGINT) AS failed_rows FROM (SELECT unnest(_failed_dq_rules) AS rule
FROM ({_dq_tagged_sql()}) t) u GROUP BY rule""")
def q_quarantine_summary(spark, sf):
    return audit.quarantine_summary(quality.quarantine(load(spark, sf, "orders"), DQ_RULES, "orders", sc.RUN0))


@register("duplicate_keys", lambda: f"""
SELECT {_cols(LI3)}, CAST(count(*) AS BIGINT) AS dup_count FROM lineitem GROUP BY {_cols(LI3)} HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf):
    return audit.duplicate_keys(load(spark, sf, "lineitem"), LI3)
