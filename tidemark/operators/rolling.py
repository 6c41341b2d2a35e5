"""Rolling-window snapshots and delete detection (Control 1).

A run re-reads the trailing N days of a keyless source, gives every row a
stable identity (``identity.add_identity``) and emits it as an ``upsert``
event. Rows of the previous snapshot whose rowkey is missing from this one
and whose window value is still inside the current window become ``delete``
tombstones carrying their last-known payload. Everything is stamped with one
run constant (``RunStamp``) so a run is one ``snapshotseq`` partition of the
change stream.

Change-stream grain: one row per source row per snapshot, plus soft-delete
events. Column order: business columns, identity columns, event columns,
snapshot stamps, provenance.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.bounds import at_or_after
from tidemark.functions.hashing import quote, select_names
from tidemark.operators.identity import add_identity
from tidemark.session import RunStamp, ts_literal

# Change-stream column names and order, and the provenance block
# (names and types) shared with file staging.
EVENT_COLUMNS = ["rowhash", "rowoccurrence", "rowkey", "contenthash",
                 "changetype", "isdeleted", "deletedat"]
STAMP_COLUMNS = ["snapshotseq", "snapshotts", "windowstart", "windowdays"]
# All provenance fields but the ingest time are null for table sources.
# Timestamps are TIMESTAMP_NTZ holding UTC wall-clock time.
PROVENANCE = [
    ("_staging_ingested_at", "timestamp_ntz"),
    ("_source_file_path", "string"),
    ("_source_file_name", "string"),
    ("_source_file_size", "long"),
    ("_source_file_modified", "timestamp_ntz"),
]
PROVENANCE_COLUMNS = [n for n, _ in PROVENANCE]

# Fixed change types; priority breaks ties between events of one key at one sequence.
CHANGE_PRIORITY = {"upsert": 3, "delete": 2, "reconcile": 1}


@dataclass(frozen=True)
class RollingSpec:
    """Options of one rolling source (reference YAML keys, as arguments)."""

    window_column: str
    days: int = 7
    anchor: str = "midnight_utc"
    where: str | None = None
    select: Sequence[str] | None = None
    mode: str = "hash_all"
    key_columns: Sequence[str] = ()
    exclude_columns: Sequence[str] = ()
    allow_duplicates: bool = True
    detect_deletes: bool = True
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if not self.window_column:
            raise ValueError("window_column is required")
        if str(self.anchor).lower() not in ("midnight_utc", "run_time"):
            raise ValueError("window_start_anchor must be midnight_utc or run_time")
        if int(self.days) < 1:
            raise ValueError("rolling_window_days must be an int >= 1")

    @classmethod
    def from_config(cls, src: dict) -> "RollingSpec":
        """From a source dict with the reference's keys (``federated_source.*``,
        ``row_identity.*``, ``allow_duplicate_rows``, ``delete_detection.enabled``)."""
        fed = src.get("federated_source") or {}
        if not fed.get("foreign_fqn"):
            raise ValueError("federated_source.foreign_fqn is required")
        ri = src.get("row_identity") or {}
        days = fed.get("rolling_window_days", 7)
        if not isinstance(days, int) or days < 1:
            raise ValueError("rolling_window_days must be an int >= 1")
        return cls(
            window_column=fed.get("window_column"), days=days,
            anchor=str(fed.get("window_start_anchor", "midnight_utc")).lower(),
            where=fed.get("where_clause"), select=fed.get("select_columns"),
            mode=str(ri.get("mode", "hash_all")).lower(),
            key_columns=tuple(ri.get("key_columns") or ()),
            exclude_columns=tuple(ri.get("exclude_columns") or ()),
            allow_duplicates=bool(src.get("allow_duplicate_rows", True)),
            detect_deletes=bool((src.get("delete_detection") or {}).get("enabled", True)),
        )

    def identity(self) -> dict:
        return dict(mode=self.mode, key_columns=tuple(self.key_columns),
                    exclude_columns=tuple(self.exclude_columns),
                    allow_duplicates=self.allow_duplicates)


def read_window(df: DataFrame, window_column: str, since: datetime | None = None,
                where: str | None = None, select: Sequence[str] | None = None) -> DataFrame:
    """Filter -> user predicate -> projection, in that order (before identity).

    ``since`` is inclusive; rows with a null window value never qualify, also
    when ``since`` is None (the whole-table read of the sweep).
    """
    if window_column not in df.columns:
        raise ValueError(f"window column {window_column!r} not in source columns")
    if since is not None:
        df = df.where(at_or_after(df, window_column, since))
    else:
        df = df.where(F.col(f"`{window_column}`").isNotNull())
    if where:
        df = df.where(where)
    if select:
        cols = list(select)
        if window_column not in cols:
            cols.append(window_column)
        df = select_names(df, cols)
    return df


def _ts_sql(ts: datetime) -> str:
    return f"TIMESTAMP_NTZ'{ts.strftime('%Y-%m-%d %H:%M:%S.%f')}'"


def _stamp_sql(run: RunStamp, window_start: datetime, days: int) -> dict:
    """SQL text of the four snapshot stamps (one projection, no per-column calls)."""
    return {"snapshotseq": f"CAST({run.seq} AS BIGINT)", "snapshotts": _ts_sql(run.ts),
            "windowstart": _ts_sql(window_start), "windowdays": f"CAST({int(days)} AS INT)"}


def _provenance_sql(run: RunStamp) -> dict:
    return {"_staging_ingested_at": _ts_sql(run.ts),
            **{n: f"CAST(NULL AS {t})" for n, t in PROVENANCE[1:]}}


def _project(df: DataFrame, columns: Sequence[str], exprs: dict) -> DataFrame:
    """Select ``columns`` in order; names in ``exprs`` come from their SQL text."""
    return df.selectExpr(*[f"{exprs[c]} AS {quote(c)}" if c in exprs else quote(c) for c in columns])


def with_null_provenance(df: DataFrame, run: RunStamp) -> DataFrame:
    """Provenance block of a table source: ingest time = run time, file fields null."""
    return df.withColumns({
        "_staging_ingested_at": run.ts_col(),
        **{n: F.expr(f"CAST(NULL AS {t})") for n, t in PROVENANCE[1:]},
    })


def stamp_snapshot(df: DataFrame, run: RunStamp, window_start: datetime, days: int) -> DataFrame:
    return df.withColumns({
        "snapshotseq": run.seq_col(),
        "snapshotts": run.ts_col(),
        "windowstart": ts_literal(window_start),
        "windowdays": F.expr(f"CAST({int(days)} AS INT)"),
    })


def snapshot(source: DataFrame, run: RunStamp, spec: RollingSpec, stage: str | None = None) -> DataFrame:
    """This run's trailing-window read as ``upsert`` events (``stage``: see ``add_identity``)."""
    ws = run.window_start(spec.days, spec.anchor)
    cur = read_window(source, spec.window_column, ws, spec.where, spec.select)
    business = list(cur.columns)
    cur = add_identity(cur, with_contenthash=True, stage=stage, **spec.identity())
    exprs = {"changetype": "'upsert'", "isdeleted": "FALSE", "deletedat": "CAST(NULL AS TIMESTAMP_NTZ)",
             **_stamp_sql(run, ws, spec.days), **_provenance_sql(run)}
    return _project(cur, business + EVENT_COLUMNS + STAMP_COLUMNS + PROVENANCE_COLUMNS, exprs)


def stamp_deleted(df: DataFrame, run: RunStamp, change_type: str, window_start: datetime,
                  days: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Restamp last-known payload rows as soft-delete events of this run
    (one projection; ``columns`` fixes the output order, default: the input's)."""
    if change_type not in ("delete", "reconcile"):
        raise ValueError("change_type must be 'delete' or 'reconcile'")
    exprs = {"changetype": f"'{change_type}'", "isdeleted": "TRUE", "deletedat": _ts_sql(run.ts),
             "_staging_ingested_at": _ts_sql(run.ts), **_stamp_sql(run, window_start, days)}
    cols = list(columns) if columns is not None else list(df.columns) + [c for c in STAMP_COLUMNS if c not in df.columns]
    return _project(df, cols, exprs)


def detect_deletes(current: DataFrame, prior: DataFrame | None, run: RunStamp, spec: RollingSpec,
                   already_deleted: DataFrame | None = None) -> DataFrame:
    """Prior-snapshot rows missing from ``current`` and still inside the window.

    ``prior`` holds the upsert rows of the previous snapshot (None on the first
    run). ``already_deleted`` (rowkeys tombstoned after that snapshot) keeps a
    run with an empty snapshot from re-issuing the same tombstones later.
    Note: the aged-out guard tests the prior row's window value, so in
    key_columns mode a row whose window value moved out looks deleted (as in
    the reference).
    """
    ws = run.window_start(spec.days, spec.anchor)
    if prior is None:
        return current.limit(0)
    vanished = (
        prior.where(at_or_after(prior, spec.window_column, ws))   # aged-out guard, pushed to the scan
        .join(current.select("rowkey"), "rowkey", "left_anti")     # rowkey is unique: no distinct needed
    )
    if already_deleted is not None:
        vanished = vanished.join(already_deleted.select("rowkey"), "rowkey", "left_anti")
    return stamp_deleted(vanished, run, "delete", ws, spec.days, current.columns)


def aged_out(current: DataFrame, prior: DataFrame, run: RunStamp, spec: RollingSpec) -> DataFrame:
    """Vanished rows the guard keeps alive: they left the window, not the source."""
    ws = run.window_start(spec.days, spec.anchor)
    return (
        prior.where(~at_or_after(prior, spec.window_column, ws))
        .join(current.select("rowkey"), "rowkey", "left_anti")
    ).transform(lambda d: select_names(d, prior.columns))


def null_window_rows(source: DataFrame, window_column: str) -> int:
    """Rows neither control can ever see (null window value): one count job
    whose ``IsNull`` filter reaches the scan. Kept apart from the snapshot so
    the window filter there still prunes the read."""
    return source.where(F.col(f"`{window_column}`").isNull()).count()


def prior_snapshot_seq(stream: DataFrame, run: RunStamp):
    """Latest snapshotseq below this run that has upsert rows (None on the first run)."""
    row = (
        stream.where((F.col("snapshotseq") < run.seq) & (F.col("changetype") == "upsert"))
        .agg(F.max("snapshotseq").alias("prior_seq"))
        .first()
    )
    return None if row is None else row["prior_seq"]


def prior_snapshot(stream: DataFrame, seq: int) -> DataFrame:
    """Upsert rows of one snapshot (partition-pruned on ``snapshotseq``)."""
    return stream.where((F.col("snapshotseq") == seq) & (F.col("changetype") == "upsert"))


def deleted_since(stream: DataFrame, seq: int, run: RunStamp) -> DataFrame:
    """Rowkeys tombstoned after snapshot ``seq`` and before this run."""
    return stream.where(
        (F.col("snapshotseq") > seq) & (F.col("snapshotseq") < run.seq) & F.col("isdeleted")
    ).select("rowkey")


def conform(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Bag union of event frames in one column order (the fan-in of the flows)."""
    out = None
    for f in frames:
        f = select_names(f, columns)
        out = f if out is None else out.union(f)        # same names, same order
    return out
