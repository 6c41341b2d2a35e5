"""Slowly changing dimensions from an out-of-order change log.

``scd1``  latest row per key by sequence.
``scd2``  versioned rows with ``__START_AT`` / ``__END_AT`` (typed like the
          sequence column; the open version has ``__END_AT`` null).

SCD2 rules (the platform's apply_changes body is not public; these are the
rules its arguments and comments imply):

1. rows are ordered per key by ``seq``; rows sharing (key, seq) keep only the
   highest ``tie_break`` (e.g. change-type priority) and, between equals, the
   row with the largest content hash — one change per key per sequence value,
   whatever the input order;
2. a version (island) starts at a key's first row or where the struct of
   tracked columns differs null-safely from the previous row;
3. ``__START_AT`` is the island's first sequence, ``__END_AT`` the next island's
   start (null for the last);
4. untracked columns take the values of the island's highest-sequence row
   ("updates in place");
5. ``except_columns`` are dropped last;
6. a null key or null sequence fails the query (``raise_error``).

Because the result depends only on the set of rows, arrival order and batch
splits do not matter (late data is handled by recomputing affected keys, see
``streaming.scd_stream``).

Plan shape: one shuffle of the rows; the windows and the island aggregate reuse
that partitioning. The island aggregate is partial/final, so a long unchanged
island never buffers. A key's history is cut into chunks of about ``hot_key_rows``
rows, so no task holds a key whole, whatever its size or the type of its sequence;
chunks are versioned on their own and joined through a bounded summary. No job
runs while the plan is made.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import quote, select_names

START_AT = "__START_AT"
END_AT = "__END_AT"

# Columns stamped by ingestion; re-delivery of unchanged data must not open a
# version, so they are never tracked by default. Fixed names shared with the
# staging, bronze and federated layers.
AUDIT_COLUMNS = [
    "_staging_ingested_at",
    "_source_file_path",
    "_source_file_name",
    "_source_file_size",
    "_source_file_modified",
    "_bronze_ingested_at",
    "_silver_processed_at",
    "_federated_watermark",
    "_rescued_data",
]

# The columns that order a change stream, and those that change
# every run without a data change, so they are never tracked for history.
SNAPSHOT_SEQUENCES = ("snapshotseq", "snapshotts")
CHANGE_STREAM_UNTRACKED = ["snapshotseq", "snapshotts", "windowstart", "windowdays",
                           "changetype", "rowoccurrence"]


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _checked(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    missing = [c for c in list(keys) + [seq] if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    if not keys:
        raise ValueError("at least one key column is required")
    bad = F.lit(False)
    for k in list(keys) + [seq]:
        bad = bad | _q(k).isNull()
    # Lazy check: evaluated inside the same scan stage, no extra job.
    return df.where(F.when(bad, F.raise_error(F.lit(f"null key or sequence in {list(keys)} / {seq}")))
                    .otherwise(F.lit(True)))


def tracked_columns(columns: Sequence[str], keys: Sequence[str], seq: str,
                    track: Sequence[str] | None = None, except_track: Sequence[str] = ()) -> list[str]:
    """Explicit list, or every column but keys, sequence, audit columns and exclusions."""
    if track is not None:
        missing = [c for c in track if c not in columns]
        if missing:
            raise ValueError(f"tracked columns not found: {missing}")
        return [c for c in track if c not in set(except_track)]
    skip = set(keys) | {seq} | set(AUDIT_COLUMNS) | set(except_track)
    return [c for c in columns if c not in skip]


def scd1(changes: DataFrame, keys: Sequence[str], seq: str, tie_break: Column | None = None,
         except_columns: Sequence[str] = ()) -> DataFrame:
    """Latest row per key: ``max_by(row, (seq, tie_break))`` — partial aggregation, skew-safe."""
    keys = list(keys)
    df = _checked(changes, keys, seq)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(_q(seq), tie_break if tie_break is not None else F.lit(0), content_order(df))
    latest = df.groupBy(*[_q(k) for k in keys]).agg(
        F.max_by(F.expr(f"struct({', '.join(quote(c) for c in rest)})"), order).alias("_latest"))
    out = latest.select(*[_q(k) for k in keys], "_latest.*")
    return select_names(out, [c for c in changes.columns if c not in set(except_columns)])


# Working column: content hash of a change row.
CONTENT = "_content_order"

# About how many rows of one key are versioned together.
HOT_KEY_ROWS = 1_000_000
# Most cuts over all keys: bounds what is broadcast. Beyond HOT_KEY_ROWS * HOT_KEY_CHUNKS rows chunks grow.
HOT_KEY_CHUNKS = 65_536


def scd2(changes: DataFrame, keys: Sequence[str], seq: str, track: Sequence[str] | None = None,
         except_track: Sequence[str] = (), except_columns: Sequence[str] = (),
         tie_break: Column | None = None, hot_key_rows: int | None = HOT_KEY_ROWS,
         chunks: int = HOT_KEY_CHUNKS) -> DataFrame:
    """Versions per key (rules in the module docstring).

    Skew: one user may hold a third of all events. A change whose key and sequence
    hash to 0 modulo ``hot_key_rows`` begins a chunk of its key, so the cuts follow
    from the data alone, come about every ``hot_key_rows`` changes, and keep equal
    sequences together; of more than ``chunks`` such changes those with the smallest
    hash count. Rows are shuffled by key and chunk. ``hot_key_rows=None`` leaves keys
    whole where they are bounded by construction.
    """
    keys = list(keys)
    df = _checked(changes, keys, seq)
    cols = list(df.columns)
    df = df.withColumn(CONTENT, content_order(df))
    tracked = tracked_columns(cols, keys, seq, track, except_track)
    payload = [c for c in cols if c not in keys]
    if hot_key_rows is None:
        out = _versions(df, keys, seq, tracked, payload, tie_break)
    else:
        out = _versions_chunked(df, keys, seq, tracked, payload, tie_break, int(hot_key_rows), int(chunks))
    keep = [c for c in cols if c not in set(except_columns)] + [START_AT, END_AT]
    return select_names(out, keep)


def content_order(df: DataFrame) -> Column:
    """Hash of the whole row: decides between changes of one key and sequence, in any input order."""
    columns = [_q(f.name) if not _has_map(f.dataType) else F.to_json(F.struct(_q(f.name))) for f in df.schema.fields]
    return F.xxhash64(*columns)


def _has_map(kind) -> bool:
    return "map<" in kind.simpleString()


def _order(seq: str, tie_break: Column | None) -> list[Column]:
    """By sequence; of equal ones the tie-break's winner comes first, then the row with the largest content hash."""
    return [_q(seq)] + ([tie_break.desc()] if tie_break is not None else []) + [_q(CONTENT).desc()]


def _drop_ties(df: DataFrame, w: Window, seq: str) -> DataFrame:
    """Keep the first row of each (key, seq) run under ``w`` (the tie-break winner)."""
    return (df.withColumn("_prev_seq", F.lag(_q(seq)).over(w))
              .where(F.col("_prev_seq").isNull() | (F.col("_prev_seq") != _q(seq)))
              .drop("_prev_seq"))


def _state(tracked: Sequence[str]) -> Column:
    return F.expr(f"struct({', '.join(quote(c) for c in tracked)})") if tracked else F.expr("struct(0)")


def _islands(df: DataFrame, group: Sequence[str], seq: str, tracked, tie_break) -> DataFrame:
    """Rows without ties, with their island's number inside ``group`` and the next row's sequence."""
    w = Window.partitionBy(*[_q(k) for k in group]).orderBy(*_order(seq, tie_break))
    return (
        _drop_ties(df, w, seq).withColumn("_state", _state(tracked))
        .withColumn("_start", (~F.col("_state").eqNullSafe(F.lag("_state").over(w))).cast("int"))
        .withColumn("_island", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("_next", F.lead(_q(seq)).over(w))
    )


def _fold(marked: DataFrame, group: Sequence[str], seq: str, payload) -> DataFrame:
    """One row per island of a group: first sequence, last row's payload and next start."""
    fields = ", ".join(f"{quote(c)}" for c in payload)
    versions = marked.groupBy(*[_q(k) for k in group], "_island").agg(
        F.min(_q(seq)).alias(START_AT),
        F.expr(f"max_by(struct({fields}, _next AS _end), {quote(seq)})").alias("_last"),
    )
    return versions.selectExpr(
        *[quote(k) for k in group],
        *[f"_last.{quote(c)} AS {quote(c)}" for c in payload],
        quote(START_AT),
        f"_last._end AS {quote(END_AT)}",
        "_island",
    )


def _versions(df: DataFrame, keys, seq, tracked, payload, tie_break) -> DataFrame:
    """Gaps and islands with windows partitioned by the key (one shuffle)."""
    return _fold(_islands(df, keys, seq, tracked, tie_break), keys, seq, payload).drop("_island")


def _cuts(df: DataFrame, keys, seq, every: int, most: int) -> DataFrame:
    """(keys, _cuts): the sorted sequences at which a key's chunks begin; at most ``most`` over all keys."""
    mark = F.xxhash64(*[_q(k) for k in keys], _q(seq))
    begins = (df.select(*[_q(k) for k in keys], _q(seq).alias("_at"), mark.alias("_mark"))
              .where(F.pmod("_mark", F.lit(every)) == 0).distinct()
              .orderBy("_mark", *[_q(k) for k in keys], "_at").limit(most))
    return begins.groupBy(*[_q(k) for k in keys]).agg(F.sort_array(F.collect_set("_at")).alias("_cuts"))


def _at_or_below(cuts: str, seq: str, most: int) -> str:
    """SQL for the number of a sorted array's entries (at most ``most``) at or below the row's sequence, by binary search."""
    middle = "(__span.lo + __span.hi) div 2"
    return f"""aggregate(sequence(1, {most.bit_length() + 1}),
        named_struct('lo', 0L, 'hi', CAST(size({cuts}) AS BIGINT)),
        (__span, __step) -> CASE WHEN __span.lo >= __span.hi THEN __span
            WHEN {cuts}[CAST({middle} AS INT)] <= {quote(seq)} THEN named_struct('lo', {middle} + 1, 'hi', __span.hi)
            ELSE named_struct('lo', __span.lo, 'hi', {middle}) END,
        __span -> CAST(__span.lo AS INT))"""


def _chunked(df: DataFrame, cuts: DataFrame, keys, seq, most: int, how: str) -> DataFrame:
    """``df`` with ``_c``, the number of the row's cuts at or below its sequence.

    A joined row is copied with the arrays that it meets, so a key's cuts come in blocks of
    about the root of ``most``: a row meets its key's block heads and then one block.
    """
    size = max(1, math.isqrt(max(0, most - 1)) + 1)
    blocks = f"sequence(0, (size(_cuts) - 1) div {size})"
    heads = cuts.select(*[_q(k) for k in keys], F.expr(f"transform({blocks}, b -> _cuts[b * {size}])").alias("_heads"))
    block = (cuts.select(*[_q(k) for k in keys], F.expr(f"posexplode(transform({blocks}, b -> slice(_cuts, b * {size} + 1, {size})))")
                         .alias("_b", "_block")))
    found = (df.join(F.broadcast(heads), keys, how)
             .withColumn("_b", F.expr(f"CASE WHEN _heads IS NULL THEN -1 ELSE {_at_or_below('_heads', seq, size)} - 1 END")).drop("_heads"))
    inside = F.expr(f"CASE WHEN _block IS NULL THEN 0 ELSE _b * {size} + {_at_or_below('_block', seq, size)} END")
    return found.join(F.broadcast(block), [*keys, "_b"], "left").withColumn("_c", inside).drop("_b", "_block")


def _versions_chunked(df: DataFrame, keys, seq, tracked, payload, tie_break, every: int, most: int) -> DataFrame:
    """Gaps and islands inside chunks, and then across them.

    An island that runs on into later chunks is reported by its last chunk, with the
    start that the summary carries there. The summary has a row for each chunk of a
    key that is cut, at most two for each cut, and is computed from those keys' rows
    alone; cuts and summary are broadcast.
    """
    group = [*keys, "_c"]
    cuts = _cuts(df, keys, seq, every, most)

    def chunked(how: str) -> DataFrame:
        return _chunked(df, cuts, keys, seq, most, how)

    ends = (
        _islands(chunked("inner"), group, seq, tracked, tie_break).groupBy(*[_q(k) for k in group])
        .agg(F.min(_q(seq)).alias("_first"), F.min_by("_state", _q(seq)).alias("_from"), F.max_by("_state", _q(seq)).alias("_to"),
             F.max("_island").alias("_islands"), F.max(F.when(F.col("_start") == 1, _q(seq))).alias("_begun"))
    )
    over = Window.partitionBy(*[_q(k) for k in keys]).orderBy("_c")
    summary = (
        ends.withColumn("_carried", F.col("_from").eqNullSafe(F.lag("_to").over(over)) & F.lag("_first").over(over).isNotNull())
        # Where the chunk's last island began, unless that was before the chunk.
        .withColumn("_own", F.when((F.col("_islands") > 1) | ~F.col("_carried"), F.col("_begun")))
        .withColumn("_since", F.last("_own", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_runs_on", F.coalesce(F.lead("_carried").over(over), F.lit(False)))
        .withColumn("_then", F.lead("_first").over(over))
        .select(*[_q(k) for k in group], "_islands", "_carried", "_since", "_runs_on", "_then")
    )
    folded = _fold(_islands(chunked("left"), group, seq, tracked, tie_break), group, seq, payload)
    joined = folded.join(F.broadcast(summary), group, "left")
    last = F.col("_island") == F.col("_islands")
    return (
        joined.where(~F.coalesce(last & F.col("_runs_on"), F.lit(False)))
        .withColumn(START_AT, F.when((F.col("_island") == 1) & F.col("_carried"), F.col("_since")).otherwise(F.col(START_AT)))
        .withColumn(END_AT, F.coalesce(F.col(END_AT), F.when(last, F.col("_then"))))
        .select(*[_q(k) for k in keys], *[_q(c) for c in payload], START_AT, END_AT)
    )


def change_stream_scd2(stream: DataFrame, seq: str = "snapshotseq",
                       except_track: Sequence[str] = ()) -> DataFrame:
    """SCD2 of a rolling change stream: key rowkey, untracked run stamps.

    Same-sequence ties resolve upsert > delete > reconcile.
    """
    if seq not in SNAPSHOT_SEQUENCES:
        raise ValueError("change-stream history must be sequenced by snapshotseq or snapshotts")
    from tidemark.operators.rolling import CHANGE_PRIORITY
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in CHANGE_PRIORITY.items())
    prio = F.expr(f"CASE changetype {cases} ELSE 0 END")
    untracked = list(CHANGE_STREAM_UNTRACKED) + ["deletedat"] + list(except_track)
    # A rowkey gets at most one upsert and one tombstone per run, so keys are
    # bounded by the number of runs: no hot-key detection pass needed.
    return scd2(stream, ["rowkey"], seq, except_track=untracked, tie_break=prio, hot_key_rows=None)


def live_rows(scd: DataFrame, deleted_column: str | None = "isdeleted") -> DataFrame:
    """Open versions that are not soft-deleted."""
    cond = F.col(END_AT).isNull()
    if deleted_column and deleted_column in scd.columns:
        cond = cond & ~F.col(deleted_column)
    return scd.where(cond)


def lifespan(scd: DataFrame) -> DataFrame:
    """Closed versions with their length: sequence units for numbers, seconds for timestamps."""
    closed = scd.where(F.col(END_AT).isNotNull())
    dtype = scd.schema[START_AT].dataType.simpleString()
    if dtype.startswith("timestamp") or dtype == "date":
        micros = (F.unix_micros(F.col(END_AT).cast("timestamp"))
                  - F.unix_micros(F.col(START_AT).cast("timestamp")))
        length = F.floor(micros / F.lit(1_000_000)).cast("long")
    else:
        length = (F.col(END_AT) - F.col(START_AT)).cast("long")
    return closed.withColumn("lifespan", length)
