"""Keyless row identity: rowhash, rowoccurrence, rowkey (and contenthash).

``rowhash`` fingerprints the identity columns; ``rowoccurrence`` numbers rows
that share a rowhash 1..n; ``rowkey = rowhash || '#' || rowoccurrence``. The
pair makes a multiset of keyless rows addressable: a snapshot diff on rowkey
is an ``EXCEPT ALL`` on the identity columns.

Numbering is skew-proof. The obvious ``row_number() over (partition by rowhash)``
sends every copy of a row to one task, and a single duplicated row may be a
third of the table. Instead rows are numbered inside (rowhash, contenthash,
input split) groups — no group holds more than one input split's worth of
copies, so a hot row is spread over as many tasks as it has input splits —
and each group is shifted by the running total of the groups before it,
computed on the small table of group sizes. Full rows are shuffled once, the same
as for the naive window.

Where identity covers every column the rows are dealt by their fingerprint without
carrying it (it follows from the columns), both branches read that one shuffle, and
the group sizes carry its 32 bytes, not its 64 characters. In the other modes the
group sizes come from a second, narrow branch, which reads a plain scan again. With
``stage`` (a scratch folder) the rows are hashed, tagged with their split and written
there first, so the source is read and hashed exactly once and both branches read the
tagged rows. Persisted runs do so.

Occurrence order: copies are numbered in ``contenthash`` order, so in
key_columns / exclude_columns mode the same multiset always gets the same
numbering (the order of identical copies does not matter: they are equal).
Caveat (documented, as in the reference): the numbering depends on the read
scope, so the snapshot and the sweep must read with the same filters. The
input must be deterministic (a file or table scan plus filters/projections):
split ids are taken in two branches of the plan, which is the same assumption
Spark makes when it recomputes a lost partition. With ``stage`` the tags are data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import quote, row_hash

# The column names a change stream adds (a source may not use
# them) and the accepted identity modes. Downstream layers rely on these names.
CHANGE_COLUMNS = [
    "rowhash", "contenthash", "rowoccurrence", "rowkey",
    "changetype", "isdeleted", "deletedat",
    "snapshotseq", "snapshotts", "windowstart", "windowdays",
]

IDENTITY_MODES = ("hash_all", "key_columns")


def identity_columns(available: Sequence[str], mode: str = "hash_all",
                     key_columns: Sequence[str] = (), exclude_columns: Sequence[str] = ()) -> list[str]:
    """The projected columns whose values make up a row's identity."""
    by_key = mode.lower() == "key_columns"
    if not by_key and mode.lower() != "hash_all":
        raise ValueError(f"identity mode {mode!r} is not one of {', '.join(IDENTITY_MODES)}")
    listed = [*key_columns, *exclude_columns]
    if not all(isinstance(c, str) and c for c in listed):
        raise ValueError(f"identity column names must be non-empty strings: {listed!r}")
    if bool(key_columns) != by_key:
        raise ValueError("identity mode key_columns needs key columns and hash_all takes none")
    chosen = list(key_columns) if by_key else [c for c in available if c not in exclude_columns]
    unknown = set(chosen).difference(available)
    if unknown or not chosen:
        raise ValueError(f"row identity needs at least one column of the projection {list(available)}; "
                         f"not in it: {sorted(unknown)}")
    return chosen


def check_reserved(columns: Sequence[str]) -> None:
    """Raise if the source already uses a name that the change stream adds."""
    taken = [c for c in CHANGE_COLUMNS if c in columns]
    if taken:
        raise ValueError(f"the change stream adds columns that the source has already: {taken}")


def add_identity(df: DataFrame, mode: str = "hash_all", key_columns: Sequence[str] = (),
                 exclude_columns: Sequence[str] = (), allow_duplicates: bool = True,
                 with_contenthash: bool = False, stage: str | None = None) -> DataFrame:
    """Append ``rowhash, rowoccurrence, rowkey`` (plus ``contenthash`` on request).

    With ``stage`` this runs a job that writes the tagged rows to that folder, which
    the result reads.

    Output columns: the input columns in order, then
    ``rowhash, [contenthash,] rowoccurrence, rowkey``.
    """
    business = list(df.columns)
    check_reserved(business)
    id_cols = identity_columns(business, mode, key_columns, exclude_columns)
    whole_row = sorted(id_cols) == sorted(business)

    # Where identity covers every column, the content fingerprint is the same hash.
    hashes = {"rowhash": row_hash(id_cols)} if whole_row else {"rowhash": row_hash(id_cols), "contenthash": row_hash(business)}
    if allow_duplicates:
        df = df.withColumn("_split", F.spark_partition_id())
        if stage is not None:
            df = df.withColumns({"_digest": _digest(id_cols)} if whole_row else hashes)
            df.write.mode("overwrite").parquet(stage)
            df = df.sparkSession.read.schema(df.schema).parquet(stage)
        if whole_row:
            df = _number_equal_rows(df, _digest(id_cols) if stage is None else F.col("_digest"))
        else:
            df = _number_copies(df if stage is not None else df.withColumns(hashes))
    else:
        df = df.withColumns({**hashes, "rowoccurrence": F.lit(1).cast("int")})

    out = [quote(c) for c in business] + ["rowhash"]
    if with_contenthash:
        out.append("rowhash AS contenthash" if whole_row else "contenthash")
    out += ["rowoccurrence", "concat_ws('#', rowhash, rowoccurrence) AS rowkey"]
    return df.selectExpr(*out)


def rowkey_parts(df: DataFrame) -> DataFrame:
    """``df`` with ``_digest`` (the 32 bytes of rowhash), which with rowoccurrence is equal exactly where rowkeys are.

    A join on these two moves half the bytes of one on rowkey.
    """
    return df.withColumn("_digest", F.unhex("rowhash"))


def _digest(columns: Sequence[str]) -> Column:
    """The 32 bytes of rowhash. Typed as never null: a null check in one branch only would keep its shuffle from being reused."""
    return F.coalesce(F.unhex(row_hash(columns)), F.expr("X''"))


def _number_equal_rows(split: DataFrame, digest: Column) -> DataFrame:
    """Assign 1..n to rows of one fingerprint where identity covers every column.

    Plan: ONE shuffle of the rows on (digest, split), which a plan without ``stage``
    computes from the columns on both sides of the shuffle; the row numbers and the
    group sizes both come from it. The sizes (at most one per input split for each
    fingerprint) are shuffled by digest for the running offsets, and the non-zero
    ones are joined back.
    """
    group = ["_digest", "_split"]
    dealt = split.repartition(digest, F.col("_split")).withColumn("_digest", digest)
    rows = dealt.withColumn("_i", F.row_number().over(Window.partitionBy(*group).orderBy("_digest")))
    w = Window.partitionBy("_digest").orderBy("_split").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = dealt.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_off", F.sum("_n").over(w) - F.col("_n"))
    return (_shifted(rows, offsets, group)
            .withColumn("rowhash", F.lower(F.hex("_digest"))).drop("_digest"))


def _number_copies(split: DataFrame) -> DataFrame:
    """Assign 1..n to rows sharing a rowhash, ordered by contenthash (see module doc).

    Plan: ONE shuffle of the rows on (rowhash, contenthash, split) numbers
    each row inside its group (a group never exceeds one input split); the
    group sizes are counted in a narrow branch that is reduced before its shuffle;
    the running offsets are computed on that small table and the non-zero ones are
    joined back.
    """
    group = ["rowhash", "contenthash", "_split"]
    rows = split.withColumn("_i", F.row_number().over(Window.partitionBy(*group).orderBy("rowhash")))
    counts = split.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    # Many contents may share a rowhash (key_columns mode, hot keys): running
    # sums inside contenthash-prefix buckets, plus the total of the buckets
    # before. Prefix order == contenthash order, so the numbering is the
    # contenthash order whatever the bucket count. With g groups in all, prefixes
    # of log2(g) / 8 hex characters make about sqrt(g) buckets of a rowhash that
    # has them all.
    total = counts.agg(F.count(F.lit(1)).alias("_g"))
    chars = F.greatest(F.lit(1), F.ceil(F.log2(F.col("_g") + 1) / 8)).cast("int")
    counts = (counts.join(F.broadcast(total))  # one row
              .withColumn("_b", F.substring("contenthash", F.lit(1), chars)).drop("_g"))
    w = Window.partitionBy("rowhash", "_b").orderBy("contenthash", "_split").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = counts.withColumn("_loc", F.sum("_n").over(w) - F.col("_n"))
    before = Window.partitionBy("rowhash").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        local.groupBy("rowhash", "_b").agg(F.sum("_n").alias("_bn"))
        .withColumn("_boff", F.coalesce(F.sum("_bn").over(before), F.lit(0)))
        .where("_boff > 0").select("rowhash", "_b", "_boff")
    )
    offsets = (local.join(buckets, ["rowhash", "_b"], "left")
               .withColumn("_off", F.col("_loc") + F.coalesce(F.col("_boff"), F.lit(0))))
    return _shifted(rows, offsets, group)


def _shifted(rows: DataFrame, offsets: DataFrame, group: Sequence[str]) -> DataFrame:
    """Row numbers inside groups moved by their group's offset."""
    # Only groups that follow another group of their rowhash need a shift; the
    # rest (all rows of duplicate-free data) keep _i. The shift table is then
    # small for ordinary data and AQE broadcasts it after checking its size.
    shifts = offsets.where(F.col("_off") > 0).select(*group, "_off")
    numbered = rows.join(shifts, list(group), "left")
    return numbered.withColumn("rowoccurrence",
                               (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_i")).cast("int")) \
        .drop("_split", "_i", "_off")
