"""File ingestion: streaming file sources with provenance and schema control.

``FileSource`` carries the reference's per-source options; ``stream_files``
turns them into a Structured Streaming file source (built-in formats only:
json, csv, parquet, orc, text, binaryFile; avro passes through to the
external spark-avro module when it is on the classpath).

Schema handling:

* ``resolve_schema``: inferred types (or all strings when inference is off)
  from all files, with DDL ``schema_hints`` overriding or adding fields;
* evolution modes: ``rescue`` keeps the stored schema and moves unknown columns
  and values that do not fit their declared type, at any depth, into
  ``_rescued_data``; the record stays. ``addNewColumns`` widens the stored
  schema; ``failOnNewColumns`` raises; ``none`` ignores new columns.

Rescue by path (JSON): the text is parsed twice, once by the stored schema and
once as a variant, and what the schema does not account for stays as the JSON
difference of the two. Rescue by name (CSV, parquet, orc): each file's columns
are those of its own header or footer. Files with the same physical columns form
a group, each group is read with its own schema and refitted to the stored one by
name, and columns left over or values that the stored type cannot hold are
rescued. Parquet and orc footers are read by Spark jobs (a group is a set of files
whose schemas merge; a set that does not merge is halved); of a CSV file the
driver reads the first line, ``HEAD_THREADS`` files at a time.

Provenance: ``_staging_ingested_at``, ``_source_file_path``, ``_source_file_name``,
``_source_file_size``, ``_source_file_modified`` from the hidden ``_metadata``
column (works in streaming).

File discovery by listing: ``discover_files`` lists path / modification time /
size (``binaryFile`` without ``content`` — the read prunes file bodies) and
anti-joins a ledger of files already taken; ``medallion.ingest_listed`` keeps
that ledger for sources whose files are overwritten in place
(``allow_overwrites``). Streams skip pre-existing files
(``include_existing_files=False``) by consuming them into an empty first batch,
and take files of any age where ``backfill_interval`` is set (without it, Spark
ignores files that are a week older than the newest one taken).
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.rolling import PROVENANCE, PROVENANCE_COLUMNS
from tidemark.sources import properties

# Fixed option values accepted by the reference configuration.
FORMATS = ("json", "parquet", "csv", "avro", "orc", "text", "binaryfile")
EVOLUTION_MODES = ("rescue", "addNewColumns", "failOnNewColumns", "none")
RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"
#: CSV headers read at a time, and the bytes read of a file at first (more while no line ends in them).
HEAD_THREADS, HEAD_BYTES = 16, 1 << 16
#: Files that one ingestion batch takes at most unless the source says otherwise.
BATCH_FILES = 10_000
#: Longer than any file's age.
ANY_AGE = "36500d"
BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


@dataclass
class FileSource:
    path: str
    file_format: str
    schema_evolution_mode: str = "rescue"
    infer_column_types: bool = True
    schema_hints: str | None = None
    include_existing_files: bool | None = None
    file_name_pattern: str | None = None
    partition_columns: Sequence[str] = ()
    allow_overwrites: bool = False
    ignore_corrupt_files: bool = False
    csv_options: dict = field(default_factory=dict)
    use_managed_file_events: bool = False
    backfill_interval: str | None = None
    max_files_per_trigger: int | None = None
    about: tuple[str, dict] | None = None  # comment and properties of the staging table

    def __post_init__(self):
        if not self.path:
            raise ValueError("source_path is required")
        fmt = (self.file_format or "").lower()
        if fmt not in FORMATS:
            raise ValueError(f"file_format must be one of {FORMATS}, got {self.file_format!r}")
        self.file_format = fmt
        if self.schema_evolution_mode not in EVOLUTION_MODES:
            raise ValueError(f"schema_evolution_mode must be one of {EVOLUTION_MODES}")
        if self.use_managed_file_events and self.backfill_interval:
            raise ValueError("use_managed_file_events and backfill_interval are incompatible")
        if fmt == "csv" and not self.csv_options:
            raise ValueError("csv sources need a non-empty csv_options block")

    @classmethod
    def from_config(cls, src: dict) -> "FileSource":
        """From a source dict with the reference's keys (``source_path``,
        ``file_format``, ``bronze_options.*``)."""
        if not src.get("source_table"):
            raise ValueError("missing required field 'source_table'")
        opts = dict(src.get("bronze_options") or {})
        return cls(
            path=src.get("source_path"), file_format=src.get("file_format", ""),
            schema_evolution_mode=opts.get("schema_evolution_mode", "rescue"),
            infer_column_types=bool(opts.get("infer_column_types", True)),
            schema_hints=opts.get("schema_hints"),
            include_existing_files=opts.get("include_existing_files"),
            file_name_pattern=opts.get("file_name_pattern"),
            partition_columns=tuple(opts.get("partition_columns") or ()),
            allow_overwrites=bool(opts.get("allow_overwrites", False)),
            ignore_corrupt_files=bool(opts.get("ignore_corrupt_files", False)),
            csv_options=dict(opts.get("csv_options") or {}),
            use_managed_file_events=bool(opts.get("use_managed_file_events", False)),
            backfill_interval=opts.get("backfill_interval"), about=properties.staging(src),
        )

    @property
    def spark_format(self) -> str:
        return "binaryFile" if self.file_format == "binaryfile" else self.file_format

    def reader_options(self) -> dict:
        opts: dict[str, str] = {}
        if self.file_name_pattern:
            opts["pathGlobFilter"] = self.file_name_pattern
        if self.ignore_corrupt_files:
            opts["ignoreCorruptFiles"] = "true"
        if self.max_files_per_trigger:
            opts["maxFilesPerTrigger"] = str(int(self.max_files_per_trigger))
        if self.backfill_interval:
            # Every listing then is a full one: it also finds files that arrive with an old modification time.
            opts["maxFileAge"] = ANY_AGE
        if self.file_format == "csv":
            opts["header"] = str(self.csv_options.get("header", True)).lower()
            opts["sep"] = self.csv_options.get("delimiter", ",")
            opts["multiLine"] = str(self.csv_options.get("multiline", False)).lower()
        if self.file_format == "json" and not self.infer_column_types:
            opts["primitivesAsString"] = "true"
        return opts


def parse_hints(spark: SparkSession, ddl: str | None) -> T.StructType:
    if not ddl:
        return T.StructType([])
    return spark.createDataFrame([], ddl).schema


def apply_hints(schema: T.StructType, hints: T.StructType) -> T.StructType:
    """Hinted fields replace inferred ones of the same name; unknown hints are added."""
    by_name = {f.name: f for f in hints.fields}
    fields = [by_name.pop(f.name, f) for f in schema.fields]
    return T.StructType(fields + list(by_name.values()))


def resolve_schema(spark: SparkSession, src: FileSource, paths: Sequence[str] | None = None) -> T.StructType:
    """Schema of all files of a new source, or of the files at ``paths``, with the hints on top."""
    hints = parse_hints(spark, src.schema_hints)
    if src.file_format == "text":
        return T.StructType([T.StructField("value", T.StringType())])
    if src.file_format == "binaryfile":
        return parse_hints(spark, BINARY_SCHEMA)
    inferred = _inferred(spark, src, paths)
    inferred = T.StructType([f for f in inferred.fields if f.name != CORRUPT])
    return apply_hints(inferred, hints)


def _inferred(spark: SparkSession, src: FileSource, paths: Sequence[str] | None) -> T.StructType:
    """All files count: a column may first appear in any of them."""
    def reader():
        return spark.read.format(src.spark_format).options(**src.reader_options())

    if src.file_format == "json":
        if src.partition_columns:  # partition discovery needs the base path
            return reader().option("basePath", src.path).load(list(paths) if paths else src.path).schema
        if paths is None and list_files(spark, src).isEmpty():
            raise ValueError(f"no files to infer a schema from under {src.path}")
        return reader().option("recursiveFileLookup", "true").load(list(paths) if paths else src.path).schema
    if paths is None:
        paths = [r["path"] for r in list_files(spark, src).select("path").toLocalIterator()]
        if not paths:
            raise ValueError(f"no files to infer a schema from under {src.path}")
    if src.file_format == "csv" and not has_header(src):
        found = [reader().option("inferSchema", str(bool(src.infer_column_types)).lower()).load(list(paths)).schema]
    elif src.file_format == "csv":
        found = []
        for header, group in header_groups(spark, src, paths):
            names = T.StructType([T.StructField(n, T.StringType()) for n in header])
            if src.infer_column_types:
                typed = reader().option("inferSchema", "true").load(group).schema  # same columns in the same order
                names = T.StructType([T.StructField(n, f.dataType) for n, f in zip(header, typed.fields)])
            found.append(names)
    else:
        found = [schema for schema, _ in physical_groups(spark, src, paths)]
    merged = found[0]
    for schema in found[1:]:
        merged = merge_schemas(merged, schema)
    if src.partition_columns:
        known = {f.name for f in merged.fields}
        where = spark.read.format("binaryFile").option("basePath", src.path).load(list(paths)).schema
        merged = T.StructType(merged.fields + [f for f in where.fields if f.name in src.partition_columns and f.name not in known])
    return merged


#: Integers and floats, narrow to wide; a mix of both is a double.
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_BROKEN = ("float", "double")


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type for values of both: structs by field, numbers by width, strings for what else differs."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge_schemas(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType), True)
    kinds = a.simpleString(), b.simpleString()
    for scale in (_WHOLE, _BROKEN):
        if all(k in scale for k in kinds):
            return a if scale.index(kinds[0]) >= scale.index(kinds[1]) else b
    if all(k in _WHOLE + _BROKEN for k in kinds):
        return T.DoubleType()
    return T.StringType()


def merge_schemas(a: T.StructType, b: T.StructType) -> T.StructType:
    of = {f.name: f.dataType for f in b.fields}
    fields = [T.StructField(f.name, merge_types(f.dataType, of.pop(f.name, f.dataType))) for f in a.fields]
    return T.StructType(fields + [f for f in b.fields if f.name in of])


# ── physical columns of files ─────────────────────────────────────────────────


def has_header(src: FileSource) -> bool:
    return src.file_format == "csv" and bool(src.csv_options.get("header", True))


def header_groups(spark: SparkSession, src: FileSource, paths: Sequence[str]) -> list[tuple[tuple[str, ...], list[str]]]:
    """CSV files by the columns their first line names; files without any line are left out.

    A name that occurs twice (in any case) or not at all gets its position appended.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    sep = src.csv_options.get("delimiter", ",")
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(path: str) -> tuple[str, ...] | None:
        where = jvm.org.apache.hadoop.fs.Path(path)
        fs, codec, size = where.getFileSystem(conf), codecs.getCodec(where), HEAD_BYTES
        while True:
            stream = fs.open(where)
            try:
                plain = codec.createInputStream(stream) if codec is not None else stream
                head = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(
                    jvm.org.apache.commons.io.input.BoundedInputStream(plain, size)))
            except Exception as broken:
                if src.ignore_corrupt_files and "IOException" in str(broken):
                    return None
                raise
            finally:
                stream.close()
            text = head.decode("utf-8-sig", "replace").lstrip("\r\n")
            if not text.strip() and len(head) < size:
                return None
            if "\n" in text or "\r" in text or len(head) < size:
                names = next(csv.reader(io.StringIO(text, newline=""), delimiter=sep))
                low = [n.lower() for n in names]
                return tuple(n if n and low.count(n.lower()) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names))
            size *= 4

    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEAD_THREADS) as pool:
        for path, names in zip(paths, pool.map(first_line, paths)):
            if names is not None:
                groups.setdefault(names, []).append(path)
    return sorted(groups.items())


def physical_groups(spark: SparkSession, src: FileSource, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Parquet / orc files in groups whose footers merge to one schema (each file's columns read by name)."""
    todo, groups = [list(paths)], {}
    while todo:
        part = todo.pop()
        try:
            schema = (spark.read.format(src.spark_format).options(**src.reader_options())
                      .option("mergeSchema", "true").load(part).schema)
        except (PySparkException, Py4JJavaError):  # schemas that do not merge, or an unreadable file
            if len(part) == 1:
                raise
            todo += [part[:len(part) // 2], part[len(part) // 2:]]
            continue
        groups.setdefault(schema.json(), (schema, []))[1].extend(part)
    return [groups[k] for k in sorted(groups)]


def evolve_schema(stored: T.StructType, incoming: T.StructType, mode: str) -> T.StructType:
    """Schema to read with after ``incoming`` files appear (stored types always win)."""
    if mode not in EVOLUTION_MODES:
        raise ValueError(f"unknown schema evolution mode {mode!r}")
    known = {f.name for f in stored.fields}
    new = [f for f in incoming.fields if f.name not in known]
    if not new or mode in ("none", "rescue"):
        return stored
    if mode == "failOnNewColumns":
        raise ValueError(f"new columns {[f.name for f in new]} with schema_evolution_mode=failOnNewColumns")
    return T.StructType(list(stored.fields) + new)


def rescue(df: DataFrame, text_column: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Parse a JSON text column with ``schema``; keep everything that does not fit.

    ``_rescued_data`` is a JSON object of what the schema does not account for, at
    its path: keys the schema lacks, and values that do not parse as the declared
    type (inside an array of objects, elements that fit stand as null). A document
    that is no JSON object is rescued whole under ``_corrupt_record``. Null when
    nothing was rescued.
    """
    text = F.col(f"`{text_column}`")
    whole = F.try_parse_json(text).try_cast("map<string,variant>")
    staged = df.select(*[F.col(f"`{c}`") for c in keep], text.alias("_t"), F.from_json(text, schema).alias("_p"), whole.alias("_v"))
    rest = _leftover(F.col("_v"), schema, F.col("_p"))
    rescued = (F.when(F.col("_v").isNull() & F.col("_t").isNotNull(), F.to_json(F.struct(F.col("_t").alias(CORRUPT))))
               .when(F.size(rest) > 0, F.to_json(rest)))
    return staged.select(*[F.col(f"`{c}`") for c in keep], "_p.*", rescued.alias(RESCUED))


def _leftover(entries: Column, schema: T.StructType, parsed: Column) -> Column:
    """The entries (name -> variant) of an object that ``schema`` does not account for."""
    def of(name: Column, value: Column) -> Column:
        left = value
        for f in schema.fields:
            left = F.when(name == F.lit(f.name), _misfit(value, f.dataType, parsed.getField(f.name))).otherwise(left)
        return left
    return F.map_filter(F.transform_values(entries, of), lambda k, v: v.isNotNull())


def _misfit(value: Column, kind: T.DataType, parsed: Column) -> Column:
    """What of a variant its declared type does not hold, or null."""
    lost = F.when(parsed.isNull() & ~F.is_variant_null(value), value)
    if isinstance(kind, T.StructType):
        entries = value.try_cast("map<string,variant>")
        rest = _leftover(entries, kind, parsed)
        return F.when(parsed.isNull() | entries.isNull(), lost).when(F.size(rest) > 0, F.to_variant_object(rest))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        items = value.try_cast("array<variant>")
        rest = F.transform(items, lambda x, i: _misfit(x, kind.elementType, F.get(parsed, i)))
        return (F.when(parsed.isNull() | items.isNull(), lost)
                .when(F.exists(rest, lambda x: x.isNotNull()), F.to_variant_object(rest)))
    return lost


def rescue_csv(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """CSV read as all strings -> declared types; misfits and further columns rescued."""
    have = T.StructType([f for f in df.schema.fields if f.name not in keep])
    return refit(df, have, schema, keep)


def refit(df: DataFrame, have: T.StructType, want: T.StructType, keep: Sequence[str] = (), rescued: bool = True) -> DataFrame:
    """Columns of ``want`` by name from a file's columns ``have``; the rest as JSON in ``_rescued_data``."""
    of = {f.name: f for f in have.fields}
    typed, left = [], []
    for f in want.fields:
        mine = of.pop(f.name, None)
        if mine is None:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value, rest, present = _fit(F.col(f"`{f.name}`"), mine.dataType, f.dataType, df.sparkSession)
        typed.append(value.alias(f.name))
        if rest is not None:
            left.append((present, rest.alias(f.name)))
    for name in sorted(of):
        left.append((F.col(f"`{name}`").isNotNull(), F.col(f"`{name}`")))
    kept = [F.col(f"`{c}`") for c in keep]
    if not rescued:
        return df.select(*kept, *typed)
    some = F.lit(False)
    for present, _ in left:
        some = some | present
    packed = F.to_json(F.struct(*[c for _, c in left])) if left else F.lit(None).cast("string")
    return df.select(*kept, *typed, F.when(some, packed).alias(RESCUED))


def _fit(value: Column, have: T.DataType, want: T.DataType, spark: SparkSession) -> tuple[Column, Column | None, Column | None]:
    """(value as ``want``, what that loses, whether it loses anything)."""
    if have.simpleString() == want.simpleString():
        return value, None, None
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        of = {f.name: f for f in have.fields}
        typed, left = [], []
        for f in want.fields:
            mine = of.pop(f.name, None)
            if mine is None:
                typed.append(F.lit(None).cast(f.dataType).alias(f.name))
                continue
            part, rest, present = _fit(value.getField(f.name), mine.dataType, f.dataType, spark)
            typed.append(part.alias(f.name))
            if rest is not None:
                left.append((present, rest.alias(f.name)))
        left += [(value.getField(n).isNotNull(), value.getField(n).alias(n)) for n in sorted(of)]
        whole = F.when(value.isNotNull(), F.struct(*typed))
        if not left:
            return whole, None, None
        some = F.lit(False)
        for present, _ in left:
            some = some | F.coalesce(present, F.lit(False))
        return whole, F.when(some, F.struct(*[c for _, c in left])), some
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        _, lost, _ = _fit(F.lit(None).cast(have.elementType), have.elementType, want.elementType, spark)
        whole = F.transform(value, lambda x: _fit(x, have.elementType, want.elementType, spark)[0])
        if lost is None:
            return whole, None, None
        some = F.coalesce(F.exists(value, lambda x: F.coalesce(_fit(x, have.elementType, want.elementType, spark)[2], F.lit(False))), F.lit(False))
        return whole, F.when(some, F.transform(value, lambda x: _fit(x, have.elementType, want.elementType, spark)[1])), some
    typed = F.lit(None).cast(want)
    try:
        spark.range(0).select(F.lit(None).cast(have).try_cast(want)).schema
        typed = value.try_cast(want)
    except AnalysisException:
        pass
    lost = value.isNotNull() & typed.isNull()
    if isinstance(have, T.NumericType) and isinstance(want, T.NumericType):
        lost = lost | (typed.cast(have) != value)  # 2.7 is no integer
    lost = F.coalesce(lost, F.lit(False))
    return F.when(~lost, typed), F.when(lost, value), lost


def with_provenance(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Provenance columns from the file source's hidden ``_metadata`` struct."""
    at = ingested_at if ingested_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return df.withColumns({
        "_staging_ingested_at": at,
        "_source_file_path": F.col("_metadata.file_path"),
        "_source_file_name": F.col("_metadata.file_name"),
        "_source_file_size": F.col("_metadata.file_size").cast("long"),
        "_source_file_modified": F.col("_metadata.file_modification_time").cast("timestamp_ntz"),
    })


def stream_files(spark: SparkSession, src: FileSource, schema: T.StructType | None = None,
                 ingested_at: Column | None = None) -> DataFrame:
    """Streaming DataFrame of the source's files (+ provenance, + rescue column).

    Sources that are read ``by_name`` differ from file to file and have no such
    stream; ``medallion.ingest_staging`` takes them in batches of files.
    """
    if by_name(src):
        raise ValueError(f"{src.file_format} files are read by name: use medallion.ingest_staging")
    stored = schema if schema is not None else resolve_schema(spark, src)
    return _read(spark.readStream, src, stored, src.path, ingested_at)


def by_name(src: FileSource) -> bool:
    """Whether files differ in their physical columns in a way only a look at each of them tells."""
    return has_header(src) or (src.file_format in ("parquet", "orc") and src.schema_evolution_mode == "rescue")


def read_files(spark: SparkSession, src: FileSource, paths: Sequence[str], schema: T.StructType,
               ingested_at: Column | None = None) -> DataFrame:
    """Batch DataFrame of some of the source's files, with the columns of ``stream_files``."""
    if by_name(src):
        return _read_by_name(spark, src, paths, schema, ingested_at)
    reader = spark.read.option("basePath", src.path) if src.partition_columns else spark.read
    return _read(reader, src, schema, list(paths), ingested_at)


def _read_by_name(spark: SparkSession, src: FileSource, paths: Sequence[str], stored: T.StructType,
                  ingested_at: Column | None) -> DataFrame:
    """Groups of files with the same physical columns, each refitted to the stored schema."""
    rescued = src.schema_evolution_mode == "rescue"
    parts = [f for f in stored.fields if f.name in set(src.partition_columns)]
    inside = T.StructType([f for f in stored.fields if f not in parts])
    last = [*[f.name for f in inside.fields], *[f.name for f in parts], *([RESCUED] if rescued else []), *PROVENANCE_COLUMNS]
    if src.file_format == "csv":
        # Values are read as text, so a line of another length or a mistyped value loses nothing.
        groups = [(T.StructType([T.StructField(n, T.StringType()) for n in [*header, CORRUPT]]), group)
                  for header, group in header_groups(spark, src, paths)]
    else:
        groups = physical_groups(spark, src, paths)
    out = None
    for have, group in groups:
        reader = spark.read.options(**src.reader_options())
        if src.partition_columns:
            reader = reader.option("basePath", src.path)
        if src.file_format == "csv":
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        rows = with_provenance(reader.format(src.spark_format).schema(T.StructType([*have.fields, *parts])).load(group), ingested_at)
        rows = refit(rows, have, inside, [*[f.name for f in parts], *PROVENANCE_COLUMNS], rescued).select(*last)
        out = rows if out is None else out.unionByName(rows)
    if out is not None:
        return out
    kinds = {**{f.name: f.dataType.simpleString() for f in stored.fields}, RESCUED: "string",
             **dict(PROVENANCE)}
    return spark.createDataFrame([], ", ".join(f"`{c}` {kinds[c]}" for c in last))


def _read(reader, src: FileSource, stored: T.StructType, where, ingested_at: Column | None) -> DataFrame:
    rs = reader.options(**src.reader_options())
    if src.file_format == "json" and src.schema_evolution_mode == "rescue":
        # Partition values stand in the paths, not in the text; the JSON reader skips blank lines.
        parts = list(src.partition_columns or ())
        inside = T.StructType([f for f in stored.fields if f.name not in parts])
        lines = rs.format("text")
        if parts:
            lines = lines.schema(T.StructType([T.StructField("value", T.StringType()),
                                               *[f for f in stored.fields if f.name in parts]]))
        df = with_provenance(lines.load(where).where(F.trim("value") != ""), ingested_at)
        prov = PROVENANCE_COLUMNS
        return rescue(df, "value", inside, keep=[*parts, *prov]).select(
            *[f.name for f in stored.fields], RESCUED, *prov)
    if src.file_format == "csv" and src.schema_evolution_mode == "rescue":  # without header: by position
        strings = T.StructType([T.StructField(f.name, T.StringType()) for f in [*stored.fields, T.StructField(CORRUPT, T.StringType())]])
        df = with_provenance(rs.format("csv").option("columnNameOfCorruptRecord", CORRUPT).schema(strings).load(where), ingested_at)
        prov = PROVENANCE_COLUMNS
        return rescue_csv(df, stored, keep=prov).select(*[f.name for f in stored.fields], RESCUED, *prov)
    df = rs.format(src.spark_format).schema(stored).load(where)
    if src.partition_columns:
        discovered = [f.name for f in stored.fields if f.name not in set(src.partition_columns)]
        df = df.select(*discovered, *src.partition_columns)
    return with_provenance(df, ingested_at)


def list_files(spark: SparkSession, src: FileSource) -> DataFrame:
    """(path, modificationTime, length) of every matching file; bodies are not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if src.file_name_pattern:
        r = r.option("pathGlobFilter", src.file_name_pattern)
    return r.load(src.path).select("path", "modificationTime", "length")


def stream_listing(spark: SparkSession, src: FileSource) -> DataFrame:
    """Stream of the paths of matching files as they arrive; bodies are not read."""
    options = {k: v for k, v in src.reader_options().items() if k in ("pathGlobFilter", "maxFileAge")}
    return (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).options(**options).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", str(src.max_files_per_trigger or BATCH_FILES)).load(src.path).select("path"))


def discover_files(spark: SparkSession, src: FileSource, ledger: DataFrame | None) -> DataFrame:
    """Files not yet taken. With ``allow_overwrites`` a rewritten file (same path,
    newer modification time) counts as new; otherwise the path alone decides.
    ``ledger=None`` is the first listing: everything is new unless
    ``include_existing_files`` is False (then nothing is, and the caller seeds
    the ledger with this listing)."""
    listing = list_files(spark, src)
    if ledger is None:
        return listing.limit(0) if src.include_existing_files is False else listing
    keys = ["path", "modificationTime"] if src.allow_overwrites else ["path"]
    return listing.join(ledger.select(*keys).distinct(), keys, "left_anti")
