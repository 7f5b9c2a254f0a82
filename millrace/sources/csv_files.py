"""Delimited file sets: listing, line numbers, typed fields and per-row errors.

Files are read as lines, so a large file is split over tasks like any text file. Line
numbers come from the order of lines inside each split plus the number of lines in the
splits before it; that needs the rows to be written once (``stage_rows``), after which
nothing depends on how a later scan would be cut into tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from millrace import session
from millrace.functions.parse import AUTO
from millrace.functions import null_tokens, parse_date, parse_time_text, parse_timestamp, qcol
from millrace.operators.semistruct import build_map
from millrace.sources.formats import CsvFormat, charset
from millrace.sources.records import records
from millrace.sources.schemas import TIME

# never part of real text: lets an empty field be told from a quoted empty text
_UNSET = "\u0000"
# stands for bytes the encoding does not define
_REPLACED = "\ufffd"
# may stand before the first line
_MARK = "\ufeff"

LINEAGE = ["file", "file_size", "file_modified_at", "block_start", "seq"]
ERROR_TYPE = "struct<message:string,column_name:string,character:bigint>"


@dataclass(frozen=True)
class Location:
    """A folder below a stage root; file names are kept relative to the root."""

    root: str
    folder: str = ""

    @property
    def path(self) -> str:
        return f"{self.root}/{self.folder}".rstrip("/")


def resolve(location: str, stages: dict[str, str]) -> Location:
    """``@stage/folder`` against the known stage roots; other text is a plain path."""
    if not location.startswith("@"):
        return Location(location.rstrip("/"))
    name, _, folder = location[1:].partition("/")
    stage = name.split(".")[-1]
    if stage not in stages:
        raise KeyError(f"unknown stage {stage!r}")
    return Location(stages[stage].rstrip("/"), re.sub("/{2,}", "/", folder).strip("/"))


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``, whatever scheme the file system puts in front of it."""
    bare = re.sub("^file:/*", "/", root.rstrip("/")) + "/"
    return F.substr(path, F.position(F.lit(bare), path) + F.lit(len(bare)))


def source_file(root: str) -> Column:
    """File of a scanned row, below ``root``; the metadata column holds it URL-encoded."""
    path = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return relative_path(F.when(path.contains("%"), decoded).otherwise(path), root)


def list_files(
    spark: SparkSession, location: Location, pattern: str | None = None
) -> DataFrame:
    """Name, size and time of the files below a location; contents are not read.

    ``pattern`` is a regular expression for the whole name below the stage root. A folder
    that does not exist holds no files.
    """
    if not session.path_exists(spark, location.path):
        return spark.createDataFrame(
            [], "path string, file string, file_size bigint, file_modified_at timestamp"
        )
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(location.path)
        .select(
            "path",
            relative_path(F.col("path"), location.root).alias("file"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").alias("file_modified_at"),
        )
    )
    return files if pattern is None else files.where(F.col("file").rlike(f"^(?:{pattern})$"))


def line_source(reader, paths, root: str, fmt: CsvFormat) -> DataFrame:
    """Undecoded lines with the file they come from; batch or stream."""
    if fmt.record_delimiter:
        reader = reader.option("lineSep", fmt.record_delimiter)
    lines = reader.option("recursiveFileLookup", "true").format("text").load(paths)
    return lines.select(
        source_file(root).alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_modified_at"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("value").cast("binary").alias("_bytes"),
    )


LEAST_TASKS = 64  # scans of no more splits have one task for each


def scanned_lines(spark: SparkSession, paths: Sequence[str], root: str, fmt: CsvFormat) -> DataFrame:
    """``line_source`` of a batch; a task takes several splits when these are small and many."""
    lines = line_source(spark.read, list(paths), root, fmt)
    together = session.LEAST_READ // session.split_bytes(spark)
    return lines.coalesce(max(LEAST_TASKS, -(-lines.rdd.getNumPartitions() // together))) if together > 1 else lines


def _decoded(lines: DataFrame, fmt: CsvFormat) -> DataFrame:
    # other charsets must be allowed and undefined bytes must not fail the job; the
    # expression keeps the settings it was built under
    with session.conf_set(
        lines.sparkSession,
        spark__sql__legacy__javaCharsets="true",
        spark__sql__legacy__codingErrorAction="true",
    ):
        decoded = lines.select(
            *LINEAGE[:-1],
            F.monotonically_increasing_id().alias("seq"),
            F.decode("_bytes", charset(fmt.encoding)).alias("_line"),
        )
    if fmt.skip_byte_order_mark:
        decoded = decoded.withColumn("_line", _unmarked(F.col("_line")))
    return decoded


def _unmarked(line: Column) -> Column:
    return F.when(line.startswith(_MARK), F.substring(line, 2, 2**31 - 1)).otherwise(line)


def _field_names(count: int) -> list[str]:
    return [f"_c{i}" for i in range(1, count + 1)]


def _options(fmt: CsvFormat) -> dict[str, str]:
    return {
        "sep": fmt.delimiter,
        "quote": fmt.quote or "\u0000",
        "escape": fmt.quote or "\\",
        "ignoreLeadingWhiteSpace": str(fmt.trim).lower(),
        "ignoreTrailingWhiteSpace": str(fmt.trim).lower(),
        "nullValue": _UNSET,
        "emptyValue": "",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_bad",
    }


def _quoted_fields(lines: DataFrame, count: int, fmt: CsvFormat, *keep: str, **options: str) -> DataFrame:
    names = _field_names(count)
    ddl = ", ".join(f"{n} string" for n in names) + ", _bad string"
    parsed = lines.withColumn("_f", F.from_csv("_line", ddl, {**_options(fmt), **options}))
    # a blank line is one empty field
    short = F.col("_f._bad").isNotNull() | (F.trim("_line") == "" if count > 1 else F.lit(False))
    # a quoted field that goes on in the next line
    unquoted = F.length(F.replace(F.col("_line"), F.lit(fmt.quote), F.lit("")))
    odd = (F.length("_line") - unquoted) / len(fmt.quote) % 2 == 1
    odd = F.when(F.col("_line").contains(fmt.quote), odd).otherwise(False)  # most lines hold none
    return parsed.withColumns({"_short": short, "_odd": odd}).select(
        *LINEAGE, "_line", *keep, "_short", "_odd", *[F.col(f"_f.{n}").alias(n) for n in names]
    )


def _plain_fields(lines: DataFrame, count: int, fmt: CsvFormat) -> DataFrame:
    """Fields of lines without quoting, where a backslash takes the next character as is."""
    parts = lines.withColumn("_f", F.split("_line", r"(?<!\\)" + re.escape(fmt.delimiter)))

    def field(i: int) -> Column:
        text = F.get("_f", F.lit(i))
        if fmt.trim:
            text = F.trim(text)
        spelled_null = text.isin(list(fmt.null_if)) if fmt.null_if else F.lit(False)
        plain = F.when(
            text.contains("\\") & ~spelled_null, F.regexp_replace(text, r"\\(.)", "$1")
        ).otherwise(text)
        return F.when(plain != "", plain)

    return parts.select(
        *LINEAGE,
        "_line",
        (F.size("_f") != count).alias("_short"),
        F.lit(False).alias("_odd"),
        *[field(i).alias(n) for i, n in enumerate(_field_names(count))],
    )


def _split_lines(lines: DataFrame, count: int, fmt: CsvFormat) -> DataFrame:
    if fmt.skip_blank_lines:
        lines = lines.where(F.trim("_line") != "")
    return (_quoted_fields if fmt.quote else _plain_fields)(lines, count, fmt)


def _record_fields(found: DataFrame, count: int, fmt: CsvFormat) -> DataFrame:
    """Fields of records put together from undecoded lines."""
    with session.conf_set(
        found.sparkSession, spark__sql__legacy__javaCharsets="true", spark__sql__legacy__codingErrorAction="true"
    ):
        decoded = F.transform("_lines", lambda line: F.decode(line, charset(fmt.encoding)))
        text = found.select(*LINEAGE, F.array_join(decoded, fmt.record_delimiter or "\n").alias("_line"), "_long")
    if fmt.skip_byte_order_mark:
        text = text.withColumn("_line", _unmarked(F.col("_line")))
    if fmt.skip_blank_lines:
        text = text.where(F.trim("_line") != "")
    fields = _quoted_fields(text, count, fmt, "_long", multiLine="true")
    return fields.withColumn("_odd", F.lit(False))


def typed_value(c: Column, kind, fmt: CsvFormat) -> Column:
    if kind == TIME:
        return parse_time_text(c, auto=fmt.timestamp_format == AUTO)
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.DateType):
        return parse_date(c, fmt.date_format)
    if isinstance(kind, T.TimestampNTZType):
        return parse_timestamp(c, fmt.timestamp_format)
    return c.try_cast(kind)


def _character(position: int, fmt: CsvFormat) -> Column:
    """Where field ``position`` starts in its line; unknown once the line holds quotes."""
    if position == 1:
        return F.lit(1).cast("long")
    before = F.length(F.substring_index("_line", fmt.delimiter, position - 1))
    start = (before + len(fmt.delimiter) + 1).cast("long")
    return F.when(~F.col("_line").contains(fmt.quote), start) if fmt.quote else start


def _typed_fields(rows: DataFrame, columns: Sequence[tuple[str, object]], fmt: CsvFormat) -> DataFrame:
    """Typed columns plus ``_error`` with the first thing wrong in the row."""
    raw = _field_names(len(columns))
    cleaned = rows.withColumns(
        {
            r: null_tokens(qcol(r) if fmt.empty_as_null else F.coalesce(qcol(r), F.lit("")), fmt.null_if)
            for r in raw
        }
    )
    typed = cleaned.withColumns(
        {f"_t{i}": typed_value(qcol(r), kind, fmt) for i, (r, (_, kind)) in enumerate(zip(raw, columns))}
    )

    def error(message: Column, name: str | None = None, at: Column | None = None) -> Column:
        at = F.lit(None).cast("long") if at is None else at
        return F.struct(
            message.alias("message"), F.lit(name).cast("string").alias("column_name"), at.alias("character")
        ).cast(ERROR_TYPE)

    checks = []
    if "_long" in rows.columns:
        checks.append(F.when(F.col("_long"), error(F.lit(f"record of more than {fmt.most_record_bytes} bytes"))))
    if fmt.strict_encoding:
        bad_bytes = F.col("_line").contains(_REPLACED)
        checks.append(F.when(bad_bytes, error(F.lit(f"bytes outside encoding {fmt.encoding}"))))
    if fmt.strict_columns:
        checks.append(
            F.when(F.col("_short"), error(F.lit(f"line does not have {len(columns)} columns")))
        )
    for i, (r, (name, kind)) in enumerate(zip(raw, columns)):
        if not isinstance(kind, T.StringType):
            wrong = qcol(r).isNotNull() & qcol(f"_t{i}").isNull()
            label = kind if isinstance(kind, str) else kind.simpleString()
            message = F.concat(F.lit("'"), qcol(r), F.lit(f"' is not a valid {label}"))
            checks.append(F.when(wrong, error(message, name, _character(i + 1, fmt))))
    first = F.coalesce(*checks) if checks else F.lit(None).cast(ERROR_TYPE)
    return typed.select(
        *LINEAGE,
        first.alias("_error"),
        F.when(first.isNotNull(), F.col("_line")).alias("_rejected"),
        F.coalesce("_odd", F.lit(False)).alias("_odd"),
        *[qcol(f"_t{i}").alias(name) for i, (name, _) in enumerate(columns)],
    )


def rows_of_lines(
    lines: DataFrame, fmt: CsvFormat, columns: Sequence[tuple[str, object]]
) -> DataFrame:
    """Typed rows of undecoded lines that are still in file order."""
    return _typed_fields(_split_lines(_decoded(lines, fmt), len(columns), fmt), columns, fmt)


def scan_rows(
    spark: SparkSession,
    paths: Sequence[str],
    root: str,
    fmt: CsvFormat,
    columns: Sequence[tuple[str, object]],
) -> DataFrame:
    """Lazy typed rows of some files with lineage and errors, not yet numbered."""
    if fmt.multi_line and fmt.quote:
        return record_rows(spark, paths, root, fmt, columns, session.scratch_path(spark, "records"))
    return rows_of_lines(scanned_lines(spark, paths, root, fmt), fmt, columns)


def record_rows(
    spark: SparkSession, paths: Sequence[str], root: str, fmt: CsvFormat, columns: Sequence[tuple[str, object]], folder: str
) -> DataFrame:
    """Typed rows of files whose records may go on over several lines; split over tasks like any lines."""
    found = records(scanned_lines(spark, paths, root, fmt), fmt, folder)
    return _typed_fields(_record_fields(found, len(columns), fmt), columns, fmt)


def records_of(
    spark: SparkSession, root: str, fmt: CsvFormat, columns: Sequence[tuple[str, object]]
) -> Callable[[Sequence[str], str], DataFrame] | None:
    """How to read files below ``root`` again whose quoted fields hold line breaks, given a folder for tables."""
    if not fmt.quote or fmt.multi_line:
        return None
    return lambda files, folder: record_rows(spark, [f"{root}/{literal_path(f)}" for f in files], root, fmt, columns, folder)


def stage_scan(
    spark: SparkSession, paths: Sequence[str], root: str, fmt: CsvFormat, columns: Sequence[tuple[str, object]]
) -> tuple[DataFrame, str]:
    """``scan_rows`` and ``stage_rows`` in one."""
    scanned = scan_rows(spark, paths, root, fmt, columns)
    return stage_rows(scanned, fmt, records_of(spark, root, fmt, columns))


def stage_rows(
    rows: DataFrame, fmt: CsvFormat, again: Callable[[Sequence[str], str], DataFrame] | None = None
) -> tuple[DataFrame, str]:
    """Write scanned rows once to the shared folder and read them back numbered.

    ``line`` is the line in the file, ``row_number`` counts from 1 after the header.
    Header lines stay in, with a row number below 1, so that a file holding nothing else
    is still seen. Returns the rows and the folder to drop when done.

    Numbering joins every row with the index of file splits. The index is a table of its
    own, one short row per split, so the join needs no shuffle of the rows unless there
    are very many splits; then it spreads evenly over them.

    A line with an odd number of quotes may be part of a record of several lines. Files that
    have one are read by ``again``, split by split, and their lines put together; all others
    stay cut into lines. ``line`` then counts records.
    """
    spark = rows.sparkSession
    folder = session.scratch_path(spark, "rows")
    with session.conf_set(spark, spark__sql__legacy__javaCharsets="true"):
        staged = session.written(rows, f"{folder}/rows")
        if again is not None:
            with session.usual_splits(spark):
                broken = session.written(staged.where("_odd").select("file").distinct(), f"{folder}/broken")
                files = [r.file for r in broken.toLocalIterator()]
            if files:
                found = again(files, folder)
                with session.usual_splits(spark):
                    records = session.written(found, f"{folder}/records")
                staged = staged.join(broken, "file", "left_anti").unionByName(records)
    staged = staged.drop("_odd")
    with session.usual_splits(spark):
        splits = session.written(split_index(staged), f"{folder}/splits")
    return number_rows(staged, splits, fmt.skip_header), folder


def split_index(staged: DataFrame) -> DataFrame:
    """What to add to ``seq`` in each file split to get the line in the file."""
    splits = staged.groupBy("file", "block_start").agg(
        F.min("seq").alias("_first"), F.count(F.lit(1)).alias("_lines")
    )
    # a file of any size is one row per split here, not one per line
    before = Window.partitionBy("file").orderBy("block_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shift = F.coalesce(F.sum("_lines").over(before), F.lit(0)) - F.col("_first") + 1
    return splits.select("file", "block_start", shift.alias("_shift"))


def number_rows(staged: DataFrame, splits: DataFrame, skip_header: int = 0) -> DataFrame:
    """Line and row numbers from the order of lines within and between file splits."""
    line = F.col("seq") + F.col("_shift")
    return (
        staged.join(splits, ["file", "block_start"])
        .withColumns({"line": line, "row_number": line - skip_header})
        .drop("_shift", "block_start", "seq")
    )


def data_rows(numbered: DataFrame) -> DataFrame:
    return numbered.where(F.col("row_number") > 0)


def read_csv_typed(
    spark: SparkSession,
    location: Location,
    fmt: CsvFormat,
    columns: Sequence[tuple[str, object]],
    pattern: str | None = None,
    paths: Sequence[str] | None = None,
) -> DataFrame:
    """Numbered, typed rows of a file set: file, line, row_number, ``_error``, columns.

    ``paths`` names the files when the caller has listed them already. File names are the
    only thing that passes through the driver, which holds them for any scan.
    """
    if paths is None:
        paths = [location.path] if pattern is None else file_paths(list_files(spark, location, pattern))
    if not paths:
        return data_rows(_no_rows(spark, columns))
    return data_rows(stage_scan(spark, paths, location.root, fmt, columns)[0])


def _no_rows(spark: SparkSession, columns) -> DataFrame:
    fields = ", ".join(
        ["file string", "file_size bigint", "file_modified_at timestamp", f"_error {ERROR_TYPE}", "_rejected string"]
        + [f"`{n}` {'string' if k == TIME else k.simpleString()}" for n, k in columns]
        + ["line bigint", "row_number bigint"]
    )
    return spark.createDataFrame([], fields)


def literal_path(path: str) -> str:
    """A path without glob characters."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def file_paths(files: DataFrame) -> list[str]:
    """File names for the next scan; Spark's own file index holds the same list."""
    return [literal_path(r.path) for r in files.select("path").toLocalIterator()]


def validation_errors(rows: DataFrame) -> DataFrame:
    """One row per bad line: file, line, place, message and the line itself."""
    return data_rows(rows).where(F.col("_error").isNotNull()).select(
        "file",
        F.col("_error.message").alias("error"),
        "line",
        F.col("_error.character").alias("character"),
        F.col("_error.column_name").alias("column_name"),
        "row_number",
        F.col("_rejected").alias("rejected_record"),
    )


def placed_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Text columns named ``keys`` beside the place of their row: its file and its number there."""
    return data_rows(rows).select(
        F.col("file").alias("source_file_path"),
        F.col("row_number").cast("decimal(38,0)").alias("source_row_number"),
        *[qcol(k) for k in keys],
    )


def objects_of(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Placed rows with their text columns as one object, NULL values included."""
    return placed.select("source_file_path", "source_row_number", build_map({k: qcol(k) for k in keys}).alias("raw_obj"))


def read_csv_as_object(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of text columns named ``keys`` as one object each, NULL values included."""
    return objects_of(placed_rows(rows, keys), keys)
