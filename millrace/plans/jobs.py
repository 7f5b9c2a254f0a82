"""Load jobs: typed tables, wide production records, all datasets, recovery."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F

from millrace import session
from millrace.functions import base_name, event_id, parse_number, qcol, split_target
from millrace.functions.parse import parse_timestamp
from millrace.operators import merge, quality, runlog, semistruct
from millrace.sources import config, csv_files, formats, schemas
from millrace.sources.store import BATCH, TableStore

# Where below the stage root, and how, the wide production files arrive.
WIDE_LOCATION = "@MY_AZURE_STAGE/IoT/FH/Recv/"
WIDE_PATTERN = r".*Prod_log/.*\.csv"
WIDE_FORMAT = "FF_CSV_PROD_LOG_FH"
RAW, EVENTS, DEFECTS = "PROD_LOG_FH_RAW", "PROD_LOG_FH", "PROD_LOG_FH_DEFECT"
# The four typed logs, their folders, format and error policy.
TYPED_LOADS = {
    name: {
        "target": name,
        "load_type": "APPEND",
        "location": f"@MY_AZURE_STAGE/IoT/Recv/{name}/",
        "file_format": "FF_CSV_COMMON",
        "on_error": "SKIP_FILE",
    }
    for name in ("MC_LOG", "PROD_LOG", "REEL_LOG", "STOP_LOG")
}


class LoadError(Exception):
    """A load that cannot go on; ``kind`` says why."""

    INVALID_LOAD_TYPE = "INVALID_LOAD_TYPE"
    INVALID_TARGET = "INVALID_TARGET"
    TABLE_NOT_FOUND = "TABLE_NOT_FOUND"
    UNEXPECTED_RESULT = "UNEXPECTED_RESULT"
    BAD_ROWS = "BAD_ROWS"
    # The error numbers callers know
    CODES = {INVALID_LOAD_TYPE: -20001, INVALID_TARGET: -20002, TABLE_NOT_FOUND: -20003, UNEXPECTED_RESULT: -20004}

    def __init__(self, kind: str, text: str):
        super().__init__(f"{kind}: {text}")
        self.kind, self.code = kind, self.CODES.get(kind)


# Fixed value: status of a load that found no files.
NO_FILES = "Copy executed with 0 files processed."


@dataclass
class LoadResult:
    status: str
    outcomes: DataFrame
    error_files: int = 0
    error_rows: int = 0
    digest: DataFrame | None = None
    copy_status: str = NO_FILES


def _batch(run_at: datetime, label: str, *what: str | None) -> str:
    """Id of a load: its time, and what it loads from where to where; no two loads share one."""
    mark = hashlib.sha1(repr(what).encode()).hexdigest()[:12]
    plain = re.sub(r"\W", "_", label)  # part of a folder's name
    return f"{run_at:%Y%m%dT%H%M%S%f}_{plain}_{mark}"


def _plain_table(store: TableStore, target: str) -> str:
    name = target.split(".")[-1]
    if store.layout(name) not in schemas.LOADABLE:
        raise LoadError(LoadError.TABLE_NOT_FOUND, target)
    return name


def _totals(outcomes: DataFrame) -> tuple[int, int]:
    """Bad files and bad rows, one row from the cluster."""
    row = outcomes.agg(
        F.count_if(F.col("errors_seen") > 0).alias("files"),
        F.coalesce(F.sum("errors_seen"), F.lit(0)).alias("rows"),
    ).first()
    return row.files, row.rows


def _bad_rows(outcomes: DataFrame) -> LoadError:
    first = outcomes.where(F.col("errors_seen") > 0).orderBy("file").first()
    return LoadError(
        LoadError.BAD_ROWS, f"{first.file} line {first.first_error_line}: {first.first_error}"
    )


def history_without(store: TableStore, batch: str) -> DataFrame:
    """Load history without this batch's own rows, so a repeated batch sees the same files."""
    past = store.read("LOAD_HISTORY", with_batch=True)
    return past.where(F.col(BATCH) != batch).drop(BATCH)


def _load_paths(
    store: TableStore,
    table: str,
    paths: list[str],
    root: str,
    fmt: formats.CsvFormat,
    on_error: str,
    run_at: datetime,
    batch: str,
    collect_errors=None,
) -> tuple[DataFrame, int, int]:
    """Parse once, record outcomes, then append the rows of good files."""
    columns = schemas.columns(store.layout(table))
    rows, folder = csv_files.stage_scan(store.spark, paths, root, fmt, columns)
    try:
        with session.usual_splits(store.spark):
            # one row per file, kept as a table: read several times, and small enough for the
            # planner to see that filtering rows by it needs no shuffle
            outcomes = session.written(quality.file_outcomes(rows, table, run_at), f"{folder}/files")
            files, errors = _totals(outcomes)
            if collect_errors is not None:
                collect_errors(csv_files.validation_errors(rows) if files else None)
            if files and on_error == "ABORT_STATEMENT":
                raise _bad_rows(outcomes)
            good = csv_files.data_rows(rows)
            if files:
                good = quality.rows_of_good_files(good, outcomes)
            # rows and history appear together: a load that stops half-way leaves its files pending
            store.begin(batch)
            store.append(table, good, batch)
            store.append("LOAD_HISTORY", outcomes, batch)
            store.commit(batch)
            return store.read("LOAD_HISTORY", [batch]), files, errors
    finally:
        store.drop_folder(folder)


def load_table(
    store: TableStore,
    target: str,
    load_type: str,
    location: str,
    file_format: str,
    pattern: str | None = None,
    on_error: str = "ABORT_STATEMENT",
    force: bool = False,
    run_at: datetime | None = None,
    collect_errors=None,
    label: str = "",
) -> LoadResult:
    """Load the files below a location into a table.

    APPEND adds the rows of files not loaded before (all files with ``force``) and gives
    WARN when files had errors under SKIP_FILE. FULL_REFRESH replaces the table by all
    files and fails on any bad value. ``run_at`` names the load, together with target, place,
    pattern, format and ``label``: the same load run again under the same time replaces its
    own rows, and no other's.
    """
    run_at = run_at or datetime.now()
    kind = (load_type or "").upper()
    if kind == "FULL_REFRESH":
        return _full_refresh(store, target, location, file_format, pattern, run_at)
    if kind != "APPEND":
        raise LoadError(LoadError.INVALID_LOAD_TYPE, f"{load_type!r}, use APPEND or FULL_REFRESH")
    if on_error not in quality.POLICIES:
        raise ValueError(f"unknown error policy {on_error!r}")
    table, fmt = _plain_table(store, target), formats.named(file_format)
    place = csv_files.resolve(location, store.stages)
    batch = _batch(run_at, table, label, target, place.path, pattern, file_format)
    files = csv_files.list_files(store.spark, place, pattern)
    if not force:
        files = quality.pending_files(files, history_without(store, batch), table)
    paths = csv_files.file_paths(files)
    if not paths:
        return LoadResult("OK", store.read("LOAD_HISTORY", []))
    outcomes, bad_files, bad_rows = _load_paths(
        store, table, paths, place.root, fmt, on_error, run_at, batch, collect_errors
    )
    digest = runlog.error_digest(outcomes) if bad_files else None
    least = outcomes.agg(F.min("status").alias("status"), F.count_if(F.col("status").isNull()).alias("none")).first()
    if least.none:
        raise LoadError(LoadError.UNEXPECTED_RESULT, f"{least.none} file(s) of {target} without a status")
    return LoadResult("WARN" if bad_files else "OK", outcomes, bad_files, bad_rows, digest, least.status or NO_FILES)


def _full_refresh(store, target, location, file_format, pattern, run_at) -> LoadResult:
    if not all(split_target(target)):
        raise LoadError(LoadError.INVALID_TARGET, f"{target!r}, use DB.SCHEMA.TABLE")
    table = _plain_table(store, target)
    # fields are taken by position: missing ones are NULL, surplus ones ignored
    fmt = formats.named(file_format).with_options(strict_columns=False)
    place = csv_files.resolve(location, store.stages)
    paths = csv_files.file_paths(csv_files.list_files(store.spark, place, pattern))
    empty = store.read("LOAD_HISTORY", [])
    if not paths:
        store.replace(table, store.read(table).limit(0))
        return LoadResult("OK", empty)
    rows, folder = csv_files.stage_scan(store.spark, paths, place.root, fmt, schemas.columns(store.layout(table)))
    try:
        outcomes = session.written(quality.file_outcomes(rows, table, run_at), f"{folder}/files")
        if _totals(outcomes)[0]:
            raise _bad_rows(outcomes)
        store.replace(table, csv_files.data_rows(rows), _batch(run_at, table, target, place.path, pattern, file_format))
    finally:
        store.drop_folder(folder)
    return LoadResult("OK", empty)


# --- wide production records ---------------------------------------------------------------


def ingest_raw_objects(
    store: TableStore,
    run_at: datetime,
    location: str = WIDE_LOCATION,
    pattern: str | None = WIDE_PATTERN,
    file_format: str = WIDE_FORMAT,
) -> str | None:
    """Add the rows of new or changed files as objects; known rows stay as they are.

    Files unchanged since they were read hold no new rows and are not read again. Returns
    the id of the batch written, if any.
    """
    fmt = formats.named(file_format)
    place = csv_files.resolve(location, store.stages)
    batch = _batch(run_at, RAW, place.path, pattern, file_format)
    files = csv_files.list_files(store.spark, place, pattern)
    paths = csv_files.file_paths(
        quality.pending_files(files, history_without(store, batch), RAW)
    )
    if not paths:
        return None
    text = [(key, schemas.TEXT) for key in schemas.WIDE_KEYS]
    rows, folder = csv_files.stage_scan(store.spark, paths, place.root, fmt, text)
    try:
        add_raw_objects(store, rows, run_at, batch)
    finally:
        store.drop_folder(folder)
    return batch


def add_raw_objects(store: TableStore, rows: DataFrame, run_at: datetime, batch: str) -> tuple[int, int]:
    """Insert numbered text rows that the raw table does not hold yet, as one batch.

    As in typed loads, a file with a bad line loads nothing and stays pending; returns the
    bad files and bad rows. The load history names the batches that hold earlier rows of the
    same files. Usually there are none and the rows are written as they come; otherwise only
    the keys of those batches are read. Rows and history appear together.
    """
    listed = session.scratch_path(store.spark, "files")
    try:
        outcomes = session.written(quality.file_outcomes(rows, RAW, run_at), listed)
        bad = _totals(outcomes)
        good = quality.rows_of_good_files(rows, outcomes) if bad[0] else rows
        placed = csv_files.placed_rows(good, schemas.WIDE_KEYS)
        past = store.read("LOAD_HISTORY", with_batch=True).where(
            (F.col("target_table") == RAW) & (F.col("rows_loaded") > 0) & (F.col(BATCH) != batch)
        )
        earlier = past.join(outcomes.select("file"), "file", "left_semi").select(BATCH).distinct()
        # batch ids of re-delivered files only
        earlier = sorted(r[BATCH] for r in earlier.toLocalIterator())
        store.begin(batch)
        if earlier:
            keys = ["source_file_path", "source_row_number"]
            # before objects are made: these repeat their keys, and would be shuffled and sorted with every row
            placed = merge.insert_new(store.read(RAW, earlier), placed, keys, scope=["source_file_path"])
        found = csv_files.objects_of(placed, schemas.WIDE_KEYS).withColumn(
            "loaded_at", F.lit(run_at).cast("timestamp_ntz")
        )
        store.append(RAW, found, batch)
        store.append("LOAD_HISTORY", outcomes, batch)
        store.commit(batch)
        return bad
    finally:
        store.drop_folder(listed)


def events_of(raw: DataFrame) -> DataFrame:
    """Typed event per raw object."""

    def field(name: str, kind):
        text = F.try_element_at("raw_obj", F.lit(name))
        if kind == schemas.STAMP:
            return parse_timestamp(text)
        if kind == schemas.TEXT:
            return text
        # numbers are whole here, also the rate that its column would give a decimal
        return parse_number(text).try_cast(kind)

    return raw.select(
        event_id(F.col("source_file_path"), F.col("source_row_number")).alias("event_id"),
        "source_file_path",
        "source_row_number",
        *[field(name, kind).alias(name) for name, kind in schemas.PRODUCTION_FIELDS],
        *[c for c in raw.columns if c == BATCH],
    )


def defects_of(raw: DataFrame) -> DataFrame:
    """Long rows of the numeric values beside the known fields."""
    keyed = raw.withColumn("event_id", event_id(F.col("source_file_path"), F.col("source_row_number")))
    keep = ["event_id", "source_file_path", "source_row_number"] + [c for c in raw.columns if c == BATCH]
    return semistruct.unpivot_numeric(keyed, F.col("raw_obj"), keep, schemas.FIELD_KEYS)


def normalize_events(
    store: TableStore, run_at: datetime, batches: list[str] | None = None
) -> str:
    """Upsert events and defects from the raw table.

    All raw rows take part by default and every matched row gets a new update time. With
    ``batches`` only those raw batches are read and only their part of the target tables
    is rewritten: a raw row never leaves its batch, so neither do its event and defects.
    """
    raw = store.read(RAW, batches, with_batch=True)
    several = len(store.batches(RAW) if batches is None else batches) > 1
    for table, rows, keys in (
        (EVENTS, events_of(raw), ["event_id"]),
        (DEFECTS, defects_of(raw), ["event_id", "defect_name"]),
    ):
        present = set(store.batches(table))
        now = F.lit(run_at).cast("timestamp_ntz")
        if not present or (batches is not None and not present & set(batches)):
            # nothing to match: a plain write, no shuffle
            fresh = rows.withColumns({"created_at": now, "updated_at": now})
            store.merge_batches(table, fresh, deal=several)
        else:
            target = store.read(table, batches, with_batch=True)
            merged = merge.upsert(target, rows, [*keys, BATCH], run_at)
            store.merge_batches(table, merged, deal=several)
    return "OK"


def refresh_events(store: TableStore, run_at: datetime, incremental: bool = True, **source) -> str:
    """Ingest, then normalize the rows of the new batch, or all raw rows without ``incremental``.

    WARN says that files with bad lines were left out; they stay pending.
    """
    batch = ingest_raw_objects(store, run_at, **source)
    if batch is not None or not incremental:
        normalize_events(store, run_at, [batch] if incremental else None)
    bad = batch is not None and not store.read("LOAD_HISTORY", [batch]).where("errors_seen > 0").isEmpty()
    return "WARN" if bad else "OK"


# --- all datasets and recovery ---------------------------------------------------------------

RUN_LOG, ERROR_LOG, QUEUE, CONFIG = (
    "OPS_RUN_LOG",
    "OPS_ERROR_LOG",
    "OPS_RECOVERY_QUEUE",
    "OPS_DATASET_CONFIG",
)


def _log_rows(df: DataFrame, system, dataset, target, run_at, **values) -> DataFrame:
    """Rows in run-log shape; the result row itself is kept as an object."""
    fixed = {
        "run_at": F.lit(run_at).cast("timestamp_ntz"),
        "system": F.lit(system),
        "dataset": F.lit(dataset),
        "target_table": F.lit(target),
    }
    chosen = {**fixed, **values, "raw": semistruct.row_as_object(df)}
    return df.select(
        *[chosen[f.name].cast(f.dataType).alias(f.name) for f in schemas.schema(RUN_LOG).fields]
    )


def _failure(store, system, dataset, target, run_at, status: str, error: Exception) -> DataFrame:
    text = str(error)
    df = store.spark.createDataFrame([(text,)], "exception string")
    return _log_rows(
        df,
        system,
        dataset,
        target,
        run_at,
        file_path=F.lit(None),
        file_name=F.lit(None),
        status=F.lit(status),
        errors_seen=F.lit(None),
        first_error_message=F.lit(text),
        error_flag=F.lit(True),
    )


def _below(base_path: str, folder: str) -> "F.Column":
    """Logged path: the dataset's location plus the file name below its folder."""
    skip = len(folder) + 2 if folder else 1
    return F.concat(F.lit(base_path.rstrip("/") + "/"), F.substr(F.col("file"), F.lit(skip)))


STATE, SEEN = "OPS_RECOVERY_STATE", "OPS_RECOVERY_SEEN"
AT_ONCE = 4  # datasets loaded side by side


def run_datasets(store: TableStore, system: str, run_at: datetime, at_once: int = AT_ONCE) -> str:
    """Check, load and log every active dataset of a system, ``at_once`` at a time.

    Each dataset's files are parsed once; bad lines and file outcomes both come from that
    pass and go to the run log in one write. One failing dataset does not stop the others.
    Datasets write batches of their own, so the tables do not depend on who ends first.
    """
    # one row per configured dataset, a hand-kept list
    rows = config.active_datasets(store.read(CONFIG), system).orderBy("dataset").collect()
    session.side_by_side(store.spark, [partial(_run_dataset, store, row, run_at) for row in rows], at_once)
    return f"DONE: {len(rows)} dataset(s)"


def _run_dataset(store: TableStore, row, run_at: datetime) -> None:
    label = f"{row.system}_{row.dataset}"
    batch = _batch(run_at, label, row.system, row.dataset)
    who = (row.system, row.dataset, row.target_table, run_at)
    logged = []

    def log_errors(errors: DataFrame | None) -> None:
        logged.append(True)
        if errors is None:
            return
        place = csv_files.resolve(row.base_path, store.stages)
        found = _log_rows(
            errors,
            *who,
            file_path=_below(row.base_path, place.folder),
            file_name=base_name(F.col("file")),
            status=F.lit("VALIDATION_ERROR"),
            errors_seen=F.lit(1),
            first_error_message=F.col("error"),
            error_flag=F.lit(True),
        )
        store.append(RUN_LOG, found, batch + "_check")

    try:
        place = csv_files.resolve(row.base_path, store.stages)
        result = load_table(
            store,
            row.target_table,
            "APPEND",
            row.base_path,
            row.file_format,
            on_error=row.on_error,
            run_at=run_at,
            collect_errors=log_errors,
            label=label,
        )
        status, errors = F.col("status"), F.col("errors_seen")
        log = _log_rows(
            result.outcomes,
            *who,
            file_path=_below(row.base_path, place.folder),
            file_name=base_name(F.col("file")),
            status=status,
            errors_seen=runlog.outcome_errors(status, errors),
            first_error_message=F.coalesce("first_error", F.lit("")),
            error_flag=runlog.outcome_flag(status, errors),
        )
    except Exception as error:  # noqa: BLE001 - one dataset must not stop the others
        log = _failure(store, *who, "LOAD_FAILED", error)
        if not logged:
            log = _failure(store, *who, "VALIDATION_FAILED", error).unionByName(log)
    store.append(RUN_LOG, log, batch)


def rebuild_error_log(store: TableStore) -> None:
    store.replace(ERROR_LOG, runlog.error_log(store.read(RUN_LOG)))


def rebuild_recovery_queue(
    store: TableStore, run_at: datetime, exclude_recovered: bool = False
) -> None:
    store.replace(
        QUEUE,
        runlog.recovery_queue(
            store.read(ERROR_LOG),
            store.read(CONFIG),
            run_at,
            store.read(RUN_LOG),
            exclude_recovered,
            tie_break=["status", "first_error_message"],
        ),
    )


def update_recovery_queue(store: TableStore, run_at: datetime, exclude_recovered: bool = False) -> int:
    """The queue of ``rebuild_recovery_queue``, kept up from the log batches not seen before; returns their number.

    Only new batches of the run log are read. They are merged into a state of one row per
    file, in whatever order they come; a run that stops half-way takes its batches again,
    which changes nothing. As a rebuild does, this loses the states of settled items.
    """
    seen = store.read(SEEN)
    new = store.spark.createDataFrame([(b,) for b in store.batches(RUN_LOG)], "batch string").join(seen, "batch", "left_anti")
    new = sorted(r.batch for r in new.toLocalIterator())
    if new:
        fresh = runlog.recovery_state(store.read(RUN_LOG, new))
        store.replace(STATE, runlog.merged_states(store.read(STATE).unionByName(fresh)))
        store.replace(SEEN, seen.unionByName(store.spark.createDataFrame([(b,) for b in new], "batch string")))
    store.replace(QUEUE, runlog.queue_of_state(store.read(STATE), store.read(CONFIG), run_at, exclude_recovered))
    return len(new)


def run_recovery(store: TableStore, system: str, run_at: datetime, at_once: int = AT_ONCE) -> str:
    """Load the queued files again and settle their queue items, ``at_once`` datasets at a time.

    All pending files of a dataset are loaded together. An item is done, or in error with
    the message of its bad file; both count. An item whose dataset is not configured, or
    whose file fails under ABORT_STATEMENT, is in error and does not count.
    """
    queue = store.read(QUEUE)
    pending = queue.where((F.col("system") == system) & (F.col("status") == "PENDING"))
    active = config.active_datasets(store.read(CONFIG), system)
    settled: list[DataFrame] = []
    unknown = pending.join(active.select("dataset"), "dataset", "left_anti").select(
        "queue_id", F.lit("ERROR").alias("status"), F.lit("CONFIG NOT FOUND").alias("note"),
        F.lit(False).alias("counted"),
    )
    settled.append(unknown)
    def recover(row) -> DataFrame:
        items = pending.where(F.col("dataset") == row.dataset).select("queue_id", "pattern", "force")
        return _recover_dataset(store, row, items, run_at)

    rows = active.orderBy("dataset").collect()
    settled += session.side_by_side(store.spark, [partial(recover, row) for row in rows], at_once)
    changes = reduce(DataFrame.unionByName, settled)
    # the outcome is read twice and comes from tables this job goes on to replace
    folder = f"{store.root}/_recovery/{_batch(run_at, system, system)}"
    changes.write.mode("overwrite").parquet(folder)
    changes = store.spark.read.schema(changes.schema).parquet(folder)
    done = changes.where("counted").count()
    updated = merge.upsert(
        queue, changes.drop("counted"), ["queue_id"], run_at, created=None, updated=None
    )
    store.replace(QUEUE, updated)
    store.drop_folder(folder)
    return f"RECOVERY DONE: {done}"


def _recover_dataset(store: TableStore, row, items: DataFrame, run_at: datetime) -> DataFrame:
    base = F.lit(row.base_path.rstrip("/") + "/")
    # a queue item without a known folder holds the whole path
    joined = F.when(F.col("pattern").startswith(base), F.col("pattern")).otherwise(
        F.concat(base, F.col("pattern"))
    )
    full = F.regexp_replace(joined, "/{2,}", "/")
    who = (row.system, row.dataset, row.target_table, run_at)
    batch = _batch(run_at, f"recovery_{row.system}_{row.dataset}", row.system, row.dataset)

    def failed(error: Exception) -> DataFrame:
        return items.select(
            "queue_id",
            F.lit("ERROR").alias("status"),
            F.lit(str(error)).alias("note"),
            F.lit(False).alias("counted"),
        )

    try:
        table, fmt = _plain_table(store, row.target_table), formats.named(row.file_format)
        place = csv_files.resolve(row.base_path, store.stages)
        listed = csv_files.list_files(store.spark, place).withColumn(
            "full", _below(row.base_path, place.folder)
        )
        wanted = items.withColumn("full", full).join(listed, "full", "left")
        history = history_without(store, batch)
        fresh = quality.pending_files(wanted.where("not force and file is not null"), history, table)
        chosen = wanted.where("force and file is not null").unionByName(fresh, True)
        paths = csv_files.file_paths(chosen.select("path").distinct())
        if paths:
            # every file stands alone here, so a bad one never stops the others
            outcomes, _, _ = _load_paths(
                store, table, paths, place.root, fmt, "SKIP_FILE", run_at, batch
            )
        else:
            outcomes = store.read("LOAD_HISTORY", [])
    except Exception as error:  # noqa: BLE001 - becomes the note of the queue items
        return failed(error)

    nothing = F.lit(NO_FILES)
    results = (
        wanted.select("queue_id", "full", "file")
        .join(outcomes.drop("target_table", "file_size", "file_modified_at"), "file", "left")
        .withColumn("status", F.coalesce("status", nothing))
        .withColumn("errors_seen", F.coalesce("errors_seen", F.lit(0)))
    )
    flag = runlog.recovery_flag(F.col("status"), F.col("errors_seen"))
    aborted = (F.lit(row.on_error == "ABORT_STATEMENT")) & (F.col("errors_seen") > 0)
    log = _log_rows(
        results.where(~aborted),
        *who,
        file_path=F.col("full"),
        file_name=base_name(F.col("full")),
        status=F.col("status"),
        errors_seen=F.col("errors_seen"),
        first_error_message=F.col("first_error"),
        error_flag=flag,
    )
    store.append(RUN_LOG, log, batch)
    per_item = results.withColumns({"error_flag": flag, "seq": F.col("full"), "_aborted": aborted})
    settled = runlog.queue_outcomes(per_item)
    counted = per_item.groupBy("queue_id").agg((~F.bool_or("_aborted")).alias("counted"))
    return settled.join(counted, "queue_id").select("queue_id", "status", "note", "counted")


# --- messages --------------------------------------------------------------------------------

# Labels of the two messages, in order.
WARNING_HEAD = ["[TASK_WARNING]", "RESULT=SUCCESS_WITH_SKIPPED_FILES"]
WARNING_LABELS = ["TASK", "TARGET", "STAGE", "FILE_FORMAT", "PATTERN", "ON_ERROR", "COPY_QUERY_ID", "COPY_STATUS"]
FAILURE_HEAD = ["[TASK_FAILED]"]
FAILURE_LABELS = [
    "TASK",
    "LOAD_TYPE",
    "TARGET",
    "STAGE",
    "FILE_FORMAT",
    "PATTERN",
    "ON_ERROR",
    "COPY_QUERY_ID",
    "COPY_STATUS",
    "SQLCODE",
    "SQLSTATE",
    "SQLERRM",
]


def _labelled(labels, values: dict) -> list[str]:
    missing = {"TASK": "UNKNOWN"}
    return [
        f"{label}={values[label] if values.get(label) is not None else missing.get(label, 'NULL')}"
        for label in labels
    ]


def load_digest(outcomes: DataFrame, max_files: int | None = None, **values) -> DataFrame:
    """Warning text about the bad files of a load, and the same as a JSON body."""
    lead = "\n".join(["```", *WARNING_HEAD, *_labelled(WARNING_LABELS, values)])
    message = F.concat_ws(
        "\n",
        F.lit(lead),
        F.concat(F.lit("ERROR_FILE_COUNT="), F.col("error_file_count").cast("string")),
        F.concat(F.lit("ERROR_ROW_COUNT="), F.col("error_row_count").cast("string")),
        F.lit("ERROR_SAMPLE="),
        F.coalesce("error_sample", F.lit("(none)")),
        F.lit("```"),
    )
    return (
        runlog.error_digest(outcomes, max_files=max_files)
        .withColumn("message", message)
        .withColumn("body", F.to_json(F.struct(F.col("message").alias("text"))))
    )


def failure_text(error: Exception, **values) -> str:
    """Failure text for a load that raised."""
    values = {
        "SQLERRM": str(error),
        "SQLCODE": getattr(error, "code", None),
        "SQLSTATE": getattr(error, "kind", None),
        **values,
    }
    return "\n".join(["```", *FAILURE_HEAD, *_labelled(FAILURE_LABELS, values), "```"])
