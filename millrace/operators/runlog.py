"""Run log, error log, recovery queue and digests."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions import base_name, qcol, text_after
from millrace.operators.merge import latest_per_key

# Fixed lengths of the digest: error text per file, text of all files together.
ERROR_CHARS = 180
SAMPLE_CHARS = 2500
# Files named by the documented short form of the digest.
SHORT_FORM_FILES = 5
# A digest entry has at least 20 characters of its own and a newline, so no more entries
# than this can show within SAMPLE_CHARS.
MAX_VISIBLE = SAMPLE_CHARS // 21 + 1

LOADED = "LOADED"


def outcome_errors(status: Column, errors_seen: Column) -> Column:
    """Error count; when missing, 1 for a status other than LOADED, else 0."""
    odd = (F.coalesce(status, F.lit("")) != "") & (status != LOADED)
    return F.coalesce(errors_seen.cast("long"), F.when(odd, 1).otherwise(0).cast("long"))


def outcome_flag(status: Column, errors_seen: Column) -> Column:
    """Error flag of a regular load: an error was seen or a status other than LOADED."""
    odd = (F.coalesce(status, F.lit("")) != "") & (status != LOADED)
    return (outcome_errors(status, errors_seen) > 0) | F.coalesce(odd, F.lit(False))


def recovery_flag(status: Column, errors_seen: Column) -> Column:
    """Error flag of a recovery load, where a missing status is an error too."""
    return (F.coalesce(F.upper(status), F.lit("NULL")) != LOADED) | (
        F.coalesce(errors_seen, F.lit(0)) > 0
    )


def error_log(run_log: DataFrame) -> DataFrame:
    return run_log.where(F.col("error_flag"))


def recovery_pattern(path: Column, subpath: Column) -> Column:
    """Path below the dataset's folder with a leading slash, else the whole path."""
    return text_after(path, subpath)


def recovery_queue(
    errors: DataFrame,
    config: DataFrame,
    run_at: datetime,
    run_log: DataFrame | None = None,
    exclude_recovered: bool = False,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """One pending item per file that ever failed, newest error first.

    With ``exclude_recovered`` files that were loaded after their last error stay out;
    ``run_log`` is then needed.
    """
    known = errors.where(F.col("file_path").isNotNull())
    latest = latest_per_key(known, ["system", "dataset", "file_path"], "run_at", tie_break)
    if exclude_recovered:
        done = (
            run_log.where((F.col("status") == LOADED) & ~F.col("error_flag"))
            .groupBy("system", "dataset", "file_path")
            .agg(F.max("run_at").alias("_done_at"))
        )
        latest = (
            latest.join(done, ["system", "dataset", "file_path"], "left")
            .where(F.col("_done_at").isNull() | (F.col("_done_at") <= F.col("run_at")))
            .drop("_done_at")
        )
    return _pending_items(latest, config, run_at)


def _pending_items(files: DataFrame, config: DataFrame, run_at: datetime) -> DataFrame:
    """Pending queue items of failed files, one row each."""
    paths = config.groupBy("system", "dataset").agg(F.min("subpath").alias("_subpath"))
    now = F.lit(run_at).cast("timestamp_ntz")
    pattern = recovery_pattern(F.col("file_path"), F.col("_subpath"))
    return (
        files.join(paths, ["system", "dataset"], "left")
        .withColumn("pattern", pattern)
        .select(
            F.sha2(F.concat_ws("|", "system", "dataset", "pattern"), 256).alias("queue_id"),
            "system",
            "dataset",
            "pattern",
            F.lit(True).alias("force"),
            F.lit("PENDING").alias("status"),
            F.lit(None).cast("string").alias("note"),
            now.alias("created_at"),
            now.alias("enq_at"),
        )
    )


FILE_KEY = ["system", "dataset", "file_path"]


def recovery_state(run_log: DataFrame) -> DataFrame:
    """Per file, when it failed last and when it was loaded last, from any part of a run log.

    Both are maxima, so parts of a log can be taken in any order, and twice; partial
    aggregation leaves one row per file and task before anything is shuffled.
    """
    done = (F.col("status") == LOADED) & ~F.col("error_flag")
    return run_log.where(F.col("file_path").isNotNull()).groupBy(*FILE_KEY).agg(
        F.max(F.when(F.col("error_flag"), F.col("run_at"))).alias("failed_at"), F.max(F.when(done, F.col("run_at"))).alias("loaded_at")
    )


def merged_states(states: DataFrame) -> DataFrame:
    """One row per file from states of several parts of a log."""
    return states.groupBy(*FILE_KEY).agg(F.max("failed_at").alias("failed_at"), F.max("loaded_at").alias("loaded_at"))


def queue_of_state(state: DataFrame, config: DataFrame, run_at: datetime, exclude_recovered: bool = False) -> DataFrame:
    """``recovery_queue`` from the state of the whole log."""
    failed = state.where(F.col("failed_at").isNotNull())
    if exclude_recovered:
        failed = failed.where(F.col("loaded_at").isNull() | (F.col("loaded_at") <= F.col("failed_at")))
    return _pending_items(failed.select(*FILE_KEY), config, run_at)


def queue_outcomes(results: DataFrame, key: str = "queue_id", seq: str = "seq") -> DataFrame:
    """Final status and note per queue item from its per-file load results.

    Any error makes the item ERROR with the message of its last bad file.
    """
    bad = F.col("error_flag")
    note = F.max_by(
        F.when(bad, F.coalesce("first_error", F.lit("LOAD_FAILED"))), F.when(bad, qcol(seq))
    )
    return results.groupBy(key).agg(
        F.when(F.bool_or(bad), "ERROR").otherwise("DONE").alias("status"),
        F.coalesce(note, F.lit("OK")).alias("note"),
    )


def digest_entry() -> Column:
    """``name (line=…, char=…) : error`` for one bad file."""
    return F.concat(
        F.regexp_replace("file", "^.*/", ""),
        F.lit(" (line="),
        F.coalesce(F.col("first_error_line").cast("string"), F.lit("NULL")),
        F.lit(", char="),
        F.coalesce(F.col("first_error_character").cast("string"), F.lit("NULL")),
        F.lit(") : "),
        F.left("first_error", F.lit(ERROR_CHARS)),
    )


def error_digest(
    outcomes: DataFrame, groups: Sequence[str] = (), max_files: int | None = None
) -> DataFrame:
    """Bad-file count, error-row count and readable sample per group.

    By default every bad file is listed, in file order, and the line "(+ N more files...)"
    still counts those beyond the fifth; ``max_files=5`` lists only the first five. The sample
    is cut at a fixed length, so only the first ``MAX_VISIBLE`` entries of a group can
    show; the others are counted but never shipped to one task.
    """
    if not groups:
        one = error_digest(outcomes.withColumn("_all", F.lit(0)), ["_all"], max_files)
        return one.groupBy().agg(
            F.coalesce(F.max("error_file_count"), F.lit(0)).alias("error_file_count"),
            F.coalesce(F.max("error_row_count"), F.lit(0)).alias("error_row_count"),
            F.max("error_sample").alias("error_sample"),
        )
    groups = list(groups)
    errors = F.col("errors_seen") > 0
    counts = outcomes.groupBy(*groups).agg(
        F.sum(F.when(errors, 1).otherwise(0)).alias("error_file_count"),
        F.coalesce(F.sum("errors_seen"), F.lit(0)).cast("long").alias("error_row_count"),
        F.lit(None).cast("string").alias("_sample"),
    )
    shown = MAX_VISIBLE if max_files is None else min(max_files, MAX_VISIBLE)
    # entries without text are skipped by the text aggregate, so they take no place
    entries = outcomes.where(errors).select(*groups, "file", digest_entry().alias("_entry"))
    w = Window.partitionBy(*groups).orderBy("file", "_entry")
    top = (
        entries.where(F.col("_entry").isNotNull())
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= shown)
    )
    listed = F.array_sort(F.collect_list(F.struct("file", "_entry")))
    samples = top.groupBy(*groups).agg(
        F.lit(None).cast("long").alias("error_file_count"),
        F.lit(None).cast("long").alias("error_row_count"),
        F.array_join(F.transform(listed, lambda x: x["_entry"]), "\n").alias("_sample"),
    )
    merged = counts.unionByName(samples).groupBy(*groups).agg(
        F.max("error_file_count").alias("error_file_count"),
        F.max("error_row_count").alias("error_row_count"),
        F.coalesce(F.max("_sample"), F.lit("")).alias("_sample"),
    )
    more = F.greatest(F.col("error_file_count") - SHORT_FORM_FILES, F.lit(0))
    tail = F.concat(
        F.col("_sample"), F.char(F.lit(10)), F.lit("(+ "), more.cast("string"), F.lit(" more files...)")
    )
    sample = F.left(F.when(more > 0, tail).otherwise(F.col("_sample")), F.lit(SAMPLE_CHARS))
    return merged.select(
        *groups,
        "error_file_count",
        "error_row_count",
        F.when(F.col("error_file_count") > 0, sample).alias("error_sample"),
    )
