"""Per-file load outcomes and what to do about files with errors."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.runlog import LOADED

LOAD_FAILED = "LOAD_FAILED"
POLICIES = ("ABORT_STATEMENT", "SKIP_FILE")
# a file is the same file while its name, size and time stay the same
FILE_IDENTITY = ["file", "file_size", "file_modified_at"]


def file_outcomes(rows: DataFrame, target: str, run_at: datetime) -> DataFrame:
    """One row per file of numbered rows: counts, first error and resulting status.

    A file with any bad line loads nothing. All rows go through a hash aggregation of
    plain counts, which leaves one row per file and task however large the file; only bad
    rows are looked at again for the text of the first error.
    """
    is_row = F.col("row_number") > 0
    bad = is_row & F.col("_error").isNotNull()
    totals = rows.groupBy(*FILE_IDENTITY).agg(
        F.sum(is_row.cast("long")).alias("rows_parsed"),
        F.sum(bad.cast("long")).alias("errors_seen"),
        F.min(F.when(bad, F.col("line"))).alias("first_error_line"),
    )
    firsts = rows.where(bad).groupBy("file").agg(F.min_by("_error", "line").alias("_first"))
    good = F.col("errors_seen") == 0
    return totals.join(firsts, "file", "left").select(
        F.lit(target).alias("target_table"),
        *FILE_IDENTITY,
        F.when(good, LOADED).otherwise(LOAD_FAILED).alias("status"),
        "rows_parsed",
        F.when(good, F.col("rows_parsed")).otherwise(0).cast("long").alias("rows_loaded"),
        "errors_seen",
        F.col("_first.message").alias("first_error"),
        "first_error_line",
        F.col("_first.character").alias("first_error_character"),
        F.col("_first.column_name").alias("first_error_column_name"),
        F.lit(run_at).cast("timestamp_ntz").alias("loaded_at"),
    )


def rows_of_good_files(rows: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Rows of the files that loaded without error."""
    bad = outcomes.where(F.col("status") != LOADED).select("file")
    return rows.join(bad, "file", "left_anti")


def pending_files(files: DataFrame, history: DataFrame, target: str | Column) -> DataFrame:
    """Listed files not yet loaded into the target in their present form."""
    done = history.where(
        (F.col("target_table") == target) & (F.col("status") == LOADED)
    ).select(*FILE_IDENTITY)
    return files.join(done, FILE_IDENTITY, "left_anti")
