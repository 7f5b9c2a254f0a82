"""Dataset configuration: which folders load into which tables, and how."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# What an unset format or error policy means.
DEFAULT_FORMAT = "FF_CSV_COMMON"
DEFAULT_ON_ERROR = "SKIP_FILE"


def location_root(stage: Column) -> Column:
    return F.when(stage.startswith("@"), stage).otherwise(F.concat(F.lit("@"), stage))


def dataset_path(stage: Column, subpath: Column) -> Column:
    """Stage and folder joined, with the leading ``@`` and the slash added where absent."""
    folder = F.coalesce(subpath, F.lit(""))
    slashed = F.when((folder == "") | folder.startswith("/"), folder).otherwise(
        F.concat(F.lit("/"), folder)
    )
    return F.concat(location_root(stage), slashed)


def recovery_path(stage: Column, subpath: Column, pattern: Column) -> Column:
    """Location of one queued file; doubled slashes from the parts are joined into one."""
    joined = F.concat(dataset_path(stage, subpath), F.lit("/"), pattern)
    return F.regexp_replace(joined, "/{2,}", "/")


def active_datasets(config: DataFrame, system: str | None = None) -> DataFrame:
    """Active rows, all systems or one, with defaults filled in and the path composed."""
    rows = config.where(F.col("is_active"))
    if system is not None:
        rows = rows.where(F.col("system") == system)
    return rows.select(
        "system",
        "dataset",
        "stage",
        "subpath",
        "target_table",
        F.coalesce("file_format", F.lit(DEFAULT_FORMAT)).alias("file_format"),
        F.coalesce("on_error", F.lit(DEFAULT_ON_ERROR)).alias("on_error"),
        dataset_path(F.col("stage"), F.col("subpath")).alias("base_path"),
    )
