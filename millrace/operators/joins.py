"""Joins that stay balanced when one key holds a large share of the rows.

No side is ever hinted for broadcast: Catalyst's size threshold and AQE's measured sizes
decide that. AQE splits a skewed partition of an inner join on either side, and of a left
join on the left side only. The right side of a left join is what ``salted_left_join``
covers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import qcol

# Right rows one task should meet per key before the key is spread over more tasks.
ROWS_PER_SALT = 200_000
NULL_BUCKETS = 1024


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def hashable(df: DataFrame) -> list[str]:
    """Columns whose values Spark can hash (objects and maps cannot be)."""
    return [f.name for f in df.schema.fields if f.dataType.typeName() not in ("variant", "map")]


def null_salt(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for rows whose keys are all set; otherwise a bucket drawn from the row's content.

    Rows with a NULL key match nothing, yet a shuffle on the key alone would send every
    one of them to a single task. Used as an extra join key on both sides.
    """
    some_null = any_of([qcol(k).isNull() for k in keys])
    bucket = F.pmod(F.xxhash64(*[qcol(c) for c in hashable(df)]), F.lit(NULL_BUCKETS))
    return F.when(some_null, bucket + 1).otherwise(F.lit(0)).cast("int")


def spread_null_key(key: Column, by: Sequence[Column]) -> Column:
    """A text join key whose NULLs become many values that match nothing."""
    bucket = F.pmod(F.xxhash64(*by), F.lit(NULL_BUCKETS)).cast("string")
    return F.coalesce(key, F.concat(F.lit("\u0001null:"), bucket))


def has_hot_keys(df: DataFrame, keys: Sequence[str], limit: int = ROWS_PER_SALT) -> bool:
    """Whether any key holds more than ``limit`` rows; counted at once, partial counts first."""
    counts = df.groupBy(*[qcol(k) for k in keys]).agg(F.count(F.lit(1)).alias("_rows"))
    return not counts.where(F.col("_rows") > limit).isEmpty()


def fanout_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_salt: int = ROWS_PER_SALT, hot: bool | None = None
) -> DataFrame:
    """Left join on equal key names where one key may match any number of right rows.

    Without a key of more than ``rows_per_salt`` rows on the right this is a plain left join,
    whose left side AQE can split; else it is salted. ``hot`` says whether there is such a key;
    when it is not known, the right side's keys are counted at once.
    """
    if hot is None:
        hot = has_hot_keys(right.where(all_of([qcol(k).isNotNull() for k in keys])), keys, rows_per_salt)
    if hot:
        return salted_left_join(left, right, keys, rows_per_salt)
    return lookup_left_join(left, right, keys)


def salted_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """Left join for right sides with keys of very many rows.

    Copies on the right are collapsed into one row and a count by partial aggregation, so
    a hot group of copies shrinks before it is shuffled. Keys holding more than
    ``rows_per_salt`` rows then get several salts: their left rows are repeated once per
    salt, their right rows are dealt over the salts by content, and a long run of copies
    is dealt in pieces. No task meets all matches of a hot key. A repeated left row whose
    salt drew nothing is dropped again; an unmatched left row stays once.
    """
    keys = list(keys)
    payload = [c for c in right.columns if c not in keys]
    limit = F.lit(rows_per_salt)
    distinct = (
        right.where(all_of([qcol(k).isNotNull() for k in keys]))
        .groupBy(*[qcol(c) for c in right.columns])
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    hot = (
        distinct.groupBy(*[qcol(k) for k in keys])
        .agg(F.sum("_n").alias("_rows"))
        .where(F.col("_rows") > limit)
        .select(*[qcol(k) for k in keys], F.ceil(F.col("_rows") / limit).cast("int").alias("_salts"))
    )
    pieces = (
        distinct.withColumn(
            "_piece", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_n") / limit).cast("int") - 1))
        )
        .withColumn("_take", F.least(limit, F.col("_n") - F.col("_piece") * limit).cast("int"))
        .join(hot, keys, "left")
        .withColumn(
            "_salt",
            F.pmod(
                F.xxhash64(*[qcol(c) for c in payload], F.col("_piece")),
                F.coalesce(F.col("_salts"), F.lit(1)),
            ).cast("int"),
        )
        .select(*[qcol(c) for c in right.columns], "_salt", "_take")
    )
    salted = left.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    joined = salted.join(pieces, [*keys, "_salt"], "left").where(
        F.col("_take").isNotNull() | F.col("_salts").isNull()
    )
    copies = F.explode(F.sequence(F.lit(1), F.coalesce(F.col("_take"), F.lit(1)))).alias("_copy")
    return joined.select("*", copies).select(
        *[qcol(c) for c in left.columns], *[qcol(c) for c in payload]
    )


def lookup_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], unique_right: bool = True
) -> DataFrame:
    """Left join; with ``unique_right`` the caller promises that no right key is hot."""
    if unique_right:
        return left.join(right, list(keys), "left").select(
            *[qcol(c) for c in left.columns], *[qcol(c) for c in right.columns if c not in keys]
        )
    return fanout_left_join(left, right, keys)
