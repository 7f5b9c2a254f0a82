"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session

# Words are runs of bytes other than these blanks: space, tab, line feed, vertical tab,
# form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


_scopes: list[list[str]] = []


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: survives lost executors."""
    path = session.scratch_path(df.sparkSession, label)
    out = session.written(df, path)
    out.scratch = path
    for scope in _scopes[-1:]:
        scope.append(path)
        relieve(df.sparkSession)
    return out


HEAP_SHARE = 0.5  # of the driver's heap that may be taken before its garbage is collected


def relieve(spark: SparkSession) -> None:
    """Let a driver that has taken much of its heap collect its garbage and give memory back.

    A job of many small queries leaves plans, metrics and broadcasts behind, and the heap grows
    to its limit before the JVM gives any of it back. Collected plans also free their shuffle files.
    """
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() > HEAP_SHARE * runtime.maxMemory():
        gc.collect()  # frames that only Python still holds keep their plans alive
        runtime.gc()


def dropped(*frames: DataFrame) -> None:
    """Delete tables made by ``saved`` that nothing reads any more."""
    for df in frames:
        remove(df.sparkSession, df.scratch)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = session.file_system(spark, path)
    fs.delete(p, True)


@contextmanager
def scratch_scope():
    """The paths of all tables saved inside, for deleting them once the result is written."""
    _scopes.append([])
    try:
        yield _scopes[-1]
    finally:
        _scopes.pop()


def tables_read(df: DataFrame, paths: list[str]) -> list[str]:
    """Those of the given folders that ``df`` still reads."""
    leaves, roots = df._jdf.queryExecution().analyzed().collectLeaves(), []
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            found = leaf.relation().location().rootPaths()
            roots += [found.apply(j).getName() for j in range(found.size())]
    return [path for path in paths if path.rsplit("/", 1)[1] in roots]


def pruned_joins(spark: SparkSession):
    """Let Spark drop rows by a Bloom filter of the other side before it shuffles them.

    The filter has at most 8 MB (Spark's own bound); beyond that it drops fewer rows. The
    small side must be a written table with a filter on it. It changes no result.
    """
    prefix = "spark__sql__optimizer__runtime__bloomFilter__"
    return session.conf_set(spark, **{f"{prefix}applicationSideScanSizeThreshold": "0", f"{prefix}creationSideThreshold": "1g"})


def release() -> None:
    """Give memory that a Python worker no longer uses back to the system: idle workers stay for other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def trimmed(function):
    """A function of batches that releases memory when its task is done."""

    @wraps(function)
    def run(batches):
        yield from function(batches)
        release()

    return run


def trimmed_group(function):
    """A function of one group's table that releases memory when it is done."""

    def run(table):
        out = function(table)
        release()
        return out

    return run


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scalar(df: DataFrame):
    """The single value of a one-row, one-column aggregate."""
    return df.first()[0]


def finite_vector(vector: Column) -> Column:
    """True for a vector that holds only finite numbers."""
    return vector.isNotNull() & F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Join condition: all ``names`` equal, NULL equal to NULL."""
    cond = F.lit(True)
    for name in names:
        cond = cond & left[name].eqNullSafe(right[name])
    return cond
