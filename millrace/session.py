"""Session settings and the shared scratch folder every job uses."""

from __future__ import annotations

import os
import queue
import re
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor, wait
from contextlib import contextmanager, nullcontext
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Runtime settings the operators rely on. Only joins whose skewed side Spark can split
# are left to AQE; the others salt explicitly (operators/joins.py).
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even when that costs one more shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a join by more keys than its sides are partitioned by shuffles them by all; see share_partitioning
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    "spark.sql.session.timeZone": "UTC",
    # the JVM never compiles a method of more than 8,000 bytes; rows of many columns run in pieces it does compile
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # texts go to Python workers in batches of bytes, not of rows
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

# Plans of wide tables have many columns, and noting the Python call site of each costs more
# than building them. Read once per process, so it is set with the session.
# Loads that run side by side share the cores fairly.
BUILD_CONF = {**RUNTIME_CONF, "spark.python.sql.dataFrameDebugging.enabled": "false", "spark.scheduler.mode": "FAIR"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists, and give its workers this package."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return ship(spark)


def share_partitioning(spark: SparkSession) -> SparkSession:
    """Let joins by several keys run inside a partitioning by some of them, until ``configure``.

    For plans that see to hot values of those keys themselves.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Add this package to the files that Spark hands to its Python workers, once per application.

    Workers then find it wherever the driver found it: no install and no PYTHONPATH needed.
    """
    sc = spark.sparkContext
    if getattr(sc, "_millrace_shipped", False):
        return spark
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="millrace-code-"), "millrace.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("millrace", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    sc._millrace_shipped = True
    return spark


def build(app: str = "millrace", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BUILD_CONF, **conf}.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


# options set by running blocks: key -> [value, blocks that hold it, value before]
_held: dict[str, list] = {}
_held_change = threading.Condition()
_mine = threading.local()


@contextmanager
def conf_set(spark: SparkSession, **values):
    """Set session options (dots written as ``__``) and restore them on exit.

    Threads share a session: a block that wants a value which others hold shares it, and the
    last one restores; one that wants another value waits for them.
    """
    keys = {k.replace("__", "."): v for k, v in values.items()}
    own = _mine.__dict__.setdefault("keys", {})

    def restore(key: str, value: str | None) -> None:
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)

    nested: dict[str, str | None] = {}
    taken = []
    with _held_change:
        for key in sorted(keys):
            value = keys[key]
            if own.get(key):  # a block inside a block of the same thread
                nested[key] = spark.conf.get(key, None)
                spark.conf.set(key, value)
                continue
            _held_change.wait_for(lambda key=key, value=value: key not in _held or _held[key][0] == value)
            if key not in _held:
                _held[key] = [value, 0, spark.conf.get(key, None)]
                spark.conf.set(key, value)
            _held[key][1] += 1
            own[key] = True
            taken.append(key)
    try:
        yield
    finally:
        with _held_change:
            for key, value in nested.items():
                restore(key, value)
            for key in taken:
                own[key] = False
                _held[key][1] -= 1
                if not _held[key][1]:
                    restore(key, _held.pop(key)[2])
            _held_change.notify_all()


LEAST_READ = 8 << 20  # bytes that a task should read at least
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def split_bytes(spark: SparkSession) -> int:
    """The most bytes of a file that one split takes."""
    number, unit = re.fullmatch(r"(\d+)([bkmgt]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    return int(number) * _UNITS[unit]


def usual_splits(spark: SparkSession):
    """While it holds, files are read in splits of ``LEAST_READ`` bytes at least.

    A caller may have its files cut finely; tables written on the way need no such pieces.
    """
    return nullcontext() if split_bytes(spark) >= LEAST_READ else conf_set(spark, spark__sql__files__maxPartitionBytes=str(LEAST_READ))


def side_by_side(spark: SparkSession, work: Sequence[Callable[[], T]], at_once: int) -> list[T]:
    """Run independent pieces of work that start Spark jobs, ``at_once`` at a time; their results in order.

    Each piece's jobs go to a pool of their own, which share the cores when the application
    runs under the FAIR scheduler, and else fill cores that the others leave idle. Local
    properties are those of the calling thread. The first exception, in order, is raised once
    all pieces have ended.
    """
    pools = queue.SimpleQueue()
    for k in range(at_once):
        pools.put(f"side-{k}")

    def run(piece: Callable[[], T]) -> T:
        pool = pools.get()
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        try:
            return piece()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
            pools.put(pool)

    if at_once < 2 or len(work) < 2:
        return [piece() for piece in work]
    with ThreadPoolExecutor(at_once) as pool:
        # wrapped here, in the calling thread: that is where the properties are copied from
        waiting = [pool.submit(inheritable_thread_target(spark)(run), piece) for piece in work]
        wait(waiting)
        return [done.result() for done in waiting]


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, as named in ``spark.checkpoint.dir``.

    A temporary folder is used only when nothing is configured and the master is local.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """Hadoop file system of a path, and the path as that file system takes it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


# zstd halves what texts such as hex ids take under snappy, at about the same time
TABLE_OPTIONS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def save(df: DataFrame, path: str, mode: str = "errorifexists", by: Sequence[str] = ()) -> None:
    """Write ``df`` as Parquet; the shuffle files of that write go as soon as it is complete.

    Nothing else reads them, and a driver with a large heap would keep them until it next collects
    its garbage, beside those of every write after it. A task keeps ``OPEN_FOLDERS`` folders open
    and sorts its rows by folder only beyond these.
    """
    options = {
        "spark__sql__classic__shuffleDependency__fileCleanup__enabled": "true",
        "spark__sql__maxConcurrentOutputFileWriters": OPEN_FOLDERS,
    }
    with conf_set(df.sparkSession, **options):
        writer = df.write.options(**TABLE_OPTIONS).mode(mode)
        (writer.partitionBy(*by) if by else writer).parquet(path)


# folders that a writing task keeps open; it sorts the rows of any others
OPEN_FOLDERS = "16"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written below the shared folder and read back.

    Cuts the lineage, and gives the planner the exact size of a small table: joins with it
    are planned as broadcast joins from the start, or as shuffled joins when it is large.
    """
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
