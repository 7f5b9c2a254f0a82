"""Files cut into many small splits, rows of many columns, and what tables leave on disk."""

import glob
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from millrace import session
from millrace.operators import semistruct
from millrace.sources import csv_files, formats, schemas
from millrace.sources.csv_files import Location

FMT = formats.CsvFormat(skip_header=1, quote='"', trim=True)
COLUMNS = [("a", schemas.num(18)), ("b", schemas.TEXT)]


def test_small_splits_share_tasks(spark, tmp_path):
    """Far more splits than tasks: lines keep their numbers, and records over lines stay whole."""
    lines = ["a,b", *[f'{i},"x{i}\ny{i}"' if i % 7 == 0 else f"{i},x{i}" for i in range(4000)]]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f.csv").write_text("\n".join(lines) + "\n")
    place = Location(str(tmp_path / "in"))
    with session.conf_set(session.configure(spark), spark__sql__files__maxPartitionBytes="200", spark__sql__files__openCostInBytes="0"):
        assert csv_files.line_source(spark.read, [place.path], place.root, FMT).rdd.getNumPartitions() > 200
        scanned = csv_files.scan_rows(spark, [place.path], place.root, FMT, COLUMNS)
        assert scanned.rdd.getNumPartitions() == csv_files.LEAST_TASKS
        with session.usual_splits(spark):
            assert session.split_bytes(spark) == session.LEAST_READ
        assert session.split_bytes(spark) == 200
        got = csv_files.read_csv_typed(spark, place, FMT, COLUMNS).select("a", "b", "row_number").collect()
    assert {(int(r.a), r.b, r.row_number) for r in got} == {(i, f"x{i}\ny{i}" if i % 7 == 0 else f"x{i}", i + 1) for i in range(4000)}
    assert len(got) == 4000


def test_usual_splits_leave_larger_ones(spark):
    for text, size in (("128MB", 128 << 20), ("134217728b", 128 << 20), ("16m", 16 << 20), ("9000000", 9_000_000)):
        with session.conf_set(spark, spark__sql__files__maxPartitionBytes=text):
            assert session.split_bytes(spark) == size
            with session.usual_splits(spark):
                assert session.split_bytes(spark) == size


def test_wide_rows_run_in_compiled_methods(spark):
    """A method beyond this size is run by the JVM's interpreter for good."""
    assert int(session.configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_unpivot_calls_no_function_on_the_map(spark):
    df = spark.range(2).select("id", semistruct.build_map({"known": F.lit("1"), "x": F.lit("2"), "y": F.lit(None)}).alias("m"))
    got = semistruct.unpivot_numeric(df, F.col("m"), ["id"], ["known"])
    assert sorted((r.id, r.defect_name, int(r.defect_value)) for r in got.collect()) == [(0, "x", 2), (1, "x", 2)]
    assert "map_filter" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_unpivot_parses_no_text_without_digits(spark):
    """Finding out that a text is no number costs an exception; digits of any script make one."""
    texts = ["1", " -2.5 ", "+3", "1e2", "１２", "abc", "", "NaN", "x1", "-", None]
    df = spark.range(1).select("id", F.create_map(*[F.lit(x) for i, t in enumerate(texts) for x in (f"k{i}", t)]).alias("m"))
    got = semistruct.unpivot_numeric(df, F.col("m"), ["id"])
    plain = {t: spark.range(1).select(F.lit(t).try_cast("decimal(38,0)")).first()[0] for t in texts}
    assert {r.defect_value_raw: r.defect_value for r in got.collect()} == {t: v for t, v in plain.items() if v is not None}
    assert "RLIKE" in got._jdf.queryExecution().optimizedPlan().toString()


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before = files()
    out = session.written(spark.range(1000).repartition(4, "id").withColumn("hex", F.sha2(F.col("id").cast("string"), 256)), str(tmp_path / "t"))
    for _ in range(50):  # they are removed beside the next job
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and out.count() == 1000
    part = pq.ParquetFile(glob.glob(f"{tmp_path}/t/part-*.parquet")[0])
    assert part.metadata.row_group(0).column(1).compression == "ZSTD"
