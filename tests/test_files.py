"""File reading: encoding, quoting, null spellings, numbering, errors."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions.parse import AUTO, parse_time_text, parse_timestamp
from millrace.sources import csv_files, formats, schemas
from millrace.sources.csv_files import Location
from millrace.sources.formats import CsvFormat

COMMON = formats.named("DB.RAW.FF_CSV_COMMON")
STOP = schemas.columns("STOP_LOG")
HEADER = "時刻,Nコード,ラインNo.,状態,要因No.\r\n"


def write(folder, name, text, encoding="cp932"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))


def read(spark, folder, fmt=COMMON, columns=STOP, **kw):
    return csv_files.read_csv_typed(spark, Location(str(folder)), fmt, columns, **kw)


def test_types_nulls_and_trim(spark, tmp_path):
    write(tmp_path, "a b[1].csv", HEADER + '2024/01/02 03:04:05, ﾊﾝｶｸ表 ,"L,1",1,12\r\nNULL,,NULL, 2 ,\r\n')
    rows = read(spark, tmp_path).orderBy("row_number").collect()
    assert [r.file for r in rows] == ["a b[1].csv"] * 2
    assert [(r.line, r.row_number) for r in rows] == [(2, 1), (3, 2)]
    first = [rows[0][name] for name, _ in STOP]
    assert first == [dt.datetime(2024, 1, 2, 3, 4, 5), "ﾊﾝｶｸ表", "L,1", Decimal(1), Decimal(12)]
    assert [rows[1][name] for name, _ in STOP] == [None, None, None, Decimal(2), None]
    assert rows[0]._error is None and rows[1]._error is None


def test_row_errors(spark, tmp_path):
    lines = [
        "2024/01/02 03:04:05,N,L,1,12",
        "2024-01-02 03:04:05,N,L,1,12",
        "2024/01/02 03:04:05,N,L,1",
        "2024/01/02 03:04:05,N,L,1,12,9",
        "",
        "2024/01/02 03:04:05,N,L,x,12",
        "2024/01/02 03:04:05,N,L,10,12",
        "2024/01/02 03:04:05,N,L,1,1000",
        '2024/01/02 03:04:05,"N",L,x,12',
    ]
    write(tmp_path, "a.csv", (HEADER + "\r\n".join(lines) + "\r\n").encode("cp932") + b"2024/01/02 03:04:05,\x82,L,1,12\r\n")
    rows, _ = csv_files.stage_rows(
        csv_files.scan_rows(spark, [str(tmp_path)], str(tmp_path), COMMON, STOP), COMMON
    )
    got = {r.line: r for r in csv_files.validation_errors(rows).collect()}
    assert sorted(got) == [3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert got[3].column_name == "時刻" and got[3].character == 1
    assert "5 columns" in got[4].error and "5 columns" in got[5].error and "5 columns" in got[6].error
    assert got[7].column_name == STOP[3][0] and got[7].character == 25
    assert "decimal(1,0)" in got[8].error and got[9].column_name == "要因No."
    assert got[10].character is None  # quoted line
    assert "encoding" in got[11].error
    assert got[7].rejected_record == "2024/01/02 03:04:05,N,L,x,12"


def test_padding_format_accepts_any_width(spark, tmp_path):
    fmt = formats.named("FF_CSV_PROD_LOG_FH")
    columns = [(k, schemas.TEXT) for k in schemas.WIDE_KEYS]
    write(tmp_path, "a.csv", "h\n" + "a,b\n" + ",".join(str(i) for i in range(70)) + "\n\n")
    rows = read(spark, tmp_path, fmt, columns).orderBy("line").collect()
    assert [r._error for r in rows] == [None] * 3
    assert (rows[0]["時刻"], rows[0]["Nコード"], rows[0]["ラインNo."]) == ("a", "b", None)
    assert rows[1]["T不良_46"] == "59"
    assert rows[2]["時刻"] is None


def test_numbers_survive_splits(spark, tmp_path):
    """A file cut into many tasks keeps its line numbers."""
    columns = [("n", schemas.num(18)), ("pad", schemas.TEXT)]
    fmt = CsvFormat(skip_header=1)
    for name, count in (("big.csv", 5000), ("small.csv", 3)):
        text = "n,pad\n" + "".join(f"{i},{'x' * (i % 37)}\n" for i in range(1, count + 1))
        write(tmp_path, name, text)
    write(tmp_path, "empty.csv", "")
    write(tmp_path, "header.csv", "n,pad\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        scanned = csv_files.scan_rows(spark, [str(tmp_path)], str(tmp_path), fmt, columns)
        assert scanned.rdd.getNumPartitions() > 10
        rows, _ = csv_files.stage_rows(scanned, fmt)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    data = csv_files.data_rows(rows)
    assert data.count() == 5003
    assert data.where(F.col("row_number") != F.col("n")).count() == 0
    assert rows.select("file").distinct().count() == 3  # the header-only file is seen


def test_text_formats(spark, tmp_path):
    columns = [("a", schemas.TEXT), ("b", schemas.TEXT), ("c", schemas.DAY)]
    write(tmp_path / "stage", "a.csv", "\ufeff x ,\\N,2024-02-29\n\"q\",,2024-02-30\n", "utf-8")
    rows = read(spark, tmp_path / "stage", formats.STAGE_DEFAULT, columns).orderBy("line").collect()
    assert (rows[0].a, rows[0].b, rows[0].c) == (" x ", None, dt.date(2024, 2, 29))
    assert (rows[1].a, rows[1].b) == ('"q"', None) and rows[1]._error.column_name == "c"
    write(tmp_path / "esc", "a.csv", "one\\,two,x,2024-01-01\none,two\n", "utf-8")
    rows = read(spark, tmp_path / "esc", formats.STAGE_DEFAULT, columns).orderBy("line").collect()
    assert (rows[0].a, rows[0].b, rows[0]._error) == ("one,two", "x", None)
    assert "3 columns" in rows[1]._error.message
    write(tmp_path / "my", "a.csv", 'h,h,h\n"say ""hi""",,\n"",\\N,\n', "utf-8")
    rows = read(spark, tmp_path / "my", formats.named("MYFORMAT"), columns).orderBy("line").collect()
    assert [(r.a, r.b) for r in rows] == [('say "hi"', None), ("", None)]
    kept = CsvFormat(skip_header=1, quote='"', empty_as_null=False)
    rows = read(spark, tmp_path / "my", kept, columns[:2] + [("c", schemas.TEXT)]).orderBy("line").collect()
    assert [(r.a, r.b) for r in rows] == [('say "hi"', ""), ("", None)]


def test_line_breaks_inside_quotes(spark, tmp_path):
    columns = [("a", schemas.TEXT), ("b", schemas.num(3))]
    write(tmp_path, "a.csv", 'a,b\n"one\ntwo",1\nthree,x\n')
    fmt = COMMON.with_options(multi_line=True)
    rows = read(spark, tmp_path, fmt, columns).orderBy("row_number").collect()
    assert [(r.a, r.b) for r in rows] == [("one\ntwo", Decimal(1)), ("three", None)]
    assert rows[1]._error.column_name == "b"


def test_listing_and_pattern(spark, tmp_path):
    for name in ("IoT/Prod_log/a.csv", "IoT/Prod_log/x/b.csv", "IoT/Prod_log/b.txt", "IoT/Other/c.csv"):
        write(tmp_path, name, "h\n1\n")
    place = csv_files.resolve("@DB.RAW.ST/IoT/", {"ST": str(tmp_path)})
    files = csv_files.list_files(spark, place, r".*Prod_log/.*\.csv")
    assert sorted(r.file for r in files.collect()) == ["IoT/Prod_log/a.csv", "IoT/Prod_log/x/b.csv"]
    with pytest.raises(KeyError):
        csv_files.resolve("@NOPE/x", {})
    with pytest.raises(KeyError):
        formats.named("NOPE")


def test_time_of_day_and_reel_schema(spark, tmp_path):
    columns = schemas.columns("REEL_LOG")
    good = "2024/01/02 03:04:05,N,T,S,L,P,10,08:00:00,23:59:59" + ",1" * 15
    bad = good.replace("23:59:59", "24:00:00")
    write(tmp_path, "a.csv", "h\n" + good + "\n" + bad + "\n")
    rows = read(spark, tmp_path, COMMON, columns).orderBy("line").collect()
    assert rows[0]["梱包終了時間"] == "23:59:59" and rows[0]._error is None
    assert rows[1]._error.column_name == "梱包終了時間"


def test_line_breaks_inside_quotes_of_named_formats(spark, tmp_path):
    """Only the file that has them is read record by record; bad values and bytes are still seen."""
    head = "h1,h2,h3,h4,h5\n"
    (tmp_path / "a.csv").write_bytes((head + '2024/01/02 03:04:05,"N\n1",L,1,1\n2024/01/02 03:04:05,N2,"L\n""2",1,x\n').encode("cp932"))
    (tmp_path / "b.csv").write_bytes((head + '2024/01/02 03:04:05,"N3",L,1,3\n').encode("cp932"))
    (tmp_path / "c.csv").write_bytes(head.encode() + b'2024/01/02 03:04:05,"N\n\xfd",L,1,4\n')
    rows, _ = csv_files.stage_scan(spark, [str(tmp_path)], str(tmp_path), COMMON, STOP)
    got = {(r.file, r.row_number): r for r in csv_files.data_rows(rows).collect()}
    assert sorted(got) == [("a.csv", 1), ("a.csv", 2), ("b.csv", 1), ("c.csv", 1)]
    assert got["a.csv", 1]["Nコード"] == "N\n1" and got["a.csv", 1]._error is None
    assert "'x' is not a valid" in got["a.csv", 2]._error.message
    assert got["b.csv", 1]["Nコード"] == "N3"
    assert "bytes outside encoding" in got["c.csv", 1]._error.message


def test_recognised_dates_and_times(spark):
    stamps = {
        "2024-01-02": "2024-01-02 00:00:00",
        "2024-1-2 03:04:05.678": "2024-01-02 03:04:05.678",
        "2024-01-02T03:04:05+09:00": "2024-01-02 03:04:05",
        " 31-jan-2024 ": "2024-01-31 00:00:00",
        "31-Jan-2024 10:20:30": "2024-01-31 10:20:30",
        "01/31/2024": "2024-01-31 00:00:00",
        "01/31/2024 10:20:30": "2024-01-31 10:20:30",
        "1700000000": "2023-11-14 22:13:20",
        "1700000000123": "2023-11-14 22:13:20.123",
        "2024/01/02": None,
        "31-Xyz-2024": None,
        "2024-13-01": None,
        "text": None,
    }
    times = {"3:04": "03:04:00", "03:04:05.9": "03:04:05", "12:30 am": "00:30:00", "1:02:03 PM": "13:02:03", "13:00 PM": None, "24:00": None}
    df = spark.createDataFrame([(k,) for k in stamps], "t string").select("t", parse_timestamp(F.col("t"), AUTO).cast("string"))
    assert {r[0]: r[1] for r in df.collect()} == stamps
    df = spark.createDataFrame([(k,) for k in times], "t string").select("t", parse_time_text(F.col("t"), auto=True))
    assert {r[0]: r[1] for r in df.collect()} == times
