"""Records over several lines, put together from file splits, against Spark's whole-file reader."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from millrace.sources import csv_files, formats, records, schemas
from millrace.sources.csv_files import Location
from millrace.sources.formats import CsvFormat

FMT = CsvFormat(quote='"', null_if=(), encoding="UTF-8")
TEXTS = [(f"c{i}", schemas.TEXT) for i in range(3)]


def whole_file(spark, path, fmt, count):
    """(file, fields) of all records in order, as one task a file reads them."""
    names = [f"_c{i}" for i in range(count)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_bad"]])
    rows = spark.read.schema(schema).options(**csv_files._options(fmt), multiLine="true", encoding="UTF-8").csv(str(path))
    return [tuple(r[n] for n in names) for r in rows.coalesce(1).collect()]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def random_text(r, trim):
    """Lines of good and odd fields; every quote that opens a field is closed somewhere."""
    pieces = ["a", "b c", "é", "", "5\" pipe", "x\"y\"", "12"]
    inner = ["a", "\n", "\n\n", "\"\"", ",", "line, two", "é", " ", "\"\"\"\"", "\n\"\"\n"]

    def field():
        if r.random() < 0.4:
            text = '"' + "".join(r.choices(inner, k=r.randint(0, 6))) + '"'
            return (r.choice(["", " "]) if trim else "") + text + r.choice(["", "", "", "tail", 'x"y'])
        return r.choice(pieces)

    # the first field is never blank: Spark's whole-file reader skips blank lines
    return "".join("k" + field().lstrip('" ').replace('"', "").replace("\n", "") + "," + field() + "," + field() + "\n" for _ in range(r.randint(1, 60)))


@pytest.mark.parametrize("trim", [False, True])
def test_records_equal_the_whole_file_reader(spark, tmp_path, small_splits, trim):
    r = random.Random(11 + trim)
    fmt = FMT.with_options(trim=trim, multi_line=True)
    for n in range(6):
        (tmp_path / f"f{n}.csv").write_bytes(random_text(r, trim).encode())
    scanned = csv_files.line_source(spark.read, [str(tmp_path)], str(tmp_path), fmt)
    assert scanned.rdd.getNumPartitions() > 6
    rows, _ = csv_files.stage_scan(spark, [str(tmp_path)], str(tmp_path), fmt, TEXTS)
    got = rows.orderBy("file", "line").collect()
    for n in range(6):
        mine = [tuple(x[c] for c, _ in TEXTS) for x in got if x.file == f"f{n}.csv"]
        assert mine == whole_file(spark, tmp_path / f"f{n}.csv", fmt, 3)
        lines = [x.line for x in got if x.file == f"f{n}.csv"]
        assert lines == list(range(1, len(lines) + 1))


def test_a_large_record_file_is_read_in_splits(spark, tmp_path):
    """Each split is a task of its own, records cross many splits, and all forms of state changes occur."""
    r = random.Random(3)
    want = []
    with open(tmp_path / "big.csv", "w", newline="") as out:
        out.write("n,text\n")
        for n in range(3000):
            text = "".join(r.choices(["word ", 'q""', "\n", "\n\n", ", "], k=r.choice([0, 2, 5, 400 if n % 500 == 7 else 3])))
            out.write(f'{n},"{text}"\n')
            want.append((n, text.replace('""', '"') or None))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        fmt = CsvFormat(quote='"', skip_header=1, null_if=())
        columns = [("n", schemas.num(18)), ("text", schemas.TEXT)]
        scanned = csv_files.line_source(spark.read, [str(tmp_path)], str(tmp_path), fmt)
        assert scanned.rdd.getNumPartitions() > 40
        rows = csv_files.read_csv_typed(spark, Location(str(tmp_path)), fmt, columns)
        got = sorted((int(x.n), x.text or None, x.row_number) for x in rows.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [(n, text, n + 1) for n, text in want]


def test_line_ends_quote_marks_and_blank_lines(spark, tmp_path):
    columns = [("a", schemas.TEXT), ("b", schemas.num(3))]
    (tmp_path / "crlf.csv").write_bytes(b'a,b\r\n"one\r\ntwo",1\r\n\r\nthree,x\r\n')
    (tmp_path / "mark.csv").write_bytes("﻿\"a\nb\",b\n\"x\n\ny\",2\n".encode())
    fmt = CsvFormat(quote='"', skip_header=1)
    rows = csv_files.read_csv_typed(spark, Location(str(tmp_path)), fmt, columns).orderBy("file", "line").collect()
    found = [(x.file, x.row_number, x.a, x.b, x._error and x._error.message) for x in rows]
    assert found == [
        ("crlf.csv", 1, "one\ntwo", Decimal(1), None), ("crlf.csv", 2, None, None, "line does not have 2 columns"),
        ("crlf.csv", 3, "three", None, "'x' is not a valid decimal(3,0)"), ("mark.csv", 1, "x\n\ny", Decimal(2), None),
    ]


def test_a_quote_that_is_never_closed_is_one_bad_record(spark, tmp_path, small_splits):
    text = 'h,h\n1,good\n2,"open\n' + "".join(f"{i},more text here\n" for i in range(3, 400))
    (tmp_path / "a.csv").write_text(text)
    (tmp_path / "b.csv").write_text('h,h\n1,"two\nlines"\n')
    fmt = CsvFormat(quote='"', skip_header=1, most_record_bytes=1000)
    rows = csv_files.read_csv_typed(spark, Location(str(tmp_path)), fmt, [("n", schemas.num(9)), ("t", schemas.TEXT)])
    got = {(x.file, x.row_number): x for x in rows.collect()}
    assert sorted(got) == [("a.csv", 1), ("a.csv", 2), ("b.csv", 1)]
    assert got["a.csv", 1]._error is None and got["b.csv", 1].t == "two\nlines"
    assert got["a.csv", 2]._error.message == "record of more than 1000 bytes" and got["a.csv", 2]._rejected == '2,"open'


def test_states_of_splits(spark):
    """All four functions of a split on its starting state, in all orders of three."""
    kinds = {"keep": (False, True), "turn": (True, False), "shut": (False, False), "open": (True, True)}
    rows, want = [], {}
    names = [(a, b, c) for a in kinds for b in kinds for c in kinds]
    for n, order in enumerate(names):
        state = begun = 0
        for k, kind in enumerate(order):
            want[f"f{n}", k * 10] = (bool(state), begun)
            begun += (2 * k + 1) if state else (k + 2)
            rows.append((f"f{n}", k * 10, 0, *kinds[kind], k + 2, 2 * k + 1))
            state = kinds[kind][state]
    marked = spark.createDataFrame(rows, "file string, block_start long, seq long, next_o boolean, next_q boolean, nth_o long, nth_q long")
    got = {(x.file, x.block_start): (x._starts_open, x._begun) for x in records.split_states(marked).collect()}
    assert got == want
