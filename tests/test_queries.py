"""Every registered query against its SQL on the smallest given tables."""

import glob
import gzip
import os
from collections import Counter

import pytest

import __spark_entry__ as entry
from millrace.checks import file_queries

SF_DIR = "/root/testdata/sf0.001"
# queries of optional parts are tested with those parts
CORE = {**entry.QUERIES, **entry.FILE_QUERIES}
QUERIES = {name: query for name, query in entry.queries().items() if name in CORE}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in CORE}


def cell(value):
    if value is None:
        return None
    return str(value.normalize() + 0) if hasattr(value, "normalize") else str(value)


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(SF_DIR + "/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = db.execute(SQL[name])
    order = [d[0] for d in got.description]
    assert sorted(order) == columns
    places = [order.index(c) for c in columns]
    theirs = Counter(tuple(cell(r[i]) for i in places) for r in got.fetchall())
    ours = Counter(tuple(cell(r[c]) for c in columns) for r in df.collect())
    assert ours == theirs
    assert ours


def test_wide_queries_keep_no_files_that_nothing_reads(spark, monkeypatch):
    made, scratch_path = [], file_queries.session.scratch_path
    monkeypatch.setattr(file_queries.session, "scratch_path", lambda *a: (made.append(scratch_path(*a)), made[-1])[1])
    for name in ("wide_refresh", "stream_refresh", "wide_spoilt"):
        made.clear()
        df = QUERIES[name](spark, SF_DIR)
        left = {os.path.basename(p).split("-")[0] for p in made if file_queries.session.path_exists(spark, p)}
        assert "files" not in left, name
        assert name != "wide_spoilt" or "tables" not in left
        assert df.count()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_odd_lines_of_many_files(spark, monkeypatch):
    monkeypatch.setattr(file_queries, "FILE_LINES", 25)
    whole = [tuple(map(cell, r)) for r in spark.read.parquet(f"{SF_DIR}/events.parquet").groupBy("event_type").count().collect()]
    folder = file_queries._odd_files(spark, SF_DIR).removeprefix("file:")
    for kind, n in whole:
        files = glob.glob(f"{folder}/kind={kind}/**/*.gz", recursive=True)
        lines = [gzip.open(f, "rt").read().splitlines() for f in files]
        assert len(files) >= int(n) / 25 and all(x[0] == "h1,h2,h3,h4,h5" for x in lines)
        assert sum(len(x) - 1 for x in lines) == int(n) and max(map(len, lines)) <= 60
    many = sorted(map(repr, file_queries.odd_lines(spark, SF_DIR).collect()))
    monkeypatch.setattr(file_queries, "FILE_LINES", 20_000)
    assert many == sorted(map(repr, file_queries.odd_lines(spark, SF_DIR).collect()))
