"""Tables and results that are kept up: sales tables by load, the change report, the recovery queue, side-by-side jobs."""

import datetime as dt
import re
import threading
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.checks import file_queries, queries, shapes
from millrace.operators import runlog
from millrace.plans import jobs, reports
from millrace.sources import sales
from millrace.sources.store import TableStore

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2024, 2, 1)


def rows(df):
    return Counter(tuple(map(str, r)) for r in df.collect())


def files_of(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


@pytest.fixture(scope="module")
def stored(spark):
    return queries._sales_in_loads(spark, SF)


def test_window_reads_its_months_only(spark, stored):
    since = queries.AS_OF - dt.timedelta(days=30)
    for name in ("cdhdr", "cdpos"):
        whole, window = files_of(stored.read(name)), files_of(stored.read(name, since))
        months = {f.split("part=m")[1][:7] for f in window}
        assert min(months) == "2001-07" and len(window) < len(whole) / 3
    tables = {n: stored.read(n, since) for n in ("cdhdr", "cdpos")}
    plan = reports.date_changes(tables, queries.CLIENT, queries.AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(part") >= 2


def test_stored_tables_hold_all_rows(spark, stored):
    tables = shapes.erp_tables(spark, SF)
    for name in ("vbep", "vbap", "vbpa", "vbfa", "cdhdr", "cdpos"):
        got = stored.read(name).select(*tables[name].columns)
        assert rows(got) == rows(tables[name]), name
    assert stored.hot_keys() == {}
    some = stored.hot_keys(rows_per_key=10)
    counted = tables["vbep"].groupBy("vbeln").count().where("count > 10").count()
    assert len(some["document"]) >= counted and some["order"]


def test_refresh_touches_changed_documents_only(spark, tmp_path):
    """A second load of one document rewrites its part only, and the report equals that of all rows."""
    tables = shapes.erp_tables(spark, SF)
    whole = reports.delivery_change_report(tables, queries.CLIENT, queries.AS_OF, queries.WHOLE_HISTORY_DAYS, hot={})
    one = whole.select("Sales Doc No").first()[0]
    stored, store = sales.SalesTables(spark, str(tmp_path / "sales"), parts=8), TableStore(spark, str(tmp_path / "tables"))
    late = F.col("vbeln") == one
    stored.append("day0", {**tables, "vbpa": tables["vbpa"].where(~late)})
    refresh = lambda *loads: reports.refresh_change_report(store, stored, queries.CLIENT, queries.AS_OF, loads, queries.WHOLE_HISTORY_DAYS)
    read = lambda: reports.read_change_report(store, queries.AS_OF, queries.WHOLE_HISTORY_DAYS)
    assert refresh("day0") == 8
    before = set(store._batch_folders(reports.REPORT))
    assert rows(read()) != rows(whole)
    stored.append("day1", {"vbpa": tables["vbpa"].where(late)})
    assert [r.document for r in stored.touched(["day1"]).collect()] == [one]
    assert refresh("day1") == 1 and len(set(store._batch_folders(reports.REPORT)) - before) == 1
    assert rows(read()) == rows(whole)
    assert refresh("day1") == 1 and rows(read()) == rows(whole)  # a load may be taken twice
    assert refresh() == 0 and refresh("day7") == 0
    later = dt.date(2002, 1, 1)
    assert rows(reports.read_change_report(store, later, 30)) == rows(whole.where(F.col("Updated Date") >= later - dt.timedelta(days=30)))


def test_items_wait_for_their_header(spark, tmp_path):
    stored = sales.SalesTables(spark, str(tmp_path), parts=4)
    header = lambda n, day: spark.createDataFrame([("900", "VERKBELEG", n, "d", day)], "mandant string, objectclas string, changenr string, objectid string, udate date")
    item = lambda n: spark.createDataFrame([(n, "d", "VBEP", "EDATU", "k", None, "20240203")], "changenr string, objectid string, tabname string, fname string, tabkey string, value_old string, value_new string")
    day = dt.date(2024, 1, 31)
    stored.append("a", {"cdpos": item("c1")})
    assert stored.read("cdpos").count() == 0
    stored.append("b", {"cdhdr": header("c1", day)})
    stored.append("c", {"cdpos": item("c1").unionByName(item("c9"))})  # the header came before
    assert [(r.changenr, r.month) for r in stored.read("cdpos").collect()] == [("c1", "m2024-01")] * 2
    tables = {n: stored.read(n, day) for n in ("cdhdr", "cdpos")}
    assert reports.date_changes(tables, "900", day).count() == 1


def test_a_load_runs_its_frames_once(spark, tmp_path):
    """Items and the join for their months are not run again for the sketch; purchase orders are written as they come."""
    header = spark.createDataFrame([("900", "VERKBELEG", f"c{n}", f"d{n}", dt.date(2024, 1, 1 + n)) for n in range(9)], "mandant string, objectclas string, changenr string, objectid string, udate date")
    item = spark.createDataFrame([(f"c{n}", f"d{n}", "VBEP", "EDATU", "k", None, "20240203") for n in range(9)], "changenr string, objectid string, tabname string, fname string, tabkey string, value_old string, value_new string")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(number):
        seen.add(1)
        return number

    counted = counted.asNondeterministic()
    order = spark.range(0, 30, 1, 3).select(F.concat(F.lit("45"), F.col("id")).alias("ebeln"), F.lit("00010").alias("ebelp"), F.lit("0001").alias("etenr"), F.lit(dt.date(2024, 1, 1)).alias("eindt"))
    stored = sales.SalesTables(spark, str(tmp_path), parts=4)
    stored.append("a", {"cdhdr": header, "cdpos": item.withColumn("objectid", counted("objectid")), "eket": order})
    assert seen.value == 9
    assert rows(stored.read("cdpos").select(*item.columns)) == rows(item) and rows(stored.read("eket")) == rows(order)
    assert len(files_of(stored.read("eket"))) == 3
    hot = stored.hot_keys(rows_per_key=0)
    assert hot == {"document": [f"d{n}" for n in range(9)], "order": sorted(f"45{n}" for n in range(30))}


def _report_tables(spark, documents):
    make = lambda lines, schema: spark.createDataFrame([x for d in documents for x in lines(d)], schema)
    day, line = dt.date(2001, 7, 20), lambda d: [(d, p) for p in ("000010", "000020")]
    return {
        "vbap": make(lambda d: [("900", *k, "M", f"text {d}", "part", "ref", "org") for k in line(d)], "mandt string, vbeln string, posnr string, matnr string, arktx string, kdmat string, bstkd_ana string, berid string"),
        "vbep": make(lambda d: [("900", *k, "0001", day, day) for k in line(d)], "mandt string, vbeln string, posnr string, etenr string, req_dlvdate date, edatu date"),
        "vbpa": make(lambda d: [("900", d, "000000", r, f"bp {d}", "a1", "DE") for r in ("AG", "ZR")], "mandt string, vbeln string, posnr string, parvw string, assigned_bp string, adrnr string, land1 string"),
        "vbfa": make(lambda d: [("900", *k, f"45{d}", k[1], "C", "V") for k in line(d)], "mandt string, vbelv string, posnv string, vbeln string, posnn string, vbtyp_v string, vbtyp_n string"),
        "cdhdr": make(lambda d: [("900", "VERKBELEG", f"c{d}", d, day)], "mandant string, objectclas string, changenr string, objectid string, udate date"),
        "cdpos": make(lambda d: [(f"c{d}", d, "VBEP", "EDATU", f"900{d or '':>10}{p}0001", "20010701", "20010801") for _, p in line(d)], "changenr string, objectid string, tabname string, fname string, tabkey string, value_old string, value_new string"),
        "adrc": spark.createDataFrame([("900", "a1", "name")], "client string, addrnumber string, name1 string"),
    }


def test_a_long_list_of_documents_filters_inside_the_partitioning(spark, tmp_path, monkeypatch):
    tables = _report_tables(spark, [*"abcd", None])
    whole = reports.change_rows(tables, "900", queries.AS_OF, hot={})
    assert whole.select("vbeln").distinct().count() == 4
    only = spark.createDataFrame([("a",), ("c",), ("x",)], "document string")
    for hot in ({}, {"document": ["a", "b"]}):
        assert rows(reports.change_rows(tables, "900", queries.AS_OF, hot=hot, only=only)) == rows(whole.where("vbeln IN ('a', 'c')"))
    with session.conf_set(session.configure(spark), spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false", spark__sql__maxPlanStringLength="100000000"):
        plan = reports.change_rows(tables, "900", queries.AS_OF, hot={}, only=only)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") >= 6
    assert len([x for x in plan.splitlines() if re.search(r"Exchange hashpartitioning\(vbelv?#\d+, \d+\), REPARTITION", x)]) <= 6
    # a store brought up to date by a long list holds the same report
    monkeypatch.setattr(reports, "FEW_DOCUMENTS", 0)
    stored, store = sales.SalesTables(spark, str(tmp_path / "sales"), parts=3), TableStore(spark, str(tmp_path / "tables"))
    stored.append("day0", {n: t.where("vbeln <> 'c'") if n == "vbpa" else t for n, t in tables.items()})
    stored.append("day1", {"vbpa": tables["vbpa"].where("vbeln = 'c'")})
    for load in ("day0", "day1"):
        reports.refresh_change_report(store, stored, "900", queries.AS_OF, [load])
    want = whole.select(*[F.col(c).alias(h) for c, h in reports.CHANGE_HEADINGS])
    assert rows(reports.read_change_report(store, queries.AS_OF)) == rows(want)


def _log(spark, lines):
    schema = "system string, dataset string, file_path string, status string, error_flag boolean, run_at timestamp_ntz"
    out = spark.createDataFrame([("S", "d", *x) for x in lines], schema)
    none = F.lit(None).cast("string")
    more = {c: none for c in ("target_table", "file_name", "errors_seen", "first_error_message")}
    return out.withColumns({**more, "raw": F.lit(None).cast("variant")})


def test_parts_are_computed_in_groups(spark, tmp_path, monkeypatch):
    """Groups of parts leave the report of all parts, seen at once."""
    assert reports._groups({"p0": 5, "p1": 5, "p2": 1, "p3": 20, "p4": 1}, 10) == [["p0", "p1"], ["p2"], ["p3"], ["p4"]]
    tables = shapes.erp_tables(spark, SF)
    stored = sales.SalesTables(spark, str(tmp_path / "sales"), parts=4)
    stored.append("day0", tables)
    monkeypatch.setattr(reports, "MOST_DOCUMENTS", 800)
    written = []
    save = session.save
    monkeypatch.setattr(session, "save", lambda df, path, *rest: (written.append(path), save(df, path, *rest)))
    for few in (reports.FEW_DOCUMENTS, 10):
        monkeypatch.setattr(reports, "FEW_DOCUMENTS", few)
        store = TableStore(spark, str(tmp_path / f"tables{few}"))
        for _ in range(2):
            assert reports.refresh_change_report(store, stored, queries.CLIENT, queries.AS_OF, ["day0"], queries.WHOLE_HISTORY_DAYS) == 4
            assert len(store._batch_folders(reports.REPORT)) == 4
        assert sum(f"tables{few}/{reports.REPORT}" in w for w in written) > 2
        whole = reports.delivery_change_report(tables, queries.CLIENT, queries.AS_OF, queries.WHOLE_HISTORY_DAYS, hot={})
        assert rows(reports.read_change_report(store, queries.AS_OF, queries.WHOLE_HISTORY_DAYS)) == rows(whole)
    session.configure(spark)


def test_kept_queue_equals_a_rebuild(spark, tmp_path):
    hour = lambda h: NOW + dt.timedelta(hours=h)
    batches = {
        "b1": [("a", "LOAD_FAILED", True, hour(1)), ("b", "LOAD_FAILED", True, hour(1)), (None, "LOAD_FAILED", True, hour(1))],
        "b2": [("a", "LOADED", False, hour(2)), ("c", "LOADED", False, hour(2)), ("d", None, True, hour(2))],
        "b3": [("b", "LOADED", False, hour(0)), ("c", "VALIDATION_ERROR", True, hour(3)), ("d", "LOADED", False, hour(2))],
    }
    for n, order in enumerate((["b1", "b2", "b3"], ["b3", "b1", "b2"])):
        store = TableStore(spark, str(tmp_path / str(n)))
        for batch in order:
            store.append(jobs.RUN_LOG, _log(spark, batches[batch]), batch)
            for skip in (False, True):
                jobs.update_recovery_queue(store, NOW, exclude_recovered=skip)
                kept = rows(store.read(jobs.QUEUE))
                jobs.rebuild_error_log(store)
                jobs.rebuild_recovery_queue(store, NOW, exclude_recovered=skip)
                assert kept == rows(store.read(jobs.QUEUE)) and (kept or batch == "b3")
        assert jobs.update_recovery_queue(store, NOW) == 0
    twice = runlog.recovery_state(_log(spark, batches["b1"] * 2).unionByName(_log(spark, batches["b2"])))
    parts = runlog.recovery_state(_log(spark, batches["b2"])).unionByName(runlog.recovery_state(_log(spark, batches["b1"])))
    assert rows(runlog.merged_states(parts)) == rows(twice)


def test_a_grown_file_is_taken_by_the_listing_stream(spark, tmp_path):
    """New, same, changed and bad files, over three runs; what the batch job holds is what the stream holds."""
    folder = tmp_path / "files"
    place = folder / "L1" / "Prod_log"
    place.mkdir(parents=True)
    line = lambda n: f"2024/01/02 03:04:05,N{n}," + ",".join(str(n) for _ in range(20)) + "\n"
    put = lambda name, lines: (place / name).write_bytes(("h\n" + "".join(lines)).encode("cp932"))
    stores = [TableStore(spark, str(tmp_path / way), {"FILES": str(folder)}) for way in ("batch", "stream")]

    def run(day):
        at = dt.datetime(2024, 2, day)
        jobs.refresh_events(stores[0], at, location="@FILES/")
        done = file_queries.refresh_from_listings(stores[1], str(tmp_path / "checkpoint"), at, "@FILES/")
        held = [rows(s.read(jobs.EVENTS).drop("created_at", "updated_at")) for s in stores]
        assert held[0] == held[1]
        assert rows(stores[0].read(jobs.DEFECTS).drop("created_at", "updated_at")) == rows(stores[1].read(jobs.DEFECTS).drop("created_at", "updated_at"))
        return done, sum(held[1].values())

    put("a.csv", [line(1), line(2)])
    put("b.csv", [line(3)])
    (place / "bad.csv").write_bytes(b"h\n2024/01/02 03:04:05,\xfd,1\n")
    assert run(1) == (1, 3)
    put("a.csv", [line(1), line(2), line(4)])  # grew
    put("c.csv", [line(5)])  # new
    assert run(2) == (1, 5)
    put("bad.csv", [line(6)])  # mended
    assert run(3) == (1, 6)
    assert run(4)[0] == 0


def test_options_are_shared_by_threads_that_agree(spark):
    key, seen = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(key, None)

    def hold(value, seconds):
        with session.conf_set(spark, spark__sql__files__maxPartitionBytes=value):
            seen.append((value, spark.conf.get(key)))
            time.sleep(seconds)
            seen.append((value, spark.conf.get(key)))

    threads = [threading.Thread(target=hold, args=(v, s)) for v, s in (("1m", 0.3), ("2m", 0.2), ("1m", 0.5), ("2m", 0.1))]
    for t in threads:
        t.start()
    for t in threads:
        t.join(60)
    assert len(seen) == 8 and all(a == b for a, b in seen) and spark.conf.get(key, None) == before and not session._held
    with session.conf_set(spark, spark__sql__files__maxPartitionBytes="3m"):
        with session.conf_set(spark, spark__sql__files__maxPartitionBytes="4m"):
            assert spark.conf.get(key) == "4m"
        assert spark.conf.get(key) == "3m"
    assert spark.conf.get(key, None) == before


def test_work_runs_side_by_side(spark):
    begun, meet = [], threading.Barrier(3, timeout=30)

    def piece(k):
        begun.append(k)
        if k < 3:
            meet.wait()  # only passed when three run at once
        if k == 4:
            raise ValueError("piece 4")
        return spark.range(k).count()

    assert session.side_by_side(spark, [lambda k=k: piece(k) for k in range(4)], 3) == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="piece 4"):
        session.side_by_side(spark, [lambda k=k: piece(k) for k in (4, 5, 6)], 2)
    assert set(begun) == {0, 1, 2, 3, 4, 5, 6}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_datasets_side_by_side_leave_the_same_tables(spark, monkeypatch):
    found = {}
    for at_once in (1, 4):
        monkeypatch.setattr(jobs.run_datasets, "__defaults__", (at_once,))
        found[at_once] = rows(file_queries.dataset_run(spark, SF))
    assert found[1] == found[4] and found[1]
