"""Load jobs end to end on small file sets."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace.plans import jobs
from millrace.plans.jobs import LoadError
from millrace.sources import schemas
from millrace.sources.store import TableStore
from millrace.streaming.refresh import refresh_from_stream

T1, T2, T3 = (dt.datetime(2024, 1, d, 9, 0) for d in (1, 2, 3))
HEAD = "h1,h2,h3,h4,h5\n"


def stop_rows(*numbers):
    return HEAD + "".join(f"2024/01/02 03:04:05,N{n},L,1,{n}\n" for n in numbers)


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("cp932"))


@pytest.fixture
def store(spark, tmp_path):
    (tmp_path / "stage" / "in").mkdir(parents=True)
    return TableStore(spark, str(tmp_path / "tables"), {"MY_AZURE_STAGE": str(tmp_path / "stage")})


@pytest.fixture
def stage(tmp_path):
    return tmp_path / "stage"


def load(store, **kw):
    args = dict(
        target="DB.RAW.STOP_LOG",
        load_type="append",
        location="@DB.RAW.MY_AZURE_STAGE/in/",
        file_format="FF_CSV_COMMON",
        on_error="SKIP_FILE",
        run_at=T1,
    )
    return jobs.load_table(store, **{**args, **kw})


def factors(store, table="STOP_LOG"):
    return sorted(int(r[0]) for r in store.read(table).select("`要因No.`").collect())


def test_append_skips_bad_files_and_loads_once(store, stage):
    write(stage, "in/a.csv", stop_rows(1, 2))
    write(stage, "in/b.csv", stop_rows(3) + "x,N,L,1,4\ny,N,L,1,5\n")
    result = load(store)
    assert (result.status, result.error_files, result.error_rows) == ("WARN", 1, 2)
    assert factors(store) == [1, 2]
    got = {r.file: r for r in result.outcomes.collect()}
    assert (got["in/a.csv"].status, got["in/a.csv"].rows_loaded) == ("LOADED", 2)
    bad = got["in/b.csv"]
    assert (bad.status, bad.rows_parsed, bad.rows_loaded, bad.first_error_line) == ("LOAD_FAILED", 3, 0, 3)
    assert bad.first_error_column_name == "時刻" and bad.first_error_character == 1
    digest = result.digest.first()
    assert digest.error_sample == "b.csv (line=3, char=1) : " + bad.first_error

    # the same load again under its own time replaces itself
    load(store)
    assert factors(store) == [1, 2]
    # only the repaired and the new file are read later
    write(stage, "in/b.csv", stop_rows(3))
    write(stage, "in/c.csv", stop_rows(7))
    result = load(store, run_at=T2)
    assert result.status == "OK" and factors(store) == [1, 2, 3, 7]
    result = load(store, run_at=T3)
    assert result.status == "OK" and result.outcomes.count() == 0
    load(store, run_at=T3, force=True)
    assert factors(store) == [1, 1, 2, 2, 3, 3, 7, 7]


def test_loads_of_one_time_do_not_replace_each_other(store, stage):
    write(stage, "in/a.csv", stop_rows(1))
    write(stage, "out/b.csv", stop_rows(2))
    for _ in range(2):  # the same loads again add nothing
        for folder in ("in", "out"):
            load(store, location=f"@MY_AZURE_STAGE/{folder}/")
        assert factors(store) == [1, 2] and store.read("LOAD_HISTORY").count() == 2


def test_a_load_that_stops_half_way_is_not_seen(store, stage, monkeypatch):
    write(stage, "in/a.csv", stop_rows(1, 2))
    append = store.append

    def stops(name, df, batch):
        if name == "LOAD_HISTORY":
            raise RuntimeError("stopped")
        append(name, df, batch)

    monkeypatch.setattr(store, "append", stops)
    with pytest.raises(RuntimeError):
        load(store)
    monkeypatch.setattr(store, "append", append)
    assert factors(store) == [] and store.read("LOAD_HISTORY").count() == 0
    load(store, run_at=T2)
    assert factors(store) == [1, 2]
    load(store)  # the stopped load, run again after all, finds nothing left to do
    assert factors(store) == [1, 2]


def test_two_datasets_share_a_table(store, stage, spark):
    configure(
        store,
        spark,
        ("IOT", "one", "MY_AZURE_STAGE", "one", "DB.RAW.STOP_LOG", None, None, True),
        ("IOT", "two", "MY_AZURE_STAGE", "two", "DB.RAW.STOP_LOG", None, None, True),
    )
    write(stage, "one/a.csv", stop_rows(1, 2))
    write(stage, "two/a.csv", stop_rows(3))
    for run_at in (T1, T1, T2):
        jobs.run_datasets(store, "IOT", run_at)
        assert factors(store) == [1, 2, 3]
        assert store.read("LOAD_HISTORY").agg(F.sum("rows_loaded")).first()[0] == 3


def test_abort_writes_nothing(store, stage):
    write(stage, "in/a.csv", stop_rows(1))
    write(stage, "in/b.csv", HEAD + "x,N,L,1,4\n")
    with pytest.raises(LoadError) as e:
        load(store, on_error="ABORT_STATEMENT")
    assert e.value.kind == LoadError.BAD_ROWS and "in/b.csv line 2" in str(e.value)
    assert factors(store) == [] and store.read("LOAD_HISTORY").count() == 0


def test_full_refresh_replaces_everything(store, stage):
    write(stage, "in/a.csv", stop_rows(1, 2))
    load(store)
    write(stage, "in/a.csv", "h\n2024/01/02 03:04:05,N,L,1,8,surplus\n2024/01/02 03:04:05,N\n")
    assert load(store, load_type="FULL_REFRESH").status == "OK"
    rows = store.read("STOP_LOG").select("`Nコード`", "`要因No.`").collect()
    assert sorted((r[0], r[1]) for r in rows if r[1] is not None) == [("N", 8)] and len(rows) == 2
    write(stage, "in/a.csv", HEAD + "x,N,L,1,4\n")
    with pytest.raises(LoadError):
        load(store, load_type="FULL_REFRESH")
    assert store.read("STOP_LOG").count() == 2
    # later appends go to the new version
    write(stage, "in/a.csv", stop_rows(5))
    load(store, run_at=T2, pattern=r"in/a\.csv")
    assert store.read("STOP_LOG").count() == 3


def test_load_errors(store):
    for changes, kind, code in (
        (dict(load_type="MERGE"), LoadError.INVALID_LOAD_TYPE, -20001),
        (dict(load_type="FULL_REFRESH", target="STOP_LOG"), LoadError.INVALID_TARGET, -20002),
        (dict(target="A.B.NOPE"), LoadError.TABLE_NOT_FOUND, -20003),
        (dict(load_type="FULL_REFRESH", target="A.B.NOPE"), LoadError.TABLE_NOT_FOUND, -20003),
    ):
        with pytest.raises(LoadError) as e:
            load(store, **changes)
        assert (e.value.kind, e.value.code) == (kind, code)
    assert load(store).status == "OK"  # nothing there is fine
    assert load(store, location="@MY_AZURE_STAGE/none/").status == "OK"
    assert load(store, location="@MY_AZURE_STAGE/none/", load_type="FULL_REFRESH").status == "OK"
    text = jobs.failure_text(e.value, TARGET="A.B.NOPE")
    assert "TASK=UNKNOWN" in text and "PATTERN=NULL" in text and "SQLCODE=-20003" in text


@pytest.mark.parametrize("name", sorted(jobs.TYPED_LOADS))
def test_typed_logs(store, stage, name):
    samples = {"STRING": "T", "time": "01:02:03"}

    def value(kind):
        if isinstance(kind, str):
            return samples[kind]
        return {"string": "T", "date": "2024/01/02", "timestamp_ntz": "2024/01/02 03:04:05"}.get(
            kind.simpleString(), "1"
        )

    kinds = [k for _, k in schemas.columns(name)]
    line = ",".join(value(k) for k in kinds)
    spec = jobs.TYPED_LOADS[name]
    write(stage, f"IoT/Recv/{name}/a.csv", ",".join("h" * len(kinds)) + f"\n{line}\n{line}\n")
    result = jobs.load_table(store, **{**spec, "target": "TEST_" + name}, run_at=T1)
    assert result.status == "OK"
    rows = store.read("TEST_" + name)
    assert rows.count() == 2 and rows.columns == [n for n, _ in schemas.columns(name)]
    assert all(v is not None for v in rows.first())


# --- wide records -------------------------------------------------------------------------


def wide_line(stamp="2024/01/02 03:04:05", rate="12.7", **defects):
    fields = [stamp, "N1", "L1", "1", "10", "9", "8", "7", rate, "6", "5", "4", "3", "2"]
    values = [defects.get(f"d{i:02d}", "") for i in range(1, 47)]
    return ",".join(fields + values) + "\n"


def wide(store):
    events = {int(r.source_row_number): r for r in store.read("PROD_LOG_FH").collect()}
    defects = {
        (int(r.source_row_number), r.defect_name): r for r in store.read("PROD_LOG_FH_DEFECT").collect()
    }
    return events, defects


FOLDER = "IoT/FH/Recv/L1/Prod_log/"


@pytest.mark.parametrize("incremental", [False, True])
def test_refresh_events(store, stage, incremental):
    name = FOLDER + "a.csv"
    write(stage, name, "h\n" + wide_line(d01="0", d02="12.7", d03="abc", d04="NULL", d46="-3") + "short,N2\n")
    write(stage, "IoT/FH/Recv/Other/a.csv", "h\n" + wide_line(d01="5"))
    assert jobs.refresh_events(store, T1, incremental) == "OK"
    raw = {int(r.source_row_number): r for r in store.read("PROD_LOG_FH_RAW").collect()}
    assert raw[1].source_file_path == name
    keys = raw[1].raw_obj
    assert len(keys) == 60 and keys["T不良_05"] is None
    events, defects = wide(store)
    assert sorted(events) == [1, 2]
    assert events[1]["時刻"] == dt.datetime(2024, 1, 2, 3, 4, 5) and events[1]["進捗率[%]"] == 13
    assert events[2]["時刻"] is None and events[2]["Nコード"] == "N2"
    assert events[1].created_at == events[1].updated_at == T1
    got = {k: (int(r.defect_value), r.defect_value_raw) for k, r in defects.items()}
    assert got == {(1, "T不良_01"): (0, "0"), (1, "T不良_02"): (13, "12.7"), (1, "T不良_46"): (-3, "-3")}

    # a changed file adds rows beyond those known, and changes none of them
    write(stage, name, "h\n" + wide_line(d01="99") + "short,N9\n" + wide_line(d07="7"))
    jobs.refresh_events(store, T2, incremental)
    events, defects = wide(store)
    assert sorted(events) == [1, 2, 3] and len(defects) == 4
    assert defects[1, "T不良_01"].defect_value == 0 and events[2]["Nコード"] == "N2"
    assert events[1].created_at == T1 and events[3].created_at == T2
    assert events[1].updated_at == (T1 if incremental else T2)
    assert store.read("PROD_LOG_FH").count() == 3
    assert len({e.event_id for e in events.values()}) == 3

    # running again changes nothing but update times
    jobs.refresh_events(store, T3, incremental)
    again, defects_again = wide(store)
    drop = lambda r: {k: v for k, v in r.asDict().items() if k != "updated_at"}
    assert {k: drop(r) for k, r in again.items()} == {k: drop(r) for k, r in events.items()}
    assert len(defects_again) == 4


def test_rows_of_a_grown_file_are_compared_before_they_are_objects(store, stage, monkeypatch):
    """An object repeats its keys in every row; only places and texts go through the shuffle."""
    seen = []
    insert_new = jobs.merge.insert_new
    monkeypatch.setattr(jobs.merge, "insert_new", lambda target, source, *a, **b: (seen.append(source), insert_new(target, source, *a, **b))[1])
    write(stage, FOLDER + "a.csv", "h\n" + wide_line(d01="1"))
    jobs.refresh_events(store, T1)
    write(stage, FOLDER + "a.csv", "h\n" + wide_line(d01="9") + wide_line(d02="2"))
    jobs.refresh_events(store, T2)
    assert len(seen) == 1 and not any(f.dataType.typeName() == "map" for f in seen[0].schema)
    raw = {int(r.source_row_number): r.raw_obj for r in store.read(jobs.RAW).collect()}
    assert raw[1]["T不良_01"] == "1" and raw[2]["T不良_02"] == "2" and len(raw[2]) == 60


def test_wide_files_with_bad_lines_load_nothing(store, stage):
    name = FOLDER + "a.csv"
    good = ("h\n" + wide_line(d01="1")).encode("cp932")
    write(stage, FOLDER + "b.csv", "h\n" + wide_line(d02="2"))
    (stage / name).write_bytes(good + b"bad \xfd byte\n" + wide_line(d03="3").encode("cp932"))
    assert jobs.refresh_events(store, T1) == "WARN"
    assert {r.source_file_path for r in store.read(jobs.RAW).collect()} == {FOLDER + "b.csv"}
    history = {r.file: (r.status, r.rows_loaded, r.errors_seen) for r in store.read("LOAD_HISTORY").collect()}
    assert history == {name: ("LOAD_FAILED", 0, 1), FOLDER + "b.csv": ("LOADED", 1, 0)}
    (stage / name).write_bytes(good)  # still pending, so the repaired file is read
    assert jobs.refresh_events(store, T2) == "OK"
    assert store.read(jobs.RAW).count() == 2 and store.read(jobs.EVENTS).count() == 2


def test_a_merge_that_stops_half_way_leaves_the_old_table(store, stage, monkeypatch):
    write(stage, FOLDER + "a.csv", "h\n" + wide_line(d01="1"))
    jobs.refresh_events(store, T1)
    monkeypatch.setattr(TableStore, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        jobs.normalize_events(store, T2)
    monkeypatch.undo()
    events, defects = wide(store)
    assert [e.updated_at for e in events.values()] == [T1] and len(defects) == 1
    jobs.normalize_events(store, T3)
    events, defects = wide(store)
    assert [(e.created_at, e.updated_at) for e in events.values()] == [(T1, T3)] and len(defects) == 1
    assert store.read(jobs.EVENTS).count() == 1


def test_normalize_keeps_defects_that_vanish(store, spark):
    """An upsert never deletes: rows the source no longer yields stay."""
    batch = "b1"
    raw = spark.createDataFrame([("f", 1, '{"T不良_01": "5"}')], "p string, n int, j string").select(
        F.col("p").alias("source_file_path"),
        F.col("n").alias("source_row_number"),
        F.from_json("j", "map<string,string>").alias("raw_obj"),
        F.lit(T1).cast("timestamp_ntz").alias("loaded_at"),
    )
    store.append(jobs.RAW, raw, batch)
    jobs.normalize_events(store, T1)
    store.append(jobs.RAW, raw.withColumn("raw_obj", F.expr("map('T不良_01', 'gone', 'T不良_02', '1')")), batch)
    jobs.normalize_events(store, T2)
    rows = {r.defect_name: r for r in store.read(jobs.DEFECTS).collect()}
    assert rows["T不良_01"].defect_value == 5 and rows["T不良_01"].updated_at == T1
    assert rows["T不良_02"].created_at == T2


def test_stream_takes_each_file_once(store, stage, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    place = "@MY_AZURE_STAGE/IoT/FH/Recv/"
    write(stage, FOLDER + "a.csv", "h\n" + wide_line(d01="1") + wide_line(d02="2"))
    assert refresh_from_stream(store, checkpoint, T1, place) == 1
    events, defects = wide(store)
    assert sorted(events) == [1, 2] and len(defects) == 2
    assert refresh_from_stream(store, checkpoint, T2, place) == 0
    write(stage, FOLDER + "readme.txt", "not a record\n")
    refresh_from_stream(store, checkpoint, T2, place)
    assert store.read(jobs.EVENTS).count() == 2
    assert refresh_from_stream(store, str(tmp_path / "other"), T2, "@MY_AZURE_STAGE/missing/") == 0
    write(stage, FOLDER + "b.csv", "h\n" + wide_line(d03="3"))
    write(stage, FOLDER + "c.csv", "h\n" + wide_line(d03="4"))
    assert refresh_from_stream(store, checkpoint, T3, place, max_files=1) == 2
    assert store.read(jobs.EVENTS).count() == 4 and store.read(jobs.DEFECTS).count() == 4
    assert {e.updated_at for e in store.read(jobs.EVENTS).collect()} == {T1, T3}


# --- datasets and recovery ----------------------------------------------------------------


def configure(store, spark, *rows):
    schema = schemas.schema("OPS_DATASET_CONFIG")
    store.replace("OPS_DATASET_CONFIG", spark.createDataFrame(list(rows), schema))


def test_datasets_then_recovery(store, stage, spark):
    configure(
        store,
        spark,
        ("IOT", "stop", "MY_AZURE_STAGE", "in", "DB.RAW.STOP_LOG", None, None, True),
        ("IOT", "strict", "@MY_AZURE_STAGE", "/strict", "STOP_LOG", "FF_CSV_COMMON", "ABORT_STATEMENT", True),
        ("IOT", "broken", "MY_AZURE_STAGE", "in", "NOPE", None, None, True),
        ("IOT", "idle", "MY_AZURE_STAGE", "in", "STOP_LOG", None, None, False),
        ("OTHER", "stop", "MY_AZURE_STAGE", "in", "STOP_LOG", None, None, True),
    )
    write(stage, "in/a.csv", stop_rows(1))
    write(stage, "in/d/b.csv", HEAD + "x,N,L,1,2\ny,N,L,1,3\n")
    write(stage, "strict/s.csv", HEAD + "x,N,L,1,4\n")
    assert jobs.run_datasets(store, "IOT", T1) == "DONE: 3 dataset(s)"
    assert factors(store) == [1]
    log = store.read("OPS_RUN_LOG").collect()
    seen = sorted((r.dataset, r.status, r.file_path or "", r.errors_seen, r.error_flag) for r in log)
    assert seen == [
        ("broken", "LOAD_FAILED", "", None, True),
        ("broken", "VALIDATION_FAILED", "", None, True),
        ("stop", "LOADED", "@MY_AZURE_STAGE/in/a.csv", 0, False),
        ("stop", "LOAD_FAILED", "@MY_AZURE_STAGE/in/d/b.csv", 2, True),
        ("stop", "VALIDATION_ERROR", "@MY_AZURE_STAGE/in/d/b.csv", 1, True),
        ("stop", "VALIDATION_ERROR", "@MY_AZURE_STAGE/in/d/b.csv", 1, True),
        ("strict", "LOAD_FAILED", "", None, True),
        ("strict", "VALIDATION_ERROR", "@MY_AZURE_STAGE/strict/s.csv", 1, True),
    ]
    raw = next(json.loads(r.raw.toJson()) for r in log if r.status == "VALIDATION_ERROR" and r.dataset == "stop")
    assert raw["column_name"] == "時刻" and raw["file"] == "in/d/b.csv"

    jobs.rebuild_error_log(store)
    assert store.read("OPS_ERROR_LOG").count() == 7
    jobs.rebuild_recovery_queue(store, T1)
    queue = {r.dataset: r for r in store.read("OPS_RECOVERY_QUEUE").collect()}
    assert {d: (q.pattern, q.status, q.force) for d, q in queue.items()} == {
        "stop": ("//d/b.csv", "PENDING", True),
        "strict": ("//s.csv", "PENDING", True),
    }

    write(stage, "in/d/b.csv", stop_rows(2, 3))  # repaired
    assert jobs.run_recovery(store, "IOT", T2) == "RECOVERY DONE: 1"
    assert factors(store) == [1, 2, 3]
    queue = {r.dataset: r for r in store.read("OPS_RECOVERY_QUEUE").collect()}
    assert (queue["stop"].status, queue["stop"].note) == ("DONE", "OK")
    assert queue["strict"].status == "ERROR" and "is not a valid" in queue["strict"].note
    recovered = store.read("OPS_RUN_LOG").where(F.col("run_at") == F.lit(T2).cast("timestamp_ntz")).collect()
    assert [(r.file_path, r.status, r.error_flag) for r in recovered] == [
        ("@MY_AZURE_STAGE/in/d/b.csv", "LOADED", False)
    ]

    # the rebuild starts over from all errors unless recovered files are left out
    jobs.rebuild_error_log(store)
    jobs.rebuild_recovery_queue(store, T3)
    assert store.read("OPS_RECOVERY_QUEUE").where("status = 'PENDING'").count() == 2
    jobs.rebuild_recovery_queue(store, T3, exclude_recovered=True)
    assert [r.dataset for r in store.read("OPS_RECOVERY_QUEUE").collect()] == ["strict"]


def test_recovery_of_missing_config_and_file(store, stage, spark):
    configure(store, spark, ("IOT", "stop", "MY_AZURE_STAGE", "in", "STOP_LOG", None, None, True))
    write(stage, "in/a.csv", stop_rows(1))
    write(stage, "in/bad.csv", HEAD + "x,N,L,1,2\n")
    stamp = F.lit(T1).cast("timestamp_ntz")
    queue = spark.createDataFrame(
        [("q1", "gone", "/a.csv"), ("q2", "stop", "/none.csv"), ("q3", "stop", "a.csv"), ("q4", "stop", "/bad.csv")],
        "queue_id string, dataset string, pattern string",
    ).withColumns(
        {
            "system": F.lit("IOT"),
            "force": F.lit(True),
            "status": F.lit("PENDING"),
            "note": F.lit(None).cast("string"),
            "created_at": stamp,
            "enq_at": stamp,
        }
    )
    store.replace("OPS_RECOVERY_QUEUE", queue)
    assert jobs.run_recovery(store, "IOT", T2) == "RECOVERY DONE: 3"
    got = {r.queue_id: (r.status, r.note) for r in store.read("OPS_RECOVERY_QUEUE").collect()}
    assert got["q1"] == ("ERROR", "CONFIG NOT FOUND")
    assert got["q2"] == ("ERROR", "LOAD_FAILED")
    assert got["q3"] == ("DONE", "OK")
    assert got["q4"][0] == "ERROR" and "timestamp" in got["q4"][1]
    assert factors(store) == [1]


def test_warning_text(store, stage):
    for i in range(7):
        write(stage, f"in/f{i}.csv", HEAD + "x,N,L,1,2\n")
    result = load(store)
    row = jobs.load_digest(result.outcomes, TARGET="DB.RAW.STOP_LOG", ON_ERROR="SKIP_FILE").first()
    lines = row.message.split("\n")
    assert lines[:5] == ["```", "[TASK_WARNING]", "RESULT=SUCCESS_WITH_SKIPPED_FILES", "TASK=UNKNOWN", "TARGET=DB.RAW.STOP_LOG"]
    assert "ERROR_FILE_COUNT=7" in lines and "ERROR_ROW_COUNT=7" in lines
    assert sum(line.startswith("f") for line in lines) == 7 and "(+ 2 more files...)" in lines
    short = jobs.load_digest(result.outcomes, max_files=5).first().message
    assert sum(line.startswith("f") for line in short.split("\n")) == 5
    assert json.loads(row.body)["text"] == row.message
