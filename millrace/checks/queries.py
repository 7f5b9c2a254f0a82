"""One query per capability, each over whole given tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import session
from millrace.checks import shapes
from millrace.checks.shapes import CLIENT, pad, table
from millrace.functions import (
    base_name,
    dash_date,
    event_id,
    null_tokens,
    parse_date,
    parse_number,
    parse_time_text,
    parse_timestamp,
    qcol,
)
from millrace.operators import lookup, merge, runlog, semistruct
from millrace.operators.joins import lookup_left_join
from millrace.plans import jobs, reports
from millrace.sources import config, sales
from millrace.sources.store import TableStore

KEYS = ["mandt", "vbeln", "posnr"]
RUN_AT = datetime(2024, 2, 1, 9, 5, 0)
AS_OF = date(2001, 8, 1)
WHOLE_HISTORY_DAYS = 4000

money = "decimal(18,2)"


def _money(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast(money) for n in names})


def open_schedule(spark, sf_dir):
    """Ordered, delivered and open quantity per sales item, open items only."""
    lines = shapes.vbep(spark, sf_dir)
    return _money(lookup.open_schedule(lines, KEYS), "soqty", "dlvqty", "openqty")


def last_schedule_line(spark, sf_dir):
    """Open items with the dates of their last schedule line, ties kept."""
    lines = shapes.vbep(spark, sf_dir)
    found = lookup.open_last_lines(lines, KEYS, ["edatu", "mbdat", "wadat"])
    return found.drop("soqty", "dlvqty", "openqty")


def _items(spark, sf_dir):
    return shapes.vbep(spark, sf_dir).select(*KEYS)


def partner_fallback(spark, sf_dir):
    """Sold-to partner of every item row, item level first, else document level."""
    roles = {"AG": {"assigned_bp": "sold_to_bp", "adrnr": "sold_to_addr"}}
    return lookup.with_partners(
        _items(spark, sf_dir), shapes.vbpa(spark, sf_dir), roles, KEYS[:2]
    )


def partner_three_roles(spark, sf_dir):
    """Sold-to, ship-to and person in charge of every item row."""
    return lookup.with_partners(
        _items(spark, sf_dir),
        shapes.vbpa(spark, sf_dir),
        reports.partner_roles("ZR"),
        KEYS[:2],
    )


def name_lookup(spark, sf_dir):
    """The address table joined twice under other names, matched within the client."""
    partners = shapes.vbpa(spark, sf_dir).select(
        "mandt",
        "vbeln",
        "posnr",
        F.col("adrnr").alias("first_addr"),
        F.when(F.col("parvw") == "AG", F.col("adrnr")).alias("second_addr"),
    )
    return lookup.with_names(
        partners,
        shapes.adrc(spark, sf_dir),
        {"first_addr": "first_name", "second_addr": "second_name"},
        spread_by=["vbeln", "posnr"],
        scope={"mandt": "client"},
        read_again=True,
    )


def flow_hop(spark, sf_dir):
    """Items with a follow-on purchase order, once per purchase-order item."""
    return lookup.flow_hop(
        _items(spark, sf_dir),
        shapes.vbfa(spark, sf_dir),
        {"mandt": "mandt", "vbeln": "vbelv", "posnr": "posnv"},
        {"vbeln": "po_vbeln", "posnn": "po_posnn"},
    )


def transformed_key_join(spark, sf_dir):
    """Purchase-order items joined to dates stored under a shorter item number."""
    hops = shapes.vbfa(spark, sf_dir).select(
        "vbeln", "posnn", F.col("vbeln").alias("ebeln"), lookup.po_item(F.col("posnn")).alias("ebelp")
    )
    dates = shapes.eket(spark, sf_dir).where(F.col("etenr") == "0001").drop("etenr")
    return lookup_left_join(hops, dates, ["ebeln", "ebelp"], unique_right=False)


def recent_changes(spark, sf_dir):
    """Date changes inside the rolling 30-day window, parsed from the change key."""
    return reports.date_changes(shapes.erp_tables(spark, sf_dir), CLIENT, AS_OF)


def delivery_change_report(spark, sf_dir):
    """The change report over the whole change history, repeated keys allowed."""
    hot = shapes.hot_keys(spark, sf_dir)
    return reports.delivery_change_report(shapes.erp_tables(spark, sf_dir), CLIENT, AS_OF, WHOLE_HISTORY_DAYS, hot)


def so_po_combination(spark, sf_dir):
    """The sales-order / purchase-order list over all open items, repeated keys allowed."""
    out = reports.so_po_combination(shapes.erp_tables(spark, sf_dir), CLIENT, shapes.hot_keys(spark, sf_dir))
    return _money(out, "SOQTY", "DLVQTY", "OpenQTY")


def delivery_change_report_unique(spark, sf_dir):
    """The change report over tables with unique keys."""
    tables, hot = shapes.erp_tables(spark, sf_dir), shapes.hot_keys(spark, sf_dir)
    return reports.delivery_change_report(tables, CLIENT, AS_OF, WHOLE_HISTORY_DAYS, hot, unique=shapes.PRIMARY_KEYS)


def delivery_change_report_recent(spark, sf_dir):
    """The change report of the last 30 days, filtering large tables by changed documents."""
    tables, hot = shapes.erp_tables(spark, sf_dir), shapes.hot_keys(spark, sf_dir)
    return reports.delivery_change_report(tables, CLIENT, AS_OF, hot=hot, stage_changes=True, unique=shapes.PRIMARY_KEYS)


def _sales_in_loads(spark, sf_dir) -> sales.SalesTables:
    """All sales tables in three loads: changes by day, and some documents' partners and lines late."""
    tables, stored = shapes.erp_tables(spark, sf_dir), sales.SalesTables(spark, session.scratch_path(spark, "sales"), parts=16)
    number = lambda c: F.substring(c, -1, 1)
    late = {  # the load that brings a row, by table
        "cdhdr": F.when(F.col("udate") >= AS_OF, 2).when(F.col("udate") >= F.date_add(F.lit(AS_OF), -10), 1).otherwise(0),
        "vbpa": F.when((number("vbeln") == "7") & (F.col("posnr") != "000000"), 1).otherwise(0),
        "vbep": F.when(number("vbeln") == "3", 2).otherwise(0),
        "adrc": F.when(number("addrnumber") == "9", 1).otherwise(0),
    }
    dated = tables["cdhdr"].select("changenr", "objectid", late["cdhdr"].alias("load")).distinct()
    for load in range(3):
        rows = {n: t.where(late[n] == load) if n in late else t for n, t in tables.items() if n in late or load == 0}
        # the items of the second day come a load before their headers
        rows["cdpos"] = tables["cdpos"].join(dated.where((F.col("load") > 0) == (load == 1)), ["changenr", "objectid"]).drop("load")
        stored.append(f"day{load}", rows if load < 2 else {n: t for n, t in rows.items() if n != "cdpos"})
    return stored


def recent_changes_stored(spark, sf_dir):
    """Date changes of the rolling window, read from the months that hold it."""
    stored = _sales_in_loads(spark, sf_dir)
    since = AS_OF - timedelta(days=30)
    return reports.date_changes({n: stored.read(n, since) for n in ("cdhdr", "cdpos")}, CLIENT, AS_OF)


def change_report_kept_up(spark, sf_dir):
    """The change report kept up over three loads of the sales tables; only documents they touch are computed again."""
    stored = _sales_in_loads(spark, sf_dir)
    store = TableStore(spark, session.scratch_path(spark, "tables"))
    for load in range(3):
        reports.refresh_change_report(store, stored, CLIENT, AS_OF, [f"day{load}"], WHOLE_HISTORY_DAYS)
    return reports.read_change_report(store, AS_OF, WHOLE_HISTORY_DAYS)


def so_po_combination_unique(spark, sf_dir):
    """The combination list over tables with unique keys."""
    out = reports.so_po_combination(shapes.erp_tables(spark, sf_dir), CLIENT, shapes.hot_keys(spark, sf_dir), shapes.PRIMARY_KEYS)
    return _money(out, "SOQTY", "DLVQTY", "OpenQTY")


def latest_per_key(spark, sf_dir):
    """Newest event per user and type."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return merge.latest_per_key(events, ["user_id", "event_type"], "ts", ["event_id"])


def outcome_flags(spark, sf_dir):
    """Error count and flag of every load outcome, regular and recovery rule."""
    log = shapes.run_log(spark, sf_dir)
    status, errors = F.col("status"), F.col("errors_seen")
    return log.select(
        "event_id",
        runlog.outcome_errors(status, errors).alias("errors_seen"),
        runlog.outcome_flag(status, errors).alias("error_flag"),
        runlog.recovery_flag(status, errors).alias("recovery_flag"),
    )


def _flagged(spark, sf_dir):
    log = shapes.run_log(spark, sf_dir)
    return log.withColumn("error_flag", runlog.outcome_flag(F.col("status"), F.col("errors_seen")))


def error_log(spark, sf_dir):
    """Run-log rows that carry the error flag."""
    return runlog.error_log(_flagged(spark, sf_dir)).select(
        "run_at", "system", "dataset", "file_path", "status", "errors_seen", "first_error", "event_id"
    )


def recovery_queue(spark, sf_dir):
    """Pending item per file that ever failed, with its path below the dataset folder."""
    log = _flagged(spark, sf_dir)
    kind = F.col("event_type")
    folders = (
        table(spark, sf_dir, "events")
        .select(
            F.lit("IOT").alias("system"),
            kind.alias("dataset"),
            F.when(kind == "error", "recv/error/")
            .when(kind == "signup", "elsewhere/")
            .when(kind == "purchase", "/recv/purchase")
            .alias("subpath"),
        )
        .distinct()
    )
    return runlog.recovery_queue(runlog.error_log(log), folders, RUN_AT, tie_break=["event_id"])


def queue_outcomes(spark, sf_dir):
    """Final status and note per queue item, one item per user."""
    results = shapes.run_log(spark, sf_dir).select(
        F.col("user_id").alias("queue_id"),
        F.col("event_id").alias("seq"),
        "first_error",
        runlog.recovery_flag(F.col("status"), F.col("errors_seen")).alias("error_flag"),
    )
    return runlog.queue_outcomes(results)


def _outcomes(spark, sf_dir):
    return shapes.run_log(spark, sf_dir).select(
        "dataset", "user_id", "file", "errors_seen", "first_error", "first_error_line", "first_error_character"
    )


def error_digest(spark, sf_dir):
    """Readable digest of bad files per dataset."""
    return runlog.error_digest(_outcomes(spark, sf_dir), ["dataset"])


def error_digest_short(spark, sf_dir):
    """Digest per user naming the first five bad files."""
    return runlog.error_digest(_outcomes(spark, sf_dir), ["user_id"], runlog.SHORT_FORM_FILES)


def error_digest_all(spark, sf_dir):
    """One digest over all outcomes."""
    return runlog.error_digest(_outcomes(spark, sf_dir))


def warning_message(spark, sf_dir):
    """Warning text and JSON body about the bad files among all outcomes."""
    return jobs.load_digest(_outcomes(spark, sf_dir), TARGET="DB.RAW.STOP_LOG", ON_ERROR="SKIP_FILE").select(
        "message", "body"
    )


def load_status(spark, sf_dir):
    """Least status, bad files and bad rows over all outcomes, as a load sums them up."""
    errors = F.col("errors_seen")
    return shapes.run_log(spark, sf_dir).agg(
        F.min("status").alias("status"),
        F.coalesce(F.sum((errors > 0).cast("long")), F.lit(0)).alias("error_files"),
        F.coalesce(F.sum(errors), F.lit(0)).alias("error_rows"),
    )


def event_upsert(spark, sf_dir):
    """Customers updated by their order totals and extended by the suppliers."""
    old = datetime(2024, 1, 1)
    target = (
        table(spark, sf_dir, "customer")
        .select(
            F.col("c_custkey").alias("custkey"),
            F.col("c_acctbal").cast(money).alias("amount"),
            F.col("c_name").alias("note"),
            F.col("c_nationkey").alias("nation"),
            F.lit(old).cast("timestamp_ntz").alias("created_at"),
            F.lit(old).cast("timestamp_ntz").alias("updated_at"),
        )
    )
    total = F.sum(F.col("o_totalprice").cast(money))
    source = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("custkey"))
        .agg(
            total.cast(money).alias("amount"),
            F.when(total > 400000, F.max("o_orderstatus")).alias("note"),
        )
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        (-F.col("s_suppkey") - 1).alias("custkey"), F.col("s_acctbal").cast(money).alias("amount"), F.col("s_name").alias("note")
    )
    return merge.upsert(target, source.unionByName(suppliers), ["custkey"], RUN_AT)


def defect_upsert(spark, sf_dir):
    """Upsert on a two-column key: finished lines extended by open ones."""
    lines = table(spark, sf_dir, "lineitem")

    def totals(status):
        return (
            lines.where(F.col("l_linestatus") == status)
            .groupBy(F.col("l_orderkey").alias("event_id"), F.col("l_returnflag").alias("defect_name"))
            .agg(F.sum(F.col("l_quantity").cast("decimal(18,0)")).cast("decimal(18,0)").alias("defect_value"))
        )

    old = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")
    target = totals("F").withColumns({"created_at": old, "updated_at": old})
    return merge.upsert(target, totals("O"), ["event_id", "defect_name"], RUN_AT)


def insert_new(spark, sf_dir):
    """Table after an insert-only merge: open lines join finished ones under new keys."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus", "l_partkey"
    )
    target = lines.where(F.col("l_linestatus") == "F")
    source = lines.where(F.col("l_linestatus") == "O")
    fresh = merge.insert_new(target, source, ["l_orderkey", "l_linenumber"], scope=["l_orderkey"])
    return target.unionByName(fresh)


def surrogate_key(spark, sf_dir):
    """Hash key over file and row; NULL when a part is missing."""
    path = F.concat(F.lit("recv/"), F.col("event_type"), F.lit(".csv"))
    path = F.when(F.col("value") > 1, path)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_number"), event_id(path, F.col("event_id")).alias("event_id")
    )


def _line_fields():
    c = F.col
    text = lambda x: x.cast("string")
    fields = {
        "時刻": F.date_format("l_shipdate", "yyyy/MM/dd HH:mm:ss"),
        "ラインNo.": c("l_returnflag"),
        "T投入数[個]": text(c("l_quantity").cast("decimal(18,2)")),
        "T不良_01": text(c("l_extendedprice").cast("decimal(18,2)")),
        "T不良_02": text(c("l_discount").cast("decimal(18,2)")),
        "T不良_03": c("l_linestatus"),
        "T不良_04": F.when(c("l_tax") > 0.035, text(c("l_partkey"))),
        "T不良_05": F.when(c("l_tax") > 0.035, F.lit("")).otherwise(F.lit("NULL")),
        "T不良_06": F.concat(F.lit("-"), text(c("l_suppkey"))),
    }
    return fields


def _line_objects(spark, sf_dir, build):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", build(_line_fields()).alias("raw_obj"))


KNOWN_KEYS = ["時刻", "ラインNo.", "T投入数[個]"]


def unpivot_numeric(spark, sf_dir):
    """Long rows of the numeric values of wide objects, known fields left out."""
    return semistruct.unpivot_numeric(
        _line_objects(spark, sf_dir, semistruct.build_map),
        F.col("raw_obj"),
        ["l_orderkey", "l_linenumber"],
        KNOWN_KEYS,
    )


def object_fields(spark, sf_dir):
    """Typed fields read back from objects by key."""
    obj = F.col("raw_obj")
    return _line_objects(spark, sf_dir, semistruct.build_object).select(
        "l_orderkey",
        "l_linenumber",
        parse_timestamp(semistruct.object_text(obj, "時刻")).alias("stamp"),
        semistruct.object_text(obj, "ラインNo.").alias("line"),
        parse_number(semistruct.object_text(obj, "T投入数[個]"), 18).alias("quantity"),
        semistruct.object_text(obj, "T不良_04").alias("raw_04"),
        semistruct.object_text(obj, "missing").alias("missing"),
    )


def parsed_json(spark, sf_dir):
    """Result rows captured as objects, and a field read from given JSON text."""
    events = table(spark, sf_dir, "events")
    captured = semistruct.row_as_object(events.select("event_type", "user_id"))
    return events.select(
        "event_id",
        semistruct.object_text(F.parse_json("props"), "k").alias("k"),
        semistruct.object_text(captured, "event_type").alias("event_type"),
        F.to_json(F.struct(F.col("event_type").alias("text"))).alias("body"),
    )


def try_parse(spark, sf_dir):
    """Numbers, dates, times and timestamps from text that is right, odd or wrong."""
    c, ts = F.col, F.col("ts")
    number = (
        F.when(c("event_type") == "click", c("value").cast("decimal(18,2)").cast("string"))
        .when(c("event_type") == "view", F.concat(F.lit("-"), c("value").cast("decimal(18,2)").cast("string")))
        .when(c("event_type") == "error", "")
        .when(c("event_type") == "signup", F.concat(c("user_id").cast("string"), F.lit("x")))
        .otherwise(F.concat(F.lit(" "), c("user_id").cast("string"), F.lit(" ")))
    )
    slashed = F.date_format(ts, "yyyy/MM/dd HH:mm:ss")
    stamp = F.when(c("event_type") == "view", F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise(slashed)
    day = F.when(c("event_type") == "view", F.concat(F.lit("2024/13/"), F.lit("01"))).otherwise(
        F.date_format(ts, "yyyy/MM/dd")
    )
    clock = F.when(c("event_type") == "view", "24:00:00").otherwise(F.date_format(ts, "HH:mm:ss"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        parse_number(number).alias("whole"),
        parse_number(number, 18, 1).alias("tenth"),
        parse_number(number, 2, 0).alias("narrow"),
        parse_timestamp(stamp).alias("stamp"),
        parse_date(day).alias("day"),
        parse_time_text(clock).alias("clock"),
        null_tokens(number, ["", "NULL"]).alias("cleaned"),
        dash_date(F.when(c("event_type") != "view", F.date_format(ts, "yyyyMMdd"))).alias("dashed"),
    )


def dataset_paths(spark, sf_dir):
    """Active datasets with defaults and composed locations."""
    active = config.active_datasets(shapes.dataset_config(spark, sf_dir))
    full = config.recovery_path(F.col("stage"), F.col("subpath"), F.concat(F.lit("//"), "dataset", F.lit(".csv")))
    return active.withColumn("file_path", full)


def text_functions(spark, sf_dir):
    """The text functions of the load scripts over page addresses and whole texts."""
    pages = table(spark, sf_dir, "pages")
    url = F.col("url")
    return pages.select(
        "page_id",
        base_name(url).alias("base"),
        F.regexp_replace(url, "^.*/", "").alias("tail"),
        F.split_part(url, F.lit("/"), F.lit(3)).alias("host"),
        F.split_part(url, F.lit("/"), F.lit(9)).alias("beyond"),
        F.position(F.lit("example"), url).alias("at"),
        F.upper(F.substring(url, 1, 4)).alias("scheme"),
        F.left("html", F.lit(runlog.ERROR_CHARS)).alias("head"),
        F.length("html").alias("n_chars"),
        F.greatest(F.length("html") - 1000, F.lit(0)).alias("beyond_1000"),
        F.replace(url, F.lit('"'), F.lit('""')).alias("quoted"),
        F.lower("url").alias("lowered"),
        F.concat(F.lit("a"), F.char(F.lit(10)), F.col("page_id").cast("string")).alias("two_lines"),
        runlog.recovery_pattern(url, F.lit(".example.")).alias("after_host"),
    )


def headings(spark, sf_dir):
    """Columns under report headings with spaces and symbols."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("CL"),
        F.col("p_brand").alias("CustomerPart#"),
        F.col("p_type").alias("進捗率[%]"),
        F.col("p_name").alias("ラインNo."),
    ).select(*[qcol(c) for c in ("CL", "CustomerPart#", "進捗率[%]", "ラインNo.")])


QUERIES = {
    f.__name__: f
    for f in (
        open_schedule,
        last_schedule_line,
        partner_fallback,
        partner_three_roles,
        name_lookup,
        flow_hop,
        transformed_key_join,
        recent_changes,
        delivery_change_report,
        so_po_combination,
        delivery_change_report_unique,
        delivery_change_report_recent,
        recent_changes_stored,
        change_report_kept_up,
        so_po_combination_unique,
        latest_per_key,
        outcome_flags,
        error_log,
        recovery_queue,
        queue_outcomes,
        error_digest,
        error_digest_short,
        error_digest_all,
        warning_message,
        load_status,
        event_upsert,
        defect_upsert,
        insert_new,
        surrogate_key,
        unpivot_numeric,
        object_fields,
        parsed_json,
        try_parse,
        dataset_paths,
        text_functions,
        headings,
    )
}
