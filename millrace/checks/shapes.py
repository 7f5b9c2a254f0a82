"""Sales-document and log tables derived in full from the given Parquet tables.

Nothing is sampled: every row of a given table takes part. The matching SQL is in
``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace import session
from millrace.operators import hotkeys, lookup
from millrace.sources import sales

CLIENT = "900"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pad(c: Column | str, width: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.lpad(c.cast("string"), width, "0")


def line_client() -> Column:
    return F.when(F.col("l_tax") > 0.065, "420").otherwise(CLIENT)


def line_keys() -> list[Column]:
    return [
        line_client().alias("mandt"),
        pad("l_orderkey", 10).alias("vbeln"),
        pad(F.col("l_linenumber") * 10, 6).alias("posnr"),
    ]


def schedule_line() -> Column:
    return pad(F.col("l_quantity").cast("int"), 4)


def purchase_order() -> Column:
    return F.concat(F.lit("45"), pad("l_orderkey", 8))


def vbep(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("decimal(12,2)")
    shipped = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        *line_keys(),
        schedule_line().alias("etenr"),
        quantity.alias("wmeng"),
        F.when(F.col("l_linestatus") == "F", quantity).otherwise(0).cast("decimal(12,2)").alias("dlvqty_su"),
        shipped.alias("edatu"),
        F.date_add(shipped, -2).alias("mbdat"),
        F.date_add(shipped, -1).alias("wadat"),
        F.date_add(shipped, 7).alias("req_dlvdate"),
    )


def vbap(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type", "p_size"
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(part, "l_partkey", "left")
        .select(
            *line_keys(),
            pad("l_partkey", 18).alias("matnr"),
            F.col("p_name").alias("arktx"),
            F.col("p_brand").alias("kdmat"),
            F.concat(F.lit("REF"), F.col("l_suppkey").cast("string")).alias("bstkd_ana"),
            F.col("l_returnflag").alias("berid"),
            F.col("p_type").alias("zzsection"),
            F.col("l_linestatus").alias("vkorg_ana"),
            F.col("l_shipdate").cast("date").alias("erdat"),
            pad(F.col("l_suppkey"), 4).alias("lgort"),
            F.col("p_size").cast("decimal(9,0)").alias("umziz"),
        )
    )


def vbpa(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    wanted = F.array(
        F.lit("AG"),
        F.when(F.col("o_orderstatus") != "F", "WE"),
        F.when(F.col("o_orderpriority") != "5-LOW", "ZR"),
        F.when(F.col("o_orderpriority") != "1-URGENT", "ZI"),
    )
    headers = orders.select(
        F.when(F.col("o_totalprice") > 400000, "420").otherwise(CLIENT).alias("mandt"),
        pad("o_orderkey", 10).alias("vbeln"),
        F.lit("000000").alias("posnr"),
        F.explode(wanted).alias("parvw"),
        F.concat(F.lit("C"), pad("o_custkey", 9)).alias("assigned_bp"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("adrnr"),
        F.substring("o_orderpriority", 1, 1).alias("land1"),
    ).where(F.col("parvw").isNotNull())
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    role = (
        F.when(flag == "R", "AG").when(flag == "A", "WE").when(status == "O", "ZR").otherwise("ZI")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        *line_keys(),
        role.alias("parvw"),
        F.concat(F.lit("S"), pad("l_suppkey", 9)).alias("assigned_bp"),
        F.when(F.col("l_discount") > 0, F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("adrnr"),
        status.alias("land1"),
    )
    return headers.unionByName(lines)


def adrc(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("addrnumber"),
        F.col("c_name").alias("name"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("addrnumber"),
        F.col("s_name").alias("name"),
    )
    return (
        customer.unionByName(supplier)
        .withColumn("client", F.explode(F.array(F.lit(CLIENT), F.lit("420"))))
        .select("client", "addrnumber", F.concat("client", F.lit("-"), "name").alias("name1"))
    )


def vbfa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        line_client().alias("mandt"),
        pad("l_orderkey", 10).alias("vbelv"),
        pad(F.col("l_linenumber") * 10, 6).alias("posnv"),
        purchase_order().alias("vbeln"),
        pad(F.col("l_linenumber") * 10, 6).alias("posnn"),
        F.lit("C").alias("vbtyp_v"),
        F.when(F.col("l_linestatus") == "F", "V").otherwise("J").alias("vbtyp_n"),
    )


def ekes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        purchase_order().alias("ebeln"),
        pad(F.col("l_linenumber") * 10, 5).alias("ebelp"),
        F.when(F.col("l_returnflag") == "R", "AB").otherwise("LA").alias("ebtyp"),
        F.date_add(F.col("l_shipdate").cast("date"), 3).alias("eindt"),
    )


def eket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        purchase_order().alias("ebeln"),
        pad(F.col("l_linenumber") * 10, 5).alias("ebelp"),
        F.when(F.col("l_linestatus") == "O", "0001").otherwise("0002").alias("etenr"),
        F.date_add(F.col("l_shipdate").cast("date"), 5).alias("eindt"),
    )


def cdhdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.lit(CLIENT).alias("mandant"),
        F.when(F.col("o_orderstatus") != "P", "VERKBELEG").otherwise("EINKBELEG").alias("objectclas"),
        pad("o_orderkey", 12).alias("changenr"),
        pad("o_orderkey", 10).alias("objectid"),
        F.col("o_orderdate").cast("date").alias("udate"),
    )


def cdpos(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = F.col("l_shipdate").cast("date")
    keys = line_keys()
    return table(spark, sf_dir, "lineitem").select(
        pad("l_orderkey", 12).alias("changenr"),
        pad("l_orderkey", 10).alias("objectid"),
        F.lit("VBEP").alias("tabname"),
        F.when(F.col("l_returnflag") == "A", "WMENG").otherwise("EDATU").alias("fname"),
        F.concat(*keys, schedule_line()).alias("tabkey"),
        F.when(F.col("l_discount") > 0, F.date_format(shipped, "yyyyMMdd")).alias("value_old"),
        F.date_format(F.date_add(shipped, 30), "yyyyMMdd").alias("value_new"),
    )


def erp_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    makers = (vbep, vbap, vbpa, adrc, vbfa, ekes, eket, cdhdr, cdpos)
    return {make.__name__: make(spark, sf_dir) for make in makers}


def hot_keys(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    """Documents and purchase orders of very many rows, from sketches made as a load of the tables makes them.

    Items, flow, change items and purchase-order lines have one row per line item, as schedule
    lines and confirmations do; one sketch stands for all of them.
    """
    path = session.scratch_path(spark, "sketches")
    tables = {make.__name__: make(spark, sf_dir) for make in (vbep, vbpa, ekes)}
    hotkeys.save_sketches(tables, {name: sales.SKETCHED[name] for name in tables}, path)
    return hotkeys.read_hot_keys(spark, path)


def unique_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same tables with one row per primary key, as an ERP system keeps them."""
    tables = erp_tables(spark, sf_dir)
    return {**tables, **{name: lookup.least_row(tables[name], keys) for name, keys in PRIMARY_KEYS.items()}}


PRIMARY_KEYS = {
    "vbap": ["mandt", "vbeln", "posnr"],
    "vbpa": ["mandt", "vbeln", "posnr", "parvw"],
    "vbep": ["mandt", "vbeln", "posnr", "etenr"],
    "eket": ["ebeln", "ebelp", "etenr"],
}


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as the outcome of loading one file; users' files fail repeatedly."""
    kind = F.col("event_type")
    status = (
        F.when(kind == "error", "LOAD_FAILED")
        .when(kind == "signup", "VALIDATION_ERROR")
        .when(kind == "view", F.lit(None))
        .otherwise("LOADED")
    )
    errors = F.when(kind == "purchase", F.floor(F.col("value")).cast("int")).when(kind == "click", 0)
    path = F.concat(
        F.lit("@STAGE/recv/"), kind, F.lit("/u"), F.col("user_id").cast("string"), F.lit(".csv")
    )
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp_ntz").alias("run_at"),
        F.lit("IOT").alias("system"),
        kind.alias("dataset"),
        F.when(F.col("value") > 1, path).alias("file_path"),
        path.alias("file"),
        status.alias("status"),
        errors.alias("errors_seen"),
        F.when(F.col("value") > 2, F.concat(F.lit("bad value "), F.col("props"))).alias("first_error"),
        F.when(F.col("value") > 5, F.col("event_id")).alias("first_error_line"),
        F.when(F.col("value") > 9, F.col("user_id")).alias("first_error_character"),
        "event_id",
        "user_id",
    )


def dataset_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as one dataset row, with all spellings of stage and folder."""
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("system"),
        F.concat(F.col("p_name"), F.lit("#"), F.col("p_partkey").cast("string")).alias("dataset"),
        F.when(size > 25, F.concat(F.lit("@"), F.col("p_type"))).otherwise(F.col("p_type")).alias("stage"),
        F.when(size > 40, F.lit(None))
        .when(size > 30, "")
        .when(size > 15, F.concat(F.lit("/"), F.col("p_name")))
        .otherwise(F.col("p_name"))
        .alias("subpath"),
        F.concat(F.lit("DB.RAW."), F.col("p_type")).alias("target_table"),
        F.when(size > 10, "MST_CSV_FORMAT").alias("file_format"),
        F.when(size > 20, "ABORT_STATEMENT").alias("on_error"),
        (size > 5).alias("is_active"),
    )
