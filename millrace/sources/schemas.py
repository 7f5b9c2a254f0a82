"""Column lists of the declared tables.

Fixed values: names, order and types must equal those of the files and tables in use.
A time of day is kept as checked ``HH:mm:ss`` text and marked by ``TIME``.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
STAMP = T.TimestampNTZType()
DAY = T.DateType()
TIME = "time"


def num(precision: int = 38, scale: int = 0) -> T.DecimalType:
    return T.DecimalType(precision, scale)


# the fields every production record starts with, in file order
PRODUCTION_FIELDS = [
    ("時刻", STAMP),
    ("Nコード", TEXT),
    ("ラインNo.", TEXT),
    ("0:生産開始/1:定時/2：一時停止/3:生産終了/4:定時終了", num(1)),
    ("T投入数[個]", num(18)),
    ("T生産数[個]", num(18)),
    ("T梱包数[個]", num(18)),
    ("現在計画数[個]", num(18)),
    ("進捗率[%]", num(18, 1)),
    ("T計画数[個]", num(18)),
    ("計画ﾏｼﾝﾀｸﾄ[10ms]", num(18)),
    ("平均ﾀｸﾄ[10ms]", num(18)),
    ("T不良数[個]", num(18)),
    ("T不良率ppm", num(18)),
]
FIELD_KEYS = [name for name, _ in PRODUCTION_FIELDS]

# positional defect columns that follow the fields in the wide production file
DEFECT_COLUMNS = 46
DEFECT_KEYS = [f"T不良_{n:02d}" for n in range(1, DEFECT_COLUMNS + 1)]
WIDE_KEYS = FIELD_KEYS + DEFECT_KEYS

_COLUMNS = {
    "PROD_LOG": PRODUCTION_FIELDS
    + [
        (name, num(18))
        for name in (
            "T不良1_短絡不良",
            "T不良2_短絡1不良",
            "T不良3_短絡2不良",
            "T不良4_導通不良",
            "T不良5_機器不良",
            "T不良6_平坦度1不良",
            "T不良7_ﾋﾟｯﾁ1不良",
            "T不良8_平坦度2不良",
            "T不良9_ﾋﾟｯﾁ2不良",
            "T不良10_予備",
        )
    ],
    "MC_LOG": [
        ("DATA No.", TEXT),
        ("DATE", DAY),
        ("TIME", TIME),
        ("Nコード", TEXT),
        ("ロットトレースNo.", TEXT),
        ("製造指示書No.", TEXT),
        ("ラインNo.", TEXT),
        ("CAM3ﾜｰｸ有無", TEXT),
    ]
    + [
        (name, num(18, 3))
        for name in (
            "信号端子平坦度1MAX[μm]",
            "電源端子平坦度1-1[μm]",
            "電源端子平坦度1-2[μm]",
            "金具平坦度1-1[μm]",
            "金具平坦度1-2[μm]",
            "信号端子平坦度2MAX[μm]",
            "電源端子平坦度2-1[μm]",
            "電源端子平坦度2-2[μm]",
            "金具平坦度2-1[μm]",
            "金具平坦度2-2[μm]",
            "金具ｷﾞｬｯﾌﾟ1[㎜]",
            "金具ｷﾞｬｯﾌﾟ2[㎜]",
            "信号端子ﾄｰﾀﾙﾋﾟｯﾁ1[㎜]",
            "信号電源端子ﾋﾟｯﾁ1-1[㎜]",
            "信号電源端子ﾋﾟｯﾁ1-2[㎜]",
            "信号端子ﾄｰﾀﾙﾋﾟｯﾁ2[㎜]",
            "信号電源端子ﾋﾟｯﾁ2-1[㎜]",
            "信号電源端子ﾋﾟｯﾁ2-2[㎜]",
            "金具ﾋﾟｯﾁ1[㎜]",
            "金具ﾋﾟｯﾁ2[㎜]",
            "爪傷L[単位無]",
            "爪傷R[単位無]",
        )
    ],
    "REEL_LOG": [
        ("時刻", STAMP),
        ("Nコード", TEXT),
        ("ロットトレースNo.", TEXT),
        ("製造指示書No.", TEXT),
        ("ラインNo.", TEXT),
        ("製品名", TEXT),
        ("計画ﾏｼﾝﾀｸﾄ", num()),
        ("梱包開始時間", TIME),
        ("梱包終了時間", TIME),
    ]
    + [
        (name, num())
        for name in (
            "R計画数",
            "R投入数",
            "R生産数",
            "R梱包数",
            "R不良数",
            "短絡R不良数",
            "短絡1R不良数",
            "短絡2R不良数",
            "導通R不良数",
            "機器R不良数",
            "平坦度1R不良数",
            "ﾋﾟｯﾁ1R不良数",
            "平坦度2R不良数",
            "ﾋﾟｯﾁ2R不良数",
            "予備R不良数",
        )
    ],
    "STOP_LOG": [
        ("時刻", STAMP),
        ("Nコード", TEXT),
        ("ラインNo.", TEXT),
        ("0:開始待/1:開始/2:停止/3:再開/4:終了", num(1)),
        ("要因No.", num(3)),
    ],
    "MST_CL_CODE": [
        ("CLコード", TEXT),
        ("VENDER", TEXT),
        ("OTS", TEXT),
        ("PRODUCT", TEXT),
        ("PROGRAM", TEXT),
        ("APN", TEXT),
        ("INTERNAL_PN", TEXT),
        ("BUILD", TEXT),
        ("QC_CATEGORY", TEXT),
        ("CATEGORY", TEXT),
        ("INSPECTION_STEP", TEXT),
        ("INSPECTION_ITEM", TEXT),
        ("USL", num(4)),
        ("LSL", num(4)),
        ("D_NAME", TEXT),
    ],
    "MST_LINE_CL": [
        (name, TEXT)
        for name in ("製造拠点", "設備_PF", "ライン", "製品名", "CLコード", "生産開始日", "生産終了日")
    ],
    "MST_PROCESS_DEFECT": [
        ("RL_LOG項目名", TEXT),
        ("測定SEQ", num(3)),
        ("大項目", TEXT),
        ("中項目", TEXT),
        ("小項目", TEXT),
        ("上限値", num(3)),
        ("下限値", num(3)),
        ("USL", num(3)),
        ("LSL", num(3)),
        ("データタイプ", TEXT),
    ],
    "MST_STOP_FACTOR": [("要因No.", num()), ("停止要因項目", TEXT)],
    "PROD_LOG_FH_RAW": [
        ("source_file_path", TEXT),
        ("source_row_number", num()),
        ("raw_obj", T.MapType(TEXT, TEXT)),
        ("loaded_at", STAMP),
    ],
    "PROD_LOG_FH": [("event_id", TEXT), ("source_file_path", TEXT), ("source_row_number", num())]
    + PRODUCTION_FIELDS
    + [("created_at", STAMP), ("updated_at", STAMP)],
    "PROD_LOG_FH_DEFECT": [
        ("event_id", TEXT),
        ("source_file_path", TEXT),
        ("source_row_number", num()),
        ("defect_name", TEXT),
        ("defect_value", num(18)),
        ("defect_value_raw", TEXT),
        ("created_at", STAMP),
        ("updated_at", STAMP),
    ],
    "OPS_DATASET_CONFIG": [
        (name, TEXT)
        for name in ("system", "dataset", "stage", "subpath", "target_table", "file_format", "on_error")
    ]
    + [("is_active", T.BooleanType())],
    "OPS_RUN_LOG": [
        ("run_at", STAMP),
        ("system", TEXT),
        ("dataset", TEXT),
        ("target_table", TEXT),
        ("file_path", TEXT),
        ("file_name", TEXT),
        ("status", TEXT),
        ("errors_seen", T.LongType()),
        ("first_error_message", TEXT),
        ("error_flag", T.BooleanType()),
        ("raw", T.VariantType()),
    ],
    "OPS_RECOVERY_QUEUE": [
        ("queue_id", TEXT),
        ("system", TEXT),
        ("dataset", TEXT),
        ("pattern", TEXT),
        ("force", T.BooleanType()),
        ("status", TEXT),
        ("note", TEXT),
        ("created_at", STAMP),
        ("enq_at", STAMP),
    ],
    # per file, its newest failure and its newest load; and the run-log batches it was made of
    "OPS_RECOVERY_STATE": [("system", TEXT), ("dataset", TEXT), ("file_path", TEXT), ("failed_at", STAMP), ("loaded_at", STAMP)],
    "OPS_RECOVERY_SEEN": [("batch", TEXT)],
    # the change report as it is kept up, under the names its plan uses
    "DELIVERY_CHANGE_REPORT": [
        (name, DAY if name in ("udate", "req_dlvdate", "edatu") else TEXT)
        for name in (
            "vbeln", "posnr", "sold_to_bp", "sold_to_name", "bstkd_ana", "pic2_name", "pic2_country", "matnr", "berid",
            "arktx", "kdmat", "udate", "req_dlvdate", "edatu", "current_mad", "previous_mad", "po_vbeln", "po_posnv",
        )
    ],
    # what was read from each file, once per load; also the record of files already loaded
    "LOAD_HISTORY": [
        ("target_table", TEXT),
        ("file", TEXT),
        ("file_size", T.LongType()),
        ("file_modified_at", T.TimestampType()),
        ("status", TEXT),
        ("rows_parsed", T.LongType()),
        ("rows_loaded", T.LongType()),
        ("errors_seen", T.LongType()),
        ("first_error", TEXT),
        ("first_error_line", T.LongType()),
        ("first_error_character", T.LongType()),
        ("first_error_column_name", TEXT),
        ("loaded_at", STAMP),
    ],
}
_COLUMNS["OPS_ERROR_LOG"] = _COLUMNS["OPS_RUN_LOG"]

# tables that files are loaded into
LOADABLE = (
    "PROD_LOG",
    "MC_LOG",
    "REEL_LOG",
    "STOP_LOG",
    "MST_CL_CODE",
    "MST_LINE_CL",
    "MST_PROCESS_DEFECT",
    "MST_STOP_FACTOR",
)


def columns(table: str) -> list[tuple[str, object]]:
    return list(_COLUMNS[table])


def known(table: str) -> bool:
    return table in _COLUMNS


def schema(table: str) -> T.StructType:
    """Stored schema; a time of day is stored as text."""
    return T.StructType(
        [T.StructField(name, TEXT if kind == TIME else kind) for name, kind in _COLUMNS[table]]
    )
