"""SQL that must give the same rows as ``queries.py``, written for DuckDB."""

from __future__ import annotations

_CLIENT = "CASE WHEN l_tax > 0.065 THEN '420' ELSE '900' END"
_DOC = "lpad(l_orderkey::VARCHAR, 10, '0')"
_ITEM = "lpad((l_linenumber * 10)::VARCHAR, 6, '0')"
_LINE = "lpad(l_quantity::INT::VARCHAR, 4, '0')"
_PO = "'45' || lpad(l_orderkey::VARCHAR, 8, '0')"
_PO_ITEM = "lpad((l_linenumber * 10)::VARCHAR, 5, '0')"

_TABLES = {
    "vbep": f"""
        SELECT {_CLIENT} AS mandt, {_DOC} AS vbeln, {_ITEM} AS posnr, {_LINE} AS etenr,
               l_quantity::DECIMAL(12,2) AS wmeng,
               CASE WHEN l_linestatus = 'F' THEN l_quantity::DECIMAL(12,2) ELSE 0 END AS dlvqty_su,
               l_shipdate::DATE AS edatu, l_shipdate::DATE - 2 AS mbdat,
               l_shipdate::DATE - 1 AS wadat, l_shipdate::DATE + 7 AS req_dlvdate
        FROM lineitem""",
    "vbap": f"""
        SELECT {_CLIENT} AS mandt, {_DOC} AS vbeln, {_ITEM} AS posnr,
               lpad(l_partkey::VARCHAR, 18, '0') AS matnr, p_name AS arktx, p_brand AS kdmat,
               'REF' || l_suppkey AS bstkd_ana, l_returnflag AS berid, p_type AS zzsection,
               l_linestatus AS vkorg_ana, l_shipdate::DATE AS erdat,
               lpad(l_suppkey::VARCHAR, 4, '0') AS lgort, p_size::DECIMAL(9,0) AS umziz
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "vbpa": f"""
        SELECT CASE WHEN o_totalprice > 400000 THEN '420' ELSE '900' END AS mandt,
               lpad(o_orderkey::VARCHAR, 10, '0') AS vbeln, '000000' AS posnr, r.parvw,
               'C' || lpad(o_custkey::VARCHAR, 9, '0') AS assigned_bp, 'C' || o_custkey AS adrnr,
               o_orderpriority[1:1] AS land1
        FROM orders CROSS JOIN (VALUES ('AG'), ('WE'), ('ZR'), ('ZI')) r(parvw)
        WHERE r.parvw = 'AG' OR (r.parvw = 'WE' AND o_orderstatus <> 'F')
           OR (r.parvw = 'ZR' AND o_orderpriority <> '5-LOW')
           OR (r.parvw = 'ZI' AND o_orderpriority <> '1-URGENT')
        UNION ALL
        SELECT {_CLIENT}, {_DOC}, {_ITEM},
               CASE WHEN l_returnflag = 'R' THEN 'AG' WHEN l_returnflag = 'A' THEN 'WE'
                    WHEN l_linestatus = 'O' THEN 'ZR' ELSE 'ZI' END,
               'S' || lpad(l_suppkey::VARCHAR, 9, '0'),
               CASE WHEN l_discount > 0 THEN 'S' || l_suppkey END, l_linestatus
        FROM lineitem""",
    "adrc": """
        SELECT client, addrnumber, client || '-' || name AS name1
        FROM (SELECT 'C' || c_custkey AS addrnumber, c_name AS name FROM customer
              UNION ALL SELECT 'S' || s_suppkey, s_name FROM supplier)
        CROSS JOIN (VALUES ('900'), ('420')) c(client)""",
    "vbfa": f"""
        SELECT {_CLIENT} AS mandt, {_DOC} AS vbelv, {_ITEM} AS posnv, {_PO} AS vbeln, {_ITEM} AS posnn,
               'C' AS vbtyp_v, CASE WHEN l_linestatus = 'F' THEN 'V' ELSE 'J' END AS vbtyp_n
        FROM lineitem""",
    "ekes": f"""
        SELECT {_PO} AS ebeln, {_PO_ITEM} AS ebelp,
               CASE WHEN l_returnflag = 'R' THEN 'AB' ELSE 'LA' END AS ebtyp,
               l_shipdate::DATE + 3 AS eindt
        FROM lineitem""",
    "eket": f"""
        SELECT {_PO} AS ebeln, {_PO_ITEM} AS ebelp,
               CASE WHEN l_linestatus = 'O' THEN '0001' ELSE '0002' END AS etenr,
               l_shipdate::DATE + 5 AS eindt
        FROM lineitem""",
    "cdhdr": """
        SELECT '900' AS mandant, CASE WHEN o_orderstatus <> 'P' THEN 'VERKBELEG' ELSE 'EINKBELEG' END AS objectclas,
               lpad(o_orderkey::VARCHAR, 12, '0') AS changenr, lpad(o_orderkey::VARCHAR, 10, '0') AS objectid,
               o_orderdate::DATE AS udate
        FROM orders""",
    "cdpos": f"""
        SELECT lpad(l_orderkey::VARCHAR, 12, '0') AS changenr, {_DOC} AS objectid, 'VBEP' AS tabname,
               CASE WHEN l_returnflag = 'A' THEN 'WMENG' ELSE 'EDATU' END AS fname,
               {_CLIENT} || {_DOC} || {_ITEM} || {_LINE} AS tabkey,
               CASE WHEN l_discount > 0 THEN strftime(l_shipdate, '%Y%m%d') END AS value_old,
               strftime(l_shipdate + INTERVAL 30 DAY, '%Y%m%d') AS value_new
        FROM lineitem""",
    "run_log": """
        SELECT ts AS run_at, 'IOT' AS system, event_type AS dataset,
               CASE WHEN value > 1 THEN '@STAGE/recv/' || event_type || '/u' || user_id || '.csv' END AS file_path,
               '@STAGE/recv/' || event_type || '/u' || user_id || '.csv' AS file,
               CASE event_type WHEN 'error' THEN 'LOAD_FAILED' WHEN 'signup' THEN 'VALIDATION_ERROR'
                    WHEN 'view' THEN NULL ELSE 'LOADED' END AS status,
               CASE event_type WHEN 'purchase' THEN floor(value)::INT WHEN 'click' THEN 0 END AS errors_seen,
               CASE WHEN value > 2 THEN 'bad value ' || props END AS first_error,
               CASE WHEN value > 5 THEN event_id END AS first_error_line,
               CASE WHEN value > 9 THEN user_id END AS first_error_character,
               event_id, user_id
        FROM events""",
    "flagged": """
        SELECT *, coalesce(errors_seen, CASE WHEN coalesce(status, '') NOT IN ('', 'LOADED') THEN 1 ELSE 0 END) > 0
                  OR coalesce(status, '') NOT IN ('', 'LOADED') AS error_flag
        FROM run_log""",
    "cfg": """
        SELECT p_brand AS system, p_name || '#' || p_partkey AS dataset,
               CASE WHEN p_size > 25 THEN '@' ELSE '' END || p_type AS stage,
               CASE WHEN p_size > 40 THEN NULL WHEN p_size > 30 THEN '' WHEN p_size > 15 THEN '/' || p_name
                    ELSE p_name END AS subpath,
               'DB.RAW.' || p_type AS target_table,
               CASE WHEN p_size > 10 THEN 'MST_CSV_FORMAT' END AS file_format,
               CASE WHEN p_size > 20 THEN 'ABORT_STATEMENT' END AS on_error,
               p_size > 5 AS is_active
        FROM part""",
}


def _unique(name: str, keys: str, rest: str) -> str:
    """One row per key: the least of the remaining columns, taken together."""
    first = ", ".join(f"{c} NULLS FIRST" for c in rest.split(", "))
    return f"""SELECT * FROM ({_TABLES[name]})
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {first}) = 1"""


_UNIQUE = {
    "vbap": _unique(
        "vbap",
        "mandt, vbeln, posnr",
        "matnr, arktx, kdmat, bstkd_ana, berid, zzsection, vkorg_ana, erdat, lgort, umziz",
    ),
    "vbpa": _unique("vbpa", "mandt, vbeln, posnr, parvw", "assigned_bp, adrnr, land1"),
    "vbep": _unique(
        "vbep", "mandt, vbeln, posnr, etenr", "wmeng, dlvqty_su, edatu, mbdat, wadat, req_dlvdate"
    ),
    "eket": _unique("eket", "ebeln, ebelp, etenr", "eindt"),
}
_NEEDS = {"flagged": ["run_log"]}


def _with(names: str, body: str, tables: dict[str, str] = _TABLES) -> str:
    wanted: list[str] = []
    for name in names.split():
        wanted += [n for n in (*_NEEDS.get(name, []), name) if n not in wanted]
    return "WITH " + ",\n".join(f"{n} AS ({tables[n]})" for n in wanted) + body


def _partner(role: str, prefix: str, document: list[str]) -> str:
    """Left joins giving ``{prefix}l`` and ``{prefix}h`` to the row source ``i``."""

    def same(a: str, b: str) -> str:
        return " AND ".join(f"{a}.{c} = {b}.{c}" for c in document)

    l, h, v = prefix + "l", prefix + "h", prefix + "v"
    return f"""
        LEFT JOIN vbpa {l} ON {same('i', l)} AND i.posnr = {l}.posnr AND {l}.parvw = '{role}'
             AND {l}.posnr <> '000000'
        LEFT JOIN (SELECT {', '.join(document)}, bool_or(posnr <> '000000') AS own FROM vbpa WHERE parvw = '{role}'
                   GROUP BY {', '.join(document)}) {v} ON {same('i', v)}
        LEFT JOIN vbpa {h} ON {same('i', h)} AND {h}.parvw = '{role}' AND {h}.posnr = '000000' AND NOT {v}.own"""


def _pick(prefix: str, column: str, alias: str) -> str:
    return f"coalesce({prefix}l.{column}, {prefix}h.{column}) AS {alias}"


def _picks(pic: str) -> str:
    return ", ".join(
        [
            _pick("ag", "assigned_bp", "sold_to_bp"),
            _pick("ag", "adrnr", "sold_to_addr"),
            _pick("we", "assigned_bp", "ship_to_bp"),
            _pick("we", "adrnr", "ship_to_addr"),
            _pick(pic, "assigned_bp", "pic2_bp"),
            _pick(pic, "adrnr", "pic2_addr"),
            _pick(pic, "land1", "pic2_country"),
        ]
    )


_OPEN = """
    SELECT mandt, vbeln, posnr, sum(wmeng) AS soqty, sum(dlvqty_su) AS dlvqty,
           sum(wmeng) - sum(dlvqty_su) AS openqty, max(etenr) AS max_line
    FROM vbep GROUP BY ALL HAVING openqty > 0"""


def _digest(groups: str, files: str) -> str:
    """Digest over ``run_log`` rows; ``files`` limits which entries are listed."""
    part = f"PARTITION BY {groups}" if groups else ""
    by = f"GROUP BY {groups}" if groups else ""
    pick = f"{groups}, " if groups else ""
    return _with(
        "run_log",
        f"""
        , entries AS (
          SELECT *, CASE WHEN entry IS NOT NULL THEN
                 row_number() OVER ({part} ORDER BY entry IS NULL, errors_seen > 0 DESC, file, entry) END AS n
          FROM (SELECT *, CASE WHEN errors_seen > 0 THEN regexp_replace(file, '^.*/', '')
                       || ' (line=' || coalesce(first_error_line::VARCHAR, 'NULL')
                       || ', char=' || coalesce(first_error_character::VARCHAR, 'NULL') || ') : '
                       || left(first_error, 180) END AS entry
                FROM run_log)),
        sums AS (
          SELECT {pick} count(*) FILTER (WHERE errors_seen > 0) AS files, coalesce(sum(errors_seen), 0)::BIGINT AS rws,
                 coalesce(string_agg(entry, chr(10) ORDER BY file, entry) FILTER (WHERE {files}), '') AS txt
          FROM entries {by})
        SELECT {pick} files AS error_file_count, rws AS error_row_count,
               CASE WHEN files > 0 THEN left(txt || CASE WHEN files > 5 THEN chr(10) || '(+ ' || (files - 5) || ' more files...)'
                                              ELSE '' END, 2500) END AS error_sample
        FROM sums""",
    )


_CHANGE_TABLES = "cdhdr cdpos vbap vbpa vbep vbfa adrc"
_CHANGES = f"""
        , changes AS (
          SELECT h.objectid AS vbeln, p.tabkey[14:19] AS posnr, p.tabkey[20:23] AS etenr, h.udate,
                 p.value_old AS vo, p.value_new AS vn
          FROM cdhdr h JOIN cdpos p USING (changenr, objectid)
          WHERE h.objectclas = 'VERKBELEG' AND h.mandant = '900' AND p.fname = 'EDATU'
            AND h.udate >= DATE '2001-08-01' - 4000),
        i AS (
          SELECT c.*, v.matnr, v.arktx, v.kdmat, v.bstkd_ana, v.berid
          FROM changes c LEFT JOIN vbap v ON v.vbeln = c.vbeln AND v.posnr = c.posnr),
        partners AS (
          SELECT i.*, {_picks('zr')}
          FROM i {_partner('AG', 'ag', ['vbeln'])} {_partner('WE', 'we', ['vbeln'])} {_partner('ZR', 'zr', ['vbeln'])}),
        named AS (
          SELECT DISTINCT p.* EXCLUDE (vo, vn, ship_to_bp, ship_to_addr), vo, vn, a.name1 AS sold_to_name, c.name1 AS pic2_name
          FROM partners p
          LEFT JOIN adrc a ON a.addrnumber = p.sold_to_addr AND a.client = '900'
          LEFT JOIN adrc b ON b.addrnumber = p.ship_to_addr AND b.client = '900'
          LEFT JOIN adrc c ON c.addrnumber = p.pic2_addr AND c.client = '900')
        SELECT DISTINCT n.vbeln AS "Sales Doc No", n.posnr AS "Sales Line No", n.sold_to_bp AS "Sold to CD",
               n.sold_to_name AS "Sold to name", n.bstkd_ana AS "Customer Ref No", n.pic2_name AS "PIC2 Name",
               n.pic2_country AS "PIC2 Branch", n.matnr AS "CL", n.berid AS "Sales Org", n.arktx AS "Description",
               n.kdmat AS "CustomerPart#", n.udate AS "Updated Date", s.req_dlvdate AS "Org Req Date",
               s.edatu AS "Current Delivery Date",
               vn[1:4] || '-' || vn[5:6] || '-' || vn[7:8] AS "Current MAD",
               vo[1:4] || '-' || vo[5:6] || '-' || vo[7:8] AS "Previous MAD",
               f.vbeln AS "Connected PO", f.posnv AS "Connected PO Item"
        FROM named n
        LEFT JOIN vbep s ON s.vbeln = n.vbeln AND s.posnr = n.posnr AND s.etenr = n.etenr
        JOIN vbfa f ON f.vbelv = n.vbeln AND f.posnv = n.posnr
        WHERE f.vbtyp_n = 'V' AND f.vbtyp_v = 'C'"""
_COMBINATION_TABLES = "vbep vbap vbpa vbfa adrc ekes eket"
_COMBINATION = f"""
        , o AS (SELECT * FROM ({_OPEN}) WHERE mandt = '900'),
        i AS (
          SELECT o.*, s.edatu, s.mbdat, s.wadat, v.* EXCLUDE (mandt, vbeln, posnr, berid)
          FROM o
          LEFT JOIN vbep s ON s.mandt = o.mandt AND s.vbeln = o.vbeln AND s.posnr = o.posnr AND s.etenr = o.max_line
          LEFT JOIN vbap v ON v.mandt = o.mandt AND v.vbeln = o.vbeln AND v.posnr = o.posnr),
        p AS (
          SELECT i.*, {_picks('zi')}
          FROM i {_partner('AG', 'ag', ['mandt', 'vbeln'])} {_partner('WE', 'we', ['mandt', 'vbeln'])}
          {_partner('ZI', 'zi', ['mandt', 'vbeln'])})
        SELECT p.mandt AS "MANDT", p.vbeln AS "Sales Document", p.posnr AS "Sales Document Item",
               soqty::DECIMAL(18,2) AS "SOQTY", dlvqty::DECIMAL(18,2) AS "DLVQTY", openqty::DECIMAL(18,2) AS "OpenQTY",
               max_line AS "MAXschLine", edatu AS "Delivery Date", mbdat AS "Material Avail. Date",
               wadat AS "Goods Issue Date", arktx AS "Item Description", matnr AS "Material", zzsection AS "Section",
               bstkd_ana AS "Customer Reference", kdmat AS "Customer Material Number", vkorg_ana AS "Sales Org",
               erdat AS "Created On", lgort AS "Storage Location", umziz AS "Conversion Factor",
               sold_to_bp AS "SoldToBP", sold_to_addr AS "SoldToBPAddr", ship_to_bp AS "ShipToBP",
               ship_to_addr AS "ShipToBPAddr", pic2_bp AS "PIC2BP", pic2_addr AS "PIC2Addr",
               pic2_country AS "PIC2Country", a.name1 AS "SoldToBPName", b.name1 AS "ShipToBPName",
               c.name1 AS "PIC2BPName", f.vbeln AS "PO Document", f.posnn AS "PO Document Item",
               k.eindt AS "ABDate", t.eindt AS "ReqDate"
        FROM p
        JOIN vbfa f ON f.mandt = p.mandt AND f.vbelv = p.vbeln AND f.posnv = p.posnr
             AND f.vbtyp_v = 'C' AND f.vbtyp_n = 'V'
        LEFT JOIN adrc a ON a.addrnumber = sold_to_addr AND a.client = p.mandt
        LEFT JOIN adrc b ON b.addrnumber = ship_to_addr AND b.client = p.mandt
        LEFT JOIN adrc c ON c.addrnumber = pic2_addr AND c.client = p.mandt
        LEFT JOIN ekes k ON k.ebeln = f.vbeln AND k.ebelp = f.posnn[2:6] AND k.ebtyp = 'AB'
        LEFT JOIN eket t ON t.ebeln = f.vbeln AND t.ebelp = f.posnn[2:6] AND t.etenr = '0001'"""
ORACLE = {
    "open_schedule": _with(
        "vbep",
        f""" SELECT mandt, vbeln, posnr, soqty::DECIMAL(18,2) AS soqty, dlvqty::DECIMAL(18,2) AS dlvqty,
                    openqty::DECIMAL(18,2) AS openqty, max_line FROM ({_OPEN})""",
    ),
    "last_schedule_line": _with(
        "vbep",
        f""" SELECT o.mandt, o.vbeln, o.posnr, o.max_line, v.edatu, v.mbdat, v.wadat
             FROM ({_OPEN}) o LEFT JOIN vbep v
               ON v.mandt = o.mandt AND v.vbeln = o.vbeln AND v.posnr = o.posnr AND v.etenr = o.max_line""",
    ),
    "partner_fallback": _with(
        "vbep vbpa",
        f""" SELECT i.mandt, i.vbeln, i.posnr, {_pick('ag', 'assigned_bp', 'sold_to_bp')},
                    {_pick('ag', 'adrnr', 'sold_to_addr')}
             FROM vbep i {_partner('AG', 'ag', ['mandt', 'vbeln'])}""",
    ),
    "partner_three_roles": _with(
        "vbep vbpa",
        f""" SELECT i.mandt, i.vbeln, i.posnr, {_picks('zr')}
             FROM vbep i {_partner('AG', 'ag', ['mandt', 'vbeln'])}
             {_partner('WE', 'we', ['mandt', 'vbeln'])} {_partner('ZR', 'zr', ['mandt', 'vbeln'])}""",
    ),
    "name_lookup": _with(
        "vbpa adrc",
        """ SELECT p.mandt, p.vbeln, p.posnr, p.adrnr AS first_addr,
                   CASE WHEN p.parvw = 'AG' THEN p.adrnr END AS second_addr,
                   a.name1 AS first_name, b.name1 AS second_name
            FROM vbpa p
            LEFT JOIN adrc a ON a.addrnumber = p.adrnr AND a.client = p.mandt
            LEFT JOIN adrc b ON b.addrnumber = CASE WHEN p.parvw = 'AG' THEN p.adrnr END AND b.client = p.mandt""",
    ),
    "flow_hop": _with(
        "vbep vbfa",
        """ SELECT i.mandt, i.vbeln, i.posnr, f.vbeln AS po_vbeln, f.posnn AS po_posnn
            FROM vbep i LEFT JOIN vbfa f ON f.mandt = i.mandt AND f.vbelv = i.vbeln AND f.posnv = i.posnr
            WHERE f.vbtyp_v = 'C' AND f.vbtyp_n = 'V'""",
    ),
    "transformed_key_join": _with(
        "vbfa eket",
        """ SELECT f.vbeln, f.posnn, f.vbeln AS ebeln, substr(f.posnn, 2, 5) AS ebelp, e.eindt
            FROM vbfa f LEFT JOIN eket e
              ON e.ebeln = f.vbeln AND e.ebelp = substr(f.posnn, 2, 5) AND e.etenr = '0001'""",
    ),
    "recent_changes": _with(
        "cdhdr cdpos",
        """ SELECT DISTINCT h.objectid AS vbeln, p.tabkey[14:19] AS posnr, p.tabkey[20:23] AS etenr, h.udate,
                   p.value_old, p.value_new
            FROM cdhdr h LEFT JOIN cdpos p ON p.changenr = h.changenr AND p.objectid = h.objectid
            WHERE h.objectclas = 'VERKBELEG' AND h.mandant = '900' AND p.tabname = 'VBEP' AND p.fname = 'EDATU'
              AND h.udate >= DATE '2001-07-02'""",
    ),
    "change_report_kept_up": _with(_CHANGE_TABLES, _CHANGES),
    "delivery_change_report": _with(_CHANGE_TABLES, _CHANGES),
    "delivery_change_report_unique": _with(_CHANGE_TABLES, _CHANGES, {**_TABLES, **_UNIQUE}),
    "delivery_change_report_recent": _with(
        _CHANGE_TABLES, _CHANGES.replace("DATE '2001-08-01' - 4000", "DATE '2001-07-02'"), {**_TABLES, **_UNIQUE}
    ),
    "so_po_combination": _with(_COMBINATION_TABLES, _COMBINATION),
    "so_po_combination_unique": _with(_COMBINATION_TABLES, _COMBINATION, {**_TABLES, **_UNIQUE}),
    "latest_per_key": """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "outcome_flags": _with(
        "flagged",
        """ SELECT event_id,
                   coalesce(errors_seen, CASE WHEN coalesce(status, '') NOT IN ('', 'LOADED') THEN 1 ELSE 0 END)::BIGINT AS errors_seen,
                   error_flag, coalesce(upper(status), '?') <> 'LOADED' OR coalesce(errors_seen, 0) > 0 AS recovery_flag
            FROM flagged""",
    ),
    "error_log": _with(
        "flagged",
        """ SELECT run_at, system, dataset, file_path, status, errors_seen, first_error, event_id
            FROM flagged WHERE error_flag""",
    ),
    "recovery_queue": _with(
        "flagged",
        """
        , folders AS (
          SELECT DISTINCT 'IOT' AS system, event_type AS dataset,
                 CASE event_type WHEN 'error' THEN 'recv/error/' WHEN 'signup' THEN 'elsewhere/'
                      WHEN 'purchase' THEN '/recv/purchase' END AS subpath
          FROM events),
        latest AS (
          SELECT e.system, e.dataset,
                 CASE WHEN c.subpath IS NOT NULL AND position(c.subpath IN e.file_path) > 0
                      THEN '/' || substr(e.file_path, position(c.subpath IN e.file_path) + length(c.subpath))
                      ELSE e.file_path END AS pattern
          FROM flagged e LEFT JOIN folders c ON c.system = e.system AND c.dataset = e.dataset
          WHERE e.error_flag AND e.file_path IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY e.system, e.dataset, e.file_path ORDER BY run_at DESC) = 1)
        SELECT sha256(system || '|' || dataset || '|' || pattern) AS queue_id, system, dataset, pattern, TRUE AS force,
               'PENDING' AS status, NULL::VARCHAR AS note, TIMESTAMP '2024-02-01 09:05:00' AS created_at,
               TIMESTAMP '2024-02-01 09:05:00' AS enq_at
        FROM latest""",
    ),
    "queue_outcomes": _with(
        "run_log",
        """
        , r AS (SELECT *, coalesce(upper(status), '?') <> 'LOADED' OR coalesce(errors_seen, 0) > 0 AS bad FROM run_log)
        SELECT user_id AS queue_id, CASE WHEN bool_or(bad) THEN 'ERROR' ELSE 'DONE' END AS status,
               coalesce(max_by(coalesce(first_error, 'LOAD_FAILED'), event_id) FILTER (WHERE bad), 'OK') AS note
        FROM r GROUP BY user_id""",
    ),
    "error_digest": _digest("dataset", "TRUE"),
    "error_digest_short": _digest("user_id", "n <= 5"),
    "error_digest_all": _digest("", "TRUE"),
    "warning_message": f"""
        WITH d AS ({_digest("", "TRUE")}),
        m AS (SELECT concat_ws(chr(10), '```', '[TASK_WARNING]', 'RESULT=SUCCESS_WITH_SKIPPED_FILES', 'TASK=UNKNOWN',
                       'TARGET=DB.RAW.STOP_LOG', 'STAGE=NULL', 'FILE_FORMAT=NULL', 'PATTERN=NULL', 'ON_ERROR=SKIP_FILE',
                       'COPY_QUERY_ID=NULL', 'COPY_STATUS=NULL', 'ERROR_FILE_COUNT=' || error_file_count,
                       'ERROR_ROW_COUNT=' || error_row_count, 'ERROR_SAMPLE=', coalesce(error_sample, '(none)'),
                       '```') AS message FROM d)
        SELECT message, json_object('text', message)::VARCHAR AS body FROM m""",
    "load_status": _with(
        "run_log",
        """ SELECT min(status) AS status, count(*) FILTER (WHERE errors_seen > 0) AS error_files,
                   coalesce(sum(errors_seen), 0)::BIGINT AS error_rows FROM run_log""",
    ),
    "event_upsert": """
        WITH s AS (SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2)) AS amount,
                     CASE WHEN sum(o_totalprice::DECIMAL(18,2)) > 400000 THEN max(o_orderstatus) END AS note
              FROM orders GROUP BY o_custkey
              UNION ALL SELECT -s_suppkey - 1, s_acctbal::DECIMAL(18,2), s_name FROM supplier)
        SELECT coalesce(c_custkey, o_custkey) AS custkey,
               (CASE WHEN o_custkey IS NULL THEN c_acctbal::DECIMAL(18,2) ELSE amount END)::DECIMAL(18,2) AS amount,
               CASE WHEN o_custkey IS NULL THEN c_name ELSE note END AS note, c_nationkey AS nation,
               CASE WHEN c_custkey IS NULL THEN TIMESTAMP '2024-02-01 09:05:00' ELSE TIMESTAMP '2024-01-01' END AS created_at,
               CASE WHEN o_custkey IS NOT NULL THEN TIMESTAMP '2024-02-01 09:05:00' ELSE TIMESTAMP '2024-01-01' END AS updated_at
        FROM customer FULL JOIN s ON o_custkey = c_custkey""",
    "defect_upsert": """
        WITH g AS (SELECT l_orderkey AS event_id, l_returnflag AS defect_name, l_linestatus AS st,
                          sum(l_quantity::DECIMAL(18,0)) AS v FROM lineitem GROUP BY ALL)
        SELECT event_id, defect_name, coalesce(max(v) FILTER (WHERE st = 'O'), max(v))::DECIMAL(18,0) AS defect_value,
               CASE WHEN bool_or(st = 'F') THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-02-01 09:05:00' END AS created_at,
               CASE WHEN bool_or(st = 'O') THEN TIMESTAMP '2024-02-01 09:05:00' ELSE TIMESTAMP '2024-01-01' END AS updated_at
        FROM g GROUP BY event_id, defect_name""",
    "insert_new": """
        SELECT l_orderkey, l_linenumber, l_linestatus, l_partkey FROM lineitem a
        WHERE l_linestatus = 'F' OR (l_linestatus = 'O' AND NOT EXISTS (
            SELECT 1 FROM lineitem b WHERE b.l_linestatus = 'F' AND b.l_orderkey = a.l_orderkey
            AND b.l_linenumber = a.l_linenumber))""",
    "surrogate_key": """
        SELECT event_id AS row_number,
               sha256(CASE WHEN value > 1 THEN 'recv/' || event_type || '.csv' END || '|' || event_id) AS event_id
        FROM events""",
    "unpivot_numeric": """
        WITH w AS (
          SELECT l_orderkey, l_linenumber, unnest([
            {'k': 'T不良_01', 'v': l_extendedprice::DECIMAL(18,2)::VARCHAR},
            {'k': 'T不良_02', 'v': l_discount::DECIMAL(18,2)::VARCHAR},
            {'k': 'T不良_03', 'v': l_linestatus},
            {'k': 'T不良_04', 'v': CASE WHEN l_tax > 0.035 THEN l_partkey::VARCHAR END},
            {'k': 'T不良_05', 'v': CASE WHEN l_tax > 0.035 THEN '' ELSE 'NULL' END},
            {'k': 'T不良_06', 'v': '-' || l_suppkey}]) AS e
          FROM lineitem)
        SELECT l_orderkey, l_linenumber, e.k AS defect_name, try_cast(e.v AS DECIMAL(18,0)) AS defect_value,
               e.v AS defect_value_raw
        FROM w WHERE try_cast(e.v AS DECIMAL(38,0)) IS NOT NULL""",
    "object_fields": """
        SELECT l_orderkey, l_linenumber, l_shipdate AS stamp, l_returnflag AS line,
               l_quantity::DECIMAL(18,0) AS quantity, CASE WHEN l_tax > 0.035 THEN l_partkey::VARCHAR END AS raw_04,
               NULL::VARCHAR AS missing
        FROM lineitem""",
    "parsed_json": """
        SELECT event_id, props->>'$.k' AS k, event_type, '{"text":"' || event_type || '"}' AS body FROM events""",
    "try_parse": """
        WITH x AS (
          SELECT *, CASE event_type WHEN 'click' THEN value::DECIMAL(18,2)::VARCHAR
                         WHEN 'view' THEN '-' || value::DECIMAL(18,2)::VARCHAR WHEN 'error' THEN ''
                         WHEN 'signup' THEN user_id || 'x' ELSE ' ' || user_id || ' ' END AS number
          FROM events)
        SELECT event_id, try_cast(number AS DECIMAL(38,0)) AS whole, try_cast(number AS DECIMAL(18,1)) AS tenth,
               try_cast(number AS DECIMAL(2,0)) AS narrow,
               CASE WHEN event_type <> 'view' THEN date_trunc('second', ts) END AS stamp,
               CASE WHEN event_type <> 'view' THEN ts::DATE END AS day,
               CASE WHEN event_type <> 'view' THEN strftime(ts, '%H:%M:%S') END AS clock,
               nullif(number, '') AS cleaned,
               CASE WHEN event_type <> 'view' THEN strftime(ts, '%Y-%m-%d') END AS dashed
        FROM x""",
    "dataset_paths": _with(
        "cfg",
        """
        , p AS (
          SELECT *, CASE WHEN stage LIKE '@%' THEN stage ELSE '@' || stage END
                 || CASE WHEN coalesce(subpath, '') = '' THEN '' WHEN subpath LIKE '/%' THEN subpath
                         ELSE '/' || subpath END AS base_path
          FROM cfg WHERE is_active)
        SELECT system, dataset, stage, subpath, target_table, coalesce(file_format, 'FF_CSV_COMMON') AS file_format,
               coalesce(on_error, 'SKIP_FILE') AS on_error, base_path, base_path || '/' || dataset || '.csv' AS file_path
        FROM p""",
    ),
    "text_functions": r"""
        SELECT page_id, CASE WHEN url LIKE '%/' THEN NULL ELSE regexp_extract(url, '[^/]+$') END AS base,
               regexp_replace(url, '^.*/', '') AS tail, split_part(url, '/', 3) AS host, split_part(url, '/', 9) AS beyond,
               position('example' IN url)::INT AS "at", upper(url[1:4]) AS scheme, left(html, 180) AS head,
               length(html)::INT AS n_chars, greatest(length(html) - 1000, 0)::INT AS beyond_1000,
               replace(url, '"', '""') AS quoted, lower(url) AS lowered, 'a' || chr(10) || page_id AS two_lines,
               CASE WHEN position('.example.' IN url) > 0
                    THEN '/' || substr(url, position('.example.' IN url) + length('.example.')) ELSE url END AS after_host
        FROM pages""",
    "headings": """
        SELECT p_partkey AS "CL", p_brand AS "CustomerPart#", p_type AS "進捗率[%]", p_name AS "ラインNo." FROM part""",
}
# the same rows, read from tables stored by month
ORACLE["recent_changes_stored"] = ORACLE["recent_changes"]
