"""Equivalent SQL for each operator query, runnable by DuckDB over the same Parquet tables.

Written independently of the Spark code: the merge is spelled out as a FULL OUTER JOIN with one
CASE per column, exactly as the MERGE statement's branches read.
"""

from __future__ import annotations


def _snap(start: str, end: str) -> str:
    month = end[:4] + end[5:7]
    return f"""
    SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment,
           a.best_priority, a.is_frequent, a.open_priority, '{month}' AS snapshot_month
    FROM customer c
    JOIN (SELECT o_custkey,
                 min(o_orderpriority) AS best_priority,
                 count(*) >= 2 AS is_frequent,
                 min(CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END) AS open_priority
          FROM orders
          WHERE o_orderdate >= TIMESTAMP '{start}' AND o_orderdate < TIMESTAMP '{end}'
          GROUP BY o_custkey) a
      ON c.c_custkey = a.o_custkey"""


_TABLES = ("region nation supplier customer part orders lineitem events documents embeddings pages benchmark labels "
           "conversations").split()
SNAP1 = _snap("1997-01-01", "1998-01-01")
SNAP2 = _snap("1997-07-01", "1998-07-01")
T1 = "TIMESTAMP '1998-01-01 04:00:00'"
T2 = "TIMESTAMP '1998-07-01 04:00:00'"

ATTRS = ["c_name", "c_nationkey", "c_mktsegment", "best_priority", "is_frequent", "open_priority"]


TEXT_ATTRS = {"c_name", "c_mktsegment", "best_priority", "open_priority", "snapshot_month"}


def _merge_sql(insert_only=("snapshot_month",), null_safe=False, pk=False, collated=False,
               snap2=None) -> str:
    """Run 1 into an empty table is a plain insert; run 2 is the FULL OUTER JOIN below.
    ``collated``: text columns compare case-insensitively and ignoring trailing blanks."""
    upd = [c for c in ATTRS + ["snapshot_month"] if c not in insert_only]
    op = "IS DISTINCT FROM" if null_safe else "<>"

    def ne(c):
        if collated and c in TEXT_ATTRS:
            return f"lower(rtrim(s.{c})) {op} lower(rtrim(t.{c}))"
        return f"s.{c} {op} t.{c}"
    changed = ("(t.c_custkey IS NOT NULL AND s.c_custkey IS NOT NULL AND ("
               + "coalesce(" + " OR ".join(ne(c) for c in upd) + ", false)"
               + " OR t.Status = 'Inactive'))")
    cols = ["coalesce(t.c_custkey, s.c_custkey) AS c_custkey"]
    for c in ATTRS + ["snapshot_month"]:
        if c in upd:
            cols.append(f"CASE WHEN t.c_custkey IS NULL OR {changed} THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            cols.append(f"CASE WHEN t.c_custkey IS NULL THEN s.{c} ELSE t.{c} END AS {c}")
    cols += [
        f"CAST(CASE WHEN t.c_custkey IS NULL THEN 1 WHEN {changed} THEN coalesce(t.CountOfFiles, 0) + 1"
        f" ELSE t.CountOfFiles END AS INTEGER) AS CountOfFiles",
        f"CASE WHEN t.c_custkey IS NULL THEN {T2} ELSE t.InsertDate END AS InsertDate",
        f"CASE WHEN {changed} THEN {T2} ELSE t.LastModifiedDate END AS LastModifiedDate",
        f"CASE WHEN s.c_custkey IS NULL AND coalesce(t.Status <> 'Inactive', true) THEN {T2}"
        f" WHEN s.c_custkey IS NULL THEN t.DropDate WHEN {changed} THEN NULL"
        f" ELSE t.DropDate END AS DropDate",
        f"CASE WHEN t.c_custkey IS NULL OR {changed} THEN 'Active' WHEN s.c_custkey IS NULL"
        f" THEN 'Inactive' ELSE t.Status END AS Status",
        f"CASE WHEN t.c_custkey IS NULL THEN 'New' WHEN {changed} THEN 'Updated'"
        f" WHEN s.c_custkey IS NULL THEN 'Dropped' ELSE t.SubStatus END AS SubStatus",
    ]
    pk_t1 = ""
    if pk:
        cols.insert(0, "CASE WHEN t.c_custkey IS NULL THEN s.Primary_Key ELSE t.Primary_Key END"
                       " AS Primary_Key")
        pk_t1 = ", 9999999999 + row_number() OVER (ORDER BY c_custkey) AS Primary_Key"
    s2 = "s2raw"
    s2_pk = ""
    if pk:
        s2_pk = (", CASE WHEN t1k.c_custkey IS NULL THEN (SELECT max(Primary_Key) FROM t1)"
                 " + row_number() OVER (PARTITION BY t1k.c_custkey IS NULL ORDER BY s2raw.c_custkey)"
                 " END AS Primary_Key")
    return f"""
    WITH s1 AS ({SNAP1}),
         s2raw AS ({snap2 or SNAP2}),
         t1 AS (SELECT *, CAST(1 AS INTEGER) AS CountOfFiles, {T1} AS InsertDate,
                       CAST(NULL AS TIMESTAMP) AS LastModifiedDate,
                       CAST(NULL AS TIMESTAMP) AS DropDate,
                       'Active' AS Status, 'New' AS SubStatus {pk_t1}
                FROM s1),
         s2 AS (SELECT s2raw.* {s2_pk} FROM {s2}
                LEFT JOIN (SELECT c_custkey FROM t1) t1k ON s2raw.c_custkey = t1k.c_custkey)
    SELECT {', '.join(cols)}
    FROM t1 t FULL OUTER JOIN s2 s ON t.c_custkey = s.c_custkey"""


SNAPSHOT_MERGE = _merge_sql()

SNAP2_RECASED = f"""
    SELECT c_custkey,
           CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) || '  ' ELSE c_name END AS c_name,
           c_nationkey,
           CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN lower(c_mktsegment) ELSE c_mktsegment END
               AS c_mktsegment,
           best_priority, is_frequent, open_priority, snapshot_month
    FROM ({SNAP2})"""

SQL = {
    "snapshot_merge": SNAPSHOT_MERGE,
    "merge_summary": f"""
        SELECT Status, SubStatus, count(*) AS n_rows FROM ({SNAPSHOT_MERGE}) m
        GROUP BY Status, SubStatus""",
    "merge_insert_only": _merge_sql(insert_only=("snapshot_month", "best_priority")),
    "merge_null_safe": _merge_sql(null_safe=True),
    "merge_collated": _merge_sql(collated=True, snap2=SNAP2_RECASED),
    "surrogate_key": f"""
        SELECT Primary_Key, c_custkey, Status, SubStatus FROM ({_merge_sql(pk=True)}) m""",
    "change_predicate": f"""
        SELECT count(*) AS n_matched,
               count(*) FILTER (WHERE coalesce({' OR '.join(f's.{c} <> t.{c}' for c in ATTRS)}, false))
                   AS n_changed,
               count(*) FILTER (WHERE {' OR '.join(f's.{c} IS DISTINCT FROM t.{c}' for c in ATTRS)})
                   AS n_changed_null_safe
        FROM ({SNAP1}) t JOIN ({SNAP2}) s ON t.c_custkey = s.c_custkey""",
    "key_violations": """
        SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey HAVING count(*) > 1""",
    "dedupe_top1": """
        SELECT o_custkey, o_orderkey, o_orderpriority, o_totalprice FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey
                                       ORDER BY o_orderpriority DESC, o_orderkey) AS rn
          FROM orders) WHERE rn = 1""",
    "distinct_projection": "SELECT DISTINCT p_brand, p_type, p_size FROM part",
    "left_enrich": """
        SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, l.l_linestatus
        FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey, l_linestatus FROM lineitem) l
          ON o.o_orderkey = l.l_orderkey""",
    "row_cap": """
        SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
}

_CONFORM = """
    SELECT 'CUS' AS LineOfBusiness, CAST(c_custkey AS VARCHAR) AS Entity_ID, c_name AS EntityName,
           CAST(c_nationkey AS INTEGER) AS NationKey, c_mktsegment AS Segment,
           CAST(c_acctbal AS DECIMAL(12,2)) AS Balance, CAST(NULL AS VARCHAR) AS Brand,
           CAST(NULL AS INTEGER) AS PartSize
    FROM customer
    UNION ALL
    SELECT 'SUP', CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS INTEGER), NULL,
           CAST(s_acctbal AS DECIMAL(12,2)), NULL, NULL
    FROM supplier
    UNION ALL
    SELECT 'PRT', CAST(p_partkey AS VARCHAR), p_name, NULL, p_type, NULL, p_brand,
           CAST(p_size AS INTEGER)
    FROM (SELECT DISTINCT p_partkey, p_name, p_type, p_brand, p_size FROM part)"""

SQL.update({
    "conform_union": _CONFORM,
    "person_key": f"""
        SELECT LineOfBusiness, Entity_ID,
               upper(md5(concat_ws('', lower(EntityName), lower(Segment),
                                   CAST(NationKey AS VARCHAR), CAST(PartSize AS VARCHAR))))
                   AS Member_Key,
               TRY_CAST(Balance AS DECIMAL(10,4)) AS Score,
               CAST(count(*) OVER (PARTITION BY lower(EntityName), lower(Segment), NationKey,
                                   PartSize) AS INTEGER) AS CountOf_LOB
        FROM ({_CONFORM}) u""",
    "typed_projection": """
        SELECT left(CAST(c_custkey AS VARCHAR), 12) AS c_custkey,
               CAST(CAST(c_custkey AS INTEGER) AS VARCHAR) AS cust_id_str,
               CAST(c_nationkey AS INTEGER) AS c_nationkey,
               left(c_name, 9) AS name9,
               left(c_mktsegment, 5) AS segment5,
               left(CAST(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(20,0)) AS VARCHAR), 10)
                   AS acctbal_whole,
               TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(3,2)) AS acctbal_small
        FROM customer WHERE c_nationkey IS NOT NULL""",
    "strict_cast": """
        SELECT CAST(CAST(c_custkey AS VARCHAR) AS BIGINT) AS c_custkey,
               CAST(CAST(c_nationkey AS VARCHAR) AS SMALLINT) AS nation_small,
               CAST(CAST(c_nationkey AS VARCHAR) AS INTEGER) AS nation_int
        FROM customer""",
    "lenient_cast": r"""
        SELECT event_id,
               TRY_CAST(NULLIF(trim(regexp_extract(props, '([0-9]+)', 1)), '') AS INTEGER) AS k_int,
               TRY_CAST(NULLIF(trim(event_type), '') AS INTEGER) AS type_int,
               TRY_CAST(CAST(value AS VARCHAR) AS DECIMAL(3,2)) AS value_dec
        FROM events""",
    "to_bit": """
        SELECT doc_id, quality <> 0 AS is_quality, toxic <> 0 AS is_toxic FROM labels""",
    "blank_to_null": r"""
        SELECT page_id,
               NULLIF(regexp_extract(url, '\?([^#]*)', 1), '') AS query_text,
               NULLIF(regexp_extract(url, '#(.*)$', 1), '') AS fragment,
               NULLIF(NULLIF(regexp_extract(url, '#(.*)$', 1), ''), 'top') AS fragment_not_top
        FROM pages""",
    "parse_date": """
        SELECT o_orderkey,
               CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
                                  WHEN 'O' THEN strftime(o_orderdate, '%Y%m%d')
                                  ELSE strftime(o_orderdate, '%m/%d/%Y') END AS date_text,
               CAST(o_orderdate AS DATE) AS order_date
        FROM orders""",
    "zip_clean": """
        SELECT c_custkey, replace(NULLIF(c_name, ''), '#', '') AS name_clean FROM customer""",
    "zip_split": """
        SELECT page_id, substring(url, 1, 5) AS head5,
               CASE WHEN length(rtrim(url)) > 5 THEN substring(url, 6, 9) ELSE NULL END AS tail9
        FROM pages""",
    "yyyymm": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS yyyymm,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS load_text,
               left(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), 10) AS load_day
        FROM orders""",
    "month_start": """
        SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start
        FROM orders""",
    "case_map": """
        SELECT o_orderkey, o_orderstatus,
               CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open'
                    ELSE 'ZZZZZZ - ERROR' END AS status_label
        FROM orders""",
    "excel_serial_date": """
        SELECT o_orderkey,
               CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS DOUBLE) + 0.75
                   AS serial_1900,
               CAST(o_orderdate AS DATE) AS date_1900,
               CAST(o_orderdate AS DATE) AS date_1904
        FROM orders""",
    "incident_filter": """
        SELECT *, TIMESTAMP '2024-06-26 04:00:00' AS Date_Ingested
        FROM events WHERE event_type = 'error' AND user_id IN (8, 9)""",
    "persistent_view": """
        SELECT l.doc_id, l.toxic, d.lang, d.source, d.n_chars
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE l.quality = 1""",
    "numeric_profile": """
        SELECT count(*) FILTER (WHERE TRY_CAST(trim(CAST(s_suppkey AS VARCHAR)) AS DOUBLE) IS NULL) = 0
                   AS s_suppkey,
               count(*) FILTER (WHERE trim(s_name) <> '' AND TRY_CAST(trim(s_name) AS DOUBLE) IS NULL) = 0
                   AS s_name,
               count(*) FILTER (WHERE TRY_CAST(trim(CAST(s_nationkey AS VARCHAR)) AS DOUBLE) IS NULL) = 0
                   AS s_nationkey,
               count(*) FILTER (WHERE TRY_CAST(trim(CAST(s_acctbal AS VARCHAR)) AS DOUBLE) IS NULL) = 0
                   AS s_acctbal
        FROM supplier""",
    "enforce_schema": """
        SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
               CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment
        FROM customer""",
})

_CUST_TEXT = """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           c_mktsegment, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal
    FROM customer"""

SQL.update({
    "delimited_scan": _CUST_TEXT,
    "tab_scan": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
               coalesce(CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END, 'nan') AS open_priority
        FROM orders""",
    "bad_line_quarantine": f"""
        SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
               CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS c_acctbal
        FROM ({_CUST_TEXT}) t WHERE c_mktsegment <> 'AUTOMOBILE'""",
    "quarantine_count": """
        SELECT CAST(6 AS INTEGER) AS n_fields, count(*) AS n_lines
        FROM customer WHERE c_mktsegment = 'AUTOMOBILE' HAVING count(*) > 0""",
    "stage_rebuild": "SELECT * FROM customer",
    "multi_feed_origin": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
               CASE WHEN CAST(c_acctbal AS DECIMAL(12,2)) >= 0 THEN 'mcr' ELSE 'mcd' END AS file_origin,
               CASE WHEN CAST(c_acctbal AS DECIMAL(12,2)) >= 0 THEN 'medicare' ELSE 'medicaid' END
                   AS CS_file_origin
        FROM customer""",
    "latest_file": """
        SELECT 'orders_' || CAST(y AS VARCHAR) AS feed, count(*) AS n_rows
        FROM (SELECT year(o_orderdate) AS y FROM orders)
        WHERE y = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY y""",
    "workbook_scan": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
               'orders_' || CAST(o_orderkey // 5000 AS VARCHAR) || '.xlsx' AS FileName
        FROM orders""",
    "archive_expand": """
        SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "lineage_columns": """
        SELECT c_custkey, TIMESTAMP '2024-06-26 04:00:00' AS date_ingested,
               'segment=' || c_mktsegment AS FileName
        FROM customer""",
    "empty_guard": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS loaded, true AS refused, count(*) AS staged FROM {t}" for t in _TABLES),
    "column_exclusion": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
               CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
        FROM customer""",
    "incidents_load": """
        SELECT *, TIMESTAMP '2024-07-26 04:00:00' AS Date_Ingested
        FROM events WHERE event_type = 'error' AND user_id IN (8, 9)""",
    "row_reconcile": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS expected, count(*) AS loaded, CAST(0 AS BIGINT) AS diff, true AS same_contents FROM {t}"
        for t in _TABLES),
    "coerced_feed": """
        SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_orderkey AS BIGINT) * 10000000000 AS wide_id,
               CASE WHEN o_orderstatus = 'O' THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(38,2)) END AS open_price,
               CAST(CAST(o_orderkey AS VARCHAR) || 'e-3' AS DOUBLE) AS share,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day,
               lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS padded,
               CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE CAST(o_orderkey AS VARCHAR) END AS mixed,
               o_orderstatus
        FROM orders""",
    "quoted_breaks_scan": """
        SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text
        FROM documents""",
})


# --- G1 member extract job: two monthly runs of the derived member feed ------------------------

# Target widths of the text columns that the feed fills by kind.
_MEMBER_WIDTHS = {
    1: """MBR_MIDL_INIT MBR_GDR_CD MSR_51_MAD_CYR_STS MSR_52_MAH_CYR_STS MSR_53_MAC_CYR_STS MSR_100_SUPD_CYR_STS
          ASSOC_PROV_ASGN_RNDR_IND PARTD_ALRT_LVL_86""",
    2: "MBR_ADR_ST_CD ASGN_PROV_ADR_ST_CD ASSOC_PROV_ADR_ST_CD",
    3: "MBR_CURR_CMS_PBP_CD",
    5: "MBR_CURR_CMS_CONTR_NUM MBR_TYP_CD",
    15: "MBR_DAY_PH_NUM LST_HICN_BFR_MBI",
    25: "MBR_VDS_ID MBR_INCNT_PGM_IND SRC_SYS ASGN_PROV_VDS_ID ASSOC_PROV_VDS_ID",
    30: "ASSOC_PROV_GRP_TYP_CD",
    50: "MBR_ADR_CTY_NM ASGN_PROV_ADR_CTY_NM ASSOC_PROV_ADR_CTY_NM",
    75: "ASGN_PROV_LST_NM ASGN_PROV_FST_NM ASSOC_PROV_LST_NM ASSOC_PROV_FST_NM",
    100: """MBR_ADR_LN1_TXT MBR_ADR_LN2_TXT ASGN_PROV_ADR_LN1_TXT ASGN_PROV_ADR_LN2_TXT ASSOC_PROV_ADR_LN1_TXT
            ASSOC_PROV_ADR_LN2_TXT""",
    200: "ASSOC_PROV_GRP_ID",
    255: "ASSOC_PROV_GRP_NM ASSOC_HLTH_SYS_ID ASSOC_HLTH_SYS_NM",
}


def _member_filled() -> dict[str, str]:
    """What the columns filled by kind must become; ``j`` is a column's place in its kind."""
    from snapflow.plans.job_queries import FEED_FILL
    width = {c: w for w, names in _MEMBER_WIDTHS.items() for c in names.split()}

    def value(kind: str, c: str, j: int) -> str:
        kj = f"(c_custkey + {j})"
        if kind == "words":
            return (f"CASE WHEN c_custkey % 11 = 5 THEN '' ELSE left(chr(CAST(65 + {kj} % 26 AS INTEGER)) || '{j}-' || "
                    f"repeat(c_mktsegment || '_', 30), {width[c]}) END")
        if kind == "flag":
            return f"CASE ({kj} + CAST(is_frequent AS INTEGER)) % 7 WHEN 2 THEN NULL WHEN 1 THEN false WHEN 4 THEN false WHEN 6 THEN false ELSE true END"
        if kind == "day":
            return f"CASE WHEN {kj} % 4 <> 0 THEN make_date(1990 + c_nationkey, 1 + c_custkey % 12, 1 + {kj} % 28) END"
        if kind == "number":
            return f"CASE WHEN {kj} % 4 = 0 THEN CAST(c_custkey * 3 + {j} AS INTEGER) END"
        if kind == "wide":
            return f"CASE WHEN {kj} % 3 = 0 THEN 1000000000 + CAST(c_custkey AS BIGINT) END"
        if kind == "zip":
            return "CASE WHEN c_custkey % 5 <> 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 5, '0') || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END"
        if kind == "small":
            return f"CASE WHEN {kj} % 5 <> 0 THEN CAST((c_custkey * 7 + {j}) % 256 AS SMALLINT) END"
        if kind == "short":
            return f"CASE WHEN {kj} % 5 <> 0 THEN CAST((c_custkey * 31 + {j}) % 65536 - 32768 AS SMALLINT) END"
        return f"CASE WHEN {kj} % 5 >= 3 THEN CAST('0.' || lpad(CAST({kj} % 1000 AS VARCHAR), 3, '0') AS DECIMAL(3,2)) END"

    return {c: value(kind, c, j) for kind, names in FEED_FILL.items() for j, c in enumerate(names)}


def _member_columns() -> dict[str, str]:
    """All columns of the target that come from the feed, each with its SQL."""
    filled = {
        "MBR_HICN_NUM": "'H' || lpad(CAST(c_custkey AS VARCHAR), 10, '0')",
        "RPT_MO_KEY": "CAST(snapshot_month AS INTEGER)",
        "MBR_INDV_ID": "CASE WHEN c_nationkey <> 7 THEN CAST(c_custkey AS INTEGER) END",
        "MBR_INDV_ID_STR": "CASE WHEN c_nationkey <> 7 THEN CAST(c_custkey AS VARCHAR) END",
        "MBR_CRD_ID": "CASE WHEN c_nationkey <> 9 THEN CAST(c_custkey * 7 AS VARCHAR) END",
        "MBR_LST_NM": "left(c_name, 100)",
        "MBR_FST_NM": "left(c_mktsegment, 100)",
        "MBR_DOB": "make_date(1940 + c_nationkey, 6, 15)",
        "MBR_ADR_ZIP_FULL_CD": "lpad(CAST(c_nationkey AS VARCHAR), 5, '0') || '1234'",
        "MBR_ANNL_CARE_VST_FLG": "is_frequent",
        "ASGN_PROV_MPIN_NUM": "CAST(NULL AS INTEGER)",
        "ASGN_PROV_NPI_NUM": "CAST('1' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS BIGINT)",
        "ASGN_PROV_ADR_ZIP_FULL_CD": "CAST(10000 + c_nationkey AS VARCHAR)",
        "MSR_21_CBP_RSLT": "CAST(substr(best_priority, 1, 1) AS SMALLINT)",
        "MSR_49_HRM_CYR_STS": "substr(open_priority, 1, 1)",
        "MSR_51_MAD_CURR_PDC": "CAST('0.' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS DECIMAL(3,2))",
        "ROW_INSRT_DT": "CAST(make_date(1998, 1, 1 + c_nationkey) AS TIMESTAMP) + INTERVAL 4 HOUR",
        "SegmentID": "CAST(c_nationkey AS SMALLINT)",
    }
    return filled | _member_filled()


def _member_typed(snap: str, as_of: str) -> str:
    cols = [f"{expr} AS {name}" for name, expr in _member_columns().items()]
    cols.append(f"TIMESTAMP '{as_of}' AS Load_Date_Py")
    cols.append("'Master_Extract_Data_Mart_1998.txt' AS FileName")
    # a customer without an open order has a blank report month and is not loaded
    return f"SELECT {', '.join(cols)} FROM ({snap}) WHERE open_priority IS NOT NULL"


def _member_job_sql() -> str:
    a1, a2 = "1998-01-01 04:00:00", "1998-07-01 04:00:00"
    k = "MBR_HICN_NUM"
    cols = [f"coalesce(t.{k}, s.{k}) AS {k}"]
    names = [c for c in _member_columns() if c != k] + ["Load_Date_Py", "FileName"]
    # fixed values: the columns that are not compared
    changed = " OR ".join(f"coalesce(s.{c} <> t.{c}, false)" for c in names
                          if c not in ("RPT_MO_KEY", "MBR_INDV_ID_STR", "Load_Date_Py"))
    for name in names:
        if name == "RPT_MO_KEY":                      # insert-only
            cols.append(f"CASE WHEN t.{k} IS NULL THEN s.{name} ELSE t.{name} END AS {name}")
        else:
            cols.append(f"CASE WHEN t.{k} IS NULL OR {changed} THEN s.{name} ELSE t.{name} END AS {name}")
    cols += [
        f"CASE WHEN {changed} THEN 2 ELSE 1 END AS CountOfFiles",
        f"CASE WHEN t.{k} IS NULL THEN TIMESTAMP '{a2}' ELSE TIMESTAMP '{a1}' END AS InsertDate",
        f"CASE WHEN {changed} THEN TIMESTAMP '{a2}' END AS LastModifiedDate",
        f"CASE WHEN s.{k} IS NULL THEN TIMESTAMP '{a2}' END AS DropDate",
        f"CASE WHEN s.{k} IS NULL THEN 'Inactive' ELSE 'Active' END AS MnR_Status",
        f"CASE WHEN t.{k} IS NULL THEN 'New' WHEN s.{k} IS NULL THEN 'Dropped'"
        f" WHEN {changed} THEN 'Updated' ELSE 'New' END AS MnR_SubStatus",
    ]
    return (f"SELECT {', '.join(cols)} FROM ({_member_typed(SNAP1, a1)}) t "
            f"FULL OUTER JOIN ({_member_typed(SNAP2, a2)}) s ON t.{k} = s.{k}")


SQL["member_extract_job"] = _member_job_sql()


# The source of one run, from the customers it delivers
_SUPER_USERS_SOURCE = """
        WITH p AS (
            SELECT c_custkey, c_nationkey, c_mktsegment AS seg, c_acctbal,
                   'Name' || CAST(c_nationkey AS VARCHAR) AS fn,
                   'Cust' || CAST(c_custkey AS VARCHAR) AS ln,
                   make_date(1940 + c_nationkey, 6, 15) AS dob,
                   lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip5,
                   CAST(CAST({score} AS DECIMAL(12,2)) AS VARCHAR) AS pred,
                   CASE WHEN c_nationkey = 3 THEN 'nan' WHEN c_acctbal > 5000 THEN '1' ELSE '0' END AS flag
            FROM customer WHERE {who}),
        ei AS (
            SELECT 'E' || CAST(c_custkey AS VARCHAR) AS MBR_ID,
                   CASE WHEN c_acctbal < 0 THEN 'nan' ELSE CAST(c_custkey // 2 AS VARCHAR) END AS indv_id,
                   * FROM p),
        ei_first AS (
            SELECT * EXCLUDE (rn) FROM (
                SELECT *, row_number() OVER (PARTITION BY indv_id ORDER BY flag DESC, MBR_ID) AS rn
                FROM ei WHERE indv_id <> 'nan') WHERE rn = 1
            UNION ALL SELECT * FROM ei WHERE indv_id = 'nan'),
        aco AS (
            SELECT DISTINCT 'E' || CAST(c.c_custkey AS VARCHAR) AS MBR_ID,
                   'Group' || CAST(c.c_nationkey AS VARCHAR) AS group_nm
            FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
            WHERE c.c_mktsegment = 'BUILDING' AND c.c_custkey IN (SELECT c_custkey FROM p)),
        u AS (
            SELECT 'E&I' AS LineOfBusiness, e.MBR_ID AS Member_ID, fn AS MemberFirstName,
                   ln AS MemberLastName, dob AS Member_DOB, CAST(NULL AS VARCHAR) AS Subscriber_ID,
                   indv_id AS Indv_ID, 'nan' AS MemberGender, pred, flag, '5000' AS cutoff,
                   CASE WHEN a.MBR_ID IS NOT NULL THEN '1' END AS aco_flag, a.group_nm AS ACO_Name,
                   'N' AS ExchangeInd, 'nan' AS CustomerSegmentNumber, a.group_nm AS GroupName,
                   CASE WHEN a.MBR_ID IS NOT NULL THEN 'Y' END AS EI_Referral, 'nan' AS MarketRollup,
                   left(seg, 3) AS MarketSegment, zip5 AS MemberZipCd, CAST(NULL AS VARCHAR) AS MemberZipPlus4Cd,
                   'nan' AS MemberCityName, 'nan' AS MemberCounty, 'nan' AS MemberState,
                   '1' AS RCT, CAST(NULL AS VARCHAR) AS MR_ContractNumber, CAST(NULL AS VARCHAR) AS chf,
                   CAST(NULL AS VARCHAR) AS CS_MemberKey, CAST(NULL AS VARCHAR) AS CS_CompanyState,
                   CAST(NULL AS VARCHAR) AS CS_file_origin
            FROM ei_first e LEFT JOIN aco a ON e.MBR_ID = a.MBR_ID
            UNION ALL
            SELECT DISTINCT 'M&R', 'M' || CAST(p.c_custkey AS VARCHAR), upper(fn), upper(ln), dob, NULL,
                   NULL, NULL, pred, flag, '5000', '0', NULL, NULL, NULL, NULL, NULL, NULL, NULL,
                   zip5, '1234', NULL, NULL, 'MN', NULL,
                   'H' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0'),
                   CASE WHEN c_acctbal > 0 THEN '1' ELSE '0' END, NULL, NULL, NULL
            FROM p JOIN orders o ON o.o_custkey = p.c_custkey
            WHERE seg IN ('AUTOMOBILE', 'MACHINERY')
            UNION ALL
            SELECT 'C&S', 'C' || CAST(c_custkey AS VARCHAR), fn, ln, dob, NULL, NULL, NULL, pred,
                   flag, '5000', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, zip5, NULL, NULL,
                   NULL, NULL, NULL, NULL, NULL, 'C' || CAST(c_custkey AS VARCHAR),
                   'State' || CAST(c_nationkey AS VARCHAR),
                   CASE WHEN c_acctbal >= 0 THEN 'medicare' ELSE 'medicaid' END
            FROM p WHERE seg IN ('HOUSEHOLD', 'AUTOMOBILE'))
        SELECT upper(md5(concat_ws('', lower(MemberFirstName), lower(MemberLastName),
                                   CAST(Member_DOB AS VARCHAR), MemberZipCd))) AS Member_Key,
               LineOfBusiness, '{month}' AS YYYYMM, Member_ID, MemberFirstName, MemberLastName,
               Member_DOB, Subscriber_ID, nullif(Indv_ID, 'nan') AS Indv_ID, CS_MemberKey,
               CS_CompanyState, CS_file_origin, MemberGender,
               CAST(pred AS DECIMAL(10,4)) AS HCE_PredictiveScore, CASE flag WHEN '1' THEN true WHEN '0' THEN false END AS Is_PSU,
               CAST(cutoff AS DECIMAL(10,4)) AS PSU_Score_Cutoff,
               CASE aco_flag WHEN '1' THEN true WHEN '0' THEN false END AS ACO_Flag, ACO_Name,
               ExchangeInd, CustomerSegmentNumber, GroupName, EI_Referral, MarketRollup,
               MarketSegment, MemberZipCd, MemberZipPlus4Cd, MemberCityName, MemberCounty,
               nullif(MemberState, 'nan') AS MemberState, MR_ContractNumber,
               CAST(NULL AS VARCHAR) AS MR_PBP, CAST(NULL AS VARCHAR) AS MR_Product,
               CAST(NULL AS VARCHAR) AS MR_PMG_Name, CAST(NULL AS VARCHAR) AS GI,
               CAST(chf AS INTEGER) AS CongestiveHeartFailure, CAST(NULL AS INTEGER) AS Diabetes,
               CAST(NULL AS INTEGER) AS EndStageRenal, CAST(NULL AS INTEGER) AS TCM_eng,
               CAST(NULL AS INTEGER) AS HRCM_eng, CAST(NULL AS INTEGER) AS AI_eng,
               CAST(NULL AS INTEGER) AS Any_Optum_Program, CAST(RCT AS INTEGER) AS RCT,
               TIMESTAMP '{as_of}' AS Load_Date_Py,
               CAST(count(*) OVER (PARTITION BY lower(MemberFirstName), lower(MemberLastName),
                                   Member_DOB, MemberZipCd) AS INTEGER) AS CountOf_LOB
        FROM u"""


def _super_users_sql() -> str:
    a1, a2 = "2024-06-26 04:00:00", "2024-07-26 04:00:00"
    one = _SUPER_USERS_SOURCE.format(who="c_acctbal <= 9000", score="c_acctbal", month="202406", as_of=a1)
    two = _SUPER_USERS_SOURCE.format(who="NOT c_acctbal BETWEEN 0 AND 500", month="202407", as_of=a2,
                                     score="CASE WHEN c_nationkey < 10 THEN c_acctbal + 1 ELSE c_acctbal END")
    # fixed values: columns that only an insert sets, and those that an update sets but does not compare
    insert_only = ["Member_Key", "LineOfBusiness", "YYYYMM", "Load_Date_Py"]
    compared = """MemberFirstName MemberLastName Member_DOB Subscriber_ID Indv_ID MemberGender
        HCE_PredictiveScore Is_PSU PSU_Score_Cutoff ACO_Flag ACO_Name ExchangeInd CustomerSegmentNumber
        GroupName EI_Referral MarketRollup MarketSegment MemberZipCd MemberZipPlus4Cd MemberCityName
        MemberCounty MemberState RCT MR_ContractNumber MR_PBP MR_Product MR_PMG_Name GI
        CongestiveHeartFailure Diabetes EndStageRenal TCM_eng HRCM_eng AI_eng Any_Optum_Program
        CS_MemberKey CS_CompanyState CS_file_origin""".split()
    cols = ["coalesce(t.Member_ID, s.Member_ID) AS Member_ID"]
    cols += [f"CASE WHEN t.Member_ID IS NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in insert_only]
    cols += [f"CASE WHEN t.Member_ID IS NULL OR changed THEN s.{c} ELSE t.{c} END AS {c}"
             for c in [*compared, "CountOf_LOB"]]
    changed = " OR ".join(f"s.{c} <> t.{c}" for c in compared)
    return f"""
        WITH one AS ({one}), two AS ({two}),
        t AS (SELECT *, 9999999999 + row_number() OVER (ORDER BY Member_ID) AS Primary_Key FROM one),
        new AS (SELECT Member_ID, (SELECT max(Primary_Key) FROM t) + row_number() OVER (ORDER BY Member_ID) AS pk
                FROM two WHERE Member_ID NOT IN (SELECT Member_ID FROM one)),
        m AS (SELECT t, s, coalesce({changed}, false) AS changed
              FROM t FULL OUTER JOIN two s ON t.Member_ID = s.Member_ID)
        SELECT {', '.join(cols)},
               CASE WHEN changed THEN 2 ELSE 1 END AS CountOfFiles,
               CASE WHEN t.Member_ID IS NULL THEN TIMESTAMP '{a2}' ELSE TIMESTAMP '{a1}' END AS InsertDate,
               CASE WHEN changed THEN TIMESTAMP '{a2}' END AS LastModifiedDate,
               CASE WHEN s.Member_ID IS NULL THEN TIMESTAMP '{a2}' END AS DropDate,
               CASE WHEN s.Member_ID IS NULL THEN 'Inactive' ELSE 'Active' END AS SuperUser_Status,
               CASE WHEN s.Member_ID IS NULL THEN 'Dropped' WHEN changed THEN 'Updated' ELSE 'New' END AS SuperUser_SubStatus,
               coalesce(t.Primary_Key, new.pk) AS Primary_Key
        FROM m LEFT JOIN new ON new.Member_ID = s.Member_ID"""


SQL["super_users_job"] = _super_users_sql()
