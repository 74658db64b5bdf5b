"""Source / sink operator queries: the driver's tables are landed as feeds under the shared
scratch folder (``spark.checkpoint.dir``) and read back through the feed readers.

Each callable writes its feed files first (the landing step a real feed gets from upstream) and
returns a lazy DataFrame over what the reader produced, so the work grows with the tables.
"""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapflow.operators import conform as CF
from snapflow.operators.checks import DataCheckError
from snapflow.operators.sinks import load_into_empty, rebuild_reconciled, rebuild_stage
from snapflow.plans.snapshots import read
from snapflow.session import scratch_dir, spread
from snapflow.sources import archive, files
from snapflow.sources.delimited import read_delimited, write_delimited

CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal"]
AS_OF = "2024-06-26 04:00:00"


def _customer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"), "c_mktsegment",
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("c_acctbal"))


def q_delimited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipe feed with padded header names and padded values, read back trimmed."""
    path = scratch_dir(spark, "pipe_feed")
    t = _customer_text(spark, sf_dir)
    padded = t.select([F.concat(F.lit(" "), F.col(c), F.lit("\t ")).alias(f" {c} ")
                       for c in CUST_COLS])
    write_delimited(padded, path, sep="|")
    return read_delimited(spark, path, CUST_COLS, sep="|", file_col=None).good


def q_tab_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab feed read all-string; a missing value becomes the text 'nan' (parity)."""
    path = scratch_dir(spark, "tab_feed")
    o = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus",
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("open_priority"))
    write_delimited(o, path, sep="\t")
    cols = ["o_orderkey", "o_orderstatus", "open_priority"]
    return read_delimited(spark, path, cols, sep="\t", blank_as_null=True, nan_text=True,
                          file_col=None).good


def q_bad_line_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a surplus field are quarantined, lines missing a field are kept."""
    path = scratch_dir(spark, "bad_lines")
    t = _customer_text(spark, sf_dir)
    full = F.concat_ws("|", *[F.col(c) for c in CUST_COLS])
    short = F.concat_ws("|", *[F.col(c) for c in CUST_COLS[:-1]])
    line = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(full, F.lit("|surplus")))
            .when(F.col("c_mktsegment") == "BUILDING", short).otherwise(full))
    t.select(line.alias("|".join(CUST_COLS))).write.mode("overwrite") \
        .option("header", "true").option("quote", "\u0000").csv(path)
    return read_delimited(spark, path, CUST_COLS, sep="|", file_col=None).good


def q_quarantine_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantined side of the same feed (surplus-field lines per field count)."""
    path = scratch_dir(spark, "bad_lines_q")
    t = _customer_text(spark, sf_dir)
    full = F.concat_ws("|", *[F.col(c) for c in CUST_COLS])
    line = F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(full, F.lit("|surplus"))) \
        .otherwise(full)
    t.select(line.alias("|".join(CUST_COLS))).write.mode("overwrite") \
        .option("header", "true").option("quote", "\u0000").csv(path)
    q = read_delimited(spark, path, CUST_COLS, sep="|").quarantine
    return q.groupBy("n_fields").agg(F.count(F.lit(1)).alias("n_lines"))


def q_quoted_breaks_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a pipe feed whose quoted texts run over many lines, with separators and
    quotes in them; every record comes back whole and none is quarantined."""
    path = scratch_dir(spark, "quoted_breaks")
    cols = ["doc_id", "lang", "source", "text"]
    d = read(spark, sf_dir, "documents")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "\r\n?", "\n")
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols[:-1]]
    d.select(F.concat_ws("|", *plain, quoted).alias("value")).write.mode("overwrite").text(path)
    feed = read_delimited(spark, path, cols, sep="|", header_names=cols, strip=False, file_col=None)
    if not feed.quarantine.isEmpty():
        raise DataCheckError("a record of the feed was quarantined")
    return feed.good.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", "text")


def q_coerced_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as an untyped pipe feed come back in the types that their values have: int,
    bigint, decimal, double and date with blanks; padded numbers and mixtures stay text."""
    from snapflow.operators.clean import coerced
    path = scratch_dir(spark, "untyped")
    o = read(spark, sf_dir, "orders")
    key, open_order = F.col("o_orderkey").cast("string"), F.col("o_orderstatus") == "O"
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    feed = o.select(
        key.alias("order_id"), (F.col("o_orderkey") * F.lit(10_000_000_000)).cast("string").alias("wide_id"),
        F.when(open_order, F.col("o_totalprice").cast("decimal(12,2)").cast("string")).alias("open_price"),
        F.concat(key, F.lit("e-3")).alias("share"),
        F.when(open_order, F.date_format("o_orderdate", "M/d/yyyy")).when(F.col("o_orderstatus") == "F", day).alias("day"),
        F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("padded"), F.when(open_order, day).otherwise(key).alias("mixed"),
        "o_orderstatus")
    write_delimited(feed, path)
    return coerced(read_delimited(spark, path, feed.columns, file_col=None).good)


def q_stage_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K2: the stage is rebuilt twice (overwrite, 500-row files); one copy remains."""
    path = scratch_dir(spark, "stage")
    c = read(spark, sf_dir, "customer")
    rebuild_stage(c, path, max_records_per_file=500)
    rebuild_stage(c, path, max_records_per_file=500)
    return spark.read.parquet(path)


def q_multi_feed_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds of one layout, tagged by their file pattern, unioned."""
    root = scratch_dir(spark, "cs_feeds")
    t = _customer_text(spark, sf_dir)
    bal = F.col("c_acctbal").cast("decimal(12,2)")
    write_delimited(t.where(bal >= 0), f"{root}/mcr_feed", sep="|")
    write_delimited(t.where(bal < 0), f"{root}/mcd_feed", sep="|")
    feeds = []
    for origin in ("mcr", "mcd"):
        g = read_delimited(spark, f"{root}/{origin}_feed", CUST_COLS, file_col=None).good
        feeds.append(g.select("c_custkey", F.lit(origin).alias("file_origin")))
    u = CF.union_all(feeds)
    return u.withColumn("CS_file_origin",
                        CF.case_map("file_origin", {"mcd": "medicaid", "mcr": "medicare"}))


def q_latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as one dated folder per year; the newest one is loaded."""
    root = scratch_dir(spark, "dated")
    o = read(spark, sf_dir, "orders")
    (o.withColumn("feed", F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string")))
     .write.mode("overwrite").partitionBy("feed").parquet(root))
    pick = files.newest(files.list_files(spark, root, "*.parquet"), by="path").first()
    folder = pick["parent"]
    newest = spark.read.parquet(f"{root}/{folder}")
    return newest.agg(F.lit(folder.split("=", 1)[1]).alias("feed"),
                      F.count(F.lit(1)).alias("n_rows"))


def _archive_writer(folder: str, skip_segment: str):
    """One zip per group of at most 250 customers (a bounded group, delivered whole by
    ``applyInPandas``); the skipped segment's text file is landed too, marking its archive as
    already expanded.  Writes go to the shared scratch folder mounted on every worker."""
    local = folder.replace("file:", "", 1)

    def write(g):
        import pandas as pd
        seg, blk = g["c_mktsegment"].iloc[0], int(g["blk"].iloc[0])
        name = f"cust_{seg}_{blk}"
        body = "|".join(CUST_COLS) + "\n" + "\n".join(g["line"]) + "\n"
        with zipfile.ZipFile(os.path.join(local, name + ".zip"), "w") as zf:
            zf.writestr(name + ".txt", body)
        if seg == skip_segment:
            with open(os.path.join(local, name + ".txt"), "w") as fh:
                fh.write(body)
        return pd.DataFrame({"archive": [name], "n_lines": [len(g)]})
    return write


def q_archive_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives not yet expanded are expanded; those with a text file are skipped."""
    folder = scratch_dir(spark, "archives")
    t = _customer_text(spark, sf_dir)
    line = F.concat_ws("|", *[F.col(c) for c in CUST_COLS])
    blocks = t.select("c_mktsegment", (F.col("c_custkey").cast("long") / 250).cast("long")
                      .alias("blk"), line.alias("line"))
    landed = spread(blocks, "c_mktsegment", "blk").groupBy("c_mktsegment", "blk").applyInPandas(
        _archive_writer(folder, "BUILDING"), "archive string, n_lines long")
    landed.write.format("noop").mode("overwrite").save()
    lines = archive.expand(archive.pending_archives(spark, folder))
    f = F.split("line", r"\|", -1)
    body = lines.where(F.col("line") != F.lit("|".join(CUST_COLS)))
    return body.select(f.getItem(0).cast("long").alias("c_custkey"),
                       f.getItem(3).alias("c_mktsegment"))


def _xlsx_bytes(header, rows, date1904: bool) -> bytes:
    """Sheet 0 of a minimal workbook: numbers as number cells, text as inline strings, and
    ``datetime`` values as date-styled serial numbers that keep their time of day."""
    import datetime as dt
    from xml.sax.saxutils import escape

    epoch = dt.datetime(1904, 1, 1) if date1904 else dt.datetime(1899, 12, 30)

    def ref(r, c):
        s, c = "", c + 1
        while c:
            c, rem = divmod(c - 1, 26)
            s = chr(65 + rem) + s
        return f"{s}{r + 1}"

    body = []
    for r, row in enumerate([header] + rows):
        cells = []
        for c, v in enumerate(row):
            if v is None:
                continue
            if isinstance(v, dt.datetime):
                serial = (v - epoch).total_seconds() / 86400.0
                cells.append(f'<c r="{ref(r, c)}" s="1"><v>{serial!r}</v></c>')
            elif isinstance(v, (int, float)):
                cells.append(f'<c r="{ref(r, c)}"><v>{v!r}</v></c>')
            else:
                cells.append(f'<c r="{ref(r, c)}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>')
        body.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml",
                   f'<workbook {ns} {rns}><workbookPr date1904="{int(date1904)}"/>'
                   f'<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/'
                   'relationships"><Relationship Id="rId1" Type="worksheet" '
                   'Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs count="2"><xf numFmtId="0"/>'
                                    f'<xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml",
                   f'<worksheet {ns}><sheetData>{"".join(body)}</sheetData></worksheet>')
    return buf.getvalue()


# one workbook per block of this many order keys: keys are unique, so a block is bounded
WORKBOOK_BLOCK = 5000
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority"]


def _workbook_writer(folder: str):
    local = folder.replace("file:", "", 1)

    def write(g):
        import pandas as pd
        blk = int(g["blk"].iloc[0])
        g = g.sort_values("o_orderkey")
        rows = [[int(k), int(c), st, float(p), ts.to_pydatetime(), pr] for k, c, st, p, ts, pr in
                zip(*[g[c] for c in ORDER_COLS])]
        name = f"orders_{blk}.xlsx"
        with open(os.path.join(local, name + ".part"), "wb") as fh:
            fh.write(_xlsx_bytes(ORDER_COLS, rows, date1904=bool(blk % 2)))
        os.replace(os.path.join(local, name + ".part"), os.path.join(local, name))
        return pd.DataFrame({"workbook": [name], "n_rows": [len(g)]})
    return write


def q_workbook_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as workbooks (alternating 1900 / 1904 date systems, date cells
    with their time of day), read back through the workbook reader and typed."""
    folder = scratch_dir(spark, "workbooks")
    o = read(spark, sf_dir, "orders").withColumn(
        "blk", F.floor(F.col("o_orderkey") / WORKBOOK_BLOCK).cast("long"))
    landed = spread(o, "blk").groupBy("blk").applyInPandas(_workbook_writer(folder),
                                                           "workbook string, n_rows long")
    landed.write.format("noop").mode("overwrite").save()
    from snapflow.sources.workbook import read_workbooks
    w = read_workbooks(spark, folder, ORDER_COLS)
    return w.select(F.col("o_orderkey").cast("long").alias("o_orderkey"),
                    F.col("o_custkey").cast("long").alias("o_custkey"), "o_orderstatus",
                    F.col("o_totalprice").cast("double").alias("o_totalprice"),
                    F.col("o_orderdate").cast("date").alias("o_orderdate"),
                    "o_orderpriority", "FileName")


def q_lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: batch-constant ingest time and the feed (folder) each row came from."""
    root = scratch_dir(spark, "lineage")
    t = _customer_text(spark, sf_dir)
    (t.select(*CUST_COLS, F.col("c_mktsegment").alias("segment"))
     .write.mode("overwrite").partitionBy("segment").option("sep", "|").option("header", "true")
     .option("quote", "\u0000").csv(root))
    g = read_delimited(spark, root, CUST_COLS, lineage_as_of=AS_OF, file_from="parent").good
    return g.select(F.col("c_custkey").cast("long").alias("c_custkey"), "date_ingested",
                    "FileName")


def q_row_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every given table is staged; rows and contents counted on the way in (observed) are
    compared with what the stage holds.  The stages are independent, so their jobs are submitted
    together and share the cluster."""
    from concurrent.futures import ThreadPoolExecutor
    root = scratch_dir(spark, "reconcile")

    def stage(name):
        written, found = rebuild_reconciled(read(spark, sf_dir, name), f"{root}/{name}")
        return (name, written.rows, found.rows, written.rows - found.rows, written == found)

    with ThreadPoolExecutor(max_workers=4) as pool:
        rows = list(pool.map(stage, STAGED_TABLES))
    return spark.createDataFrame(rows, "table_name string, expected long, loaded long, diff long, same_contents boolean")


STAGED_TABLES = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events", "documents", "embeddings",
                 "pages", "benchmark", "labels", "conversations")


def q_empty_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: every given table loads into its empty stage; a second load into the now non-empty stage is
    refused, so the stage holds exactly one copy."""
    root = scratch_dir(spark, "guarded")
    rows = []
    for name in STAGED_TABLES:
        path = f"{root}/{name}"
        loaded = load_into_empty(read(spark, sf_dir, name), path)
        try:
            load_into_empty(read(spark, sf_dir, name), path)
            refused = False
        except DataCheckError:
            refused = True
        staged = spark.read.parquet(path).count()
        rows.append((name, int(loaded), refused, int(staged)))
    return spark.createDataFrame(
        rows, "table_name string, loaded long, refused boolean, staged long")


def q_column_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column excluded from the staged feed before insertion (header check still holds
    for the remaining columns)."""
    from snapflow.operators.clean import drop_columns
    from snapflow.plans.table_queries import staged_customer
    return drop_columns(staged_customer(spark, sf_dir), ["c_acctbal"])


def q_incidents_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incidents job run twice on the events table (assignment = 'error',
    reference in (8, 9)); the second run replaces the stage and both reconcile."""
    from snapflow.plans import incidents
    stage = f"{scratch_dir(spark, 'incidents')}/stage"
    events = read(spark, sf_dir, "events")
    for as_of in ("2024-06-26 04:00:00", "2024-07-26 04:00:00"):
        incidents.run(spark, events, stage, "error", [8, 9], as_of,
                      assignment_col="event_type", reference_col="user_id")
    return spark.read.parquet(stage)
