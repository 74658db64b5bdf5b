"""Whole-job queries over the driver's tables.

The super-users job reads four feeds: E&I members and ACO detail as tab text, M&R and C&S as
workbooks.  Here they are derived from ``customer`` and ``orders`` and landed under the shared
scratch folder in those formats, then the job runs unchanged (read, clean, top-1, enrich,
conform, union, person key, lines-of-business count, guarded snapshot merge).

Derived people: customer ``k`` of nation ``n`` is "Name<n> Cust<k>", born 1940+n-06-15, ZIP
``n`` padded to five digits.  Every customer is an E&I member (customers ``2i`` and ``2i+1``
share individual ``i``, so the top-1 rule picks one of them; a negative balance leaves the
individual blank, i.e. keyless).  BUILDING customers carry ACO detail, AUTOMOBILE and
MACHINERY customers are M&R members, HOUSEHOLD and AUTOMOBILE customers are C&S members (mcr
for a non-negative balance, mcd otherwise).  ACO rows are emitted once per order and M&R rows
once per order status of the member, so the job's DISTINCT steps have real duplicates to
remove.

The job runs twice.  Run 1 has the customers with a balance up to 9000; run 2 those outside 0 to 500,
with the score of nations below 10 raised by one.  Nation 3 has a blank flag.  The E&I landing
folder also holds an older delivery, and lines with a surplus field that must stay out.
"""

from __future__ import annotations

from functools import partial
import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapflow.plans import super_users as SU
from snapflow.plans.snapshots import read
from snapflow.session import drop_folder, scratch_dir, spread, together
from snapflow.sources.delimited import write_delimited

AS_OF, AS_OF_2 = "2024-06-26 04:00:00", "2024-07-26 04:00:00"
# workbooks hold at most this many keys each (keys are unique, so every block is bounded)
BLOCK = 5000


def _person(run: int) -> dict[str, Column]:
    k, n, bal = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal")
    raised = F.when(n < 10, bal + 1).otherwise(bal) if run == 2 else bal
    return {
        "fn": F.concat(F.lit("Name"), n.cast("string")),
        "ln": F.concat(F.lit("Cust"), k.cast("string")),
        "dob": F.make_date(F.lit(1940) + n, F.lit(6), F.lit(15)),
        "zip5": F.lpad(n.cast("string"), 5, "0"),
        "pred": raised.cast("decimal(12,2)").cast("string"),
        "flag": F.when(n == 3, F.lit("")).when(bal > 5000, F.lit("1")).otherwise(F.lit("0")),
    }


def _layout(df: DataFrame, columns, values: dict[str, Column], blank=None) -> DataFrame:
    return df.select([(values[c] if c in values else F.lit(blank).cast("string")).alias(c)
                      for c in columns])


def _workbook_writer(folder: str, columns, prefix: str):
    local = folder.replace("file:", "", 1)

    def write(g):
        import datetime as dt
        import pandas as pd
        from snapflow.plans.source_queries import _xlsx_bytes
        blk = int(g["_blk"].iloc[0])
        g = g.sort_values([c for c in g.columns if c.startswith("_order")])
        rows = []
        for rec in g[list(columns)].itertuples(index=False):
            row = []
            for v in rec:
                if v is None or (not isinstance(v, str) and pd.isna(v)):
                    row.append(None)
                elif isinstance(v, pd.Timestamp):
                    row.append(v.to_pydatetime())
                elif isinstance(v, dt.date) and not isinstance(v, dt.datetime):
                    row.append(dt.datetime(v.year, v.month, v.day))
                else:
                    row.append(v)
            rows.append(row)
        name = f"{prefix}_{blk}.xlsx"
        with open(os.path.join(local, name + ".part"), "wb") as fh:
            fh.write(_xlsx_bytes(list(columns), rows, date1904=False))
        os.replace(os.path.join(local, name + ".part"), os.path.join(local, name))
        return pd.DataFrame({"workbook": [name], "n_rows": [len(g)]})
    return write


def land_workbooks(df: DataFrame, folder: str, columns, block: Column, order: list[Column],
                   prefix: str) -> None:
    """One workbook per bounded block (``applyInPandas`` per block, written to the shared
    landing folder); the blocks are spread over the cluster."""
    os.makedirs(folder.replace("file:", "", 1), exist_ok=True)
    out = df.select(*columns, block.alias("_blk"),
                    *[o.alias(f"_order{i}") for i, o in enumerate(order)])
    landed = spread(out, "_blk").groupBy("_blk").applyInPandas(_workbook_writer(folder, columns, prefix),
                                                               "workbook string, n_rows long")
    landed.write.format("noop").mode("overwrite").save()


def land_super_user_feeds(spark: SparkSession, sf_dir: str, root: str, run: int) -> SU.Config:
    target, root = f"{root}/target", f"{root}/run{run}"
    c = read(spark, sf_dir, "customer")
    c = c.where("c_acctbal <= 9000" if run == 1 else "not c_acctbal between 0 and 500")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = _person(run)
    key = F.col("c_custkey").cast("string")
    seg = F.col("c_mktsegment")

    ei = _layout(c, SU.EI_COLUMNS, {
        "MBR_ID": F.concat(F.lit("E"), key),
        "indv_id": F.when(F.col("c_acctbal") < 0, F.lit(""))
                    .otherwise(F.expr("c_custkey div 2").cast("string")),
        "dob": F.date_format(p["dob"], "yyyy-MM-dd"), "MBR_FST_NM": p["fn"],
        "MBR_LST_NM": p["ln"], "MKT_SEG_CD": F.left(seg, F.lit(3)),
        "Exchange_Ind": F.lit("N"), "MBR_ZIP_CD": p["zip5"],
        "pred": p["pred"], "pred_flag": p["flag"], "pred_cutoff": F.lit("5000"),
        "RCT": F.lit("1")}, blank="")

    def land_ei():
        write_delimited(ei.withColumn("MBR_FST_NM", F.lit("Older")), f"{root}/ei/ei_delivery_1.txt", sep="\t")
        write_delimited(ei, f"{root}/ei/ei_delivery_2.txt", sep="\t")
        surplus = ei.where("MKT_SEG_CD = 'FUR'").withColumn("MBR_ID", F.concat(F.lit("X"), "MBR_ID"))
        surplus.select(F.concat_ws("\t", *SU.EI_COLUMNS, F.lit("surplus"))).write.mode("append").text(
            f"{root}/ei/ei_delivery_2.txt")

    co = c.join(o, c["c_custkey"] == o["o_custkey"], "inner")
    aco = _layout(co.where(seg == "BUILDING"), SU.EI_ACO_COLUMNS, {
        "MBR_ID": F.concat(F.lit("E"), key), "referral": F.lit("Y"), "aco_flag": F.lit("1"),
        "group_nm": F.concat(F.lit("Group"), F.col("c_nationkey").cast("string")),
        "ACO": F.lit("ACO1"), "pred": p["pred"], "pred_flag": p["flag"]}, blank="")
    landings = [land_ei, partial(write_delimited, aco, f"{root}/aco", sep="\t")]

    # one M&R row per (customer, order status): up to three copies of each member, all in the
    # member's own workbook, so the job's DISTINCT (which includes the file name) collapses them
    statuses = read(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus").distinct()
    cst = c.join(statuses, c["c_custkey"] == statuses["o_custkey"], "inner")
    mr_people = cst.where(seg.isin("AUTOMOBILE", "MACHINERY"))
    mr = _layout(mr_people, SU.MR_COLUMNS + ["c_custkey", "o_orderstatus"], {
        "hicn": F.concat(F.lit("M"), key), "bth_dt": p["dob"],
        "GPS_FIRST_NAME": F.upper(p["fn"]), "GPS_LAST_NAME": F.upper(p["ln"]),
        "gps_zip_cd": F.concat(p["zip5"], F.lit("1234")), "FIN_STATE": F.lit("MN"),
        "pred": p["pred"], "pred_flag": p["flag"], "pred_cutoff": F.lit("5000"),
        "aco_flag": F.lit("0"),
        "FIN_CONTRACT_NBR": F.concat(F.lit("H"),
                                     F.lpad(F.col("c_nationkey").cast("string"), 4, "0")),
        "CHF_eng": F.when(F.col("c_acctbal") > 0, F.lit("1")).otherwise(F.lit("0")),
        "c_custkey": F.col("c_custkey"), "o_orderstatus": F.col("o_orderstatus")})
    landings.append(partial(land_workbooks, mr, f"{root}/mr", SU.MR_COLUMNS,
                            F.floor(F.col("c_custkey") / BLOCK).cast("long"),
                            [F.col("c_custkey"), F.col("o_orderstatus")], "mr"))

    cs_people = c.where(seg.isin("HOUSEHOLD", "AUTOMOBILE"))
    cs_vals = {
        "Member_Key": F.concat(F.lit("C"), key), "Member_First_Name": p["fn"],
        "Member_Last_Name": p["ln"], "Member_DOB": p["dob"], "Member_Zip": p["zip5"],
        "COMPANY_DESC": F.concat(F.lit("State"), F.col("c_nationkey").cast("string")),
        "pred_model": p["pred"], "pred_model_flag": p["flag"],
        "pred_model_cutoff": F.lit("5000"), "c_custkey": F.col("c_custkey")}
    for origin, cond in (("mcr", F.col("c_acctbal") >= 0), ("mcd", F.col("c_acctbal") < 0)):
        cs = _layout(cs_people.where(cond), SU.CS_COLUMNS + ["c_custkey"], cs_vals)
        landings.append(partial(land_workbooks, cs, f"{root}/{origin}", SU.CS_COLUMNS,
                                F.floor(F.col("c_custkey") / BLOCK).cast("long"), [F.col("c_custkey")],
                                origin))
    together(*landings)
    return SU.Config(ei=f"{root}/ei", ei_aco=f"{root}/aco", mr=f"{root}/mr",
                     cs_mcr=f"{root}/mcr", cs_mcd=f"{root}/mcd", target=target,
                     patterns={"ei": "ei_delivery_*.txt"}, stage=f"{root}/stage")


def q_super_users_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 end to end, twice, on feeds landed from the driver's tables; the merged table after both
    runs.  Every delivery has the same file names, so the other columns decide what changed."""
    from snapflow.operators.sinks import open_table
    root = scratch_dir(spark, "super_users")
    for run, as_of in ((1, AS_OF), (2, AS_OF_2)):
        cfg = land_super_user_feeds(spark, sf_dir, root, run)
        SU.run(spark, cfg, as_of)
    return open_table(spark, cfg.target).read().drop("FileName")


# --- G1: member extract -----------------------------------------------------------------------

# How the feed's further columns are filled (see ``_filled``).
FEED_FILL = {
    "words": """
        MBR_VDS_ID MBR_CURR_CMS_CONTR_NUM MBR_CURR_CMS_PBP_CD MBR_MIDL_INIT MBR_GDR_CD MBR_ADR_LN1_TXT
        MBR_ADR_LN2_TXT MBR_ADR_CTY_NM MBR_ADR_ST_CD MBR_DAY_PH_NUM MBR_INCNT_PGM_IND MBR_TYP_CD SRC_SYS
        ASGN_PROV_VDS_ID ASGN_PROV_LST_NM ASGN_PROV_FST_NM ASGN_PROV_ADR_LN1_TXT ASGN_PROV_ADR_LN2_TXT
        ASGN_PROV_ADR_CTY_NM ASGN_PROV_ADR_ST_CD MSR_51_MAD_CYR_STS MSR_52_MAH_CYR_STS MSR_53_MAC_CYR_STS
        MSR_100_SUPD_CYR_STS ASSOC_PROV_VDS_ID ASSOC_PROV_LST_NM ASSOC_PROV_FST_NM ASSOC_PROV_ADR_LN1_TXT
        ASSOC_PROV_ADR_LN2_TXT ASSOC_PROV_ADR_CTY_NM ASSOC_PROV_ADR_ST_CD ASSOC_PROV_ASGN_RNDR_IND
        ASSOC_PROV_GRP_TYP_CD ASSOC_PROV_GRP_ID ASSOC_PROV_GRP_NM ASSOC_HLTH_SYS_ID ASSOC_HLTH_SYS_NM
        LST_HICN_BFR_MBI PARTD_ALRT_LVL_86""".split(),
    "flag": """
        MBR_DIAB_IND MSR_1_BCS_RSLT MSR_2_COL_RSLT MSR_3_CMCSCR_RSLT MSR_4_CDCLPP_RSLT MSR_5_GSO_RSLT
        MSR_12_ABA_RSLT MSR_13_COAMR_RSLT MSR_14_COAFSA_RSLT MSR_15_COAPS_RSLT MSR_16_OMW_RSLT
        MSR_91_OMWX_RSLT MSR_17_CDCEYE_RSLT MSR_18_CDCNEP_RSLT MSR_19_CDCA1C9_RSLT MSR_20_CDC100_RSLT
        MSR_49_HRM_PYR_RSLT MSR_49_HRM_CYR_RSLT MSR_51_MAD_PYR_RSLT MSR_52_MAH_PYR_RSLT
        MSR_53_MAC_PYR_RSLT MSR_100_SUPD_PYR_RSLT MSR_100_SUPD_CYR_RSLT MSR_101_SPC_RSLT MSR_58_FMI_RSLT
        MSR_60_AMM_RSLT MSR_61_BBT_RSLT MSR_62_MPLM_RSLT MSR_64_COPD_RSLT MSR_71_PCE_SC_RSLT
        MSR_72_PCEBRON_RSLT MSR_73_AODRINITOT_RSLT MSR_74_EADT_RSLT MSR_RSLT_86 MSR_RSLT_CY_86""".split(),
    "day": "MBR_ANNL_CARE_VST_DT MBR_ANNL_CARE_VST_DT_HC MSR_16_OMW_DT MSR_91_OMWX_DT".split(),
    "number": "ASGN_PROV_TIN_NUM ASSOC_PROV_MPIN_NUM ASSOC_PROV_TIN".split(),
    "wide": ["ASSOC_PROV_NPI_NUM"],
    "zip": ["ASSOC_PROV_ADR_ZIP_FULL_CD"],
    "small": """
        MSR_22_ART_RSLT MSR_51_MAD_CYR_RSLT MSR_51_MAD_FA_CYR_RSLT MSR_52_MAH_CYR_RSLT MSR_52_MAH_FA_CYR_RSLT
        MSR_53_MAC_CYR_RSLT MSR_53_MAC_FA_CYR_RSLT""".split(),
    "short": "MSR_51_MAD_AD MSR_51_MAD_DM45 MSR_52_MAH_AD MSR_52_MAH_DM45 MSR_53_MAC_AD MSR_53_MAC_DM45".split(),
    "share": """
        MSR_51_MAD_EOY_PDC_PRED MSR_52_MAH_CURR_PDC MSR_52_MAH_EOY_PDC_PRED MSR_53_MAC_CURR_PDC
        MSR_53_MAC_EOY_PDC_PRED""".split(),
}


def _pick(index: Column, *texts) -> Column:
    """The text at ``index`` modulo their number."""
    return F.element_at(F.array(*[t if isinstance(t, Column) else F.lit(t) for t in texts]),
                        (F.pmod(index, F.lit(len(texts))) + 1).cast("int"))


def _filled(kind: str, j: int) -> Column:
    """Raw text of column ``j`` of a kind: values that differ from column to column, blanks, several
    spellings of one value, text wider than its target, and (lenient kinds) text that does not fit."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    kj = k + j

    def text(c: Column) -> Column:
        return c.cast("string")

    if kind == "words":
        long = F.concat(F.char(65 + F.pmod(kj, F.lit(26))), F.lit(f"{j}-"), F.repeat(F.concat("c_mktsegment", F.lit("_")), 30))
        return F.when(F.pmod(k, F.lit(11)) == 5, F.lit("")).otherwise(long)
    if kind == "flag":
        return _pick(kj + F.col("is_frequent").cast("int"), "1", "0", "", "true", "False", "2.5", "-0.0")
    if kind == "day":
        d = F.make_date(1990 + n, (F.pmod(k, F.lit(12)) + 1).cast("int"), (F.pmod(kj, F.lit(28)) + 1).cast("int"))
        return _pick(kj, "", *[F.date_format(d, p) for p in ("yyyy-MM-dd", "yyyyMMdd", "M/d/yyyy")])
    if kind == "number":
        return _pick(kj, text(k * 3 + j), "", F.concat(F.lit("T"), text(k)), "9999999999")
    if kind == "wide":
        return _pick(kj, F.concat(F.lit("1"), F.lpad(text(k), 9, "0")), "N/A", "")
    if kind == "zip":
        full = F.concat(F.lpad(text(n), 5, "0"), F.lit("-"), F.lpad(text(F.pmod(k, F.lit(10000))), 4, "0"))
        return F.when(F.pmod(k, F.lit(5)) == 0, F.lit("")).otherwise(full)
    if kind == "small":
        v = text(F.pmod(k * 7 + j, F.lit(256)))
        return _pick(kj, "", F.concat(v, F.lit(".0")), v, v, v)
    if kind == "short":
        v = text(F.pmod(k * 31 + j, F.lit(65536)) - 32768)
        return _pick(kj, "", v, v, v, v)
    v = F.concat(F.lit("0."), F.lpad(text(F.pmod(kj, F.lit(1000))), 3, "0"))
    return _pick(kj, "", "n/a", "12.5", v, v)


def member_feed(snap: DataFrame, as_of: str) -> DataFrame:
    """The 118-column member feed (all text) for one monthly customer snapshot, every column filled.

    By name: key and names (text widths), report month (blank when the customer has no open order,
    so F1 drops the row), ids via int (some blank), a date in three layouts, ZIP with a dash, a bit,
    a lenient bigint and a junk lenient int, a float ZIP, a small int, a one-letter status, a
    decimal(3,2) that rounds, and a 23-character timestamp.  The others by ``FEED_FILL``."""
    from snapflow.plans import member_extract as ME
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    dob = F.make_date(F.lit(1940) + n, F.lit(6), F.lit(15))
    layout = F.pmod(n, F.lit(3))
    vals = {
        "MBR_HICN_NUM": F.concat(F.lit("H"), F.lpad(k.cast("string"), 10, "0")),
        "RPT_MO_KEY": F.when(F.col("open_priority").isNull(), F.lit(""))
                       .otherwise(F.col("snapshot_month")),
        "MBR_INDV_ID": F.when(n == 7, F.lit("")).otherwise(k.cast("string")),
        "MBR_CRD_ID": F.when(n == 9, F.lit("  ")).otherwise((k * 7).cast("string")),
        "MBR_LST_NM": F.col("c_name"),
        "MBR_FST_NM": F.col("c_mktsegment"),
        "MBR_DOB": F.when(layout == 0, F.date_format(dob, "yyyy-MM-dd"))
                    .when(layout == 1, F.date_format(dob, "yyyyMMdd"))
                    .otherwise(F.date_format(dob, "MM/dd/yyyy")),
        "MBR_ADR_ZIP_FULL_CD": F.concat(F.lpad(n.cast("string"), 5, "0"), F.lit("-1234")),
        "MBR_ANNL_CARE_VST_FLG": F.when(F.col("is_frequent"), F.lit("1")).otherwise(F.lit("0")),
        "ASGN_PROV_NPI_NUM": F.concat(F.lit("1"), F.lpad(k.cast("string"), 9, "0")),
        "ASGN_PROV_MPIN_NUM": F.concat(F.lit("X"), n.cast("string")),
        "ASGN_PROV_ADR_ZIP_FULL_CD": F.concat((F.lit(10000) + n).cast("string"), F.lit(".0")),
        "MSR_21_CBP_RSLT": F.substring("best_priority", 1, 1),
        "MSR_49_HRM_CYR_STS": F.coalesce(F.substring("open_priority", 1, 1), F.lit("")),
        "MSR_51_MAD_CURR_PDC": F.concat(F.lit("0."),
                                        F.lpad(F.pmod(k, F.lit(1000)).cast("string"), 3, "0")),
        "ROW_INSRT_DT": F.concat(F.lit("1998-01-"), F.lpad((n + 1).cast("string"), 2, "0"),
                                  F.lit(" 04:00:00.123")),
        "SegmentID": n.cast("string"),
    }
    vals.update({c: _filled(kind, j) for kind, names in FEED_FILL.items() for j, c in enumerate(names)})
    return _layout(snap, ME.FEED_COLUMNS, vals, blank="")


# a compressed file is read by one task: some 600 MB of feed text
FEED_FILE_ROWS = 50_000


def q_member_extract_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 end to end, two monthly runs: each run's feed lands in its own folder under the same
    delivered name, so the other compared columns decide what was updated; the job stages it,
    types it and merges it.  The table after the second run.

    A feed is by far the largest thing on disk (some 12 kB of text a customer): it lands as Snappy text
    when its run is due and is deleted after it, so one feed is there at a time.  Gzip would be smaller
    yet, but scans are cut by compressed bytes: so few of them leave cores idle."""
    from snapflow.operators.sinks import open_table
    from snapflow.plans import member_extract as ME
    from snapflow.plans import snapshots as S
    root = scratch_dir(spark, "member_extract")
    for run, (snap, as_of) in enumerate(zip(S.snapshots(spark, sf_dir), (S.AS_OF_1, S.AS_OF_2)), 1):
        cfg = ME.Config(landing=f"{root}/landing{run}", stage=f"{root}/stage", target=f"{root}/target")
        # a snapshot's rows are narrow: spread before they are widened
        write_delimited(member_feed(spread(snap, "c_custkey"), as_of),
                        f"{cfg.landing}/Master_Extract_Data_Mart_1998.txt", sep="|",
                        compression="snappy", rows_per_file=FEED_FILE_ROWS)
        ME.run(spark, cfg, as_of)
        drop_folder(spark, cfg.landing)
    return open_table(spark, cfg.target).read()
