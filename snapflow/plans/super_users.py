"""Super-users job (G2): three lines of business -> one layout -> person key -> snapshot merge.

E&I: keep the first row per individual (W1, partial ``WindowGroupLimit`` before the shuffle),
left-join the DISTINCT-reduced ACO detail (J1).  M&R: DISTINCT over the conformed rows (A1).
C&S: two workbooks tagged by origin (S8, X21).  The union (U1) gets the MD5 person key (X17)
and the number of lines of business sharing the person (W2, an aggregate joined back so a hot
person group is split), then is merged on ``Member_ID`` with surrogate identities (M7).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapflow.functions import casts as C, dates as D, text as X
from snapflow.operators import conform as CF, keys, merge as M
from snapflow.operators.checks import reconcile
from snapflow.operators.dedupe import top1_per_key
from snapflow.operators.sinks import rebuild_stage
from snapflow.schemas import enforce_schema, layout
from snapflow.session import scratch_dir, together
from snapflow.sources import files
from snapflow.sources.delimited import read_delimited
from snapflow.sources.workbook import read_workbooks

# Staging layouts of the four feeds (header names as delivered).
MR_COLUMNS = """hicn bth_dt GPS_FIRST_NAME GPS_LAST_NAME FIN_GENDER gps_zip_cd GPS_ADDRESS_LINE_1
GPS_CITY FIN_STATE GPS_DAYTIME_PHONE_NUM fin_county_name FIN_ESRD_FLAG hospice
GPS_SPOKEN_LANGUAGE_NAME GPS_DO_NOT_CALL aco_flag PMG_NAME FIN_CONTRACT_NBR FIN_PBP product
FIN_DERIVED_MCAID_STATUS_FLG age hcc paid_r12 pred_cutoff pred pred_flag ip_acute_cnt ip_pd_amt
op_er_cnt op_er_pd_amt gps_new_group_number FIN_G_I CHF_eng DIAB_eng ESRD_eng TCM_eng HRCM_eng
AI_eng chronic institutional agecat hicn_old ASGN_TO_USER_ID external_care_manager case_manager
ANY_OPTUM_PGM""".split()
CS_COLUMNS = """year_mo Member_Key COMPANY_DESC pred_model pred_model_cutoff pred_model_flag
Member_First_Name Member_Last_Name Member_DOB Subscriber_ID Member_City Member_State Member_Zip
Member_Sex HCFA_CNTY_NM""".split()
EI_COLUMNS = """MBR_ID indv_id age dob MBR_FST_NM MBR_LST_NM MBR_GDR_CD MKT_RLLP_NM MKT_SEG_CD
CUST_SEG_NBR Exchange_Ind MBR_ZIP_CD MBR_CTY_NM MBR_HCFA_CNTY_NM MBR_ST_ABBR_CD pred pred_flag
pred_cutoff RCT chf esrd""".split()
EI_ACO_COLUMNS = """MBR_ID referral condition_count pred_flag year_mo MKT_RLLP_NM PRSPCTV_RISK pred
CUST_SEG_NBR chf esrd indv_id group_nm ACO Exchange_ind aco_flag""".split()
LINEAGE = ["date_ingested", "FileName"]

# Line-of-business labels and C&S origin codes.
LOB_EI, LOB_MR, LOB_CS = "E&I", "M&R", "C&S"
ORIGINS = {"mcd": "medicaid", "mcr": "medicare"}

# The common layout of the union (text until the final projection types it).
# Fixed values.
UNION_LAYOUT = T.StructType([T.StructField(n, T.StringType()) for n in """LineOfBusiness YYYYMM
Member_ID MemberFirstName MemberLastName Member_DOB Subscriber_ID Indv_ID MemberGender
HCE_PredictiveScore PredictiveFlag PredictiveCutoff ACO_Flag ACO_Name ExchangeInd
CustomerSegmentNumber GroupName EI_Referral MarketRollup MarketSegment MemberZipCd
MemberZipPlus4Cd MemberCityName MemberCounty MemberState RCT MR_ContractNumber MR_PBP MR_Product
MR_PMG_Name GI CongestiveHeartFailure Diabetes EndStageRenal TCM_eng HRCM_eng AI_eng
Any_Optum_Program CS_MemberKey CS_CompanyState CS_file_origin load_date_py FileName""".split()])

# Fixed values.
EI_MAP = {
    "Member_ID": "MBR_ID", "MemberFirstName": "MBR_FST_NM", "MemberLastName": "MBR_LST_NM",
    "Member_DOB": "dob", "Indv_ID": "indv_id", "MemberGender": "MBR_GDR_CD",
    "HCE_PredictiveScore": "pred", "PredictiveFlag": "pred_flag",
    "PredictiveCutoff": "pred_cutoff", "ACO_Flag": "aco_aco_flag", "ACO_Name": "aco_group_nm",
    "ExchangeInd": "Exchange_Ind", "CustomerSegmentNumber": "CUST_SEG_NBR",
    "GroupName": "aco_group_nm", "EI_Referral": "aco_referral", "MarketRollup": "MKT_RLLP_NM",
    "MarketSegment": "MKT_SEG_CD", "MemberZipCd": "MBR_ZIP_CD", "MemberCityName": "MBR_CTY_NM",
    "MemberCounty": "MBR_HCFA_CNTY_NM", "MemberState": "MBR_ST_ABBR_CD", "RCT": "RCT",
    "FileName": "FileName",
}
# Fixed values.
MR_MAP = {
    "Member_ID": "hicn", "MemberFirstName": "GPS_FIRST_NAME", "MemberLastName": "GPS_LAST_NAME",
    "Member_DOB": "bth_dt", "MemberGender": "FIN_GENDER", "HCE_PredictiveScore": "pred",
    "PredictiveFlag": "pred_flag", "PredictiveCutoff": "pred_cutoff", "ACO_Flag": "aco_flag",
    "MemberCityName": "GPS_CITY", "MemberCounty": "fin_county_name", "MemberState": "FIN_STATE",
    "MR_ContractNumber": "FIN_CONTRACT_NBR", "MR_PBP": "FIN_PBP", "MR_Product": "product",
    "MR_PMG_Name": "PMG_NAME", "GI": "FIN_G_I", "CongestiveHeartFailure": "CHF_eng",
    "Diabetes": "DIAB_eng", "EndStageRenal": "ESRD_eng", "TCM_eng": "TCM_eng",
    "HRCM_eng": "HRCM_eng", "AI_eng": "AI_eng", "Any_Optum_Program": "ANY_OPTUM_PGM",
    "FileName": "FileName",
}
# Fixed values.
CS_MAP = {
    "Member_ID": "Member_Key", "MemberFirstName": "Member_First_Name",
    "MemberLastName": "Member_Last_Name", "Member_DOB": "Member_DOB",
    "Subscriber_ID": "Subscriber_ID", "MemberGender": "Member_Sex",
    "HCE_PredictiveScore": "pred_model", "PredictiveFlag": "pred_model_flag",
    "PredictiveCutoff": "pred_model_cutoff", "MemberZipCd": "Member_Zip",
    "MemberCityName": "Member_City", "MemberCounty": "HCFA_CNTY_NM",
    "MemberState": "Member_State", "CS_MemberKey": "Member_Key", "CS_CompanyState": "COMPANY_DESC",
    "FileName": "FileName",
}
# Fixed values.
ACO_KEEP = ["MBR_ID", "pred", "pred_flag", "aco_flag", "ACO", "group_nm", "referral",
            "PRSPCTV_RISK", "condition_count"]

KEY = "Member_ID"
# Fixed values.
INSERT_ONLY = ("Member_Key", "LineOfBusiness", "YYYYMM", "Load_Date_Py")
# Fixed values.
COMPARED = """MemberFirstName MemberLastName Member_DOB Subscriber_ID Indv_ID MemberGender
HCE_PredictiveScore Is_PSU PSU_Score_Cutoff ACO_Flag ACO_Name ExchangeInd CustomerSegmentNumber
GroupName EI_Referral MarketRollup MarketSegment MemberZipCd MemberZipPlus4Cd MemberCityName
MemberCounty MemberState RCT MR_ContractNumber MR_PBP MR_Product MR_PMG_Name GI
CongestiveHeartFailure Diabetes EndStageRenal TCM_eng HRCM_eng AI_eng Any_Optum_Program
CS_MemberKey CS_CompanyState CS_file_origin FileName""".split()
# Fixed values.
TARGET_COLUMNS = """Member_Key LineOfBusiness YYYYMM Member_ID MemberFirstName MemberLastName
Member_DOB Subscriber_ID Indv_ID CS_MemberKey CS_CompanyState CS_file_origin MemberGender
HCE_PredictiveScore Is_PSU PSU_Score_Cutoff ACO_Flag ACO_Name ExchangeInd CustomerSegmentNumber
GroupName EI_Referral MarketRollup MarketSegment MemberZipCd MemberZipPlus4Cd MemberCityName
MemberCounty MemberState MR_ContractNumber MR_PBP MR_Product MR_PMG_Name GI CongestiveHeartFailure
Diabetes EndStageRenal TCM_eng HRCM_eng AI_eng Any_Optum_Program RCT Load_Date_Py CountOf_LOB
FileName""".split()

# Types, widths and NOT NULL of the target's columns.
TARGET = layout("""
Member_Key varchar(32) not null
LineOfBusiness varchar(3) not null
YYYYMM varchar(6)
Member_ID varchar(50) not null
MemberFirstName varchar(255)
MemberLastName varchar(255)
Member_DOB date
Subscriber_ID varchar(50)
Indv_ID varchar(50)
CS_MemberKey varchar(50)
CS_CompanyState varchar(50)
CS_file_origin varchar(20)
MemberGender varchar(3)
HCE_PredictiveScore decimal(10,4)
Is_PSU boolean
PSU_Score_Cutoff decimal(10,4)
ACO_Flag boolean
ACO_Name varchar(255)
ExchangeInd varchar(1)
CustomerSegmentNumber varchar(20)
GroupName varchar(255)
EI_Referral varchar(10)
MarketRollup varchar(255)
MarketSegment varchar(3)
MemberZipCd varchar(10)
MemberZipPlus4Cd varchar(10)
MemberCityName varchar(255)
MemberCounty varchar(255)
MemberState varchar(2)
MR_ContractNumber varchar(10)
MR_PBP varchar(10)
MR_Product varchar(50)
MR_PMG_Name varchar(50)
GI varchar(10)
CongestiveHeartFailure int
Diabetes int
EndStageRenal int
TCM_eng int
HRCM_eng int
AI_eng int
Any_Optum_Program int
RCT int
Load_Date_Py timestamp_ntz
CountOf_LOB int
CountOfFiles int
FileName varchar(255)
""")


def conform_ei(ei: DataFrame, aco: DataFrame, keyless: str = "keep") -> DataFrame:
    """cte_ei: first row per individual by flag (Q3 tie-break on member id; Q5 keyless rows
    kept unless ``keyless='collapse'``), enriched with the distinct ACO detail."""
    first = top1_per_key(ei, "indv_id", ["-pred_flag", "MBR_ID"], keyless=keyless)
    reduced = aco.select(*ACO_KEEP).distinct().select(
        "MBR_ID", *[F.col(c).alias(f"aco_{c}") for c in ACO_KEEP if c != "MBR_ID"])
    joined = first.join(reduced, "MBR_ID", "left")
    mapping = dict(EI_MAP)
    mapping.update({
        "YYYYMM": D.yyyymm("date_ingested"),
        "load_date_py": F.left(F.col("date_ingested").cast("string"), F.lit(19)),
    })
    return CF.conform(joined, UNION_LAYOUT, mapping, {"LineOfBusiness": LOB_EI})


def conform_mr(mr: DataFrame) -> DataFrame:
    """cte_mr: ZIP split into 5 + 4 (X12, X13, X22), DISTINCT over the conformed row (Q15)."""
    mapping = dict(MR_MAP)
    mapping.update({
        "YYYYMM": D.yyyymm("date_ingested"),
        "MemberZipCd": X.zip5("gps_zip_cd"),
        "MemberZipPlus4Cd": X.zip_plus4("gps_zip_cd"),
        "load_date_py": F.left(F.col("date_ingested").cast("string"), F.lit(19)),
    })
    return CF.conform(mr, UNION_LAYOUT, mapping, {"LineOfBusiness": LOB_MR}).distinct()


def conform_cs(cs: DataFrame) -> DataFrame:
    """cte_cs: origin code mapped to a label, unknown codes get the error label."""
    mapping = dict(CS_MAP)
    mapping.update({
        "YYYYMM": D.yyyymm("date_ingested"),
        "CS_file_origin": CF.case_map("file_origin", ORIGINS),
        "load_date_py": F.left(F.col("date_ingested").cast("string"), F.lit(19)),
    })
    return CF.conform(cs, UNION_LAYOUT, mapping, {"LineOfBusiness": LOB_CS})


def source_rows(union: DataFrame) -> DataFrame:
    """cte_source: person key, 'nan' repairs, lenient decimals, typed flags, LOB count."""
    fn, ln = F.col("MemberFirstName"), F.col("MemberLastName")
    dob = C.parse_date("Member_DOB")
    zip_ = F.col("MemberZipCd")
    u = union.withColumn("Member_DOB", dob)
    out = u.select(
        keys.person_key([fn, ln, F.col("Member_DOB"), zip_], lower_first=2).alias("Member_Key"),
        F.left("LineOfBusiness", F.lit(3)).alias("LineOfBusiness"), "YYYYMM", "Member_ID",
        "MemberFirstName", "MemberLastName", "Member_DOB", "Subscriber_ID",
        X.sentinel_to_null("Indv_ID").alias("Indv_ID"), "CS_MemberKey", "CS_CompanyState",
        "CS_file_origin", "MemberGender",
        C.lenient("HCE_PredictiveScore", "decimal(10,4)").alias("HCE_PredictiveScore"),
        C.to_bit("PredictiveFlag").alias("Is_PSU"),
        C.lenient("PredictiveCutoff", "decimal(10,4)").alias("PSU_Score_Cutoff"),
        C.to_bit("ACO_Flag").alias("ACO_Flag"), "ACO_Name", "ExchangeInd",
        "CustomerSegmentNumber", "GroupName", "EI_Referral", "MarketRollup", "MarketSegment",
        "MemberZipCd", "MemberZipPlus4Cd", "MemberCityName", "MemberCounty",
        X.sentinel_to_null("MemberState").alias("MemberState"),
        "MR_ContractNumber", "MR_PBP", "MR_Product", "MR_PMG_Name", "GI",
        *[C.lenient(c, "int").alias(c) for c in ("CongestiveHeartFailure", "Diabetes",
                                                  "EndStageRenal", "TCM_eng", "HRCM_eng",
                                                  "AI_eng", "Any_Optum_Program", "RCT")],
        F.left("load_date_py", F.lit(19)).cast("timestamp_ntz").alias("Load_Date_Py"),
        F.lit(1).alias("CountOfFiles"), "FileName")
    grp = {"fn": F.lower("MemberFirstName"), "ln": F.lower("MemberLastName"),
           "dob": F.col("Member_DOB"), "zip": F.col("MemberZipCd")}
    counted = keys.count_over(out, grp, "CountOf_LOB")
    return counted.select(*TARGET_COLUMNS, "CountOfFiles")


def spec(parity: bool = False) -> M.MergeSpec:
    update = [c for c in TARGET_COLUMNS if c != KEY and c not in INSERT_ONLY]
    return M.spec(KEY, TARGET_COLUMNS, update, compare_cols=COMPARED,
                  status_col="SuperUser_Status", substatus_col="SuperUser_SubStatus",
                  surrogate_col="Primary_Key", reactivate=not parity, restamp_drops=parity)


def build_source(ei: DataFrame, aco: DataFrame, mr: DataFrame, cs: DataFrame,
                 keyless: str = "keep") -> DataFrame:
    return source_rows(CF.union_all([conform_ei(ei, aco, keyless), conform_mr(mr),
                                     conform_cs(cs)]))


@dataclass
class Config:
    """Feeds are files or folders of part files.  Where ``patterns`` has a pattern for a feed, its
    path is a landing folder instead and the newest match in it is read (S1)."""
    ei: str
    ei_aco: str
    mr: str
    cs_mcr: str
    cs_mcd: str
    target: str
    parity: bool = False
    on_duplicate: str = "error"
    buckets: int | None = None   # target bucket count (K6); None = shuffle partitions, 0 = off
    patterns: dict[str, str] = field(default_factory=dict)
    stage: str | None = None     # staged feeds and quarantined lines; None = the shared scratch folder


FEEDS = {"ei": EI_COLUMNS, "ei_aco": EI_ACO_COLUMNS, "mr": MR_COLUMNS, "cs_mcr": CS_COLUMNS,
         "cs_mcd": CS_COLUMNS}


def stage_feeds(spark: SparkSession, cfg: Config, as_of: str) -> tuple[dict[str, DataFrame], dict]:
    """Every feed is read once, written to its stage and counted there.  Lines that the
    delimited reader refuses (R3) are kept below ``quarantine/`` and counted as well."""
    root = (cfg.stage or scratch_dir(spark, "super_users_stage")).rstrip("/")

    def one(feed: str, columns: list[str]) -> tuple[DataFrame, int, int | None]:
        path, name = getattr(cfg, feed), None
        if feed in cfg.patterns:
            newest = files.latest_feed(spark, path, cfg.patterns[feed])
            if newest is None:
                raise FileNotFoundError(f"no {cfg.patterns[feed]} under {path}")
            path, name = newest
        if feed in ("ei", "ei_aco"):
            read = read_delimited(spark, path, columns, sep="\t", nan_text=True, blank_as_null=True,
                                  lineage_as_of=as_of, observe=True, feed_name=name)
            rows = read.good
        else:
            read, rows = None, read_workbooks(spark, path, columns, as_of)
        written = rebuild_stage(rows, f"{root}/{feed}")
        loaded = spark.read.parquet(f"{root}/{feed}")
        reconcile(written, loaded.count(), f"stage {feed}")
        bad = read.metrics.get["quarantined"] if read else None
        if bad:
            read.quarantine.write.mode("overwrite").parquet(f"{root}/quarantine/{feed}")
        return loaded, written, bad

    # the feeds do not depend on each other
    done = dict(zip(FEEDS, together(*[partial(one, feed, columns) for feed, columns in FEEDS.items()])))
    staged = {feed: loaded for feed, (loaded, _, _) in done.items()}
    metrics = {"staged": {feed: written for feed, (_, written, _) in done.items()},
               "quarantined": {feed: bad for feed, (_, _, bad) in done.items() if bad is not None}}
    return staged, metrics


def run(spark: SparkSession, cfg: Config, as_of: str, readers=None) -> dict:
    """Stage the five feeds (tab text for E&I, workbooks for M&R and C&S), build the source,
    hold it against the target layout (K4) and merge it.  Returns the merge's counts and those of
    the stages and the quarantine.  ``readers`` lets tests feed already-staged frames."""
    from snapflow.operators.sinks import open_table
    metrics: dict = {}
    if readers is None:
        f, metrics = stage_feeds(spark, cfg, as_of)
        cs = CF.union_all([f["cs_mcr"].withColumn("file_origin", F.lit("mcr")),
                           f["cs_mcd"].withColumn("file_origin", F.lit("mcd"))])
        readers = f["ei"], f["ei_aco"], f["mr"], cs
    source = build_source(*readers, "collapse" if cfg.parity else "keep")
    source = enforce_schema(source, TARGET)
    merged = M.merge_into_table(spark, open_table(spark, cfg.target, cfg.buckets), source, spec(cfg.parity),
                                as_of, on_duplicate=cfg.on_duplicate,
                                order_by=["LineOfBusiness", "Member_Key"])
    return {**merged, **metrics}


def persistent_super_users(spark: SparkSession, cfg: Config) -> DataFrame:
    """the consumer view of the merged table — members flagged ``Is_PSU`` — registered as
    the temporary view ``persistent_super_users`` and returned (a filter over the bucketed
    table: no shuffle, only the scan)."""
    from snapflow.operators.sinks import open_table
    view = open_table(spark, cfg.target, cfg.buckets).read().where(F.col("Is_PSU"))
    view.createOrReplaceTempView("persistent_super_users")
    return view
