"""Member extract job (G1): newest pipe feed -> stage -> typed projection -> snapshot merge.

Plan at scale: the feed text splits by size across tasks; staging is one write; the typed
projection is a single ``Project`` over ~120 columns (kept in whole-stage codegen by raising
``spark.sql.codegen.maxFields``); the merge is one full outer join that shuffles the source and
the target once each on ``MBR_HICN_NUM`` (unique, so no hot key), and the new version is written
clustered by that key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapflow.operators import merge as M
from snapflow.operators.project import Rule, typed_projection
from snapflow.operators.sinks import open_table, rebuild_stage
from snapflow.sources import archive, files
from snapflow.schemas import SchemaError, enforce_schema, layout
from snapflow.sources.delimited import read_delimited

# The member-extract layout in target order — output column, conversion rule,
# argument (text width / decimal precision,scale), source column when it differs.  Widths are
# the effective ones (the smaller of projection and table width).
MEMBER_LAYOUT = """
MBR_HICN_NUM text 12
RPT_MO_KEY int
MBR_VDS_ID text 25
MBR_INDV_ID int
MBR_INDV_ID_STR int_text 15 MBR_INDV_ID
MBR_CRD_ID int_text 30
MBR_CURR_CMS_CONTR_NUM text 5
MBR_CURR_CMS_PBP_CD text 3
MBR_LST_NM text 100
MBR_FST_NM text 100
MBR_MIDL_INIT text 1
MBR_DOB try_date
MBR_GDR_CD text 1
MBR_ADR_LN1_TXT text 100
MBR_ADR_LN2_TXT text 100
MBR_ADR_CTY_NM text 50
MBR_ADR_ST_CD text 2
MBR_ADR_ZIP_FULL_CD zip 10
MBR_DAY_PH_NUM text 15
MBR_ANNL_CARE_VST_FLG bit
MBR_ANNL_CARE_VST_DT date
MBR_ANNL_CARE_VST_DT_HC date
MBR_DIAB_IND bit
MBR_INCNT_PGM_IND text 25
MBR_TYP_CD text 5
SRC_SYS text 25
ASGN_PROV_VDS_ID text 25
ASGN_PROV_MPIN_NUM try_int
ASGN_PROV_NPI_NUM try_bigint
ASGN_PROV_TIN_NUM try_int
ASGN_PROV_LST_NM text 75
ASGN_PROV_FST_NM text 75
ASGN_PROV_ADR_LN1_TXT text 100
ASGN_PROV_ADR_LN2_TXT text 100
ASGN_PROV_ADR_CTY_NM text 50
ASGN_PROV_ADR_ST_CD text 2
ASGN_PROV_ADR_ZIP_FULL_CD float_text 10
MSR_1_BCS_RSLT bit
MSR_2_COL_RSLT bit
MSR_3_CMCSCR_RSLT bit
MSR_4_CDCLPP_RSLT bit
MSR_5_GSO_RSLT bit
MSR_12_ABA_RSLT bit
MSR_13_COAMR_RSLT bit
MSR_14_COAFSA_RSLT bit
MSR_15_COAPS_RSLT bit
MSR_16_OMW_RSLT bit
MSR_16_OMW_DT date
MSR_91_OMWX_RSLT bit
MSR_91_OMWX_DT date
MSR_17_CDCEYE_RSLT bit
MSR_18_CDCNEP_RSLT bit
MSR_19_CDCA1C9_RSLT bit
MSR_20_CDC100_RSLT bit
MSR_21_CBP_RSLT tinyint
MSR_22_ART_RSLT tinyint
MSR_49_HRM_PYR_RSLT bit
MSR_49_HRM_CYR_STS text 1
MSR_49_HRM_CYR_RSLT bit
MSR_51_MAD_PYR_RSLT bit
MSR_51_MAD_CYR_STS text 1
MSR_51_MAD_CYR_RSLT tinyint
MSR_51_MAD_CURR_PDC decimal 3,2
MSR_51_MAD_FA_CYR_RSLT tinyint
MSR_51_MAD_AD smallint
MSR_51_MAD_DM45 smallint
MSR_51_MAD_EOY_PDC_PRED decimal 3,2
MSR_52_MAH_PYR_RSLT bit
MSR_52_MAH_CYR_STS text 1
MSR_52_MAH_CYR_RSLT tinyint
MSR_52_MAH_CURR_PDC decimal 3,2
MSR_52_MAH_FA_CYR_RSLT tinyint
MSR_52_MAH_AD smallint
MSR_52_MAH_DM45 smallint
MSR_52_MAH_EOY_PDC_PRED decimal 3,2
MSR_53_MAC_PYR_RSLT bit
MSR_53_MAC_CYR_STS text 1
MSR_53_MAC_CYR_RSLT tinyint
MSR_53_MAC_CURR_PDC decimal 3,2
MSR_53_MAC_FA_CYR_RSLT tinyint
MSR_53_MAC_AD smallint
MSR_53_MAC_DM45 smallint
MSR_53_MAC_EOY_PDC_PRED decimal 3,2
MSR_100_SUPD_PYR_RSLT bit
MSR_100_SUPD_CYR_STS text 1
MSR_100_SUPD_CYR_RSLT bit
MSR_101_SPC_RSLT bit
MSR_58_FMI_RSLT bit
MSR_60_AMM_RSLT bit
MSR_61_BBT_RSLT bit
MSR_62_MPLM_RSLT bit
MSR_64_COPD_RSLT bit
MSR_71_PCE_SC_RSLT bit
MSR_72_PCEBRON_RSLT bit
MSR_73_AODRINITOT_RSLT bit
MSR_74_EADT_RSLT bit
ASSOC_PROV_VDS_ID text 25
ASSOC_PROV_MPIN_NUM try_int
ASSOC_PROV_NPI_NUM try_bigint
ASSOC_PROV_TIN try_int
ASSOC_PROV_LST_NM text 75
ASSOC_PROV_FST_NM text 75
ASSOC_PROV_ADR_LN1_TXT text 100
ASSOC_PROV_ADR_LN2_TXT text 100
ASSOC_PROV_ADR_CTY_NM text 50
ASSOC_PROV_ADR_ST_CD text 2
ASSOC_PROV_ADR_ZIP_FULL_CD zip 10
ASSOC_PROV_ASGN_RNDR_IND text 1
ASSOC_PROV_GRP_TYP_CD text 30
ASSOC_PROV_GRP_ID text 200
ASSOC_PROV_GRP_NM text 255
ASSOC_HLTH_SYS_ID text 255
ASSOC_HLTH_SYS_NM text 255
ROW_INSRT_DT timestamp
LST_HICN_BFR_MBI text 15
SegmentID tinyint
MSR_RSLT_86 bit
PARTD_ALRT_LVL_86 text 1
MSR_RSLT_CY_86 bit
"""

# Types, widths and NOT NULL of the target's columns.
TARGET = layout("""
MBR_HICN_NUM varchar(12) not null
RPT_MO_KEY int
MBR_VDS_ID varchar(25)
MBR_INDV_ID int
MBR_INDV_ID_STR varchar(15)
MBR_CRD_ID varchar(30)
MBR_CURR_CMS_CONTR_NUM varchar(5)
MBR_CURR_CMS_PBP_CD varchar(3)
MBR_LST_NM varchar(100)
MBR_FST_NM varchar(100)
MBR_MIDL_INIT varchar(1)
MBR_DOB date
MBR_GDR_CD varchar(1)
MBR_ADR_LN1_TXT varchar(100)
MBR_ADR_LN2_TXT varchar(100)
MBR_ADR_CTY_NM varchar(50)
MBR_ADR_ST_CD varchar(2)
MBR_ADR_ZIP_FULL_CD varchar(10)
MBR_DAY_PH_NUM varchar(15)
MBR_ANNL_CARE_VST_FLG boolean
MBR_ANNL_CARE_VST_DT date
MBR_ANNL_CARE_VST_DT_HC date
MBR_DIAB_IND boolean
MBR_INCNT_PGM_IND varchar(25)
MBR_TYP_CD varchar(5)
SRC_SYS varchar(25)
ASGN_PROV_VDS_ID varchar(25)
ASGN_PROV_MPIN_NUM int
ASGN_PROV_NPI_NUM bigint
ASGN_PROV_TIN_NUM int
ASGN_PROV_LST_NM varchar(100)
ASGN_PROV_FST_NM varchar(100)
ASGN_PROV_ADR_LN1_TXT varchar(100)
ASGN_PROV_ADR_LN2_TXT varchar(100)
ASGN_PROV_ADR_CTY_NM varchar(50)
ASGN_PROV_ADR_ST_CD varchar(2)
ASGN_PROV_ADR_ZIP_FULL_CD varchar(10)
MSR_1_BCS_RSLT boolean
MSR_2_COL_RSLT boolean
MSR_3_CMCSCR_RSLT boolean
MSR_4_CDCLPP_RSLT boolean
MSR_5_GSO_RSLT boolean
MSR_12_ABA_RSLT boolean
MSR_13_COAMR_RSLT boolean
MSR_14_COAFSA_RSLT boolean
MSR_15_COAPS_RSLT boolean
MSR_16_OMW_RSLT boolean
MSR_16_OMW_DT date
MSR_91_OMWX_RSLT boolean
MSR_91_OMWX_DT date
MSR_17_CDCEYE_RSLT boolean
MSR_18_CDCNEP_RSLT boolean
MSR_19_CDCA1C9_RSLT boolean
MSR_20_CDC100_RSLT boolean
MSR_21_CBP_RSLT smallint
MSR_22_ART_RSLT smallint
MSR_49_HRM_PYR_RSLT boolean
MSR_49_HRM_CYR_STS varchar(1)
MSR_49_HRM_CYR_RSLT boolean
MSR_51_MAD_PYR_RSLT boolean
MSR_51_MAD_CYR_STS varchar(1)
MSR_51_MAD_CYR_RSLT smallint
MSR_51_MAD_CURR_PDC decimal(3,2)
MSR_51_MAD_FA_CYR_RSLT smallint
MSR_51_MAD_AD smallint
MSR_51_MAD_DM45 smallint
MSR_51_MAD_EOY_PDC_PRED decimal(3,2)
MSR_52_MAH_PYR_RSLT boolean
MSR_52_MAH_CYR_STS varchar(1)
MSR_52_MAH_CYR_RSLT smallint
MSR_52_MAH_CURR_PDC decimal(3,2)
MSR_52_MAH_FA_CYR_RSLT smallint
MSR_52_MAH_AD smallint
MSR_52_MAH_DM45 smallint
MSR_52_MAH_EOY_PDC_PRED decimal(3,2)
MSR_53_MAC_PYR_RSLT boolean
MSR_53_MAC_CYR_STS varchar(1)
MSR_53_MAC_CYR_RSLT smallint
MSR_53_MAC_CURR_PDC decimal(3,2)
MSR_53_MAC_FA_CYR_RSLT smallint
MSR_53_MAC_AD smallint
MSR_53_MAC_DM45 smallint
MSR_53_MAC_EOY_PDC_PRED decimal(3,2)
MSR_100_SUPD_PYR_RSLT boolean
MSR_100_SUPD_CYR_STS varchar(1)
MSR_100_SUPD_CYR_RSLT boolean
MSR_101_SPC_RSLT boolean
MSR_58_FMI_RSLT boolean
MSR_60_AMM_RSLT boolean
MSR_61_BBT_RSLT boolean
MSR_62_MPLM_RSLT boolean
MSR_64_COPD_RSLT boolean
MSR_71_PCE_SC_RSLT boolean
MSR_72_PCEBRON_RSLT boolean
MSR_73_AODRINITOT_RSLT boolean
MSR_74_EADT_RSLT boolean
ASSOC_PROV_VDS_ID varchar(25)
ASSOC_PROV_MPIN_NUM int
ASSOC_PROV_NPI_NUM bigint
ASSOC_PROV_TIN int
ASSOC_PROV_LST_NM varchar(100)
ASSOC_PROV_FST_NM varchar(100)
ASSOC_PROV_ADR_LN1_TXT varchar(100)
ASSOC_PROV_ADR_LN2_TXT varchar(100)
ASSOC_PROV_ADR_CTY_NM varchar(50)
ASSOC_PROV_ADR_ST_CD varchar(2)
ASSOC_PROV_ADR_ZIP_FULL_CD varchar(10)
ASSOC_PROV_ASGN_RNDR_IND varchar(1)
ASSOC_PROV_GRP_TYP_CD varchar(30)
ASSOC_PROV_GRP_ID varchar(200)
ASSOC_PROV_GRP_NM varchar(255)
ASSOC_HLTH_SYS_ID varchar(255)
ASSOC_HLTH_SYS_NM varchar(255)
ROW_INSRT_DT timestamp_ntz
LST_HICN_BFR_MBI varchar(15)
SegmentID smallint
MSR_RSLT_86 boolean
PARTD_ALRT_LVL_86 varchar(1)
MSR_RSLT_CY_86 boolean
Load_Date_Py timestamp_ntz
CountOfFiles int
FileName varchar(255)
InsertDate timestamp_ntz
LastModifiedDate timestamp_ntz
DropDate timestamp_ntz
MnR_Status varchar(20)
MnR_SubStatus varchar(20)
""")

KEY = "MBR_HICN_NUM"
INSERT_ONLY = ("RPT_MO_KEY",)
NOT_COMPARED = ("MBR_INDV_ID_STR", "Load_Date_Py")
# Fixed value: file-name pattern of the member feed.
FEED_PATTERN = "Master_Extract_Data_Mart_*"


def _parse(layout: str) -> list[Rule]:
    rules = []
    for ln in layout.strip().splitlines():
        parts = ln.split()
        out, kind = parts[0], parts[1]
        arg = None
        if len(parts) > 2:
            a = parts[2]
            arg = tuple(int(x) for x in a.split(",")) if "," in a else int(a)
        src = parts[3] if len(parts) > 3 else out
        rules.append(Rule(src, kind, arg, out))
    return rules


RULES = _parse(MEMBER_LAYOUT)
FEED_COLUMNS = list(dict.fromkeys(r.src for r in RULES))          # 118 feed columns
TYPED_COLUMNS = [r.name for r in RULES] + ["Load_Date_Py", "FileName"]


def spec(parity: bool = False) -> M.MergeSpec:
    """127-column target: 121 typed columns + counter + 5 lifecycle columns.  ``parity``
    reproduces the reference's quirks (Q1 counter from source, Q11 no reactivation, Q12 drop
    time refreshed)."""
    update = [c for c in TYPED_COLUMNS if c != KEY and c not in INSERT_ONLY]
    compare = [c for c in update if c not in NOT_COMPARED]
    return M.spec(KEY, TYPED_COLUMNS, update, compare_cols=compare,
                  status_col="MnR_Status", substatus_col="MnR_SubStatus",
                  counter_base="source" if parity else "target",
                  reactivate=not parity, restamp_drops=parity)


def typed_source(stage: DataFrame, blank_bit_false: bool = False) -> DataFrame:
    """P11 + F1: the typed projection; rows without a report month are dropped."""
    extra = {"Load_Date_Py": F.col("Date_Ingested").cast(T.TimestampNTZType()),
             "CountOfFiles": F.lit(1),
             "FileName": F.left(F.col("FileName"), F.lit(255))}
    return typed_projection(stage, RULES, not_null="RPT_MO_KEY", blank_bit_false=blank_bit_false,
                            extra=extra)


def fitted_columns() -> set[str]:
    """Columns whose conversion rule cuts text to the target's width or less."""
    width = {f.name: f.metadata.get("max_chars") for f in TARGET.fields}
    return {r.name for r in RULES if width[r.name] and isinstance(r.arg, int) and r.arg <= width[r.name]} | {"FileName"}


def target_source(stage: DataFrame, blank_bit_false: bool = False) -> DataFrame:
    """K4: the typed projection in the target's columns, order and types; a NULL key or a text that is
    wider than its column stops the job."""
    columns = T.StructType([f for f in TARGET.fields if f.name in TYPED_COLUMNS])
    typed = typed_source(stage, blank_bit_false).select(*columns.fieldNames())
    return enforce_schema(typed, columns, fitted=fitted_columns())


def target_table(merged: DataFrame) -> DataFrame:
    """The merged table in the target's column order; types are checked by name."""
    have = {f.name: f.dataType for f in merged.schema.fields}
    wrong = {f.name: (have.get(f.name), f.dataType) for f in TARGET.fields if have.get(f.name) != f.dataType}
    if wrong or len(have) != len(TARGET.fields):
        raise SchemaError(f"the merged table differs from its layout: {wrong or sorted(set(have) - set(TARGET.fieldNames()))}")
    return merged.select(*TARGET.fieldNames())


@dataclass
class Config:
    landing: str          # folder where feed files (.txt / .zip) arrive
    stage: str            # staging table path (rebuilt each run)
    target: str           # versioned master table root
    parity: bool = False
    quarantine: str | None = None   # folder for refused records; None: beside the stage
    buckets: int | None = None   # target bucket count (K6); None = shuffle partitions, 0 = off


def run(spark: SparkSession, cfg: Config, as_of: str) -> dict:
    """G1 end to end; returns row counts for reconciliation."""
    archive.expand_newest(spark, cfg.landing, zip_pattern=FEED_PATTERN + ".zip",
                          txt_pattern=FEED_PATTERN + ".txt")
    newest = files.latest_feed(spark, cfg.landing, FEED_PATTERN + ".txt")
    if newest is None:
        raise FileNotFoundError(f"no {FEED_PATTERN}.txt under {cfg.landing}")
    feed = read_delimited(spark, newest[0], FEED_COLUMNS, sep="|", lineage_as_of=as_of,
                          ingest_col="Date_Ingested", observe=True, feed_name=newest[1])
    staged_rows = rebuild_stage(feed.good, cfg.stage)
    refused = feed.metrics.get["quarantined"]
    # refused records are kept, in the same replace-per-run manner as the stage; none: no second scan
    kept = (cfg.quarantine or cfg.stage.rstrip("/") + "_quarantine").rstrip("/")
    # no rows, known to the optimizer: no Python worker is started for them
    empty = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in feed.quarantine.schema])
    rebuild_stage(feed.quarantine if refused else empty, kept)
    loaded = spark.read.parquet(cfg.stage).count()
    from snapflow.operators.checks import reconcile
    reconcile(staged_rows, loaded, "member stage")
    source = target_source(spark.read.parquet(cfg.stage), blank_bit_false=cfg.parity)
    metrics = M.merge_into_table(spark, open_table(spark, cfg.target, cfg.buckets), source,
                                 spec(cfg.parity), as_of)
    # counted during the stage write
    metrics.update({"staged": staged_rows, "quarantined": refused, "quarantine": kept, "file": newest[1]})
    return metrics
