"""Incidents load (G3): filtered relational scan -> batch stamp -> replace stage -> count check.

The source is read with ``spark.read.jdbc`` (S6): the equality and IN-list filter (F2) is
pushed into the source query, and ``partitionColumn``/``numPartitions`` split the scan into
parallel range reads.  The same filter applies to any DataFrame source (Parquet pushes it into
the scan too), which is how the operator query runs on the driver's tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapflow.operators import checks
from snapflow.operators.sinks import rebuild_reconciled
from snapflow.schemas import enforce_schema, layout


# Types, widths and NOT NULL of the target's columns.
TARGET = layout("""
IN_ID varchar(12) not null
IN_CATEGORY string
OPEN_TIME timestamp_ntz
UH_OPENED_BY_ID string
PRIORITY_CODE string
UPDATE_TIME timestamp_ntz
ASSIGNMENT string
STATUS string
CLOSE_TIME timestamp_ntz
UH_CLOSED_BY_ID string
RESOLUTION_CODE string
LOGICAL_NAME string
ACTION string
RESOLUTION string
ASSIGNEE_NAME string
UPDATE_ACTION string
BRIEF_DESCRIPTION string
PROBLEM_STATUS string
SUBCATEGORY string
PRODUCT_TYPE string
PROBLEM_TYPE string
ALTERNATE_PHONE string
AFFECTED_ITEM string
UH_ASSIGNEE_FULL_NAME string
UH_CALLBACK_CONTACT string
UH_CALLBACK_TYPE string
UH_SPARK_INCIDENT bigint
UH_NEEDED_BY_TIME timestamp_ntz
UH_ALTERNATE_FULL_NAME string
UH_ALTERNATE_PHONE string
UH_INCIDENT_TYPE string
UH_PLANNED_FINISH timestamp_ntz
UH_WORKAROUND string
UH_ASSIGNMENT_COUNTER bigint
UH_IT_ESCALATION string
UH_RESTORATION_GOAL bigint
UH_IT_EXEC string
UH_RESTORE_TIME timestamp_ntz
UH_PENDING_CLOSED timestamp_ntz
UH_ICT_CONTACT string
UH_ESS_TICKET bigint
UH_ALERT string
UH_REFERENCE_NUMBER_1 string
UH_REFERENCE_NUMBER_2 string
UH_CLASSIFICATION string
UH_PENDING_CLOSED_ID string
UH_WORKFROM string
UH_REQUEST_PERSON string
UH_REQUEST_PERSON_NAME string
UH_REQUEST_PERSON_NUMBER string
UH_ESS_ERRORMSG string
UH_ESS_STEPSTAKEN string
UH_ESS_ISSUETIME string
UH_LOGICAL_NAME string
UH_AFFECTED_ITEM string
UH_EXECUTIVE_ARRAY string
UH_UNDEFINED_CI1 string
UH_MISSED_SLA string
UH_REOPENED_COUNTER bigint
UH_REFERENCE_NUMBER_3 string
UH_REFERENCE_NUMBER_4 string
UH_REFERENCE_NUMBER_5 string
UH_REFERENCE_NUMBER_6 string
UPDATE_ACTION_ESS string
UH_ESS_APP_NOTWORKING string
UH_UNDEFINED_SERVICE string
UH_MACHINE_NAME string
UH_LOCK_RECORD string
UH_USC_KNOWLEDGE string
UH_CSS_KNOWLEDGE string
UH_START_TIME string
UH_RESTORED_DURATION double
EVENT_ID string
TOTAL_ADTM string
UH_CAUSED_BY_CHANGE bigint
UH_UPDATED_BY string
UH_VALIDATED bigint
UH_START_INVOLVEMENT string
UH_INVOLVEMENT_END string
UH_DIAGNOSIS_COMPLETE string
UH_RESTORATION string
UH_WAR_ROOM_END string
UH_NUMBER_ISSUE string
TEMPLATE_NAME string
SLA_MULTIPLIER bigint
SLA_MULTIPLIER_XWT double
RESTORED_DURATION_XWT double
ATTACHMENTS bigint
CUSTOMER_IMPACT string
AFF_SRV_CONCAT string
AFF_SRV_CONCAT_UCMDB string
MAN_SRV_CONCAT string
MAN_SRV_CONCAT_UCMDB string
REL_SRV_CONCAT string
REL_SRV_CONCAT_UCMDB string
UH_HIGH_PRIORITY_SVC_IMPACT string
UH_ISSUE_TYPE string
UH_USC_PRODUCT string
UH_GL_CODE string
COMPANY string
UH_UCC_MANAGED string
UH_SERVICE_IMPACT string
UH_SEC_INC_CNT bigint
UH_SVC_CMPLNT_CNT bigint
UH_PLATFORM_TYPE string
UH_CONNECTION_TYPE string
UH_ESS_COMMENTS string
UH_SET_DEADLINE timestamp_ntz
UH_ADTM_VAL_COMM string
UH_SLA_GROUP string
LIABLE_ADTM string
UH_EXTERNAL_CLIENT_UPDATE string
UH_CUSTOMER_ESCALATION string
UH_RESPONSE_DEADLINE timestamp_ntz
UH_RESPONSE_GOAL_ACHIEVED string
UH_RESPONSE_TIME timestamp_ntz
UH_RESOURCE_ID string
SN_CONTACT_TYPE string
SN_SYS_ID string
SN_PARENT_ID string
SN_PROBLEM_ID string
SN_CLASSIFICATION_2 string
SN_CLASSIFICATION_3 string
SN_WR_RESTORE_TIME string
SN_WG_SYS_ID string
SN_KNOWLEDGE_ID_FLAG bigint
SN_CREATED_IN_BUS_HRS_FLAG string
SN_WORK_IN_PROGRESS_ON timestamp_ntz
SN_RESTORED_ON string
SN_WAITING_CLIENT_ON timestamp_ntz
SN_WAITING_IT_ON timestamp_ntz
SN_CANCELLED_ON string
SN_RESPONDED_ON timestamp_ntz
SN_CTS_OUTAGE_MINUTES bigint
SN_FAILED_SERVICE string
SN_POLARIS_PROGRAM bigint
SN_SUBCATEGORY2 string
SN_CAUSED_BY_CHANGE string
SN_CBA_ADTM string
SN_REOPEN_CALLER_CNT bigint
SN_ALT_EMAIL_ADD string
SN_ISSUE_RESOLVED_TICKET_ONLY bigint
SN_USER_BUSSINESS_IMPACT string
Date_Ingested timestamp_ntz
""")


def select_incidents(df: DataFrame, assignment: str, references, as_of: str,
                     assignment_col: str = "ASSIGNMENT",
                     reference_col: str = "UH_REFERENCE_NUMBER_1") -> DataFrame:
    """F2 + P5: ``assignment_col = assignment AND reference_col IN (references)``, then the load
    time as one batch constant (not per row)."""
    f = df.where((F.col(assignment_col) == F.lit(assignment))
                 & F.col(reference_col).isin(list(references)))
    return f.withColumn("Date_Ingested", F.lit(as_of).cast(T.TimestampNTZType()))


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Relational scan; with a partition column the read is split into range queries."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions or 8))
    return reader.load()


def run(spark: SparkSession, source: DataFrame, stage_path: str, assignment: str, references,
        as_of: str, target: T.StructType | None = None, **cols) -> dict:
    """Filter, stamp, replace the stage (K3) and reconcile what it holds, rows and contents.
    ``target``: the layout that the stage must have (K4), ``TARGET`` for the incidents' own source."""
    out = select_incidents(source, assignment, references, as_of, **cols)
    if target is not None:
        out = enforce_schema(out, target)
    expected, loaded = rebuild_reconciled(out, stage_path)
    checks.reconcile_contents(expected, loaded, "incidents")
    return {"expected": expected.rows, "loaded": loaded.rows}
