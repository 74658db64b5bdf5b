"""Query registry: key -> Spark callable and key -> DuckDB SQL."""

from __future__ import annotations

from snapflow.plans import (job_queries as jq, source_queries as sq, stream_queries as st,
                            table_queries as tq)
from snapflow.plans.oracle import SQL

QUERIES = {
    "snapshot_merge": tq.q_snapshot_merge,
    "merge_summary": tq.q_merge_summary,
    "merge_insert_only": tq.q_merge_insert_only,
    "merge_null_safe": tq.q_merge_null_safe,
    "merge_collated": tq.q_merge_collated,
    "change_predicate": tq.q_change_predicate,
    "surrogate_key": tq.q_surrogate_key,
    "key_violations": tq.q_key_violations,
    "dedupe_top1": tq.q_dedupe_top1,
    "distinct_projection": tq.q_distinct_projection,
    "left_enrich": tq.q_left_enrich,
    "row_cap": tq.q_row_cap,
    "conform_union": tq.q_conform_union,
    "person_key": tq.q_person_key,
    "typed_projection": tq.q_typed_projection,
    "strict_cast": tq.q_strict_cast,
    "lenient_cast": tq.q_lenient_cast,
    "to_bit": tq.q_to_bit,
    "blank_to_null": tq.q_blank_to_null,
    "parse_date": tq.q_parse_date,
    "zip_clean": tq.q_zip_clean,
    "zip_split": tq.q_zip_split,
    "yyyymm": tq.q_yyyymm,
    "month_start": tq.q_month_start,
    "case_map": tq.q_case_map,
    "excel_serial_date": tq.q_excel_serial_date,
    "incident_filter": tq.q_incident_filter,
    "persistent_view": tq.q_persistent_view,
    "numeric_profile": tq.q_numeric_profile,
    "enforce_schema": tq.q_enforce_schema,
    "delimited_scan": sq.q_delimited_scan,
    "tab_scan": sq.q_tab_scan,
    "quoted_breaks_scan": sq.q_quoted_breaks_scan,
    "coerced_feed": sq.q_coerced_feed,
    "bad_line_quarantine": sq.q_bad_line_quarantine,
    "quarantine_count": sq.q_quarantine_count,
    "stage_rebuild": sq.q_stage_rebuild,
    "multi_feed_origin": sq.q_multi_feed_origin,
    "latest_file": sq.q_latest_file,
    "workbook_scan": sq.q_workbook_scan,
    "archive_expand": sq.q_archive_expand,
    "lineage_columns": sq.q_lineage_columns,
    "row_reconcile": sq.q_row_reconcile,
    "empty_guard": sq.q_empty_guard,
    "column_exclusion": sq.q_column_exclusion,
    "incidents_load": sq.q_incidents_load,
    "stream_arrival": st.q_stream_arrival,
    "stream_deliveries": st.q_stream_deliveries,
    "super_users_job": jq.q_super_users_job,
    "member_extract_job": jq.q_member_extract_job,
}

# the streamed table must equal the batch merge of the same two snapshots, whatever the order of arrival
_ARRIVED = f"""SELECT * FROM (VALUES ('in order'), ('repeated'), ('older last')) AS a(arrival),
               ({SQL['snapshot_merge']}) AS m"""
ORACLE = {k: v for k, v in {**SQL, "stream_arrival": SQL["snapshot_merge"], "stream_deliveries": _ARRIVED}.items() if k in QUERIES}
