"""Operator queries over the driver's tables, one callable per operator family.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole tables.
Column names equal those of the matching SQL in ``snapflow.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapflow.functions import casts as C, dates as D, text as X
from snapflow.operators import checks, conform as CF, dedupe, keys, merge as M
from snapflow.plans.snapshots import (read, snapshots, customer_spec, two_runs, SNAPSHOT_COLS)

STATUS_COLS = ["Status", "SubStatus"]


# --- 2.9 snapshot merge family -------------------------------------------------------------

def q_snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two monthly runs; the table after the second."""
    return two_runs(spark, sf_dir, customer_spec())


def q_merge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: rows per status / sub-status of the merged table."""
    ms = customer_spec()
    return M.merge_summary(two_runs(spark, sf_dir, ms), ms)


def q_merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: ``best_priority`` and ``snapshot_month`` are written on insert and never updated."""
    return two_runs(spark, sf_dir, customer_spec(insert_only=("snapshot_month", "best_priority")))


def q_merge_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 / Q13 with ``null_safe=True``: NULL <-> value transitions count as a change."""
    return two_runs(spark, sf_dir, customer_spec(null_safe=True))


def q_merge_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§1.4: the second snapshot arrives with names upper-cased and blank-padded (BUILDING) and
    segments lower-cased (AUTOMOBILE); under ``UTF8_LCASE_RTRIM`` those are not changes."""
    from snapflow.plans.snapshots import AS_OF_1, AS_OF_2
    s1, s2 = snapshots(spark, sf_dir)
    seg = F.col("c_mktsegment")
    s2 = s2.withColumns({
        "c_name": F.when(seg == "BUILDING", F.concat(F.upper("c_name"), F.lit("  ")))
                   .otherwise(F.col("c_name")),
        "c_mktsegment": F.when(seg == "AUTOMOBILE", F.lower(seg)).otherwise(seg)})
    ms = customer_spec(collation="UTF8_LCASE_RTRIM")
    t1 = M.snapshot_merge(M.empty_target(spark, ms, s1.schema), s1, ms, AS_OF_1)
    return M.snapshot_merge(t1, s2, ms, AS_OF_2)


def q_change_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """changed rows among matched keys, three-valued and null-safe."""
    s1, s2 = snapshots(spark, sf_dir)
    cmp = ["c_name", "c_nationkey", "c_mktsegment", "best_priority", "is_frequent", "open_priority"]
    a = s1.select([F.col(c).alias(f"t_{c}") for c in SNAPSHOT_COLS])
    b = s2.select([F.col(c).alias(f"s_{c}") for c in SNAPSHOT_COLS])
    j = a.join(b, F.col("t_c_custkey") == F.col("s_c_custkey"), "inner")
    s = {c: F.col(f"s_{c}") for c in cmp}
    t = {c: F.col(f"t_{c}") for c in cmp}
    return j.agg(
        F.count(F.lit(1)).alias("n_matched"),
        F.count_if(M.change_predicate(s, t, cmp, null_safe=False)).alias("n_changed"),
        F.count_if(M.change_predicate(s, t, cmp, null_safe=True)).alias("n_changed_null_safe"),
    )


def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: identity from 10,000,000,000; run 1 numbers its keys, run 2 continues after the max."""
    ms = customer_spec(surrogate_col="Primary_Key")
    t = two_runs(spark, sf_dir, ms, surrogate=True)
    return t.select("Primary_Key", "c_custkey", *STATUS_COLS)


def q_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 / M8: a key that is not unique (customers with several orders)."""
    return checks.key_violations(read(spark, sf_dir, "orders"), "o_custkey")


# --- 2.7 distinct, window, limit, union -----------------------------------------------------

def q_dedupe_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First order per customer by priority descending, order key tie-break."""
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority",
                                             "o_totalprice")
    return dedupe.top1_per_key(o, "o_custkey", ["-o_orderpriority", "o_orderkey"])


def q_distinct_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: distinct part brand, type, size."""
    return dedupe.distinct_rows(read(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])


def q_left_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders left join the DISTINCT-reduced line statuses (fan-out kept, as in Q4)."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                                "l_linestatus")
    return CF.left_enrich(o, li, "o_orderkey", ["l_linestatus"])


def q_row_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 20 orders by total price (the limit is the feature)."""
    o = read(spark, sf_dir, "orders")
    return (o.select("o_orderkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).limit(20))


CONFORMED = T.StructType([
    T.StructField("LineOfBusiness", T.StringType()),
    T.StructField("Entity_ID", T.StringType()),
    T.StructField("EntityName", T.StringType()),
    T.StructField("NationKey", T.IntegerType()),
    T.StructField("Segment", T.StringType()),
    T.StructField("Balance", T.DecimalType(12, 2)),
    T.StructField("Brand", T.StringType()),
    T.StructField("PartSize", T.IntegerType()),
])


def conformed_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three feeds in one layout; the part feed is DISTINCT first (as M&R is)."""
    cus = CF.conform(read(spark, sf_dir, "customer"), CONFORMED, {
        "Entity_ID": "c_custkey", "EntityName": "c_name", "NationKey": "c_nationkey",
        "Segment": "c_mktsegment", "Balance": "c_acctbal"}, {"LineOfBusiness": "CUS"})
    sup = CF.conform(read(spark, sf_dir, "supplier"), CONFORMED, {
        "Entity_ID": "s_suppkey", "EntityName": "s_name", "NationKey": "s_nationkey",
        "Balance": "s_acctbal"}, {"LineOfBusiness": "SUP"})
    prt = CF.conform(read(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", "p_brand", "p_size").distinct(), CONFORMED, {
        "Entity_ID": "p_partkey", "EntityName": "p_name", "Segment": "p_type",
        "Brand": "p_brand", "PartSize": "p_size"}, {"LineOfBusiness": "PRT"})
    return CF.union_all([cus, sup, prt])


def q_conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conformed_feeds(spark, sf_dir)


def q_person_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash key over lower-cased name + parts, count of rows sharing it."""
    u = conformed_feeds(spark, sf_dir)
    parts = [F.col("EntityName"), F.col("Segment"), F.col("NationKey"), F.col("PartSize")]
    keyed = u.select(
        "LineOfBusiness", "Entity_ID",
        keys.person_key(parts, lower_first=2).alias("Member_Key"),
        C.lenient(F.col("Balance"), "decimal(10,4)").alias("Score"),
        *[c.alias(f"_p{i}") for i, c in enumerate(parts)])
    grp = {"n": F.lower(F.col("_p0")), "s": F.lower(F.col("_p1")), "k": F.col("_p2"),
           "z": F.col("_p3")}
    out = keys.count_over(keyed, grp, "CountOf_LOB")
    return out.select("LineOfBusiness", "Entity_ID", "Member_Key", "Score", "CountOf_LOB")


# --- 2.4 / 2.8 projections and scalar functions ---------------------------------------------

def staged_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer as an all-string staging table (what a landed text feed looks like)."""
    c = read(spark, sf_dir, "customer")
    return c.select([F.col(n).cast(T.StringType()).alias(n) for n in c.columns])


def q_typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table-driven typed projection over a string stage."""
    from snapflow.operators.project import typed_projection, Rule
    rules = [
        Rule("c_custkey", "text", 12),
        Rule("c_custkey", "int_text", out="cust_id_str"),          # P14 derived duplicate
        Rule("c_nationkey", "int"),
        Rule("c_name", "text", 9, out="name9"),
        Rule("c_mktsegment", "text", 5, out="segment5"),
        Rule("c_acctbal", "float_text", 10, out="acctbal_whole"),
        Rule("c_acctbal", "decimal", (3, 2), out="acctbal_small"),
    ]
    return typed_projection(staged_customer(spark, sf_dir), rules, not_null="c_nationkey")


def q_strict_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict number casts of text (bad text would raise)."""
    s = staged_customer(spark, sf_dir)
    return s.select(C.strict_int("c_custkey", "bigint").alias("c_custkey"),
                    C.strict_int("c_nationkey", "smallint").alias("nation_small"),
                    C.strict_int("c_nationkey", "int").alias("nation_int"))


def q_lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient int / decimal(3,2) casts (malformed -> NULL, overflow -> NULL)."""
    e = read(spark, sf_dir, "events")
    return e.select(
        "event_id",
        C.lenient(F.regexp_extract("props", r"([0-9]+)", 1), "int").alias("k_int"),
        C.lenient("event_type", "int").alias("type_int"),
        C.decimal_text(F.col("value").cast("string"), 3, 2).alias("value_dec"),
    )


def q_to_bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text flags to boolean (non-zero is true)."""
    lb = read(spark, sf_dir, "labels")
    return lb.select("doc_id", C.to_bit(F.col("quality").cast("string")).alias("is_quality"),
                     C.to_bit(F.col("toxic").cast("string")).alias("is_toxic"))


def q_blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank text and a sentinel value become NULL."""
    p = read(spark, sf_dir, "pages")
    frag = F.regexp_extract("url", "#(.*)$", 1)
    return p.select("page_id",
                    X.blank_to_null(F.regexp_extract("url", r"\?([^#]*)", 1)).alias("query_text"),
                    X.blank_to_null(frag).alias("fragment"),
                    X.sentinel_to_null(X.blank_to_null(frag), "top").alias("fragment_not_top"))


def q_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates rendered in three layouts (chosen by order status) parse back to one date."""
    o = read(spark, sf_dir, "orders")
    fmt = (F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
           .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyyMMdd"))
           .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")))
    r = o.select("o_orderkey", fmt.alias("date_text"))
    return r.select("o_orderkey", "date_text", C.parse_date("date_text").alias("order_date"))


def q_zip_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank to NULL, then a character removed."""
    c = read(spark, sf_dir, "customer")
    return c.select("c_custkey", X.remove_char(X.blank_to_null("c_name"), "#").alias("name_clean"))


def q_zip_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 + 9 character split with a length test ignoring trailing blanks."""
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", X.zip5("url").alias("head5"), X.zip_plus4("url").alias("tail9"))


def q_yyyymm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year-month label, style-120 text, 19-character prefix."""
    o = read(spark, sf_dir, "orders")
    s120 = D.style120("o_orderdate")
    return o.select("o_orderkey", D.yyyymm("o_orderdate").alias("yyyymm"),
                    s120.alias("load_text"), F.left(s120, F.lit(10)).alias("load_day"))


def q_month_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First day of month."""
    o = read(spark, sf_dir, "orders")
    return o.select("o_orderkey", D.month_start("o_orderdate").alias("month_start"))




def q_case_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value map with an error label for unknown codes."""
    o = read(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderstatus",
                    CF.case_map("o_orderstatus", {"F": "fulfilled", "O": "open"}).alias("status_label"))


def q_excel_serial_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: workbook serial numbers (with a time-of-day fraction) back to dates, 1900 and 1904."""
    o = read(spark, sf_dir, "orders")
    s1900 = D.date_to_excel_serial("o_orderdate") + F.lit(0.75)
    s1904 = D.date_to_excel_serial("o_orderdate", date1904=True) + F.lit(0.75)
    return o.select("o_orderkey", s1900.alias("serial_1900"),
                    D.excel_serial_to_date(s1900).alias("date_1900"),
                    D.excel_serial_to_date(s1904, date1904=True).alias("date_1904"))


def q_incident_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """equality AND IN-list filter pushed to the scan; load time stamped per batch (P5)."""
    from snapflow.plans.incidents import select_incidents
    return select_incidents(read(spark, sf_dir, "events"), "error", [8, 9],
                            as_of="2024-06-26 04:00:00",
                            assignment_col="event_type", reference_col="user_id")


def q_persistent_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """flagged rows (quality = 1) with their document metadata; the text column is pruned."""
    lb = read(spark, sf_dir, "labels").where(F.col("quality") == 1)
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return lb.select("doc_id", "toxic").join(docs, "doc_id", "inner")


def q_numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per column, does every non-blank value parse as a number? (one aggregate pass)."""
    from snapflow.operators.clean import numeric_profile
    s = read(spark, sf_dir, "supplier")
    return numeric_profile(s.select([F.col(c).cast("string").alias(c) for c in s.columns]))


def q_enforce_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage with shuffled column order is selected by name into the declared layout."""
    from snapflow.schemas import enforce_schema, CUSTOMER_TYPED
    s = staged_customer(spark, sf_dir)
    shuffled = s.select(*reversed(s.columns))
    return enforce_schema(shuffled, CUSTOMER_TYPED)
