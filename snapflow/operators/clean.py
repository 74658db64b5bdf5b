"""Loader-side cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from snapflow.functions.casts import parse_date, strict_date, try_double
from snapflow.functions.text import NAN_TEXT, strip_all


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip blanks around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def strip_values(df: DataFrame, cols=None) -> DataFrame:
    """Strip surrounding whitespace of every string value in one projection."""
    cols = set(cols or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"])
    return df.select([strip_all(F.col(f"`{c}`")).alias(c) if c in cols else F.col(f"`{c}`")
                      for c in df.columns])


def nan_literal(df: DataFrame, cols=None) -> DataFrame:
    """P4 parity: a frame forced to text writes missing values as ``'nan'``."""
    cols = set(cols or df.columns)
    return df.select([F.coalesce(F.col(f"`{c}`"), F.lit(NAN_TEXT)).alias(c) if c in cols
                      else F.col(f"`{c}`") for c in df.columns])


def numeric_profile(df: DataFrame, cols=None) -> DataFrame:
    """For each text column, whether every non-blank value parses as a number.

    One aggregate pass with partial aggregation; the answer (one row) tells the caller which
    columns may be cast.  Leading zeros are lost by such a cast (Q6), so it is opt-in.
    """
    cols = cols or df.columns
    aggs = []
    for c in cols:
        v = F.trim(F.col(f"`{c}`"))
        bad = v.isNotNull() & (v != F.lit("")) & try_double(v).isNull()
        aggs.append((F.count_if(bad) == F.lit(0)).alias(c))
    return df.agg(*aggs)


# Texts that are dates, by their form
_INT = r"^[+-]?\d+$"
_PADDED = r"^[+-]?0\d"
_FRACTION = r"^[+-]?\d*\.\d+$"
_DATE = r"^(\d{4}-\d{1,2}-\d{1,2}|\d{1,2}/\d{1,2}/\d{4})$"


def type_facts(cols) -> list[Column]:
    """For each text column, the join of its values' types, as aggregates that merge across tasks.

    The lattice: int < bigint < decimal(38, s) < double < text, and date < text; blanks are below
    all.  A number with a leading zero is text (an id or a code, Q6), as is a number of more than 38
    digits before and after the point together; ``nan`` and infinities are text."""
    out = []
    for c in cols:
        v = F.trim(F.col(f"`{c}`"))
        filled = v.isNotNull() & (v != F.lit(""))
        whole = v.rlike(_INT) & ~v.rlike(_PADDED)
        parts = v.rlike(_FRACTION) & ~v.rlike(_PADDED)
        digits = F.length(F.regexp_replace(v, r"\D", ""))
        scale = F.when(parts, F.length(F.substring_index(v, ".", -1)))
        number = try_double(v)
        real = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))) & ~v.rlike(r"^[+-]?0\d|[a-df-zA-DF-Z]")
        kind = (F.when(whole & (digits <= 10) & v.try_cast("int").isNotNull(), 1)
                .when(whole & (digits <= 19) & v.try_cast("bigint").isNotNull(), 2)
                .when((whole | parts) & (digits <= 38), 3).when(~whole & ~parts & real, 4)
                .when(v.rlike(_DATE) & parse_date(v).isNotNull(), 10).otherwise(20))
        kind = F.when(filled, kind)
        out += [F.coalesce(F.max(F.when(kind < 10, kind)), F.lit(0)).alias(f"{c}.number"),
                F.count_if(kind == 10).alias(f"{c}.dates"), F.count_if(kind == 20).alias(f"{c}.texts"),
                F.coalesce(F.max(F.when(filled, scale)), F.lit(0)).alias(f"{c}.scale"),
                F.coalesce(F.max(F.when(filled & (whole | parts), digits - F.coalesce(scale, F.lit(0)))), F.lit(0)).alias(f"{c}.whole")]
    return out


def inferred_types(df: DataFrame, cols=None) -> dict[str, str]:
    """The least type of each text column that holds all its values; one pass, one row."""
    cols = list(cols or df.columns)
    row = df.agg(*type_facts(cols)).first().asDict()
    types = {}
    for c in cols:
        number, dates, texts = row[f"{c}.number"], row[f"{c}.dates"], row[f"{c}.texts"]
        scale, whole = row[f"{c}.scale"], row[f"{c}.whole"]
        if texts or (dates and number) or not (dates or number):
            types[c] = "string"
        elif dates:
            types[c] = "date"
        elif number == 3 and whole + scale > 38:
            types[c] = "double"
        else:
            types[c] = {1: "int", 2: "bigint", 3: f"decimal(38,{scale})", 4: "double"}[number]
    return types


def coerced(df: DataFrame, cols=None, types: dict[str, str] | None = None) -> DataFrame:
    """Text columns in the types their values have; blanks in a typed column are NULL, text
    columns stay as they are.  ``types`` of an earlier feed make later ones alike: a value that
    does not fit is then an error."""
    types = types or inferred_types(df, cols)

    def typed(c: str, t: str) -> Column:
        v = F.trim(F.col(f"`{c}`"))
        v = F.when(v != F.lit(""), v)
        return strict_date(v) if t == "date" else v.cast(t)

    return df.select([F.col(f"`{c}`") if types.get(c, "string") == "string" else typed(c, types[c]).alias(c) for c in df.columns])


def row_cap(df: DataFrame, n: int, order_by) -> DataFrame:
    """First ``n`` rows under an explicit order (deterministic, top-k plan)."""
    return df.orderBy(*order_by).limit(n)


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Column exclusion hook."""
    return df.drop(*cols)
