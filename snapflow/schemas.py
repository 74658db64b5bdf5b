"""Declared layouts (K4) and schema enforcement."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T


class SchemaError(ValueError):
    """Raised when a frame's columns do not fit the declared layout."""


def all_string(names) -> T.StructType:
    """Staging layout: every column text and nullable (K1)."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def check_columns(actual, expected, allow_missing: bool = False) -> None:
    """Header-driven insert: order may differ, an unknown column is an error."""
    actual, expected = list(actual), list(expected)
    unknown = [c for c in actual if c not in expected]
    missing = [c for c in expected if c not in actual]
    if unknown:
        raise SchemaError(f"unknown columns {unknown}")
    if missing and not allow_missing:
        raise SchemaError(f"missing columns {missing}")


_TYPES = {"date": T.DateType(), "boolean": T.BooleanType(), "int": T.IntegerType(),
          "bigint": T.LongType(), "timestamp_ntz": T.TimestampNTZType(), "smallint": T.ShortType(),
          "double": T.DoubleType(), "string": T.StringType()}


def _type(kind: str) -> T.DataType:
    decimal = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
    return T.DecimalType(int(decimal[1]), int(decimal[2])) if decimal else _TYPES[kind]


def layout(text: str) -> T.StructType:
    """A target layout from lines ``name type [not null]``; ``varchar(n)`` keeps its width as
    ``max_chars`` in the field's metadata."""
    fields = []
    for ln in text.strip().splitlines():
        name, kind, *rest = ln.split()
        width = re.fullmatch(r"varchar\((\d+)\)", kind)
        fields.append(T.StructField(
            name, T.StringType() if width else _type(kind), rest != ["not", "null"],
            {"max_chars": int(width[1])} if width else {}))
    return T.StructType(fields)


def enforce_schema(df: DataFrame, schema: T.StructType, allow_missing: bool = False,
                   check_not_null: bool = True, fitted=()) -> DataFrame:
    """K4: select by name in declared order, cast to declared types, fill allowed-missing
    columns with typed NULLs, and fail the job (``raise_error``) on NULL in a NOT NULL column or
    on a text wider than its column (blanks at the end do not count and are cut).  The tests are
    expressions in the same projection, so they cost no extra pass.  ``fitted``: columns whose text
    the caller has cut to the width already, which need no test."""
    check_columns(df.columns, schema.fieldNames(), allow_missing)
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`").cast(f.dataType) if f.name in present \
            else F.lit(None).cast(f.dataType)
        if "max_chars" in f.metadata and f.name not in fitted:
            n = f.metadata["max_chars"]
            wide = F.raise_error(F.lit(f"text wider than {n} in column {f.name}")).cast("string")
            c = F.when(F.char_length(F.rtrim(c)) > n, wide).otherwise(F.left(c, F.lit(n)))
        if check_not_null and not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"NULL in NOT NULL column {f.name}"))
                       .cast(f.dataType)).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(cols)


CUSTOMER_TYPED = T.StructType([
    T.StructField("c_custkey", T.LongType(), False),
    T.StructField("c_name", T.StringType(), True),
    T.StructField("c_nationkey", T.IntegerType(), True),
    T.StructField("c_acctbal", T.DecimalType(12, 2), True),
    T.StructField("c_mktsegment", T.StringType(), True),
])
