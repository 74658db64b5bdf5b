"""Conform feeds to one layout (P11-P15, U1, X21, R5) and enrich them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed value: label the reference writes for an origin code it does not know.
ERROR_LABEL = "ZZZZZZ - ERROR"


def conform(df: DataFrame, layout: T.StructType, mapping: dict, literals: dict | None = None
            ) -> DataFrame:
    """Project ``df`` onto ``layout``.

    ``mapping`` maps each output column to a source column name or a Column expression; output
    columns absent from both ``mapping`` and ``literals`` become typed NULLs (an untyped NULL
    beside text fails a union under ANSI, so every NULL is cast).  All outputs are cast to the
    layout type so the union by name lines up.
    """
    literals = literals or {}
    cols = []
    for f in layout.fields:
        if f.name in literals:
            e = F.lit(literals[f.name])
        elif f.name in mapping:
            m = mapping[f.name]
            e = F.col(m) if isinstance(m, str) else m
        else:
            e = F.lit(None)
        cols.append(e.cast(f.dataType).alias(f.name))
    return df.select(cols)


def union_all(frames) -> DataFrame:
    """UNION ALL of conformed frames, matched by name (layouts must be equal)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def case_map(c, mapping: dict, default=ERROR_LABEL) -> Column:
    """Value map with a default label; a small fixed CASE, evaluated in codegen."""
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def left_enrich(left: DataFrame, right: DataFrame, key, right_cols=None,
                reduce_right: bool = True) -> DataFrame:
    """Left outer equi-join with the right side pre-reduced by DISTINCT.

    The right side is not broadcast by hand: its size is only known at run time, so AQE
    decides (broadcast when the reduced side is under the threshold, sort-merge otherwise, and
    skew-join splitting for hot keys).  A key repeated on the right fans the left row out, as
    in the reference (Q4); ``checks.key_violations`` on the right side detects it.
    """
    key = [key] if isinstance(key, str) else list(key)
    r = right.select(*(key + list(right_cols))) if right_cols else right
    if reduce_right:
        r = r.distinct()
    return left.join(r, key, "left")
