"""De-duplication: row distinct (A1) and keep-first-per-key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def distinct_rows(df: DataFrame, cols=None) -> DataFrame:
    """A1: ``SELECT DISTINCT`` over a projection (partial + final hash aggregate)."""
    return (df.select(*cols) if cols else df).distinct()


def _order(order_by) -> list[Column]:
    out = []
    for o in order_by:
        if isinstance(o, Column):
            out.append(o)
        elif o.startswith("-"):
            out.append(F.col(o[1:]).desc_nulls_last())
        else:
            out.append(F.col(o).asc_nulls_last())
    return out


def top1_per_key(df: DataFrame, key, order_by, keyless: str = "keep",
                 blank_keys=("", "nan")) -> DataFrame:
    """First row per key under ``order_by`` (``"-col"`` = descending).

    Written as ``row_number() = 1``, which Catalyst turns into a partial ``WindowGroupLimit``
    before the shuffle and a final one after it: each map task forwards at most one row per
    key, so a key holding a third of all rows never reaches one task whole.  The caller's order
    should end in a unique tie-break (Q3); the remaining columns are appended so the choice is
    deterministic anyway.

    Q5: rows whose key is NULL or in ``blank_keys`` are "no key".  ``keyless="keep"`` keeps
    them all: each is a group of its own, named by its place in the scan, so the input is read once
    and keyless rows spread evenly; ``"collapse"`` treats them as one key (reference parity).
    """
    key = [key] if isinstance(key, str) else list(key)
    order = _order(order_by)
    named = {o.lstrip("-") for o in order_by if isinstance(o, str)}
    tie = [F.col(c).asc_nulls_last() for c in df.columns if c not in named and c not in key]
    w = Window.partitionBy(*key).orderBy(*(order + tie))
    if keyless == "collapse":
        ranked = df.withColumn("_rn", F.row_number().over(w))
        return ranked.where("_rn = 1").drop("_rn")
    has_key = None
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for k in key:
        ok = F.col(k).isNotNull()
        if types.get(k) == "string":     # only text can be blank or the text 'nan'
            ok = ok & ~F.trim(F.col(k)).isin(*blank_keys)
        has_key = ok if has_key is None else (has_key & ok)
    alone = df.withColumn("_alone", F.when(~has_key, F.monotonically_increasing_id()))
    w = Window.partitionBy("_alone", *[F.when(has_key, F.col(k)) for k in key]).orderBy(*(order + tie))
    return alone.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_alone")
