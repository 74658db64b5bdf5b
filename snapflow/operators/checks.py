"""Data-quality checks: key violations (K5, M8), row reconciliation (R1, A2, A4),
empty-target guard (R2).

Checks scan only the columns they need (the key) and bring at most ``sample`` offending keys
to the driver for the error message; counts travel as single numbers.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, functions as F


class DataCheckError(RuntimeError):
    """Raised when a check fails; the message names offending keys."""


def key_violations(df: DataFrame, key, count_col: str = "n_rows") -> DataFrame:
    """K5 / M8: keys that occur more than once (partial counts before the shuffle)."""
    key = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias(count_col))
            .where(F.col(count_col) > 1))


def guard_keys(df: DataFrame, key, name: str = "source", sample: int = 10,
               collation: str | None = None) -> None:
    """M8: a merge needs a unique, non-null key; raise naming up to ``sample`` offenders.

    One aggregate over the key columns only: partial counts before the shuffle, so even a
    key (or NULL) holding a third of the rows reaches the reducer as one row per map task.
    With ``collation``, text keys that compare equal under it (e.g. ``'ab'`` / ``'AB '``) are
    one key."""
    key = [key] if isinstance(key, str) else list(key)
    is_null = None
    for k in key:
        c = F.col(k).isNull()
        is_null = c if is_null is None else (is_null | c)
    text = {f.name for f in df.schema.fields if f.dataType.simpleString().startswith("string")}
    grp = [F.collate(F.col(k), collation).alias(k) if collation and k in text else F.col(k)
           for k in key]
    bad = (df.groupBy(*grp).agg(F.count(F.lit(1)).alias("_n"))
           .where((F.col("_n") > 1) | is_null).limit(sample).collect())
    nulls = [r for r in bad if any(r[k] is None for k in key)]
    if nulls:
        raise DataCheckError(f"{name}: {nulls[0]['_n']} rows with a NULL key {key}")
    if bad:
        shown = ", ".join(str(tuple(r[k] for k in key)) if len(key) > 1 else str(r[key[0]])
                          for r in bad)
        raise DataCheckError(f"{name}: duplicate key {key}: {shown}")


def reconcile(expected: int, loaded: int, what: str = "rows") -> int:
    """Expected − loaded must be 0."""
    diff = expected - loaded
    if diff != 0:
        raise DataCheckError(f"{what}: expected {expected}, loaded {loaded}, diff {diff}")
    return diff


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A4: count rows as they stream through a write, without a second scan."""
    import uuid
    # unique per call: jobs observed under the same name may run concurrently
    obs = Observation(f"{name}_{uuid.uuid4().hex[:12]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


@dataclass(frozen=True)
class Contents:
    """A table as a multiset of rows: their number and two sums of row hashes, which no order of
    rows, files or tasks changes.  A changed, missing, doubled or swapped value changes the sums."""
    rows: int
    digest: tuple[Decimal, Decimal]


def contents_aggregates(columns: list[str]) -> list[Column]:
    """Aggregates of ``Contents``; they merge across tasks, so a write can observe them."""
    # a NULL leaves a hash as it is: the flag before each value tells (NULL, a) from (a, NULL)
    row = [x for c in sorted(columns) for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    sums = [F.sum(F.xxhash64(F.lit(seed), *row).cast("decimal(38,0)")).alias(f"digest_{seed}") for seed in (1, 2)]
    return [F.count(F.lit(1)).alias("rows"), *sums]


def _contents(found) -> Contents:
    return Contents(int(found["rows"]), tuple(Decimal(found[f"digest_{seed}"] or 0) for seed in (1, 2)))


def contents(df: DataFrame) -> Contents:
    return _contents(df.agg(*contents_aggregates(df.columns)).first().asDict())


def observed_contents(df: DataFrame, name: str) -> tuple[DataFrame, "Observation"]:
    """Rows and contents noted as they stream through a write, without a second scan."""
    import uuid
    obs = Observation(f"{name}_{uuid.uuid4().hex[:12]}")
    return df.observe(obs, *contents_aggregates(df.columns)), obs


def reconcile_contents(expected: Contents, loaded: Contents, what: str = "rows") -> None:
    """As many rows as expected, and the same ones."""
    reconcile(expected.rows, loaded.rows, what)
    if expected != loaded:
        raise DataCheckError(f"{what}: {loaded.rows} rows as expected, but their contents differ")


def require_empty(df: DataFrame, what: str) -> None:
    """R2: refuse to load into a target that already holds rows."""
    if not df.isEmpty():
        raise DataCheckError(f"{what} is not empty")
