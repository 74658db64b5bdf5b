"""Table-driven typed projection (P11, P14, F1): one list of rules -> one ``select``.

A rule names a source column, a conversion and its argument.  Two Catalyst ``Project``s of one stage
(plus the optional NOT NULL filter): the first makes blank text NULL, the second converts, so that
each text is cleaned once however often its conversion uses it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from snapflow.functions import casts as C, text as X


@dataclass(frozen=True)
class Rule:
    """``src`` column, ``kind`` of conversion, optional ``arg``, output name ``out``.

    kinds: ``text`` (VARCHAR(n), truncating), ``int``/``tinyint``/``smallint``/``bigint``
    (strict), ``try_int``/``try_bigint`` (lenient), ``int_text`` (via INT to text), ``bit``,
    ``date`` (strict, blank -> NULL), ``try_date`` (lenient), ``decimal`` (arg=(p, s), lenient),
    ``float_text`` (via DECIMAL(20) to VARCHAR(arg)), ``zip`` (blank -> NULL, '-' removed,
    VARCHAR(arg)), ``timestamp`` (19-character text to DATETIME), ``ts_text`` (style 120),
    ``copy``.
    """

    src: str
    kind: str
    arg: Any = None
    out: str | None = None

    @property
    def name(self) -> str:
        return self.out or self.src


#: Kinds that take blank text as NULL and use their text more than once.
_CLEANED = ("int", "tinyint", "smallint", "bigint", "try_int", "try_bigint", "int_text", "bit", "date",
            "try_date", "decimal", "float_text")


def rule_expr(r: Rule, blank_bit_false: bool = False, cleaned: str | None = None) -> Column:
    """The rule's expression.  ``cleaned``: a column that holds the source's text with blanks as NULL."""
    c, blanks = F.col(f"`{cleaned or r.src}`"), cleaned is None
    k = r.kind
    if k == "text":
        return C.text_n(c, r.arg) if r.arg else c.cast("string")
    if k in ("int", "tinyint", "smallint", "bigint"):
        dtype = "smallint" if k == "tinyint" else k  # TINYINT is unsigned 0-255: needs SMALLINT
        return C.strict_int(c, dtype, blanks=blanks)
    if k in ("try_int", "try_bigint"):
        return C.lenient(c, k[4:], blanks=blanks)
    if k == "int_text":
        out = C.int_text(c, blanks=blanks)
        return C.text_n(out, r.arg) if r.arg else out
    if k == "bit":
        return C.to_bit(c, blank_false=blank_bit_false, blanks=blanks)
    if k == "date":
        return C.strict_date(c, blanks=blanks)
    if k == "try_date":
        return C.parse_date(c, blanks=blanks)
    if k == "decimal":
        p, s = r.arg
        return C.decimal_text(c, p, s, blanks=blanks)
    if k == "float_text":
        return C.float_text(c, r.arg or 10, blanks=blanks)
    if k == "zip":
        return C.text_n(X.remove_char(X.blank_to_null(c), "-"), r.arg or 10)
    if k == "timestamp":
        # style-120 text (first 19 characters) into DATETIME; blank is NULL, bad text raises
        return F.trim(F.left(F.nullif(F.trim(c), F.lit("")), F.lit(19))).cast("timestamp_ntz")
    if k == "ts_text":
        return F.left(c.cast("string"), F.lit(19))
    if k == "copy":
        return c
    raise ValueError(f"unknown rule kind {k!r}")


def typed_projection(df: DataFrame, rules, not_null: str | None = None,
                     blank_bit_false: bool = False, extra: dict | None = None) -> DataFrame:
    """Apply ``rules`` in order; ``not_null`` drops rows whose *converted* column is NULL (F1:
    missing or blank report month).  The filter is pushed below the projection by Catalyst."""
    rules = list(rules)
    clean = {r.src: f"__clean_{r.src}" for r in rules
             if r.kind in _CLEANED and not (r.kind == "bit" and blank_bit_false)}
    df = df.select("*", *[C.filled(F.col(f"`{src}`")).alias(name) for src, name in clean.items()])
    cols = [rule_expr(r, blank_bit_false, clean.get(r.src) if r.kind in _CLEANED else None).alias(r.name) for r in rules]
    cols += [e.alias(n) for n, e in (extra or {}).items()]
    out = df.select(cols)
    return out.where(F.col(f"`{not_null}`").isNotNull()) if not_null else out
