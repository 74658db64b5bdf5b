"""Casts: strict, lenient and T-SQL-parity conversions.

Spark runs with ANSI casts, so a plain ``cast`` is the strict T-SQL ``CONVERT`` (bad text
raises) and ``try_cast`` the lenient ``TRY_CONVERT`` (bad text is NULL).  Differences that
matter for parity are handled explicitly: blank text is NULL before any cast (T-SQL would give
0, 1900-01-01 or false), fractional text never silently rounds into an integer, and dates accept
the three layouts the feeds use.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Date layouts accepted by the lenient date parse (ISO, compact, US).
# one letter takes one or two digits, so padded and unpadded dates share a layout
DATE_FORMATS = ("yyyy-M-d", "yyyyMMdd", "M/d/yyyy")
_TIME_OF_DAY = r" +([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def filled(x) -> Column:
    """The text, NULL where it is blank.  Casts with ``blanks=False`` take such text as it is, so that
    a projection can clean a column once, in a step before, instead of once a use."""
    c = _c(x).cast(T.StringType())
    return F.when(F.trim(c) == F.lit(""), F.lit(None).cast(T.StringType())).otherwise(c)


def _text(x, blanks: bool) -> Column:
    return filled(x) if blanks else _c(x)


def _digit_guarded(c: Column, dtype) -> Column:
    """``try_cast`` of text that holds no digit at all.  Such text can never become an integer
    or a decimal, so it is NULL without calling the cast: a failing ``try_cast`` raises and
    catches a JVM exception per row, which on a column of words costs far more than the scan.
    Text with a digit still goes through ``try_cast``, so results are exactly ``try_cast``'s.
    (Not for dates / timestamps: Spark also casts ``'today'``, ``'now'``, ``'epoch'``.)"""
    # \p{Nd}: any Unicode decimal digit — Java's BigDecimal (decimal casts) accepts them all
    return F.when(c.rlike(r"\p{Nd}"), c.try_cast(dtype))


_DIGIT_TYPES = (T.IntegralType, T.DecimalType)
_DIGIT_NAMES = ("tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long",
                "decimal", "dec", "numeric")


def _needs_digit(dtype) -> bool:
    if isinstance(dtype, T.DataType):
        return isinstance(dtype, _DIGIT_TYPES)
    return dtype.strip().lower().split("(")[0].strip() in _DIGIT_NAMES


_FLOAT_NAMES = ("double", "float", "real")


def try_double(c: Column, dtype="double") -> Column:
    """``try_cast`` to double / float, skipping text that cannot parse: only text with a digit
    or with ``nan`` / ``inf`` in it (Spark's special literals, any case, optional sign) is
    handed to the cast, so words and flags cost no JVM exception.  Same results as
    ``try_cast``."""
    return F.when(c.rlike(r"\p{Nd}|(?i:nan|inf)"), c.try_cast(dtype))


def _try(c: Column, dtype) -> Column:
    if _needs_digit(dtype):
        return _digit_guarded(c, dtype)
    name = dtype.simpleString() if isinstance(dtype, T.DataType) else dtype.strip().lower()
    if name in _FLOAT_NAMES:
        return try_double(c, dtype)
    return c.try_cast(dtype)


def text_n(x, n: int) -> Column:
    """``CONVERT(VARCHAR(n), x)`` silently truncates; Spark's varchar cast does not."""
    return F.left(_c(x).cast(T.StringType()), F.lit(n))


def _strict(c: Column, dtype) -> Column:
    """A cast that raises on text that does not fit, whether or not the session casts by ANSI."""
    text = c.cast(T.StringType())
    name = dtype.simpleString() if isinstance(dtype, T.DataType) else dtype
    bad = F.raise_error(F.concat(F.lit(f"CAST_INVALID_INPUT: no {name}: "), text)).cast(dtype)
    return F.when(c.isNotNull(), F.coalesce(c.try_cast(dtype), bad))


def _integral(c: Column, dtype: str) -> Column:
    """Whole numbers as text, with or without a fraction of zeros or an exponent (``123.0``,
    ``1.23E8``: the text of a float column).  Other fractions and other text raise."""
    text = c.cast(T.StringType())
    exact = _strict(text, T.DecimalType(38, 6))
    whole = F.when(exact != F.floor(exact), F.raise_error(
        F.concat(F.lit("not a whole number: "), text)).cast(dtype)).otherwise(_strict(exact, dtype))
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), _strict(text, dtype)).otherwise(whole)


def strict_int(x, dtype: str = "int", blanks: bool = True) -> Column:
    """``CONVERT(INT|TINYINT|SMALLINT, x)``; bad text raises (ANSI).  Blank is NULL."""
    return _integral(_text(x, blanks), dtype)


def int_text(x, blanks: bool = True) -> Column:
    """Id via integer to text, so ``123.0`` / ``1.23E8`` print as plain digits.  Blank is NULL."""
    return _integral(_text(x, blanks), "int").cast(T.StringType())


def lenient(x, dtype: str, blanks: bool = True) -> Column:
    """``TRY_CONVERT(t, x)``: blank or malformed text is NULL; surrounding blanks ignored."""
    return _try(_text(x, blanks), dtype)


def decimal_text(x, precision: int, scale: int, strict: bool = False, blanks: bool = True) -> Column:
    """``CONVERT(DECIMAL(p,s), x)``: half-up rounding; overflow raises (strict) or is NULL."""
    c = _text(x, blanks)
    t = T.DecimalType(precision, scale)
    return _strict(c, t) if strict else _digit_guarded(c, t)


def float_text(x, width: int = 10, blanks: bool = True) -> Column:
    """Float-typed ZIP to text without exponent: via DECIMAL(20,0), then VARCHAR(width)."""
    c = _text(x, blanks)
    return F.left(_digit_guarded(c, T.DecimalType(20, 0)).cast(T.StringType()), F.lit(width))


def to_bit(x, blank_false: bool = False, blanks: bool = True) -> Column:
    """``CAST(x AS BIT)``: any non-zero number is true, ``true``/``false`` text accepted.

    Blank is NULL by default; ``blank_false=True`` is the T-SQL result (Q18).
    """
    c = _text(x, blanks)
    num = try_double(c)
    # Spark's text booleans are t/true/y/yes/1 and f/false/n/no/0 (any case): text without any
    # of those letters is NULL without the cast (a failing cast raises per row)
    as_bool = F.when(c.rlike("(?i)[tyfn01]"), c.try_cast(T.BooleanType()))
    # the missing-value text ``nan`` and infinities are no numbers (and no booleans): NULL, never TRUE
    bit = F.coalesce(F.when(F.abs(num) < F.lit(float("inf")), num != F.lit(0.0)), as_bool)
    if blank_false:
        raw = _c(x).cast(T.StringType())
        bit = F.when(raw.isNotNull() & (F.trim(raw) == F.lit("")), F.lit(False)).otherwise(bit)
    return bit


def parse_date(x, formats=DATE_FORMATS, blanks: bool = True) -> Column:
    """X10 lenient: first layout that parses; blank, ``nan`` or malformed text is NULL (Q7, Q20)."""
    c = _date_part(x, blanks)
    return F.coalesce(*[_layout_guard(c, f) for f in formats])


def _date_part(x, blanks: bool) -> Column:
    """The text without blanks around it and without a time of day (taken off once, so that no
    layout is needed twice)."""
    c = F.trim(_text(x, blanks))
    return F.when(F.contains(c, F.lit(":")), F.regexp_replace(c, _TIME_OF_DAY, "")).otherwise(c)


def _layout_guard(c: Column, fmt: str) -> Column:
    """``try_to_date(c, fmt)`` only for text that could fit the layout — it contains every
    literal separator of ``fmt``, or, for a layout of pattern letters only, it is digits and
    signs — so text in another layout costs no JVM parse exception.  Same results."""
    literals = sorted({ch for ch in fmt if not ch.isalpha()})
    if literals:
        cond = None
        for ch in literals:
            t = F.contains(c, F.lit(ch))
            cond = t if cond is None else cond & t
    else:
        cond = c.rlike(r"^[\p{Nd}+-]+$")
    return F.when(cond, F.try_to_date(c, fmt))


def strict_date(x, formats=DATE_FORMATS, blanks: bool = True) -> Column:
    """X10 strict: like ``parse_date`` but non-blank text that fits no layout raises."""
    raw = _c(x).cast(T.StringType())
    fail = F.raise_error(F.concat(F.lit("unparseable date: "), raw)).cast(T.DateType())
    return F.coalesce(parse_date(raw, formats, blanks), F.when(_text(raw, blanks).isNotNull(), fail))
