"""Text helpers."""

from __future__ import annotations

import functools

from pyspark.sql import Column, functions as F, types as T

# Fixed value: the text pandas writes for a missing value once a frame is forced to str.
NAN_TEXT = "nan"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x) -> Column:
    """``CASE WHEN x = '' THEN NULL ELSE x END``."""
    return F.nullif(_c(x), F.lit(""))


def sentinel_to_null(x, sentinel: str = NAN_TEXT) -> Column:
    """``CASE WHEN x = 'nan' THEN NULL ELSE x END``."""
    return F.nullif(_c(x), F.lit(sentinel))


def remove_char(x, ch: str = "-") -> Column:
    """X11: ``REPLACE(x, '-', '')``."""
    return F.replace(_c(x), F.lit(ch), F.lit(""))


@functools.cache
def python_whitespace() -> str:
    """Every character Python's ``str.strip()`` removes (``str.isspace()``), built by rule."""
    return "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def strip_all(x) -> Column:
    """Python ``str.strip()`` removes every kind of surrounding whitespace (Unicode
    spaces included); ``trim`` removes only blanks and a regex ``\\s`` misses the Unicode ones.
    ``btrim`` with the exact character set gives the Python result without a regex."""
    return F.btrim(_c(x), F.lit(python_whitespace()))


def len_rtrim(x) -> Column:
    """T-SQL ``LEN`` ignores trailing blanks."""
    return F.length(F.rtrim(_c(x)))


def zip5(x) -> Column:
    """``SUBSTRING(zip, 1, 5)``."""
    return F.substring(_c(x), 1, 5)


def zip_plus4(x) -> Column:
    """``CASE WHEN LEN(zip) > 5 THEN SUBSTRING(zip, 6, 9) ELSE NULL END``."""
    c = _c(x)
    return F.when(len_rtrim(c) > 5, F.substring(c, 6, 9)).otherwise(F.lit(None).cast(T.StringType()))


def base_name(path) -> Column:
    """Last path element."""
    return F.element_at(F.split(_c(path), "/"), -1)


def strip_extension(name) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(_c(name), r"\.[^./]*$", "")
