"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Day zero of the two workbook date systems (1900 mode counts the phantom
# 1900-02-29, hence 1899-12-30).
EXCEL_EPOCH_1900 = "1899-12-30"
EXCEL_EPOCH_1904 = "1904-01-01"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def yyyymm(x) -> Column:
    """``FORMAT(CONVERT(date, x), 'yyyyMM')``."""
    return F.date_format(_c(x).cast(T.DateType()), "yyyyMM")


def month_start(x) -> Column:
    """First day of the month."""
    return F.trunc(_c(x).cast(T.DateType()), "MM")


def style120(x) -> Column:
    """``CONVERT(VARCHAR(19), x, 120)``: ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_c(x), "yyyy-MM-dd HH:mm:ss")


def excel_serial_to_date(x, date1904: bool | Column = False) -> Column:
    """P10: workbook serial number to a date; the time-of-day fraction is dropped."""
    days = F.floor(_c(x).cast(T.DoubleType())).cast(T.IntegerType())
    d1900 = F.date_add(F.lit(EXCEL_EPOCH_1900).cast(T.DateType()), days)
    d1904 = F.date_add(F.lit(EXCEL_EPOCH_1904).cast(T.DateType()), days)
    if isinstance(date1904, bool):
        return d1904 if date1904 else d1900
    return F.when(date1904, d1904).otherwise(d1900)


def date_to_excel_serial(x, date1904: bool = False) -> Column:
    """Inverse of ``excel_serial_to_date`` for whole days (used to build workbook cells)."""
    epoch = EXCEL_EPOCH_1904 if date1904 else EXCEL_EPOCH_1900
    return F.datediff(_c(x).cast(T.DateType()), F.lit(epoch).cast(T.DateType())).cast(T.DoubleType())
