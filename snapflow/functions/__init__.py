"""Scalar expression helpers; every one returns a built-in Spark ``Column`` (codegen, no UDF)."""

from snapflow.functions.casts import (  # noqa: F401
    text_n, strict_int, int_text, lenient, to_bit, decimal_text, float_text, parse_date,
    strict_date,
)
from snapflow.functions.text import (  # noqa: F401
    blank_to_null, sentinel_to_null, remove_char, strip_all, zip5, zip_plus4, base_name,
    strip_extension, len_rtrim,
)
from snapflow.functions.dates import (  # noqa: F401
    yyyymm, month_start, style120, excel_serial_to_date, date_to_excel_serial,
)
