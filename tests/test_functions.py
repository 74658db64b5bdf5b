"""Scalar conversions: the FIXTURES edge-case matrix."""

import pytest
from decimal import Decimal

from pyspark.sql import functions as F

from snapflow.functions import casts as C, dates as D, text as X


def _one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_lenient_int(spark):
    assert _one(spark, lambda c: C.lenient(c, "int"), ["", " 7 ", "12.5", "x", None]) == \
        [None, 7, None, None, None]


def test_decimal_3_2(spark):
    assert _one(spark, lambda c: C.decimal_text(c, 3, 2), ["0.855", "12.3", "nan"]) == \
        [Decimal("0.86"), None, None]


def test_to_bit(spark):
    assert _one(spark, C.to_bit, ["1", "0", "2", "", "true", None]) == \
        [True, False, True, None, True, None]
    assert _one(spark, lambda c: C.to_bit(c, blank_false=True), [""]) == [False]


def test_dates(spark):
    got = _one(spark, C.parse_date, ["", "bad", "2019-09-26", "20190926", "09/26/2019", "nan"])
    assert got[:2] == [None, None] and got[5] is None
    assert len(set(got[2:5])) == 1 and str(got[2]) == "2019-09-26"


def test_strict_date_raises(spark):
    import pytest
    with pytest.raises(Exception):
        _one(spark, C.strict_date, ["bad"])


def test_zip_rules(spark):
    assert _one(spark, lambda c: C.text_n(X.remove_char(X.blank_to_null(c)), 10),
                ["55401-1234", ""]) == ["554011234", None]
    assert _one(spark, C.float_text, ["55401.0", "55401.6"]) == ["55401", "55402"]
    assert _one(spark, X.zip5, ["554011234", "55401", "55401  "]) == ["55401"] * 3
    assert _one(spark, X.zip_plus4, ["554011234", "55401", "55401  "]) == ["1234", None, None]


def test_text_helpers(spark):
    assert _one(spark, lambda c: C.text_n(c, 3), ["abcdef"]) == ["abc"]
    assert _one(spark, X.strip_all, ["\t a b \n"]) == ["a b"]
    odd = ["\xa0y\u3000", "\u2028z\u2029", "\x1cq\x1f", "\x85w", "\u200bzw\u200b", "   ", None]
    assert _one(spark, X.strip_all, odd) == [None if v is None else v.strip() for v in odd]
    assert _one(spark, X.sentinel_to_null, ["nan", "x"]) == [None, "x"]
    assert _one(spark, C.int_text, ["123"]) == ["123"]


def test_excel_serial(spark):
    assert str(_one(spark, D.excel_serial_to_date, [43734.75], "double")[0]) == "2019-09-26"
    assert str(_one(spark, lambda c: D.excel_serial_to_date(c, True), [42272.2], "double")[0]) \
        == "2019-09-26"


def test_digit_guard_equals_try_cast(spark):
    """The shortcuts in lenient casts (no digit; for doubles no digit and no nan/inf) must give
    exactly ``try_cast``'s result."""
    from hypothesis import given, settings, strategies as st
    alphabet = st.sampled_from(list("0123456789+-.eE xn\t") + ["nan", "١", " ", "today",
                                                                  "NaN", "Inf", "inity", "d", "f"])
    texts = st.lists(st.lists(alphabet, max_size=6).map("".join), min_size=1, max_size=40)

    @settings(max_examples=15, deadline=None)
    @given(texts)
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "x string")
        for t in ("int", "bigint", "tinyint", "decimal(3,2)", "decimal(20,0)", "double", "float"):
            got = df.select(C.lenient("x", t).alias("a"),
                            F.when(F.trim("x") != "", F.col("x").try_cast(t)).alias("b")).collect()
            same = [r["a"] == r["b"] or (r["a"] != r["a"] and r["b"] != r["b"]) for r in got]
            assert all(same), t                                  # NaN compares unequal to itself

    check()


def test_date_layout_guard_equals_unguarded(spark):
    """Skipping layouts whose separators are absent gives exactly the unguarded result."""
    from hypothesis import given, settings, strategies as st
    alphabet = st.sampled_from(list("0123456789-/+ x") + ["2019", "09", "26", "12/31/", "-02-"])
    texts = st.lists(st.lists(alphabet, max_size=5).map("".join), min_size=1, max_size=40)

    @settings(max_examples=15, deadline=None)
    @given(texts)
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "x string")
        c = F.trim(F.when(F.trim("x") != "", F.col("x")))
        plain = F.coalesce(*[F.try_to_date(c, f) for f in C.DATE_FORMATS])
        # compared inside Spark: a year-0 date cannot be collected into Python
        differ = df.select(F.count_if(~C.parse_date("x").eqNullSafe(plain)).alias("n")).first()
        assert differ["n"] == 0

    check()


def test_bit_guard_equals_unguarded(spark):
    """``to_bit``'s shortcut for text that cannot be a boolean keeps the unguarded result."""
    from hypothesis import given, settings, strategies as st
    alphabet = st.sampled_from(["t", "T", "rue", "y", "es", "f", "alse", "n", "o", "0", "1",
                                "2", " ", "A", "R", "x", "nan", "."])
    texts = st.lists(st.lists(alphabet, max_size=4).map("".join), min_size=1, max_size=40)

    @settings(max_examples=15, deadline=None)
    @given(texts)
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "x string")
        c = F.when(F.trim("x") != "", F.col("x"))
        num = c.try_cast("double")
        finite = ~F.isnan(num) & (F.abs(num) != F.lit(float("inf")))
        plain = F.when(num.isNotNull(), F.when(finite, num != F.lit(0.0))).otherwise(c.try_cast("boolean"))
        differ = df.select(F.count_if(~C.to_bit("x").eqNullSafe(plain)).alias("n")).first()
        assert differ["n"] == 0

    check()


def test_to_bit_missing_text_is_null(spark):
    assert _one(spark, C.to_bit, ["nan", "NaN", "inf", "-Infinity", "0.0", "2.5"]) == \
        [None, None, None, None, False, True]


def test_whole_numbers_of_float_text(spark):
    assert _one(spark, C.int_text, ["123.0", "1.23E8", "7", "-4.000", None]) == \
        ["123", "123000000", "7", "-4", None]
    with pytest.raises(Exception, match="not a whole number|CAST_INVALID"):
        _one(spark, C.int_text, ["1.5"])


def test_dates_without_padding_and_with_time(spark):
    got = _one(spark, C.parse_date, ["1/5/1950", "1950-1-5", "1950-01-05 00:00:00", "1/5/1950 12:30:00"])
    assert [str(d) for d in got] == ["1950-01-05"] * 4


def test_strict_casts_raise_without_ansi(spark):
    import pytest
    from pyspark.sql import functions as F
    from snapflow.functions import casts
    good = spark.createDataFrame([(" 12 ", "7.0", "1.25"), ("", None, " ")], "a string, b string, c string")
    bad = spark.createDataFrame([("x", "7.5", "1.2.3")], "a string, b string, c string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        row = good.select(casts.strict_int("a"), casts.int_text("b"), casts.decimal_text("c", 5, 2, strict=True)).collect()
        assert [tuple(str(x) for x in r) for r in row] == [("12", "7", "1.25"), ("None", "None", "None")]
        for c in (casts.strict_int("a"), casts.int_text("b"), casts.strict_int(F.lit("99999999999")), casts.decimal_text("c", 5, 2, strict=True),
                  casts.decimal_text(F.lit("12345.6"), 5, 2, strict=True)):
            with pytest.raises(Exception):
                bad.select(c).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
