"""Text to numbers: the guards must not change what converts."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from refinery.functions import to_decimal, to_double, to_whole_number
from refinery.functions.columns import _any_number, _ascii_number

WHOLE = {
    "7": 7, "+7": 7, "-7": -7, " 7 ": 7, "\t7": 7, "7.0": 7, "3.9": 3, "-3.9": -3, "1e3": 1000, "1E3": 1000,
    "2147483647": 2**31 - 1, "2147483648": None, "-2147483648": -(2**31), "1e12": None, ".5": 0, "5.": 5,
    "": None, " ": None, "x9": None, "9x": None, "n/a": None, "12 USD": None, "1-2": None, "NaN": None,
    "Infinity": None, "0x1p3": None, "1.0d": None, "é9": None, "9é": None, ".": None, "e": None, None: None,
}
MONEY = {
    "109.95": "109.95", "110": "110.00", "2.675": "2.68", "2.665": "2.67", "-2.665": "-2.67", " 5 ": "5.00",
    "99999999.99": "99999999.99", "99999999.995": None, "1e12": None, "1e3": "1000.00", "1E3": "1000.00",
    ".5": "0.50", "5.": "5.00", "n/a": None, "12 USD": None, "USD 12": None, "1,5": None, "": None, None: None,
    "NaN": None, "1-2": None,
}


def convert(spark, texts, expression):
    df = spark.createDataFrame([(text,) for text in texts], "t string").select("t", expression.alias("n"))
    return {row.t: row.n for row in df.collect()}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    t = F.col("t")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        assert convert(spark, WHOLE, to_whole_number(t, text=True)) == WHOLE
        expected = {text: Decimal(n) if n else None for text, n in MONEY.items()}
        assert convert(spark, MONEY, to_decimal(t, "decimal(10,2)", text=True)) == expected
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_wide_whole_numbers_do_not_pass_through_a_double(spark):
    texts = {str(2**62 + 1): 2**62 + 1, "9223372036854775808": None}
    assert convert(spark, texts, to_whole_number(F.col("t"), "bigint", text=True)) == texts


def test_decimal_guard_agrees_with_the_bare_cast(spark):
    texts = [*WHOLE, *MONEY, "١٢", "+.5e-1", "--1", "{1}", "1}", "@1", "1:", ":1", "zz", "{"]
    bare = convert(spark, texts, F.col("t").try_cast("decimal(10,2)"))
    assert convert(spark, texts, to_decimal(F.col("t"), "decimal(10,2)", text=True)) == bare


def test_doubles(spark):
    texts = ["4.5", " 4.5 ", "nan", "NaN", "-inf", "+Infinity", " inf ", "abc", "", "1e400", "n/a", None, "4,5"]
    bare = convert(spark, texts, F.col("t").try_cast("double"))
    assert {k: repr(v) for k, v in convert(spark, texts, to_double(F.col("t"), text=True)).items()} == {
        k: repr(v) for k, v in bare.items()
    }


def test_numbers_stay_numbers(spark):
    df = spark.createDataFrame([(3.9, 2**40, 2.665)], "d double, l bigint, p double")
    row = df.select(
        to_whole_number(F.col("d"), text=False).alias("d"),
        to_whole_number(F.col("l"), text=False).alias("l"),
        to_decimal(F.col("p"), "decimal(10,2)", text=False).alias("p"),
    ).collect()[0]
    assert (row.d, row.l, row.p) == (3, None, Decimal("2.67"))


@pytest.mark.parametrize("guard", [_ascii_number, _any_number])
def test_usual_junk_never_reaches_the_conversion(spark, guard):
    """A failing conversion raises inside Spark, which costs many times a good one."""
    junk = ["n/a", "x9", "9x", "12 USD", "USD 12", "free", "", "NaN", "null", "N/A", "-", "--"]
    numbers = [text for text, n in {**WHOLE, **MONEY}.items() if n is not None]
    passed = convert(spark, junk + numbers, guard(F.col("t")))
    assert [text for text in numbers if not passed[text]] == []
    # A lone sign is not caught; it converts to NULL like the rest.
    assert [text for text in junk if passed[text]] == ["-", "--"]
