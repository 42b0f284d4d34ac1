"""Column helpers: NULL, substring, decode and date rules."""

from datetime import date, datetime

from pyspark.sql import functions as F

from ledgerloom.functions import moments, text
from ledgerloom.operators.writeback import number_text
from ledgerloom.sources.sinks import report_line


def one(spark, column, **row):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'int' if isinstance(v, int) else 'timestamp_ntz'}" for k, v in row.items())
    df = spark.createDataFrame([tuple(row.values())], schema) if row else spark.range(1)
    return df.select(column.alias("r")).first().r


def test_null_adds_nothing(spark):
    assert one(spark, text.cat(F.col("a"), "x"), a=None) == "x"
    assert one(spark, text.cat(F.col("a"), F.col("b")), a=None, b="") is None
    assert one(spark, text.blank_to_null(F.col("a")), a="") is None


def test_optional_filter_drops_null_columns(spark):
    df = spark.createDataFrame([("A",), (None,), ("B",)], "c string")
    assert df.where(text.given_or_column(F.col("c"), None)).count() == 2
    assert df.where(text.given_or_column(F.col("c"), "A")).count() == 1


def test_decode_matches_null_and_has_no_default(spark):
    pairs = [(None, "none"), ("A", "first")]
    assert one(spark, text.decode(F.col("c"), pairs), c=None) == "none"
    assert one(spark, text.decode(F.col("c"), pairs), c="A") == "first"
    assert one(spark, text.decode(F.col("c"), pairs), c="Z") is None
    assert one(spark, text.decode(F.col("c"), pairs, "other"), c="Z") == "other"


def test_length_test_is_a_digit_search_unless_strict(spark):
    loose, strict = (text.length_is_one_of(F.col("c"), (4, 6, 8), s) for s in (False, True))
    assert one(spark, loose, c="1" * 14) is True and one(spark, strict, c="1" * 14) is False
    assert one(spark, loose, c="123") is False and one(spark, strict, c="1234") is True
    assert one(spark, loose, c=None) is None


def test_day_range_defaults_and_bounds():
    run = datetime(2001, 8, 1, 15, 30)
    assert moments.day_range(None, None, run) == (datetime(2001, 7, 31), datetime(2001, 8, 2))
    assert moments.day_range(datetime(2001, 1, 5, 9), datetime(2001, 1, 6, 1), run) == (datetime(2001, 1, 5), datetime(2001, 1, 7))


def test_stamp_has_upper_case_month(spark):
    assert one(spark, moments.stamp(F.col("t")), t=datetime(2020, 12, 31, 23, 59, 58)) == "31-DEC-2020 23:59:58"
    assert one(spark, moments.iso_day(F.col("t")), t=datetime(2020, 12, 31, 23)) == "2020-12-31"


def test_two_digit_years_pivot_at_fifty(spark):
    parse = lambda year: moments.two_digit_year_date(F.col("d"), year)
    assert one(spark, parse(2001), d="07-MAR-49") == date(2049, 3, 7)
    assert one(spark, parse(2001), d="7-mar-50") == date(1950, 3, 7)
    assert one(spark, parse(1999), d="07-Mar-49") == date(2049, 3, 7)
    assert one(spark, parse(1999), d="07-Mar-50") == date(1950, 3, 7)
    assert one(spark, parse(2001), d="nonsense") is None


def test_effective_rows(spark):
    rows = [(datetime(2000, 1, 1), None), (datetime(2000, 1, 1), datetime(2000, 6, 1)), (datetime(2002, 1, 1), None)]
    df = spark.createDataFrame(rows, "s timestamp_ntz, e timestamp_ntz")
    assert df.where(moments.effective_at(F.col("s"), F.col("e"), datetime(2001, 8, 1))).count() == 1


def test_number_text_and_report_line(spark):
    assert one(spark, number_text(F.col("a").cast("decimal(10,4)")), a=100) == "100"
    df = spark.createDataFrame([("x", None, 3)], "a string, b string, c int")
    assert df.select(report_line(["a", "b", "c"]).alias("r")).first().r == "x~~3"
