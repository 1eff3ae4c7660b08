from datetime import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reportloom.functions import text as tx
from reportloom.functions.convert import to_datetime


@pytest.mark.parametrize("text, expected", [
    ("2025-02-14 10:11:12.123", dt(2025, 2, 14, 10, 11, 12, 123000)), ("2025-01-02T03:04:05", dt(2025, 1, 2, 3, 4, 5)),
    ("2025-01-02", dt(2025, 1, 2)), ("2/14/2025 1:02:03 PM", dt(2025, 2, 14, 13, 2, 3)),
    ("12/1/2024 12:00:00 AM", dt(2024, 12, 1)), ("12/1/2024 12:05 PM", dt(2024, 12, 1, 12, 5)),
    ("2/3/2025 17:45", dt(2025, 2, 3, 17, 45)), ("Feb  4 2025  1:05PM", dt(2025, 2, 4, 13, 5)),
    ("dec 31 2024", dt(2024, 12, 31)), (" 1/2/2025 ", dt(2025, 1, 2)), ("2/30/2025", None), ("13/1/2025", None),
    ("Foo 1 2025", None), ("ebm 1 2025", None), ("1/2/2025 1:02 XM", None), ("x", None), ("", None), (None, None)])
def test_dates(spark, text, expected):
    df = spark.createDataFrame([(text,)], "c string").select(to_datetime(F.col("c")).alias("d"))
    assert df.first().d == expected


def test_dates_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # a time that clocks skip there
        df = spark.createDataFrame([("3/9/2025 2:30:00 AM",)], "c string").select(to_datetime(F.col("c")).alias("d"))
        assert df.selectExpr("cast(d as string)").first()[0] == "2025-03-09 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("expression, expected", [
    (tx.before("'a;b;c'", ";"), "a"), (tx.before("'abc'", ";"), "abc"),
    (tx.after_last("'a;b;c'", ";"), "c"), (tx.after_last("'abc'", ";"), "abc"),
    (tx.through("'ab cd'", " "), "ab "), (tx.through("'abcd'", " "), ""), (tx.through("''", " "), ""),
    (tx.tail("'on heap: dbo.T'", ":"), "dbo.T"), (tx.swap("'A.b.a'", "a", "x"), "x.b.x"),
    (tx.swap("'a.b'", ".", "$"), "a$b"), (tx.digits("' 1,234 '"), "1234"),
    (tx.number("'1,234,567,890,123'", "bigint"), 1234567890123), (tx.number("'12x'", "int"), None),
    (tx.number("'99999.5'", "decimal(4,1)"), None), (tx.number("'99.5'", "decimal(4,1)"), Decimal("99.5")),
    (tx.shown("''"), "x"), (tx.shown("CAST(NULL AS string)"), None),
    (tx.ends_with("'Duplicate Keys'", "duplicate keys"), True),
    (tx.starts_with("'DB3x'", "db3"), True)])
def test_text(spark, expression, expected):
    assert spark.range(1).selectExpr(f"{expression} AS v").first().v == expected
