"""Scalar column functions on hand-written rows (X-01 .. X-17, S-05, X-15)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomstar.functions.dates import datetime_from_parts, parse_mixed_date, parse_mixed_timestamp
from loomstar.functions.text import (
    equals_flag,
    is_junk_code,
    newlines_to_commas,
    strip_leading_lower,
    strip_letters,
    strip_question_marks,
)
from loomstar.functions.urls import url_parts
from loomstar.functions.weights import weight_kg
from loomstar.operators.conform import weight_class


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr("v")).collect()]


def test_junk_code_matches_ten_upper_alnum(spark):
    vals = ["AB12CD34EF", "AUTOMOBILE", "1234567890", "ab12cd34ef", "AB12CD34E", "AB12CD34EFG",
            "AB12CD34EF\n", "AB12CD34EF\r", "", None, "AB12 CD34E"]
    assert col_values(spark, vals, is_junk_code) == [
        True, True, True, False, False, False, True, False, False, False, False]


def test_junk_code_on_typed_columns(spark):
    df = spark.createDataFrame([(1234567890, 1234567890.0, 12)], "a bigint, b double, c int")
    row = df.select(*[is_junk_code(c, df.schema[c].dataType).alias(c) for c in df.columns]).first()
    assert (row.a, row.b, row.c) == (True, False, False)


def test_mixed_dates_order_and_range(spark):
    vals = ["1950-01-05", "1950/01/05", "1950 October 05", "July 1950 05", "03/04/2005",
            "13/04/2005", "2005", "NULL", "ZX90CV81BN", "1600-01-01", "2020-01-05 10:11:12",
            " 2001-2-3 ", "2020-02-30", None]
    assert col_values(spark, vals, parse_mixed_date) == [
        dt.date(1950, 1, 5), dt.date(1950, 1, 5), dt.date(1950, 10, 5), dt.date(1950, 7, 5),
        dt.date(2005, 3, 4), dt.date(2005, 4, 13), dt.date(2005, 1, 1), None, None, None,
        dt.date(2020, 1, 5), dt.date(2001, 2, 3), None, None]


def test_datetime_from_parts_strict_and_tolerant(spark):
    df = spark.createDataFrame([("1998", "1", "5", "7:05:00"), ("1998", "13", "5", "7:05:00")],
                               "y string, m string, d string, t string")
    ok = df.where(F.col("m") == "1").select(datetime_from_parts("y", "m", "d", "t").alias("x")).first().x
    assert ok == dt.datetime(1998, 1, 5, 7, 5)
    tolerant = [r.x for r in df.select(datetime_from_parts("y", "m", "d", "t", strict=False).alias("x")).collect()]
    assert tolerant[1] is None
    with pytest.raises(Exception):
        df.select(datetime_from_parts("y", "m", "d", "t").alias("x")).collect()


def test_text_repairs(spark):
    assert col_values(spark, ["1 Road\nTown", "x", None], newlines_to_commas) == ["1 Road, Town", "x", None]
    assert col_values(spark, ["???4000", "40??00", "4000"], strip_question_marks) == ["4000", "4000", "4000"]
    assert col_values(spark, ["J12", "12e", "ee", "1a2B3"], strip_letters) == ["12", "12", "", "123"]
    assert col_values(spark, ["eeEurope", "Europe", "ee", "N/A"], strip_leading_lower) == [
        "Europe", "Europe", "", "N/A"]
    assert col_values(spark, ["Removed", "Still_available", None], lambda c: equals_flag(c, "Removed")) == [
        True, False, False]


def test_text_repairs_are_idempotent(spark):
    vals = ["1 Road\nTown\n", "???1??", "J1e2", "eeAsia"]
    for f in (newlines_to_commas, strip_question_marks, strip_letters, strip_leading_lower):
        once = col_values(spark, vals, f)
        assert col_values(spark, once, f) == once


def test_weights_to_kg(spark):
    vals = ["12 x 100g", "5.5kg", "12g .", "30lb", "MN45BV67CX", "500ml", "16oz", "kg", "1kg", None,
            "12 x 1.5kg"]
    got = col_values(spark, vals, weight_kg)
    expect = [0.001 * 1200.0, 5.5, 0.012, None, None, 0.5, 16 * 0.028349523125, None, 1.0, None, 12.0]
    assert got == expect


def test_weights_strict_multipack(spark):
    got = col_values(spark, ["12 x 1.5kg", "1.5*2kg"], lambda c: weight_kg(c, strict_multipack=True))
    assert got == [18.0, 3.0]


def test_weight_class_boundaries(spark):
    vals = [0.0, 1.999, 2.0, 39.99, 40.0, 139.9, 140.0, 1000.0, None]
    assert col_values(spark, vals, lambda c: weight_class("v"), "double") == [
        "Light", "Light", "Mid_Sized", "Mid_Sized", "Heavy", "Heavy", "Truck_Required",
        "Truck_Required", None]


def test_url_parts_compatible_and_fixed(spark):
    df = spark.createDataFrame([("s3://sample-bucket/a.csv",),
                                ("https://other-bucket.store.example.com/b.json",),
                                ("s3://my-bucket2/a/b.csv",), ("s3://b_x/k",), ("ftp://x/y",)], "u string")
    compat = [tuple(r) for r in df.select(*url_parts("u")).collect()]
    assert compat[0] == ("s3", "sample-bucket", "a.csv")
    assert compat[1] == ("https", "other-bucket", "b.json")
    assert compat[2] == ("s3", "my-bucket", "a/b.csv")  # the compatible class has no digits
    assert compat[3] == (None, None, None)
    assert compat[4] == (None, None, None)
    fixed = [tuple(r) for r in df.select(*url_parts("u", compatible=False)).collect()]
    assert fixed[2] == ("s3", "my-bucket2", "a/b.csv")
    assert fixed[3] == ("s3", "b_x", "k")


@pytest.mark.parametrize("value,want", [
    ("2 October 1975", "1975-10-02"), ("October 2 1975", "1975-10-02"), ("Oct 2 1975", "1975-10-02"), ("1975 Oct 02", "1975-10-02"),
    ("Oct 1975 2", "1975-10-02"), ("2 oct 1975", "1975-10-02"), ("1975-10-02T00:00:00", "1975-10-02"), ("1975-10-02T00:00:00Z", "1975-10-02"),
    ("1975-10-02 10:11", "1975-10-02"), ("19751002", "1975-10-02"), ("1975.10.02", "1975-10-02"), ("02-10-1975", "1975-02-10"),
    ("13-10-1975", "1975-10-13"), ("1975-10", "1975-10-01"), ("October 1975", "1975-10-01"), ("10/2/24", "2024-10-02"),
    ("13/2/24", "2024-02-13"), ("1/2/99", "1999-01-02"), ("03/04/2005", "2005-03-04"), ("13/04/2005", "2005-04-13"),
    ("2 Octember 1975", None), ("1975-13-40", None), ("99999999", None), ("", None), (None, None),
])
def test_mixed_date_layouts(spark, value, want):
    df = spark.createDataFrame([(value,)], "d string")
    got = df.select(parse_mixed_date("d").cast("string")).first()[0]
    assert got == want


#: The two-digit years of these texts are read in the 100 years that end 49 years from now, as below.
DATE_TEXTS = """October 2, 1975|Oct 2, 1975|2-Oct-1975|1975-10-02 10:11:12.123|1975-10-02T10:11:12+00:00|1975-10-02T10:11|Sept 2 1975
2nd October 1975|Thu 2 Oct 1975|02.10.1975|13.10.1975|10.13.1975|1975|75|197510|751002|19751002|19751002101112|197510021011
19751002T101112|1975Q4|1975-Q4|Q4 1975|Oct 75|2 Oct 75|75 Oct 2|Oct 1975|2 October|October|10/75|10/1975|1975/10|31/12|12/31/1975
31/12/1975|31-12-75|75-12-31|12-31-75|32/12/75|12/32/75|2/3/75|10am 2 Oct 1975|2 Oct 1975 10am|2 Oct 1975 10:11 pm|2 Oct 1975 12:11 am
2 Oct 1975 12:11 pm|10:11 2 Oct 1975|Thursday, October 2nd, 1975 at 10:11|2 of October 1975|2Oct1975|02Oct75|October-2-1975|Oct.2.1975
Oct. 2, 1975|2. Oct 1975|1975-10-02 25:00|1975-13-02|1975-02-30|2 Foo 1975|1975 10 02|10 2 1975|1975-10-02T10:11:12Z
1975-10-02 10:11:12 UTC|1975-10-02 10:11:12+02:00|1975-10-02 10:11:12 -0500|1975-10-02T10|1975-10-02 10|5 1975|1675-01-01|2300-01-01
1975-10-2|1975-1-2 1:2:3|2-Oct-75|49-10-02|Oct/2/1975|1975/Oct/02|1975-Oct-02|2;10;1975|tomorrow|nan||1975-275|1975-W40-4|10-1975
1975.10|10.1975|1975.5|1e5|-1975|+1975|1975-10-02T10:11:12.123456789|2 10 75|99/1/2|1/99/2|1/2/99|0/1/1975|1975-00-01|123|1234|12345
123456|1234567|12345678|02/29/1900|02/29/2000|Fri|Oct 2 1975 AD|October2,1975|2.10.75|2.10|1975 Oct|1975 Oct 2|75 October|Oct 32
MAY 5 2001|5 mAy 2001|Mai 5 2001|01 01 01|010101|20010101 10:11|2001-01-01 10:11:60|2001-01-01T24:00|2001/13|13/2001|1 2 3 4|Jan Feb 2001
a 1 2001|2 sep 1975 7:08|sept. 3, 1975 7:8:9|1975-10-02 10:11:12.5 PM|13:00 pm 2 Oct 1975|00:10 am 2 Oct 1975|Sun, 05 Oct 1975 10:11:12 GMT"""


def test_mixed_dates_agree_with_pandas(spark):
    """Every text is read as the original tool reads it; a zone is kept off, the clock time stays."""
    import warnings

    import pandas as pd

    texts = [t for line in DATE_TEXTS.split("\n") for t in line.split("|")]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.x for r in df.select("i", parse_mixed_timestamp("t").alias("x")).orderBy("i").collect()]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = [pd.to_datetime(pd.Series([t]), errors="coerce", format="mixed")[0] for t in texts]
    want = [None if pd.isna(x) else x.replace(tzinfo=None).floor("us").to_pydatetime() for x in want]
    assert dict(zip(texts, got)) == dict(zip(texts, want))
