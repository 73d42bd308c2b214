"""One test per quirk of SURVEY §2.15 that is kept, fixed or surfaced."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomstar.functions.text import strip_literal
from loomstar.functions.weights import weight_kg
from loomstar.operators import cleaning as C
from loomstar.operators import conform as D
from loomstar.operators import nulls as N
from loomstar.plans import analytics as A
from loomstar.sources import readers as S


def test_q01_junk_codes_null_cells_not_rows(spark):
    df = spark.createDataFrame([("AB12CD34EF", "x")], "a string, b string")
    assert N.null_unknown_codes(df).collect()[0].asDict() == {"a": None, "b": "x"}


def test_q02_ten_digit_integers_are_junk_unless_excluded(spark):
    df = spark.createDataFrame([(1234567890, 42)], "a bigint, b bigint")
    assert N.null_unknown_codes(df).first().a is None
    assert N.null_unknown_codes(df, exclude=("a",)).first().a == 1234567890


def test_q03_q04_multipacks_multiply_decimal_packs_compatible(spark):
    df = spark.createDataFrame([("12 x 100g",), ("12 x 1.5kg",)], "w string")
    assert [r[0] for r in df.select(weight_kg("w")).collect()] == [0.001 * 1200.0, 12.0]


def test_q05_q06_unknown_unit_or_no_digits_gives_null_and_keeps_row(spark):
    df = spark.createDataFrame([("p1", "30lb"), ("p2", "kg")], "product_code string, weight string")
    out = C.weights_to_kg(df).orderBy("product_code").collect()
    assert [(r.product_code, r.weight) for r in out] == [("p1", None), ("p2", None)]


def test_q08_still_available_is_not_removed_by_default(spark):
    df = spark.createDataFrame([("1.00", 1.0, True, "p")], "product_price string, weight double, removed boolean, product_code string")
    assert D.conform_products(df).first().still_available is False
    assert D.conform_products(df, compat_still_available=True).first().still_available is True


def test_q11_top_k_ties_broken_by_group_key(spark):
    fact = spark.createDataFrame([(1, s) for s in (1, 2, 3, 4)], "date_key long, store_code long")
    store = spark.createDataFrame([(1, "B"), (2, "A"), (3, "D"), (4, "C")], "store_code long, locality string")
    top = A.stores_per_locality_top(fact, store, 2).collect()
    assert [r.locality for r in top] == ["A", "B"]


def test_q14_failed_fetches_surface_as_missing_ids_never_duplicates(spark):
    docs = spark.createDataFrame([(0,), (1,), (1,), (3,)], "index long")
    assert sorted(r.id for r in S.missing_document_ids(docs, "index", 5).collect()) == [2, 4]


def test_q15_unknown_content_type_raises(spark):
    with pytest.raises(ValueError):
        S.load(spark, "/nonexistent", "application/octet-stream")


def test_q18_month_first_then_day_first(spark):
    df = spark.createDataFrame([("03/04/2005",), ("13/04/2005",)], "date_added string")
    out = [r.date_added for r in C.parse_mixed_dates(df).collect()]
    assert sorted(out) == [dt.date(2005, 3, 4), dt.date(2005, 4, 13)]


def test_q19_strict_datetime_fails_the_job(spark):
    df = spark.createDataFrame([("2020", "2", "30", "00:00:00", "Morning")],
                               "year string, month string, day string, timestamp string, time_period string")
    with pytest.raises(Exception):
        C.build_datetime(df).collect()
    assert C.build_datetime(df, strict=False).count() == 0


def test_q20_web_store_address_overwritten_after_missing_addresses_dropped(spark):
    df = spark.createDataFrame([(0, "W", "Web Portal", "1", None, "1", "1", "eeX", "2010-01-01"),
                                (1, "V", "Web Portal", "1", "A\\nB", "1", "1", "eeX", "2010-01-01")],
                               "index long, store_code string, store_type string, staff_numbers string, "
                               "address string, longitude string, latitude string, continent string, "
                               "opening_date string")
    out = C.clean_stores(df).collect()
    assert [(r.store_code, r.address) for r in out] == [("V", "N/A")]


def test_q21_cell_equal_to_its_column_name_deletes_the_row(spark):
    df = spark.createDataFrame([("card_number", "01/25", "2020-01-01"), ("4000", "01/25", "2020-01-01")],
                               "card_number string, expiry_date string, date_payment_confirmed string")
    assert [r.card_number for r in C.clean_cards(df).collect()] == ["4000"]


def test_q22_missing_drop_column_raises(spark):
    with pytest.raises(KeyError):
        C.clean_orders(spark.createDataFrame([(1,)], "level_0 int"))


def test_q24_currency_strip_is_idempotent(spark):
    df = spark.createDataFrame([("£9.99",)], "product_price string")
    once = df.select(strip_literal("product_price", "£").alias("product_price"))
    assert once.select(strip_literal("product_price", "£")).first()[0] == once.first()[0] == "9.99"


def test_q27_distinct_counts_only_stores_with_orders(spark):
    fact = spark.createDataFrame([(1, 1)], "date_key long, store_code long")
    store = spark.createDataFrame([(1, "GB"), (2, "GB"), (3, "DE")], "store_code long, country_code string")
    assert [tuple(r) for r in A.stores_per_country(fact, store).collect()] == [("GB", 1)]


def test_q30_letters_only_staff_fails_strict_and_is_reported(spark):
    df = spark.createDataFrame([(1, "JJ")], "id int, staff_numbers string")
    digits = df.withColumn("staff_numbers", F.regexp_replace("staff_numbers", "[A-Za-z]+", ""))
    with pytest.raises(Exception):
        D.conform(digits, {"staff_numbers": "int2"}).collect()
    report = D.conform_violations(digits, {"staff_numbers": "int2"}, "id", "stores").collect()
    assert [(r.column, r.rule, r.value) for r in report] == [("staff_numbers", "int2", "")]
