"""Cleaning pipelines, conformance and key checks on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomstar.functions.dates import mixed_date_sql
from loomstar.operators import cleaning as C
from loomstar.operators import conform as D
from loomstar.operators import constraints as K
from loomstar.operators import nulls as N
from loomstar.operators import reshape as R


def rows(df, order):
    return [r.asDict() for r in df.orderBy(order).collect()]


def test_null_unknown_codes_only_cells(spark):
    df = spark.createDataFrame([(1, "AB12CD34EF", "x"), (2, "ok", "AUTOMOBILE")], "i int, a string, b string")
    out = rows(N.null_unknown_codes(df), "i")
    assert out == [{"i": 1, "a": None, "b": "x"}, {"i": 2, "a": "ok", "b": None}]
    kept = rows(N.null_unknown_codes(df, exclude=("b",)), "i")
    assert kept[1]["b"] == "AUTOMOBILE"


def test_null_unknown_codes_idempotent(spark):
    df = spark.createDataFrame([("AB12CD34EF", "x"), ("ok", None)], "a string, b string")
    once = N.null_unknown_codes(df)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(
        map(tuple, N.null_unknown_codes(once).collect()), key=str)


def test_na_tokens(spark):
    df = spark.createDataFrame([("N/A", 1), ("NULL", 2), ("", 3), ("value", 4), (None, 5)], "s string, i int")
    assert [r.s for r in N.na_tokens_to_null(df).orderBy("i").collect()] == [None, None, None, "value", None]


def test_reindex_and_strict_drop(spark):
    df = spark.createDataFrame([(1, "a", "extra")], "index int, store_code string, junk string")
    out = R.reindex_columns(df, ["index", "store_code", "locality"])
    assert out.columns == ["index", "store_code", "locality"]
    assert out.first().locality is None
    with pytest.raises(KeyError):
        R.drop_columns_strict(df, ["nope"])
    assert R.drop_index_column(df, None) is df


def test_clean_users_order_and_rules(spark):
    df = spark.createDataFrame([
        (1, "Ann", "Lee", "1950-01-05", "1 Road\nTown", "GGB"),
        (2, "Bob", "AB12CD34EF", "July 1950 05", "2 Road", "GB"),
        (3, "Cy", "Ray", "NULL", "3 Road", "GB"),          # unparsable date -> row dropped
        (4, "Di", "Ray", "1999/12/31", None, "GB"),       # no address -> row dropped
    ], "index long, first_name string, last_name string, date_of_birth string, address string, country_code string")
    out = rows(C.clean_users(df), "first_name")
    assert out == [
        {"first_name": "Ann", "last_name": "Lee", "date_of_birth": dt.date(1950, 1, 5),
         "address": "1 Road, Town", "country_code": "GB"},
        {"first_name": "Bob", "last_name": None, "date_of_birth": dt.date(1950, 7, 5),
         "address": "2 Road", "country_code": "GB"},
    ]


def test_clean_cards(spark):
    df = spark.createDataFrame([
        ("???4000123412341234", "01/25", "2020-01-01"),
        ("card_number", "expiry_date", "date_payment_confirmed"),  # repeated header
        ("4000123412341235", "QW34ER56TY", "2020-01-02"),          # junk code
        (None, "01/25", "2020-01-03"),                              # incomplete
        ("4000123412341236", "02/26", "2020-01-04"),
    ], "card_number string, expiry_date string, date_payment_confirmed string")
    out = rows(C.clean_cards(df), "card_number")
    assert [r["card_number"] for r in out] == ["4000123412341234", "4000123412341236"]


def test_clean_stores_web_overrides(spark):
    df = spark.createDataFrame([
        (0, "WEB-1", "Web Portal", "J25", "1 Road\nTown", "1.5", "2.5", "London", "GB", "eeEurope", "2010-06-12"),
        (1, "ST-1", "Local", "30e", "2 Road", "3.5", "4.5", "Leeds", "GB", "eeEurope", "2011/06/12"),
        (2, "ST-2", "Local", "30", "3 Road", "3.5", "4.5", "Leeds", "GB", "Europe", "NULL"),
    ], "index long, store_code string, store_type string, staff_numbers string, address string, "
       "longitude string, latitude string, locality string, country_code string, continent string, "
       "opening_date string")
    out = rows(C.clean_stores(df), "store_code")
    assert len(out) == 2 and "index" not in out[0]
    st, web = out
    assert (st["staff_numbers"], st["continent"], st["opening_date"]) == ("30", "Europe", dt.date(2011, 6, 12))
    assert (web["address"], web["continent"], web["longitude"], web["latitude"], web["staff_numbers"]) == (
        "N/A", "N/A", None, None, "25")


def test_clean_products(spark):
    df = spark.createDataFrame([
        ("A", "£9.99", "12 x 100g", "Removed", "2001-02-03", "p1"),
        ("B", "£1.00", "1.5kg", None, "2001-02-03", "p2"),
        ("C", "£1.00", "3lb", "Still_available", "2001-02-03", "p3"),   # unknown unit: kept, NULL
        ("D", "£1.00", None, "Removed", "2001-02-03", "p4"),            # no weight: dropped
        ("E", "£1.00", "2kg", "Removed", "NULL", "p5"),                 # bad date: dropped
    ], "product_name string, product_price string, weight string, removed string, date_added string, product_code string")
    out = rows(C.clean_products(df), "product_code")
    assert [(r["product_code"], r["product_price"], r["weight"], r["removed"]) for r in out] == [
        ("p1", "9.99", 1.2, True), ("p2", "1.00", 1.5, False), ("p3", "1.00", None, False)]


def test_clean_orders_requires_columns(spark):
    df = spark.createDataFrame([(1, "x", "y", None, 5)], "level_0 int, first_name string, last_name string, `1` string, q int")
    assert C.clean_orders(df).columns == ["q"]
    with pytest.raises(KeyError):
        C.clean_orders(df.drop("1"))


def test_build_datetime_strict_and_tolerant(spark):
    df = spark.createDataFrame([
        ("1", "2020", "1", "5", "07:05:00", "Morning"),
        ("2", "PO12IU34YT", "1", "5", "07:05:00", "Morning"),
        ("3", "2020", "NULL", "5", "07:05:00", "Morning"),
    ], "date_uuid string, year string, month string, day string, timestamp string, time_period string")
    out = C.build_datetime(df).collect()
    assert len(out) == 1 and out[0].datetime == dt.datetime(2020, 1, 5, 7, 5)
    assert "timestamp" not in C.build_datetime(df).columns
    bad = spark.createDataFrame([("1", "2020", "13", "5", "07:05:00", "Morning")], df.schema)
    with pytest.raises(Exception):
        C.build_datetime(bad).collect()
    assert C.build_datetime(bad, strict=False).count() == 0


def test_dedupe_exact_and_by_key(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "c")], "k int, v string")
    assert C.dedupe_exact(df).count() == 3
    assert rows(C.dedupe_exact(df, ["k"]), "k") == [{"k": 1, "v": "a"}, {"k": 2, "v": "c"}]


def test_conform_strict_and_report_agree(spark):
    spec = {"u": "uuid", "n": "int2", "c": "varchar(2)"}
    good = spark.createDataFrame([("A0EEBC999C0B4EF8BB6D000000000001", "12", "GB"),
                                  ("{a0eebc99-9c0b-4ef8-bb6d-000000000002}", None, None)],
                                 "u string, n string, c string")
    out = D.conform(good, spec).collect()
    assert out[0].u == "a0eebc99-9c0b-4ef8-bb6d-000000000001" and out[0].n == 12
    assert out[1].u == "a0eebc99-9c0b-4ef8-bb6d-000000000002"
    assert D.conform_violations(good.withColumn("id", F.lit(1)), spec, "id", "t").count() == 0
    bad = spark.createDataFrame([(1, "not-a-uuid", "40000", "GBR")], "id int, u string, n string, c string")
    report = {(r.column, r.rule) for r in D.conform_violations(bad, spec, "id", "t").collect()}
    assert report == {("u", "uuid"), ("n", "int2"), ("c", "varchar(2)")}
    for col in ("u", "n", "c"):
        with pytest.raises(Exception):
            D.conform(bad.select(col), {col: spec[col]}).collect()


def test_conform_products_availability(spark):
    df = spark.createDataFrame([("9.99", 1.5, True, "p1"), ("1.00", 150.0, False, "p2")],
                               "product_price string, weight double, removed boolean, product_code string")
    out = rows(D.conform_products(df), "product_code")
    assert [(r["still_available"], r["weight_class"]) for r in out] == [(False, "Light"), (True, "Truck_Required")]
    compat = rows(D.conform_products(df, compat_still_available=True), "product_code")
    assert [r["still_available"] for r in compat] == [True, False]


def test_pk_and_fk(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, -1), (4, 11)], "id int, k int")
    dim = spark.createDataFrame([(10,), (11,), (11,), (None,)], "k int")
    assert [r.id for r in K.fk_violations(fact, dim, "k").collect()] == [3]
    pk = {(r.k, r.n_rows) for r in K.pk_violations(dim, ["k"]).collect()}
    assert pk == {(11, 2), (None, 1)}


def test_unparsed_date_values_report(spark):
    df = spark.createDataFrame([("1999-01-02", "soon"), ("bad", "2001/2/3"), ("bad", None), (None, "soon")],
                               "join_date string, date_added string")
    got = {(r.column, r.value, r.n_rows) for r in C.unparsed_date_values(df).collect()}
    assert got == {("join_date", "bad", 2), ("date_added", "soon", 2)}


def test_strict_uuid_and_date_shapes(spark):
    body = "a0eebc99-9c0b-4ef8-bb6d-000000000001"
    spec = {"u": "uuid", "d": "date"}
    good = spark.createDataFrame([("{" + body.upper() + "}", "2020-01-31"), (body.replace("-", ""), None)], "u string, d string")
    assert [r.u for r in D.conform(good, spec).collect()] == [body, body]
    for u, d in (("{" + body, "2020-01-01"), (body + "}", "2020-01-01"), (body, "2020"), (body, "2020-01"), (body, "2020-13-01")):
        bad = spark.createDataFrame([(u, d)], "u string, d string")
        with pytest.raises(Exception):
            D.conform(bad, spec).collect()
        assert D.conform_violations(bad.withColumn("k", F.lit(1)), spec, "k", "t").count() == 1


def test_mixed_dates_are_parsed_once(spark):
    """The filter on parsed dates does not parse them again; rows and column order stay as they were."""
    rows = [("a", "2 October 1990", 1, "2001-02-03"), ("b", "no date", 2, "2001-02-03"), ("c", None, 3, "2001-02-03"),
            ("d", "1991-05-06", 4, "Oct 2 1999"), ("e", "1991-05-06", 5, None)]
    df = spark.createDataFrame(rows, "d0 string, date_a string, x int, `the date` string")
    out = C.parse_mixed_dates(df)
    assert out.dtypes == [("d0", "string"), ("date_a", "date"), ("x", "int"), ("the date", "date")]
    assert sorted((r[0], str(r[1]), r[2], str(r[3])) for r in out.collect()) == [
        ("a", "1990-10-02", 1, "2001-02-03"), ("d", "1991-05-06", 4, "1999-10-02")]
    assert C.parse_mixed_dates(df, ["date_a"]).count() == 3
    stored = spark.range(5).selectExpr("cast(id AS string) AS date_a", "id")
    plan = C.parse_mixed_dates(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("october") == mixed_date_sql("date_a").count("october")
