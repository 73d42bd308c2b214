"""Property-based checks of the scalar functions against plain-Python models."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from loomstar.functions.dates import parse_mixed_date, parse_mixed_timestamp
from loomstar.functions.weights import UNIT_TO_KG, weight_kg

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December"]

dates = st.dates(min_value=dt.date(1700, 1, 1), max_value=dt.date(2200, 12, 31))


def layouts(d: dt.date):
    return [
        f"{d.year}-{d.month:02d}-{d.day:02d}",
        f"{d.year}-{d.month}-{d.day}",
        f"{d.year}/{d.month:02d}/{d.day:02d}",
        f"{d.year} {MONTHS[d.month - 1]} {d.day:02d}",
        f"{MONTHS[d.month - 1]} {d.year} {d.day}",
    ]


@settings(max_examples=25, deadline=None)
@given(st.lists(dates, min_size=1, max_size=20))
def test_mixed_dates_round_trip(spark, values):
    rows = [(i, text, d) for i, d in enumerate(values) for text in layouts(d)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "i int, t string")
    got = [r[0] for r in df.select(parse_mixed_date("t")).collect()]
    assert got == [d for _, _, d in rows]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.datetimes(min_value=dt.datetime(1700, 1, 1), max_value=dt.datetime(2200, 12, 31)), min_size=1, max_size=10))
def test_mixed_timestamps_round_trip(spark, values):
    def texts(t: dt.datetime):
        dates = [f"{MONTHS[t.month - 1]} {t.day}, {t.year}", f"{t.day}-{MONTHS[t.month - 1][:3]}-{t.year}", f"{t:%Y.%m.%d}", f"{t:%Y%m%d}",
                 f"{t:%A} {t.day} {MONTHS[t.month - 1].upper()} {t.year}", f"{t.month}/{t.day}/{t.year}"]
        times = [f"{t:%H:%M:%S}.{t.microsecond:06d}", f"{t.hour % 12 or 12}:{t:%M:%S}.{t.microsecond:06d} {'pm' if t.hour > 11 else 'AM'}",
                 f"{t:%H:%M:%S},{t.microsecond:06d} +01:30"]
        return [f"{d} {c}" for d in dates for c in times] + [f"{t.isoformat()}Z"]

    rows = [(i, text, t) for i, t in enumerate(values) for text in texts(t)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "i int, t string")
    assert [r[0] for r in df.select(parse_mixed_timestamp("t")).collect()] == [t for _, _, t in rows]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 999), st.integers(1, 99), st.sampled_from(sorted(UNIT_TO_KG)),
                          st.booleans()), min_size=1, max_size=20))
def test_weights_match_model(spark, items):
    texts, expect = [], []
    for n, m, unit, pack in items:
        if pack:
            texts.append(f"{m} x {n}{unit}")
            expect.append(UNIT_TO_KG[unit] * float(m * n))
        else:
            texts.append(f"{n}{unit}")
            expect.append(UNIT_TO_KG[unit] * float(n))
    df = spark.createDataFrame([(t,) for t in texts], "w string")
    assert [r[0] for r in df.select(weight_kg("w")).collect()] == expect


# --- regular expressions: Spark (Java) against Python's engine ---------------------

import re  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from loomstar.functions.text import is_junk_code  # noqa: E402
from loomstar.functions.urls import URL_PATTERN, url_parts  # noqa: E402
from loomstar.functions.weights import NUMBER_PATTERN  # noqa: E402

# Python's form of the junk test: ``$`` also matches before one final newline.
PY_JUNK = re.compile(r"^[A-Z0-9]{10}$")


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="AZ09az \n\r", min_size=8, max_size=12), min_size=1, max_size=30))
def test_junk_code_matches_python_semantics(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(is_junk_code("v")).collect()]
    assert got == [PY_JUNK.search(v) is not None for v in values]


hosts = st.text(alphabet="abz09-._", min_size=1, max_size=12)
urls = st.builds(lambda scheme, host, path: f"{scheme}://{host}/{path}",
                 st.sampled_from(["s3", "http", "https", "ftp"]), hosts,
                 st.text(alphabet="abc/._-", min_size=0, max_size=8))


@settings(max_examples=30, deadline=None)
@given(st.lists(urls, min_size=1, max_size=30))
def test_url_parts_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, u string")
    got = [tuple(r) for r in df.orderBy("i").select(*url_parts("u")).collect()]
    expect = []
    for v in values:
        m = re.match(URL_PATTERN, v)
        expect.append(tuple(g or None for g in m.groups()) if m else (None, None, None))
    assert got == expect


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.*gk", min_size=0, max_size=10), min_size=1, max_size=30))
def test_weight_number_extraction_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, w string")
    got = [r[0] for r in df.orderBy("i").select(F.regexp_extract("w", NUMBER_PATTERN, 1)).collect()]
    expect = []
    for v in values:
        m = re.search(NUMBER_PATTERN, v)
        expect.append(m.group(1) if m else "")
    assert got == expect
