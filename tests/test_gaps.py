"""W-01 / W-02 against a brute-force successor computed in plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomstar.operators.gaps import avg_gap_by_year, avg_gap_telescoped, next_event_gap


def brute_next(rows):
    out = []
    by_year = {}
    for key, year, ts in rows:
        by_year.setdefault(year, []).append((key, ts))
    for year, items in by_year.items():
        items.sort(key=lambda kt: (kt[1] is None, kt[1] or dt.datetime.min, kt[0] is None, kt[0] or 0))
        for i, (key, ts) in enumerate(items):
            out.append((key, year, ts, items[i + 1][1] if i + 1 < len(items) else None))
    return sorted(out, key=str)


def fixture_rows():
    rnd = random.Random(7)
    base = dt.datetime(2020, 1, 1)
    rows = []
    for key in range(400):
        year = 2020 if key < 250 else 2021 if key < 390 else None   # a hot year and a NULL year
        ts = None if key % 37 == 0 else base + dt.timedelta(days=rnd.randint(0, 40), hours=rnd.choice([0, 6]))
        rows.append((key, year, ts))
    rows.append((1000, 2022, base))                                # single-row year
    rows += [(5, 2020, rows[5][2]), (5, 2020, rows[5][2])]          # exact duplicate rows
    rows += [(None, 2020, rows[6][2]), (None, 2021, None)]           # NULL keys
    return rows


@pytest.mark.parametrize("buckets", [None, 1, 3, 50])
def test_next_event_gap_matches_brute_force(spark, buckets):
    rows = fixture_rows()
    df = spark.createDataFrame(rows, "date_key long, year int, datetime timestamp_ntz")
    got = sorted(((r.date_key, r.year, r.datetime, r.next_datetime)
                  for r in next_event_gap(df, buckets=buckets).collect()), key=str)
    assert got == brute_next(rows)


def test_telescoped_equals_window(spark):
    rows = fixture_rows()
    df = spark.createDataFrame(rows, "date_key long, year int, datetime timestamp_ntz")
    a = {r.year: r.actual_time_taken for r in avg_gap_by_year(df).collect()}
    b = {r.year: r.actual_time_taken for r in avg_gap_telescoped(df).collect()}
    assert a == b
    assert a[2022] is None


def test_hot_timestamp_and_hot_year(spark):
    # one timestamp holds a third of all rows, and one year nearly all of them
    base = dt.datetime(2021, 3, 1)
    rows = [(k, 2021, base) for k in range(300)]
    rows += [(1000 + k, 2021, base + dt.timedelta(minutes=k)) for k in range(580)]
    rows += [(5000 + k, 2022, dt.datetime(2022, 1, 1) + dt.timedelta(days=k)) for k in range(20)]
    df = spark.createDataFrame(rows, "date_key long, year int, datetime timestamp_ntz")
    got = sorted(((r.date_key, r.year, r.datetime, r.next_datetime)
                  for r in next_event_gap(df, buckets=16).collect()), key=str)
    assert got == brute_next(rows)


def test_successor_plan_never_windows_by_year_alone(spark):
    from loomstar.operators.gaps import _next_distinct

    rows = fixture_rows()
    df = spark.createDataFrame(rows, "date_key long, year int, datetime timestamp_ntz")
    times = df.where("datetime IS NOT NULL").groupBy("year", "datetime").count()
    out = _next_distinct(times, "year", "datetime")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
    assert windows, "the successor is a window over range buckets"
    # every window is keyed by the range bucket (or is the one-row-per-bucket stitch)
    assert all("windowspecdefinition(_b" in w for w in windows)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
@pytest.mark.parametrize("partitions", [2, 3, 4, 8, 200])
def test_successors_at_any_partition_count(spark, sf, partitions):
    """Range bounds are sampled; the answer must not depend on them."""
    dates = spark.read.parquet(f"{sf}/orders.parquet").selectExpr(
        "o_orderkey AS date_key", "o_orderdate AS datetime", "CAST(year(o_orderdate) AS INT) AS year")
    w = Window.partitionBy("year").orderBy(F.col("datetime").asc_nulls_last(), F.col("date_key").asc_nulls_last())
    want = dates.withColumn("next_datetime", F.lead("datetime").over(w)).select("date_key", "year", "datetime", "next_datetime")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = next_event_gap(dates).select("date_key", "year", "datetime", "next_datetime")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        a = {r.year: r.actual_time_taken for r in avg_gap_by_year(dates).collect()}
        b = {r.year: r.actual_time_taken for r in avg_gap_telescoped(dates).collect()}
        assert a == b
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_null_key_with_a_third_of_the_rows(spark):
    """Rows of a repeated key and time are written out in chunks, exactly as often as they came."""
    rows = spark.range(90_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS date_key", "2020 AS year",
        "CASE WHEN id % 3 = 0 THEN timestamp_ntz'2020-05-01 00:00:00' ELSE "
        "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id % 300 as int)) END AS datetime")
    got = next_event_gap(rows)
    assert got.count() == 90_000
    hot = got.where("date_key IS NULL").groupBy("next_datetime").count().collect()
    assert sorted(r["count"] for r in hot) == [1, 29_999]


def test_rows_of_a_hot_time_spread_over_tasks(spark):
    """A third of the rows at one time, in one year: no range, hence no task, gets more than its share, and no row is joined."""
    from loomstar.operators.gaps import _ranged

    rows = spark.range(60_000).selectExpr(
        "id AS date_key", "2020 AS year",
        "CASE WHEN id % 3 = 0 THEN timestamp_ntz'2020-05-01 00:00:00' ELSE "
        "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(id as int) * 7) END AS datetime")
    ranged = _ranged(rows.withColumn("_n", F.lit(1).cast("long")), "year", "datetime", "date_key", buckets=12)
    sizes = [r["count"] for r in ranged.groupBy("_b").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * 60_000 / 12
    hot = ranged.where("datetime = timestamp_ntz'2020-05-01 00:00:00'").select("_b").distinct().count()
    assert hot >= 4
    gaps = next_event_gap(rows, buckets=12)
    w = Window.partitionBy("year").orderBy("datetime", "date_key")
    want = rows.withColumn("next_datetime", F.lead("datetime").over(w))
    assert gaps.select(*want.columns).exceptAll(want).count() == 0 and gaps.count() == 60_000
    plan = gaps._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1  # the one row per range
