"""Successor gaps over time (W-01, W-02, A-07, X-19).

``next_event_gap`` is ``LEAD(ts) OVER (PARTITION BY part ORDER BY ts, key)``.
A plain window would send each partition (a year: only a handful exist) to a
single task, and equal timestamps (day-precision dates) would pile up in it.
Instead equal rows are counted, the distinct rows are ordered in balanced range
buckets of (part, ts, key), so that one hot time spreads over buckets too, and
bucket boundaries are stitched through a table of one row per bucket.  No row is
joined to another one.

``avg_gap_telescoped`` gives the same yearly mean without any ordering: for the
non-null times of a group the successor differences telescope,
``sum(next - cur) = max - min`` over ``n - 1`` gaps.  It is a hash aggregation
whose partial step runs before the shuffle, so no group is ever one task.
Both compute the mean as ``double(sum_us) / count / 1e6``, so they agree bit
for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstar.session import scratch_path

REPEAT_CHUNK = 10_000


def micros_between(start: Column, end: Column) -> Column:
    """Whole microseconds from ``start`` to ``end`` (BIGINT)."""
    return F.timestamp_diff("MICROSECOND", start, end)


def _ranged(rows: DataFrame, part: str, ts: str, key: str | None = None, buckets: int | None = None) -> DataFrame:
    """Distinct rows in ``buckets`` contiguous ranges of (part, ts, key), written once with their range ``_b``.

    Range bounds are sampled, so whoever orders and stitches must read the same ranges
    and never range-partition anew.  The rows are distinct, so the bounds balance the
    buckets even when one part or one time holds most of them.
    """
    spark = rows.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranged")
    order = [F.col(part).asc_nulls_first(), F.col(ts).asc()] + ([F.col(key).asc_nulls_last()] if key else [])
    (rows.repartitionByRange(n, *order)
     .withColumn("_b", F.spark_partition_id()).write.mode("errorifexists").parquet(path))
    return spark.read.parquet(path)


def _followed(ranged: DataFrame, part: str, ts: str, key: str | None = None) -> DataFrame:
    """``_next``: the ts of the following row of the same part, over all ranges.

    Inside a range it is a window.  Only the last row of a range's last part finds no
    successor there although its part may go on: it takes the first row of the next
    non-empty range, from a table of one row per range (bounded by their number, so broadcast).
    """
    order = [F.col(ts).asc()] + ([F.col(key).asc_nulls_last()] if key else [])
    local = ranged.withColumn("_next", F.lead(ts).over(Window.partitionBy("_b", part).orderBy(*order)))
    at = F.struct(F.col(part).alias("p"), F.col(ts).alias("t"))
    ends = ranged.groupBy("_b").agg(F.min(at).alias("_first"), F.max(at).alias("_last"))
    # one row per non-empty range: a single ordered pass over at most that many rows
    follow = ends.withColumn("_nf", F.lead("_first").over(Window.orderBy("_b")))
    stitch = follow.select(
        F.col("_b").alias("_sb"), F.col("_last.p").alias("_lp"),
        F.when(F.col("_nf.p").eqNullSafe(F.col("_last.p")), F.col("_nf.t")).alias("_stitch"))
    joined = local.join(F.broadcast(stitch), local["_b"] == stitch["_sb"], "left")
    nxt = F.coalesce(F.col("_next"), F.when(F.col(part).eqNullSafe(F.col("_lp")), F.col("_stitch")))
    return joined.select(*ranged.columns, nxt.alias("_next"))


def _next_distinct(times: DataFrame, part: str, ts: str, buckets: int | None = None) -> DataFrame:
    """For unique (part, ts) rows: the next larger ts in the same part (``_next``)."""
    return _followed(_ranged(times, part, ts, buckets=buckets), part, ts).select(*times.columns, "_next")


def next_event_gap(df: DataFrame, key: str = "date_key", part: str = "year",
                   ts: str = "datetime", buckets: int | None = None) -> DataFrame:
    """Each row with the next time in its ``part`` and the gap in microseconds.

    Same rows as ``LEAD(ts) OVER (PARTITION BY part ORDER BY ts NULLS LAST, key NULLS LAST)``.
    Equal rows are counted before anything is ordered (partial counts before the
    shuffle); of ``n`` of them, one takes the following row's time and the others
    their own.  Copies beyond ``REPEAT_CHUNK`` are written out again in chunks spread
    over tasks, so a row that comes a billion times is never one array or one task.
    Rows without a time come last in their part: they have no next time.
    Output: key, part, ts, ``next_<ts>``, ``gap_us``.
    """
    nxt = f"next_{ts}"
    counted = df.groupBy(key, part, ts).agg(F.count(F.lit(1)).alias("_n"))
    ranged = _ranged(counted, part, ts, key, buckets)
    timed, untimed = ranged.where(F.col(ts).isNotNull()), ranged.where(F.col(ts).isNull())
    rows = _followed(timed, part, ts, key).unionByName(untimed.withColumn("_next", F.col(ts)))
    chunk = F.lit(REPEAT_CHUNK).cast("bigint")
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.col("_n"), chunk) - 1))
    first = rows.withColumn("_i", copy).select(key, part, ts, F.when(F.col("_i") == 0, F.col("_next")).otherwise(F.col(ts)).alias(nxt))
    more = (ranged.where(F.col("_n") > chunk)
            .withColumn("_c", F.explode(F.sequence(chunk, F.col("_n") - 1, chunk)))
            .repartition(F.col("_c"), F.col(part), F.col(ts), F.col(key))
            .withColumn("_i", F.explode(F.sequence(F.col("_c"), F.least(F.col("_c") + chunk, F.col("_n")) - 1)))
            .select(key, part, ts, F.col(ts).alias(nxt)))
    out = first.unionByName(more)
    return out.select(key, part, ts, nxt, micros_between(F.col(ts), F.col(nxt)).alias("gap_us"))


def avg_gap_by_year(df: DataFrame, part: str = "year", ts: str = "datetime",
                    key: str = "date_key") -> DataFrame:
    """A-07 over W-01: mean successor gap per ``part`` in seconds (DOUBLE)."""
    gaps = next_event_gap(df, key=key, part=part, ts=ts)
    return (gaps.groupBy(part)
            .agg(F.sum("gap_us").alias("_s"), F.count("gap_us").alias("_n"))
            .select(part, (F.col("_s").cast("double") / F.nullif(F.col("_n"), F.lit(0))
                           / F.lit(1e6)).alias("actual_time_taken")))


def avg_gap_telescoped(df: DataFrame, part: str = "year", ts: str = "datetime") -> DataFrame:
    """W-02: ``(max - min) / (n - 1)`` per ``part`` in seconds; NULL when n < 2."""
    return (df.groupBy(part)
            .agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), F.count(ts).alias("_n"))
            .select(part, (micros_between(F.col("_lo"), F.col("_hi")).cast("double")
                           / F.nullif(F.col("_n") - 1, F.lit(0))
                           / F.lit(1e6)).alias("actual_time_taken")))
