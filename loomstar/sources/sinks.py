"""Sinks (K-01 .. K-03).

``create_table`` keeps the create-only contract of the original loader: an
existing table is never appended to or replaced.  Instead of printing, it
returns whether the table was created (Q-12).  Writes go through Spark's
commit protocol, so a lost executor only retries its tasks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _exists_error(err: Exception) -> bool:
    text = str(err).lower()
    return "already exists" in text or "table_or_view_already_exists" in text


def create_table(df: DataFrame, table: str, fmt: str = "parquet",
                 path: str | None = None, bucket_by: str | None = None,
                 buckets: int | None = None) -> bool:
    """K-01 for catalog tables: write ``df`` as a new table; False if it already exists.

    With ``bucket_by`` the table is hash-bucketed (and sorted) on that column,
    so later joins and aggregations on it between tables bucketed the same way
    need no shuffle.
    """
    writer = df.write.format(fmt).mode("errorifexists")
    if bucket_by:
        writer = writer.bucketBy(buckets or 64, bucket_by).sortBy(bucket_by)
    if path:
        writer = writer.option("path", path)
    try:
        writer.saveAsTable(table)
    except AnalysisException as err:
        if _exists_error(err):
            return False
        raise
    return True


def create_jdbc_table(df: DataFrame, url: str, table: str,
                      properties: dict[str, str] | None = None) -> bool:
    """K-01 over JDBC: create-only insert of the whole frame; False if the table exists."""
    writer = (df.write.format("jdbc").mode("errorifexists")
              .option("url", url).option("dbtable", table))
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    try:
        writer.save()
    except AnalysisException as err:
        if _exists_error(err):
            return False
        raise
    return True


def write_files(df: DataFrame, path: str, fmt: str = "parquet", **options) -> str:
    """Write a frame to a new folder (never overwriting) and return the folder."""
    df.write.format(fmt).options(**options).mode("errorifexists").save(path)
    return path


def preview(df: DataFrame, n: int = 100_000, order_by: list[str] | None = None) -> DataFrame:
    """K-02: the first ``n`` rows, all columns; with ``order_by`` the choice is deterministic.

    Returned as a DataFrame (K-03): the caller decides whether to show it.
    """
    if order_by:
        df = df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return df.limit(n)
