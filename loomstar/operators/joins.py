"""Size-checked broadcast for dimension-side joins.

The planner only broadcasts a side whose *estimated* size is under the
threshold, and estimates for derived dimensions (joins of joins) are products
of their inputs, so a small derived dimension is often planned as a
sort-merge join that shuffles the whole fact.  ``broadcast_if_small`` measures
the projected dimension with one distributed aggregate (rows and bytes; every
task sends one row) and broadcasts it only if its bytes are under the session's
broadcast threshold; beyond it the join stays a shuffle join, with AQE handling
skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_OVERHEAD = 16  # bytes a row holds besides its values


def broadcast_threshold(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1: never)."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return int(conf.autoBroadcastJoinThreshold())


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 8 for each column, and the lengths of text and binary values."""
    wide = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return sum(wide, F.lit(ROW_OVERHEAD + 8 * len(df.columns))).cast("bigint")


def table_bytes(df: DataFrame) -> int:
    return df.agg(F.sum(row_bytes(df)).alias("bytes")).first()["bytes"] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its measured bytes are at most ``max_bytes``, else ``df`` unchanged."""
    limit = broadcast_threshold(df) if max_bytes is None else max_bytes
    return F.broadcast(df) if limit >= 0 and table_bytes(df) <= limit else df
