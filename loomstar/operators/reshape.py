"""Projection and reshaping operators (P-01 .. P-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def reindex_columns(df: DataFrame, columns: list[str],
                    types: dict[str, T.DataType] | None = None) -> DataFrame:
    """P-01: exactly ``columns`` in that order; extras dropped, absent ones NULL.

    Absent columns are typed from ``types`` (default STRING).
    """
    types = types or {}
    present = set(df.columns)
    return df.select(*[
        F.col(c) if c in present
        else F.lit(None).cast(types.get(c, T.StringType())).alias(c)
        for c in columns])


def drop_columns_strict(df: DataFrame, columns: list[str]) -> DataFrame:
    """P-02: drop ``columns``; a name that is not there is an error (Q-22)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*columns)


def drop_index_column(df: DataFrame, index_col: str | None = "index") -> DataFrame:
    """P-04: remove the surrogate row-index column; ``None`` leaves the frame as is."""
    if index_col is None:
        return df
    return drop_columns_strict(df, [index_col])


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """P-05."""
    return df.withColumnRenamed(old, new)


def add_column_if_absent(df: DataFrame, name: str, value, dtype: str = "string") -> DataFrame:
    """P-06: like ``ADD COLUMN IF NOT EXISTS``; an existing column is left alone."""
    if name in df.columns:
        return df
    col = value if hasattr(value, "alias") else F.lit(value)
    return df.withColumn(name, col.cast(dtype))
