"""Missing-value operators (F-01 .. F-05, S-04).

Each is one projection over all columns (a single ``selectExpr``), never a
loop of ``withColumn`` calls, so plans stay flat however wide the table is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loomstar.functions.sql import as_col, ident, text
from loomstar.functions.text import null_if_junk_sql

# Text the original CSV reader treats as missing (pandas defaults).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def dropna_subset(df: DataFrame, subset: list[str]) -> DataFrame:
    """F-01: drop rows with a missing value in any of ``subset``."""
    return df.na.drop(how="any", subset=subset)


def dropna_any(df: DataFrame) -> DataFrame:
    """F-02: drop rows with any missing value."""
    return df.na.drop(how="any")


def null_unknown_codes(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """F-03: every cell whose text is a junk code becomes NULL (all columns, types kept).

    Only cells change; no row is removed here (Q-01).  ``exclude`` protects
    columns whose legitimate values look like codes (Q-02).
    """
    return df.selectExpr(*[
        ident(f.name) if f.name in exclude else as_col(null_if_junk_sql(f.name, f.dataType), f.name)
        for f in df.schema.fields])


def null_header_cells(df: DataFrame) -> DataFrame:
    """F-04: a cell equal to its own column name becomes NULL (repeated headers)."""
    return df.selectExpr(*[
        as_col(f"CASE WHEN NOT (CAST({ident(c)} AS STRING) <=> {text(c)}) THEN {ident(c)} END", c)
        for c in df.columns])


def null_literal(df: DataFrame, token: str = "NULL") -> DataFrame:
    """F-05: the exact text ``token`` becomes NULL in every string column."""
    return df.selectExpr(*[
        as_col(f"nullif({ident(f.name)}, {text(token)})", f.name)
        if isinstance(f.dataType, T.StringType) else ident(f.name)
        for f in df.schema.fields])


def na_tokens_to_null(df: DataFrame, tokens: tuple[str, ...] = NA_TOKENS) -> DataFrame:
    """S-04: NA tokens in string columns become NULL (what a CSV reader implies)."""
    listed = ", ".join(text(t) for t in tokens)
    return df.selectExpr(*[
        as_col(f"CASE WHEN NOT ({ident(f.name)} IN ({listed})) THEN {ident(f.name)} END", f.name)
        if isinstance(f.dataType, T.StringType) else ident(f.name)
        for f in df.schema.fields])
