"""Cleaning operators and per-dataset pipelines (C-01 .. C-10).

Every function is a pure ``DataFrame -> DataFrame`` transform meant for
``df.transform(f)``.  Steps keep the order of the original pipelines, because
order changes results (Q-20, Q-28).  All work is row-local (narrow): the only
operator here that shuffles is de-duplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.functions.dates import datetime_from_parts_sql, mixed_date_sql
from loomstar.functions.sql import as_col, ident, text
from loomstar.functions.text import (
    equals_flag_sql,
    newlines_to_commas_sql,
    strip_leading_lower_sql,
    strip_letters_sql,
    strip_literal_sql,
    strip_question_marks_sql,
)
from loomstar.functions.weights import weight_kg_sql
from loomstar.operators.nulls import (
    dropna_any,
    null_header_cells,
    null_literal,
    null_unknown_codes,
)
from loomstar.operators.reshape import drop_columns_strict, drop_index_column

WEB_STORE_TYPE = "Web Portal"
NOT_APPLICABLE = "N/A"
CURRENCY_SIGN = "£"
ORDER_SURPLUS_COLUMNS = ["first_name", "last_name", "1", "level_0"]


def date_columns(df: DataFrame) -> list[str]:
    """F-09: columns whose name contains ``date`` (case-sensitive)."""
    return [c for c in df.columns if "date" in c]


def parse_mixed_dates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """C-01: parse every ``*date*`` column as mixed text into DATE; drop rows that fail.

    The parsed values come out of a generator, which emits no row where one is missing: a
    filter on them would be pushed below the projection, and every text be parsed twice.
    """
    cols = date_columns(df) if columns is None else columns
    if not cols:
        return df
    found = {c: f"d{i}" for i, c in enumerate(dict.fromkeys(cols))}
    values = ", ".join(f"{text(d)}, {mixed_date_sql(c)}" for c, d in found.items())
    whole = " AND ".join(f"x.{d} IS NOT NULL" for d in found.values())
    parsed = df.selectExpr(*[as_col(ident(c), f"c{i}") for i, c in enumerate(df.columns)],
                           f"inline(filter(array(named_struct({values})), x -> {whole})) AS ({', '.join(found.values())})")
    return parsed.selectExpr(*[as_col(found.get(c, f"c{i}"), c) for i, c in enumerate(df.columns)])


def unparsed_date_values(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """C-01's companion report: non-NULL date texts that no layout accepts.

    One row per (column, value) with its row count, so the layout list can be
    extended from evidence.  A hash aggregation (partial counts before the
    shuffle); nothing is collected.
    """
    cols = date_columns(df) if columns is None else columns
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string, n_rows long")
    items = ", ".join(
        f"named_struct('column', {text(c)}, 'value', CAST({ident(c)} AS STRING), "
        f"'bad', {ident(c)} IS NOT NULL AND {mixed_date_sql(c)} IS NULL)"
        for c in cols)
    return (df.selectExpr(f"explode(filter(array({items}), x -> x.bad)) AS u")
            .groupBy(F.col("u.column").alias("column"), F.col("u.value").alias("value"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def clean_address(df: DataFrame, column: str = "address") -> DataFrame:
    """C-02: drop rows without an address; newlines become ``", "``."""
    return (df.na.drop(how="any", subset=[column])
            .withColumn(column, F.expr(newlines_to_commas_sql(column))))


def clean_users(df: DataFrame, index_col: str | None = "index") -> DataFrame:
    """C-03: dates -> junk codes -> address -> drop index -> ``GGB`` is ``GB``."""
    out = (df.transform(parse_mixed_dates)
           .transform(null_unknown_codes)
           .transform(clean_address)
           .transform(lambda d: drop_index_column(d, index_col)))
    return out.withColumn(
        "country_code",
        F.expr("CASE WHEN country_code = 'GGB' THEN 'GB' ELSE country_code END"))


def clean_cards(df: DataFrame) -> DataFrame:
    """C-04: drop incomplete rows, junk codes and repeated header cells, then strip ``?`` runs.

    The two row drops of the original collapse into one: nulling only adds
    NULLs, so dropping once at the end removes exactly the same rows.
    """
    out = (df.transform(null_unknown_codes)
           .transform(null_header_cells)
           .transform(dropna_any))
    return out.withColumn("card_number", F.expr(strip_question_marks_sql("card_number")))


def web_store_overrides(df: DataFrame) -> DataFrame:
    """F-06 for web stores: no place, so continent/address ``N/A`` and no coordinates."""
    web = f"store_type = {text(WEB_STORE_TYPE)}"
    overrides = {"continent": text(NOT_APPLICABLE), "longitude": "NULL",
                 "latitude": "NULL", "address": text(NOT_APPLICABLE)}
    return df.selectExpr(*[
        as_col(f"CASE WHEN {web} THEN CAST({overrides[f.name]} AS {f.dataType.simpleString()}) "
               f"ELSE {ident(f.name)} END", f.name)
        if f.name in overrides else ident(f.name)
        for f in df.schema.fields])


def clean_stores(df: DataFrame, index_col: str | None = "index") -> DataFrame:
    """C-05: junk -> address -> dates -> web overrides -> staff digits -> continent -> drop index."""
    out = (df.transform(null_unknown_codes)
           .transform(clean_address)
           .transform(parse_mixed_dates)
           .transform(web_store_overrides))
    out = out.withColumns({"staff_numbers": F.expr(strip_letters_sql("staff_numbers")),
                           "continent": F.expr(strip_leading_lower_sql("continent"))})
    return drop_index_column(out, index_col)


def weights_to_kg(df: DataFrame, column: str = "weight", strict_multipack: bool = False) -> DataFrame:
    """C-06: drop rows without a weight, then weight text -> kilograms (DOUBLE)."""
    return (df.na.drop(how="any", subset=[column])
            .withColumn(column, F.expr(weight_kg_sql(column, strict_multipack))))


def clean_products(df: DataFrame) -> DataFrame:
    """C-07 (with the junk and weight steps that precede it in the original run).

    dates -> ``removed`` flag (missing is false) -> weight rounded to 3 places
    (half-even) -> currency sign stripped from the price.
    """
    out = (df.transform(null_unknown_codes)
           .transform(weights_to_kg)
           .transform(parse_mixed_dates))
    return out.withColumns({
        "removed": F.expr(equals_flag_sql("removed", "Removed")),
        "weight": F.expr("bround(weight, 3)"),
        "product_price": F.expr(strip_literal_sql("product_price", CURRENCY_SIGN)),
    })


def clean_orders(df: DataFrame) -> DataFrame:
    """C-08: drop the surplus order columns; any of them missing is an error."""
    return drop_columns_strict(df, ORDER_SURPLUS_COLUMNS)


def build_datetime(df: DataFrame, strict: bool = True) -> DataFrame:
    """C-09: junk -> ``NULL`` text -> drop incomplete rows -> ``datetime`` from the parts.

    ``strict=True`` fails the job when a remaining row does not parse (as the
    original does); ``strict=False`` drops such rows instead.
    """
    out = (df.transform(null_unknown_codes)
           .transform(null_literal)
           .transform(dropna_any))
    out = out.withColumn("datetime", F.expr(datetime_from_parts_sql("year", "month", "day", "timestamp", strict)))
    if not strict:
        out = out.na.drop(how="any", subset=["datetime"])
    return out.drop("timestamp")


def dedupe_exact(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """C-10: remove duplicate rows (all columns, or one row per ``keys``).

    A hash aggregation: the partial step de-duplicates inside each task before
    the shuffle, so a key holding a large share of rows is collapsed early.
    With ``keys`` the surviving row is the smallest by all columns, so the
    result is deterministic.
    """
    if not keys:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    picked = (df.groupBy(*keys)
              .agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_row")))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
