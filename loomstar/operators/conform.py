"""Schema conformance (D-01 .. D-08, D-11, X-20).

A table spec maps column names to declared types in the reference's DDL
vocabulary: ``uuid``, ``varchar(n)``, ``int2``, ``float4``, ``date``,
``decimal(p,s)``, ``boolean``, ``text``.  ``conform`` has two modes:

* ``strict``: cast everything with ANSI casts; the first bad value fails the
  job (what ``ALTER COLUMN ... TYPE`` does).  Lengths are checked with
  ``raise_error`` because ``CAST(x AS VARCHAR(n))`` neither truncates nor fails.
* ``report``: never fails; ``conform_violations`` returns one row per bad cell
  (table, column, rule, key, value).  Strict passes iff the report is empty.

Columns not named in the spec pass through unchanged, like columns an
``ALTER TABLE`` does not mention.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstar.functions.sql import as_col, ident, text
from loomstar.operators.reshape import add_column_if_absent, rename_column

# Fixed value: textual UUID forms accepted on input (hyphens optional, braces
# optional, both braces or none, any case); output is the lower-case hyphenated form.
_UUID_BODY = r"[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}"
UUID_PATTERN = rf"^(?:{_UUID_BODY}|\{{{_UUID_BODY}\}})\z"
_UUID_CANONICAL = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"
_UUID_PARTS = r"^\{?([0-9a-f]{8})-?([0-9a-f]{4})-?([0-9a-f]{4})-?([0-9a-f]{4})-?([0-9a-f]{12})\}?\z"

# A date text must have all three parts: the engine's own cast would read ``2020-01`` as 1 January.
DATE_PATTERN = r"^\s*[0-9]{4,}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?\s*\z"

_VARCHAR = re.compile(r"varchar\((\d+)\)")

# Declared column types of the conformed star (the DDL), as
# they apply to this repository's star (money as exact decimal, Q-09).
SPECS: dict[str, dict[str, str]] = {
    "orders_table": {"date_uuid": "uuid", "user_uuid": "uuid", "card_number": "varchar(19)",
                     "store_code": "varchar(12)", "product_code": "varchar(11)",
                     "product_quantity": "int2"},
    "dim_users_table": {"first_name": "varchar(255)", "last_name": "varchar(255)",
                        "date_of_birth": "date", "country_code": "varchar(2)",
                        "user_uuid": "uuid", "join_date": "date"},
    "dim_store_details": {"longitude": "float4", "locality": "varchar(255)",
                          "store_code": "varchar(12)", "staff_numbers": "int2",
                          "opening_date": "date", "store_type": "varchar(255)",
                          "latitude": "float4", "country_code": "varchar(3)",
                          "continent": "varchar(255)"},
    "dim_products": {"product_price": "decimal(12,2)", "weight": "float4", "EAN": "varchar(20)",
                     "product_code": "varchar(20)", "date_added": "date", "uuid": "uuid",
                     "weight_class": "varchar(20)"},
    "dim_date_times": {"month": "varchar(2)", "year": "varchar(4)", "day": "varchar(2)",
                       "time_period": "varchar(20)", "date_uuid": "uuid"},
    "dim_card_details": {"card_number": "varchar(22)", "expiry_date": "varchar(5)",
                         "date_payment_confirmed": "date"},
}

# Weight class buckets in kilograms (half-open, no ELSE).
WEIGHT_CLASSES = (("Light", None, 2.0), ("Mid_Sized", 2.0, 40.0),
                  ("Heavy", 40.0, 140.0), ("Truck_Required", 140.0, None))

_SPARK_TYPE = {"int2": "smallint", "float4": "float", "date": "date", "boolean": "boolean",
               "text": "string", "uuid": "string"}


def spark_type(declared: str) -> str:
    if declared in _SPARK_TYPE:
        return _SPARK_TYPE[declared]
    if _VARCHAR.fullmatch(declared):
        return "string"
    if declared.startswith("decimal"):
        return declared
    raise ValueError(f"unknown declared type {declared!r}")


def _conform_sql(c: str, declared: str) -> str:
    """Strict conformance of one column as SQL: ANSI cast, or ``raise_error``."""
    col, txt = ident(c), f"CAST({ident(c)} AS STRING)"
    if declared == "uuid":
        # canonical text, the usual case, takes one test; other accepted forms one more test and one rewrite
        rewritten = f"regexp_replace(lower({txt}), {text(_UUID_PARTS)}, '$1-$2-$3-$4-$5')"
        return (f"CASE WHEN {txt} IS NULL OR {txt} RLIKE {text(_UUID_CANONICAL)} THEN {txt} "
                f"WHEN {txt} RLIKE {text(UUID_PATTERN)} THEN {rewritten} "
                f"ELSE raise_error(concat({text(f'invalid uuid in {c}: ')}, {txt})) END")
    m = _VARCHAR.fullmatch(declared)
    if m:
        n = int(m.group(1))
        return (f"CASE WHEN {txt} IS NULL OR length({txt}) <= {n} THEN {txt} "
                f"ELSE raise_error(concat({text(f'value too long for varchar({n}) in {c}: ')}, {txt})) END")
    if declared == "date":
        return (f"CASE WHEN {txt} IS NULL OR {txt} RLIKE {text(DATE_PATTERN)} THEN CAST({col} AS DATE) "
                f"ELSE raise_error(concat({text(f'invalid date in {c}: ')}, {txt})) END")
    return f"CAST({col} AS {spark_type(declared)})"


def conform(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Strict conformance: cast spec columns in one projection; bad values fail the job."""
    return df.selectExpr(*[as_col(_conform_sql(c, spec[c]), c) if c in spec else ident(c)
                           for c in df.columns])


def violation_checks_sql(c: str, declared: str) -> list[tuple[str, str]]:
    """(rule, SQL predicate) pairs that are true for a bad non-NULL cell."""
    txt = f"CAST({ident(c)} AS STRING)"
    present = f"{ident(c)} IS NOT NULL"
    m = _VARCHAR.fullmatch(declared)
    if m:
        return [(f"varchar({m.group(1)})", f"{present} AND length({txt}) > {int(m.group(1))}")]
    if declared == "uuid":
        return [("uuid", f"{present} AND NOT ({txt} RLIKE {text(UUID_PATTERN)})")]
    if declared == "text":
        return []
    if declared == "date":
        return [("date", f"{present} AND (NOT ({txt} RLIKE {text(DATE_PATTERN)}) "
                         f"OR try_cast({ident(c)} AS DATE) IS NULL)")]
    return [(declared, f"{present} AND try_cast({ident(c)} AS {spark_type(declared)}) IS NULL")]


def conform_violations(df: DataFrame, spec: dict[str, str], key: str, table: str) -> DataFrame:
    """D-11 report mode: one row per bad cell, (table, column, rule, key, value).

    One narrow pass: each row emits an array of its violations, which is
    exploded; no shuffle, no collect.
    """
    checks = [(c, rule, pred) for c, declared in spec.items() if c in df.columns
              for rule, pred in violation_checks_sql(c, declared)]
    if not checks:
        return df.sparkSession.createDataFrame(
            [], "table string, column string, rule string, key string, value string")
    items = ", ".join(
        f"CASE WHEN {pred} THEN named_struct('column', {text(c)}, 'rule', {text(rule)}, "
        f"'value', CAST({ident(c)} AS STRING)) END"
        for c, rule, pred in checks)
    found = f"filter(array({items}), x -> x IS NOT NULL)"
    return (df.selectExpr(f"CAST({ident(key)} AS STRING) AS key", f"explode({found}) AS v")
            .selectExpr(f"{text(table)} AS `table`", "v.column AS `column`", "v.rule AS rule",
                        "key", "v.value AS value"))


def weight_class(c: str = "weight") -> Column:
    """X-15: bucket a weight in kilograms; NULL weight gives NULL (no ELSE)."""
    w = F.col(c)
    expr = None
    for name, lo, hi in WEIGHT_CLASSES:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (w >= lo)
        if hi is not None:
            cond = cond & (w < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def conform_products(df: DataFrame, compat_still_available: bool = False) -> DataFrame:
    """D-04 .. D-06: add ``weight_class``, conform, publish availability.

    The original renames ``removed`` to ``still_available`` without inverting
    it (Q-08).  By default ``still_available = NOT removed``;
    ``compat_still_available=True`` keeps the original, inverted meaning.
    """
    out = add_column_if_absent(df, "weight_class", weight_class("weight"))
    out = conform(out, SPECS["dim_products"])
    if compat_still_available:
        return rename_column(out, "removed", "still_available")
    return out.withColumn("removed", ~F.col("removed")).withColumnRenamed("removed", "still_available")


def union_violations(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)
