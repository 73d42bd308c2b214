"""Key constraints as Spark jobs (D-09 / A-10 primary keys, D-10 / J-06 foreign keys).

The reference enforces keys with indexes inside the database.  Here each check
is one job whose output is the set of offending keys or rows; an empty result
means the constraint holds.  ``stacked_key_report`` checks all keys of a star in one
job that scans every table once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.functions.sql import ident, text
from loomstar.operators.joins import broadcast_if_small


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are NULL or appear more than once, with their row count.

    A hash aggregation: partial counts are formed inside each task before the
    shuffle, so a key holding a third of all rows costs one row per task.
    """
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .where((F.col("n_rows") > 1) | null_key))


def fk_violations(fact: DataFrame, dim: DataFrame, fact_key: str,
                  dim_key: str | None = None) -> DataFrame:
    """Fact rows whose non-NULL key has no match in the dimension (NULLs are allowed).

    A left anti join on the key only: the dimension side is reduced to its
    distinct keys and broadcast if their measured bytes allow it, so the
    fact is checked where it is read; beyond the bound it is a sort-merge anti
    join, with AQE splitting skewed keys.
    """
    dim_key = dim_key or fact_key
    keys = broadcast_if_small(
        dim.select(F.col(dim_key).alias("_dim_key")).where(F.col("_dim_key").isNotNull()).distinct())
    return (fact.where(F.col(fact_key).isNotNull())
            .join(keys, F.col(fact_key) == F.col("_dim_key"), "left_anti"))


def stacked_key_report(tables: dict[str, DataFrame], primary: list[tuple[str, str]],
                       foreign: list[tuple[str, str, str, str]]) -> DataFrame:
    """Violations of all declared keys, in one scan of each table and one grouping.

    ``primary`` lists (table, key); ``foreign`` lists (table, column, referenced table, its key).
    A row of a table is stacked into one entry (domain, side, key text) for each key column it
    has a part in; a domain is a referenced or primary key, a side is the row that defines a key (0)
    or one of the foreign keys that use it (from 1 in each domain).  Entries are counted by (domain, key), and
    the counts decide both kinds: a primary key is violated where the key is NULL or defined
    more than once, a foreign key where a non-NULL key is used and nowhere defined.
    Partial counts are formed before the shuffle, so a key that holds a third of the fact costs
    one row a task.  Nothing runs before the result is asked for.
    Result: (check, table, column, key, n_rows); keys are compared as text.
    """
    domains = list(dict.fromkeys([*primary, *((t, k) for _, _, t, k in foreign)]))
    entries: dict[str, list[str]] = {}
    for i, (table, key) in enumerate(domains):
        entries.setdefault(table, []).append(f"{i}, 0, CAST({ident(key)} AS STRING)")
    uses, sides = dict.fromkeys(domains, 0), []
    for table, column, dim, key in foreign:
        uses[dim, key] += 1
        sides.append(uses[dim, key])
        entries.setdefault(table, []).append(f"{domains.index((dim, key))}, {sides[-1]}, CAST({ident(column)} AS STRING)")
    stacked = reduce(DataFrame.unionByName, [
        tables[t].selectExpr(f"stack({len(e)}, {', '.join(e)}) AS (domain, side, key)") for t, e in entries.items()])
    defining = ", ".join(str(i) for i, d in enumerate(domains) if d in primary) or "-1"
    counts = stacked.where(f"key IS NOT NULL OR (side = 0 AND domain IN ({defining}))").groupBy("domain", "key").agg(
        F.count_if(F.col("side") == 0).alias("defined"),
        *(F.count_if(F.col("side") == j).alias(f"used{j}") for j in range(1, max(sides, default=0) + 1)))

    def found(when: str, check: str, table: str, column: str, n: str) -> str:
        return (f"CASE WHEN {when} THEN named_struct('check', {text(check)}, 'table', {text(table)}, "
                f"'column', {text(column)}, 'n_rows', {n}) END")

    checks = [found(f"domain = {domains.index((t, k))} AND (defined > 1 OR (key IS NULL AND defined > 0))", "primary_key", t, k, "defined")
              for t, k in primary]
    checks += [found(f"domain = {domains.index((d, k))} AND used{j} > 0 AND defined = 0", "foreign_key", t, c, f"used{j}")
               for j, (t, c, d, k) in zip(sides, foreign)]
    bad = counts.selectExpr("key", f"explode(filter(array({', '.join(checks)}), x -> x IS NOT NULL)) AS v")
    return bad.selectExpr("v.check AS check", "v.table AS `table`", "v.column AS `column`", "key", "v.n_rows AS n_rows")
