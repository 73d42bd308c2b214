"""Helpers that several operators of this subpackage use.

Tables that a job reads more than once are written to the shared folder named
by ``spark.checkpoint.dir`` (``saved``), so a lost executor never forces a
recomputation that could differ from what was already consumed.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstar.session import scratch_path

#: White space between words: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def ship(module: str) -> None:
    """Send this module's functions to executors by value, so they need no copy of the package.

    Functions must refer to others by name (``from m import f``), not through a module.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


def saved(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: its lineage ends here.

    ``narrow`` tables (a few numbers a row) come in two files per core at most.
    """
    spark = df.sparkSession
    if narrow:
        df = df.coalesce(2 * spark.sparkContext.defaultParallelism)
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; NULL and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), rf"{SPACE_CLASS}+"), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


MAX_BROADCAST_TEXT = 1 << 25     # bytes of text in a table that is broadcast


def broadcast_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast a table of narrow rows if a distributed count proves it has ``max_rows`` and 32 MB of text at most."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(sum(texts, F.lit(0))).alias("bytes")).first()
    return F.broadcast(df) if found["n"] <= max_rows and (found["bytes"] or 0) <= MAX_BROADCAST_TEXT else df


def marked(df: DataFrame, value: Column, keys: DataFrame, bits: int) -> DataFrame:
    """``df`` with ``marked``: false only where ``value`` (a long) is not in the one column of ``keys``.

    The marks are ``2 ** bits`` bits by a hash, in rows of 64, so at most ``2 ** (bits - 6)`` narrow rows are broadcast;
    where they fill up, more rows than needed are marked.
    """
    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c.cast("long")), F.lit(1 << bits))

    found = keys.select(place(F.col(keys.columns[0])).alias("b")).groupBy(F.shiftright("b", 6).alias("mark word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("mark bits"))
    at = df.withColumn("mark place", place(value))
    at = at.join(F.broadcast(saved(found, "marks", narrow=True)), F.shiftright("mark place", 6) == F.col("mark word"), "left")
    hit = F.coalesce(F.expr("shiftright(`mark bits`, cast(`mark place` & 63 as int)) & 1"), F.lit(0)) == 1
    return at.withColumn("marked", hit).drop("mark place", "mark word", "mark bits")


def hidden(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under column names that no operator uses, and those names by the caller's."""
    names = {c: f"caller column {i}" for i, c in enumerate(docs.columns)}
    return docs.select([F.col(f"`{c.replace('`', '``')}`").alias(n) for c, n in names.items()]), names


def shown(df: DataFrame, names: dict[str, str], *more: str) -> DataFrame:
    """The caller's columns under their own names again, and columns of the operator, which replace such names."""
    own = [F.col(n).alias(c) for c, n in names.items() if c not in more]
    return df.select(*own, *more)
