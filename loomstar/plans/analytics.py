"""The nine analytic questions over the star (Q4.1 - Q4.9) plus the global total.

Inputs are the conformed star tables:

* ``fact``    (date_key, store_code, product_code, product_quantity)
* ``store``   (store_code, store_type, staff_numbers, locality, country_code, ...)
* ``product`` (product_code, product_price, ...)
* ``date_dim``(date_key, datetime, year, month, day)

Scale notes (each plan was read with ``explain("formatted")``):

* No unconditional broadcast hints: dimension sizes grow with the data.  Base
  dimensions are broadcast by the planner's size check
  (``autoBroadcastJoinThreshold``, re-checked by AQE from real shuffle sizes);
  where a derived dimension's estimate is useless and the fact would be
  shuffled for it, ``broadcast_if_small`` measures its bytes first.
* Sales are rolled up to the grain of the next join key *before* that join
  (eager aggregation).  Amounts are exact integer cents, so the answer does
  not depend on where partial sums are formed, while the rows crossing each
  exchange shrink and the partial (map-side) aggregate collapses hot keys
  before any shuffle.
* Distinct store counts are a semi join against the de-duplicated fact key,
  so the fact contributes at most one row per store per task to the shuffle.
* Every top-k has a total order (group keys break ties) and explicit null
  ordering (PostgreSQL puts NULLs first on DESC and last on ASC).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstar.functions.money import line_cents, money_from_cents, price_cents, share_pct
from loomstar.operators.gaps import avg_gap_by_year, avg_gap_telescoped  # noqa: F401
from loomstar.operators.joins import broadcast_if_small

ONLINE_TYPE = "Web Portal"


def _prices(product: DataFrame) -> DataFrame:
    """Product prices as BIGINT cents, computed on the dimension side."""
    return product.select("product_code", price_cents("product_price").alias("price_cents"))


def _priced(fact: DataFrame, product: DataFrame) -> DataFrame:
    """Fact lines with their exact amount in cents (J-02, P-08)."""
    return (fact.select("date_key", "store_code", "product_code", "product_quantity")
            .join(_prices(product), "product_code")
            .withColumn("amount", line_cents("product_quantity", "price_cents")))


def _stores_with_orders(fact: DataFrame, store: DataFrame) -> DataFrame:
    """Store rows that have at least one fact line (Q-27), as a semi join."""
    keys = fact.select("store_code").where(F.col("store_code").isNotNull()).distinct()
    return store.join(keys, "store_code", "left_semi")


def _distinct_stores(approximate: bool):
    """A-01: exact distinct count, or a HyperLogLog estimate when opted in."""
    if approximate:
        return F.approx_count_distinct("store_code").alias("num_stores")
    return F.countDistinct("store_code").alias("num_stores")


def stores_per_country(fact: DataFrame, store: DataFrame, approximate: bool = False) -> DataFrame:
    """Q4.1: distinct stores (with orders) per country."""
    return (_stores_with_orders(fact, store)
            .groupBy("country_code")
            .agg(_distinct_stores(approximate)))


def stores_per_locality_top(fact: DataFrame, store: DataFrame, k: int = 7,
                            approximate: bool = False) -> DataFrame:
    """Q4.2: top-k localities by distinct stores with orders."""
    return (_stores_with_orders(fact, store)
            .groupBy("locality")
            .agg(_distinct_stores(approximate))
            .orderBy(F.col("num_stores").desc_nulls_first(), F.col("locality").asc_nulls_last())
            .limit(k))


def sales_total(fact: DataFrame, product: DataFrame) -> DataFrame:
    """A-05: one-row global sales total."""
    return (_priced(fact, product)
            .agg(F.sum("amount").alias("total"))
            .select(money_from_cents("total").alias("total_sales")))


def _sales_per_date(fact: DataFrame, product: DataFrame,
                    store: DataFrame | None = None) -> DataFrame:
    """Sales rolled up to the date key; optional filter-only store join (Q-26)."""
    priced = _priced(fact, product)
    if store is not None:
        # filter-only join: the store keys are broadcast when a bounded count
        # proves them small, so the fact is not shuffled for it
        priced = priced.join(broadcast_if_small(store.select("store_code")), "store_code")
    return priced.groupBy("date_key").agg(F.sum("amount").alias("amount"))


def sales_by_month_top(fact: DataFrame, date_dim: DataFrame, product: DataFrame,
                       k: int = 6) -> DataFrame:
    """Q4.3: top-k months (across years) by sales."""
    per_date = _sales_per_date(fact, product)
    return (per_date.join(date_dim.select("date_key", "month"), "date_key")
            .groupBy("month")
            .agg(F.sum("amount").alias("amount"))
            .select(money_from_cents("amount").alias("total_sales"), "month")
            .orderBy(F.col("total_sales").desc_nulls_first(), F.col("month").asc_nulls_last())
            .limit(k))


def sales_by_year_month_top(fact: DataFrame, store: DataFrame, product: DataFrame,
                            date_dim: DataFrame, k: int = 10) -> DataFrame:
    """Q4.6: top-k (year, month) pairs by sales over the three-way star join."""
    per_date = _sales_per_date(fact, product, store)
    return (per_date.join(date_dim.select("date_key", "year", "month"), "date_key")
            .groupBy("year", "month")
            .agg(F.sum("amount").alias("amount"))
            .select(money_from_cents("amount").alias("total_sales"), "year", "month")
            .orderBy(F.col("total_sales").desc_nulls_first(),
                     F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last())
            .limit(k))


def online_vs_offline(fact: DataFrame, store: DataFrame, product: DataFrame) -> DataFrame:
    """Q4.4: line count and quantity for web versus physical stores.

    The product join only filters (Q-26); lines are first rolled up per store,
    which turns the fact into at most one row per store per task.
    """
    per_store = (fact.select("store_code", "product_code", "product_quantity")
                 .join(product.select("product_code"), "product_code")
                 .groupBy("store_code")
                 .agg(F.count(F.lit(1)).alias("n"), F.sum("product_quantity").alias("q")))
    location = (F.when(F.col("store_type") == ONLINE_TYPE, F.lit("Online"))
                .otherwise(F.lit("Offline")))
    return (per_store.join(store.select("store_code", "store_type"), "store_code")
            .withColumn("location", location)
            .groupBy("location")
            .agg(F.sum("n").cast("bigint").alias("total_sales"),
                 F.sum("q").cast("bigint").alias("total_products_sold")))


def sales_share_by_type(fact: DataFrame, store: DataFrame, product: DataFrame) -> DataFrame:
    """Q4.5: sales and percentage of the global total per store type.

    The global total covers every priced line, including lines whose store is
    unknown.  One scan of the fact: lines are added up per store code (the NULL
    group stays), joined with the stores, and added up again per type and match,
    which leaves a handful of rows; the total is a sum over those.  A store code
    listed several times counts its lines once in the total (``first`` of each).
    """
    per_store = _priced(fact, product).groupBy("store_code").agg(F.sum("amount").alias("amount"))
    listed = (store.where(F.col("store_code").isNotNull()).groupBy("store_code", "store_type")
              .agg(F.count(F.lit(1)).alias("copies")))
    kinds = listed.groupBy("store_code").agg(
        F.sort_array(F.collect_list(F.struct("store_type", "copies"))).alias("kinds"))  # the types of one code
    none = F.array(F.struct(F.lit(None).cast("string").alias("store_type"), F.lit(0).cast("bigint").alias("copies")))
    rows = (per_store.join(kinds, "store_code", "left")
            .select("amount", F.posexplode(F.coalesce("kinds", none)).alias("i", "k"))
            .groupBy(F.col("k.store_type").alias("store_type"), (F.col("k.copies") > 0).alias("known"))
            .agg(F.sum(F.col("amount") * F.col("k.copies")).alias("amount"),
                 F.sum(F.when(F.col("i") == 0, F.col("amount"))).alias("once")))
    total = F.coalesce(F.sum("once").over(Window.partitionBy(F.lit(1))), F.lit(0))  # one row per type
    return (rows.withColumn("total", total).where("known")
            .select("store_type",
                    money_from_cents("amount").alias("total_sales"),
                    share_pct("amount", F.col("total")).alias("percentage_total"))
            .orderBy(F.col("total_sales").desc_nulls_first(), F.col("store_type").asc_nulls_last()))


def staff_by_country(store: DataFrame) -> DataFrame:
    """Q4.7: total staff per country, largest first."""
    return (store.groupBy("country_code")
            .agg(F.sum("staff_numbers").cast("bigint").alias("total_staff_numbers"))
            .orderBy(F.col("total_staff_numbers").desc_nulls_first(),
                     F.col("country_code").asc_nulls_last()))


def sales_by_type_one_country(fact: DataFrame, store: DataFrame, product: DataFrame,
                              country: str, k: int = 10) -> DataFrame:
    """Q4.8: sales per store type within one country, smallest first.

    The country filter is applied to the store dimension first, so it reaches
    the store scan; the filtered stores are broadcast if their measured bytes
    allow it and prune fact lines in the scan stage, before the product join.
    """
    stores = broadcast_if_small(store.where(F.col("country_code") == F.lit(country))
                                .select("store_code", "store_type", "country_code"))
    return (fact.select("store_code", "product_code", "product_quantity")
            .join(stores, "store_code")
            .join(_prices(product), "product_code")
            .groupBy("country_code", "store_type")
            .agg(F.sum(line_cents("product_quantity", "price_cents")).alias("amount"))
            .select(money_from_cents("amount").alias("total_sales"), "store_type", "country_code")
            .orderBy(F.col("total_sales").asc_nulls_last(), F.col("store_type").asc_nulls_last())
            .limit(k))


def avg_gap_by_year_top(date_dim: DataFrame, k: int = 5, telescoped: bool = True) -> DataFrame:
    """Q4.9: top-k years by mean time between consecutive sales (seconds).

    ``telescoped=True`` (default) uses W-02: a plain hash aggregation whose
    partial step runs before the shuffle, so a year holding most rows is not a
    single task.  ``telescoped=False`` uses the row-level successor (W-01).
    """
    per_year = avg_gap_telescoped(date_dim) if telescoped else avg_gap_by_year(date_dim)
    return (per_year
            .orderBy(F.col("actual_time_taken").desc_nulls_first(), F.col("year").asc_nulls_last())
            .limit(k))
