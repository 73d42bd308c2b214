"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the supplied tables under ``sf_dir`` (or views Spark derives
from them) in full.  Outputs are presented with oracle-friendly types: money
as DOUBLE (after exact integer-cent sums), counts as BIGINT, and DATE columns
as ISO text, because engines convert DATE values to different client types.
The library functions themselves return the real types.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstar.functions.text import (
    equals_flag,
    strip_leading_lower,
    strip_letters,
    strip_literal,
    strip_question_marks,
)
from loomstar.functions.urls import url_parts
from loomstar.functions.weights import multipack_amount
from loomstar.operators import cleaning as C
from loomstar.operators import conform as D
from loomstar.operators import constraints as K
from loomstar.operators import gaps
from loomstar.operators import nulls as N
from loomstar.operators import reshape as R
from loomstar.plans import analytics as A
from loomstar.plans import etl as E
from loomstar.plans.etl import PRODUCT_COLUMNS, STORE_COLUMNS
from loomstar.plans.fixtures import table, view, views
from loomstar.session import scratch_path
from loomstar.sources import readers as S
from loomstar.sources.sinks import create_table, preview

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Country used by the single-country query; it has the most stores at sf0.01.
ONE_COUNTRY = "NATION_9"


def register(name: str) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    """DATE columns as ``yyyy-MM-dd`` text; everything else unchanged."""
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    if not dates:
        return df
    return df.withColumns({c: F.col(c).cast("string") for c in dates})


# --- Q4.x analytics ---------------------------------------------------------

@register("stores_per_country")
def q_stores_per_country(spark, sf_dir):
    fact, store = views(spark, sf_dir, "fact", "store")
    return A.stores_per_country(fact, store)


@register("stores_per_locality_top7")
def q_stores_per_locality_top7(spark, sf_dir):
    fact, store = views(spark, sf_dir, "fact", "store")
    return A.stores_per_locality_top(fact, store, 7)


@register("sales_total")
def q_sales_total(spark, sf_dir):
    fact, product = views(spark, sf_dir, "fact", "product")
    return A.sales_total(fact, product)


@register("sales_by_month_top6")
def q_sales_by_month_top6(spark, sf_dir):
    fact, date_dim, product = views(spark, sf_dir, "fact", "date_dim", "product")
    return A.sales_by_month_top(fact, date_dim, product, 6)


@register("online_vs_offline")
def q_online_vs_offline(spark, sf_dir):
    fact, store, product = views(spark, sf_dir, "fact", "store", "product")
    return A.online_vs_offline(fact, store, product)


@register("sales_share_by_type")
def q_sales_share_by_type(spark, sf_dir):
    fact, store, product = views(spark, sf_dir, "fact", "store", "product")
    return A.sales_share_by_type(fact, store, product)


@register("sales_by_year_month_top10")
def q_sales_by_year_month_top10(spark, sf_dir):
    fact, store, product, date_dim = views(spark, sf_dir, "fact", "store", "product", "date_dim")
    return A.sales_by_year_month_top(fact, store, product, date_dim, 10)


@register("staff_by_country")
def q_staff_by_country(spark, sf_dir):
    return A.staff_by_country(view(spark, sf_dir, "store"))


@register("sales_by_type_one_country")
def q_sales_by_type_one_country(spark, sf_dir):
    fact, store, product = views(spark, sf_dir, "fact", "store", "product")
    return A.sales_by_type_one_country(fact, store, product, ONE_COUNTRY, 10)


@register("next_event_gap")
def q_next_event_gap(spark, sf_dir):
    return gaps.next_event_gap(view(spark, sf_dir, "date_dim"))


@register("avg_gap_by_year_top5")
def q_avg_gap_by_year_top5(spark, sf_dir):
    return A.avg_gap_by_year_top(view(spark, sf_dir, "date_dim"), 5)


@register("avg_gap_by_year")
def q_avg_gap_by_year(spark, sf_dir):
    return gaps.avg_gap_by_year(view(spark, sf_dir, "date_dim"))


@register("avg_gap_telescoped")
def q_avg_gap_telescoped(spark, sf_dir):
    return gaps.avg_gap_telescoped(view(spark, sf_dir, "date_dim"))


# --- scalar, filter and cleaning operators over the dirty views --------------


def _orders_with_one(spark, sf_dir):
    # the fixture's ``one`` stands for the column literally named ``1``
    return view(spark, sf_dir, "dirty_orders").withColumnRenamed("one", "1")


@register("na_tokens_to_null")
def q_na_tokens_to_null(spark, sf_dir):
    return N.na_tokens_to_null(view(spark, sf_dir, "dirty_products"))


@register("url_parts")
def q_url_parts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", *url_parts("url"))


@register("reindex_columns")
def q_reindex_columns(spark, sf_dir):
    return R.reindex_columns(view(spark, sf_dir, "dirty_stores"), STORE_COLUMNS)


@register("drop_index_column")
def q_drop_index_column(spark, sf_dir):
    return R.drop_index_column(view(spark, sf_dir, "dirty_users"), "index")


@register("dropna_subset")
def q_dropna_subset(spark, sf_dir):
    return N.dropna_subset(view(spark, sf_dir, "dirty_users"), ["address"])


@register("dropna_any")
def q_dropna_any(spark, sf_dir):
    return N.dropna_any(view(spark, sf_dir, "dirty_cards"))


@register("null_unknown_codes")
def q_null_unknown_codes(spark, sf_dir):
    return N.null_unknown_codes(view(spark, sf_dir, "dirty_users"))


@register("null_literal")
def q_null_literal(spark, sf_dir):
    return N.null_literal(view(spark, sf_dir, "dirty_dates"))


@register("parse_mixed_dates")
def q_parse_mixed_dates(spark, sf_dir):
    return present(C.parse_mixed_dates(view(spark, sf_dir, "dirty_users")))


@register("unparsed_dates")
def q_unparsed_dates(spark, sf_dir):
    return C.unparsed_date_values(view(spark, sf_dir, "dirty_users"))


@register("clean_address")
def q_clean_address(spark, sf_dir):
    return C.clean_address(view(spark, sf_dir, "dirty_users"))


@register("strip_currency")
def q_strip_currency(spark, sf_dir):
    p = view(spark, sf_dir, "dirty_products")
    return p.select("product_code", strip_literal("product_price", C.CURRENCY_SIGN).alias("product_price"))


@register("strip_question_marks")
def q_strip_question_marks(spark, sf_dir):
    cards = view(spark, sf_dir, "dirty_cards")
    return cards.select("date_payment_confirmed", strip_question_marks("card_number").alias("card_number"))


@register("digits_only_staff")
def q_digits_only_staff(spark, sf_dir):
    s = view(spark, sf_dir, "dirty_stores")
    return s.select("index", strip_letters("staff_numbers").alias("staff_numbers"))


@register("fix_continent")
def q_fix_continent(spark, sf_dir):
    s = view(spark, sf_dir, "dirty_stores")
    return s.select("index", strip_leading_lower("continent").alias("continent"))


@register("weights_to_kg")
def q_weights_to_kg(spark, sf_dir):
    p = view(spark, sf_dir, "dirty_products").select("product_code", "weight")
    return C.weights_to_kg(p)


@register("multipack_weight")
def q_multipack_weight(spark, sf_dir):
    p = view(spark, sf_dir, "dirty_products")
    return p.select("product_code", "weight", multipack_amount("weight").alias("amount"))


@register("removed_flag")
def q_removed_flag(spark, sf_dir):
    p = view(spark, sf_dir, "dirty_products")
    return p.select("product_code", equals_flag("removed", "Removed").alias("removed"))


@register("weight_class")
def q_weight_class(spark, sf_dir):
    p = view(spark, sf_dir, "product")
    return p.select("product_code", "weight", D.weight_class("weight").alias("weight_class"))


@register("build_datetime")
def q_build_datetime(spark, sf_dir):
    return C.build_datetime(view(spark, sf_dir, "dirty_dates"))


@register("dedupe_exact")
def q_dedupe_exact(spark, sf_dir):
    return C.dedupe_exact(view(spark, sf_dir, "repeated_fact"))


@register("clean_users")
def q_clean_users(spark, sf_dir):
    return present(C.clean_users(view(spark, sf_dir, "dirty_users")))


@register("clean_cards")
def q_clean_cards(spark, sf_dir):
    return C.clean_cards(view(spark, sf_dir, "dirty_cards"))


def _clean_stores_df(spark, sf_dir):
    raw = R.reindex_columns(view(spark, sf_dir, "dirty_stores"), STORE_COLUMNS)
    return C.clean_stores(raw)


def _clean_products_df(spark, sf_dir):
    raw = R.reindex_columns(view(spark, sf_dir, "dirty_products"), PRODUCT_COLUMNS)
    return C.clean_products(raw)


@register("clean_stores")
def q_clean_stores(spark, sf_dir):
    return present(_clean_stores_df(spark, sf_dir))


@register("clean_products")
def q_clean_products(spark, sf_dir):
    return present(_clean_products_df(spark, sf_dir))


@register("clean_orders")
def q_clean_orders(spark, sf_dir):
    return C.clean_orders(_orders_with_one(spark, sf_dir))


# --- conformance and constraints ----------------------------------------------

@register("conform_fact")
def q_conform_fact(spark, sf_dir):
    return D.conform(C.clean_orders(_orders_with_one(spark, sf_dir)), D.SPECS["orders_table"])


@register("conform_users")
def q_conform_users(spark, sf_dir):
    users = C.clean_users(view(spark, sf_dir, "etl_users"))
    return present(D.conform(users, D.SPECS["dim_users_table"]))


@register("conform_orders_keys")
def q_conform_orders_keys(spark, sf_dir):
    orders = view(spark, sf_dir, "etl_orders").withColumnRenamed("one", "1")
    return D.conform(C.clean_orders(orders), D.SPECS["orders_table"])


@register("conform_full_stores")
def q_conform_full_stores(spark, sf_dir):
    return present(D.conform(C.clean_stores(view(spark, sf_dir, "etl_stores")), D.SPECS["dim_store_details"]))


@register("conform_full_products")
def q_conform_full_products(spark, sf_dir):
    out = D.conform_products(C.clean_products(view(spark, sf_dir, "etl_products")))
    return present(out.withColumn("product_price", F.col("product_price").cast("double")))


@register("conform_stores")
def q_conform_stores(spark, sf_dir):
    return present(D.conform(_clean_stores_df(spark, sf_dir), D.SPECS["dim_store_details"]))


@register("conform_products")
def q_conform_products(spark, sf_dir):
    out = D.conform_products(_clean_products_df(spark, sf_dir))
    return present(out.withColumn("product_price", F.col("product_price").cast("double")))


@register("conform_dates")
def q_conform_dates(spark, sf_dir):
    return D.conform(C.build_datetime(view(spark, sf_dir, "etl_dates")), D.SPECS["dim_date_times"])


@register("conform_cards")
def q_conform_cards(spark, sf_dir):
    cards = C.clean_cards(view(spark, sf_dir, "dirty_cards"))
    return present(D.conform(cards, D.SPECS["dim_card_details"]))


# Declared types for the bad_uuid fixture: a uuid, a small integer and a 2-letter code.
BAD_UUID_SPEC = {"user_uuid": "uuid", "small_text": "int2", "country_code": "varchar(2)"}


@register("conform_violations")
def q_conform_violations(spark, sf_dir):
    return D.conform_violations(view(spark, sf_dir, "bad_uuid"), BAD_UUID_SPEC, "id", "bad_uuid")


@register("pk_violations")
def q_pk_violations(spark, sf_dir):
    lines = view(spark, sf_dir, "dirty_orders")
    return K.pk_violations(lines, ["date_key", "level_0"])


@register("fk_violations")
def q_fk_violations(spark, sf_dir):
    fact, store = views(spark, sf_dir, "dangling_fact", "store")
    return K.fk_violations(fact, store, "store_code")


@register("preview_limit")
def q_preview_limit(spark, sf_dir):
    # half of the supplied products are fewer than the table has at any scale
    n = max(1, table(spark, sf_dir, "part").count() // 2)
    return present(preview(_clean_products_df(spark, sf_dir), n, order_by=["product_code"]))


# --- sources: each file-format key writes its input with Spark to a fresh folder
# under the shared checkpoint directory and reads it back -----------------------


DATE_PARTS = ["year", "month", "day", "timestamp", "time_period"]
CARD_COLUMNS = ["card_number", "expiry_date", "date_payment_confirmed"]
ROWS_PER_PAGE = 5_000


@register("scan_table")
def q_scan_table(spark, sf_dir):
    return S.scan_table(spark, f"{sf_dir.rstrip('/')}/customer.parquet")


@register("scan_csv_products")
def q_scan_csv_products(spark, sf_dir):
    src = view(spark, sf_dir, "dirty_products")
    # a leading column with an empty header, as written by a frame's row index
    out = src.select(F.col("product_code").cast("string").alias(""), *src.columns)
    path = scratch_path(spark, "products-csv")
    out.write.option("header", "true").mode("errorifexists").csv(path)
    return S.read_csv_strings(spark, path)


@register("scan_columnar_json")
def q_scan_columnar_json(spark, sf_dir):
    src = view(spark, sf_dir, "dirty_dates")
    path = scratch_path(spark, "dates-json")
    S.write_columnar_json(src, path, key="date_key", rows_per_doc=4_000)
    rows = S.read_columnar_json(spark, path, DATE_PARTS, key="date_key", whole_file=False)
    return rows.withColumn("date_key", F.col("date_key").cast("bigint"))


def _store_documents(spark, sf_dir):
    s = view(spark, sf_dir, "dirty_stores")
    return s.select("index", "store_code", "store_type", "staff_numbers", "address",
                    F.struct("longitude", "latitude").alias("geo"), "continent", "opening_date")


@register("missing_document_ids")
def q_missing_document_ids(spark, sf_dir):
    path = scratch_path(spark, "store-docs")
    # every seventh fetch failed
    _store_documents(spark, sf_dir).where("index % 7 <> 3").write.mode("errorifexists").json(path)
    docs = S.flatten(S.read_json_documents(spark, path))
    expected = table(spark, sf_dir, "supplier").count()  # the count endpoint
    return S.missing_document_ids(docs, "index", expected)


@register("json_flatten_props")
def q_json_flatten_props(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "props")
    # "_" joins the path so the output names are plain identifiers for any client
    return S.flatten_json_column(events, "props", "k BIGINT", sep="_")


def _write_card_pages(spark, sf_dir) -> str:
    cards = view(spark, sf_dir, "dirty_cards")
    pages = max(1, -(-cards.count() // ROWS_PER_PAGE))
    path = scratch_path(spark, "card-pages")
    # every page file starts with the column names, as pages extracted from a document do
    cards.repartition(pages).write.option("header", "true").mode("errorifexists").csv(path)
    return path


@register("drop_repeated_headers")
def q_drop_repeated_headers(spark, sf_dir):
    path = _write_card_pages(spark, sf_dir)
    return S.drop_repeated_headers(S.read_pages(spark, path, CARD_COLUMNS))


@register("union_pages")
def q_union_pages(spark, sf_dir):
    cards = view(spark, sf_dir, "dirty_cards")
    early, late = (scratch_path(spark, f"cards-{x}") for x in ("early", "late"))
    # the early pages have no column for the payment date
    cards.where("date_payment_confirmed < '1995-01-01'").drop("date_payment_confirmed") \
        .write.option("header", "true").mode("errorifexists").csv(early)
    cards.where("NOT date_payment_confirmed < '1995-01-01'").write.option("header", "true").mode("errorifexists").csv(late)
    return S.union_frames([S.read_csv_strings(spark, late, na_tokens=False), S.read_csv_strings(spark, early, na_tokens=False)])


@register("scan_csv_several_headers")
def q_scan_csv_several_headers(spark, sf_dir):
    """One folder, three kinds of file: columns in another order, and without the last column."""
    src = view(spark, sf_dir, "dirty_cards").where("card_number IS NOT NULL")
    path = scratch_path(spark, "cards-several")
    for i, columns in enumerate((CARD_COLUMNS, CARD_COLUMNS[::-1], CARD_COLUMNS[:2])):
        rows = src.where(F.ascii(F.right("card_number", F.lit(1))) % 3 == i).select(*columns)
        rows.write.option("header", "true").mode("append").csv(path)
    return S.read_csv_strings(spark, path, na_tokens=False)


@register("broken_documents")
def q_broken_documents(spark, sf_dir):
    """Store documents of which some were cut off, are lists, or hold text for a number."""
    docs = view(spark, sf_dir, "dirty_stores").select("index", F.to_json(F.struct("index", "store_code")).alias("j"))
    text = (F.when(F.col("index") % 5 == 0, F.substring("j", 1, 9)).when(F.col("index") % 7 == 0, F.concat(F.lit("["), "j", F.lit("]")))
            .when(F.col("index") % 11 == 0, F.concat(F.lit('{"index":"x'), F.col("index").cast("string"), F.lit('"}'))).otherwise(F.col("j")))
    path = scratch_path(spark, "store-lines")
    docs.select(text.alias("value")).write.mode("errorifexists").text(path)
    return S.broken_json_documents(spark, path, "index BIGINT, store_code STRING").groupBy("reason").agg(
        F.count(F.lit(1)).alias("n_documents"), F.min("text").alias("first_text"))


@register("load_by_content_type")
def q_load_by_content_type(spark, sf_dir):
    """S-06: one source as CSV, one as column-oriented JSON, both through the dispatch."""
    nations = table(spark, sf_dir, "nation").selectExpr("CAST(n_nationkey AS STRING) AS k", "n_name AS name")
    csv, columnar = scratch_path(spark, "nations-csv"), scratch_path(spark, "customers-json")
    nations.write.option("header", "true").mode("errorifexists").csv(csv)
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_name AS name")
    S.write_columnar_json(customers, columnar, key="k", rows_per_doc=1_000)
    a = S.load(spark, csv, "text/csv; charset=utf-8").withColumn("source", F.lit("csv"))
    b = S.load(spark, columnar, "application/json", columns=["name"], key="k", whole_file=False).withColumn("source", F.lit("json"))
    return a.unionByName(b)


@register("create_only_table")
def q_create_only_table(spark, sf_dir):
    """K-01: a table is created once; a second load of other rows changes nothing."""
    nation = table(spark, sf_dir, "nation")
    name = f"loomstar_nation_{uuid.uuid4().hex}"
    first = create_table(nation, name, path=scratch_path(spark, "nation-table"))
    second = create_table(nation.where("n_regionkey = 0"), name, path=scratch_path(spark, "nation-again"))
    return spark.table(name).select("n_nationkey", "n_name", "n_regionkey", F.lit(first).alias("created"), F.lit(second).alias("created_again"))


@register("list_tables")
def q_list_tables(spark, sf_dir):
    """S-10: the tables of a catalog database, with their rows."""
    database = f"loomstar_{uuid.uuid4().hex}"
    location = scratch_path(spark, "catalog")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    for name in ("region", "nation", "supplier"):
        create_table(table(spark, sf_dir, name), f"{database}.{name}", path=f"{location}/{name}")
    counts = S.union_frames([spark.table(f"{database}.{n}").groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(n).alias("table_name"), "n_rows") for n in ("region", "nation", "supplier")])
    listed = S.list_tables(spark, database).select(F.col("tableName").alias("table_name"))
    return listed.join(counts, "table_name")


# --- end-to-end: the ETL job and the key checks over what it loaded ------------


def etl_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One source for each dataset of the star, with all declared columns, some repeated and some dangling keys."""
    names = {"dim_users_table": "etl_users", "dim_card_details": "etl_cards", "dim_store_details": "etl_stores",
             "dim_products": "etl_products", "orders_table": "etl_orders", "dim_date_times": "etl_dates"}
    with ThreadPoolExecutor(max_workers=len(names)) as pool:  # landed together, so no small table holds up the cluster
        found = dict(zip(names, pool.map(lambda name: view(spark, sf_dir, name), names.values())))
    # the fixture's ``one`` stands for the column literally named ``1``
    return {**found, "orders_table": found["orders_table"].withColumnRenamed("one", "1")}


@register("etl_key_report")
def q_etl_key_report(spark, sf_dir):
    sources = etl_sources(spark, sf_dir)
    tables = E.load_star(spark, sources, scratch_path(spark, "star"))
    return E.key_report(spark, tables)
