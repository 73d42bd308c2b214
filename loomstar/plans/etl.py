"""End-to-end ETL (C-11): dirty sources -> cleaned, conformed star -> key checks.

One pipeline per dataset, each a pure ``DataFrame -> DataFrame`` built from the
operators; loading is separate and create-only.  After loading, the key
constraints the reference declared (five primary keys, five foreign keys) are
checked as jobs over the written tables, so each check reads columnar files
instead of re-running the cleaning.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from loomstar.operators import cleaning as C
from loomstar.operators import conform as D
from loomstar.operators import constraints as K
from loomstar.operators.reshape import reindex_columns
from loomstar.sources.manifest import LoadManifest, source_files, source_fingerprint
from loomstar.sources.sinks import create_table, write_files

# Column lists the original run keeps for two sources.
STORE_COLUMNS = ["index", "store_code", "store_type", "staff_numbers", "address", "longitude",
                 "latitude", "locality", "country_code", "continent", "opening_date"]
PRODUCT_COLUMNS = ["product_name", "product_price", "weight", "category", "EAN", "date_added",
                   "uuid", "removed", "product_code"]

# Primary keys and foreign keys of the star (fact column, dimension, key).
PRIMARY_KEYS = {"dim_card_details": "card_number", "dim_date_times": "date_uuid",
                "dim_products": "product_code", "dim_store_details": "store_code",
                "dim_users_table": "user_uuid"}
FOREIGN_KEYS = [("card_number", "dim_card_details"), ("date_uuid", "dim_date_times"),
                ("product_code", "dim_products"), ("store_code", "dim_store_details"),
                ("user_uuid", "dim_users_table")]

# Pipelines that parse free-form dates: tens of microseconds a row, so few tasks would hold up the load.
PARSING = frozenset({"dim_users_table", "dim_store_details", "dim_products"})
ROWS_A_TASK = 25_000          # rows of such a source that a task cleans in about a second
SMALL_FILES = 32 << 20        # bytes a core: of larger sources, a scan makes tasks enough by itself

Pipeline = Callable[[DataFrame], DataFrame]

PIPELINES: dict[str, Pipeline] = {
    "dim_users_table": lambda df: D.conform(C.clean_users(df), D.SPECS["dim_users_table"]),
    "dim_card_details": lambda df: D.conform(C.clean_cards(df), D.SPECS["dim_card_details"]),
    "dim_store_details": lambda df: D.conform(
        C.clean_stores(reindex_columns(df, STORE_COLUMNS)), D.SPECS["dim_store_details"]),
    "dim_products": lambda df: D.conform_products(
        C.clean_products(reindex_columns(df, PRODUCT_COLUMNS))),
    "orders_table": lambda df: D.conform(C.clean_orders(df), D.SPECS["orders_table"]),
    "dim_date_times": lambda df: D.conform(C.build_datetime(df), D.SPECS["dim_date_times"]),
}


def spread(df: DataFrame, n_bytes: int) -> DataFrame:
    """A source of few bytes (``n_bytes``, of its files) but many rows, dealt out to all cores.

    Millions of rows may come in a few megabytes of Parquet, which a scan gives to one task, but
    what parsing costs goes by rows.  Their count comes from the files' footers.  Only for
    ``PARSING``: dealing out the fact would cost more than it saves, and tear its runs of equal keys apart.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if not 0 < n_bytes < cores * SMALL_FILES:
        return df
    parts = min(df.count() // ROWS_A_TASK, 3 * cores)
    return df.repartition(parts) if parts > 1 else df


def load_star(spark: SparkSession, sources: dict[str, DataFrame], out_dir: str, resume: bool = False) -> dict[str, str]:
    """Clean, conform and write every dataset present in ``sources``; returns table -> path.

    The datasets are independent, so their write jobs are submitted together
    (one driver thread each) and the cluster works on all of them at once.
    Each write is create-only: an existing folder is an error, never replaced.

    Every finished dataset is entered in the load's manifest (``sources.manifest``).  With ``resume`` a load
    that was cut off goes on: a dataset whose entry has the fingerprint of the present source and whose folder
    has the entry's rows is taken as it is, all others are written, into a new folder beside an unfinished one.
    """
    out_dir = out_dir.rstrip("/")
    manifest = LoadManifest(spark, f"{out_dir}/_manifest")
    known = manifest.finished() if resume else {}

    def one(name: str, pipeline: Pipeline) -> str:
        files = source_files(sources[name])
        fingerprint = source_fingerprint(sources[name], files)
        entry = known.get(name)
        if entry and fingerprint and entry["fingerprint"] == fingerprint and manifest.intact(entry):
            return entry["folder"]
        path = manifest.new_folder(f"{out_dir}/{name}") if resume else f"{out_dir}/{name}"
        source = spread(sources[name], sum(n for _, n, _ in files)) if name in PARSING else sources[name]
        write_files(pipeline(source), path)
        manifest.enter(name, fingerprint, path)
        return path

    todo = {name: pipeline for name, pipeline in PIPELINES.items() if name in sources}
    if not todo:
        return {}
    with ThreadPoolExecutor(max_workers=len(todo)) as pool:
        futures = {name: pool.submit(one, name, pipeline) for name, pipeline in todo.items()}
        return {name: f.result() for name, f in futures.items()}


# The fact and the date dimension share the order-level key; bucketing both on
# it co-locates their join (and the fact's roll-up to that key) without a shuffle.
CO_BUCKETED = {"orders_table": "date_uuid", "dim_date_times": "date_uuid"}


def load_star_tables(spark: SparkSession, sources: dict[str, DataFrame], prefix: str,
                     buckets: int = 64) -> dict[str, bool]:
    """Like ``load_star`` but into catalog tables ``<prefix><name>``; the fact and the
    date dimension are bucketed on the date key.  Returns table -> created."""
    created = {}
    for name, pipeline in PIPELINES.items():
        if name in sources:
            df = pipeline(sources[name])
            key = CO_BUCKETED.get(name)
            if key and key not in df.columns:
                raise ValueError(f"{name} has no column {key!r} to bucket by")
            created[name] = create_table(df, f"{prefix}{name}", bucket_by=key, buckets=buckets)
    return created


def key_report(spark: SparkSession, tables: dict[str, str | DataFrame]) -> DataFrame:
    """PK and FK violations over the loaded tables: (check, table, column, key, n_rows).

    One job scans every table once (``constraints.stacked_key_report``).
    ``tables`` maps table names to written Parquet folders or to DataFrames
    (for example catalog tables from ``load_star_tables``).  A table that is not
    given is not checked; a given table without a declared key column is an error.
    """
    read = {name: t if isinstance(t, DataFrame) else spark.read.parquet(t)
            for name, t in tables.items()}
    declared = [(t, k) for t, k in PRIMARY_KEYS.items() if t in read]
    declared += [("orders_table", c) for c, d in FOREIGN_KEYS if "orders_table" in read and d in read]
    declared += [(d, c) for c, d in FOREIGN_KEYS if "orders_table" in read and d in read]
    absent = sorted({f"{t}.{c}" for t, c in declared if c not in read[t].columns})
    if absent:
        raise ValueError(f"declared key columns are absent: {', '.join(absent)}")
    primary = [(t, k) for t, k in PRIMARY_KEYS.items() if t in read]
    foreign = [("orders_table", c, d, c) for c, d in FOREIGN_KEYS if "orders_table" in read and d in read]
    if not primary:
        return spark.createDataFrame([], "check string, table string, column string, key string, n_rows long")
    return K.stacked_key_report(read, primary, foreign)
