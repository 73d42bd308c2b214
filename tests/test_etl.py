"""End-to-end: dirty views -> conformed Parquet star -> key report."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from loomstar.operators import constraints as K
from loomstar.plans import analytics as A
from loomstar.plans import etl
from loomstar.plans.etl import PRIMARY_KEYS, key_report, load_star, load_star_tables
from loomstar.plans.fixtures import view
from loomstar.plans.queries import etl_sources
from loomstar.session import scratch_path, scratch_scope
from loomstar.sources.sinks import write_files


def test_load_star_and_key_report(spark, tmp_dir):
    sources = etl_sources(spark, SF_SMALL)
    out = os.path.join(tmp_dir, "star")
    tables = load_star(spark, sources, out)
    assert set(tables) == set(sources)
    stores = spark.read.parquet(tables["dim_store_details"])
    assert isinstance(stores.schema["staff_numbers"].dataType, T.ShortType)
    assert isinstance(stores.schema["opening_date"].dataType, T.DateType)
    products = spark.read.parquet(tables["dim_products"])
    assert {"still_available", "weight_class"} <= set(products.columns)
    dates = spark.read.parquet(tables["dim_date_times"])
    assert isinstance(dates.schema["datetime"].dataType, T.TimestampNTZType)
    report = key_report(spark, tables)
    found = {(r.check, r.column): r.n for r in report.groupBy("check", "column").agg(F.count(F.lit(1)).alias("n")).collect()}
    columns = {"card_number", "date_uuid", "product_code", "store_code", "user_uuid"}
    assert set(found) == {(check, c) for check in ("primary_key", "foreign_key") for c in columns}
    for table, key in PRIMARY_KEYS.items():  # some keys are clean, too
        assert found["primary_key", key] < spark.read.parquet(tables[table]).select(key).distinct().count()
    fact = spark.read.parquet(tables["orders_table"])
    assert report.where("check = 'foreign_key' AND column = 'store_code'").agg(F.sum("n_rows")).first()[0] < fact.count()


def test_key_report_scans_each_table_once_and_lazily(spark, tmp_dir):
    written = load_star(spark, etl_sources(spark, SF_SMALL), os.path.join(tmp_dir, "star"))
    read = {name: spark.read.parquet(path) for name, path in written.items()}
    spark.sparkContext.setJobGroup("key-report", "building the report")
    report = key_report(spark, read)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("key-report") == []
    spark.sparkContext.setJobGroup("", "")
    for name in read:
        assert plan.count(f"/star/{name}]") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_killed_load_resumes(spark, tmp_dir, monkeypatch):
    """The load dies while writing the third dataset: the two finished ones are kept, the others written once."""
    sources = etl_sources(spark, SF_SMALL)
    out = os.path.join(tmp_dir, "star")
    written = []

    def dies(df, path):
        if len(written) == 2:
            os.makedirs(os.path.join(path, "_temporary"))  # what a killed job leaves
            raise RuntimeError("killed")
        written.append(os.path.basename(path))
        return write_files(df, path)

    class OneByOne(etl.ThreadPoolExecutor):
        def __init__(self, max_workers):
            super().__init__(max_workers=1)

    monkeypatch.setattr(etl, "ThreadPoolExecutor", OneByOne)
    monkeypatch.setattr(etl, "write_files", dies)
    with pytest.raises(RuntimeError, match="killed"):
        load_star(spark, sources, out)
    assert len(written) == 2
    again = []
    monkeypatch.setattr(etl, "write_files", lambda df, path: (again.append(os.path.basename(path)), write_files(df, path))[1])
    with pytest.raises(Exception, match="(?i)already exists"):
        load_star(spark, sources, out)  # without resume an existing folder is an error
    again.clear()
    tables = load_star(spark, sources, out, resume=True)
    assert set(tables) == set(sources) and {os.path.basename(p) for p in tables.values()} == set(written) | set(again)
    assert len(again) == 4 and not set(again) & set(written)
    assert sum(name.endswith("-2") for name in again) >= 1  # beside the folder of the killed job
    expected = {n: etl.PIPELINES[n](sources[n]).count() for n in sources}
    assert {n: spark.read.parquet(p).count() for n, p in tables.items()} == expected
    again.clear()
    assert load_star(spark, sources, out, resume=True) == tables and again == []
    # another source is loaded anew, and so is a folder that has lost rows
    copy = os.path.join(tmp_dir, "users")
    sources["dim_users_table"].limit(10).write.parquet(copy)
    changed = load_star(spark, {**sources, "dim_users_table": spark.read.parquet(copy)}, out, resume=True)
    assert len(again) == 1 and [n for n in tables if changed[n] != tables[n]] == ["dim_users_table"]
    for f in os.listdir(tables["dim_products"]):
        if "part-" in f:
            os.remove(os.path.join(tables["dim_products"], f))
    again.clear()
    renewed = load_star(spark, {**sources, "dim_users_table": spark.read.parquet(copy)}, out, resume=True)
    assert len(again) == 1 and [n for n in tables if renewed[n] != changed[n]] == ["dim_products"]


def test_stacked_key_report_agrees_with_single_checks(spark):
    """NULL and repeated keys, a hot dangling key, two columns that use one key, a reference to a key that is not primary."""
    fact = spark.createDataFrame(
        [(1, "a", 10)] * 40 + [(2, None, 11), (None, "b", None), (9, "zz", 10), (9, "a", 12), (1, "c", 99)], "k int, code string, alt int")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, "a")], "k int, code string")
    other = spark.createDataFrame([(10,), (10,), (11,), (None,)], "alt int")
    foreign = [("fact", "k", "dim", "k"), ("fact", "alt", "dim", "k"), ("fact", "code", "dim", "code"), ("fact", "alt", "other", "alt")]
    got = sorted(map(tuple, K.stacked_key_report({"fact": fact, "dim": dim, "other": other}, [("dim", "k")], foreign).collect()), key=str)
    tables = {"dim": dim, "other": other}
    want = [("primary_key", "dim", "k", None if r.k is None else str(r.k), r.n_rows) for r in K.pk_violations(dim, ["k"]).collect()]
    for _, column, d, key in foreign:
        rows = K.fk_violations(fact, tables[d], column, key).groupBy(column).count().collect()
        want += [("foreign_key", "fact", column, str(r[0]), r[1]) for r in rows]
    assert got == sorted(want, key=str) and len(want) > 6


def test_absent_key_column_is_an_error(spark):
    sources = etl_sources(spark, SF_SMALL)
    with pytest.raises(ValueError, match="dim_users_table.user_uuid"):
        key_report(spark, {**sources, "dim_users_table": sources["dim_users_table"].drop("user_uuid")})
    with pytest.raises(ValueError, match="date_uuid"):
        load_star_tables(spark, {"dim_date_times": sources["dim_date_times"].drop("date_uuid")}, "no_key_", buckets=2)


def test_bucketed_star_joins_without_fact_shuffle(spark):
    sources = {k: v for k, v in etl_sources(spark, SF_SMALL).items() if k in ("orders_table", "dim_date_times")}
    created = load_star_tables(spark, sources, "bkt_", buckets=8)
    assert created == {"orders_table": True, "dim_date_times": True}
    fact = spark.table("bkt_orders_table").withColumnRenamed("date_uuid", "date_key")
    dates = spark.table("bkt_dim_date_times").withColumnRenamed("date_uuid", "date_key")
    product = view(spark, SF_SMALL, "product").withColumn("product_code", F.concat(F.lit("P-"), F.col("product_code")))
    out = A.sales_by_month_top(fact, dates, product, 6)
    assert out.count() == 6
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the roll-up to the date key and the date join reuse the bucketing: no hash exchange on it
    assert "hashpartitioning(date" not in plan


def test_scratch_scope_removes_its_folders(spark):
    with scratch_scope(spark):
        path, kept = scratch_path(spark, "gone"), scratch_path(spark, "kept", keep=True)
        for p in (path, kept):
            spark.range(3).write.parquet(p)
        assert spark.read.parquet(path).count() == 3
    assert not os.path.exists(path) and spark.read.parquet(kept).count() == 3


def test_few_bytes_of_many_rows_are_cleaned_by_many_tasks(spark, tmp_dir, monkeypatch):
    """a small file of users is not left to one task; the fact keeps its tasks and its runs of equal keys."""
    monkeypatch.setattr(etl, "ROWS_A_TASK", 100, raising=False)
    sources = {}
    for name, source in etl_sources(spark, SF_SMALL).items():
        write_files(source.coalesce(1), os.path.join(tmp_dir, name))
        sources[name] = spark.read.parquet(os.path.join(tmp_dir, name))
    users, orders = sources["dim_users_table"], sources["orders_table"]
    users = users.crossJoin(spark.range(10).select()).coalesce(1)
    write_files(users, os.path.join(tmp_dir, "many-users"))
    sources = {"dim_users_table": spark.read.parquet(os.path.join(tmp_dir, "many-users")), "orders_table": orders}
    tables = load_star(spark, sources, os.path.join(tmp_dir, "star"))
    loaded = spark.read.parquet(tables["dim_users_table"])
    assert len(loaded.inputFiles()) > 1 and len(spark.read.parquet(tables["orders_table"]).inputFiles()) == 1
    expected = etl.PIPELINES["dim_users_table"](users)
    assert loaded.count() == expected.count() > 1000
    assert loaded.exceptAll(expected).isEmpty()


def test_key_report_counts_each_domain_by_its_own_foreign_keys(spark):
    """entries carry one count for each foreign key of a domain, not one for each of the star."""
    fact = spark.createDataFrame([("a", "b", "z"), ("q", "a", "z"), ("q", None, "y")], "k1 string, k2 string, o string")
    dim = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    other = spark.createDataFrame([("y",)], "o string")
    report = K.stacked_key_report({"fact": fact, "dim": dim, "other": other}, [("dim", "k"), ("other", "o")],
                                  [("fact", "k1", "dim", "k"), ("fact", "o", "other", "o"), ("fact", "k2", "dim", "k")])
    assert sorted(map(tuple, report.collect())) == [
        ("foreign_key", "fact", "k1", "q", 2), ("foreign_key", "fact", "o", "z", 2), ("primary_key", "dim", "k", "b", 2)]
    assert "used3" not in report._jdf.queryExecution().optimizedPlan().toString()
