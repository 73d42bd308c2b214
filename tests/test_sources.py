"""Sources and sinks through real files (S-01 .. S-10, K-01, K-02, O-06)."""

import os
import time

import pytest
from pyspark.sql import functions as F

from loomstar.sources import readers as S
from loomstar.sources import sinks as K
from conftest import SF_SMALL


def test_columnar_json_round_trip(spark, tmp_dir):
    src = spark.createDataFrame([(i, f"y{i}", None if i % 3 == 0 else f"m{i}") for i in range(40)],
                                "date_key long, year string, month string")
    path = os.path.join(tmp_dir, "cols")
    n_docs = S.write_columnar_json(src, path, "date_key", rows_per_doc=10)
    assert n_docs == 4
    back = S.read_columnar_json(spark, path, ["year", "month"], key="date_key")
    got = sorted((int(r.date_key), r.year, r.month) for r in back.collect())
    assert got == sorted((r.date_key, r.year, r.month) for r in src.collect())


def test_columnar_json_whole_file_document(spark, tmp_dir):
    path = os.path.join(tmp_dir, "one.json")
    with open(path, "w") as f:
        f.write('{"year": {"0": "2020", "1": "2021"},\n "month": {"0": "1", "1": null}}\n')
    rows = sorted(tuple(r) for r in S.read_columnar_json(spark, path, ["year", "month"], whole_file=True).collect())
    assert rows == [("0", "2020", "1"), ("1", "2021", None)]


def test_columnar_json_broken_document_is_an_error(spark, tmp_dir):
    path = os.path.join(tmp_dir, "broken")
    os.makedirs(path)
    for name, text in (("a.json", '{"year": {"0": "2020"}}'), ("b.json", '{"year": {"0": \n')):
        with open(os.path.join(path, name), "w") as f:
            f.write(text)
    for whole in (True, False):
        with pytest.raises(Exception, match="not a column-oriented JSON document"):
            S.read_columnar_json(spark, path, ["year"], whole_file=whole).collect()
        assert S.broken_documents(spark, path, whole_file=whole).count() == 1
    assert S.load(spark, os.path.join(path, "a.json"), "application/json", columns=["year"]).count() == 1


def test_columnar_json_several_documents_of_many_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "many.json")
    with open(path, "w") as f:
        f.write('{"a": {"0": "x } {"},\n "b": {"1": "y"}\n}\n{\n"a": {"2": "z"}}\n\n')
    got = sorted(tuple(r) for r in S.read_columnar_json(spark, path, ["a", "b"]).collect())
    assert got == [("0", "x } {", None), ("1", None, "y"), ("2", "z", None)]


def test_columnar_json_time_follows_the_document(spark, tmp_dir):
    def seconds(n):
        path = os.path.join(tmp_dir, f"doc{n}")
        S.write_columnar_json(spark.range(n).selectExpr("id", "cast(id as string) AS a", "cast(id as string) AS b"), path, "id", rows_per_doc=n)
        best = []
        for _ in range(3):
            began = time.perf_counter()
            assert S.read_columnar_json(spark, path, ["a", "b"]).agg(F.count("a"), F.count("b")).first() == (n, n)
            best.append(time.perf_counter() - began)
        return min(best)

    small, large = seconds(8_000), seconds(64_000)
    assert large < 24 * small + 1  # a quadratic read takes 64 times as long


def test_one_large_document_is_spread_over_tasks(spark, tmp_dir):
    """One document of a million rows in one file: its rows come from many tasks, in about equal parts."""
    n = 1_000_000
    path = os.path.join(tmp_dir, "large.json")
    with open(path, "w") as f:
        f.write('{"a": {%s}, "b": {%s}}' % (", ".join(f'"{i}": "x{i}"' for i in range(n)), ", ".join(f'"{i}": null' for i in range(n, n + 5))))
    rows = S.read_columnar_json(spark, path, ["a", "b"], key="k")
    assert rows.agg(F.count("k"), F.count("a"), F.count("b")).first() == (n + 5, n, 0)
    parts = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(parts) >= 4 and max(parts) < 2 * (n + 5) / len(parts)


def test_same_row_key_in_two_documents(spark, tmp_dir):
    path = os.path.join(tmp_dir, "two.json")
    with open(path, "w") as f:
        f.write('{"a": {"0": "x"}, "a b": {"0": "s", "1": "t"}}\n{"a": {"0": "y", "2": null}, "b": {}}\n')
    got = sorted((tuple(r) for r in S.read_columnar_json(spark, path, ["a", "a b", "none"], whole_file=False).collect()), key=str)
    assert got == [("0", "x", "s", None), ("0", "y", None, None), ("1", None, "t", None), ("2", None, None, None)]


def test_csv_rows_of_other_lengths_are_errors(spark, tmp_dir):
    path = os.path.join(tmp_dir, "odd.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,2\n3,4,5\n6\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        S.read_csv_strings(spark, path).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        S.read_csv_strings(spark, path).select("a").collect()
    assert sorted(r.row for r in S.malformed_csv_rows(spark, path).collect()) == ["3,4,5", "6"]
    assert S.read_csv_strings(spark, path, strict=False).count() == 3
    with pytest.raises(Exception, match="(?i)malformed"):
        S.read_pages(spark, path, ["a", "b"]).collect()


def write(path, *files):
    os.makedirs(path)
    for i, text in enumerate(files):
        with open(os.path.join(path, f"part-{i}.csv"), "w") as f:
            f.write(text)


@pytest.mark.parametrize("strict", [True, False])
def test_every_csv_file_is_read_by_its_own_header(spark, tmp_dir, strict):
    path = os.path.join(tmp_dir, "several")
    write(path, "a,b\n1,2\n", "b,a\n20,10\n", "a,b\n3,\n", "a,c\n5,NULL\n6,7\n", "", '"b","a"\n"x, y",8\n')
    df = S.read_csv_strings(spark, path, strict=strict)
    assert df.columns == ["a", "b", "c"]
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted(
        [("1", "2", None), ("10", "20", None), ("3", None, None), ("5", None, None), ("6", None, "7"), ("8", "x, y", None)], key=str)
    assert sorted(r.a for r in df.select("a").collect()) == sorted(["1", "10", "3", "5", "6", "8"])
    assert set(S.files_by_header(spark, path)) == {"a,b", "b,a", "a,c", '"b","a"'}


def test_malformed_rows_are_counted_by_their_own_header(spark, tmp_dir):
    path = os.path.join(tmp_dir, "several")
    write(path, "a,b\n1,2\n3\n", "b,a,c\n20,10,5\n1,2\n")
    found = S.malformed_csv_rows(spark, path)
    assert found.count() == 2 and sorted(r.row for r in found.collect()) == ["1,2", "3"]
    with pytest.raises(Exception, match="(?i)malformed"):
        S.read_csv_strings(spark, path).collect()


def test_broken_json_documents_are_rejected_with_path_and_reason(spark, tmp_dir):
    path = os.path.join(tmp_dir, "stores")
    os.makedirs(path)
    texts = {"good": '{"index": 1,\n "geo": {"lat": 1.5}}', "cut": '{"index": 2, "geo": ', "empty": " \n", "list": "[1, 2]",
             "kind": '{"index": "many", "geo": {"lat": 2}}', "null": "null", "less": '{"index": 5}'}
    for name, text in texts.items():
        with open(os.path.join(path, f"{name}.json"), "w") as f:
            f.write(text)
    schema = "index BIGINT, geo STRUCT<lat: DOUBLE>"
    bad = S.broken_json_documents(spark, path, schema, one_per_file=True)
    got = {os.path.basename(r.path).split(".")[0]: (r.reason, r.text) for r in bad.collect()}
    assert got == {"cut": ("not JSON", texts["cut"]), "empty": ("empty document", texts["empty"]), "list": ("not an object", texts["list"]),
                   "kind": ("a value does not fit the schema", texts["kind"]), "null": ("not an object", "null")}
    assert bad.count() == 5
    with pytest.raises(Exception, match="broken document in .*json"):
        S.read_json_documents(spark, path, schema, one_per_file=True).collect()
    kept = S.flatten(S.read_json_documents(spark, path, schema, one_per_file=True, strict=False))
    assert sorted(tuple(r) for r in kept.collect()) == [(1, 1.5), (5, None)]
    one_read = S.json_documents(spark, path, schema, one_per_file=True)
    assert one_read.groupBy(F.col("reason").isNull()).count().count() == 2


def test_broken_json_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lines.json")
    with open(path, "w") as f:
        f.write('{"a": 1}\n\n{"a": \n{"a": 3, "b": "x"}\n')
    assert [(r.reason, r.text) for r in S.broken_json_documents(spark, path).collect()] == [("not JSON", '{"a": ')]
    assert S.read_json_documents(spark, path, strict=False).columns == ["a", "b"]
    assert sorted(r.a for r in S.read_json_documents(spark, path, strict=False).select("a").collect()) == [1, 3]
    with pytest.raises(Exception, match="not JSON"):
        S.read_json_documents(spark, path).select("a").collect()


def test_csv_quoted_newlines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lines.csv")
    with open(path, "w") as f:
        f.write('a,b\n"1\n2",3\n')
    assert [tuple(r) for r in S.read_csv_strings(spark, path, quoted_newlines=True).collect()] == [("1\n2", "3")]
    path = os.path.join(tmp_dir, "headers")
    write(path, '"a\nx",b\n"1\n2",3\n', '"a\ny",b\n4,5\n', 'b,"a\nx"\n7,6\n')
    df = S.read_csv_strings(spark, path, quoted_newlines=True)
    assert df.columns == ["a\nx", "b", "a\ny"]
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted([("1\n2", "3", None), (None, "5", "4"), ("6", "7", None)], key=str)


def test_store_documents_gap_report_and_flatten(spark, tmp_dir):
    path = os.path.join(tmp_dir, "stores")
    os.makedirs(path)
    for i in range(10):
        if i in (3, 7):      # two failed fetches
            continue
        with open(os.path.join(path, f"store_{i}.json"), "w") as f:
            f.write('{"index": %d, "store_code": "ST-%d", "geo": {"latitude": "1.5", "longitude": "2.5"}}\n' % (i, i))
    docs = S.flatten(S.read_json_documents(spark, path))
    assert set(docs.columns) == {"index", "store_code", "geo.latitude", "geo.longitude"}
    assert sorted(r.id for r in S.missing_document_ids(docs, "index", 10).collect()) == [3, 7]


def test_json_text_column_flatten(spark):
    df = spark.createDataFrame([(1, '{"k": 5, "n": {"a": "x"}}'), (2, None)], "id int, props string")
    out = S.flatten_json_column(df, "props", "k BIGINT, n STRUCT<a: STRING>")
    assert out.columns == ["id", "props.k", "props.n.a"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 5, "x"), (2, None, None)]


def test_csv_strings_with_index_column_and_tokens(spark, tmp_dir):
    path = os.path.join(tmp_dir, "products.csv")
    with open(path, "w") as f:
        f.write(',product_name,weight\n0,"A, big one",N/A\n1,B,NULL\n2,C,1kg\n')
    df = S.read_csv_strings(spark, path)
    assert df.columns == ["_c0", "product_name", "weight"]
    assert [tuple(r) for r in df.orderBy("_c0").collect()] == [
        ("0", "A, big one", None), ("1", "B", None), ("2", "C", "1kg")]
    with pytest.raises(ValueError):
        S.load(spark, path, "application/pdf")
    assert S.load(spark, path, "text/csv").count() == 3


def test_pages_with_repeated_headers(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pages")
    os.makedirs(path)
    for p in range(3):
        with open(os.path.join(path, f"page{p}.csv"), "w") as f:
            f.write("card_number,expiry_date\n")
            f.write(f"40{p}1,01/2{p}\n40{p}2,02/2{p}\n")
    df = S.drop_repeated_headers(S.read_pages(spark, path, ["card_number", "expiry_date"]))
    assert df.count() == 6


def test_union_frames_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    out = S.union_frames([a, b]).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, "x", None), (2, None, "y")]


def test_table_sink_is_create_only(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    assert K.create_table(df, "loomstar_sink_test") is True
    assert K.create_table(df.union(df), "loomstar_sink_test") is False
    assert spark.table("loomstar_sink_test").count() == 1
    assert "loomstar_sink_test" in [r.tableName for r in S.list_tables(spark).collect()]


def test_jdbc_round_trip_in_process_derby(spark):
    url = "jdbc:derby:memory:loomstar;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    assert K.create_jdbc_table(nation, url, "NATION", props) is True
    assert K.create_jdbc_table(nation, url, "NATION", props) is False
    back = S.scan_jdbc(spark, url, "NATION", partition_column="N_NATIONKEY", lower_bound=0,
                       upper_bound=25, num_partitions=4, properties=props)
    assert back.rdd.getNumPartitions() == 4
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in nation.collect())


def test_jdbc_splits_of_skewed_ids(spark):
    """Dense ids, far outliers, a hot value and NULLs: every row once, in parts of about equal size."""
    url = "jdbc:derby:memory:loomstar_skew;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    ids = [*range(2000), *(10**15 + 10**12 * k for k in range(10)), *[700] * 600, *(-(10**9) - k for k in range(100)), *[None] * 50]
    df = spark.createDataFrame([(x, f"v{i}") for i, x in enumerate(ids)], "ID long, V string")
    assert K.create_jdbc_table(df.coalesce(1), url, "SKEWED", props)
    parts = S.scan_jdbc_balanced(spark, url, "SKEWED", "ID", 8, props)
    assert sorted(map(tuple, parts.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    share = -(-(len(ids) - 50) // 8)
    assert parts.rdd.getNumPartitions() <= 20 and sorted(sizes)[-2] <= share and max(sizes) < 601 + share
    even = S.scan_jdbc(spark, url, "SKEWED", partition_column="ID", lower_bound=-(10**9) - 99, upper_bound=10**15 + 10**13,
                       num_partitions=8, properties=props)
    assert max(r["count"] for r in even.groupBy(F.spark_partition_id()).count().collect()) > 2000  # what equal ranges give
    for rows in ([], [(None, "x")], [(5, "x")], [(5, "x"), (5, "y"), (None, "z")]):
        name = f"SMALL{len(rows)}{rows[0][0] is None if rows else ''}".upper()
        small = spark.createDataFrame(rows, "ID long, V string")
        assert K.create_jdbc_table(small, url, name, props)
        assert sorted(map(tuple, S.scan_jdbc_balanced(spark, url, name, "ID", 4, props).collect()), key=str) == sorted(rows, key=str)


def test_preview_is_ordered(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    assert [r.id for r in K.preview(df, 3, order_by=["id"]).collect()] == [0, 1, 2]


def test_columnar_json_writer_rejects_repeated_keys(spark, tmp_dir):
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(Exception):
        S.write_columnar_json(dup, os.path.join(tmp_dir, "dup"), "k")
