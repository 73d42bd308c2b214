"""Readers for every source shape the retail ETL meets (S-01 .. S-10, O-06).

Dirty sources are read as all-string columns (never ``inferSchema``) and
typed later by ``conform``.  Every reader returns a lazy DataFrame whose work
is split across tasks: multi-file directories are one task per file split,
JDBC tables can be read in parallel ranges.  Nothing is fetched to the driver.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstar.operators.nulls import na_tokens_to_null


# --- S-01: relational tables ------------------------------------------------------

def scan_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Full table scan of a file table; column pruning and filters are pushed down later."""
    return spark.read.format(fmt).load(path)


def scan_jdbc(spark: SparkSession, url: str, table: str, *,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              properties: dict[str, str] | None = None) -> DataFrame:
    """S-01 over JDBC; with a numeric ``partition_column`` the read is split in ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 1)))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader.load()


SPLIT_BUCKETS = 64


def jdbc_splits(spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
                properties: dict[str, str] | None = None) -> list[str]:
    """Predicates that split a table by an integer column into parts of about equal row counts.

    The database counts; only counts come back.  The column's range is cut into
    ``SPLIT_BUCKETS`` pieces and every piece with more than its share of rows is cut again,
    until pieces are small enough or single values (a few short queries, each counting at
    most ``num_partitions`` pieces), so outliers and dense stretches don't matter.  Neighbouring pieces
    are put together up to the share.  Every row satisfies exactly one predicate: the first and the
    last one are open, rows inserted meanwhile included, and NULLs have one of their own.  A single value with more
    than the share is a part by itself.
    """
    def rows(sql: str) -> list:
        reader = spark.read.format("jdbc").option("url", url).option("query", sql)
        for key, value in (properties or {}).items():
            reader = reader.option(key, value)
        return reader.load().collect()

    low, high, total = rows(f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT({column}) AS n FROM {table}")[0]
    if not total or num_partitions < 2:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    low, high = int(low), int(high)
    share = -(-int(total) // num_partitions)
    done: list[tuple[int, int, int]] = []                    # first value, last value, rows
    heavy = [(low, high, int(total))]
    while heavy:
        cuts, cases, width = [], [], {}
        for i, (first, last, _) in enumerate(heavy):
            width[i] = -(-(last - first + 1) // SPLIT_BUCKETS)
            where = f"{column} BETWEEN {first} AND {last}"
            cuts.append(where)
            cases.append(f"WHEN {where} THEN {i * SPLIT_BUCKETS} + ({column} - {first}) / {width[i]}")
        counted = rows(f"SELECT b, COUNT(*) AS n FROM (SELECT CASE {' '.join(cases)} END AS b FROM {table} "
                       f"WHERE {' OR '.join(cuts)}) x GROUP BY b")
        pieces = []
        for b, n in counted:
            i, k = divmod(int(b), SPLIT_BUCKETS)
            first = heavy[i][0] + k * width[i]
            pieces.append((first, min(first + width[i] - 1, heavy[i][1]), int(n)))
        done += [p for p in pieces if p[2] <= share or p[0] == p[1]]
        heavy = [p for p in pieces if p[2] > share and p[0] < p[1]]
    starts, held = [], 0
    for first, _, n in sorted(done):
        if not starts or held + n > share:
            starts.append(first)
            held = 0
        held += n
    lower = [None, *starts[1:]]
    upper = [*starts[1:], None]
    parts = [" AND ".join([*([f"{column} >= {x}"] if x is not None else []), *([f"{column} < {y}"] if y is not None else [])])
             or f"{column} IS NOT NULL" for x, y in zip(lower, upper)]
    return [*parts, f"{column} IS NULL"]


def scan_jdbc_balanced(spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
                       properties: dict[str, str] | None = None) -> DataFrame:
    """S-01 over JDBC in parts of about equal row counts, whatever the distribution of ``column`` (``jdbc_splits``)."""
    predicates = jdbc_splits(spark, url, table, column, num_partitions, properties)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """S-10: table names in the catalog, as a DataFrame (``SHOW TABLES``)."""
    if database:
        return spark.sql(f"SHOW TABLES IN {database}")
    return spark.sql("SHOW TABLES")


# --- S-02 / S-04: CSV objects ---------------------------------------------------------

HEADER_BYTES = 1 << 20
HEADER_THREADS = 32


def files_by_header(spark: SparkSession, path: str, quoted_newlines: bool = False) -> dict[str, list[str]]:
    """The files under ``path`` by their header text, in the order of their names; empty files are left out.

    Only headers are read (the first line, with ``quoted_newlines`` up to where its quotes close), over the file system that Spark reads the path with; like the
    file listing itself this is work per file, not per row.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def header(name: str) -> str | None:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream = at.getFileSystem(conf).open(at)
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
        if codec is not None:
            stream = codec.createInputStream(stream)
        try:
            lines, out, text = jvm.org.apache.hadoop.util.LineReader(stream), jvm.org.apache.hadoop.io.Text(), None
            while lines.readLine(out, HEADER_BYTES, HEADER_BYTES):
                text = out.toString() if text is None else f"{text}\n{out.toString()}"
                if not quoted_newlines or text.count('"') % 2 == 0:
                    break
            return None if text is None else text.removeprefix("\ufeff")
        finally:
            stream.close()

    names = sorted(spark.read.text(path).inputFiles())
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(max_workers=HEADER_THREADS) as pool:
        for name, line in zip(names, pool.map(header, names)):
            if line is not None:
                groups.setdefault(line, []).append(name)
    return groups


def _csv_reader(spark: SparkSession, quoted_newlines: bool):
    return (spark.read.option("header", "true").option("inferSchema", "false").option("escape", '"')
            .option("multiLine", str(quoted_newlines).lower()))


def read_csv_strings(spark: SparkSession, path: str, na_tokens: bool = True,
                     quoted_newlines: bool = False, strict: bool = True) -> DataFrame:
    """CSV with header rows, every column as text; NA tokens become NULL.

    Every file is read by its own header: files are grouped by header, each group is
    read by name, and the groups are stacked (a column that a file lacks is NULL there).
    A leading column with an empty header (a written row index) keeps Spark's
    positional name ``_c0`` until a reshape drops it.  A row with more or fewer
    fields than its header fails the job; ``strict=False`` keeps it, cut or filled
    up, and ``malformed_csv_rows`` lists such rows.  Files are split across tasks
    unless ``quoted_newlines`` says that values can hold line breaks.
    """
    def group(files: list[str]) -> DataFrame:
        reader = _csv_reader(spark, quoted_newlines)
        df = reader.csv(files)
        if strict:  # every column is asked for, so no field of a row goes unread
            df = reader.schema(df.schema).option("mode", "FAILFAST").option("columnPruning", "false").csv(files)
        return df

    groups = files_by_header(spark, path, quoted_newlines)
    df = union_frames([group(files) for files in groups.values()]) if groups else _csv_reader(spark, quoted_newlines).csv(path)
    return na_tokens_to_null(df) if na_tokens else df


def malformed_csv_rows(spark: SparkSession, path: str, quoted_newlines: bool = False) -> DataFrame:
    """``row`` texts of CSV files with more or fewer fields than their file's header."""
    def group(files: list[str]) -> DataFrame:
        reader = _csv_reader(spark, quoted_newlines)
        fields = reader.csv(files).schema.fields
        schema = T.StructType([*fields, T.StructField("_malformed", T.StringType())])
        rows = (reader.schema(schema).option("columnNameOfCorruptRecord", "_malformed")
                .option("columnPruning", "false").csv(files))
        # the corrupt column can't be asked for alone, whatever is selected later
        first = F.col(f"`{fields[0].name}`")
        return rows.where(F.col("_malformed").isNotNull() & (F.length(F.coalesce(first, F.lit(""))) >= 0)).select(
            F.coalesce("_malformed", first).alias("row"))

    found = [group(files) for files in files_by_header(spark, path, quoted_newlines).values()]
    return union_frames(found) if found else spark.createDataFrame([], "row string")


# --- S-03: column-oriented JSON documents --------------------------------------------

_COLUMNAR = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))


def _columnar_documents(spark: SparkSession, path: str, whole_file: bool) -> DataFrame:
    raw = spark.read.text(path, wholetext=whole_file)
    if whole_file:  # a line break with only space around it between } and { stands between documents only
        raw = raw.select(F.explode(F.split("value", r"(?<=\})\s*\n\s*(?=\{)")).alias("value"))
    return raw.where(F.trim("value") != "").select("value", F.from_json(F.col("value"), _COLUMNAR).alias("doc"))


def broken_documents(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """``document`` texts that are not column-oriented JSON objects."""
    return _columnar_documents(spark, path, whole_file).where(F.col("doc").isNull()) \
        .select(F.col("value").alias("document"))


def read_columnar_json(spark: SparkSession, path: str, columns: list[str],
                       key: str = "row_key", whole_file: bool = True) -> DataFrame:
    """Documents shaped ``{column: {row_key: value}}`` -> one row per row key.

    A file holds one document, over as many lines as it likes, or several, each
    beginning on a line of its own; with ``whole_file=False`` every line is one
    document, and large files are split across tasks.  A document that does not parse fails the job
    (``broken_documents`` lists such ones).  The row keys of a document are the
    union of the keys of its columns.

    A document is parsed where it is read and then taken apart: every cell becomes an
    entry (document, row key, column, value), entries are dealt over tasks by document and
    row key, and rows are put together there.  So the rows of one large document are
    built by all tasks, and no row ever holds more than its own cells.
    """
    docs = _columnar_documents(spark, path, whole_file).withColumn("_doc", F.monotonically_increasing_id())
    doc = F.coalesce(F.col("doc"), F.raise_error(F.concat(
        F.lit("not a column-oriented JSON document: "), F.substring("value", 1, 200))).cast(_COLUMNAR))
    cells = docs.select("_doc", F.explode(doc).alias("_column", "_cells")).select(
        "_doc", "_column", F.explode("_cells").alias("_key", "_value"))
    # entries meet their row before they are grouped: the grouping needs no second shuffle
    rows = cells.repartition("_doc", "_key").groupBy("_doc", "_key").agg(*[
        F.max(F.when(F.col("_column") == c, F.col("_value"))).alias(f"_c{i}") for i, c in enumerate(columns)])
    return rows.select(F.col("_key").alias(key), *[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)])


def write_columnar_json(df: DataFrame, path: str, key: str, rows_per_doc: int = 50_000) -> int:
    """Write ``df`` as column-oriented JSON documents, one document per line.

    Rows are hashed into ``ceil(rows / rows_per_doc)`` documents, so no
    document (one aggregation group) grows with the table.  ``key`` must be
    unique, as the row keys of a JSON object are (a repeated key fails the
    write instead of silently keeping one value).  Returns the number of
    documents.
    """
    n_rows = df.count()
    n_docs = max(1, -(-n_rows // rows_per_doc))
    cols = [c for c in df.columns if c != key]
    doc_id = F.pmod(F.xxhash64(F.col(key)), F.lit(n_docs))
    rk = F.col(key).cast("string")
    docs = (df.groupBy(doc_id.alias("_doc"))
            .agg(*[F.map_from_entries(F.collect_list(F.struct(rk, F.col(c).cast("string")))).alias(c)
                   for c in cols]))
    (docs.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value"))
     .write.mode("errorifexists").text(path))
    return n_docs


# --- S-06: dispatch by content type ------------------------------------------------------

def load(spark: SparkSession, path: str, content_type: str, **options) -> DataFrame:
    """CSV if the content type mentions ``csv``, column-oriented JSON if ``json``; else an error."""
    if "csv" in content_type:
        return read_csv_strings(spark, path)
    if "json" in content_type:
        return read_columnar_json(spark, path, **options)
    raise ValueError(f"unsupported content type {content_type!r}")  # Q-15: never silent


# --- S-07 / S-08: numbered JSON documents ----------------------------------------------

def json_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   one_per_file: bool = False) -> DataFrame:
    """Every document of a directory, parsed or not, in one read: ``document``, ``path``, ``text``, ``reason``.

    ``reason`` is NULL for a document that parsed; else ``document`` is NULL and ``text`` holds what was read.
    Reasons: ``empty document``, ``not JSON``, ``not an object``, ``a value does not fit the schema``.
    JSON lines have one document per line (blank lines are none); with ``one_per_file`` a file is one document.
    """
    text = spark.read.text(path, wholetext=one_per_file).select("value", F.col("_metadata.file_path").alias("path"))
    if not one_per_file:
        text = text.where(~F.col("value").rlike(r"^\s*$"))
    if schema is None:
        schema = spark.read.option("multiLine", str(one_per_file).lower()).option("mode", "DROPMALFORMED").json(path).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    broken = "_broken_document"
    parsed = F.from_json("value", T.StructType([*schema.fields, T.StructField(broken, T.StringType())]),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken})
    rows = text.select("path", F.col("value").alias("text"), parsed.alias("_parsed"))
    whole = F.try_variant_get(F.try_parse_json("text"), "$", "variant")
    kind = F.schema_of_variant(whole)
    reason = (F.when(F.col("text").rlike(r"^\s*$"), "empty document").when(whole.isNull(), "not JSON")
              .when(~kind.startswith("OBJECT"), "not an object").otherwise("a value does not fit the schema"))
    bad = F.col("_parsed").isNull() | F.col(f"_parsed.{broken}").isNotNull() | ~F.col("text").rlike(r"^\s*\{")
    document = F.struct(*[F.col("_parsed").getField(f.name).alias(f.name) for f in schema.fields])
    return rows.select(F.when(~bad, document).alias("document"), "path", F.when(bad, F.col("text")).alias("text"),
                       F.when(bad, reason).alias("reason"))


def read_json_documents(spark: SparkSession, path: str,
                        schema: T.StructType | str | None = None,
                        one_per_file: bool = False, strict: bool = True) -> DataFrame:
    """A directory of JSON documents (JSON lines, or one pretty document per file) as columns.

    A document that does not parse fails the job, naming its file; ``strict=False`` leaves it out.
    ``broken_json_documents`` lists such documents.
    """
    docs = json_documents(spark, path, schema, one_per_file)
    if strict:
        kind = docs.schema["document"].dataType
        failed = F.raise_error(F.concat(F.lit("broken document in "), "path", F.lit(": "), "reason")).cast(kind)
        docs = docs.select(F.when(F.col("reason").isNull(), F.col("document")).otherwise(failed).alias("document"))
    else:
        docs = docs.where(F.col("reason").isNull())
    names = docs.schema["document"].dataType.names
    return docs.select(*[F.col("document").getField(n).alias(n) for n in names])


def broken_json_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                          one_per_file: bool = False) -> DataFrame:
    """The reject channel of ``read_json_documents``: ``path``, ``reason`` and ``text`` of broken documents."""
    docs = json_documents(spark, path, schema, one_per_file)
    return docs.where(F.col("reason").isNotNull()).select("path", "reason", "text")


def missing_document_ids(docs: DataFrame, id_col: str, expected: int) -> DataFrame:
    """Ids in ``0 .. expected-1`` with no document (the failed fetches of S-07, Q-14).

    ``spark.range`` is generated in parallel and the anti join keeps the work
    distributed; duplicates in the documents never inflate anything.
    """
    spark = docs.sparkSession
    got = docs.select(F.col(id_col).cast("bigint").alias("id")).where(F.col("id").isNotNull())
    return spark.range(expected).join(got, "id", "left_anti")


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """S-08: nested structs -> flat columns named ``a.b.c``; arrays are left as values."""
    def walk(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from walk(f.dataType, path + [f.name])
        else:
            yield path

    cols = []
    for field in df.schema.fields:
        for path in walk(field.dataType, [field.name]):
            ref = F.col(path[0])
            for part in path[1:]:
                ref = ref.getField(part)
            cols.append(ref.alias(sep.join(path)))
    return df.select(*cols)


def flatten_json_column(df: DataFrame, column: str, schema: T.StructType | str,
                        sep: str = ".") -> DataFrame:
    """S-08 for a JSON text column: parse it with ``schema``, then flatten."""
    parsed = df.withColumn(column, F.from_json(F.col(column), schema))
    return flatten(parsed, sep)


# --- S-09 / O-06: paged tables --------------------------------------------------------------

def read_pages(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Page tables written without a header; every page starts with the column names.

    A row with more or fewer fields than ``columns`` fails the job.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (spark.read.schema(schema).option("header", "false").option("escape", '"')
            .option("mode", "FAILFAST").option("columnPruning", "false").csv(path))


def drop_repeated_headers(df: DataFrame) -> DataFrame:
    """Drop rows in which every cell equals its own column name (a repeated page header)."""
    is_header = reduce(lambda a, b: a & b,
                       [F.col(c).cast("string").eqNullSafe(F.lit(c)) for c in df.columns])
    return df.where(~is_header)


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """O-06: append frames by column name; columns missing in one frame become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
