"""Mixing sources to target weights (7): hash-random order, prefix sums, exact budget cuts.

Every document gets a hash-random key of its id and text.  Within a source, keys are cut into
ranges of equal width, which random keys fill evenly, so a hot source spreads
over many ranges without sampling.  Sizes are summed per (source, range), a
prefix sum over a source's ranges finds the range in which its budget ends, and
a prefix sum inside that one range finds the document and word where it ends.
Whole epochs come first; the cut of the last epoch is thus a key per source,
and whether a document is in is decided row by row, without a join of documents.

Sources are numbered, weighed and given their targets by grouped sums: there may be as many as there are hosts.
The target of a source is its weight's share of ``SHARE`` of all words, at most
``MAX_EPOCHS`` times its own words; what is cut off goes to the others by weight.

Defined results: NULL texts have size 0 and take 0; NULL sources are one source,
ordered last; rows that share id and text share a key, and those at the cut are
taken one after the other, so a budget ends in one row at most.  Other columns stay
as they are, unless they are called ``epoch`` or ``taken``: those are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstar.llm.shared import broadcast_bounded, hidden, saved, shown, words_of

WEIGHTS = (5, 2, 1)      # by source in code point order, repeating
SHARE = 1.5              # of all words
MAX_EPOCHS = 2
SEED = 20240607
LEAST_RANGE = 1_000      # documents in a key range, at least about
MAX_BROADCAST_SOURCES = 100_000


def targets(sizes: list[int], weights: list[int], share: float = SHARE, most: float = MAX_EPOCHS) -> list[float]:
    """Words to take of each source: by weight, none above ``most`` times its size."""
    total = share * sum(sizes)
    out, open_ = [0.0] * len(sizes), list(range(len(sizes)))
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if total * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = total * weights[i] / weight
            break
        for i in over:
            out[i] = float(most * sizes[i])
        total = max(0.0, total - sum(out[i] for i in over))
        open_ = [i for i in open_ if i not in set(over)]
    return out


def random_key(id_col: str, text_col: str, seed: int = SEED) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed))


def ordered_sources(rows: DataFrame) -> DataFrame:
    """``(source, source_size, docs, sid, weight)``: ``sid`` numbers the sources in code point order, NULL last.

    Sources are range-partitioned and written once with their range; a range's numbers follow those of the ranges before it.
    """
    spark = rows.sparkSession
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    order = F.col("source").asc_nulls_last()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = saved(sizes.repartitionByRange(n, order).withColumn("range", F.spark_partition_id()), "sources")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    numbered = ranged.withColumn("no", F.row_number().over(Window.partitionBy("range").orderBy(order))) \
        .join(F.broadcast(starts.select("range", "start")), "range").withColumn("sid", F.col("start") + F.col("no") - 1)
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (F.col("sid") % len(WEIGHTS)).cast("int"))
    return numbered.select("source", F.coalesce("source_size", F.lit(0)).alias("source_size"), "docs", "sid", weight.alias("weight"))


def with_targets(sources: DataFrame, share: float = SHARE, most: float = MAX_EPOCHS) -> DataFrame:
    """``sources`` with their ``target``, as ``targets`` has it.

    A source is cut off at ``most`` times its size if the level (words for each unit of weight) is above that. Cutting off
    raises the level for the others, so a few rounds of two sums find the last level; no source comes to the driver.
    """
    size, weight = F.col("source_size"), F.col("weight")
    first = sources.agg(F.sum(size).alias("size"), F.sum(weight).alias("weight")).first()
    total, whole = share * (first["size"] or 0), first["weight"] or 0
    left, open_, cut = total, whole, 0
    over = F.lit(False)
    while open_:
        over = F.lit(left) * weight / F.lit(open_) > F.lit(float(most)) * size
        found = sources.where(over).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size"), F.sum(weight).alias("weight")).first()
        if found["n"] == cut:
            break
        cut = found["n"]
        left, open_ = max(0.0, total - float(most * found["size"])), whole - found["weight"]
    if not open_:
        return sources.withColumn("target", F.lit(float(most)) * size)
    return sources.withColumn("target", F.when(over, F.lit(float(most)) * size).otherwise(F.lit(float(left)) * weight / F.lit(open_)))


def plan(rows: DataFrame) -> DataFrame:
    """A row for each source: size, target, whole epochs, and the key, its words and rows where its last epoch ends.

    ``rows`` has ``source, size, key``.
    """
    size, goal = F.col("source_size"), F.col("target")
    sources = with_targets(saved(ordered_sources(rows), "numbered"))
    epochs = F.when(size > 0, F.least(F.floor(goal / size), F.lit(MAX_EPOCHS))).otherwise(0).cast("int")
    sources = sources.withColumn("epochs", epochs)
    rest = F.greatest(F.lit(0), F.least(size, F.rint(goal).cast("long") - F.col("epochs") * size)).cast("long")
    ranges = F.greatest(F.lit(1), F.floor(F.col("docs") / F.greatest(F.lit(float(LEAST_RANGE)), F.sqrt("docs")))).cast("long")
    sources = saved(sources.select("source", "sid", "source_size", "target", "epochs", rest.alias("rest"), ranges.alias("ranges")), "goals")
    sources = broadcast_bounded(sources, MAX_BROADCAST_SOURCES)

    # the range of a key: its upper 32 bits, scaled to the number of ranges
    at = F.shiftrightunsigned(F.shiftrightunsigned("key", 32) * F.col("ranges"), 32)
    own = sources.withColumnRenamed("source", "_source")
    placed = rows.join(own, rows["source"].eqNullSafe(F.col("_source"))).select("sid", "size", "key", "rest", at.alias("range"))
    sums = placed.groupBy("sid", "range", "rest").agg(F.sum("size").alias("words"))
    before = F.coalesce(F.sum("words").over(Window.partitionBy("sid").orderBy("range")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = saved(sums.withColumn("before", before)
                 .where((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("words")))
                 .select("sid", "range", "before"), "ranges")
    inside = placed.join(broadcast_bounded(ends, MAX_BROADCAST_SOURCES), ["sid", "range"]) \
        .groupBy("sid", "rest", "before", "key").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("copies"))
    ahead = F.col("before") + F.coalesce(F.sum("words").over(
        Window.partitionBy("sid").orderBy("key_order").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # ranges follow the unsigned order of keys
    cut = inside.withColumn("key_order", F.col("key").bitwiseXOR(F.lit(-(1 << 63)))).withColumn("ahead", ahead) \
        .where((F.col("ahead") < F.col("rest")) & (F.col("rest") <= F.col("ahead") + F.col("words"))) \
        .select("sid", F.col("key_order").alias("cut"), (F.col("rest") - F.col("ahead")).alias("part"), "copies")
    return saved(sources.join(cut, "sid", "left").select("source", "source_size", "target", "epochs", "cut", "part", "copies"), "plan")


def with_taken(rows: DataFrame, sources: DataFrame, source_col: str, size_col: str, key_col: str) -> DataFrame:
    """``rows`` with ``source_size``, ``target`` and ``taken``: the words that the mix takes of each."""
    own = broadcast_bounded(sources, MAX_BROADCAST_SOURCES).withColumnRenamed("source", "_source")
    order = F.col(key_col).bitwiseXOR(F.lit(-(1 << 63)))
    out = rows.join(own, rows[source_col].eqNullSafe(F.col("_source")))
    size, left = F.col(size_col), F.col("part")
    if not sources.where("copies > 1").isEmpty():
        # equal rows at a cut, one after the other; there is no window over any other row
        shared = F.coalesce((F.col("copies") > 1) & (order == F.col("cut")), F.lit(False))
        before = F.sum(size).over(Window.partitionBy("_source").orderBy(size_col).rowsBetween(Window.unboundedPreceding, -1))
        out = out.where(~shared).withColumn("_left", left).unionByName(
            out.where(shared).withColumn("_left", F.greatest(F.lit(0), left - F.coalesce(before, F.lit(0)))))
        left = F.col("_left")
    last = F.when(order < F.col("cut"), size).when(order == F.col("cut"), F.least(size, left)).otherwise(F.lit(0))
    return out.withColumn("taken", F.col("epochs") * size + F.when(F.col("cut").isNull(), F.lit(0)).otherwise(last)) \
        .drop("_source", "epochs", "cut", "part", "copies", "_left")


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """What the mix takes of every document."""
    rows = saved(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                             F.size(words_of(F.col(text_col))).cast("long").alias("size"),
                             random_key(id_col, text_col).alias("key")), "sizes")
    return with_taken(rows, plan(rows), "source", "size", "key") \
        .select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: a row for each document and epoch, with ``epoch`` (from 1) and ``taken`` words.

    The document in which a budget ends keeps its first ``taken`` words, joined by
    single spaces; every other row has its whole text.
    """
    docs, names = hidden(docs)
    id_col, text_col, source_col = names[id_col], names[text_col], names[source_col]
    rows = saved(docs.select(F.col(source_col).cast("string").alias("source"), random_key(id_col, text_col).alias("key"),
                             F.size(words_of(F.col(text_col))).cast("long").alias("size")), "sizes")
    size = F.size(words_of(F.col(text_col))).cast("long")
    own = docs.withColumns({"_size": size, "_key": random_key(id_col, text_col), "_s": F.col(source_col).cast("string")})
    out = with_taken(own, plan(rows).withColumnsRenamed({"source_size": "_ss", "target": "_t"}), "_s", "_size", "_key") \
        .where("taken > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("_size")).cast("int"))))
    words = F.least(F.col("_size"), F.col("taken") - (F.col("epoch") - 1) * F.col("_size"))
    out = out.withColumn("taken", words.cast("long")) \
        .withColumn(text_col, F.when(F.col("taken") < F.col("_size"),
                                     F.array_join(F.slice(words_of(F.col(text_col)), 1, F.col("taken").cast("int")), " "))
                    .otherwise(F.col(text_col)))
    return shown(out, names, "taken", "epoch")
