"""Document fingerprints (11): SpotSigs, chains of content words that follow common words.

Every common word (an anchor) and the ``CHAIN`` content words after it form a signature; a text's fingerprint
is its set of signatures.  Text that is edited elsewhere keeps its signatures, and navigation or lists of names
hardly have any.  So that texts without listed common words have signatures as well, the beginning of a text
and one in ``SHARE`` content words, by their hash, are anchors too.

Sets are compared by Jaccard likeness.  ``near_sets`` is the join: sets are partitioned by length, so that a set
meets only partitions whose lengths its likeness allows; it is looked up by its rarest signatures, as
many as any near set must share one of; and a pair is compared as far as its lengths allow.

Built-in expressions only.  Defined results: NULL texts are empty; an empty text has no signature and the
fingerprint ``''``; a text without words is one signature; two empty sets are alike (1), an empty one and
another one are not (0); documents follow each other by id, NULL ids last, those of one id by a hash of their text;
of rows equal in both, each is followed by its equal and the last by the next document; the last
document is followed by the first, an only one by itself; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstar.llm.shared import broadcast_bounded, let, saved

CHAIN = 3
SHARE = 8
THRESHOLD = 0.75
MAX_WORD = 24            # code points; longer runs of letters are several words
QUERY_BLOCK = 256        # queries in a block, about
MAX_BROADCAST = 500_000  # rows of looked-up signatures that may be broadcast

# Frequent function words of four languages.
COMMON = tuple(sorted(set("""
a an and are as at be been but by can for from had has have he her his i in is it its not of on or our she so that the
their there they this to was we were what which who will with would you your
au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour
que qui sa se ses son sur un une vous
aber als am auch auf aus bei bin das dass dem den der des die durch ein eine einem einen einer er es für hat ich im in
ist mit nach nicht noch nur oder sein sich sie sind so und vom von vor war wie wir wird zu zum zur
al como con de del el ella en entre era es esta este fue ha hay la las le lo los más me mi muy no o para pero por porque
que se ser si sin sobre son su sus también te tiene todo un una y ya
""".split())))

_SINGLE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}"
WORDS = rf"[{_SINGLE}]|[\p{{L}}\p{{M}}\p{{N}}&&[^{_SINGLE}]]{{1,{MAX_WORD}}}"


def words_of(text: Column) -> Column:
    """Words in lower case.  Where none is longer than a word may be and no character is a word of its own, a split gives them."""
    def found(low: Column) -> Column:
        plain = F.split(low, r"[^\p{L}\p{M}\p{N}]+")
        return let(plain, lambda w: F.when(
            low.rlike(r"[^\x{0}-\x{DFF}]") | F.exists(w, lambda x: F.length(x) > MAX_WORD),
            F.regexp_extract_all(low, F.lit(WORDS), F.lit(0))).otherwise(F.filter(w, lambda x: x != "")))

    return let(F.lower(text), found)


def signatures(text: Column) -> Column:
    """The sorted set of a text's signatures (32-bit numbers)."""
    words = words_of(text)

    def chain(anchor: Column, content: Column, first: Column) -> Column:
        return F.hash(anchor, *(F.get(content, first + k) for k in range(CHAIN)))

    def found(w: Column, content: Column) -> Column:
        def places(of: Column, chosen) -> Column:
            return F.filter(F.transform(of, lambda x, i: F.when(chosen(x), i)), lambda i: i.isNotNull())

        # of the words before the j-th common word, j are common: i - j content words came before it
        after_common = F.transform(places(w, lambda x: x.isin(*COMMON)), lambda i, j: chain(F.get(w, i), content, i - j))
        after_chosen = F.transform(places(content, lambda x: F.pmod(F.hash(x), F.lit(SHARE)) == 0),
                                   lambda k: chain(F.get(content, k), content, k + 1))
        return F.sort_array(F.array_distinct(F.concat(after_common, after_chosen, F.array(chain(F.lit(""), content, F.lit(0))))))

    of_words = let(words, lambda w: let(F.filter(w, lambda x: ~x.isin(*COMMON)), lambda content: F.when(
        F.size(w) > 0, found(w, content)).when(F.length(text) > 0, F.array(F.hash(text))).otherwise(F.array().cast("array<int>"))))
    return of_words


def fingerprint(sigs: Column) -> Column:
    """A signature set as text: its numbers, four bytes each, in base64."""
    digits = F.transform(sigs, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.replace(F.base64(F.unhex(F.array_join(digits, ""))), F.lit("\r\n"), F.lit(""))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two signature sets; 0 where their lengths alone keep it below ``least``."""
    n, m = F.size(a), F.size(b)
    both = F.size(F.array_intersect(a, b))
    return F.when((n == 0) & (m == 0), 1.0).when(F.least(n, m) < F.lit(least) * F.greatest(n, m), 0.0) \
        .otherwise(let(both, lambda x: x / (n + m - x)))


# -- near sets -------------------------------------------------------------------

def length_partition(n: Column, threshold: float) -> Column:
    """Sets of likeness ``threshold`` lie in one partition or in neighbouring ones (the margin is for rounding)."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(1 / threshold)) * F.lit(1 - 1e-9)).cast("int")


def distinct_sets(sets: DataFrame) -> DataFrame:
    """One row for each set of ``(c1, c2, sigs)``."""
    return sets.groupBy("c1", "c2").agg(F.first("sigs").alias("sigs"))


def near_sets(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(q1, q2, c1, c2, likeness)``: each set that a query has, with the sets near it (itself included).

    ``sets`` has a row ``(c1, c2, sigs, is_query)`` for each document, ``c1, c2`` naming its set; it is read several times.
    """
    sets = sets.where(F.size("sigs") > 0)
    queries = saved(distinct_sets(sets.where("is_query")).select(F.col("c1").alias("q1"), F.col("c2").alias("q2"), "sigs"), "spot-queries")
    asked = queries.select("q1", "q2", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    # how many documents have each signature that is asked for; a set is looked up by its rarest ones
    wanted = saved(asked.select("sig").distinct(), "spot-wanted", narrow=True)
    held = sets.select(F.explode("sigs").alias("sig")).join(broadcast_bounded(wanted, MAX_BROADCAST), "sig")
    frequency = held.groupBy("sig").agg(F.count(F.lit(1)).alias("f"))
    # of n signatures a near set shares at least threshold * n, so it has one of any n - that + 1
    few = F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)) + 1
    ranked = asked.join(frequency, "sig").groupBy("q1", "q2", "n").agg(F.array_sort(F.collect_list(F.struct("f", "sig"))).alias("s"))
    probes = ranked.select("q1", "q2", "n", F.explode(F.slice("s", F.lit(1), few.cast("int"))).alias("p"))
    part = length_partition(F.col("n"), threshold)
    probes = saved(probes.select("q1", "q2", "n", F.col("p.sig").alias("sig"), F.explode(F.sequence(part - 1, part + 1)).alias("part")),
                   "spot-probes", narrow=True)
    posted = sets.select("c1", "c2", F.size("sigs").alias("m"), F.explode("sigs").alias("sig")) \
        .withColumn("part", length_partition(F.col("m"), threshold))
    # a signature that is looked up lists each set once, however many documents have it
    asking = saved(probes.groupBy("sig", "part").agg(F.count(F.lit(1)).alias("queries")), "spot-keys", narrow=True)
    posted = posted.join(broadcast_bounded(asking.select("sig", "part"), MAX_BROADCAST), ["sig", "part"], "left_semi").distinct()
    # and meets blocks of the queries that look it up: sets of one group ask for the same signatures, so a set
    # and a block meet once for all the signatures they share, and then give each pair once
    blocks = max(1, -(-(asking.agg(F.max("queries")).first()[0] or 0) // QUERY_BLOCK))
    listed = probes.groupBy("sig", "part", F.pmod(F.xxhash64("q1", "q2"), F.lit(blocks)).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("q1", "q2", "n"))).alias("queries"))
    met = posted.join(listed, ["sig", "part"]).groupBy("c1", "c2", "m", "block").agg(F.collect_set("queries").alias("queries"))
    shorter, longer = F.least("n", "m"), F.greatest("n", "m")
    pairs = met.select("c1", "c2", "m", F.explode(F.array_distinct(F.flatten("queries"))).alias("q")).select("c1", "c2", "m", "q.*") \
        .where(shorter >= F.lit(threshold) * longer - F.lit(1e-9)).select("q1", "q2", "c1", "c2")
    pairs = saved(pairs, "spot-pairs", narrow=True)
    met = saved(pairs.select("c1", "c2").distinct(), "spot-met", narrow=True)
    found = distinct_sets(sets.join(broadcast_bounded(met, MAX_BROADCAST), ["c1", "c2"]))
    rows = pairs.join(queries.withColumnRenamed("sigs", "of_query"), ["q1", "q2"]).join(found, ["c1", "c2"])
    like = likeness(F.col("of_query"), F.col("sigs"), threshold)
    return rows.select("q1", "q2", "c1", "c2", like.alias("likeness")).where(F.col("likeness") >= threshold)


# -- documents and their successors ------------------------------------------------

KEY = ["id", "none", "print"]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, none, print, text)``: ids with a mark for NULL ones, a hash of the text, the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    i = F.col(id_col).cast("long")
    return docs.select(F.coalesce(i, F.lit(0)).alias("id"), i.isNull().alias("none"), F.xxhash64(text).alias("print"), text.alias("text"))


def successors(rows: DataFrame) -> DataFrame:
    """For each document (key): ``next``, the key of the following one, ``n`` code points, ``times`` it occurs.

    Keys are range-partitioned and written once with their range; inside a range the next
    key follows, and the last one of a range is followed by the first one of the next range.
    """
    spark = rows.sparkSession
    keys = rows.select(*KEY, F.length("text").alias("n")).groupBy(*KEY, "n").agg(F.count(F.lit(1)).alias("times"))
    order = ["none", "id", "print"]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = saved(keys.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "spot-order")
    key = F.struct(*order)
    inside = Window.partitionBy("range").orderBy(*order)
    by_range = Window.orderBy("range")  # one row for each range
    ends = ranged.groupBy("range").agg(F.min(key).alias("head")) \
        .withColumn("after", F.coalesce(F.lead("head").over(by_range), F.first("head").over(
            by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))).drop("head")
    linked = ranged.withColumn("next", F.lead(key).over(inside)).join(F.broadcast(ends), "range")
    return linked.select(*KEY, "n", "times", F.coalesce("next", "after").alias("next"))


def edited_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The registered query: every text's fingerprint, that of its edited text, and their likeness.

    ``n_near`` counts the other documents of likeness ``THRESHOLD`` or more, for the search's
    queries (ids divisible by 100), and is NULL for other documents.
    """
    rows = keyed(docs, id_col, text_col)
    texts = rows.groupBy(*KEY).agg(F.first("text").alias("text"))
    quarter = F.floor(F.col("n") / 4).cast("int")
    ahead = successors(rows).select(*(F.col(f"next.{k}").alias(k) for k in KEY), *(F.col(k).alias(f"of_{k}") for k in KEY),
                                    quarter.alias("quarter"), "times")
    ahead = texts.join(ahead, KEY).select(
        *(F.col(f"of_{k}").alias(k) for k in KEY), "quarter", "times",
        F.substring("text", F.lit(1), F.col("quarter")).alias("lead"), signatures(F.col("text")).alias("next_sigs"))
    both = texts.join(ahead, KEY).join(near_counts(rows), KEY, "left").withColumn("sigs", signatures(F.col("text")))
    # of equal rows, all but one are followed by their equal
    variant = lambda lead, sigs, times: F.struct(lead.alias("lead"), sigs.alias("next_sigs"), times.alias("times"))
    variants = F.filter(F.array(
        variant(F.col("lead"), F.col("next_sigs"), F.lit(1).cast("long")),
        variant(F.substring("text", F.lit(1), F.col("quarter")), F.col("sigs"), F.col("times") - 1)), lambda v: v["times"] > 0)
    each = both.select(*KEY, "text", "quarter", "sigs", "n_near", F.explode(variants).alias("v"))
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - F.col("quarter")), F.col("v.lead"))
    each = each.select("id", "none", F.length("text").cast("long").alias("n_chars"), "sigs", "v.next_sigs", "v.times", "n_near", edited.alias("edited"))
    each = each.withColumn("edited_sigs", signatures(F.col("edited")))
    out = each.select(
        F.when(~F.col("none"), F.col("id")).alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"), fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"), "n_near", "times")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("times", "copy")


def near_counts(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(key, n_near)`` of the documents with ids divisible by 100: others that are near."""
    sigs = F.col("sigs")
    sets = rows.select(*KEY, signatures(F.col("text")).alias("sigs")).select(
        *KEY, "sigs", F.xxhash64(sigs).alias("c1"), F.xxhash64(F.size(sigs), sigs).alias("c2"),
        (~F.col("none") & (F.col("id") % 100 == 0)).alias("is_query"))
    sets = saved(sets, "spot-sets")
    members = sets.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("members"))
    near = near_sets(sets, threshold).join(members, ["c1", "c2"]).groupBy("q1", "q2").agg((F.sum("members") - 1).alias("n_near"))
    empty = members.join(sets.where(F.size("sigs") == 0).select("c1", "c2").distinct(), ["c1", "c2"]).select(
        F.col("c1").alias("q1"), F.col("c2").alias("q2"), (F.col("members") - 1).alias("n_near"))  # empty texts are alike
    asked = sets.where("is_query").select(*KEY, F.col("c1").alias("q1"), F.col("c2").alias("q2")).distinct()
    return asked.join(near.unionByName(empty), ["q1", "q2"]).select(*KEY, "n_near")
