"""MinHash near-dedup (2): bottom-k sketches, inverted lists, exact Jaccard.

1. One hash function orders a document's 5-word shingles; the ``k`` smallest
   hashes are its sketch, and a 128-bit sum over the whole set names the set.
   Documents with equal sets are one class, worked on through its smallest id.
2. The retained values are inverted.  Two sets with Jaccard ``>= 0.75`` share at
   least ``t`` retained values (``overlap_bound``), so each document only needs
   to stand in the lists of its ``size - t + 1`` rarest values; values that
   occur once stand first and lead nowhere.
3. Only documents that meet another one in a list go on: they get sketches and
   lists again, with ``K_FINE`` values.  A pair that meets first at some value
   shares no more values than either has from there on in the common order
   (``rem``), which rules most pairs and whole memberships out unseen.
4. Lists are worked on as stars, never as all pairs.  First every document is
   tested against the best centre among its lists (the one with the fewest
   unique values: the text its copies were made from); then, while a list still
   holds several components, documents outside its largest component become
   centres for the list's other components (``CENTRES`` of a list at a time as
   long as that merges components, then all).
   A pair in one component needs no test, every other possible one gets it, so no
   list is cut short and no link is lost.
5. A pair must pass an estimate from the union of both sketches, then the exact
   Jaccard test on the full shingle sets.

The bound ``t`` holds but for a chance below 1e-9 a pair (binomial tail of the
``k`` smallest union values); for sets of up to 3/4 ``k`` shingles it is exact.

Defined results: NULL and blank texts have no shingles and link with nothing;
texts of 1 to 4 words are one shingle; repeated rows are copies of each other.
Rows that share an id count as one document: the classes of their texts are one.
Rows with a NULL id belong to the class of their text but never give it its id;
if such a class has no other id, ``component_id`` is NULL and ``kept`` false.
Extra columns are carried by ``keep_one``, whatever their names.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstar.llm.components import components
from loomstar.llm.shared import SPACES, broadcast_bounded, hidden, saved, ship, shown
from loomstar.llm.wordhash import BASE, NOT_SPACE, doc_shingles, mix, pieces, shingles, words

ship(__name__)

K = 64                      # retained values of a sketch
K_FINE = 1024               # the same for documents that meet another one
MAX_AT_ONCE = 20_000_000    # looks at members of lists below which all that remains is tested in one round
CENTRES = 16                # of each list in a round, else
SHINGLE = 5                 # words of a shingle
SIM_NUM, SIM_DEN = 75, 100  # link when 100 * intersection >= 75 * union
MISS = 1e-9                 # chance that the overlap bound loses one linked pair
LAST = 1 << 62              # stand-ins of NULL ids start here
MAX_BROADCAST_IDS = 500_000  # ids of 8 bytes: a broadcast of a few MB at most
SKETCH = "doc_id long, n_shingles long, f1 long, f2 long, sketch array<long>"


def overlap_bound(k: int = K, num: int = SIM_NUM, den: int = SIM_DEN, miss: float = MISS) -> int:
    """Largest ``t`` with P(Binomial(k, num/den) < t) <= miss."""
    p, tail = num / den, 0.0
    for t in range(k + 1):
        tail += math.comb(k, t) * p ** t * (1 - p) ** (k - t)
        if tail > miss:
            return t
    return k


def _sketch_batches(batches, k: int = K, q: int = SHINGLE):
    for batch in pieces(batches, 1):
        n = batch.num_rows
        found = words(batch.column(1), NOT_SPACE)
        sizes, f1, f2 = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        kept, ends = [np.zeros(0, np.int64)], np.zeros(n + 1, np.int32)
        # shingles of the batch at once; those that cross from one text into the next are not used
        runs = shingles(found.hash, q).view(np.int64)
        for i in range(n):
            lo, hi = found.first[i], found.first[i + 1]
            own = np.unique(runs[lo:hi - q + 1]) if hi - lo >= q else \
                doc_shingles(found.hash[lo:hi], q).view(np.int64)
            sizes[i] = len(own)
            f1[i] = mix(own.view(np.uint64)).sum(dtype=np.uint64)
            f2[i] = mix(own.view(np.uint64) ^ np.uint64(BASE)).sum(dtype=np.uint64)
            kept.append(own[:k])
            ends[i + 1] = ends[i] + len(kept[-1])
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(kept)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), lists],
            names=["doc_id", "n_shingles", "f1", "f2", "sketch"])


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Set size, set fingerprint and bottom-k sketch of every document."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(partial(_sketch_batches, k=k), SKETCH)


def _linked(batches, q: int = SHINGLE, num: int = SIM_NUM, den: int = SIM_DEN):
    """Pairs whose full shingle sets have the asked Jaccard similarity."""
    for batch in pieces(batches, 2, 3):
        left, right = words(batch.column(2), NOT_SPACE), words(batch.column(3), NOT_SPACE)
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            a = doc_shingles(left.hash[left.first[i]:left.first[i + 1]], q)
            b = doc_shingles(right.hash[right.first[i]:right.first[i + 1]], q)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep[i] = den * both >= num * (len(a) + len(b) - both) and both > 0
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))


def _may_link(a: Column, b: Column, na: Column, nb: Column, k: int = K) -> Column:
    """Union-sketch estimate: retained values common to both among the union's ``k`` smallest."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    common = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    whole = (na <= F.size(a)) & (nb <= F.size(b))  # both sketches are whole sets: the estimate is exact
    least = F.when(whole & (F.size(union) < k), F.ceil(F.size(union) * SIM_NUM / SIM_DEN)) \
        .otherwise(F.least(F.lit(overlap_bound(k)), F.ceil(F.size(union) * SIM_NUM / SIM_DEN)))
    sizes = (SIM_DEN * F.least(na, nb) >= SIM_NUM * F.greatest(na, nb))
    return sizes & (common >= least)


def inverted_lists(sets: DataFrame, k: int) -> DataFrame:
    """``(value, s)``: the necessary retained values of each set that other sets retain too.

    ``sets`` has ``doc, n, sketch``.  ``s`` is (unique values, doc, n, rem), in
    the order in which members become centres; ``rem`` counts the set's retained
    values from this one on, rarest first.
    """
    posted = sets.select("doc", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    often = posted.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = posted.join(often, "value").groupBy("doc").agg(
        F.first("size").alias("size"), F.first("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("vals"))  # k entries at most
    exact = F.ceil(F.col("n") * SIM_NUM / SIM_DEN)
    t = F.when(F.col("n") * SIM_DEN <= SIM_NUM * k, exact).otherwise(F.least(F.lit(overlap_bound(k)), exact))
    return shared.withColumn("u", F.col("size") - F.size("vals")) \
        .withColumn("use", F.col("size") - t + 1 - F.col("u")).where("use > 0") \
        .select("doc", "n", "u", "size", F.posexplode(F.slice("vals", 1, F.col("use").cast("int"))).alias("i", "v")) \
        .select(F.col("v.value").alias("value"), F.struct(
            "u", "doc", "n", (F.col("size") - F.col("u") - F.col("i")).alias("rem")).alias("s"))


def _possible(x: str, y: str, k: int) -> Column:
    """Whether two members of a list that meet first at its value can be linked at all."""
    nx, ny, most = F.col(f"{x}.n"), F.col(f"{y}.n"), F.least(F.col(f"{x}.rem"), F.col(f"{y}.rem"))
    return _sizes_allow(nx, ny, most, k)


def _sizes_allow(nx: Column, ny: Column, most: Column, k: int) -> Column:
    whole = (nx <= k) & (ny <= k)
    return (SIM_DEN * F.least(nx, ny) >= SIM_NUM * F.greatest(nx, ny)) & F.when(
        whole, (SIM_DEN + SIM_NUM) * most >= SIM_NUM * (nx + ny)).otherwise(most >= overlap_bound(k))


def _met(lists: DataFrame, k: int) -> DataFrame:
    """Without the members that no other member's size allows, and the lists of one document."""
    sizes = lists.groupBy("value").agg(F.min("s.n").alias("low"))
    n, rem = F.col("s.n"), F.col("s.rem")
    small = SIM_DEN * n <= SIM_NUM * k  # any partner's sketch is its whole set, too
    least = F.greatest("low", F.ceil(n * SIM_NUM / SIM_DEN))
    lists = lists.join(sizes, "value").where(
        F.when(small, (SIM_DEN + SIM_NUM) * rem >= SIM_NUM * (n + least))
        .otherwise(rem >= F.least(F.lit(overlap_bound(k)), F.ceil(n * SIM_NUM / SIM_DEN)))).drop("low")
    ends = lists.groupBy("value").agg(F.min("s.doc").alias("lo"), F.max("s.doc").alias("hi")).where("lo < hi")
    return lists.join(ends.select("value"), "value", "left_semi")


def _verified(pairs: DataFrame, store: DataFrame) -> DataFrame:
    """Of ``pairs (a, b)`` those that are links, by the estimate and then the exact test."""
    left = store.select(F.col("doc").alias("a"), F.col("sketch").alias("sa"), F.col("n").alias("na"))
    right = store.select(F.col("doc").alias("b"), F.col("sketch").alias("sb"), F.col("n").alias("nb"))
    likely = saved(pairs.join(left, "a").join(right, "b").where(
        _may_link(F.col("sa"), F.col("sb"), F.col("na"), F.col("nb"))).select("a", "b"), "likely", narrow=True)
    texts = likely.join(store.select(F.col("doc").alias("a"), F.col("text").alias("ta")), "a") \
        .join(store.select(F.col("doc").alias("b"), F.col("text").alias("tb")), "b")
    return texts.select("a", "b", "ta", "tb").mapInArrow(_linked, "a long, b long")


def link_components(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, comp)`` of the distinct sets that are linked with another one."""
    spark = docs.sparkSession
    first = _met(inverted_lists(reps.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "sketch"), K), K)
    ids = broadcast_bounded(saved(first.select("s.doc").distinct(), "ids", narrow=True), MAX_BROADCAST_IDS)
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")) \
        .join(ids, "doc", "left_semi").dropDuplicates(["doc"])
    store = saved(texts.join(reps.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "sketch")
                             .join(ids, "doc", "left_semi"), "doc"), "store")
    fine = saved(sketches(store, "doc", "text", K_FINE)
                 .select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "sketch"), "fine")
    lists = saved(_met(inverted_lists(fine, K_FINE), K_FINE).withColumn("doc", F.col("s.doc")), "lists")

    # round 0: each document against the best centre of its lists
    best = lists.groupBy("value").agg(F.min("s").alias("c"))
    tried = lists.join(best, "value").where(_possible("s", "c", K_FINE)).groupBy("doc").agg(F.min("c").alias("c")) \
        .select(F.col("c.doc").alias("a"), F.col("doc").alias("b")).where("a <> b")
    tested = saved(tried, "pairs", narrow=True)
    edges = saved(_verified(tested, store), "links", narrow=True)
    comp, at_once = components(edges), False
    while True:
        named = lists.join(comp, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
        sizes = named.groupBy("value", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("value").agg(
            F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
        sizes = saved(sizes.select("value", F.col("top.comp").alias("main"), (F.col("n") * (F.col("n") - F.col("top.n"))).alias("pairs")),
                      "lists", narrow=True)
        # all documents outside the main component become centres, or some of each list, to merge components first
        at_once = at_once or (sizes.agg(F.sum("pairs")).first()[0] or 0) <= MAX_AT_ONCE
        open_ = saved(named.join(sizes.select("value", "main"), "value"), "open", narrow=True)
        chosen = open_.where("comp <> main").select("value", F.col("s").alias("c"), F.col("comp").alias("of"))
        if not at_once:
            chosen = chosen.groupBy("value", F.pmod(F.xxhash64("c.doc"), F.lit(CENTRES)).alias("salt")) \
                .agg(F.min(F.struct("c", "of")).alias("x")).select("value", "x.c", "x.of")
        pairs = open_.join(chosen, "value").where((F.col("comp") != F.col("of")) & _possible("s", "c", K_FINE)) \
            .select(F.least("c.doc", "doc").alias("a"), F.greatest("c.doc", "doc").alias("b")).distinct() \
            .join(tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
        pairs = saved(pairs, "pairs", narrow=True)
        tested = tested.unionByName(pairs)
        more = saved(_verified(pairs, store), "links", narrow=True)
        found = not more.isEmpty()
        if found:
            edges = edges.unionByName(more)
            comp = components(edges)
        if at_once:
            return comp
        at_once = not found  # some centres merged nothing: all the rest is tested


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's set size, component (smallest id reachable) and whether it is the one kept."""
    base = saved(sketches(docs, id_col, text_col), "sketches")
    differ = F.struct("n_shingles", "f1", "f2")
    if not base.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(differ).alias("lo"), F.max(differ).alias("hi")) \
            .where("lo <> hi").isEmpty():
        return _with_several_texts(docs, id_col, text_col)
    full = base.where("n_shingles > 0")
    sets = saved(full.groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("rep")), "sets")
    reps = saved(full.join(sets.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
                 .dropDuplicates(["doc_id"]).select("doc_id", "n_shingles", "sketch"), "reps")
    comp = link_components(docs, reps, id_col, text_col)
    named = sets.join(comp.withColumnRenamed("doc", "rep"), "rep", "left") \
        .select("n_shingles", "f1", "f2", F.coalesce("comp", "rep").alias("component_id"))
    linked = base.select("doc_id", "n_shingles", "f1", "f2").join(named, ["n_shingles", "f1", "f2"], "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return linked.select("doc_id", "n_shingles", own.alias("component_id"),
                         F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept"))


def _with_several_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``near_duplicates`` where an id stands for several texts: every text is linked by a number of its own.

    The texts of an id are one class, so components that share an id are put together.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("print"), F.col(text_col).alias("text"))
    known = rows.where("id IS NOT NULL")
    numbers = saved(known.select("id", "print").distinct().withColumn("doc_id", F.monotonically_increasing_id()), "text-numbers")
    single = known.join(numbers, ["id", "print"]).select("doc_id", "text") \
        .unionByName(rows.where("id IS NULL").select(F.lit(None).cast("long").alias("doc_id"), "text"))
    found = saved(near_duplicates(single), "text-components")
    of_id = found.join(numbers.select("doc_id", "id"), "doc_id", "left")
    least = of_id.where("id IS NOT NULL").groupBy("id").agg(F.min("component_id").alias("a"))
    edges = saved(of_id.join(least, "id").where("a <> component_id").select("a", F.col("component_id").alias("b")).distinct(),
                  "shared-ids", narrow=True)
    merged = components(edges).select(F.col("doc").alias("component_id"), "comp")
    whole = of_id.join(merged, "component_id", "left").withColumn("comp", F.coalesce("comp", "component_id"))
    names = whole.where("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("component"))
    return whole.join(names, "comp", "left").select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those whose near-duplicate class has a smaller id; all columns stay.

    Rows with a NULL id come after all others, in the order of a fingerprint of the text; of those that
    share a text with words, one is kept at most.
    """
    docs, names = hidden(docs)
    own, text = F.col(names[id_col]).cast("long"), names[text_col]
    keyed = docs.withColumn("_near_key", F.coalesce(own, F.xxhash64(text).bitwiseAND(F.lit(LAST - 1)).bitwiseOR(F.lit(LAST))))
    if not docs.where(own.isNull()).isEmpty():
        copies = own.isNull() & (F.translate(text, SPACES, "") != "")
        copies = F.coalesce(copies, F.lit(False))
        keyed = keyed.where(~copies).unionByName(keyed.where(copies).dropDuplicates(["_near_key"]))
    gone = saved(near_duplicates(keyed, "_near_key", text).where("NOT kept").select("doc_id").distinct(), "gone")
    gone = broadcast_bounded(gone, MAX_BROADCAST_IDS).withColumnRenamed("doc_id", "_gone_id")
    return shown(keyed.join(gone, F.col("_near_key") == F.col("_gone_id"), "left_anti"), names)
