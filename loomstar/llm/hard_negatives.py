"""Hard-negative mining (12): exact inner products by Kronecker-packed multiplication.

A block of candidates is packed component by component: the values of component
``j`` of all candidates, biased to be non-negative, lie in separated fields of one
wide integer ``W[j]``.  ``sum(a[j] * W[j])`` then holds the inner products of an
anchor with the whole block, one in each field: one multiplication for each of
the anchor's components, whatever the number of candidates.  Fields are as wide as
the largest sum that can arise, so no field runs into the next one, and taking the
biases off again gives exact scores.

The anchors (a stated query set) meet all rows in blocks of bounded size: rows are dealt
to slices by a hash of their row number, anchors to blocks likewise, and every
(anchor block, slice) pair is one group of a co-group.  A group gives at most
``K`` rows for an anchor (first pass: positives) or for an anchor and positive
(second pass: negatives), which are ranked again over the slices.

Defined results: rows with a NULL label or vector, or a NULL or non-finite component,
take no part; a NULL id takes part, is never an anchor and comes last among ties;
repeated rows are rows of their own; of vectors of different lengths, missing
components count as 0; an empty vector scores 0; components are held at +-2^53 and
scores at a long's ends; anchors without a positive, and positives without a
negative in their range, give no row; other columns are not looked at.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstar.llm.shared import saved, ship

ship(__name__)

SCALE = 256
K_POSITIVES, K_NEGATIVES = 5, 5
LOW, HIGH = 80, 100              # per cent of the positive's score
ANCHOR_BLOCK, SLICE = 1024, 32_768   # rows of a block and of a slice, at most about
VALUES = 1 << 22                 # components of a block or slice, at most about (32 MB)
LARGEST = 1 << 53
LONG = (1 << 63) - 1


def quantised(vectors: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """``(row, id, label, v)`` of the rows that take part, written once; ``v`` holds ``floor(scale * x)``."""
    x = F.col("embedding").cast("array<double>")
    scaled = F.transform(x, lambda c: F.coalesce(c, F.lit(float("nan"))) * scale)
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), scaled.alias("s")).where(
        F.col("label").isNotNull() & F.col("s").isNotNull() & F.forall("s", lambda c: F.abs(c) < float("inf")))
    held = F.transform("s", lambda c: F.floor(F.least(F.greatest(c, F.lit(float(-LARGEST))), F.lit(float(LARGEST)))))
    return saved(rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", held.cast("array<bigint>").alias("v")),
                 "vectors")


def matrix(col: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """The vectors of a list column as rows of integers, padded with zeros to the longest (``width`` at least)."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(col.offsets.to_numpy()) if len(col) else np.zeros(0, np.int64)
    d = max(width, int(sizes.max()) if len(sizes) else 0)
    out = np.zeros((len(sizes), d), np.int64)
    out[np.arange(d) < sizes[:, None]] = flat
    return out


class Packed:
    """Candidates in fields of wide integers, for anchors of up to ``largest`` a component (biased)."""

    def __init__(self, rows: np.ndarray, lowest: int, highest: int):
        self.n, d = rows.shape
        self.bias = -min(0, int(rows.min(initial=0)))
        self.anchor_bias = -min(0, lowest)
        biased = rows + self.bias
        # wide enough for the biased sums and for every term that takes the biases off again
        width = (max(1, d), max(1, int(biased.max(initial=0)), self.bias), max(1, highest + self.anchor_bias, -lowest))
        bits = (width[0] * width[1] * width[2]).bit_length()
        self.field = 4 if bits <= 32 else 8 if bits <= 62 else (bits + 7) // 8
        if self.field <= 8:
            columns = np.ascontiguousarray(biased.T).astype("<u4" if self.field == 4 else "<u8")
            self.wide = [int.from_bytes(c.tobytes(), "little") for c in columns]
            self.sums = biased.sum(axis=1)
        else:
            exact = [[int(x) for x in c] for c in biased.T]
            self.wide = [int.from_bytes(b"".join(x.to_bytes(self.field, "little") for x in c), "little") for c in exact]
            self.sums = [sum(x) for x in zip(*exact)]

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The anchor's inner products with all candidates."""
        product = sum(map(mul, [a + self.anchor_bias for a in anchor], self.wide))
        buf = product.to_bytes(self.field * self.n, "little")
        less = self.bias * sum(anchor)
        if self.field <= 8:
            fields = np.frombuffer(buf, "<u4" if self.field == 4 else "<u8").astype(np.int64)
            return fields - self.anchor_bias * self.sums - less
        fields = (int.from_bytes(buf[i:i + self.field], "little") for i in range(0, len(buf), self.field))
        return np.array([max(-LONG, min(LONG, f - self.anchor_bias * s - less)) for f, s in zip(fields, self.sums)], np.int64)


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of ``among``: higher scores first, ties by smaller id, then row."""
    if len(among) > k:
        among = among[scores[among] >= np.partition(scores[among], len(among) - k)[len(among) - k]]
    return among[np.lexsort((rows[among], ids[among], -scores[among]))][:k]


def block_columns(left: pa.Table, right: pa.Table):
    """Packed candidates with their rows, ids (NULLs last) and labels; anchors as lists."""
    a = matrix(right["v"])
    m = matrix(left["v"], a.shape[1])
    a = np.pad(a, ((0, 0), (0, m.shape[1] - a.shape[1])))
    packed = Packed(m, int(a.min(initial=0)), int(a.max(initial=0)))
    ids = left["id"].fill_null(LONG).to_numpy()
    return packed, left["row"].to_numpy(), ids, left["label"].to_numpy(), a.tolist()


POSITIVES = "anchor long, row long, id long, score long"
NEGATIVES = "anchor long, place int, row long, id long, score long"


def positives_of_block(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if left.num_rows and right.num_rows:
            packed, rows, ids, labels, anchors = block_columns(left, right)
            given = left["id"].to_pylist()
            for row, label, a in zip(right["row"].to_pylist(), right["label"].to_pylist(), anchors):
                s = packed.scores(a)
                for i in best(s, ids, rows, np.flatnonzero((labels == label) & (rows != row)), k):
                    for col, x in zip(out, (row, int(rows[i]), given[i], int(s[i]))):
                        col.append(x)
        return pa.table([pa.array(x, pa.int64()) for x in out], ["anchor", "row", "id", "score"])

    return run


def negatives_of_block(k: int, low: int, high: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            packed, rows, ids, labels, anchors = block_columns(left, right)
            given = left["id"].to_pylist()
            for row, label, a, of in zip(right["row"].to_pylist(), right["label"].to_pylist(), anchors, right["positives"].to_pylist()):
                s = packed.scores(a)
                other = np.flatnonzero(labels != label)
                so = s[other]
                for place, p in enumerate(of):
                    least, most = -(-low * p // 100), high * p // 100
                    if least > most:
                        continue
                    for i in best(s, ids, rows, other[(so >= max(least, -LONG)) & (so <= min(most, LONG))], k):
                        for col, x in zip(out, (row, place, int(rows[i]), given[i], int(s[i]))):
                            col.append(x)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(x, t) for x, t in zip(out, kinds)], ["anchor", "place", "row", "id", "score"])

    return run


def in_blocks(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, width: int, run, schema: str) -> DataFrame:
    """``run`` over every pair of a slice of all rows and a block of anchors; vectors have ``width`` components at most."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    most = max(1, VALUES // max(1, width))
    blocks = -(-max(1, n_anchors) // min(ANCHOR_BLOCK, most))
    slices = max(-(-max(1, n_rows) // min(SLICE, most)), -(-2 * cores // blocks))
    number = F.xxhash64("row")
    left = rows.withColumn("slice", F.pmod(number, F.lit(slices)).cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    anchors = anchors.select([F.col(c).alias(c) for c in anchors.columns])  # columns of their own: both sides come from one table
    right = anchors.withColumn("block", F.pmod(number, F.lit(blocks)).cast("int")) \
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice")).applyInArrow(run, schema)


def first_rows(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, k_positives: int = K_POSITIVES, k_negatives: int = K_NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """Hard negatives of the anchors among ``quantised`` rows.

    For each anchor, the first ``k_positives`` other rows of its label; for each of those,
    the first ``k_negatives`` rows of other labels whose score is ``low`` to ``high`` per
    cent of the positive's.
    """
    anchors = rows.where(is_anchor)
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_anchor).alias("anchors"), F.max(F.size("v")).alias("width")).first()
    counts = size["rows"], size["anchors"], size["width"] or 0
    found = in_blocks(rows, anchors, *counts, positives_of_block(k_positives), POSITIVES)
    near = saved(first_rows(found, k_positives, "anchor"), "positives", narrow=True)
    listed = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("p"))
    held = anchors.join(listed.withColumnRenamed("anchor", "row"), "row") \
        .withColumn("positives", F.transform("p", lambda p: p["score"])).drop("p")
    found = in_blocks(rows, held, *counts, negatives_of_block(k_negatives, low, high), NEGATIVES)
    negatives = first_rows(found, k_negatives, "anchor", "place").select(
        "anchor", (F.col("place") + 1).alias("nth"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    positive = near.select("anchor", F.col("rank").alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return negatives.join(positive, ["anchor", "nth"]).join(named, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """The registered query: relabelled by id, ids divisible by 100 as anchors."""
    vec_id, label = F.col("vec_id"), F.col("label")
    relabelled = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(quantised(vectors, relabelled), F.col("id") % 100 == 0)
