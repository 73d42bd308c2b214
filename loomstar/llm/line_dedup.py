"""Line dedup (1): exact and one-word-edit duplicates of lines, the earliest one stays.

A line is the lower-cased (A-Z) sequence of its words.  A line goes if an
earlier line (by document id, then line number) is equal, or, for lines of
``NEAR_WORDS`` words or more, is within one word edit of it (a word replaced,
inserted or left out).

* Equal lines: one grouping by a 64-bit sequence hash.  Lines that occur very often meet
  their first occurrence where they are read, the others in a shuffle.
* Near lines, by the deletion neighbourhood: two lines are one edit apart just if
  they are equal after leaving out one word at the same place, or if one equals
  the other without one of its words.  Every line emits these variants as hashed
  keys; a grouping by key finds the earliest line of each, so a large group costs
  one row per line, never a pair of members.  The pair (line, earliest) found is
  verified by its edit distance on the words.
* One edit leaves the first or the second half of a line as it is, so only lines
  that share a half with another line emit variants, and only for the other half.
  The shared halves reach the tasks as a bitmap of fixed size (``2 ** BITS``
  bits); a false hit costs variants, never a wrong result.

Defined results: NULL and blank texts have no lines with words and stay as they
are; lines of fewer than ``MIN_WORDS`` words are never dropped; rows with a NULL
id keep all lines and are not compared; rows that share an id count as one
document.  Other columns stay, whatever their names; the counts of ``dedup_lines``
replace columns of their names.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.shared import SPACES, hidden, marked, saved, ship, shown
from loomstar.llm.wordhash import BASE, NOT_SPACE, mix, pieces, powers, words

ship(__name__)

MIN_WORDS = 4       # shorter lines stay
NEAR_WORDS = 8      # lines from this length on may differ by one word
BITS = 26           # of the bitmap of shared halves: 8 MB
MOST_HOT = 20_000   # lines that may count as very frequent: those with more than this part of all lines
MAX_LISTS = 500_000 # documents whose lists of lines may be broadcast, with four lines each on average (20 MB)
MARKS = 26          # bits of the hashes by which documents, lines and variants are marked before a shuffle
PIECE_LINES = 1 << 20   # bytes of lines whose variants are made at once: those take some forty times the lines' bytes
Q = 0xD1342543DE82EF95
Q_INVERSE = pow(Q, -1, 1 << 64)
_GAP = re.compile(r"[\x20\x09-\x0D]+")


class Lines:
    """Lines of a batch of texts with hashes of any run of their words, or of a line without one word."""

    def __init__(self, col: pa.Array):
        found = words(col, NOT_SPACE)
        self.found = found
        rows = found.offsets[:-1]
        breaks = np.flatnonzero(found.buf == 10) + 1
        starts = np.concatenate([rows, breaks])
        row = np.concatenate([np.arange(len(rows)), np.searchsorted(found.offsets, breaks - 1, side="right") - 1])
        order = np.lexsort((starts, row))
        starts, self.row = starts[order], row[order]
        self.first = np.searchsorted(found.start, starts)
        ends = np.append(starts[1:], len(found.buf))
        self.last = np.searchsorted(found.start, ends)
        self.n = self.last - self.first
        begin = np.searchsorted(self.row, np.arange(len(rows)))
        self.no = np.arange(len(starts)) - begin[self.row] if len(starts) else np.zeros(0, np.int64)
        m = len(found.hash) + 2
        self.sums = np.zeros(m, np.uint64)
        np.cumsum(mix(found.hash) * powers(Q, m)[:m - 2], out=self.sums[1:m - 1])
        self.sums[m - 1] = self.sums[m - 2]
        self.shift = powers(Q_INVERSE, m)

    def run(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.shift[a] + (b - a).astype(np.uint64) * np.uint64(BASE))

    def without(self, a: np.ndarray, b: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Hash of words ``a..b`` without word ``i``: equal to ``run`` over an equal sequence."""
        raw = (self.sums[i] - self.sums[a]) * self.shift[a] + (self.sums[b] - self.sums[i + 1]) * self.shift[a + 1]
        return mix(raw + (b - a - 1).astype(np.uint64) * np.uint64(BASE))

    def halves(self) -> np.ndarray:
        """Four keys a line: first and second half by its own length, then by that of a line one word shorter."""
        out = []
        for less in (0, 1):
            n = np.maximum(self.n - less, 0)
            head = n // 2
            tag = mix(n.astype(np.uint64) * np.uint64(4))
            out.append(mix(self.run(self.first, self.first + head) + tag))
            out.append(mix(self.run(self.last - (n - head), self.last) + tag + np.uint64(1)))
        return np.stack(out, axis=1)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64, copy=False).view(np.int64))


def _line_rows(batches):
    for batch in pieces(batches, 1):
        lines = Lines(batch.column(1))
        use = np.flatnonzero(lines.n >= MIN_WORDS)
        whole = lines.run(lines.first, lines.last)[use]
        # the halves of a line that comes again in this piece are the same
        near = np.zeros(len(use), bool)
        near[np.unique(whole, return_index=True)[1]] = True
        near &= lines.n[use] >= NEAR_WORDS
        keys = lines.halves()[use][near].reshape(-1)
        ends = np.concatenate([[0], np.cumsum(np.where(near, 4, 0))]).astype(np.int32)
        docs = batch.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs[lines.row[use]], pa.int64()), pa.array(lines.no[use].astype(np.int32)),
             pa.array(lines.n[use].astype(np.int32)), _long(whole),
             pa.ListArray.from_arrays(pa.array(ends), _long(keys))],
            names=["doc", "line", "n", "h", "halves"])


def _candidates(batches, bitmap):
    """Lines that share a half with another one: their words, and which of the four halves."""
    bits = bitmap.value
    for batch in pieces(batches, 1):
        lines = Lines(batch.column(1))
        keys = lines.halves() & np.uint64((1 << BITS) - 1)
        hit = (bits[(keys >> np.uint64(6)).astype(np.int64)] >> (keys & np.uint64(63))) & np.uint64(1)
        mask = (hit * np.array([1, 2, 4, 8], np.uint64)).sum(axis=1).astype(np.int32)
        use = np.flatnonzero((lines.n >= NEAR_WORDS) & (mask > 0))
        docs, found = batch.column(0).to_numpy(zero_copy_only=False), lines.found
        whole = lines.run(lines.first, lines.last)
        texts = [found.buf[found.start[lines.first[x]]:found.end[lines.last[x] - 1]].tobytes().lower().decode("utf-8", "replace")
                 for x in use]
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs[lines.row[use]], pa.int64()), pa.array(lines.no[use].astype(np.int32)),
             pa.array(lines.n[use].astype(np.int32)), _long(whole[use]), pa.array(mask[use]), pa.array(texts, pa.string())],
            names=["doc", "line", "n", "h", "mask", "words"])


def _variants(batches):
    """Keys of each line's variants; kind 0: one word left out at a place, 1: whole line, 2: one word left out."""
    for batch in pieces(batches, 0, most=PIECE_LINES):
        lines = Lines(batch.column(0))
        n, mask = lines.n, batch.column(1).to_numpy()
        a, b = lines.first, lines.last
        line = np.repeat(np.arange(len(n)), n)
        i = np.arange(len(line)) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        variant = lines.without(a[line], b[line], a[line] + i)
        m, size = mask[line], n[line]
        same = ((m & 1) > 0) & (i >= size // 2) | ((m & 2) > 0) & (i < size // 2)
        head = (size - 1) // 2
        less = ((m & 4) > 0) & (i >= head) | ((m & 8) > 0) & (i <= head)
        whole = np.flatnonzero(mask & 3)
        key = np.concatenate([
            mix(variant[same] + mix(i[same].astype(np.uint64) + np.uint64(17))),
            mix(lines.run(a[whole], b[whole]) + np.uint64(5)), mix(variant[less] + np.uint64(5))])
        of = np.concatenate([line[same], whole, line[less]])
        kind = np.concatenate([np.zeros(same.sum(), np.int8), np.ones(len(whole), np.int8), np.full(less.sum(), 2, np.int8)])
        first = pa.array(of)
        yield pa.RecordBatch.from_arrays(
            [_long(key), pa.array(kind), batch.column(2).take(first), batch.column(3).take(first), batch.column(4).take(first)],
            names=["key", "kind", "doc", "line", "h"])


def edit_at_most_one(x: list[str], y: list[str]) -> bool:
    """Whether one word replaced, inserted or left out turns ``x`` into ``y`` (or none)."""
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    p = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), len(x))
    return x[p + 1:] == y[p + 1:] if len(x) == len(y) else x[p:] == y[p + 1:]


def _verify(batches):
    for batch in pieces(batches, 1, 2):
        ok = [edit_at_most_one(_GAP.split(x), _GAP.split(y)) for x, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0)], names=["h"]).filter(pa.array(ok, pa.bool_()))


def _bitmap(keys: DataFrame) -> np.ndarray:
    """A bitmap of the keys' last ``BITS`` bits; at most ``2 ** (BITS - 6)`` rows reach the driver."""
    bit = F.col("key").bitwiseAND(F.lit((1 << BITS) - 1))
    rows = keys.select(F.shiftright(bit, 6).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(key & 63 as int))").alias("m")) \
        .groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[rows.column("w").to_numpy()] = rows.column("m").to_numpy().view(np.uint64)
    return out


def near_lines(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``h`` of the lines that have an earlier line within one edit."""
    spark = docs.sparkSession
    shared = rows.select("h", F.explode("halves").alias("key")).groupBy("key") \
        .agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("key")
    bitmap = spark.sparkContext.broadcast(_bitmap(shared))
    found = docs.mapInArrow(partial(_candidates, bitmap=bitmap), "doc long, line int, n int, h long, mask int, words string")
    lines = saved(found.groupBy("h", "n").agg(F.min(F.struct("doc", "line")).alias("f"), F.max("mask").alias("mask"),
                                             F.min_by("words", F.struct("doc", "line")).alias("words")), "lines")
    keys = saved(lines.select("words", "mask", "f.doc", "f.line", "h").mapInArrow(
        _variants, "key long, kind byte, doc long, line int, h long"), "variants")
    # most variants are of one line only: of the others, which are marked, the earliest of each kind is sought
    often = keys.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("key")
    keys = saved(marked(keys, F.col("key"), often, MARKS).where("marked").drop("marked"), "shared-variants")
    me = F.struct("doc", "line", "h")
    best = keys.groupBy("key").agg(*[F.min(F.when(F.col("kind") == k, me)).alias(f"m{k}") for k in range(3)],
                                   F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi")
    other = F.when(F.col("kind") == 0, F.col("m0")).when(F.col("kind") == 1, F.col("m2")).otherwise(F.col("m1"))
    pairs = keys.join(best, "key").withColumn("e", other).where(F.col("e") < me).where("e.h <> h") \
        .groupBy("h").agg(F.min("e").alias("e")).select("h", F.col("e.h").alias("eh"))
    text = lines.select("h", "words").dropDuplicates(["h"])
    both = pairs.join(text, "h").join(text.select(F.col("h").alias("eh"), F.col("words").alias("ewords")), "eh")
    return both.select("h", "words", "ewords").mapInArrow(_verify, "h long")


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, drop)``: for each document with any, the numbers (from 0) of the lines that go."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).where("doc IS NOT NULL")
    rows = saved(texts.mapInArrow(_line_rows, "doc long, line int, n int, h long, halves array<long>"), "rows")
    near = saved(near_lines(texts, rows), "near").select("h", F.lit(True).alias("near"))
    place = F.struct("doc", "line")
    firsts = rows.groupBy("h").agg(F.min(place).alias("f"), F.max(place).alias("l"), F.count(F.lit(1)).alias("times")) \
        .join(near, "h", "left").where("f < l OR near")
    firsts = saved(firsts.select("h", "f", "near", "times"), "firsts", narrow=True)
    often = max(1, rows.count() // MOST_HOT)
    place_of = rows.select("doc", "line", "h")
    # at most MOST_HOT lines occur more often than that: their rows are decided before the shuffle
    hot = firsts.where(F.col("times") > often).select("h", F.col("f").alias("hf"), F.col("near").alias("hnear"), F.lit(True).alias("hot"))
    split = place_of.join(F.broadcast(hot), "h", "left")
    decided = split.where(F.col("hot") & (F.col("hnear") | (place > F.col("hf")))).select("doc", "line")
    few = firsts.where(F.col("times") <= often)
    rest = marked(split.where(F.col("hot").isNull()).select("doc", "line", "h"), F.col("h"), few.select("h"), MARKS) \
        .where("marked").drop("marked").join(few, "h")
    gone = decided.unionByName(rest.where(F.col("near") | (place > F.col("f"))).select("doc", "line"))
    return saved(gone.groupBy("doc").agg(F.array_sort(F.collect_set("line")).alias("drop")), "gone")


def _deduplicated(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` (``hidden``) with the duplicate lines taken out, and the two counts."""
    gone = duplicate_lines(docs, id_col, text_col).select(F.col("doc").alias("_gone_doc"), F.col("drop").alias("_drop"))
    same = F.col(id_col).cast("long") == F.col("_gone_doc")
    size = gone.agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size("_drop")).alias("lines")).first()
    if size["docs"] <= MAX_LISTS and (size["lines"] or 0) <= 4 * MAX_LISTS:
        rows = docs.join(F.broadcast(gone), same, "left").drop("_gone_doc")
    else:
        # only documents that lose lines meet their lists in a shuffle: the others stay where they are read
        docs = marked(docs, F.col(id_col), gone.select("_gone_doc"), MARKS)
        losing, whole = (docs.where(m).drop("marked") for m in ("marked", "NOT marked"))
        rows = losing.join(gone, same, "left").drop("_gone_doc") \
            .unionByName(whole.withColumn("_drop", F.lit(None).cast("array<int>")))
    lines = F.split(F.col(text_col), "\n", -1)
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_drop")),
                                    lambda i: F.get(lines, i)), "\n")
    return rows.withColumn("_n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("long")) \
        .withColumn("_n_dropped", F.coalesce(F.size("_drop"), F.lit(0)).cast("long")) \
        .withColumn(text_col, F.when(F.col("_drop").isNull(), F.col(text_col)).otherwise(kept))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the duplicate lines taken out of the text, and ``_n_lines`` and ``_n_dropped``."""
    rows, names = hidden(docs)
    return shown(_deduplicated(rows, names[id_col], names[text_col]), names, "_n_lines", "_n_dropped")


def keep_first_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without duplicate lines; documents that lost lines and have no word left go."""
    rows, names = hidden(docs)
    rows = _deduplicated(rows, names[id_col], names[text_col])
    return shown(rows.where((F.col("_n_dropped") == 0) | (F.translate(names[text_col], SPACES, "") != "")), names)
