"""Benchmark decontamination (3): prefix-filtered join of item windows with documents.

Every run of ``WINDOW`` consecutive words of an item is a window (a shorter item
is one window).  To hold a window, a document must hold all its three-word
shingles, so its rarest one is a sufficient prefix:

1. Corpus counts of the items' shingles order them by rarity (one pass over all
   texts; a bitmap of fixed size says which shingles to count).
2. A window's prefix is its rarest shingle; a window with a shingle that no text
   has cannot occur and leaves.
3. A second pass emits each place where a prefix shingle occurs, with the words
   around it; places are joined with the windows on the shingle, the positional
   and length bounds are applied (the window must fit at that offset), and the
   words are compared exactly.  Only places travel, never texts.

Defined results: NULL and blank texts have no words and no hits; repeated rows get
equal results; items without words have no windows; equal windows of several
items count for each of them; items with a NULL id hit words but are not listed.
``keep_clean`` takes texts with a hit out by id and fingerprint, so rows with a NULL id
are decided like all others, and so is each text of an id that has several.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.shared import broadcast_bounded, hidden, saved, ship, shown
from loomstar.llm.wordhash import ALNUM, shingles, words

ship(__name__)

WINDOW = 10
Q = 3                # words of a shingle; shorter windows are one shingle
BITS = 24            # of the bitmaps of shingles: 2 MB
MAX_BROADCAST_IDS = 500_000


def _windows(batches, size: int = WINDOW):
    for batch in batches:
        found = words(batch.column(1), ALNUM)
        items, texts, keys = [], [], []
        for r in range(batch.num_rows):
            lo, hi = found.first[r], found.first[r + 1]
            if lo == hi:
                continue
            own = [_lower(found.text(i)) for i in range(lo, hi)]
            n = min(size, hi - lo)
            for i in range(hi - lo - n + 1):
                items.append(batch.column(0)[r].as_py())
                texts.append(own[i:i + n])
                keys.append(shingles(found.hash[lo + i:lo + i + n], min(Q, n)).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), pa.array(texts, pa.list_(pa.string())), pa.array(keys, pa.list_(pa.int64()))],
            names=["item", "words", "keys"])


def _lower(text: str) -> str:
    """Lower-case A-Z only."""
    return text.encode().lower().decode()


def _hits(found, bits: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and keys of the shingles of ``q`` words that the bitmap has, within texts."""
    keys = shingles(found.hash, q)
    low = keys & np.uint64((1 << BITS) - 1)
    at = np.flatnonzero((bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1))
    row = np.searchsorted(found.first, at, side="right") - 1
    at = at[at + q <= found.first[row + 1]]
    return at, keys[at]


def _count_keys(batches, bitmap, lengths: list[int]):
    for batch in batches:
        found = words(batch.column(0), ALNUM)
        for q in lengths:
            _, keys = _hits(found, bitmap.value, q)
            key, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])


def _places(batches, bitmap, lengths: list[int], size: int = WINDOW):
    """A row for each text: its word count, a fingerprint, and the places of prefix shingles with words around."""
    for batch in batches:
        found = words(batch.column(1), ALNUM)
        rows = batch.num_rows
        pos, key, before, around, of = [], [], [], [], []
        for q in lengths:
            at, keys = _hits(found, bitmap.value, q)
            row = np.searchsorted(found.first, at, side="right") - 1
            for i, k, r in zip(at.tolist(), keys.view(np.int64).tolist(), row.tolist()):
                first, last = int(found.first[r]), int(found.first[r + 1])
                lo = max(first, i - size + 1)
                pos.append(i - first)
                key.append(k)
                before.append(i - lo)
                around.append([_lower(found.text(j)) for j in range(lo, min(last, i + size))])
                of.append(r)
        order = np.argsort(np.array(of, np.int64), kind="stable")
        ends = np.searchsorted(np.array(of, np.int64)[order], np.arange(rows + 1)).astype(np.int32)
        places = pa.StructArray.from_arrays(
            [pa.array(pos, pa.int32()), pa.array(key, pa.int64()), pa.array(before, pa.int32()),
             pa.array(around, pa.list_(pa.string()))], names=["pos", "key", "before", "around"]).take(pa.array(order))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(found.first)), batch.column(2),
             pa.ListArray.from_arrays(pa.array(ends), places)], names=["doc_id", "n_words", "print", "places"])


PLACES = "doc_id long, n_words long, print long, places array<struct<pos:int,key:long,before:int,around:array<string>>>"


def _bitmap(keys: DataFrame):
    """A broadcast bitmap of the keys' last bits; ``2 ** (BITS - 6)`` rows at most reach the driver."""
    bit = F.col("key").bitwiseAND(F.lit((1 << BITS) - 1))
    rows = keys.select(F.shiftright(bit, 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("m")) \
        .groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[rows.column("w").to_numpy()] = rows.column("m").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(out)


def prefix_windows(texts: DataFrame, items: DataFrame) -> tuple[DataFrame, list[int]]:
    """``(key, offset, words, items)``: every window that can occur, under its rarest shingle."""
    windows = saved(items.mapInArrow(_windows, "item long, words array<string>, keys array<long>")
                    .groupBy("words").agg(F.collect_set("item").alias("items"), F.first("keys").alias("keys")), "windows")
    lengths = sorted(r[0] for r in windows.select(F.least(F.size("words"), F.lit(Q))).distinct().collect())  # 1 to Q
    keys = windows.select("words", "items", F.posexplode("keys").alias("offset", "key"))
    counts = texts.select("text").mapInArrow(
        partial(_count_keys, bitmap=_bitmap(keys), lengths=lengths), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    rare = keys.join(counts, "key", "left").groupBy("words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "offset")).alias("p"), F.first("items").alias("items"))
    return saved(rare.where("p.n > 0").select("p.key", "p.offset", "words", "items"), "prefixes"), lengths


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For each document: words, words inside occurrences of windows, and the items that these are from."""
    return _judged(docs, benchmark, id_col, text_col, item_col, item_text_col).drop("print")


def _judged(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame:
    """``contamination`` with ``print``, the fingerprint of each text."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("print"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text"))
    prefixes, lengths = prefix_windows(texts, items)
    rows = saved(texts.mapInArrow(partial(_places, bitmap=_bitmap(prefixes), lengths=lengths), PLACES), "places")

    place = rows.where(F.size("places") > 0).select("doc_id", "n_words", "print", F.explode("places").alias("x")) \
        .select("doc_id", "n_words", "print", "x.*")
    fits = place.join(prefixes, "key").withColumn("size", F.size("words")).withColumn("start", F.col("pos") - F.col("offset")) \
        .where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")) & (F.col("offset") <= F.col("before")))
    exact = fits.where(F.slice("around", F.col("before") - F.col("offset") + 1, F.col("size")) == F.col("words"))
    spans = F.array_sort(F.collect_set(F.struct("start", "size")))
    found = exact.groupBy("doc_id", "print", "n_words").agg(
        spans.alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")), lambda a, s: F.struct(
        F.greatest(a["end"], s["start"] + s["size"]).alias("end"),
        (a["hit"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(a["end"], s["start"]))).alias("hit")))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    found = found.select(F.col("doc_id").alias("_d"), F.col("print").alias("_p"), covered["hit"].alias("hit"),
                         F.size("items").alias("n"), F.array_join(names, ",").alias("names"))
    all_ = rows.select("doc_id", "n_words", "print").join(
        found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("print") == F.col("_p")), "left")
    return all_.select(
        "doc_id", "print", "n_words", F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("names", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("hit", F.lit(0)) > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with all their columns."""
    docs, names = hidden(docs)
    own, text = names[id_col], names[text_col]
    gone = saved(_judged(docs, benchmark, own, text, "item_id", "text").where("contaminated")
                 .select(F.col("doc_id").alias("_gone_id"), F.col("print").alias("_gone_print")).distinct(), "leaks")
    same = docs[own].cast("long").eqNullSafe(F.col("_gone_id")) & (F.xxhash64(docs[text]) == F.col("_gone_print"))
    return shown(docs.join(broadcast_bounded(gone, MAX_BROADCAST_IDS), same, "left_anti"), names)
