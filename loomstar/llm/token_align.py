"""Cross-tokenizer alignment (13): groups of tokens between common boundaries, as an associative monoid.

Both tokenizations of a text cover the same bytes.  Offsets where tokens of both
end cut them into groups; all A-B token pairs of a group are links.

A chunk of a text gives a fragment: an open prefix (text before the first safe cut), the
closed groups between its safe cuts, and an open suffix.  A cut is safe where both
tokenizers always begin a new token whatever lies around it: before a space or line
break after a non-space, and between a letter and a digit, if no piece of B spans
that.  So ``(p1, C1, s1) + (p2, C2, s2) = (p1, C1 + groups(s1 p2) + C2, s2)``, a fragment without a
cut is all open text, and composing is associative.  Long texts are cut into chunks that
spread over tasks; their fragments are composed level by level, ``FAN`` neighbours at
a time.  Texts of one chunk are finished where they are read.

Pair counts are document frequencies over the whole corpus, one grouped sum over
the distinct pairs of each text; counts and the highest count of every A id are joined
back to the texts' pairs and summed there.

Defined results: NULL and empty texts, and texts that either tokenizer changes (the space
mark U+2581 stands for a space), have no tokens, and zeros; a stretch without a safe
cut is encoded as one; repeated rows and rows without an id are documents of their own;
other columns are not looked at.
"""

from __future__ import annotations

import re
import sys
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.shared import broadcast_bounded, saved, ship

ship(__name__)

CHUNK = 1 << 16          # characters of a chunk
FAN = 8                  # neighbouring fragments that one composition takes
AT_A_TIME = 1 << 18      # characters whose new segments are encoded together
MAX_SEGMENTS = 100_000   # segments beyond which a worker forgets what it has encoded, before its next texts
TOGETHER = 100           # segments in one call text of the tokenizers
SMALL_GROUP = 64         # links of a group that are listed one by one
MAX_BROADCAST = 4_000_000  # rows (24 bytes each) of the pair counts that may be broadcast


def byte_table() -> dict[str, int]:
    """Which byte each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Groups of segments, by a byte-level BPE (A) and a piece BPE with byte fallback (B)."""

    def __init__(self, a_file: str, b_file: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        table = byte_table()
        size = self.a.get_vocab_size()
        self.a_bytes = [b""] * size
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            known = all(c in table for c in token)
            self.a_bytes[i] = bytes(table[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.n_b = len(pieces)
        self.span = len(self.a_bytes) * self.n_b
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # ids as text with what follows them: inside a group, at the end of its A part, of the group, of the segment
        self.a_shown = [np.array([f"{i}{c}" for i in range(len(self.a_bytes))], object) for c in ",|"]
        self.b_shown = [np.array([f"{i}{c}" for i in range(self.n_b)], object) for c in (",", ";", "")]
        self.cut = self._safe_cut([p for i, p in enumerate(pieces) if not self.b.is_byte(i)])
        self.forget()

    @staticmethod
    def _safe_cut(pieces: list[str]) -> re.Pattern:
        """Positions where A's pattern always ends a token and no piece of B goes on."""
        beside = {x + y for p in pieces for x, y in zip(p, p[1:])}
        if any("\n" in x or (x[1] == "▁" and x[0] != "▁") for x in beside):
            raise ValueError("pieces that span a word's end can't be aligned in fragments")
        rules = [r"(?<=\S)(?=[ \n])"]
        if not any(x.isascii() and x[0].isalpha() and x[1].isdigit() for x in beside):
            rules.append("(?<=[A-Za-z])(?=[0-9])")
        marks = "，。、；：？！"  # noqa: RUF001
        if not any(x[1] in marks and x[0] > "⹿" for x in beside):
            rules.append(f"(?<=[぀-ヿ一-鿿])(?=[{marks}])")
        return re.compile("|".join(rules))

    # -- segments ------------------------------------------------------------

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[str] = []                            # the groups of each segment
        self.numbers = np.zeros((0, 4), np.int64)             # its A tokens, B tokens, groups, 1 if the bytes differ
        self.ends = np.zeros(1, np.int64)                     # where its links end
        self.codes, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _keep(self, segments: list[str], texts: list[str], numbers: np.ndarray, links: np.ndarray, codes: np.ndarray, times: np.ndarray):
        self.index.update(zip(segments, range(len(self.index), len(self.index) + len(segments))))
        self.texts += texts
        self.numbers = np.concatenate((self.numbers, numbers))
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(links)))
        self.codes, self.times = np.concatenate((self.codes, codes)), np.concatenate((self.times, times))

    def _ids(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        # B puts a space before a text: a line break keeps it apart
        b = self.b.encode(["\n" + t for t in texts], num_threads=1)
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)], [x[2:] for x in b]

    def learn(self, lists: list[list[str]]) -> None:
        """Have the segments of these texts at hand."""
        if len(self.index) > MAX_SEGMENTS:
            self.forget()
        new = [s for s in set().union(*lists) if s not in self.index]
        # segments that stand together in any text are encoded in one
        odd = [s for s in new if s[0] not in " \n" or s[-1].isspace() or "▁" in s]
        if odd:
            kept = set(odd)
            new = [s for s in new if s not in kept]
        for at in range(0, len(new), 64 * TOGETHER):
            part = new[at:at + 64 * TOGETHER]
            odd += self._together(part)
        if odd:
            ids = self._ids(odd)
            for s, x, y in zip(odd, *ids):
                self._keep([s], *self._one(s.encode(), x, y))

    def _together(self, segments: list[str]) -> list[str]:
        """Groups of many segments in a few array operations; those that need another look are returned."""
        texts = ["".join(segments[i:i + TOGETHER]) for i in range(0, len(segments), TOGETHER)]
        lists_a, lists_b = self._ids(texts)
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (lists_a, lists_b))
        raw = "".join(texts).encode()
        if b"".join(map(self.a_bytes.__getitem__, ids_a.tolist())) != raw or b"".join(map(self.b_bytes.__getitem__, ids_b.tolist())) != raw:
            return segments
        ends = np.cumsum(np.fromiter((len(s) if s.isascii() else len(s.encode()) for s in segments), np.int64, len(segments)))
        end_a, end_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        at = np.searchsorted(end_b, end_a)
        last_a = np.flatnonzero(end_b[at] == end_a)
        last_b, end = at[last_a], end_a[last_a]
        of_group = np.searchsorted(ends, end)                     # the segment of each group
        if not np.array_equal(end[np.searchsorted(end, ends)], ends):
            return segments
        first_a, first_b = np.append(0, last_a[:-1] + 1), np.append(0, last_b[:-1] + 1)
        n_a, n_b = last_a - first_a + 1, last_b - first_b + 1
        links = n_a * n_b
        large = np.unique(of_group[links > SMALL_GROUP])
        # links: every A token of a group with every B token
        group = np.repeat(np.arange(len(end)), links)
        k = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
        codes = ids_a[first_a[group] + k // n_b[group]] * self.n_b + ids_b[first_b[group] + k % n_b[group]]
        # the ids as text, A before B in each group
        final = np.append(of_group[1:] != of_group[:-1], True)
        shown = np.empty(len(ids_a) + len(ids_b), object)
        of_a, of_b = np.repeat(np.arange(len(end)), n_a), np.repeat(np.arange(len(end)), n_b)
        x = self.a_shown[0][ids_a]
        x[last_a] = self.a_shown[1][ids_a[last_a]]
        shown[np.arange(len(ids_a)) + first_b[of_a]] = x
        x = self.b_shown[0][ids_b]
        x[last_b] = np.where(final, self.b_shown[2][ids_b[last_b]], self.b_shown[1][ids_b[last_b]])
        shown[np.arange(len(ids_b)) + last_a[of_b] + 1] = x
        per = np.bincount(of_group, weights=n_a + n_b, minlength=len(segments)).astype(np.int64)
        stop = np.cumsum(per).tolist()
        shown = shown.tolist()
        texts = ["".join(shown[i:j]) for i, j in zip([0, *stop], stop)]
        of_segment = [np.bincount(of_group, weights=w, minlength=len(segments)).astype(np.int64) for w in (n_a, n_b, np.ones(len(end)), links)]
        numbers = np.stack([*of_segment[:3], np.zeros(len(segments), np.int64)], axis=1)
        if len(large):
            keep = np.ones(len(segments), bool)
            keep[large] = False
            codes = codes[np.repeat(keep, of_segment[3])]
            again = [segments[i] for i in large]
            segments, texts = ([x for x, k in zip(v, keep) if k] for v in (segments, texts))
            self._keep(segments, texts, numbers[keep], of_segment[3][keep], codes, np.ones(len(codes), np.int64))
            return again
        self._keep(segments, texts, numbers, of_segment[3], codes, np.ones(len(codes), np.int64))
        return []

    def _one(self, raw: bytes, ids_a: list[int], ids_b: list[int]):
        """Groups of one segment, large ones by their distinct ids; what ``_keep`` takes."""
        bytes_a, bytes_b = [self.a_bytes[i] for i in ids_a], [self.b_bytes[i] for i in ids_b]
        none = np.zeros(0, np.int64)
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            return [""], np.array([[0, 0, 0, 1]]), np.zeros(1, np.int64), none, none
        end_a, end_b = (np.cumsum([len(x) for x in v]).tolist() for v in (bytes_a, bytes_b))
        groups, codes, times, from_a, from_b = [], [none], [none], 0, 0
        place_a, place_b = ({e: k + 1 for k, e in enumerate(v)} for v in (end_a, end_b))
        for e in end_a:
            if e in place_b:
                in_a, in_b = ids_a[from_a:place_a[e]], ids_b[from_b:place_b[e]]
                from_a, from_b = place_a[e], place_b[e]
                groups.append(f"{','.join(map(str, in_a))}|{','.join(map(str, in_b))}")
                (x, n), (y, m) = np.unique(in_a, return_counts=True), np.unique(in_b, return_counts=True)
                codes.append(np.add.outer(x.astype(np.int64) * self.n_b, y).ravel())
                times.append(np.outer(n, m).ravel())
        codes, times = summed(np.concatenate(codes), np.concatenate(times))
        return [";".join(groups)], np.array([[len(ids_a), len(ids_b), len(groups), 0]]), np.array([len(codes)]), codes, times

    def segments_of(self, text: str) -> list[str]:
        """The segments of a text that begins and ends at a safe cut: each begins with a space or line break.

        Where white space never follows white space they are words.
        """
        if not text:
            return []
        if re.search(r"\s[ \n]", text) is None and text[0] in " \n":
            parts = text.replace("\n", " \n").split(" ")
            return [x if x[:1] == "\n" else " " + x for x in parts[1:]]
        out, at = [], 0
        for m in re.finditer(r"(?<=\S)[ \n]", text):
            out.append(text[at:m.start()])
            at = m.start()
        return [*out, text[at:]]

    def groups(self, lists: list[list[str]]) -> list["Groups"]:
        """The groups of texts, each given by its segments."""
        self.learn(lists)
        sizes = np.array([len(x) for x in lists], np.int64)
        ends = np.cumsum(sizes)
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
        sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(self.numbers[at], axis=0)))
        numbers = (sums[ends] - sums[ends - sizes]).tolist()
        # links: those of all segments, sorted within each text
        links = self.ends[at + 1] - self.ends[at]
        place = np.arange(int(links.sum())) + np.repeat(self.ends[at] - (np.cumsum(links) - links), links)
        doc = np.repeat(np.repeat(np.arange(len(lists)), sizes), links)
        codes, times = summed(doc * self.span + self.codes[place], self.times[place])
        cuts = np.searchsorted(codes, np.arange(len(lists) + 1) * self.span)
        at, texts = at.tolist(), self.texts
        return [Groups(n[0], n[1], n[2], ";".join([texts[k] for k in at[e - m:e]]), codes[x:y] - d * self.span, times[x:y], not n[3])
                for d, (n, e, m, x, y) in enumerate(zip(numbers, ends.tolist(), sizes.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()))]

    def closed(self, text: str) -> "Groups":
        return self.groups([self.segments_of(text)])[0]

    # -- fragments -----------------------------------------------------------

    def fragment(self, text: str) -> "Fragment":
        """Open prefix, closed groups, open suffix of a chunk."""
        first = self.cut.search(text)
        if first is None:
            return Fragment(text)
        begin, width = first.start(), 64
        while True:  # the last cut: look back further and further
            base = max(begin, len(text) - width)
            cuts = [m.start() for m in self.cut.finditer(text, base)]
            if cuts or base == begin:
                break
            width *= 4
        end = cuts[-1] if cuts else begin
        return Fragment(text[:begin], self.closed(text[begin:end]), text[end:])

    def compose(self, x: "Fragment", y: "Fragment") -> "Fragment":
        if x.groups is None:
            return Fragment(x.prefix + y.prefix, y.groups, y.suffix) if y.groups is not None else self.fragment(x.prefix + y.prefix)
        if y.groups is None:
            tail = self.fragment(x.suffix + y.prefix)
            if tail.groups is None:
                return Fragment(x.prefix, x.groups, tail.prefix)
            return Fragment(x.prefix, x.groups.plus(self.closed(tail.prefix)).plus(tail.groups), tail.suffix)
        return Fragment(x.prefix, x.groups.plus(self.closed(x.suffix + y.prefix)).plus(y.groups), y.suffix)

    def whole(self, f: "Fragment") -> "Groups":
        """All groups of a text from its fragment."""
        head = self.closed(f.prefix)
        return head if f.groups is None else head.plus(f.groups).plus(self.closed(f.suffix))


def summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes with the sums of their times."""
    if not len(codes):
        return codes, times
    if (times == 1).all():
        codes = np.sort(codes)
        begin = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        return codes[begin], np.diff(np.append(begin, len(codes)))
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    begin = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[begin], np.add.reduceat(times, begin)


class Groups:
    """Closed groups: token and group counts, the groups as text, distinct links with how often they occur."""

    __slots__ = ("n_a", "n_b", "n_groups", "text", "codes", "times", "same")

    def __init__(self, n_a=0, n_b=0, n_groups=0, text="", codes=None, times=None, same=True):
        self.n_a, self.n_b, self.n_groups, self.text, self.same = n_a, n_b, n_groups, text, same
        self.codes = np.zeros(0, np.int64) if codes is None else codes
        self.times = np.zeros(0, np.int64) if times is None else times

    def plus(self, o: "Groups") -> "Groups":
        if not o.n_groups and o.same:
            return self
        if not self.n_groups and self.same:
            return o
        codes, times = summed(np.concatenate((self.codes, o.codes)), np.concatenate((self.times, o.times)))
        return Groups(self.n_a + o.n_a, self.n_b + o.n_b, self.n_groups + o.n_groups, f"{self.text};{o.text}", codes, times,
                      self.same and o.same)


class Fragment:
    __slots__ = ("prefix", "groups", "suffix")

    def __init__(self, prefix: str = "", groups: Groups | None = None, suffix: str = ""):
        self.prefix, self.groups, self.suffix = prefix, groups, suffix


def worker_aligner(a_file: str, b_file: str) -> Aligner:
    """The aligner of this worker process: its next tasks go on with what it has seen."""
    kept = sys.__dict__.setdefault("_token_aligners", {})
    if (a_file, b_file) not in kept:
        kept[a_file, b_file] = Aligner(a_file, b_file)
    return kept[a_file, b_file]


# -- Arrow tasks -------------------------------------------------------------

GROUPS = "n_a long, n_b long, n_groups long, n_links long, groups string, codes array<long>, times array<long>, same boolean"
READ = f"doc_id long, chunk int, n_chunks int, part string, {GROUPS}"
FRAGMENT = f"row long, doc_id long, chunk long, prefix string, suffix string, {GROUPS}"


def lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate(arrays).astype(np.int64) if arrays else np.zeros(0, np.int64))


def group_columns(found: list[Groups | None]) -> list[pa.Array]:
    """The columns of ``GROUPS``; NULLs for a fragment without a cut."""
    none = np.array([g is None for g in found], bool)
    g = [Groups() if x is None else x for x in found]
    numbers = [[x.n_a for x in g], [x.n_b for x in g], [x.n_groups for x in g], [int(x.times.sum()) for x in g]]
    return [*(pa.array(x, pa.int64(), mask=none) for x in numbers), pa.array([x.text for x in g], pa.string(), mask=none),
            lists([x.codes for x in g]), lists([x.times for x in g]), pa.array([x.same for x in g], pa.bool_(), mask=none)]


def finished(g: Groups) -> Groups:
    """A text that a tokenizer changes has no tokens."""
    return g if g.same else Groups(same=False)


def _read(batches, a_file: str, b_file: str, chunk: int):
    """Texts of one chunk are done; of longer ones, their chunks go on as rows."""
    aligner = worker_aligner(a_file, b_file)
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for begin in starts(pc.utf8_length(texts).fill_null(0).to_numpy(zero_copy_only=False), AT_A_TIME):
            doc_ids = ids[begin].to_pylist()
            values = texts[begin].to_pylist()
            short = [" " + t if t and len(t) < chunk else "" for t in values]
            found = aligner.groups([aligner.segments_of(t) for t in short])
            yield read_batch([(i, 0, 1, None, finished(g)) for i, g, t in zip(doc_ids, found, values) if not t or len(t) < chunk])
            for i, t in zip(doc_ids, values):
                if t and len(t) >= chunk:
                    n = -(-(len(t) + 1) // chunk)
                    spaced = " " + t
                    for at in range(0, n, 16):
                        yield read_batch([(i, k, n, spaced[k * chunk:(k + 1) * chunk], None) for k in range(at, min(at + 16, n))])


def starts(sizes: np.ndarray, most: int) -> list[slice]:
    """Runs of rows with about ``most`` characters each."""
    of = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(sizes)]
    return [slice(x, y) for x, y in zip(cuts, cuts[1:]) if y > x]


def read_batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, chunks, of, parts, found = zip(*rows) if rows else ((), (), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(chunks, pa.int32()), pa.array(of, pa.int32()), pa.array(parts, pa.string()),
         *group_columns(list(found))], names=[x.split()[0] for x in READ.split(", ")])


def fragment_batch(rows: list[tuple]) -> pa.RecordBatch:
    """``rows``: (row, doc_id, place, Fragment)."""
    row, ids, place, found = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(row, pa.int64()), pa.array(ids, pa.int64()), pa.array(place, pa.int64()),
         pa.array([f.prefix for f in found], pa.string()), pa.array([f.suffix for f in found], pa.string()),
         *group_columns([f.groups for f in found])], names=[x.split()[0] for x in FRAGMENT.split(", ")])


def _fragments(batches, a_file: str, b_file: str):
    aligner = worker_aligner(a_file, b_file)
    for batch in batches:
        for row, i, place, part in zip(*(c.to_pylist() for c in batch.columns)):
            yield fragment_batch([(row, i, place, aligner.fragment(part))])


def fragments_of(table: pa.Table) -> list[Fragment]:
    """The fragments of a table's rows, in the order of their places."""
    table = table.sort_by("chunk")
    out = []
    for r in table.select(["prefix", "suffix", "n_a", "n_b", "n_groups", "groups", "same"]).to_pylist():
        groups = None if r["n_a"] is None else Groups(r["n_a"], r["n_b"], r["n_groups"], r["groups"], same=r["same"])
        out.append(Fragment(r["prefix"], groups, r["suffix"]))
    for k, f in enumerate(out):
        if f.groups is not None:
            f.groups.codes, f.groups.times = (table[c][k].values.to_numpy() for c in ("codes", "times"))
    return out


def composition(a_file: str, b_file: str):
    """Compose the neighbours of one group, at most ``FAN``, in order."""
    def run(table: pa.Table) -> pa.Table:
        aligner = worker_aligner(a_file, b_file)
        found = fragments_of(table)
        one = found[0]
        for f in found[1:]:
            one = aligner.compose(one, f)
        first = table.slice(0, 1)
        place = min(table["chunk"].to_pylist()) // FAN
        return pa.Table.from_batches([fragment_batch([(first["row"][0].as_py(), first["doc_id"][0].as_py(), place, one)])])

    return run


def _wholes(batches, a_file: str, b_file: str):
    aligner = worker_aligner(a_file, b_file)
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for k, f in enumerate(fragments_of(pa.Table.from_batches([batch.append_column("at", pa.array(range(len(ids))))]))):
            yield read_batch([(ids[k], 0, 1, None, finished(aligner.whole(f)))])


# -- the operator ------------------------------------------------------------

def aligned(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK,
            groups: bool = True) -> DataFrame:
    """``(row, doc_id, n_a, n_b, n_groups, n_links, groups, groups_sha256, codes, times)`` of every whole text.

    ``codes`` are the text's distinct links, ``a * pieces of B + b``, ``times`` their occurrences.
    Without ``groups``, only their digest is written.
    """
    def digested(df: DataFrame) -> DataFrame:
        digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
        df = df.withColumn("groups_sha256", digest)
        return df if groups else df.drop("groups")

    tools = {"a_file": a_file, "b_file": b_file}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    read = saved(digested(rows.mapInArrow(partial(_read, chunk=chunk, **tools), READ))
                 .withColumn("row", F.monotonically_increasing_id()), "aligned")
    short = read.where("n_chunks = 1").drop("chunk", "n_chunks", "part")
    # the rows of a text's chunks are consecutive: the first one's number stands for the text
    parts = read.where("n_chunks > 1").select((F.col("row") - F.col("chunk")).alias("row"), "doc_id", F.col("chunk").cast("long").alias("chunk"),
                                               "part", "n_chunks")
    most = parts.agg(F.max("n_chunks")).first()[0]
    if most is None:
        return short
    spread = parts.drop("n_chunks").repartition(F.xxhash64("row", "chunk"))
    level = saved(spread.mapInArrow(partial(_fragments, **tools), FRAGMENT), "fragments")
    while most > 1:
        level = level.groupBy("row", F.floor(F.col("chunk") / FAN)).applyInArrow(composition(**tools), FRAGMENT)
        most = -(-most // FAN)
    whole = level.mapInArrow(partial(_wholes, **tools), READ).drop("chunk", "n_chunks", "part")
    # a text's row number is -1 - its place among the composed ones: no other row has it
    long = saved(digested(whole).withColumn("row", -1 - F.monotonically_increasing_id()), "aligned-long")
    return short.unionByName(long)


def pair_counts(found: DataFrame, n_b: int) -> DataFrame:
    """``(code, n, best)``: documents that hold a link, and whether its A id has no link with more."""
    counts = found.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    counts = saved(counts, "pair-counts", narrow=True)
    highest = counts.groupBy(F.expr(f"code div {n_b}").alias("a")).agg(F.max("n").alias("top"))
    return counts.join(highest, F.expr(f"code div {n_b}") == F.col("a")) \
        .select("code", "n", (F.col("n") == F.col("top")).alias("best"))


def alignment(docs: DataFrame, a_file: str, b_file: str, chunk: int = CHUNK) -> DataFrame:
    """The registered query: counts of tokens, groups and links, and of the links' corpus-wide counts."""
    import sentencepiece

    found = aligned(docs, a_file, b_file, chunk=chunk, groups=False)
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_file).get_piece_size()
    counts = saved(pair_counts(found, n_b), "pair-bests", narrow=True)
    links = found.select("row", F.explode(F.arrays_zip("codes", "times")).alias("x")).select("row", "x.codes", "x.times")
    held = links.join(broadcast_bounded(counts, MAX_BROADCAST), F.col("codes") == F.col("code"))
    sums = held.groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    narrow = found.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return narrow.join(sums, F.col("row") == F.col("_row"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
