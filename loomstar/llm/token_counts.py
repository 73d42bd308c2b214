"""Token counts (8): a byte-fallback BPE vocabulary compiled into a counting transducer.

The last token of the tokenization of every prefix determines the tokenization:
a token ``t`` may follow the last token ``p`` of the prefix before it just if the
merges leave ``p t`` as it is.  So a deterministic transducer reads characters
and keeps only the starts that a longer piece can still reach: for each, the
place in the piece trie, the last token there and its token count relative to
the present one.  Every transition is annotated with the tokens it adds (merging
may take some away).  States are made when first reached and numbered; only
``MAX_STATES`` are kept, then the table starts anew (results don't change).

No piece has a space mark after another character, and characters without a
piece (line breaks are) are bytes that never merge, so a space after a non-space
and such a character reset the transducer.  A chunk's state map is therefore its head (up
to its first reset, read from whatever state comes in), the count between its
resets, and its tail (from the last reset).  Two maps compose into one, which is
associative: texts are cut into chunks of ``CHUNK`` characters, each chunk gets
its map in whichever task has it, and the maps of a text are composed pairwise,
level by level, as a prefix scan does.

Defined results: NULL texts count as empty, empty texts have no tokens, repeated
rows get equal results (each its own row).
"""

from __future__ import annotations

import re
import sys
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.shared import ship

ship(__name__)

CHUNK = 1 << 16          # characters of a chunk
LIMIT = 4096             # tokens; documents beyond are marked
MAX_STATES = 400_000
MAX_WORDS = 150_000      # segments in each of two generations whose counts a worker remembers
SPACE = "▁"


class Transducer:
    """Counts the tokens of a segment (spaces, then non-spaces) of normalised text."""

    def __init__(self, pieces: dict[str, float]):
        self.score = pieces
        self.trie: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        for p in pieces:
            node = 0
            for c in p:
                if c not in self.trie[node]:
                    self.trie[node][c] = len(self.trie)
                    self.trie.append({})
                    self.ends.append(None)
                node = self.trie[node][c]
            self.ends[node] = p
        self.pairs: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        """Only the start state: nothing read, one start, no token before it."""
        self.states: dict[tuple, int] = {((0, "", 0),): 0}
        self.keys: list[tuple] = [((0, "", 0),)]
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]

    def merged(self, text: str) -> list[str]:
        """The merges themselves, on a text of two pieces at most."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, last: str, token: str) -> bool:
        """Whether ``token`` can come after ``last`` (the empty string: at a start)."""
        known = self.pairs.get((last, token))
        if known is None:
            known = self.merged(last + token) == ([last, token] if last else [token])
            self.pairs[last, token] = known
        return known

    def step(self, state: int, c: str) -> tuple[int, int]:
        """Next state, and the tokens that this transition adds."""
        live, last, count = [], c, 1 << 30
        for node, before, n in self.keys[state]:
            nxt = self.trie[node].get(c)
            if nxt is None:
                continue
            live.append((nxt, before, n))
            token = self.ends[nxt]
            if token is not None and self.follows(before, token):
                last, count = token, n + 1
        if count == 1 << 30:  # a character without a piece: the caller counts its bytes and resets
            raise KeyError(c)
        key = tuple((node, before, n - count) for node, before, n in live if self.trie[node]) + ((0, last, 0),)
        new = self.states.get(key)
        if new is None:
            new = self.states[key] = len(self.keys)
            self.keys.append(key)
            self.arcs.append({})
        return new, count

    def count(self, segment: str) -> int:
        if len(self.keys) > MAX_STATES:
            self.reset()
            if len(self.pairs) > MAX_STATES:
                self.pairs.clear()
        state, total, arcs = 0, 0, self.arcs
        for c in segment:
            arc = arcs[state].get(c)
            if arc is None:
                if c not in self.trie[0] or self.ends[self.trie[0][c]] is None:
                    total += len(c.encode("utf-8", "replace"))
                    state = 0
                    continue
                arc = arcs[state][c] = self.step(state, c)
            state, more = arc
            total += more
        return total


def load_pieces(model: str) -> tuple[dict[str, float], re.Pattern]:
    """Pieces with their scores, and the pattern of the segments between resets."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))}
    inner = [p for p in pieces if SPACE in p.lstrip(SPACE)]
    if inner:
        raise ValueError(f"pieces with a space mark after another character: {inner[:3]}")
    if any("\n" in p for p in pieces):
        raise ValueError("pieces with a line break")
    return pieces, re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+")


#: A chunk's state map: (head, has a reset, count between resets, tail); without a reset all is head.
StateMap = tuple[str, bool, int, str]


class Counter:
    """State maps of chunks, with the counts of segments remembered."""

    def __init__(self, model: str):
        pieces, self.segments = load_pieces(model)
        self.transducer = Transducer(pieces)
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def tokens(self, segment: str) -> int:
        """Remembered in two generations: when the newer one is full, it becomes the older one."""
        n = self.known.get(segment)
        if n is None:
            n = self.older.get(segment)
            if n is None:
                n = self.transducer.count(segment)
            if len(self.known) >= MAX_WORDS:
                self.known, self.older = {}, self.known
            self.known[segment] = n
        return n

    def map_of(self, chunk: str) -> StateMap:
        """Resets lie before a space after a non-space, and around line breaks; the outer segments may go on in other chunks."""
        found = self.segments.findall(chunk)
        if len(found) < 2:
            return chunk, False, 0, ""
        total = 0
        for s in found[1:-1]:
            n = self.known.get(s)
            total += self.tokens(s) if n is None else n
        return found[0], True, total, found[-1]

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        if not a[1]:
            if not b[1]:
                return self._joined(a[0] + b[0])
            head = self._joined(a[0] + b[0])
            return (head[0], True, head[2] + self.tokens(head[3]) + b[2], b[3]) if head[1] else (head[0], True, b[2], b[3])
        middle = self._joined(a[3] + b[0])
        if not b[1]:
            return (a[0], True, a[2] + self.tokens(middle[0]) + middle[2], middle[3]) if middle[1] else (a[0], True, a[2], middle[0])
        inside = self.tokens(middle[0]) + middle[2] + (self.tokens(middle[3]) if middle[1] else 0)
        return a[0], True, a[2] + inside + b[2], b[3]

    def _joined(self, text: str) -> StateMap:
        return self.map_of(text)

    def total(self, maps: list[StateMap]) -> int:
        """Tokens of a text from the maps of its chunks in order: composed pairwise, level by level."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        head, reset, n, tail = maps[0]
        return (self.tokens(head) if head else 0) + (n + self.tokens(tail) if reset else 0)


def worker_counter(model: str) -> Counter:
    """The counter of this worker process: its next tasks go on with what it has compiled."""
    kept = sys.__dict__.setdefault("_token_counters", {})
    if model not in kept:
        kept[model] = Counter(model)
    return kept[model]


def normalised(chunk: str, first: bool) -> str:
    """Spaces are marked; a text begins with one."""
    return (SPACE if first else "") + chunk.replace(" ", SPACE)


MAPS = "doc_id long, print long, n_bytes long, n_chunks int, chunk int, head string, reset boolean, n long, tail string"


def _maps(batches, model: str):
    counter = worker_counter(model)
    for batch in batches:
        no, text = batch.column(4).to_pylist(), batch.column(5).to_pylist()
        maps = [counter.map_of(normalised(t, i == 0)) if t else ("", False, 0, "") for i, t in zip(no, text)]
        whole = batch.column(3).to_pylist()
        # the only chunk of a text is done here
        maps = [("", False, counter.total([m]) if m[0] else 0, "") if k == 1 else m for m, k in zip(maps, whole)]
        cols = list(zip(*maps)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(5)), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.bool_()),
             pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
            names=["doc_id", "print", "n_bytes", "n_chunks", "chunk", "head", "reset", "n", "tail"])


def _composed(batches, model: str):
    counter = worker_counter(model)
    for batch in batches:
        out = [counter.total([(m["head"], m["reset"], m["n"], m["tail"]) for m in maps]) if n is None else n
               for n, maps in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.int64()), batch.column(4)],
                                         names=["doc_id", "n_bytes", "n_tokens", "copies"])


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = CHUNK, limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every whole text, without begin, end or special tokens."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = F.when(F.length(text) <= chunk, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0)))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("print"),
                       F.octet_length(text).cast("long").alias("n_bytes"), cut.alias("chunks")) \
        .select("doc_id", "print", "n_bytes", F.size("chunks").alias("n_chunks"), F.posexplode("chunks").alias("chunk", "part"))
    maps = rows.mapInArrow(partial(_maps, model=model), MAPS)
    one = F.col("n_chunks") == 1
    # texts of several chunks: chunk maps (a few words each) meet in one row; equal rows count once and are repeated
    part = F.struct("chunk", "head", "reset", "n", "tail")
    key = F.when(one, F.lit(0)).otherwise(F.col("print"))
    both = maps.groupBy("doc_id", key.alias("print"), "n_bytes", "n_chunks", F.when(one, F.col("n")).alias("n_tokens")).agg(
        F.array_sort(F.collect_set(F.when(~one, part))).alias("maps"),
        F.count_if(F.col("chunk") == 0).cast("int").alias("copies"))
    # one pass over all groups: a union of the two kinds would read and count every text twice
    return both.select("doc_id", "n_bytes", "n_tokens", "maps", "copies") \
        .mapInArrow(partial(_composed, model=model), "doc_id long, n_bytes long, n_tokens long, copies int") \
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
                F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")
