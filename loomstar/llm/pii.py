"""Personal data (6): patterns, and a semi-Markov conditional random field that adds spans.

Four patterns give the base spans.  Around digits, at-signs and what follows a key word (``password:``), a
semi-Markov CRF looks at whole candidate spans (their characters, digit groups, checksum, the
word before, what touches their ends), scores each as one entity of one kind, and
a dynamic program over spans of up to ``MAX_ATOMS`` atoms picks the best set of
boundaries and kinds at once.  Spans that it finds beside the base ones are
added: numbers without their prefix, cards that fail the checksum, secrets (those without a digit
after ``=``, or with signs or mixed case inside).

The CRF is trained here by the gradient of its log-likelihood, on regions of a
bounded hash sample of the documents (``SAMPLE_DOCS``, ``SAMPLE_REGIONS``).  Its
gold spans are the base spans and secrets after a key word; regions are also
shown with the prefix of their phone numbers left out, and filled up with a few
made-up examples of each kind, so that every kind can be learned from any input.

Defined results: NULL and empty texts have no spans; repeated rows get equal
results; every row gives one row.  Long runs of digits, letters or signs cost
time in proportion to their length.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.shared import ship

ship(__name__)

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
SAMPLE_DOCS = 20_000       # documents looked at for training, about
SAMPLE_REGIONS = 300       # regions that the CRF is trained on, at most
EPOCHS = 6
MAX_ATOMS = 24             # atoms of an entity
BEFORE = 24                # characters ahead of a span in which a key word counts
MAX_REGION = 400           # atoms whose candidate spans are held at a time; the dynamic program runs on across them
KEYWORDS = ("token", "password", "passwd", "secret", "key", "apikey", "auth")

#: A key word and its sign, ahead of what may be a secret without a digit.
_KEYED = re.compile(r"(?i)\b(?:%s)\b[\"']?\s*[=:]\s*[\"']?(?=[A-Za-z_+/.-]{8})" % "|".join(KEYWORDS))
_AFTER_KEY = re.compile(r"(?i)\b(?:%s)\b[\"']?\s*([=:])\s*[\"']?$" % "|".join(KEYWORDS))
_SIGNS = re.compile(r"[A-Za-z][_+/.-]+[A-Za-z]|[a-z][A-Z]")

# The base patterns, anchored so that no start is tried twice.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end(), "email"))
            end = m.end()
        else:
            end = max(end, at + 1)  # no later local part reaches over an at-sign
        at = text.find("@", max(at + 1, end))
    return out


def small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[Span]:
    """The base spans by kind, then start."""
    out = emails(text)
    if not _DIGIT.search(text):
        return out
    out += [(*m.span(), "ip") for m in _IP.finditer(text) if small_parts(m[0])]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    if "+" in text:
        out += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


# ---- regions and their atoms -------------------------------------------------

_ATOM = re.compile(r"[A-Za-z0-9]+|\s+|.", re.S)
_SECRET = re.compile(r"(?i)\b(?:%s)\b[\"']?\s*[=:]\s*[\"']?([A-Za-z0-9_+/.-]{8,})" % "|".join(KEYWORDS))


def has_sign(text: str) -> bool:
    """Whether a key word may be followed by its sign."""
    return "=" in text or ":" in text


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around tokens with a digit or an at-sign, or after a key word: a few words before, one after, merged."""
    out: list[list[int]] = []
    at, n = 0, len(text)
    hit = re.compile("[0-9@]")
    keyed = (m.end() for m in _KEYED.finditer(text)) if has_sign(text) else iter(())
    key = next(keyed, n)
    while at < n:
        m = hit.search(text, at)
        while key < at:
            key = next(keyed, n)
        place = min(m.start() if m else n, key)
        if place == n:
            break
        start, end = place, place + 1
        floor = out[-1][1] if out else 0
        gaps = 0
        while start > floor and gaps < 4 and place - start < 200:  # back over the token and three words
            start -= 1
            gaps += text[start].isspace() and not text[start - 1:start].isspace()
        while end < n and not text[end].isspace() and end - place < 400:
            end += 1
        if out and start <= out[-1][1] + 1:
            out[-1][1] = end
        else:
            out.append([start, end])
        at = end
    return [(a, b) for a, b in out]


def atoms(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in _ATOM.finditer(text, start, end)]


def _bucket(n: int) -> str:
    return next((str(k) for k in (0, 3, 6, 7, 9, 11, 15, 19) if n <= k), "20+")


def features(text: str, a: int, b: int, before: str) -> tuple[str, ...]:
    """Features of a whole candidate span ``text[a:b]``; ``before`` is the text ahead of it in the region."""
    s = text[a:b]
    digits = sum(c.isdigit() for c in s)
    letters = sum(c.isalpha() for c in s)
    out = ["bias", f"digits {_bucket(digits)}"]
    edge = (a > 0 and text[a - 1].isalnum()) + 2 * (b < len(text) and text[b].isalnum())
    if edge:
        out.append(f"edge {edge}")
    if "@" in s:
        whole = s.count("@") == 1 and s[0] not in "@." and _DOMAIN.fullmatch(s, s.index("@") + 1) is not None
        out.append("address" if whole and all(c in _LOCAL or c == "@" for c in s) else "at")
        return tuple(out)
    numeric = letters == 0 and all(c.isdigit() or c in " ().+-" for c in s)
    if numeric:
        kind = f"number {_bucket(digits)}"
        out += [kind, "balanced" if s.count("(") == s.count(")") else "open", f"first {'d' if s[0].isdigit() else s[0]}",
                f"last {'d' if s[-1].isdigit() else s[-1]}"]
        groups = len(_CARD.findall(s)) if "." not in s else s.count(".") + 1
        out.append(f"dots {min(s.count('.'), 4)}")
        if s.count(".") == 3 and _IP.fullmatch(s) and small_parts(s):
            out.append("quad")
        elif " " in s or "(" in s or "-" in s:
            out.append(f"grouped {_bucket(digits)}")
        if 13 <= digits <= 19 and "(" not in s and "." not in s:
            out.append("checksum" if luhn(re.sub(r"[^0-9]", "", s)) else "no checksum")
        if "  " in s or groups > 6:
            out.append("loose")
        return tuple(out)
    dense = not any(c.isspace() for c in s) and len(s) >= 8
    word = re.findall(r"[A-Za-z]+", before[-BEFORE:])
    key = bool(word) and word[-1].lower() in KEYWORDS and bool(re.search(r"[=:]\s*[\"']?$", before))
    if dense and letters and digits:
        out.append("mixed" + (" long" if len(s) >= 16 else ""))
        if key:
            out.append("keyed")
    elif dense and letters and key:
        # a word may follow a key word in any sentence
        out.append("keyed " + ("assigned" if "=" in before[-3:] else "signs" if _SIGNS.search(s) else "word"))
        if text[b:b + 1] in ("-", "_", "/", "+", ".") and text[b + 1:b + 2].isalnum():
            out.append("cut")
    out.append("text" if not dense else "dense")
    if not s.replace("_", "").replace("-", "").isalnum():
        out.append("signs")
    return tuple(out)


def candidates(text: str, at: list[tuple[int, int]], lo: int = 0, hi: int | None = None) -> list[tuple[int, int, tuple[str, ...]]]:
    """Candidate spans (first atom, end atom, features): begin and end on no white space, hold a digit or an at-sign.

    Those that begin at atoms ``lo`` to ``hi``; features look at up to ``BEFORE`` characters ahead of a span.
    """
    out = []
    hi = len(at) if hi is None else min(hi, len(at))
    some = range(lo, min(len(at), hi + MAX_ATOMS))
    marked = {i: any(c.isdigit() or c == "@" for c in text[at[i][0]:at[i][1]]) for i in some}
    blank = {i: text[at[i][0]].isspace() for i in some}
    start = at[0][0] if at else 0
    for i in range(lo, hi):
        if blank[i] or text[at[i][0]] in ",;:!?\"'=)":
            continue
        a = at[i][0]
        # after a key word, a token without a digit counts from eight characters on
        keyed = a > start and text[a - 1] in "=: \"'" and _AFTER_KEY.search(text[max(start, a - BEFORE):a]) is not None
        seen = False
        gaps = 0
        for j in range(i, min(len(at), i + MAX_ATOMS)):
            if blank[j]:
                gaps += 1
                if "\n" in text[at[j][0]:at[j][1]] or gaps > 5:
                    break
                continue
            seen = seen or marked[j] or keyed and not gaps and at[j][1] - a >= 8
            if seen and text[at[j][1] - 1] not in ",;:!?\"'=(":
                out.append((i, j + 1, features(text, at[i][0], at[j][1], text[max(start, at[i][0] - BEFORE):at[i][0]])))
    return out


Weights = dict[str, tuple[float, ...]]


def scores(feats: tuple[str, ...], weights: Weights) -> list[float]:
    total = [0.0] * len(KINDS)
    for f in feats:
        w = weights.get(f)
        if w is not None:
            for k in range(len(KINDS)):
                total[k] += w[k]
    return total


def _add(ending: dict[int, list[tuple[int, float, int]]], spans, weights: Weights) -> None:
    """The best kind of each span that scores above 0, under the span's end."""
    for i, j, feats in spans:
        s = scores(feats, weights)
        k = max(range(len(KINDS)), key=s.__getitem__)
        if s[k] > 0:
            ending.setdefault(j, []).append((i, s[k], k))


def _advance(best: list[float], back: list, ending: dict[int, list[tuple[int, float, int]]], hi: int) -> None:
    """Carry the dynamic program on to atom ``hi``."""
    for j in range(len(best), hi + 1):
        best.append(best[j - 1])
        back.append(None)
        for i, s, k in ending.pop(j, ()):
            if best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, (i, j, k)


def _chosen(back: list) -> list[tuple[int, int, int]]:
    out, j = [], len(back) - 1
    while j > 0:
        if back[j]:
            out.append(back[j])
            j = back[j][0]
        else:
            j -= 1
    return out[::-1]


def decode(n: int, spans: list[tuple[int, int, tuple[str, ...]]], weights: Weights) -> list[tuple[int, int, int]]:
    """The best set of disjoint spans with kinds: an atom outside scores 0, a span its features' weights."""
    ending: dict[int, list[tuple[int, float, int]]] = {}
    best, back = [0.0], [None]
    _add(ending, spans, weights)
    _advance(best, back, ending, n)
    return _chosen(back)


def decode_region(text: str, at: list[tuple[int, int]], weights: Weights) -> list[tuple[int, int, int]]:
    """``decode`` over all candidates of a region, of which ``MAX_REGION`` atoms' are held at a time."""
    ending: dict[int, list[tuple[int, float, int]]] = {}
    best, back = [0.0], [None]
    for lo in range(0, len(at), MAX_REGION):
        _add(ending, candidates(text, at, lo, lo + MAX_REGION), weights)
        _advance(best, back, ending, min(len(at), lo + MAX_REGION))
    return _chosen(back)


# ---- training ----------------------------------------------------------------

#: Made-up regions, one of each kind, that training always sees.
EXAMPLES = ("write to some.one@mail.example.com or", "from 10.20.30.40 came", "card 4111 1111 1111 1111 paid",
            "card 4111111111111111 paid", "call +1 (202) 555-0143 now", "call +44 20 7946 0958 now",
            "the token = \"9f86d081884c7d659a2feaa0c55ad015\" is", "in password=hunter2hunter2 there",
            "password: correct-horse-battery is", "token=abcdefghijklmnop now", "the key: something that opens", "auth: NotForEveryone here",
            "secret: blue-river-stone and", "passwd=openthegate then", "a token: remember that one", "apikey = \"qwertyuiopas\" is",
            "in 1999 there were 12 of 300 left", "version 2.10 and 3.5 of", "room 12-14 at 10 pm", "sum 1,200.50 due")


def gold_spans(text: str) -> list[Span]:
    out = [(a, b, k) for a, b, k in base_spans(text)]
    out += [(*m.span(1), "secret") for m in _SECRET.finditer(text)
            if _DIGIT.search(m[1]) or _SIGNS.search(m[1]) or "=" in text[max(0, m.start(1) - 3):m.start(1)]]
    chosen: list[Span] = []
    for s in sorted(out, key=lambda s: (s[0] - s[1], s[0])):
        if all(s[1] <= c[0] or s[0] >= c[1] for c in chosen):
            chosen.append(s)
    return chosen


def _example(text: str, gold: list[Span]):
    at = atoms(text, 0, len(text))
    first, last = {a: i for i, (a, _) in enumerate(at)}, {b: i + 1 for i, (_, b) in enumerate(at)}
    spans = candidates(text, at)
    index = {(i, j): x for x, (i, j, _) in enumerate(spans)}
    truth = {}
    for a, b, k in gold:
        x = index.get((first.get(a), last.get(b)))
        if x is not None:
            truth[x] = KINDS.index(k)
    return len(at), spans, truth


def train(texts: list[str], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-3) -> Weights:
    """Weights that raise the log-likelihood of the gold segmentations (AdaGrad, forward-backward over spans)."""
    data = []
    for t in texts:
        gold = gold_spans(t)
        data.append(_example(t, gold))
        for a, b, k in gold:
            if k == "phone" and (m := re.match(r"\+[0-9]+[ -]", t[a:b])):
                cut = t[:a] + t[a + m.end():]
                data.append(_example(cut, [(a, b - m.end(), "phone")] if len(gold) == 1 else gold_spans(cut)))
    weights: dict[str, list[float]] = {}
    seen: dict[str, list[float]] = {}
    kinds = range(len(KINDS))
    for _ in range(epochs):
        for n, spans, truth in data:
            s = [scores(f, weights) for _, _, f in spans]
            alpha, beta = [0.0] * (n + 1), [0.0] * (n + 1)
            ends, starts = {}, {}
            for x, (i, j, _) in enumerate(spans):
                top = max(s[x])
                total = top + math.log(sum(math.exp(v - top) for v in s[x]))
                ends.setdefault(j, []).append((i, total))
                starts.setdefault(i, []).append((j, total))
            for j in range(1, n + 1):
                vals = [alpha[j - 1], *(alpha[i] + v for i, v in ends.get(j, ()))]
                top = max(vals)
                alpha[j] = top + math.log(sum(math.exp(v - top) for v in vals))
            for i in range(n - 1, -1, -1):
                vals = [beta[i + 1], *(beta[j] + v for j, v in starts.get(i, ()))]
                top = max(vals)
                beta[i] = top + math.log(sum(math.exp(v - top) for v in vals))
            change: dict[str, list[float]] = {}
            for x, (i, j, feats) in enumerate(spans):
                p = [math.exp(min(0.0, alpha[i] + s[x][k] + beta[j] - alpha[n])) for k in kinds]
                if x in truth or max(p) > 1e-4:
                    for f in feats:
                        g = change.setdefault(f, [0.0] * len(KINDS))
                        for k in kinds:
                            g[k] += (truth.get(x) == k) - p[k]
            for f, g in change.items():
                w, q = weights.setdefault(f, [0.0] * len(KINDS)), seen.setdefault(f, [1e-6] * len(KINDS))
                for k in kinds:
                    d = g[k] - decay * w[k]
                    q[k] += d * d
                    w[k] += rate * d / math.sqrt(q[k])
    return {f: tuple(w) for f, w in weights.items()}


# ---- over documents ----------------------------------------------------------

def find_spans(text: str, weights: Weights) -> tuple[list[Span], list[Span]]:
    """Base spans, and the spans that the CRF adds beside them."""
    base = base_spans(text)
    added: list[Span] = []
    taken = sorted((a, b) for a, b, _ in base)
    for start, end in regions(text):
        at = atoms(text, start, end)
        for i, j, k in decode_region(text, at, weights):
            a, b = at[i][0], at[j - 1][1]
            if all(b <= x or a >= y for x, y in taken):
                added.append((a, b, KINDS[k]))
    return base, added


def _named(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (KINDS.index(s[2]), s[0], s[1])))


def _report(batches, weights: Weights):
    mark = re.compile("[0-9@]")
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            base, added = find_spans(text, weights) if text and (mark.search(text) or has_sign(text)) else ([], [])
            rows.append((*(sum(k == s[2] for s in base) for k in BASE_KINDS), sum(s[2] == "secret" for s in added), len(base) + len(added),
                         hashlib.sha256(_named(base).encode()).hexdigest(), _named(base + added)))
        cols = list(zip(*rows)) or [()] * 8
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:6]), *(pa.array(c, pa.string()) for c in cols[6:])],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_secret", "n_spans", "base_sha256", "spans"])


def _sample(batches):
    for batch in batches:
        out = [t[a:b] for t in batch.column(0).to_pylist() if t for a, b in regions(t) if b - a <= 300]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["region"])


def learn(docs: DataFrame, text_col: str = "text") -> Weights:
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    some = docs.select(F.col(text_col).alias("text")).where(
        F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    found = some.mapInArrow(_sample, "region string").distinct().orderBy(F.xxhash64("region"), "region").limit(SAMPLE_REGIONS)
    return train([*EXAMPLES * 3, *(r[0] for r in found.collect())])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: Weights | None = None) -> DataFrame:
    """Counts and hash of the base spans, the secrets and spans found in all, and the names of all spans, for every whole text."""
    weights = learn(docs, text_col) if weights is None else weights
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        partial(_report, weights=weights),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_secret long, n_spans long, base_sha256 string, spans string")
