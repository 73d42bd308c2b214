"""Plain-Python versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = {i: i + 32 for i in range(65, 91)}


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate(LOWER)


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def components(rows):
    """{doc_id: (set size, smallest id reachable)} over Jaccard >= 0.75 of 5-word shingles."""
    sets, inverted = {}, defaultdict(list)
    for i, text in rows:
        w = space_words(lower(text))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        for s in sets[i]:
            inverted[s].append(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in inverted[x] if j > i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def contamination(docs, items, size=10):
    windows = defaultdict(set)
    for i, text in items:
        w = alnum_words(text)
        n = min(size, len(w))
        for j in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[j:j + n])].add(i)
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w, hit, names = alnum_words(text), set(), set()
        for n in lengths:
            for j in range(len(w) - n + 1):
                found = windows.get(tuple(w[j:j + n]))
                if found:
                    hit |= set(range(j, j + n))
                    names |= found
        listed = ",".join(sorted(str(x) for x in names))
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return out


def base_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = space_words(text)
    where = defaultdict(list)
    for i in range(len(w) - 2):
        where[tuple(w[i:i + 3])].append(i)
    hit = {i + k for v in where.values() if len(v) > 1 for i in v for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if space_words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def line_dedup(rows, min_words=4, near_words=8):
    """{doc_id: (n_lines, n_dropped, text)}: every line against all earlier ones."""
    lines = []
    for i, text in sorted(r for r in rows if r[0] is not None):
        for k, line in enumerate((text or "").split("\n")):
            w = tuple(space_words(lower(line)))
            if len(w) >= min_words:
                lines.append((i, k, w))
    first = {}
    for i, k, w in lines:
        first.setdefault(w, (i, k))
    whole, holes, shorter = {}, defaultdict(list), defaultdict(list)
    near = {w: f for w, f in first.items() if len(w) >= near_words}
    for w, f in near.items():
        for j in range(len(w)):
            holes[j, w[:j] + w[j + 1:]].append(f)
            shorter[w[:j] + w[j + 1:]].append(f)
        whole[w] = f
    gone = defaultdict(set)
    for i, k, w in lines:
        f = first[w]
        bad = f < (i, k)
        if len(w) >= near_words:
            cut = [w[:j] + w[j + 1:] for j in range(len(w))]
            bad = bad or any(min(holes[j, c]) < f for j, c in enumerate(cut)) or \
                any(c in whole and whole[c] < f for c in cut) or any(x < f for x in shorter.get(w, ()))
        if bad:
            gone[i].add(k)
    out = {}
    for i, text in rows:
        parts = (text or "").split("\n")
        drop = gone.get(i, set())
        out[i] = (len(parts) if text is not None else 0, len(drop),
                  text if not drop else "\n".join(x for k, x in enumerate(parts) if k not in drop))
    return out
