"""The quality classifier against a plain-Python version: statistics, evidence, host and path rates, posteriors."""

import math
import re
from collections import Counter, defaultdict

import pytest

from loomstar.llm import quality_classifier as qc
from loomstar.llm.quality_rules import MAX_WORDS, MIN_G, MIN_LEAN, MIN_SUPPORT, labelled_sample
from loomstar.llm.shared import table
from tests.llm.helpers import base_counts, space_words

SF = "/root/testdata/sf0.001"


def features(text):
    """The statistics of a text by name."""
    text = text or ""
    n, chars, symbols, dup, repeated = base_counts(text)
    lines = [x for x in text.split("\n") if space_words(x)]
    of = lambda a, b: a / b if b else 0.0
    count = lambda pattern: len(re.findall(pattern, text))
    return {"n_words": float(n), "mean_word": of(chars, n), "symbol_ratio": of(symbols, chars), "dup_line_ratio": of(dup, len(lines)),
            "repeat_ratio": of(repeated, n), "upper_ratio": of(count("[A-Z]"), chars), "mark_ratio": of(count("[!?]"), chars),
            "digit_ratio": of(count("[0-9]"), chars), "distinct_ratio": of(len(set(space_words(text))), n)}


def terms(text):
    return set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()))


def word_ratios(sample):
    good, bad = (sum(b is side for _, b in sample) for side in (False, True))
    if not good or not bad:
        return {}
    seen = defaultdict(lambda: [0, 0])
    for text, b in sample:
        for w in terms(text):
            seen[w][b] += 1
    n, found = good + bad, []
    for w, (g, b) in seen.items():
        cells = ((b, b + g, bad), (g, b + g, good), (bad - b, n - b - g, bad), (good - g, n - b - g, good))
        stat = 2 * sum(x * math.log(x * n / (row * side)) for x, row, side in cells if x)
        ratio = math.log((g + 1) / (good + 2)) - math.log((b + 1) / (bad + 2))
        if b + g >= MIN_SUPPORT and stat >= MIN_G and abs(ratio) >= MIN_LEAN:
            found.append((-stat, w, ratio))
    return {w: r for _, w, r in sorted(found)[:MAX_WORDS]}


def strength(groups, toward):
    """``groups``: (documents, good ones)."""
    n = sum(a for a, _ in groups)
    if not n or len(groups) < 2:
        return qc.MOST
    inside = sum(a * t * (1 - t) for (a, _), t in zip(groups, toward)) / n
    spread = sum(a * (g / a - t) ** 2 for (a, g), t in zip(groups, toward))
    nn = sum(a * a for a, _ in groups)
    between = (spread - len(groups) * inside) / (n - nn / n) if n * n > nn else 0.0
    return min(qc.MOST, max(qc.LEAST, inside / between - 1)) if between > 0 else qc.MOST


def classified(docs, labels, thresholds):
    """{doc_id: (evidence, host rate, path rate, posterior)} of rows (doc_id, text, source, lang)."""
    marks = {}
    for i, quality, toxic in labels:
        if i is not None and (quality is not None or toxic == 1):
            marks[i] = marks.get(i, False) or quality == 0 or toxic == 1
    sample = [(t, marks[i]) for i, t, _, _ in docs if i in marks]
    good, bad = (sum(b is side for _, b in sample) for side in (False, True))
    words = word_ratios(sample)
    at = lambda f, k: sum(x > t for t in thresholds[k]) if (x := f[qc.USED[k]]) is not None else 0
    counts = [Counter() for _ in qc.USED]
    for text, b in sample:
        f = features(text)
        for k in range(len(qc.USED)):
            counts[k][at(f, k), b] += 1
    share = (good + 1) / (good + bad + 2)
    sig = lambda x: 1 / (1 + math.exp(-x))
    evidence, p = {}, {}
    for i, text, _, _ in docs:
        f, e = features(text), 0.0
        for k in range(len(qc.USED)):
            n, b = len(thresholds[k]) + 1, at(f, k)
            if counts[k][b, False] or counts[k][b, True]:
                e += qc.TEMPER * (math.log((counts[k][b, False] + 1) / (good + n)) - math.log((counts[k][b, True] + 1) / (bad + n)))
        e += sum(qc.TEMPER * r for w, r in words.items() if w in terms(text))
        evidence[i], p[i] = e, sig(e + math.log(share / (1 - share)))
    hosts, paths = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for i, _, source, lang in docs:
        for group, key in ((hosts, source), (paths, (source, f"{source or ''}/{lang or ''}"))):
            group[key][0] += 1
            group[key][1] += p[i]
    mean = sum(p.values()) / len(p)
    k = strength(list(hosts.values()), [mean] * len(hosts))
    host = {h: (g + k * mean) / (n + k) for h, (n, g) in hosts.items()}
    k = strength(list(paths.values()), [host[h] for h, _ in paths])
    path = {key: (g + k * host[key[0]]) / (n + k) for key, (n, g) in paths.items()}
    out = {}
    for i, _, source, lang in docs:
        rate = path[source, f"{source or ''}/{lang or ''}"]
        sure = min(1 - 1e-6, max(1e-6, rate))
        out[i] = (evidence[i], host[source], rate, sig(evidence[i] + math.log(sure / (1 - sure))))
    return out


@pytest.mark.parametrize("changed", [False, True])
def test_classifier_equals_plain_python(spark, changed):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    if changed:  # NULL hosts and languages, one hot host, repeated and empty texts, one very long one
        docs = docs.selectExpr(
            "doc_id", "CASE doc_id % 20 WHEN 3 THEN NULL WHEN 4 THEN '' WHEN 5 THEN repeat(concat(text, ' '), 40) WHEN 6 THEN 'same text' ELSE text END AS text",
            "CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN 'hot' ELSE source END AS source",
            "CASE WHEN doc_id % 7 <> 0 THEN lang END AS lang", "doc_id AS _s", "'x' AS host", "1 AS p", "2 AS evidence")
    thresholds, _, _ = qc.learn_evidence(labelled_sample(docs, labels, "doc_id", "text"))
    rows = [(r["doc_id"], r["text"], r["source"], r["lang"]) for r in docs.collect()]
    want = classified(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()], thresholds)
    got = {r["doc_id"]: r for r in qc.classify(docs, labels).collect()}
    assert set(got) == set(want)
    for i, x in want.items():
        r = got[i]
        for a, b in zip((r["evidence"], r["host_posterior"], r["path_posterior"], r["posterior"]), x):
            assert abs(a - b) < 2e-9, (i, r, x)
        assert r["kept"] is (r["posterior"] >= qc.THRESHOLD) or abs(x[3] - qc.THRESHOLD) < 1e-9
    # every threshold is a quantile of the labelled rows
    marked = {r["doc_id"] for r in labels.collect()}
    values = [features(t) for i, t, _, _ in rows if i in marked]
    for k, f in enumerate(qc.USED):
        assert set(thresholds[k]) <= {v[f] for v in values}
    assert qc.classify(docs.where("false"), labels).collect() == []
