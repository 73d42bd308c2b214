"""Document fingerprints against plain Python: edited texts, signature sets, near sets."""

import hashlib
import random

import pytest
import regex
from pyspark.sql import functions as F

from loomstar.llm import spot_signatures as spots
from loomstar.llm.shared import table

SF = "/root/testdata/sf0.001"
SINGLE = r"\p{Script=Han}\p{Script=Hiragana}\p{Script=Katakana}\p{Script=Thai}"
WORDS = regex.compile(rf"[{SINGLE}]|[[\p{{L}}\p{{M}}\p{{N}}]--[{SINGLE}]]{{1,24}}", regex.V1)


def words(text):
    return WORDS.findall(text.lower())


def chains(text, chosen):
    """Signatures before hashing: an anchor and the content words after it."""
    w = words(text)
    if not w:
        return {text} if text else set()
    out = {("", *[x for x in w if x not in spots.COMMON][:3])}
    for i, x in enumerate(w):
        if x in spots.COMMON or x in chosen:
            out.add((x, *[y for y in w[i + 1:] if y not in spots.COMMON][:3]))
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def chosen_words(spark, texts):
    found = spark.createDataFrame([(x,) for x in {x for t in texts for x in words(t)} | {"x"}], "w string")
    return {r[0] for r in found.where(F.pmod(F.hash("w"), F.lit(spots.SHARE)) == 0).collect()}


def expected(spark, rows):
    """{sorted rows of the report without the fingerprints}"""
    order = sorted(((i is None, i or 0, t or "") for i, t in rows))
    pairs = []
    for k, (none, i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        q = len(t) // 4
        pairs.append((None if none else i, t, t[:len(t) - q] + after[:q], after))
    chosen = chosen_words(spark, [x for p in pairs for x in p[1:]])
    sets = [[chains(x, chosen) for x in p[1:]] for p in pairs]
    out = []
    for (i, t, e, _), (a, b, c) in zip(pairs, sets):
        near = sum(jaccard(a, s[0]) >= 0.75 for s in sets) - 1 if i is not None and i % 100 == 0 else None
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), round(jaccard(a, b), 9), round(jaccard(a, c), 9), near))
    return sorted(out, key=str)


def reported(df):
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9), r["n_near"])
                   for r in df.collect()), key=str)


def test_whole_table(spark):
    df = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = spots.edited_report(df).cache()
    assert reported(got) == expected(spark, rows)
    prints = {}
    for r in got.collect():
        t = dict(rows)[r["doc_id"]]
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert (r["near_edited"] == 1) == (r["fingerprint"] == r["edited_fingerprint"])


ONE = "the cat sat on the mat and the old dog was in a garden with red flowers that grew by it"
EDGES = [
    (5, None), (6, ""), (7, " \n"), (8, "???"), (9, "x"), (10, "the of and"), (11, ONE), (12, ONE), (13, ONE.replace("red", "blue")),
    (14, "中文字。日本語のテスト"), (15, "é" * 100 + " ñ"), (100, ONE), (200, None), (300, "???"), (400, "long words " * 4000), (500, "🙂 a\n\tb c"),
    (16, "word " * 3), (None, "no id the first"), (None, "no id the second"), (None, "no id the second"),
]


def test_edges(spark):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in EDGES], "doc_id long, text string, id string, times int, print string").repartition(3)
    got = spots.edited_report(df)
    # rows of one id are ordered by a hash of their text: compare those with distinct ids before them
    assert len(got.collect()) == len(EDGES)
    single = [r for r in EDGES if r[0] is not None]
    assert reported(spots.edited_report(df.where("doc_id IS NOT NULL"))) == expected(spark, single)
    assert spots.edited_report(df.where("false")).collect() == []


def test_equal_rows_follow_each_other(spark):
    rows = [(1, ONE)] * 4 + [(2, "another text of the same kind with more words in it")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert reported(spots.edited_report(df)) == expected(spark, rows)
    assert reported(spots.edited_report(df.limit(1))) == expected(spark, rows[:1])


@pytest.mark.parametrize("bound", [spots.MAX_BROADCAST, 0])
def test_near_sets_of_a_hot_group(spark, monkeypatch, bound):
    """A large group of graded copies, copies, and one passage that all documents share."""
    monkeypatch.setattr(spots, "MAX_BROADCAST", bound)
    rnd = random.Random(5)
    base = [f"{rnd.choice(['the', 'of', 'and', 'in'])} w{i} v{i} u{i}" for i in range(60)]
    rows = []
    for i in range(240):
        own = list(base)
        for k in range(i % 12):
            own[(i * 7 + 11 * k) % 60] = f"to x{i} y{k}"
        rows.append((i * 25, " ".join(own)))
    rows += [(10_000 + i, " ".join(base)) for i in range(50)]
    rows += [(20_000 + 50 * i, " ".join(base[:20]) + " " + " ".join(f"the a{i}x{k} b{i}x{k}" for k in range(i % 9))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    chosen = chosen_words(spark, [t for _, t in rows])
    sets = {i: chains(t, chosen) for i, t in rows}
    want = {i: sum(jaccard(s, x) >= 0.75 for x in sets.values()) - 1 for i, s in sets.items() if i % 100 == 0}
    got = {r["id"]: r["n_near"] for r in spots.near_counts(spots.keyed(df, "doc_id", "text")).collect()}
    assert got == want


def test_no_python_on_the_main_path(spark):
    df = table(spark, SF, "documents").where("doc_id < 50")
    plan = spots.edited_report(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
