"""Hard negatives and cross-tokenizer alignment against plain Python."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from loomstar.llm import hard_negatives, token_align
from loomstar.llm.queries import tokenizer_path
from loomstar.llm.shared import table

SF = "/root/testdata/sf0.001"


# ---- hard negatives ------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, row string, slice string, score string"


def mined(rows):
    """(anchor, positive, rank, negative, positive score, negative score), every pair looked at."""
    part = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        part.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    for k, (i, v, label) in enumerate(part):
        if i is None or i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j is None, j or 0, at) for at, (j, w, _) in enumerate(part) if at != k]
        order = sorted(scored)
        for s, _, j, at in [x for x in order if part[x[3]][2] == label][:5]:
            ps = -s
            near = [x for x in order if part[x[3]][2] != label and 80 * ps <= 100 * -x[0] <= 100 * ps][:5]
            out += [(i, part[at][0], r + 1, part[x[3]][0], ps, -x[0]) for r, x in enumerate(near)]
    return sorted(out, key=str)


def test_hard_negatives_whole_table(spark):
    df = table(spark, SF, "embeddings")
    rows = [(r[0], [float(x) for x in r[1]], r[2]) for r in df.select("vec_id", "embedding", "label").collect()]
    got = sorted(map(tuple, hard_negatives.hard_negatives(df).collect()), key=str)
    assert got == mined(rows) and got


@pytest.mark.parametrize("values", [hard_negatives.VALUES, 200])
def test_hard_negatives_edges(spark, monkeypatch, values):
    monkeypatch.setattr(hard_negatives, "VALUES", values)  # few components: many blocks and slices
    rnd = random.Random(7)
    vec = lambda: [rnd.choice([0.0, 0.25, -0.25, 0.5, 1.0]) for _ in range(4)]
    rows = [(i, vec(), rnd.randrange(3)) for i in range(0, 400, 4)]
    rows += [(0, [0.5, 0.5, 0.0, 0.0], 1)] * 3                                # repeated anchors
    rows += [(1000 + i, [0.5, 0.25, 0.0, 0.0], i % 2) for i in range(60)]     # equal vectors: ties by id
    rows += [(None, [0.5, 0.5, 0.0, 0.0], 1), (None, vec(), 2), (300, None, 1), (200, vec(), None), (100, [0.5, None], 1),
             (7, [float("nan")] * 4, 1), (14, [float("inf"), 0.0, 0.0, 0.0], 1), (21, [], 1), (28, [1.0], 2), (35, vec() + [1.0, 2.0], 2)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], VECTORS)
    got = sorted(map(tuple, hard_negatives.hard_negatives(df).collect()), key=str)
    assert got == mined(rows)
    assert hard_negatives.hard_negatives(df.where("false")).collect() == []


@pytest.mark.parametrize("largest", [3, 300, 40_000, 1 << 40, 1 << 53])
def test_packed_scores_are_exact(largest):
    rnd = random.Random(largest)
    for rows, d in ((1, 1), (7, 3), (50, 16), (3, 0)):
        m = np.array([[rnd.randint(-largest, largest) for _ in range(d)] for _ in range(rows)], np.int64).reshape(rows, d)
        a = [rnd.randint(-largest, largest) for _ in range(d)]
        packed = hard_negatives.Packed(m, min(a, default=0), max(a, default=0))
        exact = [sum(x * int(y) for x, y in zip(a, r)) for r in m]
        assert packed.scores(a).tolist() == [max(-hard_negatives.LONG, min(hard_negatives.LONG, x)) for x in exact]


# ---- cross-tokenizer alignment -------------------------------------------------

@pytest.fixture(scope="module")
def files():
    return tokenizer_path("byte_bpe_50k.json"), tokenizer_path()


@pytest.fixture(scope="module")
def whole_text_groups(files):
    """The groups of a text from the libraries' tokens of the whole text; None if a tokenizer changes it."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(files[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=files[1])
    table = token_align.byte_table()

    def groups(text):
        if not text:
            return None
        e = a.encode(" " + text, add_special_tokens=False)
        ids = b.encode(text)
        in_a = [bytes(table[c] for c in t) for t in e.tokens]
        in_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, map(b.id_to_piece, ids))]
        if b"".join(in_a) != (" " + text).encode() or b"".join(in_b) != (" " + text).encode():
            return None
        ends_a, ends_b = np.cumsum([len(x) for x in in_a]).tolist(), np.cumsum([len(x) for x in in_b]).tolist()
        out, x, y = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a.index(end, x) + 1, ends_b.index(end, y) + 1
            out.append((e.ids[x:i], ids[y:j]))
            x, y = i, j
        return out

    return groups


def text_of(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def expected(docs, whole_text_groups):
    found = [whole_text_groups(t) for _, t in docs]
    links = [Counter((p, q) for x, y in g or [] for p in x for q in y) for g in found]
    docs_with = Counter(p for c in links for p in c)
    top = defaultdict(int)
    for (p, _), n in docs_with.items():
        top[p] = max(top[p], n)
    out = []
    for (i, _), g, c in zip(docs, found, links):
        if g is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        out.append((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
                    sum(n for p, n in c.items() if docs_with[p] == top[p[0]]), sum(n * docs_with[p] for p, n in c.items()),
                    hashlib.sha256(text_of(g).encode()).hexdigest()))
    return sorted(out, key=str)


ODD = ["a", " ", "  ", "\n", "\n\n", " x  y ", "a\n\nb \n c\t d\r\n", "<|endoftext|> <s> </s> <unk> <0x41>", "x ▁ y", "naïve café 中文，字。日本語のテスト",
       "it's we'll 'sx 12ab34 a1b2", "é" * 50, "🙂🙂 👩‍👩‍👧 z", "\x00 \x01b", "a  b", "ab\x1cd e", "tail \n", "1234567890" * 30,
       "QUJD" * 200 + "9x" * 100, "w" * 5000, " lead", "\nlead", "́a ̈", "٣٤ ५"]


@pytest.mark.parametrize("chunk", [5, 64, 1 << 16])
def test_alignment_edges(spark, files, whole_text_groups, chunk):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (51, ""), (None, "no id"), (3, "same id"), (3, "same id")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, row string, chunk int").repartition(3)
    got = sorted(map(tuple, token_align.alignment(df, *files, chunk=chunk).collect()), key=str)
    assert got == expected(rows, whole_text_groups)
    assert token_align.alignment(df.where("false"), *files, chunk=chunk).collect() == []


def test_alignment_whole_table(spark, files, whole_text_groups):
    df = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    for chunk in (700, token_align.CHUNK):
        got = sorted(map(tuple, token_align.alignment(df, *files, chunk=chunk).collect()), key=str)
        assert got == expected(rows, whole_text_groups)


def test_fragments_are_associative(files, whole_text_groups):
    """Any chunks, composed in any order, give the groups of the whole text."""
    aligner = token_align.Aligner(*files)
    rnd = random.Random(3)
    for text in [*ODD, " ".join(ODD)]:
        g = whole_text_groups(text)
        spaced = " " + text
        for _ in range(6):
            cuts = sorted({0, len(spaced), *(rnd.randrange(len(spaced) + 1) for _ in range(rnd.randrange(9)))})
            parts = [aligner.fragment(spaced[x:y]) for x, y in zip(cuts, cuts[1:])]
            while len(parts) > 1:
                k = rnd.randrange(len(parts) - 1)
                parts[k:k + 2] = [aligner.compose(*parts[k:k + 2])]
            one = aligner.whole(parts[0])
            assert one.same == (g is not None)
            if g is not None:
                links = Counter(p * aligner.n_b + q for x, y in g for p in x for q in y)
                assert (one.text, one.n_a, dict(zip(one.codes.tolist(), one.times.tolist()))) == (
                    text_of(g), sum(len(x) for x, _ in g), dict(links))


def test_forgotten_segments_are_encoded_again(files, whole_text_groups, monkeypatch):
    monkeypatch.setattr(token_align, "MAX_SEGMENTS", 4)
    aligner = token_align.Aligner(*files)
    for k in range(3):
        text = " ".join(f"word{i % 23 + k}" for i in range(200))
        assert aligner.closed(" " + text).text == text_of(whole_text_groups(text))
