"""Line dedup, near-dedup, decontamination and quality rules against plain Python."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from loomstar.llm import decontaminate, line_dedup, near_dedup, quality_rules
from loomstar.llm.shared import table
from tests.llm import helpers

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, kept string, value string"


def base_text(n, word="w"):
    return " ".join(f"{word}{i}" for i in range(n))


def edited(n, *at):
    return " ".join(f"x{i}" if i in at else f"w{i}" for i in range(n))


#: NULL, blank, short, equal, near, chained and repeated rows, mixed case and line breaks; ids out of order.
HARD = [
    (50, None), (51, ""), (52, " \n\t "), (53, "one"), (54, "ONE"), (55, "a b c"), (56, "a b c d"),
    (9, base_text(60)), (8, base_text(60).upper()), (7, edited(60, 30)), (6, edited(60, 5, 50)), (5, edited(60, 5, 50, 20)),
    (4, "alpha beta gamma delta epsilon zeta eta theta\nsecond line"),
    (3, "ALPHA beta gamma delta epsilon zeta eta theta\nother"),
    (2, "alpha beta gamma delta epsilon zeta eta\nnew"), (1, "alpha beta gamma delta XXX zeta eta theta"),
    (10, "x y z w\nx y z w\n\nx y z w\n"), (11, "é à ü ß 中文 字 a b c d e"), (12, "é à ü ß 中文 字 a b c d f"),
    (13, "na na " * 3000), (14, "na na " * 3000 + "end"), (15, ("long line " * 2000).strip()),
]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(i, t, "k", "v") for i, t in HARD], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["hard", "docs"])
def test_near_duplicates(which, request):
    df = request.getfixturevalue(which)
    got = {r[0]: (r[1], r[2]) for r in near_dedup.near_duplicates(df).collect()}
    assert got == helpers.components(pairs(df))


def test_near_duplicates_hot_group(spark):
    """A group of graded copies, and short texts around one passage that are mostly not linked."""
    rows = [(0, base_text(100))]
    rows += [(i, edited(100, *[(i * 7 + 13 * k) % 100 for k in range(i % 9)])) for i in range(1, 120)]
    rows += [(1000 + i, base_text(40, "p") + " " + base_text(3 + i % 12, f"own{i}_")) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in near_dedup.near_duplicates(df).collect()}
    assert got == helpers.components(rows)


def test_near_duplicates_edges(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "q r s"), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(near_dedup.near_duplicates(df).collect(), key=str)
    assert len(got) == 5
    by = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in got}
    assert by == {(None, 2): (3, False), (3, 2): (3, True), (None, 1): (None, False), (4, 0): (4, True)}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(empty).count() == 0
    assert near_dedup.keep_one(empty).count() == 0


def test_keep_one_decides_rows_without_id(spark):
    """Rows without an id come last; one of several copies stays if no copy has an id."""
    rows = [(None, base_text(60), "a"), (3, edited(60, 30), "b"), (None, base_text(60, "q"), "c"), (None, base_text(60, "q"), "c"),
            (None, base_text(60, "q") + " end", "c"), (None, base_text(60, "z"), "d"), (None, " ", "e"), (None, " ", "e"), (None, None, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, v string")
    out = near_dedup.keep_one(df)
    assert out.columns == df.columns and sorted(r["v"] for r in out.collect()) == ["b", "c", "d", "e", "e", "f"]


def test_keep_one_keeps_columns(hard):
    out = near_dedup.keep_one(hard)
    want = {i for i, (_, c) in helpers.components(HARD).items() if c == i}
    assert out.columns == hard.columns and {r[0] for r in out.collect()} == want


@pytest.mark.parametrize("which", ["hard", "docs"])
def test_line_dedup(which, request):
    df = request.getfixturevalue(which)
    got = {r["doc_id"]: (r["_n_lines"], r["_n_dropped"], r["text"]) for r in line_dedup.dedup_lines(df).collect()}
    assert got == helpers.line_dedup(pairs(df))


def test_line_dedup_edges(spark):
    line = "one two three four five"
    df = spark.createDataFrame([(None, line), (None, line), (2, line), (1, line), (1, line), (3, None)], "doc_id long, text string")
    got = sorted([(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(df).collect()], key=str)
    assert got == sorted([(None, line), (None, line), (1, line), (1, line), (2, ""), (3, None)], key=str)
    assert {r["doc_id"] for r in line_dedup.keep_first_lines(df).collect()} == {None, 1, 3}
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_near_lines_split_words_at_ascii_white_space_only(spark):
    rows = [(1, "a b c d e f g\u3000h\u00a0i j"), (2, "a b c d e f x\u3000y\u00a0z j")]
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    got = {r["doc_id"]: (r["_n_lines"], r["_n_dropped"], r["text"]) for r in line_dedup.dedup_lines(df).collect()}
    assert got == helpers.line_dedup(rows) and got[2][1] == 1


@pytest.mark.parametrize("x,y,near", [("a b c", "a b c", True), ("a b c", "a x c", True), ("a b c", "a c", True),
                                      ("a b c", "c b a", False), ("a b", "a b c d", False), ("a b c d", "b c d a", False)])
def test_edit_distance(x, y, near):
    assert line_dedup.edit_at_most_one(x.split(), y.split()) is near
    assert line_dedup.edit_at_most_one(y.split(), x.split()) is near


ITEMS = [(1, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13"), (10, "ONE"), (2, "a, b. c!"), (3, None), (4, ""), (5, "absent words here"),
         (6, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (7, "na na na na na na na na na na na na")]


def test_contamination(spark, hard, docs):
    bench = table(spark, SF, "benchmark")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    got = sorted(map(tuple, decontaminate.contamination(docs, bench).collect()))
    assert got == sorted(helpers.contamination(pairs(docs), items)) and any(r[-1] for r in got)
    own = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(map(tuple, decontaminate.contamination(hard, own).collect()))
    assert got == sorted(helpers.contamination(HARD, ITEMS)) and sum(r[-1] for r in got) > 5
    left = decontaminate.keep_clean(hard, own)
    assert left.columns == hard.columns
    assert {r[0] for r in left.collect()} == {r[0] for r in got if not r[-1]}


def test_keep_clean_decides_every_text(spark):
    """Rows without an id and several texts of one id are decided by their own text."""
    rows = [(None, "x one y", "a"), (None, "clean", "b"), (None, "clean", "c"), (7, "ONE", "d"), (7, "also clean", "e"), (8, None, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, v string")
    own = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = decontaminate.keep_clean(df, own)
    assert left.columns == df.columns and {r["v"] for r in left.collect()} == {"b", "c", "e", "f"}


def test_contamination_edges(spark, hard):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontaminate.contamination(hard, none).collect())
    rows = spark.createDataFrame([(1, "one"), (1, "one"), (None, "one")], "doc_id long, text string")
    own = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert [r["n_hit"] for r in decontaminate.contamination(rows, own).collect()] == [1, 1, 1]
    assert decontaminate.contamination(rows.limit(0), own).count() == 0


@pytest.mark.parametrize("which", ["hard", "docs"])
def test_quality_counts(which, spark, request):
    df = request.getfixturevalue(which)
    rows = quality_rules.quality_report(df, table(spark, SF, "labels")).collect()
    want = {i: helpers.base_counts(t) for i, t in pairs(df)}
    assert {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows} == want
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["rule"] is None)


def test_rules_separate_labelled_rows(spark):
    """Learned rules find a planted cause and leave the other rows alone."""
    rows = [(i, " ".join(f"w{i}x{k}" + ("###" if i % 4 == 0 else "") for k in range(60 + i % 30))) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, 240)], "doc_id long, quality int")
    rules = quality_rules.learn_rules(quality_rules.labelled_sample(docs, labels, "doc_id", "text"))
    assert rules
    kept = {r[0] for r in quality_rules.judge(docs, rules, out="q").where("q.kept").select("doc_id").collect()}
    assert kept == {i for i, _ in rows if i % 4}
    assert quality_rules.learn_rules(quality_rules.labelled_sample(docs, labels.limit(0), "doc_id", "text")) == []
    plan = quality_rules.judge(docs, rules, out="q")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_rules_find_toxic_rows(spark):
    """Toxic rows count as bad whatever their quality, and only their words tell them from the others."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(60)) + (" Trash, such idiot! they" if i % 4 == 0 else " Fine, such people! they"))
            for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 if i % 8 else None, int(i % 4 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    rules = quality_rules.learn_rules(quality_rules.labelled_sample(docs, labels, "doc_id", "text"))
    new = [(1000 + i, " ".join(f"z{i}y{k}" for k in range(70)) + (" an IDIOT, trash." if i % 2 else " an uncle, there.")) for i in range(20)]
    judged = quality_rules.judge(docs.union(spark.createDataFrame(new, docs.schema)), rules, out="q")
    kept = {r[0] for r in judged.where("q.kept").select("doc_id").collect()}
    assert kept == {i for i, _ in rows if i % 4} | {i for i, _ in new if i % 2 == 0}
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def memory_of(run):
    """What ``run`` returns and the bytes that Python and numpy held at most meanwhile."""
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_sketches_and_links_hold_pieces_of_a_batch():
    """A worker's memory does not grow with the rows of an Arrow batch or the length of their texts."""
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    texts = [None, "", "a b"] + [" ".join(r.choices(vocabulary, k=900)) for _ in range(4000)] + [" ".join(r.choices(vocabulary, k=10 ** 6)), "a b"]
    docs = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc", "text"])
    kept = []

    _, most = memory_of(lambda: [kept.extend(b.column(1).to_pylist()) for b in near_dedup._sketch_batches([docs])])
    assert docs.get_total_buffer_size() > 25 << 20 and most < 180 << 20
    assert kept[:3] == [0, 0, 1] and kept[-1] == 1 and kept[3] == len({tuple(w) for w in zip(*(texts[3].split()[i:] for i in range(5)))})
    n = 2000
    pairs = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(n)), pa.array(texts[3:n + 3]),
                                        pa.array(texts[3:n + 2] + ["other words"])], names=["a", "b", "ta", "tb"])
    got, most = memory_of(lambda: [a for b in near_dedup._linked([pairs]) for a in b.column(0).to_pylist()])
    assert got == list(range(n - 1)) and most < 120 << 20


def test_lines_hold_pieces_of_a_batch():
    """Neither the rows of an Arrow batch nor the length of their texts decide what a worker of line dedup holds."""
    r = random.Random(6)
    vocabulary = [f"w{i}" for i in range(5000)]
    line = lambda k: " ".join(r.choices(vocabulary, k=k))
    long = line(10 ** 6)
    texts = [None, "", "a b"] + ["\n".join(line(30) for _ in range(30)) for _ in range(4000)] + [long, "a b"]
    docs = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc", "text"])
    every = type("Broadcast", (), {"value": np.full(1 << (line_dedup.BITS - 6), (1 << 64) - 1, np.uint64)})
    rows, found = [], []

    _, most = memory_of(lambda: [rows.append(b.select(["doc", "line", "h"])) for b in line_dedup._line_rows([docs])])
    assert docs.get_total_buffer_size() > 20 << 20 and most < 180 << 20
    _, held = memory_of(lambda: [found.append(b.select(["doc", "line", "h"])) for b in line_dedup._candidates([docs], every)])
    assert held < 180 << 20
    rows, found = (pa.Table.from_batches(x) for x in (rows, found))
    assert rows.num_rows == 4000 * 30 + 1 and rows.equals(found)
    assert rows.column("doc").to_pylist()[::30] == [*range(3, 4003), 4003] and rows.column("line").to_pylist()[:30] == list(range(30))
    n = 10_000
    texts = [line(100) for _ in range(n)]
    lines = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([15] * n, pa.int32()), pa.array(range(n)), pa.array([0] * n, pa.int32()),
                                        pa.array(range(n))], names=["words", "mask", "doc", "line", "h"])
    sizes, most = memory_of(lambda: [(b.num_rows, b.column(2)[0].as_py(), b.column(2)[-1].as_py()) for b in line_dedup._variants([lines])])
    # a line of 100 words: 100 with one left out at a place, itself, 100 and one of both halves without a word
    assert most < 80 << 20 and sum(x for x, _, _ in sizes) == n * 201 and sizes[0][1] == 0 and sizes[-1][2] == n - 1
    pairs = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(texts), pa.array(texts[:-1] + ["other words"])], names=["h", "a", "b"])
    assert [h for b in line_dedup._verify([pairs]) for h in b.column(0).to_pylist()] == list(range(n - 1))
