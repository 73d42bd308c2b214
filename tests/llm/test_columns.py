"""Extra columns with the names that operators use inside; ids with several texts; marked documents."""

import pytest
from pyspark.sql import functions as F

from loomstar.llm import decontaminate, line_dedup, mixing, near_dedup, quality_rules
from loomstar.llm.shared import table
from tests.llm import helpers
from tests.llm.test_filters import base_text, edited

SF = "/root/testdata/sf0.001"
CLASHES = {
    "keep_first_lines": ["_drop", "_gone_doc", "_n_lines", "_n_dropped", "doc", "h", "mark place", "caller column 1"],
    "keep_one": ["_gone_id", "_near_key", "doc_id2", "kept", "component_id"],
    "keep_clean": ["_gone_id", "_gone_print", "item_id", "print", "key"],
    "mixed": ["part", "cut", "epochs", "copies", "_size", "_key", "_s", "_ss", "_t", "_source", "_left", "rest", "key", "size"],
    "keep_good": ["_quality", "_quality_s", "_quality_v", "_v", "w", "rule"],
}


def run(spark, name, docs):
    if name == "keep_first_lines":
        return line_dedup.keep_first_lines(docs)
    if name == "keep_one":
        return near_dedup.keep_one(docs)
    if name == "keep_clean":
        return decontaminate.keep_clean(docs, table(spark, SF, "benchmark"))
    if name == "mixed":
        return mixing.mixed(docs)
    return quality_rules.keep_good(docs, table(spark, SF, "labels"))


@pytest.mark.parametrize("name", sorted(CLASHES))
def test_extra_columns_stay_whatever_their_names(spark, name):
    docs = table(spark, SF, "documents")
    extra = docs.withColumns({c: F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")) for c in CLASHES[name]})
    plain, clashing = run(spark, name, docs), run(spark, name, extra)
    assert set(clashing.columns) == {*plain.columns, *CLASHES[name]}
    assert sorted(map(str, clashing.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    for c in CLASHES[name]:
        assert clashing.where(F.col(f"`{c}`") != F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string"))).count() == 0


def test_an_id_with_several_texts_keeps_all_their_links(spark):
    a, b = base_text(40, "a"), base_text(40, "b")
    near = lambda t: " ".join([*t.split()[:-1], "other"])
    rows = [(1, a), (1, b), (2, near(a)), (3, near(b)), (4, base_text(30, "c")), (5, ""), (5, base_text(30, "c")), (6, None), (None, near(a))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 36, 1, True), (1, 36, 1, True), (2, 36, 1, False), (3, 36, 1, False), (4, 26, 4, True), (5, 0, 4, False),
                          (5, 26, 4, False), (6, 0, 6, True), (None, 36, 1, False)], key=str)
    assert sorted((r["doc_id"] for r in near_dedup.keep_one(df.where("doc_id IS NOT NULL")).collect())) == [1, 1, 4, 6]


def test_hot_lines_and_marks(spark, monkeypatch):
    """Very frequent lines are decided before the shuffle; marks that fill up change nothing."""
    rows = [(i, f"the very same line of all documents\nown {i} words of a line\n{base_text(12, f'x{i}_')}" + ("\nthe very same line of all documents" * (i % 3)))
            for i in range(300)]
    rows += [(1000 + i, edited(60, i % 7)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = helpers.line_dedup(rows)
    for lists, marks, hot in ((line_dedup.MAX_LISTS, line_dedup.MARKS, line_dedup.MOST_HOT), (0, line_dedup.MARKS, 3), (0, 7, 3), (10, 6, 1)):
        monkeypatch.setattr(line_dedup, "MAX_LISTS", lists)
        monkeypatch.setattr(line_dedup, "MARKS", marks)
        monkeypatch.setattr(line_dedup, "MOST_HOT", hot)
        got = {r["doc_id"]: (r["_n_lines"], r["_n_dropped"], r["text"]) for r in line_dedup.dedup_lines(df).collect()}
        assert got == want
