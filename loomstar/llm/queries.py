"""Registered queries of the operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomstar.llm import (
    chat, decontaminate, hard_negatives, html_extract, line_dedup, mixing, near_dedup, pii, quality_classifier, quality_rules,
    spot_signatures, token_align, token_counts,
)
from loomstar.llm.shared import table


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    """The vocabulary file of a public tokenizer; the files are installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.selectExpr("doc_id", "_n_lines AS n_lines", "_n_dropped AS n_dropped", "text")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.windows(rows))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.edited_report(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.alignment(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path())


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_personal_data": op6_personal_data,
    "op7_source_mixing": op7_source_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_html_extraction": op9_html_extraction,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_document_fingerprints": op11_document_fingerprints,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_cross_tokenizer_alignment": op13_cross_tokenizer_alignment,
}

# ---- DuckDB SQL: line by line, pair by pair, window by window --------------------

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

#: Every line against the earliest of its equals, and of the lines one word away.
_OP1 = f"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(range(len(parts))) AS no, unnest(parts) AS line FROM split WHERE text IS NOT NULL),
worded AS (SELECT doc_id, no, line, {_SPACE_WORDS.format(_LOWER.format('line'))} AS w FROM lines),
firsts AS (SELECT w, len(w) AS n, MIN((doc_id, no)) AS f FROM worded WHERE len(w) >= 4 GROUP BY w),
cuts AS (SELECT f, w, i, w[1:i - 1] || w[i + 1:] AS cut FROM (SELECT f, w, unnest(range(1, n + 1)) AS i FROM firsts WHERE n >= 8) x),
replaced AS (SELECT i, cut, MIN(f) AS m FROM cuts GROUP BY i, cut),
shortened AS (SELECT cut, MIN(f) AS m FROM cuts GROUP BY cut),
near AS (
  SELECT w FROM cuts JOIN replaced USING (i, cut) WHERE m < f
  UNION SELECT cuts.w FROM cuts JOIN firsts ON cuts.cut = firsts.w AND firsts.n >= 8 WHERE firsts.f < cuts.f
  UNION SELECT w FROM firsts JOIN shortened ON w = cut WHERE n >= 8 AND m < f),
judged AS (SELECT doc_id, no, line, COALESCE((doc_id, no) > f OR firsts.w IN (SELECT w FROM near), false) AS gone
           FROM worded LEFT JOIN firsts USING (w))
SELECT doc_id, CAST(COUNT(no) AS BIGINT) AS n_lines, CAST(COUNT(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       CASE WHEN COUNT(no) > 0 THEN COALESCE(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT gone), '') END AS text
FROM split LEFT JOIN judged USING (doc_id) GROUP BY doc_id
"""

#: All pairs of documents with a common shingle, and who reaches whom.
_OP2 = f"""
WITH RECURSIVE worded AS (SELECT doc_id, {_SPACE_WORDS.format(_LOWER.format("COALESCE(text, '')"))} AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, w[i:i + 4] AS s
             FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM worded WHERE len(w) > 0) x),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS both_have
           FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * both_have >= 75 * (x.n + y.n - both_have)),
reach(a, b) AS (SELECT doc_id, doc_id FROM worded UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, MIN(b) AS component_id FROM reach GROUP BY a) c LEFT JOIN sizes USING (doc_id)
"""

#: Every run of words of a document against every window of an item.
_WORDS3 = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP3 = f"""
WITH items AS (SELECT item_id, {_WORDS3.format(_LOWER.format("COALESCE(text, '')"))} AS w FROM benchmark),
windows AS (SELECT item_id, least(10, len(w)) AS size, w[i:i + 9] AS win
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0) x),
docs AS (SELECT doc_id, {_WORDS3.format(_LOWER.format("COALESCE(text, '')"))} AS w FROM documents),
runs AS (SELECT doc_id, i, size, w[i:i + size - 1] AS win
         FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM windows) z) x),
found AS (SELECT doc_id, i, runs.size, item_id FROM runs JOIN windows USING (win)),
hit AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) x GROUP BY doc_id),
named AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) x GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit, CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items,
       sha256(COALESCE(names, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

#: Every anchor against every row.
_OP12 = """
WITH worded AS (SELECT CAST(vec_id AS BIGINT) AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                       [CAST(c AS DOUBLE) FOR c IN embedding] AS x FROM embeddings),
rows AS (SELECT id, label, [floor(256 * c) FOR c IN x] AS v FROM worded
         WHERE label IS NOT NULL AND x IS NOT NULL AND len([c FOR c IN x IF c IS NULL OR NOT isfinite(c)]) = 0),
scored AS (SELECT a.id AS anchor_id, a.label = r.label AS same, r.id, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
           FROM rows a JOIN rows r ON a.id % 100 = 0 AND a.id <> r.id),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 5
"""

#: The other operators have no SQL form (learned models, random order, tokenizers, markup,
#: windows of the formatter): tests/llm holds them against plain Python, libraries and round trips.
ORACLE: dict[str, str] = {
    "op1_line_dedup": _OP1,
    "op2_minhash_near_dedup": _OP2,
    "op3_decontamination": _OP3,
    "op12_hard_negatives": _OP12,
}
