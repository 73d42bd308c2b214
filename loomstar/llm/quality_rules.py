"""Quality rules (4): a decision list learned by sequential covering, applied as Spark conditionals.

Every document gets text statistics from built-in expressions.  A bounded,
hash-chosen sample of the labelled documents (``MAX_LABELLED``) teaches a
decision list for low quality: thresholds are quantiles of the good and the bad rows and the middles between them; a rule
grows condition by condition by information gain on one half of the sample and
is cut back on the other half; it is accepted if it is precise there; the rows
it covers leave and the next rule is grown.  Each step is one small grouping;
only counts per feature and threshold reach the driver.  A labelled row is bad if
its quality is 0 or it is toxic.  Words that stand in bad documents far more
often than in good ones (``learned_words``, at most ``MAX_WORDS``, from the growing
half) are learned as well; their share of a text's words is one more statistic.  The list becomes an
ordered ``CASE WHEN`` over all documents.  No Python runs on executors.

Defined results: NULL texts count as empty; texts without words have all
statistics zero and fail the base rule; without labels there are no learned
rules; repeated rows get equal results; every input row gives one row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstar.llm.shared import SPACES, hidden, let, saved, shown, words_of

MAX_LABELLED = 20_000      # labelled documents that the rules are learned from, at most about
MIN_WORDS = 50             # base rule: fewer words fail
REPEAT_PERCENT = 50        # base rule: more repeated words than this fail
BINS = 12                  # quantiles of each class that thresholds are taken from
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_PRECISION = 0.9        # of a rule on the pruning half (Laplace)
MIN_SUPPORT = 5            # low-quality documents that a rule must find there
MAX_WORDS = 256            # learned words, at most
MIN_G = 20.0               # of a learned word: G statistic of its presence against the class
MIN_LEAN = math.log(3)     # of a learned word: log ratio of its rates in the classes
SYMBOLS = "#*$%&|<>"
FEATURES = ("n_words", "mean_word", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio",
            "mark_ratio", "digit_ratio", "distinct_ratio", "learned_ratio")


def _count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _repeated_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more (positions counted once)."""
    n = F.size(w)

    def covered(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            same = lambda x, j, k: F.coalesce(F.get(s, k).getField("h") == x.getField("h"), F.lit(False))
            hits = F.filter(s, lambda x, j: same(x, j, j - 1) | same(x, j, j + 1))
            return F.sort_array(F.transform(hits, lambda x: x.getField("i")))

        def total(p: Column) -> Column:
            steps = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
            return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(let(ranked, positions), total))

    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(n < 4, F.lit(0)).otherwise(let(windows, covered))


def terms_of(text: Column) -> Column:
    """Lower-case words of letters and digits (anything beyond ASCII counts as a letter), for word evidence."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(words, lambda w: w != "")


def n_learned(terms: Column, words: Sequence[str]) -> Column:
    """How many of the terms are learned words."""
    return F.size(F.filter(terms, lambda w: w.isin(*words))).cast("long") if words else F.lit(0).cast("long")


def statistics(text: Column, words: Sequence[str] = ()) -> Column:
    """One struct of counts of a text; ``words`` are the learned ones."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.translate(x, SPACES, "") != "")

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeated_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"))

    return F.struct(
        let(words_of(t), of).alias("w"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        _count_of(t, SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(lines, F.size).cast("long").alias("n_lines"),
        _count_of(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"),
        _count_of(t, "!?").cast("long").alias("n_marks"),
        _count_of(t, "0123456789").cast("long").alias("n_digits"),
        (n_learned(terms_of(t), words) if words else F.lit(0).cast("long")).alias("n_learned"))


def with_statistics(docs: DataFrame, text_col: str, out: str, words: Sequence[str] = ()) -> DataFrame:
    return docs.withColumn(out, statistics(F.col(text_col), words))


def feature(name: str, s: str) -> Column:
    c = lambda x: F.col(f"{s}.{x}").cast("double")
    ratio = lambda a, b: F.when(c(b) > 0, c(a) / c(b)).otherwise(F.lit(0.0))
    return {
        "n_words": c("w.n_words"),
        "mean_word": ratio("word_chars", "w.n_words"),
        "symbol_ratio": ratio("n_symbols", "word_chars"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "repeat_ratio": ratio("w.n_repeat_words", "w.n_words"),
        "upper_ratio": ratio("n_upper", "word_chars"),
        "mark_ratio": ratio("n_marks", "word_chars"),
        "digit_ratio": ratio("n_digits", "word_chars"),
        "distinct_ratio": ratio("w.n_distinct", "w.n_words"),
        "learned_ratio": ratio("n_learned", "w.n_words"),
    }[name]


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float
    words: tuple[str, ...] = ()  # the learned ones, of a condition on their share

    def column(self, s: str) -> Column:
        f = feature(self.feature, s)
        return f > self.threshold if self.above else f <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _holds(rule: Rule, s: str) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column(s)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                    max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``(s, terms, bad, grow)`` of a bounded hash sample of the labelled documents; bad: of quality 0, or toxic."""
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False)) if "toxic" in labels.columns else F.lit(False)
    marked = labels.where((F.col("quality").isNotNull() | toxic) & F.col("doc_id").isNotNull()).groupBy("doc_id") \
        .agg(F.max(F.coalesce(F.col("quality") == 0, F.lit(False)) | toxic).alias("bad"))
    n = marked.count()
    share = min(1.0, max_labelled / max(n, 1))
    point = F.pmod(F.xxhash64("_label_id"), F.lit(1 << 20))
    marked = saved(marked.withColumnRenamed("doc_id", "_label_id").where(point < math.ceil(share * (1 << 20))), "labelled")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")) \
        .join(F.broadcast(marked), F.col("_id") == F.col("_label_id"))  # bounded by max_labelled
    rows = with_statistics(texts, "_text", "s")
    return saved(rows.select("s", terms_of(F.col("_text")).alias("terms"), "bad",
                             (F.pmod(F.xxhash64(F.col("_id"), F.lit(7)), F.lit(3)) < 2).alias("grow")), "statistics")


def learned_words(sample: DataFrame) -> dict[str, float]:
    """Words whose presence tells the classes apart, with their log-likelihood ratios (good over bad).

    One grouped count of presence per class; ``MAX_WORDS`` words at most reach the driver.
    """
    classes = sample.agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).first()
    bad, good = classes["bad"], classes["good"]
    if not bad or not good:
        return {}
    found = sample.select("bad", F.explode(F.array_distinct("terms")).alias("word")).groupBy("word").agg(
        F.count_if("bad").alias("b"), F.count_if(~F.col("bad")).alias("g"))
    b, g, n = F.col("b"), F.col("g"), F.lit(float(bad + good))

    def part(seen: Column, row: Column, side: int) -> Column:
        return F.when(seen > 0, seen * F.log(seen * n / (row * side))).otherwise(F.lit(0.0))

    stat = 2 * (part(b, b + g, bad) + part(g, b + g, good) + part(bad - b, n - b - g, bad) + part(good - g, n - b - g, good))
    ratio = F.log((g + 1) / F.lit(good + 2.0)) - F.log((b + 1) / F.lit(bad + 2.0))
    rows = found.where(b + g >= MIN_SUPPORT).select("word", stat.alias("stat"), ratio.alias("ratio")) \
        .where((F.col("stat") >= MIN_G) & (F.abs("ratio") >= MIN_LEAN)).orderBy(F.desc("stat"), "word").limit(MAX_WORDS)
    return {r["word"]: r["ratio"] for r in rows.collect()}


#: While rules are learned, a condition is (feature number, above?, threshold number) on binned rows:
#: ``b[f]`` is the number of the feature's thresholds below the row's value.
Binned = tuple[int, bool, int]


def _binned(sample: DataFrame, thresholds: list[list[float]]) -> DataFrame:
    def below(f: str, t: list[float]) -> Column:
        if not t:
            return F.lit(0)
        return F.size(F.filter(F.array(*map(F.lit, t)), lambda x: feature(f, "s") > x))

    return saved(sample.select("bad", "grow", F.array(*map(below, FEATURES, thresholds)).alias("b")).coalesce(4), "binned")


def class_thresholds(sample: DataFrame, names: tuple[str, ...], bins: int = BINS) -> list[list[float]]:
    """Quantiles of each statistic within the good and the bad rows, and the middles between them."""
    cuts = [i / bins for i in range(bins + 1)]
    at = sample.groupBy("bad").agg(*[F.percentile_approx(feature(f, "s"), cuts, 10_000).alias(f) for f in names]).collect()  # two rows
    out = []
    for f in names:
        values = sorted({x for r in at for x in r[f] or ()})
        out.append(sorted({*values, *((a + b) / 2 for a, b in zip(values, values[1:]))}))
    return out


def _covers(rule: tuple[Binned, ...]) -> Column:
    out = F.lit(True)
    for f, above, k in rule:
        b = F.element_at("b", f + 1)
        out = out & (b > k if above else b <= k)
    return out


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    """Information gained by going from ``p0`` of ``p0 + n0`` rows to ``p`` of ``p + n``."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _grow(rows: DataFrame, thresholds: list[list[float]]) -> tuple[Binned, ...]:
    rule: tuple[Binned, ...] = ()
    while len(rule) < MAX_CONDITIONS:
        found = rows.where(_covers(rule)).select("bad", F.posexplode("b").alias("f", "b")).groupBy("f", "b").agg(
            F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()  # features x (BINS + 1)
        counts = {(r["f"], r["b"]): (r["p"], r["n"]) for r in found}
        p0, n0 = (sum(v[i] for (f, _), v in counts.items() if f == 0) for i in (0, 1))
        if not p0 or not n0:
            break
        best, best_gain = None, 0.0
        for f, t in enumerate(thresholds):
            p = n = 0
            for k in range(len(t)):
                more = counts.get((f, k), (0, 0))
                p, n = p + more[0], n + more[1]
                below, over = _gain(p0, n0, p, n), _gain(p0, n0, p0 - p, n0 - n)
                # of conditions that cover the same rows the one that leaves most of the others alone
                if below > best_gain:
                    best, best_gain = (f, False, k), below
                if over > best_gain or over == best_gain > 0 and best[:2] == (f, True):
                    best, best_gain = (f, True, k), over
        if best is None:
            break
        rule += (best,)
    return rule


def _prune(rows: DataFrame, rule: tuple[Binned, ...]) -> tuple[tuple[Binned, ...], int, int]:
    """The prefix of the rule with the best worth on the other half, and what it covers there."""
    covers = [_covers(rule[:k]) for k in range(1, len(rule) + 1)]
    found = rows.agg(*[F.count_if(c & F.col("bad")).alias(f"p{k}") for k, c in enumerate(covers)],
                     *[F.count_if(c & ~F.col("bad")).alias(f"n{k}") for k, c in enumerate(covers)]).first()
    worth = lambda k: (found[f"p{k}"] - found[f"n{k}"]) / max(1, found[f"p{k}"] + found[f"n{k}"])
    k = max(range(len(rule)), key=lambda k: (worth(k), found[f"p{k}"]))
    return rule[:k + 1], found[f"p{k}"], found[f"n{k}"]


def learn_rules(sample: DataFrame) -> list[Rule]:
    """The ordered decision list for low quality from ``labelled_sample`` rows."""
    words = tuple(sorted(w for w, r in learned_words(sample.where("grow")).items() if r < 0))
    sample = saved(sample.select(F.col("s").withField("n_learned", n_learned(F.col("terms"), words)).alias("s"), "bad", "grow"), "learned")
    thresholds = class_thresholds(sample, FEATURES)
    rules: list[Rule] = []
    left = _binned(sample, thresholds)
    while len(rules) < MAX_RULES:
        rule = _grow(left.where("grow"), thresholds)
        if not rule:
            break
        rule, p, n = _prune(left.where("NOT grow"), rule)
        if p < MIN_SUPPORT or (p + 1) / (p + n + 2) < MIN_PRECISION:
            break
        rules.append(tuple(Condition(FEATURES[f], above, thresholds[f][k], words if FEATURES[f] == "learned_ratio" else ())
                           for f, above, k in rule))
        left = left.where(~_covers(rule))
    return rules


def verdict(rules: list[Rule], s: str) -> Column:
    """The text of the first rule that rejects, else NULL: one ordered CASE WHEN."""
    out = F.when(F.lit(False), F.lit(""))
    for rule in rules:
        out = out.when(_holds(rule, s), F.lit(" AND ".join(map(str, rule))))
    return out.otherwise(F.lit(None).cast("string"))


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text", out: str = "_quality") -> DataFrame:
    """``docs`` with a struct ``out``: the base counts, ``base_failed``, the rejecting ``rule`` and ``kept``.

    ``out`` replaces a column of that name.
    """
    s = f"{out}_s"
    n = F.col(f"{s}.w.n_words")
    failed = (n < MIN_WORDS) | (100 * F.col(f"{s}.w.n_repeat_words") > REPEAT_PERCENT * n)
    words = next((c.words for rule in rules for c in rule if c.words), ())
    rows = with_statistics(docs, text_col, s, words).withColumn(f"{out}_v", verdict(rules, s))
    return rows.withColumn(out, F.struct(
        n.alias("n_words"), F.col(f"{s}.word_chars").alias("word_chars"), F.col(f"{s}.n_symbols").alias("n_symbols"),
        F.col(f"{s}.n_dup_lines").alias("n_dup_lines"), F.col(f"{s}.w.n_repeat_words").alias("n_repeat_words"),
        failed.alias("base_failed"), F.col(f"{out}_v").alias("rule"),
        (~failed & F.col(f"{out}_v").isNull()).alias("kept"))).drop(s, f"{out}_v")


def quality_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rules = learn_rules(labelled_sample(docs, labels, id_col, text_col))
    return judge(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), rules, "_text", "_q") \
        .select("doc_id", "_q.*")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    rules = learn_rules(labelled_sample(docs, labels, id_col, text_col))
    docs, names = hidden(docs)
    return shown(judge(docs, rules, names[text_col], "_quality").where("_quality.kept"), names)
