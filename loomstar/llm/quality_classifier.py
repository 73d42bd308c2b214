"""Quality classifier (5): hierarchical empirical Bayes over documents, hosts and paths.

Document evidence: a naive Bayes log-likelihood ratio over quantile bins of text
statistics and over the presence of learned words, learned from a bounded hash
sample of the labelled documents (bad: of quality 0, or toxic) and shrunk by
``TEMPER`` because statistics and words are related.  Hosts and their paths
have mean rates of good documents: a host's is its documents' expected good
share, shrunk toward the global rate; a path's is shrunk toward its host's.  How
strongly comes from the data: the spread of well-filled groups beyond what their
sizes explain (method of moments).  A document's posterior combines its evidence
with the log-odds of its path's rate.  Groups are sums of counts, so a hot host is
added up before it is shuffled; only narrow rows are joined, never texts.

Defined results: NULL texts count as empty; NULL hosts or paths are groups of
their own; without labels the evidence is 0 and every rate is ``0.5``; repeated
rows get equal results; every row gives one row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstar.llm.quality_rules import FEATURES, MAX_LABELLED, feature, labelled_sample, learned_words, statistics, terms_of
from loomstar.llm.shared import saved

TEMPER = 0.5
BINS = 24                        # quantile bins of each statistic
THRESHOLD = 0.5
USED = tuple(f for f in FEATURES if f != "learned_ratio")  # learned words have ratios of their own
LEAST, MOST = 1.0, 10_000.0      # bounds of the prior strengths, in documents


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (lower case, without ``www.`` and port) and first path segment of a URL; for pages."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z]+://([^/?#:]+)", 1)), r"^www\.", "")
    return host, F.concat(host, F.lit("/"), F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]+/([^/?#]*)", 1))


def learn_evidence(sample: DataFrame) -> tuple[list[list[float]], list[list[float]], float]:
    """Thresholds and bin log-likelihood ratios (good over bad) of each statistic, and the share of good ones."""
    at = sample.agg(*[F.percentile_approx(feature(f, "s"), [i / BINS for i in range(1, BINS)], 10_000).alias(f) for f in USED]).first()
    thresholds = [sorted(set(at[f] or ())) for f in USED]
    rows = saved(sample.select("bad", F.array(*[_bin(f, t, "s") for f, t in zip(USED, thresholds)]).alias("b")).coalesce(4), "bins")
    found = rows.select("bad", F.posexplode("b").alias("f", "b")).groupBy("f", "b").agg(
        F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect()  # statistics x (BINS + 1)
    bad = sum(r["bad"] for r in found if r["f"] == 0)
    good = sum(r["good"] for r in found if r["f"] == 0)
    ratios = [[0.0] * (len(t) + 1) for t in thresholds]
    for r in found:
        n = len(ratios[r["f"]])
        ratios[r["f"]][r["b"]] = TEMPER * (math.log((r["good"] + 1) / (good + n)) - math.log((r["bad"] + 1) / (bad + n)))
    return thresholds, ratios, (good + 1) / (good + bad + 2)


def word_evidence(terms: Column, ratios: dict[str, float]) -> Column:
    """The sum of the ratios of the learned words that a text has."""
    if not ratios:
        return F.lit(0.0)
    own = F.create_map(*[F.lit(x) for w, r in ratios.items() for x in (w, TEMPER * r)])
    return F.aggregate(F.array_intersect(terms, F.array(*map(F.lit, ratios))), F.lit(0.0), lambda a, w: a + F.element_at(own, w))


def _bin(name: str, thresholds: list[float], s: str) -> Column:
    if not thresholds:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, thresholds)), lambda x: feature(name, s) > x))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def strength(groups: DataFrame, toward: Column) -> float:
    """Prior strength of groups ``(n, good)`` around the rate ``toward``: within over between variance."""
    rate = F.col("good") / F.col("n")
    r = groups.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count(F.lit(1)).alias("groups"),
                   F.sum(F.col("n") * F.pow(rate - toward, 2)).alias("spread"), F.sum(F.col("n") * toward * (1 - toward)).alias("inside")).first()
    if not r["n"] or r["groups"] < 2:
        return MOST
    inside = r["inside"] / r["n"]
    between = (r["spread"] - r["groups"] * inside) / (r["n"] - r["nn"] / r["n"]) if r["n"] * r["n"] > r["nn"] else 0.0
    return min(MOST, max(LEAST, inside / between - 1)) if between > 0 else MOST


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host: Column | None = None, path: Column | None = None, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Evidence, host and path rates, posterior and verdict of every document.

    ``host`` and ``path`` default to the source and to source and language.
    """
    host = F.col("source") if host is None else host
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))) if path is None else path
    sample = labelled_sample(docs, labels, id_col, text_col, max_labelled)
    thresholds, ratios, share = learn_evidence(sample)
    by_word = learned_words(sample)
    evidence = sum((F.element_at(F.array(*map(F.lit, r)), _bin(f, t, "_s") + 1) for f, t, r in zip(USED, thresholds, ratios)), F.lit(0.0))
    rows = saved(docs.select(F.col(id_col).alias("doc_id"), host.alias("host"), path.alias("path"),
                             statistics(F.col(text_col)).alias("_s"), word_evidence(terms_of(F.col(text_col)), by_word).alias("_w"))
                 .select("doc_id", "host", "path", (evidence + F.col("_w")).alias("evidence")), "evidence")
    rows = rows.withColumn("p", _sigmoid(F.col("evidence") + math.log(share / (1 - share))))
    paths = saved(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("good")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("good") / F.sum("n")).first()[0]
    mean = F.lit(float(total if total is not None else share))
    k_host = strength(hosts, mean)
    rates = saved(hosts.select(F.col("host").alias("_host"), ((F.col("good") + k_host * mean) / (F.col("n") + k_host)).alias("host_rate")), "hosts")
    paths = saved(paths.join(rates, F.col("host").eqNullSafe(F.col("_host"))).drop("_host"), "paths")
    k_path = strength(paths, F.col("host_rate"))
    rates = paths.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "host_rate",
                         ((F.col("good") + k_path * F.col("host_rate")) / (F.col("n") + k_path)).alias("path_rate"))
    out = rows.join(rates, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    sure = lambda p: F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), p))
    posterior = _sigmoid(F.col("evidence") + _logit(sure(F.col("path_rate"))))
    return out.select("doc_id", F.round("evidence", 9).alias("evidence"), F.round("host_rate", 9).alias("host_posterior"),
                      F.round("path_rate", 9).alias("path_posterior"), F.round(posterior, 9).alias("posterior"),
                      (posterior >= THRESHOLD).alias("kept"))
