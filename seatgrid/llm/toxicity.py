"""Toxicity by weak supervision: many voters, a generative label model over them, a linear classifier on its labels.

Lexicons of words and word fronts are mined from a bounded sample of labelled texts. Lexicons and patterns vote
toxic or nothing on every text. From the counts of vote patterns alone (no labels) the label model estimates how often
each voter votes what in either class, and how voters go together within a class, by expectation-maximisation; voters that
say the same thing share their weight. Its posteriors are the labels on which a logistic regression is fitted.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatgrid.llm.common import stored

FRONTS = (4, 5, 6)
BUCKETS = 256
_WORDS = re.compile(r"[^\W\d_]+")
TOXIC, CLEAN, NONE = 1, 0, -1
VOTERS = (
    "words a", "words b", "words c", "weak words", "fronts of 4", "fronts of 5", "fronts of 6", "several terms", "shouting",
)


class Lexicons:
    """Mined terms: ``(kind, term, strong)`` with kind 0 for whole words and n for fronts of n letters."""

    def __init__(self, terms: list[tuple[int, str, bool]]):
        self.terms = {(k, t): s for k, t, s in terms}
        self.heads = {t[:4] for _, t, _ in terms}

    def found(self, text: str) -> list[tuple[int, str, bool]]:
        """Terms of the text, each once. Every term has at least one letter and is looked up by its first four."""
        heads, terms, out = self.heads, self.terms, set()
        for word in {w for w in _WORDS.findall(text.lower()) if w[:4] in heads}:
            for key in ((0, word), *((n, word[:n]) for n in FRONTS if len(word) > n)):
                if key in terms:
                    out.add(key)
        return [(k, t, terms[k, t]) for k, t in out]

    def votes(self, text: str, found: list[tuple[int, str, bool]]) -> list[int]:
        hit = {
            "words a": any(k == 0 and s and zlib.crc32(t.encode()) % 3 == 0 for k, t, s in found),
            "words b": any(k == 0 and s and zlib.crc32(t.encode()) % 3 == 1 for k, t, s in found),
            "words c": any(k == 0 and s and zlib.crc32(t.encode()) % 3 == 2 for k, t, s in found),
            "weak words": any(k == 0 and not s for k, t, s in found),
            **{f"fronts of {n}": any(k == n and s for k, t, s in found) for n in FRONTS},
            "several terms": sum(k == 0 and s for k, t, s in found) > 1,
            "shouting": text.count("!") * 20 > len(text) > 0,
        }
        return [TOXIC if hit[v] else NONE for v in VOTERS]

    def features(self, found: list[tuple[int, str, bool]], votes: list[int]) -> list[float]:
        out = [float(v == TOXIC) for v in votes]
        buckets = [0.0] * BUCKETS
        for k, t, s in found:
            if s:
                buckets[zlib.crc32(f"{k}{t}".encode()) % BUCKETS] = 0.5
        return out + buckets


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """``text, toxic`` of different texts, about ``per_class`` rows of each class at most, drawn by the ids' hashes.

    ``labels`` holds the rows to learn from. A text with two labels counts as toxic.
    """
    labels = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    labels = stored(labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)), "toxic-labels")
    limit = F.lit(0)
    for row in labels.groupBy("toxic").count().collect():
        limit = F.when(F.col("toxic") == row["toxic"], int(1e6 * per_class / row["count"]) + 1).otherwise(limit)
    drawn = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < limit)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("text").isNotNull()).join(F.broadcast(drawn), "doc_id")
    return texts.groupBy("text").agg(F.max("toxic").alias("toxic"))


def _fronts(words: Column, n: int) -> Column:
    long_ = F.filter(words, lambda w: F.char_length(w) > n)
    return F.transform(F.array_distinct(F.transform(long_, lambda w: F.substring(w, 1, n))), lambda t: F.struct(F.lit(n).alias("kind"), t.alias("term")))


def mine(sample: DataFrame, most_terms: int = 4000, least_share: float = 0.015, lift: float = 8.0, strong: float = 40.0) -> Lexicons:
    """Words and word fronts that are ``lift`` times as frequent in toxic texts of ``sample`` as in others.

    A term needs ``least_share`` of the toxic texts, and four at least, so that what near-copies of one text share is no term.
    A front of which four fifths or more come from one word says no more than the word, and is no term either.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    whole = F.transform("words", lambda w: F.struct(F.lit(0).alias("kind"), w.alias("term")))
    terms = F.concat(whole, *[_fronts(F.col("words"), n) for n in FRONTS])
    rows = sample.withColumn("words", words).select("toxic", F.explode(terms).alias("t"))
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    counted = rows.groupBy("t").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    counted = stored(counted.filter("bad > 0"), "toxic-terms")
    fronts = F.explode(F.concat(*[_fronts(F.array("t.term"), n) for n in FRONTS]))
    first = counted.filter("t.kind = 0").select(fronts.alias("t"), "bad").groupBy("t").agg(F.max("bad").alias("most"))
    times = ((F.col("bad") + 0.5) / (n.get(1, 0) + 1)) / ((F.col("good") + 0.5) / (n.get(0, 0) + 1))
    often = counted.filter(F.col("bad") >= max(4.0, least_share * n.get(1, 0))).withColumn("times", times).filter(F.col("times") >= lift)
    own = often.join(first, "t", "left").filter("t.kind = 0 OR 5 * most < 4 * bad")
    best = own.orderBy(F.desc("times"), "t").limit(most_terms)
    return Lexicons([(r["t"]["kind"], r["t"]["term"], r["times"] >= strong) for r in best.collect()])


def label_model(patterns: dict[tuple[int, ...], int], rounds: int = 40) -> dict[tuple[int, ...], float]:
    """Posterior of toxic for each vote pattern, from the patterns' counts.

    Given the class, a voter's votes (toxic, clean or none) have a distribution of their own. A voter that is a function
    of all the others (one that votes clean where none of them votes, say) tells nothing and must not be among them. Voters that go together within the classes
    (by their correlation, averaged over the classes) are each weighted 1 / (1 + sum of squared correlations).
    """
    keys = sorted(patterns)
    votes, counts = np.array(keys), np.array([patterns[k] for k in keys], float)
    toxic, clean = (votes == TOXIC).sum(1), (votes == CLEAN).sum(1)
    post = (toxic + 0.05) / (toxic + clean + 1.0)
    for _ in range(rounds):
        odds = np.log((counts @ post + 1) / (counts @ (1 - post) + 1)) * np.ones(len(keys))
        by_class = [counts * (1 - post), counts * post]
        together = np.zeros((votes.shape[1],) * 2)
        for weight in by_class:
            x = (votes == TOXIC) * 1.0 - (votes == CLEAN)
            x = x - (weight @ x) / (weight.sum() + 1e-9)
            cov = (x * weight[:, None]).T @ x / (weight.sum() + 1e-9)
            dev = np.sqrt(np.diag(cov)) + 1e-6
            together += (cov / dev / dev[:, None]) ** 2 / 2
        share = 1 / (1 + together.sum(1) - np.diag(together))
        for j in range(votes.shape[1]):
            for value in (NONE, CLEAN, TOXIC):
                own = votes[:, j] == value
                rate = [(w[own].sum() + 0.1) / (w.sum() + 0.3) for w in by_class]
                odds[own] += share[j] * np.log(rate[1] / rate[0])
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return dict(zip(keys, post.tolist()))




def voted(text: Column, lexicons: Lexicons) -> Column:
    """Struct ``votes, features`` of a whole text; a null text counts as empty."""

    @F.pandas_udf("votes array<int>, features array<double>")
    def udf(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            rows = []
            for text in part:
                found = lexicons.found(text or "")
                votes = lexicons.votes(text or "", found)
                rows.append((votes, lexicons.features(found, votes)))
            yield pd.DataFrame(rows, columns=["votes", "features"])

    return udf(text.cast("string"))


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = 4000, fitted: int = 20000) -> DataFrame:
    """``doc_id, learned, score`` of every row; ``learn`` (on ``doc_id``) says from which rows labels may be learned.

    Lexicons come from about ``per_class`` labelled texts of each class, the classifier from about ``fitted`` different vote and feature
    rows of rows to learn from; the label model's counts cover all of these. Null and empty texts are scored (no voter
    finds anything). Without toxic labels to learn from there are no lexicons, and all scores are low.
    """
    sample = stored(labelled_sample(docs, labels.filter(learn), per_class), "toxic-sample")
    lexicons = mine(sample)
    rows = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), voted(F.col("text"), lexicons).alias("v")).select("doc_id", F.coalesce(learn, F.lit(False)).alias("learned"), "v.*"),
        "toxic-votes",
    )
    known = rows.filter("learned")
    counts = {tuple(r["votes"]): r["count"] for r in known.groupBy("votes").count().collect()}  # 3 ^ voters patterns at most
    post = label_model(counts) if counts else {}
    weights, bias = np.zeros(len(VOTERS) + BUCKETS), -4.0
    if post and max(post.values()) > 0.5 > min(post.values()):
        # Equal rows are one row with a weight; of these as many are drawn as may be fitted, by their hash.
        same = known.groupBy("votes", "features").agg(F.count(F.lit(1)).cast("double").alias("n"))
        same = stored(same, "toxic-same")
        many = same.count()
        drawn = same.filter(F.pmod(F.xxhash64("features"), F.lit(1_000_000)) < int(1e6 * fitted / many) + 1)
        table = docs.sparkSession.createDataFrame([(list(k), p) for k, p in post.items()], "votes array<int>, p double")
        fit_rows = drawn.join(F.broadcast(table), "votes").select(
            array_to_vector("features").alias("features"),
            F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("part")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("part")))).alias("x"),
            F.log1p("n").alias("n"),
        ).select("features", "x.label", (F.col("x.part") * F.col("n")).alias("weight")).filter("weight > 1e-6")
        fit = LogisticRegression(maxIter=60, regParam=1e-4, weightCol="weight", standardization=False).fit(stored(fit_rows, "toxic-fit"))
        weights, bias = fit.coefficients.toArray(), float(fit.intercept)
    return rows.select("doc_id", "learned", _logistic(weights, bias).alias("score"))


def _logistic(weights: np.ndarray, bias: float) -> Column:
    each = F.zip_with("features", F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w)
    return 1 / (1 + F.exp(-(F.aggregate(each, F.lit(0.0), lambda a, x: a + x) + F.lit(bias))))
