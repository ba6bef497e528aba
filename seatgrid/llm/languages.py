"""Language identification in two levels: the family first, then its languages by one-versus-one linear SVMs.

A text is the square roots of its hashed byte n-gram shares. The machines are fitted on a bounded sample of
different labelled texts; every text is then scored whole, in Arrow batches, with one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatgrid.llm.common import stored

UNKNOWN = "und"
SIZE = 2048
OWN_FAMILIES = 8
# Families of common languages. A language that is not listed is a family of its own, or, if those are many, of
# a family of alike ones.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "pl": "slavic", "cs": "slavic", "uk": "slavic", "bg": "slavic", "sk": "slavic",
}


def grams(text: str) -> np.ndarray:
    """Unit vector of the square roots of hashed counts of byte 1- to 4-grams, lower-cased; white space counts as one space."""
    raw = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    counts = np.zeros(SIZE)
    mark = np.zeros(len(raw), np.uint32)
    for n in range(4):
        mark = mark[: len(raw) - n] * np.uint32(0x01000193) + raw[n:] + np.uint32(n + 1)
        if len(mark):
            counts += np.bincount((mark * np.uint32(0x9E3779B1)) >> np.uint32(21), minlength=SIZE)
    out = np.sqrt(counts)
    return out / (np.linalg.norm(out) or 1.0)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def training_sample(docs: DataFrame, per_language: int, most_languages: int | None = None) -> DataFrame:
    """``lang, text``: at most ``per_language`` different texts of every language, or of the ``most_languages`` most frequent ones.

    Texts are drawn by their hash, so copies are one text and the draw is the same in every run.
    """
    rows = docs.select(F.col("lang").cast("string").alias("lang"), "text").filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    key = F.pmod(F.xxhash64("text"), F.lit(1_000_000))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).orderBy(F.desc("n"), "lang")
    found = (counts if most_languages is None else counts.limit(most_languages)).collect()
    limits = [F.lit(x) for row in found for x in (row["lang"], int(2e6 * per_language / max(row["n"], 1)) + 1)]
    limit = F.try_element_at(F.create_map(*limits), F.col("lang")) if limits else F.lit(-1)
    drawn = rows.filter(key < limit).groupBy("lang", F.xxhash64("text").alias("key")).agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key", "text"))
    return drawn.withColumn("rank", rank).filter(F.col("rank") <= per_language).select("lang", "text")


def group_alike(means: dict[str, np.ndarray]) -> dict[str, list[str]]:
    """The languages of ``means`` in groups of alike mean vectors: about as many groups as each has languages.

    A group is led by the first language not yet in one and takes those nearest to it, so that machines number
    about half the 1.5th power of the languages, not half their square.
    """
    left, out = sorted(means), {}
    size = int(np.ceil(np.sqrt(len(left))))
    while left:
        near = sorted(left, key=lambda x: (x != left[0], float(np.linalg.norm(means[x] - means[left[0]])), x))[:size]
        out[f"={near[0]}"] = sorted(near)
        left = [x for x in left if x not in near]
    return out


class LanguageModel:
    """Weights of one linear machine per pair of families, and per pair of languages of a family."""

    def __init__(self, families: dict[str, list[str]], machines: dict[tuple[str, str], tuple[np.ndarray, float]]):
        self.families, self.machines = families, machines

    def _duels(self, names: list[str], margins: dict[tuple[str, str], np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the winner of each text and its mean certainty over its duels."""
        if len(names) == 1:
            return np.zeros(n, int), np.ones(n)
        sure = np.zeros((len(names), n))
        for a, b in combinations(range(len(names)), 2):
            p = 1 / (1 + np.exp(-3 * np.clip(margins[names[a], names[b]], -50, 50)))
            sure[a] += p
            sure[b] += 1 - p
        sure /= len(names) - 1
        return sure.argmax(0), sure.max(0)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = {pair: x @ w + b for pair, (w, b) in self.machines.items()}
        names = sorted(self.families)
        family, sure = self._duels(names, margins, len(x))
        out = np.empty(len(x), object)
        for i, name in enumerate(names):
            own = family == i
            which, certain = self._duels(self.families[name], {k: m[own] for k, m in margins.items()}, int(own.sum()))
            out[own] = np.array(self.families[name], object)[which] if own.any() else []
            sure[own] *= certain
        return list(out), sure


def fit_languages(docs: DataFrame, per_language: int = 800, most_languages: int | None = None, families: dict[str, str] | None = None) -> LanguageModel | None:
    """Fits on a sample of ``docs`` (``lang, text``); None without a text of a known language.

    At most ``per_language`` texts of every language are fitted (with ``most_languages``, of the most frequent ones only). More
    than ``OWN_FAMILIES`` languages that ``families`` does not list form families of alike languages.
    """
    table = FAMILIES if families is None else families

    def featured(batches):
        for part in batches:
            yield pd.DataFrame({"lang": part["lang"], "grams": [grams(t).tolist() for t in part["text"]]})

    sample = stored(training_sample(docs, per_language, most_languages).mapInPandas(featured, "lang string, grams array<double>"), "lang-sample")
    langs = sorted(r[0] for r in sample.select("lang").distinct().collect())
    if not langs:
        return None
    groups: dict[str, list[str]] = {}
    for lang in langs:
        groups.setdefault(table.get(lang, f"={lang}"), []).append(lang)
    rows = sample.select("lang", array_to_vector("grams").alias("features")).persist()
    other = [lang for lang in langs if lang not in table]
    if len(other) > OWN_FAMILIES:
        means = rows.filter(~F.col("lang").isin(list(table))).groupBy("lang").agg(Summarizer.mean(F.col("features")).alias("mean"))
        groups = {k: v for k, v in groups.items() if k not in {f"={x}" for x in other}}
        groups |= group_alike({r["lang"]: r["mean"].toArray() for r in means.collect()})
    machines = {}

    def machine(a: list[str], b: list[str]) -> tuple[np.ndarray, float]:
        pair = rows.filter(F.col("lang").isin(a + b)).withColumn("label", F.col("lang").isin(a).cast("double"))
        fit = LinearSVC(maxIter=40, regParam=1e-3, standardization=False).fit(pair)
        return fit.coefficients.toArray(), float(fit.intercept)

    for a, b in combinations(sorted(groups), 2):
        machines[a, b] = machine(groups[a], groups[b])
    for own in groups.values():
        for a, b in combinations(own, 2):
            machines[a, b] = machine([a], [b])
    rows.unpersist()
    return LanguageModel(groups, machines)


def predict_language(text: Column, model: LanguageModel | None) -> Column:
    """Struct ``lang_pred, score``; ``und`` with score 0 for a null text, one without a letter, or without a model."""

    @F.pandas_udf("lang_pred string, score double")
    def udf(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            langs, sure = [], []
            for at in range(0, len(part), 512):
                names, certain = model.predict(np.array([grams(t or "") for t in part.iloc[at : at + 512]]))
                langs += names
                sure += certain.tolist()
            yield pd.DataFrame({"lang_pred": langs, "score": sure})

    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if model is None:
        return unknown
    return F.when(has_letter(text), udf(text)).otherwise(unknown)
