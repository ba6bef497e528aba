"""Quality rules: plain limits on a text's words, then robust multivariate outliers per language and source.

Each text that passes the plain limits becomes a vector of transformed statistics. For each (language, source)
the minimum covariance determinant is estimated by concentration steps over all rows: from medians and median
deviations, each step takes the mean and covariance of the half-or-more of the rows with the smallest distances.
A step is one grouped quantile sketch of the distances and one grouped sum of products, so a group with a
third of all rows is added up on all tasks. Rows whose robust Mahalanobis distance is over the limit are rejected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatgrid.llm.common import stored

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, vector array<double>"
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIMENSIONS = 5
_NOT_REPEATED = np.uint64(0x9E3779B97F4A7C15)


def _repeated(words: list[bytes], window: int = 8) -> int:
    """Words inside windows of ``window`` words that the text holds twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    marks = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        sums = np.zeros(n, np.uint64)
        for k in range(window):
            sums = sums * _NOT_REPEATED + marks[k : k + n]
    order = np.argsort(sums, kind="stable")
    same = np.flatnonzero(sums[order[1:]] == sums[order[:-1]])
    if not len(same):
        return 0
    left, right = order[same], order[same + 1]
    equal = np.all([marks[left + k] == marks[right + k] for k in range(window)], axis=0)
    if equal.all():
        starts = np.unique(np.concatenate([left, right]))
    else:  # different windows of one sum: told apart by their words
        windows = [tuple(words[i : i + window]) for i in range(n)]
        many = Counter(windows)
        starts = np.array([i for i, w in enumerate(windows) if many[w] > 1], np.int64)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def _stats(text: str | None) -> tuple:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = len(text) - sum(raw.count(s) for s in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    capitals, marks = (len(raw) - len(raw.translate(None, kind)) for kind in (CAPITALS, MARKS))
    vector = [
        float(np.log1p(len(words))), float(np.log1p(len(set(words)))), float(np.log((chars + 60) / (len(words) + 10))),
        float(np.log((capitals + 4) / (chars + 200))), float(np.log((marks + 6) / (chars + 200))),
    ]
    return (
        len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), _repeated(words), vector,
    )


def text_stats(text: Column) -> Column:
    """Statistics of a whole text as a struct of ``STATS``; a null text counts as empty."""

    @F.pandas_udf(STATS)
    def udf(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            yield pd.DataFrame([_stats(t) for t in part], columns=[c.split()[0] for c in STATS.split(", ")])

    return udf(text.cast("string"))


def base_failed(stats: str = "stats", least_words: int = 20, most_repeated: int = 30) -> Column:
    s = F.col(stats)
    return (s["n_words"] < least_words) | (100 * s["n_repeat_words"] > most_repeated * s["n_words"])


def _distance(vector: Column, fit: Column) -> Column:
    """Squared Mahalanobis distance under ``fit`` (centre, rows of the inverse covariance)."""
    gaps = [vector[i] - fit["centre"][i] for i in range(DIMENSIONS)]
    return sum(
        (gaps[i] * gaps[j] * fit["inverse"][i * DIMENSIONS + j] for i in range(DIMENSIONS) for j in range(DIMENSIONS)), F.lit(0.0)
    )


def _with_inverse(cells: DataFrame, keys: list[str], shape: str) -> DataFrame:
    """Cells with ``centre`` and ``inverse`` out of their sums (``sums``) or medians and deviations (``spread``)."""
    least = 1e-4

    def solve(batches):
        for cells in batches:
            centres, inverses = [], []
            for row in cells.itertuples():
                if shape == "spread":
                    centre = np.array(row.middle, float)
                    cov = np.diag(np.maximum(1.4826 * np.array(row.wide, float), least) ** 2)
                else:
                    sums = np.array(row.sums, float)
                    n, centre = sums[0], sums[1 : 1 + DIMENSIONS] / sums[0]
                    cov = np.zeros((DIMENSIONS, DIMENSIONS))
                    cov[np.triu_indices(DIMENSIONS)] = sums[1 + DIMENSIONS :] / n
                    cov = np.triu(cov) + np.triu(cov, 1).T - np.outer(centre, centre)
                    cov = cov / SHRUNK + np.eye(DIMENSIONS) * least
                centres.append(centre.tolist())
                inverses.append(np.linalg.inv(cov).ravel().tolist())
            yield cells[keys].assign(centre=centres, inverse=inverses)

    kinds = ", ".join(f"{k} {cells.schema[k].dataType.simpleString()}" for k in keys)
    return cells.mapInPandas(solve, f"{kinds}, centre array<double>, inverse array<double>")


# The covariance of the innermost 75 % of a five-dimensional normal sample is this share of the whole one:
# P(chi2 with 7 degrees <= q) / 0.75, where q is the 75 % quantile with 5 degrees.
SHRUNK = 0.7075
SHARE = 0.75


def fit_cells(vectors: DataFrame, keys: list[str], steps: int = 4) -> DataFrame:
    """For each value of ``keys`` in ``vectors`` (with ``vector``): ``centre`` and ``inverse``."""
    v = F.col("vector")
    middle = vectors.groupBy(*keys).agg(*[F.percentile_approx(v[i], 0.5, 2000).alias(f"m{i}") for i in range(DIMENSIONS)])
    middle = stored(middle.select(*keys, F.array(*[f"m{i}" for i in range(DIMENSIONS)]).alias("middle")), "quality-middle")
    wide = vectors.join(middle, keys).groupBy(*keys).agg(
        F.first("middle").alias("middle"),
        *[F.percentile_approx(F.abs(v[i] - F.col("middle")[i]), 0.5, 2000).alias(f"d{i}") for i in range(DIMENSIONS)],
    )
    fits = stored(
        _with_inverse(wide.select(*keys, "middle", F.array(*[f"d{i}" for i in range(DIMENSIONS)]).alias("wide")), keys, "spread"),
        "quality-fit",
    )
    terms = [v[i] for i in range(DIMENSIONS)] + [v[i] * v[j] for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]
    for _ in range(steps):
        near = vectors.join(fits, keys).select(
            *keys, "vector", _distance(v, F.struct("centre", "inverse")).alias("distance")
        )
        bounds = stored(near.groupBy(*keys).agg(F.percentile_approx("distance", SHARE, 2000).alias("bound")), "quality-bound")
        inner = near.join(bounds, keys).filter("distance <= bound")
        sums = inner.groupBy(*keys).agg(F.array(F.count(F.lit(1)).cast("double"), *[F.sum(t) for t in terms]).alias("sums"))
        fits = stored(_with_inverse(sums, keys, "sums"), "quality-fit")
    return fits


#: Rows, of which three quarters make an estimate, that are more than its 5 means and 15 covariances.
LEAST_IN_ALL = 28


def fit_quality(stats: DataFrame, least_rows: int = 200, steps: int = 4) -> DataFrame:
    """Fits by language and source (``cell_lang``, ``cell_source``); needs ``cell_lang, cell_source, vector``.

    A cell with fewer than ``least_rows`` rows takes the fit of its language over all sources; a language with
    fewer takes the one over everything. With fewer than ``LEAST_IN_ALL`` rows in all there is no covariance to estimate, and
    nothing is rejected.
    """
    rows = stats.select("cell_lang", "cell_source", "vector")
    cells = rows.groupBy("cell_lang", "cell_source").agg(F.count(F.lit(1)).alias("n"))
    cells = stored(cells, "quality-cells")
    langs = cells.groupBy("cell_lang").agg(F.sum("n").alias("n_lang"))
    enough = (cells.agg(F.sum("n")).first()[0] or 0) >= LEAST_IN_ALL
    sized = stored(
        cells.join(langs, "cell_lang").select(
            "cell_lang", "cell_source",
            F.when(F.col("n") >= least_rows, F.struct("cell_lang", "cell_source"))
            .when(F.col("n_lang") >= least_rows, F.struct("cell_lang", F.lit("*").alias("cell_source")))
            .when(F.lit(enough), F.struct(F.lit("*").alias("cell_lang"), F.lit("*").alias("cell_source")))
            .alias("uses"),
        ).filter("uses is not null"),
        "quality-sized",
    )
    # Every row counts for its own cell, and for its language and for everything where some cell needs those.
    needed = sized.select(F.col("uses.cell_lang").alias("of_lang"), F.col("uses.cell_source").alias("of_source")).distinct()
    wider = rows.select(
        F.explode(F.array(
            F.struct("cell_lang", "cell_source"), F.struct("cell_lang", F.lit("*").alias("cell_source")),
            F.struct(F.lit("*").alias("cell_lang"), F.lit("*").alias("cell_source")),
        )).alias("of"), "vector",
    ).select(F.col("of.cell_lang").alias("of_lang"), F.col("of.cell_source").alias("of_source"), "vector")
    fits = fit_cells(stored(wider.join(stored(needed, "quality-needed"), ["of_lang", "of_source"]), "quality-vectors"), ["of_lang", "of_source"], steps)
    return stored(
        sized.select("cell_lang", "cell_source", F.col("uses.cell_lang").alias("of_lang"), F.col("uses.cell_source").alias("of_source"))
        .join(fits, ["of_lang", "of_source"]).select("cell_lang", "cell_source", "centre", "inverse"),
        "quality-fits",
    )


def cell(column: str) -> Column:
    """A cell key out of a column that may be null; a text for null that no plain name takes."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


# Squared distance. The 99.99 % quantile of five normal degrees is 25.7, but ratios of short clean texts have far heavier
# tails; a text over this is made of something other than the prose of its cell.
LIMIT = 150.0


def judged(rows: DataFrame, fits: DataFrame, limit: float = LIMIT) -> DataFrame:
    """``rows`` (with ``stats, cell_lang, cell_source``) plus ``base_failed``, ``distance`` and ``kept``."""
    names = [c for c in rows.columns if c not in ("base_failed", "distance", "kept")]
    fits = fits.select(
        F.col("cell_lang").alias("_fit_lang"), F.col("cell_source").alias("_fit_source"), F.struct("centre", "inverse").alias("_fit")
    )
    near = rows.select(*names).join(
        fits, (F.col("cell_lang") == F.col("_fit_lang")) & (F.col("cell_source") == F.col("_fit_source")), "left"
    )
    distance = F.when(F.col("_fit").isNotNull(), _distance(F.col("stats")["vector"], F.col("_fit")))
    return near.select(
        *names, base_failed().alias("base_failed"), distance.alias("distance"),
        (~base_failed() & (F.coalesce(distance, F.lit(0.0)) <= limit)).alias("kept"),
    )


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id``, the statistics, ``base_failed``, ``distance`` and ``kept`` of every row.

    Null and empty texts have no words and fail the plain limits. Null languages and sources are values of their own.
    Repeated rows get equal verdicts. An empty table gives an empty table. Texts of any length are read whole, in time that grows
    with their length but for sorting their windows.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"), cell(lang_col).alias("cell_lang"), cell(source_col).alias("cell_source"),
            text_stats(F.col(text_col)).alias("stats"),
        ),
        "quality-stats",
    )
    fits = fit_quality(rows.filter(~base_failed()).select("cell_lang", "cell_source", "stats.vector"))
    return judged(rows, fits).select("doc_id", "stats.*", "base_failed", "distance", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (``text, lang, source`` and any others) that pass, unchanged."""
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), cell("lang").alias("cell_lang"),
        cell("source").alias("cell_source"), text_stats(F.col("text")).alias("stats"),
    )
    light = stored(
        docs.select(cell("lang").alias("cell_lang"), cell("source").alias("cell_source"), text_stats(F.col("text")).alias("stats")),
        "quality-stats",
    )
    fits = fit_quality(light.filter(~base_failed()).select("cell_lang", "cell_source", "stats.vector"))
    return judged(whole, fits).filter("kept").select("row.*")
