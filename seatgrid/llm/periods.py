"""Periodic runs in the words of a text, by longest common extensions over a difference cover.

A run is a stretch of words that repeats with a period q and that no neighbouring word extends. All questions that the search
asks are longest common extensions (LCE): how far do the words from i on agree with those from j on. Of every seven places the
three of a difference cover are sampled; only suffixes at sampled places are sorted (by doubling over blocks of seven words),
with the common blocks of sorted neighbours in a sparse table for range minima. Any two places reach sampled ones by one
common shift of less than seven words, so an LCE compares a few words, looks up one range minimum, and compares a few more.

Runs come from a harmonic grid: for every period q the places 0, s, 2s, ... (s a multiple of q) are compared with those q on;
a long enough run holds a place of its grid, so n words ask O(n log n) questions. Texts are searched whole, many at once: the
words of a batch stand in one sequence, parted by words that occur once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from itertools import compress, count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatgrid.llm.common import slices

# Every difference modulo 7 is one of two places of the cover.
MODULUS = 7
COVER = (0, 1, 3)
_SHIFT = np.array([[next(h for h in range(MODULUS) if (i + h) % MODULUS in COVER and (j + h) % MODULUS in COVER) for j in range(MODULUS)] for i in range(MODULUS)])


def _numbered(keys: np.ndarray) -> np.ndarray:
    """Dense numbers of the values, in their order."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


class Extensions:
    """LCE of places of ``words``, whole numbers from 0; the last word must occur nowhere else."""

    def __init__(self, words: np.ndarray):
        n, top = len(words), int(words.max(initial=0)) + 1
        self.words = np.concatenate([words, top + np.arange(2 * MODULUS)])
        top += 2 * MODULUS
        place = np.arange(n)
        place = place[np.isin(place % MODULUS, COVER)]
        many = len(place)
        self.sample = np.full(n + MODULUS, -1, np.int64)
        self.sample[place] = np.arange(many)
        block, held = self.words[place], top
        for k in range(1, MODULUS):
            if held > (1 << 62) // top:
                block, held = _numbered(block), many
            block, held = block * top + self.words[place + k], held * top
        ranks, after = [_numbered(block)], [np.append(np.where(place + MODULUS < n, self.sample[np.minimum(place + MODULUS, n)], many), many)]
        while ranks[-1].max(initial=0) + 1 < many:
            here, then = np.append(ranks[-1], -1), after[-1]
            ranks.append(_numbered(here[:-1] * (many + 1) + here[then[:-1]] + 1))
            after.append(then[then])
        self.rank = ranks[-1]
        order = np.empty(many, np.int64)
        order[self.rank] = np.arange(many)
        a, b = order[:-1], order[1:]
        common = np.zeros(max(many - 1, 0), np.int32)
        for level in range(len(ranks) - 2, -1, -1):
            here, then = np.append(ranks[level], -1), after[level]
            same = (here[a] == here[b]) & (a < many) & (b < many)
            common[same] += 1 << level
            a, b = np.where(same, then[a], a), np.where(same, then[b], b)
        self.least = [common]
        while 2 << (len(self.least) - 1) <= len(common):
            half = 1 << (len(self.least) - 1)
            self.least.append(np.minimum(self.least[-1][:-half], self.least[-1][half:]))

    def _agree(self, i: np.ndarray, j: np.ndarray, most: np.ndarray | int) -> np.ndarray:
        """How many words agree one by one, up to ``most`` (below ``MODULUS``)."""
        most = np.broadcast_to(most, i.shape)
        out = np.zeros(len(i), np.int64)
        open_ = np.flatnonzero(most > 0)
        for k in range(MODULUS):
            open_ = open_[(most[open_] > k) & (self.words[i[open_] + k] == self.words[j[open_] + k])]
            if not len(open_):
                break
            out[open_] += 1
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For places ``i < j`` the number of words that agree from there on."""
        shift = _SHIFT[i % MODULUS, j % MODULUS]
        out = self._agree(i, j, shift)
        open_ = np.flatnonzero(out == shift)
        if not len(open_):
            return out
        i, j, shift = i[open_], j[open_], shift[open_]
        a, b = self.rank[self.sample[i + shift]], self.rank[self.sample[j + shift]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(float))[1] - 1
        blocks = np.empty(len(i), np.int64)
        for k in np.unique(level):
            own = level == k
            blocks[own] = np.minimum(self.least[k][low[own]], self.least[k][high[own] - (1 << k)])
        far = shift + MODULUS * blocks
        out[open_] = far + self._agree(i + far, j + far, MODULUS - 1)
        return out


def _grid(starts: np.ndarray, sizes: np.ndarray, times: int, stride: int, at_once: int):
    """Portions of the grid: ``text, period, place`` arrays, whole (text, period) pairs in order of place."""
    most = sizes // times
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    points = -(-(sizes[text] - period) // (stride * period))
    total = np.cumsum(points)
    at = 0
    while at < len(text):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + at_once, "right")))
        many = points[at:end]
        own = np.repeat(np.arange(at, end), many)
        step = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
        yield text[own], period[own], starts[text[own]] + step * stride * period[own]
        at = end


def runs_of(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, times: int = 4, shortest: int = 6, at_once: int = 1 << 20):
    """Runs of many texts as arrays ``text, start, length, period``, by text, start, period.

    Text t is ``words[starts[t]:starts[t] + sizes[t]]``; a word that occurs once in all stands behind each. A run is at least
    ``times`` (2 or more) periods and ``shortest`` words long; its period is its smallest.
    """
    none = np.zeros(0, np.int64)
    able = np.flatnonzero(sizes >= max(shortest, times))
    if not len(able):
        return none, none, none, none
    extensions = Extensions(words)
    stride = max(1, times - 2)
    found = []
    for text, period, place in _grid(starts[able], sizes[able], times, stride, at_once):
        reach = extensions.lce(place, place + period)
        # A run's first grid place has the rest of it ahead; at later ones the place before reaches this one.
        long = reach > (times - 1 - stride) * period
        before = np.append(-1, reach[:-1])
        follows = np.append(False, (text[1:] == text[:-1]) & (period[1:] == period[:-1]))
        first = np.flatnonzero(long & ~(follows & (before >= stride * period)))
        text, period, place, reach = text[first], period[first], place[first], reach[first]
        low = np.where(follows[first], place - stride * period + before[first] + 1, starts[able][text])
        high = place.copy()
        while (open_ := np.flatnonzero(low < high)).size:  # the first place from which the words agree up to the grid place
            middle = (low[open_] + high[open_]) // 2
            good = middle + extensions.lce(middle, middle + period[open_]) >= place[open_]
            high[open_[good]] = middle[good]
            low[open_[~good]] = middle[~good] + 1
        length = place + reach + period - low
        keep = length >= np.maximum(shortest, times * period)
        found.append(np.stack([able[text], low, length, period])[:, keep])
    text, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    text, start, length, period = text[order], start[order], length[order], period[order]
    # One stretch found with several periods: they are multiples of its smallest.
    new = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    text, start, length, period = text[new], start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return text[order], start[order] - starts[text[order]], length[order], period[order]


def strongest(lengths: list[int], periods: list[int]) -> int | None:
    """Place of the greatest exact ``length / period``, the first of equals; None without runs."""
    best = None
    for k, (length, period) in enumerate(zip(lengths, periods)):
        if best is None or length * periods[best] > lengths[best] * period:
            best = k
    return best


Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = 4, shortest: int = 6,
    prepare: Prepare | None = None, words_at_once: int = 250_000,
) -> DataFrame:
    """``doc_id, n_words, runs, best, collapsed`` of every row.

    Words are stretches without ASCII white space. ``runs`` is ``array<struct<start, length, period>>`` in words from 0, by start,
    then period; ``best`` the place in it of the run with the greatest length for its period (null without runs); ``collapsed``
    the words joined by one space, without those that a run holds after its first period. ``prepare`` may change the words of a
    row before they are searched. Null, empty and blank texts have no words and no runs. Repeated rows give equal rows, a null
    id stays null, other columns are left out, an empty table gives an empty one. A text of any length is searched whole; a
    batch is searched in portions of about ``words_at_once`` words.
    """
    if times < 2:
        raise ValueError("a run has two periods at least")
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def search(batches):
        import pyarrow as pa

        for batch in batches:
            ids = batch.column(0).to_pylist()
            portion, held = [], 0
            for at, part in slices(range(len(ids))):
                texts = batch.column(1).slice(at, len(part)).cast(pa.binary()).to_pylist()
                for key, text in zip(ids[at : at + len(part)], texts):
                    words = text.split() if text else []
                    portion.append((key, prepare(key, words) if prepare else words))
                    held += len(words)
                    if held >= words_at_once:
                        yield _searched(portion, times, shortest)
                        portion, held = [], 0
            if portion:
                yield _searched(portion, times, shortest)

    return kept.mapInArrow(
        search, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, best int, collapsed string"
    )


def _searched(portion: list[tuple[int | None, list[bytes]]], times: int, shortest: int):
    import pyarrow as pa

    number = defaultdict(count().__next__)
    sizes = np.array([len(words) for _, words in portion], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    sequence = np.empty(int((sizes + 1).sum()), np.int64)
    for (_, words), start, size in zip(portion, starts.tolist(), sizes.tolist()):
        sequence[start : start + size] = list(map(number.__getitem__, words))
    ends = starts + sizes
    sequence[ends] = len(number) + np.arange(len(ends))
    text, start, length, period = runs_of(sequence, starts, sizes, times, shortest)
    edges = np.zeros(len(sequence) + 1, np.int64)
    np.add.at(edges, starts[text] + start + period, 1)
    np.add.at(edges, starts[text] + start + length, -1)
    keep = np.cumsum(edges)[:-1] == 0
    many = np.bincount(text, minlength=len(portion))
    bounds = np.append(0, np.cumsum(many))
    best, collapsed = [None] * len(portion), []
    lengths, periods = length.tolist(), period.tolist()
    for t in np.flatnonzero(many):
        own = slice(bounds[t], bounds[t + 1])
        best[t] = strongest(lengths[own], periods[own])
    for t, (_, words) in enumerate(portion):
        if many[t]:
            words = compress(words, keep[starts[t] : ends[t]].tolist())
        collapsed.append(b" ".join(words))
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([key for key, _ in portion], pa.int64()), pa.array(sizes, pa.int64()),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs), pa.array(best, pa.int32()),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        ["doc_id", "n_words", "runs", "best", "collapsed"],
    )
