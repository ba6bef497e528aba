"""Helpers shared by the text operators: stored tables, ranks within groups, tokenizer access."""

from __future__ import annotations

from array import array
from codecs import charmap_decode
from collections.abc import Sequence
from string import punctuation
from unicodedata import is_normalized

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatgrid.session import ensure_scratch, scratch_path


BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``; a local session without one is given its own.

    Also sees to it that Arrow batches hold at most ``BATCH_ROWS`` rows, since rows are whole texts here.
    """
    ensure_scratch(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return scratch_path(spark, name)


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts the lineage and survives lost executors.

    The default makes the smallest files; others need no memory outside the heap, which counts where a job keeps many tables.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str, to: str = "rank") -> DataFrame:
    """``df`` with ``to``: each row's place, gapless from 0, within its group by ``order``.

    Rows are range-sorted on group and order together, so a group with most of the rows lies over many
    partitions. The sorted rows are stored with a row number of (partition, place); what is added up is one
    count for each group and partition. Equal rows get different places. A null group is a group.
    """
    keys = [*groups, *order]
    rows = stored(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()),
        name,
    ).withColumn("_part", F.shiftright("_at", 33))
    runs = rows.groupBy(*groups, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(runs.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_part").alias("_p"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    ), f"{name}-runs")  # stored, so that the join is planned by its true size and the rows stay where they are
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(groups):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(runs, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(to))


def doc_hash(column: str = "doc_id") -> Column:
    """crc32 of an id as text, unsigned; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


# White space next to white space, or of a kind at which words may not be cut safely; fixed values.
_ODD = (
    "  ", " \n", " \t", " \r", " \x0b", " \x0c", "\n\n", "\n ", "\n\t", "\n\r", "\n\x0b", "\n\x0c", "\t\n", "\r\n", "\x0b\n",
    "\x0c\n", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", "\u1680", "\u180e", "\u2000", "\u2001", "\u2002", "\u2003",
    "\u2004", "\u2005", "\u2006", "\u2007", "\u2008", "\u2009", "\u200a", "\u200b", "\u2028", "\u2029", "\u202f", "\u205f",
    "\u3000", "\ufeff",
)
_PROBES = "the there Well ABC wOrd thinking zzzq eR xylophone für Éa mañana ßÜ œuvre".split()
# Byte-level vocabularies write a visible Latin-1 byte as that character and the others as characters from 256 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _VISIBLE]
_BYTE_CHARS = "".join(chr(256 + _HIDDEN.index(b)) if b in _HIDDEN else chr(b) for b in range(256))


# Where one of them stands in a text, or a blank at its front or end.
_ODD_SPACE = "|".join(("^ ", r" \z", *_ODD))


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes, with a memo of words.

    A space or line break before a visible character always starts a new pre-token in the supported byte-level and
    word vocabularies, so the ids of a text are those of its led words in order; each new word is encoded once while the
    memo (``memo`` words at most) holds it. Of a new word, punctuation after letters is a pre-token of its own, and letters
    alone may go to the model behind the tokenizer at once, if that is seen to give the same. Texts with other kinds of
    white space, or with the text of an added token, where all this does not hold for sure, go to the tokenizer whole.
    Texts are split into words as Arrow arrays, so that the memo is asked once for each different word of a call.
    """

    def __init__(self, path: str, memo: int = 1_500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize  # looked up once: the model is wrapped anew each time it is asked for
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added if not t.normalized]
        self.folded = [t.content.lower() for t in added if t.normalized]
        self.memo, self.words, self.tails = memo, {}, {}
        self.line = self._ids(["\n"])[0]
        self.lead, self.fold = None, False
        for lead, fold in (("\u0120", False), ("", True)):  # as the model sees a space-led word
            self.lead, self.fold = lead, fold
            led, bare = self._ids([f" {w}" for w in _PROBES]), self._ids(_PROBES)
            if [self._model(w, True) for w in _PROBES] == led and [self._model(w, False) for w in _PROBES] == bare:
                break
        else:
            self.lead = None

    def _marked(self, text: str) -> bool:
        return any(t in text for t in self.added) or (bool(self.folded) and any(t in text.lower() for t in self.folded))

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _model(self, word: str, led: bool) -> bytes:
        word = word.lower() if self.fold else word
        if not word.isascii():
            word = charmap_decode(word.encode(), "strict", _BYTE_CHARS)[0]
        word = f"{self.lead}{word}" if led else word
        return array("I", [t.id for t in self.tokenize(word)]).tobytes()

    def _learn(self, new: set[str]) -> None:
        words, tails, rest = self.words, self.tails, []
        for word in new:
            led = word[0] != "\n"
            body = word if led else word[1:]
            core = body.rstrip(punctuation)
            plain = core.isalpha() and (
                core.isascii() or (max(core) < "\u0250" and core.lower().isalpha() and is_normalized("NFC", core))
            )
            if self.lead is None or not plain:
                rest.append(word)
                continue
            key, tail = core if led else f"\n{core}", body[len(core) :]
            ids = words.get(key)
            if ids is None:
                words[key] = ids = self._model(core, led) if led else self.line + self._model(core, led)
            if tail:
                if tail not in tails:
                    if len(tails) > 10_000:
                        tails.clear()
                    tails[tail] = self._ids([tail])[0]
                words[word] = ids + tails[tail]
        words.update(zip(rest, self._ids([w if w[0] == "\n" else f" {w}" for w in rest])))

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text; a null text counts as empty."""
        import pyarrow as pa
        import pyarrow.compute as pc

        out = [b""] * len(texts)
        if len(self.words) > self.memo:
            self.words.clear()
        column = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(column, _ODD_SPACE).to_pylist()
        split: list[int] = []
        whole: list[int] = []
        for i, text in enumerate(texts):
            if text:
                (whole if odd[i] or self._marked(text) else split).append(i)
        if split:
            parts = pc.split_pattern(pc.replace_substring(column.take(pa.array(split)), "\n", " \n"), " ")
            ends = parts.offsets.to_numpy()
            is_led = np.ones(ends[-1], bool)
            is_led[ends[:-1]] = False
            heads = self._ids(parts.values.take(pa.array(ends[:-1])).to_pylist())
            led, places = self._led(parts.values.filter(pa.array(is_led)))
            places = places[ends - np.arange(len(ends))].tolist()
            for i, head, start, end in zip(split, heads, places, places[1:]):
                out[i] = head + led[start:end]
        for i, ids in zip(whole, self._ids([texts[i] for i in whole])):
            out[i] = ids
        return out

    def _led(self, parts) -> tuple[memoryview, np.ndarray]:
        """Ids of an Arrow array of led words one after the other, and in which byte each word's begin (and the last one's end)."""
        import pyarrow as pa

        if not len(parts):
            return memoryview(b""), np.zeros(1, np.int64)
        coded = parts.dictionary_encode()
        keys = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.words.get, keys))
        new = [k for k, ids in enumerate(found) if ids is None]
        self._learn({keys[k] for k in new})
        for k in new:
            found[k] = self.words[keys[k]]
        ids = pa.array(found, pa.large_binary()).take(coded.indices)
        _, places, data = ids.buffers()
        return memoryview(b"" if data is None else data), np.frombuffer(places, np.int64, len(ids) + 1, 8 * ids.offset)


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, memo: int = 1_500_000) -> Encoder:
    """One per worker process, vocabulary and size of the memo (about 250 bytes a word)."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if (path, memo) not in _encoders:
        _encoders[path, memo] = Encoder(path, memo)
    return _encoders[path, memo]


def slices(values: list, most: int = 256):
    """Short runs of a batch, so that a batch of long texts is not held twice."""
    for i in range(0, len(values), most):
        yield i, values[i : i + most]
