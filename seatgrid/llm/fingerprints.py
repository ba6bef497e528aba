"""Document fingerprints by SimHash over weighted terms, and permuted block tables to find those within a Hamming radius.

A text's terms are its words and its pairs of neighbouring words, lower-cased (``[a-z]`` only). A term that occurs c times weighs
1 + log2(c), pairs twice that: pairs tell texts of one language apart, words hold where a short text has few pairs. Every bit of a
term's 64-bit hash votes with the term's weight, for or against; a fingerprint bit is 1 where the votes for it have more weight.

For a radius r the 64 bits are cut into blocks, r + 2 or more. Two fingerprints at most r bits apart agree on all but r blocks, so
each choice of the others makes a table in which the chosen blocks come first and are the key. Fingerprints that share a key
in a table are compared as whole bits; a pair that shares keys in several tables counts in the first of them. Fingerprints of
equal documents are one entry with a count, and the fingerprints of a hot key are dealt into tiles, two of which meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatgrid.llm.common import slices, stored

BITS = 64
PAIR_WEIGHT = 2.0
TILE = 2048
_MEMO = 400_000
_word_hashes: dict[bytes, int] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finisher of the splitmix generator)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, in order."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    known = _word_hashes
    if len(known) > _MEMO:
        known.clear()
    out = list(map(known.get, words))
    if None in out:
        for k, value in enumerate(out):
            if value is None:
                out[k] = known[words[k]] = xxh64_intdigest(words[k], 13)
    return np.array(out, np.uint64)


def _fingerprint(words: np.ndarray) -> np.uint64:
    if not len(words):
        return np.uint64(0)
    with np.errstate(over="ignore"):
        pairs = _mixed(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    sums = np.zeros(BITS)
    whole = 0.0
    for terms, each in ((words, 1.0), (pairs, PAIR_WEIGHT)):
        terms, many = np.unique(terms, return_counts=True)
        weights = ((1 + np.log2(many)) * each).astype(np.float32)
        for at in range(0, len(terms), 1 << 14):
            own = weights[at : at + (1 << 14)]
            bits = np.unpackbits(terms[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sums += own @ bits.astype(np.float32)
            whole += float(own.sum(dtype=float))
    return np.packbits(2 * sums > whole, bitorder="little").view("<u8")[0]


def fingerprint(text: Column) -> Column:
    """Fingerprint of a whole text as a signed long; 0 for a text without words (null, empty, blank)."""

    @F.pandas_udf("long")
    def udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series(np.array([_fingerprint(_hashes(t)) for t in part], np.uint64).astype(np.int64))

    return udf(text.cast("string"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of the term weights that the differing bits of two fingerprints stand for, 0 if they stand for none."""
    apart = F.bit_count(a.bitwiseXOR(b))
    return F.when(apart >= BITS // 2, 0.0).otherwise(F.cos(apart * (np.pi / BITS)))


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), BITS // 4, "0"))


def block_masks(radius: int, blocks: int) -> list[int]:
    """Bits of the chosen blocks, for each table."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("needs more blocks than differing bits")
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    own = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(blocks)]
    return [sum(own[k] for k in chosen) for chosen in combinations(range(blocks), blocks - radius)]


def near_counts(prints: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """``fingerprint, near``: how many of ``prints`` (distinct ``fingerprint``, ``n``, how often) lie within ``radius``, others only.

    Fingerprints with none are left out. ``n`` adds up the neighbours' copies.
    """
    masks = block_masks(radius, blocks)
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    entry = F.explode(F.array(*[
        F.struct(F.lit(k).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(m).cast("long")).alias("key")) for k, m in enumerate(signed)
    ])).alias("e")
    entries = prints.select("fingerprint", "n", entry).select("fingerprint", "n", "e.table", "e.key")
    hot = entries.groupBy("table", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    hot = stored(hot.select("table", "key", F.ceil(F.col("members") / TILE).cast("int").alias("tiles")), "prints-shared")
    met = entries.join(hot, ["table", "key"]).withColumn("tile", F.pmod(F.xxhash64("fingerprint"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    cells = met.withColumn("other", other).withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))
    cells = cells.groupBy("table", "key", "low", "high").agg(F.collect_list(F.struct("tile", "fingerprint", "n")).alias("own"))
    keys = np.array(masks, np.uint64)

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            found = []
            tables, low, high, own = (batch.column(c) for c in ("table", "low", "high", "own"))
            flat, ends = own.flatten(), own.offsets.to_numpy()
            tile, prints, many = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            prints = prints.astype(np.int64).view(np.uint64)
            ends = ends - ends[0]
            for k, (table, i, j) in enumerate(zip(tables.to_pylist(), low.to_pylist(), high.to_pylist())):
                at = np.arange(ends[k], ends[k + 1])
                left, right = at[tile[at] == i], at[tile[at] == j]
                for some in range(0, len(left), 256):
                    a = left[some : some + 256]
                    apart = prints[a][:, None] ^ prints[right][None]
                    x, y = np.nonzero((np.bitwise_count(apart) <= radius) & (apart != 0))
                    for earlier in keys[:table]:
                        new = (apart[x, y] & earlier) != 0
                        x, y = x[new], y[new]
                    found.append((prints[a][x], many[right][y]))
                    if i != j:
                        found.append((prints[right][y], many[a][x]))
            if not found:
                continue
            whose, near = (np.concatenate(c) for c in zip(*found))
            whose, place = np.unique(whose, return_inverse=True)
            sums = np.zeros(len(whose), np.int64)
            np.add.at(sums, place, near)
            yield pa.RecordBatch.from_arrays([pa.array(whose.astype(np.int64)), pa.array(sums)], ["fingerprint", "near"])

    counted = cells.mapInArrow(compare, "fingerprint long, near long")
    return counted.groupBy("fingerprint").agg(F.sum("near").alias("near"))


def with_near(rows: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """``rows`` (stored, with ``fingerprint``) plus ``n_near``: how many other rows lie within ``radius``, copies included."""
    prints = stored(rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")), "prints")
    near = near_counts(prints, radius, blocks).select(F.col("fingerprint").alias("_of"), "near")
    counts = prints.join(near, F.col("fingerprint") == F.col("_of"), "left").select(
        F.col("fingerprint").alias("_of"), (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_near")
    )
    return rows.join(stored(counts, "prints-near"), F.col("fingerprint") == F.col("_of")).drop("_of")


PROBED = "part long, last boolean, doc_id long, n_chars long, edited_sha256 string, fingerprint long, edited_fingerprint long, next_fingerprint long, text string"


def _edited(text: str, after: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _probe(key: int | None, text: str, own: np.uint64, after: str, of_after: np.uint64) -> tuple:
    from hashlib import sha256

    changed = _edited(text, after)
    return (
        key, len(text), sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own, _fingerprint(_hashes(changed)), of_after,
    )


def against_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of the same text with its second half replaced, and of the next text.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint``. The last ``n_chars // 2`` code points
    give way to the first as many (or all) of the next document in ascending order of id; after the last comes the first. Rows of
    one id (nulls first) are in order of a hash of the text; a single row is its own next. A null text is an empty one.

    Texts are sorted once, by range, and read in one pass: a row meets the next one of its partition in passing. What is left are the
    last rows of the partitions, joined with the first rows of the next; these alone are stored with their texts.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # The number of a row tells equal rows apart, so that many of them can lie in several partitions.
    rows = rows.withColumn("_hash", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    keys = ["doc_id", "_hash", "_row"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text", F.spark_partition_id().cast("long").alias("part"))

    def walk(batches):
        import pyarrow as pa

        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        names = [c.split()[0] for c in PROBED.split(", ")]

        def out(rows: list[tuple]):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        before = None
        for batch in batches:
            ids, parts, done = batch.column(0).to_pylist(), batch.column(2), []
            for at, some in slices(range(len(ids))):
                for key, text in zip(ids[at : at + len(some)], batch.column(1).slice(at, len(some)).to_pylist()):
                    own = _fingerprint(_hashes(text))
                    if before is None:
                        part = parts[0].as_py()
                        yield out([(part, False, key, None, None, own.astype(np.int64), None, None, text)])
                    else:
                        probe = _probe(*before, text, own)
                        done.append((None, None, *probe[:3], *(x.astype(np.int64) for x in probe[3:]), None))
                    before = key, text, own
            if done:
                yield out(done)
        if before is not None:
            key, text, own = before
            yield out([(part, True, key, None, None, own.astype(np.int64), None, None, text)])

    probed = stored(rows.mapInArrow(walk, PROBED), "prints-probed")
    ends = probed.filter("part is not null")
    # Two rows a partition: the numbers of the parts alone come to the driver, one each.
    parts = sorted(r[0] for r in ends.filter("last").select("part").collect())
    following = F.create_map(*[F.lit(x) for p, q in zip(parts, parts[1:] + parts[:1]) for x in (p, q)]) if parts else F.create_map(F.lit(0), F.lit(0))
    last = ends.filter("last").select(
        F.element_at(following, F.col("part")).alias("part"), "doc_id", "text", "fingerprint"
    )
    first = ends.filter("not last").select("part", F.col("text").alias("after"), F.col("fingerprint").alias("next_fingerprint"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    changed = F.concat(F.substring("text", F.lit(1), F.char_length("text") - half), F.substring("after", F.lit(1), half))
    met = last.join(first, "part").withColumn("changed", changed).select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("changed", 256).alias("edited_sha256"), "fingerprint",
        fingerprint(F.col("changed")).alias("edited_fingerprint"), "next_fingerprint",
    )
    return probed.filter("part is null").select(*met.columns).union(met)
