"""Near-duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint is cut into segments, and a table for each segment holds all fingerprints under their value there. Of two fingerprints
at most r bits apart one of m segments differs in r div m bits at most, so the small Hamming ball of each segment's value is
enumerated, the table's entries under each value of the ball are fetched, and the complete distance is verified. A pair counts
in the first segment in which it can be found, so no pair is found twice.

A value that very many fingerprints share in a segment gets a second key: what is left of the fingerprint is cut into r + 1 parts, one
of which must be equal. A fingerprint has a bounded number of neighbours (2,080 within two bits), and so have the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatgrid.llm.common import stored
from seatgrid.llm.components import components

BITS = 64
#: Values that more fingerprints share than this get a second key.
HOT_VALUE = 256


def _fingerprint(text: str | None, words_each: int) -> int:
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII letters and white space only
    if not words:
        return 0
    if len(words) <= words_each:
        hashes = [xxh64_intdigest(b" ".join(words), 42)]
    else:
        shifted = [words[i:] for i in range(words_each)]
        hashes = [xxh64_intdigest(s, 42) for s in map(b" ".join, zip(*shifted))]
    values = np.array(hashes, np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(values), 1 << 15):
        ones += np.unpackbits(values[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(values)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, words_each: int = 3) -> Column:
    """SimHash of a whole text as a signed long: word shingles of ``words_each``, repeats included, hashed by XXH64.

    A text with fewer words is one shingle; null, empty and blank texts have fingerprint zero.
    """

    @F.pandas_udf("long")
    def udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([_fingerprint(t, words_each) for t in part], dtype="int64")

    return udf(text.cast("string"))


def segment_masks(segments: int) -> list[int]:
    """Bits of each segment."""
    if not 1 <= segments <= BITS:
        raise ValueError("a fingerprint has 1 to 64 segments")
    edges = [BITS * s // segments for s in range(segments + 1)]
    return [(1 << edges[s + 1]) - (1 << edges[s]) for s in range(segments)]


def _long(value: int) -> Column:
    return F.lit(value - (1 << BITS) if value >> (BITS - 1) else value).cast("long")


def _ball(mask: int, radius: int) -> list[int]:
    """All patterns of at most ``radius`` bits of a segment."""
    bits = [1 << i for i in range(BITS) if mask >> i & 1]
    return [sum(chosen) for k in range(radius + 1) for chosen in combinations(bits, k)]


def _rest_masks(mask: int, parts: int) -> list[int]:
    """The bits outside a segment in so many parts."""
    bits = [1 << i for i in range(BITS) if not mask >> i & 1]
    return [sum(bits[len(bits) * p // parts : len(bits) * (p + 1) // parts]) for p in range(parts)]


def candidates(prints: DataFrame, segments: int = 2, radius: int = 2) -> DataFrame:
    """Pairs ``a < b`` of ``prints`` (distinct ``fingerprint``) that a segment's table brings together, each with its ``segment``.

    Every pair at most ``radius`` bits apart is one of them, once for each segment that differs little enough.
    """
    masks, near = segment_masks(segments), radius // segments
    own = F.col("fingerprint")
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes each, but many entries
    prints = prints.repartition(tasks, "fingerprint").select("fingerprint")
    keys = [F.struct(F.lit(s).alias("segment"), own.bitwiseAND(_long(m)).alias("value")) for s, m in enumerate(masks)]
    table = stored(prints.select("fingerprint", F.explode(F.array(*keys)).alias("k")).select("k.*", "fingerprint"), "simhash-table")
    hot = stored(
        table.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_VALUE).select("segment", "value"), "simhash-hot"
    )

    def ball(s: int, mask: int) -> Column:
        around = F.array(*[_long(x) for x in _ball(mask, near)])
        return F.transform(around, lambda x: F.struct(F.lit(s).alias("segment"), own.bitwiseAND(_long(mask)).bitwiseXOR(x).alias("value")))

    asked = [ball(s, mask) for s, mask in enumerate(masks)]
    probes = prints.select(own.alias("a"), F.explode(F.concat(*asked)).alias("k")).select("a", "k.*")
    fetched = table.join(hot, ["segment", "value"], "left_anti").withColumnRenamed("fingerprint", "b")
    # Spark takes an explode for as many rows as go in, and would broadcast what comes out of it: such sides are shuffled at every size.
    found = probes.hint("merge").join(fetched, ["segment", "value"]).filter("a < b").select("a", "b", "segment")

    def parted(rows: DataFrame, column: str) -> DataFrame:
        parts = [
            F.array(*[F.struct(F.lit(p).alias("part"), F.col(column).bitwiseAND(_long(m)).alias("rest")) for p, m in enumerate(_rest_masks(mask, radius + 1))])
            for mask in masks
        ]
        of_segment = F.element_at(F.array(*parts), F.col("segment") + 1)
        return rows.join(hot, ["segment", "value"]).select("segment", "value", column, F.explode(of_segment).alias("r")).select("segment", "value", column, "r.*")

    if segments > 1:  # one segment is the whole fingerprint, which no two share
        left, right = parted(probes, "a"), parted(table.withColumnRenamed("fingerprint", "b"), "b")
        shared = left.hint("merge").join(right, ["segment", "value", "part", "rest"]).filter("a < b")
        apart = F.col("a").bitwiseXOR(F.col("b"))
        firsts = [
            F.coalesce(*[F.when(apart.bitwiseAND(_long(m)) == 0, p) for p, m in enumerate(_rest_masks(mask, radius + 1))]) for mask in masks
        ]
        shared = shared.filter(F.element_at(F.array(*firsts), F.col("segment") + 1) == F.col("part"))
        found = found.union(shared.select("a", "b", "segment"))
    return found


def links(prints: DataFrame, segments: int = 2, radius: int = 2) -> DataFrame:
    """All pairs ``a < b`` of ``prints`` (distinct ``fingerprint``) at most ``radius`` bits apart, each once."""
    masks, near = segment_masks(segments), radius // segments
    apart = F.col("a").bitwiseXOR(F.col("b"))
    first = F.coalesce(*[F.when(F.bit_count(apart.bitwiseAND(_long(m))) <= near, s) for s, m in enumerate(masks)])
    found = candidates(prints, segments, radius)
    return found.filter((F.bit_count(apart) <= radius) & (first == F.col("segment"))).select("a", "b")


def print_components(rows: DataFrame) -> DataFrame:
    """``fingerprint, root`` for fingerprints of ``rows`` that have a neighbour; the others are their own root."""
    return components(links(stored(rows.select("fingerprint").distinct(), "simhash-prints")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = 3) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` of every row.

    ``component_id`` is the smallest id reachable over links of at most two differing bits. Null ids do not
    count for the smallest (null only where a component has no other); repeated rows are linked to each other.
    """
    rows = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprint(F.col(text_col), words_each).alias("fingerprint")), "simhash-rows")
    first = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    found = print_components(rows).select(F.col("node").alias("fingerprint"), "root")
    named = first.join(found, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    named = stored(named, "simhash-named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = stored(named.join(least, "root").select("fingerprint", "component_id"), "simhash-of-print")
    return rows.join(of_print, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, words_each: int = 3) -> DataFrame:
    """One row of ``docs`` (``doc_id``, ``text`` and others) of each component: the smallest id, nulls last, then the smallest text hash.

    Of rows that agree in both, one is kept.
    """
    text_key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key.alias("text_key"), fingerprint(F.col("text"), words_each).alias("fingerprint")),
        "simhash-rows",
    )
    found = print_components(rows).select(F.col("node").alias("fingerprint"), "root")
    first = rows.groupBy("fingerprint").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first"))
    keepers = first.join(found, "fingerprint", "left").groupBy(F.coalesce("root", "fingerprint").alias("root")).agg(F.min("first").alias("first"))
    keepers = stored(keepers.select(F.coalesce("first.doc_id", F.lit(0)).alias("_keep_id"), F.col("first.no_id").alias("_keep_null"), F.col("first.text_key").alias("_keep_text")), "simhash-keepers")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select(
        F.struct(*columns).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_keep_id"),
        F.col("doc_id").isNull().alias("_keep_null"), text_key.alias("_keep_text"),
    )
    keys = ["_keep_id", "_keep_null", "_keep_text"]
    return whole.join(keepers, keys, "left_semi").dropDuplicates(keys).select("row.*")
