"""Contiguous shards of nearly equal bytes, cut between groups of equal texts.

The law is ``bytes``. Groups of equal texts are atomic; they are put in order of their smallest id and numbered by
the bytes before and with them (a prefix sum over range-sorted, stored rows). The smallest capacity with which a
greedy sweep needs no more than the wanted number of shards is found by a search on the capacity, which narrows
to 1/(width + 1) with each round: the greedy cuts of all ``width`` capacities of a round are found together, one
pass over the prefix sums for each shard, in which parquet statistics leave only the row groups near the cuts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatgrid.llm.common import ranked, stored


def _prefixes(groups: DataFrame) -> tuple[DataFrame, int, int]:
    """Groups with ``below`` (bytes of all groups before), the largest group and the bytes of all."""
    rows = stored(
        groups.repartitionByRange("_first", "_key").sortWithinPartitions("_first", "_key")
        .withColumn("_at", F.monotonically_increasing_id()),
        "shard-groups",
    ).withColumn("_part", F.shiftright("_at", 33))
    parts = sorted(map(tuple, rows.groupBy("_part").agg(F.sum("_bytes"), F.max("_bytes")).collect()))
    sums = np.cumsum([0, *(p[1] for p in parts)]).tolist()
    shifts = stored(
        rows.sparkSession.createDataFrame(
            [(p[0], s) for p, s in zip(parts, sums)], "_p long, _shift long"
        ),
        "shard-shifts",
    )
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_below", F.coalesce(F.sum("_bytes").over(inside), F.lit(0)))
    rows = rows.join(shifts, F.col("_part") == F.col("_p")).select("_key", (F.col("_below") + F.col("_shift")).alias("_below"), "_bytes")
    return (
        stored(rows.repartitionByRange("_below").sortWithinPartitions("_below"), "shard-prefixes"),
        max((p[2] for p in parts), default=0), sums[-1],
    )


def _greedy(prefixes: DataFrame, capacities: list[int], shards: int, largest: int, total: int) -> list[list[int]]:
    """For each capacity the greedy cuts: bytes before each of the ``shards`` next shards' ends."""
    ends: list[list[int]] = [[0] for _ in capacities]
    top = F.col("_below") + F.col("_bytes")
    for _ in range(shards):
        aims = [e[-1] + c for e, c in zip(ends, capacities)]
        open_ = sorted({a for a in aims if a < total})
        found = {}
        if open_:
            near = F.lit(False)
            for a in open_:  # the last group that ends at or before the aim starts within two group sizes of it
                near |= F.col("_below").between(a - 2 * largest, a)
            row = prefixes.filter(near).agg(*[F.max(F.when(top <= a, top)).alias(str(a)) for a in open_]).first()
            found = {a: row[str(a)] for a in open_}
        for e, a in zip(ends, aims):
            e.append(total if a >= total else found[a] if found[a] is not None else e[-1])
    return ends


def minimax_cuts(prefixes: DataFrame, shards: int, largest: int, total: int, width: int = 24) -> list[int]:
    """The greedy cuts of the smallest capacity that is enough for ``shards`` shards; ``shards`` ends in bytes."""
    low, high = max(largest, -(-total // shards)), -(-total // shards) + largest
    best = None
    while best is None or low < high:
        tried = sorted({low + (high - low) * i // (width + 1) for i in range(width + 2)})
        ends = _greedy(prefixes, tried, shards, largest, total)
        enough = next(i for i, e in enumerate(ends) if e[-1] == total)
        best, high = ends[enough], tried[enough]
        low = tried[enough - 1] + 1 if enough else high
    return best[1:]


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot`` of every row.

    ``size`` is the UTF-8 bytes of the text plus 1. Equal texts lie in one shard, even if their group alone is
    larger than an even share; a null text counts as an empty one. ``slot`` numbers a shard's rows from 0 by id
    (nulls first); repeated rows get different slots. Fewer groups than shards leave shards empty.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("_sha"),
        ).withColumn("_key", F.unhex(F.substring("_sha", 1, 32))).drop("_sha"),
        "shard-rows",
    )
    groups = rows.groupBy("_key").agg(F.min("doc_id").alias("_first"), F.sum("size").alias("_bytes"))
    prefixes, largest, total = _prefixes(groups)
    cuts = minimax_cuts(prefixes, shards, largest, total) if total else []
    shard = F.lit(0)
    for cut in cuts[:-1]:
        shard += (F.col("_below") >= cut).cast("int")
    placed = rows.join(stored(prefixes.select("_key", shard.alias("shard")), "shard-of-group"), "_key")
    placed = ranked(placed.drop("_key"), ["shard"], ["doc_id", "text_crc32"], "shard-slots", "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> None:
    """All columns of ``docs`` as parquet, one folder ``shard=N`` for each shard that has rows."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = [F.col(id_col).cast("long").alias("_i"), F.crc32(text.cast("binary")).alias("_c"), (F.octet_length(text) + 1).cast("long").alias("_s")]
    place = shard_documents(docs, shards, id_col, text_col).select(
        F.col("doc_id").alias("_j"), F.col("text_crc32").alias("_d"), F.col("size").alias("_t"), "shard"
    ).distinct()
    own = docs.drop("shard").select("*", *key)
    own.join(place, F.col("_i").eqNullSafe(F.col("_j")) & (F.col("_c") == F.col("_d")) & (F.col("_s") == F.col("_t"))).drop(
        "_i", "_c", "_s", "_j", "_d", "_t"
    ).write.partitionBy("shard").parquet(path)
