"""Interleaving sources by target weights with Pfair earliest-deadline-first scheduling.

A source's rows are taken in a fixed pseudo-random order and cut into blocks. With w the share of a source, an exact fraction, its
block k (from 0) is released at slot floor(k / w) and due by slot ceil((k + 1) / w); every slot goes to the released block that is
due first. Shares add up to one, so all deadlines are met, and until a source ends it is less than one block away from its
share after any number of slots.

The schedule is worked out over blocks, not rows: one count for each stream goes in, and it is stored by and by as it comes out, so
that the driver holds one piece of it however many rows there are, and blocks have the same size on every input. Rows read their
slots off that table, and everything that touches rows is a DataFrame expression. The ``named`` largest sources are streams; where there are more, the others
share one stream of their joint weight, in which each row has a deadline of its own by its source's weight.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatgrid.llm.common import ranked, scratch, stored

REST = "<rest>"
NULL = "<null>"
PIECE = 200_000  # blocks of a schedule held at once


def schedule(weights: dict[str, float | Fraction], blocks: dict[str, int]) -> list[tuple[str, int, int]]:
    """``(stream, block, slot)`` of all blocks in order of slots: earliest deadline first among the released, ties by name.

    Streams in ``weights`` without blocks leave their slots empty, as do streams that have ended.
    """
    return list(slots(weights, blocks))


def slots(weights: dict[str, float | Fraction], blocks: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """:func:`schedule`, one block after the other; its state is one entry for each stream."""
    exact = {s: Fraction(w) for s, w in weights.items() if w > 0}
    total = sum(exact.values())
    steps = {s: total / w for s, w in exact.items()}  # slots per block
    waiting = [(0, s, 0) for s in steps if blocks.get(s, 0)]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slot = 0

    def deadline(stream: str, block: int) -> int:
        step = steps[stream]
        return -(-(block + 1) * step.numerator // step.denominator)

    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, stream, block = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline(stream, block), stream, block))
        _, stream, block = heapq.heappop(ready)
        yield stream, block, slot
        if block + 1 < blocks[stream]:
            heapq.heappush(waiting, ((block + 1) * steps[stream].numerator // steps[stream].denominator, stream, block + 1))
        slot += 1


def _stored_schedule(spark: SparkSession, weights: dict[str, float | Fraction], blocks: dict[str, int], piece: int = PIECE) -> DataFrame:
    """The schedule as a table, written piece by piece."""
    path, schema = scratch(spark, "mix-plan"), "_stream string, _block long, _slot long"
    coming = slots(weights, blocks)
    part = list(islice(coming, piece))
    while True:
        spark.createDataFrame(part, schema).write.mode("append").parquet(path)
        part = list(islice(coming, piece))
        if not part:
            return spark.read.schema(schema).parquet(path)


def _with_streams(rows: DataFrame, listed: DataFrame | None) -> DataFrame:
    """``rows`` with ``stream``; ``listed`` has the sources that are streams (as many as are named at most), None for all."""
    if listed is None:
        return rows.withColumn("stream", F.col("source"))
    listed = F.broadcast(listed.select(F.col("source").alias("_listed")))
    return rows.join(listed, F.col("source") == F.col("_listed"), "left").withColumn("stream", F.coalesce("_listed", F.lit(REST))).drop("_listed")


def _by_deadline(rest: DataFrame, counts: DataFrame, temperature: float) -> DataFrame:
    """Rows of the shared stream with ``_due``, when the k-th row of a source is due by its weight."""
    rest = ranked(rest.drop("_due"), ["source"], ["_draw", "doc_id"], "mix-rest", "_k")
    weights = counts.select(F.col("source").alias("_of"), F.pow(F.col("rows").cast("double"), F.lit(temperature)).alias("_weight"))
    return rest.join(weights, F.col("source") == F.col("_of")).withColumn("_due", (F.col("_k") + 1) / F.col("_weight")).drop("_k", "_of", "_weight")


def mix(
    docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int = 16, most_blocks: int | None = None, named: int = 10_000,
    temperature: float = 1.0, seed: int = 7, carry: bool = False,
) -> DataFrame:
    """Every row once: ``doc_id, source, stream, block, slot, place``; the mix is the order of ``slot, place``.

    ``weights`` maps sources to any positive numbers; the others share one stream, ``<rest>``, of its weight there, or of a
    thousandth of the sum. Without it weights are row counts to the power ``temperature`` (1: as found, so that all streams end
    together; 0: all equal), and sources beyond the ``named`` largest share a stream of their joint weight, each at its own pace in it.
    A block has ``block_rows`` rows, or, if ``most_blocks`` is given, as many as leave that many blocks. When a stream has no rows left its slots stay empty
    and the others keep their turns.

    Null sources are a source of their own (``<null>``). Rows with equal ids, repeated ones and null ids too, follow each other in any
    order; an empty table gives an empty one. ``carry`` keeps the columns of ``docs`` as a struct ``row``.
    """
    source = F.coalesce(F.col("source").cast("string"), F.lit(NULL))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"),
        F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed)).alias("_draw"), F.lit(None).cast("double").alias("_due"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    counts = stored(docs.groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("rows")), "mix-counts")
    if weights is None:
        most = {r["source"]: r["rows"] for r in counts.orderBy(F.desc("rows"), "source").limit(named).collect()}
        shares = {s: n**temperature for s, n in most.items()}
    else:
        weights = {s: w for s, w in weights.items() if w > 0}
        asked = [s for s in weights if s != REST]
        most = {r["source"]: r["rows"] for r in counts.filter(F.col("source").isin(*asked)).collect()} if asked else {}
        shares = {s: weights[s] for s in asked}
    listed = rows.sparkSession.createDataFrame([(s,) for s in most], "source string") if most else counts.select("source").limit(0)
    others = counts.join(F.broadcast(listed), "source", "left_anti")
    sums = others.agg(F.sum("rows").alias("rows"), F.sum(F.pow(F.col("rows").cast("double"), F.lit(temperature))).alias("weight")).first()
    if sums["rows"]:
        most[REST] = sums["rows"]
        shares[REST] = sums["weight"] if weights is None else weights.get(REST, sum(shares.values()) / 1000 or 1.0)
    rows = _with_streams(rows, listed if sums["rows"] else None)
    if sums["rows"]:
        rest = _by_deadline(rows.filter(F.col("stream") == REST), others, temperature)
        rows = rows.filter(F.col("stream") != REST).unionByName(rest)
    if most_blocks is not None:
        block_rows = max(block_rows, -(-sum(most.values()) // most_blocks))
    rows = ranked(rows, ["stream"], ["_due", "_draw", "doc_id"], "mix-ranked", "_rank")
    plan = _stored_schedule(docs.sparkSession, shares, {s: -(-n // block_rows) for s, n in most.items()})
    rows = rows.withColumn("block", F.floor(F.col("_rank") / F.lit(block_rows)).cast("long"))
    rows = rows.join(plan, (F.col("stream") == F.col("_stream")) & (F.col("block") == F.col("_block")))
    return rows.select(
        "doc_id", "source", "stream", "block", F.col("_slot").alias("slot"), (F.col("_rank") % block_rows).cast("int").alias("place"),
        *(["row"] if carry else []),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, unchanged, sorted into the mix."""
    return mix(docs, carry=True, **options).orderBy("slot", "place").select("row.*")
