"""Best-fit packing of documents into sequences, in bulk-synchronous supersteps.

Documents are cut into pieces and range-sorted by length; a piece is known by its length and its rank among the
pieces of that length. Gaps of open sequences are kept the same way: as runs (gap size, first sequence, count).
One superstep handles all pieces of one length, longest first: a sweep finds the successor gap (the smallest that
holds the length), conflicts between pieces are resolved by rank (rank r of the length goes to the r-th place),
the gaps are updated, and the sweep is repeated until no gap is left that fits; the rest open new sequences. The
plan of a superstep is runs, not rows: with capacity C there are at most C lengths and O(C log C) runs for any
number of documents. The rows themselves stay on the executors: every task sweeps its sorted pieces over
the runs and reads off sequence and offset.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatgrid.llm.common import encoder, ranked, slices, stored

PIECES = "doc_id long, piece int, start long, length long, ids binary"


def cut_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    memo: int = 1_500_000, carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per piece of a document: ``doc_id, piece, start, length, ids`` and the columns ``carry`` of ``docs``.

    ``ids`` are little-endian unsigned 32-bit ids, the document's followed by ``end_id``. Only documents of more
    than ``capacity`` ids are cut, every ``capacity`` ids. A null text is an empty one (its piece is the end id
    alone); a null id stays null; repeated rows give repeated pieces; other columns of ``docs`` are left out.
    """
    kept = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), *carry)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        import pyarrow as pa

        encode = encoder(tokenizer, memo).encode
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for at, part in slices(range(len(keys))):
                rows, of = [[], [], [], [], []], []
                for row, key, ids in zip(part, keys[at : at + len(part)], encode(texts.slice(at, len(part)).to_pylist())):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[start : start + 4 * capacity]
                        for column, value in zip(rows, (key, piece, start // 4, len(own) // 4, own)):
                            column.append(value)
                        of.append(row)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, k) for c, k in zip(rows, kinds)), *(c.take(pa.array(of, pa.int64())) for c in batch.columns[2:])],
                    names=["doc_id", "piece", "start", "length", "ids", *carry],
                )

    return kept.mapInArrow(cut, ", ".join([PIECES, *(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in carry)]))


def best_fit_runs(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs ``(length, first rank, first sequence, per sequence, offset)`` in order of length and rank.

    From a run's first rank on, each sequence from its first takes ``per sequence`` pieces, from ``offset`` on.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    opened = 0

    def free(gap: int, first: int, count: int) -> None:
        if gap and count > 0:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)  # the successor gap
            if at < len(sizes):
                gap = sizes[at]
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, first = capacity, opened
                count = -(-left // (capacity // length))
                opened += count
            each = gap // length
            runs.append((length, rank, first, each, capacity - gap))
            full = min(count, left // each)
            some = left % each if full < count else 0
            free(gap - each * length, first, full)
            free(gap - some * length, first + full, int(full < count))
            free(gap, first + full + 1, count - full - 1)
            rank, left = rank + full * each + some, left - full * each - some
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def best_fit(pieces: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs ``length`` from 1 to ``capacity``.

    Other columns are carried along. Pieces of one length are placed by ``order``; equal rows get different places.
    An empty table gives an empty table. Only the count of each length (``capacity`` numbers at most) goes to the driver.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = ranked(pieces.select(*columns), ["length"], list(order), "pack-ranked", "_rank")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    bad = [n for n in counts if n is None or not 0 < n <= capacity]
    if bad:
        raise ValueError(f"lengths outside 1..{capacity}: {bad[:3]}")
    runs = best_fit_runs(counts, capacity)
    schema = pieces.select(*columns, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema

    def place(batches):
        import pyarrow as pa

        starts = runs[:, 0] << 48 | runs[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            run = runs[np.searchsorted(starts, length << 48 | rank, "right") - 1] if len(runs) else runs
            behind = rank - run[:, 1]
            sequence, offset = run[:, 2] + behind // run[:, 3], run[:, 4] + behind % run[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=schema.names,
            )

    return pieces.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, **options) -> DataFrame:
    """Packed pieces of whole documents with their ids: ``doc_id, piece, start, length, ids, sequence_id, offset``.

    ``options`` go to :func:`cut_documents`. The texts are cut twice, to sample the lengths and to sort the pieces, so that
    ids are stored once only.
    """
    return best_fit(cut_documents(docs, tokenizer, capacity, end_id, **options), capacity)


def pack_in_order(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, order: tuple[str, ...] = ("slot", "place"), **options
) -> DataFrame:
    """As :func:`pack_documents`, with sequences numbered in the order of ``docs``.

    ``order`` names columns of ``docs`` (no ``piece``, ``start``, ``length``) that are never null and tell all its rows apart.
    Pieces of one length are placed by them, and a sequence's number is the place of its first piece in that order among the
    first pieces of all sequences. Places are worked out from lengths alone and joined to the texts, which are then
    encoded again, so that no ids are stored or shuffled. A null id stays null, a null text is an empty one, repeated rows are packed
    each (``order`` tells them apart), and an empty table gives an empty one.
    """
    cut = cut_documents(docs, tokenizer, capacity, end_id, carry=order, **options).select(*order, "piece", "length")
    placed = stored(best_fit(stored(cut, "pack-lengths"), capacity, (*order, "piece")), "pack-placed")
    first = placed.groupBy("sequence_id").agg(F.min(F.struct(*order, "piece")).alias("first")).select("sequence_id", "first.*")
    numbers = ranked(first, [], [*order, "piece"], "pack-numbers", "number").select("sequence_id", "number")
    places = placed.join(numbers, "sequence_id").groupBy(*order).agg(
        F.array_sort(F.collect_list(F.struct("piece", F.col("number").alias("sequence_id"), "offset"))).alias("places")
    )
    whole = docs.select("doc_id", "text", *order).join(places, list(order))
    pieces = cut_documents(whole, tokenizer, capacity, end_id, carry=("places",), **options)
    at = F.col("places")[F.col("piece")]
    return pieces.select("doc_id", "piece", "start", "length", "ids", at["sequence_id"].alias("sequence_id"), at["offset"].alias("offset"))
