"""Token ids of documents as raw binary shards, with a minimal perfect hash index for keyed access.

Documents are range-sorted by id; each sorted partition becomes one shard of two files, written by the task that
holds it:

``shard-NNNNN.ids``  ids of its documents, one after the other, little-endian, unsigned 16-bit if the vocabulary
    and the end id have no more than 65,536 ids, else 32-bit.
``shard-NNNNN.idx``  eight-byte ``TOKIDX01``, then little-endian: counts (6 x u64: bytes of an id, rows, null keys, distinct keys,
    levels, words of all levels), keys (i64 each row), offsets (u64, rows + 1, in ids), level sizes in 64-bit words (u64 each), level bits (u64),
    ones before each word (u64), then for each slot of the hash its first row (u64), its rows (u64) and a fingerprint (u32).

A key's slot: at the first level whose bit at hash(key, level) mod bits is set, the number of ones before it. A level
sets the bits that exactly one of the keys left hashes to; the others go to the next one. The stored fingerprint tells keys that
are not there. A task writes to a name of its own and renames, so a task that runs twice leaves one whole file.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatgrid.llm.common import encoder, slices

MAGIC = b"TOKIDX01"
# The odd constants of a common 64-bit finaliser.
_MIX_1, _MIX_2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15
MANIFEST = "shard int, rows long, tokens long, low long, high long"


def _hash(keys: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64((level + 1) * _STEP % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * _MIX_1
        x = (x ^ (x >> np.uint64(27))) * _MIX_2
        return x ^ (x >> np.uint64(31))


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 1 << 20) & np.uint64(0xFFFFFFFF)).astype("<u4")


class PerfectHash:
    """Minimal perfect hash over distinct signed 64-bit keys: slots 0 to n - 1, no key stored."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, ones: np.ndarray):
        self.sizes, self.words, self.ones = sizes, words, ones

    @classmethod
    def build(cls, keys: np.ndarray, room: float = 2.0) -> PerfectHash:
        sizes, levels, left = [], [], np.asarray(keys, np.int64)
        while len(left):
            size = max(1, -(-int(len(left) * room) // 64))
            at = (_hash(left, len(sizes)) % np.uint64(size * 64)).astype(np.int64)
            alone = np.bincount(at, minlength=size * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[at]]
        words = np.concatenate(levels) if levels else np.zeros(0, "<u8")
        ones = np.bitwise_count(words).astype(np.int64)
        return cls(np.array(sizes, "<u8"), words, (np.cumsum(ones) - ones).astype("<u8"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level has a bit for it (then it is not in the index for sure)."""
        keys = np.asarray(keys, np.int64)
        out, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = _hash(keys[left], level) % np.uint64(size * 64)
            word, bit = base + (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (self.ones[word].astype(np.int64) + np.bitwise_count(below))[hit]
            left, base = left[~hit], base + size
        return out


class Index:
    """A shard's index: keys in order, offsets, and the hash from key to rows."""

    def __init__(self, width, keys, nulls, offsets, mph, first, rows, prints):
        self.width, self.keys, self.nulls, self.offsets, self.mph, self.first, self.rows, self.prints = width, keys, nulls, offsets, mph, first, rows, prints

    @classmethod
    def build(cls, width: int, keys: np.ndarray, nulls: int, offsets: np.ndarray) -> Index:
        """``keys`` ascending, the first ``nulls`` of them null; equal keys are one entry with many rows."""
        distinct, first, rows = np.unique(keys[nulls:], return_index=True, return_counts=True)
        mph = PerfectHash.build(distinct)
        order = np.argsort(mph.slots(distinct))
        return cls(width, keys, nulls, offsets, mph, first[order] + nulls, rows[order], _fingerprints(distinct[order]))

    def dump(self) -> bytes:
        counts = struct.pack("<6Q", self.width, len(self.keys), self.nulls, len(self.first), len(self.mph.sizes), len(self.mph.words))
        parts = [(self.keys, "<i8"), (self.offsets, "<u8"), (self.mph.sizes, "<u8"), (self.mph.words, "<u8"), (self.mph.ones, "<u8"), (self.first, "<u8"), (self.rows, "<u8"), (self.prints, "<u4")]
        return MAGIC + counts + b"".join(np.asarray(a).astype(k).tobytes() for a, k in parts)

    @classmethod
    def load(cls, raw: bytes) -> Index:
        if raw[:8] != MAGIC:
            raise ValueError("not a token index")
        width, n, nulls, keys, levels, words = struct.unpack_from("<6Q", raw, 8)
        at, out = 56, []
        for kind, many in (("<i8", n), ("<u8", n + 1), ("<u8", levels), ("<u8", words), ("<u8", words), ("<u8", keys), ("<u8", keys), ("<u4", keys)):
            out.append(np.frombuffer(raw, kind, many, at))
            at += many * np.dtype(kind).itemsize
        return cls(width, out[0], nulls, out[1].astype(np.int64), PerfectHash(*out[2:5]), out[5].astype(np.int64), out[6].astype(np.int64), out[7])

    def widened(self, raw: bytes) -> bytes:
        """Ids as unsigned 32-bit."""
        return raw if self.width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row of each key and its number of rows; -1 and 0 for keys that are not there."""
        if not len(self.first):
            return np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        slots = self.mph.slots(keys)
        there = (slots >= 0) & (self.prints[slots] == _fingerprints(np.asarray(keys, np.int64)))
        return np.where(there, self.first[slots], -1), np.where(there, self.rows[slots], 0)


def _files(folder: str):
    """File system and path of a folder that all machines share."""
    from pyarrow import fs

    scheme, colon, rest = folder.partition(":")
    if colon and scheme == "file":
        folder = "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(folder)


def write_token_ids(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Writes the shards into ``folder``; returns one row per shard (``MANIFEST``).

    Rows are in order of id, nulls first, equal ids by their texts' hashes; each text is followed by ``end_id``. A null text counts as
    empty. There are as many shards as shuffle partitions: set these by the size of the input. An empty table writes none.
    """
    from pyspark import TaskContext

    def write(batches):
        import pyarrow as pa

        words, shard = encoder(tokenizer), TaskContext.get().partitionId()
        width = 2 if max(words.tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        end = np.array([end_id], "<u4").tobytes()
        files, base = _files(folder)
        own = f"{base}/.{shard:05d}-{uuid.uuid4().hex}"
        keys, nulls, sizes, out = [], 0, [], None
        for batch in batches:
            texts = batch.column(1)
            for at, part in slices(batch.column(0).to_pylist()):
                if out is None:
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(f"{own}.ids")
                found = words.encode(texts.slice(at, len(part)).to_pylist())
                raw = b"".join([x for ids in found for x in (ids, end)])
                out.write(raw if width == 4 else np.frombuffer(raw, "<u4").astype("<u2").tobytes())
                sizes.extend(len(ids) // 4 + 1 for ids in found)
                nulls += sum(k is None for k in part)
                keys.extend(0 if k is None else k for k in part)
        if out is None:
            return
        out.close()
        keys = np.array(keys, np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
        with files.open_output_stream(f"{own}.idx") as idx:
            idx.write(Index.build(width, keys, nulls, offsets).dump())
        for kind in ("ids", "idx"):
            files.move(f"{own}.{kind}", f"{base}/shard-{shard:05d}.{kind}")
        bounds = (None, None) if nulls == len(keys) else (int(keys[nulls]), int(keys[-1]))
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        row = (shard, len(keys), int(offsets[-1]), *bounds)
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=["shard", "rows", "tokens", "low", "high"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return docs.sparkSession.createDataFrame(rows.mapInArrow(write, MANIFEST).collect(), MANIFEST)


def read_token_ids(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every row, out of the files; ``start`` counts the ids of all rows before.

    Every key is looked up in its shard's index, and the ids are read at the offset found there.
    """
    shards = sorted(map(tuple, manifest.select("shard", "tokens").collect()))
    starts = np.concatenate([[0], np.cumsum([t for _, t in shards])]).tolist() if shards else []
    tasks = spark.createDataFrame([(s, b) for (s, _), b in zip(shards, starts)], "shard int, base long")
    tasks = tasks.repartition(max(1, len(shards)), "shard")

    def read(batches: Iterator):
        import pyarrow as pa

        files, base = _files(folder)
        for batch in batches:
            for shard, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = f"{base}/shard-{shard:05d}"
                index = Index.load(files.open_input_file(f"{name}.idx").read())
                keys, first = np.unique(index.keys[index.nulls :]), np.zeros(0, np.int64)
                found, many = index.find(keys)
                if (found < 0).any():
                    raise ValueError(f"{name}.idx does not find its own keys")
                rows = np.concatenate([np.arange(index.nulls), np.repeat(found, many) + np.concatenate([first, *map(np.arange, many)])]).astype(np.int64)
                with files.open_input_file(f"{name}.ids") as payload:
                    for at in range(0, len(rows), 512):
                        part = rows[at : at + 512]
                        starts, ends = index.offsets[part], index.offsets[part + 1]
                        low = int(starts.min())
                        payload.seek(index.width * low)
                        raw = index.widened(payload.read(index.width * (int(ends.max()) - low)))
                        ids = [raw[4 * (a - low) : 4 * (b - low)] for a, b in zip(starts.tolist(), ends.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(index.keys[part], pa.int64(), mask=part < index.nulls), pa.array(starts + before, pa.int64()),
                                pa.array(ends - starts, pa.int64()), pa.array(ids, pa.binary()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids"],
                        )

    return tasks.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


class _At:
    """Numbers of a fixed layout in an open file, read one or a few at a time; ``read`` counts the bytes."""

    def __init__(self, file):
        self.file, self.read = file, 0

    def numbers(self, at: int, kind: str, many: int = 1) -> list[int]:
        kind = np.dtype(kind)
        self.file.seek(at)
        raw = self.file.read(kind.itemsize * many)
        self.read += len(raw)
        return np.frombuffer(raw, kind).tolist()


def _rows_of(idx: _At, key: int) -> tuple[int, list[int]]:
    """Bytes of an id, and the offsets that the rows of a key start and end at; none if the key is not there.

    Reads the header and the level sizes, one word for each level until one has the key's bit, and one slot with its key.
    """
    idx.file.seek(0)
    if idx.file.read(8) != MAGIC:
        raise ValueError("not a token index")
    width, n, nulls, keys, levels, words = idx.numbers(8, "<u8", 6)
    offsets = 56 + 8 * n
    sizes = offsets + 8 * (n + 1)
    bits = sizes + 8 * levels
    ones, own, base = bits + 8 * words, np.array([key], np.int64), 0
    for level, size in enumerate(idx.numbers(sizes, "<u8", levels) if levels else []):
        at = int(_hash(own, level)[0]) % (size * 64)
        [word] = idx.numbers(bits + 8 * (base + at // 64), "<u8")
        if word >> at % 64 & 1:
            break
        base += size
    else:
        return width, []
    [before] = idx.numbers(ones + 8 * (base + at // 64), "<u8")
    slot = before + (word & ((1 << at % 64) - 1)).bit_count()
    first_at = ones + 8 * words
    [first] = idx.numbers(first_at + 8 * slot, "<u8")
    [many] = idx.numbers(first_at + 8 * (keys + slot), "<u8")
    [stored] = idx.numbers(first_at + 16 * keys + 4 * slot, "<u4")
    if stored != int(_fingerprints(own)[0]) or idx.numbers(56 + 8 * first, "<i8") != [key]:
        return width, []
    return width, idx.numbers(offsets + 8 * first, "<u8", many + 1)


def lookup(folder: str, manifest: list[tuple[int, int, int]], key: int, count: list[int] | None = None) -> list[bytes]:
    """The raw ids of each row of one key; ``manifest`` holds ``(shard, low, high)``.

    Reads a few numbers of a shard's index, as many for a shard of any size but for the levels of its hash, and the ids of the key's
    rows. ``count`` takes the bytes read of each index.
    """
    files, base = _files(folder)
    out = []
    for shard, low, high in manifest:
        if low is None or not low <= key <= high:
            continue
        with files.open_input_file(f"{base}/shard-{shard:05d}.idx") as file:
            idx = _At(file)
            width, offsets = _rows_of(idx, key)
            if count is not None:
                count.append(idx.read + 8)
        if offsets:
            with files.open_input_file(f"{base}/shard-{shard:05d}.ids") as payload:
                for start, end in zip(offsets, offsets[1:]):
                    payload.seek(width * start)
                    raw = payload.read(width * (end - start))
                    out.append(raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes())
    return out
