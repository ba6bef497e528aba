"""Packing, token files and sharding against brute force, and on edge rows."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from plain import SF_DIR, ids_of
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seatgrid.llm import packing, queries, sharding, tokenids
from seatgrid.llm.common import Encoder

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoders():
    return {path: Encoder(path, memo=50) for path in (WORDS, BYTES)}


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_equals_the_tokenizer(encoders, documents, edge_rows, path):
    texts = [r[1] for r in [*documents[:60], *edge_rows] if r[1] and len(r[1]) < 50_000]
    assert encoders[path].encode([*texts, None, ""]) == [ids_of(path, t) for t in texts] + [b"", b""]


@settings(max_examples=400, deadline=None)
@example("\nİ")
@example("aİ. ǅ ŉ ßẞ")
@given(st.text(alphabet="aZé'.,1 \n\n\t\r　\x1c#!Σ́ßİ", max_size=25))
def test_encoder_equals_the_tokenizer_on_odd_texts(encoders, text):
    for path, encoder in encoders.items():
        assert encoder.encode([text]) == [ids_of(path, text)]


def test_encoder_asks_its_memo_once_for_a_word_of_a_call():
    class Memo(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

    encoder, texts = Encoder(WORDS), [f"a {'the word, of ' * 500}end\n"] * 20
    encoder.words = Memo()
    assert encoder.encode(texts) == [ids_of(WORDS, texts[0])] * 20
    assert encoder.words.asked < 20


@pytest.mark.parametrize("text", ["\n", "a\n", " a", "a ", "a  b", "a\n\nb", "\na", "a\x1cb", "<|endoftext|>"])
def test_encoder_on_single_short_texts(encoders, text):
    for path, encoder in encoders.items():
        assert encoder.encode([text]) == [ids_of(path, text)]


def sequential_best_fit(lengths: list[int], capacity: int) -> int:
    gaps: list[int] = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def check_packed(rows, capacity):
    """rows: (sequence, offset, length); every sequence is gapless from 0."""
    ends: dict[int, int] = {}
    for sequence, offset, length in sorted(rows):
        assert offset == ends.get(sequence, 0)
        ends[sequence] = offset + length
    assert all(e <= capacity for e in ends.values())
    return len(ends)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=60))
def test_runs_pack_as_well_as_one_by_one(lengths):
    runs = packing.best_fit_runs({n: lengths.count(n) for n in set(lengths)}, 24)
    rows = []
    for n in set(lengths):
        own = runs[runs[:, 0] == n]
        for rank in range(lengths.count(n)):
            _, first, sequence, each, offset = own[own[:, 1] <= rank][-1].tolist()
            rows.append((sequence + (rank - first) // each, offset + (rank - first) % each * n, n))
    assert check_packed(rows, 24) == sequential_best_fit(lengths, 24)


def test_op1_places_every_id_once(spark, documents):
    rows = queries.op1_best_fit_packing(spark, SF_DIR).collect()
    check_packed([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 2048)
    want = []
    for doc_id, text, *_ in documents:
        ids = ids_of(WORDS, text) + bytes(4)
        for piece, at in enumerate(range(0, len(ids), 8192)):
            want.append((doc_id, piece, at // 4, len(ids[at : at + 8192]) // 4, zlib.crc32(ids[at : at + 8192])))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)


def test_packing_of_edge_rows(spark, edge_docs, edge_rows, no_docs):
    rows = packing.pack_documents(edge_docs, WORDS, 64).collect()
    check_packed([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 64)
    assert sum(r["length"] for r in rows) == sum(len(ids_of(WORDS, r[1] or "")) // 4 + 1 for r in edge_rows)
    assert packing.pack_documents(no_docs, WORDS).collect() == []


def test_op5_reads_back_what_the_tokenizer_gives(spark, documents):
    rows = sorted(queries.op5_token_ids(spark, SF_DIR).collect(), key=lambda r: r["start"])
    start = 0
    for row, (doc_id, text, *_) in zip(rows, documents, strict=True):
        ids = ids_of(BYTES, text) + np.array([2], "<u4").tobytes()
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (doc_id, start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4


def test_token_files_of_edge_rows(spark, edge_docs, edge_rows, no_docs, tmp_path):
    manifest = tokenids.write_token_ids(edge_docs, f"file://{tmp_path}/a", BYTES)
    rows = sorted(tokenids.read_token_ids(spark, f"file://{tmp_path}/a", manifest).collect(), key=lambda r: r["start"])
    end = np.array([2], "<u4").tobytes()
    want = sorted((r[0] is not None, r[0] or 0, ids_of(BYTES, r[1] or "") + end) for r in edge_rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["ids"])) for r in rows) == want
    assert [r["doc_id"] for r in rows] == sorted((r[0] for r in edge_rows), key=lambda k: (k is not None, k or 0))
    bounds = [tuple(r) for r in manifest.select("shard", "low", "high").collect()]
    assert len(tokenids.lookup(f"{tmp_path}/a", bounds, 4)) == 2
    assert tokenids.lookup(f"{tmp_path}/a", bounds, -7) == [ids_of(BYTES, edge_rows[9][1]) + end]
    assert tokenids.lookup(f"{tmp_path}/a", bounds, 7) == []
    empty = tokenids.write_token_ids(no_docs, f"{tmp_path}/b", BYTES)
    assert empty.collect() == [] and tokenids.read_token_ids(spark, f"{tmp_path}/b", empty).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
def test_perfect_hash_is_minimal(keys):
    keys = np.array(sorted(keys), np.int64)
    index = tokenids.Index.load(tokenids.Index.build(4, keys, 0, np.arange(len(keys) + 1)).dump())
    assert sorted(index.mph.slots(keys).tolist()) == list(range(len(keys)))
    first, many = index.find(keys)
    assert first.tolist() == list(range(len(keys))) and (many == 1).all()


def greedy(sizes: list[int], capacity: int) -> list[list[int]]:
    out: list[list[int]] = [[]]
    for n in sizes:
        if out[-1] and sum(out[-1]) + n > capacity:
            out.append([])
        out[-1].append(n)
    return out


def check_shards(rows, source, shards):
    texts: dict[str, list] = {}
    for doc_id, text in source:
        texts.setdefault(text or "", []).append(doc_id)
    sizes = {t: (len(t.encode()) + 1) * len(ids) for t, ids in texts.items()}
    order = sorted(texts, key=lambda t: (min((i for i in texts[t] if i is not None), default=-(2**70)), t))
    best = next(c for c in range(max(max(sizes.values()), -(-sum(sizes.values()) // shards)), sum(sizes.values()) + 1) if len(greedy([sizes[t] for t in order], c)) <= shards)
    load: dict[int, int] = {}
    places: dict[tuple, set] = {}
    for r in rows:
        load[r["shard"]] = load.get(r["shard"], 0) + r["size"]
        places.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert max(load.values()) == best and set(load) <= set(range(shards))
    assert all(len(p) == 1 for p in places.values())
    for shard in load:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


def test_op9_has_the_smallest_capacity(spark, documents):
    rows = queries.op9_minimax_sharding(spark, SF_DIR).collect()
    check_shards(rows, [d[:2] for d in documents], 8)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == [(d[0], len(d[1].encode()) + 1, zlib.crc32(d[1].encode())) for d in documents]


def test_sharding_of_edge_rows(spark, edge_docs, edge_rows, no_docs, tmp_path):
    for shards in (1, 3, 40):
        rows = sharding.shard_documents(edge_docs, shards).collect()
        assert len(rows) == len(edge_rows)
        check_shards(rows, [r[:2] for r in edge_rows], shards)
    assert sharding.shard_documents(no_docs).collect() == []
    sharding.write_shards(edge_docs.drop("rank"), f"{tmp_path}/shards", 3)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == len(edge_rows) and back.select("shard").distinct().count() <= 3


def test_hot_length_is_dealt_over_tasks(spark):
    pieces = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(100).cast("long").alias("length"))
    rows = packing.best_fit(pieces, 2048).collect()
    assert check_packed([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 2048) == 200


def test_a_lookup_reads_a_few_numbers_only(spark, tmp_path):
    """Every key of a small shard and of a large one, keys that are not there, and the bytes read of the index."""
    read = {}
    for n in (50, 20_000):
        docs = spark.range(n).selectExpr("id * 3 - 60 AS doc_id", "concat('text ', id) AS text").coalesce(1)
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        try:
            manifest = tokenids.write_token_ids(docs, f"{tmp_path}/{n}", BYTES)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        bounds = [(r["shard"], r["low"], r["high"]) for r in manifest.collect()]
        counts = []
        for i in range(0, n, max(1, n // 200)):
            assert tokenids.lookup(f"{tmp_path}/{n}", bounds, 3 * i - 60, counts) == [ids_of(BYTES, f"text {i}") + np.array([2], "<u4").tobytes()]
            assert tokenids.lookup(f"{tmp_path}/{n}", bounds, 3 * i - 59, counts) == []
        read[n] = max(counts)
        size = (tmp_path / str(n) / f"shard-{bounds[0][0]:05d}.idx").stat().st_size
    assert size > 700_000 and read[20_000] < 600 and read[20_000] < 3 * read[50]
