"""Merkle manifest, periodic runs and document fingerprints against plain versions, on whole small tables and edge rows."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from oracle import compare
from plain import SF_DIR
from pyspark.sql import functions as F

from seatgrid.llm import fingerprints, merkle, periods, queries

LARGER = "/root/testdata/sf0.01"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


# --- Merkle manifest -------------------------------------------------------------------------------------


def plain_levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def plain_manifest(rows):
    """``rows`` of (source, doc_id, leaf, claimed); results in any order."""
    by = {}
    for row in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])):
        by.setdefault(row[0], []).append(row)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_levels([r[2] for r in by[s]]) for s in sources}
    top = plain_levels([trees[s][-1][0] for s in sources])
    out = []
    for number, s in enumerate(sources):
        for place, (_, doc_id, leaf, folded) in enumerate(by[s]):
            proof = ""
            for levels, at in ((trees[s], place), (top, number)):
                for level in levels[:-1]:
                    run = level[at // 3 * 3 :][:3]
                    proof += "".join(run[: at % 3] + run[at % 3 + 1 :])
                    folded = sha("".join(run[: at % 3] + [folded] + run[at % 3 + 1 :]))
                    at //= 3
            out.append((doc_id, leaf, trees[s][-1][0], proof, folded))
    return out, top[-1][0]


def leaf_of(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode('utf-8', 'surrogatepass'))}:{v}" for v in values))


def check_manifest(spark, rows):
    frame = spark.createDataFrame(rows, "source string, doc_id long, leaf string, claimed string")
    manifest = merkle.build_manifest(frame.select("source", "doc_id", F.unhex("leaf").alias("leaf"), F.unhex("claimed").alias("claimed")))
    got = [(r["doc_id"], r["leaf"], r["subroot"], bytes(r["proof"]).hex(), r["folded_root"]) for r in merkle.climb(manifest, proofs=True).collect()]
    want, root = plain_manifest(rows)
    assert manifest.root == root
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(r["proof_sha256"] == sha(bytes(r["proof"]).hex()) for r in merkle.climb(manifest, proofs=True).collect())


def test_op11_equals_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{LARGER}/documents.parquet'")
    assert compare(spark, LARGER, db, queries.op11_merkle_manifest, queries.SQL["op11_merkle_manifest"]) == []


def test_op11_equals_plain_manifest(spark, documents):
    rows = []
    for doc_id, text, lang, source, n_chars in documents:
        leaf = leaf_of(doc_id, source, lang, n_chars, text)
        flat = text.replace("\n", "") if text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 else text
        rows.append((source, doc_id, leaf, leaf_of(doc_id, source, lang, n_chars, flat)))
    want, root = plain_manifest(rows)
    got = queries.op11_merkle_manifest(spark, SF_DIR).collect()
    assert sorted((r["doc_id"], r["leaf"], r["subroot"], r["proof_sha256"], r["folded_root"]) for r in got) == sorted(
        (i, leaf, sub, sha(proof), folded) for i, leaf, sub, proof, folded in want
    )
    assert all(r["root"] == root and r["verified"] == (r["folded_root"] == root) for r in got)
    truth = {i: leaf == claimed for _, i, leaf, claimed in rows}
    assert all(r["verified"] == truth[r["doc_id"]] for r in got) and len(set(truth.values())) == 2


def test_manifest_of_many_tiers(spark):
    """More leaves than two tiers of a source hold, more sources than one row holds, lone leaves, runs of one."""
    rows = [("hot", i, sha(f"h{i}"), sha(f"h{i}" if i % 3 else "x")) for i in range(81 * 81 + 2)]
    rows += [(f"s{i % 99}", i, sha(f"s{i}"), sha(f"s{i}")) for i in range(500)]
    rows += [(None, 1, sha("n"), sha("n")), ("é", 5, sha("e"), sha("f"))]
    rows += [("full", i, sha(f"f{i}"), sha(f"f{i}")) for i in range(81)] + [("over", i, sha(f"o{i}"), sha(f"o{i}")) for i in range(82)]
    check_manifest(spark, rows)


@pytest.mark.parametrize("rows", [
    [("a", 1, sha("x"), sha("x"))],
    [(None, None, sha("x"), sha("y")), (None, None, sha("x"), sha("y")), (None, 3, sha("z"), sha("z")), ("", None, sha(""), sha(""))],
    [("a", 7, sha("same"), sha("same"))] * 250,
])
def test_manifest_of_few_and_equal_rows(spark, rows):
    check_manifest(spark, rows)


def test_manifest_of_edge_rows(spark, edge_docs, edge_rows, no_docs):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    def build(docs):
        leaf = F.unhex(merkle.row_digest([F.col(c) for c in columns]))
        return merkle.build_manifest(docs.withColumn("leaf", leaf).withColumn("claimed", leaf))
    manifest = build(edge_docs)
    got = merkle.climb(manifest).collect()
    assert sorted(r["leaf"] for r in got) == sorted(leaf_of(i, source, lang, n, text) for i, text, lang, source, n in edge_rows)
    assert {r["folded_root"] for r in got} == {manifest.root}
    empty = build(no_docs)
    assert empty.root is None and merkle.climb(empty, proofs=True).collect() == []


def test_a_recursion_may_have_any_number_of_rows(spark):
    before = spark.conf.get(merkle.ROW_LIMIT)
    spark.conf.set(merkle.ROW_LIMIT, "50")
    try:
        check_manifest(spark, [("a", i, sha(str(i)), sha(str(i))) for i in range(300)])
        assert spark.conf.get(merkle.ROW_LIMIT) == "50"
    finally:
        spark.conf.set(merkle.ROW_LIMIT, before)


# --- periodic runs ---------------------------------------------------------------------------------------


def plain_runs(words, times=4, shortest=6):
    """Every stretch of every period by plain comparison, smallest periods first."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((start, length, q) for (start, length), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_best(runs):
    best = None
    for start, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (start, length, q)
    return best


def plain_collapsed(words, runs):
    gone = {k for start, length, q in runs for k in range(start + q, start + length)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


def test_extensions_equal_word_by_word():
    rng = random.Random(5)
    for letters in (1, 2, 3, 50):
        words = [rng.randrange(letters) for _ in range(300)] + [letters]
        extensions = periods.Extensions(np.array(words))
        pairs = [(i, j) for i in range(0, 300, 7) for j in range(i + 1, 301, 5)]
        got = extensions.lce(*np.array(pairs).T)
        for (i, j), far in zip(pairs, got):
            want = 0
            while j + want < len(words) and words[i + want] == words[j + want]:
                want += 1
            assert far == want


@pytest.mark.parametrize("times", [2, 3, 4, 6])
def test_runs_equal_plain_search(times):
    rng = random.Random(times)
    for _ in range(120):
        texts = []
        for _ in range(rng.randint(1, 6)):
            n, letters = rng.randint(0, 80), rng.randint(1, 4)
            words = [rng.randrange(letters) for _ in range(n)]
            if n > 8 and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
                words = [words[i] if i < a else words[min(n - 1, a + (i - a) % p)] for i in range(n)]
            texts.append([str(w).encode() for w in words])
        shortest = rng.choice([1, 6])
        rows = periods._searched(list(enumerate(texts)), times, shortest).to_pylist()
        for row, words in zip(rows, texts):
            runs = plain_runs(words, times, shortest)
            assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == runs
            assert row["collapsed"].encode() == plain_collapsed(words, runs) and row["n_words"] == len(words)
            assert (row["best"] is None) == (not runs)
            if runs:
                assert runs[row["best"]] == plain_best(runs)


def test_grid_in_small_portions_finds_the_same():
    words = np.array([1, 2, 3] * 40 + [4] + [5] * 30 + [6, 7] * 20 + [9])
    starts, sizes = np.array([0]), np.array([len(words) - 1])
    whole = periods.runs_of(words, starts, sizes)
    assert list(zip(*map(np.ndarray.tolist, whole))) == [(0, 0, 120, 3), (0, 121, 30, 1), (0, 151, 40, 2)]
    for a, b in zip(whole, periods.runs_of(words, starts, sizes, at_once=3)):
        assert (a == b).all()


def test_op12_equals_plain_search(spark, documents):
    got = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, SF_DIR).collect()}
    assert len(got) == len(documents)
    with_runs = 0
    for doc_id, text, *_ in documents:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 2500 and h % 10:
            continue  # the plain search is too slow for these; shorter ones and repeated tails are all compared
        runs, r = plain_runs(words), got[doc_id]
        best = plain_best(runs)
        with_runs += bool(runs)
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"]) == (best or (None, None, None))
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{length},{q}\n" for s, length, q in runs))
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapsed(words, runs)).hexdigest()
    assert with_runs > 5


def test_runs_of_edge_rows(spark, edge_docs, edge_rows, no_docs):
    rows = periods.find_runs(edge_docs).collect()
    def key(i, runs):
        return repr((i, runs))
    want = [key(r[0], plain_runs((r[1] or "").encode().split())) for r in edge_rows if len((r[1] or "").split()) < 3000]
    got = [key(r["doc_id"], [tuple(x) for x in r["runs"]]) for r in rows if r["n_words"] < 3000]
    assert sorted(got) == sorted(want)
    repeats = {r["doc_id"]: r for r in rows}[9]  # "1 2-3" twenty thousand times
    assert [tuple(x) for x in repeats["runs"]] == [(1, 19_999, 1)] and repeats["collapsed"].startswith("1 2-31 2-3a")
    assert periods.find_runs(no_docs).collect() == []
    with pytest.raises(ValueError):
        periods.find_runs(no_docs, times=1)


# --- document fingerprints -------------------------------------------------------------------------------


def plain_fingerprint(text):
    """Votes one term and one bit at a time."""
    from xxhash import xxh64_intdigest

    full = (1 << 64) - 1

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & full
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & full
        return x ^ (x >> 31)

    words = [xxh64_intdigest(w, 13) for w in (text or "").encode("utf-8", "surrogatepass").lower().split()]
    pairs = [mix((a * 0x9E3779B97F4A7C15 + b) & full) for a, b in zip(words, words[1:])]
    votes = [0.0] * 64
    for terms, each in ((words, 1.0), (pairs, fingerprints.PAIR_WEIGHT)):
        for term in set(terms):
            weight = each * (1 + math.log2(terms.count(term)))
            for bit in range(64):
                votes[bit] += weight if term >> bit & 1 else -weight
    return votes


def agrees(votes, value):
    """Bits as voted; a vote that is even but for rounding may fall either way."""
    return all(abs(v) < 1e-3 * (1 + sum(map(abs, votes)) / 64) or (v > 0) == bool(value >> bit & 1) for bit, v in enumerate(votes))


def test_op13_equals_plain_version(spark, documents):
    got = {r["doc_id"]: r for r in queries.op13_document_fingerprints(spark, SF_DIR).collect()}
    assert sorted(got) == [d[0] for d in documents]
    prints = {i: int(r["fingerprint"], 16) for i, r in got.items()}
    for k, (doc_id, text, *_) in enumerate(documents):
        r, after = got[doc_id], documents[(k + 1) % len(documents)]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[1][:half]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == sha(changed)
        if len(text) < 2500:
            assert agrees(plain_fingerprint(text), prints[doc_id])
        if len(changed) < 2500:
            assert agrees(plain_fingerprint(changed), int(r["edited_fingerprint"], 16))
        for near, other in ((r["near_edited"], int(r["edited_fingerprint"], 16)), (r["near_next"], prints[after[0]])):
            assert near == pytest.approx(max(0.0, math.cos(math.pi * (prints[doc_id] ^ other).bit_count() / 64)), abs=1e-9)
        assert r["n_near"] == sum((prints[doc_id] ^ p).bit_count() <= 3 for i, p in prints.items() if i != doc_id)
    same = {}
    for doc_id, text, *_ in documents:
        same.setdefault(text, set()).add(prints[doc_id])
    assert all(len(p) == 1 for p in same.values())


def test_edited_texts_are_nearer_than_the_next(spark):
    rows = queries.op13_document_fingerprints(spark, LARGER).filter("n_chars > 200").collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) >= 0.95 * len(rows)
    assert 0.4 <= sum(r["near_edited"] for r in rows) / len(rows) <= 0.7


@pytest.mark.parametrize("radius, blocks, tile", [(3, 5, 2048), (3, 5, 8), (2, 4, 16), (6, 8, 64), (0, 2, 2048)])
def test_near_counts_equal_all_pairs(spark, monkeypatch, radius, blocks, tile):
    """Clusters far larger than a tile, with and without copies."""
    monkeypatch.setattr(fingerprints, "TILE", tile)
    rng = random.Random(radius)
    prints = {0: 2, (1 << 64) - 1: 1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 40])):
            p = centre
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                p ^= 1 << bit
            prints[p] = rng.randint(1, 3)
    signed = [(p - (1 << 64) if p >> 63 else p, n) for p, n in prints.items()]
    frame = spark.createDataFrame(signed, "fingerprint long, n long")
    got = {r["fingerprint"] % (1 << 64): r["near"] for r in fingerprints.near_counts(frame, radius, blocks).collect()}
    want = {p: sum(n for q, n in prints.items() if q != p and (p ^ q).bit_count() <= radius) for p in prints}
    assert got == {p: n for p, n in want.items() if n}


def test_blocks_must_outnumber_differing_bits():
    with pytest.raises(ValueError):
        fingerprints.block_masks(3, 3)


def test_fingerprints_of_edge_rows(spark, edge_docs, edge_rows, no_docs):
    rows = fingerprints.against_edits(edge_docs).collect()
    assert sorted(repr((r["doc_id"], r["n_chars"])) for r in rows) == sorted(repr((i, len(t or ""))) for i, t, *_ in edge_rows)
    of = {r["doc_id"]: r for r in rows}
    assert of[1]["fingerprint"] == of[2]["fingerprint"] == of[3]["fingerprint"] == 0 and of[4]["fingerprint"] == of[5]["fingerprint"]
    assert of[1]["edited_sha256"] == sha("")
    assert fingerprints.against_edits(no_docs).collect() == []
    text = edge_rows[4][1]
    one = fingerprints.against_edits(edge_docs.filter("doc_id = 5")).collect()
    half = len(text) // 2
    assert len(one) == 1 and one[0]["edited_sha256"] == sha(text[: len(text) - half] + text[:half]) and one[0]["next_fingerprint"] == one[0]["fingerprint"]
    near = fingerprints.with_near(edge_docs.select("doc_id", "extra", fingerprints.fingerprint(F.col("text")).alias("fingerprint")))
    assert near.count() == len(edge_rows) and near.columns == ["doc_id", "extra", "fingerprint", "n_near"]


def test_next_texts_across_partitions(spark):
    """Many rows of one id, and more partitions than rows in some of them."""
    docs = spark.range(0, 400, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text of "), F.col("id") % 50).alias("text")
    )
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = fingerprints.against_edits(docs).collect()
        rows = docs.select("doc_id", F.xxhash64("text").alias("h"), "text").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    rows = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"]))
    want = []
    for k, r in enumerate(rows):
        half = len(r["text"]) // 2
        want.append((r["doc_id"], sha(r["text"][: len(r["text"]) - half] + rows[(k + 1) % len(rows)]["text"][:half])))
    assert sorted(((r["doc_id"], r["edited_sha256"]) for r in got), key=repr) == sorted(want, key=repr)
