"""The whole pipeline against a plain version of its stages: which rows stay, their texts, ids, places and numbers."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SCHEMA
from plain import SF_DIR, ids_of
from pyspark.sql import functions as F
from test_packing_tokens import check_packed, sequential_best_fit
from test_text_rules import plain_components, plain_disclosures, plain_print, plain_spans, plain_stats

import corpus_pipeline
from seatgrid.llm import mixing, privacy, quality

WORDS = public_tokenizers.path("word_bpe_49k.json")


def plain_clean(text: str, told: dict) -> str:
    """Texts with their spans replaced: the patterns', and the terms that tell of a kind the text holds, or of a value."""
    spans = [(int(a), n, int(b), kind) for n, kind, a, b in (
        (list(privacy.KINDS).index(s.split(":")[0]), *s.split(":")) for s in filter(None, plain_spans(text).split(","))
    )]
    kinds, shares = {kind for *_, kind in spans}, {}
    for (level, entity, term), share in told.items():
        if level == "value" or entity in kinds:
            shares[term] = max(share, shares.get(term, 0))
    blank = list(text)
    for a, _, b, _ in spans:
        blank[a:b] = " " * (b - a)
    for m in re.finditer(r"[\w'’-]+", "".join(blank)):
        if m.group().lower() in shares:
            spans.append((m.start(), 4, m.end(), "removed" if shares[m.group().lower()] >= privacy.REMOVE_AT else "term"))
    out, at = [], 0
    for a, _, b, kind in sorted(spans):
        if a >= at:
            out += [text[at:a], "" if kind == "removed" else f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def passes(text: str | None) -> bool:
    n_words, _, _, _, repeated = plain_stats(text)
    return n_words >= 20 and 100 * repeated <= 30 * n_words


def plain_rows(spark, docs):
    """Documents in the order of the mix, with their clean texts."""
    verdicts = quality.quality(docs).filter("kept").select("doc_id").collect()
    kept_ids = {r[0] for r in verdicts}  # an id of which one row fails the plain limits may have another that passes
    rows = [tuple(r) for r in docs.collect() if r["doc_id"] in kept_ids and passes(r["text"])]
    least = plain_components([(i, plain_print(text)) for i, text, *_ in rows])
    chosen = {}
    for i, text, _, source, _ in rows:
        if least[plain_print(text)] == i:
            chosen.setdefault(plain_print(text) if i is None else i, (i, text, source))
    kept = list(chosen.values())
    told = plain_disclosures([text for _, text, _ in kept])
    draws = {
        (r["doc_id"],): r["draw"]
        for r in spark.createDataFrame([(i,) for i, *_ in kept], "doc_id long").select("doc_id", F.xxhash64("doc_id", F.lit(7)).alias("draw")).collect()
    }
    by = defaultdict(list)
    for i, text, source in sorted(kept, key=lambda r: (draws[(r[0],)], r[0] if r[0] is not None else -(1 << 63))):
        by[source if source is not None else mixing.NULL].append((i, plain_clean(text, told)))
    weights = {s: len(own) ** corpus_pipeline.TEMPERATURE for s, own in by.items()}
    plan = mixing.schedule(weights, {s: -(-len(own) // 16) for s, own in by.items()})
    return [row for s, block, _ in plan for row in by[s][16 * block : 16 * block + 16]]


def check_run(spark, folder, docs):
    want = plain_rows(spark, docs)
    packed = corpus_pipeline.run(spark, str(folder)).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(i for i, _ in want)
    pieces = defaultdict(list)
    for r in sorted(packed, key=lambda r: r["start"]):
        pieces[r["doc_id"]].append(r)
    places = {i: n for n, (i, _) in enumerate(want)}
    for i, text in want:
        ids = ids_of(WORDS, text) + np.array([0], "<u4").tobytes()
        assert b"".join(bytes(r["ids"]) for r in pieces[i]) == ids
        assert [(r["piece"], r["start"], r["length"]) for r in pieces[i]] == [
            (n, start, min(2048, len(ids) // 4 - start)) for n, start in enumerate(range(0, len(ids) // 4, 2048))
        ]
    assert check_packed([(r["sequence_id"], r["offset"], r["length"]) for r in packed], 2048) == sequential_best_fit([r["length"] for r in packed], 2048)
    first = {}
    for r in packed:
        at = (places[r["doc_id"]], r["piece"])
        first[r["sequence_id"]] = min(first.get(r["sequence_id"], at), at)
    assert [first[n] for n in range(len(first))] == sorted(first.values())
    return packed


def test_run_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    assert len(check_run(spark, SF_DIR, docs)) > 100


def test_run_on_edge_rows(spark, edge_rows, documents, tmp_path):
    """Among documents of which some hold the texts of added tokens, personal data and the edge rows."""
    extra = [(9000 + k, f"{documents[100 + k][1]} write to k{k}@mail.org or <|endoftext|>", "en", None if k % 2 else "rare", 1) for k in range(40)]
    rows = [r for r in edge_rows if r[0] != 9] + list(documents[100:160]) + extra
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.select("*", *[F.lit("x").alias(c) for c in ("slot", "place", "row", "fingerprint", "marks", "number", "_rank")]).write.parquet(f"{tmp_path}/documents.parquet")
    check_run(spark, tmp_path, docs)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", "en", "a", 0)]])
def test_run_on_nothing(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
