"""Language and toxicity models on held-out rows, exact search against brute force, and all of them on edge rows."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pytest
from oracle import compare
from plain import SF_DIR
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from seatgrid.llm import languages, queries, topk, toxicity

LARGER = "/root/testdata/sf0.01"


def test_op3_on_held_out_texts(spark):
    rows = {r["doc_id"]: r for r in queries.op3_language_id(spark, LARGER).collect()}
    truth = duckdb.sql(f"SELECT doc_id, text, lang FROM '{LARGER}/documents.parquet'").fetchall()
    assert len(rows) == len(truth)
    right = total = 0
    for doc_id, text, lang in truth:
        r = rows[doc_id]
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        if r["held_out"]:
            total, right = total + 1, right + (r["lang_pred"] == lang)
    assert right >= 0.97 * total


def test_languages_of_edge_rows(spark, edge_docs, no_docs):
    model = languages.fit_languages(edge_docs.filter("doc_id > 0"), per_language=5)
    assert sorted(x for own in model.families.values() for x in own) == ["de", "en", "es", "xx"]
    rows = edge_docs.select("text", languages.predict_language(F.col("text"), model).alias("p")).collect()
    assert all((r["p"]["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in rows)
    assert languages.fit_languages(no_docs) is None
    assert {r[0] for r in edge_docs.select(languages.predict_language(F.col("text"), None)["lang_pred"]).collect()} == {"und"}
    one = languages.fit_languages(edge_docs.filter("lang = 'xx'"))
    assert edge_docs.select(languages.predict_language(F.col("text"), one)["lang_pred"].alias("l")).filter("l = 'xx'").count() == 12


def test_sample_takes_a_copied_text_once(spark):
    docs = spark.range(3000).select(F.lit("en").alias("lang"), F.when(F.col("id") < 2000, "same text").otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    texts = [r["text"] for r in languages.training_sample(docs, 300, 3).collect()]
    assert len(texts) == len(set(texts)) and 200 <= len(texts) <= 300


def test_every_language_is_learnt(spark, monkeypatch):
    class Machine:
        coefficients, intercept = DenseVector([0.0]), 0.0

        def fit(self, pair):
            return self

    monkeypatch.setattr(languages, "LinearSVC", lambda **_: Machine())
    names = ["en", "de", "fr", *(f"x{i:02}" for i in range(40))]
    rows = [(name, f"{chr(0x400 + 9 * i)}word {k} of {name}") for i, name in enumerate(names) for k in range(3)]
    model = languages.fit_languages(spark.createDataFrame(rows, "lang string, text string"))
    assert sorted(x for own in model.families.values() for x in own) == sorted(names)
    assert len(model.machines) < 200  # of 903 pairs
    for own in (list(model.families), *model.families.values()):
        assert all((a, b) in model.machines for i, a in enumerate(sorted(own)) for b in sorted(own)[i + 1 :])


def test_op4_on_held_out_texts(spark):
    rows = {r["doc_id"]: r for r in queries.op4_toxicity(spark, LARGER).collect()}
    ids = [r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{LARGER}/documents.parquet'").fetchall()]
    assert sorted(rows) == sorted(ids)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    truth = duckdb.sql(f"SELECT doc_id, toxic FROM '{LARGER}/labels.parquet'").fetchall()
    held = [(t, rows[i]["predicted"]) for i, t in truth if rows[i]["held_out"]]
    assert sum(p for t, p in held if t) >= 0.7 * sum(t for t, _ in held)
    assert sum(p for t, p in held if not t) <= 0.02 * len(held)


def test_label_model_finds_accuracies_without_labels():
    rng = np.random.default_rng(4)
    truth = rng.random(6000) < 0.2
    votes = np.full((6000, 4), toxicity.NONE)
    for j, (hit, wrong) in enumerate([(0.9, 0.02), (0.8, 0.05), (0.7, 0.02)]):
        votes[rng.random(6000) < np.where(truth, hit, wrong), j] = toxicity.TOXIC
    votes[:, 3] = votes[:, 2]  # says what another voter says
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    post = toxicity.label_model({tuple(map(int, p)): int(n) for p, n in zip(patterns, counts)})
    right = np.mean([(post[tuple(map(int, v))] > 0.5) == t for v, t in zip(votes, truth)])
    best = sum(max(t, n - t) for p, n in zip(patterns, counts) for t in [truth[(votes == p).all(1)].sum()]) / len(truth)
    assert right > best - 0.005


def test_toxicity_of_edge_rows(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(1, 0, 1), (4, 0, 0), (4, 0, None), (None, 0, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity(edge_docs, labels, F.col("doc_id") > 0).collect()
    assert sorted(r["doc_id"] or 0 for r in rows) == sorted(r[0] or 0 for r in edge_rows)
    assert all(0 <= r["score"] < 0.7 for r in rows)
    assert toxicity.toxicity(no_docs, labels, F.col("doc_id") > 0).collect() == []
    assert len(toxicity.toxicity(edge_docs, labels.limit(0), F.col("doc_id") > 0).collect()) == len(edge_rows)


def test_op6_equals_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{LARGER}/embeddings.parquet'")
    assert compare(spark, LARGER, db, queries.op6_exact_top_k, queries.SQL["op6_exact_top_k"]) == []


def brute(rows, asked, k):
    out = []
    for q, v in asked.items():
        found = sorted((-sum(int(a) * int(b) for a, b in zip(v, w)), i) for i, w in rows if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("largest", [1.0, 1e6])
def test_search_on_ties_copies_and_few_rows(spark, largest, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)  # more annuli than so few rows would get
    rng = np.random.default_rng(7)
    vectors = [(i, (largest * rng.normal(size=8)).tolist()) for i in range(400)]
    vectors += [(i, [0.25] * 8) for i in range(400, 700)] + [(3, [1.0] * 8), (700, []), (701, [0.5])]
    bad = [(None, [1.0] * 8), (900, None), (901, [1.0, None]), (902, [float("nan")] * 8), (950, [float("inf")])]
    table = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    rows = topk.whole_vectors(table)
    whole = [(i, np.floor(256 * np.array(v)).tolist()) for i, v in vectors]
    assert sorted((r["vec_id"], r["v"]) for r in rows.collect()) == sorted(whole)
    asked = {i: v for i, v in whole if i % 50 == 0}
    found = topk.Search(rows, pivots=6, rings=4).top(rows.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"), 5)
    assert sorted(map(tuple, found.collect())) == brute(whole, asked, 5)
    few = rows.filter("vec_id in (1, 2, 50)")
    got = topk.Search(few).top(few.withColumnRenamed("vec_id", "query_id"), 5).collect()
    assert sorted(map(tuple, got)) == brute([x for x in whole if x[0] in (1, 2, 50)], {i: v for i, v in whole if i in (1, 2, 50)}, 5)
    none = rows.filter("vec_id < 0")
    assert topk.Search(none).top(none.withColumnRenamed("vec_id", "query_id")).collect() == []
