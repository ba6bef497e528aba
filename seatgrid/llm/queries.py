"""One query for each operator, over whole tables; ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from zlib import crc32

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatgrid.llm import (
    fingerprints, languages, merkle, mixing, packing, periods, privacy, quality, sharding, simhash, tokenids, topk, toxicity,
)
from seatgrid.llm.common import doc_hash, scratch, stored, table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048, 0)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.best_fit(stored(digests, "op1-pieces"), 2048)


def op2_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), temperature=0.7)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = doc_hash() % 5 == 0
    model = languages.fit_languages(docs.filter(~held_out))
    found = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), languages.predict_language(F.col("text"), model).alias("x"))
    return found.select("doc_id", "held_out", "x.*")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.toxicity(docs, labels, doc_hash() % 3 != 1)
    held_out = F.coalesce(doc_hash() % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-ids")
    manifest = tokenids.write_token_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return tokenids.read_token_ids(spark, folder, manifest).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(topk.whole_vectors(table(spark, sf_dir, "embeddings")), "topk-vectors")
    queries = rows.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "v")
    return topk.Search(rows).top(queries, 5)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def _of_kind(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op8_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.find_private(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *map(_of_kind, privacy.KINDS),
        F.sha2(privacy.span_list("base"), 256).alias("base_sha256"), privacy.span_list("spans").alias("spans"),
    )


def op9_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), 8)
    return placed.withColumn("shard", F.col("shard").cast("int")).withColumn("grown_shard", F.lit(None).cast("int"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


#: The columns of a document's leaf, in the order they are hashed in.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    leaf = merkle.row_digest([F.col(c) for c in LEAF])
    flat = merkle.row_digest([F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in LEAF])
    rows = docs.select(
        "source", F.col("doc_id").cast("long").alias("doc_id"), F.unhex(leaf).alias("leaf"),
        F.unhex(F.when(doc_hash() % 2 == 0, flat).otherwise(leaf)).alias("claimed"),
    )
    manifest = merkle.build_manifest(rows)
    root = F.lit(manifest.root).cast("string")
    return merkle.climb(manifest).select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified")
    )


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document by hash ends in repeats of a few of its own words."""
    if doc_id is None or not words or (h := crc32(str(doc_id).encode())) % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.find_runs(table(spark, sf_dir, "documents"), prepare=repeated_tail)
    best = F.get("runs", F.col("best"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[best[c].alias(c) for c in ("start", "length", "period")],
        F.floor(best["length"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(fingerprints.against_edits(table(spark, sf_dir, "documents")), "op13-rows")
    own = F.col("fingerprint")
    return fingerprints.with_near(rows, radius=3, blocks=5).select(
        "doc_id", "n_chars", "edited_sha256", fingerprints.as_hex(own).alias("fingerprint"),
        fingerprints.as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        fingerprints.likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        fingerprints.likeness(own, F.col("next_fingerprint")).alias("near_next"), "n_near",
    )


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_pfair_mixing": op2_pfair_mixing,
    "op3_language_id": op3_language_id,
    "op4_toxicity": op4_toxicity,
    "op5_token_ids": op5_token_ids,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_private_data": op8_private_data,
    "op9_minimax_sharding": op9_minimax_sharding,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_document_fingerprints": op13_document_fingerprints,
}

SQL: dict[str, str] = {
    "op6_exact_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM pairs
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
    """,
    # Equal rows of one id would be one row here; ids are unique in the given tables.
    "op11_merkle_manifest": """
        WITH RECURSIVE rows_of AS (
            SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS place, text,
                coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS fields
            FROM documents
        ), leaves AS (
            -- crc32, bit by bit: each byte is taken in and followed by eight steps (-1)
            SELECT source, doc_id, place, sha256(fields || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(
                    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
                    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                    CAST(4294967295 AS BIGINT)), 4294967295) % 2 = 0
                THEN sha256(fields || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
                ELSE sha256(fields || coalesce(strlen(text) || ':' || text, '-')) END AS claimed
            FROM rows_of
        ), nodes AS (
            SELECT source, 0 AS level, place, leaf AS h, count(*) OVER (PARTITION BY source) AS many FROM leaves
            UNION ALL
            SELECT source, level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)), (many + 2) // 3
            FROM nodes WHERE many > 1 GROUP BY source, level, place // 3, many
        ), subroots AS (
            SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS many
            FROM nodes WHERE many = 1
        ), tops AS (
            SELECT 0 AS level, place, subroot AS h, many FROM subroots
            UNION ALL
            SELECT level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)), (many + 2) // 3
            FROM tops WHERE many > 1 GROUP BY level, place // 3, many
        ), tree AS (
            SELECT source, false AS top, level, place, h, many FROM nodes
            UNION ALL SELECT NULL, true, level, place, h, many FROM tops
        ), runs AS (
            SELECT source, top, level, place // 3 AS run, list(h ORDER BY place) AS own FROM tree WHERE many > 1 GROUP BY source, top, level, place // 3
        ), climb AS (
            SELECT doc_id, leaf, l.source, false AS top, 0 AS level, l.place, s.place AS of_source, subroot, '' AS proof, claimed AS folded
            FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
            UNION ALL
            SELECT doc_id, leaf, c.source, CASE WHEN r.own IS NULL THEN true ELSE c.top END, CASE WHEN r.own IS NULL THEN 0 ELSE c.level + 1 END,
                CASE WHEN r.own IS NULL THEN of_source ELSE c.place // 3 END, of_source, subroot,
                CASE WHEN r.own IS NULL THEN proof
                    ELSE proof || array_to_string(list_filter(r.own, lambda h, i: i <> c.place % 3 + 1), '') END,
                CASE WHEN r.own IS NULL THEN folded
                    ELSE sha256(array_to_string(list_transform(r.own, lambda h, i: CASE WHEN i = c.place % 3 + 1 THEN folded ELSE h END), '')) END
            FROM climb c LEFT JOIN runs r
                ON (c.top OR c.source IS NOT DISTINCT FROM r.source) AND c.top = r.top AND c.level = r.level AND c.place // 3 = r.run
            WHERE NOT c.top OR r.own IS NOT NULL
        ), ends AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id, leaf ORDER BY top DESC, level DESC) AS last FROM climb
        )
        SELECT doc_id, leaf, subroot, (SELECT h FROM tops WHERE many = 1) AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
            folded = (SELECT h FROM tops WHERE many = 1) AS verified
        FROM ends WHERE last = 1
    """,
}
