"""Merkle manifest of a dataset, with proofs climbed by a recursive query.

Every row is a leaf. The leaves of a source, in order, are hashed in runs of three, level by level, to its subroot; the subroots, by
source, likewise to the root. Built levels are stored as node rows. A node row holds the digests of four levels: at most 81
neighbours, their 27, 9 and 3 parents, and a link to the place of its top digest in the row above, so that a tree of N leaves has
about N/80 rows above the first tier and is four times as flat. One step of the recursive query (``WITH RECURSIVE``) takes each
leaf from its row to the row above: it appends the siblings of four levels and folds a claimed digest with them.

Digests are SHA-256; a node's input is the lower-case hex of its children, in order. They are stored as 32 bytes each, those of one
level of a row end to end.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatgrid.llm.common import ranked, stored

FAN = 3
LEVELS = 4
NEIGHBOURS = FAN**LEVELS
BYTES = 32
TOP = 1000  # tier of the first rows over subroots; no source has so many tiers
ROOT = -1  # tier of the place above the last row
COPIES = 16  # of rows above the second tier, whose leaves may be most of all rows
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def row_digest(values: Sequence[Column]) -> Column:
    """Hex digest of a row: for each value ``-`` if null, else its UTF-8 byte count, ``:`` and its text."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _parents(level: Column) -> Column:
    """The level above: one digest for every three of ``level``, the last run shorter."""
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / (FAN * BYTES)).cast("int"))
    run = F.transform(runs, lambda i: F.sha2(F.lower(F.hex(F.substring(level, i * FAN * BYTES + 1, F.lit(FAN * BYTES)))), 256))
    return F.unhex(F.array_join(run, ""))


def _levels(rows: DataFrame, first: Column, nodes: Column) -> DataFrame:
    """``rows`` with ``depth``, ``l0`` to ``l3`` and ``top``; ``first`` is level 0, ``nodes`` how many nodes its tree has in this tier."""
    depth = F.when(nodes > 27, 4).when(nodes > 9, 3).when(nodes > 3, 2).when(nodes > 1, 1).otherwise(0)
    rows = rows.withColumn("depth", depth).withColumn("l0", first)
    for k in range(1, LEVELS + 1):
        above = F.when(F.col("depth") >= k, _parents(F.col(f"l{k - 1}")))
        rows = rows.withColumn(f"l{k}", above)
    top = F.coalesce(*[F.col(f"l{k}") for k in range(LEVELS, -1, -1)])
    return rows.withColumn("top", top).drop(f"l{LEVELS}")


def _steps(row: str, place: str, proof: str, folded: str) -> tuple[str, str]:
    """SQL for ``proof`` and ``folded`` after the levels of node row ``row``, from the node at ``place`` among its neighbours."""
    for k in range(LEVELS):
        at, level = f"({place} div {FAN**k})", f"{row}.l{k}"
        left = f"substring({level}, {FAN * BYTES} * ({at} div {FAN}) + 1, {BYTES} * ({at} % {FAN}))"
        right = f"substring({level}, {BYTES} * ({at} + 1) + 1, {BYTES} * ({FAN - 1} - {at} % {FAN}))"
        there = f"{row}.depth > {k}"
        none = "CAST('' AS BINARY)"
        proof = f"concat({proof}, CASE WHEN {there} THEN {left} ELSE {none} END, CASE WHEN {there} THEN {right} ELSE {none} END)"
        digest = f"unhex(sha2(lower(concat(hex({left}), hex(digest), hex({right}))), 256))"
        # The digest so far is named by a lambda, so that it is worked out once.
        folded = f"transform({folded}, digest -> CASE WHEN {there} THEN {digest} ELSE digest END)"
    return proof, folded


@dataclass
class Manifest:
    """``leaves`` (first node rows, with their leaves), ``nodes`` (the rows above) and ``root`` (hex; None without rows)."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def _linked(rows: DataFrame, tier: int, many: Column, above: Column) -> DataFrame:
    """Rows with the place of their top digest: in the next tier, or ``above`` (tier, tree, place) for a tree's only row."""
    here = F.struct(F.lit(tier + 1).alias("tier"), F.col("tree"), F.col("block").alias("place"))
    link = F.when(many > NEIGHBOURS, here).otherwise(above)
    return rows.withColumn("up_tier", link["tier"]).withColumn("up_tree", link["tree"]).withColumn("up_place", link["place"])


def _tier(tops: DataFrame, tier: int, above: Column) -> DataFrame:
    """Node rows over ``tops`` (``tree, place, many, top``), the digests of a tier, stored."""
    block = F.floor(F.col("place") / NEIGHBOURS).cast("long").alias("block")
    rows = tops.groupBy("tree", block).agg(
        F.first("many").alias("many"), F.array_sort(F.collect_list(F.struct("place", F.hex("top").alias("digest")))).alias("own")
    )
    rows = _levels(rows, F.unhex(F.array_join(F.col("own.digest"), "")), F.col("many")).drop("own")
    return stored(_linked(rows.withColumn("tier", F.lit(tier)), tier, F.col("many"), above), "merkle-tier")


NODE = ["tier", "tree", "block", "depth", "l0", "l1", "l2", "l3", "top", "up_tier", "up_tree", "up_place"]


def build_manifest(rows: DataFrame) -> Manifest:
    """Levels and root of ``rows``: ``source, doc_id, leaf`` (32 bytes), ``claimed`` (the digest to fold; 32 bytes).

    The leaves of a source are in order of ``doc_id``, then ``leaf`` (nulls first); a null source is a source of its own, the first.
    Equal rows are leaves each. Without rows there are no nodes and no root. Leaves are range-sorted, so the rows of a hot source
    lie in many tasks, and gathered 81 at a time; what is counted per source is one row per source.
    """
    light = rows.select("source", "doc_id", "leaf", "claimed")
    placed = ranked(light, ["source"], ["doc_id", "leaf", "claimed"], "merkle-leaves", "place")
    counts = stored(placed.groupBy("source").agg(F.count(F.lit(1)).alias("many")), "merkle-sources")
    trees = ranked(counts, [], ["source"], "merkle-trees", "tree")
    trees = stored(trees.select(F.col("source").alias("_source"), "many", "tree"), "merkle-trees-of")
    sources = trees.count()
    if not sources:
        nodes = trees.sparkSession.createDataFrame([], "tier int, tree long, block long, salt int, up_tier int, up_tree long, up_place long, "
                                                   "depth int, l0 binary, l1 binary, l2 binary, l3 binary, top binary")
        return Manifest(placed.limit(0), nodes, None)

    block = F.floor(F.col("place") / NEIGHBOURS).cast("long").alias("block")
    gathered = placed.groupBy("source", block).agg(F.array_sort(F.collect_list(F.struct("place", "doc_id", "leaf", "claimed"))).alias("own"))
    # A source may hold most rows; its blocks go to its row's copies.
    gathered = gathered.withColumn("_salt", F.pmod("block", F.lit(COPIES)).cast("int"))
    copies = trees.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    gathered = gathered.join(copies, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_salt") == F.col("_copy")))
    digests = F.transform(F.col("own.leaf"), F.hex)
    over_sources = F.struct(F.lit(TOP).alias("tier"), F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"))
    first = _levels(gathered.drop("_source", "_salt", "_copy"), F.unhex(F.array_join(digests, "")), F.col("many"))
    first = stored(_linked(first.withColumn("tier", F.lit(0)), 0, F.col("many"), over_sources), "merkle-first")

    above_root = F.struct(F.lit(ROOT).alias("tier"), F.lit(0).cast("long").alias("tree"), F.lit(0).cast("long").alias("place"))
    tiers, tier, rows, most = [], 0, first, trees.agg(F.max("many")).first()[0]
    subroots = [first.filter(F.col("up_tier") == TOP).select("up_place", "top")]
    while most > NEIGHBOURS:
        most, tier = -(-most // NEIGHBOURS), tier + 1
        fewer = F.ceil(F.col("many") / NEIGHBOURS).cast("long").alias("many")
        rows = _tier(rows.filter(F.col("up_tier") == tier).select("tree", F.col("up_place").alias("place"), fewer, "top"), tier, over_sources)
        subroots.append(rows.filter(F.col("up_tier") == TOP).select("up_place", "top"))
        tiers.append(rows)
    tops = subroots[0]
    for more in subroots[1:]:
        tops = tops.union(more)
    tops = tops.select(F.lit(0).cast("long").alias("tree"), F.col("up_place").alias("place"), F.lit(sources).alias("many"), "top")
    most, tier = sources, TOP
    while True:
        rows = _tier(tops, tier, above_root)
        tiers.append(rows)
        if most <= NEIGHBOURS:
            break
        most, tier = -(-most // NEIGHBOURS), tier + 1
        tops = rows.select("tree", F.col("up_place").alias("place"), F.lit(most).alias("many"), "top")
    root = rows.select(F.lower(F.hex("top"))).first()[0]
    nodes = tiers[0].select(*NODE)
    for more in tiers[1:]:
        nodes = nodes.union(more.select(*NODE))
    # Up to the second tier a row has few leaves below; those above get copies, over which leaves are dealt.
    salts = F.when(F.col("tier") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    return Manifest(first, stored(nodes.withColumn("salt", F.explode(salts)), "merkle-nodes"), root)


@contextmanager
def _any_rows(spark: SparkSession):
    """Spark stops a recursion at a million rows unless told otherwise."""
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.set(ROW_LIMIT, before)


def climb(manifest: Manifest, proofs: bool = False) -> DataFrame:
    """``doc_id, leaf, subroot, proof_sha256, folded_root`` (hex) of every leaf, and with ``proofs`` the ``proof`` itself.

    A proof is the sibling digests (32 bytes each) in order, from the leaf to the root; ``folded_root`` is what the claimed digest
    comes to with them, equal to the root only if the claim is the leaf.
    """
    leaves, spark = manifest.leaves, manifest.leaves.sparkSession
    if manifest.root is None:
        schema = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string" + (", proof binary" if proofs else "")
        return spark.createDataFrame([], schema)
    none = "CAST('' AS BINARY)"
    first_proof, first_folded = _steps("f", "int(one.place % 81)", none, "array(one.claimed)")
    proof, folded = _steps("n", "int(c.place % 81)", "c.proof", "array(c.folded)")
    query = f"""
        WITH RECURSIVE climb(doc_id, leaf, tier, tree, place, salt, subroot, proof, folded) AS (
            SELECT one.doc_id, one.leaf, up_tier, up_tree, up_place, CAST(pmod(xxhash64(one.doc_id, one.leaf), {COPIES}) AS INT),
                CASE WHEN up_tier = {TOP} THEN top END, {first_proof}, element_at({first_folded}, 1)
            FROM {{leaves}} f LATERAL VIEW explode(own) AS one
            UNION ALL
            SELECT c.doc_id, c.leaf, n.up_tier, n.up_tree, n.up_place, c.salt,
                CASE WHEN n.tier < {TOP} AND n.up_tier = {TOP} THEN n.top ELSE c.subroot END, {proof}, element_at({folded}, 1)
            FROM climb c JOIN {{nodes}} n
                ON c.tier = n.tier AND c.tree = n.tree AND c.place div {NEIGHBOURS} = n.block
                AND CASE WHEN c.tier = 1 THEN 0 ELSE c.salt END = n.salt
        )
        SELECT doc_id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot, sha2(lower(hex(proof)), 256) AS proof_sha256,
            lower(hex(folded)) AS folded_root{", proof" if proofs else ""}
        FROM climb WHERE tier = {ROOT}
    """
    with _any_rows(spark):
        return stored(spark.sql(query, leaves=leaves, nodes=manifest.nodes), "merkle-climbed")
