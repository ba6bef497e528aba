"""Exact top-k by inner product over a pivot-distance index.

Vectors are lifted by one component, sqrt(M - |v|^2) with M the largest squared length, so that the largest inner
product is the nearest vector: |q' - v'|^2 = |q|^2 + M - 2 q.v for queries lifted by 0. Every vector is keyed by
its nearest pivot and its distance to it; keys are range-sorted into annuli (pivots and rings are parameters, so their
table has a fixed size) and stored in blocks. A query first visits the annuli with the lowest bounds until these hold
enough vectors, which gives its k-th best score; by the triangle inequality an annulus [a, b] of pivot p holds nothing nearer than
max(0, d(q, p) - b, a - d(q, p)), so it then visits only those whose bound is within that of its k-th score. Blocks
of queries meet blocks of vectors as matrix products on the executors.

Scores are exact: components are whole numbers and products are summed in doubles, or in Python's integers if 2^53 could be passed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatgrid.llm.common import stored

BLOCK_ROWS = 1024
QUERY_ROWS = 512
SPREAD = 8  # parts, at most, into which the blocks of one annulus are dealt
_EXACT = float(1 << 53)


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``vec_id, v`` with v = floor(scale * x); rows with null ids, null vectors or null or non-finite components are left out."""
    x = F.col(vector_col).cast("array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))

    def floored(batches):
        for part in batches:
            yield part.assign(v=[np.floor(scale * np.asarray(v, float)) for v in part["v"]])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & good
    )
    return rows.mapInPandas(floored, "vec_id long, v array<double>")


def _matrix(rows, width: int) -> np.ndarray:
    """Vectors as a matrix; shorter ones are filled with zeros, which leaves inner products as they are."""
    out = np.zeros((len(rows), width))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def _lift(m: np.ndarray, most: float) -> np.ndarray:
    return np.hstack([m, np.sqrt(np.maximum(most - (m * m).sum(1, keepdims=True), 0.0))])


def _distances(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((m * m).sum(1)[:, None] + (pivots * pivots).sum(1)[None] - 2 * m @ pivots.T, 0.0))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first points of a sample."""
    chosen = [0]
    near = np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        if near.max() <= 0:
            break
        chosen.append(int(near.argmax()))
    return sample[chosen]


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products, as floats that hold whole numbers, or as Python integers where floats might not."""
    most = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, queries.shape[1])
    if most < _EXACT:
        return queries @ vectors.T
    return np.array([[int(x) for x in q] for q in queries], object) @ np.array([[int(x) for x in v] for v in vectors], object).T


class Search:
    """An index over ``rows`` (``vec_id, v``, stored). ``sample`` rows at most are used to place the pivots; all rows are indexed.

    There are ``pivots`` at most, fewer where annuli would hold less than half a block on average.
    """

    def __init__(self, rows: DataFrame, pivots: int = 48, rings: int = 16, sample: int = 4096):
        self.rows = rows
        size = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)), F.max(F.size("v")), F.count(F.lit(1))).first()
        self.most, self.width, self.count = size[0] or 0.0, size[1] or 0, size[2]
        if not self.count:
            return
        pivots = max(1, min(pivots, 2 * self.count // (rings * BLOCK_ROWS)))
        few = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
        self.pivots = points = choose_pivots(_lift(_matrix([r["v"] for r in few], self.width), self.most), pivots)
        width, most = self.width, self.most

        def keyed(batches):
            for part in batches:
                far = _distances(_lift(_matrix(part["v"], width), most), points)
                nearest = far.argmin(1)
                yield part.assign(pivot=nearest.astype(np.int32), distance=far[np.arange(len(part)), nearest])

        keys = stored(rows.mapInPandas(keyed, "vec_id long, v array<double>, pivot int, distance double"), "topk-keys")
        cuts = [i / rings for i in range(1, rings)]
        edges = {r[0]: r[1] for r in keys.groupBy("pivot").agg(F.percentile_approx("distance", cuts, 1000)).collect()}
        ring = F.lit(0)
        for i in range(len(cuts)):
            edge = F.element_at(F.create_map(*[x for p, e in edges.items() for x in (F.lit(p), F.lit(float(e[i])))]), F.col("pivot"))
            ring += (F.col("distance") > edge).cast("int")
        keys = keys.withColumn("cell", F.col("pivot") * rings + ring)
        cells = keys.groupBy("cell").agg(F.min("distance"), F.max("distance"), F.count(F.lit(1))).collect()  # pivots x rings at most
        cells = np.array(sorted(map(tuple, cells)), float)
        self.cells, self.low, self.high, self.many = cells[:, 0].astype(int), cells[:, 1], cells[:, 2], cells[:, 3]
        self.of_pivot = self.cells // rings
        self.spreads = np.clip(self.many // (4 * BLOCK_ROWS), 1, SPREAD).astype(np.int32)
        spreads = dict(zip(self.cells.tolist(), self.spreads.tolist()))

        def blocked(batches):
            for part in batches:
                for cell, group in part.groupby("cell", sort=False):
                    for at in range(0, len(group), BLOCK_ROWS):
                        own = group.iloc[at : at + BLOCK_ROWS].sort_values("vec_id", kind="stable")
                        ids = own["vec_id"].to_numpy(np.int64)
                        yield pd.DataFrame({
                            "cell": [cell], "spread": [int(ids[0] % spreads[cell])], "ids": [ids.tobytes()],
                            "vectors": [_matrix(own["v"], width).tobytes()],
                        })

        order = keys.select("cell", "vec_id", "v").repartitionByRange("cell", "vec_id").sortWithinPartitions("cell", "vec_id")
        self.blocks = stored(order.mapInPandas(blocked, "cell int, spread int, ids binary, vectors binary"), "topk-blocks")

    def _visit(self, queries: DataFrame, k: int, again: bool) -> DataFrame:
        """``query_id, v, cell, floor``: the first cells to visit, or those left that the k-th score ``worst`` leaves open."""
        width, most, points, count = self.width, self.most, self.pivots, self.count
        low, high, many, cells, of_pivot, spreads = self.low, self.high, self.many, self.cells, self.of_pivot, self.spreads

        def plan(batches):
            for part in batches:
                m = _matrix(part["v"], width)
                far = _distances(np.hstack([m, np.zeros((len(m), 1))]), points)[:, of_pivot]
                bound = np.maximum(np.maximum(far - high, low - far), 0.0)
                order = np.argsort(bound, axis=1, kind="stable")
                before = np.cumsum(many[order], axis=1) - many[order]
                first = np.zeros(bound.shape, bool)
                np.put_along_axis(first, order, before < 4 * k + 1, axis=1)
                if again:
                    worst = part["worst"].to_numpy(float)
                    reach = (m * m).sum(1) + most - 2 * worst  # infinite where fewer than k are known
                    slack = 1e-9 * (abs(reach) + (m * m).sum(1) + most + 1)
                    chosen = ~first & (bound**2 <= np.maximum(reach + slack, 0.0)[:, None] + 1e-6 * most)
                else:
                    chosen = first
                q, c = np.nonzero(chosen)
                if len(q):
                    floor = part["worst"].to_numpy(float)[q] if again else np.full(len(q), -np.inf)
                    yield pd.DataFrame({
                        "query_id": part["query_id"].to_numpy()[q], "v": [m[i].tobytes() for i in q], "cell": cells[c].astype(np.int32), "spreads": spreads[c], "floor": floor,
                    })

        return queries.mapInPandas(plan, "query_id long, v binary, cell int, spreads int, floor double")

    def _meet(self, visits: DataFrame, queries: int, k: int) -> DataFrame:
        """Each visiting query's k best of each block: ``query_id, vec_id, score``."""
        width, groups = self.width, max(1, -(-queries // QUERY_ROWS))
        group = F.pmod(F.xxhash64("query_id"), F.lit(groups))
        sides = visits.groupBy("cell", "spreads", group.alias("group")).agg(F.collect_list(F.struct("query_id", "v", "floor")).alias("queries"))
        sides = sides.select("cell", F.explode(F.sequence(F.lit(0), F.col("spreads") - 1)).alias("spread"), "queries")

        def best(batches):
            for part in batches:
                out = []
                for row in part.itertuples():
                    ids = np.frombuffer(row.ids, np.int64)
                    vectors = np.frombuffer(row.vectors).reshape(len(ids), width)
                    asked = np.array([q["query_id"] for q in row.queries], np.int64)
                    floor = np.array([q["floor"] for q in row.queries], float)
                    matrix = np.frombuffer(b"".join(q["v"] for q in row.queries)).reshape(len(asked), width)
                    found = scores(matrix, vectors)
                    other = asked[:, None] != ids[None]
                    order = np.argsort(np.where(other, -found, np.inf), axis=1, kind="stable")[:, :k]
                    q = np.repeat(np.arange(len(asked)), order.shape[1])
                    c = order.ravel()
                    good = other[q, c] & (found[q, c] >= floor[q])
                    out.append(pd.DataFrame({"query_id": asked[q[good]], "vec_id": ids[c[good]], "score": [int(x) for x in found[q[good], c[good]]]}))
                yield pd.concat(out).astype("int64")

        # Rows of matrices: never to be broadcast, however small their files are.
        pairs = sides.hint("merge").join(self.blocks, ["cell", "spread"]).select("queries", "ids", "vectors")
        return pairs.mapInPandas(best, "query_id long, vec_id long, score long")

    def top(self, queries: DataFrame, k: int = 5) -> DataFrame:
        """``query_id, rank, vec_id, score``: each query's k best (all, if fewer), ties to the smaller id; ``queries`` has ``query_id, v``.

        Rows with the query's own id are not its candidates. Repeated ids are candidates each; a repeated query is asked once.
        """
        spark = queries.sparkSession
        if not self.count:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        asked = stored(queries.dropDuplicates(["query_id"]), "topk-queries")
        number = asked.count()
        ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

        def best(found: DataFrame) -> DataFrame:
            return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)

        first = stored(best(self._meet(self._visit(asked.withColumn("worst", F.lit(0.0)), k, False), number, k)), "topk-first")
        worst = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("worst"))
        open_ = asked.join(worst, "query_id", "left").withColumn("worst", F.coalesce("worst", F.lit(float("-inf"))))
        second = self._meet(self._visit(open_, k, True), number, k)
        return best(first.select("query_id", "vec_id", "score").union(second)).select("query_id", "rank", "vec_id", "score")
