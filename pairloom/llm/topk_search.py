"""Exact top-k search by inner product: ball trees per shard, best bounds first.

Vectors are turned into integers, dealt to shards by a hash of their ids, and each shard's vectors
are split into balls around centres. A ball's inner products with a query are at most q.centre +
|q| radius, with a margin for rounding. A block of queries visits the balls in order of that bound,
while it can still reach the query's k-th best pair; equal scores are decided by smaller ids, so a
ball of equal bound is left out only if its smallest id is too large. Each query is first searched
in one shard; its k-th score there is shared with all others, which begin with it.

Every query meets every shard, in blocks: the work of a search that must be exact. Vectors that
are null, empty, or hold a null or non-finite component take no part, as query or candidate; nor
do rows with a null id. Only vectors of one dimension are compared. Repeated rows are candidates
each, but for those with the query's own id; of queries with one id, that
of the least vector is searched. An empty table gives an empty result. Components are
taken as 64-bit integers, and those beyond 2**53 saturate there; scores beyond 64 bits wrap around.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.scratch import scratch_dir

K = 10
SCALE = 1024.0
SHARD_ROWS = 4096
BLOCK_ROWS = 2048
LEAF_ROWS = 128

_EXACT = 2.0 ** 53


def quantised(vector: Column, scale: float = SCALE) -> Column:
    """floor(scale * x) of each component, or null where a component is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != F.lit(float("inf"))))
    limit = F.lit(_EXACT)
    whole = F.transform(vector, lambda x: F.floor(F.greatest(-limit, F.least(
        limit, x.cast("double") * F.lit(scale)))))
    return F.when((F.size(vector) > 0) & finite, whole)


class BallTree:
    """Balls of at most LEAF_ROWS vectors, below balls that hold two each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.dim = vectors.shape[1]
        self.largest = float(np.abs(self.vectors).max(initial=0))
        parts = [np.arange(len(ids))]
        levels = [parts]
        while max(map(len, levels[-1])) > LEAF_ROWS:
            levels.append([half for part in levels[-1] for half in self._halves(part)])
        # A level: the nodes' rows, centres, radii, least ids.
        self.leaves = levels[-1]
        self.levels = [self._balls(nodes) for nodes in levels]

    def _halves(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Split between two far points; equal vectors are split by id."""
        x = self.vectors[part].astype(float)
        far = x[np.argmax(((x - x[0]) ** 2).sum(1))]
        other = x[np.argmax(((x - far) ** 2).sum(1))]
        order = np.argsort(x @ (other - far), kind="stable")
        middle = (len(part) + 1) // 2
        return np.sort(part[order[:middle]]), np.sort(part[order[middle:]])

    def _balls(self, nodes):
        dim = self.dim
        centres, radii = np.zeros((len(nodes), dim)), np.zeros(len(nodes))
        least = np.full(len(nodes), np.iinfo(np.int64).max)
        for i, rows in enumerate(nodes):
            if len(rows):
                x = self.vectors[rows].astype(float)
                centres[i] = x.mean(0)
                radii[i] = np.sqrt(((x - centres[i]) ** 2).sum(1).max())
                least[i] = self.ids[rows[0]]
            else:
                radii[i] = -np.inf
        return centres, radii, least

    def scores(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        largest = float(np.abs(queries).max(initial=0))
        if largest * self.largest * self.dim < _EXACT:
            product = queries.astype(float) @ self.vectors[rows].astype(float).T
            return product.astype(np.int64)
        return queries @ self.vectors[rows].T

    def search(self, queries: np.ndarray, own: np.ndarray, k: int,
               least_score: np.ndarray, least_id: np.ndarray):
        """The k best (score, id) of each query among other rows, scores descending.

        least_score and least_id: a pair that k candidates are known to reach already; pairs
        beyond it need not be found. Absent places hold the least integer and id -1.
        """
        low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        n = len(queries)
        best, best_id = np.full((n, k), low), np.full((n, k), high)
        as_float = queries.astype(float)
        norm = np.sqrt((as_float ** 2).sum(1))
        kth, kth_id = least_score.copy(), least_id.copy()
        # From the root, only nodes that may hold a better pair; then leaves by their bound.
        reach = np.ones((n, 1), bool)
        bound = None
        for centres, radii, least in self.levels:
            exact = as_float @ centres.T
            far = norm[:, None] * np.maximum(radii, 0)
            slack = 1e-12 * (np.abs(as_float) @ np.abs(centres).T + far) + 1e-9
            # Scores are whole numbers, so that the bound of equal vectors is their score.
            bound = np.where(radii >= 0, np.floor(exact + far + slack), -np.inf)
            if reach.shape[1] != len(radii):
                reach = np.repeat(reach, 2, axis=1)
            reach = reach & self._may(bound, least, kth, kth_id)
        order = np.argsort(-np.where(reach, bound, -np.inf), axis=1, kind="stable")
        least = self.levels[-1][2]
        active = np.arange(n)
        for place in range(order.shape[1]):
            leaf = order[active, place]
            may = reach[active, leaf] & self._may(
                bound[active, leaf], least[leaf], kth[active], kth_id[active], rows=True)
            # Bounds fall from here on: a query whose bound is below its k-th score is done.
            going = reach[active, leaf] & (bound[active, leaf] >= kth[active])
            visit, at = active[may], leaf[may]
            for node in np.unique(at):
                rows, who = self.leaves[node], visit[at == node]
                found = self.scores(queries[who], rows)
                ids = np.broadcast_to(self.ids[rows], found.shape)
                mine = ids == own[who, None]
                all_scores = np.concatenate([best[who], np.where(mine, low, found)], axis=1)
                all_ids = np.concatenate([best_id[who], np.where(mine, high, ids)], axis=1)
                top = np.lexsort((all_ids, ~all_scores), axis=1)[:, :k]
                best[who] = np.take_along_axis(all_scores, top, 1)
                best_id[who] = np.take_along_axis(all_ids, top, 1)
                better = (best[who, -1] > kth[who]) | ((best[who, -1] == kth[who])
                                                       & (best_id[who, -1] < kth_id[who]))
                kth[who[better]] = best[who[better], -1]
                kth_id[who[better]] = best_id[who[better], -1]
            active = active[going]
            if not len(active):
                break
        return best, best_id

    @staticmethod
    def _may(bound, least, kth, kth_id, rows=False):
        if not rows:
            kth, kth_id, least = kth[:, None], kth_id[:, None], least[None, :]
        return (bound > kth) | ((bound >= kth) & (least <= kth_id))


_RESULT = "query_id bigint, score bigint, vec_id bigint"


def _search_shards(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Best pairs by shard and block of queries; both sides hold dim, shard and block."""
    keys = ["dim", "shard", "block"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64()),
                          "vec_id": pa.array([], pa.int64())})
        if not left.num_rows or not right.num_rows:
            return empty

        def vectors(table):
            flat = table.column("vector").combine_chunks().flatten()
            return flat.to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        ids = left.column("id").to_numpy()
        own = right.column("id").to_numpy()
        score = right.column("least_score").fill_null(low).to_numpy()
        least = right.column("least_id").fill_null(high).to_numpy()
        best, best_id = BallTree(ids, vectors(left)).search(
            vectors(right), own, k, score.copy(), least.copy())
        held = (best > low) | (best_id < high)
        held &= (best > score[:, None]) | ((best == score[:, None]) & (best_id <= least[:, None]))
        return pa.table({"query_id": np.repeat(own, k).reshape(-1, k)[held],
                         "score": best[held], "vec_id": best_id[held]})

    return candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(run, _RESULT)


def _best(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, *, k: int = K, scale: float = SCALE,
           id_col: str = "vec_id", vector_col: str = "embedding",
           shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every row that is a query."""
    spark = vectors.sparkSession
    folder = scratch_dir(spark, "topk")
    (vectors.select(F.col(id_col).cast("bigint").alias("id"),
                    quantised(F.col(vector_col), scale).alias("vector"),
                    F.coalesce(is_query, F.lit(False)).alias("is_query"))
     .where("id is not null and vector is not null")
     .withColumn("dim", F.size("vector")).write.parquet(f"{folder}/vectors"))
    stored = spark.read.parquet(f"{folder}/vectors")
    # One row: how many.
    counts = stored.agg(F.count("*").alias("n"), F.count_if("is_query").alias("queries")).first()
    shards = max(1, -(-counts.n // shard_rows))
    blocks = max(1, -(-counts.queries // block_rows))

    def dealt(seed: int, parts: int) -> Column:
        # Ids may repeat, so equal ids are spread by vector too.
        return F.pmod(F.xxhash64(F.lit(seed), "id", "vector"), F.lit(parts)).cast("int")

    def each(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    candidates = stored.select("id", "vector", "dim", dealt(1, shards).alias("shard"))
    # Read anew, as the two sides of a cogroup may not share columns.
    queries = (spark.read.parquet(f"{folder}/vectors").where("is_query").groupBy("id").agg(F.min("vector").alias("vector"))
               .withColumns({"dim": F.size("vector"), "block": dealt(2, blocks)}))
    # Home: each query in one shard.
    home = queries.withColumns({"shard": dealt(3, shards),
                                "least_score": F.lit(None).cast("bigint"),
                                "least_id": F.lit(None).cast("bigint")})
    in_blocks = candidates.withColumn("block", each(blocks))
    first = _best(_search_shards(in_blocks, home, k), k)
    first.write.parquet(f"{folder}/home")
    shared = spark.read.parquet(f"{folder}/home").where(F.col("rank") == k).select(
        F.col("query_id").alias("id"), F.col("score").alias("least_score"),
        F.col("vec_id").alias("least_id"))
    everywhere = queries.join(shared, "id", "left").withColumn("shard", each(shards))
    found = _search_shards(in_blocks, everywhere.select(
        "id", "vector", "dim", "block", "shard", "least_score", "least_id"), k)
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"),
                                  "vec_id", "score")
