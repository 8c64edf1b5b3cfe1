"""Exact top-k search by inner product with the threshold algorithm.

Rows and queries are dealt into blocks of bounded size, and every pair of a query block and a row
block is one group. There the rows stand in one sorted list per dimension. Sorted access goes down
all lists at once, from both ends (a query reads a list from its top or its bottom, by the sign of
its own component); what it meets is scored in full, and a query stops as soon as the score of a
row not met yet, bounded by the list values reached, cannot beat its k-th result.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 1024


def integer_vector(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component as a double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def usable(vector: Column) -> Column:
    """Neither NULL nor holding a NULL or a component that is not finite."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))),
    )
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def threshold_topk(
    queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, id, score) of the k best rows for each query of a block.

    ``ids`` ascend, so of equal scores the smaller id comes first; a row with the query's own id
    takes no part.
    """
    n, dims = rows.shape
    order = np.argsort(rows, axis=0, kind="stable")
    lists = np.take_along_axis(rows, order, axis=0)
    # The first depth at which a row is met, going down from the top or up from the bottom.
    depth = np.full(n, n, dtype=np.int64)
    place = np.arange(n)
    for d in range(dims):
        np.minimum.at(depth, order[:, d], np.minimum(place, n - 1 - place))
    best_score = np.full((len(queries), k), -np.inf)
    best_row = np.full((len(queries), k), n, dtype=np.int64)
    live = np.arange(len(queries))
    positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
    reached, step = 0, max(16, k)
    while len(live) and reached < n:
        until = min(n, reached + step)
        met = np.flatnonzero((depth >= reached) & (depth < until))
        reached, step = until, step * 2
        if len(met):
            scores = queries[live] @ rows[met].T
            scores[own[live][:, None] == ids[met][None, :]] = -np.inf
            keep = min(k, len(met))
            # Rows met now ascend; a stable choice keeps the smaller ones of equal scores.
            if keep < len(met):
                edge = -np.partition(-scores, keep - 1, axis=1)[:, keep - 1 : keep]
                scores_kept, rows_kept = _first_best(scores, met, edge, keep)
            else:
                scores_kept, rows_kept = scores, np.broadcast_to(met, scores.shape)
            all_scores = np.concatenate([best_score[live], scores_kept], axis=1)
            all_rows = np.concatenate([best_row[live], rows_kept], axis=1)
            chosen = np.lexsort((all_rows, -all_scores), axis=1)[:, :k]
            best_score[live] = np.take_along_axis(all_scores, chosen, axis=1)
            best_row[live] = np.take_along_axis(all_rows, chosen, axis=1)
        if reached < n:
            # What no list has shown yet lies between the values reached from both ends.
            low, high = lists[reached], lists[n - 1 - reached]
            if (low > high).any():
                break  # both ends have passed each other: every row was met
            bound = positive[live] @ high + negative[live] @ low
            live = live[bound >= best_score[live, k - 1]]
    query, slot = np.nonzero(np.isfinite(best_score))
    return query, ids[best_row[query, slot]], best_score[query, slot]


def _first_best(scores, met, edge, keep):
    """The ``keep`` best of each row of scores, the first ones where the last place is tied."""
    above = scores > edge
    tied = scores == edge
    room = keep - above.sum(axis=1, keepdims=True)
    taken = above | (tied & (np.cumsum(tied, axis=1) <= room))
    at = np.nonzero(taken)[1].reshape(len(scores), keep)
    return np.take_along_axis(scores, at, axis=1), met[at]


def _every(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each query row.

    ``vectors`` has vec_id and v, an array<double> of whole numbers; inner products stay exact up
    to 2**53. Rows without an id or components take no part; repeated rows count once; rows sharing an
    id are all candidates, but for queries of that id. Vectors meet only those of their length. Ties
    go to the smaller vec_id; fewer candidates than k give fewer rows. An empty table gives none.
    """
    rows = vectors.where(F.col("vec_id").isNotNull() & (F.size("v") > 0))
    rows = rows.select("vec_id", "v", F.size("v").alias("dims"), is_query.alias("asks")).distinct()
    sizes = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    row_blocks = max(1, -(-sizes[0] // ROWS_PER_BLOCK))
    query_blocks = max(1, -(-sizes[1] // QUERIES_PER_BLOCK))
    dealt = F.xxhash64("vec_id", "v")
    candidates = rows.select(
        "dims",
        F.pmod(dealt, F.lit(row_blocks)).alias("rows"),
        _every(query_blocks).alias("asking"),
        "vec_id",
        "v",
    )
    queries = rows.where("asks").select(
        "dims",
        _every(row_blocks).alias("rows"),
        F.pmod(dealt, F.lit(query_blocks)).alias("asking"),
        "vec_id",
        "v",
    )

    def block(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame(columns=["query_id", "vec_id", "score"]).astype("int64")
        held = held.sort_values("vec_id", kind="stable")
        ids, own = held["vec_id"].to_numpy(), asked["vec_id"].to_numpy()
        query, found, score = threshold_topk(
            np.stack(asked["v"].to_numpy()), own, np.stack(held["v"].to_numpy()), ids, k
        )
        return pd.DataFrame(
            {"query_id": own[query], "vec_id": found, "score": score.astype(np.int64)}
        )

    group = ["dims", "rows", "asking"]
    found = (
        queries.groupBy(*group)
        .cogroup(candidates.groupBy(*group))
        .applyInPandas(block, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
