"""Exact top-k search by inner product with vector-approximation files.

Vectors are dealt evenly to groups. A group keeps, beside its exact vectors, one
4-bit cell number per component: the cells of a component hold equally many
values. A block of queries scans the cells for an upper and a lower bound of every
score, drops what cannot be among the best k, and reads exact vectors in the order
of their bounds until the k-th result is certain. The best of the groups are then
merged. Groups and query blocks have a fixed size, so a task's memory does not
grow with the data; what grows is their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 16
GROUP_ROWS, QUERY_ROWS = 8192, 2048
READ_AT_ONCE, SCAN_AT_ONCE = 64, 64


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as long; NULL where one is NULL or not finite."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")), F.lit(False)),
    )
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _cells(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers, and the edges of each component's cells."""
    ordered = np.sort(vectors, axis=0)
    edges = ordered[np.linspace(0, len(vectors) - 1, CELLS + 1).astype(int)]
    codes = np.empty(vectors.shape, np.uint8)
    for d in range(vectors.shape[1]):
        codes[:, d] = np.searchsorted(edges[1:-1, d], vectors[:, d], "right")
    return codes, edges


def _search(queries, asking, vectors, ids, rows, k):
    """Per query the best k rows of one group but the row that asks, as (query row, row, score)."""
    largest = max(int(np.abs(queries).max(initial=0)), 1) * max(int(np.abs(vectors).max(initial=0)), 1)
    exact = largest * max(vectors.shape[1], 1) < 2**53
    codes, edges = _cells(vectors)
    component = np.arange(vectors.shape[1])
    low, high = edges[codes, component], edges[codes + 1, component]
    number = np.float64 if exact else object  # Python's integers where doubles could round
    low, high, queries = low.astype(number), high.astype(number), queries.astype(number)
    vectors = vectors.astype(number)
    for at in range(0, len(queries), SCAN_AT_ONCE):
        block = queries[at:at + SCAN_AT_ONCE]
        up, down = np.maximum(block, 0), np.minimum(block, 0)
        most = up @ high.T + down @ low.T
        least = up @ low.T + down @ high.T
        for i in range(len(block)):
            others = np.flatnonzero(rows != asking[at + i])
            if not len(others):
                continue
            upper = most[i, others]
            if len(others) > k:
                certain = np.partition(least[i, others], -k)[-k]
                others, upper = others[upper >= certain], upper[upper >= certain]
            order = np.argsort(-upper, kind="stable")
            others, upper = others[order], upper[order]
            best: list[tuple[int, int, int]] = []  # score downwards, id, row
            for start in range(0, len(others), READ_AT_ONCE):
                if len(best) == k and -best[-1][0] > upper[start]:
                    break
                read = others[start:start + READ_AT_ONCE]
                scores = (vectors[read] @ block[i]).tolist()
                best = sorted([*best, *zip([-x for x in scores], ids[read].tolist(), read.tolist())])[:k]
            for score, _, row in best:
                yield at + i, row, -int(score)


def top_k(
    queries: DataFrame, vectors: DataFrame, k: int,
    group_rows: int = GROUP_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k highest integer inner products of each query, ties to the smaller vec_id.

    ``queries`` has query_id and vector (array of long), ``vectors`` vec_id and
    vector. Rows with a missing id or vector take no part. A shorter vector counts as
    padded with zeros. Candidates that repeat an id each count. Scores beyond a long
    are an error. Empty tables give no rows. Other columns are not read.

    Where both tables have a column ``row``, a long that numbers the rows, every query
    row is a search of its own against every row but the one of its number, also if
    ids or whole rows repeat. Without it, rows are told apart by their ids: no row with
    the query's own id is a candidate, every different vector of a query's id is
    searched, and the k best of all their answers are returned.

    Returns query_id, rank (from 1), vec_id, score; fewer than k rows where there
    are fewer candidates.
    """
    numbered = "row" in queries.columns and "row" in vectors.columns
    queries = queries.where("query_id is not null and vector is not null")
    queries = queries.select("query_id", "vector", F.col("row" if numbered else "query_id").alias("asking"))
    if not numbered:
        queries = queries.distinct()
    vectors = vectors.where("vec_id is not null and vector is not null")
    vectors = vectors.select("vec_id", "vector", F.col("row" if numbered else "vec_id").alias("own"))
    groups = -(-vectors.count() // group_rows) or 1
    blocks = -(-queries.count() // query_rows) or 1
    dealt = vectors.repartition(groups).select(
        F.spark_partition_id().alias("group"), "vec_id", "vector", "own",
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    asked = queries.repartition(blocks).select(
        F.spark_partition_id().alias("block"), "query_id", "vector", "asking",
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
    )

    def best(have: pa.Table, ask: pa.Table) -> pa.Table:
        rows: list = []
        if len(have) and len(ask):
            width = max(
                int(np.diff(t["vector"].combine_chunks().offsets.to_numpy()).max()) for t in (have, ask)
            )
            ids, query_ids, asking = have["vec_id"].to_numpy(), ask["query_id"].to_numpy(), ask["asking"].to_numpy()
            rows = [
                (asking[q], query_ids[q], ids[v], score) for q, v, score in _search(
                    _matrix(ask["vector"], width), asking, _matrix(have["vector"], width), ids, have["own"].to_numpy(), k
                )
            ]
        columns = list(zip(*rows)) or [(), (), (), ()]
        return pa.table(
            [pa.array(c, pa.int64()) for c in columns], names=["asking", "query_id", "vec_id", "score"]
        )

    found = dealt.groupBy("group", "block").cogroup(asked.groupBy("group", "block")).applyInArrow(
        best, "asking long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("asking").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
