"""Exact top-k inner-product search by columnar branch and bound.

Candidates lie in vertical layout (one row for each dimension). For a query
the products are summed dimension block by dimension block; after each block
a candidate's score is bounded above by its sum so far plus the product of
the norms that remain (Cauchy-Schwarz), and candidates whose bound is below
the k-th best lower bound are dropped by compaction. The last block leaves
exact scores.

Scale: queries and candidates meet in blocks. Candidates are dealt by hash
into blocks of bounded size, queries likewise, and a task holds one block of
each, so memory does not depend on the table. A task returns k rows for each
of its queries; the best k of those are the result. Work is queries x
candidates (every pair is bounded at least once), as the contract asks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of one candidate block and of one query block; dimensions summed between two prunings.
CANDIDATES, QUERIES, DIMENSIONS = 32_768, 4_096, 16
SCALE = 256

_OUT = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the vectors that take part: no null, no null or non-finite component, an id."""
    v = F.col(vector_col).cast("array<double>")
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vectors.where(v.isNotNull() & F.col(id_col).isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def _matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids, sorted, and vectors of whole numbers in float64; a repeated id stands once for each of its rows."""
    t = t.combine_chunks()
    n = t.num_rows
    ids = t.column("id").to_numpy()
    lists = t.column("v").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    values = lists.flatten().to_numpy(zero_copy_only=False)
    v = np.floor(values * SCALE).reshape(n, -1) if n else np.zeros((0, 0))
    order = np.argsort(ids, kind="stable")
    return ids[order], v[order]


def _fit(score: int) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, score))


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int,
                 step: int = DIMENSIONS) -> list[tuple[int, int, int]]:
    """(query, id, score) of the k best candidates of each query, ties to the smaller id; a query is no candidate of its own."""
    if not len(ids) or not len(query_ids):
        return []
    dims = vectors.shape[1]
    largest = max(np.abs(vectors).max(initial=0), np.abs(queries).max(initial=0))
    if dims * largest * largest >= 2.0 ** 52:  # not exact in float64: whole numbers of any size, no pruning
        exact = [[int(x) for x in row] for row in vectors]
        out = []
        for q, w in zip(query_ids.tolist(), queries, strict=True):
            w = [int(x) for x in w]
            scored = sorted((-_fit(sum(a * b for a, b in zip(w, v, strict=True))), i) for i, v in zip(ids.tolist(), exact, strict=True) if i != q)
            out += [(q, i, -s) for s, i in scored[:k]]
        return out
    columns = np.ascontiguousarray(vectors.T)
    cuts = list(range(0, dims, step)) + [dims]
    mass = np.stack([np.sqrt((columns[c:] ** 2).sum(0)) for c in cuts])  # norm of what remains of each candidate
    out = []
    for q, w in zip(query_ids.tolist(), queries, strict=True):
        alive = np.delete(np.arange(len(ids)), np.s_[np.searchsorted(ids, q):np.searchsorted(ids, q, side="right")])
        total = np.zeros(len(alive))
        whole = len(alive) == len(ids)
        for b in range(len(cuts) - 1):
            lo, hi = cuts[b], cuts[b + 1]
            part = columns[lo:hi] if whole else columns[lo:hi, alive]
            total = total + w[lo:hi] @ part
            if hi == dims or len(alive) <= k:
                continue
            rest = float(np.sqrt((w[hi:] ** 2).sum())) * mass[b + 1][alive] * (1 + 1e-12) + 1e-6
            least = np.partition(total - rest, len(alive) - k)[len(alive) - k]
            keep = total + rest >= least
            if not keep.all():
                alive, total, whole = alive[keep], total[keep], False
        if len(alive) > k:
            edge = np.partition(total, len(total) - k)[len(total) - k]
            keep = total >= edge
            alive, total = alive[keep], total[keep]
        best = np.lexsort((ids[alive], -total))[:k]
        out += [(q, int(ids[alive[x]]), int(total[x])) for x in best]
    return out


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding",
          candidates: int = CANDIDATES, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, the k best other rows.

    Components become floor(256 x); the score is their integer inner product,
    exact (beyond the range of a long it is clamped to it). Ties go to the
    smaller vec_id. Rows without id and vectors that are null or hold a null or
    non-finite component take no part. Vectors of different lengths do not
    meet; empty ones score 0 with each other. Rows that repeat a vec_id are
    candidates of their own, for other ids; as queries they share one list of
    the k best scores of all of them. Other columns are not read.
    """
    spark = vectors.sparkSession
    use = usable(vectors, id_col, vector_col).withColumn("dims", F.size("v"))
    n, m = use.agg(F.count("*"), F.count(F.when(F.col("id") % every == 0, 1))).head()
    wide = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # blocks of bounded size; smaller ones while that gives every task slot work
    blocks = max(-(-n // candidates), min(wide, -(-n // 2_048)), 1)
    groups = max(-(-m // queries), 1)
    place = lambda salt, count: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(count)).cast("int")
    right = (use.withColumn("block", place("c", blocks))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    left = (use.where(F.col("id") % every == 0).withColumn("part", place("q", groups))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        rows = search_block(*_matrix(a), *_matrix(b), k) if a.num_rows and b.num_rows else []
        cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
        return pa.table({c: pa.array(list(x), pa.int64()) for c, x in zip(("query_id", "vec_id", "score"), cols, strict=True)})

    found = left.groupBy("dims", "part", "block").cogroup(right.groupBy("dims", "part", "block")).applyInArrow(meet, _OUT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
