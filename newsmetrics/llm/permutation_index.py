"""Operator 4, approximate nearest neighbours by a permutation index.

Pivots are PIVOTS distinct vectors with the smallest hashes (a bounded sample).
Every vector is represented by its PREFIX nearest pivots in order and posted, with
its rank, in the inverted file of each. Vectors are dealt by hash into shards of
about SHARD vectors, queries into blocks of about BLOCK; for each block and shard
the postings of the query's pivots give the footrule distance of the truncated
orders, the RERANK nearest by it are reranked by exact distance, and the shards'
best are merged. A shard hence compares the same share of its vectors at every
size of the input, and memory is bounded by a shard and a block.

Equal vectors: ties go to smaller ids, so beyond K + 1 ids of one vector none
can be among the K nearest; those are set aside before the index is made. Against
brute force the recall is measured in tests/llm and stated in the README.

Defined results: rows with null id, null vector, null or non-finite components,
or only zeros take no part, nor do vectors of another length than the most
frequent one (the smaller of equally frequent ones); rows that repeat id and
vector count once; different vectors of one id are candidates of their own, but no query finds its own id;
ties go to the smaller id; fewer candidates than K give fewer rows; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsmetrics.llm.common import table

K = 10
QUERY_EVERY = 100
PIVOTS, PREFIX = 512, 128
SHARD, BLOCK = 4096, 1024
RERANK = 320  # of a shard's about 4,096 vectors, all of a smaller shard's if it has fewer
HITS = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (common[0]["n"] if common else -1))


def orders(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of every row, nearest first, ties to the smaller number."""
    d = (x ** 2).sum(1)[:, None] + (pivots ** 2).sum(1)[None] - 2 * x @ pivots.T
    return np.argsort(d, 1, kind="stable")[:, :prefix]


def inverted(order: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per pivot, the rows posted there and the pivot's rank in each."""
    rank = np.tile(np.arange(order.shape[1], dtype=np.int32), len(order))
    row = np.repeat(np.arange(len(order)), order.shape[1])
    by = np.argsort(order.ravel(), kind="stable")
    cut = np.searchsorted(order.ravel()[by], np.arange(pivots + 1))
    return [(row[by[a:b]], rank[by[a:b]]) for a, b in zip(cut[:-1], cut[1:])]


def search_shard(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, x: np.ndarray, pivots: np.ndarray,
                 prefix: int, rerank: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, distance) of each query's ``k`` best in one shard."""
    order = np.argsort(vid, kind="stable")
    vid, x = vid[order], x[order]
    files = inverted(orders(x, pivots, prefix), len(pivots))
    asked = inverted(orders(q, pivots, prefix), len(pivots))
    # footrule = constant - 2 * near, summed over the pivots that both orders hold
    near = np.zeros((len(q), len(x)), np.int32)
    for (rows, rank), (posted, posted_rank) in zip(asked, files):
        if len(rows) and len(posted):
            near[np.ix_(rows, posted)] += prefix - np.maximum(rank[:, None], posted_rank[None])
    near[qid[:, None] == vid[None]] = -1
    keep = min(rerank, len(x))
    # ties of the footrule go to the smaller id
    key = near.astype(np.int64) * len(x) + np.arange(len(x))[::-1]
    best = np.argpartition(-key, keep - 1, axis=1)[:, :keep]
    out = []
    for i, rows in enumerate(best):
        rows = rows[near[i, rows] >= 0]
        d = np.sqrt(((x[rows] - q[i]) ** 2).sum(1))
        top = np.lexsort((vid[rows], d))[:k]
        out.append((np.full(len(top), qid[i]), vid[rows[top]], d[top]))
    return tuple(np.concatenate(c) for c in zip(*out))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest found of every query (vec_id, v)."""
    by = Window.partitionBy("v").orderBy("vec_id")
    kept = (vectors.dropDuplicates(["vec_id", "v"]).withColumn("same", F.row_number().over(by))
            .where(F.col("same") <= k + 1).select("vec_id", "v")).checkpoint()
    asked = queries.dropDuplicates(["vec_id", "v"]).checkpoint()
    sample = (kept.dropDuplicates(["v"]).orderBy(F.xxhash64("v"), "v").limit(PIVOTS).collect())
    pivots = np.array([r["v"] for r in sample], float)
    shards = max(1, -(-kept.count() // SHARD))
    parts = max(1, -(-asked.count() // BLOCK))

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not (len(left) and len(right)):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())],
                            ["query_id", "vec_id", "score"])

        def matrix(t: pa.Table) -> np.ndarray:
            return t.column("v").combine_chunks().flatten().to_numpy().reshape(len(t), -1)

        hits = search_shard(left.column("vec_id").to_numpy(), matrix(left), right.column("vec_id").to_numpy(),
                            matrix(right), pivots, min(PREFIX, len(pivots)), RERANK, k)
        return pa.table([pa.array(c) for c in hits], ["query_id", "vec_id", "score"])

    each_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    each_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    left = asked.select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"), each_shard)
    right = kept.select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), each_part)
    hits = (left.groupBy("part", "shard").cogroup(right.groupBy("part", "shard"))
            .applyInArrow(search, HITS))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_permutation_index(spark, sf_dir: str) -> DataFrame:
    vectors = usable(table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))
