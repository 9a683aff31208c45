"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

Rows are sparse integer vectors (term -> weight).  Queries and candidates are
dealt to blocks of bounded size and every pair of a query block and a candidate
block is one task's group.  Inside it the candidates become postings, one list
of (row, weight) per term; each query walks its terms, scatters
``query weight * posting weight`` into a dense score array over the block's rows,
and a partition selection keeps its best rows.  The partial lists of a query are
merged by a ranked window whose limit is applied before the shuffle.

The query set is a stated part of the table, so no block is paired with itself
as a cross join of the whole table would; shuffled bytes are
(query blocks x candidates + candidate blocks x queries).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, union

K = 10
SCALE = 1024
QUERY_BLOCK = 512           # queries of a block
CANDIDATE_BLOCK = 8192      # candidates of a block


def integer_vector(embedding: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(F.col(embedding), lambda x: F.floor(x.cast("double") * scale))


def usable(embedding: str) -> Column:
    """A vector takes part if it and all its components are there and finite."""
    return F.col(embedding).isNotNull() & F.forall(
        F.col(embedding), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """Best ``k`` candidates of each query within one pair of blocks."""
    query = found["is_query"].to_numpy()
    rows, asked = found[~query], found[query]
    ids = rows["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    vectors = rows["vector"].to_numpy()[order]
    sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
    flat = np.concatenate([*vectors, np.zeros(0, np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(ids)), sizes)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    stored = flat != 0
    row, term, flat = row[stored], term[stored], flat[stored]
    by = np.argsort(term, kind="stable")
    row, weight = row[by], flat[by]
    ends = np.searchsorted(term[by], np.arange(int(sizes.max()) + 1 if len(sizes) else 1), "left")
    out = []
    score = np.empty(len(ids), np.int64)
    for q, vector in zip(asked["id"].to_numpy(), asked["vector"].to_numpy()):
        score[:] = 0
        for t, w in enumerate(vector[: len(ends) - 1]):
            if w:
                own = slice(ends[t], ends[t + 1])
                score[row[own]] += w * weight[own]      # a row is in a term's postings once
        other = np.flatnonzero(ids != q)
        if len(other) > k:
            least = np.partition(score[other], len(other) - k)[len(other) - k]
            other = other[score[other] >= least]
        best = other[np.lexsort((ids[other], -score[other]))][:k]
        out.append(pd.DataFrame({"query_id": q, "vec_id": ids[best], "score": score[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
          k: int = K, scale: int = SCALE, query_block: int = QUERY_BLOCK,
          candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows for each query, all
    rows if there are fewer; equal scores go to the smaller id.

    ``is_query`` says which rows are queries; a query's own id is never among its
    results.  Vectors that are null or hold a null or non-finite component, and
    rows with a null id, take no part; an empty vector scores 0; missing components of
    shorter vectors count as 0; rows that repeat an id are separate candidates,
    and a repeated query id is asked once, with one of its vectors; other columns
    are not read; an empty table gives no rows.  Scores are 64-bit integers."""
    spark = vectors.sparkSession
    ship(spark)
    rows = (vectors.where(usable(vector_col) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), integer_vector(vector_col, scale).alias("vector"),
                    is_query.alias("asked")))
    asked = rows.where("asked").groupBy("id").agg(F.min("vector").alias("vector"))
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("q")).first()
    q_blocks, c_blocks = max(1, math.ceil(n["q"] / query_block)), max(1, math.ceil(n["n"] / candidate_block))
    qb, cb = F.pmod(F.xxhash64("id"), F.lit(q_blocks)), F.pmod(F.xxhash64(F.lit(1), "id", F.lit(2)), F.lit(c_blocks))
    every_c = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long")))
    every_q = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long")))
    dealt = union(asked.select(qb.alias("qb"), every_c.alias("cb"), "id", "vector", F.lit(True).alias("is_query")),
                  rows.select(every_q.alias("qb"), cb.alias("cb"), "id", "vector", F.lit(False).alias("is_query")))
    partial = dealt.groupBy("qb", "cb").applyInPandas(
        lambda found: _best(found, k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum(list_transform(list_zip(q.w, c.w), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""
