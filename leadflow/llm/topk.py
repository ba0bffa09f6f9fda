"""Exact top-k search by pivot-table elimination.

Scores are integer inner products of quantised vectors. An inner product is half of
|q|^2 + |x|^2 - d(q, x)^2, so a lower bound of the distance d bounds the score from above. Every
vector keeps its distances to PIVOTS pivots; by the triangle inequality the largest difference
between a query's and a vector's distances to a pivot is such a lower bound. A task evaluates the
vectors of a block in the order of their bounds and stops a query where the next bound is below the
score of its k-th best so far; what is left out cannot enter, so the result is exact. A block keeps
the least and greatest distance to each pivot and its greatest norm, so a query passes over a whole
block whose best possible score is too low.

Vectors are packed into blocks where they lie (no shuffle): a task takes SORT_BLOCKS blocks' worth of
them, orders them by nearest pivot and distance, and cuts them into blocks, so that a block's
vectors lie close together. Queries are packed into blocks of
QUERY_BLOCK rows. Each pass sends at most PASS_BLOCKS query blocks to the tasks (a fixed bound of a
few MB), whatever the number of queries. A task keeps k rows a query over all its blocks; the rest
is merged by query.

Rows whose vector is null, empty or holds null or non-finite components take no part, nor do null
ids. Shorter vectors count as padded with zeros. Rows with a query's own id are its own row. Equal
scores go to the smaller id. Pivots are spread over a bounded sample, which affects speed only.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadflow.llm.common import checkpointed

PIVOTS, PIVOT_SAMPLE = 16, 512
BLOCK, QUERY_BLOCK, PASS_BLOCKS = 4096, 4096, 4
CHUNK, SORT_BLOCKS = 256, 8
_EXACT = 1 << 53


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(id, v array<bigint>) of the rows that take part: floor(scale * component)."""
    x: Column = F.col("v")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    src = src.filter(F.col("id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(x, fine))
    return src.select("id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first traversal of a sample."""
    if not len(sample):
        return np.zeros((0, 1))
    at = [int(np.argmax((sample**2).sum(1)))]
    near = ((sample - sample[at[0]]) ** 2).sum(1)
    while len(at) < min(n, len(sample)) and near.max() > 0:
        at.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[at[-1]]) ** 2).sum(1))
    return sample[at]


def _matrix(vectors, dims: int = 0) -> np.ndarray:
    dims = max([dims, *map(len, vectors)])
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class _Block:
    """Vectors with norms and their row of the pivot table."""

    def __init__(self, ids: bytes, data: bytes, dims: int, pivots: np.ndarray):
        self.ids = np.frombuffer(ids, np.int64)
        self.ints = np.frombuffer(data, np.int64).reshape(len(self.ids), dims)
        self.x = self.ints.astype(np.float64)
        self.norm = (self.x**2).sum(1)
        p = np.zeros((len(pivots), max(dims, pivots.shape[1])))
        p[:, : pivots.shape[1]] = pivots
        cross = self.x @ p[:, :dims].T
        self.table = np.sqrt(np.maximum(0, self.norm[:, None] + (p**2).sum(1)[None] - 2 * cross)).T.copy()
        self.nearest, self.farthest, self.most = self.table.min(1, initial=np.inf), self.table.max(1, initial=0), self.norm.max(initial=0)

    def best_score(self, q: "_Block") -> np.ndarray:
        """For each query a score that no vector of the block passes."""
        low = np.maximum(self.nearest[:, None] - q.table, q.table - self.farthest[:, None]).max(0, initial=0)
        total = q.norm + self.most
        return (total - low**2) / 2 + 1e-9 * total + 1


class _Best:
    """The k best of each query of one block so far."""

    def __init__(self, q: _Block, k: int):
        self.q, self.k = q, k
        self.scores = [np.zeros(0, np.int64)] * len(q.ids)
        self.ids = [np.zeros(0, np.int64)] * len(q.ids)

    def merge(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, d = np.concatenate([self.scores[i], scores]), np.concatenate([self.ids[i], ids])
        order = np.lexsort((d, -s))[: self.k]
        self.scores[i], self.ids[i] = s[order], d[order]

    def search(self, x: _Block) -> None:
        q, k = self.q, self.k
        dims = min(q.x.shape[1], x.x.shape[1])
        exact = float(np.abs(q.x).max(initial=0)) * float(np.abs(x.x).max(initial=0)) * max(dims, 1) < _EXACT
        best = x.best_score(q)
        for i in range(len(q.ids)):
            if len(self.scores[i]) >= k and best[i] < self.scores[i][-1]:
                continue
            low = np.abs(x.table - q.table[:, i][:, None]).max(0) if len(x.table) else np.zeros(len(x.ids))
            total = q.norm[i] + x.norm
            bound = (total - low**2) / 2 + 1e-9 * total + 1  # a little above, for rounding
            at = np.arange(len(x.ids))
            if len(self.scores[i]) >= k:
                at = at[bound >= self.scores[i][-1]]
            at = at[np.argsort(-bound[at], kind="stable")]
            for c in range(0, len(at), CHUNK):
                if len(self.scores[i]) >= k and bound[at[c]] < self.scores[i][-1]:
                    break
                part = at[c : c + CHUNK]
                part = part[x.ids[part] != q.ids[i]]
                if exact:
                    s = (x.x[part, :dims] @ q.x[i, :dims]).astype(np.int64)
                else:
                    s = np.array([sum(int(a) * int(b) for a, b in zip(r, q.ints[i], strict=False)) for r in x.ints[part, :dims]], np.int64)
                if len(self.scores[i]) >= k:
                    keep = s >= self.scores[i][-1]
                    s, part = s[keep], part[keep]
                if len(s):
                    self.merge(i, s, x.ids[part])


def packed(rows: DataFrame, size: int, pivots: np.ndarray) -> DataFrame:
    """Blocks of up to `size` vectors close to each other: (ids binary, data binary, dims int)."""

    def run(frames):
        ids, vectors = [], []

        def out():
            m = _matrix(vectors).astype(np.int64) if all(abs(c) < _EXACT for v in vectors for c in (min(v), max(v))) else _ints(vectors)
            table = _Block(np.array(ids, np.int64).tobytes(), m.tobytes(), m.shape[1], pivots).table
            order = np.lexsort((table.min(0), table.argmin(0))) if len(table) else np.arange(len(ids))
            for c in range(0, len(order), size):
                at = order[c : c + size]
                yield pd.DataFrame({"ids": [np.array(ids, np.int64)[at].tobytes()], "data": [m[at].tobytes()], "dims": [m.shape[1]]})
            ids.clear()
            vectors.clear()

        for f in frames:
            for i, v in zip(f["id"], f["v"], strict=True):
                ids.append(i)
                vectors.append(v)
                if len(ids) == size * SORT_BLOCKS:
                    yield from out()
        if ids:
            yield from out()

    return rows.mapInPandas(run, "ids binary, data binary, dims int")


def _ints(vectors) -> np.ndarray:
    m = np.zeros((len(vectors), max(map(len, vectors))), np.int64)
    for i, v in enumerate(vectors):
        m[i, : len(v)] = v
    return m


def exact_topk(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each query; both sides (id, v)."""
    sample = rows.orderBy(F.xxhash64("id", "v")).limit(PIVOT_SAMPLE).select("v").collect()
    pivots = choose_pivots(_matrix([r.v for r in sample]) if sample else np.zeros((0, 1)), PIVOTS)
    n_queries = queries.count()
    q = packed(queries.repartition(max(1, -(-n_queries // QUERY_BLOCK)), F.xxhash64("id")), QUERY_BLOCK, pivots)
    q = checkpointed(q.withColumn("block", F.monotonically_increasing_id()))
    blocks = [r.block for r in q.select("block").orderBy("block").collect()]  # one per QUERY_BLOCK queries
    data = packed(rows, BLOCK, pivots)
    if len(blocks) > PASS_BLOCKS:
        data = checkpointed(data)

    def run(frames):
        best: dict[int, _Best] = {}
        held: tuple = (None, None)
        for f in frames:
            for r in f.itertuples(index=False):
                if held[0] != (r.ids, r.data):
                    held = ((r.ids, r.data), _Block(r.ids, r.data, r.dims, pivots))
                if r.block not in best:
                    best[r.block] = _Best(_Block(r.q_ids, r.q_data, r.q_dims, pivots), k)
                best[r.block].search(held[1])
        for b in best.values():
            n = [len(s) for s in b.scores]
            if sum(n):
                yield pd.DataFrame({"query_id": np.repeat(b.q.ids, n), "vec_id": np.concatenate(b.ids), "score": np.concatenate(b.scores)})

    found = None
    for i in range(0, len(blocks), PASS_BLOCKS):
        few = q.filter(F.col("block").isin(blocks[i : i + PASS_BLOCKS])).select("block", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("dims").alias("q_dims"))
        # at most PASS_BLOCKS * QUERY_BLOCK vectors are sent to the tasks at a time
        part = data.crossJoin(F.broadcast(few)).mapInPandas(run, "query_id bigint, vec_id bigint, score bigint")
        if len(blocks) > PASS_BLOCKS:
            part = checkpointed(part)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, score bigint")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_query(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    rows = quantised(embeddings, "vec_id", "embedding")
    return exact_topk(rows.filter(F.col("id") % every == 0), rows, k)


OP4_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id as vec_id,
         cast(list_inner_product(cast(q.e as double[]), cast(c.e as double[])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
), r as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score from s
)
select query_id, rank, vec_id, score from r where rank <= 5
"""
