"""Centroid clustering by dimension-sharded Lloyd rounds on whole numbers.

Vectors are cut by columns: a chunk of CHUNK vectors becomes one row for each column block, in the
folder of that block. A task of a block reads only its columns and the matching slice of the
centroids and gives the exact partial distances of its chunk to all centroids. Partial distances are
added by chunk (a key with one row a block), and the argmin is the assignment. The assignment goes
back to the shards; each adds up its own columns by centroid within a task first, so a centroid that
holds a third of all vectors sends one sum a task, and its slice becomes floor(sum / count).

The driver holds k x dims whole numbers between rounds (two parameters, not the data); each round
starts anew from the written shards, so a lost executor costs its tasks of the round at hand.

Kept are vectors with exactly `dims` components, none null or non-finite. Rows with equal or null ids
are separate rows. The first centroids are the kept vectors with the smallest SHA-256 of
`<seed>:<id>`; null ids come last, equal ids by their components. With fewer vectors than k there are
fewer centroids; without vectors the result is empty. Ties go to the smaller centroid number; an
empty centroid stays. Components so large that squared distances could leave 64 bits raise an error.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import materialised, remove, shared_dir
from leadflow.llm.vectors import blocks_of, compact, finite_vectors, whole_numbers

CHUNK, BLOCKS = 4096, 4
_NAMES = -1  # the block that holds the ids of a chunk in place of columns


def first_centroids(kept: DataFrame, id_col: str, vec_col: str, k: int, seed: int, scale: int) -> np.ndarray:
    """k x dims whole numbers: the kept vectors with the smallest hashes, in their order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    first = kept.select(digest.alias("h"), F.col(vec_col).alias("v")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()  # k rows
    if not first:
        return np.zeros((0, 0), np.int64)
    return whole_numbers(pa.array([r.v for r in first], pa.list_(pa.float64())), len(first[0].v), scale)


def _bounds(dims: int, blocks: int) -> list[tuple[int, int]]:
    at = [round(i * dims / blocks) for i in range(blocks + 1)]
    return [(a, b) for a, b in zip(at, at[1:], strict=False) if b > a]


def write_shards(kept: DataFrame, path: str, id_col: str, vec_col: str, dims: int, blocks: int, scale: int) -> DataFrame:
    """(chunk, ids, kind, data, block): a row for each column block of a chunk, one folder a block."""
    spark = kept.sparkSession
    id_type = kept.schema[id_col].dataType.simpleString()
    bounds = _bounds(dims, blocks)

    def run(batches):
        chunk = TaskContext.get().partitionId() << 32
        for ids, vectors in blocks_of(batches, CHUNK, ["id", "v"]):
            m = compact(whole_numbers(vectors, dims, scale))
            n = len(bounds) + 1
            offsets = pa.array([0] + [len(ids)] * n, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk] * n, pa.int64()),
                    pa.ListArray.from_arrays(offsets, ids),
                    pa.array([m.dtype.str] * n),
                    pa.array([b"", *[np.ascontiguousarray(m[:, a:b]).tobytes() for a, b in bounds]], pa.binary()),
                    pa.array([_NAMES, *range(len(bounds))], pa.int32()),
                ],
                names=["chunk", "ids", "kind", "data", "block"],
            )
            chunk += 1

    src = kept.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    out = src.mapInArrow(run, f"chunk bigint, ids array<{id_type}>, kind string, data binary, block int")
    out.write.partitionBy("block").option("compression", "zstd").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def assign(shards: DataFrame, centroids: np.ndarray, bounds: list[tuple[int, int]]) -> DataFrame:
    """(chunk, labels, distances) of each chunk: partial distances by block, added by chunk, argmin."""
    k = len(centroids)

    def partial(frames):
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                a, b = bounds[r.block]
                x = np.frombuffer(r.data, r.kind).reshape(-1, b - a).astype(np.int64)
                d = np.empty((len(x), k), np.int64)
                for j in range(k):
                    d[:, j] = ((x - centroids[j, a:b]) ** 2).sum(1)
                d = compact(d)
                out.append((r.chunk, d.dtype.str, d.tobytes()))
            yield pd.DataFrame(out, columns=["chunk", "kind", "part"])

    def added(f: pd.DataFrame) -> pd.DataFrame:
        d = sum(np.frombuffer(r.part, r.kind).reshape(-1, k).astype(np.int64) for r in f.itertuples(index=False))
        labels = d.argmin(1)  # the first of equal ones
        return pd.DataFrame({"chunk": [f["chunk"].iloc[0]], "labels": [labels.astype(np.int32).tobytes()], "distances": [d[np.arange(len(d)), labels].tobytes()]})

    parts = shards.filter(F.col("block") != _NAMES).select("chunk", "kind", "data", "block").mapInPandas(partial, "chunk bigint, kind string, part binary")
    return parts.groupBy("chunk").applyInPandas(added, "chunk bigint, labels binary, distances binary")


def moved(shards: DataFrame, assigned: DataFrame, centroids: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """The centroids after each shard has updated its own slice."""
    k = len(centroids)

    def sums(frames):
        total: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for f in frames:
            for r in f.itertuples(index=False):
                a, b = bounds[r.block]
                x = np.frombuffer(r.data, r.kind).reshape(-1, b - a).astype(np.int64)
                labels = np.frombuffer(r.labels, np.int32)
                if r.block not in total:
                    total[r.block], counts[r.block] = np.zeros((k, b - a), np.int64), np.zeros(k, np.int64)
                for j in np.unique(labels):
                    total[r.block][j] += x[labels == j].sum(0)
                counts[r.block] += np.bincount(labels, minlength=k)
        for block, t in total.items():
            j, at = np.nonzero(np.broadcast_to(counts[block][:, None] > 0, t.shape))
            yield pd.DataFrame({"cluster": j, "place": at + bounds[block][0], "total": t[j, at], "n": counts[block][j]})

    joined = shards.filter(F.col("block") != _NAMES).select("chunk", "kind", "data", "block").join(assigned.select("chunk", "labels"), "chunk")
    added = joined.mapInPandas(sums, "cluster int, place int, total bigint, n bigint").groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    mean = added.select("cluster", "place", F.expr("(total - pmod(total, n)) div n").alias("mean")).collect()  # k x dims numbers
    out = centroids.copy()
    for r in mean:
        out[r.cluster, r.place] = r.mean
    return out


def cluster(vectors: DataFrame, k: int, rounds: int, *, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, scale: int = 64, seed: int = 1, blocks: int = BLOCKS) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) of every kept vector as a written table, final centroids)."""
    spark = vectors.sparkSession
    kept = finite_vectors(vectors.select(id_col, vec_col), vec_col, dims=dims)
    id_type = kept.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, cluster int, distance bigint"
    centroids = first_centroids(kept, id_col, vec_col, k, seed, scale)
    if not len(centroids):
        return spark.createDataFrame([], schema), centroids
    bounds = _bounds(dims, blocks)
    path = f"{shared_dir(spark)}/lloyd-shards-{uuid.uuid4().hex}"
    shards = write_shards(kept, path, id_col, vec_col, dims, blocks, scale)
    for _ in range(rounds):
        centroids = moved(shards, assign(shards, centroids, bounds), centroids, bounds)

    def unpacked(batches):
        for b in batches:
            for i in range(b.num_rows):
                labels, distances = (np.frombuffer(b.column(c)[i].as_py(), t) for c, t in ((1, np.int32), (2, np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0)[i].values, pa.array(labels), pa.array(distances)], names=[id_col, "cluster", "distance"])

    names = shards.filter(F.col("block") == _NAMES).select("chunk", "ids")
    last = names.join(assign(shards, centroids, bounds), "chunk").select("ids", "labels", "distances")
    found = materialised(last.mapInArrow(unpacked, schema), "lloyd")
    remove(spark, path)
    return found, centroids


def op12_query(embeddings: DataFrame, k: int = 16, rounds: int = 3) -> DataFrame:
    """Cluster of every kept vector with distances and inertia."""
    found, centroids = cluster(embeddings, k, rounds)
    spark = embeddings.sparkSession
    digests = [(j, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for j, c in enumerate(centroids)]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    per = sums.join(F.broadcast(named), "cluster").crossJoin(F.broadcast(total))  # k rows, one row
    return found.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op12_sql(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> str:
    parts = [
        f"""v as materialized (select row_number() over () as uid, vec_id, list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as e
  from embeddings where embedding is not null and len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0)""",
        f"""c0 as materialized (select cast(row_number() over (order by sha256('1:' || cast(vec_id as varchar)) nulls last, e) - 1 as int) as cluster, e as c
  from v qualify cluster < {k})""",
        "long as materialized (select uid, unnest(range(1, len(e) + 1)) as place, unnest(e) as x from v)",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} as materialized (select uid, arg_min(cluster, (d, cluster)) as cluster, min(d) as distance from (
  select uid, cluster, cast(list_sum(list_transform(list_zip(e, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint) as d from v cross join c{r}) p group by uid)"""
        )
        if r < rounds:
            parts.append(f"m{r} as materialized (select cluster, list(m order by place) as c from (select cluster, place, cast(floor(sum(x) / count(*)) as bigint) as m from long join a{r} using (uid) group by cluster, place) g group by cluster)")
            parts.append(f"c{r + 1} as materialized (select o.cluster, coalesce(m.c, o.c) as c from c{r} o left join m{r} m using (cluster))")
    return "with " + ",\n".join(parts) + f"""
select vec_id, cluster, distance, cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia, cast(sum(distance) over () as bigint) as inertia,
  sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join v using (uid) join c{rounds} using (cluster)"""


OP12_SQL = _op12_sql()
