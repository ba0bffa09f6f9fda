"""Mixing sources to target weights by Sainte-Lague apportionment.

1. Sizes: words per document, summed per source and per shard (documents are dealt to shards of
   their source by a seeded hash).
2. Targets: sources in code-point order weigh 5, 2, 1, repeating; together they get SHARE of all
   words, none more than TIMES its own size; what is above is shared anew by weight among the rest.
3. Apportionment: the mix is made of blocks of BLOCK words. Blocks go to the sources by highest
   quotients target / (2 s + 1), and a source's last block is cut, or one begun, to meet its target;
   then each source's blocks go to its shards in the same way, so every shard has an integer quota
   for its source.
4. Selection: a shard's documents stand in seeded hash order and are cut into blocks. Whole passes
   over the shard are taken first; of the rest of the quota a seeded systematic draw picks blocks,
   the last of which is cut to the quota. A document takes the words of its chosen blocks, so never
   more than TIMES its size. The words of these very blocks are what apply_mix emits, so each part of
   a long text has the same chance.

Only one row per source is gathered on the driver, at most MAX_SOURCES; more raise an error. A source
has a shard per SHARD_ROWS rows, or MOST_SHARDS larger ones, so its quotas fit into one task. Rows
with a null text have size 0; null sources form one source that stands last; repeated rows count
each; nothing depends on the order of rows, so reruns agree.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadflow.llm.common import WORD, checkpointed, fresh, returning, sliced, small_batches

WEIGHTS, SHARE, TIMES = (5, 2, 1), 1.5, 2
_WORD = re.compile(WORD)
BLOCK, SHARD_ROWS, MOST_SHARDS, MAX_SOURCES = 64, 4_000, 100_000, 1_000_000
DRAWN = ("passes", "part", "start", "n_taken", "shift", "n_blocks")


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, times: int = TIMES) -> list[float]:
    """Words each source should give; sources in order."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    total, out, free = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        left = total - sum(times * sizes[i] for i in range(len(sizes)) if i not in free)
        sum_w = sum(weight[i] for i in free)
        over = {i for i in free if left * weight[i] / sum_w > times * sizes[i]}
        if not over:
            for i in free:
                out[i] = left * weight[i] / sum_w
            break
        for i in over:
            out[i] = float(times * sizes[i])
        free -= over
    return out


def apportion(votes: list[float], seats: int, most: list[int] | None = None) -> list[int]:
    """Seats by highest quotients votes / (2 s + 1), ties to the earlier one, within the most each may have."""
    total = float(sum(votes))
    if seats <= 0 or total <= 0:
        return [0] * len(votes)
    most = most if most is not None else [seats] * len(votes)
    given = [min(m, max(0, int(v * seats / total - 0.5))) for v, m in zip(votes, most, strict=True)]
    left = seats - sum(given)
    heap = [(-v / (2 * s + 1), i) for i, (v, s) in enumerate(zip(votes, given, strict=True)) if s < most[i] and v > 0]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        given[i] += 1
        left -= 1
        if given[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * given[i] + 1), i))
    return given


def mix(docs: DataFrame, seed: int = 42, weights=WEIGHTS, share: float = SHARE, times: int = TIMES, block: int = BLOCK) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, shard) of every document, and what names the
    blocks drawn: passes over the whole text, words of a last part, start on the shard's line, n_taken,
    shift, n_blocks."""
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    sized = checkpointed(sized.withColumn("pos", F.xxhash64("doc_id", "source", "size", F.lit(seed))))
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(per) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    per.sort(key=lambda r: (r.source is None, r.source or ""))
    goal = targets([r.source_size for r in per], weights, share, times)
    blocks = apportion(goal, round(sum(goal) / block))
    columns = {
        "source": pa.array([r.source for r in per], pa.string()),
        "source_size": pa.array([int(r.source_size) for r in per], pa.int64()),
        "target": pa.array(goal, pa.float64()),
        "blocks": pa.array(blocks, pa.int64()),
        "goal": pa.array([round(g) for g in goal], pa.int64()),
        "shards": pa.array([min(MOST_SHARDS, max(1, -(-r.n // SHARD_ROWS))) for r in per], pa.int64()),
    }
    plan = spark.createDataFrame(pa.table(columns))  # from Arrow, so without Python workers
    # one row per source; at most MAX_SOURCES, so it may be sent to all tasks
    dealt = sized.join(F.broadcast(plan), sized["source"].eqNullSafe(plan["source"]), "left").drop(plan["source"])
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("pos", F.lit(seed + 1)), F.greatest("shards", F.lit(1))))
    shards = dealt.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.first("blocks").alias("blocks"), F.first("goal").alias("goal"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))

    def quotas(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard", kind="stable").reset_index(drop=True)
        words = pdf["words"].to_numpy(np.int64)
        most = [int(times * w // block) for w in words]
        goal = int(pdf["goal"].iloc[0])
        given = np.array(apportion([float(w) for w in words], min(int(pdf["blocks"].iloc[0]), goal // block), most), np.int64)
        quota = given * block
        left = goal - int(quota.sum())  # the source's last block is cut, or one more begun
        for i in np.lexsort((np.arange(len(words)), -words / (2 * given + 1))):
            more = max(0, min(left, int(times * words[i] - quota[i])))
            quota[i] += more
            left -= more
        return pd.DataFrame({"source": pdf["source"], "shard": pdf["shard"], "words": words, "quota": quota})

    quota = shards.groupBy("source").applyInPandas(quotas, "source string, shard bigint, words bigint, quota bigint")
    q = quota.select(F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "words", "quota")
    joined = dealt.join(q, dealt["source"].eqNullSafe(q["q_source"]) & (dealt["shard"] == q["q_shard"]), "left")
    line = W.partitionBy("source", "shard").orderBy("pos", "doc_id")
    end = F.sum("size").over(line.rowsBetween(W.unboundedPreceding, 0))
    out = joined.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    out = out.withColumn("passes", F.when(F.col("words") > 0, F.floor(F.col("quota") / F.col("words"))).otherwise(0))
    out = out.withColumn("rest", F.col("quota") - F.col("passes") * F.col("words"))
    out = out.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("words") / block)))
    # one block more than the rest fills, for the shorter last block of the line may be among them
    spare = F.when((F.col("rest") > 0) & (F.col("words") % block > 0), 1).otherwise(0)
    out = out.withColumn("n_taken", F.least(F.ceil(F.col("rest") / block) + spare, F.col("n_blocks")))
    out = out.withColumn("shift", F.pmod(F.xxhash64("source", "shard", F.lit(seed + 2)), F.col("n_blocks")))

    def upto(x):
        """Words of chosen blocks before place x of the shard's line, up to the rest of the quota:
        block j is chosen where floor((j q + shift) / n) steps up."""
        j = F.floor(x / F.lit(block)).cast("long")
        step = lambda i: F.floor((i * F.col("n_taken") + F.col("shift")) / F.col("n_blocks")).cast("long")
        return F.least((step(j) - step(F.lit(0))) * block + (step(j + 1) - step(j)) * (x - j * block), F.col("rest"))

    out = out.withColumn("part", (upto(F.col("end")) - upto(F.col("start"))).cast("long"))
    out = out.withColumn("taken", (F.col("passes") * F.col("size") + F.col("part")).cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", "shard", *DRAWN)


def op9_query(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def drawn_words(size: int, part: int, start: int, n_taken: int, shift: int, n_blocks: int, block: int = BLOCK) -> list[tuple[int, int]]:
    """Word ranges [from, to) of a document at `start` of its shard's line that lie in chosen blocks,
    `part` words at most; adjoining blocks make one range."""
    if not part:
        return []
    first = start // block
    j = np.arange(first, (start + size - 1) // block + 2, dtype=np.int64)
    chosen = np.diff((j * n_taken + shift) // n_blocks) > 0
    turns = np.flatnonzero(np.diff(np.concatenate([[False], chosen, [False]]).astype(np.int8)))
    edges = np.clip((turns + first) * block - start, 0, size).tolist()
    out = []
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        b = min(b, a + part)
        if b > a:
            out.append((a, b))
            part -= b - a
    return out


def cut_words(text: str, ranges: list[tuple[int, int]]) -> str:
    """The words of the ranges with the white space between them; a range begins on a new line."""
    at = [m.span() for m in _WORD.finditer(text)]
    return "\n".join(text[at[a][0] : at[b - 1][1]] for a, b in ranges)


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed table, with the columns of docs: each row as often as it is taken whole, and a last
    time with the words of its drawn blocks where a part is left. n_chars, if there, follows the text.
    Rows that differ in any column are drawn apart."""
    counts = ["size", *DRAWN]
    row_hash, own_hash, own_id, *places = fresh(docs, "row_hash", "own_hash", "own_id", *[f"n_{c}" for c in counts])
    hashed = docs.withColumn(row_hash, F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind]))
    taken = mix(hashed.select(F.struct("doc_id", F.col(row_hash).alias("h")).alias("doc_id"), "source", "text"), **options).filter("taken > 0")
    taken = taken.select(F.col("doc_id.doc_id").alias(own_id), F.col("doc_id.h").alias(own_hash), *[F.col(c).cast("long").alias(p) for c, p in zip(counts, places, strict=True)])
    # rows equal in all columns differ in their place on the line only; one of them serves all
    once = hashed.dropDuplicates(["doc_id", row_hash])
    src = once.join(taken, once["doc_id"].eqNullSafe(F.col(own_id)) & (F.col(row_hash) == F.col(own_hash)))
    fields = {f.name: f for f in docs.schema.fields}
    small_batches(docs.sparkSession)
    names = docs.columns
    src = src.select(*names, *places)
    text_at = names.index("text")
    chars_at = names.index("n_chars") if "n_chars" in fields else None
    block = options.get("block", BLOCK)

    def run(batches):
        for b in sliced(batches):
            index, texts = [], []
            drawn = (b.column(len(names) + k).to_pylist() for k in range(len(counts)))
            for i, (text, size, whole, *place) in enumerate(zip(b.column(text_at).to_pylist(), *drawn, strict=True)):
                part = drawn_words(size, *place, block=block)
                index += [i] * (whole + bool(part))
                texts += [text] * whole + ([cut_words(text, part)] if part else [])
            out = b.take(pa.array(index, pa.int64())).select(names)
            columns = list(out.columns)
            columns[text_at] = pa.array(texts, out.schema.field(text_at).type)
            if chars_at is not None:
                columns[chars_at] = pa.array([len(t) for t in texts], out.schema.field(chars_at).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return src.mapInArrow(returning(run), docs.schema)
