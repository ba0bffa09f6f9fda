"""Document fingerprints by winnowing.

Every run of K code points is hashed by a rolling polynomial (prefix sums modulo 2**64), then mixed
and cut to 32 bits. Of every WINDOW consecutive hashes the smallest is kept, the rightmost one on
ties, with its position. Two texts that share a passage of K + WINDOW - 1 code points therefore share
at least one kept hash; the positions say where. A text shorter than that has one window, a text
shorter than K one gram (itself); an empty text has an empty fingerprint.

`edited` pairs each document with its successor in id order without sorting the table in one place:
ids are cut into ranges by quantiles, each range is one task's sorted stream, and the first document
of a range is also sent to the range before it. Null ids count as the smallest; rows with equal ids
follow each other by text. A null text is empty. The likeness of two fingerprints is the Dice
coefficient of their sets of hashes; two empty fingerprints are alike (1), an empty and another are
not (0).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import partitions, returning, sliced, small_batches, text_or_empty

K, WINDOW = 16, 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """32-bit hash of every run of k code points (of the whole text if it is shorter)."""
    n = len(points)
    if not n:
        return np.zeros(0, np.uint32)
    k = min(k, n)
    up, down = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    h = (sums[k:] - sums[:-k]) * down[: n - k + 1]
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    return (h >> np.uint64(32)).astype(np.uint32)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions kept: the rightmost minimum of every window."""
    n = len(hashes)
    if n <= 1:
        return np.arange(n)
    window = min(window, n)
    at, span = np.arange(n), 1  # at[i]: rightmost minimum of hashes[i : i + span]
    while span < window:
        step = min(span, window - span)
        a, b = at[: n - span - step + 1], at[step : n - span + 1]
        at = np.where(hashes[b] <= hashes[a], b, a)
        span += step
    return np.unique(at)


class Fingerprint:
    """Kept hashes and positions of one text."""

    def __init__(self, text: str, k: int = K, window: int = WINDOW):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        h = gram_hashes(points, k)
        self.at = winnow(h, window)
        self.hashes = h[self.at]
        self.set = np.unique(self.hashes)

    def text(self) -> str:
        """Per kept hash eight hexadecimal digits and the distance from the one before it, in
        hexadecimal digits behind a letter."""
        gaps = np.diff(self.at, prepend=0)
        return "".join([f"{h:08x}g{g:x}" for h, g in zip(self.hashes.tolist(), gaps.tolist(), strict=True)])

    def likeness(self, other: "Fingerprint") -> float:
        total = len(self.set) + len(other.set)
        if not total:
            return 1.0
        return 2.0 * len(np.intersect1d(self.set, other.set, assume_unique=True)) / total


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """(id, hashes array<bigint>, positions array<int>) of every text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in sliced(batches):
            f = [Fingerprint(t, k, window) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x.hashes.astype(np.int64) for x in f], pa.list_(pa.int64())), pa.array([x.at.astype(np.int32) for x in f], pa.list_(pa.int32()))],
                names=["id", "hashes", "positions"],
            )

    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    out = src.mapInArrow(returning(run), f"id {id_type}, hashes array<bigint>, positions array<int>")
    return out.withColumnRenamed("id", id_col)


def with_successors(docs: DataFrame, run, schema: str) -> DataFrame:
    """Apply run(iterator of (id, text, next text)) to the documents in id order, range by range."""
    small_batches(docs.sparkSession)
    lowest = -(1 << 63)
    src = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("key"), text_or_empty().alias("text"))
    n = max(2, 2 * partitions(docs.sparkSession))
    cuts = src.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10_000)).head()[0] or []
    # ranges by binary search; as doubles neighbouring large keys may be equal, but never out of order
    splits = [float("-inf"), *sorted({float(c) for c in cuts} or {0.0}), float("inf")]
    ranges = Bucketizer(splits=splits, inputCol="place", outputCol="bucket")
    placed = ranges.transform(src.withColumn("place", F.col("key").cast("double"))).withColumn("bucket", F.col("bucket").cast("int")).drop("place")
    first = {r.bucket: r.key for r in placed.groupBy("bucket").agg(F.min("key").alias("key")).collect()}  # a row per range
    order = sorted(first)
    starts = docs.sparkSession.createDataFrame([(first[b], order[i - 1]) for i, b in enumerate(order)], "key bigint, copy int")
    placed = placed.join(F.broadcast(starts), "key", "left")  # a row per range
    copy = F.col("copy")
    sent = (
        placed.withColumn("to", F.array_compact(F.array(F.struct(F.col("bucket").cast("int").alias("at"), F.lit(0).alias("copy")), F.when(copy.isNotNull(), F.struct(copy.alias("at"), F.lit(1).alias("copy"))))))
        .select("doc_id", "key", "text", F.explode("to").alias("to"))
        .select("to.at", "to.copy", "doc_id", "key", "text")
        .repartitionByRange(n, "at")
        .sortWithinPartitions("at", "copy", "key", "text")
    )

    def stream(batches):
        def rows():
            for b in sliced(batches):
                yield from zip(*[c.to_pylist() for c in b.columns], strict=True)

        held = None  # the last document that waits for the one after it
        for at, copy, doc_id, _, text in rows():
            if held is not None and held[0] == at:
                yield held[1], held[2], text
            held = (at, doc_id, text) if not copy else None
        # each range ends with a copy of its successor's first document, so nothing is left over

    return sent.mapInArrow(returning(lambda batches: run(stream(batches))), schema)


def op3_query(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every document and of its edited text, with likenesses."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(rows):
        out, ahead = [], (None, None)
        for doc_id, text, after in rows:
            half = len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            own = ahead[1] if ahead[0] == text and ahead[1] is not None else Fingerprint(text, k, window)
            new, nxt = Fingerprint(edited, k, window), Fingerprint(after, k, window)
            ahead = (after, nxt)
            out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.text(), new.text(), own.likeness(new), own.likeness(nxt)))
            if len(out) >= 500:
                yield _batch(out, names, id_type)
                out = []
        if out:
            yield _batch(out, names, id_type)

    schema = f"doc_id {id_type}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_successors(docs, run, schema)


def _batch(rows: list[tuple], names: list[str], id_type: str) -> pa.RecordBatch:
    kinds = [pa.int32() if id_type == "int" else pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
