"""Near-duplicate detection with a MinHash LSH forest; links confirmed on full shingle sets.

1. Sets: words of a text (lower-cased A-Z, runs of anything but ASCII white space), distinct
   shingles of SHINGLE words; a shorter text is one shingle; no words, no shingles. Texts with equal
   sets fall together in one aggregation (partial first), so copies cost nothing later.
2. Forest: HASHES min-hashes a set; TREES sorted orders, each reading DEPTH of them from another
   start. An order is a range-partitioned sort of (tree, path, id), so a region of any size spreads
   over many tasks, and rows on the two sides of a range border are compared as others are.
   Neighbours that share at least the first level of the path are candidates; where many rows share
   it, the sort puts those with the longest common prefix side by side, so the depth adapts to how
   crowded a region is. A sketch of four bits a hash and the set sizes rule out candidates that are
   far below the threshold.
3. Rounds: the first looks at the nearest NEAR neighbours, links most of every group, and notes which
   rows have more neighbours in which orders; the second joins these rows, in these orders only, with
   all rows of other components that share two levels of the path, however many they are. Each
   candidate is confirmed on the full sets.
4. Components by alternating large-star and small-star steps; the label is the smallest doc_id.

The forest is probabilistic: a pair at the threshold is missed if it shares two levels in none of the
TREES orders (2 in a million), or if its sketches estimate it below LIKELY (about 2 in 100,000). The
size of a region plays no part. A link is never wrong.
Null and wordless texts are linked with nothing. Rows without a doc_id are linked with nothing and
kept. Repeated rows share their component. doc_id is expected to name one text.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import checkpointed, discard, materialised, partitions, release, returning, sliced, small_batches, text_or_empty

SHINGLE, PERCENT = 5, 75
HASHES, TREES, DEPTH = 96, 16, 16
NEAR = 6
LIKELY = 0.56  # estimates below this are no candidates: over four deviations (0.046 each) below the threshold
BROADCAST_IDS = 1_000_000
_MULTIPLIERS = np.random.default_rng(20).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD_POWERS = np.random.default_rng(21).integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        v = self[word] = xxhash.xxh3_64_intdigest(word)
        return v


_HASHES = _WordHashes()


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    size = min(n, SHINGLE)
    total = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        total += _mix(h[j : n - size + 1 + j] + np.uint64(j)) * _WORD_POWERS[j]
    return np.unique(_mix(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The upper 32 bits of the least product of each multiplier."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for c in range(0, len(shingles), 1024):
        np.minimum(low, (shingles[c : c + 1024, None] * _MULTIPLIERS).min(0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def document_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n, k1, k2, sig): set size, 128-bit key of the set, min-hashes."""

    def run(batches):
        for b in sliced(batches):
            sets = [shingle_set(t) for t in b.column(1).to_pylist()]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            sigs = [signature(s).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(sigs, pa.binary())],
                names=["doc_id", "n", "k1", "k2", "sig"],
            )
        _HASHES.clear()

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return src.mapInArrow(returning(run), "doc_id bigint, n bigint, k1 bigint, k2 bigint, sig binary")


def forest_orders(nodes: DataFrame) -> DataFrame:
    """(place, sid, n, sketch, comp) sorted by place within ranges: tree, path and id. nodes may have
    `trees`, a bit mask of the orders that each row is wanted in; else it is wanted in all."""
    nodes = nodes if "trees" in nodes.columns else nodes.withColumn("trees", F.lit((1 << TREES) - 1))

    def run(batches):
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            sid, n, sig, comp, trees = (b.column(i) for i in range(5))
            sigs = np.frombuffer(b"".join(sig.to_pylist()), np.uint32).reshape(m, HASHES)
            four = (sigs & 15).astype(np.uint8)
            sketches = pa.array(list(map(bytes, four[:, ::2] | four[:, 1::2] << 4)), pa.binary())
            ids = sid.to_numpy(zero_copy_only=False).astype(">i8").view(np.uint8).reshape(m, 8)
            wanted = trees.to_numpy(zero_copy_only=False)
            for t in range(TREES):
                at = np.flatnonzero(wanted >> t & 1)
                if not len(at):
                    continue
                levels = [(t * (HASHES // TREES) + j) % HASHES for j in range(DEPTH)]
                path = sigs[np.ix_(at, levels)]
                head = np.ascontiguousarray(path[:, :1].astype(">u4")).view(np.uint8)
                rest = np.ascontiguousarray(path[:, 1:].astype(np.uint16).astype(">u2")).view(np.uint8)
                place = np.concatenate([np.full((len(at), 1), t, np.uint8), head, rest, ids[at]], 1)
                pick = pa.array(at)
                yield pa.RecordBatch.from_arrays([pa.array(list(map(bytes, place)), pa.binary()), sid.take(pick), n.take(pick), sketches.take(pick), comp.take(pick)], names=["place", "sid", "n", "sketch", "comp"])

    rows = nodes.select("sid", "n", "sig", "comp", F.col("trees").cast("int").alias("trees")).mapInArrow(returning(run), "place binary, sid bigint, n bigint, sketch binary, comp bigint")
    return rows.repartitionByRange(max(2, partitions(nodes.sparkSession)), "place").sortWithinPartitions("place")


_SAME = np.array([((x & 15) == 0) + ((x >> 4) == 0) for x in range(256)], np.uint8)
_BORDER = ["place", "sid", "n", "sketch", "comp"]
_FOUND = "a bigint, b bigint, trees int, place binary, sid bigint, n bigint, sketch binary, comp bigint, part int, at bigint"


def compare(held: pd.DataFrame, span: int, nearest: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, crowded) of sorted rows: likely pairs of different components at most `span` apart, and
    flags of the rows that share the first level with rows which they were not compared with."""
    m = len(held)
    place = np.frombuffer(b"".join(held["place"]), np.uint8).reshape(m, -1)
    head = place[:, :5].astype(np.uint64) @ (np.uint64(256) ** np.arange(4, -1, -1, dtype=np.uint64))
    sketch = np.frombuffer(b"".join(held["sketch"]), np.uint8).reshape(m, -1)
    n, comp = held["n"].to_numpy(np.int64), held["comp"].to_numpy(np.int64)
    done, crowded = np.zeros(m, bool), np.zeros(m, bool)
    left, right = [], []
    for d in range(1, min(span + 2, m)):
        i = np.flatnonzero(head[:-d] == head[d:])
        if not len(i):
            break
        j = i + d
        apart = comp[i] != comp[j]
        skip = done[i] if nearest and d > 2 else np.zeros(len(i), bool)
        if d > span:
            skip[:] = True
        crowded[i[skip & apart]] = crowded[j[skip & apart]] = True
        if d > span:
            break
        small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        fit = apart & ~skip & (100 * small >= PERCENT * large)
        i, j = i[fit], j[fit]
        share = _SAME[sketch[i] ^ sketch[j]].sum(1, dtype=np.int64) / HASHES
        ok = (share - 1 / 16) / (15 / 16) >= LIKELY
        i, j = i[ok], j[ok]
        done[i] = True
        left.append(i)
        right.append(j)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right]), crowded


def _pairs(held: pd.DataFrame, i: np.ndarray, j: np.ndarray) -> pd.DataFrame:
    sid = held["sid"].to_numpy(np.int64)
    return pd.DataFrame({"a": np.minimum(sid[i], sid[j]), "b": np.maximum(sid[i], sid[j]), "trees": 0}).drop_duplicates()


def _crowd(held: pd.DataFrame, at: np.ndarray) -> pd.DataFrame:
    sid = held["sid"].to_numpy(np.int64)[at]
    tree = np.array([held["place"].iloc[k][0] for k in at], np.int64)
    return pd.DataFrame({"a": sid, "b": sid, "trees": np.left_shift(1, tree)})


def neighbours(orders: DataFrame, span: int, nearest: bool) -> DataFrame:
    """(a, b, trees): candidate pairs a < b of different components, with trees 0; and for a row that
    has more neighbours in some orders than it was compared with, a = b and the mask of these orders.
    Rows on the two sides of a range border are compared as others are."""

    def run(frames):
        part, first = TaskContext.get().partitionId(), 0
        rest = None
        for f in frames:
            held = f if rest is None else pd.concat([rest, f], ignore_index=True)
            if len(held):
                i, j, crowded = compare(held, span, nearest)
                yield _pairs(held, i, j).reindex(columns=columns)
                if crowded.any():
                    yield _crowd(held, np.flatnonzero(crowded)).reindex(columns=columns)
                old = len(held) - len(f)
                if first < span + 1:
                    at = np.arange(old, min(len(held), span + 1 - first + old))
                    yield border(held, at, first - old, part)
                first += len(f)
                rest = held.tail(span + 1)
        if rest is not None:  # rows among the first as well come twice
            yield border(rest, np.arange(len(rest)), first - len(rest), part)

    columns = [c.split()[0] for c in _FOUND.split(", ")]

    def border(held, at, shift, part):
        return held.iloc[at][_BORDER].assign(part=part, at=at + shift).reindex(columns=columns)

    found = checkpointed(orders.mapInPandas(returning(run), _FOUND))
    edge = found.filter("part is not null")
    counts = sorted((r.part, r.n) for r in edge.groupBy("part").agg((F.max("at") + 1).alias("n")).collect())  # a row per range
    starts = np.cumsum([0, *[n for _, n in counts]]).tolist()
    near = [(p, s, [c for c in starts[max(1, k - span) : k + span + 2] if c < starts[-1] and s - span <= c <= s + n + span]) for k, ((p, n), s) in enumerate(zip(counts, starts, strict=False))]
    spark = orders.sparkSession
    kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()))
    listed = [pa.array([r[k] for r in near], kind) for k, kind in enumerate(kinds)]
    cuts = spark.createDataFrame(pa.table(listed, ["part", "start", "cuts"]))  # a row per range; from Arrow, so without Python workers
    edge = edge.join(F.broadcast(cuts), "part").withColumn("at", F.col("start") + F.col("at"))
    close = F.filter("cuts", lambda c: (F.col("at") >= c - span) & (F.col("at") < c + span))
    edge = edge.select(*_BORDER, "at", F.explode(close).alias("cut"))

    def across(pdf):
        held = pdf.drop_duplicates("at").sort_values("at").reset_index(drop=True)  # at most 2 * span rows
        i, j, _ = compare(held, span, False)
        keep = (held["at"].to_numpy()[i] < held["cut"].iloc[0]) & (held["at"].to_numpy()[j] >= held["cut"].iloc[0])
        side = held["at"].to_numpy() < held["cut"].iloc[0]
        last, new = np.flatnonzero(side)[-1:], np.flatnonzero(~side)[:1]
        out = [_pairs(held, i[keep], j[keep])]
        if len(last) and len(new) and held["place"].iloc[last[0]][:5] == held["place"].iloc[new[0]][:5]:
            head = held["place"].iloc[last[0]][:5]  # a region across the border counts as crowded there
            out.append(_crowd(held, np.flatnonzero([p[:5] == head for p in held["place"]])))
        return pd.concat(out, ignore_index=True)[["a", "b", "trees"]]

    more = edge.groupBy("cut").applyInPandas(across, "a bigint, b bigint, trees int")
    both = found.filter("part is null").select("a", "b", "trees").unionByName(more)
    return both.groupBy("a", "b").agg(F.bit_or("trees").alias("trees"))


REST_PART = 1_000  # rows of one region that a task joins with the others
_NIBBLES = 0x1111111111111111


def crowded_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b): all likely pairs a < b of different components that share the first two levels of their
    path in one of the orders that `trees` names, in regions of any size. A join, so nothing is cut; a
    large region is dealt over tasks, and one that is a single component already is passed over."""

    def run(batches):
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            sid, n, sig, comp, trees = (b.column(i) for i in range(5))
            sigs = np.frombuffer(b"".join(sig.to_pylist()), np.uint32).reshape(m, HASHES)
            four = (sigs & 15).astype(np.uint8)
            words = np.ascontiguousarray(four[:, ::2] | four[:, 1::2] << 4).view(np.int64)
            wanted = trees.to_numpy(zero_copy_only=False)
            for t in range(TREES):
                at = np.flatnonzero(wanted >> t & 1)
                if not len(at):
                    continue
                one, two = (t * (HASHES // TREES)) % HASHES, (t * (HASHES // TREES) + 1) % HASHES
                region = np.int64(t) << 48 | sigs[at, one].astype(np.int64) << 16 | (sigs[at, two] & 0xFFFF).astype(np.int64)
                pick = pa.array(at)
                yield pa.RecordBatch.from_arrays([pa.array(region), sid.take(pick), n.take(pick), comp.take(pick), *[pa.array(words[at, k]) for k in range(words.shape[1])]], names=names)

    parts = HASHES // 16
    names = ["region", "sid", "n", "comp", *[f"s{k}" for k in range(parts)]]
    rows = nodes.select("sid", "n", "sig", "comp", F.col("trees").cast("int").alias("trees")).mapInArrow(returning(run), ", ".join(f"{c} bigint" for c in names))
    rows = materialised(rows, "rest")
    many = rows.groupBy("region").agg(F.count("*").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    rows = rows.join(many.select("region", F.ceil(F.col("m") / REST_PART).cast("long").alias("salts")), "region")
    one = rows.withColumn("salt", F.pmod(F.xxhash64("sid"), F.col("salts"))).drop("salts")
    two = rows.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")
    two = two.withColumnsRenamed({c: f"r_{c}" for c in two.columns})
    differ = reduce(lambda x, y: x + y, [F.bit_count(_low_bits(F.col(f"s{k}").bitwiseXOR(F.col(f"r_s{k}")))) for k in range(parts)])
    likely = (1 - differ / F.lit(float(HASHES)) - 1 / 16) / (15 / 16) >= LIKELY
    sized = 100 * F.least("n", "r_n") >= PERCENT * F.greatest("n", "r_n")
    met = one.join(two, (F.col("region") == F.col("r_region")) & (F.col("salt") == F.col("r_salt")) & (F.col("sid") < F.col("r_sid")) & (F.col("comp") != F.col("r_comp")) & sized & likely)
    return met.select(F.col("sid").alias("a"), F.col("r_sid").alias("b")).distinct()


def _low_bits(x: Column) -> Column:
    """A bit for each group of four bits that is not zero."""
    some = reduce(lambda p, q: p.bitwiseOR(q), [x, *[F.shiftrightunsigned(x, k) for k in (1, 2, 3)]])
    return some.bitwiseAND(F.lit(_NIBBLES))


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(sid, shingles binary) of the documents named."""

    def run(batches):
        for b in sliced(batches):
            sets = [shingle_set(t).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], names=["sid", "shingles"])
        _HASHES.clear()

    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS  # at most so many ids are broadcast
    src = docs.select(F.col("doc_id").cast("long").alias("sid"), text_or_empty().alias("text"))
    return src.join(F.broadcast(ids) if few else ids, "sid", "left_semi").mapInArrow(returning(run), "sid bigint, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are alike enough."""

    def run(batches):
        for b in sliced(batches, 32 << 20):
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(s) + len(t) - common))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("sid").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("sid").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(returning(run), "a bigint, b bigint")


def local_forest(edges: DataFrame) -> DataFrame:
    """Replace each task's edges by stars of their local components."""

    def run(frames):
        parent: dict[int, int] = {}

        def find(x):
            root = x
            while parent.setdefault(root, root) != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        def stars():
            rows = [(find(x), x) for x in list(parent)]
            out = pd.DataFrame([r for r in rows if r[0] != r[1]], columns=["a", "b"], dtype="int64")
            parent.clear()
            return out

        for f in frames:
            for a, b in zip(f["a"].tolist(), f["b"].tolist(), strict=True):
                x, y = find(a), find(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            if len(parent) > 200_000:
                yield stars()
        yield stars()

    return edges.mapInPandas(returning(run), "a bigint, b bigint")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge; component is the smallest node."""
    e = checkpointed(local_forest(edges.select("a", "b").filter("a <> b")))
    before = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        up = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(up, "b")
        e = small.select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(small.select(F.col("m").alias("a"), "b")).filter("a <> b").distinct()
        e = checkpointed(e)
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())
        if state == before or not state[0]:
            break
        before = state
    stars = e.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return stars.unionByName(e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of documents."""
    small_batches(docs.sparkSession)
    sets = materialised(document_sets(docs), "sets")
    named = sets.filter("doc_id is not null")
    reps = named.groupBy("k1", "k2").agg(F.min("doc_id").alias("sid"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    reps = materialised(reps, "nodes")
    nodes = reps.filter("n > 0").withColumn("comp", F.col("sid"))

    spark = docs.sparkSession
    seen = checkpointed(neighbours(forest_orders(nodes), NEAR, True))
    release(spark)
    first = seen.filter("trees = 0").select("a", "b")
    crowd = seen.filter("trees > 0").select(F.col("a").alias("sid"), "trees")
    ids = lambda p: p.select(F.col("a").alias("sid")).unionByName(p.select(F.col("b").alias("sid"))).distinct()
    shingles = materialised(full_sets(docs, ids(first)), "shingles")
    linked = checkpointed(confirmed(first, shingles))  # one Python step a task: two would need twice the workers
    release(spark)
    comps = checkpointed(connected_components(linked))
    labelled = nodes.drop("comp").join(crowd, "sid").join(comps.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("component", "sid"))

    second = checkpointed(crowded_pairs(labelled).join(first, ["a", "b"], "left_anti"))
    release(spark)
    fresh = ids(second).join(ids(first), "sid", "left_anti")
    more = shingles.unionByName(full_sets(docs, fresh))
    found = checkpointed(confirmed(second, more))
    discard(shingles)
    release(spark)
    all_edges = found.unionByName(comps.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b")))
    final = connected_components(all_edges)

    named_reps = reps.join(final.withColumnRenamed("node", "sid"), "sid", "left").select("k1", "k2", F.coalesce("component", "sid").alias("comp"))
    out = sets.drop("sig").join(named_reps, ["k1", "k2"], "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("comp"))
    rows = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
    result = materialised(rows, "groups")  # a few numbers a row, in place of the tables it is made from
    discard(sets)
    discard(reps)
    release(spark)
    return result


def op1_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
