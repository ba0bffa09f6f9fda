"""Exact removal of repeated byte strings of LENGTH bytes or more, in all documents together.

The shard-merge idea is kept in the form that a table of this size allows: suffixes fall into blocks
by their common prefix, blocks are refined to greater depth in rounds, and only blocks that still
hold two suffixes from anywhere go on; no suffix is sorted again. Blocks are named by 64-bit
polynomial hashes instead of by their place in a merged Burrows-Wheeler transform (see the README
for why), and suffixes are first thinned out without loss:

* The anchor of a window of LENGTH bytes is the rightmost smallest K-gram hash among its first
  SPREAD places. Equal windows have equal anchors at equal offsets, so windows are handled by anchor.
* Round 1, depth LENGTH - SPREAD + 1 behind the anchor: every window of the anchor holds this
  string. If it occurs once in all texts, none of the anchor's windows is repeated.
* Round 2, the union of the anchor's windows: if that string is repeated, so are all windows.
* Round 3, the remaining anchors (edges of repeated passages): window by window, together with one
  member of each repeated union of the same block.

All keys are counted by partial aggregation, so a passage in a third of all documents is a counter,
not a group; joins on keys are sort-merge joins with no aggregation by the same key behind them, so
that Spark splits them when skewed. The covered bytes are removed in a last pass over the whole texts.

A null text is empty. Texts shorter than LENGTH lose nothing. Equal texts are removed whole (from
LENGTH bytes on), since each byte is covered by a string that also starts in the other copy; repeated
rows and rows without an id count as documents like others. Matches never cross documents.

Beside the bytes, passages of over 50 words that documents share are told, whatever their bytes and
the white space between the words: the same rounds over words in place of bytes, with windows of
WORDS words, of which only those count that stand in two documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import discard, materialised, release, returning, sliced

LENGTH, SPREAD, K = 400, 128, 16
WORDS, WORD_SPREAD, WORD_K = 51, 24, 6
BROADCAST_IDS = 500_000
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_SYMBOLS = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_UP = [np.ones(1, np.uint64)]
_DOWN = [np.ones(1, np.uint64)]


class Hashed:
    """A sequence of symbols with prefix sums, for the hash of any of its substrings."""

    def __init__(self, symbols: np.ndarray):
        self.n = n = len(symbols)
        if len(_UP[0]) <= n:
            for table, base in ((_UP, _BASE), (_DOWN, _INVERSE)):
                p = np.full(max(n + 1, 1 << 17), base, np.uint64)
                p[0] = 1
                table[0] = np.multiply.accumulate(p)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * _UP[0][:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * _DOWN[0][start]
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(29))


def by_bytes(text: str) -> Hashed:
    return Hashed(_SYMBOLS[np.frombuffer(text.encode(), np.uint8)])


def by_words(text: str) -> Hashed:
    """Words are runs of anything but ASCII white space (common.WORD)."""
    data = text.encode()
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(inside))
    return Hashed(by_bytes(text).of(edges[::2], edges[1::2]))


def anchors(t: Hashed, length: int, spread: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last): each anchor and the first and last window start that it serves."""
    if t.n < length:
        e = np.zeros(0, np.int64)
        return e, e, e
    n = t.n - length + spread  # gram places that windows look at
    start = np.arange(n)
    h = t.of(start, start + k) >> np.uint64(32)
    at, span = start, 1
    while span < spread:
        step = min(span, spread - span)
        a, b = at[: n - span - step + 1], at[step : n - span + 1]
        at = np.where(h[b] <= h[a], b, a)
        span += step
    new = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new - 1, [len(at) - 1]])
    return at[first], first, last


def _arrow(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("rid"))


def anchor_rows(docs: DataFrame, length: int, spread: int, k: int, units=by_bytes) -> DataFrame:
    """(rid, pack, core, whole): text key, windows and offset of an anchor in one number, hashes of
    the string all its windows share and of their union."""
    depth = length - spread + 1

    def run(batches):
        for b in sliced(batches):
            out = []
            for rid, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                t = units(text)
                p, first, last = anchors(t, length, spread, k)
                if len(p):
                    pack = (first << 20) | ((p - first) << 10) | (last - first)
                    out.append((np.full(len(p), rid), pack, t.of(p, p + depth).view(np.int64), t.of(first, last + length).view(np.int64)))
            if out:
                yield _arrow(["rid", "pack", "core", "whole"], *[np.concatenate(c) for c in zip(*out, strict=True)])

    return _keyed(docs).select("rid", "text").mapInArrow(returning(run), "rid bigint, pack bigint, core bigint, whole bigint")


def window_rows(docs: DataFrame, wanted: DataFrame, length: int, units=by_bytes) -> DataFrame:
    """(h, core, rid, at, open) of the windows of the wanted anchors: (rid, packs, cores, opens)."""

    def run(batches):
        for b in sliced(batches):
            out = []
            for rid, text, todo in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                t = units(text)
                pack = np.array([x["pack"] for x in todo], np.int64)
                count = (pack & 1023) + 1
                at = np.repeat(pack >> 20, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                core = np.repeat(np.array([x["core"] for x in todo], np.int64), count)
                wide = np.repeat(np.array([x["open"] for x in todo], bool), count)
                out.append((t.of(at, at + length).view(np.int64), core, np.full(len(at), rid), at, wide))
            if out:
                yield _arrow(["h", "core", "rid", "at", "open"], *[np.concatenate(c) for c in zip(*out, strict=True)])

    ids = wanted.select("rid")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS  # at most so many keys are broadcast
    texts = _keyed(docs).select("rid", "text").join(F.broadcast(ids) if few else ids, "rid", "left_semi").dropDuplicates(["rid"])
    return texts.join(wanted, "rid").select("rid", "text", "todo").mapInArrow(returning(run), "h bigint, core bigint, rid bigint, at bigint, open boolean")


def repeated_starts(docs: DataFrame, length: int = LENGTH, spread: int = SPREAD, k: int = K, units=by_bytes, across: bool = False) -> DataFrame:
    """(rid, runs array<struct<a, b>>): first and last starts of runs of repeated windows, per text
    key. across: only windows that stand in two documents."""
    spark = docs.sparkSession
    rows = materialised(anchor_rows(docs, length, spread, k, units), "anchors")
    shared = materialised(rows.groupBy("core").agg(F.count("*").alias("c")).filter("c > 1").select("core"), "cores")
    met = materialised(rows.join(shared, "core"), "shared")  # no aggregation behind it: a hot core is split
    discard(rows)
    release(spark)
    kept = materialised(met.groupBy("core", "whole", "rid", "pack").agg(F.count("*").alias("n")), "blocks")
    discard(met)
    discard(shared)
    release(spark)

    # a text's n is over 1 if several documents have it
    many = F.expr("min(rid) <> max(rid) or max(n) > 1" if across else "sum(n) > 1").alias("many")
    unions = kept.groupBy("core", "whole").agg(many, F.min(F.struct("rid", "pack")).alias("one"))
    unions = materialised(unions, "unions")
    edges = unions.filter("not many").select("core").distinct()
    if across:  # a union that one document alone has may stand in it at several places
        crossing = unions.groupBy("core").agg(F.expr("bool_or(many) or min(one.rid) <> max(one.rid)").alias("met")).filter("met").select("core")
        crossing = materialised(crossing, "crossing")  # no aggregation beside the join: a hot core is split
        lone = unions.filter("not many").join(crossing, "core", "left_semi").select("core", "whole")
        once = kept.join(lone, ["core", "whole"], "left_semi").select("core", "rid", "pack", F.lit(True).alias("open"))
    else:
        once = unions.filter("not many").select("core", F.col("one.rid").alias("rid"), F.col("one.pack").alias("pack"), F.lit(True).alias("open"))
    beside = unions.filter("many").join(edges, "core", "left_semi").select("core", F.col("one.rid").alias("rid"), F.col("one.pack").alias("pack"), F.lit(False).alias("open"))
    # a single member of a block of one text that is alone in it cannot meet another
    wanted = once.unionByName(beside).groupBy("rid").agg(F.collect_list(F.struct("pack", "core", "open")).alias("todo"))
    wanted = materialised(wanted, "wanted")

    windows = window_rows(docs, wanted, length, units)
    more = "min(rid) <> max(rid) or not bool_and(open)" if across else "count(*) > 1"
    twice = windows.groupBy("h", "core").agg(F.expr(more).alias("more"), F.max(F.col("open").cast("int")).alias("o")).filter("more and o = 1").select("h", "core")
    found = windows.filter("open").join(twice, ["h", "core"], "left_semi").select("rid", F.col("at").alias("a"), F.col("at").alias("b"))
    found = materialised(found, "windows")
    release(spark)

    sure = kept.join(unions.filter("many").select("core", "whole"), ["core", "whole"], "left_semi")
    first = F.shiftright("pack", 20)
    sure = sure.select("rid", first.alias("a"), (first + F.col("pack").bitwiseAND(1023)).alias("b"))
    runs = sure.unionByName(found).groupBy("rid").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    runs = materialised(runs, "runs")
    for t in (kept, unions, wanted, found, *([crossing] if across else [])):
        discard(t)
    release(spark)
    return runs


def spans(first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of what windows cover, from the first and last starts of runs of them."""
    if not len(first):
        return first, last
    order = np.argsort(first)
    start, end = first[order], np.maximum.accumulate(last[order] + length)
    apart = start[1:] > end[:-1]
    return start[np.concatenate([[True], apart])], end[np.concatenate([apart, [True]])]


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column; a null is empty."""
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_pylist()
    return [values[i:j] for i, j in zip(offsets, offsets[1:])]


def remove_repeated(docs: DataFrame, length: int = LENGTH, spread: int = SPREAD, k: int = K, words: int = 0) -> DataFrame:
    """(doc_id, n_bytes, starts, ends, kept, n_shared_words): removed runs and the remaining bytes of
    every document; its words inside strings of as many words as given that another document has
    (none are looked for if 0)."""
    runs = repeated_starts(docs, length, spread, k)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    src = _keyed(docs).join(runs, "rid", "left").withColumn("shared", F.lit(None).cast("array<struct<a:bigint,b:bigint>>"))
    if words:
        near = min(WORD_SPREAD, words)
        shared = repeated_starts(docs, words, near, min(WORD_K, words - near + 1), by_words, across=True)
        src = src.drop("shared").join(shared.withColumnRenamed("runs", "shared"), "rid", "left")
    src = src.select("doc_id", "text", *[F.col(f"{c}.{x}").alias(f"{c}_{x}") for c in ("runs", "shared") for x in "ab"])
    big = pa.list_(pa.int64())

    def run(batches):
        for b in sliced(batches):
            sizes, starts, ends, rest, told = [], [], [], [], []
            for text, first, last, a, z in zip(b.column(1).to_pylist(), *(_lists(b.column(i)) for i in range(2, 6)), strict=True):
                data = text.encode()
                x, y = spans(first, last, length)
                sizes.append(len(data))
                starts.append(x.tolist())
                ends.append(y.tolist())
                rest.append(b"".join(data[i:j] for i, j in zip([0, *ends[-1]], [*starts[-1], len(data)], strict=True)))
                a, z = spans(a, z, words)
                told.append(int((z - a).sum()))
            names = ["doc_id", "n_bytes", "starts", "ends", "kept", "n_shared_words"]
            yield _arrow(names, b.column(0), pa.array(sizes, pa.int64()), pa.array(starts, big), pa.array(ends, big), pa.array(rest, pa.binary()), pa.array(told, pa.int64()))

    return src.mapInArrow(returning(run), f"doc_id {id_type}, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary, n_shared_words bigint")


def op5_query(docs: DataFrame, words: int = 0) -> DataFrame:
    """words: also tell the words of passages of so many words or more that documents share."""
    out = remove_repeated(docs, words=words)
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # the text that is left; a character of which a removed run took a part shows as U+FFFD
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
        *(["n_shared_words", (F.col("n_shared_words") > 0).alias("shares_passage")] if words else []),
    )
