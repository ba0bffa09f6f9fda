"""Vector code compression: product codes found by value dictionaries.

Vectors of whole numbers are written once as blocks of up to BLOCK rows. For each dimension a block
keeps the sorted distinct integers that occur there and, a row, the place of its integer in that
dictionary. A round tabulates, for each dimension, the squared difference of every distinct integer
to the component of every codebook entry; the distance of a part is then a sum of gathers from these
tables by dictionary place, and no row's integers are subtracted or multiplied again. The sums for
the new entries come from counts by (entry, place) times the dictionary. Dictionaries belong to a
block, so their size is bounded by BLOCK however many distinct integers the table holds.

The driver holds the codebooks between rounds (entries x dimensions whole numbers, two parameters);
tasks add their parts' sums before the shuffle, so an entry that a third of all parts choose sends
one row a task. Each round starts from the written blocks.

Rows whose vector is null or holds a null or non-finite component are dropped. Shorter vectors count
as padded with zeros to the longest length, and that to a multiple of the number of parts. The first
codebooks are parts of the rows with the smallest ids, ascending, equal ids by their components, null
ids last; with fewer rows there are fewer entries, without rows the result is empty. Rows with equal
ids are separate rows. Ties go to the lower entry, an unused entry stays. Components so large that
squared distances could leave 64 bits raise an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import discard, materialised
from leadflow.llm.vectors import blocks_of, finite_vectors, whole_numbers

BLOCK = 8192
LABELS_SENT = 100_000  # sums of so many labels are sent to all tasks; more are joined by a shuffle


def encode_blocks(kept: DataFrame, id_col: str, vec_col: str, label_col: str, dims: int, scale: int) -> DataFrame:
    """(ids, labels, sizes, numbers, places) of each block: numbers holds the dictionaries of all
    dimensions one behind the other (sizes: their lengths), places the row's place in each."""
    id_type, label_type = (kept.schema[c].dataType.simpleString() for c in (id_col, label_col))

    def run(batches):
        for ids, labels, vectors in blocks_of(batches, BLOCK, ["id", "label", "v"]):
            m = whole_numbers(vectors, dims, scale)
            books = [np.unique(m[:, j], return_inverse=True) for j in range(dims)]
            places = np.stack([b[1].astype(np.uint16) for b in books]) if dims else np.zeros((0, len(m)), np.uint16)
            whole = pa.array([0, len(ids)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(whole, ids),
                    pa.ListArray.from_arrays(whole, labels),
                    pa.array([[len(b[0]) for b in books]], pa.list_(pa.int32())),
                    pa.array([b"".join(b[0].tobytes() for b in books)], pa.binary()),
                    pa.array([places.tobytes()], pa.binary()),
                ],
                names=["ids", "labels", "sizes", "numbers", "places"],
            )

    src = kept.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    return src.mapInArrow(run, f"ids array<{id_type}>, labels array<{label_type}>, sizes array<int>, numbers binary, places binary")


class _Block:
    """Dictionaries and places of one block."""

    def __init__(self, sizes, numbers: bytes, places: bytes, n: int):
        ends = np.cumsum(np.asarray(sizes, np.int64))
        every = np.frombuffer(numbers, np.int64)
        self.books = [every[e - s : e] for s, e in zip(sizes, ends.tolist(), strict=True)]
        self.places = np.frombuffer(places, np.uint16).reshape(len(self.books), n)
        self.n = n

    def nearest(self, codebook: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row's part, which begins at dimension `first`."""
        entries, width = codebook.shape
        far = np.zeros((self.n, entries), np.int64)
        for j in range(width):
            table = (self.books[first + j][:, None] - codebook[None, :, j]) ** 2
            far += table[self.places[first + j]]
        at = far.argmin(1)  # the first of equal ones
        return at, far[np.arange(self.n), at]

    def sums(self, at: np.ndarray, entries: int, first: int, width: int) -> np.ndarray:
        """entries x width: sums of the rows' integers by entry, from counts of dictionary places."""
        out = np.zeros((entries, width), np.int64)
        for j in range(width):
            book = self.books[first + j]
            counts = np.bincount(at * len(book) + self.places[first + j], minlength=entries * len(book))
            out[:, j] = counts.reshape(entries, len(book)) @ book
        return out


def refined(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: books[part, entry, position] replaced by the floored means of the parts they attract."""
    parts, entries, width = books.shape

    def run(frames):
        total, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for f in frames:
            for r in f.itertuples(index=False):
                block = _Block(r.sizes, r.numbers, r.places, r.n)
                for p in range(parts):
                    at, _ = block.nearest(books[p], p * width)
                    counts[p] += np.bincount(at, minlength=entries)
                    total[p] += block.sums(at, entries, p * width, width)
        p, e, j = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, total.shape))
        yield pd.DataFrame({"part": p, "entry": e, "place": j, "total": total[p, e, j], "n": counts[p, e]})

    src = blocks.select("sizes", "numbers", "places", F.size("ids").alias("n"))
    sums = src.mapInPandas(run, "part int, entry int, place int, total bigint, n bigint").groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    out = books.copy()
    for r in sums.select("part", "entry", "place", F.expr("(total - pmod(total, n)) div n").alias("mean")).collect():  # entries x dimensions numbers
        out[r.part, r.entry, r.place] = r.mean
    return out


def compress(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, np.ndarray]:
    """((id, label, code, error) of every kept row as a written table, final codebooks[part, entry, position])."""
    spark = vectors.sparkSession
    kept = finite_vectors(vectors.select(id_col, label_col, vec_col), vec_col)
    schema = f"{id_col} {kept.schema[id_col].dataType.simpleString()}, {label_col} {kept.schema[label_col].dataType.simpleString()}, code string, error bigint"
    longest = kept.agg(F.max(F.size(vec_col))).head()[0]
    if longest is None:
        return spark.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    width = -(-longest // parts)
    dims = width * parts
    first = kept.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    start = whole_numbers(pa.array([r.v for r in first], pa.list_(pa.float64())), dims, scale)
    books = np.ascontiguousarray(start.reshape(len(first), parts, width).transpose(1, 0, 2))
    blocks = materialised(encode_blocks(kept, id_col, vec_col, label_col, dims, scale), "codebooks-blocks")
    for _ in range(rounds):
        books = refined(blocks, books)

    def codes(batches):
        for b in batches:
            for i in range(b.num_rows):
                ids, labels = b.column(0)[i].values, b.column(1)[i].values
                block = _Block(b.column(2)[i].as_py(), b.column(3)[i].as_py(), b.column(4)[i].as_py(), len(ids))
                found = [block.nearest(books[p], p * width) for p in range(parts)]
                code = np.stack([at for at, _ in found], 1).astype(np.uint8)
                error = sum(far for _, far in found)
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array([row.tobytes().hex() for row in code]), pa.array(error, pa.int64())], names=[id_col, label_col, "code", "error"])

    found = materialised(blocks.mapInArrow(codes, schema), "codebooks")
    discard(blocks)
    return found, books


def op13_query(embeddings: DataFrame) -> DataFrame:
    """Code and error of every kept row, with the error of its label and a digest of the codebooks."""
    found, books = compress(embeddings)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    by_label = found.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    if by_label.count() <= LABELS_SENT:
        by_label = F.broadcast(by_label)
    joined = found.join(by_label, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _op13_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same for vectors of equal length that the number of parts divides."""
    steps = [
        f"""v as materialized (select row_number() over () as uid, vec_id, label, list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as e
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0)""",
        f"parts as materialized (select uid, p, e[p * (len(e) // {parts}) + 1 : (p + 1) * (len(e) // {parts})] as s from v cross join (select unnest(range({parts})) as p) n)",
        f"firsts as materialized (select uid, row_number() over (order by vec_id nulls last, e) - 1 as entry from v qualify entry < {entries})",
        "b0 as materialized (select p, entry, s as c from parts join firsts using (uid))",
        "long as materialized (select uid, p, unnest(range(1, len(s) + 1)) as place, unnest(s) as x from parts)",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} as materialized (select uid, p, arg_min(entry, (d, entry)) as entry, min(d) as far from (
  select uid, p, entry, cast(list_sum(list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint) as d from parts join b{r} using (p)) g group by uid, p)"""
        )
        if r < rounds:
            steps.append(f"m{r} as materialized (select p, entry, list(m order by place) as c from (select p, entry, place, cast(floor(sum(x) / count(*)) as bigint) as m from long join a{r} using (uid, p) group by p, entry, place) g group by p, entry)")
            steps.append(f"b{r + 1} as materialized (select o.p, o.entry, coalesce(m.c, o.c) as c from b{r} o left join m{r} m using (p, entry))")
    steps.append(f"coded as (select uid, string_agg(lpad(printf('%x', entry), 2, '0'), '' order by p) as code, cast(sum(far) as bigint) as error from a{rounds} group by uid)")
    steps.append(f"digest as (select sha256(string_agg(array_to_string(c, ','), ',' order by p, entry)) as codebooks_sha256 from b{rounds})")
    return "with " + ",\n".join(steps) + """
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from coded join v using (uid) cross join digest"""


OP13_SQL = _op13_sql()
