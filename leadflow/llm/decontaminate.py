"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are lower-cased (A-Z) runs of letters, digits and characters beyond ASCII. Every run of GRAM
words is hashed, and of every WINDOW - GRAM + 1 consecutive hashes the smallest is kept, the rightmost
one on ties. A window of WINDOW words that a document shares with an item therefore keeps the same
gram on both sides, so no shared span of WINDOW words or more is missed. Fingerprints of documents and
items are joined; around each joint one the windows that hold it are compared with the items' windows
word by word, and joint windows that follow each other extend the hit. An item of fewer words than
WINDOW is one window, and its own gram.

Documents are read once. Beside each kept gram of a document go the words around it, but only where
the gram's bit is set in a bitmap of the benchmark's grams (MAX_BITS at most, the only data that
travels with the tasks whole; where it is too full to tell, more candidates reach the join, none is
lost). The candidates are written with a row number, so copies and repeated ids stay rows of their
own and no key is hotter than one document. Windows are joined as distinct texts, and the items are
found once for each distinct set of them, so neither a passage that many documents share nor one that
many items share makes pairs of documents and items.

A null text has no words; a null, empty or wordless item has no window. Rows of one item_id are one
item. A null item_id counts for the hit words, but is neither listed nor counted in n_items. A
document without hits has the digest of the empty string. Words are whole texts', of any length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import discard, materialised

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GRAM, WINDOW = 5, 10
MIN_BITS, MAX_BITS, BITS_A_GRAM = 1 << 12, 1 << 22, 16
BROADCAST_ROWS = 200_000  # narrow rows; beyond it tables are joined by shuffle
_LAST = (1 << 31) - 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """WORD in the lower-cased text: cut at what is neither a word character nor A-Z, then lower-cased."""
    cut = F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), "")
    return F.transform(cut, lambda w: F.when(F.octet_length(w) == F.length(w), F.lower(w)).otherwise(F.translate(w, _UPPER, _LOWER)))


def _head(array: Column, n: Column) -> Column:
    """The first n elements, none where n is not positive."""
    return F.slice(array, F.lit(1), F.greatest(n, F.lit(0)).cast("int"))


def grams(hashes: Column, k: int) -> Column:
    """Every run of k word hashes as one long: 32 bits of hash, then a place that falls from left to
    right, so that of equal hashes the rightmost is the smallest."""

    def pack(x: Column, i: Column) -> Column:
        h = F.shiftrightunsigned(F.xxhash64(x, *[F.get(hashes, i + j) for j in range(1, k)]), 32)
        return F.shiftleft(h, 31).bitwiseOR(F.lit(_LAST).cast("long") - i)

    return F.transform(_head(hashes, F.size(hashes) - (k - 1)), pack)


def winnowed(packed: Column, span: int) -> Column:
    """The smallest of every `span` consecutive grams, each once."""
    least = lambda x, i: F.least(x, *[F.get(packed, i + j) for j in range(1, span)])
    return F.array_distinct(F.transform(_head(packed, F.size(packed) - (span - 1)), least))


def _print(packed: Column) -> Column:
    return F.shiftright(packed, 31)


def _place(packed: Column) -> Column:
    return (F.lit(_LAST).cast("long") - packed.bitwiseAND(F.lit(_LAST).cast("long"))).cast("int")


def with_grams(df: DataFrame, lengths: list[int], prints: str = "prints") -> DataFrame:
    """df has `words`. Adds an array of (len, gram): winnowed grams for windows of WINDOW words, all
    grams of the shorter lengths."""
    hashed = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    for n in lengths:
        hashed = hashed.withColumn(f"grams_{n}", grams(F.col("hashes"), min(n, GRAM) if n == WINDOW else n))
    kept = {n: winnowed(F.col(f"grams_{n}"), WINDOW - GRAM + 1) if n == WINDOW else F.col(f"grams_{n}") for n in lengths}
    return hashed.withColumns({f"{prints}_{n}": c for n, c in kept.items()})


def benchmark_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, len, words): the words of every item that has some; len: words of its windows."""
    w = items.select(F.col(item_col).alias("item"), words(F.col(text_col)).alias("words")).filter(F.size("words") > 0)
    return w.withColumn("len", F.least(F.size("words"), F.lit(WINDOW)))


def _windows(array: Column, n: Column) -> Column:
    """(start, text) of every run of n words of an array of at least n."""
    return F.transform(F.sequence(F.lit(0), F.size(array) - n), lambda i: F.struct(i.alias("start"), F.array_join(F.slice(array, i + 1, n), " ").alias("window")))


def _sent(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if it is small: one count decides."""
    return F.broadcast(df) if df.count() <= rows else df


def _bitmap(prints: DataFrame) -> tuple[Column, int]:
    """A literal array of longs with a bit for each gram's hash, and the number of bits."""
    bits, n = MIN_BITS, prints.count()
    while bits < MAX_BITS and bits < BITS_A_GRAM * n:
        bits *= 2
    bit = F.col("print").bitwiseAND(F.lit(bits - 1).cast("long"))
    cells = prints.groupBy(F.shiftright(bit, 6).cast("int").alias("cell")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63).cast("long")).cast("int"))).alias("v")).collect()  # at most MAX_BITS / 64 rows
    full = [0] * (bits // 64)
    for r in cells:
        full[r.cell] = r.v
    return F.expr(f"array({', '.join(f'{v}L' for v in full)})"), bits  # constant, so folded into one literal


def _marked(n: int, bitmap: Column, bits: int) -> Column:
    """(len, print, first, words) of the grams for windows of n words whose bit is set: words are those
    that a window with the gram may hold, from place `first`."""
    reach = WINDOW - GRAM if n == WINDOW else 0

    def is_set(g: Column) -> Column:
        bit = _print(g).bitwiseAND(F.lit(bits - 1).cast("long"))
        return F.getbit(F.get(bitmap, F.shiftright(bit, 6).cast("int")), bit.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1

    def around(g: Column) -> Column:
        first = F.greatest(_place(g) - reach, F.lit(0))
        last = F.least(_place(g) + n, F.size("words"))
        return F.struct(F.lit(n).alias("len"), _print(g).alias("print"), first.alias("first"), F.slice("words", first + 1, last - first).alias("words"))

    return F.transform(F.filter(f"prints_{n}", is_set), around)


def _candidates(docs: DataFrame, doc_col: str, text_col: str, found: dict[int, DataFrame]) -> DataFrame:
    """(uid, doc, n_words, near): near holds (len, print, first, words) of the grams that may be in the benchmark."""
    lengths = sorted(found)
    w = with_grams(docs.select(F.col(doc_col).alias("doc"), words(F.col(text_col)).alias("words")), lengths)
    near = [_marked(n, *_bitmap(found[n])) for n in lengths]
    every = F.concat(*near) if near else F.array().cast("array<struct<len:int,print:bigint,first:int,words:array<string>>>")
    return w.select(F.monotonically_increasing_id().alias("uid"), "doc", F.size("words").cast("long").alias("n_words"), every.alias("near"))


def decontaminate(docs: DataFrame, items: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row of docs: (id, n_words, spans, n_hit, items, n_items, items_sha256). spans: word places
    (first, end) of maximal runs of hit words; items: item ids as sorted strings."""
    bench = benchmark_windows(items, item_col, item_text_col)
    lengths = [r.len for r in bench.select("len").distinct().collect()]  # at most WINDOW numbers
    # written before its arrays are exploded: a filter on them would be pushed below and computed anew for each gram
    printed = materialised(with_grams(bench, lengths).select("len", *[f"prints_{n}" for n in lengths]), "benchmark-grams")
    found = {n: printed.filter(F.col("len") == n).select(F.explode(f"prints_{n}").alias("g")).select(_print(F.col("g")).alias("print")).distinct() for n in lengths}
    windows = materialised(bench.select("item", "len", F.explode(_windows(F.col("words"), F.col("len"))).alias("w")).select("item", "len", "w.window").distinct(), "benchmark-windows")
    listed = windows.filter("item is not null")
    # windows that occur in the same items are one class; the class is named by one of them
    h = lambda seed: F.bit_xor(F.xxhash64("item", F.lit(seed)))
    same = windows.groupBy("len", "window").agg(F.count("item").alias("n"), h(1).alias("a"), h(2).alias("b"))
    names = same.groupBy("n", "a", "b").agg(F.min(F.struct("len", "window")).alias("class"))
    classed = materialised(same.join(names, ["n", "a", "b"]).select("len", "window", "class"), "benchmark-classes")

    candidates = materialised(_candidates(docs, doc_col, text_col, found), "candidates")
    near = candidates.filter(F.size("near") > 0).select("uid", F.explode("near").alias("c")).select("uid", "c.*")
    prints = [found[n].select(F.lit(n).alias("len"), "print") for n in lengths]
    if prints:
        near = near.join(_sent(reduce(DataFrame.unionByName, prints)), ["len", "print"], "left_semi")
    spread = near.select("uid", "len", "first", F.explode(_windows(F.col("words"), F.col("len"))).alias("w"))
    spread = spread.select("uid", "len", (F.col("first") + F.col("w.start")).alias("start"), "w.window")
    hits = spread.join(_sent(classed), ["len", "window"]).select("uid", "len", "start", "class")

    by_class = hits.repartition("uid").groupBy("uid", "class").agg(F.collect_set(F.struct("start", "len")).alias("at"))
    c = lambda seed: F.bit_xor(F.xxhash64("class", F.lit(seed)))
    per_doc = by_class.groupBy("uid").agg(F.flatten(F.collect_list("at")).alias("at"), F.count("*").alias("n"), c(1).alias("a"), c(2).alias("b"), F.collect_list("class").alias("classes"))
    hit = F.array_sort(F.array_distinct(F.flatten(F.transform("at", lambda x: F.sequence(x["start"], x["start"] + x["len"] - 1)))))
    per_doc = materialised(per_doc.withColumn("hit", hit).select("uid", "n", "a", "b", "classes", "hit"), "hits")

    # the items of each distinct set of classes, once
    sets = per_doc.groupBy("n", "a", "b").agg(F.min("uid").alias("uid"))
    members = sets.join(per_doc.select("uid", "classes"), "uid").select("n", "a", "b", F.explode("classes").alias("class"))
    of_class = listed.select(F.struct("len", "window").alias("class"), F.col("item").cast("string").alias("item"))
    of_set = members.join(of_class, "class").groupBy("n", "a", "b").agg(F.array_sort(F.collect_set("item")).alias("items"))
    of_set = materialised(of_set.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)), "item-sets")
    for used in (printed, windows, classed):
        discard(used)

    h = F.col("hit")
    begins = F.filter(h, lambda x, i: (i == 0) | (F.get(h, i - 1) != x - 1))
    ends = F.filter(h, lambda x, i: (i == F.size(h) - 1) | (F.get(h, i + 1) != x + 1))
    spans = F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("first"), (b + 1).alias("end")))
    per_doc = per_doc.select("uid", "n", "a", "b", spans.alias("spans"), F.size("hit").cast("long").alias("n_hit"))
    out = candidates.select("uid", "doc", "n_words").join(_sent(per_doc), "uid", "left").join(_sent(of_set), ["n", "a", "b"], "left")
    none = F.array().cast("array<string>")
    return out.select(
        F.col("doc").alias(doc_col),
        "n_words",
        F.coalesce("spans", F.array().cast("array<struct<first:int,end:int>>")).alias("spans"),
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
    )


def op11_query(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Hit words and items of every document."""
    found = decontaminate(docs, items)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


OP11_SQL = rf"""
with d as materialized (
  select row_number() over () as uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') as ws from documents
), i as materialized (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') as ws from benchmark
), iw as materialized (
  select distinct item_id, k, array_to_string(ws[s : s + k - 1], ' ') as t
  from (select item_id, ws, least(len(ws), {WINDOW}) as k, unnest(range(1, len(ws) - least(len(ws), {WINDOW}) + 2)) as s from i where len(ws) > 0) x
), dw as materialized (
  select uid, k, s, array_to_string(ws[s : s + k - 1], ' ') as t
  from (select uid, ws, k, unnest(range(1, len(ws) - k + 2)) as s from d cross join (select distinct k from iw) n where len(ws) >= k) x
), h as materialized (select uid, k, s, item_id from dw join iw using (k, t)
), w as (select uid, count(distinct p) as n_hit from (select uid, unnest(range(s, s + k)) as p from h) x group by uid
), n as (select uid, count(distinct item_id) as n_items, sha256(coalesce(array_to_string(list_sort(list(distinct cast(item_id as varchar)) filter (item_id is not null)), ','), '')) as items_sha256 from h group by uid
)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join w using (uid) left join n using (uid)
"""
