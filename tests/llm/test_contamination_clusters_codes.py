"""Decontamination, centroid clustering and vector codes against brute-force versions: nulls, empty and
long texts, ties, repeated rows, empty tables, clashing column names."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from leadflow.llm import codebooks, decontaminate, lloyd

DOC, ITEM = "doc_id bigint, text string", "item_id bigint, text string"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def contaminated(docs, items):
    """doc row -> (n_words, hit places, item ids), window by window."""
    windows = []
    for item, text in items:
        w = words_of(text)
        k = min(len(w), 10)
        windows += [(item, tuple(w[i : i + k])) for i in range(len(w) - k + 1) if k]
    out = []
    for doc, text in docs:
        w = words_of(text)
        hit, found = set(), set()
        for item, t in windows:
            for i in range(len(w) - len(t) + 1):
                if tuple(w[i : i + len(t)]) == t:
                    hit |= set(range(i, i + len(t)))
                    found.add(item)
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return sorted(out, key=repr)


def op11(spark, docs, items):
    got = decontaminate.op11_query(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM))
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect()), key=repr)


def test_decontamination_equals_brute_force(spark):
    rnd = random.Random(8)
    say = lambda n, v=300: [f"w{rnd.randrange(v)}" for _ in range(n)]
    items = [(i, " ".join(say(rnd.randrange(10, 40)))) for i in range(12)]
    boiler = say(14)
    items += [(20 + i, " ".join(boiler + say(12))) for i in range(5)]  # one stem in many items
    items += [(30, "Only five WORDS right here"), (31, "né"), (32, ""), (33, None), (34, "... !!"), (None, " ".join(say(15))), (3, " ".join(say(11))), (35, "a a a a a a a a a a a a a"), (36, items[0][1])]
    docs = []
    for i in range(60):
        w = say(rnd.randrange(0, 120))
        for _ in range(rnd.randrange(3)):
            src = words_of(rnd.choice(items)[1])
            a = rnd.randrange(len(src) + 1)
            at = rnd.randrange(len(w) + 1)
            w[at:at] = src[a : a + rnd.randrange(5, 30)]
        docs.append((i, rnd.choice([" ", ", ", "\n--", "\x7f"]).join(w).replace("w1", "W1")))
    docs += [(100, None), (101, ""), (102, "x ONLY, five words Right here y"), (103, "NÉ né"), (104, " ".join(["a"] * 300)), (None, items[1][1]), (None, items[1][1]), (7, items[2][1]), (105, " ".join(boiler)), (106, " ".join(boiler)), (107, " ".join(say(3000) + words_of(items[4][1]) + say(3000)))]
    assert op11(spark, docs, items) == contaminated(docs, items)


def test_every_shared_window_keeps_the_same_gram(spark):
    rnd = random.Random(1)
    for _ in range(3):
        shared = [f"s{rnd.randrange(40)}" for _ in range(10)]
        docs = [(i, " ".join([f"d{rnd.randrange(9)}" for _ in range(i)] + shared + [f"e{rnd.randrange(9)}" for _ in range(20 - i)])) for i in range(20)]
        items = [(1, " ".join([f"x{rnd.randrange(9)}" for _ in range(7)] + shared + ["y"]))]
        assert all(r[2] >= 10 and r[3] == 1 for r in op11(spark, docs, items))


def test_decontamination_spans_and_empty_tables(spark):
    item = " ".join(f"q{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"a b {item} c d {item}", "x", "y")], "doc_id bigint, text string, uid string, words string")
    r = decontaminate.decontaminate(docs, spark.createDataFrame([(5, item), (4, item)], ITEM)).head()
    assert [(s.first, s.end) for s in r.spans] == [(2, 14), (16, 28)] and r["items"] == ["4", "5"] and r.n_hit == 24
    none = spark.createDataFrame([], ITEM)
    assert [(r.n_hit, r.n_items, r.items_sha256) for r in decontaminate.op11_query(docs, none).collect()] == [(0, 0, sha(""))]
    assert decontaminate.op11_query(docs.limit(0), none).count() == 0
    assert decontaminate.op11_query(docs.limit(0), spark.createDataFrame([(5, item)], ITEM)).count() == 0


def test_decontamination_joins_by_shuffle_alike(spark, monkeypatch):
    rnd = random.Random(4)
    items = [(i, " ".join(f"w{rnd.randrange(50)}" for _ in range(25))) for i in range(8)]
    docs = [(i, items[i % 8][1] + f" tail{i}") for i in range(40)]
    want = op11(spark, docs, items)
    monkeypatch.setattr(decontaminate, "_sent", lambda df, rows=0: df)
    monkeypatch.setattr(decontaminate, "MAX_BITS", 1 << 12)
    assert op11(spark, docs, items) == want


def test_decontamination_has_no_python_in_its_plan(spark):
    d, i = spark.createDataFrame([(1, "a b")], DOC), spark.createDataFrame([(1, "a b")], ITEM)
    plan = decontaminate.op11_query(d, i)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan


VEC = "vec_id bigint, embedding array<float>, label int"


def finite(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def lloyd_rows(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, _ in rows if finite(v) and len(v) == 64]
    first = sorted(kept, key=lambda r: (r[0] is None, sha(f"1:{r[0]}"), r[1]))[:k]
    cent = [list(v) for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(cent)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            if mine:
                cent[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = [(i, *near(v)) for i, v in kept]
    per = [sum(d for _, d, j in last if j == c) for c in range(len(cent))]
    return sorted(((i, j, d, per[j], sum(per), sha(",".join(map(str, cent[j])))) for i, d, j in last), key=repr)


def op12(spark, rows):
    got = lloyd.op12_query(spark.createDataFrame(rows, VEC).repartition(3))
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got.collect()), key=repr)


def vectors(n, seed, dims=64, spread=0.3):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 0.5, (5, dims))
    return [(int(i), [float(np.float32(x)) for x in centres[i % 5] + rnd.normal(0, spread, dims)], int(i % 4) if i % 7 else None) for i in range(n)]


ODD = [(500, None, 1), (501, [], 1), (502, [0.5] * 63, 2), (503, [0.5] * 63 + [None], 2), (504, [0.5] * 63 + [float("nan")], None), (505, [float("inf")] * 64, 3)]


def test_lloyd_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lloyd, "CHUNK", 16)
    rows = vectors(150, 3)
    rows += [(700 + i, rows[0][1], 1) for i in range(30)] + [rows[5], rows[5], (None, rows[9][1], 1), (None, [0.25] * 64, 1), (800, [-0.015625] * 64, 0)] + ODD
    assert op12(spark, rows) == lloyd_rows(rows)


def test_lloyd_with_few_vectors_ties_and_none(spark):
    rows = [(1, [0.0] * 64, 1), (2, [0.0] * 64, 1), (3, [1.0] * 64, 2)]
    assert op12(spark, rows) == lloyd_rows(rows)
    assert op12(spark, ODD) == []
    assert op12(spark, [(1, [1.0] * 64, 1)] * 20) == lloyd_rows([(1, [1.0] * 64, 1)] * 20)
    with pytest.raises(Exception, match="too large"):
        op12(spark, [(1, [1e12] * 64, 1), (2, [0.0] * 64, 1)])


def test_lloyd_is_the_same_for_any_blocks(spark):
    df = spark.createDataFrame(vectors(60, 5), VEC)
    want = None
    for blocks in (1, 3, 7, 64):
        found, cent = lloyd.cluster(df, 6, 2, blocks=blocks)
        got = (sorted(map(tuple, found.collect())), cent.tolist())
        want = want or got
        assert got == want


def code_rows(rows, parts=8, entries=16, rounds=6):
    kept = [(i, v, lab) for i, v, lab in rows if finite(v)]
    if not kept:
        return []
    longest = max(len(v) for _, v, _ in kept)
    width = -(-longest // parts)
    m = [(i, [math.floor(4096 * float(np.float32(x))) for x in v] + [0] * (width * parts - len(v)), lab) for i, v, lab in kept]
    orig = {id(r): v for r, (_, v, _) in zip(m, kept, strict=True)}
    first = sorted(m, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, orig[id(r)]))[:entries]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    near = lambda v, p: min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)), j) for j, e in enumerate(books[p]))
    for _ in range(rounds):
        own = [[near(v, p)[1] for _, v, _ in m] for p in range(parts)]
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [cut(v, p) for (_, v, _), o in zip(m, own[p], strict=True) if o == j]
                if mine:
                    books[p][j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = [(i, lab, [near(v, p) for p in range(parts)]) for i, v, lab in m]
    err = [sum(d for d, _ in n) for _, _, n in last]
    digest = sha(",".join(str(x) for b in books for e in b for x in e))
    by = {}
    for (_, lab, _), e in zip(last, err, strict=True):
        by[lab] = by.get(lab, 0) + e
    return sorted(((i, "".join(f"{j:02x}" for _, j in n), e, by[lab], digest) for (i, lab, n), e in zip(last, err, strict=True)), key=repr)


def op13(spark, rows):
    got = codebooks.op13_query(spark.createDataFrame(rows, VEC).repartition(3))
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got.collect()), key=repr)


def test_codes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(codebooks, "BLOCK", 16)
    rows = vectors(90, 6, 16)
    rows += [(700 + i, rows[0][1], 1) for i in range(20)] + [rows[5], rows[5], (None, rows[9][1], None), (9000, [-1.5] * 16, 9)] + [(500, None, 1), (503, [0.5] * 15 + [None], 2), (504, [float("nan")] * 16, None)]
    assert op13(spark, rows) == code_rows(rows)


def test_codes_of_uneven_short_few_and_no_vectors(spark, monkeypatch):
    rows = [(3, [0.5, 0.25, -0.125], 1), (1, [], 1), (2, [1.0] * 11, None), (4, [0.5, 0.25, -0.125], 2)]
    assert op13(spark, rows) == code_rows(rows)
    assert op13(spark, [(1, None, 1), (2, [float("inf")], 2)]) == []
    assert op13(spark, [(1, [], 1)])[0][1:4] == ("00" * 8, 0, 0)
    monkeypatch.setattr(codebooks, "LABELS_SENT", 0)
    assert op13(spark, rows) == code_rows(rows)
    with pytest.raises(Exception, match="too large"):
        op13(spark, [(1, [1e9] * 8, 1), (2, [0.0] * 8, 1)])


def test_extra_columns_with_clashing_names_stay_out_of_the_way(spark):
    rows = vectors(40, 2)
    df = spark.createDataFrame(rows, VEC)
    from pyspark.sql import functions as F

    wide = df.withColumns({c: F.lit("x") for c in ("v", "id", "cluster", "distance", "chunk", "code", "error", "sizes", "block")})
    pick = lambda q, d: sorted(map(tuple, q(d).collect()), key=repr)
    assert pick(lloyd.op12_query, wide) == pick(lloyd.op12_query, df)
    assert pick(codebooks.op13_query, wide) == pick(codebooks.op13_query, df)
