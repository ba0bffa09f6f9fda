"""Each operator against a brute-force version on small rows: nulls, empty and long texts, ties,
repeated rows, empty tables, extra columns."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from leadflow.llm import bpe, minhash, mixing, pii, secret_scan, substrings, topk, toxicity, winnow, wrapper

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    base = words(rnd, 120)
    near = base.split()
    near[60] = "changed"
    long = words(rnd, 6000)
    return {1: base, 2: base, 3: " ".join(near), 4: None, 5: "", 6: "one two", 7: "ONE  two", 8: long, 9: base + " " + words(rnd, 10), 10: words(rnd, 90), 11: "Ünïcode ÉÉ words here and there", 12: long[:9000] + words(rnd, 50)}


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", len(t or "")) for i, t in texts.items()]
    return spark.createDataFrame([*rows, rows[0]], DOC)


def empty(spark):
    return spark.createDataFrame([], DOC)


def test_minhash_matches_brute_force(spark, docs, texts):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    got = minhash.near_duplicates(docs.withColumnRenamed("lang", "sig")).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)


def test_minhash_finds_links_in_crowded_regions_over_any_number_of_ranges(spark, monkeypatch):
    rnd = random.Random(40)
    passage = words(rnd, 70).split()
    texts = {i: passage + words(rnd, 40, 10_000).split() for i in range(150)}  # likeness of about 0.45
    for i in range(0, 150, 3):  # near copies of every third, in the midst of the crowd
        near = list(texts[i])
        near[rnd.randrange(75, 110)] = "changed"
        texts[1000 + i] = near
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in texts.items()}
    pairs = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert len(pairs) >= 50
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id bigint, text string")
    for ranges in (3, 24):
        monkeypatch.setattr(minhash, "partitions", lambda _, n=ranges: n)
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(d).collect()}
        assert sum(got[a] == got[b] for a, b in pairs) >= 0.99 * len(pairs)
        assert len(set(got.values())) >= len(texts) - len(pairs)


def test_minhash_null_ids_and_empty_table(spark):
    d = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (3, "a b c d e f")], "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in minhash.near_duplicates(d).collect())
    assert got == [(0, None, True), (3, 3, True), (7, 3, False)]
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 100)]
    got = {r.node: r.component for r in minhash.connected_components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(4)).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(100))


PAGE = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<div class="top-menu"><a href="/">Home</a></div><div id="wrap"><div class="story"><h1>Head &amp; line {i}</h1><p>First   para {i} with text &eacute;&#233; {t}<p>Second <b>bold<br>more</b> para {i} {t}</div>
<div class="sidebar">side {i}</div><div class="comments"><p>reader says {i}</p></div></div><form><p>sign up</p></form><footer>foot</footer><!-- c --></body></html>"""


def test_wrapper_extracts_the_story(spark):
    filler = "and some more words to fill the line " * 4
    rows = [(i, f"http://h.example/{i}", PAGE.format(i=i, t=filler)) for i in range(6)]
    rows += [(10, "http://h.example/x", None), (11, None, ""), (12, "http://other.example/", PAGE.format(i=12, t=filler)), (13, "bad url", "<p>just text"), (0, "http://h.example/0", rows[0][2])]
    got = {r.page_id: r for r in wrapper.op2_query(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for i in (0, 1, 5, 12):
        f = " ".join(filler.split())
        assert got[i].text == f"Head & line {i}\nFirst para {i} with text éé {f}\nSecond bold more para {i} {f}"
        assert got[i].n_chars == len(got[i].text)
    assert got[10].text == got[11].text == "" and got[13].text == "just text"
    assert wrapper.op2_query(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def page_texts(spark, rows):
    return {r.page_id: r.text for r in wrapper.op2_query(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}


def test_wrapper_keeps_text_beside_the_container(spark):
    page = "<html><head><title>t{i}</title></head><body><nav>menu</nav><main><h1>Title {i}</h1><p>lead {i}</p><div class='body'><p>{long} {i}</p></div></main></body></html>"
    long = "words that fill the body " * 40
    rows = [(i, f"http://{h}.example/{i}", page.format(i=i, long=long)) for i, h in [*((i, "many") for i in range(7)), (20, "single")]]
    got = page_texts(spark, rows)
    assert all(got[i] == f"Title {i}\nlead {i}\n{long}{i}" for i, _, _ in rows)


def test_wrapper_reads_every_page_template_of_a_host(spark):
    long = "words that fill the body " * 20
    a = "<html><head><title>a{i}</title></head><body><div class='x'><h2>Site</h2><p>{long}{i}</p></div></body></html>"
    b = "<html><head><title>b{i}</title></head><body><div class='x'><p>hint {i}</p></div><div class='y'><h2>Shop</h2><p>{long}item {i}</p></div></body></html>"
    copy = "<html><head><title>same</title></head><body><div class='z'><h1>Same</h1><p>{long}copy {i}</p></div></body></html>"
    pages = [a] * 40 + [b] * 4 + [copy] * 6
    rows = [(i, f"http://h.example/{i}", p.format(i=i, long=long)) for i, p in enumerate(pages)]
    got = page_texts(spark, rows + rows[:40])
    assert all(got[i] == f"{long}{i}" for i in range(40))
    assert all(got[i] == f"hint {i}\n{long}item {i}" for i in range(40, 44))
    assert all(got[i] == f"Same\n{long}copy {i}" for i in range(44, 50))


def test_wrapper_leaves_out_constants_of_any_size_and_depth(spark):
    note = "no liability is taken for anything said here " * 4
    page = "<html><head><title>t{i}</title></head><body><div><div class='z'><p>story {i}</p><p>{note}</p><p>{note}again</p><div class='box'><p>more <a href='/'>of <b>us</b></a></p><ul><li>x</li><li>y</li></ul></div></div></div></body></html>"
    rows = [(i, f"http://h.example/{i}", page.format(i=i, note=note)) for i in range(5)]
    prefix = [(i, f"http://g.example/{i}", f"<title>{i}</title><body><p>{note}{i}</p></body>") for i in range(10, 15)]
    got = page_texts(spark, rows + prefix)
    assert all(got[i] == f"story {i}" for i in range(5))
    assert all(got[i] == f"{note}{i}" for i in range(10, 15))


def brute_matching(x, y):
    """Textbook simple tree matching of (label, children) trees: the number of matched nodes."""
    if x[0] != y[0]:
        return 0
    m = [[0] * (len(y[1]) + 1) for _ in range(len(x[1]) + 1)]
    for i, a in enumerate(x[1], 1):
        for j, b in enumerate(y[1], 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + brute_matching(a, b))
    return m[-1][-1] + 1


def test_tree_matching_equals_brute_force():
    rnd = random.Random(31)

    def tree(depth):
        return rnd.choice("ab") if depth == 4 else "r", [(k, tree(depth - 1)[1]) for k in rnd.sample("pqrstuv", rnd.randrange(5))] if depth else []

    def shape(t):
        return b"".join([np.array([ord(t[0]), len(t[1])], np.int64).tobytes(), *map(shape, t[1])])

    for _ in range(300):
        x, y = tree(4), tree(4)
        got = wrapper.match_trees(wrapper.Skeleton(shape(x)), wrapper.Skeleton(shape(y)))
        assert len(got) == brute_matching(x, y) and len(set(got)) == len(got)
    a, b = (wrapper.Skeleton(wrapper.shape_of(wrapper.parse(t))) for t in ("<div><p>x</p><p>z</p><ul><li>1</li></ul></div>", "<div><h1>t</h1><p>y</p><ul><li>2</li></ul></div>"))
    assert len(wrapper.match_trees(a, b)) == 5
    assert len(wrapper.match_trees(a, wrapper.Skeleton(wrapper.shape_of(wrapper.parse("<div><ul><li>1</li></ul><p>x</p></div>"))))) == 4  # not in order


def test_wrapper_walks_trees_of_any_depth_and_keeps_blocks_of_articles(spark):
    deep = "".join(f"<{t}>" for t in ["div", "b"] * 5000)
    page = "<html><head><title>t{i}</title></head><body><div class='search'>find</div><article><h1>h{i}</h1><p>a{i}</p><div class='search'>how we searched {i}</div><div class='form'>its form {i}</div><math><mi>x{i}</mi></math><div class='comments'>reader {i}</div></article></body></html>"
    rows = [(i, f"http://h.example/{i}", page.format(i=i)) for i in range(4)] + [(k, "http://d.example/", f"<title>{k}</title>{deep}end {k}") for k in range(10, 14)]
    got = page_texts(spark, rows)
    assert all(got[i] == f"h{i}\na{i}\nhow we searched {i}\nits form {i}\nx{i}" for i in range(4))
    assert all(got[k] == f"end {k}" for k in range(10, 14))


def test_winnowing_matches_brute_force():
    rnd = random.Random(1)
    for _ in range(40):
        h = np.array([rnd.randrange(6) for _ in range(rnd.randrange(60))], np.uint32)
        w = rnd.randrange(1, 9)
        n = min(w, len(h))
        want = sorted({max(range(i, i + n), key=lambda j: (-int(h[j]), j)) for i in range(len(h) - n + 1)}) if len(h) else []
        assert winnow.winnow(h, w).tolist() == want


def test_fingerprint_query(spark, docs, texts):
    got = sorted(((r.doc_id, r) for r in winnow.op3_query(docs).collect()), key=lambda x: x[0])
    order = sorted([*texts.items(), (1, texts[1])], key=lambda x: x[0])
    assert [i for i, _ in got] == [i for i, _ in order]
    for k, (_, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = got[k][1]
        assert r.n_chars == len(t)
        same = [x for x in got if x[0] == order[k][0]]
        assert any(x[1].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() for x in same)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(t) > 400 and after[:half] != t[-half:]:
            assert 0.2 < r.near_edited < 1
    assert got[0][1].fingerprint == got[2][1].fingerprint
    assert winnow.op3_query(empty(spark)).count() == 0


def test_topk_matches_brute_force(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([-1.0, -0.5, 0.25, 0.3, 1.0]) for _ in range(6)]) for i in range(300)]
    rows += [(400, None), (450, [float("nan")] * 6), (500, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (550, []), (600, [float("inf")] * 6)]
    d = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    ints = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows[:300]}
    got = collections.defaultdict(list)
    for r in topk.op4_query(d).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == {0, 50, 100, 150, 200, 250}
    for q in got:
        want = sorted(((-int(ints[q] @ ints[x]), x) for x in ints if x != q))[:5]
        assert got[q] == [(k + 1, x, -s) for k, (s, x) in enumerate(want)]
    assert topk.op4_query(d.limit(0)).count() == 0


def brute_repeats(all_texts, length):
    seen = collections.Counter()
    for t in all_texts:
        for x in range(len(t) - length + 1):
            seen[t[x : x + length]] += 1
    out = []
    for t in all_texts:
        cover = np.zeros(len(t) + 1, bool)
        for x in range(len(t) - length + 1):
            if seen[t[x : x + length]] > 1:
                cover[x : x + length] = True
        c = cover[: len(t)]
        spans = int((np.diff(np.concatenate([[False], c]).astype(int)) == 1).sum())
        out.append((len(t), int(c.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~c].tobytes()).hexdigest()))
    return out


def test_substrings_match_brute_force(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    want = sorted((r.doc_id, *x) for r, x in zip(rows, brute_repeats([(r.text or "").encode() for r in rows], 400), strict=True))
    out = substrings.op5_query(docs)
    assert sorted(map(tuple, out.drop("text").collect())) == want
    for r in out.collect():
        left = r.text.encode()
        assert "\ufffd" in r.text or (len(left) == r.n_bytes - r.n_removed and hashlib.sha256(left).hexdigest() == r.kept_sha256)
    assert substrings.op5_query(empty(spark)).count() == 0


def test_substrings_of_one_text_and_small_length(spark):
    rnd = random.Random(9)
    part = "".join(rnd.choice("abcd") for _ in range(70))
    t = ["x" * 90, part + "12345" + part, "q" + part[:50] + "z", None]
    d = spark.createDataFrame(list(enumerate(t)), "doc_id bigint, text string")
    want = brute_repeats([(x or "").encode() for x in t], 40)
    got = {r.doc_id: r for r in substrings.remove_repeated(d, length=40, spread=16, k=8).collect()}
    for i, w in enumerate(want):
        assert (got[i].n_bytes, got[i].n_bytes - len(got[i].kept), len(got[i].starts), hashlib.sha256(got[i].kept).hexdigest()) == w


def brute_shared_words(all_texts, n):
    every = [[w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for t in all_texts]
    holders = collections.defaultdict(set)
    for i, w in enumerate(every):
        for x in range(len(w) - n + 1):
            holders[tuple(w[x : x + n])].add(i)
    out = []
    for w in every:
        cover = [False] * len(w)
        for x in range(len(w) - n + 1):
            if len(holders[tuple(w[x : x + n])]) > 1:
                cover[x : x + n] = [True] * n
        out.append(sum(cover))
    return out


def test_substrings_tell_passages_of_over_50_words_that_documents_share(spark, docs):
    rnd = random.Random(15)
    passage = words(rnd, 60, 40).split()
    short = " ".join(w[:3] for w in passage)
    assert len(short) < 400
    t = [words(rnd, 30) + " " + short + " " + words(rnd, 30), words(rnd, 9) + "\n" + short.replace(" ", "\t "), " ".join(short.split()[:50]) + " " + words(rnd, 70)]
    t += ["twice here: " + " ".join(short.split()[::-1]) + " x " + " ".join(short.split()[::-1]), "to be " * 80, "to be " * 26, "copy " * 60, "copy " * 60, words(rnd, 50), None, "", " \n "]
    t += [a.text for a in docs.collect()]
    d = spark.createDataFrame(list(enumerate(t)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in substrings.op5_query(d, substrings.WORDS).collect()}
    want = brute_shared_words(t, 51)
    assert [got[i].n_shared_words for i in range(len(t))] == want
    assert [got[i].shares_passage for i in range(len(t))] == [n > 0 for n in want]
    assert want[:4] == [60, 60, 0, 0] and got[0].n_removed == got[1].n_removed == 0  # under 400 bytes
    for n in (1, 2, 7, 30):
        got = {r.doc_id: r.n_shared_words for r in substrings.remove_repeated(d, words=n).collect()}
        assert [got[i] for i in range(len(t))] == brute_shared_words(t, n)


def test_secret_scan(spark):
    rnd = random.Random(4)
    hexes = ["".join(rnd.choice("0123456789abcdef") for _ in range(40)) for _ in range(40)]
    rows = [(i, f'some text token = "{h}" and mail name.{i}@mail.example.com plus averyveryverylongword{"x" * (i % 5)} end', "src") for i, h in enumerate(hexes)]
    rows += [(100, None, None), (101, "", "src"), (102, "nothing here", "docs/example")]
    got = secret_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), "source").collect()
    assert {r.value for r in got if r.secret} == set(hexes)  # no published format, so no forest: by secret name
    assert all(rows[r.doc_id][1][r.at : r.at + len(r.value)] == r.value for r in got)
    d = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert secret_scan.op6_query(d).count() == 0


def test_values_of_secret_names_are_findings_whatever_they_look_like(spark):
    values = ['password = "hunter2024"', "pwd='a!b$c#d%e'", "secret: correct-horse-battery", "token => short_one", 'api_key="abcdefgh1234!x$y"', "auth=Zq9!", "?token=abc12&user=me", 'password: "two words 7"', "my_passwd := x7."]
    want = ["hunter2024", "a!b$c#d%e", "correct-horse-battery", "short_one", "abcdefgh1234!x$y", "Zq9!", "abc12", "two words 7", "x7"]
    d = spark.createDataFrame([(i, f"text before, {v} and after", None) for i, v in enumerate(values)], "doc_id bigint, text string, source string")
    got = {r.doc_id: r for r in secret_scan.findings(d, "source").collect()}
    assert [got[i].value if i in got else None for i in range(len(want))] == want
    assert all(f"text before, {values[i]} and after"[r.at :].startswith(r.value) for i, r in got.items())
    assert secret_scan.findings(spark.createDataFrame([(1, "a password is short; the token of: love")], "doc_id bigint, text string")).count() == 0


def test_forest_of_labelled_findings_removes_false_positives(spark):
    rnd = random.Random(14)
    token = lambda alphabet, n: "".join(rnd.choice(alphabet) for _ in range(n))
    secrets = [token("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOP0123456789", 36) for _ in range(300)]
    harmless = [f"{token('abcdefgh', 8)}.{token('0123456789', 2)}.{token('abcdefgh', 6)}" for _ in range(300)]
    lab = [(v, "key = ", "", "src", 1) for v in secrets[:200]] + [(v, "key = ", "", "src", 0) for v in harmless[:200]]
    labelled = spark.createDataFrame(lab, "value string, before string, after string, path string, label int")
    d = spark.createDataFrame([(i, f"some key = {v} then") for i, v in enumerate(secrets[200:] + harmless[200:])], "doc_id bigint, text string")
    got = secret_scan.scan(d, None, labelled).collect()
    right = sum(r.secret == (r.doc_id < 100) for r in got)
    assert len(got) == 200 and right >= 190


def test_compiled_forest_equals_the_fitted_one(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F

    rnd = random.Random(15)
    rows = [(rnd.randrange(2), *[rnd.random() for _ in secret_scan.FEATURES]) for _ in range(300)]
    sample = spark.createDataFrame(rows, "label int, " + ", ".join(f"{f} double" for f in secret_scan.FEATURES))
    data = VectorAssembler(inputCols=list(secret_scan.FEATURES), outputCol="features").transform(sample.withColumn("label", F.col("label").cast("double")))
    model = RandomForestClassifier(numTrees=secret_scan.TREES, maxDepth=secret_scan.DEPTH, seed=7, subsamplingRate=0.8, featureSubsetStrategy="sqrt").fit(data)
    want = [float(r.probability[1]) for r in model.transform(data).select("probability").collect()]
    votes = [r.s for r in sample.select(secret_scan.train_forest(sample).alias("s")).collect()]
    assert sum(abs(a - b) < 1e-6 for a, b in zip(votes, want, strict=True)) == len(want)


def test_topk_with_ties_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "PASS_BLOCKS", 1)
    rnd = random.Random(16)
    vectors = {i: [rnd.choice([-1.0, 0.0, 1.0]) for _ in range(4)] for i in range(600)}
    d = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>").repartition(5)
    got = collections.defaultdict(list)
    for r in topk.op4_query(d).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q in range(0, 600, 50):
        want = sorted((-sum(256 * 256 * a * b for a, b in zip(vectors[q], v, strict=True)), i) for i, v in vectors.items() if i != q)[:5]
        assert got[q] == [(i, -s) for s, i in want]


def test_native_plans_have_no_python(spark, docs):
    for df in (secret_scan.op6_query(docs), pii.op8_query(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_toxicity_learns_words_and_stems(spark):
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        t = words(rnd, 60).split()
        toxic = i % 6 == 0
        if toxic:
            for k in range(3):
                t[10 * k] = rnd.choice(["gruk", "blorgo" + rnd.choice("abcdef"), "zarf"])
        rows.append((i, " ".join(t) + "."))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, None), (1001, "")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    lab = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.op7_query(d, lab).collect()}
    import zlib

    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    assert sum(got[i].predicted == t for i, _, t in labels) >= 590
    assert got[1000].predicted == 0 and 0 <= got[1000].score <= 1
    none = toxicity.op7_query(d, lab.limit(0)).collect()
    assert len(none) == len(rows) and all(0 <= r.score <= 1 for r in none)


def test_composed_transducer_equals_the_cascade():
    rnd = random.Random(21)
    g = toxicity.Grammar({})
    for _ in range(300):
        string = [rnd.choice(toxicity.SYMBOLS) for _ in range(rnd.randrange(25))]
        weights = [rnd.choice([0.0, 3.0]) if x in ("insult", "harm") else 0.0 for x in string]
        out, factor = list(string), [1.0] * len(string)
        for start, arcs in toxicity.cascade():  # one transducer after the other over the whole string
            state = start
            for k, x in enumerate(out):
                state, out[k], w = arcs[state, x]
                factor[k] *= w
        want = sum(f * (w if y == "insult" else max(w, 1.0)) for y, f, w in zip(out, factor, weights, strict=True) if y in toxicity.HITS)
        got = g.run(0, [(toxicity.SYMBOLS.index(x), w) for x, w in zip(string, weights, strict=True)])
        assert abs(got[0] - want) < 1e-9


def test_quotation_marks_stay_open_over_clauses():
    g = toxicity.Grammar({"w:clown": 3.0})
    open_mark, closed = g.features('he "went out. you are a clown. done"')[0], g.features('he "went" out. you are a clown. done')[0]
    assert 0 < open_mark < closed
    assert g.features('he "went out\nyou are a clown')[0] == g.features("he went out\nyou are a clown")[0]
    assert g.features("i will kill you")[0] > g.features("i will kill time")[0] > g.features("anna said i will kill time")[0] > 0


def test_repeated_rows_are_scored_each(spark):
    d = spark.createDataFrame([(1, "you are a clown"), (1, "you are a clown"), (2, None)], "doc_id bigint, text string")
    got = [(r.doc_id, r.score) for r in toxicity.score_documents(d, {"w:clown": 3.0}, [-3.0, 1.5, 1.5, 0.0, 0.0]).collect()]
    assert len(got) == 3 and got[0] == got[1] and got[2][1] < 0.1 < got[0][1]


def test_grammar_weighs_clauses():
    g = toxicity.Grammar({"w:clown": 3.0})
    plain = g.features("you are a clown")[0]
    assert plain > g.features("you are not a clown")[0] > 0
    assert plain > g.features('they said "clown" to him')[0] > 0
    assert g.features("i will kill you")[0] > 0 and g.features("a kill switch")[0] == 0
    assert g.features("")[0] == 0


def test_pii_keeps_formats_and_links(spark):
    t = "mail Ab.c9@x.example.com, ip 10.2.3.255 and 300.1.1.1 call +1 (323) 555-9830 card 4111-1111-1111-1111 or 4111111111111111 not 4111111111111112 ssn 123-45-6789 born 1980-02-29 IBAN GB82WEST12345698765432"
    d = spark.createDataFrame([(1, t), (2, "again 4111111111111111"), (3, None), (4, ""), (1, t)], "doc_id bigint, text string")
    got = sorted(map(tuple, pii.op8_query(d).select("doc_id", "text", "n_found").collect()), key=lambda x: x[0])
    a = got[0][1]
    assert got[0] == got[1] and len(a.split()) == len(t.split())
    for old in ("Ab.c9@", "10.2.3.255", "555-9830", "4111111111111111", "4111-1111-1111-1111", "123-45-6789", "1980-02-29", "GB82WEST12345698765432"):
        assert old not in a
    assert "300.1.1.1" in a and "4111111111111112" in a and "@x.example.com" in a and "+1 (" in a
    card = got[2][1].split()[1]
    assert card in a.replace("-", "") and a.count(card) == 1
    digits = [int(c) for c in card][::-1]
    assert sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0
    assert got[3][1:] == (None, 0) and got[4][1:] == ("", 0)
    assert pii.op8_query(d.limit(0)).count() == 0


def test_pii_permutes_one_to_one(spark):
    d = spark.range(3000).selectExpr("id as doc_id", "format_string('%03d-%02d-%04d', 100 + id div 1000, 1 + id % 90, 1 + id % 1000) as text")
    out = pii.op8_query(d.dropDuplicates(["text"]))
    assert out.select("text").distinct().count() == out.count()


def test_pii_output_is_valid_and_month_first_dates_are_found(spark):
    valid = lambda a, g, n: a not in (0, 666) and a < 900 and g and n
    d = spark.range(3000).selectExpr("id as doc_id", "format_string('%03d-%02d-%04d', 1 + id * 7 % 665, 1 + id % 99, 1 + id * 13 % 9999) as text").dropDuplicates(["text"])
    got = [r.text for r in pii.op8_query(d, "k").collect()]
    assert len(set(got)) == len(got) and all(valid(*map(int, t.split("-"))) for t in got)
    days = [f"{m:02d}/{x:02d}/{y}" for y in (1950, 1999, 2024) for m in range(1, 13) for x in range(13, 29)]
    got = [r.text for r in pii.op8_query(spark.createDataFrame(list(enumerate(days)), "doc_id bigint, text string"), "k").collect()]
    assert len(set(got)) == len(days) and not set(got) & set(days[:3])
    assert all(1 <= int(t[:2]) <= 12 and int(t[3:5]) > 12 for t in got)


def test_pii_matches_a_plain_feistel_network(spark):
    text = "123-45-6789"
    v, radix = [122, 44, 6788], [898, 99, 9999]
    for k in range(8):
        other = v[1:] if k % 2 == 0 else v[:1]
        h = hashlib.sha256(f"k:ssn:{k}:3:{','.join(map(str, other))}".encode()).hexdigest()
        v = [(x + int(h[4 * i : 4 * i + 4], 16)) % radix[i] if (i < 1) == (k % 2 == 0) else x for i, x in enumerate(v)]
    want = f"{v[0] + 1 + (v[0] >= 665):03d}-{v[1] + 1:02d}-{v[2] + 1:04d}"
    assert pii.op8_query(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), "k").head().text == want


def test_targets_and_apportionment():
    t = mixing.targets([100, 100, 100])
    assert t[0] == 200 and abs(sum(t) - 450) < 1e-9 and abs(t[1] - 2 * t[2]) < 1e-9
    assert mixing.apportion([53, 24, 23], 7) == [3, 2, 2]
    assert sum(mixing.apportion([1.0] * 10, 3)) == 3 and mixing.apportion([], 5) == [] and mixing.apportion([0.0], 5) == [0]


def test_mixing(spark, texts):
    rnd = random.Random(8)
    rows = [(i, words(rnd, rnd.randrange(1, 300)), "en", None if i % 7 == 0 else f"s{i % 4}", 0) for i in range(900)]
    d = spark.createDataFrame([*rows, rows[3], (2000, None, "en", "s9", 0)], DOC)
    got = mixing.op9_query(d).collect()
    assert got and len(got) == len(rows) + 2
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.op9_query(d.repartition(7)).collect()))
    by = {r[0]: r for r in rows}
    total = collections.Counter()
    target = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        s = by[r.doc_id][3] if r.doc_id in by else "s9"
        total[s] += r.taken
        target[s] = r.target
    for s in target:
        assert abs(total[s] - target[s]) <= 0.5
    mixed = mixing.apply_mix(d)
    assert mixed.schema == d.schema
    n = sum(len(r.text.split()) for r in mixed.collect())
    assert abs(n - sum(total.values())) <= 2
    assert mixing.op9_query(empty(spark)).count() == 0


def test_mixed_text_is_of_the_drawn_blocks(spark):
    size = 100 * 64 + 17
    rows = [(i, " ".join(f"{s}{k}" for k in range(size)), "en", s, 0) for i, s in enumerate("abc")]
    d = spark.createDataFrame([*rows, rows[0]], DOC)
    taken = collections.Counter()
    for r in mixing.op9_query(d).collect():
        taken[r.doc_id] += r.taken
    got = collections.defaultdict(list)
    for r in mixing.apply_mix(d).collect():
        assert r.n_chars == len(r.text)
        got[r.doc_id].append([int(w[1:]) for w in r.text.split()])
    for i in (0, 1, 2):
        assert sum(map(len, got[i])) == taken[i]
    parts = [p for i in got for p in got[i] if len(p) < size]
    assert parts
    for p in parts:
        assert p == sorted(set(p))
        for at in range(0, size, size // 5):  # each fifth of the text has its share
            share = sum(at <= k < at + size // 5 for k in p) / (size // 5)
            assert abs(share - len(p) / size) < 0.12 or at + size // 5 > size


def brute_mix(rows, seed=42):
    """Targets by repeated resharing, then words by source: what any mix has to come near."""
    size = collections.Counter()
    for _, t, _, s, _ in rows:
        size[s] += len((t or "").split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, fixed = {}, {}
    while True:
        left = 1.5 * sum(size.values()) - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        goal = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if goal[s] > 2 * size[s]]
        if not over:
            return {**goal, **fixed}, size
        fixed |= {s: 2 * size[s] for s in over}


def test_small_sources_meet_their_targets_and_like_rows_stay_apart(spark):
    rows = [(1, words(random.Random(1), 200), "en", "a", 0), (2, words(random.Random(2), 200), "en", "b", 0), (3, "same text here", "en", "a", 0), (3, "same text here", "en", "b", 0), (4, None, "en", None, 0)]
    d = spark.createDataFrame(rows, DOC)
    goal, size = brute_mix(rows)
    total = collections.Counter()
    for r in mixing.mix(d).collect():
        assert r.source_size == size[r.source] and abs(r.target - goal[r.source]) < 1e-9
        total[r.source] += r.taken
    assert all(abs(total[s] - goal[s]) <= 0.5 for s in goal)
    out = collections.Counter()
    for r in mixing.apply_mix(d).collect():
        out[r.source] += len(r.text.split())
    assert out == +total


def test_drawn_words_are_the_chosen_blocks():
    rnd = random.Random(12)
    for _ in range(300):
        block, sizes = rnd.randrange(1, 9), [rnd.randrange(1, 40) for _ in range(6)]
        n = -(-sum(sizes) // block)
        q, shift = rnd.randrange(n + 1), rnd.randrange(n)
        line = [b for b in range(n) if ((b + 1) * q + shift) // n > (b * q + shift) // n]
        start = 0
        for size in sizes:
            want = [k for k in range(size) if (start + k) // block in line]
            part = rnd.randrange(len(want) + 1)
            for most in (len(want), part):
                assert [k for a, b in mixing.drawn_words(size, most, start, q, shift, n, block) for k in range(a, b)] == want[:most]
            start += size
    assert mixing.cut_words(" a  b c\td e ", [(0, 2), (3, 5)]) == "a  b\nd e"


def test_bpe_equals_the_library(spark, docs, texts):
    tokenizers = pytest.importorskip("tokenizers")
    from leadflow.llm.queries import tokenizer_path

    path = tokenizer_path()
    t = tokenizers.Tokenizer.from_file(path)
    rnd = random.Random(5)
    more = ["<|endoftext|>x <|endoftext|>", "a" * 5000, "  two  spaces\n\n\tand 123's I'LL we'll", "".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(160, 0x3000), 0x1F600 + rnd.randrange(40)])) for _ in range(800))]
    rows = [*texts.items(), *enumerate(more, 100)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in bpe.op10_query(d, path).collect()}
    for i, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        want = bpe.digests(np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False))
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), *want)
    assert bpe.op10_query(empty(spark), path).count() == 0


def test_bpe_keeps_pairs_and_holds_runs_once(monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    from leadflow.llm.queries import tokenizer_path

    path = tokenizer_path()
    t, b = tokenizers.Tokenizer.from_file(path), bpe.ByteBpe(path)
    monkeypatch.setattr(bpe, "CACHE", 500, raising=False)  # so that generations change between the slices below
    rnd = random.Random(8)
    odd = ["", " ", "  ", "a", "a\x00", "a\x00\x00b", "x\t y", "x \ty", "x\u2028 y", "x\x1c y", "end. \nnext", "end.\n next", " lead", "trail ", "a" * 31, "a" * 32, "a" * 33, "a" * 400, "a" * 400 + "b", "é" * 16 + "x", "é" * 17]
    slices = [[*odd, "".join(rnd.choice("ab é\n.\t\x00Ж中1'") for _ in range(3000))] for _ in range(4)]
    asked = []
    apart = b._apart
    monkeypatch.setattr(b, "_apart", lambda x, y: asked.append((x, y)) or apart(x, y))
    for texts in [*slices, *slices]:
        ids = [t.encode(x, add_special_tokens=False).ids for x in texts]
        assert b.encode(texts) == [np.array(x, "<u4").tobytes() for x in ids]
    assert len(asked) == len(set(asked))
    b.forget()
    b.encode(slices[0])
    assert len(asked) == len(set(asked))  # what the vocabulary alone decides is not worked out again
    learned = []
    learn = b.learn
    monkeypatch.setattr(b, "learn", lambda words: learned.append(set(words)) or learn(words))
    b.encode(["one two", "one three two"])
    b.encode(["three", "three one two one"])
    assert learned == [{"one", " two", " three"}, {"three", " one"}]


def test_extra_columns_with_clashing_names(spark, docs):
    more = {c: docs["lang"] for c in ("score", "size", "taken", "target", "shard", "sig", "sid", "comp", "kept", "n", "found", "value", "pii", "host", "rid", "runs", "key", "to", "ids_le", "decoded")}
    wide = docs.withColumns(more)
    same = lambda f: sorted(map(str, f(wide).collect())) == sorted(map(str, f(docs).collect()))
    for f in (minhash.op1_query, winnow.op3_query, substrings.op5_query, secret_scan.op6_query, pii.op8_query, mixing.op9_query):
        assert same(f)
    assert mixing.apply_mix(wide).columns == wide.columns
    scored = toxicity.score_documents(wide, {}, [0.0] * 5, out_col="_toxicity")
    assert scored.columns == [*wide.columns, "_toxicity"]


def test_pipeline_stages(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema], name
        out.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        assert 0 < kept.count() and (name == "mixing" or kept.count() <= docs.count())
        docs = kept
    assert pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()


def test_pipeline_stages_decide_as_brute_force(spark, docs, texts):
    pipeline = pytest.importorskip("corpus_pipeline")
    stages = dict(pipeline.STAGES)
    sf = "/root/testdata/sf0.001"
    clash = docs.withColumns({c: docs["lang"] for c in ("pii", "_h", "text_hash", "toxicity", "values", "kinds", "hit", "row_hash", "own_id")})
    kept = stages["near_dedup"](spark, clash, sf)
    assert kept.columns == clash.columns and kept.select("pii").distinct().collect() == [("en",)]
    sets = {i: ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()) for i, w in ((i, (t or "").lower().split()) for i, t in texts.items())}
    alike = lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    want = sorted(i for i in sets if not any(j < i and alike(i, j) for j in sets))  # no chains in these rows
    assert sorted(r.doc_id for r in kept.collect()) == want
    masked = stages["pii"](spark, clash, sf)
    assert masked.columns == clash.columns and sorted(str(r.text) for r in masked.collect()) == sorted(str(r.text) for r in clash.collect())  # nothing personal in them
    mixed = stages["mixing"](spark, clash, sf)
    goal, _ = brute_mix([(r.doc_id, r.text, r.lang, r.source, 0) for r in docs.collect()])
    total = collections.Counter()
    for r in mixed.collect():
        assert r.n_chars == len(r.text)
        total[r.source] += len(r.text.split())
    assert mixed.columns == clash.columns and all(abs(total[s] - goal[s]) <= 0.5 for s in goal)


def test_pipeline_of_an_empty_table(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    d = empty(spark)
    for name, stage in pipeline.STAGES:
        assert stage(spark, d, "/root/testdata/sf0.001").count() == 0, name
