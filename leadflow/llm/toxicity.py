"""Toxicity by a weighted finite-state pattern grammar.

A text is read as a string of symbols: its words by class, quotation marks, ends of clauses and of
lines. An insult is a word, or the stem of one, from a lexicon learned from labelled documents; it
brings its weight. Four weighted transducers, each a table of arcs
(state, symbol) -> (state, symbol, weight), rewrite the string:

  threat     a word of harm within reach of a word of intent becomes a threat
  target     insults and threats near "you", "they" ... weigh more; a threat with its target behind
             it puts out a hit at the target
  negation   what follows "not", "never" ... within reach weighs less
  reported   what stands behind "said", "wrote" ... or inside quotation marks weighs less; quotation
             marks stay open over the ends of clauses, up to the end of the line

`compose` makes one transducer of them: the pairs of states that can be reached, with the weights of
an arc multiplied. One walk of the composed table over a clause gives the weights of its hits, and
their sum is the clause's score. A document's features are the sum, the best clause, the number of
hits and their density; a logistic model, fitted on the labelled training rows, turns them into a
score from 0 to 1. The training sample is at most MAX_LABELLED labelled rows, chosen by a hash of the
id, and the lexicon at most MAX_LEXICON entries; scoring reads every whole text. Labels, language,
source and id are never inputs of a score.

The model is fitted out of fold: the training rows fall into two halves by a hash of the id, and a
row's features come from the lexicon of the other half. The lexicon used for scoring is that of both.

A null or empty text has no clauses and gets the model's score for no matches. Repeated rows are
scored each. With no labelled row, or labels of one kind only, the learned lexicon is empty and the
built-in patterns alone count. Several labels of one document: any toxic one counts.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from leadflow.llm.common import partitions, returning, sliced, small_batches, text_or_empty

MAX_LABELLED, MAX_LEXICON, LEAST, THRESHOLD = 40_000, 20_000, 3, 0.7
HELD = 150_000  # features or words that a task keeps at a time
STEMS = (3, 4, 5, 6, 7)
WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”«»]")
CLAUSES = re.compile(r"([.!?;:\n]+)")
QUOTES = "\"“”«»"
# Function words of the four languages.
TARGET = frozenset("you your you're yours yourself ur u he she they them him her his this these those that du dich dir ihr euch sie tu toi vous ils elles él ella ustedes tú vosotros".split())
NEGATION = frozenset("not no never neither nor isn't aren't wasn't weren't don't doesn't didn't hardly nicht kein keine nie ne pas jamais ni nunca jamás sin".split())
REPORTED = frozenset("said says say claimed claims wrote writes quoted quotes quote called reported reports according alleged tweeted sagte sagt schrieb disait dit selon dijo dice según".split())
INTENT = frozenset("will gonna going shall must should want i'll we'll werde werden vais allons voy vamos".split())
HARM = frozenset("kill hurt destroy murder beat shoot stab burn hang die bury crush strangle töten umbringen schlagen verletzen tuer frapper brûler matar golpear quemar herir".split())
REACH = 3
SYMBOLS = ("other", "insult", "harm", "intent", "target", "negation", "report", "quote", "stop", "line")
HITS = ("insult", "threat", "struck")
CLASS_OF = {w: k for k, words in (("report", REPORTED), ("intent", INTENT), ("target", TARGET), ("negation", NEGATION), ("harm", HARM)) for w in words}
Arcs = dict[tuple, tuple]


def transducer(start, symbols, step) -> tuple[object, Arcs]:
    """(start, arcs) of all states that step(state, symbol) -> (state, symbol, weight) reaches."""
    arcs: Arcs = {}
    todo, seen = [start], {start}
    while todo:
        state = todo.pop()
        for x in symbols:
            arcs[state, x] = arc = step(state, x)
            if arc[0] not in seen:
                seen.add(arc[0])
                todo.append(arc[0])
    return start, arcs


def compose(first: tuple[object, Arcs], second: tuple[object, Arcs], symbols=SYMBOLS) -> tuple[object, Arcs]:
    """The transducer that gives what second makes of the output of first."""

    def step(state, x):
        p, y, v = first[1][state[0], x]
        q, z, w = second[1][state[1], y]
        return (p, q), z, v * w

    return transducer((first[0], second[0]), symbols, step)


def threat_step(left: int, x: str):
    if x in ("stop", "line"):
        return 0, x, 1.0
    if x == "intent":
        return 2 * REACH, x, 1.0
    if x == "harm":  # without intent it counts as what the lexicon says of it
        return max(0, left - 1), "threat" if left else "insult", 1.0
    return max(0, left - 1), x, 1.0


def target_step(state: tuple[int, int], x: str):
    after, waiting = state  # words since a target, words since a threat without one
    fewer = max(0, after - 1), max(0, waiting - 1)
    if x in ("stop", "line"):
        return (0, 0), x, 1.0
    if x == "target":
        return (REACH + 1, 0), "struck" if waiting else x, 1.0
    if x == "insult":
        return fewer, x, 1.25 if after else 1.0
    if x == "threat":
        return (fewer[0], 0 if after else REACH + 1), x, 2.0 if after else 1.0
    return fewer, x, 1.0


def negation_step(left: int, x: str):
    if x in ("stop", "line"):
        return 0, x, 1.0
    if x == "negation":
        return REACH + 1, x, 1.0
    return max(0, left - 1), x, 0.3 if left and x in HITS else 1.0


def reported_step(state: tuple[bool, bool], x: str):
    quoted, said = state
    if x == "line":
        return (False, False), x, 1.0
    if x == "stop":
        return (quoted, False), x, 1.0
    if x == "quote":
        return (not quoted, said), x, 1.0
    if x == "report":
        return (quoted, True), x, 1.0
    return state, x, (0.5 if quoted and said else 0.8 if quoted or said else 1.0) if x in HITS else 1.0


def cascade() -> list[tuple[object, Arcs]]:
    """The transducers in the order they are composed in."""
    after_threat = (*SYMBOLS, "threat")
    return [
        transducer(0, SYMBOLS, threat_step),
        transducer((0, 0), after_threat, target_step),
        transducer(0, (*after_threat, "struck"), negation_step),
        transducer((False, False), (*after_threat, "struck"), reported_step),
    ]


@functools.cache
def composed() -> tuple[list[int], list[float], list[str]]:
    """The composed transducer as tables over state * len(SYMBOLS) + symbol: next state (times
    len(SYMBOLS)), weight (0 where no hit comes out) and output symbol; state 0 is the start."""
    whole = functools.reduce(compose, cascade())
    place = {whole[0]: 0}
    for state, _ in whole[1]:
        place.setdefault(state, len(place))
    size = len(SYMBOLS)
    after, weight, out = [0] * (len(place) * size), [0.0] * (len(place) * size), [""] * (len(place) * size)
    for (state, x), (to, y, w) in whole[1].items():
        k = place[state] * size + SYMBOLS.index(x)
        after[k], weight[k], out[k] = place[to] * size, w if y in HITS else 0.0, y
    return after, weight, out


class Grammar:
    """The composed transducer over one learned lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = {k[2:]: w for k, w in lexicon.items() if k[0] == "w"}
        self.stems = {k[2:]: w for k, w in lexicon.items() if k[0] == "p"}
        self.memo: dict[str, tuple[int, float]] = {}
        self.after, self.weight, self.out = composed()

    def symbol(self, word: str) -> tuple[int, float]:
        """Symbol and lexicon weight of a word, by itself or by its stem."""
        found = self.memo.get(word)
        if found is None:
            w = max([self.words.get(word, 0.0), *[self.stems.get(word[:n], 0.0) for n in STEMS if len(word) > n]])
            kind = "quote" if word in QUOTES else CLASS_OF.get(word, "other")
            if w and kind != "harm":
                kind = "insult"
            if len(self.memo) > HELD // 3:
                self.memo.clear()
            found = self.memo[word] = SYMBOLS.index(kind), w
        return found

    def run(self, state: int, symbols: list[tuple[int, float]]) -> tuple[float, int, int]:
        """(score, hits, state) of a walk from a state; a threat weighs 1 at least, a struck target 1."""
        total, hits = 0.0, 0
        for x, own in symbols:
            k = state + x
            if w := self.weight[k]:
                y = self.out[k]
                value = w * (own if y == "insult" else max(own, 1.0))
                if value:
                    total += value
                    hits += 1
            state = self.after[k]
        return total, hits, state

    def features(self, text: str) -> list[float]:
        total = best = hits = words = 0.0
        state, quote, stop, line = 0, *(SYMBOLS.index(x) for x in ("quote", "stop", "line"))
        parts = CLAUSES.split(text.lower())
        for clause, end in zip(parts[::2], [*parts[1::2], ""], strict=True):
            found = [self.symbol(w) for w in WORDS.findall(clause)]
            words += len(found)
            if any(w or x == _HARM for x, w in found):
                s, n, state = self.run(state, found)
                total += s
                best = max(best, s)
                hits += n
            else:  # only the quotation marks outlast the clause
                for x, _ in found:
                    if x == quote:
                        state = self.after[state + quote]
            state = self.after[state + (line if "\n" in end else stop)]
        return [math.log1p(total), math.log1p(best), math.log1p(hits), 100 * total / (words + 20)]


_HARM = SYMBOLS.index("harm")


def features_of(text: str) -> set[str]:
    """What the lexicon is learned from: words, and stems of longer words."""
    words = {w for w in WORDS.findall(text.lower()) if w not in QUOTES}
    return {f"w:{w}" for w in words} | {f"p:{w[:n]}" for w in words for n in STEMS if len(w) > n}


def held_out(col: str = "doc_id") -> Column:
    return F.crc32(F.col(col).cast("string").cast("binary")) % 3 == 1


def labelled_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, toxic, fold) of at most `limit` labelled documents that are not held out."""
    lab = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~F.coalesce(held_out(), F.lit(False)))
    lab = lab.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    few = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)  # at most `limit` ids are broadcast
    return docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(few), "doc_id").select("doc_id", "text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(2)).cast("int").alias("fold"))


def learn_lexicons(rows: DataFrame) -> tuple[dict[str, float], list[dict[str, float]]]:
    """Log-odds of words and stems that mark toxic documents beyond chance: of all rows, and for each
    half of the rows (fold 0, fold 1) those of the other half."""
    n = {(r.toxic, r.fold): r.n for r in rows.groupBy("toxic", "fold").agg(F.count("*").alias("n")).collect()}
    toxic, clean = ([n.get((y, k), 0) for k in (0, 1)] for y in (1, 0))
    if not sum(toxic) or not sum(clean):
        return {}, [{}, {}]

    def count(kept):
        def run(batches):
            seen = Counter(), Counter()  # by fold

            def out():
                keys = list(seen[0].keys() | seen[1].keys())
                batch = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *[pa.array([c[f] for f in keys], pa.int64()) for c in seen]], names=["f", "n0", "n1"])
                for c in seen:
                    c.clear()
                return batch

            for b in sliced(batches):
                for text, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    found = features_of(text)
                    seen[k].update(found if kept is None else found & kept.keys())
                if len(seen[0]) + len(seen[1]) > HELD:
                    yield out()
            if any(seen):
                yield out()

        return returning(run)

    def counted(y, kept=None):
        per = rows.filter(F.col("toxic") == y).select("text", "fold").mapInArrow(count(kept), "f string, n0 bigint, n1 bigint")
        return per.groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))

    # the most frequent features of at most MAX_LABELLED texts, at most 5 MAX_LEXICON
    hits = counted(1).filter(F.col("n0") + F.col("n1") >= LEAST).orderBy(F.desc(F.col("n0") + F.col("n1")), "f").limit(MAX_LEXICON * 5)
    kept = {r.f: (r.n0, r.n1) for r in hits.collect()}
    there = {r.f: (r.n0, r.n1) for r in counted(0, kept).collect()}

    def lexicon(folds):
        n1, n0 = sum(toxic[k] for k in folds), sum(clean[k] for k in folds)
        if not n1 or not n0:
            return {}
        bar, found = 2 * math.log(max(2, len(kept))), {}
        for f, hit in kept.items():
            a, b = sum(hit[k] for k in folds), sum(there.get(f, (0, 0))[k] for k in folds)
            w = math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
            if a >= LEAST and w >= 2.5 and _surprise(a, b, n1, n0) >= bar:
                found[f] = w
        return dict(sorted(found.items(), key=lambda x: (-sum(kept[x[0]]) * x[1], x[0]))[:MAX_LEXICON])

    whole = lexicon((0, 1))
    return whole, [lexicon((1,)) or whole, lexicon((0,)) or whole]  # a half with too few toxic rows has none of its own


def _surprise(a: int, b: int, n1: int, n0: int) -> float:
    """Log-likelihood ratio of a of n1 against b of n0."""
    p = (a + b) / (n1 + n0)
    part = lambda k, n, q: (k * math.log(q) if k else 0.0) + ((n - k) * math.log(1 - q) if n - k else 0.0)
    at = lambda k, n: min(max(k / n, 1e-12), 1 - 1e-12)
    q = min(max(p, 1e-12), 1 - 1e-12)
    return 2 * (part(a, n1, at(a, n1)) + part(b, n0, at(b, n0)) - part(a, n1, q) - part(b, n0, q))


def fit(x: np.ndarray, y: np.ndarray, l2: float = 0.05, steps: int = 60) -> list[float]:
    """Ridge logistic regression by Newton's method; intercept first."""
    if not len(y) or y.min() == y.max():
        return [-3.0, 1.5, 1.5, 0.0, 0.0]
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    ridge = np.full(a.shape[1], l2)
    ridge[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + ridge * w
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> tuple[dict[str, float], list[float]]:
    """The lexicon of all training rows, and the model of their features out of fold."""
    n = max(2, partitions(docs.sparkSession))
    rows = labelled_rows(docs, labels, limit).repartition(n, "doc_id").cache()  # at most `limit` rows
    try:
        return _train(rows)
    finally:
        rows.unpersist()


def _train(rows: DataFrame) -> tuple[dict[str, float], list[float]]:
    lexicon, other = learn_lexicons(rows)

    def score(batches):
        g = [Grammar(x) for x in other]
        for b in sliced(batches):
            f = [g[k].features(t) for t, k in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in zip(*f, strict=True)] + [b.column(1)], names=["a", "b", "c", "d", "y"])

    got = rows.select("text", F.col("toxic").cast("int").alias("y"), "fold").mapInArrow(returning(score), "a double, b double, c double, d double, y int").collect()
    got = np.array(sorted(map(tuple, got))) if got else np.zeros((0, 5))  # at most MAX_LABELLED rows of five numbers
    return lexicon, fit(got[:, :4], got[:, 4])


def score_documents(docs: DataFrame, lexicon: dict[str, float], model: list[float], text_col: str = "text", out_col: str = "score") -> DataFrame:
    """docs with the score in out_col, which docs must not have yet."""
    small_batches(docs.sparkSession)
    names = docs.columns
    schema = docs.schema

    def run(batches):
        g = Grammar(lexicon)
        w = np.array(model)
        for b in sliced(batches):
            x = np.array([g.features(t or "") for t in b.column(names.index(text_col)).to_pylist()])
            s = 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*names, out_col])

    return docs.mapInArrow(returning(run), StructType([*schema.fields, StructField(out_col, DoubleType())]))


def op7_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    lexicon, model = train(docs, labels)
    scored = score_documents(docs.select("doc_id", "text"), lexicon, model).drop("text")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
