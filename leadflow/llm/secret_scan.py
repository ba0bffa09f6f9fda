"""Secret scan with a random forest that removes false positives.

Main path: DataFrame functions only. A pattern finds candidates (long unbroken runs of token
characters with a digit in them, long runs of letters, and whatever is assigned to a secret name, of
any length and characters) with the text around them; they are written once and read by what follows.
Features: length, share of digits, capitals and hexadecimal digits, class transitions, distinct
characters, dictionary coverage (share of the candidate made of words that stand around other
candidates), path of the document, and neighbouring words (assignment, quotes, key-like names, signs
of an address). A random forest is trained on at most MAX_LABELLED labelled findings and compiled
into a CASE expression, which scores every finding of every whole text.

Labelled findings are a table (value, before, after, path, label). Where none is given they are made
from the value alone: values in a published key format (a provider's, or 128, 160 or 256 bits in
hexadecimal digits) count as secrets; mail addresses,
numbers with units, dates and plain words do not; the rest is left out of training and is scored. No
feature looks at these formats, and no label at the neighbouring words, so what the forest says of
values behind a secret name is learned from other findings.

A null or empty text has no findings. Repeated rows give repeated findings. Without labels of both
kinds there is no forest: the score is 1 for a value behind a secret name or in a published format,
else 0. Values are returned as SHA-256 only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import materialised

MAX_LABELLED, MAX_DICTIONARY, AROUND = 5_000, 2_000, 48
TREES, DEPTH = 12, 6
TOKEN = r"(?<![A-Za-z0-9+/_.@-])(?:(?=[A-Za-z+/_.@-]*+[0-9])[A-Za-z0-9+/_.@-]{12,}(?<![.@-])|[A-Za-z]{16,}+)={0,2}"
# Published key formats and usual names of secrets.
PROVIDER = r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|glpat-[0-9A-Za-z_-]{20}|xox[abprs]-[0-9A-Za-z-]{10,}|sk_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_-]{35}|eyJ[0-9A-Za-z_-]{16,})"
HEX_KEY = r"^([0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"  # keys of 128, 160 and 256 bits
NAMES = r"(?i)(password|passwd|pwd|secret|token|api_?-?key|access_?-?key|auth|bearer|credential)s?"
ASSIGNED = NAMES + r"[\"']?\s*(:|=|=>|:=)\s*[\"']?$"
# The value behind an assigned secret name: up to the closing quote, or unquoted up to white space or
# what ends a list entry or sentence. The short look-behinds come first: they fail at once in prose.
_ASSIGN = r"[\"']?\s{0,16}(?::=|=>|:|=)\s{0,16}"
_BEHIND = r"(?<=%s)(?<=" + NAMES + _ASSIGN + "%s)"
VALUE = (
    r"(?<=[:=>\s\"'])(?:" + _BEHIND % (r"[:=>]\s{0,16}\"", r"\"") + r"[^\"\r\n]+(?=\")|" + _BEHIND % (r"[:=>]\s{0,16}'", "'") + r"[^'\r\n]+(?=')|"
    + _BEHIND % (r"[:=>]\s{0,16}[\"']?", r"[\"']?") + r"(?=\S*\w)[^\s\"'`<>,;&=:](?:[^\s\"'`<>,;&]|[,;&](?!\s|\w*=|$))*(?<![.,;:)}\]]))"
)
CANDIDATE = VALUE + "|" + TOKEN
EXAMPLE_PATH = r"(?i)(test|example|sample|fixture|mock|doc)"
FEATURES = ("f_length", "f_digits", "f_capitals", "f_hex", "f_transitions", "f_distinct", "f_coverage", "f_address", "f_path", "f_assigned", "f_named", "f_quoted", "f_spaced")


def findings(docs: DataFrame, path_col: str | None = None) -> DataFrame:
    """One row per candidate: doc_id, number (1, 2 ... in the text), at (code points before it),
    value, before, after, path."""
    text = F.col("text")
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    src = docs.select("doc_id", "text", F.coalesce(path, F.lit("")).alias("path"))
    src = src.filter(text.isNotNull()).withColumn("found", F.regexp_extract_all(text, F.lit(CANDIDATE), 0)).filter(F.size("found") > 0)
    src = src.withColumn("gaps", F.split(text, CANDIDATE, -1)).drop("text")
    lengths = F.zip_with(F.slice("gaps", 1, F.size("found")), "found", lambda g, f: F.struct(F.length(g).alias("g"), F.length(f).alias("f")))
    ends = F.transform("found", lambda v, i: F.struct(
        v.alias("value"),
        F.right(F.get("gaps", i), F.lit(AROUND)).alias("before"),
        F.substr(F.get("gaps", i + 1), F.lit(1), F.lit(AROUND)).alias("after"),
        F.length(F.get("gaps", i)).alias("gap"),
    ))
    src = src.withColumn("lengths", lengths).select("doc_id", "path", F.posexplode(ends).alias("n", "f"), "lengths")
    before = F.aggregate(F.slice("lengths", 1, F.col("n")), F.lit(0).cast("long"), lambda a, x: a + x["g"] + x["f"])
    return src.select("doc_id", (F.col("n") + 1).alias("number"), (before + F.col("f.gap")).alias("at"), "f.value", "f.before", "f.after", "path")


def neighbour_words(rows: DataFrame, limit: int = MAX_DICTIONARY) -> DataFrame:
    """The `limit` words most often seen around candidates: the dictionary."""
    words = rows.select(F.explode(F.regexp_extract_all(F.lower(F.concat_ws(" ", "before", "after")), F.lit("[a-z]{3,}"), 0)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(limit).select("word")


def with_features(rows: DataFrame, dictionary: list[str]) -> DataFrame:
    v, n = F.col("value"), F.length("value").cast("double")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    known = F.array(*map(F.lit, dictionary)) if dictionary else F.array().cast("array<string>")
    parts = F.array_intersect(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), 0), known)
    covered = F.aggregate(parts, F.lit(0), lambda a, w: a + F.length(w))
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    made = {
        "f_length": n,
        "f_digits": share("[0-9]"),
        "f_capitals": share("[A-Z]"),
        "f_hex": share("[0-9a-fA-F]"),
        "f_transitions": share(r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"),
        "f_distinct": F.size(F.array_distinct(F.split("value", ""))) / n,
        "f_coverage": covered / n,
        "f_address": yes(F.col("after").rlike(r"^\s?[@]|^\.[a-z]") | F.col("before").rlike(r"(@|://|www\.|/)[^\s]*$")),
        "f_path": yes(F.col("path").rlike(EXAMPLE_PATH)),
        "f_assigned": yes(F.col("before").rlike(r"(:|=|=>|:=)\s*[\"']?$")),
        "f_named": yes(F.col("before").rlike(NAMES + r"\W{0,6}$")),
        "f_quoted": yes(F.col("before").rlike("[\"'`]$")),
        "f_spaced": yes(F.col("before").rlike(r"(^|\s)$")),
    }
    return rows.select("*", *[made[f].cast("double").alias(f) for f in FEATURES])


def format_label(value: Column) -> Column:
    """1 for a published key format, 0 for the form of something harmless, else null."""
    harmless = value.rlike(r"^[\w.+-]+@[\w-]+(\.[\w-]+)+$") | value.rlike("^[0-9.,/:-]+[A-Za-z]{0,4}$") | value.rlike("^[A-Za-z]+([_./-][A-Za-z]+)*$")
    return F.when(value.rlike(PROVIDER) | value.rlike(HEX_KEY), 1).when(harmless, 0)


def prior_score() -> Column:
    """The score where nothing is labelled."""
    return F.when(F.col("value").rlike(PROVIDER) | F.col("before").rlike(ASSIGNED), 1.0).otherwise(0.0)


def train_forest(sample: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> Column:
    """A random forest over the features of a bounded labelled sample, as one column expression."""
    if sample.select("label").distinct().count() < 2:
        return prior_score()
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample.select(*FEATURES, F.col("label").cast("double").alias("label")))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8, featureSubsetStrategy="sqrt").fit(data)
    votes = [F.expr(tree_sql(t._call_java("rootNode"))) for t in forest.trees]
    score = votes[0]
    for v in votes[1:]:
        score = score + v
    return score / len(votes)


def tree_sql(node) -> str:
    """A fitted tree as nested CASE expressions; a leaf is the share of secrets in it."""
    if node.subtreeDepth() == 0:
        stats = list(node.impurityStats().stats())
        return repr(float(stats[1]) / max(sum(stats), 1e-9)) + "D"
    split = node.split()
    name = FEATURES[split.featureIndex()]
    return f"CASE WHEN `{name}` <= {split.threshold()!r}D THEN {tree_sql(node.leftChild())} ELSE {tree_sql(node.rightChild())} END"


def scan(docs: DataFrame, path_col: str | None = None, labelled: DataFrame | None = None) -> DataFrame:
    """Findings with features, score (0 to 1) and secret (score >= 0.5)."""
    rows = materialised(findings(docs, path_col), "findings")
    words = [r.word for r in neighbour_words(rows).collect()]  # at most MAX_DICTIONARY words
    made = with_features(rows, words)
    if labelled is None:
        sample = made.withColumn("label", format_label(F.col("value"))).filter("label is not null")
    else:
        sample = with_features(labelled, words).filter("label is not null")
    # as many of each kind, at most MAX_LABELLED in all
    order = [F.xxhash64("value", "before"), "value", "before", "after"]
    per = [sample.filter(F.col("label") == k).orderBy(*order).limit(MAX_LABELLED // 2) for k in (0, 1)]
    sample = per[0].unionByName(per[1]).select("label", *FEATURES).cache()  # MAX_LABELLED rows at most
    try:
        score = train_forest(sample)
    finally:
        sample.unpersist()
    return made.withColumn("score", score).withColumn("secret", F.col("score") >= 0.5)


def op6_query(docs: DataFrame) -> DataFrame:
    """One row per finding; the document's source stands for its path."""
    out = scan(docs.select("doc_id", "text", "source"), "source")
    kind = F.when(F.col("value").rlike(PROVIDER), "provider").when(F.col("before").rlike(ASSIGNED), "assigned").otherwise("other")
    return out.select(
        "doc_id", "number", "at", F.length("value").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"), kind.alias("kind"),
        F.round("score", 6).alias("score"), F.col("secret").cast("int").alias("predicted"),
    )
