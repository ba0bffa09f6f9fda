"""Corpus pipeline: toxicity, near-dedup, personal data, source mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. run() writes each stage's result as Parquet in the shared folder and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.llm import bpe, minhash, mixing, pii, toxicity
from leadflow.llm.common import fresh, materialised, read_table
from leadflow.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose toxicity score is below the threshold."""
    lexicon, model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    [score] = fresh(docs, "toxicity")
    scored = toxicity.score_documents(docs, lexicon, model, out_col=score)
    return scored.filter(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies; rows without an id stay. Of rows with one id and
    text the smallest stays, whatever their order, so reruns agree."""
    kept = minhash.near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    [text_hash, row] = fresh(docs, "text_hash", "row")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    named = docs.join(kept, "doc_id", "left_semi").withColumn(text_hash, F.xxhash64("text"))
    order = F.to_json(F.struct(*rest)) if rest else F.lit("")  # columns of any type
    first = named.groupBy("doc_id", text_hash).agg(F.min_by(F.struct(*rest, "text"), order).alias(row)).select("doc_id", f"{row}.*")
    return first.select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the text by pseudonyms."""
    [counts] = fresh(docs, "pii")
    out = pii.pseudonymise(docs, pii.session_key(spark), out_col=counts)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take as many words of each document as the mix says: whole copies, then its drawn blocks."""
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row."""
    return bpe.op10_query(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
