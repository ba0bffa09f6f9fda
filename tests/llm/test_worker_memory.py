"""What Python workers hold, and which steps start them."""

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F


def test_bpe_task_holds_little_beside_its_batch():
    bpe = pytest.importorskip("leadflow.llm.bpe")
    from leadflow.llm.queries import tokenizer_path

    b, rnd = bpe.ByteBpe(tokenizer_path()), random.Random(3)
    texts = [" ".join("".join(rnd.choices("etaoinshrdlu", k=7)) for _ in range(2_000)) for _ in range(250)]  # 4 MB, hardly a word twice
    batch = pa.RecordBatch.from_arrays([pa.array(range(250)), pa.array(texts)], names=["id", "text"])
    encode = bpe.encode_batches(b, [batch]) if hasattr(bpe, "encode_batches") else ({"ids_le": pa.array(b.encode(x.column(1).to_pylist()))} for x in bpe.sliced([batch], 4 << 20))
    tracemalloc.start()
    try:
        ids = [x for out in encode for x in out["ids_le"].to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [b.decode(x) for x in ids] == texts
    assert peak < 100e6


def test_small_tables_start_no_python_workers(spark, monkeypatch):
    minhash, mixing = pytest.importorskip("leadflow.llm.minhash"), pytest.importorskip("leadflow.llm.mixing")
    words = F.transform(F.sequence(F.lit(0), F.lit(29)), lambda k: F.concat(F.lit("w"), (F.col("id") / 2).cast("int") * 100 + k))
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat_ws(" ", words).alias("text"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("source"))

    def parallelize(*_, **__):
        raise AssertionError("rows that go through Python workers of their own")

    monkeypatch.setattr(SparkContext, "parallelize", parallelize)
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()} == {(k, k // 2 * 2) for k in range(40)}
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == 40 and abs(sum(r.taken for r in mixed) - 1.5 * 40 * 30) <= 3
    none = mixing.mix(docs.limit(0))
    assert none.count() == 0
