"""Near copies whose only link is one text that very many others resemble."""

import random

import pytest

minhash = pytest.importorskip("leadflow.llm.minhash")


def test_no_near_copy_of_a_large_group_is_missed(spark):
    rnd = random.Random(7)
    base = [f"w{k}" for k in range(1000)]
    texts = [" ".join(base)]
    for i in range(2000):  # likeness to the base 0.77, to each other about 0.6
        copy = list(base)
        for at in rnd.sample(range(7, 990, 5), 26):
            copy[at] = f"x{i}y{at}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    missed = sum(c != 0 for c in got.values())
    assert len(got) == 2001 and missed == 0
