"""The pipeline's dedup stage on rows of one id."""

import pytest
from pyspark.sql import functions as F

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_rows_of_one_id_are_kept_alike_in_any_order(spark):
    stage = dict(pytest.importorskip("corpus_pipeline").STAGES)["near_dedup"]
    t, u = "one two three four five six seven", "other words stand in this text here"
    rows = [(1, t, "en", "b", 5), (1, t, "en", "a", 5), (1, t, "en", None, 5), (1, u, "en", "c", 5), (2, t, "en", "a", 5), (None, t, "en", "z", 5), (None, t, "en", "z", 5), (3, None, None, None, None)]
    got = []
    for order in (rows, rows[::-1]):
        out = stage(spark, spark.createDataFrame(order, DOC).withColumn("more", F.create_map(F.lit("k"), F.lit(1))), "")
        got.append(sorted(((r.doc_id, r.text, r.source) for r in out.collect()), key=repr))
    assert got[0] == got[1]
    assert [r for r in got[0] if r[0] == 1] in ([(1, u, "c"), (1, t, "a")], [(1, t, "a"), (1, u, "c")], [(1, t, None), (1, u, "c")], [(1, t, "a")], [(1, t, None)])
    assert (None, t, "z") in got[0] and (3, None, None) in got[0] and all(r[0] != 2 for r in got[0])
