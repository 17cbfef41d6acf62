import os
from collections import Counter

import pytest

import corpus_pipeline as P

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", None, 0), (10**6 + 1, "only words here and nothing else to see", None, "new", None)], docs.schema)
    now = docs.unionByName(odd)
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, now, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        before, now = now, spark.read.parquet(f"{tmp_path}/{k}")
        if name == "language ID":
            assert {r.doc_id for r in before.collect()} - {r.doc_id for r in now.collect()} <= {None, 10**6} | {r.doc_id for r in before.collect() if not any(c.isalpha() for c in r.text or "")}
        if name == "line dedup":
            assert now.count() == before.count()
        if name != "mixing":
            assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert now.where("copies > 2").count() == 0 and max(Counter(r.doc_id for r in now.collect()).values()) <= 2


def test_empty(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
