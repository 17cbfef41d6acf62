"""Near duplicates by row: one of each group stays, whatever the ids are."""

from collections import Counter

import corpus_pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_one_row_of_each_group(spark, tmp_path):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    texts = [(3, a), (5, a + " z"), (None, a), (None, a), (5, b), (8, b), (8, b), (8, b), (None, c), (None, c), (9, None), (9, None), (-4, d), (2, d), (10, d + " y")]
    docs = spark.createDataFrame([(i, t, "en", "s", t and len(t)) for i, t in texts], SCHEMA).repartition(3)
    docs.write.parquet(f"{tmp_path}/in")
    kept = P.near_duplicates(spark, spark.read.parquet(f"{tmp_path}/in"), "")
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(3, a), (5, b), (None, c), (9, None), (9, None), (-4, d)])
