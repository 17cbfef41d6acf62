"""Benchmark items without an id, against the operator's SQL."""

import duckdb

from corpusmill.llm import decontam


def test_null_ids_against_sql(spark, tmp_path):
    texts = ["a b c d e f g h i j k l m n", "x a b c y", "q r s t", "", None, "nothing here"]
    items = [(None, "a b c d e f g h i j k l m"), (None, "a b c"), (7, "q r"), (None, None), (3, "a b c"), (None, "none of it")]
    docs, bench = enumerate(texts), items
    spark.createDataFrame(list(docs), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    want = sorted(c.execute(decontam.SQL).fetchall())
    got = sorted(tuple(r) for r in decontam.op4_decontaminate(spark, str(tmp_path)).collect())
    assert got == want and got[0][2:4] == (13, 2) and got[1][3] == 2
    small = decontam.search(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/benchmark.parquet"), block_bytes=8)
    assert {(r.doc_id, r._n_hit, len(r._items)) for r in small.collect()} == {(r[0], r[2], r[3]) for r in want}
