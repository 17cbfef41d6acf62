"""Registered queries that do the whole job: no prefix of a text, no target of a mix."""

import random

from corpusmill.plans.catalogue import EOS, QUERIES


def documents(spark, folder):
    rng = random.Random(9)
    rows = [(k, " ".join(f"w{rng.randrange(500)}" for _ in range(n)), f"s{k % 2}") for k, n in enumerate((20, 512, 513, 2000, 8193))]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{folder}/documents.parquet")
    return {k: len(t.split()) for k, t, _ in rows}


def test_whole_texts_are_tokenized(spark, tmp_path):
    n = documents(spark, tmp_path)
    rows = QUERIES["token_counts"](spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_ids, r.length) for r in rows} == {k: (w, w + -(-w // 8192)) for k, w in n.items()}
    total = sum(w + -(-w // 8192) for w in n.values())
    assert QUERIES["token_counters"](spark, str(tmp_path)).first().tokens == total
    assert sum(r.n_tokens for r in QUERIES["token_shard_sums"](spark, str(tmp_path)).collect()) == total
    assert sum(r.n for r in QUERIES["token_shards"](spark, str(tmp_path)).collect()) == total
    streams = {r.doc_id: r.stream.split() for r in QUERIES["token_chunks"](spark, str(tmp_path)).collect()}
    assert all(sum(x != str(EOS) for x in streams[k]) == w for k, w in n.items())


def test_whole_tables_are_mixed(spark, tmp_path):
    documents(spark, tmp_path)
    spark.range(40).selectExpr("id as page_id", "repeat('w ', 700) as html").write.parquet(f"{tmp_path}/pages.parquet")
    spark.range(90).selectExpr("id div 3 as conv_id", "id % 3 as turn", "repeat('w ', 900) as text").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.range(400).selectExpr("id as item_id", "if(id = 0, null, 'a b c') as text").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = QUERIES["mix_whole"](spark, str(tmp_path)).collect()
    assert sorted(r.position for r in rows) == list(range(5 + 40 + 90 + 400)) and sum(r.estimated_tokens for r in rows) > 60_000
