import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import sharding, tokenizing
from corpusmill.sources import checkpoint, files


def ids(spark, n, hard=100, chunk=4):
    df = spark.createDataFrame([("x" * 11, list(range(n)))], "text string, i array<int>")
    return tokenizing.streams(df, F.col("i"), 99, hard, chunk).first().stream


def test_chunks(spark):
    assert ids(spark, 0) == []
    assert ids(spark, 4) == [0, 1, 2, 3, 99]
    assert ids(spark, 5) == [0, 1, 2, 3, 99, 4, 99]
    assert ids(spark, 9, hard=5) == [0, 1, 2, 3, 99, 4, 99]


def test_valid(spark):
    df = spark.createDataFrame([("x" * 10,), ("x" * 11,), (None,)], "text string")
    assert [r[0] for r in df.select(tokenizing.valid(F.col("text"))).collect()] == [False, True, False]


@pytest.mark.parametrize("length,shards", [(9, [9]), (10, [10]), (11, [10, 1])])
def test_shards_and_files(spark, tmp_path, length, shards):
    rows = [(0, k, 1, [k]) for k in range(length)]
    df = spark.createDataFrame(rows, "file int, row int, length bigint, stream array<int>")
    parts = tokenizing.pieces(tokenizing.placed(df), 10)
    assert [r.n_tokens for r in tokenizing.shard_sums(tokenizing.placed(df), 10).orderBy("shard_id").collect()] == shards
    named = sharding.write_token_shards(parts, f"file://{tmp_path}/out", "uint16", 10)
    assert sorted(n for _, n in named) == sorted(shards)
    data = np.concatenate([np.fromfile(tmp_path / "out" / n, "<u2") for n in sorted((n for n, _ in named), key=lambda n: n == "buffer.bin")])
    assert data.tolist() == list(range(length))
    assert json.loads((tmp_path / "out/manifest.json").read_text())["next_part"] == sum(n == 10 for n in shards)


def test_budget_follows_the_loop(spark):
    def loop(lengths, shard, io, target):
        done = 0
        for n in lengths:
            left = n
            while left:
                if done >= target:
                    return done
                step = min(io, shard - done % shard, left)
                done, left = done + step, left - step
        return done

    rows = [(k, 0, n, None) for k, n in enumerate((13, 7, 20, 5))]
    at = tokenizing.placed(spark.createDataFrame(rows, "file int, row int, length bigint, stream array<int>"))
    for target in (1, 10, 14, 17, 30, 44, 60):
        assert tokenizing.budget(at, 10, 4, target).first().tokens == loop([13, 7, 20, 5], 10, 4, target)


def test_types():
    assert tokenizing.dtype_of(65535, 0) == "uint16" and tokenizing.dtype_of(65536, 0) == "uint32"
    with pytest.raises(ValueError):
        tokenizing.dtype_of(10, 70000)


def test_staging_resets_its_counter(spark):
    df = spark.createDataFrame([("f", k, "x" * (100 * k)) for k in range(6)], "source string, doc_id bigint, text string")
    out = sharding.staging_parts(df, "source", "doc_id", 700, 3).orderBy("doc_id").collect()
    assert [r.part for r in out] == [0, 0, 0, 1, 1, 2]


def test_files(spark, tmp_path):
    for k in range(3):
        spark.range(4).coalesce(1).write.parquet(f"{tmp_path}/in/part{k}")
    found = files.list_files(spark, f"file://{tmp_path}/in", "", "*.parquet")
    assert len(found) == 3 and found == sorted(found)
    df = files.scan(spark, f"file://{tmp_path}/in", files.file_range(found, 1, 2), 3, {found[1]: 2})
    assert sorted((r.file, r.row) for r in df.collect()) == [(1, 2), (2, 0), (2, 1), (2, 2)]
    with pytest.raises(RuntimeError):
        files.list_files(spark, f"file://{tmp_path}/in", "nothing")
    with pytest.raises(ValueError):
        files.file_range(found, 0, 0)
    files.write_json(spark, f"file://{tmp_path}/p.json", {"a": 1})
    assert files.read_json(spark, f"file://{tmp_path}/p.json") == {"a": 1} and files.read_json(spark, f"file://{tmp_path}/q.json") is None
    assert files.manifest_files({"finished": True, "next_part": 2}, "x_shard_{:05d}.parquet") == ["x_shard_00000.parquet", "x_shard_00001.parquet"]
    with pytest.raises(RuntimeError):
        files.manifest_files({"finished": False}, "x")


def test_checkpoints():
    a = checkpoint.State("h", {"s": ["0"]}, cursors={"s": {"file_index": 1, "exhausted": True}})
    b = checkpoint.State("g", {"s": ["0", "1"]})
    assert checkpoint.extended(a, b).cursors["s"]["exhausted"] is False
    with pytest.raises(RuntimeError, match="reordered"):
        checkpoint.extended(a, checkpoint.State("g", {"s": ["1"]}))
    with pytest.raises(RuntimeError):
        checkpoint.may_start(False, True, False)
    assert checkpoint.reconcile(10, 9, 10, False) == "shard" and checkpoint.reconcile(9, 9, 10, True) == "keep"
