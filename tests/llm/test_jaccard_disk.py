"""What the Jaccard join leaves on disk, and how it moves keys and sets."""

import time
from pathlib import Path

import numpy as np
import pytest

from corpusmill.llm import jaccard


def shuffled(spark) -> dict:
    """Bytes of each shuffle file that is on disk."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p: p.stat().st_size for d in folders for p in Path(d.getPath()).rglob("shuffle_*.data") if p.exists()}


def copies(spark):
    """Groups of three: a text, an equal one and one with a word more; each text in several partitions."""
    texts = [" ".join(f"g{g}w{j}" for j in range(60 + g)) for g in range(50)]
    docs = [(3 * g + k, text + " more" * (k == 2)) for k in range(3) for g, text in enumerate(texts)]
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(6, "doc_id"), {3 * g + k: (56 + g + (k == 2), 3 * g) for g in range(50) for k in range(3)}


def test_shuffles_go_with_their_query(spark):
    docs, expected = copies(spark)
    before = set(shuffled(spark))
    got = jaccard.join(docs)  # its last query has not run yet
    for _ in range(50):  # files go in the background
        left = sum(size for p, size in shuffled(spark).items() if p not in before)
        if left < 2000:
            break
        time.sleep(0.2)
    assert left < 2000  # what the sizes of the last lookup took
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    for _ in range(2):
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == expected


@pytest.mark.parametrize("most", [jaccard.PREFILTER, 0])
def test_each_class_has_one_set(spark, most, monkeypatch):
    monkeypatch.setattr(jaccard, "PREFILTER", most)
    docs, expected = copies(spark)
    shared = spark.sparkContext.broadcast((np.zeros(0, np.uint64), np.zeros(0, np.int64), frozenset()))
    classes = [jaccard.fingerprint(jaccard.shingles(r.text.encode())) for r in docs.where("doc_id % 3 > 0").collect()]
    sets = jaccard.sets_of(docs, spark.createDataFrame([(fp,) for fp in classes], "fp long"), shared)
    assert sorted(r.fp for r in sets.collect()) == sorted(classes)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs).collect()} == expected


def test_sets_are_not_shuffled(spark, monkeypatch):
    written, stored = {}, jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, label: written.setdefault(label, []).append(df._jdf.queryExecution().toString()) or stored(df, label))
    jaccard.join(copies(spark)[0].localCheckpoint()).count()
    assert len(written["jaccard-sets"]) == 1 and "Exchange" not in written["jaccard-sets"][0]


def test_packed_rows():
    keys = np.array([0, 1, 2**64 - 1, 2**48, 0x123456789ABCDEF0], np.uint64)
    places = np.array([2 << 32, (9 << 32) + jaccard.LIGHT + 3, (2**31 - 1 << 32) + 2**31 - 1, (70_000 << 32) + 65_536, (300_000 << 32) + 93_749])
    key, place = jaccard._unpacked(*jaccard._packed(keys, places))
    assert (place == places).all() and (key == (keys & np.uint64(jaccard.KEY)).astype(np.int64)).all()
