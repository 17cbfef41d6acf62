"""The runs of line dedup: merged as runs, by batches, and taken up again."""

import re
from collections import Counter

from pyspark.sql import functions as F

from corpusmill.llm import line_dedup


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_batches_meet_runs_by_merge(spark):
    texts = [f"common\nline {k}\nline {k % 7}\n\n Common " for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    runs = line_dedup.LineRuns(spark, 10)
    for b in range(5):
        runs.add(docs.where(F.col("doc_id") % 5 == b))
    assert [r.level for r in runs.runs] == [2, 0]
    with line_dedup._in_order(spark):
        again = line_dedup.LineRuns(spark, 10, runs.runs)  # as a later session would
        plan = plan_of(again.new_counts(line_dedup.document_keys(docs, "text")))
        frequent = again.frequent().collect()
    joins = re.findall(r"\w+Join", plan)
    assert joins == ["SortMergeJoin"] * 2 and len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    for below in plan.split("SortMergeJoin")[2:]:  # the runs' sides: scans of buckets, neither shuffled nor sorted
        assert "Bucketed: true" in below
    key = {r.key: r.t for r in spark.createDataFrame([("common",), *((f"line {k}",) for k in range(60))], "t string").select("t", F.xxhash64("t").alias("key")).collect()}
    want = Counter(x for k in range(60) for x in {"common", f"line {k}", f"line {k % 7}"})
    got = {key[r.key]: r.n for r in frequent}
    assert set(got) == {"common"} and got["common"] <= want["common"]


def test_counts_add_up_over_runs(spark):
    """A key that no single run shows to be frequent is known by the sum."""
    docs = spark.createDataFrame([(k, "x\n" + "y\n" * (k % 2)) for k in range(12)], "doc_id long, text string")
    runs = line_dedup.LineRuns(spark, 10)
    for b in range(4):
        runs.add(docs.where(F.col("doc_id") % 4 == b))
    with line_dedup._in_order(spark):
        assert [r.n for r in runs.frequent().collect()] == [12]
    assert len(runs.runs) == 1 and runs.runs[0].level == 2
