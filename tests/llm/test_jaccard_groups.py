"""The Jaccard join on a group of copies of which many are just too far from all others to be linked."""

import pytest

from corpusmill.llm import jaccard

#: Shingles that all copies share; how many more each has of its own: two of 80 at most leave a similarity of 3/4.
SHARED, OWN = 240, [40] * 40 + [41] * 60


def rows_of_joins(spark, after):
    """The rows that each join made in the queries after the first `after` ones."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store = spark._jsparkSession.sharedState().statusStore()
    runs = store.executionsList()
    for i in range(after, runs.size()):
        values, nodes = store.executionMetrics(runs.apply(i).executionId()), store.planGraph(runs.apply(i).executionId()).allNodes()
        for node in map(nodes.apply, range(nodes.size())):
            for metric in map(node.metrics().apply, range(node.metrics().size())):
                if "Join" in node.name() and metric.name() == "number of output rows":
                    yield int(values.getOrElse(metric.accumulatorId(), None).replace(",", "")) if values.contains(metric.accumulatorId()) else 0


@pytest.mark.parametrize("meeting", [jaccard.MEETING, 200])
def test_classes_meet_once(spark, meeting, monkeypatch):
    monkeypatch.setattr(jaccard, "MEETING", meeting)
    docs = [(k, " ".join([f"c{j}" for j in range(SHARED + 4)] + [f"d{k}x{j}" for j in range(own)])) for k, own in enumerate(OWN)]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = spark._jsparkSession.sharedState().statusStore().executionsList().size()
    got = jaccard.join(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {k: (SHARED + own, 0 if own == 40 else k) for k, own in enumerate(OWN)}
    keys, pairs = sum((SHARED + own) // 4 + 1 + (SHARED + own) // 16 for own in OWN), len(OWN) * (len(OWN) - 1) // 2
    made = list(rows_of_joins(spark, before))
    assert len(made) > 20 and max(made) <= keys + pairs  # a row for each key or for each pair, but not for each key of each pair
