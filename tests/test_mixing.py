import random

import pytest

from corpusmill.operators import mixing
from corpusmill.sources.config import Mix, MixSource


def greedy(batches, mix):
    """An independent model: batches is {source: [tokens]}."""
    at, sums, out, total = dict.fromkeys(batches, 0), dict.fromkeys(batches, 0), [], 0
    while mix.target_tokens is None or total < mix.target_tokens:
        open_ = [s for s in batches if at[s] < len(batches[s]) and (mix.target_tokens is None or sums[s] < int(mix.target_tokens * mix.shares[s]))]
        if not open_:
            break
        s = min(open_, key=lambda s: (sums[s] / mix.shares[s], mix.ranks[s]))
        out.append((s, at[s]))
        sums[s] += batches[s][at[s]]
        total += batches[s][at[s]]
        at[s] += 1
    return out


@pytest.mark.parametrize("target", [None, 400])
def test_the_schedule_is_the_greedy_one(spark, target):
    rng = random.Random(3)
    batches = {s: [rng.randint(1, 40) for _ in range(n)] for s, n in (("a", 30), ("b", 20), ("c", 5))}
    mix = Mix("m", (MixSource("a", 3), MixSource("b", 2), MixSource("c", 1)), target, 7)
    rows = [(s, 0, k, 1, t) for s, ts in batches.items() for k, t in enumerate(ts)]
    made = spark.createDataFrame(rows, "source string, file int, batch_id bigint, n_rows bigint, tokens bigint")
    taken = mixing.schedule(made, mix)
    assert [(r.source, r.batch_id) for r in taken.orderBy("before").collect()] == greedy(batches, mix)
    assert abs(sum(r.actual_pct for r in mixing.report(taken, mix).collect()) - 100) < 1e-9


def test_next_source_by_token_debt(spark):
    mix = Mix("m", (MixSource("general", 0.75), MixSource("math", 0.25)), 1000, 42)
    df = spark.createDataFrame([("general", 750, False), ("math", 100, False)], "source string, tokens bigint, exhausted boolean")
    assert mixing.next_source(df, mix).first().source == "math"


def test_batches_fall_back(spark):
    rows = [("s", 0, 0, None, 5, 3), ("s", 0, 1, None, 6, 3), ("s", 0, 2, None, None, 10), ("s", 0, 3, None, None, 0)]
    docs = mixing.numbered(spark.createDataFrame(rows, "source string, file int, row bigint, estimated_tokens bigint, token_count bigint, word_count bigint"), 2)
    assert sorted((r.batch_id, r.n_rows, r.tokens) for r in mixing.batches(docs).collect()) == [(0, 2, 11), (1, 2, 14)]


def test_errors(spark):
    with pytest.raises(ValueError):
        Mix("m", (), 10)
    with pytest.raises(ValueError):
        Mix("m", (MixSource("a", 1), MixSource("b", 0)))
    mix = Mix("m", (MixSource("a", 1), MixSource("b", 1), MixSource("c", 1)), 100, 1)
    made = spark.createDataFrame([(s, 0, k, 1, 1) for s in "abc" for k in range(50)], "source string, file int, batch_id bigint, n_rows bigint, tokens bigint")
    with pytest.raises(RuntimeError, match="99 of 100"):
        mixing.check_budget(mixing.schedule(made, mix), mix)


def test_row_limit_cuts_the_last_batch(spark):
    mix = Mix("m", (MixSource("a", 1),), None, 1, 4, 6)
    docs = mixing.numbered(spark.createDataFrame([("a", 0, k, 1, None, 1) for k in range(10)], "source string, file int, row bigint, estimated_tokens bigint, token_count bigint, word_count bigint"), 4)
    out = mixing.output(docs, mixing.schedule(mixing.batches(docs), mix), mix)
    assert sorted(r.row for r in out.collect()) == list(range(6))
