"""Each stage's kept rows against brute force on a small fixture."""

import itertools
import random
import re
from collections import Counter

import pytest

import corpus_pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BLANKS = "\t\n\x0b\x0c\r "


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    names = [f"w{k}" for k in range(200)]
    base = [rng.choices(names, k=60) for _ in range(25)]
    texts = [" ".join(w) for w in base]
    for w in base[:8]:  # near copies, and copies too far off
        texts += [" ".join([*w[:30], "new", *w[31:]]), " ".join(w[:30] + rng.choices(names, k=30)), " ".join(w)]
    texts += [f"Common line\n{' '.join(rng.choices(names, k=8))}\n common LINE " for _ in range(12)] + [f"rare line\nx{k}" for k in range(9)]
    texts += [f"{' '.join(rng.choices(names, k=20))} {' '.join(f'b{j}' for j in range(13))}", f"{' '.join(rng.choices(names, k=400))} b1 b2 b3", "b1 b2 b3", "", None]
    return [(k, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, t in enumerate(texts)]


@pytest.fixture
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_line_dedup(spark, rows, docs):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANKS))

    count = Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")} if k)
    want = {r[0]: "\n".join(x for x in (r[1] or "").split("\n") if count[key(x)] < 10) for r in rows}
    assert {r.doc_id: r.text for r in P.line_dedup_stage(spark, docs, "").collect()} == want
    assert any(want[r[0]] != (r[1] or "") for r in rows)


def test_near_duplicates(spark, rows, docs):
    sets, at = {r[0]: shingles(r[1]) for r in rows}, {r[0]: r[0] for r in rows}
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
            low, high = sorted((at[a], at[b]))
            at = {k: low if v == high else v for k, v in at.items()}
    want = sorted(k for k, v in at.items() if k == v)
    assert sorted(r.doc_id for r in P.near_duplicates(spark, docs, "").collect()) == want and len(want) <= len(rows) - 16


def test_decontamination(spark, rows, docs, tmp_path):
    items = [(1, " ".join(f"b{j}" for j in range(13))), (None, "b1 b2 b3"), (3, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = []
    for r in rows:
        w, hit = words(r[1]), set()
        for item in (words(t) for _, t in items if t):
            hit |= {x for k in range(len(w)) if w[k : k + len(item)] == item for x in range(k, k + len(item))}
        if not hit or 20 * len(hit) < len(w):
            want.append(r[0])
    got = sorted(r.doc_id for r in P.decontaminate(spark, docs, str(tmp_path)).collect())
    assert got == want and len(want) == len(rows) - 2


def test_mix(spark, rows, docs):
    out = P.mix(spark, docs, "").collect()
    taken, target, copies = Counter(), {}, {}
    for r in out:
        assert r.size == len((r.text or "").split())
        taken[r.source] += r.size
        target[r.source] = r.target
        copies.setdefault((r.doc_id, r.copies), []).append(r.copy)
    assert all(sorted(got) == list(range(1, n + 1)) and n <= 2 for (_, n), got in copies.items())
    most = max(len((r[1] or "").split()) for r in rows)
    assert set(target) == {"s0", "s1", "s2"} and all(abs(taken[s] - target[s]) <= most for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(len((r[1] or "").split()) for r in rows)) < 1e-3
