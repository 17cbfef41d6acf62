"""Runs that are stopped between any two writes end as undisturbed ones do."""

import json

import numpy as np
import pytest

from corpusmill.operators import mixing, tokenizing
from corpusmill.plans import runs
from corpusmill.sources import checkpoint, files

FILTER = {"stage": 1, "name": "a", "source": {"file_pattern": "*.parquet"}, "columns": {"id": "doc_id"}, "filters": {"min_words": 3, "min_language_score": 0.2, "min_answer_count": 1, "missing_policy": "ignore"}, "output": {"path_prefix": "a"}}
MIX = {"stage": 2, "name": "m", "seed": 3, "sources": [{"name": "a", "weight": 0.6}, {"name": "b", "weight": 0.4}], "output": {"batch_rows": 4, "max_documents": 50}}


class Stopped(Exception):
    pass


def source(spark, folder, n=12, first=0):
    """Files f0.parquet, f1.parquet, ... of ten rows each."""
    for k in range(first, n):
        spark.range(10).selectExpr(f"id + {k} * 10 as doc_id", f"if(id = 3, 'x y', concat('w{k} ', repeat('w ', 5 + cast(id as int)))) as text", "id / 10 as language_score", "if(id = 7, 0, if(id = 8, null, id)) as answer_count", "if(id = 9, 100, null) as token_count", "'x' as file_path").coalesce(1).write.parquet(f"{folder}/p{k}")
        part = next(folder.joinpath(f"p{k}").glob("*.parquet"))
        part.rename(folder / f"f{k}.parquet")


def plain(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def stop_at(monkeypatch, owner, name, nth):
    """The nth call of owner.name fails before it does anything."""
    real, calls = getattr(owner, name), []

    def f(*a, **b):
        calls.append(1)
        if len(calls) == nth:
            raise Stopped
        return real(*a, **b)

    monkeypatch.setattr(owner, name, f)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("runs")
    (folder / "in").mkdir()
    source(spark, folder / "in")
    return folder


def test_filter_goes_on(spark, base, tmp_path, monkeypatch):
    root = f"file://{base}/in"
    whole = plain(runs.run_filter(spark, FILTER, root, f"file://{tmp_path}/whole"), "*")
    rows = plain(runs.filtered(spark, f"file://{tmp_path}/whole/a"), "file", "id", "estimated_tokens", "language_score", "answer_count")
    assert [r[1:] for r in whole] == [(10, 6, 4, sum(x[2] for x in rows if x[0] == 0))] * 12
    assert {r[1][-1] for r in rows} == set("245689") and len(rows) == 72
    for owner, name, nth in ((checkpoint.Ledger, "commit", 1), (checkpoint.Ledger, "commit", 3), (files, "write_json", 2), (files, "scan", 2)):
        out = f"file://{tmp_path}/{name}{nth}"
        with monkeypatch.context() as m:
            stop_at(m, owner, name, nth)
            with pytest.raises(Stopped):
                runs.run_filter(spark, FILTER, root, out, commit_files=4)
        assert plain(runs.run_filter(spark, FILTER, root, out, commit_files=4), "*") == whole
        assert plain(runs.filtered(spark, f"{out}/a"), "file", "id", "estimated_tokens", "language_score", "answer_count") == rows
    state = checkpoint.Ledger(spark, f"{out}/a/_state").load()
    assert state["finished"] and state["progress"]["next_file"] == 12 and state["progress"]["accepted"] == 72
    assert runs.run_filter(spark, FILTER, root, out, dry=True).count() == 0
    with pytest.raises(RuntimeError, match="remove"):
        runs.run_filter(spark, FILTER, root, out, resume=False)
    with pytest.raises(RuntimeError, match="another configuration"):
        runs.run_filter(spark, {**FILTER, "filters": {}}, root, out)
    (tmp_path / "scan2/a/data/old").mkdir()
    with pytest.raises(RuntimeError, match="without a checkpoint"):
        runs.run_filter(spark, FILTER, root, out)
    files.remove(spark, f"{out}/a/data/old")
    files.remove(spark, f"{out}/a/data/{state['commits'][0]['name']}")
    with pytest.raises(RuntimeError, match="missing"):
        runs.run_filter(spark, FILTER, root, out)


def test_totals_wait_for_their_turn():
    one = {"rows_seen": 1, "accepted": 1, "rejected": 0, "estimated_tokens": 5}
    p = checkpoint.folded({}, [{"file_path": "b", **one}], ["a", "b"])
    assert p["next_file"] == 0 and p["accepted"] == 0
    p = checkpoint.folded(json.loads(json.dumps(p)), [{"file_path": "a", **one}], ["a", "b"])
    assert p["next_file"] == 2 and p["accepted"] == 2 and p["waiting"] == {}


def test_mix_goes_on_and_grows(spark, base, tmp_path, monkeypatch):
    root, inner = f"file://{tmp_path}/in", tmp_path / "b"
    inner.mkdir()
    source(spark, inner, 2)
    runs.run_filter(spark, FILTER, f"file://{base}/in", root)
    more = {**FILTER, "name": "b", "output": {"path_prefix": "b"}}
    with pytest.raises(RuntimeError, match="not finished"):
        runs.run_mix(spark, MIX, root, f"file://{tmp_path}/m0")
    runs.run_filter(spark, more, f"file://{inner}", root, most=1)
    with pytest.raises(RuntimeError, match="not finished"):
        runs.run_mix(spark, MIX, root, f"file://{tmp_path}/m0")
    runs.run_filter(spark, more, f"file://{inner}", root)
    assert [f.partition("/")[2].partition("/")[0] for f in runs.source_files(spark, root, "a")] == [f"file={k}" for k in range(12)]
    report = plain(runs.run_mix(spark, MIX, root, f"file://{tmp_path}/m"), "*")
    want = runs.mixed(spark, f"file://{tmp_path}/m/m").orderBy("position").select("position", "source_name", "id", "shard").collect()
    assert [r.position for r in want] == list(range(84)) and sum(r[1] for r in report) == 84 and {r.shard for r in want} == {0, 1}
    a_only = [int(r.id) // 10 for r in want if r.source_name == "a"]
    places = [sorted(map(str, range(12))).index(str(k)) for k in a_only]  # source files are listed by name
    assert places == sorted(places) and places[-1] == 11  # file=2 before file=10
    for owner, name in ((checkpoint.Ledger, "commit"), (files, "write_json")):
        out = f"file://{tmp_path}/stop-{name}"
        with monkeypatch.context() as m:
            stop_at(m, owner, name, 1)
            with pytest.raises(Stopped):
                runs.run_mix(spark, MIX, root, out)
        runs.run_mix(spark, MIX, root, out)
        assert runs.mixed(spark, f"{out}/m").orderBy("position").select("position", "source_name", "id", "shard").collect() == want
    again = runs.run_mix(spark, MIX, root, out)  # nothing is left to take
    assert sum(r.n_rows for r in again.collect()) == 0 and runs.mixed(spark, f"{out}/m").count() == 84
    with pytest.raises(RuntimeError, match="another configuration"):
        runs.run_mix(spark, {**MIX, "seed": 4}, root, out)
    source(spark, inner, 4, 2)
    runs.run_filter(spark, more, f"file://{inner}", root)
    runs.run_mix(spark, MIX, root, out)
    grown = runs.mixed(spark, f"{out}/m").orderBy("position").select("position", "source_name", "id", "shard").collect()
    assert grown[:84] == want and [r.position for r in grown] == list(range(96)) and {r.source_name for r in grown[84:]} == {"b"}


def test_a_schedule_in_two_goes(spark):
    """What a cursor leaves, scheduled alone, follows as in one go."""
    from corpusmill.sources.config import Mix, MixSource

    mix = Mix("m", (MixSource("a", 0.5), MixSource("b", 0.5)), None, 1)
    rows = [("a", 0, k, 4, 10 + k % 3) for k in range(9)] + [("b", 0, k, 4, 7 + k % 5) for k in range(12)]
    made = spark.createDataFrame(rows, "source string, file int, batch_id long, n_rows long, tokens long")
    whole = [(r.source, r.batch_id, r.before, r.rows_before) for r in mixing.schedule(made, mix).orderBy("before").collect()]
    for cut in (1, 7, 15):
        cursors = {}
        for s, b, *_ in whole[:cut]:
            t = next(r[4] for r in rows if r[0] == s and r[2] == b)
            old = cursors.get(s, {"tokens": 0, "rows": 0})
            cursors[s] = {"file": 0, "batch_id": b, "tokens": old["tokens"] + t, "rows": old["rows"] + 4}
        rest = [(r.source, r.batch_id, r.before, r.rows_before) for r in mixing.schedule(made, mix, cursors).orderBy("before").collect()]
        assert rest == whole[cut:]


def tokenizer(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    made = Tokenizer(models.WordLevel({"w": 0, "<|endoftext|>": 1, "[UNK]": 2}, unk_token="[UNK]"))
    made.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    made.save(str(tmp_path / "t.json"))
    return tokenizing.FileTokenizer(str(tmp_path / "t.json"), "<|endoftext|>")


def test_tokenizing_goes_on(spark, base, tmp_path, monkeypatch):
    with pytest.raises(ValueError):
        tokenizing.FileTokenizer(str((tokenizer(tmp_path), tmp_path / "t.json")[1]), "<none>")
    t, root = tokenizer(tmp_path), f"file://{base}/in"
    data = {"tokenizer": {"max_doc_tokens": 4}, "output": {"shard_size_tokens": 100, "commit_files": 5}}
    assert [f for f, _ in runs.run_tokenize(spark, data, root, "", t, dry=True)] == [f"f{k}.parquet" for k in range(12)]
    texts = [r.text for k in range(12) for r in spark.read.parquet(f"{base}/in/f{k}.parquet").orderBy("doc_id").collect()]
    ids = [[0 if w == "w" else 2 for w in x.split()] for x in texts if len(x) > 10]
    want = [i for x in ids for k in range(0, len(x), 4) for i in [*x[k : k + 4], 1]]

    def read(folder):
        names = sorted(x.name for x in folder.glob("*.bin"))
        names = [n for n in names if n != "buffer.bin"] + [n for n in names if n == "buffer.bin"]
        return np.concatenate([np.fromfile(folder / n, "<u2") for n in names]).tolist()

    rows = runs.run_tokenize(spark, data, root, f"file://{tmp_path}/out", t)
    assert read(tmp_path / "out") == want and sum(n for _, n in rows) == len(want)
    for nth in (1, 2, 3, 4):
        out = tmp_path / f"stop{nth}"
        with monkeypatch.context() as m:
            stop_at(m, checkpoint.Ledger, "commit", nth)
            with pytest.raises(Stopped):
                runs.run_tokenize(spark, data, root, f"file://{out}", t)
        assert runs.run_tokenize(spark, data, root, f"file://{out}", t) == rows and read(out) == want
    with pytest.raises(RuntimeError, match="another configuration"):
        runs.run_tokenize(spark, {**data, "tokenizer": {}}, root, f"file://{out}", t)
    few = runs.run_tokenize(spark, {**data, "target_tokens": 130, "output": {**data["output"], "io_chunk_tokens": 7}}, root, f"file://{tmp_path}/few", t)
    kept = sum(n for _, n in few)
    assert 130 <= kept < 137 and read(tmp_path / "few") == want[:kept]


def test_files_by_pattern(spark, base):
    root = f"file://{base}/in"
    assert runs.token_files(spark, root, "f1*.parquet") == ["f1.parquet", "f10.parquet", "f11.parquet"]
    assert files.glob_files(spark, root, "f[0-9].parquet") == []
    got = files.scan(spark, root, [(0, "f0.parquet"), (1, "gone.parquet"), (2, "f2.parquet")], 5, {"f2.parquet": 3})
    assert sorted((r.file, r.file_path, r.row) for r in got.collect()) == [(0, "f0.parquet", k) for k in range(5)] + [(2, "f2.parquet", 3), (2, "f2.parquet", 4)]
