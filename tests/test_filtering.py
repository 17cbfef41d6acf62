import pytest

from corpusmill.functions.schema import OUTPUT
from corpusmill.operators import filtering, metrics
from corpusmill.sources.config import Policy, Source, load, source_of

BLANKS = [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def normal(spark, rows, schema, **columns):
    return filtering.normalize(spark.createDataFrame(rows, schema), Source("name", "repo", columns=columns))


def test_words_are_split_at_all_29_blanks(spark):
    texts = [f"a{chr(c)}b" for c in BLANKS] + [f"a{chr(c)}b" for c in (0x200B, 0xFEFF, 0x180E)] + ["", "   ", " ", None]
    out = normal(spark, [(t,) for t in texts], "text string").collect()
    assert [r.word_count for r in out] == [2] * 29 + [1] * 3 + [0] * 4
    assert filtering.judged(normal(spark, [("",), ("  ",), (None,)], "text string"), Policy()).select("reason").distinct().collect()[0].reason == "empty_text"


def test_schema_and_estimates(spark):
    rows = [("a b c d e", None), ("w " * 15, None), ("a", 0), ("a", -3), ("", None)]
    out = normal(spark, rows, "text string, token_count bigint")
    assert out.schema == OUTPUT or [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in OUTPUT]
    assert [r.estimated_tokens for r in out.collect()] == [6, 20, 1, -3, 1]


def test_coercion(spark):
    rows = [("n/a", "3.7"), ("", " 12 "), ("nan", "1_000"), ("inf", "x"), ("0.5", "+5"), ("2f", "1e3"), (None, None)]
    out = normal(spark, rows, "score string, int_score string").select("score", "int_score").collect()
    assert [repr(r.score) for r in out] == ["None", "None", "nan", "inf", "0.5", "None", "None"]
    assert [r.int_score for r in out] == [None, 12, 1000, None, 5, None, None]
    out = normal(spark, [(3.9, True, [1])], "int_score double, score boolean, answer_count array<int>").first()
    assert (out.int_score, out.score, out.answer_count) == (3, 1.0, None)


def test_nested_paths_and_fallback(spark):
    out = normal(spark, [(("2", ), "", 7), (None, None, 7)], "meta struct<score: string>, dataset string, flat int", int_score="meta.score", score="flat.x", url=None).collect()
    assert [r.int_score for r in out] == [2, None]
    assert {r.score for r in out} == {None} and {r.dataset for r in out} == {"name"}


def test_order_of_reasons_and_missing_values(spark):
    p = Policy(min_words=2, min_chars=10, languages=("en",), minimums={"score": 1.0, "int_score": 3.0}, missing_policy="reject")
    rows = [("a", "en", 1.0, 3), ("a b", "en", 1.0, 3), ("aaaa bbbbbb", None, 1.0, 3), ("aaaa bbbbbb", "en", None, 3), ("aaaa bbbbbb", "en", float("nan"), 2), ("aaaa bbbbbb", "en", 1.0, 3)]
    df = normal(spark, rows, "text string, language string, score double, int_score bigint")
    assert [r.reason for r in filtering.judged(df, p).collect()] == ["too_few_words", "too_short_chars", "language", "missing_score", "min_int_score", None]
    assert filtering.accepted(df, p).count() == 1
    q = Policy(minimums={"int_score": 3.0})
    assert filtering.judged(normal(spark, [("a", None)], "text string, int_score bigint"), q).first().reason is None


def test_counters(spark):
    rows = [(f"document number {i} with enough words", "eng_Latn" if i % 2 == 0 else "fra_Latn", 20) for i in range(8)]
    df = filtering.judged(normal(spark, rows, "text string, language string, token_count bigint"), Policy(languages=("eng_Latn",), minimums={"token_count": 10}))
    r = metrics.by_file(df, "source_name").first()
    assert (r.rows_seen, r.accepted, r.rejected, r.estimated_tokens) == (8, 4, 4, 80)
    assert [tuple(x) for x in metrics.by_reason(df).collect()] == [("language", 4)]
    assert metrics.domain_rollup(df, "dataset", "source_name").count() == 3


def test_config(tmp_path, monkeypatch):
    monkeypatch.setenv("PLACE", "here")
    (tmp_path / "a.yaml").write_text("name: x\nsource: {path_prefix: $PLACE/$UNSET_NAME}\nfilters: {min_words: 3, min_score: 1, languages: [en], missing_policy: reject}\noutput: {path_prefix: out}\n")
    s = source_of(load(str(tmp_path / "a.yaml")), "try1")
    assert s.prefix == "here/$UNSET_NAME" and s.policy == Policy(3, languages=("en",), minimums={"score": 1}, missing_policy="reject") and s.output_prefix == "out/_smoke/try1"
    (tmp_path / "b.yaml").write_text("- 1\n")
    with pytest.raises(ValueError):
        load(str(tmp_path / "b.yaml"))
    with pytest.raises(RuntimeError):
        source_of({"name": "x", "enabled": False, "disabled_reason": "old"})
