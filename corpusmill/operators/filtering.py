"""Normalising records and deciding on them: one projection, and one ordered CASE whose first true branch is the reason."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.schema import COLUMNS
from ..sources.config import NUMERIC, Policy, Source
from ..sources.files import field


def normalize(df: DataFrame, source: Source, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of the fixed schema, after those named in keep. A column that is not there is null."""

    def mapped(name: str, make):
        column, kind = field(df, source.columns.get(name, name))
        return make(column, kind) if column is not None else None

    kinds = dict(COLUMNS)
    makers = {"string": X.as_string, "double": X.as_float, "bigint": X.as_int}
    value: dict[str, Column] = {}
    for name in ("text", "id", "url", "language", "dataset", "language_score", "fasttext_score", "score", "answer_count", "accepted_answer_id", "int_score", "token_count"):
        kind = kinds[name].simpleString()
        found = mapped(name, makers[kind])
        value[name] = F.lit(None).cast(kind) if found is None else found
    value["text"] = F.coalesce(value["text"], F.lit(""))
    value["dataset"] = F.coalesce(F.nullif(value["dataset"], F.lit("")), F.lit(source.name))
    for name, constant in (("source_name", source.name), ("source_repo", source.repo), ("source_config", source.config), ("source_split", source.split)):
        value[name] = F.lit(constant).cast("string")
    first = df.select(*keep, *[c.alias(n) for n, c in value.items()])
    n_words = X.word_count(F.col("text"))
    counted = first.withColumn("word_count", n_words).withColumn("char_count", X.char_count(F.col("text")))
    counted = counted.withColumn("estimated_tokens", X.estimated_tokens(F.col("token_count"), F.col("word_count")))
    return counted.select(*keep, *[n if n in counted.columns else F.lit(None).cast(k).alias(n) for n, k in COLUMNS])


def reason(policy: Policy, of: Callable[[str], Column] = F.col) -> Column:
    """Null for an accepted document, else why it is rejected. The order of the rules is part of the result. `of` gives a column's value."""
    rules: list[tuple[Column, str]] = [(of("word_count") == 0, "empty_text")]
    for bound, column, name, below in (
        (policy.min_words, "word_count", "too_few_words", True),
        (policy.max_words, "word_count", "too_many_words", False),
        (policy.min_chars, "char_count", "too_short_chars", True),
        (policy.max_chars, "char_count", "too_long_chars", False),
    ):
        if bound is not None:
            rules.append((of(column) < bound if below else of(column) > bound, name))
    if policy.languages:
        rules.append((~F.coalesce(of("language").isin(*policy.languages), F.lit(False)), "language"))
    for name in NUMERIC:
        least = policy.minimums.get(name)
        if least is not None:
            if policy.missing_policy == "reject":
                rules.append((of(name).isNull(), f"missing_{name}"))
            rules.append((of(name) < least, f"min_{name}"))
    out = F.when(*[rules[0][0], F.lit(rules[0][1])])
    for test, name in rules[1:]:
        out = out.when(test, name)
    return out


def judgement(policy: Policy) -> Column:
    """reason(policy) with each measure of the text taken once: the rules read a bound value, not the expression behind a column,
    which Catalyst would otherwise write out for each rule when it moves a filter."""
    used = ("word_count", "char_count", "language", *NUMERIC)
    return F.element_at(F.transform(F.array(F.struct(*used)), lambda x: F.struct(reason(policy, lambda name: x[name]).alias("reason"))), 1)["reason"]


def judged(df: DataFrame, policy: Policy) -> DataFrame:
    return df.withColumn("reason", judgement(policy))


def accepted(df: DataFrame, policy: Policy) -> DataFrame:
    """The accepted documents. Rules that look at no text are also given as plain conditions, which come first and reach the scan."""
    out = df
    if policy.languages:
        out = out.where(F.col("language").isin(*policy.languages))
    if policy.missing_policy == "reject":
        for name, least in policy.minimums.items():
            out = out.where(F.col(name) >= least)
    return out.where(judgement(policy).isNull())
