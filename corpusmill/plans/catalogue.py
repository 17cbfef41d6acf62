"""Queries over the driver's tables by name, and the SQL that they must agree with.

`documents` with `labels` is the filter's input: its `source` column plays the source file, doc_id the row order. Mixes take
documents, pages, conversations and benchmark as sources, in small batches so that several are needed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.schema import COLUMNS, align
from ..operators import filtering, metrics, mixing, sharding, tokenizing
from ..sources import checkpoint, files
from ..sources.config import Mix, MixSource, Policy, Source, stable_id, tie_value
from ..streaming import filtering as streaming
from . import runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD = r"[^\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
SOURCE = Source("corpus", "repo/corpus", None, "train", columns={"id": "doc_id", "language": "lang", "dataset": "source", "score": "quality", "int_score": "quality"}, required=("text", "doc_id"))
POLICY = Policy(min_words=60, max_words=2000, min_chars=300, max_chars=12000, languages=("en", "fr"), minimums={"int_score": 1.0, "estimated_tokens": 100.0}, missing_policy="reject")
MIX = Mix("blend", (MixSource("documents", 0.4), MixSource("pages", 0.3), MixSource("conversations", 0.2), MixSource("benchmark", 0.1)), 60_000, 42, 8)
OPEN_MIX = Mix("all", MIX.sources, None, 42, 8, 300)
WHOLE_MIX = Mix("whole", MIX.sources, None, 42, 8)
#: The tokenizer's own limits; a text is cut only beyond HARD ids, which tests/test_tokenizing.py tries.
HARD, CHUNK, SHARD, IO = 65_536, 8_192, 10_000, 777


def _query(name: str, sql: str | None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return table(spark, sf_dir, "documents").join(labels, "doc_id", "left")


def normal(spark: SparkSession, sf_dir: str, source: Source = SOURCE) -> DataFrame:
    return filtering.normalize(raw(spark, sf_dir), source, keep=("doc_id", "source"))


def judged(spark: SparkSession, sf_dir: str, policy: Policy = POLICY) -> DataFrame:
    return filtering.judged(normal(spark, sf_dir), policy)


NORM_SQL = f"""
WITH norm AS (
  SELECT d.doc_id, d.source, coalesce(text, '') AS text, d.doc_id::VARCHAR AS id, NULL::VARCHAR AS url, lang AS language, coalesce(nullif(d.source, ''), 'corpus') AS dataset,
    'corpus' AS source_name, 'repo/corpus' AS source_repo, NULL::VARCHAR AS source_config, 'train' AS source_split, NULL::DOUBLE AS language_score, NULL::DOUBLE AS fasttext_score,
    quality::DOUBLE AS score, NULL::BIGINT AS answer_count, NULL::VARCHAR AS accepted_answer_id, quality::BIGINT AS int_score, NULL::BIGINT AS token_count,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS word_count, length(coalesce(text, ''))::BIGINT AS char_count,
    greatest(1, round_even(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) * 1.3::DOUBLE, 0)::BIGINT) AS estimated_tokens,
    NULL::VARCHAR AS mix_name, NULL::DOUBLE AS mix_weight
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""


def reason_sql(p: Policy) -> str:
    """The CASE of a policy, written out for DuckDB."""
    rules = ["WHEN word_count = 0 THEN 'empty_text'"]
    rules += [f"WHEN {c} {op} {v} THEN '{n}'" for v, c, op, n in ((p.min_words, "word_count", "<", "too_few_words"), (p.max_words, "word_count", ">", "too_many_words"), (p.min_chars, "char_count", "<", "too_short_chars"), (p.max_chars, "char_count", ">", "too_long_chars")) if v is not None]
    if p.languages:
        rules.append(f"WHEN language IS NULL OR language NOT IN ({', '.join(repr(x) for x in p.languages)}) THEN 'language'")
    for name, v in p.minimums.items():
        if p.missing_policy == "reject":
            rules.append(f"WHEN {name} IS NULL THEN 'missing_{name}'")
        rules.append(f"WHEN {name} < {v} THEN 'min_{name}'")
    return f"CASE {' '.join(rules)} END"


def judged_sql(p: Policy = POLICY) -> str:
    return f"{NORM_SQL}, judged AS (SELECT *, {reason_sql(p)} AS reason FROM norm)"


ALL = ", ".join(n for n, _ in COLUMNS)
COUNTERS = "count(*) AS rows_seen, count(*) FILTER (WHERE reason IS NULL) AS accepted, count(*) FILTER (WHERE reason IS NOT NULL) AS rejected, coalesce(sum(estimated_tokens) FILTER (WHERE reason IS NULL), 0)::BIGINT AS estimated_tokens"


@_query("text_metrics", f"{NORM_SQL} SELECT doc_id, word_count, char_count, estimated_tokens FROM norm")
def text_metrics(spark, sf_dir):
    return normal(spark, sf_dir).select("doc_id", "word_count", "char_count", "estimated_tokens")


@_query("normalize_documents", f"{NORM_SQL} SELECT {ALL} FROM norm")
def normalize_documents(spark, sf_dir):
    return normal(spark, sf_dir).drop("doc_id", "source")


@_query("normalize_nested", "SELECT event_id, CASE WHEN regexp_full_match(props->>'$.k', '[+-]?[0-9]+') THEN try_cast(props->>'$.k' AS BIGINT) END AS int_score, NULL::BIGINT AS answer_count FROM events")
def normalize_nested(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("p", F.from_json("props", "k string"))
    nested = Source("events", columns={"text": "event_type", "id": "event_id", "int_score": "p.k", "answer_count": "event_type.k"})
    return filtering.normalize(events, nested, keep=("event_id",)).select("event_id", "int_score", "answer_count")


@_query("coerce_numeric", r"SELECT event_id, try_cast(value::VARCHAR AS DOUBLE) AS as_float, CASE WHEN regexp_full_match(round(value, 0)::BIGINT::VARCHAR, '\s*[+-]?\d+\s*') THEN round(value, 0)::BIGINT END AS as_int, trunc(value)::BIGINT AS truncated, NULL::BIGINT AS from_text FROM events")
def coerce_numeric(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    text = F.col("value").cast("string")
    whole = F.round("value", 0).cast("bigint").cast("string")
    return e.select("event_id", X.as_float(text, T.StringType()).alias("as_float"), X.as_int(whole, T.StringType()).alias("as_int"), X.as_int(F.col("value"), T.DoubleType()).alias("truncated"), X.as_int(F.concat(F.lit("x"), whole), T.StringType()).alias("from_text"))


@_query("dataset_fallback", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR doc_id % 3 = 1 THEN 'corpus' ELSE source END AS dataset FROM documents")
def dataset_fallback(spark, sf_dir):
    blank = raw(spark, sf_dir).withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).when(F.col("doc_id") % 3 == 1, "").otherwise(F.col("source")))
    return filtering.normalize(blank, SOURCE, keep=("doc_id",)).select("doc_id", "dataset")


@_query("filter_accepted", f"{judged_sql()} SELECT {ALL} FROM judged WHERE reason IS NULL")
def filter_accepted(spark, sf_dir):
    return filtering.accepted(normal(spark, sf_dir), POLICY).drop("doc_id", "source")


@_query("filter_reasons", f"{judged_sql()} SELECT doc_id, reason FROM judged")
def filter_reasons(spark, sf_dir):
    return judged(spark, sf_dir).select("doc_id", "reason")


@_query("rejected_by_reason", f"{judged_sql()} SELECT reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY reason")
def rejected_by_reason(spark, sf_dir):
    return metrics.by_reason(judged(spark, sf_dir))


def _rule(name: str, policy: Policy) -> None:
    @_query(name, f"{judged_sql(policy)} SELECT doc_id, reason FROM judged WHERE reason IS NOT NULL")
    def rejected(spark, sf_dir):
        return judged(spark, sf_dir, policy).where("reason is not null").select("doc_id", "reason")


_rule("filter_words", Policy(min_words=75, max_words=1000))
_rule("filter_chars", Policy(min_chars=400, max_chars=5000))
_rule("filter_language", Policy(languages=("en",)))
_rule("filter_numeric", Policy(minimums={"score": 1.0, "int_score": 1.0, "estimated_tokens": 256.0}))
_rule("missing_ignore", Policy(minimums={"int_score": 1.0}, missing_policy="ignore"))
_rule("missing_reject", Policy(minimums={"int_score": 1.0}, missing_policy="reject"))


@_query("file_summary", f"{judged_sql()} SELECT source, {COUNTERS} FROM judged GROUP BY source")
def file_summary(spark, sf_dir):
    return metrics.by_file(judged(spark, sf_dir), "source")


@_query("domain_rollup", f"{judged_sql()} SELECT language, source, {COUNTERS}, CASE WHEN count(*) > 0 THEN 100.0::DOUBLE * count(*) FILTER (WHERE reason IS NULL) / count(*) ELSE 0.0 END AS acceptance_pct FROM judged GROUP BY ROLLUP (language, source)")
def domain_rollup(spark, sf_dir):
    return metrics.domain_rollup(judged(spark, sf_dir), "language", "source")


@_query("reason_maps", f"{judged_sql()} SELECT source, string_agg(reason || '=' || n, ',' ORDER BY reason) AS reasons FROM (SELECT source, reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY ALL) GROUP BY source")
def reason_maps(spark, sf_dir):
    made = metrics.reason_map(judged(spark, sf_dir), "source")
    return made.select("source", F.array_join(F.transform(F.map_entries("rejected_by_reason"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("reasons"))


def by_row(docs: DataFrame, file: str = "source", order: str = "doc_id") -> DataFrame:
    """docs with row, the place in the file."""
    from pyspark.sql import Window

    return docs.withColumn("row", F.row_number().over(Window.partitionBy(file).orderBy(order)) - 1)


@_query("file_range", "SELECT doc_id FROM documents WHERE source IN (SELECT source FROM (SELECT DISTINCT source FROM documents) ORDER BY source LIMIT 5 OFFSET 3)")
def file_range(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    names = sorted(r.source for r in docs.select("source").distinct().collect())
    return docs.where(F.col("source").isin([f for _, f in files.file_range(names, 3, 5)])).select("doc_id")


@_query("row_limit_per_file", "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 7")
def row_limit_per_file(spark, sf_dir):
    docs = by_row(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return files.limit_per_file(docs, 7, file="source").select("doc_id", "source")


@_query("resume_offset", "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) > CASE source WHEN 'src0' THEN 20 WHEN 'src7' THEN 5 ELSE 0 END")
def resume_offset(spark, sf_dir):
    docs = by_row(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return files.limit_per_file(docs, None, {"src0": 20, "src7": 5}, file="source").select("doc_id", "source")


@_query("resume_antijoin", "SELECT DISTINCT source FROM documents WHERE source NOT IN ('src1', 'src3')")
def resume_antijoin(spark, sf_dir):
    done = spark.createDataFrame([("src1", True), ("src3", True), ("src4", False)], "source string, finished boolean")
    return checkpoint.remaining(table(spark, sf_dir, "documents").select("source").distinct(), done, "source")


@_query("append_only_check", "SELECT source, source <> 'src2' AS append_only, CASE WHEN source IN ('src2', 'src5') THEN 1 ELSE 0 END::BIGINT AS new_files FROM (SELECT DISTINCT source FROM documents)")
def append_only_check(spark, sf_dir):
    named = table(spark, sf_dir, "documents").select("source").distinct()
    saved = named.select("source", F.array(F.lit("a"), F.lit("b")).alias("files"))
    now = named.select("source", F.when(F.col("source") == "src2", F.array(F.lit("b"), F.lit("a"), F.lit("c"))).when(F.col("source") == "src5", F.array(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("files"))
    return checkpoint.appended(saved, now)


@_query(
    "staging_roll",
    """WITH RECURSIVE s AS (
  SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r, strlen(coalesce(text, '')) + 256 AS size FROM documents
), roll AS (
  SELECT source, doc_id, r, 0::BIGINT AS part, size AS held, 1 AS n FROM s WHERE r = 1
  UNION ALL
  SELECT s.source, s.doc_id, s.r, CASE WHEN held >= 20000 OR n >= 30 THEN part + 1 ELSE part END, CASE WHEN held >= 20000 OR n >= 30 THEN s.size ELSE held + s.size END, CASE WHEN held >= 20000 OR n >= 30 THEN 1 ELSE n + 1 END
  FROM roll JOIN s ON s.source = roll.source AND s.r = roll.r + 1
) SELECT source, doc_id, part FROM roll""",
)
def staging_roll(spark, sf_dir):
    return sharding.staging_parts(table(spark, sf_dir, "documents"), "source", "doc_id", 20_000, 30)


@_query("shard_names", "SELECT doc_id, printf('%s_shard_%05d.parquet', source, doc_id // 100) AS name FROM documents")
def shard_names(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.shard_name(F.col("source"), F.floor(F.col("doc_id") / 100)).alias("name"))


@_query("stable_ids", "SELECT doc_id, substr(sha256(coalesce(text, '')), 1, 12) AS stable_id FROM documents")
def stable_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.stable_id(F.coalesce("text", F.lit(""))).alias("stable_id"))


@_query("file_keys", r"SELECT page_id, replace(replace(url, '/', '__'), '\', '__') AS file_key FROM pages")
def file_keys(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.file_key(F.col("url")).alias("file_key"))


@_query("schema_align", f"SELECT {', '.join('p.' + n if n in ('url',) else 'page_id::VARCHAR AS id' if n == 'id' else 'html AS text' if n == 'text' else 'page_id::DOUBLE AS score' if n == 'score' else f'NULL::{ {'string': 'VARCHAR', 'double': 'DOUBLE', 'bigint': 'BIGINT'}[k.simpleString()]} AS {n}' for n, k in COLUMNS)} FROM pages p")
def schema_align(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url", F.col("html").alias("text"), F.col("page_id").cast("string").alias("score"), F.array(F.lit(1)).alias("int_score"))
    return align(pages)


def mix_input(spark: SparkSession, sf_dir: str, mix: Mix) -> DataFrame:
    """The sources' rows: source, file, row, text and its measures."""
    parts = [
        table(spark, sf_dir, "documents").select(F.lit("documents").alias("source"), F.col("source").alias("file"), F.col("doc_id").alias("k"), F.lit(0).cast("bigint").alias("k2"), "text"),
        table(spark, sf_dir, "pages").select(F.lit("pages").alias("source"), F.lit("p").alias("file"), F.col("page_id").alias("k"), F.lit(0).cast("bigint").alias("k2"), F.col("html").alias("text")),
        table(spark, sf_dir, "conversations").select(F.lit("conversations").alias("source"), F.lit("c").alias("file"), F.col("conv_id").alias("k"), F.col("turn").alias("k2"), "text"),
        table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("source"), F.lit("b").alias("file"), F.col("item_id").alias("k"), F.lit(0).cast("bigint").alias("k2"), "text"),
    ]
    from functools import reduce

    from pyspark.sql import Window

    docs = reduce(DataFrame.unionByName, parts).withColumn("word_count", X.word_count(F.coalesce("text", F.lit("")))).withColumn("token_count", F.lit(None).cast("bigint"))
    docs = docs.withColumn("estimated_tokens", X.estimated_tokens(F.col("token_count"), F.col("word_count")))
    docs = docs.withColumn("row", F.row_number().over(Window.partitionBy("source", "file").orderBy("k", "k2")) - 1)
    return mixing.numbered(docs, mix.batch_rows)


def mix_sql(mix: Mix) -> str:
    values = ", ".join(f"('{n}', {w!r}::DOUBLE, {mix.ranks[n]}, {int(mix.target_tokens * w) if mix.target_tokens else 'NULL'}::BIGINT)" for n, w in mix.shares.items())
    conditions = [*(["cum < cap"] if mix.target_tokens else [])]
    cut = " AND ".join([*([f"before < {mix.target_tokens}"] if mix.target_tokens else []), *([f"rows_before < {mix.limit_rows}"] if mix.limit_rows else []), "true"])
    return f"""
WITH raw AS (
  SELECT 'documents' AS source, source AS file, doc_id AS k, 0 AS k2, text FROM documents UNION ALL SELECT 'pages', 'p', page_id, 0, html FROM pages
  UNION ALL SELECT 'conversations', 'c', conv_id, turn, text FROM conversations UNION ALL SELECT 'benchmark', 'b', item_id, 0, text FROM benchmark
), docs AS (
  SELECT source, file, k, k2, greatest(1, round_even(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) * 1.3::DOUBLE, 0)::BIGINT) AS est, row_number() OVER (PARTITION BY source, file ORDER BY k, k2) - 1 AS row FROM raw
), batches AS (
  SELECT source, file, row // {mix.batch_rows} AS batch_id, count(*) AS n_rows, greatest(1, sum(est))::BIGINT AS tokens FROM docs GROUP BY ALL
), w(source, weight, tie, cap) AS (VALUES {values}),
cums AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY file, batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS cum FROM batches JOIN w USING (source)
), kept AS (SELECT *, cum::DOUBLE / weight AS key FROM cums WHERE {' AND '.join(conditions) or 'true'}
), pos AS (
  SELECT *, coalesce(sum(tokens) OVER o, 0)::BIGINT AS before, coalesce(sum(n_rows) OVER o, 0)::BIGINT AS rows_before FROM kept WINDOW o AS (ORDER BY key, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), taken AS (SELECT * FROM pos WHERE {cut})"""


@_query("mix_batches", f"{mix_sql(MIX)} SELECT source, file, batch_id, n_rows, tokens FROM batches")
def mix_batches(spark, sf_dir):
    return mixing.batches(mix_input(spark, sf_dir, MIX))


@_query("mix_schedule", f"{mix_sql(MIX)} SELECT source, file, batch_id, n_rows, tokens, before, rows_before FROM taken")
def mix_schedule(spark, sf_dir):
    made = mix_batches(spark, sf_dir).persist()  # a row for each batch, that several passes read
    return mixing.schedule(made, MIX).select("source", "file", "batch_id", "n_rows", "tokens", "before", "rows_before")


@_query("mix_report", f"{mix_sql(MIX)}, g AS (SELECT source, sum(n_rows)::BIGINT AS r, sum(tokens)::BIGINT AS t FROM taken GROUP BY source) SELECT w.source, coalesce(r, 0)::BIGINT AS n_rows, coalesce(t, 0)::BIGINT AS tokens, 100.0::DOUBLE * coalesce(t, 0) / (SELECT sum(t)::BIGINT FROM g) AS actual_pct, weight * 100.0::DOUBLE AS target_pct FROM w LEFT JOIN g USING (source)")
def mix_report(spark, sf_dir):
    return mixing.report(mixing.schedule(mix_batches(spark, sf_dir).persist(), MIX), MIX)


def _mix_output(spark, sf_dir, mix):
    docs = mix_input(spark, sf_dir, mix).drop("text").persist()  # a few numbers a row, that several passes read
    out = mixing.output(docs, mixing.schedule(mixing.batches(docs), mix), mix)
    return out.select("position", "source_name", "file", "k", "k2", "estimated_tokens", "mix_name", "mix_weight")


def _mix_output_sql(mix: Mix) -> str:
    limit = f"WHERE rows_before + row - batch_id * {mix.batch_rows} < {mix.limit_rows}" if mix.limit_rows else ""
    return f"{mix_sql(mix)} SELECT (rows_before + row - batch_id * {mix.batch_rows})::BIGINT AS position, t.source AS source_name, t.file, k, k2, est AS estimated_tokens, '{mix.name}' AS mix_name, weight AS mix_weight FROM docs d JOIN taken t ON t.source = d.source AND t.file = d.file AND t.batch_id = d.row // {mix.batch_rows} {limit}"


@_query("mix_output", _mix_output_sql(MIX))
def mix_output(spark, sf_dir):
    return _mix_output(spark, sf_dir, MIX)


@_query("mix_row_limit", _mix_output_sql(OPEN_MIX))
def mix_row_limit(spark, sf_dir):
    return _mix_output(spark, sf_dir, OPEN_MIX)


@_query("mix_whole", _mix_output_sql(WHOLE_MIX))
def mix_whole(spark, sf_dir):
    return _mix_output(spark, sf_dir, WHOLE_MIX)


@_query("mix_next_source", f"WITH w(source, weight, tie) AS (VALUES {', '.join(f'({chr(39)}{n}{chr(39)}, {w!r}::DOUBLE, {MIX.ranks[n]})' for n, w in MIX.shares.items())}), e AS (SELECT 'documents' AS source, count(*) AS t FROM documents UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'conversations', count(*) FROM conversations) SELECT source FROM e JOIN w USING (source) ORDER BY t / weight, tie LIMIT 1")
def mix_next_source(spark, sf_dir):
    from functools import reduce

    counts = [table(spark, sf_dir, n).agg(F.count("*").alias("tokens")).select(F.lit(n).alias("source"), "tokens", F.lit(False).alias("exhausted")) for n in ("documents", "pages", "conversations")]
    return mixing.next_source(reduce(DataFrame.unionByName, counts), Mix(MIX.name, MIX.sources, 10**15, MIX.seed))


EOS = 65535


TOKEN_SQL = f"""
WITH words AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS row, regexp_extract_all(text, '{WORD}') AS ws FROM documents WHERE length(text) > 10
), ids AS (
  SELECT doc_id, source, row, list_transform(ws[1:{HARD}], lambda w: (('0x' || substr(md5(w), 1, 4))::BIGINT % 65535)::INTEGER) AS ids FROM words
), streams AS (
  SELECT *, len(ids)::BIGINT AS n_ids, flatten(list_transform(range(0, ((len(ids) + {CHUNK - 1}) // {CHUNK})::BIGINT), lambda i: list_concat(ids[i * {CHUNK} + 1 : i * {CHUNK} + {CHUNK}], [{EOS}]))) AS stream FROM ids
), sized AS (SELECT *, len(stream)::BIGINT AS length FROM streams),
placed AS (
  SELECT *, coalesce(sum(length) OVER (ORDER BY source, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM sized
), flat AS (
  SELECT unnest(stream) AS id, unnest(range(start, start + length)) AS pos FROM placed
), files AS (SELECT source, min(start) AS s, max(start + length) AS e FROM placed GROUP BY source HAVING max(start + length) > min(start)),
parts AS (
  SELECT greatest(s, k * {SHARD}) AS low, least(e, (k + 1) * {SHARD}) AS high FROM (SELECT s, e, unnest(range(s // {SHARD}, (e - 1) // {SHARD} + 1)) AS k FROM files)
)"""


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return tokenizing.streams(docs, tokenizing.word_hash_ids(F.col("text")), EOS, HARD, CHUNK).drop("text")


@_query("token_counts", f"{TOKEN_SQL} SELECT doc_id, n_ids, length, list_sum(stream)::BIGINT AS id_sum FROM sized")
def token_counts(spark, sf_dir):
    return encoded(spark, sf_dir).select("doc_id", "n_ids", "length", F.aggregate("stream", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"))


@_query("token_chunks", f"{TOKEN_SQL} SELECT doc_id, array_to_string(stream, ' ') AS stream FROM sized")
def token_chunks(spark, sf_dir):
    return encoded(spark, sf_dir).select("doc_id", F.array_join(F.col("stream").cast("array<string>"), " ").alias("stream"))


@_query("token_counters", f"{TOKEN_SQL} SELECT (SELECT count(*) FROM documents) AS rows_seen, count(*) AS valid_rows, (SELECT count(*) FROM documents WHERE text IS NULL OR length(text) <= 10) AS skipped_rows, sum(length)::BIGINT AS tokens FROM sized")
def token_counters(spark, sf_dir):
    return tokenizing.counters(table(spark, sf_dir, "documents"), encoded(spark, sf_dir))


@_query("token_shards", f"{TOKEN_SQL} SELECT doc_id, k::BIGINT AS shard_id, (greatest(start, k * {SHARD}) - k * {SHARD})::BIGINT AS shard_offset, (least(start + length, (k + 1) * {SHARD}) - greatest(start, k * {SHARD}))::BIGINT AS n FROM (SELECT *, unnest(range(start // {SHARD}, (start + length - 1) // {SHARD} + 1)) AS k FROM placed WHERE length > 0)")
def token_shards(spark, sf_dir):
    at = tokenizing.placed(encoded(spark, sf_dir), "source", "doc_id")
    return tokenizing.pieces(at, SHARD).select("doc_id", "shard_id", "shard_offset", F.size("ids").cast("bigint").alias("n"))


@_query("token_shard_sums", f"{TOKEN_SQL} SELECT (pos // {SHARD})::BIGINT AS shard_id, count(*) AS n_tokens, sum(id)::BIGINT AS id_sum, count(*) = {SHARD} AS \"full\" FROM flat GROUP BY 1")
def token_shard_sums(spark, sf_dir):
    parts = tokenizing.pieces(tokenizing.placed(encoded(spark, sf_dir), "source", "doc_id"), SHARD)
    ids = F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x)
    sums = parts.groupBy("shard_id").agg(F.sum(F.size("ids")).cast("bigint").alias("n_tokens"), F.sum(ids).alias("id_sum"))
    return sums.withColumn("full", F.col("n_tokens") == SHARD)


@_query("token_budget", f"{TOKEN_SQL}, t AS (SELECT coalesce(max(least(high, low + ceil((50000 - low) / {IO}::DOUBLE)::BIGINT * {IO})), 0)::BIGINT AS tokens FROM parts WHERE low < 50000) SELECT tokens, tokens // {SHARD} AS shards, tokens % {SHARD} AS buffer, tokens >= 50000 AS reached FROM t")
def token_budget(spark, sf_dir):
    return tokenizing.budget(tokenizing.placed(encoded(spark, sf_dir), "source", "doc_id"), SHARD, IO, 50_000, "source")


RUN = {
    "stage": 1, "name": "run", "source": {"path_prefix": "documents.parquet"}, "required_columns": ["text"],
    "columns": {"id": "doc_id", "language": "lang", "dataset": "source", "language_score": "n_chars", "fasttext_score": "doc_id", "answer_count": "n_chars", "token_count": "n_chars", "score": "doc_id"},
    "filters": {"min_words": 20, "languages": ["en", "de", "fr"], "min_language_score": 150, "min_fasttext_score": 3, "min_answer_count": 160, "min_token_count": 170, "min_score": 4, "min_estimated_tokens": 180, "missing_policy": "reject"},
}
RUN_SQL = f"""
WITH d AS (
  SELECT doc_id, text, lang, coalesce(nullif(source, ''), 'run') AS dataset, n_chars, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS word_count FROM documents
), run AS (
  SELECT *, coalesce(nullif(n_chars, 0), greatest(1, round_even(word_count * 1.3::DOUBLE, 0)::BIGINT)) AS estimated_tokens FROM d
), kept AS (
  SELECT * FROM run WHERE word_count >= 20 AND lang IN ('en', 'de', 'fr') AND n_chars >= 170 AND doc_id >= 4 AND estimated_tokens >= 180
)"""


def _run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """A filter run over the files of `documents`, through listing, scan and commits: its counters, and its folder."""
    out = files.scratch(spark, "run")
    return runs.run_filter(spark, RUN, sf_dir, out), f"{out}/run"


@_query("run_accepted", f"{RUN_SQL} SELECT doc_id::VARCHAR AS id, dataset, language_score, fasttext_score, answer_count, token_count, word_count::BIGINT AS word_count, estimated_tokens FROM (SELECT *, n_chars::DOUBLE AS language_score, doc_id::DOUBLE AS fasttext_score, n_chars AS answer_count, n_chars AS token_count FROM kept)")
def run_accepted(spark, sf_dir):
    return runs.filtered(spark, _run(spark, sf_dir)[1]).select("id", "dataset", "language_score", "fasttext_score", "answer_count", "token_count", "word_count", "estimated_tokens")


@_query("run_counters", f"{RUN_SQL} SELECT (SELECT count(*) FROM run) AS rows_seen, (SELECT count(*) FROM kept) AS accepted, (SELECT count(*) FROM run) - (SELECT count(*) FROM kept) AS rejected, (SELECT coalesce(sum(estimated_tokens), 0) FROM kept)::BIGINT AS estimated_tokens")
def run_counters(spark, sf_dir):
    return _run(spark, sf_dir)[0].agg(*[F.sum(c).alias(c) for c in ("rows_seen", "accepted", "rejected", "estimated_tokens")])


@_query("streaming_filter", f"{judged_sql(Policy(min_words=60, languages=('en',)))} SELECT {ALL} FROM (SELECT * REPLACE (NULL::DOUBLE AS score, NULL::BIGINT AS int_score) FROM judged) WHERE reason IS NULL")
def streaming_filter(spark, sf_dir):
    source = Source(**{**SOURCE.__dict__, "policy": Policy(min_words=60, languages=("en",))})
    run = files.scratch(spark, "stream")
    schema = table(spark, sf_dir, "documents").schema
    # the table is one file or a folder of files
    folder, pattern = (f"{sf_dir}/documents.parquet", "*.parquet") if files.is_folder(spark, f"{sf_dir}/documents.parquet") else (sf_dir, "documents.parquet")
    streaming.start(spark, folder, schema, source, f"{run}/out", f"{run}/state", pattern).awaitTermination()
    return align(spark.read.schema(align(spark.createDataFrame([], schema)).schema).parquet(f"{run}/out"))
