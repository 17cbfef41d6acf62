"""Interleaving sources in batches so that their token shares follow the weights, up to a token budget.

Taking, again and again, a whole batch of the source that has the least (tokens so far / weight) is the same as sorting all
batches by (tokens of the source's earlier batches / weight, tie rank): within a source that key only grows. So the order of
batches is a window sum, a sort and a running total. Running totals are taken at two levels, in buckets of the key and over the
buckets' sums, so that no task orders all batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.config import Mix

BUCKETS = 256


def row_tokens() -> Column:
    return F.greatest(F.lit(1), F.coalesce("estimated_tokens", "token_count", F.rint(F.col("word_count") * F.lit(1.3)).cast("bigint"), F.lit(1)))


def numbered(docs: DataFrame, batch_rows: int, row: str = "row") -> DataFrame:
    """docs (source, file, row) with batch_id; a batch never crosses a file."""
    return docs.withColumn("batch_id", F.floor(F.col(row) / batch_rows).cast("bigint"))


def batches(docs: DataFrame) -> DataFrame:
    """source, file, batch_id, n_rows, tokens. A batch's tokens are the sum of the estimates; without any, of the counts; without
    any, of estimates from the words; at least 1."""
    total = F.coalesce(F.sum("estimated_tokens"), F.sum("token_count"), F.sum(row_tokens()))
    return docs.groupBy("source", "file", "batch_id").agg(F.count("*").alias("n_rows"), F.greatest(F.lit(1), total).cast("bigint").alias("tokens"))


def _table(spark: SparkSession, mix: Mix) -> DataFrame:
    caps = {n: None if mix.target_tokens is None else int(mix.target_tokens * w) for n, w in mix.shares.items()}
    rows = [(n, w, mix.ranks[n], caps[n]) for n, w in mix.shares.items()]
    return spark.createDataFrame(rows, "source string, weight double, tie int, cap bigint")


def running(df: DataFrame, value: str, order: list[Column], bucket: Column, name: str) -> DataFrame:
    """df with the exclusive running total of value in the given order; bucket must grow with that order."""
    at = df.withColumn("_bucket", bucket)
    sums = at.groupBy("_bucket").agg(F.sum(value).alias("_sum"))
    before = sums.select("_bucket", F.coalesce(F.sum("_sum").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum(value).over(Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return at.join(F.broadcast(before), "_bucket").withColumn(name, (inside + F.col("_before")).cast("bigint")).drop("_bucket", "_before")


def schedule(made: DataFrame, mix: Mix, cursors: dict[str, dict] | None = None) -> DataFrame:
    """The batches taken: source, file, batch_id, n_rows, tokens, key, tie, before (tokens of all batches taken earlier),
    rows_before. cursors (of each source: the file and batch_id taken last, tokens and rows so far) make it go on after an earlier
    schedule: as a source's key only grows, taking on is sorting what is left by the keys that it then has."""
    earlier = Window.partitionBy("source").orderBy("file", "batch_id").rowsBetween(Window.unboundedPreceding, -1)
    spark, given = made.sparkSession, cursors or {}
    from_ = spark.createDataFrame([(n, c["file"], c["batch_id"], c["tokens"]) for n, c in given.items() if c.get("tokens")], "source string, _file long, _batch long, _given long")
    if given:
        made = made.join(F.broadcast(from_), "source", "left").where(F.coalesce(F.struct("file", "batch_id") > F.struct(F.col("_file").cast(made.schema["file"].dataType).alias("file"), F.col("_batch").alias("batch_id")), F.lit(True)))
    else:
        made = made.withColumn("_given", F.lit(None).cast("long"))
    at = made.join(F.broadcast(_table(spark, mix)), "source").withColumn("cum", F.coalesce("_given", F.lit(0)) + F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    if mix.target_tokens is not None:
        at = at.where(F.col("cum") < F.col("cap"))
    at = at.withColumn("key", F.col("cum") / F.col("weight"))
    top = at.agg(F.max("key")).first()[0] or 0.0
    bucket = F.least(F.lit(BUCKETS - 1), F.floor(F.col("key") / F.lit(top + 1.0) * BUCKETS)).cast("int")
    order = [F.col("key"), F.col("tie")]
    out = running(running(at, "tokens", order, bucket, "before"), "n_rows", order, bucket, "rows_before")
    if given:
        tokens, rows = (sum(c.get(k, 0) for c in given.values()) for k in ("tokens", "rows"))
        out = out.withColumn("before", F.col("before") + tokens).withColumn("rows_before", F.col("rows_before") + rows)
    if mix.target_tokens is not None:
        out = out.where(F.col("before") < mix.target_tokens)
    if mix.limit_rows is not None:
        out = out.where(F.col("rows_before") < mix.limit_rows)
    return out.select("source", "file", "batch_id", "n_rows", "tokens", "key", "tie", "before", "rows_before", "weight")


def check_budget(taken: DataFrame, mix: Mix) -> int:
    """Tokens taken; less than the target is an error that names the sources."""
    total = taken.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("bigint")).first()[0]
    if mix.target_tokens is not None and mix.limit_rows is None and total < mix.target_tokens:
        raise RuntimeError(f"{total} of {mix.target_tokens} tokens: all sources are exhausted ({', '.join(sorted(mix.shares))})")
    return total


def output(docs: DataFrame, taken: DataFrame, mix: Mix, row: str = "row") -> DataFrame:
    """The rows of the batches taken, with batch_pos (order of the batch), row_in_batch, and the mix's columns."""
    place = Window.partitionBy("source", "file", "batch_id").orderBy(row)
    joined = docs.join(taken.select("source", "file", "batch_id", "before", "rows_before", "weight"), ["source", "file", "batch_id"])
    out = joined.withColumn("row_in_batch", F.row_number().over(place).cast("bigint") - 1)
    if mix.limit_rows is not None:
        out = out.where(F.col("rows_before") + F.col("row_in_batch") < mix.limit_rows)
    return out.withColumn("source_name", F.col("source")).withColumn("mix_name", F.lit(mix.name)).withColumn("mix_weight", F.col("weight")).withColumn("position", F.col("rows_before") + F.col("row_in_batch"))


def report(taken: DataFrame, mix: Mix) -> DataFrame:
    """Rows, tokens and shares in per cent of each source of the mix."""
    sums = taken.groupBy("source").agg(F.sum("n_rows").alias("r"), F.sum("tokens").alias("t"))
    every = _table(taken.sparkSession, mix).join(sums, "source", "left")
    tokens = F.coalesce("t", F.lit(0)).cast("bigint")
    total = F.sum(tokens).over(Window.partitionBy())
    return every.select("source", F.coalesce("r", F.lit(0)).cast("bigint").alias("n_rows"), tokens.alias("tokens"), F.when(total > 0, 100.0 * tokens / total).otherwise(0.0).alias("actual_pct"), (F.col("weight") * 100.0).alias("target_pct"))


def next_source(emitted: DataFrame, mix: Mix) -> DataFrame:
    """The source to take from, given source, tokens, exhausted: the least token debt among those that may still give."""
    at = emitted.join(F.broadcast(_table(emitted.sparkSession, mix)), "source").where(~F.col("exhausted"))
    if mix.target_tokens is not None:
        at = at.where(F.col("tokens") < F.col("cap"))
    return at.agg(F.min(F.struct(F.col("tokens") / F.col("weight"), "tie", "source")).alias("least")).select(F.col("least.source").alias("source"))
