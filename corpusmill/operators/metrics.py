"""Counters of filter, mix and tokenizing runs as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counters() -> list[Column]:
    ok = F.col("reason").isNull()
    return [
        F.count("*").alias("rows_seen"), F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"),
        F.coalesce(F.sum(F.when(ok, F.col("estimated_tokens"))), F.lit(0)).cast("bigint").alias("estimated_tokens"),
    ]


def acceptance(df: DataFrame) -> DataFrame:
    return df.withColumn("acceptance_pct", F.when(F.col("rows_seen") > 0, 100.0 * F.col("accepted") / F.col("rows_seen")).otherwise(0.0))


def by_file(judged: DataFrame, file: str) -> DataFrame:
    return judged.groupBy(file).agg(*_counters())


def domain_rollup(judged: DataFrame, domain: str, file: str) -> DataFrame:
    """Counters of each file, each domain, and all: partial sums are merged by the aggregate itself."""
    return acceptance(judged.rollup(domain, file).agg(*_counters()))


def by_reason(judged: DataFrame) -> DataFrame:
    # accepted rows are left out after the count: as a filter before it, the rules would be run twice
    counted = judged.groupBy(F.col("reason").alias("_key")).agg(F.max("reason").alias("reason"), F.count("*").alias("n"))
    return counted.where("reason is not null").select("reason", "n")


def reason_map(judged: DataFrame, file: str) -> DataFrame:
    """One map of reasons and counts for each file."""
    counted = judged.where("reason is not null").groupBy(file, "reason").agg(F.count("*").alias("n"))
    return counted.groupBy(file).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n")))).alias("rejected_by_reason"))
