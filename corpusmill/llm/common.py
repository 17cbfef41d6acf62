"""What the operators of this subpackage share: reading tables, tables written in the shared folder, size-checked lookups and
connected components. Everything here is DataFrame code and keeps nothing of unbounded size on the driver."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A table of at most so many rows may be broadcast by lookup(); its rows are a few numbers wide.
BROADCAST_ROWS = 200_000
#: Keys with this part of all rows or more, of which there are at most 1 / HOT_PART, count as hot.
HOT_PART = 1 / 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session may do without that setting."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = f"file://{tempfile.gettempdir()}/checkpoints"
    return path.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/corpusmill/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """df, written as Parquet in the shared folder and read again: this cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, label: str, *measures: Column) -> tuple[DataFrame, Row]:
    """stored(df), with aggregates of its rows, observed while they are written, so that they take no job of their own."""
    seen = Observation(f"{label}-{uuid.uuid4().hex}")
    out = stored(df.observe(seen, *[m.alias(f"m{k}") for k, m in enumerate(measures)]), label)
    return out, Row(*[seen.get[f"m{k}"] for k in range(len(measures))])


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go as soon as it has ended, not when the driver happens to collect its garbage. For
    queries that are run once each, as stored() runs them: a DataFrame that is run again has its lost stages run again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def arrow_batches(spark: SparkSession, size: str) -> Iterator[None]:
    """Within it, jobs hand Python workers batches of about `size` (or of one row), so that long values do not add up in memory."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without columns whose names an operator uses for its own: those that it adds take their place."""
    return df.drop(*[c for c in df.columns if c.lower() in names])


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, UPPER, LOWER)


def lookup(left: DataFrame, table: DataFrame, on: str, weight: str, how: str = "left", rows: int = BROADCAST_ROWS, size: Row | None = None) -> DataFrame:
    """left joined with table, which has each key of `on` once; `weight` says how many rows of left may hold that key; `size` has
    the table's number of rows and sum of weights, if known.

    A table of at most `rows` rows is broadcast. Beyond that the hot keys, at most 1 / HOT_PART by their share of the weight,
    are broadcast and all other keys are joined by a shuffle, so that no task gets a hot key's rows.
    """
    n, total = size or table.agg(F.count("*"), F.sum(weight)).first()
    values = table.drop(weight)
    if n <= rows:
        return left.join(F.broadcast(values), on, how)
    limit = max(1, int((total or 0) * HOT_PART))
    hot = F.broadcast(table.where(F.col(weight) > limit).drop(weight))
    rest = table.where(F.col(weight) <= limit).drop(weight)
    if how in ("left_semi", "left_anti"):
        cold = left.join(hot.select(on), on, "left_anti").join(rest, on, how)
        return cold if how == "left_anti" else cold.unionByName(left.join(hot, on, how))
    return left.join(hot, on, "inner").unionByName(left.join(hot.select(on), on, "left_anti").join(rest, on, how))


def star(edges: DataFrame, label: str, steps: int | None = None) -> DataFrame:
    """Edges (a, b: bigint) contracted by alternating large-star and small-star steps, each written in the shared folder: at most
    `steps` of both, or until each node a of a component has one edge, to its least node b. Edges found later can be added."""
    mark = (F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")))
    now, after = measured(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label, *mark)
    before, done = None, 0
    while done != steps and after[0] and after != before:
        before, done = after, done + 1
        for large in (True, False):
            both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else now
            least, size = measured(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n")), label, F.count("*"), F.sum("n"))
            linked = lookup(both, least, "a", "n", "inner", size=size)
            out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            if not large:
                out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
            now, after = measured(out.where("a <> b").distinct(), label, *mark)
    return now


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of edges (a, b: bigint): node, component (its least node), for every node that has an edge to another one."""
    now = star(edges, label)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
