"""Line dedup over levelled sorted runs of line hashes, in DataFrame functions only.

Documents come in batches. A batch counts, for each of its line keys, the documents that hold it. A run is a table (key, n) that is
bucketed by key and sorted in each bucket, so that a new batch, shuffled once into the same buckets, meets every run by a merge
anti-join that neither shuffles nor sorts the run: keys that a run shows to be frequent are taken out, the rest is written as a new
run of level 0. Whenever a level has two runs they are compacted: merged by key, bucket by bucket, and written as one run of the next
level. The frequent keys are those whose counts over all runs reach `min_docs`; each document then loses the lines with such keys.

A key is 64 bits of hash. A rare line is lost only if its hash is that of a frequent line, so the chance is
(lines x frequent lines) / 2**64.

Defined results: null or empty text is one empty line; every row counts as a document, repeated rows too; a document that
loses all lines keeps an empty text; an empty table gives an empty result; other columns pass through clean() untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, lookup, read_table, scratch_path, stored, without

BLANKS = "\t\n\x0b\x0c\r "
#: Frequent keys looked up in an array literal of so many buckets, as long as there are no more than MAX_LITERAL of them.
BUCKETS, MAX_LITERAL = 256, 20_000


def line_keys(text: Column) -> Column:
    """The hash of each line's key, null for a key without a code point."""
    def key(line: Column) -> Column:
        bare = F.btrim(line, F.lit(BLANKS))
        return F.when(F.length(bare) >= 1, F.xxhash64(bare))
    return F.transform(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n", -1), key)


class Run(NamedTuple):
    """A run as it is on disk; all that a later session needs to go on with it."""

    level: int
    path: str
    buckets: int


@contextmanager
def _in_order(spark: SparkSession) -> Iterator[None]:
    """Within it, scans of buckets of one file each tell that they are sorted."""
    key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class LineRuns:
    """Runs in the shared folder. Batches are added with add(); `runs` of an earlier LineRuns can be given to go on with them."""

    def __init__(self, spark: SparkSession, min_docs: int, runs: list[Run] = ()) -> None:
        self.spark, self.min_docs = spark, min_docs
        self.runs = list(runs)

    def table(self, run: Run) -> DataFrame:
        """key, n of a run, known to Spark as bucketed and sorted by key."""
        name = "lines_" + run.path.rpartition("-")[2]
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (key BIGINT, n BIGINT) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {run.buckets} BUCKETS LOCATION '{run.path}'")
        return self.spark.table(name)

    def _written(self, counts: DataFrame, level: int) -> Run:
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        run = Run(level, scratch_path(self.spark, f"lines-level{level}"), buckets)
        with _in_order(self.spark):
            counts.write.format("parquet").option("compression", "zstd").option("path", run.path).bucketBy(buckets, "key").sortBy("key").saveAsTable("lines_" + run.path.rpartition("-")[2])
        return run

    def _merged(self, x: DataFrame, y: DataFrame) -> DataFrame:
        both = x.withColumnRenamed("n", "x").hint("merge").join(y.withColumnRenamed("n", "y"), "key", "full")
        return both.select("key", (F.coalesce("x", F.lit(0)) + F.coalesce("y", F.lit(0))).cast("long").alias("n"))

    def _dropped(self, run: Run) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS lines_{run.path.rpartition('-')[2]}")  # its files stay

    def new_counts(self, keys: DataFrame) -> DataFrame:
        """key, n of a batch (a row for each document and key), without the keys that some run shows to be frequent. A key that only
        the runs' sum shows goes on being counted."""
        counts = keys.groupBy("key").agg(F.count("*").alias("n"))
        for run in self.runs:
            counts = counts.hint("merge").join(self.table(run).where(F.col("n") >= self.min_docs).select("key"), "key", "left_anti")
        return counts

    def add_keys(self, keys: DataFrame) -> None:
        self.runs.append(self._written(self.new_counts(keys), 0))
        while len(self.runs) > 1 and self.runs[-1].level == self.runs[-2].level:
            y, x = self.runs.pop(), self.runs.pop()
            self.runs.append(self._written(self._merged(self.table(x), self.table(y)), x.level + 1))
            self._dropped(x)
            self._dropped(y)

    def add(self, docs: DataFrame, text: str = "text") -> None:
        """Adds a batch of documents."""
        self.add_keys(document_keys(docs, text))

    def frequent(self) -> DataFrame:
        """key, n for each key that at least min_docs documents hold."""
        out = self.table(self.runs[-1])
        for run in self.runs[-2::-1]:  # from small to large
            out = self._merged(out, self.table(run))
        return out.where(F.col("n") >= self.min_docs)


def document_keys(docs: DataFrame, text: str, *more: Column) -> DataFrame:
    """key, a row for each document and different key of its lines."""
    return docs.select(*more, F.explode(F.array_distinct(F.filter(line_keys(F.col(text)), lambda k: k.isNotNull()))).alias("key"))


def build_runs(docs: DataFrame, text: str = "text", min_docs: int = 10, batches: int = 3) -> LineRuns:
    """The runs of a table that is taken in batches by a hash of the text. Its keys are computed once, and kept by batch."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "lines-keys")
    keys = document_keys(docs, text, F.pmod(F.xxhash64(text), F.lit(batches)).cast("int").alias("batch"))
    keys.write.option("compression", "zstd").partitionBy("batch").parquet(path)
    keys, runs = spark.read.schema(keys.schema).parquet(path), LineRuns(spark, min_docs)
    for b in range(batches):
        runs.add_keys(keys.where(F.col("batch") == b).select("key"))
    return runs


def clean(docs: DataFrame, text: str = "text", min_docs: int = 10, batches: int = 3) -> DataFrame:
    """docs with the added columns _kept (text), _n_lines, _n_dropped."""
    docs = without(docs, "_kept", "_n_lines", "_n_dropped", "_pairs", "_keep", "_row", "_gone")
    runs = build_runs(docs.select(text), text, min_docs, batches)
    with _in_order(docs.sparkSession):
        frequent = stored(runs.frequent(), "lines-frequent")
    n, most = frequent.agg(F.count("*"), F.max("n")).first()
    lines, keys = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), line_keys(F.col(text))
    if n <= MAX_LITERAL:
        gone = _literal_test(docs.sparkSession, frequent)
        pairs = F.arrays_zip(lines.alias("line"), keys.alias("key"))
        out = docs.withColumn("_pairs", pairs).withColumn("_keep", F.filter("_pairs", lambda p: ~F.coalesce(gone(p["key"]), F.lit(False))))
        return out.select(*docs.columns, F.array_join(F.transform("_keep", lambda p: p["line"]), "\n").alias("_kept"), F.size("_pairs").cast("long").alias("_n_lines"), (F.size("_pairs") - F.size("_keep")).cast("long").alias("_n_dropped"))
    # too many frequent keys for a literal: each document's frequent keys are found by joins and brought back by its row
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "lines-rows")
    held = rows.select("_row", F.explode(F.array_distinct(line_keys(F.col(text)))).alias("key")).where("key is not null")
    gone_by_row = lookup(held, frequent, "key", "n", "left_semi", rows=0).groupBy("_row").agg(F.collect_set("key").alias("_gone"))
    out = rows.join(gone_by_row, "_row", "left").withColumn("_pairs", F.arrays_zip(lines.alias("line"), keys.alias("key")))
    out = out.withColumn("_keep", F.filter("_pairs", lambda p: ~F.coalesce(F.array_contains("_gone", p["key"]), F.lit(False))))
    return out.select(*docs.columns, F.array_join(F.transform("_keep", lambda p: p["line"]), "\n").alias("_kept"), F.size("_pairs").cast("long").alias("_n_lines"), (F.size("_pairs") - F.size("_keep")).cast("long").alias("_n_dropped"))


def _literal_test(spark: SparkSession, frequent: DataFrame):
    """A test whether a hash is among the frequent keys: an array of BUCKETS small arrays, a constant of the plan. Its size was
    checked; it holds at most MAX_LITERAL numbers."""
    groups: dict[int, list[int]] = {}
    for (key,) in frequent.select("key").toLocalIterator():
        groups.setdefault(key % BUCKETS, []).append(key)
    text = ",".join("array({})".format(",".join(f"{k}L" if k > -(2**63) else "(-9223372036854775807L - 1L)" for k in sorted(groups.get(b, [])))) if groups.get(b) else "cast(array() as array<bigint>)" for b in range(BUCKETS))
    table = F.expr(f"array({text})")
    return lambda key: F.array_contains(F.element_at(table, (F.pmod(key, F.lit(BUCKETS)) + 1).cast("int")), key)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean(docs).select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("_kept", 256).alias("kept_sha256"))


SQL = """
WITH split AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, r, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE f.key IS NOT NULL)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key GROUP BY r, doc_id
"""
