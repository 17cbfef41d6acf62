"""From raw documents to a training mix: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir), docs having the columns of `documents` (doc_id, text, lang, source, n_chars), and
returns a DataFrame that is written as Parquet and read again as the next one's docs. All but the last return those columns.
Nulls in any column, empty texts, repeated rows and empty tables pass as the operators define; extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import decontam, jaccard, langid, line_dedup, mixing
from corpusmill.llm.common import lookup, read_table, scratch_path, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language (no text, no letter, or two codewords that are equally near) go."""
    docs = docs.select(*COLUMNS)
    found = langid.identify(docs, langid.train(docs))
    return found.where((F.col("_lang_pred") != "und") & ~F.col("_ambiguous")).select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 documents go from every document; the documents stay, with what is left of them."""
    found = line_dedup.clean(docs.select(*COLUMNS))
    return found.select("doc_id", F.col("_kept").alias("text"), "lang", "source", F.length("_kept").cast("long").alias("n_chars"))


def _row_key() -> Column:
    """A text for each row, all different, that sorts by doc_id (nulls last), then by a hash of the row, then by its place."""
    at = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(2**63)).cast("long"))), 16, "0")
    return F.concat(F.coalesce(F.concat(F.lit("0"), at), F.lit("1")), F.lpad(F.hex(F.xxhash64("text", "lang", "source", "n_chars")), 16, "0"), F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows one stays, that with the smallest doc_id, of several with it any. A null doc_id is the largest."""
    rows = stored(docs.select(*COLUMNS, _row_key().alias("_row")), "pipeline-rows")  # so that the keys stay as they are
    gone = jaccard.join(rows, "_row").where("doc_id <> component_id").select(F.col("doc_id").alias("_row"), F.lit(1).alias("_n"))
    return lookup(rows, stored(gone, "pipeline-gone"), "_row", "_n", "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up at least a twentieth go."""
    found = decontam.search(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("_contaminated")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy of a document that is taken, with its number, size, and its source's target."""
    docs = docs.select(*COLUMNS)
    table, made = mixing.mix(docs)
    sized = docs.withColumn("size", mixing.word_count("text")).withColumn("k", mixing.source_key())
    taken = mixing.decided(sized, made).where(F.col("copies") > 0)
    return taken.select(*COLUMNS, "size", "target", "copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup_stage),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs


#: Language ID is a trained model, which SQL cannot express.
ORACLE_SQL = None
