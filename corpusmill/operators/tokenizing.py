"""Token streams in exact-size shards.

A text of more than 10 characters is encoded, cut to a hard limit and split into chunks, each followed by the end token. All
streams in order of (file, row) form one stream that is cut into shards of exactly `shard` tokens; what is left is the buffer.
Offsets are running sums at two levels: over the files' totals, and within each file.
"""

from __future__ import annotations

from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import words

MIN_CHARS = 10


class Tokenizer(Protocol):
    eos_id: int
    max_id: int

    def encode(self, texts: list[str]) -> list[list[int]]: ...


def dtype_of(max_id: int, eos_id: int) -> str:
    """The narrowest type for ids; an end token that does not fit is an error."""
    if max_id < 0:
        raise ValueError("the vocabulary is empty")
    kind = "uint16" if max_id <= 0xFFFF else "uint32"
    if not 0 <= eos_id <= (0xFFFF if kind == "uint16" else 0xFFFFFFFF):
        raise ValueError("the end token does not fit the ids' type")
    return kind


class FileTokenizer:
    """A public tokenizer from a local `tokenizers` JSON file; loaded once in each worker."""

    def __init__(self, path: str, eos: str) -> None:
        self.path, self._made = path, None
        eos_id = self._load().token_to_id(eos)
        if eos_id is None:
            raise ValueError(f"the vocabulary has no token {eos}")
        self.eos_id, self.max_id = eos_id, max(self._load().get_vocab().values())

    def _load(self):
        if self._made is None:
            from tokenizers import Tokenizer as Made

            self._made = Made.from_file(self.path)
        return self._made

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_made": None}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._load().encode_batch(texts, add_special_tokens=False)]


def word_hash_ids(text: Column) -> Column:
    """Stand-in tokenizer inside the JVM: a word's id is from its MD5, below 65535, which is the end token."""
    return F.transform(words(text), lambda w: (F.conv(F.substring(F.md5(w), 1, 4), 16, 10).cast("int") % 65535).cast("int"))


def with_tokenizer(text: Column, tokenizer: Tokenizer) -> Column:
    @F.pandas_udf("array<int>")
    def encode(column: pd.Series) -> pd.Series:
        return pd.Series(tokenizer.encode(column.tolist()), dtype=object)

    return encode(text)


def valid(text: Column) -> Column:
    return F.coalesce(F.length(text) > MIN_CHARS, F.lit(False))


def chunked(ids: Column, chunk: int, eos: int) -> Column:
    """The ids in chunks, each followed by eos; nothing for no ids."""
    n = F.ceil(F.size(ids) / chunk).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.slice(ids, i * chunk + 1, F.lit(chunk)), F.array(F.lit(eos))))
    return F.when(F.size(ids) > 0, F.flatten(pieces)).otherwise(F.array().cast("array<int>"))


def streams(docs: DataFrame, ids: Column, eos: int, hard: int = 65536, chunk: int = 8192) -> DataFrame:
    """docs that are valid, with n_ids, stream, and its length."""
    out = docs.where(valid(F.col("text"))).withColumn("_ids", F.slice(ids, 1, hard))
    out = out.withColumn("n_ids", F.size("_ids").cast("bigint")).withColumn("stream", chunked(F.col("_ids"), chunk, eos))
    return out.withColumn("length", F.size("stream").cast("bigint")).drop("_ids")


def counters(docs: DataFrame, encoded: DataFrame) -> DataFrame:
    rows = docs.agg(F.count("*").alias("rows_seen"), F.count_if(valid(F.col("text"))).alias("valid_rows"), F.count_if(~valid(F.col("text"))).alias("skipped_rows"))
    return rows.crossJoin(encoded.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("tokens")))  # one row each


def placed(encoded: DataFrame, file: str = "file", row: str = "row") -> DataFrame:
    """encoded with start, its offset in the whole stream."""
    totals = encoded.groupBy(file).agg(F.sum("length").alias("t"))
    before = totals.select(file, F.coalesce(F.sum("t").over(Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("file_start"))
    inside = F.coalesce(F.sum("length").over(Window.partitionBy(file).orderBy(row).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return encoded.join(before, file).withColumn("start", (F.col("file_start") + inside).cast("bigint"))


def pieces(at: DataFrame, shard: int) -> DataFrame:
    """Each document's part in each shard: shard_id, shard_offset, ids."""
    some = at.where("length > 0").withColumn("shard_id", F.explode(F.sequence(F.floor(F.col("start") / shard), F.floor((F.col("start") + F.col("length") - 1) / shard))))
    low = F.greatest(F.col("start"), F.col("shard_id") * shard)
    high = F.least(F.col("start") + F.col("length"), (F.col("shard_id") + 1) * shard)
    return some.withColumn("shard_offset", (low - F.col("shard_id") * shard).cast("bigint")).withColumn("ids", F.slice("stream", (low - F.col("start") + 1).cast("int"), (high - low).cast("int"))).drop("stream")


def shard_sums(at: DataFrame, shard: int) -> DataFrame:
    made = pieces(at, shard).groupBy("shard_id").agg(F.sum(F.size("ids")).cast("bigint").alias("n_tokens"), F.count("*").alias("n_docs"))
    return made.withColumn("full", F.col("n_tokens") == shard)


def budget(at: DataFrame, shard: int, io_chunk: int, target: int, file: str = "file") -> DataFrame:
    """Tokens written under a target. It is looked at before each I/O chunk; chunks begin anew with each file and each shard."""
    files = at.groupBy(file).agg(F.min("start").alias("s"), F.max(F.col("start") + F.col("length")).alias("e")).where("e > s")
    part = files.withColumn("k", F.explode(F.sequence(F.floor(F.col("s") / shard), F.floor((F.col("e") - 1) / shard))))
    low, high = F.greatest("s", F.col("k") * shard), F.least("e", (F.col("k") + 1) * shard)
    part = part.select(low.alias("low"), high.alias("high")).where(F.col("low") < target)
    stop = F.least("high", F.col("low") + F.ceil((F.lit(target) - F.col("low")) / io_chunk) * io_chunk)
    total = F.coalesce(F.max(stop), F.lit(0)).cast("bigint")
    return part.agg(total.alias("tokens")).select("tokens", F.floor(F.col("tokens") / shard).cast("bigint").alias("shards"), (F.col("tokens") % shard).cast("bigint").alias("buffer"), (F.col("tokens") >= target).alias("reached"))
