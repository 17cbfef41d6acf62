"""Benchmark decontamination by Wu-Manber multi-pattern search.

Documents and items become words joined by single blanks, with a blank at both ends. Each window of an item is a pattern, from
blank to blank, so that a match begins and ends at word boundaries. For the patterns of like length a Matcher holds a block
shift table by hash: how far the search may jump when a block of bytes ends at the current place. Where the shift is 0, the block
(the last one of the patterns' common length) selects a bucket of patterns, and direct comparison confirms them.

Items are handled in blocks of at most `block_bytes` bytes of text, one at a time on the driver, so what is broadcast has a fixed
bound; with more blocks the documents pass the search several times, and their hits are carried along as a column. A worker builds
a block's index once.

Defined results: null or empty text has no words and no hits; items whose text is null or without words never occur; repeated
items with one id count once, and so do all items with a null id together, whose hits count like others; repeated documents are decided alike; an empty benchmark or document table works; extra columns pass.
"""

from __future__ import annotations

import math
import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, stored, without

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A-Z in lower case; digits, a-z and all bytes of characters beyond ASCII stay; the rest divides words.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WINDOW = 13


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def windows_of(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """Each window as a pattern."""
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(max(1, len(words) - size + 1))] if words else []


class Matcher:
    """Wu-Manber search for patterns whose least length is m."""

    def __init__(self, patterns: dict[bytes, tuple]) -> None:
        self.patterns, self.m = patterns, min(map(len, patterns))
        blocks = 2 * self.m * len(patterns)
        self.block = b = min(self.m, max(2, math.ceil(math.log(blocks, 4))))
        self.mask = (1 << min(22, max(12, blocks.bit_length()))) - 1
        self.jump = min(65535, self.m - b + 1)
        self.shift = array("H", [self.jump]) * (self.mask + 1)
        self.buckets: dict[bytes, list[bytes]] = {}
        for p in patterns:
            for end in range(max(b, self.m + 1 - self.jump), self.m + 1):
                k = hash(p[end - b : end]) & self.mask
                self.shift[k] = min(self.shift[k], self.m - end)
            self.buckets.setdefault(p[self.m - b : self.m], []).append(p)

    def find(self, text: bytes):
        """(start, pattern) of each occurrence, by start."""
        m, b, shift, mask, bucket = self.m, self.block, self.shift, self.mask, self.buckets.get
        end, n = m, len(text)
        while end <= n:
            block = text[end - b : end]
            step = shift[hash(block) & mask]
            if step:
                end += step
                continue
            start = end - m
            for p in bucket(block, ()):
                if text.startswith(p, start):
                    yield start, p
            end += 1


class Index:
    """All windows of a block of items."""

    def __init__(self, items: list[tuple[str | None, bytes]]) -> None:
        held: dict[bytes, tuple[int, tuple]] = {}  # of each pattern: its words, and the items that have it
        for name, text in items:
            words = words_of(text)
            own = (min(WINDOW, len(words)), (name,))
            for p in windows_of(words):
                old = held.setdefault(p, own)
                if name not in old[1]:
                    held[p] = (old[0], (*old[1], name))
        classes: dict[int, dict[bytes, tuple]] = {}
        for p, found in held.items():  # short patterns would shorten the jumps of long ones
            classes.setdefault(len(p).bit_length(), {})[p] = found
        self.matchers = [Matcher(c) for c in classes.values()]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Ranges of words that are hit, and the items."""
        text, ranges, items = b" " + b" ".join(words) + b" ", [], set()
        for matcher in self.matchers:
            at = word = 0
            for start, p in matcher.find(text):
                word += text.count(b" ", at, start)
                at = start
                size, names = matcher.patterns[p]
                ranges.append((word, word + size))
                items.update(names)
        return ranges, items


class Block:
    """The items of a block, as they are broadcast; a worker keeps it, and its index, between tasks."""

    def __init__(self, items: list[tuple[str | None, bytes]]) -> None:
        self.items, self.made = items, None

    def index(self) -> Index:
        if self.made is None:
            self.made = Index(self.items)
        return self.made


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _searcher(shared, text: str):
    """Adds to _n_words, _ranges and _items what the items of one block hit."""

    def run(batches):
        index = shared.value.index()
        for batch in batches:
            n_words, all_ranges, all_items = [], [], []
            old_r, old_i = batch.column("_ranges"), batch.column("_items")
            for k, raw in enumerate(batch.column(text).cast(pa.binary()).to_pylist()):
                words = words_of(raw)
                ranges, items = index.search(words)
                before = old_r[k].as_py() or []
                ranges = merged(ranges + list(zip(before[::2], before[1::2], strict=True)))
                n_words.append(len(words))
                all_ranges.append([x for r in ranges for x in r])
                all_items.append(sorted(items | set(old_i[k].as_py() or []), key=lambda i: (i is None, i)))
            new = {"_n_words": pa.array(n_words, pa.int64()), "_ranges": pa.array(all_ranges, pa.list_(pa.int64())), "_items": pa.array(all_items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in batch.schema.names], names=batch.schema.names)

    return run


def blocks_of(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> tuple[int, Iterator[list[tuple[str | None, bytes]]]]:
    """The number of blocks, and the items in blocks of about block_bytes / 2 bytes, each made from one hash range when it is due.
    One item alone may have more."""
    items = benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t"))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-2 * total // block_bytes) if total > block_bytes else 1
    parts = (items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect() for k in range(n))
    return n, ([(r.i, r.t.encode("utf-8", "surrogatepass")) for r in sorted(p, key=lambda r: (r.i is None, r.i, r.t))] for p in parts)


def search(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """docs with the added columns _n_words, _n_hit, _items (sorted ids as strings, then a null if an item without id is hit), _contaminated, _ranges."""
    spark = docs.sparkSession
    docs = without(docs, "_n_words", "_ranges", "_items", "_n_hit", "_contaminated")
    out = docs.select("*", F.lit(0).cast("long").alias("_n_words"), F.array().cast("array<long>").alias("_ranges"), F.array().cast("array<string>").alias("_items"))
    n, blocks = blocks_of(benchmark, item_id, item_text, block_bytes)
    for k, items in enumerate(blocks):
        schema, shared = T.StructType([T.StructField(f.name, f.dataType) for f in out.schema]), spark.sparkContext.broadcast(Block(items))
        out = out.mapInArrow(_searcher(shared, text), schema)
        if k + 1 < n:
            out = stored(out, "decontam")
            shared.unpersist()
    hit = F.aggregate(F.sequence(F.lit(0), F.size("_ranges") - 2, F.lit(2)), F.lit(0).cast("long"), lambda n, i: n + F.element_at("_ranges", i + 2) - F.element_at("_ranges", i + 1))
    out = out.withColumn("_n_hit", F.when(F.size("_ranges") > 0, hit).otherwise(F.lit(0).cast("long")))
    return out.withColumn("_contaminated", (F.col("_n_hit") > 0) & (20 * F.col("_n_hit") >= F.col("_n_words")))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"), F.size("_items").cast("long").alias("n_items"), F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"), F.col("_contaminated").alias("contaminated"))


SQL = r"""
WITH dw AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[i : i + least(13, len(ws)) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM iw WHERE len(ws) > 0)
), lengths AS (SELECT DISTINCT n FROM wins), places AS (
  SELECT r, n, i, array_to_string(ws[i : i + n - 1], ' ') AS w FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM dw, lengths WHERE len(ws) >= n)
), found AS (
  SELECT r, i, p.n, item_id FROM places p JOIN wins USING (n, w)
), hits AS (
  SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM found) GROUP BY r
), held AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM found) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN hits USING (r) LEFT JOIN held USING (r)
"""
