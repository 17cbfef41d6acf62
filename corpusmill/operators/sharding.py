"""Cutting ordered rows into parts by an estimate of their size, and writing shards."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import write_json

#: What a row counts besides its text's bytes.
ROW_BYTES = 256
#: Positions whose running total is taken in one task.
RANGE = 1 << 20


def staging_parts(docs: DataFrame, file: str, row: str, target_bytes: int, most_rows: int, text: str = "text") -> DataFrame:
    """file, row, part: a part closes when its estimated bytes reach the target or it has most_rows rows; the count then begins
    anew, which no window expresses. One file's rows, three numbers each, are ordered in a task."""

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(row, kind="stable")
        part, held, rows, parts = 0, 0, 0, []
        for size in pdf["size"]:
            parts.append(part)
            held, rows = held + size, rows + 1
            if held >= target_bytes or rows >= most_rows:
                part, held, rows = part + 1, 0, 0
        return pdf.assign(part=np.array(parts, np.int64))[[file, row, "part"]]

    sized = docs.select(file, row, (F.octet_length(F.coalesce(text, F.lit(""))) + ROW_BYTES).cast("bigint").alias("size"))
    kinds = dict(sized.dtypes)
    return sized.groupBy(file).applyInPandas(cut, f"{file} {kinds[file]}, {row} {kinds[row]}, part bigint")


def write_parts(docs: DataFrame, parts: DataFrame, file: str, row: str, path: str, level: int = 6) -> None:
    """The rows as zstd Parquet, a folder for each file and part, in order."""
    joined = docs.join(parts, [file, row])
    joined.repartition(file, "part").sortWithinPartitions(file, "part", row).write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).partitionBy(file, "part").mode("errorifexists").parquet(path)


def shard_of(docs: DataFrame, order: Column, target_bytes: int, most_rows: int | None = None, text: str = "text") -> DataFrame:
    """docs (with position, 0.. without gaps, in that order) with shard: a shard ends where the estimated bytes before it reach the
    next multiple of the target, or most_rows rows are full. Running totals are taken in ranges of positions and over their sums."""
    bucket = F.floor(F.col("position") / RANGE)
    sized = docs.withColumn("_size", (F.octet_length(F.coalesce(text, F.lit(""))) + ROW_BYTES).cast("bigint")).withColumn("_range", bucket)
    sums = sized.groupBy("_range").agg(F.sum("_size").alias("_sum"))
    before = sums.select("_range", F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("_size").over(Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_bytes = F.floor((inside + F.col("_before")) / target_bytes)
    out = sized.join(before, "_range").withColumn("shard", (F.greatest(by_bytes, F.floor(F.col("position") / most_rows)) if most_rows else by_bytes).cast("int"))
    return out.drop("_size", "_range", "_before")


def write_shards(docs: DataFrame, path: str, level: int = 3) -> None:
    """Rows with shard and position: a folder for each shard, its rows in order in one file."""
    out = docs.repartition("shard").sortWithinPartitions("shard", "position")
    out.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).partitionBy("shard").mode("errorifexists").parquet(path)


def write_token_shards(pieces: DataFrame, folder: str, dtype: str, shard: int, prefix: str = "train", manifest: dict | None = None) -> list[tuple[str, int]]:
    """pieces (shard_id, shard_offset, ids) as little-endian binary files; full shards are named by number, the remainder is
    buffer.bin. A shard's pieces arrive in order and are appended batch by batch. Files are written under a name of their own attempt
    and renamed; the manifest comes last. folder must be shared."""

    def put(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        now, out, part, done, rows = None, None, "", 0, []

        def close() -> None:
            if out is not None:
                out.close()
                name = f"{prefix}_shard_{now:05d}.bin" if done == shard else "buffer.bin"
                store.move(part, f"{base}/{name}")
                rows.append((name, done))

        for batch in batches:
            ids = batch.column("ids")
            flat, ends = ids.flatten().to_numpy(zero_copy_only=False), np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))
            shards = batch.column("shard_id").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if now != int(shards[a]):
                    close()
                    now, done = int(shards[a]), 0
                    part = f"{base}/{prefix}_{now}.{uuid.uuid4().hex}.part"
                    out = store.open_output_stream(part)
                some = flat[ends[a - 1] if a else 0 : ends[b - 1]].astype("<u2" if dtype == "uint16" else "<u4")
                out.write(some.tobytes())
                done += len(some)
        close()
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in rows], pa.string()), pa.array([k for _, k in rows], pa.int64())], names=["name", "n_tokens"])

    ordered = pieces.select("shard_id", "shard_offset", "ids").repartition("shard_id").sortWithinPartitions("shard_id", "shard_offset")
    rows = sorted(tuple(r) for r in ordered.mapInArrow(put, "name string, n_tokens bigint").collect())
    files = [r for r in rows if r[0] != "buffer.bin"]
    write_json(pieces.sparkSession, f"{folder}/manifest.json", {"finished": True, **(manifest or {}), "dtype": dtype, "shard": shard, "next_part": len(files), "files": dict(rows)})
    return rows
