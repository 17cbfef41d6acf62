"""Source files: listing through Hadoop's file systems, ranges, row limits, offsets, and JSON documents beside the data."""

from __future__ import annotations

import fnmatch
import json
import re
import tempfile
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the one that driver and executors share, spark.checkpoint.dir. Only a local session may do without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{(base or f'file://{tempfile.gettempdir()}/checkpoints').rstrip('/')}/corpusmill/{label}-{uuid.uuid4().hex}"


def list_files(spark: SparkSession, root: str, prefix: str = "", pattern: str = "*.parquet") -> list[str]:
    """Paths below root, sorted, that are prefix or lie under it and whose path or name matches pattern; none is an error."""
    fs, base = _path(spark, root)
    start = str(fs.makeQualified(base)).rstrip("/")
    found, prefix = [], prefix.strip("/")
    todo = fs.listFiles(base, True)
    while todo.hasNext():
        full = str(todo.next().getPath())
        path = full[len(start) + 1 :]
        inside = not prefix or path == prefix or path.startswith(prefix + "/")
        if inside and (fnmatch.fnmatch(path, pattern) or fnmatch.fnmatch(path.rpartition("/")[2], pattern)):
            found.append(path)
    if not found:
        raise RuntimeError(f"no file under {root}/{prefix} matches {pattern}")
    return sorted(found)


def file_range(files: list[str], start: int = 0, most: int | None = None) -> list[tuple[int, str]]:
    """The files from start on, at most `most`, with their places in the whole list."""
    if start < 0:
        raise ValueError("the first file's number must be at least 0")
    if most is not None and most < 1:
        raise ValueError("at least one file must be asked for")
    stop = len(files) if most is None else start + most
    return list(enumerate(files))[start:stop]


def check_required(df: DataFrame, required: tuple[str, ...]) -> None:
    missing = [c for c in required if c.split(".")[0] not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {', '.join(missing)}")


#: Files whose places and offsets may be broadcast to the scan; more are joined by a shuffle.
MOST_BROADCAST = 100_000


def numbered(path: str) -> list:
    """A sort key for paths in which numbers count as numbers: file=2 comes before file=10."""
    return [(0, int(x), "") if x.isdecimal() else (1, 0, x) for x in re.split(r"([0-9]+)", path)]


def scan(spark: SparkSession, root: str, files: list[tuple[int, str]], first_rows: int | None = None, offsets: dict[str, int] | None = None) -> DataFrame:
    """The files' rows with file (its place), file_path and row (place in the file), which replace columns of those names; at most
    first_rows input rows of each file, beginning at its offset. Files that are not there are passed over."""
    base, paths = root.rstrip("/"), [f"{root.rstrip('/')}/{f}" for _, f in files]
    there = [x for x, path in zip(files, paths, strict=True) if exists(spark, path)]
    df = spark.read.parquet(*[f"{base}/{f}" for _, f in there])
    own = [f.name for f in df.schema if f.name.lower() not in ("file", "file_path", "row")]
    fs, top = _path(spark, root)
    start = str(fs.makeQualified(top)).rstrip("/") + "/"
    uri = {name: (place, (offsets or {}).get(name, 0), _path(spark, start + name)[1].toUri().toString()) for place, name in there}
    table = spark.createDataFrame([(u, name, place, at) for name, (place, at, u) in uri.items()], "_uri string, file_path string, file int, _from bigint")
    rows = df.select(*[F.col(f"`{c}`") for c in own], F.col("_metadata.file_path").alias("_uri"), F.col("_metadata.row_index").alias("row"))
    # Spark writes file URIs as file:/x or file:///x
    rows = rows.withColumn("_uri", F.regexp_replace("_uri", "^file:/+", "file:/"))
    table = table.withColumn("_uri", F.regexp_replace("_uri", "^file:/+", "file:/"))
    out = rows.join(F.broadcast(table) if len(there) <= MOST_BROADCAST else table, "_uri").drop("_uri")
    if first_rows is not None:
        out = out.where(F.col("row") < first_rows)
    return (out.where(F.col("row") >= F.col("_from")) if offsets else out).drop("_from")


def limit_per_file(df: DataFrame, first_rows: int | None = None, offsets: dict[str, int] | None = None, file: str = "file_path", row: str = "row") -> DataFrame:
    """Row numbers count from 0; the limit counts input rows, so it comes before the offset."""
    if first_rows is not None:
        df = df.where(F.col(row) < first_rows)
    if offsets:
        start = df.sparkSession.createDataFrame(list(offsets.items()), "_file string, _from bigint")
        start = F.broadcast(start) if len(offsets) <= MOST_BROADCAST else start
        df = df.join(start, F.col(file) == F.col("_file"), "left").where(F.col(row) >= F.coalesce("_from", F.lit(0))).drop("_file", "_from")
    return df


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.getFileStatus(p).isDirectory()


def read_json(spark: SparkSession, path: str) -> Any | None:
    """The document, or None where there is no such file."""
    if not exists(spark, path):
        return None
    return json.loads("\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect()))


def write_json(spark: SparkSession, path: str, data: Any) -> None:
    """Written beside its place and renamed over it where the file system can do so at once."""
    fs, p = _path(spark, path)
    _, part = _path(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    out.write(bytearray((json.dumps(data, indent=2, sort_keys=True, default=str) + "\n").encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(part, p, options)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What stands in a folder; nothing where there is none."""
    fs, p = _path(spark, folder)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def size(spark: SparkSession, path: str) -> int:
    fs, p = _path(spark, path)
    return fs.getFileStatus(p).getLen()


def glob_files(spark: SparkSession, root: str, pattern: str = "*.parquet", left_out: tuple[str, ...] = ("buffer.parquet",)) -> list[str]:
    """Files below root whose name matches pattern, in which only `*` stands for other text; without the buffer."""
    shape = re.compile(".*".join(re.escape(x) for x in pattern.split("*")) + r"\Z", re.S)
    return [f for f in list_files(spark, root, "", "*") if (name := f.rpartition("/")[2]) not in left_out and shape.match(name) and not name.startswith(("_", "."))]


def manifest_files(progress: dict | None, shards: str, remainder: str | None = None) -> list[str]:
    """Shards named by a finished progress document; shards is a pattern such as `x_shard_{:05d}.parquet`."""
    if not progress or not progress.get("finished"):
        raise RuntimeError("the source is not finished")
    count = progress.get("next_part", progress.get("next_shard", progress.get("total_shards", 0)))
    found = [shards.format(k) for k in range(count)] + ([remainder] if remainder else [])
    if not found:
        raise RuntimeError("the source has no shard")
    return found


def copy_if_present(spark: SparkSession, source: str, to: str) -> bool:
    fs, p = _path(spark, source)
    if not fs.exists(p):
        return False
    fs2, q = _path(spark, to)
    return spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, fs2, q, False, spark._jsc.hadoopConfiguration())


def field(df: DataFrame, path: str | None):
    """The column at a dotted path and its type; (None, None) where the path leads nowhere."""
    kind: T.DataType = df.schema
    column = None
    for part in path.split(".") if path else ():
        if not isinstance(kind, T.StructType) or part not in kind.names:
            return None, None
        kind = kind[part].dataType
        column = F.col(f"`{part}`") if column is None else column.getField(part)
    return column, kind if column is not None else None
