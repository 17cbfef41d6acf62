"""Resumable runs of the three stages. Each writes new data under a name of its own and then commits, by one document, what counts;
stopped between any two writes, it goes on from the last commit, and the data are the same as without the stop."""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import COLUMNS, OUTPUT, align
from ..functions.text import shard_name
from ..operators import filtering, metrics, mixing, sharding, tokenizing
from ..sources import checkpoint, config, files
from ..sources.checkpoint import Ledger, State

#: A filter run commits after so many files, or so many bytes of them; a staging part's bytes and rows.
COMMIT_FILES, COMMIT_BYTES = 64, 64 << 30
MIX_VERSION = TOKENIZE_VERSION = 1
MB = 1 << 20


def filtered(spark: SparkSession, out: str) -> DataFrame:
    """The accepted documents that a filter run has committed: file (the source file's place), and the columns of the schema."""
    state = Ledger(spark, f"{out}/_state").load() or {"commits": []}
    schema = T.StructType([*OUTPUT.fields, T.StructField("file", T.IntegerType())])
    paths = [f"{out}/data/{c['name']}" for c in state["commits"]]
    return reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(p) for p in paths]) if paths else spark.createDataFrame([], schema)


def run_filter(spark: SparkSession, data: dict, root: str, output: str, start: int = 0, most: int | None = None, rows: int | None = None, run_id: str | None = None, dry: bool = False, resume: bool = True, commit_files: int = COMMIT_FILES, commit_bytes: int = COMMIT_BYTES) -> DataFrame:
    """Filters the files that are not done yet, some at a time, each time committing accepted rows, counters and progress together.
    Returns the counters of all files done (dry: the files that would be taken). A run with a row limit marks no file as done."""
    source = config.source_of(data, run_id)
    out = f"{output}/{source.output_prefix or source.name}"
    ledger, found = Ledger(spark, f"{out}/_state"), files.list_files(spark, root, source.prefix, source.pattern)
    state = ledger.load()
    checkpoint.may_start(resume, state is not None, not resume and bool(files.names(spark, f"{out}/data")))
    state = state or {"commits": [], "counters": {}, "progress": {}, "done": [], "finished": False, "config": config.stable_id(data)}
    if state["config"] != config.stable_id(data):
        raise RuntimeError("the checkpoint was made for another configuration")
    done = set(state["done"])
    chosen = [x for x in files.file_range(found, start, most) if x[1] not in done]
    if dry:
        return spark.createDataFrame(chosen, "file int, file_path string")
    checkpoint.check_parts(spark, f"{out}/data", [c["name"] for c in state["commits"]])
    group, pending = [], 0
    for k, one in enumerate(chosen):
        group.append(one)
        pending += files.size(spark, f"{root.rstrip('/')}/{one[1]}")
        if not checkpoint.should_commit(pending, commit_bytes, k == len(chosen) - 1, len(group), commit_files):
            continue
        name = f"commit-{uuid.uuid4().hex}"
        df = files.scan(spark, root, group, rows)
        files.check_required(df, source.required)
        judged = filtering.judged(filtering.normalize(df, source, keep=("file", "file_path", "row")), source.policy)
        counted = judged.withColumn("kept", F.col("reason").isNull())
        accepted = counted.where("kept").select("file", "row", *[n for n, _ in COLUMNS])
        accepted.repartition("file", F.floor(F.col("row") / 250_000)).sortWithinPartitions("file", "row").drop("row").write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", 6).partitionBy("file").parquet(f"{out}/data/{name}")
        counters = [r.asDict() for r in metrics.by_file(judged, "file_path").collect()]  # a row for each file of the group
        seen = {c["file_path"] for c in counters}
        counters += [{"file_path": f, "rows_seen": 0, "accepted": 0, "rejected": 0, "estimated_tokens": 0} for _, f in group if f not in seen]
        done |= {f for _, f in group} if rows is None else set()
        state["commits"].append({"name": name, "files": [f for _, f in group]})
        state["counters"] |= {c["file_path"]: {k: v for k, v in c.items() if k != "file_path"} for c in counters}
        state |= {"progress": checkpoint.folded(state["progress"], counters, found), "done": sorted(done), "finished": done >= set(found), "updated_at": time.time()}
        ledger.commit(state)
        group, pending = [], 0
    return spark.createDataFrame([(f, *(c[k] for k in ("rows_seen", "accepted", "rejected", "estimated_tokens"))) for f, c in sorted(state["counters"].items())], "file_path string, rows_seen long, accepted long, rejected long, estimated_tokens long")


def source_files(spark: SparkSession, root: str, name: str) -> list[str]:
    """The committed files of a finished filter run, in the order of its source files; an unfinished or empty one is an error."""
    state = Ledger(spark, f"{root}/{name}/_state").load()
    files.manifest_files({**(state or {}), "next_part": len((state or {}).get("commits", []))}, "{}")
    listed = {c["name"] for c in state["commits"]}
    found = [f for f in files.list_files(spark, f"{root}/{name}/data") if f.partition("/")[0] in listed]
    return sorted(found, key=lambda f: files.numbered(f.partition("/")[2]))


def run_mix(spark: SparkSession, data: dict, root: str, output: str, dry: bool = False, resume: bool = True) -> DataFrame:
    """Mixes the finished filter runs below root; returns the report of what this run added (dry: of what it would add). A later run
    goes on where the sources have got new files, and never changes what is there."""
    mix, rules = config.mix_of(data), data.get("output") or {}
    out = f"{output}/{mix.name}"
    listed = {name: source_files(spark, root, name) for name in mix.shares}
    settings = config.stable_id({"version": MIX_VERSION, "config": data})
    now = State(checkpoint.config_hash(MIX_VERSION, data, {}, listed), listed, settings, version=MIX_VERSION, updated_at=time.time())
    ledger = Ledger(spark, f"{out}/_state")
    held = ledger.load()
    checkpoint.may_start(resume, held is not None, not resume and bool(files.names(spark, f"{out}/data")))
    commits, position = (held["commits"], held["rows"]) if held else ([], 0)
    state = checkpoint.extended(State(**held["state"]), now) if held else now
    parts = []
    for name, paths in listed.items():
        df = files.scan(spark, f"{root}/{name}/data", list(enumerate(paths)))
        parts.append(align(df.withColumnRenamed("file", "_file"), keep=("_file", "row")).withColumnRenamed("_file", "file").withColumn("source", F.lit(name)))
    docs = mixing.numbered(reduce(DataFrame.unionByName, parts), mix.batch_rows)
    made = mixing.batches(docs).persist()
    try:
        taken = mixing.schedule(made, mix, state.cursors).persist()
        report = mixing.report(taken, mix)
        if dry:
            return spark.createDataFrame(report.collect(), report.schema)
        checkpoint.check_parts(spark, f"{out}/data", [c["name"] for c in commits])
        last = taken.groupBy("source").agg(F.max(F.struct("file", "batch_id")).alias("at"), F.sum("tokens").alias("tokens"), F.sum("n_rows").alias("rows")).collect()
        name = f"commit-{uuid.uuid4().hex}"
        rows = mixing.output(docs, taken, mix).select("position", *[n for n, _ in COLUMNS])
        base = commits[-1]["next_shard"] if commits else 0
        shards = sharding.shard_of(rows.withColumn("position", F.col("position") - position), F.col("position"), int(rules.get("target_shard_size_mb", 1024)) * MB, rules.get("max_documents"))
        sharding.write_shards(shards.withColumn("shard", F.col("shard") + base).withColumn("position", F.col("position") + position), f"{out}/data/{name}", 3)
        written = spark.read.schema(shards.schema).parquet(f"{out}/data/{name}").groupBy("shard").agg(F.count("*").alias("rows")).orderBy("shard").select(shard_name(mix.name, F.col("shard")).alias("name"), F.concat(F.lit(f"data/{name}/shard="), "shard").alias("path"), "rows").collect()
        for r in last:
            was = state.cursors.get(r["source"], {})
            state.cursors[r["source"]] = {"file": r["at"]["file"], "batch_id": r["at"]["batch_id"], "tokens": was.get("tokens", 0) + r["tokens"], "rows": was.get("rows", 0) + r["rows"], "exhausted": False}
        rest = {r["source"]: r["n"] for r in made.groupBy("source").agg(F.count("*").alias("n")).collect()}
        used = {r["source"]: r["n"] for r in taken.groupBy("source").agg(F.count("*").alias("n")).collect()}
        for source, cursor in state.cursors.items():
            cursor["batches"] = cursor.get("batches", 0) + used.get(source, 0)
            cursor["exhausted"] = cursor["batches"] >= rest.get(source, 0)
        tokens = sum(c["tokens"] for c in state.cursors.values())
        state.finished = checkpoint.is_finished(mix.limit_rows, mix.target_tokens, tokens)
        commits = [*commits, {"name": name, "next_shard": base + len(written), "shards": [r.asDict() for r in written]}]
        ledger.commit({"state": state.plain(), "commits": commits, "rows": position + sum(r["rows"] for r in written), "tokens": tokens, "finished": state.finished})
        out_report = spark.createDataFrame(report.collect(), report.schema)
    finally:
        made.unpersist()
    if mix.target_tokens is not None and mix.limit_rows is None and tokens < mix.target_tokens:
        raise RuntimeError(f"{tokens} of {mix.target_tokens} tokens: all sources are exhausted ({', '.join(sorted(mix.shares))})")
    return out_report


def mixed(spark: SparkSession, out: str) -> DataFrame:
    """The rows that a mix run has committed: shard, position, and the columns of the schema."""
    held = Ledger(spark, f"{out}/_state").load() or {"commits": []}
    schema = T.StructType([T.StructField("position", T.LongType()), *OUTPUT.fields, T.StructField("shard", T.IntegerType())])
    parts = [spark.read.schema(schema).parquet(f"{out}/data/{c['name']}") for c in held["commits"]]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def token_files(spark: SparkSession, root: str, pattern: str | None = None) -> list[str]:
    """What is to be tokenized below root: the shards that a finished mix lists, in order; where it has no commits, or with a pattern,
    the files whose name matches it, without a buffer."""
    held = None if pattern else Ledger(spark, f"{root}/_state").load()
    if held is None:
        return sorted(files.glob_files(spark, root, pattern or "*.parquet"), key=files.numbered)
    files.manifest_files({"finished": held["finished"], "total_shards": sum(len(c["shards"]) for c in held["commits"])}, "{}")
    found = [f for f in files.list_files(spark, f"{root}/data")]
    wanted = {s["path"]: k for k, s in enumerate(s for c in held["commits"] for s in c["shards"])}
    return [f"data/{f}" for f in sorted((f for f in found if f"data/{f}".rpartition("/")[0] in wanted), key=lambda f: (wanted[f"data/{f}".rpartition("/")[0]], f))]


def run_tokenize(spark: SparkSession, data: dict, root: str, output: str, tokenizer: tokenizing.Tokenizer, pattern: str | None = None, dry: bool = False, resume: bool = True) -> list[tuple[str, int]]:
    """Tokenizes the files below root into binary shards; returns their names and sizes. Streams of some files at a time are written
    and committed; shards are cut when all are there, so that a stopped run repeats the files after the last commit only."""
    rules, wants = data.get("tokenizer") or {}, data.get("output") or {}
    shard, every = int(wants.get("shard_size_tokens", 250_000_000)), int(wants.get("commit_files", COMMIT_FILES))
    found = token_files(spark, root, pattern)
    if dry:
        return [(f, files.size(spark, f"{root}/{f}")) for f in found]
    kind = tokenizing.dtype_of(tokenizer.max_id, tokenizer.eos_id)
    settings = config.stable_id({"version": TOKENIZE_VERSION, "config": data, "tokenizer": [type(tokenizer).__name__, getattr(tokenizer, "path", ""), tokenizer.eos_id, tokenizer.max_id]})
    now = State(checkpoint.config_hash(TOKENIZE_VERSION, data, {}, {"files": found}), {"files": found}, settings, version=TOKENIZE_VERSION, updated_at=time.time())
    ledger = Ledger(spark, f"{output}/_state")
    held = ledger.load()
    checkpoint.may_start(resume, held is not None, held is None and files.exists(spark, f"{output}/manifest.json"))
    if held:
        checkpoint.exact(State(**held["state"]), now)
    commits = held["commits"] if held else []
    if held and held["finished"]:
        return sorted((n, k) for n, k in files.read_json(spark, f"{output}/manifest.json")["files"].items())
    checkpoint.check_parts(spark, f"{output}/_streams", [c["name"] for c in commits])
    todo = list(enumerate(found))[sum(c["files"] for c in commits) :]
    for k in range(0, len(todo), every):
        name = f"commit-{uuid.uuid4().hex}"
        df = files.scan(spark, root, todo[k : k + every]).select("file", "row", "text")
        ids = tokenizing.with_tokenizer(F.col("text"), tokenizer)
        made = tokenizing.streams(df, ids, tokenizer.eos_id, int(rules.get("hard_doc_limit", 65536)), int(rules.get("max_doc_tokens", 8192))).drop("text")
        made.write.option("compression", "zstd").parquet(f"{output}/_streams/{name}")
        commits = [*commits, {"name": name, "files": len(todo[k : k + every])}]
        ledger.commit({"state": now.plain(), "commits": commits, "finished": False})
    schema = "file int, row bigint, n_ids bigint, stream array<int>, length bigint"
    streams = [spark.read.schema(schema).parquet(f"{output}/_streams/{c['name']}") for c in commits]
    at = tokenizing.placed(reduce(DataFrame.unionByName, streams) if streams else spark.createDataFrame([], schema))
    target, finished = data.get("target_tokens"), True
    if target:  # the budget is looked at before each I/O chunk
        row = tokenizing.budget(at, shard, int(wants.get("io_chunk_tokens", 1 << 20)), int(target)).first()
        stop, finished = row["tokens"], bool(row["reached"])
        at = at.where(F.col("start") < stop).withColumn("length", F.least("length", F.lit(stop) - F.col("start")))
        at = at.withColumn("stream", F.slice("stream", 1, F.col("length").cast("int")))
    rows = sharding.write_token_shards(tokenizing.pieces(at, shard), output, kind, shard, manifest={"finished": finished})
    ledger.commit({"state": now.plain(), "commits": commits, "finished": True})
    return rows
