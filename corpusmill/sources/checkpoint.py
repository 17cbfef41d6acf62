"""Progress documents of resumable runs: what is done, what may follow, and what would be an error."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files as storage
from .config import stable_id

#: Of a ledger's documents that many are kept.
KEPT = 5


class Ledger:
    """The commits of a run: numbered JSON documents in a folder, of which the newest readable one counts. Data are written first,
    under a name that nothing refers to yet; they become part of the run when the next document, which lists them, appears by one
    rename. Whatever a stopped run leaves without a document is no part of it, and is removed by the next."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _numbers(self) -> list[int]:
        return sorted(int(n[6:14]) for n in storage.names(self.spark, self.folder) if n.startswith("state-") and n.endswith(".json"))

    def load(self) -> dict | None:
        for k in reversed(self._numbers()):
            try:
                found = storage.read_json(self.spark, f"{self.folder}/state-{k:08d}.json")
            except ValueError:  # malformed: the one before counts
                continue
            if isinstance(found, dict):
                return found
        return None

    def commit(self, data: dict) -> None:
        numbers = self._numbers()
        storage.write_json(self.spark, f"{self.folder}/state-{numbers[-1] + 1 if numbers else 0:08d}.json", data)
        for k in numbers[: -KEPT + 1]:
            storage.remove(self.spark, f"{self.folder}/state-{k:08d}.json")


def check_parts(spark: SparkSession, folder: str, listed: list[str]) -> None:
    """Committed folders that are gone are an error, and so is anything that no run made; what a stopped run left is removed."""
    there = storage.names(spark, folder)
    if strange := [n for n in there if not n.startswith("commit-")]:
        raise RuntimeError(f"there are shards without a checkpoint in {folder}: {', '.join(strange)}")
    if missing := sorted(set(listed) - set(there)):
        raise RuntimeError(f"committed parts are missing in {folder}: {', '.join(missing)}")
    for name in set(there) - set(listed):
        storage.remove(spark, f"{folder}/{name}")


def folded(progress: dict, counters: list[dict], order: list[str]) -> dict:
    """The totals of a run, brought forward by the counters (file_path, rows_seen, accepted, rejected, estimated_tokens) of newly done
    files. Files are taken strictly in their order: one that is done out of turn waits for those before it."""
    out = {"next_file": 0, "rows_seen": 0, "accepted": 0, "rejected": 0, "estimated_tokens": 0, **progress, "waiting": dict(progress.get("waiting") or {})}
    out["waiting"] |= {c["file_path"]: {k: c[k] for k in ("rows_seen", "accepted", "rejected", "estimated_tokens")} for c in counters}
    while out["next_file"] < len(order) and (c := out["waiting"].pop(order[out["next_file"]], None)) is not None:
        for k, n in c.items():
            out[k] += n
        out["next_file"] += 1
    return out


@dataclass
class State:
    config_hash: str
    files: dict[str, list[str]]
    #: hash of the configuration alone, which no extension may change
    settings: str = ""
    revisions: dict[str, str] = field(default_factory=dict)
    cursors: dict[str, dict[str, Any]] = field(default_factory=dict)
    version: int = 1
    updated_at: float = 0.0
    finished: bool = False

    def plain(self) -> dict:
        return asdict(self)


def config_hash(version: int, config: dict, revisions: dict, files: dict) -> str:
    return stable_id({"version": version, "config": config, "revisions": revisions, "files": files})


def newest(local: State | None, remote: State | None, prefer_local: bool = False) -> State | None:
    if local is None or remote is None:
        return local or remote
    done = [sum(len(f) for f in s.files.values()) for s in (local, remote)]
    return local if prefer_local or done[0] > done[1] or (done[0] == done[1] and local.updated_at >= remote.updated_at) else remote


def extended(saved: State, now: State) -> State:
    """saved, brought to the files of now. Lists may only grow at their end; a source that was exhausted and has new files is
    opened again. Anything else is an error."""
    if saved.version != now.version:
        raise RuntimeError(f"the checkpoint has version {saved.version}, not {now.version}")
    if set(saved.files) != set(now.files):
        raise RuntimeError("the checkpoint has other sources")
    if saved.settings != now.settings:
        raise RuntimeError("the checkpoint was made for another configuration")
    for name, before in saved.files.items():
        after = now.files[name]
        if after[: len(before)] != before:
            raise RuntimeError(f"the files of {name} were changed or reordered; only new files at the end can be taken in")
    cursors = {}
    for name, cursor in saved.cursors.items():
        more = len(now.files[name]) > len(saved.files[name])
        cursors[name] = {**cursor, "exhausted": False} if cursor.get("exhausted") and more else dict(cursor)
    return State(now.config_hash, now.files, now.settings, now.revisions, cursors, now.version, now.updated_at)


def exact(saved: State, now: State) -> State:
    if (saved.config_hash, saved.files, saved.revisions) != (now.config_hash, now.files, now.revisions):
        raise RuntimeError("the checkpoint was made for another configuration or other files")
    return saved


def may_start(resume: bool, has_checkpoint: bool, has_shards: bool) -> None:
    if not resume and (has_checkpoint or has_shards):
        raise RuntimeError("there is output already; remove it or resume")
    if has_shards and not has_checkpoint:
        raise RuntimeError("there are shards without a checkpoint")


def is_finished(limit_rows: int | None, target: int | None, tokens: int) -> bool:
    return limit_rows is None and (target is None or tokens >= target)


def should_commit(pending_bytes: int, target_bytes: int, last_file: bool, since: int, every: int | None) -> bool:
    return pending_bytes >= target_bytes or last_file or bool(every and since >= every)


def reconcile(buffer_tokens: int, recorded: int, shard: int, mid_file: bool) -> str:
    """What to do with a buffer found after a crash: keep, trust it, or turn it into a shard."""
    if buffer_tokens > shard or (buffer_tokens != recorded and mid_file):
        raise RuntimeError("the buffer does not fit the checkpoint")
    return "shard" if buffer_tokens == shard else "keep" if buffer_tokens == recorded else "trust"


def remaining(files: DataFrame, done: DataFrame, key: str = "file_path") -> DataFrame:
    """Files that are not done: an anti-join with the finished ones."""
    return files.join(done.where(F.col("finished")).select(key).distinct(), key, "left_anti")


def appended(saved: DataFrame, now: DataFrame, key: str = "source", files: str = "files") -> DataFrame:
    """For each source, whether the saved list is the beginning of the present one."""
    both = saved.select(key, F.col(files).alias("saved")).join(now.select(key, F.col(files).alias("now")), key)
    return both.select(key, (F.slice("now", 1, F.size("saved")) == F.col("saved")).alias("append_only"), (F.size("now") - F.size("saved")).cast("bigint").alias("new_files"))
