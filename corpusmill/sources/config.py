"""Configuration of sources, mixes and tokenizing runs: YAML with environment variables, checked and turned into dataclasses."""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import dataclass, field, replace
from typing import Any

import yaml

#: Rules on numbers, in the order in which they are checked; fixed values.
NUMERIC = ("language_score", "fasttext_score", "score", "answer_count", "int_score", "token_count", "estimated_tokens")


@dataclass(frozen=True)
class Policy:
    """Bounds are inclusive; None is no rule."""

    min_words: int | None = None
    max_words: int | None = None
    min_chars: int | None = None
    max_chars: int | None = None
    languages: tuple[str, ...] = ()
    minimums: dict[str, float] = field(default_factory=dict)
    missing_policy: str = "ignore"


@dataclass(frozen=True)
class Source:
    name: str
    repo: str = ""
    config: str | None = None
    split: str = "train"
    prefix: str = ""
    pattern: str = "*.parquet"
    #: logical name -> column path; a logical name that is missing maps to the column of its own name, None or "" to nothing
    columns: dict[str, str | None] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    policy: Policy = Policy()
    output_prefix: str = ""


@dataclass(frozen=True)
class MixSource:
    name: str
    weight: float


@dataclass(frozen=True)
class Mix:
    name: str
    sources: tuple[MixSource, ...]
    target_tokens: int | None = None
    seed: int = 0
    batch_rows: int = 4096
    limit_rows: int | None = None

    def __post_init__(self) -> None:
        if not self.sources or sum(s.weight for s in self.sources) <= 0:
            raise ValueError("a mix needs sources with a positive total weight")
        if self.target_tokens is None and any(s.weight == 0 for s in self.sources):
            raise ValueError("a source of weight 0 needs a token target")

    @property
    def shares(self) -> dict[str, float]:
        total = sum(s.weight for s in self.sources)
        return {s.name: s.weight / total for s in self.sources}

    @property
    def ranks(self) -> dict[str, int]:
        """Place of each source in the order that breaks ties."""
        order = sorted(self.shares, key=lambda n: tie_value(self.seed, n))
        return {n: k for k, n in enumerate(order)}


def tie_value(seed: int, name: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}:{name}".encode(), digest_size=8).digest(), "big")


def stable_id(data: Any) -> str:
    text = json.dumps(data, sort_keys=True, separators=(",", ":"), default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:12]


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(os.path.expandvars(f.read()))
    if not isinstance(data, dict):
        raise ValueError(f"{path} does not hold a mapping")
    return data


def source_of(data: dict, run_id: str | None = None) -> Source:
    """A filter source from its configuration; a disabled one is an error that gives the reason."""
    if data.get("stage", 1) != 1:
        raise ValueError("this is not the configuration of a filter source")
    if data.get("enabled", True) is False:
        raise RuntimeError(f"{data.get('name')} is disabled: {data.get('disabled_reason', 'no reason given')}")
    src, out = data.get("source") or {}, data.get("output") or {}
    rules = dict(data.get("filters") or {})
    policy = Policy(
        *(rules.get(k) for k in ("min_words", "max_words", "min_chars", "max_chars")),
        tuple(rules.get("languages") or ()),
        {n: rules[f"min_{n}"] for n in NUMERIC if rules.get(f"min_{n}") is not None},
        rules.get("missing_policy", "ignore"),
    )
    columns = dict(data.get("columns") or {})
    text = columns.get("text", "text")
    required = tuple(data.get("required_columns") or [text])
    prefix = out.get("path_prefix", data["name"])
    source = Source(data["name"], src.get("repo_id", ""), src.get("config"), src.get("split", "train"), src.get("path_prefix", ""), src.get("file_pattern", "*.parquet"), columns, required, policy, prefix)
    return replace(source, output_prefix="/".join(x for x in (prefix, "_smoke", run_id) if x)) if run_id else source


def mix_of(data: dict) -> Mix:
    if data.get("stage") != 2:
        raise ValueError("this is not the configuration of a mix")
    rows = data.get("sources") or []
    out = data.get("output") or {}
    return Mix(data["name"], tuple(MixSource(r["name"], float(r["weight"])) for r in rows), data.get("target_tokens"), int(data.get("seed", 0)), int(out.get("batch_rows", 4096)), data.get("limit_rows"))
