"""Secret scans: fixed patterns, and the guess cost of values in credential contexts.

The base kinds (assign, access, hex) are patterns. The added kind `guess` covers values that stand after a credential word and
a sign such as `:`, `=`, `is` or `->` and that no pattern above has found: a value counts if guessing it would take at least
10 ** min_cost attempts. That cost is the least over all ways to cut the value into dictionary words, dates, repeats, keyboard
walks and brute-force spans, found by dynamic programming over its positions, so that `password1111` or `qwerty2020` cost little.
Values of `assign` spans get their cost too, without being judged by it.
Values of any length count by that cost. One without digits and inner symbols that reads like a word, by its letter pairs, costs
no more than a guess among 10 ** 6 words for each 24 letters, so that `secret is knowledge` gives no span; random letters do.

Defined results: null is as an empty text; every row is scanned alone, repeated rows alike; whole texts are scanned.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from bisect import bisect_left
from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, without

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
#: Runs that are long enough are just the maximal runs of `AKIA[A-Z0-9]+` and `[0-9a-f]+` that are.
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{14,}"), re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "guess")
MIN_ASSIGN, MIN_COST = 12, 8.0
TRIGGERS = ("password", "passwd", "secret", "token", "apikey", "api_key")

CONTEXT = re.compile(
    r"(?<![A-Za-z0-9])(?:password|passwd|passphrase|passcode|pwd|secret|token|api[_ -]?key|private[_ -]?key|credentials?|bearer|auth)"
    r"[\"']?\x20*(?:(?P<sign>[:=]|=>|->)|(?P<word>\x20is\x20))\x20*[\"'`]?(?P<value>[^\s\"'`<>,;]+)",
    re.I | re.A,
)
CONTEXT_TRIGGERS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer", "auth")

#: Words by rank, the commonest in passwords first; fixed values. scan() takes other lists.
WORDS = (
    "password admin welcome login letmein secret master dragon monkey sunshine princess football baseball iloveyou love shadow "
    "superman batman trustno hello freedom whatever starwars computer michael jordan hunter ranger buster soccer hockey killer "
    "george charlie andrew thomas jessica ashley daniel summer winter spring autumn orange purple yellow silver golden cookie "
    "cheese banana flower family friend forever please change default example sample test guest user root system server access "
    "public private token placeholder none null true false your here enter value string changeme pass word key the and with for"
).split()
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("@4310$57!", "aaeiosstl")


def _neighbours() -> dict[str, set[str]]:
    """Keys next to each other on a keyboard: in a row, or in the rows above and below."""
    at = {c: (r, k) for r, row in enumerate(ROWS) for k, c in enumerate(row)}
    return {a: {b for b, (s, j) in at.items() if a != b and abs(r - s) <= 1 and abs(k - j) <= 1} for a, (r, k) in at.items()}


NEXT_TO = _neighbours()
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:(?:19|20)\d\d|\d\d)")


def ranked(words: Sequence[str]) -> tuple[dict[str, int], int]:
    """The rank of each word, and the longest word's length."""
    return {w.lower(): k + 1 for k, w in reversed(list(enumerate(words)))}, max(map(len, words), default=0)


RANKS, LONGEST = ranked(WORDS)
#: Letters that words put next to each other: a vowel and a consonant, but for the rare ones, and these pairs of either; fixed values.
VOWELS, RARE_LETTERS = frozenset("aeiouy"), frozenset("jqxz")
VOWEL_PAIRS = frozenset("ai au ay ea ee ei eo eu ey ia ie io iu oa oi oo ou oy ua ue ui uo".split())
CONSONANT_PAIRS = frozenset(
    "bb bl br cc ch ck cl cr ct dd dg dl dr ds ff fl fr ft gg gh gl gn gr ht ks lb ld lf lk ll lm lp ls lt mb mm mp ms nc nd ng nk nl nn ns nt nv "
    "pl pp pr ps pt qu rb rc rd rf rg rk rl rm rn rp rr rs rt rv sc sh sk sl sm sn sp ss st sw tc th tl tr ts tt tw wh wl wn wr xc xp xt".split()
)
#: The share of unusual pairs beyond which a value is no word; what a pair with a rare letter counts; letters of one word at most;
#: log10 of all words.
UNUSUAL, RARE_PAIR, WORD_LETTERS, WORD_COST = 0.25, 0.8, 24, 6.0


def _unusual(a: str, b: str) -> float:
    """How unusual two letters of a to z are next to each other in a word, from 0 to 1."""
    if a + b in CONSONANT_PAIRS or a + b in VOWEL_PAIRS:
        return 0.0
    if (a in VOWELS) == (b in VOWELS):
        return 1.0
    return RARE_PAIR if a in RARE_LETTERS or b in RARE_LETTERS else 0.0


def _brute(c: str) -> float:
    """log10 of the guesses for one character, by its class."""
    return 1.0 if c.isdigit() else 1.41 if c.isascii() and c.isalpha() else 1.52 if c.isascii() else 2.0


def guess_cost(value: str, ranks: dict[str, int] = RANKS, longest: int = LONGEST) -> float:
    """log10 of the guesses for value: the least over all segmentations; each further segment doubles the guesses."""
    n, low = len(value), value.lower()
    plain = low.translate(LEET)
    best = [0.0] + [math.inf] * n
    repeat, walk, step = 1, 1, 1  # lengths of the repeat, walk and sequence that end here
    runs = [math.inf] * 3  # the least cost with a span of each kind that ends here, of any length from 3 to the run's
    dates: dict[int, list[int]] = {}
    for start in range(n):
        if low[start].isdigit() and (m := DATE.match(low, start)):
            dates.setdefault(m.end(), []).append(start)
    for end in range(1, n + 1):
        cost = best[end - 1] + _brute(value[end - 1])
        if end > 1:
            a, b = low[end - 2], low[end - 1]
            repeat = repeat + 1 if a == b else 1
            walk = walk + 1 if b in NEXT_TO.get(a, ()) else 1
            step = step + 1 if ord(b) - ord(a) == (1 if step == 1 else ord(a) - ord(low[end - 3])) and abs(ord(b) - ord(a)) == 1 else 2 if abs(ord(b) - ord(a)) == 1 else 1
        for k, (length, base, each) in enumerate(((repeat, _brute(value[end - 1]), 0.05), (walk, 1.7, 0.45), (step, 1.3, 0.05))):
            # the span goes on by one more, or begins three back
            runs[k] = min(runs[k] + each, best[end - 3] + 3 * each) if length >= 3 else math.inf
            cost = min(cost, runs[k] + 0.3 + base)
        for start in dates.get(end, ()):
            cost = min(cost, best[start] + 0.3 + (2.1 if end - start == 4 else 4.6))
        for k in range(3, min(longest, end) + 1):
            for form, more in ((low, 0.0), (plain, 0.6)):
                if rank := ranks.get(form[end - k : end]):
                    upper = 0.0 if value[end - k : end].islower() else 0.6
                    cost = min(cost, best[end - k] + 0.3 + math.log10(rank + 1) + more + upper)
        best[end] = cost
    return best[n]


def word_cost(value: str) -> float:
    """log10 of the guesses for a value without digits and inner symbols, as words; inf if too many of its letter pairs
    are unusual in them. Accents do not count, and letters beyond a to z tell nothing."""
    low = "".join(c for c in unicodedata.normalize("NFD", value.lower()) if not unicodedata.combining(c))
    pairs = [_unusual(a, b) for a, b in zip(low, low[1:]) if "a" <= a <= "z" and "a" <= b <= "z"]
    if pairs and sum(pairs) > UNUSUAL * len(pairs):
        return math.inf
    return WORD_COST * math.ceil(len(value) / WORD_LETTERS)


def spans(text: str | None, min_cost: float = MIN_COST, ranks: dict[str, int] = RANKS, longest: int = LONGEST) -> list[tuple[int, int, int, float | None]]:
    """(start, kind's place in KINDS, end, log10 of the value's guesses where it has a credential word) of all secrets, in that order."""
    if not text:
        return []
    low, out = text.lower(), []
    if any(t in low for t in TRIGGERS):
        out += [(m.start(), 0, m.end(), guess_cost(m[2], ranks, longest)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), None) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), None) for m in HEX.finditer(text)]
    if any(t in low for t in CONTEXT_TRIGGERS):
        starts, ends = [], []  # what is taken, as disjoint ranges in order
        for s, _, e, _ in sorted(out, key=lambda x: x[0]):
            if ends and s <= ends[-1]:
                ends[-1] = max(ends[-1], e)
            else:
                starts.append(s)
                ends.append(e)
        for m in CONTEXT.finditer(text):
            value = m["value"].rstrip(".!?)]}")
            start, end = m.start("value"), m.start("value") + len(value)
            before = bisect_left(starts, end) - 1  # the last range that starts before the value's end
            if before >= 0 and ends[before] > start:
                continue
            mixed = any(c.isdigit() for c in value) or any(not c.isalnum() for c in value[1:-1])
            cost = min(guess_cost(value, ranks, longest), math.inf if mixed else word_cost(value))
            if cost >= min_cost:
                out.append((start, 3, end, cost))
    return sorted(out, key=lambda x: x[:3])


def scan(docs: DataFrame, text: str = "text", min_cost: float = MIN_COST, words: Sequence[str] = WORDS) -> DataFrame:
    """docs with the added column _secrets: array of (kind, start, end, cost) in code points, by start, then kind; a column of that
    name is replaced. cost is the log10 of the guesses for the value, of kinds `assign` and `guess`. `words` are the dictionary, the
    commonest first."""
    ranks, longest = ranked(words)

    @F.pandas_udf("array<struct<kind: string, start: int, end: int, cost: double>>")
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": KINDS[k], "start": s, "end": e, "cost": c} for s, k, e, c in spans(t, min_cost, ranks, longest)] for t in texts])

    docs = without(docs, "_secrets")
    return docs.withColumn("_secrets", find(F.col(text)))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(column):
        return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = F.filter("_secrets", lambda x: x["kind"] != "guess")

    def count(kind: str):
        return F.size(F.filter("_secrets", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts[:3], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("_secrets")).alias("spans"), counts[3], F.array_min(F.transform("_secrets", lambda x: x["cost"])).alias("least_cost"))
