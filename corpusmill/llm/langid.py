"""Language identification by error-correcting output codes over binary n-grams.

Every language gets a codeword; for each bit a linear classifier on binary features (which hashed character 1- to 4-grams
occur in the whole text) says to which half the text belongs. Decoding is loss-weighted: a language's loss is the sum, over
bits, of the bit's weight (from its training error) times the logistic loss of the classifier's margin against the codeword;
the language with the least loss wins. The text is ambiguous if the two nearest codewords' losses hardly differ.

Training takes a bounded sample, chosen by hash, so that reruns agree: about `per_language` labelled rows of each language, fewer if
they are so many that this makes more than `MOST_ROWS`, and of more than `MOST_LANGUAGES` languages the most frequent ones. One
task gathers the sample and fits the model; only the model reaches the driver. Prediction covers every row.

Defined results: null text, or text without a letter, is `und` with score 0 and not ambiguous; without any labelled row every
text is `und`; with one language every text that has a letter gets it with score 1; repeated rows are predicted alike.
"""

from __future__ import annotations

import itertools
import pickle
import re
import sys
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, read_table, without

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Hashed features; labelled rows of each language in the sample; losses nearer than this part of the bits' weight are ambiguous.
BITS, PER_LANGUAGE, NEAR = 16, 1000, 0.02
#: Bounds of the sample: languages, and rows in all (of 8 kB at most).
MOST_LANGUAGES, MOST_ROWS = 256, 8000
#: Bytes of texts, or of their features, that a task hands to Python at once.
BATCH = "4m"
LETTER = re.compile(r"[^\W\d_]")


class Model(NamedTuple):
    languages: list[str]
    codes: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit in decoding


def features(text: str) -> np.ndarray:
    """The sorted features of the whole text: which hashed n-grams, n = 1..4, occur in its lower case, blanks folded."""
    codes = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    seen = np.zeros(1 << BITS, bool)
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, 5):
        if len(codes) < n:
            break
        h = (h[: len(codes) - n + 1] + codes[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        seen[(h >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return np.flatnonzero(seen)


def packed(f: np.ndarray) -> bytes:
    """Features as bits."""
    seen = np.zeros(1 << BITS, bool)
    seen[f] = True
    return np.packbits(seen).tobytes()


def unpacked(bits: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8)).view(bool))


def codewords(n: int) -> np.ndarray:
    """n codewords: all ways to part the languages in two, up to 7 languages; beyond that the most distant of seeded random ones."""
    if n <= 7:
        columns = [c for c in itertools.product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(columns or [(1,) * n], float).T
    rng, bits = np.random.default_rng(1), 15 * int(np.ceil(np.log2(n)))

    def distance(c: np.ndarray) -> float:
        return float((c @ c.T - np.eye(n) * 4 * bits).max())

    return min((rng.choice((-1.0, 1.0), (n, bits)) for _ in range(50)), key=distance)


def fit(rows: list[tuple[str, bytes]], epochs: int = 6) -> Model:
    """rows: language and features as bits, which are unpacked one row at a time. One logistic classifier for each bit, by AdaGrad;
    languages count alike."""
    languages = sorted({lang for lang, _ in rows})
    codes = codewords(len(languages)) if languages else np.zeros((0, 1))
    bits = codes.shape[1]
    w, b = np.zeros((1 << BITS, bits)), np.zeros(bits)
    g2 = np.full(1 << BITS, 1e-2)
    where = {lang: k for k, lang in enumerate(languages)}
    count = np.bincount([where[lang] for lang, _ in rows], minlength=len(languages)) if rows else np.zeros(0)
    rng = np.random.default_rng(7)
    for _ in range(epochs if len(languages) > 1 else 0):
        for i in rng.permutation(len(rows)):
            lang, f = rows[i][0], unpacked(rows[i][1])
            x = 1 / np.sqrt(max(1, len(f)))
            y = codes[where[lang]]
            margin = w[f].sum(0) * x + b
            grad = -y / (1 + np.exp(np.clip(y * margin, -50, 50))) * (len(rows) / len(languages) / count[where[lang]])
            g2[f] += (grad @ grad) * x * x / bits
            w[f] -= (0.5 * x / np.sqrt(g2[f]))[:, None] * grad
            b -= 0.05 * grad
    wrong = np.full(bits, 0.5)
    for lang, bits_ in rows:
        f = unpacked(bits_)
        margin = w[f].sum(0) / np.sqrt(max(1, len(f))) + b
        wrong += codes[where[lang]] * margin <= 0
    error = np.clip(wrong / (len(rows) + 1), 1e-3, 0.499)
    return Model(languages, codes, w.astype(np.float32), b, np.log((1 - error) / error))


def decode(model: Model, text: str | None) -> tuple[str, float, bool]:
    """The language, a score from 0 to 1, and whether the nearest codewords are too close to tell."""
    if not text or not model.languages or not LETTER.search(text):
        return "und", 0.0, False
    if len(model.languages) == 1:
        return model.languages[0], 1.0, False
    f = features(text)
    margin = model.weights[f].sum(0, dtype=np.float64) / np.sqrt(max(1, len(f))) + model.bias
    loss = np.logaddexp(0, -model.codes * margin) @ model.trust
    order = np.argsort(loss, kind="stable")
    p = np.exp(-(loss - loss[order[0]]))
    gap = (loss[order[1]] - loss[order[0]]) / model.trust.sum()
    return model.languages[order[0]], float(p[order[0]] / p.sum()), bool(gap < NEAR)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """A model from the rows that are not held out. Their features, at most 8 kB a row, meet in one task, which fits it."""
    docs = docs.select(doc_id, text, lang)
    known = docs.where(~held_out(F.col(doc_id)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = known.groupBy(F.col(lang).alias("_lang")).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "_lang").limit(MOST_LANGUAGES).collect()
    per_language = min(per_language, MOST_ROWS // max(1, len(counts)))
    counts = docs.sparkSession.createDataFrame([(r._lang, r._n) for r in counts], docs.select(F.col(lang).alias("_lang"), F.lit(1).cast("long").alias("_n")).schema)
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(doc_id).cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.join(F.broadcast(counts), F.col(lang) == F.col("_lang")).where(draw < F.lit(float(per_language)) / F.col("_n"))

    def featured(batches):
        for p in batches:
            p = p[[bool(LETTER.search(t)) for t in p["text"]]] if len(p) else p
            yield pd.DataFrame({"lang": p["lang"], "id": p["id"], "f": pd.Series([packed(features(t)) for t in p["text"]], index=p.index, dtype=object)})

    def fitted(batches):
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("lang", "id", "f")), strict=True)]
        model = fit([(lang, f) for lang, _, f in sorted(rows, key=lambda r: (r[0], r[1] or "", r[2]))])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tuple(model))], pa.binary())], names=["model"])

    with arrow_batches(docs.sparkSession, BATCH):
        rows = chosen.select(F.col(lang).cast("string").alias("lang"), F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text")).mapInPandas(featured, "lang string, id string, f binary")
        made = rows.repartition(1).mapInArrow(fitted, "model binary").collect()
    return Model(*pickle.loads(made[0].model)) if made else fit([])  # of no rows Spark may make no task


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with the added columns _lang_pred, _score, _ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.pandas_udf("lang string, score double, ambiguous boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        model_ = Model(*shared.value)
        return pd.DataFrame([decode(model_, t) for t in texts], columns=["lang", "score", "ambiguous"])

    docs = without(docs, "_p", "_lang_pred", "_score", "_ambiguous")
    out = docs.withColumn("_p", predict(F.col(text)))
    return out.select(*docs.columns, F.col("_p.lang").alias("_lang_pred"), F.col("_p.score").alias("_score"), F.col("_p.ambiguous").alias("_ambiguous"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"), F.col("_ambiguous").alias("ambiguous"))
