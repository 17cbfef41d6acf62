"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine >= t differ by a squared distance of at most 2 - 2t. A seeded rotation spreads a vector evenly over its
coordinates, which are split into `parts` blocks; each block has a share of the squared distance in proportion to its size, and
by the pigeonhole principle a linked pair stays within that share in at least one block. Each block is range-joined on a grid
over its first coordinates, whose cells are as wide as the block's radius: a vector visits half of the neighbouring cells, so that
each pair of neighbouring cells meets once. Pairs within a block's radius are verified by their exact cosine in double
precision, and counted only in the first block whose share they keep, so that the union over blocks has each pair once.

Equal vectors of a label are one class first. A meeting gives, instead of its pairs, each class's number of partners and a
spanning forest, so that groups of near copies do not emit all pairs. Cells with many rows are cut into chunks, and pairs of
chunks meet in tasks of their own, so that a task's memory has a bound.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and vectors with a null label, link
with nothing; vectors of unequal length do not link; rows with equal ids and vectors count as different vectors; an empty table
gives an empty result.
"""

from __future__ import annotations

import itertools
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, lookup, read_table, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COSINE, PARTS, CHUNK = 0.93, 4, 3000
#: A label's grid has a further dimension when it has more classes than this.
GRID = (0, 8000, 120_000)


def rotation(dim: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def blocks_of(dim: int, parts: int) -> list[slice]:
    edges = np.linspace(0, dim, min(parts, dim) + 1).astype(int)
    return [slice(int(a), int(b)) for a, b in itertools.pairwise(edges)]


def units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return v, v / np.sqrt((v * v).sum(1, keepdims=True))


def _shares(dim: int, parts: int, cosine: float) -> list[float]:
    return [(2 - 2 * cosine) * (b.stop - b.start) / dim * (1 + 1e-9) + 1e-12 for b in blocks_of(dim, parts)]


def _placer(cosine: float, parts: int):
    """node, label, dim, block, cell (up to three coordinates, 21 bits each), home, cnt, vec (its bytes) for each cell a row visits."""

    def run(batches):
        for p in batches:
            dims, depths = (p.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "depth"))
            for dim, depth in sorted({*zip(dims.tolist(), depths.tolist(), strict=True)}):
                g = p.filter(pa.array((dims == dim) & (depths == depth)))
                vectors = g.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                y = units(vectors)[1] @ rotation(dim).T
                row, block, cell, home = [], [], [], []
                for b, (part, share) in enumerate(zip(blocks_of(dim, parts), _shares(dim, parts, cosine), strict=True)):
                    d = min(depth, part.stop - part.start)
                    cells = np.floor(y[:, part.start : part.start + d] / (np.sqrt(share) * (1 + 1e-6))).astype(np.int64) + (1 << 20)
                    for step in itertools.product((-1, 0, 1), repeat=d):
                        if step >= (0,) * d:  # itself and half of the neighbours
                            row.append(np.arange(len(y)))
                            block.append(np.full(len(y), b, np.int32))
                            cell.append(((cells + np.array(step, np.int64)) << (21 * np.arange(d))).sum(1))
                            home.append(np.full(len(y), not any(step)))
                row = pa.array(np.concatenate(row))
                raw = pa.array([v.tobytes() for v in vectors], pa.binary())
                made = {"node": g.column("node").take(row), "label": g.column("label").take(row), "dim": pa.array(np.full(len(row), dim, np.int32)), "block": pa.array(np.concatenate(block)), "cell": pa.array(np.concatenate(cell)), "home": pa.array(np.concatenate(home)), "cnt": g.column("cnt").take(row), "vec": raw.take(row)}
                yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    return run


def _meeting(cosine: float, parts: int, kind: str):
    """Meetings of the rows of a cell; kind is the vectors' number type."""

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        block, i, j = int(g["block"].iloc[0]), int(g["i"].iloc[0]), int(g["j"].iloc[0])
        dim = int(g["dim"].iloc[0])
        v, u = units(np.frombuffer(b"".join(g["vec"]), kind).reshape(-1, dim))
        norm = np.sqrt((v * v).sum(1))
        y = u @ rotation(dim).T
        parts_, shares = blocks_of(dim, parts), _shares(dim, parts, cosine)
        yb = y[:, parts_[block]]
        sq = (yb * yb).sum(1)
        home, chunk, cnt, n = g["home"].to_numpy(), g["chunk"].to_numpy(), g["cnt"].to_numpy(), len(g)
        degree, label = np.zeros(n, np.int64), np.arange(n)
        linked: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, n, 256):
            rows = np.arange(at, min(n, at + 256))
            near = sq[rows][:, None] + sq[None, :] - 2 * yb[rows] @ yb.T <= shares[block] + 1e-7
            near &= home[rows][:, None] & ((np.arange(n)[None, :] > rows[:, None]) | ~home[None, :])
            if i != j:
                near &= chunk[rows][:, None] != chunk[None, :]
            a, b = np.nonzero(near)
            a = a + at
            for k in range(0, len(a), 50_000):
                x, z = a[k : k + 50_000], b[k : k + 50_000]
                ok = (v[x] * v[z]).sum(1) / (norm[x] * norm[z]) >= cosine
                x, z = x[ok], z[ok]
                if not len(x):
                    continue
                diff = (y[x] - y[z]) ** 2
                within = np.stack([diff[:, p].sum(1) <= s for p, s in zip(parts_, shares, strict=True)], 1)
                # the last block takes what rounding may keep from all of them
                first = np.where(within.any(1), within.argmax(1), block)
                x, z = x[first == block], z[first == block]
                np.add.at(degree, x, cnt[z])
                np.add.at(degree, z, cnt[x])
                linked.append((x, z))
                while True:  # labels fall to the least of their group
                    low = np.minimum(label[x], label[z])
                    if (low == label[x]).all() and (low == label[z]).all():
                        break
                    np.minimum.at(label, x, low)
                    np.minimum.at(label, z, low)
        changed = True
        while changed:
            changed = False
            for x, z in linked:
                low = np.minimum(label[x], label[z])
                if (low != label[x]).any() or (low != label[z]).any():
                    changed = True
                    np.minimum.at(label, x, low)
                    np.minimum.at(label, z, low)
        some = degree > 0
        node = g["node"].to_numpy()
        return pd.DataFrame({"node": node[some], "other": node[label[some]], "degree": degree[some]})

    return run


def near_duplicates(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = COSINE, parts: int = PARTS, chunk: int = CHUNK) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row."""
    e = F.col(embedding)
    fine = F.coalesce(F.size(e) > 0, F.lit(False)) & F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.coalesce(F.exists(e, lambda x: x != 0), F.lit(False)) & F.col(label).isNotNull()
    named = rows.select(F.col(vec_id).alias("vec_id"), F.when(fine, F.xxhash64(F.col(label).cast("string"), e)).alias("node"), F.when(fine, F.col(label).cast("string")).alias("label"), F.when(fine, e).alias("vec"))
    classes = named.where("node is not null").groupBy("node").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.count("*").alias("cnt"), F.min("vec_id").alias("least"))
    classes = stored(classes.withColumn("dim", F.size("vec")), "vec-classes")
    by_label = stored(classes.groupBy("label").agg(F.count("*").alias("n")), "vec-labels")
    depth = sum((F.col("m") > g).cast("int") for g in GRID)
    leveled = lookup(classes.drop("least"), by_label.withColumn("m", F.col("n")), "label", "n").withColumn("depth", depth)
    kind = "f4" if dict(classes.dtypes)["vec"] == "array<float>" else "f8"
    vec = F.col("vec") if kind == "f4" else F.col("vec").cast("array<double>")
    placed = leveled.select("node", "label", vec.alias("vec"), "cnt", "dim", "depth").mapInArrow(_placer(cosine, parts), "node long, label string, dim int, block int, cell long, home boolean, cnt long, vec binary")
    placed = placed.withColumn("place", F.xxhash64("label", "dim", "block", "cell"))
    crowded = stored(placed.groupBy("place").agg(F.count("*").alias("n")).where(F.col("n") > chunk).withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")), "vec-crowded")
    dealt = lookup(placed, crowded, "place", "n").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select("place", "block", "dim", "node", "vec", "cnt", "home", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    met = stored(dealt.groupBy("place", "block", "i", "j").applyInPandas(_meeting(cosine, parts, kind), "node long, other long, degree long"), "vec-met")
    degrees = met.groupBy("node").agg(F.sum("degree").alias("degree"))
    linked = components(met.select(F.col("node").alias("a"), F.col("other").alias("b")), "vec-edges")
    joined = classes.select("node", "cnt", "least").join(degrees, "node", "left").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    joined = stored(joined, "vec-joined")
    lowest = joined.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    told = lookup(joined, stored(lowest, "vec-lowest"), "component", "n").select("node", F.col("cnt").alias("n"), (F.col("cnt") - 1 + F.coalesce("degree", F.lit(0))).alias("n_links"), "component_id")
    out = lookup(named.select("vec_id", "node"), stored(told, "vec-told"), "node", "n")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least AS (SELECT x, min(y) AS c FROM reach GROUP BY x), degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings LEFT JOIN least ON least.x = vec_id LEFT JOIN degree ON degree.x = vec_id
"""
