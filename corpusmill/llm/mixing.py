"""Mixing sources to target weights by entropy balancing.

Each document d of source s gets a rate r in (0, 2), the number of times it is taken. Among all rates that meet the token
constraints  sum(size * r) = target(s)  those are chosen that stray least, in relative entropy, from taking each document once:

    minimise  sum over d of (size / z) * D(r || 1),   z = (size / mean size of the source) ** tilt

Its convex dual has one multiplier per source, and the rates are exponentially tilted: r = 2 / (1 + exp(-lambda * z)). The
multipliers are found by Newton steps whose gradients and Hessians are sums over all documents, computed by aggregation; a
bracket around the root makes the steps safe. At tilt 0 the rates of a source are all equal; at 1 long documents are avoided
or favoured most.

Rates are rounded into copies: floor(r), and one more for the documents that come first by (hash in [0, 1)) - fraction(r). The
cut in that order is placed where the source's tokens reach its target, by a descent through 12-bit digits of the order, and
then a few documents are toggled, each the one that brings the source closest. So no task sees a source's documents together.

Defined results: null or empty text has size 0 and is taken 0 words; a null source is a source, last in order; repeated rows
are decided alike; a source whose documents are all empty has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lookup, read_table, stored

WORD = "[^\\x20\\x09-\\x0D]+"
#: The order of documents is a number of DIGITS times 12 bits.
DIGITS = 4
#: Documents of a source that may be toggled to bring it closer to its target.
SWAPS = 3


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"))


def source_key() -> Column:
    """A key by which null is a source as well, and not the same as any text."""
    return F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))


def targets(by_source: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """by_source (k, source, n, total) with target: `share` of all words dealt by weight; a source's target stops at `most` times
    its words and the excess goes to the others by weight. Its rows are sources, so one task orders them."""
    everyone = Window.partitionBy()
    ranked = by_source.withColumn("pos", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("pos") - 1, F.lit(len(weights))) + 1).cast("int"))
    dealt = ranked.withColumn("w", weight).withColumn("cap", F.col("total") * F.lit(most)).withColumn("budget", F.sum("total").over(everyone) * F.lit(share))
    # in order of cap / weight, the sources that reach their caps come first
    order = Window.orderBy(F.col("cap") / F.col("w"), "pos").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(order), F.lit(0.0))) / (F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(order), F.lit(0.0)))
    leveled = dealt.withColumn("level", level).withColumn("full", F.col("cap") <= F.col("level") * F.col("w"))
    common = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("w"), "pos", "level"))).over(everyone)
    return leveled.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * common["level"])).select("k", "source", "n", "total", "cap", "target")


def solve(histogram: DataFrame, sources: DataFrame, tilt: float, tolerance: float = 1e-9, steps: int = 60) -> DataFrame:
    """k, lam for each source, by Newton steps in the dual; histogram is (k, size, n). A source at its cap or at 0 has no finite
    multiplier; it gets +-60, which is a rate of 2 or 0."""
    share = F.col("target") / F.col("cap")
    start = F.when(F.col("total") == 0, 0.0).when(share >= 1, 60.0).when(share <= 0, -60.0).otherwise(F.log(share / (1 - share)))
    state = stored(sources.select("k", "n", "target", "total", (F.col("total") / F.col("n")).alias("mean"), start.alias("lam"), F.lit(-700.0).alias("low"), F.lit(700.0).alias("high"), F.lit(False).alias("done")), "mix-state")
    for _ in range(steps):
        r = rate(F.col("size"), F.col("mean"), F.col("lam"), tilt)
        z = scale(F.col("size"), F.col("mean"), tilt)
        mass = (F.col("size") * F.col("c")).cast("double")
        sums = lookup(histogram.withColumnRenamed("n", "c"), state.where("not done").select("k", "mean", "lam", "n"), "k", "n", "inner").where("size > 0").groupBy("k").agg(F.sum(mass * r).alias("now"), F.sum(mass * r * (1 - r / 2) * z).alias("slope"))
        joined = state.join(sums, "k", "left")
        error = F.col("now") - F.col("target")
        done = F.col("done") | F.col("now").isNull() | (F.abs(error) <= tolerance * F.col("target")) | (F.abs(F.col("lam")) == 60)
        low, high = F.when(error < 0, F.col("lam")).otherwise(F.col("low")), F.when(error > 0, F.col("lam")).otherwise(F.col("high"))
        moved = F.col("lam") - error / F.col("slope")
        step = F.when((F.col("slope") > 0) & (moved > low) & (moved < high), moved).otherwise((low + high) / 2)
        state = stored(joined.select("k", "n", "target", "total", "mean", F.when(done, F.col("lam")).otherwise(step).alias("lam"), F.coalesce(low, "low").alias("low"), F.coalesce(high, "high").alias("high"), done.alias("done")), "mix-state")
        if not state.where("not done").limit(1).count():
            break
    return state.select("k", "mean", "lam")


def scale(size: Column, mean: Column, tilt: float) -> Column:
    return F.when(size > 0, F.pow(size / mean, F.lit(float(tilt)))).otherwise(F.lit(1.0))


def rate(size: Column, mean: Column, lam: Column, tilt: float) -> Column:
    return F.when(lam >= 60, 2.0).when(lam <= -60, 0.0).otherwise(2 / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -lam * scale(size, mean, tilt))))))


def plan(table: DataFrame, tilt: float = 0.25, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """table (k, doc_id, source, size) as stored; returns for each source k all that decided() needs."""
    by_source = stored(table.groupBy("k").agg(F.first("source").alias("source"), F.count("*").alias("n"), F.sum("size").alias("total")), "mix-sources")
    aimed = stored(targets(by_source, weights, share), "mix-targets")
    histogram = stored(table.groupBy("k", "size").agg(F.count("*").alias("n")), "mix-sizes")
    solved = stored(aimed.join(solve(histogram, aimed, tilt), "k"), "mix-solved")
    rated = lookup(table, solved.select("k", "mean", "lam", "n"), "k", "n").select("k", "size", *_copies(tilt))
    left = F.col("target") - F.coalesce(F.col("sure"), F.lit(0))
    state = stored(solved.join(rated.groupBy("k").agg(F.sum(F.col("base") * F.col("size")).alias("sure")), "k", "left").select("*", left.alias("left"), F.lit(0).cast("long").alias("cut")), "mix-cut")
    # the largest cut so that the documents before it hold no more than what is left, digit by digit
    for digit in range(DIGITS):
        shift = 12 * (DIGITS - 1 - digit)
        here = lookup(table, state.select("k", "mean", "lam", "cut", "n"), "k", "n").select("k", "size", "cut", *_copies(tilt))
        prefix = here.where(F.shiftright("order", shift + 12) == F.shiftright("cut", shift + 12)) if digit else here
        bins = prefix.groupBy("k", F.shiftright("order", shift).alias("bin")).agg(F.sum("size").alias("words"))
        upto = bins.withColumn("upto", F.sum("words").over(Window.partitionBy("k").orderBy("bin")))
        # the first bin with which more is taken than is left; without one, all bins are passed
        first = upto.join(state.select("k", "left"), "k").groupBy("k").agg(F.min(F.when(F.col("upto") > F.col("left"), F.struct("bin", F.col("upto") - F.col("words")))).alias("at"), F.max("bin").alias("last"), F.max("upto").alias("all"))
        at, passed = F.col("at.bin"), F.col("at.col2")
        new = state.join(first, "k", "left")
        cut = F.when(F.col("last").isNull(), F.col("cut")).when(at.isNotNull(), F.shiftleft(at, shift)).otherwise(F.shiftleft(F.col("last") + 1, shift))
        state = stored(new.select("k", "source", "n", "total", "cap", "target", "mean", "lam", F.when(F.col("last").isNull(), F.col("left")).when(at.isNotNull(), F.col("left") - passed).otherwise(F.col("left") - F.col("all")).alias("left"), cut.alias("cut")), "mix-cut")
    # documents whose copies, added or taken back, leave the source closest to its target; one in each round
    state = state.withColumn("swaps", F.array().cast("array<struct<order: bigint, h: bigint>>"))
    for _ in range(SWAPS):
        here = lookup(table, state.select("k", "mean", "lam", "cut", "left", "swaps", "n"), "k", "n").select("k", "doc_id", "size", "cut", "left", "swaps", *_copies(tilt))
        signed = F.when(F.col("order") < F.col("cut"), -F.col("size")).when(F.col("base") < 2, F.col("size"))
        open_ = here.where(F.col("size") > 0).where(~F.array_contains("swaps", F.struct("order", "h")))
        groups = open_.groupBy("k", "left", "order", "h", signed.alias("signed")).agg(F.count("*").alias("m")).where("signed is not null")
        rest = F.col("left") - F.col("signed") * F.col("m")
        best = groups.where(F.abs(rest) < F.abs("left")).groupBy("k").agg(F.min(F.struct(F.abs(rest).alias("gap"), "order", "h", rest.alias("rest"))).alias("b"))
        new = state.join(best, "k", "left")
        one = F.array(F.struct(F.col("b.order").alias("order"), F.col("b.h").alias("h")))
        swaps = F.when(F.col("b").isNull(), F.col("swaps")).otherwise(F.concat("swaps", one))
        state = stored(new.select(*[c for c in state.columns if c not in ("left", "swaps")], F.coalesce("b.rest", "left").alias("left"), swaps.alias("swaps")), "mix-plan")
    return state


def _copies(tilt: float) -> list[Column]:
    r = F.when(F.col("size") > 0, rate(F.col("size"), F.col("mean"), F.col("lam"), tilt)).otherwise(0.0)
    h = F.xxhash64("doc_id", "size")
    uniform = (F.shiftrightunsigned(h, 11)).cast("double") / F.lit(float(2**53))
    base = F.floor(r).cast("long")
    top = 2 ** (12 * DIGITS)
    order = F.floor((uniform - (r - F.floor(r)) + 1) / 2 * F.lit(float(top))).cast("long")
    return [base.alias("base"), F.greatest(F.lit(0), F.least(F.lit(top - 1), order)).alias("order"), h.alias("h")]


def decided(table: DataFrame, made: DataFrame, tilt: float = 0.25) -> DataFrame:
    """table with source_size, target, copies."""
    here = lookup(table, made.withColumnRenamed("source", "_s").select("k", "n", F.col("total").alias("source_size"), "target", "mean", "lam", "cut", "swaps"), "k", "n")
    here = here.select(*table.columns, "source_size", "target", "cut", "swaps", *_copies(tilt))
    extra = F.col("order") < F.col("cut")
    swap = F.array_contains("swaps", F.struct("order", "h")) & (extra | (F.col("base") < 2))
    copies = F.col("base") + (extra != swap).cast("long")
    return here.select(*table.columns, "source_size", "target", F.when(F.col("size") > 0, F.least(F.lit(2), copies)).otherwise(F.lit(0)).cast("long").alias("copies"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", tilt: float = 0.25, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5) -> tuple[DataFrame, DataFrame]:
    """The stored table of sizes (k, doc_id, source, size), and the plan for decided()."""
    table = sizes(docs, doc_id, text, source)
    table = stored(table.withColumn("k", source_key()), "mix-table")
    return table, plan(table, tilt, weights, share)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, made = mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return decided(table, made).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
