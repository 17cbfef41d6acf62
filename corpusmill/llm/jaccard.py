"""N-gram Jaccard join, heavy and light by size.

A document's set is its distinct word shingles, as 64-bit hashes. Two sets with Jaccard similarity >= 3/4 miss at most a quarter
of either set, so with all shingles in one global order (rare ones first, by hash; then the frequent ones, by their counts)
the first k + c shingles of both, k = size // 4, have at least c in common, for any c that the sets have room for.

* Light sets enumerate the fixed-size subsets, here all pairs, of their first k + 2 shingles as keys.
* Heavy sets, beyond a boundary size, scan the inverted lists of their first k + c shingles, c = 1 + size // 16, and must meet
  a set in as many lists as the smaller c of both; light sets large enough to match a heavy one enter those lists as well.
* The boundary is where the estimated cost is least: the number of subsets against list entries times the mean length of a list.

Sets that are equal are one class, known by a hash of 64 bits that a second one of 64 bits guards, before anything is joined.
In a key's list, two classes are candidates only if their sizes and the positions of the key leave room for the similarity.
Short lists give all their candidates. A long list counts each class's next few neighbours first; after these are verified and
linked into components, its classes meet a few hubs of the list for some rounds, which links most of a large group. Then the
classes that are not in the list's largest component meet all classes of other components, and give the rest, but for those
whose signatures differ too much for the similarity. For this, lists of the same largest component are one group, in which two
classes meet once, with all the keys that they share, and not once in each list. So large groups of near copies never emit all
pairs, and no link that could join two components is left out. Candidates are verified exactly on the sets, of whose hashes 48
bits are moved: sets of n and m shingles gain a common one by chance in n * m / 2**48 of the cases.

Defined results: null or empty text, or text of blanks, has an empty set and links with nothing; rows with equal texts are linked;
a null doc_id has itself as component unless it is linked with others; an empty table gives an empty result.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, components, lookup, read_table, shuffles_freed, star, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
#: A-Z in lower case, all blanks as spaces.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
#: Shingles that so many classes may hold are ordered by count; the most frequent ones of them, that many, are broadcast.
FREQUENT, MOST = 32, 1 << 17
#: A list of at most LIST classes gives all candidates, a longer one first the NEIGHBOURS next ones of each class.
LIST, NEIGHBOURS = 16, 3
#: Rounds in which each entry of a long list meets two hubs of it only, and steps towards components between them.
ROUNDS, STEPS = 3, 2
#: Words of a signature: bit i is the parity of the number of shingles that are i modulo 64 * SIGNATURE.
SIGNATURE = 8
SIGNS = [f"s{i}" for i in range(SIGNATURE)]
#: Sum of the sizes from which on signatures tell nothing.
TELLING = 7 * 16 * SIGNATURE
#: Pairs of a group's classes that are compared in one part of it.
MEETING = 1 << 20
#: Set in the place of a light key.
LIGHT = 1 << 31
#: The bits of a key that are moved; lists of keys that agree in them are one, which only adds candidates.
KEY = (1 << 48) - 1
#: Candidate classes that are broadcast as a sorted array, to keep other sets from being shuffled.
PREFILTER = 1 << 20
#: Bytes of texts or sets that a task hands to Python at once, shingles that it counts at once, classes that it remembers.
BATCH, COUNTED, SEEN = "4m", 1 << 22, 200_000
#: Boundaries that are tried.
LIMITS = (0, 4, 8, 12, 16, 20, 24, 32, 40, 48, 64)


def _powers(base: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(PIECE, base, np.uint64))])


#: Words are hashed all at once, by differences of prefix sums of a polynomial: a random number for each byte, powers of an odd
#: base and of its inverse modulo 2 ** 64. Texts are taken in pieces of so many bytes, cut between words; words that are longer than
#: LONG_WORD, for which such a hash is weak, are hashed one by one.
PIECE, LONG_WORD = 1 << 15, 512
BASE = 0x9E3779B97F4A7C15
BYTES = np.random.default_rng(5).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
POWERS, INVERSES = _powers(BASE), _powers(pow(BASE, -1, 1 << 64))


def word_hashes(text: bytes | None) -> np.ndarray:
    """The hash of each word of a whole text, in order."""
    text, at, out = text.translate(TO_WORDS) if text else b"", 0, [np.zeros(0, np.uint64)]
    while at < len(text):
        stop = len(text)
        if stop - at > PIECE:
            stop = text.rfind(b" ", at, at + PIECE)
            if stop < 0:  # a single word
                stop = text.find(b" ", at + PIECE)
                stop = len(text) if stop < 0 else stop
                out.append(np.array([xxhash.xxh3_64_intdigest(text[at:stop])], np.uint64))
                at = stop + 1
                continue
        piece = np.frombuffer(text, np.uint8, stop - at, at)
        edges = np.flatnonzero(np.diff(piece != 32, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(BYTES[piece] * POWERS[: len(piece)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * INVERSES[starts] + (ends - starts).astype(np.uint64)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        for k in np.flatnonzero(ends - starts > LONG_WORD):
            h[k] = xxhash.xxh3_64_intdigest(text[at + starts[k] : at + ends[k]])
        out.append(h)
        at = stop + 1
    return np.concatenate(out) if len(out) > 2 else out[-1]


def shingles(text: bytes | None, n: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    ids = word_hashes(text)
    if not len(ids):
        return ids
    width = min(n, len(ids))
    size = len(ids) - width + 1
    h = np.full(size, width if width < n else 0, np.uint64)
    for k in range(width):
        h = (h + ids[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def fingerprint(s: np.ndarray, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes(), seed=seed) - (1 << 63)


def identity(s: np.ndarray, collided: frozenset) -> int:
    """The class of a set: its fingerprint, or a second one if the first is shared by unequal sets."""
    fp = fingerprint(s)
    return fingerprint(s, 1) if fp in collided else fp


def signature(s: np.ndarray) -> np.ndarray:
    odd = np.bincount((s & np.uint64(64 * SIGNATURE - 1)).astype(np.int64), minlength=64 * SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lean() -> None:
    """From now on a worker's Arrow memory goes back to the system as soon as it is free."""
    pa.set_memory_pool(pa.system_memory_pool())


def _raw(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(name).cast(pa.binary()).to_pylist()


def _describe(kind: pa.DataType):
    """Rows (kind 0) of doc_id, n, both fingerprints, and (kind 1) the shingles that occur in more than one class of about COUNTED
    shingles, with their number."""
    fields = pa.schema([("kind", pa.int8()), ("doc_id", kind), ("n", pa.int64()), ("fp", pa.int64()), ("fp2", pa.int64())])

    def repeated(held: np.ndarray) -> pa.RecordBatch:
        held.sort()
        again = np.flatnonzero(held[1:] == held[:-1])
        values, counts = np.unique(held[again], return_counts=True)
        k = len(values)
        return pa.RecordBatch.from_arrays([pa.array(np.ones(k, np.int8)), pa.nulls(k, kind), pa.array(counts.astype(np.int64) + 1), pa.array(values.view(np.int64)), pa.nulls(k, pa.int64())], schema=fields)

    def run(batches):
        _lean()
        seen, held, size = set(), np.empty(COUNTED, np.uint64), 0
        for batch in batches:
            ns, fps, others = [], [], []
            for raw in _raw(batch, "text"):
                s = shingles(raw)
                ns.append(len(s))
                fps.append(fingerprint(s) if len(s) else None)
                others.append(fingerprint(s, 1) if len(s) else None)
                if len(s) > 1 and fps[-1] not in seen:
                    if len(seen) > SEEN:
                        seen.clear()
                    seen.add(fps[-1])
                    if len(s) > COUNTED:  # alone it repeats none
                        continue
                    if size + len(s) > COUNTED:
                        yield repeated(held[:size])
                        size = 0
                    held[size : size + len(s)] = s
                    size += len(s)
            yield pa.RecordBatch.from_arrays([pa.array([0] * len(ns), pa.int8()), batch.column("doc_id"), pa.array(ns, pa.int64()), pa.array(fps, pa.int64()), pa.array(others, pa.int64())], schema=fields)
        yield repeated(held[:size])

    return run


def _ordered(s: np.ndarray, hot: np.ndarray, rank: np.ndarray, most: int) -> np.ndarray:
    """The first `most` shingles of s in the global order."""
    if len(hot):
        at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
        frequent = hot[at] == s
        if frequent.any():
            rare = s[~frequent]
            if len(rare) >= most:
                return rare[:most]
            return np.concatenate([rare, s[frequent][np.argsort(rank[at[frequent]], kind="stable")]])[:most]
    return s[:most]


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A key for each two shingles, the same in either order."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    h = (low * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (high + np.uint64(0x165667B19E3779F9))
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(31))


def _packed(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and places as they are moved: the lower KEY bits of the key below the lower 16 bits of its place; and the place's rest,
    the size lowest. So the bytes in which a class's rows differ lie side by side, and a shuffle can compress the others."""
    return (keys & np.uint64(KEY) | places.astype(np.uint64) << np.uint64(48)).view(np.int64), (places >> 32) + ((places >> 16 & 0xFFFF) << 32)


def _unpacked(moved: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return moved & KEY, ((rest & 0xFFFFFFFF) << 32) + (rest >> 32 << 16) + (moved >> 48 & 0xFFFF)


def _keys(shared, boundary: int):
    """Rows fp, key, place (size, whether a light key, and position of the key), packed, for each class once in a task."""

    def run(batches):
        _lean()
        hot, rank, collided = shared.value
        seen = set()
        pairs = {k: np.triu_indices(k, 1) for k in range(2, boundary // 4 + 3)}
        for batch in batches:
            keys, fps, places = [], [], []
            for raw in _raw(batch, "text"):
                s = shingles(raw)
                n = len(s)
                if n < 2:  # only an equal set is similar to a single shingle
                    continue
                fp = identity(s, collided)
                if fp in seen:
                    continue
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(fp)
                k, c = n // 4, 1 + n // 16
                first = _ordered(s, hot, rank, k + max(2, c))
                if n <= boundary:
                    a, b = pairs[k + 2]
                    keys.append(_mixed(first[a], first[b]))
                    places.append((n << 32) + LIGHT + a)
                if 4 * n > 3 * boundary:
                    keys.append(first[: k + c])
                    places.append((n << 32) + np.arange(k + c))
                fps.append(np.full(len(keys[-1]) + (len(keys[-2]) if n <= boundary and 4 * n > 3 * boundary else 0), fp, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(fps)), *map(pa.array, _packed(np.concatenate(keys), np.concatenate(places).astype(np.int64)))], names=["fp", "key", "rest"])

    return run


def _needed(pa_, pb):
    """In how many lists the two must meet."""
    return 1 + np.minimum(pa_ >> 32, pb >> 32) // 16


def _room(pa_: np.ndarray, pb: np.ndarray) -> np.ndarray:
    """Whether the sizes and the places of a shared key allow a similarity of 3/4, the key being among the first needed ones."""
    na, nb, ia, ib = pa_ >> 32, pb >> 32, pa_ & (LIGHT - 1), pb & (LIGHT - 1)
    spare = np.where(pa_ & LIGHT, 0, _needed(pa_, pb) - 1)
    return 7 * (np.minimum(na - ia, nb - ib) + spare) >= 3 * (na + nb)


def _lists(batches):
    """Sorted packed rows of keys in; meetings (kind 0: a, b, their weight, place = the weight needed) and rows of long lists (kind 1: a =
    key, b = fp, place) out. A light key alone is enough."""
    _lean()
    held = np.zeros((3, 0), np.int64)
    done = 0  # rows of held that were centers already
    look = LIST + 1

    def emit(held: np.ndarray, start: int, stop: int):
        key, fp, place = held
        n = len(key)
        top = np.zeros(n, bool)  # starts of look equal keys
        if n > LIST:
            top[: n - LIST] = key[: n - LIST] == key[LIST:]
        mark = np.zeros(n + 1, np.int64)
        starts = np.flatnonzero(top)
        np.add.at(mark, starts, 1)
        np.add.at(mark, np.minimum(starts + look, n), -1)
        long = np.cumsum(mark[:-1]) > 0
        out = []
        for d in range(1, LIST):
            i = np.arange(start, min(stop, n - d))
            i = i[(key[i] == key[i + d]) & (fp[i] != fp[i + d]) & (~long[i] if d > NEIGHBOURS else True)]
            if not len(i):
                if d > NEIGHBOURS:
                    break
                continue
            i = i[_room(place[i], place[i + d])]
            out.append(np.stack([np.minimum(fp[i], fp[i + d]), np.maximum(fp[i], fp[i + d]), _needed(place[i], place[i + d]), place[i] & LIGHT], 1))
        pairs, count = np.unique(np.concatenate(out), axis=0, return_counts=True) if out else (np.zeros((0, 4), np.int64), np.zeros(0, np.int64))
        rows = np.arange(start, stop)[long[start:stop]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.zeros(len(pairs), np.int8), np.ones(len(rows), np.int8)])), pa.array(np.concatenate([pairs[:, 0], key[rows]])), pa.array(np.concatenate([pairs[:, 1], fp[rows]])), pa.array(np.concatenate([pairs[:, 2], place[rows]])), pa.array(np.concatenate([np.where(pairs[:, 3] > 0, LIGHT, count), np.zeros(len(rows), np.int64)]))],
            names=["kind", "a", "b", "place", "weight"],
        )

    for batch in batches:
        fp, moved, rest = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "key", "rest"))
        key, place = _unpacked(moved, rest)
        new = np.stack([key, fp, place])
        held = np.concatenate([held, new], 1)
        stop = held.shape[1] - look
        if stop > done:
            yield from emit(held, done, stop)
            cut = max(0, stop - look)
            held, done = held[:, cut:], stop - cut
    if held.shape[1] > done:
        yield from emit(held, done, held.shape[1])


def _sets(shared, order):
    """fp, shingles and signature of the classes that are wanted (all without a list), each once in a task."""

    def run(batches):
        _lean()
        wanted, collided, seen = shared.value if shared else None, order.value[2], set()
        for batch in batches:
            fps, sets, signs = [], [], np.zeros((batch.num_rows, SIGNATURE), np.int64)
            for raw in _raw(batch, "text"):
                s = shingles(raw)
                if len(s) < 2:
                    continue
                fp = identity(s, collided)
                if fp in seen or (wanted is not None and not (len(wanted) and wanted[min(np.searchsorted(wanted, fp), len(wanted) - 1)] == fp)):
                    continue
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(fp)
                signs[len(fps)] = signature(s)
                fps.append(fp)
                sets.append(s.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(sets, pa.binary()), *map(pa.array, signs[: len(fps)].T.copy())], names=["fp", "bin", *SIGNS])

    return run


def _held(bin: bytes) -> np.ndarray:
    """The shingles of a set as it is moved: the upper 48 bits of each, in order."""
    out = np.zeros((len(bin) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(bin, np.uint8).reshape(-1, 6)
    return out.view(np.uint64)[:, 0]


def _verify(batches):
    _lean()
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            s, t = _held(x.as_py()), _held(y.as_py())
            both = len(np.intersect1d(s, t, assume_unique=True))
            ok.append(100 * both >= 75 * (len(s) + len(t) - both))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))


def sets_of(texts: DataFrame, wanted: DataFrame, order) -> DataFrame:
    """fp, bin (its shingles), signature of each class in wanted (fp). The sets are stored where they are made, and not shuffled:
    of a class that several tasks have made one row counts."""
    spark = texts.sparkSession
    shared, wanted = None, stored(wanted.distinct(), "jaccard-wanted")
    if wanted.count() <= PREFILTER:
        shared = spark.sparkContext.broadcast(np.sort(np.array([r.fp for r in wanted.toLocalIterator()], np.int64)))
    with arrow_batches(spark, BATCH):
        made = texts.mapInArrow(_sets(shared, order), f"fp long, bin binary, {', '.join(f'{c} long' for c in SIGNS)}")
        made = stored(made.withColumn("row", F.monotonically_increasing_id()), "jaccard-sets")
    again = made.groupBy("fp").agg(F.sort_array(F.collect_list("row")).alias("rows")).where(F.size("rows") > 1)
    again = stored(again.select(F.explode(F.slice("rows", 2, F.size("rows"))).alias("row")), "jaccard-again")
    if again.count() <= PREFILTER:
        return made.join(F.broadcast(again), "row", "left_anti").drop("row")
    return stored(made.groupBy("fp").agg(*[F.first(c).alias(c) for c in ("bin", *SIGNS)]), "jaccard-sets")


def verified(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The stored pairs (a, b) whose sets are similar. Only the sets that they name are shuffled."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.lit(1).alias("n")), "jaccard-named")
    sets = lookup(sets.select("fp", "bin"), wanted, "fp", "n", "left_semi")
    joined = pairs.join(sets.select(F.col("fp").alias("a"), F.col("bin").alias("x")), "a").join(sets.select(F.col("fp").alias("b"), F.col("bin").alias("y")), "b")
    with arrow_batches(pairs.sparkSession, BATCH):
        return stored(joined.select("a", "b", "x", "y").mapInArrow(_verify, "a long, b long"), "jaccard-links")


def _bits(x: str, y: str) -> Column:
    """In how many bits the signatures of x and y differ."""
    return sum((F.bit_count(F.col(x + c).bitwiseXOR(F.col(y + c))) for c in SIGNS[1:]), F.bit_count(F.col(x + SIGNS[0]).bitwiseXOR(F.col(y + SIGNS[0]))))


def _room_of(x: str, y: str) -> tuple:
    """For entries x and y of a list: whether places and signatures leave room for the similarity, in how many lists they must meet,
    the weight of this one, and whether signatures can tell such sizes apart.

    Sets of that similarity differ in at most a seventh of their sizes' sum, and signatures in no more bits than sets in shingles.
    """
    size_x, size_y = F.shiftright(f"{x}place", 32), F.shiftright(f"{y}place", 32)
    at_x, at_y = F.col(f"{x}place").bitwiseAND(LIGHT - 1), F.col(f"{y}place").bitwiseAND(LIGHT - 1)
    light = F.col(f"{x}place").bitwiseAND(LIGHT) > 0
    needed = F.lit(1) + F.floor(F.least(size_x, size_y) / 16)
    room = (7 * (F.least(size_x - at_x, size_y - at_y) + F.when(light, 0).otherwise(needed - 1)) >= 3 * (size_x + size_y)) & (7 * _bits(x, y) <= size_x + size_y)
    return room, needed, F.when(light, LIGHT).otherwise(1), size_x + size_y < TELLING


def _open(long: DataFrame, forest: DataFrame, turn: int) -> DataFrame:
    """The entries of long lists that hold several components (key, fp, place, signature, component), with two hubs of their list:
    members of its largest component (p) and of all (r). In the first turn these are the same for most lists, later they differ."""
    label = stored(forest.groupBy(F.col("a").alias("fp")).agg(F.min("b").alias("component"), F.lit(1).alias("n")), "jaccard-known")
    known = lookup(long, label, "fp", "n").withColumn("component", F.coalesce("component", "fp"))
    rank = F.xxhash64(F.lit(turn), "key", "fp") if turn else F.xxhash64("fp")
    hub = F.struct(rank.alias("rank"), "fp", "place", "component", *SIGNS)
    parts = known.groupBy("key", "component").agg(F.count("*").alias("c"), F.max(hub).alias("hub"))
    lists = parts.groupBy("key").agg(F.sum("c").alias("n"), F.count("*").alias("m"), F.max_by("hub", F.struct("c", "hub")).alias("p"), F.max("hub").alias("r"))
    return lookup(known, stored(lists.where("m > 1").drop("m"), "jaccard-open"), "key", "n", "inner", 50_000)


def _at_hubs(rest: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of a class and a hub: those that meet in enough lists, or, after the first turn, whose signatures are near."""
    met = []
    for hub in ("p", "r"):
        room, needed, weight, telling = _room_of("", f"{hub}.")
        pair = F.struct(F.least("fp", f"{hub}.fp").alias("a"), F.greatest("fp", f"{hub}.fp").alias("b"), needed.alias("needed"), F.when(telling & F.lit(turn > 0), LIGHT).otherwise(weight).alias("weight"))
        met.append(F.when((F.col("component") != F.col(f"{hub}.component")) & room, pair))
    met = rest.select(F.explode(F.array_compact(F.array(*met))).alias("met")).select("met.*")
    return met.groupBy("a", "b").agg(F.sum("weight").alias("weight"), F.max("needed").alias("needed")).where("weight >= needed").select("a", "b")


def _groups(rest: DataFrame) -> DataFrame:
    """Entries of lists (key, fp, place, signature, component, largest: the list's largest component, apart: whether the entry is of
    another one) as a row for each class and group of lists: g, light, fp, size, signature, component, apart, at and keys, in order.

    Lists with the same largest component are one group; but where its classes make more pairs than those of each list added up,
    as the lists have little else in common, each of them is a group.
    """
    light, at = F.col("place").bitwiseAND(LIGHT) > 0, F.col("place").bitwiseAND(LIGHT - 1).cast("int")
    rest = rest.withColumn("light", light).withColumn("g", F.xxhash64("largest", "light"))
    lists = rest.groupBy("g", "key").agg((F.count("*") * F.count_if("apart")).alias("pairs")).groupBy("g").agg(F.sum("pairs").alias("pairs"))
    same = [F.first(c).alias(c) for c in (*SIGNS, "component", "apart")]
    classes = rest.groupBy("g", "light", "fp").agg(F.shiftright(F.first("place"), 32).alias("size"), *same, F.sort_array(F.collect_list(F.struct(at.alias("at"), "key"))).alias("entries"))
    classes = stored(classes, "jaccard-classed")
    wide = classes.groupBy("g").agg(F.count("*").alias("n"), F.count_if("apart").alias("m")).join(lists, "g").where("n * m > pairs").select("g", "n", F.lit(True).alias("wide"))
    each = F.transform("entries", lambda e: F.struct(e["key"].alias("g"), F.array(e).alias("entries")))
    classes = lookup(classes, stored(wide, "jaccard-wide"), "g", "n").withColumn("of", F.explode(F.when(F.col("wide"), each).otherwise(F.array(F.struct("g", "entries")))))
    return classes.select("of.g", "light", "fp", "size", *SIGNS, "component", "apart", F.col("of.entries.at").alias("at"), F.col("of.entries.key").alias("keys"))


def _meetings(rest: DataFrame) -> DataFrame:
    """a, b, the weight needed and that of the keys that they share in a group, of the rows of groups that are of different
    components, one at least apart, and whose signatures are near. A large group is cut in parts of at most about MEETING pairs."""
    crowd = rest.groupBy("g").agg(F.ceil(F.sqrt(F.count_if("apart") * F.count("*") / MEETING)).cast("int").alias("side"), F.count("*").alias("n")).where("side > 1")
    rest = lookup(rest, stored(crowd, "jaccard-crowd"), "g", "n").withColumn("side", F.coalesce("side", F.lit(1)))
    own, other = F.pmod(F.xxhash64("fp"), F.col("side")).cast("int"), F.sequence(F.lit(0), F.col("side") - 1)
    x = rest.where("apart").withColumn("part", F.explode(F.transform(other, lambda k: own * F.col("side") + k))).alias("x")
    y = rest.withColumn("part", F.explode(F.transform(other, lambda k: k * F.col("side") + own))).alias("y")
    both = F.col("x.size") + F.col("y.size")
    needed = F.lit(1) + F.floor(F.least("x.size", "y.size") / 16)

    def early(side: str) -> Column:
        """The keys whose places leave room for the similarity, see _room()."""
        last = 7 * (F.col(f"{side}.size") + F.when(F.col("x.light"), 0).otherwise(needed - 1)) - 3 * both
        return F.slice(f"{side}.keys", F.lit(1), F.size(F.filter(f"{side}.at", lambda k: 7 * k <= last)))

    same = (F.col("x.g") == F.col("y.g")) & (F.col("x.light") == F.col("y.light")) & (F.col("x.part") == F.col("y.part"))
    apart = (F.col("x.component") != F.col("y.component")) & (~F.col("y.apart") | (F.col("x.fp") < F.col("y.fp")))
    # x, of which a part has few rows, is the side that a merge join holds in memory
    near = (4 * F.least("x.size", "y.size") >= 3 * F.greatest("x.size", "y.size")) & (7 * _bits("x.", "y.") <= both)
    met = y.join(x, same & apart & near)
    weight = F.size(F.array_intersect(early("x"), early("y"))).cast("long") * F.when(F.col("x.light"), LIGHT).otherwise(1)
    return met.select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b"), needed.alias("needed"), weight.alias("weight"))


def boundary_of(sizes: list[tuple[int, int]], list_length: float) -> int:
    """The size up to which sets are light: sizes are (size, number of classes)."""

    def cost(limit: int) -> float:
        light = sum(c * (n // 4 + 2) * (n // 4 + 1) / 2 for n, c in sizes if 2 <= n <= limit)
        return light + list_length * sum(c * (n // 4 + 1) for n, c in sizes if 4 * n > 3 * limit)

    return min(LIMITS, key=lambda limit: (cost(limit), limit))


def _told(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, n, fp of its class), and of each class whose rows learn something new (fp) n, its rows, and component_id."""
    spark = texts.sparkSession
    kind = texts.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    with arrow_batches(spark, BATCH):
        told = stored(texts.mapInArrow(_describe(to_arrow_type(kind)), f"kind tinyint, doc_id {kind.simpleString()}, n long, fp long, fp2 long"), "jaccard-docs")
    # unequal sets of one fingerprint: about (classes ** 2) / 2 ** 65 of them
    collided = [r.fp for r in told.where("kind = 0 and fp is not null").groupBy("fp").agg(F.min("fp2").alias("x"), F.max("fp2").alias("y")).where("x <> y").select("fp").collect()]
    rows = told.where("kind = 0").withColumn("fp", F.when(F.col("fp").isin(collided), F.col("fp2")).otherwise(F.col("fp")) if collided else F.col("fp"))
    frequent = told.where("kind = 1").groupBy("fp").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "fp").limit(MOST).collect()
    values = np.array([r.fp for r in frequent], np.int64).view(np.uint64)
    order = np.argsort(values)
    shared = spark.sparkContext.broadcast((values[order], np.array([r.n for r in frequent], np.int64)[order], frozenset(collided)))
    # sizes beyond the largest boundary cost alike, so that a few rows tell all
    width = F.least("n", F.lit(2 * LIMITS[-1])).alias("n")
    sizes = [(r.n, r.c) for r in rows.where("n > 1").groupBy(width).agg(F.approx_count_distinct("fp").alias("c")).collect()]
    total, weighted = sum(c * n for n, c in sizes), sum(float(r.n) * r.n for r in frequent)
    boundary = boundary_of(sizes, 1 + weighted / max(1, total))
    keys, key = texts.mapInArrow(_keys(shared, boundary), "fp long, key long, rest long"), F.col("key").bitwiseAND(KEY)
    with arrow_batches(spark, BATCH):
        listed = stored(keys.repartition(key).sortWithinPartitions(key, "fp").mapInArrow(_lists, "kind tinyint, a long, b long, place long, weight long"), "jaccard-lists")
    met = stored(listed.where("kind = 0").groupBy("a", "b").agg(F.sum("weight").alias("weight"), F.max("place").alias("needed")), "jaccard-met")
    long = stored(listed.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"), "place").distinct(), "jaccard-long")
    pairs = met.where("weight >= needed").select("a", "b")
    sets = sets_of(texts, pairs.select(F.explode(F.array("a", "b")).alias("fp")).unionByName(long.select("fp")), shared)
    forest = verified(sets, pairs)
    if long.limit(1).count():
        long = stored(long.join(sets.select("fp", *SIGNS), "fp"), "jaccard-signed")
        # most classes of a long list are linked through a few; what is then still apart is compared in full
        for turn in range(ROUNDS):
            forest = star(forest, "jaccard-edges", STEPS)
            forest = forest.unionByName(verified(sets, stored(_at_hubs(_open(long, forest, turn), turn), "jaccard-more")))
        forest = star(forest, "jaccard-edges")
        # pairs between components, of which one at least is not the list's largest
        rest = _open(long, forest, 0).withColumn("largest", F.col("p.component")).drop("p", "r")
        rest = stored(rest.withColumn("apart", F.col("component") != F.col("largest")), "jaccard-rest")
        again = _meetings(stored(_groups(rest), "jaccard-groups"))
        again = again.groupBy("a", "b").agg(F.sum("weight").alias("more"), F.max("needed").alias("needed"))
        # the lists that were counted before may count twice; that only adds candidates
        open_pairs = again.join(met.select("a", "b", "weight"), ["a", "b"], "left").where("coalesce(weight, 0) < needed and more + coalesce(weight, 0) >= needed")
        forest = forest.unionByName(verified(sets, stored(open_pairs.select("a", "b"), "jaccard-more")))
    found = components(forest, "jaccard-edges")
    classes = rows.where("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    joined = stored(classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp")), "jaccard-classes")
    lowest = joined.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("m"))
    told_by_class = lookup(joined, stored(lowest.where("m > 1"), "jaccard-lowest"), "component", "m").select("fp", "n", F.coalesce("component_id", "least").alias("component_id"), (F.col("n") > 1).alias("many"))
    # only classes of several rows, or linked with others, tell a row something new
    return rows, stored(told_by_class.join(joined.select("fp", "least"), "fp").where("many or not (component_id <=> least)").select("fp", "n", "component_id"), "jaccard-told")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for each row."""
    with shuffles_freed(docs.sparkSession):
        rows, news = _told(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    out = lookup(rows.select("doc_id", F.col("n").alias("n_shingles"), "fp"), news, "fp", "n")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + least(5, len(ws)) - 1], ' ') || CASE WHEN len(ws) < 5 THEN ' #' || len(ws) ELSE '' END AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.b FROM reach r JOIN links l ON r.y = l.a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(y) FROM reach WHERE x = d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""
