"""N-gram Jaccard join: a grouped prefix join over sets of word shingles.

Two sets link when ``100 * common >= percent * union``. Of all shingles in one
fixed order, linked sets share one of the first ``n - ceil(percent n / 100) + 1`` of
each (its prefix), so only sets that meet in a prefix shingle are compared.

1. ``hot_shingles``: shingles of very many sets (a passage of boilerplate) go to the
   end of the order, by hash. Any order is right, this one keeps the lists short. They are found by
   lossy counting over all shingles (each task reports what it meets several times); the
   most frequent ``HOT`` at most are broadcast. Lists that are long all the same make their
   shingles hot, too, and the index is built again.
2. ``described``: each row's set as a number, its size and its prefix in that order. Equal
   sets are one set. Sets with the same prefix and size are one *group*.
3. ``_index``: an inverted index of groups: (shingle, group) range-partitioned and
   sorted, so a shingle that a third of all groups share spans many
   tasks. Shingles of one group are left out.
4. Groups are expanded to members. Rounds: in each sorted list a member looks back a few rows for one of
   another component whose size and signature fit (256 parities of the shingles, which differ in no more bits
   than the sets in shingles), and takes the one that most lists name. Of a large cluster
   this is a pair per member, not all pairs; verified links join components.
5. Rest: all pairs of members that still are in different
   components, meet in a list, have fitting sizes and signatures and share enough of their prefixes
   (``least_common``) are verified. A pair inside one component can add nothing and is not made: in
   each list only members outside its largest component look for partners.
6. ``verified``: pairs whose wide parities (2 to 4 bits a shingle) differ in more bits than linked sets do in shingles are
   left out, so whole sets are moved for few others; the texts of those give their shingles again; exact counts decide.

Shingles and sets are 64-bit hashes; that no two sets or groups got the same number is checked
with a second hash (a clash starts again with another seed). Components are joined on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import on_workers, shuffle_width, stored
from retailflow.llm.components import components

SHINGLE, PERCENT = 4, 85
#: A shingle in more sets than this is hot, and the most of them that are broadcast (8 bytes each).
LONG_LIST, HOT = 64, 1_000_000
#: Shingles counted together, and the count that a task reports.
CHUNK, REPORTED = 4_000_000, 3
#: Pairs in long lists, for each entry of the index, that make their shingles hot.
EXCESS = 4
#: Rounds before the rest, rows that a member looks back; rows of a table that is broadcast (24 bytes each).
ROUNDS, LOOK_BACK, BROADCAST_ROWS = 2, 32, 1_000_000

_C = [np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64)) for i in range(256)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """Sorted different hashes of the shingles; a text of fewer words is one shingle, one of none has none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    v = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(k, len(v))
    out = np.zeros(len(v) - width + 1, np.uint64)
    for i in range(width):
        out += v[i:len(v) - width + 1 + i] * _C[i]
    return np.unique(_mixed(out))


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def prefix(shingles: np.ndarray, hot: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first shingles of a set: by hash, hot ones last."""
    size = prefix_size(len(shingles), percent)
    if not len(hot) or not size:
        return shingles[:size]
    at = np.searchsorted(hot, shingles)
    is_hot = hot[np.minimum(at, len(hot) - 1)] == shingles
    return np.concatenate([shingles[~is_hot], shingles[is_hot]])[:size]


def least_common(a: str, b: str, percent: int = PERCENT) -> str:
    """SQL: how many prefix shingles linked sets of sizes a and b share at least.

    All common shingles but those after the prefix that ends first are common to both prefixes.
    """
    common = f"(({percent} * ({a} + {b}) + {99 + percent}) div {100 + percent})"
    after = [f"(({percent} * {n} + 99) div 100 - 1)" for n in (a, b)]
    return f"greatest(1, {common} - greatest({after[0]}, {after[1]}))"


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def _signed(x) -> pa.Array:
    return pa.array(np.asarray(x, np.uint64).view(np.int64), pa.int64())


def _parities(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Bit i tells whether an odd number of the hashes have i in their low bits (``bits``: a power of two)."""
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def _folded(parities: np.ndarray, size: int) -> np.ndarray:
    """The same parities in ``size`` bytes."""
    return np.bitwise_xor.reduce(parities.reshape(-1, size), axis=0)


def _wide(shingles: np.ndarray) -> np.ndarray:
    """Parities of 2 to 4 bits a shingle, 256 at least."""
    return _parities(shingles, max(256, 1 << (2 * len(shingles) - 1).bit_length() if len(shingles) else 0))


def _signature(shingles: np.ndarray) -> np.ndarray:
    """256 parities as four numbers."""
    return _parities(shingles, 256).view(np.int64)


def hot_shingles(docs: DataFrame, shingle: int) -> np.ndarray:
    """Sorted hashes of the shingles that are often met, in more than ``LONG_LIST`` rows as far as tasks report them."""

    def run(batches):
        held, size = [], 0

        def flush():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            many = n >= REPORTED
            return pa.RecordBatch.from_arrays([_signed(h[many]), pa.array(n[many], pa.int64())], ["h", "n"])

        for b in batches:
            for t in _texts(b.column(0)):
                held.append(shingle_set(t, shingle))
                size += len(held[-1])
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    counted = on_workers(docs).select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return _most(counted.where(F.col("n") > LONG_LIST))


def _most(counted: DataFrame) -> np.ndarray:
    """Sorted hashes ``h`` of the largest ``n``, at most ``HOT`` (whole powers of two of n stay together)."""
    many = stored(counted.select("h", "n"), "jaccard-hot")
    by_size = many.groupBy(F.floor(F.log2("n")).alias("e")).agg(F.count(F.lit(1)).alias("c")).collect()
    total, least = 0, 0
    for r in sorted(by_size, key=lambda r: -r.e):
        total += r.c
        if total > HOT:
            least = 2 ** (r.e + 1) - 1
            break
    rows = many.where(F.col("n") > least).select("h").toLocalIterator()
    return np.sort(np.array([r.h for r in rows], np.int64).view(np.uint64))


_BITS = ("s0", "s1", "s2", "s3")
_SETS = [("k1", pa.int64()), ("k2", pa.int64()), ("sid", pa.int64()), ("sid2", pa.int64()), ("n", pa.int64()), ("gid", pa.int64()),
         ("gid2", pa.int64()), ("head", pa.binary()), ("wide", pa.binary()), *((f"s{i}", pa.int64()) for i in range(4))]


def described(docs: DataFrame, hot: np.ndarray, seed: int, shingle: int, percent: int) -> DataFrame:
    """``doc_id, k1, k2, sid, sid2, n, gid, gid2, head, wide, s0 … s3`` for every row: set, size, group, prefix, signatures."""
    shared = docs.sparkSession.sparkContext.broadcast(hot.tobytes())
    salts = [4 * seed + i for i in range(4)]

    def run(batches):
        hot = np.frombuffer(shared.value, np.uint64)
        for b in batches:
            rows = []
            for text in _texts(b.column(3)):
                s = shingle_set(text, shingle)
                head = prefix(s, hot, percent)
                ids = [xxhash.xxh64_intdigest(s.tobytes(), x) for x in salts[:2]]
                whole = np.sort(head).tobytes() + len(s).to_bytes(8, "little")
                groups = [xxhash.xxh64_intdigest(whole, x) for x in salts[2:]]
                wide = _wide(s)
                rows.append((*ids, len(s), *groups, head.tobytes(), wide.tobytes(), *_folded(wide, 32).view(np.int64).tolist()))
            if rows:
                ids, ids2, n, groups, groups2, heads, wides, *bits = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2), _signed(ids), _signed(ids2), pa.array(n, pa.int64()),
                     _signed(groups), _signed(groups2), pa.array(heads, pa.binary()), pa.array(wides, pa.binary()), *(pa.array(x, pa.int64()) for x in bits)], ["doc_id", *(x for x, _ in _SETS)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return on_workers(docs).mapInArrow(run, f"doc_id {kind}, k1 long, k2 long, sid long, sid2 long, n long, gid long, "
                                            "gid2 long, head binary, wide binary, s0 long, s1 long, s2 long, s3 long")


def _clash(sets: DataFrame) -> bool:
    """Whether two sets or two groups have the same number."""
    def differ(a: str, b: str) -> DataFrame:
        return sets.groupBy(a).agg((F.min(b) != F.max(b)).alias("bad")).where("bad").select("bad")

    return bool(differ("sid", "sid2").unionAll(differ("gid", "gid2")).limit(1).count())


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        heads = [np.frombuffer(x, np.int64) for x in b.column(1).to_pylist()]
        sizes = [len(x) for x in heads]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(heads)), pa.array(np.repeat(b.column(0).to_numpy(), sizes))], ["h", "gid"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (h, gid): those of a shingle with several rows.

    The first and last shingle of a partition stay in any case, as they may go on in another.
    """
    held, first = None, None

    def shown(h, gid, end: bool) -> pa.RecordBatch:
        """All rows but the first, which was shown before, and unless at the end the last, which waits."""
        same = h[1:] == h[:-1]
        show = np.concatenate(([False], same)) | np.concatenate((same, [False])) | (h == first)
        show[0], show[-1] = False, end
        return pa.RecordBatch.from_arrays([pa.array(h[show]), pa.array(gid[show])], ["h", "gid"])

    for b in batches:
        now = [c.to_numpy() for c in b.columns]
        if not len(now[0]):
            continue
        if held is None:
            first = now[0][0]
            # a row that no other equals stands before the first
            held = [np.array([~now[0][0]]), now[1][:1]]
        now = [np.concatenate(x) for x in zip(held, now, strict=True)]
        yield shown(*now, False)
        held = [x[-2:] for x in now]
    if held is not None:
        yield shown(*held, True)


def _sorted(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartitionByRange(shuffle_width(rows.sparkSession), *keys).sortWithinPartitions(*keys)


def allowed(n: str, m: str, percent: int = PERCENT) -> str:
    """SQL: in how many shingles linked sets of sizes n and m differ at most."""
    return f"({n} + {m} - 2 * (({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent}))"


def near_before(rows: DataFrame, percent: int, order: str) -> DataFrame:
    """``sid, other``: for each row (h, sid, n, comp, s0 … s3) of a list a row before it in another component and with
    fitting size and signature: of the last ``LOOK_BACK`` rows the farthest, which keeps the chains of links short."""

    def run(batches):
        held = None
        for b in batches:
            now = [c.to_numpy() for c in b.columns]
            known = 0 if held is None else len(held[0])
            now = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            h, sid, n, comp, *bits = now
            bits = [x.view(np.uint64) for x in bits]
            other = np.full(len(h), -1)
            for d in range(min(LOOK_BACK, len(h) - 1), 0, -1):
                at = np.flatnonzero((other[d:] < 0) & (h[d:] == h[:-d]) & (comp[d:] != comp[:-d])) + d
                at = at[at >= known]
                x, y = n[at], n[at - d]
                fit = 100 * np.minimum(x, y) >= percent * np.maximum(x, y)
                at, x, y = at[fit], x[fit], y[fit]
                apart = sum(np.bitwise_count(s[at] ^ s[at - d]).astype(np.int64) for s in bits)
                near = apart <= x + y - 2 * ((percent * (x + y) + 99 + percent) // (100 + percent))
                other[at[near]] = at[near] - d
            found = np.flatnonzero(other >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(sid[found]), pa.array(sid[other[found]])], ["sid", "other"])
            held = [x[-LOOK_BACK:] for x in now]

    ranged = _sorted(rows.select("h", F.expr(order).alias("place"), "sid", "n", "comp", *_BITS), "h", "place", "sid")
    return ranged.select("h", "sid", "n", "comp", *_BITS).mapInArrow(run, "sid long, other long")


def _ends(pairs: DataFrame, name: str) -> DataFrame:
    """``sid`` of the sets in pairs, for a join with a large table."""
    ends = stored(pairs.select(F.col("a").alias("sid")).unionAll(pairs.select(F.col("b").alias("sid"))).distinct(), name)
    return F.broadcast(ends) if ends.count() <= BROADCAST_ROWS else ends


def _fitting(sets: DataFrame, pairs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The pairs that may link by their wide parities, and ``sid, k1, k2``: where the text of a set in any pair is."""
    one = sets.join(_ends(pairs, "jaccard-ends"), "sid").groupBy("sid").agg(
        F.first("n").alias("n"), F.first("wide").alias("wide"), F.min(F.struct("k1", "k2")).alias("k"))
    one = stored(one.select("sid", "n", "wide", "k.k1", "k.k2"), "jaccard-wide")

    def fit(batches):
        for b in batches:
            keep = []
            for n, m, x, y in zip(*(b.column(i).to_pylist() for i in range(2, 6)), strict=True):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                size = min(len(x), len(y))
                apart = int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum(dtype=np.int64))
                keep.append(apart <= n + m - 2 * ((percent * (n + m) + 99 + percent) // (100 + percent)))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = (one.select(F.col("sid").alias(e), F.col("n").alias(f"{e}_n"), F.col("wide").alias(f"{e}_wide")) for e in "ab")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "a_n", "b_n", "a_wide", "b_wide")
    return stored(on_workers(both).mapInArrow(fit, "a long, b long"), "jaccard-fitting"), one.select("sid", "k1", "k2")


def verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of sets that link, by exact counts of their shingles."""
    pairs, one = _fitting(sets, stored(pairs.distinct(), "jaccard-pairs"), percent)
    one = stored(one.join(_ends(pairs, "jaccard-wanted"), "sid"), "jaccard-places")
    if one.count() <= BROADCAST_ROWS:
        one = F.broadcast(one)

    def shingles(batches):
        seen = set()  # a repeated row is one row of each task
        for b in batches:
            sids = b.column(0).to_pylist()
            fresh = [i for i, sid in enumerate(sids) if not (sid in seen or seen.add(sid))]
            found = [shingle_set(t, shingle).tobytes() for t in _texts(b.column(1).take(pa.array(fresh, pa.int64())))]
            yield pa.RecordBatch.from_arrays([pa.array([sids[i] for i in fresh], pa.int64()), pa.array(found, pa.binary())],
                                             ["sid", "shingles"])

    texts = docs.join(one, ["k1", "k2"]).select("sid", "text")
    known = stored(on_workers(texts).mapInArrow(shingles, "sid long, shingles binary"), "jaccard-sets")

    def compare(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = known.toDF("a", "x"), known.toDF("b", "y")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _index(sets: DataFrame) -> DataFrame:
    """``h, gid``: the lists of the groups' prefix shingles that several groups share."""
    groups = sets.where("n > 0").groupBy("gid").agg(F.first("head").alias("head"))
    posts = on_workers(groups).mapInArrow(_spread, "h long, gid long")
    return stored(_sorted(posts, "h", "gid").mapInArrow(_shared, "h long, gid long"), "jaccard-lists")


def _described(src: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Sets and lists in an order that leaves no long list of shingles that are not known to be hot."""
    hot, seed = hot_shingles(src, shingle), 0
    while True:
        seed += 1
        sets = stored(described(src, hot, seed, shingle, percent), "jaccard-sets")
        if _clash(sets):
            continue
        lists = _index(sets)
        sizes = lists.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        known = src.sparkSession.createDataFrame([], "h long") if not len(hot) else \
            sets.sparkSession.createDataFrame(pa.table({"h": hot.view(np.int64)}))
        long = stored(sizes.where(F.col("n") > LONG_LIST).join(F.broadcast(known), "h", "left_anti"), "jaccard-long")
        pairs = long.agg(F.sum(F.col("n").cast("double") * F.col("n") / 2)).first()[0] or 0
        if pairs <= EXCESS * lists.count() or len(hot) >= HOT:
            return sets, lists
        hot = np.union1d(hot, _most(long))


def linked(docs: DataFrame, sets: DataFrame, lists: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``sid, comp``: the component of every set with shingles."""
    members = stored(sets.where("n > 0").groupBy("gid", "sid").agg(*[F.first(c).alias(c) for c in ("n", *_BITS)]), "jaccard-members")
    named = members.withColumn("comp", F.col("sid"))
    for turn in range(ROUNDS):
        rows = lists.join(named, "gid") if not turn else _mixed_lists(lists, named)
        near = near_before(rows, percent, "n" if not turn else f"xxhash64(sid, {turn})")
        # of the sets named by any list the one that most lists name
        best = near.groupBy("sid", "other").agg(F.count(F.lit(1)).alias("c")) \
            .groupBy("sid").agg(F.max(F.struct("c", "other")).alias("best"))
        two = best.select(*_ordered("sid", "best.other"))
        if not turn:
            # members of one group share their whole prefix: each with the first
            first = members.groupBy("gid").agg(F.count(F.lit(1)).alias("m"), F.min("sid").alias("first")).where("m > 1")
            two = two.unionAll(members.join(first, "gid").where("sid != first").select(*_ordered("sid", "first")))
        named = _joined(named, verified(docs, sets, two, shingle, percent))
    # the rest: whatever meets in a list or a group and is in different components still
    return _joined(named, verified(docs, sets, _apart(lists, named, percent), shingle, percent)).select("sid", "comp")


def _joined(named: DataFrame, found: DataFrame) -> DataFrame:
    """The members with their components joined by the links ``a, b``."""
    comp = named.select("sid", "comp")
    edges = found.join(comp.toDF("a", "x"), "a").join(comp.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    roots = components(edges, "jaccard-components").toDF("comp", "root")
    return stored(named.join(roots, "comp", "left").withColumn("comp", F.coalesce("root", "comp")).drop("root"), "jaccard-named")


def _mixed_lists(lists: DataFrame, named: DataFrame) -> DataFrame:
    """Members in the long lists that hold several components (the pairs of the others are few, and left to the rest)."""
    every = lists.join(named, "gid")
    mixed = every.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("c")) \
        .where(f"lo != hi and c > {LONG_LIST}").select("h")
    return every.join(mixed, "h")


def _apart(lists: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets in different components that meet in a list or a group and may link by size, signature and prefix."""
    keys = ["sid", "gid", "n", "comp", *_BITS]
    every = lists.select("h", "gid").join(named, "gid").select("h", *keys)
    sizes = every.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("c"))
    top = sizes.groupBy("h").agg(F.max_by("comp", F.struct("c", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")) \
        .where("comps > 1").select("h", "top")
    every = stored(every.join(top, "h"), "jaccard-rest")
    x = every.where("comp != top").select("h", "top", *[F.col(c).alias(f"x_{c}") for c in keys])
    y = every.select("h", *[F.col(c).alias(f"y_{c}") for c in keys])
    apart = " + ".join(f"bit_count(x_{b} ^ y_{b})" for b in _BITS)
    fit = f"x_comp != y_comp and 100 * least(x_n, y_n) >= {percent} * greatest(x_n, y_n) and {apart} <= {allowed('x_n', 'y_n', percent)}"
    met = x.join(y, "h").where(f"(y_comp = top or x_sid < y_sid) and {fit}")
    enough = met.groupBy("x_sid", "y_sid", "x_n", "y_n").agg(F.count(F.lit(1)).alias("k")) \
        .where("k >= " + least_common("x_n", "y_n", percent))
    # members of one group share their whole prefix, which may be in no list
    split = named.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("gid")
    both = named.join(split, "gid")
    left, right = (both.select("gid", *[F.col(c).alias(f"{side}_{c}") for c in keys if c != "gid"]) for side in "xy")
    within = left.join(right, "gid").where(f"x_sid < y_sid and {fit}")
    return enough.select(*_ordered("x_sid", "y_sid")).unionAll(within.select(*_ordered("x_sid", "y_sid")))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, set_id``.

    ``n_shingles`` different shingles of ``shingle`` words (A-Z folded; a text of
    fewer words is one shingle); ``component_id`` the smallest ``doc_id`` that links reach, its own
    included; rows with the same ``set_id`` have the same shingles. A null or blank text has no shingles and
    links with nothing, so its component is its own id. Repeated rows have the same
    component. A null id stays null and is a component's id only if the component
    has no other. An empty table gives an empty result; other columns are ignored.
    """
    rid, text = F.col(id_col), F.col(text_col).cast("string")
    src = docs.select(rid.alias("doc_id"), F.xxhash64(rid, F.lit(1)).alias("k1"), F.xxhash64(text, F.lit(2)).alias("k2"),
                      F.coalesce(text, F.lit("")).alias("text"))
    sets, lists = _described(src, shingle, percent)
    classes = sets.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("first"))
    comps = classes.join(linked(src, sets, lists, shingle, percent), "sid")
    least = comps.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = comps.join(least, "comp").select("sid", "component_id")
    return sets.join(named, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("sid").alias("set_id"))
