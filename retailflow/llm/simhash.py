"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints are 64 bits over the XXH64 hashes of a text's word shingles. All
pairs of distinct fingerprints within ``distance`` bits are found exactly:

1. The 64 bits are cut into ``distance + 1`` fields. Two fingerprints within
   the distance agree in one field at least, so each goes to one bucket per
   field.
2. Buckets are sorted by the Gray rank of the fingerprint, which puts patterns
   that share most bits side by side, and the sorted run is cut into leaf
   groups of bounded size. Spark sorts and cuts (range partitioning), so a
   bucket that holds a third of all rows is many groups in many tasks.
3. Each group is factored into upper nodes: the mask of the bits that all its
   fingerprints share and their common pattern. Two groups whose patterns
   differ in more than ``distance`` shared bits are pruned whole, first
   between groups (in the join) and then between the nodes inside two groups;
   only what is left is compared bit by bit.
4. A pair of groups returns no pairs but a spanning forest of its links. The
   forests are merged into components on Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retailflow.llm.common import on_workers, shuffle_width, stored
from retailflow.llm.components import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Fingerprints in a leaf group, and in a node inside it.
GROUP, NODE = 2_048, 64
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of one text (UTF-8): a bit is 1 if over half the shingle hashes set it.

    Words are runs of anything but space and ``\\t\\n\\x0b\\x0c\\r`` after folding A-Z;
    a text of fewer words than a shingle is one shingle, one of no words is 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(flat, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-shingle] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(flat[a:b], SEED) for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist(), strict=True)]
    h = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, np.int64)
    for block in range(0, len(h), 65_536):
        bits = np.unpackbits(h[block:block + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_key, fp`` for every row (signed 64-bit; text_key tells texts apart); a null text has no words (fp 0)."""

    def run(batches):
        for b in batches:
            texts = b.column(2).cast(pa.large_binary()).to_pylist()
            fps = np.array([fingerprint(t or b"", shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())],
                                             ["doc_id", "text_key", "fp"])

    src = docs.select(F.col(id_col).alias("doc_id"), _text_key(text_col).alias("text_key"),
                      F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return on_workers(src).mapInArrow(run, f"doc_id {kind}, text_key long, fp long")


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).cast("string"), F.lit(3))


def gray_rank(v: Column) -> Column:
    """Position of a bit pattern in reflected Gray order (as a signed 64-bit value)."""
    for s in (1, 2, 4, 8, 16, 32):
        v = v.bitwiseXOR(F.shiftrightunsigned(v, s))
    return v


def _fields(parts: int) -> list[tuple[int, int]]:
    """(shift, width) of ``parts`` fields that together are the 64 bits."""
    ends = [round(64 * i / parts) for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _pattern(v: np.ndarray) -> tuple[int, int]:
    """Mask of the bits that all values share, and their common value there."""
    mask = int(~(np.bitwise_or.reduce(v) ^ np.bitwise_and.reduce(v)) & _ONES)
    return mask, int(v[0]) & mask


class _Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def _nodes(v: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    spans = [(a, min(a + NODE, len(v))) for a in range(0, len(v), NODE)]
    found = [_pattern(v[a:b]) for a, b in spans]
    return spans, np.array([m for m, _ in found], np.uint64), np.array([p for _, p in found], np.uint64)


def group_links(left: np.ndarray, right: np.ndarray | None, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """A spanning forest of the links between two Gray-ordered groups (or inside one, right None).

    Pairs of fingerprints; whole nodes are pruned by the differences of their shared patterns.
    """
    same = right is None
    other = left if same else right
    spans_l, mask_l, pat_l = _nodes(left)
    spans_r, mask_r, pat_r = (spans_l, mask_l, pat_l) if same else _nodes(other)
    apart = np.bitwise_count((pat_l[:, None] ^ pat_r[None, :]) & mask_l[:, None] & mask_r[None, :])
    forest = _Forest(len(left) if same else len(left) + len(other))
    shift, out = 0 if same else len(left), []
    for x, y in zip(*np.nonzero(apart <= distance), strict=True):
        if same and y < x:
            continue
        (a, b), (c, d) = spans_l[x], spans_r[y]
        near = np.bitwise_count(left[a:b, None] ^ other[None, c:d]) <= distance
        if same and x == y:
            near = np.triu(near, 1)
        for i, j in zip(*np.nonzero(near), strict=True):
            if forest.join(a + int(i), shift + c + int(j)):
                out.append((int(left[a + i]), int(other[c + j])))
    return out


_GROUP_SCHEMA = "field int, bucket long, node string, mask long, pattern long, fps binary"


def _cut(group: int):
    """Cut sorted rows (field, bucket, fp) into leaf groups, with mask and pattern."""

    def flush(key, values):
        v = np.concatenate(values)
        mask, pattern = _pattern(v)
        signed = np.array([mask, pattern], np.uint64).view(np.int64)
        return key[0], key[1], f"{int(v[0]):016x}", int(signed[0]), int(signed[1]), v.tobytes()

    def run(batches):
        key, held, size = None, [], 0
        for b in batches:
            field, bucket = b.column(0).to_numpy(), b.column(1).to_numpy()
            fp = b.column(2).to_numpy().view(np.uint64)
            edges = np.flatnonzero((np.diff(field) != 0) | (np.diff(bucket) != 0)) + 1
            rows = []
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(fp)], strict=True):
                if e == s:
                    continue
                now = (int(field[s]), int(bucket[s]))
                if key != now and held:
                    rows.append(flush(key, held))
                    held, size = [], 0
                key = now
                while s < e:
                    take = min(e - s, group - size)
                    held.append(fp[s:s + take])
                    s, size = s + take, size + take
                    if size == group:
                        rows.append(flush(key, held))
                        held, size = [], 0
            if rows:
                yield _groups(rows)
        if held:
            yield _groups([flush(key, held)])

    return run


def _groups(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["field", "bucket", "node", "mask", "pattern", "fps"])


def near_links(fps: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """Edges ``a, b`` (long) whose components are those of all links within ``distance`` bits.

    ``fps`` has distinct values ``fp``. No link between different components
    is lost; links inside a component may be left out.
    """
    spark = fps.sparkSession
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("field"),
                 F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)).cast("long").alias("bucket"))
        for i, (s, w) in enumerate(_fields(distance + 1))])).alias("at"))
    keyed = keyed.select("at.field", "at.bucket", "fp", gray_rank(F.col("fp")).alias("gray"))
    ranged = keyed.repartitionByRange(shuffle_width(spark), "field", "bucket", "gray") \
        .sortWithinPartitions("field", "bucket", "gray").select("field", "bucket", "fp")
    groups = stored(on_workers(ranged).mapInArrow(_cut(group), _GROUP_SCHEMA), "simhash-groups")

    def inside(batches):
        for b in batches:
            yield _edges([e for x in b.column(0).to_pylist()
                          for e in group_links(np.frombuffer(x, np.uint64), None, distance)])

    def across(batches):
        for b in batches:
            yield _edges([e for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                          for e in group_links(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), distance)])

    own = groups.select("fps").mapInArrow(inside, "a long, b long")
    # only buckets of several groups meet themselves
    wide = groups.join(groups.groupBy("field", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                       .select("field", "bucket"), ["field", "bucket"])
    x, y = wide.alias("x"), wide.alias("y")
    differ = F.bit_count(F.col("x.pattern").bitwiseXOR(F.col("y.pattern"))
                         .bitwiseAND(F.col("x.mask")).bitwiseAND(F.col("y.mask")))
    pairs = x.join(y, (F.col("x.field") == F.col("y.field")) & (F.col("x.bucket") == F.col("y.bucket"))
                   & (F.col("x.node") < F.col("y.node")) & (differ <= distance))
    more = pairs.select(F.col("x.fps").alias("l"), F.col("y.fps").alias("r")).mapInArrow(across, "a long, b long")
    return own.unionAll(more).distinct()


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    v = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(v[:, 0], pa.int64()), pa.array(v[:, 1], pa.int64())], ["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id, n_copies, text_key, component``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the smallest
    ``doc_id`` reachable over links of at most ``distance`` differing bits;
    ``n_copies`` the rows that share the fingerprint. Null and empty texts have
    fingerprint zero, linked like any other. Repeated rows share a component. A
    null id stays null and is never a component's id unless the component has
    no other. An empty table gives an empty result; other columns are ignored.
    ``component`` numbers the components, those without any id included.
    """
    marked = stored(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_copies"))
    roots = components(near_links(classes.select("fp"), distance), "simhash-edges")
    linked = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.join(least, "root").select("fp", "component_id", "n_copies", F.col("root").alias("component"))
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_copies", "text_key",
        "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of ``docs``, all columns, of each component: that of the smallest id.

    Without ids in a component, one of its rows; of repeated rows, one. Null and blank
    texts share one fingerprint, so one of them stays; an empty table gives an empty result.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    first = found.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_key").alias("key"))).alias("k"))
    keys = ["none", "key", "id"]
    kept = first.select("k.none", "k.key", F.coalesce(F.col("k.id").cast("string"), F.lit("")).alias("id"))
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).isNull().alias("none"), _text_key(text_col).alias("key"),
                       F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"))
    # the join leaves each key's rows together: numbering them moves nothing
    one = Window.partitionBy(*keys).orderBy(*keys)
    return rows.join(kept, keys).withColumn("copy", F.row_number().over(one)).where("copy = 1").select("doc.*")
