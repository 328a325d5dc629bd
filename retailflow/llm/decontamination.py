"""Benchmark decontamination by size-partitioned MinHash containment search.

A short item can hide anywhere in a long document, so the search asks for
containment of the item's shingles, not for resemblance. Items are partitioned
by their number of distinct shingles. Each partition has a sketch depth: for a
containment of at least t, an item of q shingles may miss floor((1 - t) q) of
them, so of its ``floor((1 - t) q) + 1`` least shingle hashes (a bottom-k
MinHash sketch) at least one is in every document that contains it. A document
that meets a sketch is a candidate for the item; documents with fewer than
``t q`` words are not candidates of that partition. Candidates are verified by exact
shingle containment. The sketch depth makes the search lossless, so there is
no recall to tune.

The benchmark's shingles are broadcast after their number has been counted
(at most ``BROADCAST_SHINGLES``); a larger benchmark is searched in as many
slices of items, each of a size within the bound, one pass over the documents
per slice. Documents are read once per slice and never shuffled: only the few
(document, item) findings are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from retailflow.llm.common import on_workers

SHINGLE, CONTAINMENT = 5, 0.8
#: Shingles of the items that one pass holds in each task (about 200 bytes each).
BROADCAST_SHINGLES = 500_000
_C = [np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64)) for i in range(64)]


def words_of(text: bytes) -> list[bytes]:
    """Words (runs of anything but ASCII blanks), A-Z folded."""
    return text.lower().split()


def shingles_of(words: list[bytes], k: int = SHINGLE) -> set[bytes]:
    """Distinct shingles; a text of fewer words is one shingle, one of none has none."""
    if len(words) < k:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)}


def shingle_hashes(words: list[bytes], k: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the shingles in order (the same for a text shorter than a shingle)."""
    v = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(k, len(v))
    if not width:
        return v
    out = np.zeros(len(v) - width + 1, np.uint64)
    for i in range(width):
        out += v[i:len(v) - width + 1 + i] * _C[i]
    return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class Sketches:
    """Sketches and shingles of a slice of items, for a task.

    Items by size partition (powers of two of their shingle count), each with an
    index of its own: a document meets the partitions whose least item it is long enough
    to contain. A flat filter of all sketched values stands in front of the look-ups.
    """

    def __init__(self, items: list[tuple[object, bytes]], k: int, t: float):
        self.k, self.t, self.items = k, t, []
        by_size: dict[int, list[tuple[int, int]]] = {}
        for item, text in items:
            words = words_of(text)
            shingles = shingles_of(words, k)
            if not shingles:
                continue
            hashes = np.unique(shingle_hashes(words, k))
            depth = min(len(hashes), int((1 - t) * len(shingles) + 1e-9) + 1)
            by_size.setdefault(len(shingles).bit_length(), []).extend((int(h), len(self.items)) for h in hashes[:depth])
            self.items.append((item, shingles, len(words) < k and len(words)))
        #: (least number of words, sketched values in order, their items) of each size partition
        self.sizes: list[tuple[float, np.ndarray, np.ndarray]] = []
        for size, entries in sorted(by_size.items()):
            entries.sort()
            self.sizes.append((t * (1 << size - 1), np.array([h for h, _ in entries], np.uint64),
                               np.array([i for _, i in entries], np.int64)))
        # short items (fewer words than a shingle) are shingles of their own length
        self.short = sorted({s for _, _, s in self.items if s})
        bits = max(16, int(sum(len(h) for _, h, _ in self.sizes) * 16).bit_length())
        self.shift = np.uint64(64 - bits)
        self.filter = np.zeros(1 << bits, bool)
        for _, h, _ in self.sizes:
            self.filter[(h >> self.shift).astype(np.int64)] = True

    def candidates(self, hashes: np.ndarray, n_words: int) -> np.ndarray:
        """Items with a sketched value among the hashes, of the partitions that a text of so many words can contain."""
        h = hashes[self.filter[(hashes >> self.shift).astype(np.int64)]]
        found = [np.zeros(0, np.int64)]
        for least, sketched, owners in self.sizes if len(h) else ():
            if n_words < least:
                break
            lo, hi = np.searchsorted(sketched, h, "left"), np.searchsorted(sketched, h, "right")
            found += [owners[lo[i]:hi[i]] for i in np.flatnonzero(hi > lo)]
        return np.unique(np.concatenate(found))

    def search(self, text: bytes) -> list[tuple[object, int, int]]:
        """(item, its shingles, those contained) of the items that the text contains."""
        words = words_of(text)
        if not words or not self.items:
            return []
        found = [self.candidates(shingle_hashes(words, self.k), len(words))] if len(words) >= self.k else []
        found += [self.candidates(shingle_hashes(words, s), len(words)) for s in self.short if s <= len(words)]
        which = np.unique(np.concatenate(found)) if found else []
        if not len(which):
            return []
        own: dict[int, set[bytes]] = {}
        out = []
        for i in which:
            item, shingles, short = self.items[i]
            width = short or self.k
            if len(words) < self.t * len(shingles):
                continue
            if width not in own:
                own[width] = {b" ".join(words[j:j + width]) for j in range(len(words) - width + 1)}
            shared = len(shingles & own[width])
            if shared >= self.t * len(shingles) - 1e-9:
                out.append((item, len(shingles), shared))
        return out


def _slices(items: DataFrame, bound: int) -> Iterator[DataFrame]:
    """Parts of the items with about ``bound`` shingles each (one part if they fit)."""
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = -(-int(total) // bound)
    if n <= 1:
        yield items
        return
    for i in range(n):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE,
                    containment: float = CONTAINMENT, bound: int = BROADCAST_SHINGLES) -> DataFrame:
    """Every document with the items it contains: ``doc_id, items`` in input order.

    ``items`` is an array of ``item_id, n_shingles, n_shared``, sorted by item,
    empty for clean documents. Null and blank texts contain nothing; null or
    blank items are in nothing; an item shorter than a shingle is one shingle of
    its own length; equal items are found together; null ids stay null; empty
    tables on either side give empty lists (or no rows). Item ids may have any type that
    can be sorted. Other columns are ignored.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared, item_type = _broadcast_items(docs, items, item_col, item_text_col, bound)
    item_arrow = to_arrow_type(items.schema[item_col].dataType)
    kind = pa.list_(pa.struct([("item_id", item_arrow), ("n_shingles", pa.int64()), ("n_shared", pa.int64())]))

    def run(batches):
        search = _Search(shared, shingle, containment)
        for b in batches:
            lists = [[{"item_id": i, "n_shingles": q, "n_shared": n}
                      for i, q, n in sorted(f, key=lambda x: (x[0] is None, x[0]))] for f in search(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lists, kind)], ["doc_id", "items"])

    id_type = src.schema["doc_id"].dataType.simpleString()
    return on_workers(src).mapInArrow(
        run, f"doc_id {id_type}, items array<struct<item_id:{item_type},n_shingles:bigint,n_shared:bigint>>")


def _broadcast_items(docs: DataFrame, items: DataFrame, item_col: str, item_text_col: str, bound: int):
    bench = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")) \
        .where("text is not null").distinct()
    shared = [docs.sparkSession.sparkContext.broadcast([(r.item_id, r.text.encode()) for r in part.collect()])
              for part in _slices(bench, bound)]
    return shared, bench.schema["item_id"].dataType.simpleString()


class _Search:
    """All slices of the benchmark against a column of texts, one slice in memory at a time."""

    def __init__(self, shared: list, shingle: int, containment: float):
        self.shared, self.options, self.loaded, self.current = shared, (shingle, containment), None, -1

    def __call__(self, column: pa.Array) -> list[list]:
        texts = [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]
        found: list[list] = [[] for _ in texts]
        for i, s in enumerate(self.shared):
            if self.current != i:
                self.loaded, self.current = Sketches(s.value, *self.options), i
            for f, text in zip(found, texts, strict=True):
                f += self.loaded.search(text)
        return found


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", shingle: int = SHINGLE, containment: float = CONTAINMENT,
                      bound: int = BROADCAST_SHINGLES) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item (filtered where they lie).

    Rows with a null or blank text stay; repeated rows stay or go alike; without items all rows
    stay; an empty table gives an empty result.
    """
    shared, _ = _broadcast_items(docs, items, item_col, item_text_col, bound)
    place = docs.columns.index(text_col)

    def run(batches):
        search = _Search(shared, shingle, containment)
        for b in batches:
            yield b.filter(pa.array([not f for f in search(b.column(place))], pa.bool_()))

    return on_workers(docs).mapInArrow(run, docs.schema)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """One row per document: ``doc_id, n_items, item_ids, containment, contaminated``.

    ``n_items`` items are contained by ``containment`` or more, ``item_ids``
    lists them, ``containment`` is the largest share (0 if none). Null and blank texts, null ids,
    repeated rows and empty tables as in ``contained_items``.
    """
    found = contained_items(docs, items, id_col, text_col, **options)
    share = F.transform("items", lambda x: x["n_shared"] / x["n_shingles"])
    return found.select(
        "doc_id", F.size("items").cast("long").alias("n_items"), F.col("items.item_id").alias("item_ids"),
        F.coalesce(F.array_max(share), F.lit(0.0)).alias("containment"), (F.size("items") > 0).alias("contaminated"))
