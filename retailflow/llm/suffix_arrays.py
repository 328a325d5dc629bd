"""Substring dedup by bytes: range-partitioned suffix arrays.

Suffixes are sampled where a minimizer gram starts (see ``repeats``) and
range-partitioned by their leading token, the gram, with splitters that Spark
samples. A bucket sorts its suffixes locally by multikey quicksort, eight bytes
as one character, both rightwards from the gram and leftwards before it. The
common prefixes of neighbours in the two orders tell which windows around the
gram are equal. Grams that reach over a bucket's boundary are compared across
it (step 2 of ``repeats``), and grams too large for a bucket by digests.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from retailflow.llm.repeats import Units, mixed, remove_repeats, unpacked

WINDOW, GRAM = 400, 64
_TABLE = mixed(np.arange(1, 257, dtype=np.uint64))


class Bytes(Units):
    """The UTF-8 bytes of a text."""

    def cut(self, text: bytes) -> np.ndarray:
        return np.frombuffer(text, np.uint8)

    def values(self, units: np.ndarray) -> np.ndarray:
        return _TABLE[units]

    def slice(self, units: np.ndarray, lo: int, hi: int) -> bytes:
        return units[lo:hi].tobytes()

    def rest(self, units: np.ndarray, removed: np.ndarray) -> bytes:
        return (units[~removed] if removed.any() else units).tobytes()


def multikey_sort(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort byte rows inside their groups (ascending ids): order, and the common
    prefix of each row with the one before it (-1 between groups).

    Multikey quicksort, breadth first: rows that agree so far are dealt by
    their next character of eight bytes, and only those that still agree go on.
    """
    n, width = rows.shape
    order = np.argsort(group, kind="stable")
    common = np.full(n, width, np.int64)
    common[np.concatenate(([True], group[order][1:] != group[order][:-1]))] = -1
    for level in range(0, width, 8):
        tied = common == width
        part = np.flatnonzero(tied | np.append(tied[1:], False))
        if not len(part):
            break
        segment = np.cumsum(~tied)[part]
        char = np.ascontiguousarray(rows[order[part], level:level + 8]).view(">u8").ravel().astype(np.uint64)
        place = np.lexsort((char, segment))
        order[part], char = order[part[place]], char[place]
        differ = np.flatnonzero((char[1:] != char[:-1]) & (segment[1:] == segment[:-1])) + 1
        gap = char[differ] ^ char[differ - 1]
        # leading equal bytes of the two characters
        equal = sum(((gap >> np.uint64(64 - 8 * k)) == 0).astype(np.int64) for k in range(1, 8))
        common[part[differ]] = level + equal
    return order, common


def compare_suffixes(g: np.ndarray, at: np.ndarray, contents: list[bytes], window: int = WINDOW):
    """First and last repeated window of each content (-1: none)."""
    _, n, offset = unpacked(at)
    m = len(contents)
    left_width = int(offset.max(initial=0))
    left_width += -left_width % 8
    right_width = window + -window % 8
    left, right = np.zeros((m, left_width), np.uint8), np.zeros((m, right_width), np.uint8)
    for i, (c, o) in enumerate(zip(contents, offset.tolist(), strict=True)):
        b = np.frombuffer(c, np.uint8)
        tail = b[o:o + right_width]
        right[i, :len(tail)] = tail
        left[i, :o] = b[:o][::-1]
    group = np.unique(g, return_inverse=True)[1]
    r_order, r_common = multikey_sort(right, group)
    l_order, l_common = multikey_sort(left, group)
    lo, hi = np.full(m, -1), np.full(m, -1)
    r_class, l_class = np.empty(m, np.int64), np.empty(m, np.int64)
    for o in range(int((offset - n + 1).min(initial=0)), int(offset.max(initial=-1)) + 1):
        valid = np.flatnonzero((o <= offset) & (o > offset - n))
        if len(valid) < 2:
            continue
        r_class[r_order] = np.cumsum(r_common < window - o)
        l_class[l_order] = np.cumsum(l_common < o)
        key = r_class[valid] * (m + 1) + l_class[valid]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        hit = valid[order[np.append(same, False) | np.append(False, same)]]
        j = offset[hit] - o
        hi[hit] = np.maximum(hi[hit], j)
        lo[hit] = np.where(lo[hit] < 0, j, np.minimum(lo[hit], j))
    return lo, hi


def dedup_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    A byte goes when a string of ``window`` bytes that covers it also starts
    anywhere else, the same document included (overlaps count); strings are
    judged on the input and never cross documents. ``n_spans`` counts the
    maximal removed runs, ``kept_sha256`` is over the remaining bytes. A null
    text is empty; texts shorter than a window lose nothing, repeated rows are
    repeats of each other, null ids stay null, an empty table gives an empty
    result and other columns are ignored.
    """

    def compare(g, at, contents):
        return compare_suffixes(g, at, contents, window)

    return remove_repeats(docs, Bytes(), window, gram, compare, True, id_col, text_col) \
        .withColumnRenamed("n_units", "n_bytes")
