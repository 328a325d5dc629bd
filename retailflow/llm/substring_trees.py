"""Substring dedup by words: prefix-partitioned suffix trees.

Suffixes are grouped by a prefix of variable length: the words from a window's
start up to its minimizer gram (see ``repeats``), so every group fits one
task's memory; a prefix with too many suffixes is lengthened to the whole
window, where its subtree is a single path and counting it is enough. In a
group the suffix tree is grown top-down, one word per level: the suffixes of a
node are dealt to children by their next word, and a child with a single
suffix is a leaf that is not grown further. Internal nodes as deep as the
window are the repeats; the words that their leaves cover are removed.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from retailflow.llm.repeats import Units, remove_repeats, unpacked

WINDOW, GRAM = 35, 8


class Words(Units):
    """Words ``[^\\x20\\x09-\\x0D]+``, unchanged, as UTF-8."""

    def cut(self, text: bytes) -> list[bytes]:
        return text.split()

    def values(self, units: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, units), np.uint64, len(units))

    def slice(self, units: list[bytes], lo: int, hi: int) -> bytes:
        return b" ".join(units[lo:hi])

    def rest(self, units: list[bytes], removed: np.ndarray) -> bytes:
        if not removed.any():
            return b" ".join(units)
        return b" ".join([units[i] for i in np.flatnonzero(~removed).tolist()])


def deep_nodes(first: np.ndarray, words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes below an internal node of ``depth`` words (top-down growth, all groups at once).

    ``first`` is the group of each suffix, ``starts`` its place in ``words``.
    """
    alive = np.arange(len(starts))
    node = first
    span = np.int64(words.max(initial=0)) + 1
    for level in range(-1, depth):
        key = node if level < 0 else node * span + words[starts[alive] + level]
        _, child, size = np.unique(key, return_inverse=True, return_counts=True)
        inner = size[child] >= 2
        alive, node = alive[inner], child[inner].astype(np.int64)
        if not len(alive):
            break
    return alive


def grow_trees(g: np.ndarray, at: np.ndarray, contents: list[bytes], window: int = WINDOW):
    """First and last repeated window of each content (-1: none)."""
    _, n, offset = unpacked(at)
    ids: dict[bytes, int] = {}
    cuts = [c.split() for c in contents]
    words = np.array([ids.setdefault(w, len(ids)) for c in cuts for w in c], np.int64)
    lengths = np.array([len(c) for c in cuts])
    base = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(len(n)), n)
    j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    gram = np.unique(g, return_inverse=True)[1]
    prefix = gram[row].astype(np.int64) * 65_536 + (offset[row] - j)
    hit = deep_nodes(prefix, words, base[row] + j, window)
    lo, hi = np.full(len(n), 1 << 40), np.full(len(n), -1)
    np.minimum.at(lo, row[hit], j[hit])
    np.maximum.at(hi, row[hit], j[hit])
    return np.where(hi < 0, -1, lo), hi


def dedup_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, n_spans, kept_sha256``.

    A word goes when a window of ``window`` words that covers it also starts
    anywhere else, the same document included; windows are judged on the
    input. ``kept_sha256`` is over the kept words joined by one space. Null and
    blank texts have no words (the hash is that of the empty string), texts
    shorter than a window lose nothing, repeated rows are repeats of each
    other, null ids stay null, an empty table gives an empty result and other
    columns are ignored.
    """

    def compare(g, at, contents):
        return grow_trees(g, at, contents, window)

    return remove_repeats(docs, Words(), window, gram, compare, False, id_col, text_col) \
        .withColumnRenamed("n_units", "n_words")
