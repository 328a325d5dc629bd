"""Periodic runs of words, found with a recompression grammar.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) that no neighbouring word extends, of at least
``max(min_length, repeats * q)`` words. Per document:

1. Harmonic grid: a run with period p is a stretch of places x with
   ``word[x] == word[x + p]`` of at least ``m = max(min_length - p, 2 p)`` places, so
   it holds a multiple of m. Only these places are looked at, n / m for each p.
   A place stays a candidate if eight words on one side agree as well (m is at
   least 16, so a run always has them).
2. Recompression: the documents with candidates are compressed together, level
   by level, alternating block compression (a maximal block of one symbol
   becomes one symbol) and pair compression (the symbols are split in two
   sides by a hash of the level; neighbours left-right become one symbol). The levels
   are a run-length grammar of the texts; a separator that occurs once stands
   between documents and is never compressed.
3. Each candidate is extended to both sides by longest common extension
   queries on the grammar: both places climb the levels together, comparing at
   most one block or symbol a level until they are aligned, and descend from
   the level where they differ. All queries of a batch take each step at once.
4. Equal stretches are one run, with the smallest period found (a larger one
   is a multiple of it).

Documents are mapped where they lie; nothing is shuffled or collected. A batch
of texts is cut to about four megabytes (longer texts stand alone), candidates
are made a few million grid places at a time.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import WORD, on_workers

MIN_LENGTH, REPEATS = 24, 3
#: Bytes of text compressed together, grid places made at a time, symbols a text may keep on the last level.
BATCH_BYTES, GRID, TOP = 4 << 20, 2_000_000, 4
#: Words that agree on one side of every place of the grid that lies in a run.
SIDE = 8


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Grammar:
    """Recompression levels of a sequence of symbols; negative ones occur once and stay as they are.

    ``sym[k]`` are the symbols of level k, ``first[k]`` the place in level k where each symbol of level k + 1
    begins (and the end), ``up[k]`` the symbol of level k + 1 that holds each one of level k.
    """

    def __init__(self, text: np.ndarray):
        self.sym, self.first, self.up, self.block = [text], [], [], []
        self.names = int(text.max(initial=0)) + 1
        level = 0
        while self._longest() > TOP:
            self._blocks()
            self._pairs(level)
            level += 1

    def _longest(self) -> int:
        """Most symbols between two separators."""
        cut = np.flatnonzero(self.sym[-1] < 0)
        return int(np.diff(cut).max(initial=1)) - 1

    def _add(self, first: np.ndarray, sym: np.ndarray, block: bool) -> None:
        n = len(self.sym[-1])
        ends = np.append(first, n)
        self.first.append(ends)
        self.up.append(np.repeat(np.arange(len(first)), np.diff(ends)))
        self.sym.append(sym)
        self.block.append(block)

    def _named(self, keys: np.ndarray) -> np.ndarray:
        """A new symbol for each different key."""
        different, which = np.unique(keys, return_inverse=True)
        named = self.names + which
        self.names += len(different)
        return named

    def _blocks(self) -> None:
        s = self.sym[-1]
        first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        size = np.diff(np.append(first, len(s)))
        many = size > 1
        if many.any():
            out = s[first]
            out[many] = self._named(out[many] * (int(size.max()) + 1) + size[many])
            self._add(first, out, True)

    def _pairs(self, level: int) -> None:
        s = self.sym[-1]
        left = (_mixed(s.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & np.uint64(1)) == 0
        inner = s >= 0
        both = inner[:-1] & inner[1:]
        ahead, behind = both & left[:-1] & ~left[1:], both & ~left[:-1] & left[1:]
        met = ahead if np.count_nonzero(ahead) >= np.count_nonzero(behind) else behind
        at = np.flatnonzero(met)
        if not len(at):
            return
        stays = np.ones(len(s), bool)
        stays[at + 1] = False
        first = np.flatnonzero(stays)
        out = s[first]
        out[np.searchsorted(first, at)] = self._named(s[at] * self.names + s[at + 1])
        self._add(first, out, False)

    def extension(self, a: np.ndarray, b: np.ndarray, ahead: bool) -> np.ndarray:
        """How far the texts from places a and b (before them, if not ``ahead``) agree, for each pair a < b."""
        side, move = (0, 1) if ahead else (1, -1)
        top = len(self.first)
        x, y = a.copy(), b.copy()
        stop = np.full(len(a), top)
        live = np.arange(len(a))
        for k in range(top):
            sym, first, up = self.sym[k], self.first[k], self.up[k]
            i, j = x[live], y[live]
            gi, gj = up[i - side], up[j - side]
            # what is left of either group in the direction of the move, and whether both places begin one
            if ahead:
                ri, rj = first[gi + 1] - i, first[gj + 1] - j
                aligned = (first[gi] == i) & (first[gj] == j)
            else:
                ri, rj = i - first[gi], j - first[gj]
                aligned = (first[gi + 1] == i) & (first[gj + 1] == j)
            same = sym[i - side] == sym[j - side]
            step = np.where(~aligned & same, np.minimum(ri, rj) if self.block[k] else 1, 0) * move
            i, j = i + step, j + step
            halt = ~aligned & (~same | (ri != rj)) if self.block[k] else ~aligned & ~same
            stop[live[halt]] = k
            x[live], y[live] = np.where(halt, i, up[i - side] + side), np.where(halt, j, up[j - side] + side)
            live = live[~halt]
        sym = self.sym[top]
        while len(live):
            live = live[sym[x[live] - side] == sym[y[live] - side]]
            x[live] += move
            y[live] += move
        for k in range(top - 1, -1, -1):
            sym, first = self.sym[k], self.first[k]
            live = np.flatnonzero(stop > k)
            gi, gj = x[live] - side, y[live] - side
            i, j = first[x[live]], first[y[live]]
            same = sym[i - side] == sym[j - side]
            size = np.minimum(first[gi + 1] - first[gi], first[gj + 1] - first[gj]) if self.block[k] else 1
            step = np.where(same, size, 0) * move
            x[live], y[live] = i + step, j + step
        return np.abs(x - a)


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, … within each of several groups laid end to end."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def grid(lengths: np.ndarray, starts: np.ndarray, min_length: int, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the harmonic grid over texts that begin at ``starts``, some millions at a time."""
    long = lengths >= min_length
    lengths, starts = lengths[long], starts[long]
    periods = lengths // repeats
    text = np.repeat(np.arange(len(lengths)), periods)
    p = _within(periods) + 1
    m = np.maximum(min_length - p, (repeats - 1) * p)
    sizes = -(-(lengths[text] - p) // m)
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(GRID, int(sizes.sum()) + GRID, GRID), "right")
    lo = 0
    for hi in np.unique(np.append(cuts, len(p))).tolist():
        if hi > lo:
            n = sizes[lo:hi]
            yield np.repeat(starts[text[lo:hi]], n) + _within(n) * np.repeat(m[lo:hi], n), np.repeat(p[lo:hi], n)
        lo = hi


def _candidates(v: np.ndarray, lengths: np.ndarray, starts: np.ndarray, min_length: int,
                repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid places in an equal stretch that may be long enough, with their periods."""
    last, found = len(v) - 1, []
    # a stretch has at least this many places, so this many on one side of each
    side = min(SIDE, min(max(min_length - p, (repeats - 1) * p) for p in range(1, max(min_length, 2))) // 2)
    for x, p in grid(lengths, starts, min_length, repeats):
        keep = v[x] == v[x + p]
        x, p = x[keep], p[keep]
        ahead, behind = np.ones(len(x), bool), np.ones(len(x), bool)
        for d in range(1, side):
            ahead &= v[np.minimum(x + d, last)] == v[np.minimum(x + p + d, last)]
        for d in range(1, side + 1):
            behind &= v[np.maximum(x - d, 0)] == v[x + p - d]
        keep = ahead | behind
        found.append((x[keep], p[keep]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([p for _, p in found])


def _laid(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts end to end with a separator of its own before each and after the last; lengths and starts."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + 1) - lengths
    v = np.full(int(lengths.sum()) + len(texts) + 1, -1, np.int64)
    for t, s in zip(texts, starts.tolist(), strict=True):
        v[s:s + len(t)] = t
    cut = np.append(starts - 1, len(v) - 1)
    v[cut] = -1 - np.arange(len(cut))
    return v, lengths, starts


def _distinct(rows: np.ndarray) -> np.ndarray:
    """Different rows, sorted by all columns."""
    rows = rows[np.lexsort(rows.T[::-1])]
    return rows[np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1)))] if len(rows) else rows


def runs_of(texts: list[np.ndarray], min_length: int = MIN_LENGTH, repeats: int = REPEATS) -> list[np.ndarray]:
    """Rows (start, length, period) of the runs of each text, by start and period. Texts are arrays of word numbers."""
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(texts)
    v, lengths, starts = _laid(texts)
    x, p = _candidates(v, lengths, starts, min_length, repeats)
    if not len(x):
        return out
    owner = np.searchsorted(starts, x, "right") - 1
    which, local = np.unique(owner, return_inverse=True)
    v, _, begins = _laid([texts[i] for i in which.tolist()])
    x = x - starts[owner] + begins[local]
    grammar = Grammar(v)
    parts = []
    for at in range(0, len(x), GRID // 4):
        i, q, text = x[at:at + GRID // 4], p[at:at + GRID // 4], local[at:at + GRID // 4]
        lo = i - grammar.extension(i, i + q, False)
        hi = i + q + grammar.extension(i, i + q, True)
        keep = hi - lo >= np.maximum(min_length, repeats * q)
        parts.append(_distinct(np.stack([text, lo - begins[text], hi - lo, q], axis=1)[keep]))
    rows = _distinct(np.concatenate(parts))
    # of one stretch (text, start, length) the smallest period
    rows = rows[np.concatenate(([True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)))] if len(rows) else rows
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    cuts = np.searchsorted(rows[:, 0], np.arange(len(which) + 1))
    for i, text in enumerate(which.tolist()):
        out[text] = rows[cuts[i]:cuts[i + 1], 1:]
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, without those that a run holds after its first period."""
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([w for w, gone in zip(words, (np.cumsum(edge[:-1]) > 0).tolist(), strict=True) if not gone])


def _slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
              repeats: int = REPEATS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, runs, collapsed``.

    ``runs`` is an array of ``start, length, period`` (word numbers from 0) by
    start, then period; ``collapsed`` the text's words joined by one space, without
    those that any run holds after that run's first period. Null and blank texts
    have no words, no runs and an empty ``collapsed``; null ids stay null;
    repeated rows each have their row; an empty table gives an empty result; other
    columns are ignored. A text is taken whole, however long. ``repeats`` is 2 at least.
    """
    if repeats < 2 or min_length < 2:
        raise ValueError("repeats and min_length are 2 at least")

    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column(1).cast(pa.large_binary()).to_pylist()]
            done = 0
            for part in _slices(texts):
                names: dict[bytes, int] = defaultdict(count().__next__)
                words = [t.split() for t in part]
                found = runs_of([np.fromiter(map(names.__getitem__, w), np.int64, len(w)) for w in words],
                                min_length, repeats)
                lists = [[{"start": s, "length": n, "period": q} for s, n, q in f.tolist()] for f in found]
                kept = [collapsed(w, f).decode() if len(f) else b" ".join(w).decode()
                        for w, f in zip(words, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(done, len(part)), pa.array([len(w) for w in words], pa.int64()),
                     pa.array(lists, _RUNS), pa.array(kept, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])
                done += len(part)

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return on_workers(src).mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_cycles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``, where the tail of about a tenth of the texts repeats its own beginning.

    With h the unsigned crc32 of the decimal id and g = h div 10: if h mod 10 is 0
    and the text has n > 0 words, each word i >= a = g mod n becomes word
    a + (i - a) mod p of the text, p = 1 + (n - a) div (3 + g mod 8). Rows without
    id or text stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), h.alias("h")) \
        .withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))) \
        .withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10)) \
        .withColumn("a", F.expr("if(n > 0, int(g % n), 0)")) \
        .withColumn("p", F.expr("if(n > 0, int(1 + (n - a) div (3 + g % 8)), 1)"))
    a, n = F.col("a"), F.col("n")
    cycle = F.flatten(F.array_repeat(F.slice("w", a + 1, F.col("p")), F.expr("int(ceil((n - a) / p))")))
    cycled = F.array_join(F.concat(F.slice("w", F.lit(1), a), F.slice(cycle, F.lit(1), n - a)), " ")
    return src.select("doc_id", F.when(n > 0, cycled).otherwise(F.col("text")).alias("text"))


def strongest(runs: Column) -> Column:
    """Of an array of runs the one of greatest length / period (compared exactly), then least start, then period."""
    def order(x: Column, y: Column) -> Column:
        left, right = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(left > right, -1).when(left < right, 1).when(x["start"] < y["start"], -1)
                .when(x["start"] > y["start"], 1).when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1)
                .otherwise(0))

    return F.get(F.array_sort(runs, order), F.lit(0))


def run_lines(runs: Column) -> Column:
    """``start,length,period`` and a line feed for each run, joined."""
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n"))))
