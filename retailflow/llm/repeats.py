"""Exact repeats of a fixed length: what the two substring operators share.

A text is a sequence of units (words or bytes) and a window is ``window``
consecutive units of one text. To find windows that start in two places
without moving a row per window, each window is assigned to its minimizer: the
gram (``gram`` units) with the least hash inside it, the leftmost of equals.
Consecutive windows with the same minimizer form one *run*, so a text of n
units is a few runs, and every window is in exactly one. Equal windows have
equal minimizers at equal offsets; comparing runs of the same gram is enough.

    1. ``index``: per text, its runs as (gram hash, content hash, position).
    2. ``resolve``: runs, range-partitioned by gram and content hash and sorted.
       A run whose gram is unique holds no repeat. A run whose content is
       repeated is covered whole. The rest, grams that several different
       contents share, is left open. Grams at a partition's ends are compared
       across the boundaries by grouped counts, so a gram that a third of all
       rows hold may span any number of partitions.
    3. ``finish_closed``: texts meet their runs (one shuffle of texts); what
       has no open run is final, the others give the contents of their open runs.
    4. the operator's own comparison of the open contents, gram by gram
       (suffix trees or sorted suffix arrays); grams with more than
       ``GROUP_ROWS`` different contents are compared window by window through
       128-bit digests that Spark counts.
    5. ``finish_open``: the texts left over meet what was found.

Rows are told apart by a number given in step 1 and by 128-bit hashes of id
and text; nothing is collected, and each step is written to the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import on_workers, shuffle_width, stored

#: Units hashed at a time (some 20 arrays of eight bytes each), and different contents of one gram compared in one task.
CHUNK, GROUP_ROWS = 1 << 18, 20_000

_BASE = 0x9E3779B97F4A7C15
_BASE2 = 0xC2B2AE3D27D4EB4F
_POS = np.uint64((1 << 24) - 1)
RUN = np.dtype([("at", "<i8"), ("g", "<u8"), ("c", "<u8")])

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and ``base ** -i`` modulo 2**64 for i up to n."""
    known = _powers.get(base)
    if known is None or len(known[0]) <= n:
        size = max(n + 1, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            out.append(np.cumprod(x, dtype=np.uint64))
        known = _powers[base] = (out[0], out[1])
    return known


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(v: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Polynomial prefix sums; see ``span_hash``."""
    out = np.zeros(len(v) + 1, np.uint64)
    np.cumsum(v * powers(base, len(v))[0][:len(v)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hash of units lo..hi, equal for equal contents wherever they stand."""
    return mixed((sums[hi] - sums[lo]) * powers(base, len(sums))[1][lo])


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    size, out = 1, a
    while size * 2 <= w:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return out if size == w else np.minimum(out[:size - w], out[w - size:])


def runs_of(v: np.ndarray, lengths: list[int], window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of several texts laid end to end: the text's index, and RUN records.

    ``at`` packs first window (31 bits), number of windows (16) and the gram's
    offset from the first window (16).
    """
    none = np.zeros(0, np.int64), np.zeros(0, RUN)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    many = np.maximum(np.asarray(lengths) - window + 1, 0)
    if not many.sum():
        return none
    sums = prefix_sums(v)
    at = np.arange(len(v) - gram + 1)
    hashes = span_hash(sums, at, at + gram)
    least = sliding_min((hashes & ~_POS) | at.astype(np.uint64), window - gram + 1)
    # every window of every text, in order
    text = np.repeat(np.arange(len(lengths)), many)
    first = np.repeat(np.cumsum(many) - many, many)
    p = np.arange(len(text)) - first + starts[text]
    anchor = (least[p] & _POS).astype(np.int64)
    cut = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))))
    n = np.diff(np.append(cut, len(p)))
    p0, a = p[cut], anchor[cut]
    out = np.zeros(len(cut), RUN)
    out["at"] = ((p0 - starts[text[cut]]) << 32) | (n << 16) | (a - p0)
    out["g"] = hashes[a]
    out["c"] = mixed(span_hash(sums, p0, p0 + n - 1 + window) + (n * 65_536 + (a - p0)).astype(np.uint64))
    return text[cut], out


def unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, offset of the gram."""
    return at >> 32, (at >> 16) & 0xFFFF, at & 0xFFFF


def text_runs(texts: Iterable, window: int, gram: int, values: Callable | None = None) -> list[np.ndarray]:
    """Runs of each text; texts are hashed together in chunks, long ones in overlapping pieces.

    ``values`` gives the 64-bit values of a piece (none: the texts are values already).
    """
    found: list[list[np.ndarray]] = []
    held: list[tuple[int, int, np.ndarray]] = []

    def flush():
        if held:
            which, runs = runs_of(np.concatenate([x for _, _, x in held]), [len(x) for _, _, x in held], window, gram)
            for i, r in zip(np.unique(which), np.split(runs, np.flatnonzero(np.diff(which)) + 1), strict=True) \
                    if len(which) else ():
                k, offset, _ = held[i]
                r["at"] += offset << 32
                found[k].append(r)
            held.clear()

    size = 0
    for k, v in enumerate(texts):
        found.append([])
        for lo in range(0, max(len(v) - window + 1, 0), CHUNK - window + 1):
            piece = v[lo:lo + CHUNK]
            if size + len(piece) > CHUNK:
                flush()
                size = 0
            held.append((k, lo, values(piece) if values else piece))
            size += len(piece)
    flush()
    return [np.concatenate(x) if x else np.zeros(0, RUN) for x in found]


class Units:
    """How a text is cut: ``cut`` to units, ``values`` to 64-bit values, slices and rest back to bytes."""

    def cut(self, text: bytes):
        raise NotImplementedError

    def values(self, units) -> np.ndarray:
        raise NotImplementedError

    def slice(self, units, lo: int, hi: int) -> bytes:
        raise NotImplementedError

    def rest(self, units, removed: np.ndarray) -> bytes:
        raise NotImplementedError


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def _parts(batches: Iterable[pa.RecordBatch], text: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``limit`` bytes in column ``text``: objects are made of one part at a time."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                yield b.slice(lo, hi - lo)


def index(src: DataFrame, units: Units, window: int, gram: int) -> DataFrame:
    """``row, k1, k2, runs`` (packed RUN records) for every text that has a window."""

    def run(batches):
        for part in _parts(batches, 3):
            found = text_runs(map(units.cut, _texts(part.column(3))), window, gram, units.values)
            keep = pa.array([i for i, f in enumerate(found) if len(f)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(j).take(keep) for j in range(3)]
                + [pa.array([f.tobytes() for f in found if len(f)], pa.binary())], ["row", "k1", "k2", "runs"])

    numbered = src.select(F.monotonically_increasing_id().alias("row"), "k1", "k2", "text")
    return on_workers(numbered).mapInArrow(run, "row long, k1 long, k2 long, runs binary")


def _spread(batches):
    for b in batches:
        rows = b.column(0).to_numpy()
        runs = [np.frombuffer(x, RUN) for x in b.column(1).to_pylist()]
        if not runs:
            continue
        every = np.concatenate(runs)
        yield pa.RecordBatch.from_arrays(
            [pa.array(every["g"].view(np.int64) if every["g"].flags.c_contiguous else every["g"].copy().view(np.int64)),
             pa.array(every["c"].copy().view(np.int64)),
             pa.array(np.repeat(rows, [len(r) for r in runs])), pa.array(every["at"].copy())], ["g", "c", "row", "at"])


_RESOLVED = "row long, at long, g long, c long, n long, contents long, first boolean, end boolean"


def _runs_of_equal(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows in sorted columns."""
    differ = np.zeros(len(columns[0]), bool)
    differ[:1] = True
    for c in columns:
        differ[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(differ)


def _resolve_block(g, c, row, at, end: np.ndarray) -> pa.RecordBatch:
    """Runs of grams that are not unique, and for grams at an end of the partition a row per content."""
    gs, cs = _runs_of_equal(g), _runs_of_equal(g, c)
    g_len, c_len = np.diff(np.append(gs, len(g))), np.diff(np.append(cs, len(g)))
    contents = np.bincount(np.searchsorted(gs, cs, "right") - 1, minlength=len(gs))
    per_row = np.repeat(np.arange(len(gs)), g_len)
    n, many = np.repeat(c_len, c_len), contents[per_row]
    first = np.zeros(len(g), bool)
    first[cs] = True
    # whole grams are final; of grams at an end, repeats are known, and each content is summed up in one row
    keep = np.where(end, n >= 2, (n >= 2) | (first & (many >= 2)))
    parts = [(keep, first & ~end, False), (end & first, first, True)]
    cols = [np.concatenate([x[m] for m, _, _ in parts]) for x in (row, at, g, c, n, many)]
    cols += [np.concatenate([f[m] for m, f, _ in parts]), np.concatenate([np.full(m.sum(), e) for m, _, e in parts])]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in cols],
                                      ["row", "at", "g", "c", "n", "contents", "first", "end"])


def _resolve(batches):
    """Sorted rows (g, c, row, at): whole grams are decided; the first and last are marked ``end``."""
    held, opening = None, True
    for b in batches:
        now = [b.column(i).to_numpy() for i in range(4)]
        if not len(now[0]):
            continue
        held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
        last = int(np.flatnonzero(held[0] == held[0][-1])[0])
        if last and (last > 50_000 or not opening):
            done = [x[:last] for x in held]
            held = [x[last:] for x in held]
            yield _resolve_block(*done, end=(done[0] == done[0][0]) & opening)
            opening = False
    if held is not None:
        yield _resolve_block(*held, end=(held[0] == held[0][-1]) | ((held[0] == held[0][0]) & opening))


def resolve(indexed: DataFrame) -> DataFrame:
    """``row, at, g, whole, ask, big`` of the runs that matter.

    ``whole``: the same content also stands elsewhere. ``ask``: the run
    represents its content in a gram that other contents share. ``big``: that
    gram has more than ``GROUP_ROWS`` of them.
    """
    runs = on_workers(indexed).select("row", "runs").mapInArrow(_spread, "g long, c long, row long, at long")
    # all four columns: a content that a third of all texts hold spreads over many partitions
    keys = ["g", "c", "row", "at"]
    ranged = runs.repartitionByRange(shuffle_width(indexed.sparkSession), *keys).sortWithinPartitions(*keys)
    seen = stored(ranged.mapInArrow(_resolve, _RESOLVED), "repeat-runs")
    inner = seen.where("not end").select("row", "at", "g", "n", "contents", "first")
    ends = seen.where("end").select("row", "at", "g", "c", F.col("n").alias("here"))
    per_c = ends.groupBy("g", "c").agg(F.sum("here").alias("n"), F.min(F.struct("row", "at")).alias("rep"))
    per_g = per_c.groupBy("g").agg(F.count(F.lit(1)).alias("contents"))
    outer = ends.join(per_c.join(per_g, "g"), ["g", "c"]).withColumn("first", F.struct("row", "at") == F.col("rep"))
    outer = outer.where("here = 1 or first").select("row", "at", "g", "n", "contents", "first")
    every = inner.unionAll(outer)
    ask = F.col("first") & (F.col("contents") >= 2)
    return every.select("row", "at", "g", (F.col("n") >= 2).alias("whole"), ask.alias("ask"),
                        (F.col("contents") > GROUP_ROWS).alias("big")).where("whole or ask")


def _marked(units: Units, text: bytes, ranges, window: int):
    """Units of a text, the mask of those covered, and the number of covered spans."""
    cut = units.cut(text)
    edge = np.zeros(len(cut) + 1, np.int64)
    for lo, hi in ranges:
        edge[lo] += 1
        edge[hi] -= 1
    removed = np.cumsum(edge[:-1]) > 0
    spans = int(np.count_nonzero(np.diff(np.concatenate(([False], removed)).astype(np.int8)) == 1))
    return cut, removed, spans


def _final(units: Units, cut, removed: np.ndarray, spans: int) -> tuple:
    rest = units.rest(cut, removed)
    return len(cut), int(removed.sum()), spans, hashlib.sha256(rest).hexdigest()


_OUT = [("n_units", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
_OPEN = pa.list_(pa.struct([("g", pa.int64()), ("at", pa.int64()), ("whole", pa.bool_()), ("big", pa.bool_()),
                            ("content", pa.binary())]))
_OPEN_SQL = "array<struct<g:long,at:long,whole:boolean,big:boolean,content:binary>>"
_OUT_SQL = "n_units long, n_removed long, n_spans long, kept_sha256 string"


def finish_closed(src: DataFrame, marks: DataFrame, units: Units, window: int) -> DataFrame:
    """Texts with their runs: final rows, and for open ones the text, covered ranges and contents.

    Copies of a row (same id and text) share their runs: each run is listed once, whatever the number of copies,
    and a task hands out the contents of one copy only.
    """

    def run(batches):
        asked = set()
        for b in _parts(batches, 3):
            out = []
            for rid, k1, k2, runs, text in zip(*[b.column(i).to_pylist() for i in (0, 1, 2, 4)], _texts(b.column(3)),
                                               strict=True):
                ranges, open_, opens = [], False, []
                again = (k1, k2) in asked
                for m in runs or ():
                    lo, n = m["at"] >> 32, (m["at"] >> 16) & 0xFFFF
                    if m["whole"]:
                        ranges.append((lo, lo + n - 1 + window))
                    else:
                        open_ = True
                cut, removed, spans = _marked(units, text, ranges, window)
                for m in runs or ():
                    if m["ask"] and not again:
                        lo, n = m["at"] >> 32, (m["at"] >> 16) & 0xFFFF
                        opens.append({**m, "content": units.slice(cut, lo, lo + n - 1 + window)})
                if opens:
                    asked.add((k1, k2))
                end = (None,) * 4 if open_ else _final(units, cut, removed, spans)
                covered = np.array(ranges, np.int64).tobytes() if open_ else None
                out.append((rid, k1, k2, *end, text if open_ else None, covered, opens or None))
            kinds = [b.schema.field(0).type, pa.int64(), pa.int64(), *(t for _, t in _OUT), pa.binary(),
                     pa.binary(), _OPEN]
            names = ["doc_id", "k1", "k2", *(n for n, _ in _OUT), "open_text", "covered", "opens"]
            columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    # copies of a row give the same marks, but that one of them asks
    once = marks.groupBy("k1", "k2", "at", "g").agg(*[F.max(c).alias(c) for c in ("whole", "ask", "big")])
    lists = once.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "g", "whole", "ask", "big")).alias("runs"))
    joined = src.join(lists, ["k1", "k2"], "left").select("doc_id", "k1", "k2", "text", "runs")
    kind = src.schema["doc_id"].dataType.simpleString()
    return on_workers(joined).mapInArrow(run, f"doc_id {kind}, k1 long, k2 long, {_OUT_SQL}, open_text binary, "
                                              f"covered binary, opens {_OPEN_SQL}")


def finish_open(texts: DataFrame, found: DataFrame, units: Units, window: int) -> DataFrame:
    """Final rows of the open texts, with the ranges ``k1, k2, lo, hi`` that were found."""

    def run(batches):
        for b in _parts(batches, 1):
            covered, lists = b.column(2).to_pylist(), b.column(3).to_pylist()
            out = []
            for rid, text, known, more in zip(b.column(0).to_pylist(), _texts(b.column(1)), covered, lists, strict=True):
                ranges = np.frombuffer(known, np.int64).reshape(-1, 2).tolist() + [(r["lo"], r["hi"]) for r in more or ()]
                out.append((rid, *_final(units, *_marked(units, text, ranges, window))))
            kinds = [b.schema.field(0).type, *(t for _, t in _OUT)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                             ["doc_id", *(n for n, _ in _OUT)])

    lists = found.distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    joined = texts.join(lists, ["k1", "k2"], "left").select("doc_id", "open_text", "covered", "ranges")
    return joined.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, {_OUT_SQL}")


#: Rows of step 4: (g, at, whole, content, k1, k2) of whole grams, as arrays and lists.
Compare = Callable[[np.ndarray, np.ndarray, list[bytes]], tuple[np.ndarray, np.ndarray]]


def compare_grams(opens: DataFrame, compare: Compare, window: int, by_range: bool) -> DataFrame:
    """Ranges ``k1, k2, lo, hi`` covered by repeats, from contents compared gram by gram.

    ``compare(gram, at, contents)`` gets the rows of whole grams in order and
    returns each row's first and last repeated window (-1 if none).
    """

    def run(batches):
        held: list[tuple] = []

        def flush(rows):
            g = np.array([r[0] for r in rows], np.int64)
            at = np.array([r[1] for r in rows], np.int64)
            lo, hi = compare(g, at, [r[3] for r in rows])
            keep = [i for i in np.flatnonzero(lo >= 0).tolist() if not rows[i][2]]
            start = at >> 32
            return pa.RecordBatch.from_arrays(
                [pa.array([rows[i][4] for i in keep], pa.int64()), pa.array([rows[i][5] for i in keep], pa.int64()),
                 pa.array([int(start[i] + lo[i]) for i in keep], pa.int64()),
                 pa.array([int(start[i] + hi[i]) + window for i in keep], pa.int64())], ["k1", "k2", "lo", "hi"])

        for b in batches:
            held += zip(*[b.column(i).to_pylist() for i in range(6)], strict=True)
            if len(held) > 8_000:
                last = held[-1][0]
                cut = len(held)
                while cut and held[cut - 1][0] == last:
                    cut -= 1
                if cut:
                    yield flush(held[:cut])
                    held = held[cut:]
        if held:
            yield flush(held)

    width = shuffle_width(opens.sparkSession)
    rows = opens.where("not big").select("g", "at", "whole", "content", "k1", "k2")
    dealt = rows.repartitionByRange(width, "g") if by_range else rows.repartition(width, "g")
    return dealt.sortWithinPartitions("g").mapInArrow(run, "k1 long, k2 long, lo long, hi long")


def compare_windows(opens: DataFrame, units: Units, window: int) -> DataFrame:
    """The same for the grams with too many contents: every window by a 128-bit digest, counted by Spark."""

    def run(batches):
        for b in batches:
            for at, whole, content, k1, k2 in zip(*[b.column(i).to_pylist() for i in range(5)], strict=True):
                lo, n = at >> 32, (at >> 16) & 0xFFFF
                v = units.values(units.cut(content))
                p = np.arange(n)
                digests = [span_hash(prefix_sums(v, x), p, p + window, x).view(np.int64) for x in (_BASE, _BASE2)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests[0]), pa.array(digests[1]), pa.array(np.full(n, k1)), pa.array(np.full(n, k2)),
                     pa.array(p + lo), pa.array(np.full(n, whole))], ["h1", "h2", "k1", "k2", "p", "whole"])

    rows = opens.where("big").select("at", "whole", "content", "k1", "k2")
    each = rows.mapInArrow(run, "h1 long, h2 long, k1 long, k2 long, p long, whole boolean")
    twice = each.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    return each.where("not whole").join(twice, ["h1", "h2"]).select(
        "k1", "k2", F.col("p").alias("lo"), (F.col("p") + window).alias("hi"))


def remove_repeats(docs: DataFrame, units: Units, window: int, gram: int, compare: Compare, by_range: bool,
                   id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_units, n_removed, n_spans, kept_sha256`` for every row."""
    rid, text = F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(rid.alias("doc_id"), text.alias("text"), F.xxhash64(rid, F.lit(1)).alias("k1"),
                      F.xxhash64(text, F.lit(2)).alias("k2"))
    indexed = stored(index(src, units, window, gram), "repeat-index")
    marks = resolve(indexed).join(indexed.select("row", "k1", "k2"), "row")
    met = stored(finish_closed(src, marks, units, window), "repeat-texts")
    opens = met.where("opens is not null").select("k1", "k2", F.explode("opens").alias("o")) \
        .select("k1", "k2", "o.*")
    found = compare_grams(opens, compare, window, by_range).unionAll(compare_windows(opens, units, window))
    closed = met.where("open_text is null").select("doc_id", *(n for n, _ in _OUT))
    return closed.unionAll(finish_open(met.where("open_text is not null"), found, units, window))
