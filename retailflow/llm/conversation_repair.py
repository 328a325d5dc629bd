"""Conversation structure repair by a shortest path with scalar big-integer weights.

A conversation is well formed if the initials of its roles read
``(s?(ua)+)?``. Each turn is kept, given another role or deleted, and turns may be
inserted; of the cheapest ways the one whose *audit* (the edits' initials in
order) comes first in ASCII order is taken.

Both are one integer minimum. The weight of an edit is a single integer: the
high digits are its cost, and the low digits are as many bytes as an audit can
have letters, with the letter's code at the letter's place and zeros
elsewhere. Weights add up along a path, an audit that ends earlier has zeros where
the other goes on, so the least sum is the least cost and then the least audit.
The graph has a node for each (turns done, phase of the pattern, letters so far);
nodes whose cost exceeds that of another with the same turns and phase are
left out, as no best path meets them.

On Spark:

1. Equal turns are counted (partial aggregation), each (role, text) of a
   conversation gets its first turn, and rows are range-partitioned by
   (conversation, turn, role, text), so that a conversation with a third of all rows
   is many partitions.
2. Each partition is read as a sorted stream and cut into pieces of at most
   ``PIECE`` turns. A conversation that is one piece, with others before and after it in the
   partition, is repaired at once.
3. Of the others each piece gives its best paths from every phase to every
   phase. They are the edges of the same integer shortest path over pieces, one conversation
   at a time, of letters and costs alone; texts stay where they are and meet
   their piece's edits again by the piece's number.

Order of turns: by turn (nulls first), then role, then text, as code points of UTF-8. An audit is
one value, so its letters meet in one task, and so does what is hashed for a digest (as a stream).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import on_workers, shuffle_width, stored

#: What edits cost, and what a truncated turn that stays adds.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: Turns in a piece.
PIECE = 1_024
BLANKS = " \t\n\x0b\x0c\r"
OK, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
#: Phases: nothing yet, after s, after u, after a. Where a role's initial leads; ends.
BEGIN, AFTER_S, AFTER_U, AFTER_A = 0, 1, 2, 3
STEP = {(BEGIN, "s"): AFTER_S, (BEGIN, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_A, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A}
ENDS = (BEGIN, AFTER_A)

#: Nodes: (phase, inserts so far) -> weight.
Nodes = dict[tuple[int, int], int]


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with planted faults, from the crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets role user.
    A null id or turn reads as one space in the key, a null role or text is one space.
    """
    def key(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    h = F.crc32(F.concat(key("conv_id"), F.lit(":"), key("turn")).cast("binary")) % 20
    src = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), key("role").alias("role"), key("text").alias("text"),
                      h.alias("h")).where("h != 0")
    return src.select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("h") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _marked(rows: DataFrame) -> DataFrame:
    """Different rows with their number, and what is wrong with the first of each."""
    some = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    some = some.select("*", body.alias("body"), digest.alias("digest"),
                       F.struct(F.col("turn").isNotNull(), F.col("turn")).alias("place"))
    first = some.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min("place").alias("first"))
    met = some.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
    fault = (F.when(F.col("body") == "", BLANK).when(F.col("place") > F.col("first"), DUPLICATE)
             .when(~F.right("body", F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(OK))
    return met.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


def _pruned(nodes: Nodes, width: int) -> Nodes:
    least: dict[int, int] = {}
    for (phase, _), w in nodes.items():
        cost = w >> 8 * width
        least[phase] = min(cost, least.get(phase, cost))
    return {k: w for k, w in nodes.items() if w >> 8 * width == least[k[0]]}


def _offer(nodes: Nodes, node: tuple[int, int], weight: int) -> bool:
    if node in nodes and nodes[node] <= weight:
        return False
    nodes[node] = weight
    return True


def cheapest(turns: list[tuple[str, int]], begin: int) -> tuple[Nodes, int]:
    """Best paths over turns (role's initial, fault) from a phase to every phase, and the number of low bytes.

    More inserts than fit into the cost of deleting all turns (and three, to come
    from any phase to any other) are in no best path.
    """
    spare = DELETE * len(turns) // INSERT + 3
    width = len(turns) + spare

    def edit(cost: int, letter: str, at: int) -> int:
        return (cost << 8 * width) + (ord(letter) << 8 * (width - 1 - at))

    def with_inserts(nodes: Nodes, done: int) -> Nodes:
        fresh = dict(nodes)
        while fresh:
            nodes, last = _pruned(nodes, width), fresh
            fresh = {}
            for (phase, k), w in last.items():
                for role in "ua":
                    to = (STEP.get((phase, role)), k + 1)
                    if to[0] is not None and k < spare and (phase, k) in nodes:
                        better = w + edit(INSERT, "I", done + k)
                        if _offer(nodes, to, better):
                            fresh[to] = better
            kept = _pruned(nodes, width)
            fresh = {n: w for n, w in fresh.items() if n in kept}
        return _pruned(nodes, width)

    now = with_inserts({(begin, 0): 0}, 0)
    for done, (initial, fault) in enumerate(turns):
        then: Nodes = {}
        for (phase, k), w in now.items():
            _offer(then, (phase, k), w + edit(DELETE, "D", done + k))
            if fault in (BLANK, DUPLICATE):
                continue
            more = CUT_OFF if fault == TRUNCATED else 0
            if (phase, initial) in STEP:
                _offer(then, (STEP[phase, initial], k), w + edit(KEEP + more, "K", done + k))
            for role in "ua":
                if (phase, role) in STEP:
                    _offer(then, (STEP[phase, role], k), w + edit(REROLE + more, "R", done + k))
        now = with_inserts(then, done + 1)
    return now, width


def _read(weight: int, width: int) -> tuple[int, str]:
    letters = (weight & ((1 << 8 * width) - 1)).to_bytes(width, "big")
    return weight >> 8 * width, letters.rstrip(b"\0").decode()


def best_edits(turns: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    nodes, width = cheapest(turns, BEGIN)
    return _read(min(w for (phase, _), w in nodes.items() if phase in ENDS), width)


def joined_edits(pieces: list[list]) -> tuple[int, str]:
    """The same from the paths ``[begin, end, inserts, cost, letters]`` of consecutive pieces."""
    width = sum(max(len(p[4]) for p in paths) for paths in pieces)
    sizes = [len(paths[0][4]) - paths[0][2] for paths in pieces]
    now: Nodes = {(BEGIN, 0): 0}
    done = 0
    for paths, size in zip(pieces, sizes, strict=True):
        then: Nodes = {}
        for begin, end, k, cost, letters in paths:
            low = int.from_bytes(letters.encode(), "big")
            for (phase, before), w in now.items():
                if phase == begin:
                    at = done + before + len(letters)
                    _offer(then, (end, before + k), w + (cost << 8 * width) + (low << 8 * (width - at)))
        now, done = _pruned(then, width), done + size
    return _read(min(w for (phase, _), w in now.items() if phase in ENDS), width)


def _led(phase: int, edit: str, initial: str) -> int:
    """The phase after an edit of a turn with this initial."""
    if edit == "D":
        return phase
    return STEP[phase, initial if edit == "K" else "a" if phase == AFTER_U else "u"]


def apply_edits(letters: str, turns: list[tuple[str, str]], phase: int = BEGIN) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the turns that stay or are new."""
    out, rest = [], iter(turns)
    for edit in letters:
        role, text = ("", "") if edit == "I" else next(rest)
        if edit == "K":
            out.append((edit, role, text))
        elif edit != "D":
            out.append((edit, "assistant" if phase == AFTER_U else "user", text))
        phase = _led(phase, edit, role[:1])
    return out


def cut_edits(audit: str, sizes: list[int]) -> list[str]:
    """The audit by pieces of so many turns; inserts go with the turn after them, the last ones with the last piece."""
    out, at = [], 0
    for size in sizes:
        start = at
        while size:
            size -= audit[at] != "I"
            at += 1
        out.append(audit[start:at])
    out[-1] += audit[at:]
    return out


class _Counts:
    """Faults, illegal neighbours and missing turn numbers of consecutive turns, which can be added up."""

    NAMES = ("blank", "duplicate", "truncated", "illegal")

    def __init__(self, faults=(0, 0, 0, 0), first=None, last=None, low=None, high=None, distinct=0):
        self.faults, self.first, self.last = list(faults), first, last
        self.low, self.high, self.distinct = low, high, distinct

    def add(self, other: _Counts) -> None:
        """``other`` comes after self."""
        self.faults = [x + y for x, y in zip(self.faults, other.faults, strict=True)]
        if self.last is not None and other.first is not None:
            self.faults[3] += self.last + other.first not in ("su", "ua", "au")
        self.first = other.first if self.first is None else self.first
        self.last = self.last if other.last is None else other.last
        if other.low is not None:
            self.distinct += other.distinct - (self.high == other.low)
            self.low, self.high = other.low if self.low is None else self.low, other.high

    def turn(self, turn, role: str, fault: int) -> None:
        faults = [int(fault == kind) for kind in (BLANK, DUPLICATE, TRUNCATED)] + [0]
        self.add(_Counts(faults, role[:1], role[:1], turn, turn, int(turn is not None)))

    def state(self) -> list:
        return [self.faults, self.first, self.last, self.low, self.high, self.distinct]

    def totals(self) -> tuple[int, ...]:
        """gaps, blank, duplicate, truncated, illegal."""
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct, *self.faults


_TURNS = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
_TURNS_SQL = "array<struct<edit:string,role:string,text:string>>"
TOTALS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_OUT_SQL = f"piece long, turns {_TURNS_SQL}, " + ", ".join(f"{n} long" for n in TOTALS) + ", audit string"
_OUT = [("piece", pa.int64()), ("turns", _TURNS), *((n, pa.int64()) for n in TOTALS), ("audit", pa.string())]


def _batch(rows: list[tuple], kinds: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      [n for n, _ in kinds])


def _structs(turns: list[tuple[str, str, str]]) -> list[dict]:
    return [{"edit": e, "role": r, "text": t} for e, r, t in turns]


def _pieces(batches: Iterator[pa.RecordBatch], kinds: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to pieces: whole conversations repaired, the others with their paths."""
    number = TaskContext.get().partitionId() << 33
    out: list[tuple] = []
    at, opened, held, counts, seen = None, True, [], _Counts(), False

    def close(whole: bool):
        nonlocal number, held, counts
        if not held:
            return
        turns = [(role, text) for role, text, _ in held]
        codes = [(role[:1], fault) for role, _, fault in held]
        if whole:
            cost, audit = best_edits(codes)
            out.append((at, number, _structs(apply_edits(audit, turns)), *counts.totals(), cost, audit, None))
        else:
            paths = []
            for begin in (BEGIN, AFTER_S, AFTER_U, AFTER_A):
                nodes, width = cheapest(codes, begin)
                paths += [[begin, end, k, *_read(w, width)] for (end, k), w in nodes.items()]
            kept = [("", role, text) for role, text in turns]
            out.append((at, number, _structs(kept), *[None] * 6, None, json.dumps([paths, counts.state(), "".join(r[:1] if r[:1] in ("s", "u", "a") else "-" for r, _ in turns)])))
        number, held, counts = number + 1, [], _Counts()

    for b in batches:
        for conv, turn, role, text, copies, fault in zip(*[b.column(i).to_pylist() for i in range(6)], strict=True):
            if seen and conv != at:
                close(whole=not opened)
                opened = False
            at, seen = conv, True
            for copy in range(copies):
                if len(held) == PIECE:
                    opened = True
                    close(whole=False)
                # of equal rows all but the first are repeats
                wrong = DUPLICATE if copy and fault != BLANK else fault
                held.append((role, text, wrong))
                counts.turn(turn, role, wrong)
                if len(out) >= 1_000:
                    yield _batch(out, kinds)
                    out.clear()
    close(whole=False)
    if out:
        yield _batch(out, kinds)


_EDITS = [("piece", pa.int64()), ("phase", pa.int64()), ("letters", pa.string()), *((n, pa.int64()) for n in TOTALS),
          ("audit", pa.string())]
_EDITS_SQL = "piece long, phase long, letters string, " + ", ".join(f"{n} long" for n in TOTALS) + ", audit string"


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of the pieces, by conversation and piece, to the edits of each piece; totals at the last."""
    held: list[tuple] = []

    def flush():
        counts, phase, out = _Counts(), BEGIN, []
        cost, audit = joined_edits([paths for _, (paths, _, _) in held])
        cuts = cut_edits(audit, [len(initials) for _, (_, _, initials) in held])
        for (piece, (_, state, initials)), letters in zip(held, cuts, strict=True):
            counts.add(_Counts(*state))
            out.append([piece, phase, letters, *[None] * 7])
            rest = iter(initials)
            for edit in letters:
                phase = _led(phase, edit, "" if edit == "I" else next(rest))
        out[-1][3:] = [*counts.totals(), cost, audit]
        return _batch(out, _EDITS)

    at = None
    for b in batches:
        for conv, piece, paths in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
            if held and conv != at:
                yield flush()
                held = []
            at = conv
            held.append((piece, json.loads(paths)))
    if held:
        yield flush()


def _applied(batches: Iterator[pa.RecordBatch], kinds: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Pieces with their edits to pieces with the turns that stay or are new."""
    for b in batches:
        out = [(conv, piece, _structs(apply_edits(letters, [(t["role"], t["text"]) for t in turns], phase)), *totals)
               for conv, piece, turns, phase, letters, *totals in zip(*[c.to_pylist() for c in b.columns], strict=True)]
        if out:
            yield _batch(out, kinds)


def repair(rows: DataFrame) -> DataFrame:
    """Repaired conversations, a row for each piece: ``conv_id, piece, turns, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    ``turns`` is an array of ``edit, role, text`` of the turns that stay (K, R) or are new (I); the pieces of a
    conversation follow each other by ``piece``. The last piece has the totals of the conversation, the others null:
    ``gaps`` counts the turn numbers missing between the least and the largest, ``blank``, ``duplicate`` and
    ``truncated`` the turns by their first fault (only blanks; role and text seen earlier; last character not ``.!?``),
    ``illegal`` the neighbours before the repair whose roles' initials are not su, ua or au, ``cost`` and ``audit`` the edits.

    A null id is a conversation of its own; null turns come first and count for no gap; a null role or text is one
    space; a turn repeated any number of times is one turn and its duplicates; an empty table gives an empty result;
    other columns are ignored.
    """
    space = F.lit(" ")
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
                       F.coalesce(F.col("text").cast("string"), space).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    width = shuffle_width(rows.sparkSession)
    keys = ["conv_id", "turn", "role", "text"]
    ranged = _marked(rows).repartitionByRange(width, *keys).sortWithinPartitions(*keys)

    def pieces(batches):
        yield from _with_id(batches, lambda bs, ids: _pieces(bs, [ids, *_OUT, ("paths", pa.string())]))

    cut = stored(on_workers(ranged).mapInArrow(pieces, f"conv_id {kind}, {_OUT_SQL}, paths string"), "conversation-pieces")
    open_ = cut.where("paths is not null")
    edits = stored(open_.select("conv_id", "piece", "paths").repartition(width, "conv_id").sortWithinPartitions("conv_id", "piece")
                   .mapInArrow(_settled, _EDITS_SQL), "conversation-edits")

    def applied(batches):
        yield from _with_id(batches, lambda bs, ids: _applied(bs, [ids, *_OUT]))

    met = open_.select("conv_id", "piece", "turns").join(edits, "piece").select(
        "conv_id", "piece", "turns", "phase", "letters", *TOTALS, "audit")
    return cut.where("paths is null").drop("paths").unionAll(met.mapInArrow(applied, f"conv_id {kind}, {_OUT_SQL}"))


def _with_id(batches: Iterator[pa.RecordBatch], run) -> Iterator[pa.RecordBatch]:
    """``run(batches, field of the id)``, the id's type as Spark sends it."""
    first = next(batches, None)
    if first is not None:
        def every():
            yield first
            yield from batches

        yield from run(every(), ("conv_id", first.schema.field("conv_id").type))


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of each conversation's ``role:text`` joined by line feeds (lowercase hex).

    Conversations of one piece are hashed where they lie, the others as a stream of their sorted pieces.
    """
    many = repaired.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    lines = repaired.join(many.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "piece", "n", F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])).alias("lines"))
    one = lines.where("n = 1").select("conv_id", F.sha2(F.array_join("lines", "\n"), 256).alias("sha256"))

    def hashed(batches, ids):
        at, h, some, seen = None, hashlib.sha256(), False, False
        kinds = [ids, ("sha256", pa.string())]
        for b in batches:
            for conv, texts in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if seen and conv != at:
                    yield _batch([(at, h.hexdigest())], kinds)
                    h, some = hashlib.sha256(), False
                at, seen = conv, True
                for text in texts:
                    h.update((b"\n" if some else b"") + text.encode())
                    some = True
        if seen:
            yield _batch([(at, h.hexdigest())], kinds)

    def run(batches):
        yield from _with_id(batches, hashed)

    kind = repaired.schema["conv_id"].dataType.simpleString()
    width = shuffle_width(repaired.sparkSession)
    more = lines.where("n > 1").select("conv_id", "piece", "lines").repartition(width, "conv_id") \
        .sortWithinPartitions("conv_id", "piece").mapInArrow(run, f"conv_id {kind}, sha256 string")
    return one.unionAll(more)
