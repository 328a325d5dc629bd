"""Mixing sources to target weights by the cube method (balanced sampling).

Every source has a target number of words. A document is taken
``floor(target / source words)`` times for certain and once more with the
fractional inclusion probability that is left. The extra copies are drawn by
the cube method: the flight phase moves the probabilities of a few documents
at a time along the null space of the balancing constraints (documents and
words of the source), until one of them reaches 0 or 1, so both totals never
change on the way. The few documents that stay fractional are a small landing
problem, solved by enumeration together with a ladder of document sizes that was held back for it.

On Spark the flight runs in blocks of a source's documents (hashed by id, so a
source with a third of all rows is many blocks; rows that repeat a whole
(id, size, source) are counted and numbered, and spread by number). A block leaves at most two
fractional documents and a few that it holds back for the landing; these form
the next level's blocks, until each source fits one block, which lands. Only ids and sizes are shuffled, never texts.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import WORD, on_workers, stored

#: Documents per flight block, and documents left for the landing problem.
BLOCK, LANDING = 2_048, 16
#: Halvings that make a ladder, and sizes from which a document is far larger than another.
LADDER, OUTLIER = 12, 2
EPS = 1e-9
MAX_REPEATS = 3

_SCHEMA = "doc_id {id}, source string, size long, pi double, k long, salt long, extra long"


def word_count(text: Column) -> Column:
    """Words of a whole text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def flight(pi: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Flight phase: probabilities moved to 0 or 1 with ``sum(pi)`` (documents)
    and ``sum(a * pi)`` (words) kept; at most two stay fractional.

    The direction of each move is drawn from a generator seeded by the sizes,
    so a rerun repeats it.
    """
    p = pi.astype(float).copy()
    rng = np.random.default_rng([len(p), int(a.sum()) & 0xFFFFFFFF])
    draws = rng.random(2 * len(p) + 8)
    free = [i for i in range(len(p)) if EPS < p[i] < 1 - EPS][::-1]
    active: list[int] = []
    step = 0
    while True:
        while len(active) < 3 and free:
            active.append(free.pop())
        if len(active) < 3:
            return np.clip(p, 0.0, 1.0)
        i, j, k = active
        # null vector of the rows (1, 1, 1) and (a_i, a_j, a_k)
        u = np.array([a[k] - a[j], a[i] - a[k], a[j] - a[i]])
        if np.abs(u).max() <= EPS:
            u = np.array([1.0, -1.0, 0.0])
        q = p[active]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - q) / u, np.where(u < 0, -q / u, np.inf)).min()
            down = np.where(u > 0, q / u, np.where(u < 0, (q - 1) / u, np.inf)).min()
        q = q + up * u if draws[step % len(draws)] * (up + down) < down else q - down * u
        step += 1
        p[active] = np.where(q < EPS, 0.0, np.where(q > 1 - EPS, 1.0, q))
        active = [m for m in active if EPS < p[m] < 1 - EPS]


def landing(pi: np.ndarray, size: np.ndarray, goal: float) -> np.ndarray:
    """Of a few documents, those whose sizes come nearest to ``goal`` words
    (then nearest in number to the sum of ``pi``, then the earliest)."""
    sums, counts = np.zeros(1), np.zeros(1)
    for x in size.astype(float):
        # subset m of the first i documents, and the same with document i: bit i of the place
        sums, counts = np.concatenate([sums, sums + x]), np.concatenate([counts, counts + 1])
    away, many = np.round(np.abs(sums - goal), 6), np.abs(counts - float(pi.sum()))
    near = np.flatnonzero(away == away.min())
    best = int(near[np.argmin(many[near])])
    return np.array([float(best >> i & 1) for i in range(len(pi))])


def settle_outliers(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Documents far larger than all but a few are decided first, by a draw seeded by the sizes.

    A few documents cannot make up for the fraction of such a document at the landing. The words that
    its decision adds or takes are spread over the probabilities of the others, so the
    expected words of the source stay as they are. A document is left open if the others cannot take it.
    """
    p = p.astype(float).copy()
    if len(p) <= LANDING:
        return p
    order = np.argsort(-size, kind="stable")
    large = OUTLIER * size[order[LANDING]]
    rng = np.random.default_rng([len(p), int(size.sum()) & 0xFFFFFFFF, 1])
    for i in order[:LANDING]:
        draw = rng.random()
        if size[i] <= large or not EPS < p[i] < 1 - EPS:
            continue
        rest = np.flatnonzero((p > EPS) & (p < 1 - EPS) & (size <= large))
        for taken in ((1.0, 0.0) if draw < p[i] else (0.0, 1.0)):
            words = size[i] * (p[i] - taken)  # for the others to take up
            room = (size[rest] * (1 - p[rest])).sum() if words > 0 else (size[rest] * p[rest]).sum()
            if abs(words) < 0.9 * room:
                share = words / room
                p[rest] += share * (1 - p[rest]) if words > 0 else share * p[rest]
                p[i] = taken
                break
    return p


def targets(by_source: DataFrame, weights=(1, 2, 3), most: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, n, target`` for a table of ``source, source_size, n``.

    Sources by code point, null last, weigh ``weights`` in turn; shares over
    ``most`` times a source's size are cut there and the excess is reshared by
    weight until none is above. The table has a row per source: it is the one
    thing computed on the driver, exactly, in fractions.
    """
    rows = by_source.select("source", "source_size", "n").collect()
    rows = sorted(rows, key=lambda r: (r.source is None, (r.source or "").encode()))
    total = sum(int(r.source_size) for r in rows)
    weight = [weights[i % len(weights)] for i in range(len(rows))]
    cap = [most * int(r.source_size) for r in rows]
    full: set[int] = set()
    share = [Fraction(0)] * len(rows)
    while len(full) < len(rows):
        rest, w = total - sum(cap[i] for i in full), sum(weight[i] for i in range(len(rows)) if i not in full)
        for i in range(len(rows)):
            share[i] = Fraction(cap[i]) if i in full else Fraction(rest * weight[i], w)
        over = {i for i in range(len(rows)) if i not in full and share[i] > cap[i]}
        if not over:
            break
        full |= over
    share = [Fraction(cap[i]) if i in full else share[i] for i in range(len(rows))]
    schema = "source string, source_size long, n long, target double, base long, pi double"
    out = []
    for r, s in zip(rows, share, strict=True):
        times = s / int(r.source_size) if r.source_size else Fraction(0)
        base = int(times)
        out.append((r.source, int(r.source_size), int(r.n), float(s), base, float(times - base)))
    return by_source.sparkSession.createDataFrame(out, schema)


def balanced_extra(units: DataFrame, block: int = BLOCK, hold: int = LANDING) -> DataFrame:
    """Draw the extra copies: adds ``extra`` (0 or 1) to ``doc_id, source, size, pi``.

    ``row`` tells rows apart that are otherwise equal; without it they are counted and numbered. ``size`` is never null; ``source`` may be. Probabilities of 0 or 1 are
    decided at once. Levels of flight blocks follow until every source has one
    block, which lands. The number of levels is logarithmic in the largest
    source, each level holds a few rows per block of the one before.
    """
    id_type = units.schema["doc_id"].dataType.simpleString()
    schema = _SCHEMA.format(id=id_type)
    if "row" not in units.columns:
        units = numbered(units.groupBy(*units.columns).agg(F.count(F.lit(1)).alias("n")))
    units = units.withColumns({"k": F.col("size"), "salt": F.xxhash64("doc_id", "size", "source", "row"),
                               "extra": F.lit(None).cast("long")}).drop("row")
    sure = units.where((F.col("pi") <= EPS) | (F.col("pi") >= 1 - EPS)) \
        .withColumn("extra", F.when(F.col("pi") > 0.5, F.lit(1)).otherwise(F.lit(0)).cast("long"))
    parts = [sure.select("doc_id", "source", "size", "extra")]
    open_ = units.where((F.col("pi") > EPS) & (F.col("pi") < 1 - EPS)).withColumn("p", F.col("pi"))
    level = 0
    while True:
        counts = open_.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
        most = counts.agg(F.max("rows")).first()[0]
        if not most:
            return _union(parts)
        last = most <= block
        blocks = F.lit(1) if last else F.greatest(F.lit(1), F.ceil(F.col("rows") / F.lit(block // 2)))
        dealt = open_.join(F.broadcast(counts), open_.source.eqNullSafe(counts.source)).drop(counts.source) \
            .withColumn("blocks", blocks.cast("long")) \
            .withColumn("block", F.pmod(F.xxhash64("salt", F.lit(level)), F.col("blocks")))
        done = on_workers(dealt).groupBy("source", "block").applyInPandas(
            _step(last, hold), schema=schema + ", p double")
        if last:
            parts.append(done.select("doc_id", "source", "size", "extra"))
            return _union(parts)
        done = stored(done, f"cube-level{level}")
        parts.append(done.where(F.col("extra").isNotNull()).select("doc_id", "source", "size", "extra"))
        open_ = done.where(F.col("extra").isNull())
        level += 1


def numbered(kinds: DataFrame, block: int = BLOCK) -> DataFrame:
    """``kinds`` (with a count ``n``) as ``n`` rows each, numbered from 0 in ``row``.

    Equal rows are interchangeable, so the numbers are the same in every run. Kinds
    of more than ``block`` rows are dealt out in ranges of ``block`` first.
    """
    few = kinds.where(F.col("n") <= block).withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(block).cast("long")))
    ranges = kinds.where(F.col("n") > block).withColumn("at", at).repartition("doc_id", "source", "size", "at")
    many = ranges.withColumn("row", F.explode(F.sequence(F.col("at"), F.least(F.col("n"), F.col("at") + block) - 1)))
    return few.unionByName(many.drop("at")).drop("n")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rungs(size: np.ndarray, share: int, first: int = 0) -> np.ndarray:
    """Documents held for the landing: a ladder of sizes, each about half of the one before.

    The sums of a ladder reach every number of words up to the largest document to
    about its smallest rung, whatever large document is left fractional. Blocks take their
    rungs in turn (``first``), so the ladder is whole on the next level.
    """
    away, out = size.astype(float), []
    free = np.ones(len(size), bool)
    for i in range(share):
        goal = size.max() / 2 ** (1 + (first + i) % LANDING % LADDER)
        out.append(int(np.argmin(np.where(free, np.abs(away - goal), np.inf))))
        free[out[-1]] = False
    return np.array(out, np.int64)


def _step(last: bool, hold: int):
    columns = ["doc_id", "source", "size", "pi", "k", "salt", "extra", "p"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["salt", "size"], kind="stable").reset_index(drop=True)
        p, size = pdf["p"].to_numpy(float), pdf["size"].to_numpy(float)
        n = len(pdf)
        if last:
            p = settle_outliers(p, size)
        share = hold if last else -(-hold // int(pdf["blocks"].iloc[0]))
        open_ = np.flatnonzero((p > EPS) & (p < 1 - EPS))
        kept = open_[rungs(size[open_], share, int(pdf["block"].iloc[0]) * share)] if len(open_) > share else open_
        flown = np.setdiff1d(open_, kept)
        # large documents first: those that stay fractional are mostly among the last
        flown = flown[np.argsort(-size[flown], kind="stable")]
        goal, p = float((size * pdf["p"].to_numpy(float)).sum()), p.copy()
        if len(flown):
            p[flown] = flight(p[flown], size[flown])
        if last:
            kept = np.concatenate([kept, flown[(p[flown] > EPS) & (p[flown] < 1 - EPS)]])
            fixed = np.setdiff1d(np.arange(n), kept)
            p[kept] = landing(p[kept], size[kept], goal - float(size[fixed][p[fixed] > 0.5].sum()))
        decided = (p <= EPS) | (p >= 1 - EPS)
        pdf["p"] = p
        pdf["extra"] = pd.array(np.where(decided, (p > 0.5).astype(np.int64), 0), dtype="Int64")
        pdf.loc[~decided, "extra"] = pd.NA
        return pdf[columns]

    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=(1, 2, 3), most: int = MAX_REPEATS) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``.

    ``taken`` is the words that the mix takes of the document, repeats
    counted: a whole multiple of its size, at most ``most`` times. Each
    source's words taken come near ``target``, and the documents drawn near
    their expected number. Null texts have size 0 and are never missed; a null
    source is a source of its own (last); null ids are kept, repeated rows are
    drawn one by one, ties in size are broken by a hash of the id; an empty
    table gives an empty result; other columns are ignored. Sources must be
    few enough for a row each on the driver. Reruns give the same draw.
    """
    sizes = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                        word_count(F.col(text_col).cast("string")).alias("size"))
    kinds = stored(sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    by_source = kinds.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
    goal = targets(by_source, weights, most)
    units = numbered(kinds)
    joined = units.join(F.broadcast(goal), units.source.eqNullSafe(goal.source)).drop(goal.source)
    # size 0 adds nothing to either total of words: decided at once
    pi = F.when(F.col("size") == 0, F.lit(0.0)).otherwise(F.col("pi"))
    drawn = balanced_extra(joined.select("doc_id", "source", "size", "row", pi.alias("pi")))
    out = drawn.join(F.broadcast(goal), drawn.source.eqNullSafe(goal.source)).drop(goal.source)
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * (F.col("base") + F.col("extra"))).alias("taken"))
