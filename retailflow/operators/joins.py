"""Join operators: dimension enrichment, snapshot lookup, grids, threshold join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .windows import row_number_by

# A side whose size is known exactly (a generated snapshot) is broadcast up to this many bytes.
BROADCAST_MAX_BYTES = 64 << 20
# Ranks that a large share of all draws match; this many rows are broadcast.
HOT_RANKS = 65_536
# Longest array that a candidate row is exploded from.
RANK_BLOCK = 1024
# Share of the rows from which a key is hot, and items that the frequent-items sketch tracks.
HOT_SHARE, HOT_TRACKED = 0.001, 10_000
# Thresholds in a node of the threshold index, and bytes of one when broadcast.
FANOUT, THRESHOLD_BYTES = 64, 16


def enrich(fact: DataFrame, dim: DataFrame, key: str | Sequence[str], how: str = "left") -> DataFrame:
    """Left equi join USING ``key``: one key column in the output, NULL
    attributes for unmatched facts. Duplicate dimension keys multiply fact
    rows, so pass a deduplicated dimension (see ``dedup``).

    No hint: the planner broadcasts a dimension whose size is under its own
    threshold (AQE again at run time, from the real size); a larger one is
    shuffled, and AQE splits a hot key of the fact."""
    return fact.join(dim, key if isinstance(key, str) else list(key), how)


def hot_keys(fact: DataFrame, key: str | Sequence[str], share: float = HOT_SHARE, tracked: int = HOT_TRACKED) -> DataFrame:
    """``key, _rf_n`` of the keys that hold more than ``share`` of the rows, by Spark's frequent-items sketch.

    The sketch keeps ``tracked`` items a task and merges them, so its size does not grow
    with the keys; a key above ``1 / tracked`` of the rows is never missed, and at
    most ``1 / share`` keys are returned. NULL keys are not counted.
    """
    keys = [key] if isinstance(key, str) else list(key)
    k = max(1, int(1 / share))
    item = F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(keys)]))
    known = F.lit(True)
    for c in keys:
        known = known & F.col(c).isNotNull()
    got = fact.select(F.when(known, item).alias("_rf_item")).agg(
        F.expr(f"approx_top_k(_rf_item, {k}, {max(tracked, k)})").alias("top"), F.count(F.lit(1)).alias("n"))
    rows = got.select("n", F.explode("top").alias("t")).where(
        F.col("t.item").isNotNull() & (F.col("t.count") > F.lit(share) * F.col("n")))
    parsed = F.from_json("t.item", ", ".join(f"k{i} string" for i in range(len(keys))))
    return rows.select(*[parsed[f"k{i}"].cast(fact.schema[c].dataType).alias(c) for i, c in enumerate(keys)],
                       F.col("t.count").alias("_rf_n"))


def enrich_spread(fact: DataFrame, dim: DataFrame, key: str | Sequence[str], how: str = "left",
                  parts: int | None = None, share: float | None = None) -> DataFrame:
    """``enrich`` for a dimension that may be too large to broadcast and a fact with hot keys.

    A key with more than ``share`` of the fact's rows (a quarter of an even part
    by default) is salted: its fact rows go to ``parts`` places by a hash of
    the whole row, and only the hot dimension rows are copied to all of them (at most
    ``1 / share`` keys). Fact rows with a NULL key, which match nothing, are spread the same way.
    Other keys join as before. Same rows as ``enrich``; a retried task salts its rows alike.
    """
    keys = [key] if isinstance(key, str) else list(key)
    parts = parts or int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    hot = hot_keys(fact, keys, share or 0.25 / parts).select(*keys, F.lit(True).alias("_rf_hot"))
    ensure_checkpoint_dir(fact.sparkSession)
    hot = F.broadcast(hot.checkpoint(eager=True))  # at most 1 / share rows
    missing = F.lit(False)
    for c in keys:
        missing = missing | F.col(c).isNull()
    salt = F.pmod(F.xxhash64(*fact.columns), F.lit(parts)).cast("int")
    salted = fact.join(hot, keys, "left").withColumn(
        "_rf_salt", F.when(missing | F.col("_rf_hot"), salt).otherwise(F.lit(0))).drop("_rf_hot")
    copies = F.when(F.col("_rf_hot"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    spread = dim.join(hot, keys, "left").withColumn("_rf_salt", F.explode(copies)).drop("_rf_hot")
    return salted.join(spread, [*keys, "_rf_salt"], how).drop("_rf_salt")


def enrich_snapshot(fact: DataFrame, snap: DataFrame, on: Sequence[tuple[str, str]],
                    cols: Sequence[str], how: str = "left", strategy: str | None = "merge") -> DataFrame:
    """Left join on several differently named keys (e.g. sale date = stock
    date, store = store, product = product); only ``cols`` of the snapshot are
    kept and its key copies are dropped.

    The snapshot side is hinted ``merge`` by default: a snapshot can be as
    large as the fact, and size estimates of generated tables are too low to
    trust for a broadcast. When the fact is already hash-partitioned on the
    keys (e.g. it is the output of a group-by on them), only the snapshot is
    shuffled. Pass ``strategy=None`` to let the planner choose.
    """
    renamed = snap.select(*[F.col(b).alias(f"_snap_{i}") for i, (_, b) in enumerate(on)],
                          *[F.col(c) for c in cols])
    if strategy:
        renamed = renamed.hint(strategy)
    cond = None
    for i, (a, _) in enumerate(on):
        term = fact[a] == renamed[f"_snap_{i}"]
        cond = term if cond is None else cond & term
    joined = fact.join(renamed, cond, how)
    return joined.drop(*[f"_snap_{i}" for i in range(len(on))])


def date_sequence(start: Column, end: Column) -> Column:
    """Inclusive daily sequence as an array column (use with ``explode``)."""
    return F.sequence(start, end, F.expr("INTERVAL 1 DAY"))


def explode_dates(df: DataFrame, start, end, out: str) -> DataFrame:
    """One row per input row and day in ``[start, end]`` (a generator, no join)."""
    s = F.lit(start).cast("date") if not isinstance(start, Column) else start
    e = F.lit(end).cast("date") if not isinstance(end, Column) else end
    return df.withColumn(out, F.explode(date_sequence(s, e)))


def explode_values(df: DataFrame, values: Sequence, out: str, dtype: str | None = None) -> DataFrame:
    """One row per input row and value of a short fixed list (a generator, no join)."""
    if all(isinstance(v, int) and not isinstance(v, bool) for v in values):
        arr = F.expr("array(" + ", ".join(f"{v}L" for v in values) + ")")  # one literal, one call
    else:
        arr = F.array(*[F.lit(v) for v in values])
    res = df.withColumn(out, F.explode(arr))
    return res.withColumn(out, F.col(out).cast(dtype)) if dtype else res


def bounded_values(df: DataFrame, c: str, max_rows: int) -> list:
    """The values of one column of a table with a proven row bound.

    Raises when the bound does not hold, so a list never grows with the data.
    """
    rows = df.select(c).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"column {c!r}: more than {max_rows} rows; not a bounded list")
    return [r[0] for r in rows]


def _threshold_levels(placed: DataFrame, n: int, fanout: int) -> list[tuple[DataFrame, int]]:
    """The sorted thresholds (``_rf_at`` from 0, ``_rf_t``) as levels of nodes, root first: (node, thresholds) and entries.

    A leaf holds ``fanout`` thresholds that follow each other, a node above the first threshold of each of its children.
    """
    levels, entries, count = [], placed.select(F.col("_rf_at").alias("_rf_e"), "_rf_t"), n
    while True:
        node = F.floor(F.col("_rf_e") / F.lit(fanout)).alias("_rf_node")
        nodes = entries.groupBy(node).agg(F.sort_array(F.collect_list(F.struct("_rf_e", "_rf_t"))).alias("_rf_s")) \
            .select("_rf_node", F.col("_rf_s._rf_t").alias("_rf_ts"))
        levels.append((nodes, count))
        if count <= fanout:
            return levels[::-1]
        entries = nodes.select(F.col("_rf_node").alias("_rf_e"), F.element_at("_rf_ts", 1).alias("_rf_t"))
        count = -(-count // fanout)


def threshold_join(items: DataFrame, u: str, ranked: DataFrame, weight: str, factor: float,
                   hot_ranks: int = HOT_RANKS, fanout: int = FANOUT) -> DataFrame:
    """Theta join ``u < weight * factor`` for weights of any form: unsorted, tied, zero, negative or NULL.

    Row for row the theta join (NULL on either side matches nothing), without
    comparing every item with every row. In falling order of the thresholds
    ``weight * factor`` (a distributed numbering) the matches of a draw are the places
    1 .. r(u). r(u) is read from an index of the sorted thresholds: nodes of ``fanout``
    thresholds that follow each other, cut from the numbering, and levels of nodes above
    them; each level is an equi join on the node and a search among ``fanout`` thresholds. Then
    the places up to r(u) are generated and joined, so the work is proportional to the output.

    Draws above the largest threshold, which match nothing, are left out before the search. A level is
    broadcast if its thresholds are under ``BROADCAST_MAX_BYTES`` (the upper
    ones always are in practice); a larger one is joined as the planner sees fit.

    Low places, which a large share of all draws match, are generated and looked up in a broadcast: the first
    ``hot_ranks``, a fixed number of rows. Beyond them an item meets whole blocks of ``RANK_BLOCK`` rows, so one
    row per item and block is shuffled, not one per match; a block has at most ``RANK_BLOCK / hot_ranks`` of the
    output. No row holds an array as long as the catalogue.
    """
    known = ranked.where(F.col(weight).isNotNull()).withColumn("_rf_t", F.col(weight) * F.lit(factor))
    order = [F.col("_rf_t").desc(), *[F.col(c).asc() for c in ranked.columns]]
    placed = row_number_by(known, order, out="_rf_place").withColumn("_rf_at", F.col("_rf_place").cast("bigint") - 1)
    ensure_checkpoint_dir(ranked.sparkSession)
    placed = placed.checkpoint(eager=True)
    n = placed.count()
    if not n:
        return items.join(ranked, F.lit(False))
    # at most two rows: the largest threshold, and the largest beyond the hot places
    cuts = {r["_rf_at"]: r["_rf_t"] for r in placed.where(F.col("_rf_at").isin(0, hot_ranks)).select("_rf_at", "_rf_t").collect()}
    kind = placed.schema["_rf_t"].dataType
    levels = []
    for nodes, entries in _threshold_levels(placed, n, fanout):
        levels.append(F.broadcast(nodes) if entries * THRESHOLD_BYTES <= BROADCAST_MAX_BYTES else nodes)

    def tops(cut) -> DataFrame:
        """The items that match the place of the cut, with ``_rf_top``, the last place that they match."""
        found = items.where(F.col(u) < F.lit(cut).cast(kind)).withColumn("_rf_node", F.lit(0).cast("bigint"))
        for k, nodes in enumerate(levels):
            above = F.size(F.filter("_rf_ts", lambda t: t > F.col(u)))
            inside = above if k == len(levels) - 1 else F.greatest(above - 1, F.lit(0))
            found = found.join(nodes, "_rf_node", "left").withColumn(
                "_rf_node", (F.col("_rf_node") * F.lit(fanout) + inside).cast("bigint")).drop("_rf_ts")
        # of the leaf, node * fanout + those above u is r(u) itself
        return found.withColumnRenamed("_rf_node", "_rf_top").where(F.col("_rf_top") >= 1)

    rows = placed.select(F.col("_rf_place").cast("bigint").alias("_rf_place"), *ranked.columns)

    def blocks(found: DataFrame, before: int) -> DataFrame:
        """A row per item and block of places after ``before`` that it reaches (``_rf_block`` from 0)."""
        return found.withColumn("_rf_block", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.floor((F.col("_rf_top") - F.lit(before + 1)) / F.lit(RANK_BLOCK)))))

    first = F.col("_rf_block") * F.lit(RANK_BLOCK) + 1
    head = blocks(tops(cuts[0]).withColumn("_rf_top", F.least("_rf_top", F.lit(hot_ranks).cast("bigint"))), 0)
    head = head.withColumn("_rf_place", F.explode(F.sequence(first, F.least("_rf_top", first + F.lit(RANK_BLOCK - 1))))) \
        .drop("_rf_block", "_rf_top")
    out = head.join(F.broadcast(rows.where(F.col("_rf_place") <= hot_ranks)), "_rf_place", "inner").drop("_rf_place")
    if n > hot_ranks:
        after = F.col("_rf_place") - F.lit(hot_ranks + 1)
        packed = rows.where(F.col("_rf_place") > hot_ranks).groupBy(F.floor(after / F.lit(RANK_BLOCK)).alias("_rf_block")) \
            .agg(F.sort_array(F.collect_list(F.struct("_rf_place", *ranked.columns))).alias("_rf_rows"))
        tail = blocks(tops(cuts[hot_ranks]), hot_ranks)
        # few small rows that become many: an even number of blocks a task, whatever their bytes
        tail = tail.repartition(int(tail.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), "_rf_block")
        reached = F.least(F.lit(RANK_BLOCK).cast("bigint"), F.col("_rf_top") - F.lit(hot_ranks) - F.col("_rf_block") * F.lit(RANK_BLOCK))
        tail = tail.join(packed, "_rf_block", "inner") \
            .select(*items.columns, F.explode(F.slice("_rf_rows", F.lit(1), reached.cast("int"))).alias("_rf_row")) \
            .select(*items.columns, *[F.col("_rf_row")[c].alias(c) for c in ranked.columns])
        out = out.unionByName(tail)
    return out
