"""Connected components of an edge table, as Spark jobs.

Alternating large-star and small-star steps: each step points nodes to the
smallest neighbour and keeps connectivity; the number of edges never grows,
and the rounds are logarithmic. Every step is a grouped minimum (combined on
the map side) and a join that AQE can split on a hub. Each round's edges are
written to the shared folder, so the lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``: root is the smallest node it reaches.

    Loops and repeated edges do no harm; null ends are ignored; no edges give
    no rows.
    """
    clean = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")) \
        .where("a is not null and b is not null and a != b").distinct()
    now = stored(clean, name)
    state = _state(now)
    while state[0]:
        now = stored(_small_star(_large_star(now)).distinct(), name)
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
