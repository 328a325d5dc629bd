"""Refresh of partitioned tables: only what changed is read and rebuilt.

* ``refresh_partitions``: a fact partition (a day, a month) is rebuilt if the
  Silver rows behind it changed: another number of rows, another newest load, or
  other contents (a sum of row hashes). A row per source and partition is kept beside the fact.
* ``refresh_keys`` and ``key_report``: the key rules of a table from a stored
  summary of its different keys with counts per partition; after a partial load only
  the partitions of the load are read again.

Both can be rerun at any point: a run that broke off finds the same partitions changed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, DateType, IntegerType, LongType, ShortType, StringType

from ..operators.joins import bounded_values
from ..session import ensure_checkpoint_dir
from ..sources import catalog as cat
from ..sources import upkeep
from .quality import GOLD_FOREIGN_KEYS, GOLD_PRIMARY_KEYS, _key_text, status_of

#: Partitions that one table may have here (days of 270 years).
MAX_PARTITIONS = 100_000


# ------------------------------------------------------------------ facts ---
def partition_summary(rows: DataFrame, part: Column, source: str, ts: str = "silver_ts") -> DataFrame:
    """``source, part, rows, newest, digest`` per partition value; one pass, combined on the map side.

    ``digest`` sums a hash of every column but the load timestamp, so it sees edits that keep
    count and timestamp, and does not depend on the order or the layout of the rows.
    The 64 bits of a hash are added up as three longs, and only the sums become one decimal.
    """
    cols = [c for c in rows.columns if c != ts]
    newest = F.max(ts) if ts in rows.columns else F.lit(None).cast("timestamp")
    names = [c for c in rows.columns if c in cols or c == ts]
    hashed = rows.select(part.cast("string").alias("_rf_part"), *names, F.xxhash64(*cols).alias("_rf_h"))
    low, mid, high = (f"({bits})" for bits in ("_rf_h & 4194303", "shiftright(_rf_h, 22) & 4194303", "shiftright(_rf_h, 44)"))
    found = hashed.groupBy(F.col("_rf_part").alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), newest.alias("newest"),
        F.sum(F.expr(low)).alias("_rf_0"), F.sum(F.expr(mid)).alias("_rf_1"), F.sum(F.expr(high)).alias("_rf_2"))
    digest = " + ".join(f"CAST(CAST(_rf_{i} AS DECIMAL(20,0)) * {2 ** (22 * i)}BD AS DECIMAL(38,0))" for i in range(3))
    return found.select(F.lit(source).alias("source"), "part", "rows", "newest", F.expr(f"CAST({digest} AS DECIMAL(30,0))").alias("digest"))


def changed_partitions(now: DataFrame, before: DataFrame) -> DataFrame:
    """``part, gone`` where the summaries differ; ``gone`` if no source has rows of it now. NULL partitions meet."""
    cols = ["rows", "newest", "digest"]
    x = now.select("source", "part", F.struct(*cols).alias("now"))
    y = before.select(F.col("source").alias("s"), F.col("part").alias("p"), F.struct(*cols).alias("before"))
    met = x.join(y, (F.col("source") == F.col("s")) & F.col("part").eqNullSafe(F.col("p")), "full")
    parted = met.select(F.when(F.col("source").isNotNull(), F.col("part")).otherwise(F.col("p")).alias("part"),
                        (~F.col("now").eqNullSafe(F.col("before"))).alias("changed"), F.col("now").isNull().alias("none"))
    return parted.groupBy("part").agg(F.max("changed").alias("changed"), F.min("none").alias("gone")) \
        .where("changed").select("part", "gone")


def refresh_partitions(spark: SparkSession, name: str, partition: str, sources: Mapping[str, tuple[DataFrame, Column]],
                       build: Callable[[Mapping[str, DataFrame]], DataFrame], leading: str | None = None,
                       **load) -> dict[str, list]:
    """Bring table ``name`` up to date with its sources; returns the partitions ``rebuilt`` and ``dropped`` (as text).

    ``sources`` maps a name to rows and the expression of the partition value that
    a row belongs to; ``build`` makes the table from (a part of) the sources, given under the same names, and must use
    rows of a partition value for that partition only. ``leading`` names the source without
    whose rows a partition has none (the first by default). The first run builds everything.
    ``load`` goes to ``catalog.save``. The result is the table that a full rebuild gives (but for load timestamps).
    """
    leading = leading or next(iter(sources))
    log = f"{name}__parts"
    now = None
    for source, (rows, part) in sources.items():
        s = partition_summary(rows, part, source)
        now = s if now is None else now.unionByName(s)
    ensure_checkpoint_dir(spark)
    now = now.checkpoint(eager=True)  # a row per source and partition
    if not (cat.table_exists(spark, name) and cat.table_exists(spark, log)):
        cat.save(build({s: rows for s, (rows, _) in sources.items()}), name, partition_by=[partition], **load)
        cat.create_or_replace(now, log)
        return {"rebuilt": sorted(bounded_values(now.select("part").distinct(), "part", MAX_PARTITIONS), key=str), "dropped": []}
    changed = changed_partitions(now, spark.table(log))
    parts = bounded_values(changed.select("part"), "part", MAX_PARTITIONS)
    if not parts:
        return {"rebuilt": [], "dropped": []}
    kept = set(bounded_values(now.where(F.col("source") == leading).select("part"), "part", MAX_PARTITIONS))
    rebuilt, dropped = [p for p in parts if p in kept], [p for p in parts if p not in kept]
    if rebuilt:
        some = {s: rows.where(_one_of(part, rebuilt)) for s, (rows, part) in sources.items()}
        cat.save(build(some), name, partition_by=[partition], replace_partitions=True, **load)
    data = cat.current(spark, name)
    for p in dropped:
        upkeep._drop_partitions(spark, data, {partition: p})
    # last: a run that breaks off before this finds the same partitions changed
    cat.create_or_replace(now, log)
    return {"rebuilt": sorted(rebuilt, key=str), "dropped": sorted(dropped, key=str)}


def _one_of(part: Column, values: Sequence[str | None]) -> Column:
    """The rows of these partition values (text), as a filter that a scan of a partitioned table can use."""
    known = [v for v in values if v is not None]
    found = part.cast("string").isin(known) if known else F.lit(False)
    return found | part.isNull() if None in values else found


# ------------------------------------------------------------------- keys ---
def key_rules(table: str) -> dict[str, list[str]]:
    """The key rules of a Gold table: rule -> key columns."""
    return {r: list(c) for r, t, c, *_ in [*GOLD_PRIMARY_KEYS, *GOLD_FOREIGN_KEYS] if t == table}


#: Types of which different values have different texts.
_PLAIN_TEXT = (ByteType, ShortType, IntegerType, LongType, DateType, StringType, BooleanType)


def key_summary(rows: DataFrame, rules: Mapping[str, Sequence[str]], partition: str | None = None) -> DataFrame:
    """``rule, key, n, <partition>``: the different keys with their rows; a key with a NULL part is NULL.

    Each rule reads its own columns, counted on the map side; the rows of a plain column are counted by value, and only
    the different ones become text.
    """
    by, out = partition or "part", None
    part = (F.col(partition) if partition else F.lit("all")).alias("_rf_part")
    for rule, cols in rules.items():
        plain = len(cols) == 1 and isinstance(rows.schema[cols[0]].dataType, _PLAIN_TEXT)
        keys = rows.select((F.col(cols[0]) if plain else _key_text(cols)).alias("key"), part)
        one = keys.groupBy("key", "_rf_part").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(rule).alias("rule"), F.col("key").cast("string").alias("key"), "n", F.col("_rf_part").alias(by))
        out = one if out is None else out.unionByName(one)
    return out


def refresh_keys(spark: SparkSession, name: str, rules: Mapping[str, Sequence[str]], partition: str | None = None,
                 parts: Sequence[str | None] | None = None) -> DataFrame:
    """The stored key summary of table ``name``, brought up to date for the partitions ``parts`` (None: all).

    Only those partitions are read; of partitions that are gone the summary is dropped.
    """
    log, by = f"{name}__keys", partition or "part"
    if parts is None or partition is None or not cat.table_exists(spark, log):
        cat.save(key_summary(spark.table(name), rules, partition), log, partition_by=[by])
        return spark.table(log)
    if parts:
        some = spark.table(name).where(_one_of(F.col(partition), list(parts)))
        cat.save(key_summary(some, rules, partition), log, partition_by=[by], replace_partitions=True)
        left = set(bounded_values(some.select(F.col(partition).cast("string").alias("p")).distinct(), "p", MAX_PARTITIONS))
        for p in parts:
            if p not in left:
                upkeep._drop_partitions(spark, cat.current(spark, log), {by: p})
    return spark.table(log)


def key_report(summaries: Mapping[str, DataFrame]) -> DataFrame:
    """The Gold key report (see ``quality.gold_key_report``) from the key summaries of the star's tables.

    Summaries of all partitions are merged first, so a key that repeats across partitions counts.
    """
    merged = None
    for df in summaries.values():
        one = df.select("rule", "key", "n")
        merged = one if merged is None else merged.unionByName(one)
    keys = merged.groupBy("rule", "key").agg(F.sum("n").alias("n"))
    primary = [r for r, *_ in GOLD_PRIMARY_KEYS]
    found = keys.where(F.col("rule").isin(primary)).groupBy("rule").agg(
        F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(F.col("n") - 1)).alias("v"))
    by_table = {t: r for r, t, _ in GOLD_PRIMARY_KEYS}
    pairs = keys.sparkSession.createDataFrame([(r, by_table[ref]) for r, _, _, ref, _ in GOLD_FOREIGN_KEYS], "rule string, _rf_pk string")
    child = keys.where(F.col("key").isNotNull()).join(F.broadcast(pairs), "rule")  # a row per rule
    parent = keys.where(F.col("rule").isin(primary) & F.col("key").isNotNull()).select(F.col("rule").alias("_rf_pk"), "key")
    orphans = child.join(parent, ["_rf_pk", "key"], "left_anti").groupBy("rule").agg(F.sum("n").alias("v"))
    return status_of(found.unionByName(orphans))
