"""Data-quality jobs: NULL keys, duplicate keys, orphan foreign keys, and the
Gold key report (3 primary keys, 6 foreign keys of the star schema).

All checks are aggregations that pre-aggregate on the map side: a key that
holds a third of the rows reaches the shuffle as one partial count per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# --- key rules of the Gold star schema (our names) ---------------------------
GOLD_PRIMARY_KEYS = [
    ("pk_dim_stores", "dim_stores", ["store_id"]),
    ("pk_dim_products", "dim_products", ["product_id"]),
    ("pk_dim_calendar", "dim_calendar", ["day"]),
]
GOLD_FOREIGN_KEYS = [
    ("fk_fact_sales_dim_calendar", "fact_daily_sales", ["sale_date"], "dim_calendar", ["day"]),
    ("fk_fact_sales_dim_stores", "fact_daily_sales", ["store_id"], "dim_stores", ["store_id"]),
    ("fk_fact_sales_dim_products", "fact_daily_sales", ["product_id"], "dim_products", ["product_id"]),
    ("fk_fact_stock_dim_calendar", "fact_daily_stock", ["stock_date"], "dim_calendar", ["day"]),
    ("fk_fact_stock_dim_stores", "fact_daily_stock", ["store_id"], "dim_stores", ["store_id"]),
    ("fk_fact_stock_dim_products", "fact_daily_stock", ["product_id"], "dim_products", ["product_id"]),
]
# -----------------------------------------------------------------------------


def null_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: (column_name, null_count); one scan for all columns."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column_name", "null_count")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (``dup_count``)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count"))
              .where(F.col("dup_count") > 1))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows with a NULL key part, and rows beyond the first per key (one pass)."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).cast("bigint").alias("null_rows"),
        F.coalesce(F.sum(F.when(~any_null, F.col("_n") - 1)), F.lit(0)).cast("bigint").alias("dup_rows"))


def _key_text(keys: Sequence[str]) -> Column:
    """A key as text; NULL if any part is."""
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    parts = F.lit(True)
    for k in keys:
        parts = parts & F.col(k).isNotNull()
    return F.when(parts, F.to_json(F.struct(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)])))


def orphan_counts(child: DataFrame, rules: Sequence[tuple[str, Sequence[str], DataFrame, Sequence[str]]]) -> DataFrame:
    """``rule, violations`` for the foreign keys ``(rule, child keys, parent, parent keys)`` of one child.

    The child is read once: every row gives its non-NULL keys tagged by rule,
    counted on the map side, so the anti join only sees distinct keys however
    hot a key is. Keys are compared as text.
    """
    if any(len(ck) != len(pk) for _, ck, _, pk in rules):
        raise ValueError("foreign key and referenced key need the same number of columns")
    tagged = child.select(F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), _key_text(ck).alias("key")) for rule, ck, _, _ in rules])).alias("k"))
    keys = tagged.select("k.rule", "k.key").where(F.col("key").isNotNull()) \
        .groupBy("rule", "key").agg(F.count(F.lit(1)).alias("_n"))
    refs = [parent.select(F.lit(rule).alias("rule"), _key_text(pk).alias("key")) for rule, _, parent, pk in rules]
    known = refs[0]
    for r in refs[1:]:
        known = known.unionByName(r)
    missing = keys.join(known.distinct(), ["rule", "key"], "left_anti")
    # every rule has a row, at zero too
    none = child.sparkSession.createDataFrame([(rule, 0) for rule, *_ in rules], "rule string, _n bigint")
    return missing.select("rule", "_n").unionByName(none).groupBy("rule") \
        .agg(F.sum("_n").cast("bigint").alias("violations"))


def orphan_count(child: DataFrame, child_keys: Sequence[str], parent: DataFrame,
                 parent_keys: Sequence[str]) -> DataFrame:
    """One row (``violations``): child rows whose non-NULL key has no parent."""
    return orphan_counts(child, [("key", child_keys, parent, parent_keys)]).select("violations")


def orphan_report(child: DataFrame, child_name: str,
                  rules: Sequence[tuple[str, DataFrame, Sequence[tuple[str, str]]]]) -> DataFrame:
    """(child_table, parent_table, violations) for each foreign-key rule, in one pass over the child."""
    found = orphan_counts(child, [(name, [a for a, _ in pairs], parent, [b for _, b in pairs])
                                  for name, parent, pairs in rules])
    return found.select(F.lit(child_name).alias("child_table"), F.col("rule").alias("parent_table"), "violations")


def _key_columns(star: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    need: dict[str, set] = {}
    for _, table, cols in GOLD_PRIMARY_KEYS:
        need.setdefault(table, set()).update(cols)
    for _, table, cols, ref_table, ref_cols in GOLD_FOREIGN_KEYS:
        need.setdefault(table, set()).update(cols)
        need.setdefault(ref_table, set()).update(ref_cols)
    return {t: sorted(c) for t, c in need.items()}


def gold_key_report(star: Mapping[str, DataFrame], materialize: bool = False) -> DataFrame:
    """Key rules of the Gold star schema as one report.

    Columns: rule, table_name, key_columns, violations, status. A primary
    key's violations are NULL-key rows plus rows beyond the first per key; a
    foreign key's are rows whose non-NULL key has no match. Foreign keys are
    checked whether or not their primary key passed (as in the surveyed job).

    With ``materialize`` the key columns of each table are written once to the
    checkpoint folder first: a lazily defined table (e.g. a fact not yet
    loaded) is then computed once instead of once per rule that reads it.
    Tables read from the catalog need no such step.
    """
    if materialize:
        ensure_checkpoint_dir(next(iter(star.values())).sparkSession)
        star = {t: star[t].select(*cols).checkpoint(eager=True) for t, cols in _key_columns(star).items()}
    parts = []
    for rule, table, cols in GOLD_PRIMARY_KEYS:
        kv = key_violations(star[table], cols)
        parts.append(kv.select(F.lit(rule).alias("rule"),
                               (F.col("null_rows") + F.col("dup_rows")).cast("bigint").alias("violations")))
    for child in dict.fromkeys(table for _, table, *_ in GOLD_FOREIGN_KEYS):
        parts.append(orphan_counts(star[child], [
            (rule, cols, star[ref], ref_cols) for rule, table, cols, ref, ref_cols in GOLD_FOREIGN_KEYS if table == child]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return status_of(out.withColumnRenamed("violations", "v"))


def status_of(found: DataFrame) -> DataFrame:
    """The report's columns for every rule of the star, from ``rule, v`` (rules that are absent have no violation)."""
    about = [(r, t, ",".join(c)) for r, t, c, *_ in [*GOLD_PRIMARY_KEYS, *GOLD_FOREIGN_KEYS]]
    names = found.sparkSession.createDataFrame(about, "rule string, table_name string, key_columns string")
    out = names.join(found, "rule", "left").select(  # a row per rule on either side
        "rule", "table_name", "key_columns", F.coalesce("v", F.lit(0)).cast("bigint").alias("violations"))
    return out.withColumn("status", F.when(F.col("violations") == 0, F.lit("ok")).otherwise(F.lit("violated")))
