"""Catalog side of the pipeline: layers, table loads, comments and keys.

Everything here is plain Spark SQL DDL and DataFrameWriter calls against the
session catalog (Parquet tables). Only this module touches the catalog.

Load semantics
--------------
A loaded name is a view over one *data table* (``name__<version>``, see
``current``). A whole-table load writes a new data table and then points the view
to it: one catalog change, so a failed write leaves the old rows, schema, comments
and properties, and a reader always finds a whole table. The data table before
the last change is kept for readers that still use it; older ones are dropped.

* first load (name absent): the first data table, with the chosen mode;
* ``overwrite`` reload: a new data table; comments and properties that the load
  does not give are carried over (with ``replace_partitions`` only the partitions
  present in the new data are replaced, in the data table, when all are written);
* ``append``: blind append to the data table. Rerunning the same load duplicates rows;
  ``append_batches`` is the form that can be rerun;
* column comments are those of the view (partition columns included).

A plain table made by others is taken over by the first whole-table load.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MODES = ("overwrite", "append")


def quote_ident(name: str) -> str:
    """Back-quote each part of a (possibly qualified) identifier."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))


def quote_text(text: str) -> str:
    """SQL string literal: stripped, single quotes doubled, backslashes escaped."""
    return "'" + text.strip().replace("\\", "\\\\").replace("'", "''") + "'"


def qualified(layer: str, table: str) -> str:
    return f"{layer}.{table}"


def ensure_layers(spark: SparkSession, names: Sequence[str]) -> None:
    """Idempotent namespace creation (one database per layer)."""
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_ident(n)}")


def table_exists(spark: SparkSession, name: str) -> bool:
    """``layer.table`` names only; an unknown layer simply yields False."""
    parts = name.split(".")
    if len(parts) == 2 and not spark.catalog.databaseExists(parts[0]):
        return False
    return spark.catalog.tableExists(name)


def read_columns(spark: SparkSession, name: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Catalog scan with an explicit projection (the projection reaches the
    Parquet reader's ReadSchema)."""
    df = spark.table(name)
    return df.select(*cols) if cols else df


#: Properties of the view: its data table, and the one before.
DATA, BEFORE = "data_table", "data_table_before"


def current(spark: SparkSession, name: str) -> str:
    """The data table behind a loaded name (the name itself if it is a plain table)."""
    if spark.catalog.getTable(name).tableType != "VIEW":
        return name
    return table_properties(spark, name).get(DATA, name)


def _show(spark: SparkSession, name: str, comments: Mapping[str, str | None], comment: str | None,
          properties: Mapping[str, str]) -> None:
    """Make ``name`` the view of its data table, with these comments and properties (one catalog change)."""
    columns = ", ".join(quote_ident(f) + (f" COMMENT {quote_text(comments[f])}" if comments.get(f) else "")
                        for f in spark.table(properties[DATA]).columns)
    about = f"COMMENT {quote_text(comment)} " if comment else ""
    props = ", ".join(f"{quote_text(k)} = {quote_text(v)}" for k, v in sorted(properties.items()))
    spark.sql(f"CREATE OR REPLACE VIEW {quote_ident(name)} ({columns}) {about}TBLPROPERTIES ({props}) "
              f"AS SELECT * FROM {quote_ident(properties[DATA])}")


def _publish(spark: SparkSession, name: str, data: str, comments: Mapping[str, str] | None = None,
             comment: str | None = None, carry: bool = True) -> None:
    """Point ``name`` to the data table ``data``; with ``carry`` comments and properties stay where none are given."""
    texts, props, old = {}, {}, None
    plain = False
    if table_exists(spark, name):
        old, plain = current(spark, name), spark.catalog.getTable(name).tableType != "VIEW"
        if carry:
            texts, props = read_column_comments(spark, name), table_properties(spark, name)
            comment = comment if comment is not None else table_comment(spark, name)
        older = table_properties(spark, name).get(BEFORE)
        if plain:
            # a table of the same name stands in the way of the view
            old = f"{name}__{uuid.uuid4().hex[:12]}"
            spark.sql(f"ALTER TABLE {quote_ident(name)} RENAME TO {quote_ident(old)}")
    try:
        _show(spark, name, texts | {c: t for c, t in (comments or {}).items()}, comment,
              props | {DATA: data} | ({BEFORE: old} if old else {}))
    except Exception:
        if plain:
            spark.sql(f"ALTER TABLE {quote_ident(old)} RENAME TO {quote_ident(name)}")
        spark.sql(f"DROP TABLE IF EXISTS {quote_ident(data)}")
        raise
    if old and older and older != old:
        spark.sql(f"DROP TABLE IF EXISTS {quote_ident(older)}")


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """The partition columns of a table."""
    return [c.name for c in spark.catalog.listColumns(current(spark, name)) if c.isPartition]


def _new_data(df: DataFrame, name: str, partition_by: Sequence[str] | None = None,
              max_records_per_file: int | None = None, fmt: str = "parquet") -> str:
    """Write ``df`` to a new data table of ``name``; nothing is left of a failed write."""
    data = f"{name}__{uuid.uuid4().hex[:12]}"
    # the table's own option: an overwrite replaces the partitions that it writes, whatever the session says
    w = df.write.format(fmt).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    try:
        w.saveAsTable(data)
    except Exception:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {quote_ident(data)}")
        raise
    return data


def drop(spark: SparkSession, name: str) -> None:
    """Drop a loaded name with its data tables (or a plain table); an absent name is no error."""
    if not table_exists(spark, name):
        return
    if spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {quote_ident(name)}")
        return
    props = table_properties(spark, name)
    spark.sql(f"DROP VIEW {quote_ident(name)}")
    for data in (props.get(DATA), props.get(BEFORE)):
        if data:
            spark.sql(f"DROP TABLE IF EXISTS {quote_ident(data)}")


def create_or_replace(df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                      column_comments: Mapping[str, str] | None = None, table_comment: str | None = None,
                      max_records_per_file: int | None = None) -> int:
    """Replace a table's data, schema, comments and properties in one catalog change; returns the rows written.

    A failed write leaves the old table as it is, and readers find the old or
    the new table at any time. ``df`` may read the table that it replaces.
    """
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    data = _new_data(df.observe(obs, F.count(F.lit(1)).alias("rows")), name, partition_by, max_records_per_file, fmt)
    _publish(df.sparkSession, name, data, column_comments, table_comment, carry=False)
    return int(obs.get.get("rows", 0))


def _fit_columns(df: DataFrame, name: str, merge_schema: bool) -> DataFrame:
    """``df`` in the column order of an existing table.

    Columns that the table lacks are an error, or with ``merge_schema`` are
    added to the table (old rows read NULL); with it, columns that ``df``
    lacks are written as NULL.
    """
    spark = df.sparkSession
    have = spark.table(name).schema
    new = [f for f in df.schema.fields if f.name not in have.names]
    lost = [f for f in have.fields if f.name not in df.columns]
    if (new or lost) and not merge_schema:
        raise ValueError(f"{name}: columns differ (new {[f.name for f in new]}, missing {[f.name for f in lost]}); "
                         "pass merge_schema=True to keep them")
    if new:
        cols = ", ".join(f"{quote_ident(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {quote_ident(name)} ADD COLUMNS ({cols})")
    for f in lost:
        df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.select(*spark.table(name).columns)


def _layout(df: DataFrame, partition_by: Sequence[str], spread_key: Sequence[str] | None,
            num_partitions: int | None) -> DataFrame:
    """Range-partition on (partition columns, spread key) before a partitioned
    write: each task then holds a few whole days, and a day with a third of
    the rows still spans several tasks, so files stay bounded in number and
    size (tasks x days small files without it). Without a spread key the rows are
    dealt by the partition columns and AQE splits a large value and packs small ones:
    no sampling pass, which would compute the rows once more, and no value is one task's work."""
    if not spread_key and not num_partitions:
        return df.hint("rebalance", *partition_by)
    keys = [F.col(c) for c in partition_by] + [F.col(c) for c in (spread_key or [])]
    # without an explicit count AQE sizes the write tasks from the real data
    return df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)


def save(df: DataFrame, name: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None,
         column_comments: Mapping[str, str] | None = None, table_comment: str | None = None,
         replace_partitions: bool = False, max_records_per_file: int | None = None,
         spread_key: Sequence[str] | None = None, num_partitions: int | None = None,
         fmt: str = "parquet", merge_schema: bool = False) -> int:
    """Write ``df`` to table ``name`` and return the number of rows written.

    Whole-table loads are staged (see the module text): a write that fails
    changes nothing. A load into a table that is kept (append, partition
    replace) needs the table's columns; ``merge_schema`` adds new ones instead of
    refusing them. A partition replace moves its files in when all are written.

    The row count is observed during the write (one pass), instead of a
    separate ``count()`` job that would recompute the whole plan.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark = df.sparkSession
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    exists = table_exists(spark, name)
    kept = exists and (mode == "append" or bool(replace_partitions and partition_by))
    data = current(spark, name) if kept else None
    if kept:
        df = _fit_columns(df, data, merge_schema)
    out = _layout(df, partition_by, spread_key, num_partitions) if partition_by else df
    # observed above the range exchange: its sampling pass must not count rows
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    if not kept:
        _publish(spark, name, _new_data(out, name, partition_by, max_records_per_file, fmt), column_comments, table_comment)
    elif mode == "append":
        w = out.write.format(fmt).mode("append")
        parts = list(partition_by or partition_columns(spark, data))
        if parts:
            w = w.partitionBy(*parts)
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", int(max_records_per_file))
        w.saveAsTable(data)
    else:
        _replace_partitions(out, data)
    if kept:
        if list(spark.table(name).columns) != list(spark.table(data).columns):
            _publish_again(spark, name)
        if column_comments:
            known = read_column_comments(spark, name)
            comment_columns(spark, name, {c: t for c, t in column_comments.items() if c in known and known[c] != t.strip()})
        if table_comment is not None:
            comment_table(spark, name, table_comment)
    return int(obs.get.get("rows", 0))


def _replace_partitions(df: DataFrame, data: str) -> None:
    """Overwrite the partitions of a data table that ``df`` has rows of."""
    spark = df.sparkSession
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_ident(data)}").where("col_name = 'Storage Properties'").first()
    if described is None or "partitionOverwriteMode=dynamic" not in described["data_type"]:
        # a plain table of others gets the option of our own data tables
        spark.sql(f"ALTER TABLE {quote_ident(data)} SET SERDEPROPERTIES ('partitionOverwriteMode' = 'dynamic')")
    df.write.insertInto(data, overwrite=True)


def _publish_again(spark: SparkSession, name: str) -> None:
    """The view once more, after its data table got new columns."""
    if spark.catalog.getTable(name).tableType == "VIEW":
        _show(spark, name, read_column_comments(spark, name), table_comment(spark, name), table_properties(spark, name))


def comment_columns(spark: SparkSession, name: str, comments: Mapping[str, str]) -> None:
    """Column comments (text stripped and quoted), of a loaded name in one catalog change.

    On a plain table one ``ALTER COLUMN ... COMMENT`` per column; its partition
    columns are skipped, as the catalog rejects comments on them.
    """
    if not comments:
        return
    if spark.catalog.getTable(name).tableType == "VIEW":
        _show(spark, name, read_column_comments(spark, name) | dict(comments), table_comment(spark, name),
              table_properties(spark, name))
        return
    partition_cols = {c.name for c in spark.catalog.listColumns(name) if c.isPartition}
    for col_name, text in comments.items():
        if col_name in partition_cols:
            continue
        spark.sql(f"ALTER TABLE {quote_ident(name)} ALTER COLUMN {quote_ident(col_name)} "
                  f"COMMENT {quote_text(text)}")


def comment_table(spark: SparkSession, name: str, text) -> None:
    """Table comment through the ``comment`` property; non-text is ignored."""
    if not isinstance(text, str):
        return
    _set_property(spark, name, "comment", text)


def _set_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
    spark.sql(f"ALTER {kind} {quote_ident(name)} SET TBLPROPERTIES ({quote_text(key)} = {quote_text(value)})")


def read_column_comments(spark: SparkSession, name: str) -> dict[str, str | None]:
    return {c.name: c.description for c in spark.catalog.listColumns(name)}


def table_comment(spark: SparkSession, name: str) -> str | None:
    return spark.catalog.getTable(name).description


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quote_ident(name)}").collect()
    return {r["key"]: r["value"] for r in rows}


# ----------------------------------------------------------------- keys ---
_PROP = "constraint."


def _as_list(cols) -> list[str]:
    if isinstance(cols, str):
        return [cols]
    if isinstance(cols, (list, tuple)) and all(isinstance(c, str) for c in cols):
        return list(cols)
    raise TypeError("key columns must be a string or a list of strings")


def key_exists(spark: SparkSession, name: str, constraint: str) -> bool:
    """Whether ``constraint`` is already declared on table ``name``."""
    return f"{_PROP}{constraint}" in table_properties(spark, name)


def set_not_null(spark: SparkSession, name: str, column: str) -> bool:
    """Declare ``column`` NOT NULL after checking it holds no NULL.

    Returns False when NULLs exist. Parquet tables and views reject ``SET NOT
    NULL``, so the declaration is then kept as a property instead.
    """
    nulls = spark.table(name).agg(F.count_if(F.col(column).isNull()).alias("n")).first()["n"]
    if nulls > 0:
        return False
    if spark.catalog.getTable(name).tableType != "VIEW":
        try:
            spark.sql(f"ALTER TABLE {quote_ident(name)} ALTER COLUMN {quote_ident(column)} SET NOT NULL")
            return True
        except AnalysisException as e:
            # only the refusal of the table format; any other failure is the caller's to see
            if not re.search("UNSUPPORTED|NOT_SUPPORTED", e.getCondition() or ""):
                raise
    _set_property(spark, name, f"{_PROP}not_null.{column}", "true")
    return True


def declare_key(spark: SparkSession, name: str, constraint: str, cols,
                ref_table: str | None = None, ref_cols=None) -> str:
    """Declare a primary key (``ref_table`` None) or a foreign key.

    Simple or composite keys, given as a string or a list; key lists of
    different length are rejected. Idempotent: an existing declaration is
    left alone. Returns ``"declared"``, ``"exists"`` or ``"invalid"``.
    Keys are informational (not enforced); the DQ jobs check the data.
    """
    try:
        cols = _as_list(cols)
        ref = _as_list(ref_cols if ref_cols is not None else cols) if ref_table else None
    except TypeError:
        return "invalid"
    if ref is not None and len(ref) != len(cols):
        return "invalid"
    if key_exists(spark, name, constraint):
        return "exists"
    spec = {"type": "foreign_key" if ref_table else "primary_key", "columns": cols}
    if ref_table:
        spec.update({"ref_table": ref_table, "ref_columns": ref})
    _set_property(spark, name, f"{_PROP}{constraint}", json.dumps(spec))
    return "declared"


def declared_keys(spark: SparkSession, name: str) -> dict[str, dict]:
    out = {}
    for k, v in table_properties(spark, name).items():
        if k.startswith(_PROP) and not k.startswith(_PROP + "not_null."):
            out[k[len(_PROP):]] = json.loads(v)
    return out
