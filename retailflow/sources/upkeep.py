"""Loads that can be rerun, and mending of small files.

Both work on the data table behind a loaded name (see ``catalog``) with plain
Spark jobs; neither holds more than file names and sizes on the driver's side.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import catalog as cat

#: Size that files are packed to, partitions rewritten by one job, file names that are broadcast (about 200 bytes each).
FILE_BYTES, PARTITIONS_A_JOB, BROADCAST_FILES = 128 << 20, 500, 100_000
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


# ---------------------------------------------------------------- batches ---
def batch_log(name: str) -> str:
    """The table that lists the finished batches of ``name``."""
    return f"{name}__batches"


def append_batches(df: DataFrame, name: str, batch: str = "batch_id", partition_by: Sequence[str] = (),
                   spread_key: Sequence[str] | None = None, max_records_per_file: int | None = None,
                   **about) -> int:
    """Append the rows of the batches that ``name`` does not have yet; returns their number.

    ``df[batch]`` says to which batch a row belongs. The same batch again adds
    nothing. The table is partitioned by (batch, *partition_by), and a batch is
    listed in ``batch_log(name)`` when its rows are written: rows of a batch that is not listed
    are left from a run that broke off, and its partitions are dropped before
    it is written anew. A batch is whole or absent for readers who join the log;
    one writer at a time. Rows without a batch are refused.
    """
    spark = df.sparkSession
    log = batch_log(name)
    if cat.table_exists(spark, log):
        done = cat.read_columns(spark, log, [batch]).distinct()
        df = df.join(done, batch, "left_anti")
    else:
        done = None
    if cat.table_exists(spark, name):
        data = cat.current(spark, name)
        seen = spark.table(data).select(batch).distinct()
        # only broken runs leave such batches, so there are few
        for row in (seen if done is None else seen.join(done, batch, "left_anti")).collect():
            _drop_partitions(spark, data, {batch: row[0]})
    checked = df.withColumn(batch, F.when(F.col(batch).isNotNull(), F.col(batch)).otherwise(
        F.raise_error(F.lit(f"{name}: a row without {batch}")).cast(df.schema[batch].dataType)))
    rows = cat.save(checked, name, mode="append", partition_by=[batch, *partition_by], spread_key=spread_key,
                    max_records_per_file=max_records_per_file, **about)
    if rows:
        written = spark.table(cat.current(spark, name)).groupBy(batch).agg(F.count(F.lit(1)).alias("rows"))
        if done is not None:
            written = written.join(done, batch, "left_anti")
        cat.save(written, log, mode="append")
    return rows


def _drop_partitions(spark: SparkSession, data: str, values: dict) -> None:
    """Drop the partitions with these values, each by its full name (not every catalog takes a part of it)."""
    def spec(pairs) -> str:
        return "(" + ", ".join(f"{cat.quote_ident(c)} = " + ("NULL" if v is None else cat.quote_text(v)) for c, v in pairs) + ")"

    named = spec([(c, None if v is None else str(v)) for c, v in values.items()])
    found = [_partition_values(r[0].split("/")) for r in
             spark.sql(f"SHOW PARTITIONS {cat.quote_ident(data)} PARTITION {named}").collect()]
    if found:
        specs = ", ".join(f"PARTITION {spec(v.items())}" for v in found)
        spark.sql(f"ALTER TABLE {cat.quote_ident(data)} DROP IF EXISTS {specs}")


def _partition_values(names: Sequence[str]) -> dict[str, str | None]:
    """``column=value`` names of partitions to values; some characters are written as %XX."""
    pairs = (x.split("=", 1) for x in names)
    return {c: None if v == _NULL_PARTITION else unquote(v) for c, v in pairs}


# ------------------------------------------------------------------ files ---
def data_files(spark: SparkSession, name: str) -> DataFrame:
    """``path, folder, bytes`` of every data file (names and sizes are listed, no file is read)."""
    data = cat.current(spark, name)
    root = spark.sql(f"DESCRIBE TABLE EXTENDED {cat.quote_ident(data)}").where("col_name = 'Location'").first()["data_type"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return files.select(_plain_path(F.col("path")).alias("path"), F.col("length").alias("bytes")) \
        .withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1)).select("path", "folder", "bytes")


def _plain_path(path: Column) -> Column:
    """Spark writes ``file:/x`` in one place and ``file:///x`` in another."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+:)/+", "$1/")


def packed(files: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``path, folder, bin`` of the folders that packing leaves with fewer files.

    Files follow each other in bins of about ``file_bytes``; a bin is over that by less than its last file.
    """
    # names only: a folder's files, never its rows, are in one task
    w = Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("folder")
    placed = files.withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(w), F.lit(0)) / F.lit(file_bytes)))
    placed = placed.withColumns({"files": F.count(F.lit(1)).over(whole), "last": F.max("bin").over(whole)})
    return placed.where("files > last + 1").select("path", "folder", "bin")


def compact(spark: SparkSession, name: str, file_bytes: int = FILE_BYTES) -> dict[str, int]:
    """Pack the small files of a table: ``folders`` rewritten, files ``before`` and ``after`` in them.

    Of a partitioned table only the partitions that get fewer files are read and
    rewritten, some hundreds in a job; each keeps its old files until the new
    ones are written. A table without partitions gets a new data table.
    """
    data = cat.current(spark, name)
    parts = cat.partition_columns(spark, data)
    ensure_checkpoint_dir(spark)
    # the list stays as it is while the files that it names go
    bins = packed(data_files(spark, name), file_bytes).checkpoint(eager=True)
    sizes = bins.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.countDistinct("bin").alias("bins"))
    todo = sizes.orderBy("folder").collect()  # a row per partition to mend
    if not todo:
        return {"folders": 0, "before": 0, "after": 0}
    for at in range(0, len(todo), PARTITIONS_A_JOB):
        some = todo[at:at + PARTITIONS_A_JOB]
        rows = spark.table(data)
        for_folders = bins.where(F.col("folder").isin([r["folder"] for r in some]))
        if parts:
            rows = rows.where(_in_partitions(spark, data, parts, [r["folder"] for r in some]))
        tagged = rows.withColumn("_rf_path", _plain_path(F.col("_metadata.file_path")))
        names = for_folders.select(F.col("path").alias("_rf_path"), F.hash("folder", "bin").alias("_rf_bin"))
        if sum(r["files"] for r in some) <= BROADCAST_FILES:
            names = F.broadcast(names)
        width = sum(r["bins"] for r in some)
        dealt = tagged.join(names, "_rf_path", "left").repartition(width, "_rf_bin").drop("_rf_path", "_rf_bin")
        if parts:
            cat._replace_partitions(dealt.select(*spark.table(data).columns), data)
        else:
            cat._publish(spark, name, cat._new_data(dealt, name))
    left = data_files(spark, name).where(F.col("folder").isin([r["folder"] for r in todo])).count() if parts \
        else data_files(spark, name).count()
    return {"folders": len(todo), "before": sum(r["files"] for r in todo), "after": left}


def _in_partitions(spark: SparkSession, data: str, parts: Sequence[str], folders: Sequence[str]) -> Column:
    """A filter on the partition columns, so that the scan reads these partitions only."""
    types = {f.name: f.dataType for f in spark.table(data).schema.fields}
    one_of = F.lit(False)
    for folder in folders:
        this = F.lit(True)
        for p, v in _partition_values(folder.split("/")[-len(parts):]).items():
            this = this & (F.col(p).isNull() if v is None else F.col(p) == F.lit(v).cast(types[p]))
        one_of = one_of | this
    return one_of
