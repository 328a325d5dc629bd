"""Helpers shared by the operators: reading inputs, tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.session import ensure_checkpoint_dir

#: One word: a run of anything but space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"

#: The letters that the contracts fold, and nothing else.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark from whatever store ``sf_dir`` names."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, never a recomputation,
    and several consumers share one evaluation.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only (``lower`` would fold other alphabets too)."""
    return F.translate(col, UPPER, LOWER)


def shuffle_width(spark: SparkSession) -> int:
    """Number of partitions of an explicit shuffle: the session's setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


_shipped: set[str] = set()


def on_workers(df: DataFrame) -> DataFrame:
    """``df``, once Python workers can import this package (its sources are sent as a py-file)."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for p in sorted(package.rglob("*.py")):
                z.write(p, p.relative_to(package.parent))
        sc.addPyFile(str(target))
        _shipped.add(sc.applicationId)
    return df
