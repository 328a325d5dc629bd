"""A corpus pipeline: five of the training-data operators in a row over ``documents``.

Each stage takes all documents that the one before kept, and its result is
written as Parquet in the shared folder and read again. All stages but the last
return the columns of ``documents``; the last says how many words the mix takes
of each document.

1. toxicity: documents that score 0.3 or more go.
2. near duplicates: of each SimHash component (4-word shingles, 4 bits) the
   document with the smallest id stays.
3. decontamination: documents that contain 0.8 or more of a benchmark item's
   5-word shingles go.
4. secrets: found spans are replaced by a mark; ``n_chars`` follows. All rows stay.
5. mixing: sources mixed to weights 1, 2, 3 in turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retailflow.llm import decontamination, mixing, secret_scan, simhash, toxicity
from retailflow.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scoring 0.3 or more go; null and empty texts score as texts without words; no rows give no rows."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays, of repeated rows one; null and blank texts are one component; no rows give no rows."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain a benchmark item go; null and blank texts stay; an empty benchmark drops nothing."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows stay; found spans become a mark; null and empty texts stay as they are."""
    return secret_scan.redact_secrets(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per row: size and words taken; null texts have size 0, a null source is a source of its own."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: A trained model and 64-bit fingerprints are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; an empty table gives an empty result."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
