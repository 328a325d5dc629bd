"""Token counts: a map-side two-tier lookup, without any shuffle of pre-tokens.

A text is cut at ASCII blanks. The vocabulary drops white space before its
merges and its special strings hold none, so the count of a text is the sum
over its blank-separated pre-tokens, each counted by the tokenizer itself.

Tier 1 is a broadcast hash table from frequent pre-token to length, learnt
from a bounded sample of rows (it only saves work: results do not depend on
it). Tier 2 is a cache in each Python worker; what is in neither is encoded in
one batch per document. The cache has a fixed number of entries and starts
anew when it is full. Texts never leave their map task.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import on_workers

#: Entries of the broadcast table, rows sampled to fill it, entries of a worker's cache.
FREQUENT, SAMPLE_ROWS, CACHE = 32_768, 2_000, 400_000

_worker: dict[str, object] = {}


def _encoder(vocabulary: str):
    """The worker's tokenizer, built once for each vocabulary."""
    if _worker.get("vocabulary") != vocabulary:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(vocabulary)
        t.no_truncation()
        t.no_padding()
        _worker.update(vocabulary=vocabulary, tokenizer=t, cache={})
    return _worker["tokenizer"], _worker["cache"]


def _lengths(tokenizer, pre_tokens: list[bytes]) -> Iterator[tuple[bytes, int]]:
    found = tokenizer.encode_batch([w.decode() for w in pre_tokens], add_special_tokens=False)
    return zip(pre_tokens, map(len, found), strict=True)


def _bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 values, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def frequent_lengths(docs: DataFrame, vocabulary: str, text_col: str = "text",
                     size: int = FREQUENT, sample_rows: int = SAMPLE_ROWS) -> dict[bytes, int]:
    """Lengths of the ``size`` most frequent pre-tokens of about ``sample_rows`` sampled rows.

    The sample's rows, a fixed number, are counted in one task; at most
    ``size`` entries reach the driver, whatever the input's size.
    """

    def count(batches):
        seen: Counter = Counter()
        for b in batches:
            for text in _bytes(b.column(0)):
                seen.update(text.split())
        words = [w for w, _ in seen.most_common(size) if len(w) <= 64]
        pairs = list(_lengths(_encoder(vocabulary)[0], words))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in pairs], pa.binary()), pa.array([n for _, n in pairs], pa.int32())], ["w", "n"])

    n = docs.count()
    sample = docs.select(text_col).sample(min(1.0, sample_rows / n), seed=1) if n > sample_rows else docs.select(text_col)
    rows = on_workers(sample).repartition(1).mapInArrow(count, "w binary, n int").collect()
    return {bytes(r.w): r.n for r in rows}


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048, cache: int = CACHE) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit``.

    Counts are those of ``encode(text, add_special_tokens=False)`` without
    truncation or padding; special strings inside texts count as the
    tokenizer treats them by default. A null text counts as empty (0 bytes,
    0 tokens, not over the limit); a null id stays null; repeated rows give
    repeated rows; an empty table gives an empty result. Other columns of
    ``docs`` are ignored. ``tokenizer_path`` is read on the driver; the
    vocabulary (a fixed file of about 2 MB) and the frequent table (at most
    ``FREQUENT`` entries) are the only things broadcast.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = f.read()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = spark.sparkContext.broadcast((vocabulary, frequent_lengths(src, vocabulary)))

    def count(batches):
        vocabulary, frequent = shared.value
        tokenizer, seen = _encoder(vocabulary)
        if not seen:
            seen.update(frequent)
        for b in batches:
            texts, n_bytes, n_tokens = _bytes(b.column(1)), [], []
            for text in texts:
                words = text.split()
                missing = set(words).difference(seen)
                if missing:
                    if len(seen) + len(missing) > cache + len(frequent):
                        seen.clear()
                        seen.update(frequent)
                        missing = set(words).difference(seen)
                    seen.update(_lengths(tokenizer, list(missing)))
                n_bytes.append(len(text))
                n_tokens.append(sum(map(seen.__getitem__, words)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    id_type = src.schema["doc_id"].dataType.simpleString()
    out = on_workers(src).mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
