"""Secret scans with an incremental blob ledger (DataFrame functions only).

Every historical version of a file is addressed by the SHA-256 of its
content. A ledger in the shared folder records which (blob, rule version)
pairs have been scanned and what was found. A run scans only the pairs that
the ledger does not have, adds them, and joins the findings back to every path
and version that holds the blob, so a copied or unchanged file costs a hash.

Contents meet once: copies of a blob are combined on the map side before
anything is shuffled. Spans are found by splitting a text at a rule's matches
and adding up lengths, which stays in the JVM.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from retailflow.llm.common import shared_path, stored

#: Unseen blobs up to this number (64 hex digits each) are broadcast to filter contents where they lie.
BROADCAST_BLOBS = 50_000
#: Findings up to this number of spans (about 60 bytes each) are broadcast to redact texts where they lie.
BROADCAST_SPANS = 100_000

#: The rules as (kind, pattern, least length, group that it holds for), in order.
ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
RULES = (
    ("assign", ASSIGN, 6, 2),
    ("access", r"AKIA[A-Z0-9]+", 20, 0),
    ("hex", r"[0-9a-f]+", 24, 0),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 1, 0),
)
BASE_KINDS = ("assign", "access", "hex")

# What goes with a pem header when a text is redacted: all up to the END that follows (no other block between), else,
# without one, its header and base64 lines; possessive and atomic groups, as Java's others go deeper with every line.
_BREAK, _BASE64 = r"(?:\s|\\[nr])", "[A-Za-z0-9+/=]"
PEM_BLOCK = (r"^-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?>(?s:.*?)-----(?=BEGIN |END ))END [A-Z ]*PRIVATE KEY-----|"
             rf"(?:{_BREAK}++[A-Za-z-]+:\x20[^\r\n\\]*+)*+(?:{_BREAK}++{_BASE64}{{16,}}+)*+"
             r"(?:(?:[\x20\t]|\\r)*+(?:\r?\n|\r|\\n)[\x20\t]*+" rf"{_BASE64}++(?=[\x20\t]*+(?:[\r\n\\]|\z)))?+)")
#: Changes whenever RULES change: the ledger keeps results per version.
RULES_VERSION = "2"

_BLOBS = "blob string, rules string"
_FINDINGS = "blob string, rules string, kind string, start long, stop long"


def blob_id(content: Column) -> Column:
    """SHA-256 of the content's UTF-8 bytes (null: empty)."""
    return F.sha2(F.coalesce(content, F.lit("")), 256)


def _scan_pattern(pattern: str, least: int, group: int) -> str:
    """Where the length is that of one greedy class at the end of the match, short
    runs of that class cannot hide another match, so the bound goes into the pattern."""
    if pattern == r"[0-9a-f]+":
        return rf"[0-9a-f]{{{least},}}"
    if pattern == r"AKIA[A-Z0-9]+":
        return rf"AKIA[A-Z0-9]{{{least - 4},}}"
    return pattern


def find_spans(blobs: DataFrame) -> DataFrame:
    """``blob, kind, start, stop`` (code points, stop exclusive) for ``blob, content`` rows.

    Matches are leftmost and do not overlap within a kind; matches that are
    too short are dropped after matching. Empty contents have no spans.
    """
    found = None
    for kind, pattern, least, group in RULES:
        scan = _scan_pattern(pattern, least, group)
        matches = F.regexp_extract_all("content", F.lit(scan), F.lit(0))
        rows = blobs.select("blob", "content", matches.alias("m")).where(F.size("m") > 0)
        # lengths of the pieces between matches give each match its place
        lengths = F.transform(F.slice(F.split("content", scan, -1), F.lit(1), F.size("m")), lambda p: F.length(p))
        rows = rows.select("blob", F.posexplode(F.arrays_zip(lengths.alias("gap"), F.col("m").alias("hit"))))
        order = Window.partitionBy("blob").orderBy("pos")
        stop = F.sum(F.col("col.gap") + F.length("col.hit")).over(order.rowsBetween(Window.unboundedPreceding, 0))
        spans = rows.select("blob", F.col("col.hit").alias("hit"), stop.alias("stop"))
        held = F.length(F.regexp_extract("hit", pattern, group) if group else F.col("hit"))
        spans = spans.where(held >= least).select(
            "blob", F.lit(kind).alias("kind"), (F.col("stop") - F.length("hit")).cast("long").alias("start"),
            F.col("stop").cast("long").alias("stop"))
        found = spans if found is None else found.unionAll(spans)
    return found


def _ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A ledger table (empty before the first run)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def update_ledger(addressed: DataFrame, versions: DataFrame, ledger: str) -> DataFrame:
    """Scan what ``ledger`` lacks; return ``blob, kind, start, stop`` of all blobs of ``addressed``.

    ``versions`` has ``blob, content``. Findings are written before the blobs
    that vouch for them: a run that dies in between only scans again, and
    repeated findings are read once.
    """
    spark = addressed.sparkSession
    seen = _ledger(spark, f"{ledger}/blobs", _BLOBS).where(F.col("rules") == RULES_VERSION)
    wanted = addressed.select("blob").distinct()
    unseen = stored(wanted.join(seen.select("blob"), "blob", "left_anti"), "ledger-unseen")
    n = unseen.count()
    if n:
        if n <= BROADCAST_BLOBS:
            contents = versions.join(F.broadcast(unseen), "blob", "left_semi").groupBy("blob") \
                .agg(F.first("content").alias("content"))
        else:
            contents = versions.groupBy("blob").agg(F.first("content").alias("content")) \
                .join(unseen, "blob", "left_semi")
        spans = find_spans(stored(contents.where(F.length("content") > 0), "ledger-contents"))
        spans.select("blob", F.lit(RULES_VERSION).alias("rules"), "kind", "start", "stop") \
            .write.mode("append").parquet(f"{ledger}/findings")
        unseen.select("blob", F.lit(RULES_VERSION).alias("rules")).write.mode("append").parquet(f"{ledger}/blobs")
    findings = _ledger(spark, f"{ledger}/findings", _FINDINGS).where(F.col("rules") == RULES_VERSION)
    return findings.select("blob", "kind", "start", "stop").distinct().join(wanted, "blob", "left_semi")


def scan_secrets(versions: DataFrame, keys: list[str], content_col: str = "text", ledger: str | None = None) -> DataFrame:
    """One row per input row: ``keys``, counts ``n_assign, n_access, n_hex``, ``spans`` (array).

    ``keys`` name a version of a file (path, commit, …). ``spans`` holds
    ``start, rank, kind, stop`` by start and then rule order, of all rules.
    ``ledger`` is a path on shared storage; without one a fresh ledger in the
    shared folder is used. Null contents count as empty, null keys are kept,
    repeated rows give repeated rows, an empty table gives an empty result, and
    columns that are not named are ignored.
    """
    content = F.coalesce(F.col(content_col).cast("string"), F.lit(""))
    names = [f"key{i}" for i in range(len(keys))]
    paths = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
    addressed = stored(versions.select(*paths, blob_id(content).alias("blob")), "ledger-paths")
    lists = _span_lists(addressed, versions, content, ledger)
    out = addressed.join(lists, "blob", "left").withColumn("spans", F.coalesce("spans", _no_spans()))
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)],
                      *[_count(k).alias(f"n_{k}") for k in BASE_KINDS], "spans")


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:bigint,rank:int,kind:string,stop:bigint>>")


def _span_lists(addressed: DataFrame, versions: DataFrame, content: Column, ledger: str | None) -> DataFrame:
    """``blob, spans`` of the blobs with findings, after the ledger has been brought up to date."""
    ledger = ledger or shared_path(addressed.sparkSession, "secret-ledger")
    findings = update_ledger(addressed, versions.select(blob_id(content).alias("blob"), content.alias("content")), ledger)
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, (k, *_) in enumerate(RULES)])
    span = F.struct(F.col("start"), rank.alias("rank"), F.col("kind"), F.col("stop"))
    return findings.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = None,
                   ledger: str | None = None) -> DataFrame:
    """``docs``, all rows and columns, with every secret in ``text_col`` replaced by a mark.

    ``length_col``, if given, is set to the new length of texts that change. Texts
    stay where they are when the findings are few (at most ``BROADCAST_SPANS``
    spans, counted first); else they meet them by blob. Null and empty texts stay as
    they are; repeated rows change alike; an empty table gives an empty result.
    """
    content = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    addressed = stored(docs.select(blob_id(content).alias("blob")), "ledger-paths")
    lists = stored(_span_lists(addressed, docs, content, ledger), "ledger-spans")
    n = lists.agg(F.sum(F.size("spans"))).first()[0] or 0
    rows = docs.select(F.struct("*").alias("doc"), blob_id(content).alias("blob"))
    joined = rows.join(F.broadcast(lists) if n <= BROADCAST_SPANS else lists, "blob", "left")
    text = redact(F.col(f"doc.{text_col}"), F.col("spans"))
    found = F.col("doc").withField(text_col, text)
    if length_col:
        found = found.withField(length_col, F.length(text).cast(docs.schema[length_col].dataType))
    return joined.select(F.when(F.col("spans").isNull(), F.col("doc")).otherwise(found).alias("doc")).select("doc.*")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == F.lit(kind))).cast("long")


def span_text(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:stop`` of a row's spans, joined by commas."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span (overlapping ones merged) replaced by a mark, private keys with their bodies."""
    def whole(s):
        block = F.length(F.regexp_extract(F.substring(text, (s["start"] + 1).cast("int"), F.lit(2147483647)), PEM_BLOCK, 0))
        return s.withField("stop", F.when(s["kind"] == "pem", F.greatest(s["stop"], s["start"] + block)).otherwise(s["stop"]))

    spans = F.transform(spans, whole)
    state = T.StructType([T.StructField("at", T.LongType()), T.StructField("out", T.StringType())])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        kept = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.when((s["start"] >= acc["at"]) & ((s["start"] > 0) | (acc["out"] == "")),
                     F.concat(acc["out"], kept, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), out.alias("out")).cast(state)

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, start.cast(state), step,
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2147483647)))))
