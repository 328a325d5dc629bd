"""Loads that fail, are rerun, are read meanwhile, and leave small files."""

import threading

import pytest
from pyspark.sql import functions as F

from retailflow.sources import catalog as cat
from retailflow.sources import upkeep


def days(spark, n, day="2025-01-01", **extra):
    df = spark.range(n).select(F.col("id").alias("k"), F.lit(day).cast("date").alias("d"))
    return df.withColumns({c: F.lit(v) for c, v in extra.items()})


def raising(df):
    return df.withColumn("k", F.when(F.col("k") < 2, F.col("k")).otherwise(F.raise_error(F.lit("boom")).cast("long")))


@pytest.mark.parametrize("how", ["plain", "partitioned", "partitions", "append"])
def test_a_failed_load_changes_nothing(spark, db, how):
    name = f"{db}.t"
    load = {} if how == "plain" else {"partition_by": ["d"]}
    cat.save(days(spark, 5), name, column_comments={"k": "it's a key"}, table_comment="rows", **load)
    assert cat.declare_key(spark, name, "pk", "k") == "declared" and cat.set_not_null(spark, name, "k")
    before = cat.table_properties(spark, name)
    more = {"mode": "append"} if how == "append" else {"replace_partitions": how == "partitions"}
    with pytest.raises(Exception, match="boom"):
        cat.save(raising(days(spark, 9)), name, column_comments={"k": "other"}, table_comment="other", **load, **more)
    assert spark.table(name).count() == 5
    assert cat.table_properties(spark, name) == before and cat.table_comment(spark, name) == "rows"
    assert cat.read_column_comments(spark, name)["k"] == "it's a key"
    # and nothing is left beside it
    assert [t.name for t in spark.catalog.listTables(db) if t.tableType != "VIEW"] == [cat.current(spark, name).split(".")[1]]


def test_a_reload_carries_comments_and_keys(spark, db):
    name = f"{db}.t"
    cat.save(days(spark, 5, v="a"), name, column_comments={"k": "key", "v": "value"}, table_comment="rows")
    cat.declare_key(spark, name, "pk", "k")
    assert cat.save(days(spark, 2), name, column_comments={"d": "day"}) == 2
    assert cat.read_column_comments(spark, name) == {"k": "key", "d": "day"}
    assert cat.table_comment(spark, name) == "rows" and cat.key_exists(spark, name, "pk")
    assert cat.create_or_replace(days(spark, 3), name) == 3
    assert cat.table_comment(spark, name) is None and not cat.key_exists(spark, name, "pk")
    cat.drop(spark, name)
    cat.drop(spark, name)
    assert spark.catalog.listTables(db) == []


def test_a_load_may_read_its_own_table(spark, db):
    name = f"{db}.t"
    cat.save(days(spark, 5), name)
    cat.save(spark.table(name).unionAll(spark.table(name)), name)
    cat.create_or_replace(spark.table(name).select("k").distinct(), name)
    assert spark.table(name).count() == 5


def test_plain_tables_are_taken_over(spark, db):
    name = f"{db}.t"
    days(spark, 4).write.partitionBy("d").saveAsTable(name)
    cat.comment_columns(spark, name, {"k": "key", "d": "skipped"})
    cat.save(days(spark, 2, "2025-01-02"), name, partition_by=["d"], replace_partitions=True)
    assert spark.table(name).count() == 6 and cat.current(spark, name) == name
    with pytest.raises(Exception, match="boom"):
        cat.save(raising(days(spark, 9)), name)
    assert spark.table(name).count() == 6
    cat.save(days(spark, 1), name)
    assert spark.table(name).count() == 1 and cat.current(spark, name) != name
    assert cat.read_column_comments(spark, name)["k"] == "key"


def test_partition_replace_does_not_touch_the_session(spark, db):
    name, conf = f"{db}.t", "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "static")
    try:
        cat.save(days(spark, 4).unionAll(days(spark, 3, "2025-01-02")), name, partition_by=["d"])
        cat.save(days(spark, 1), name, partition_by=["d"], replace_partitions=True)
        assert spark.conf.get(conf) == "static"
    finally:
        spark.conf.set(conf, old)
    assert spark.table(name).count() == 4


def test_readers_always_find_a_whole_table(spark, db):
    name, seen, over = f"{db}.t", [], threading.Event()
    cat.create_or_replace(days(spark, 10), name)

    def poll():
        reader = spark.newSession()
        while not over.is_set():
            try:
                seen.append(reader.table(name).count())
            except Exception as e:  # noqa: BLE001 - whatever a reader meets is a failure of the test
                seen.append(str(e)[:200])

    t = threading.Thread(target=poll)
    t.start()
    try:
        for n in (20, 30, 40):
            cat.create_or_replace(days(spark, n, **({"v": 1} if n == 30 else {})), name)
    finally:
        over.set()
        t.join()
    assert set(seen) <= {10, 20, 30, 40} and seen
    # the data table before the last change is kept, no older one
    assert len([x for x in spark.catalog.listTables(db) if x.tableType != "VIEW"]) == 2


def batch(spark, n, b, day="2025-01-01"):
    return days(spark, n, day).withColumn("batch_id", F.lit(b))


def test_batches_are_appended_once(spark, db):
    name = f"{db}.t"
    assert upkeep.append_batches(batch(spark, 3, "a"), name, partition_by=["d"]) == 3
    assert upkeep.append_batches(batch(spark, 3, "a"), name, partition_by=["d"]) == 0
    two = batch(spark, 3, "a").unionAll(batch(spark, 4, "it's b", "2025-01-02"))
    assert upkeep.append_batches(two, name, partition_by=["d"]) == 4
    # a run that broke off: rows are there, the log does not list them
    cat.save(batch(spark, 50, "c", "2025-01-03"), name, mode="append", partition_by=["batch_id", "d"])
    assert spark.table(name).count() == 57
    assert upkeep.append_batches(batch(spark, 2, "c"), name, partition_by=["d"]) == 2
    rows = {r.batch_id: r["count"] for r in spark.table(name).groupBy("batch_id").count().collect()}
    assert rows == {"a": 3, "it's b": 4, "c": 2}
    assert {r.batch_id: r.rows for r in spark.table(upkeep.batch_log(name)).collect()} == rows


def test_a_batch_that_fails_can_be_loaded_again(spark, db):
    name = f"{db}.t"
    with pytest.raises(Exception, match="boom"):
        upkeep.append_batches(raising(batch(spark, 5, 1)), name)
    assert upkeep.append_batches(batch(spark, 5, 1), name) == 5
    with pytest.raises(Exception, match="boom"):
        upkeep.append_batches(raising(batch(spark, 5, 2)), name)
    assert spark.table(name).count() == 5
    assert upkeep.append_batches(batch(spark, 6, 2), name) == 6
    with pytest.raises(Exception, match="without batch_id"):
        upkeep.append_batches(days(spark, 1).withColumn("batch_id", F.lit(None).cast("int")), name)
    assert spark.table(name).count() == 11


def names_of(spark, name):
    return {r.path: r.bytes for r in upkeep.data_files(spark, name).collect()}


def test_small_files_are_packed(spark, db):
    name = f"{db}.t"
    small = days(spark, 40, "2025-01-01").unionAll(days(spark, 40, "2025-01-02")).unionAll(days(spark, 3, None))
    cat.save(small.repartition(20), name, partition_by=["d"], num_partitions=1, column_comments={"k": "key"})
    for _ in range(3):
        cat.save(days(spark, 7).repartition(4), name, mode="append")
        cat.save(days(spark, 2, None).repartition(2), name, mode="append")
    before, rows = names_of(spark, name), sorted(map(str, spark.table(name).collect()))
    got = upkeep.compact(spark, name)
    after = names_of(spark, name)
    assert sorted(map(str, spark.table(name).collect())) == rows
    assert got["folders"] == 2 and got["after"] == 2 < got["before"]
    untouched = {p for p in before if "d=2025-01-02" in p}
    assert untouched and untouched <= set(after)
    assert upkeep.compact(spark, name) == {"folders": 0, "before": 0, "after": 0}
    assert cat.read_column_comments(spark, name)["k"] == "key"


def test_files_are_packed_to_the_size_asked(spark, db):
    name = f"{db}.t"
    cat.save(days(spark, 4_000).repartition(16), name, table_comment="rows")
    sizes = names_of(spark, name)
    got = upkeep.compact(spark, name, file_bytes=sum(sizes.values()) // 4)
    assert got["before"] == 16 and got["after"] <= 6
    assert spark.table(name).count() == 4_000 and cat.table_comment(spark, name) == "rows"


def test_bins_follow_the_sizes(spark):
    files = spark.createDataFrame([(f"a/{i:02d}", "a", 30) for i in range(10)] + [("b/1", "b", 5)], "path string, folder string, bytes long")
    bins = {r.path: r.bin for r in upkeep.packed(files, 100).collect()}
    assert [bins[f"a/{i:02d}"] for i in range(10)] == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2] and "b/1" not in bins
