import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import schema
from touchline.operators import keyed
from touchline.operators.enrich import enrich
from touchline.sinks.lake import append_breaches, write_mart, write_matches, write_table
from touchline.sinks.merge import merge_table, stage_messages
from touchline.sources.lake import read_lake, read_table_or_none

ROW = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("season", T.StringType()),
    T.StructField("home_goals", T.IntegerType()),
    T.StructField("result", T.StringType()),
])


def table(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def content(df):
    return {tuple(r) for r in df.collect()}


def test_lake_is_partitioned_and_idempotent(spark, matches, tmp_path):
    path = str(tmp_path / "lake")
    two = enrich(matches).withColumn("season", F.when(F.col("match_id") < "m005", "2023-24").otherwise("2024"))
    for _ in range(2):
        write_matches(two, path)
    assert sorted(d for d in os.listdir(path) if d.startswith("season")) == ["season=2023-24", "season=2024"]
    back = read_lake(spark, path)
    assert back.count() == 8
    assert back.schema["season"].dataType == T.StringType()
    assert content(back.select(*schema.LAKE.names)) == content(two)
    write_matches(two.filter("season = '2024'").limit(1), path)
    assert read_lake(spark, path, where="season = '2023-24'").count() == 4
    assert read_lake(spark, path, where="season = '2024'").count() == 1


def test_append_mode_and_marts(spark, matches, tmp_path):
    path = str(tmp_path / "lake")
    for _ in range(2):
        write_matches(enrich(matches), path, mode="append")
    assert read_lake(spark, path).count() == 16
    write_mart(matches.groupBy("season").count(), str(tmp_path / "mart"))
    assert spark.read.parquet(str(tmp_path / "mart")).count() == 1


def test_missing_table_is_none(spark, tmp_path):
    assert read_table_or_none(spark, str(tmp_path / "nothing"), ROW) is None


# Merges of rows.


@pytest.fixture
def target(spark):
    return table(spark, ("a", "s1", 1, "old"), ("b", "s1", 2, "old"), ("c", "s2", 3, "old"))


@pytest.fixture
def source(spark):
    rows = [("b", "s1", 7, "stale", 1), ("b", "s1", 9, "new", 2), ("d", "s2", 4, "new", 1)]
    return spark.createDataFrame(rows, "match_id STRING, season STRING, home_goals INT, result STRING, seq INT")


@pytest.fixture(params=["broadcast", "shuffle"])
def join_way(request, monkeypatch):
    """Both the broadcast and the shuffle path give the same rows."""
    if request.param == "shuffle":
        monkeypatch.setattr(keyed, "BROADCAST_ROWS", -1)
    return request.param


def test_upsert(target, source, join_way):
    expected = {("a", "s1", 1, "old"), ("b", "s1", 9, "new"), ("c", "s2", 3, "old"), ("d", "s2", 4, "new")}
    assert content(keyed.upsert_rows(target, source, ["match_id"], ["seq"])) == expected


def test_insert_only(target, source, join_way):
    expected = {("a", "s1", 1, "old"), ("b", "s1", 2, "old"), ("c", "s2", 3, "old"), ("d", "s2", 4, "new")}
    assert content(keyed.insert_only_rows(target, source, ["match_id"], ["seq"])) == expected


def test_partial_update_leaves_other_columns(target, source, join_way):
    merged = keyed.update_some_rows(target, source, ["match_id"], ["home_goals"], ["seq"])
    expected = {("a", "s1", 1, "old"), ("b", "s1", 9, "old"), ("c", "s2", 3, "old"), ("d", "s2", 4, "new")}
    assert content(merged) == expected


def test_partial_update_can_set_null(spark, target):
    gone = spark.createDataFrame([("b", "s1", None, None)], ROW)
    merged = keyed.update_some_rows(target, gone, ["match_id"], ["home_goals"])
    assert ("b", "s1", None, "old") in content(merged)


def test_broadcast_is_measured_in_bytes_too(spark, monkeypatch):
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("key"))
    assert "broadcast" in keyed.broadcast_if_small(wide)._jdf.queryExecution().logical().toString().lower()
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", 5000)
    assert "broadcast" not in keyed.broadcast_if_small(wide)._jdf.queryExecution().logical().toString().lower()


def test_newest_per_key_with_a_hot_key(spark):
    rows = spark.range(30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v")
    )
    newest = keyed.newest_per_key(rows, ["k"], ["v"])
    assert newest.count() == 20_001
    assert newest.filter("k = 'hot'").first().v == 29_997


def test_duplicate_and_orphan_counts(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k STRING")
    assert keyed.count_duplicate_keys(rows, "k").first()[0] == 2
    known = spark.createDataFrame([("a",), ("a",), ("z",)], "id STRING")
    assert keyed.count_orphans(rows, known, "k", "id").first()[0] == 3


# Merges into stored tables.


def test_table_upsert_moves_keys_between_partitions(spark, tmp_path, join_way):
    path = str(tmp_path / "t")
    merge_table(table(spark, ("a", "s1", 1, "x"), ("b", "s2", 2, "x"), ("c", "s3", 3, "x")), path, ROW, ["match_id"])
    moved = table(spark, ("a", "s2", 5, "y"), ("d", "s4", 6, "y"))
    for written in (2, 0):
        assert merge_table(moved, path, ROW, ["match_id"]) == written
        found = content(read_lake(spark, path, ROW, columns=ROW.names))
        assert found == {("a", "s2", 5, "y"), ("b", "s2", 2, "x"), ("c", "s3", 3, "x"), ("d", "s4", 6, "y")}
    assert read_lake(spark, path, ROW, where="season = 's1'").count() == 0


def test_a_repeated_upsert_keeps_every_file(spark, tmp_path, join_way):
    path = str(tmp_path / "t")
    merge_table(table(spark, ("a", "s1", 1, "x"), ("b", "s2", None, "x"), ("c", None, 3, "x")), path, ROW, ["match_id"])
    changes = table(spark, ("a", "s1", 5, "y"), ("b", "s2", None, "x"), ("d", "s2", 1, "z"))
    assert merge_table(changes, path, ROW, ["match_id"]) == 2
    files = sorted(read_lake(spark, path, ROW).inputFiles())
    assert merge_table(changes, path, ROW, ["match_id"]) == 0
    assert sorted(read_lake(spark, path, ROW).inputFiles()) == files
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]  # no staging copy is left


def test_older_rows_do_not_replace_newer_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_table(table(spark, ("a", "s1", 5, "x"), ("b", "s1", 5, "x")), path, ROW, ["match_id"])
    late = table(spark, ("a", "s1", 4, "y"), ("b", "s1", 6, "y"))
    assert merge_table(late, path, ROW, ["match_id"], guard=["home_goals"]) == 1
    assert content(read_lake(spark, path, ROW, columns=ROW.names)) == {("a", "s1", 5, "x"), ("b", "s1", 6, "y")}


def test_partition_names_that_need_escaping(spark, tmp_path):
    path = str(tmp_path / "t")
    odd = "20/21: a=b%"
    merge_table(table(spark, ("a", odd, 1, "x"), ("b", None, 1, "x")), path, ROW, ["match_id"])
    merge_table(table(spark, ("a", "s", 2, "y"), ("b", "s", 2, "y")), path, ROW, ["match_id"])
    assert content(read_lake(spark, path, ROW, columns=ROW.names)) == {("a", "s", 2, "y"), ("b", "s", 2, "y")}


def test_table_insert_only(spark, tmp_path, join_way):
    path = str(tmp_path / "t")
    assert merge_table(table(spark, ("a", "s1", 1, "x")), path, ROW, ["match_id"], mode="insert_only") == 1
    again = table(spark, ("a", "s2", 9, "y"), ("b", "s1", 2, "y"))
    assert merge_table(again, path, ROW, ["match_id"], mode="insert_only") == 1
    assert merge_table(again, path, ROW, ["match_id"], mode="insert_only") == 0
    assert content(read_lake(spark, path, ROW, columns=ROW.names)) == {("a", "s1", 1, "x"), ("b", "s1", 2, "y")}


@pytest.mark.parametrize("partition_by", ["season", None])
def test_table_partial_update(spark, tmp_path, join_way, partition_by):
    path = str(tmp_path / "t")
    merge_table(table(spark, ("a", "s1", 1, "x"), ("b", "s2", 2, "x")), path, ROW, ["match_id"], partition_by=partition_by)
    changes = table(spark, ("a", "s9", 5, "y"), ("c", "s3", 6, "y"))
    for _ in range(2):
        merge_table(changes, path, ROW, ["match_id"], partition_by=partition_by, update=["home_goals"])
        found = content(read_lake(spark, path, ROW, columns=ROW.names))
        assert found == {("a", "s1", 5, "x"), ("b", "s2", 2, "x"), ("c", "s3", 6, "y")}


def test_unpartitioned_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_table(table(spark, ("a", "s1", 1, "x"), ("b", "s1", 1, "x")), path, ROW, ["match_id"], partition_by=None)
    merge_table(table(spark, ("a", "s1", 2, "y")), path, ROW, ["match_id"], partition_by=None)
    assert content(spark.read.schema(ROW).parquet(path)) == {("a", "s1", 2, "y"), ("b", "s1", 1, "x")}


def test_empty_and_invalid_merges(spark, tmp_path):
    path = str(tmp_path / "t")
    assert merge_table(table(spark), path, ROW, ["match_id"]) == 0
    assert read_table_or_none(spark, path, ROW) is None
    with pytest.raises(ValueError, match="without a key"):
        merge_table(table(spark, (None, "s1", 1, "x")), path, ROW, ["match_id"])
    with pytest.raises(ValueError, match="unknown merge mode"):
        merge_table(table(spark), path, ROW, ["match_id"], mode="replace")


def test_staging_stamps_the_time(spark, tmp_path):
    path = str(tmp_path / "staging")
    assert stage_messages(table(spark, ("a", "s1", 1, "x")), path, ROW) == 1
    assert stage_messages(table(spark, ("a", "s1", 99, "x")), path, ROW) == 1
    row = spark.read.parquet(path).first()
    assert row.home_goals == 99
    assert isinstance(row.ingested_at, dt.datetime)


def test_staging_keeps_the_last_message(spark, tmp_path):
    sent = [("a", "s1", 5, "x", 10, 0, 1), ("a", "s1", 2, "x", 12, 0, 2), ("b", "s1", 7, "x", 12, 0, 3), ("b", "s1", 1, "x", 12, 0, 4)]
    rows = spark.createDataFrame(
        [(*r[:4], dt.datetime(2024, 1, 1, r[4]), *r[5:]) for r in sent],
        "match_id STRING, season STRING, home_goals INT, result STRING, kafka_timestamp TIMESTAMP, kafka_partition INT, "
        "kafka_offset BIGINT",
    )
    path = str(tmp_path / "staging")
    assert stage_messages(rows, path, ROW) == 2
    assert {(r.match_id, r.home_goals) for r in spark.read.parquet(path).collect()} == {("a", 2), ("b", 1)}


def test_breaches_are_appended(spark, tmp_path):
    path = str(tmp_path / "breaches")
    rows = spark.createDataFrame(
        [("validate", 120, 180.5, 60.5, "high", dt.datetime(2024, 1, 1))], schema.BREACHES
    )
    for _ in range(2):
        append_breaches(rows, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 2
    assert "created_at" in stored.columns


def test_merged_rows_are_written_once(spark, tmp_path, monkeypatch, join_way):
    from touchline.sinks import merge

    path, written = str(tmp_path / "t"), []
    merge_table(table(spark, ("a", "s1", 1, "x"), ("b", "s2", 2, "x"), ("c", None, 3, "x")), path, ROW, ["match_id"])
    monkeypatch.setattr(merge, "write_table", lambda df, *rest, **named: (written.append(df.count()), write_table(df, *rest, **named)))
    assert merge_table(table(spark, ("b", "s1", 5, "y"), ("d", None, 4, "y")), path, ROW, ["match_id"]) == 2
    assert written == [4]
    assert content(read_lake(spark, path, ROW, columns=ROW.names)) == {("a", "s1", 1, "x"), ("b", "s1", 5, "y"), ("c", None, 3, "x"), ("d", None, 4, "y")}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_only_partitions_of_the_copy_are_replaced(spark, tmp_path):
    from touchline.sinks.lake import move_over

    path, copy = str(tmp_path / "t"), str(tmp_path / "t__merge-1")
    write_table(table(spark, ("a", "s1", 1, "old"), ("b", "s2", 2, "old"), ("c", "s3", 3, "old")), path)
    write_table(table(spark, ("a", "s1", 1, "new"), ("b", "s2", 2, "new")), copy)
    move_over(spark, str(tmp_path / "t__merge-1"), path, "season")
    assert content(read_lake(spark, path, ROW, columns=ROW.names)) == {("a", "s1", 1, "new"), ("b", "s2", 2, "new"), ("c", "s3", 3, "old")}
    assert not os.path.exists(copy)
