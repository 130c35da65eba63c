"""Physical plans: what reaches the scan, what is shuffled, and what must never appear."""

import os
import re

import pytest
from pyspark.sql import functions as F

from touchline import schema
from touchline.operators import health, keyed, league, quality, reports, scoring
from touchline.operators.enrich import enrich
from touchline.plans.queries import QUERIES
from touchline.sinks.lake import write_matches
from touchline.sources import footers
from touchline.sources.lake import read_lake

SF_DIR = "/root/testdata/sf0.001"
NEEDS_DATA = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")
WRITES_FILES = {"csv_multi_file", "lake_roundtrip", "lake_merge_upsert", "stream_ingest_once", "staging_upsert",
                "train_predict", "train_accuracy", "stream_rejects", "stream_counts", "standings_from_changes", "footer_profile"}


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def nodes(text: str, name: str) -> int:
    tree = text.split("\n\n\n")[0]
    return len(re.findall(rf"(?:^|[ \-+:*]){name}\b", tree, re.M))


@pytest.fixture(scope="module")
def lake(spark, matches, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "lake")
    seasons = F.when(F.col("match_id") < "m005", "2023-24").otherwise("2024-25")
    write_matches(enrich(matches.withColumn("season", seasons)), path)
    return path


def test_filters_and_columns_reach_the_scan(spark, lake):
    where = (F.col("total_goals") >= 4) & (F.col("season") == "2024-25")
    text = plan(read_lake(spark, lake, columns=["match_label", "total_goals"], where=where))
    assert "GreaterThanOrEqual(total_goals,4)" in text
    assert re.search(r"PartitionFilters: \[.*season.* = 2024-25", text)
    assert "ReadSchema: struct<total_goals:int,match_label:string>" in text


def test_tables_scan_once_and_shuffle_twice(spark, lake):
    for table in (league.standings_mart, league.standings_ranked):
        text = plan(table(read_lake(spark, lake)))
        assert nodes(text, r"Scan parquet") == 1
        assert nodes(text, "Exchange") == 2  # partial sums, then one row per team and season
        assert "home_shots" not in text


def test_season_filter_reaches_the_scan_through_window_and_aggregate(spark, lake):
    text = plan(league.season_table(read_lake(spark, lake), "2024-25"))
    assert re.search(r"PartitionFilters: \[.*season.* = 2024-25", text)


def test_incremental_run_prunes_built_seasons(spark, lake):
    rows = read_lake(spark, lake)
    built = league.standings_mart(rows.filter("season = '2023-24'"))
    text = plan(league.new_seasons_only(rows, built))
    assert re.search(r"PartitionFilters: \[.*NOT .*season.* = 2023-24", text)


def test_one_team_filters_before_it_aggregates(spark, lake):
    assert re.search(r"PushedFilters: \[Or\(EqualTo\(home_team,X\),EqualTo\(away_team,X\)\)",
                     plan(league.team_stats(read_lake(spark, lake), "X")))


def test_top_matches_keep_a_heap_instead_of_sorting(spark, lake):
    text = plan(reports.top_matches(read_lake(spark, lake)))
    assert nodes(text, "TakeOrderedAndProject") == 1
    assert nodes(text, "Exchange") == 0


def test_a_suite_scans_once_per_kind_of_rule(spark, lake):
    rows = read_lake(spark, lake)
    text = plan(quality.run_suite(rows, quality.match_suite()))
    assert nodes(text, "Scan parquet") == 2
    assert "ReadSchema: struct<match_id:string>" in text
    no_unique = [rule for rule in quality.match_suite() if not rule.unique]
    assert nodes(plan(quality.run_suite(rows, no_unique)), "Scan parquet") == 1


def test_a_small_merge_source_is_broadcast_past_the_target(spark, lake):
    target = read_lake(spark, lake)
    text = plan(keyed.upsert_rows(target, target.limit(1), ["match_id"]))
    assert nodes(text, "BroadcastHashJoin LeftAnti") == 1
    assert nodes(text, "SortMergeJoin LeftAnti") == 0


def test_orphans_meet_as_one_row_per_key(spark, lake):
    rows = read_lake(spark, lake)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to broadcast
    try:
        text = plan(keyed.count_orphans(rows, rows, "match_id", "match_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below_join = text.split("\n\n\n")[0].split("LeftAnti", 1)[1]
    assert len(re.findall("HashAggregate", below_join)) == 4  # partial and final, on both sides


def test_merges_compute_their_source_once(spark, lake, tmp_path):
    rows = read_lake(spark, lake)
    source = str(tmp_path / "source")
    rows.limit(3).write.parquet(source)
    for merge in (
        lambda: keyed.upsert_rows(rows, spark.read.schema(rows.schema).parquet(source), ["match_id"]),
        lambda: keyed.insert_only_rows(rows, spark.read.schema(rows.schema).parquet(source), ["match_id"]),
        lambda: keyed.update_some_rows(rows, spark.read.schema(rows.schema).parquet(source), ["match_id"], ["home_goals"]),
    ):
        assert "/source" not in plan(merge())


def test_rule_metrics_and_times_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "samples")
    spark.sql(
        "SELECT TIMESTAMP '2024-01-01 00:00:00' AS ts, 'lag' AS metric, map('a', 'b') AS labels, 1.0D AS value"
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    assert re.search(r"PushedFilters: \[.*(In\(metric, \[lag,load\]\)|EqualTo\(metric)", plan(health.rule_states(
        rows, [health.Rule("A", "lag", ">", 1.0), health.Rule("B", "load", "<", 1.0)])))
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    text = plan(health.missing_series(rows, rows.select("metric", F.lit("x").alias("series")), now, 60))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(ts,2024-01-01", text)


def test_unscored_reads_only_keys_of_the_predictions(spark, lake):
    rows = read_lake(spark, lake)
    assert "ReadSchema: struct<match_id:string>" in plan(scoring.unscored(rows, rows))


def test_profiles_come_from_footers(spark, lake):
    columns = ["home_goals", "home_shots", "home_possession"]
    with footers.pushed_aggregates(spark):
        text = plan(footers.profile_query(spark, lake, columns, schema.LAKE))
    assert re.search(r"PushedAggregation: \[COUNT\(\*\), COUNT\(home_goals\), MIN\(home_goals\), MAX\(home_goals\)", text)
    assert "PushedAggregation: [COUNT" not in plan(footers.profile_query(spark, lake, columns, schema.LAKE))  # as it was
    told = {r.column: tuple(r)[1:] for r in footers.table_profile(spark, lake, [*columns, "referee"], schema.LAKE).collect()}
    scanned = footers.profile_query(spark, lake, [*columns, "referee"], schema.LAKE).first()
    for k, c in enumerate([*columns, "referee"]):
        low, high = (None if scanned[f"{n}_{k}"] is None else str(scanned[f"{n}_{k}"]) for n in ("low", "high"))
        assert told[c] == (scanned["rows"], scanned[f"known_{k}"], low, high)


@NEEDS_DATA
@pytest.mark.parametrize("key", sorted(set(QUERIES) - WRITES_FILES))
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, key):
    text = plan(QUERIES[key](spark, SF_DIR))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                      "MapInPandas", "FlatMapGroups"):
        assert forbidden not in text
