import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchline import fixed
from touchline.operators import quality
from touchline.operators.enrich import enrich

AS_OF = dt.datetime(2024, 1, 15, 12)


@pytest.fixture
def suited(matches):
    """The sample in the suite's seven columns, with a well-formed season."""
    return matches.withColumn("season", F.lit("2024-25")).select(*fixed.SUITE_COLUMNS)


def failed(df, suite=None):
    rows = quality.run_suite(df, suite or quality.match_suite()).filter("NOT success").collect()
    return {(r.expectation, r.column): r.unexpected_count for r in rows}


def test_a_clean_table_passes(suited):
    results = quality.run_suite(suited, quality.match_suite())
    assert results.count() == 15
    assert results.filter("NOT success").isEmpty()
    quality.require_suite(suited, quality.match_suite())


@pytest.mark.parametrize(
    "column, value, expected",
    [
        ("home_team", None, {("expect_column_values_to_not_be_null", "home_team"): 8}),
        ("home_goals", 21, {("expect_column_values_to_be_between", "home_goals"): 8}),
        ("away_goals", -1, {("expect_column_values_to_be_between", "away_goals"): 8}),
        ("season", "2024", {("expect_column_values_to_match_regex", "season"): 8}),
        ("match_id", "m", {("expect_column_values_to_be_unique", "match_id"): 8}),
    ],
)
def test_each_row_rule(suited, column, value, expected):
    broken = suited.withColumn(column, F.lit(value).cast(suited.schema[column].dataType))
    assert failed(broken) == expected


def test_table_rules(suited):
    assert failed(suited.limit(0)) == {("expect_table_row_count_to_be_between", ""): 0}
    assert failed(suited.withColumn("away_team", F.col("home_team"))) == {
        ("expect_column_pair_values_to_not_be_equal", "home_team,away_team"): 8
    }
    reordered = suited.select(*reversed(suited.columns))
    assert failed(reordered) == {("expect_table_columns_to_match_ordered_list", ""): 1}
    long = suited.withColumn("home_goals", F.col("home_goals").cast("bigint"))
    assert failed(long) == {("expect_column_values_to_be_of_type", "home_goals"): 1}
    assert failed(suited, quality.match_suite(row_range=(1, 5))) == {("expect_table_row_count_to_be_between", ""): 8}


def test_the_gate_names_every_failure(suited):
    broken = suited.withColumns({"home_goals": F.lit(99), "season": F.lit("x")})
    with pytest.raises(quality.DataQualityError, match=r"2 expectation\(s\) failed(.|\n)*home_goals(.|\n)*season"):
        quality.require_suite(broken, quality.match_suite())


def test_column_tests(matches, match_row):
    doubled = matches.unionByName(match_row(away_goals=None))
    rows = quality.column_tests({"matches": (doubled, fixed.SOURCE_COLUMN_TESTS)}).collect()
    found = {(r.column_name, r.test): (r.failures, r.passed) for r in rows}
    assert found[("match_id", "unique")] == (1, False)
    assert found[("away_goals", "not_null")] == (1, False)
    assert found[("season", "not_null")] == (0, True)
    assert found[("matchday", "not_null")] == (None, False)


def test_null_profile(matches, match_row):
    rows = quality.null_profile(matches.unionByName(match_row(referee=None))).collect()
    assert {r.column_name: r.null_count for r in rows if r.null_count} == {"referee": 1}
    assert {r.row_count for r in rows} == {9}


def test_row_validation(matches, match_row):
    assert quality.require_valid_rows(matches, fixed.REQUIRED_COLUMNS) == 8
    with pytest.raises(quality.DataQualityError, match="empty"):
        quality.require_valid_rows(matches.limit(0))
    with pytest.raises(quality.DataQualityError, match="season: 1 null"):
        quality.require_valid_rows(matches.unionByName(match_row(season=None)), fixed.REQUIRED_COLUMNS)
    with pytest.raises(quality.DataQualityError, match="negative"):
        quality.require_valid_rows(matches.unionByName(match_row(home_goals=-5)))
    assert quality.negative_goals(matches.unionByName(match_row(home_goals=-5))).count() == 1


@pytest.mark.parametrize(
    "sent, stored, tolerance, passed", [(1000, 1000, 0, True), (1000, 800, 0, False), (1000, 995, 10, True)]
)
def test_reconciliation(spark, sent, stored, tolerance, passed):
    row = quality.row_count_reconciliation(spark.range(sent), spark.range(stored), tolerance).first()
    assert row.passed == passed
    assert row.details == (
        f"kafka_offsets={sent}, delta_rows={stored}, diff={sent - stored}, tolerance={tolerance}"
    )


def test_duplicate_keys(spark):
    once = spark.range(5)
    assert quality.duplicate_primary_keys(once, "t", "id").first().passed
    row = quality.duplicate_primary_keys(once.union(spark.range(3)), "t", "id").first()
    assert (row.passed, row.details) == (False, "table=t, pk=id, duplicate_groups=3")


def test_orphans(spark):
    source = spark.range(10)
    assert quality.referential_integrity(spark.range(5), source, "m", "s", "id", "id").first().passed
    row = quality.referential_integrity(spark.range(5, 15), source, "m", "s", "id", "id").first()
    assert (row.passed, row.details) == (False, "mart=m, source=s, orphaned_mart_rows=5")


@pytest.mark.parametrize("hours, passed", [(1, True), (25, True), (30, False)])
def test_freshness(spark, hours, passed):
    rows = spark.createDataFrame([(AS_OF - dt.timedelta(hours=hours),)], "ts TIMESTAMP")
    row = quality.data_freshness(rows, "t", "ts", F.lit(AS_OF)).first()
    assert row.passed == passed
    assert f"age_seconds={hours * 3600}, threshold_seconds=90000" in row.details


def test_freshness_of_an_empty_table(spark):
    row = quality.data_freshness(spark.createDataFrame([], "ts TIMESTAMP"), "t", "ts", F.lit(AS_OF)).first()
    assert (row.passed, row.details) == (False, "table=t has no rows")


def test_a_check_that_cannot_run_fails(spark):
    results = quality.run_checks(spark, {
        "duplicate_primary_keys": lambda: quality.duplicate_primary_keys(spark.range(3), "t", "id"),
        "referential_integrity": lambda: quality.referential_integrity(
            spark.range(3), spark.range(3), "m", "s", "no_such_column", "id"
        ),
    })
    found = {r.check_name: (r.passed, r.details) for r in results.collect()}
    assert found["duplicate_primary_keys"][0]
    assert not found["referential_integrity"][0]
    assert found["referential_integrity"][1].startswith("Query failed: ")
    assert tuple(quality.check_summary(results).first()) == (2, 1, 1)
    with pytest.raises(quality.DataQualityError, match="referential_integrity"):
        quality.require_checks(results)
    quality.require_checks(results.filter("passed"))
    assert "measured_at" in quality.with_measured_at(results).columns


def test_quarantine_splits_without_loss(matches, match_row):
    bad = match_row(match_id=None, home_goals=-1, away_team="Arsenal", season="2024")
    good = matches.withColumn("season", F.lit("2024-25"))
    valid, quarantined = quality.split_valid(good.unionByName(bad), quality.match_constraints())
    assert valid.count() == 8
    row = quarantined.first()
    assert row.reasons == ["match_id_missing", "home_goals_negative", "same_team", "season_malformed"]
    assert quarantined.count() == 1


def test_unknown_results_are_quarantined(matches):
    odd = enrich(matches).withColumn("result", F.when(F.col("match_id") != "m001", F.col("result")))
    valid, quarantined = quality.split_valid(odd, quality.allowed_results())
    assert (valid.count(), quarantined.first().reasons) == (7, ["result_unknown"])
