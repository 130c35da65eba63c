import pytest
from pyspark.sql import functions as F

from touchline.functions import text, timing
from touchline.functions import match as m
from touchline.operators.enrich import complete_for_scoring, enrich, stage_matches, stage_matches_coded


@pytest.mark.parametrize(
    "home, away, expected",
    [(3, 2, "home_win"), (1, 4, "away_win"), (2, 2, "draw"), (7, 6, "home_win"), (4, 9, "away_win"), (8, 8, "draw")],
)
def test_result(match_row, home, away, expected):
    row = enrich(match_row(home_goals=home, away_goals=away)).first()
    assert row.result == expected
    assert row.total_goals == home + away
    assert row.goal_diff == home - away
    assert row.high_scoring == (home + away >= 4)


def test_derived_columns_of_the_sample(matches):
    rows = {r.match_id: r for r in enrich(matches).collect()}
    ids = sorted(rows)
    assert [rows[i].home_shot_acc for i in ids] == [0.143, 0.111, 0.167, 0.188, 0.083, 0.182, 0.133, 0.105]
    assert [rows[i].away_shot_acc for i in ids] == [0.0, 0.154, 0.125, 0.0, 0.1, 0.25, 0.143, 0.0]
    assert [rows[i].dominant_team for i in ids] == [
        "Arsenal", "Man City", "Liverpool", "Tottenham", "Arsenal", "Man City", "Chelsea", "Liverpool",
    ]
    assert rows["m001"].match_label == "Arsenal 2-0 Wolves"


@pytest.mark.parametrize("shots", [None, 0])
def test_no_shots_is_zero_accuracy(match_row, shots):
    assert enrich(match_row(home_goals=2, home_shots=shots)).first().home_shot_acc == 0.0


def test_rounding_is_half_to_even(match_row):
    assert enrich(match_row(home_goals=1, home_shots=16)).first().home_shot_acc == 0.062


def test_missing_possession_goes_to_the_away_team(match_row):
    assert enrich(match_row(home_possession=None)).first().dominant_team == "Wolves"
    assert enrich(match_row(home_possession=50.0, away_possession=50.0)).first().dominant_team == "Arsenal"


def test_staging_drops_rows_without_a_key(matches, match_row):
    staged = stage_matches(matches.unionByName(match_row(match_id=None)))
    assert staged.count() == 8
    winners = {r.match_id: (r.winning_team, r.result_type) for r in staged.collect()}
    assert winners["m002"] == ("Man City", "away_win")
    assert winners["m005"] == (None, "draw")


def test_staging_of_missing_goals_differs_by_variant(match_row):
    row = match_row(home_goals=None)
    assert stage_matches(row).first().result_type == "away_win"
    assert enrich(row).first().result == "draw"


def test_coded_staging(matches):
    coded = {r.match_id: (r.winning_team, r.result_type) for r in stage_matches_coded(matches).collect()}
    assert coded["m001"] == ("Arsenal", "H")
    assert coded["m002"] == ("Man City", "A")
    assert coded["m005"] == ("Draw", "D")


def test_incomplete_rows_are_not_scored(matches, match_row):
    assert complete_for_scoring(matches.unionByName(match_row(season=None))).count() == 8


def test_outcome_labels(match_row):
    for home, away, expected in [(2, 0, 2), (1, 1, 1), (0, 1, 0)]:
        row = match_row(home_goals=home, away_goals=away)
        assert row.select(m.outcome_label(F.col("home_goals"), F.col("away_goals"))).first()[0] == expected


def test_lenient_values(spark):
    rows = spark.createDataFrame([("7",), (" 8 ",), ("n/a",), ("",), (None,)], "v STRING")
    assert [r[0] for r in rows.select(text.lenient_int(F.col("v"))).collect()] == [7, 8, None, None, None]
    assert [r[0] for r in rows.select(text.blank_to_null(F.col("v"))).collect()] == ["7", "8", "n/a", None, None]


def test_iso_text(spark):
    row = spark.sql("SELECT TIMESTAMP '2024-01-02 03:04:05' AS a, TIMESTAMP '2024-01-02 03:04:05.25' AS b")
    shown = row.select(text.iso_utc(F.col("a")), text.iso_utc(F.col("b"))).first()
    assert tuple(shown) == ("2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05.250000+00:00")


@pytest.mark.parametrize("actual, expected", [(110.0, "warning"), (150.0, "high"), (199.9, "high"), (210.0, "critical")])
def test_severity(spark, actual, expected):
    row = spark.range(1).select(timing.severity(F.lit(actual), F.lit(100))).first()
    assert row[0] == expected


def test_severity_of_a_zero_limit(spark):
    assert spark.range(1).select(timing.severity(F.lit(1.6), F.lit(0))).first()[0] == "high"
