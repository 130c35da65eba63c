import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from touchline import schema
from touchline.operators import league, reports
from touchline.operators.enrich import enrich, stage_matches
from touchline.operators.numbering import number_rows

# The sample's table (team, played, won, drawn, lost, gf, ga, gd, points, rank).
SAMPLE_TABLE = [
    ("Liverpool", 2, 2, 0, 0, 5, 1, 4, 6, 1),
    ("Man City", 2, 2, 0, 0, 6, 2, 4, 6, 1),
    ("Arsenal", 2, 1, 1, 0, 3, 1, 2, 4, 3),
    ("Tottenham", 1, 1, 0, 0, 3, 0, 3, 3, 4),
    ("Chelsea", 2, 1, 0, 1, 3, 3, 0, 3, 5),
    ("Brighton", 1, 0, 1, 0, 1, 1, 0, 1, 6),
    ("Crystal Palace", 1, 0, 0, 1, 1, 2, -1, 0, 7),
    ("Wolves", 1, 0, 0, 1, 0, 2, -2, 0, 8),
    ("Ipswich", 1, 0, 0, 1, 1, 4, -3, 0, 9),
    ("Leicester", 1, 0, 0, 1, 0, 3, -3, 0, 9),
    ("Brentford", 2, 0, 0, 2, 1, 5, -4, 0, 11),
]
MEAN_POSSESSION = {
    "Liverpool": 68.4, "Man City": 63.6, "Arsenal": 58.9, "Tottenham": 58.2, "Chelsea": 51.5, "Brighton": 44.6,
    "Crystal Palace": 41.1, "Wolves": 37.7, "Ipswich": 28.8, "Leicester": 41.8, "Brentford": 31.6,
}


def random_matches(spark, n=600, seed=5):
    rng = random.Random(seed)
    teams = [f"T{i:02d}" for i in range(14)]
    rows = []
    for i in range(n):
        home, away = rng.sample(teams, 2)
        season = "2020-21" if rng.random() < 0.6 else rng.choice(["2021-22", "2022-23"])
        rows.append((
            f"x{i}", dt.date(2021, 1, 1) + dt.timedelta(days=i), season, home, away, rng.randint(0, 4),
            rng.randint(0, 4), None, None, rng.choice([None, rng.randint(300, 700) / 10]),
            rng.choice([None, rng.randint(300, 700) / 10]), "S", rng.choice(["R1", "R2", None]),
        ))
    return rows, spark.createDataFrame(rows, schema.MATCHES)


def test_ranked_table_of_the_sample(matches):
    rows = league.season_table(matches, "2024").collect()
    found = [
        (r.team, r.played, r.wins, r.draws, r.losses, r.goals_for, r.goals_against, r.goal_diff, r.points, r.position)
        for r in rows
    ]
    assert found == SAMPLE_TABLE


def test_mart_places_are_unique_and_settled_by_goals(matches):
    places = {r.team: r.position for r in league.standings_mart(matches).collect()}
    assert sorted(places.values()) == list(range(1, 12))
    assert (places["Man City"], places["Liverpool"]) == (1, 2)
    assert (places["Ipswich"], places["Leicester"]) == (9, 10)


def test_table_against_a_loop(spark):
    rows, df = random_matches(spark)
    expected = {}
    for _, _, season, home, away, hg, ag, *_ in rows:
        for team, gf, ga in ((home, hg, ag), (away, ag, hg)):
            t = expected.setdefault((season, team), [0] * 6)
            for i, v in enumerate((1, gf > ga, gf == ga, gf < ga, gf, ga)):
                t[i] += v
    found = {
        (r.season, r.team): [r.played, r.won, r.drawn, r.lost, r.gf, r.ga] for r in league.standings_mart(df).collect()
    }
    assert found == expected


@pytest.mark.parametrize("table", [league.standings_mart, lambda m: league.standings_ranked(m).withColumnsRenamed(
    {"wins": "won", "draws": "drawn", "losses": "lost"})])
def test_invariants(spark, table):
    _, df = random_matches(spark)
    for r in table(df).collect():
        assert r.points == 3 * r.won + r.drawn
        assert r.played == r.won + r.drawn + r.lost


def test_all_variants_agree_on_points(spark):
    _, df = random_matches(spark)
    marts = {(r.season, r.team): r.points for r in league.standings_mart(df).collect()}
    assert {(r.season, r.team): r.points for r in league.standings_points(df).collect()} == marts
    assert {(r.season, r.team): r.points for r in league.team_season_stats(stage_matches(df)).collect()} == marts


def test_summary_possession_and_numbering(spark, matches):
    rows = league.numbered_summary(matches).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, 12))
    assert {r.team: r.avg_possession for r in rows}.keys() == MEAN_POSSESSION.keys()
    for r in rows:
        assert abs(r.avg_possession - MEAN_POSSESSION[r.team]) < 0.11
    ordered = [(r.points, r.goal_diff) for r in rows]
    assert ordered == sorted(ordered, reverse=True)
    _, df = random_matches(spark)
    no_possession = df.withColumns({c: F.lit(None).cast("double") for c in ("home_possession", "away_possession")})
    assert {r.avg_possession for r in league.team_summary(no_possession).collect()} == {0.0}


def test_numbering_is_exact_over_many_partitions(spark):
    values = spark.range(5000, numPartitions=13).withColumn("v", (F.col("id") * 7919) % 5000)
    numbered = number_rows(values, F.desc("v"))
    assert numbered.filter(F.col("position") != 5000 - F.col("v")).count() == 0
    assert numbered.count() == 5000


def test_one_team(matches):
    row = league.team_stats(matches, "Arsenal").first()
    assert (row.played, row.wins, row.draws, row.goal_diff, row.points) == (2, 1, 1, 2, 4)
    assert league.team_stats(matches, "Nobody").isEmpty()
    with pytest.raises(ValueError):
        league.team_stats_or_raise(matches, "Nobody")
    assert [r.position for r in league.team_history(matches, "Arsenal").collect()] == [3]


def test_incremental_mart_adds_only_new_seasons(spark):
    _, df = random_matches(spark)
    built = league.standings_mart(df.filter("season = '2020-21'")).withColumn("points", F.lit(-1).cast("bigint"))
    updated = league.standings_increment(df, built)
    points = {s: {r.points for r in updated.filter(F.col("season") == s).collect()} for s in ("2020-21", "2021-22")}
    assert points["2020-21"] == {-1}
    assert -1 not in points["2021-22"]
    full = {(r.season, r.team, r.points) for r in league.standings_mart(df).collect()}
    refreshed = league.standings_increment(df, built, refresh_seasons=["2020-21"])
    assert {(r.season, r.team, r.points) for r in refreshed.collect()} == full


def test_incremental_mart_with_null_seasons(spark):
    _, df = random_matches(spark)
    nameless = df.limit(1).withColumn("season", F.lit(None).cast("string"))
    built = league.standings_mart(df.filter("season = '2020-21'").unionByName(nameless))
    expected = {"2021-22", "2022-23"}
    fresh = league.new_seasons_only(df.unionByName(nameless), built)
    assert {r.season for r in fresh.select("season").distinct().collect()} == expected
    first = league.new_seasons_only(df.unionByName(nameless), built.limit(0))  # the same rule for an empty mart
    assert {r.season for r in first.select("season").distinct().collect()} == expected | {"2020-21"}


def test_distinct_values(matches):
    assert {r.team for r in league.distinct_teams(matches).collect()} == set(MEAN_POSSESSION)
    assert [r.season for r in league.distinct_values(matches, "season").collect()] == ["2024"]


def test_views_by_name(spark, matches):
    league.register_views(matches)
    league.register_views(matches)
    top = spark.sql(
        "SELECT team FROM standings WHERE season = :season AND position = 1 ORDER BY team", args={"season": "2024"}
    )
    assert [r.team for r in top.collect()] == ["Liverpool", "Man City"]
    high = spark.sql("SELECT match_id FROM matches WHERE total_goals >= :least ORDER BY total_goals DESC, match_date",
                     args={"least": 4})
    assert [r.match_id for r in high.collect()] == ["m006", "m003"]
    league.drop_views(spark)
    assert not spark.catalog.tableExists("standings")


def test_reports(matches):
    enriched = enrich(matches)
    assert [r.total_goals for r in reports.top_matches(enriched, 3).collect()] == [5, 4, 3]
    assert [r.match_label for r in reports.high_scoring_matches(enriched).collect()] == [
        "Man City 4-1 Ipswich", "Liverpool 3-1 Brentford",
    ]
    assert reports.high_scoring_matches(enriched, 7).isEmpty()
    pairs = reports.head_to_head(matches).collect()
    assert tuple(pairs[0]) == ("Brentford", "Liverpool", 2, 6, 3.0)
    assert {r.meetings for r in pairs[1:]} == {1}


def test_order_of_reports(spark):
    _, df = random_matches(spark)
    enriched = enrich(df)
    for report in (reports.referee_summary, reports.referee_stats):
        rows = [r.asDict() for r in report(enriched).collect()]
        assert [r["avg_goals"] for r in rows] == sorted((r["avg_goals"] for r in rows), reverse=True) and len(rows) > 1
    places = [r.position for r in league.season_table(df, "2020-21").collect()]
    assert places == sorted(places) and len(places) > 1


def test_referees_without_a_name_are_left_out(matches, match_row):
    enriched = enrich(matches.unionByName(match_row(match_id="x", referee=None)))
    assert reports.referee_summary(enriched).count() == 8
    stats = {r.referee: r for r in reports.referee_stats(enriched).collect()}
    assert (stats["R. Jones"].high_scoring_games, stats["R. Jones"].max_goals_in_game) == (1, 5)
