"""Canned reports over enriched matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import fixed

C = F.col


def top_matches(enriched: DataFrame, n: int = fixed.TOP_MATCHES) -> DataFrame:
    """The n matches with most goals; ties by id, so that the choice is repeatable."""
    return (
        enriched.orderBy(F.desc("total_goals"), "match_id").limit(n)
        .select("match_label", "total_goals", "match_date")
    )


def high_scoring_matches(enriched: DataFrame, min_goals: int = fixed.HIGH_SCORING_TOTAL) -> DataFrame:
    """All matches with at least min_goals, most goals first, then oldest first."""
    return (
        enriched.filter(C("total_goals") >= min_goals)
        .orderBy(F.desc("total_goals"), "match_date", "match_id")
        .select("match_label", "total_goals", "match_date", "stadium")
    )


def referee_summary(enriched: DataFrame) -> DataFrame:
    """Matches with a recorded total and their mean per referee, half to even."""
    return (
        enriched.filter(C("referee").isNotNull())
        .groupBy("referee")
        .agg(F.count("total_goals").alias("matches"), F.bround(F.avg("total_goals"), 2).alias("avg_goals"))
        .orderBy(F.desc("matches"), "referee")
    )


def referee_stats(enriched: DataFrame) -> DataFrame:
    """The view variant: all matches, mean rounded half up, high-scoring games and the highest total."""
    return (
        enriched.filter(C("referee").isNotNull())
        .groupBy("referee")
        .agg(
            F.count(F.lit(1)).alias("matches"),
            F.round(F.avg("total_goals"), 2).alias("avg_goals"),
            F.count_if(C("high_scoring")).alias("high_scoring_games"),
            F.max("total_goals").alias("max_goals_in_game"),
        )
        .orderBy(F.desc("matches"), "referee")
    )


def head_to_head(matches: DataFrame) -> DataFrame:
    """Meetings and goals per unordered pair of teams that have met."""
    goals = C("home_goals") + C("away_goals")
    return (
        matches.groupBy(
            F.least("home_team", "away_team").alias("team_a"), F.greatest("home_team", "away_team").alias("team_b")
        )
        .agg(
            F.count(F.lit(1)).alias("meetings"),
            F.sum(goals).alias("total_goals"),
            F.round(F.avg(goals), 2).alias("avg_goals"),
        )
        .filter("meetings > 0")
        .orderBy(F.desc("meetings"), F.desc("total_goals"), "team_a", "team_b")
    )
