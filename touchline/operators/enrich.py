"""Row-wise enrichment and the cleaned staging views. Narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import fixed, schema
from touchline.functions import match as m

C = F.col


def enrich(matches: DataFrame, *kept: str) -> DataFrame:
    """The canonical columns plus the eight derived ones, and any further columns named to be kept."""
    home_goals, away_goals = C("home_goals"), C("away_goals")
    derived = {
        "result": m.result(home_goals, away_goals),
        "total_goals": home_goals + away_goals,
        "goal_diff": home_goals - away_goals,
        "high_scoring": home_goals + away_goals >= fixed.HIGH_SCORING_TOTAL,
        "home_shot_acc": m.shot_accuracy(home_goals, C("home_shots")),
        "away_shot_acc": m.shot_accuracy(away_goals, C("away_shots")),
        "dominant_team": m.dominant_team(
            C("home_team"), C("away_team"), C("home_possession"), C("away_possession")
        ),
        "match_label": m.match_label(C("home_team"), C("away_team"), home_goals, away_goals),
    }
    added = [derived[name].alias(name) for name in schema.DERIVED.names]
    return matches.select(*schema.MATCHES.names, *added, *kept)


def _staged(matches: DataFrame) -> list:
    """Explicit casts of the staging columns; matchday only where the input has it."""
    types = {
        "match_id": "string", "season": "string", "matchday": "int", "home_team": "string",
        "away_team": "string", "home_goals": "int", "away_goals": "int",
    }
    return [C(name).cast(kind).alias(name) for name, kind in types.items() if name in matches.columns]


def stage_matches(matches: DataFrame) -> DataFrame:
    """Rows with a key, typed, with the winner (NULL on a draw) and the spelled-out result."""
    sides = C("home_team"), C("away_team"), C("home_goals"), C("away_goals")
    return matches.filter(C("match_id").isNotNull()).select(
        *_staged(matches),
        m.winning_team(*sides).alias("winning_team"),
        m.staged_result(C("home_goals"), C("away_goals")).alias("result_type"),
    )


def stage_matches_coded(matches: DataFrame) -> DataFrame:
    """The staging variant with H/A/D codes and the text `Draw` for a missing winner."""
    home_goals, away_goals = C("home_goals").try_cast("int"), C("away_goals").try_cast("int")
    winner = m.winning_team(C("home_team"), C("away_team"), home_goals, away_goals)
    carried = [c for c in ("match_date", "referee") if c in matches.columns]
    return matches.filter(C("match_id").isNotNull()).select(
        *_staged(matches),
        *carried,
        F.coalesce(winner, F.lit(fixed.NO_WINNER)).alias("winning_team"),
        m.result_code(home_goals, away_goals).alias("result_type"),
    )


def complete_for_scoring(matches: DataFrame) -> DataFrame:
    """The six columns the outcome model reads, without rows that miss any of them."""
    return matches.select("match_id", "season", "home_team", "away_team", "home_goals", "away_goals").dropna()
