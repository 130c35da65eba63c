"""Expressions over one match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import fixed


def result(home_goals: Column, away_goals: Column) -> Column:
    """home_win, away_win or draw; goals that cannot be compared (NULL) count as a draw."""
    return (
        F.when(home_goals > away_goals, fixed.HOME_WIN)
        .when(away_goals > home_goals, fixed.AWAY_WIN)
        .otherwise(fixed.DRAW)
    )


def staged_result(home_goals: Column, away_goals: Column) -> Column:
    """The staging variant: equal goals are a draw and whatever is left, NULL goals too, is an away win."""
    return (
        F.when(home_goals == away_goals, fixed.DRAW)
        .when(home_goals > away_goals, fixed.HOME_WIN)
        .otherwise(fixed.AWAY_WIN)
    )


def result_code(home_goals: Column, away_goals: Column) -> Column:
    """H, A or D."""
    return (
        F.when(home_goals > away_goals, fixed.RESULT_CODES[fixed.HOME_WIN])
        .when(away_goals > home_goals, fixed.RESULT_CODES[fixed.AWAY_WIN])
        .otherwise(fixed.RESULT_CODES[fixed.DRAW])
    )


def outcome_label(home_goals: Column, away_goals: Column) -> Column:
    """Numeric training label."""
    return (
        F.when(home_goals > away_goals, fixed.OUTCOME_LABELS[fixed.HOME_WIN])
        .when(home_goals == away_goals, fixed.OUTCOME_LABELS[fixed.DRAW])
        .otherwise(fixed.OUTCOME_LABELS[fixed.AWAY_WIN])
    )


def winning_team(home_team: Column, away_team: Column, home_goals: Column, away_goals: Column) -> Column:
    """The winner's name, NULL on a draw."""
    return F.when(home_goals > away_goals, home_team).when(away_goals > home_goals, away_team)


def shot_accuracy(goals: Column, shots: Column) -> Column:
    """Goals per shot to three digits, half to even; 0.0 without shots."""
    return F.when(shots > 0, F.bround(goals / shots, 3)).otherwise(F.lit(0.0))


def dominant_team(home_team: Column, away_team: Column, home_share: Column, away_share: Column) -> Column:
    """The side with more possession; an equal share goes to the home team, a missing one to the away team."""
    return F.when(home_share >= away_share, home_team).otherwise(away_team)


def match_label(home_team: Column, away_team: Column, home_goals: Column, away_goals: Column) -> Column:
    """For example "Ajax 2-0 PSV"."""
    return F.concat(
        home_team, F.lit(" "), home_goals.cast("string"), F.lit("-"), away_goals.cast("string"), F.lit(" "), away_team
    )
