"""League tables: one scan, one partial/final aggregate, and a window over one row per team and season."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline import fixed
from touchline.functions import match as m
from touchline.operators.enrich import enrich, stage_matches
from touchline.operators.numbering import number_rows

C = F.col


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _both_sides(matches: DataFrame, home: dict[str, Column], away: dict[str, Column]) -> DataFrame:
    """Two rows per match, from one scan. `season` stays outside the structs, so season filters reach the scan."""
    def side(cols: dict[str, Column]) -> Column:
        return F.struct(*[c.alias(name) for name, c in cols.items()])

    return matches.select("season", F.inline(F.array(side(home), side(away))))


def team_rows(matches: DataFrame, result: Column | None = None, possession: bool = False) -> DataFrame:
    """Each match from both teams' point of view: win, draw and loss flags, goals for and against."""
    outcome = m.result(C("home_goals"), C("away_goals")) if result is None else result
    home_won, away_won = _flag(outcome == fixed.HOME_WIN), _flag(outcome == fixed.AWAY_WIN)
    drawn = _flag(outcome == fixed.DRAW)
    home = {
        "team": C("home_team"), "win": home_won, "draw": drawn, "loss": away_won,
        "gf": C("home_goals"), "ga": C("away_goals"),
    }
    away = {
        "team": C("away_team"), "win": away_won, "draw": drawn, "loss": home_won,
        "gf": C("away_goals"), "ga": C("home_goals"),
    }
    if possession:
        home["possession"], away["possession"] = C("home_possession"), C("away_possession")
    return _both_sides(matches, home, away)


def _tally(rows: DataFrame, keys: Sequence[str], *extra: Column) -> DataFrame:
    """Played, won, drawn, lost, goals and points per key."""
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("played"),
        F.sum("win").alias("won"),
        F.sum("draw").alias("drawn"),
        F.sum("loss").alias("lost"),
        F.sum("gf").alias("gf"),
        F.sum("ga").alias("ga"),
        *extra,
    )
    points = C("won") * fixed.POINTS_WIN + C("drawn") * fixed.POINTS_DRAW
    return sums.withColumn("gd", C("gf") - C("ga")).withColumn("points", points)


_LONG_NAMES = {
    "won": "wins", "drawn": "draws", "lost": "losses", "gf": "goals_for", "ga": "goals_against", "gd": "goal_diff",
}


def standings_ranked(matches: DataFrame) -> DataFrame:
    """The view variant: RANK on points and goal difference, so equal teams share a place."""
    place = F.rank().over(Window.partitionBy("season").orderBy(F.desc("points"), F.desc("gd")))
    table = _tally(team_rows(matches), ["team", "season"])
    return table.withColumn("position", place).withColumnsRenamed(_LONG_NAMES)


def standings_mart(matches: DataFrame) -> DataFrame:
    """The mart variant: unique places on points, goal difference and goals for; the name settles what is left."""
    return _placed(_tally(team_rows(stage_matches(matches), C("result_type")), ["season", "team"]))


def _placed(table: DataFrame) -> DataFrame:
    order = Window.partitionBy("season").orderBy(F.desc("points"), F.desc("gd"), F.desc("gf"), "team")
    columns = ["season", "team", "played", "won", "drawn", "lost", "gf", "ga", "gd", "points"]
    return table.select(*columns, F.row_number().over(order).alias("position"))


_TOTALS = ["played", "won", "drawn", "lost", "gf", "ga"]


def standings_changes(changes: DataFrame) -> DataFrame:
    """Signed totals per season and team of changed matches (old, new): what is new counts, what was old is taken off.

    Matches without a season never count. An unknown number of goals counts as none.
    """
    signed = F.array(F.struct(C("new").alias("match"), F.lit(1).alias("sign")), F.struct(C("old").alias("match"), F.lit(-1).alias("sign")))
    matches = changes.select(F.inline(signed)).filter("match.season IS NOT NULL AND match.match_id IS NOT NULL").select("match.*", "sign")
    result = m.staged_result(C("home_goals"), C("away_goals"))
    won, drawn = [_flag(result == r) for r in (fixed.HOME_WIN, fixed.AWAY_WIN)], _flag(result == fixed.DRAW)
    none = F.lit(0)
    home = {
        "team": C("home_team"), "sign": C("sign"), "won": won[0], "drawn": drawn, "lost": won[1],
        "gf": F.coalesce("home_goals", none), "ga": F.coalesce("away_goals", none),
    }
    away = {
        "team": C("away_team"), "sign": C("sign"), "won": won[1], "drawn": drawn, "lost": won[0],
        "gf": F.coalesce("away_goals", none), "ga": F.coalesce("home_goals", none),
    }
    rows = _both_sides(matches, home, away)
    sums = [F.sum("sign").alias("played"), *[F.sum(C("sign") * C(c)).alias(c) for c in _TOTALS[1:]]]
    return rows.groupBy("season", "team").agg(*sums)


def standings_after(totals: DataFrame, changed: DataFrame) -> DataFrame:
    """The mart rows of the seasons in `totals` after their signed changes: sums added, empty rows gone, places given anew."""
    both = totals.select("season", "team", *_TOTALS).unionByName(changed.select("season", "team", *_TOTALS))
    sums = both.groupBy("season", "team").agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in _TOTALS]).filter("played > 0")
    return _placed(sums.withColumn("gd", C("gf") - C("ga")).withColumn("points", C("won") * fixed.POINTS_WIN + C("drawn") * fixed.POINTS_DRAW))


def new_seasons_only(matches: DataFrame, built: DataFrame) -> DataFrame:
    """Matches of seasons the mart does not hold yet.

    A NULL season in the mart excludes nothing; a match without a season is never new, or every run would add it
    again. The mart's seasons are its partitions, which Spark lists on the driver anyway; as a literal filter they
    prune the lake's season directories before any file is opened.
    """
    seasons = built.select("season").where(C("season").isNotNull()).distinct()
    listed = [row.season for row in seasons.collect()]
    named = matches.filter(C("season").isNotNull())
    return named.filter(~C("season").isin(listed)) if listed else named


def standings_increment(
    matches: DataFrame, built: DataFrame, refresh_seasons: Sequence[str] = ()
) -> DataFrame:
    """The mart after an incremental run: built seasons stay, new (and explicitly refreshed) ones are computed."""
    kept = built.filter(~C("season").isin(list(refresh_seasons))) if refresh_seasons else built
    added = standings_mart(new_seasons_only(matches, kept))
    return kept.unionByName(added, allowMissingColumns=True)


def standings_points(matches: DataFrame) -> DataFrame:
    """Points straight from goals, without result flags; incomparable goals earn none."""
    def earned(own: Column, other: Column) -> Column:
        return F.when(own > other, fixed.POINTS_WIN).when(own == other, fixed.POINTS_DRAW).otherwise(0)

    home = {
        "team": C("home_team"), "pts": earned(C("home_goals"), C("away_goals")),
        "gf": C("home_goals"), "ga": C("away_goals"),
    }
    away = {
        "team": C("away_team"), "pts": earned(C("away_goals"), C("home_goals")),
        "gf": C("away_goals"), "ga": C("home_goals"),
    }
    return (
        _both_sides(matches, home, away)
        .groupBy("season", "team")
        .agg(
            F.sum("pts").alias("points"),
            F.sum("gf").alias("goals_for"),
            F.sum("ga").alias("goals_against"),
            (F.sum("gf") - F.sum("ga")).alias("goal_diff"),
            F.count(F.lit(1)).alias("matches_played"),
        )
    )


def team_season_stats(staged: DataFrame) -> DataFrame:
    """Season totals read off the winner's name: own name is a win, no name a draw, another name a loss."""
    home = {"team": C("home_team"), "gf": C("home_goals"), "ga": C("away_goals"), "winner": C("winning_team")}
    away = {"team": C("away_team"), "gf": C("away_goals"), "ga": C("home_goals"), "winner": C("winning_team")}
    won, drawn = C("winner") == C("team"), C("winner").isNull()
    points = F.when(won, fixed.POINTS_WIN).when(drawn, fixed.POINTS_DRAW).otherwise(0)
    return (
        _both_sides(staged, home, away)
        .groupBy("team", "season")
        .agg(
            F.sum(_flag(won)).alias("wins"),
            F.sum(_flag(drawn)).alias("draws"),
            F.sum(_flag(C("winner") != C("team"))).alias("losses"),
            F.sum("gf").alias("goals_for"),
            F.sum("ga").alias("goals_against"),
            F.sum(points).alias("points"),
        )
    )


def team_summary(matches: DataFrame, ordered: bool = True) -> DataFrame:
    """Per team over all seasons, with mean possession to one digit (half to even, 0.0 if never recorded).

    Possession is summed as a decimal, so the mean does not depend on the order in which partitions arrive.
    """
    share = C("possession").cast("decimal(18,6)")
    mean = F.bround(C("possession_sum").cast("double") / C("possession_n"), 1)
    table = _tally(
        team_rows(matches, possession=True),
        ["team"],
        F.sum(share).alias("possession_sum"),
        F.count("possession").alias("possession_n"),
    )
    summary = (
        table.withColumn("avg_possession", F.when(C("possession_n") > 0, mean).otherwise(0.0))
        .drop("possession_sum", "possession_n")
        .withColumnsRenamed(_LONG_NAMES)
    )
    return summary.orderBy(F.desc("points"), F.desc("goal_diff"), "team") if ordered else summary


def numbered_summary(matches: DataFrame) -> DataFrame:
    """The summary with each team's place in it."""
    return number_rows(team_summary(matches, ordered=False), F.desc("points"), F.desc("goal_diff"), C("team"))


def team_stats(matches: DataFrame, team: str) -> DataFrame:
    """One team's totals, or no row; other teams' matches are dropped at the scan."""
    own = matches.filter((C("home_team") == team) | (C("away_team") == team))
    return _tally(team_rows(own).filter(C("team") == team), ["team"]).withColumnsRenamed(_LONG_NAMES)


def team_stats_or_raise(matches: DataFrame, team: str) -> DataFrame:
    stats = team_stats(matches, team)
    if stats.isEmpty():
        raise ValueError(f"team {team!r} does not occur in the matches")
    return stats


def season_table(matches: DataFrame, season: str) -> DataFrame:
    """One season's ranked table in order; the season filter reaches the scan."""
    return standings_ranked(matches).filter(C("season") == season).orderBy("position", "team")


def team_history(matches: DataFrame, team: str) -> DataFrame:
    """One team's row in every season's ranked table."""
    return standings_ranked(matches).filter(C("team") == team).orderBy("season")


def distinct_teams(matches: DataFrame) -> DataFrame:
    return matches.select(F.explode(F.array("home_team", "away_team")).alias("team")).distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def register_views(matches: DataFrame) -> None:
    """Expose the matches and the analytic views by name for SQL; running it again replaces them."""
    from touchline.operators.reports import head_to_head, referee_stats

    enriched = enrich(matches)
    views = {
        "matches": enriched,
        "stg_matches": stage_matches(matches),
        "standings": standings_ranked(matches),
        "referee_stats": referee_stats(enriched),
        "head_to_head": head_to_head(matches),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)


def drop_views(spark) -> None:
    for name in ("head_to_head", "referee_stats", "standings", "stg_matches", "matches"):
        spark.catalog.dropTempView(name)
