"""The SQL each registered query is compared with: plain single-node statements over the same tables.

Written independently of the operators: unions where they explode, whole-series windows where they use buckets,
joins where they aggregate.
"""

from __future__ import annotations

_MATCHES = """
base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_orderstatus AS status, CAST(o.o_orderdate AS DATE) AS match_date,
         c.c_nationkey AS hn, CAST((c.c_nationkey + 1 + o.o_orderkey % 24) % 25 AS INT) AS an,
         CASE WHEN month(o.o_orderdate) >= 8 THEN year(o.o_orderdate) ELSE year(o.o_orderdate) - 1 END AS sy
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
keyed AS (
  SELECT concat('m', CAST(k AS VARCHAR)) AS match_id, strftime(match_date, '%Y-%m-%d') AS match_date,
         concat(CAST(sy AS VARCHAR), '-', substr(CAST(sy + 1 AS VARCHAR), 3, 2)) AS season,
         h.n_name AS home_team, a.n_name AS away_team,
         CAST((k * 7 + ck) % 5 AS INT) AS home_goals, CAST((k * 3 + ck * 11) % 4 AS INT) AS away_goals,
         CASE WHEN k % 11 = 0 THEN NULL ELSE CAST((k * 7 + ck) % 5 + 3 + ck % 12 AS INT) END AS home_shots,
         CASE WHEN k % 17 = 0 THEN NULL ELSE CAST((k * 3 + ck * 11) % 4 + ck % 9 AS INT) END AS away_shots,
         CASE WHEN k % 19 = 0 THEN NULL ELSE CAST(300 + ck % 400 AS DOUBLE) / CAST(10 AS DOUBLE) END AS home_possession,
         CASE WHEN k % 19 = 0 THEN NULL ELSE CAST(700 - ck % 400 AS DOUBLE) / CAST(10 AS DOUBLE) END AS away_possession,
         concat('Stadium ', h.n_name) AS stadium,
         CASE WHEN k % 13 = 0 THEN NULL ELSE concat('Ref', CAST(ck % 20 AS VARCHAR)) END AS referee,
         k, status
  FROM base JOIN nation h ON base.hn = h.n_nationkey JOIN nation a ON base.an = a.n_nationkey),
matches AS (SELECT * EXCLUDE (k, status) FROM keyed)"""

_SENT = """
sent AS (
  SELECT *, 2 * k + (delay > 0)::INT AS nr,
         CASE WHEN k % 29 = 0 THEN 'n/a' ELSE CAST(home_goals + (status = 'P' AND delay = 0)::INT AS VARCHAR) END AS goals
  FROM (SELECT *, 0 AS delay FROM keyed UNION ALL SELECT *, 3600 FROM keyed WHERE status = 'P'))"""

_DERIVED = """
  CASE WHEN home_goals > away_goals THEN 'home_win' WHEN away_goals > home_goals THEN 'away_win' ELSE 'draw' END
    AS result,
  home_goals + away_goals AS total_goals, home_goals - away_goals AS goal_diff,
  home_goals + away_goals >= 4 AS high_scoring,
  CASE WHEN home_shots > 0 THEN round_even(home_goals / home_shots, 3) ELSE 0.0 END AS home_shot_acc,
  CASE WHEN away_shots > 0 THEN round_even(away_goals / away_shots, 3) ELSE 0.0 END AS away_shot_acc,
  CASE WHEN home_possession >= away_possession THEN home_team ELSE away_team END AS dominant_team,
  concat(home_team, ' ', home_goals, '-', away_goals, ' ', away_team) AS match_label"""

_ENRICHED = f"{_MATCHES}, enriched AS (SELECT *, {_DERIVED} FROM matches)"

_SIDES = f"""{_ENRICHED},
sides AS (
  SELECT season, home_team AS team, (result = 'home_win')::INT AS win, (result = 'draw')::INT AS draw,
         (result = 'away_win')::INT AS loss, home_goals AS gf, away_goals AS ga, home_possession AS possession
  FROM enriched
  UNION ALL
  SELECT season, away_team, (result = 'away_win')::INT, (result = 'draw')::INT, (result = 'home_win')::INT,
         away_goals, home_goals, away_possession
  FROM enriched)"""

_SUMS = """count(*) AS played, sum(win)::BIGINT AS wins, sum(draw)::BIGINT AS draws, sum(loss)::BIGINT AS losses,
  sum(gf)::BIGINT AS goals_for, sum(ga)::BIGINT AS goals_against, (sum(gf) - sum(ga))::BIGINT AS goal_diff,
  (sum(win) * 3 + sum(draw))::BIGINT AS points"""

_RANKED = f"""{_SIDES},
tallied AS (SELECT team, season, {_SUMS} FROM sides GROUP BY team, season),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY season ORDER BY points DESC, goal_diff DESC)::BIGINT AS position FROM tallied)"""

_MART = f"""{_RANKED},
mart AS (
  SELECT season, team, played, wins AS won, draws AS drawn, losses AS lost, goals_for AS gf, goals_against AS ga,
         goal_diff AS gd, points,
         row_number() OVER (PARTITION BY season ORDER BY points DESC, goal_diff DESC, goals_for DESC, team)::BIGINT
           AS position
  FROM tallied)"""

_DEFECTIVE = f"""{_MATCHES},
damaged AS (
  SELECT * REPLACE (
    CASE WHEN k % 101 = 0 THEN NULL ELSE match_id END AS match_id,
    CASE WHEN k % 97 = 0 THEN -1 - home_goals ELSE home_goals END AS home_goals,
    CASE WHEN k % 103 = 0 THEN home_team ELSE away_team END AS away_team,
    CASE WHEN k % 107 = 0 THEN 'unknown' ELSE season END AS season)
  FROM keyed),
defective AS (
  SELECT * EXCLUDE (k, status) FROM damaged
  UNION ALL SELECT * EXCLUDE (k, status) FROM damaged WHERE k % 89 = 0)"""

_BROKEN = (
    "match_id IS NULL OR home_goals < 0 OR home_team = away_team OR NOT regexp_matches(season, '^[0-9]{4}-[0-9]{2}$')"
)

_MERGE = f"""{_MATCHES},
old AS (SELECT *, {_DERIVED} FROM keyed WHERE status IN ('F', 'P')),
sent AS (
  SELECT * REPLACE (CASE WHEN status = 'P' THEN home_goals + 1 ELSE home_goals END AS home_goals)
  FROM keyed WHERE status IN ('P', 'O')),
new AS (SELECT *, {_DERIVED} FROM sent)"""

_RUNS = """
runs AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS stage, ts AS start_ts, value AS seconds,
         event_id % 7 <> 0 AS ended, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS end_ts
  FROM events),
limits(stage, expected_sec) AS (VALUES ('signup', 60), ('click', 45), ('view', 30), ('error', 20))"""

_ENDED = f"""{_RUNS},
over AS (
  SELECT run_id, stage, expected_sec, epoch_us(end_ts) - epoch_us(start_ts) AS micros, end_ts AS breached
  FROM runs JOIN limits USING (stage) WHERE ended)"""

_OPEN = f"""{_RUNS},
over AS (
  SELECT run_id, stage, expected_sec,
         epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(start_ts) AS micros,
         TIMESTAMP '2024-02-01 00:00:00' AS breached
  FROM runs JOIN limits USING (stage) WHERE NOT ended)"""

_BREACHES = """
SELECT run_id, stage, expected_sec, round_even(micros / 1000.0, 0) / 1000.0 AS actual_sec,
       round_even((micros - expected_sec * 1000000) / 1000.0, 0) / 1000.0 AS overrun_sec,
       CASE WHEN micros >= 2 * expected_sec * 1000000 THEN 'critical'
            WHEN micros * 2 >= 3 * expected_sec * 1000000 THEN 'high' ELSE 'warning' END AS severity,
       strftime(breached, '%Y-%m-%d %H:%M:%S.%f') AS breach_time,
       'SLA breach on stage ''' || stage || '''' AS summary,
       printf('Stage ''%s'' took %.1fs (SLA=%ds, overrun=%.1fs)', stage, round(micros / 100000.0) / 10.0, expected_sec,
              round((micros - expected_sec * 1000000) / 100000.0) / 10.0) AS description
FROM over WHERE micros > expected_sec * 1000000"""

_SAMPLES = """
samples AS (
  SELECT ts, event_type AS metric, 'user=' || CAST(user_id % 10 AS VARCHAR) AS series, value FROM events)"""

_GROWTH = f"""{_SAMPLES},
steps AS (SELECT *, lag(value) OVER (PARTITION BY metric, series ORDER BY ts) AS previous FROM samples),
grown AS (
  SELECT metric, series, ts,
         sum(CASE WHEN previous IS NULL THEN 0 WHEN value < previous THEN value ELSE value - previous END)
           OVER (PARTITION BY metric, series ORDER BY ts) AS total
  FROM steps),
windowed AS (
  SELECT metric, series, ts, round(total - first_value(total) OVER (
           PARTITION BY metric, series ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW), 6)
           AS increase
  FROM grown)"""



def _growth(seconds: int, name: str, first: bool = True) -> str:
    """Growth over the trailing window, summed anew for each sample over the pairs inside it."""
    steps = f"""{_SAMPLES},
steps AS (SELECT *, lag(value) OVER (PARTITION BY metric, series ORDER BY ts) AS previous FROM samples),
grown AS (
  SELECT metric, series, ts,
         sum(CASE WHEN previous IS NULL THEN 0 WHEN value < previous THEN value ELSE value - previous END)
           OVER (PARTITION BY metric, series ORDER BY ts) AS total
  FROM steps),"""
    return f"""{steps if first else ""}
{name} AS (
  SELECT metric, series, ts, round(total - first_value(total) OVER (
           PARTITION BY metric, series ORDER BY ts RANGE BETWEEN INTERVAL {seconds} SECOND PRECEDING AND CURRENT ROW), 9)
           AS increase
  FROM grown)"""


_STRETCHES = """
islands AS (
  SELECT *, sum((NOT breach)::INT) OVER (PARTITION BY alert, series ORDER BY ts) AS island FROM states),
stretches AS (
  SELECT alert, severity, hold, series, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS samples, max(value) AS peak
  FROM islands WHERE breach GROUP BY alert, severity, hold, series, island)"""

_HELD = """
SELECT alert, severity, series, strftime(start_ts, '%Y-%m-%d %H:%M:%S.%f') AS start_ts,
       strftime(end_ts, '%Y-%m-%d %H:%M:%S.%f') AS end_ts, (epoch_us(end_ts) - epoch_us(start_ts)) / 1000000.0 AS held_sec,
       samples, round(peak, 6) AS peak
FROM stretches WHERE (epoch_us(end_ts) - epoch_us(start_ts)) / 1000000.0 >= hold"""

_ALERTS = f"""{_SAMPLES},
clauses AS (
  SELECT 'SlowClicks' AS alert, 21600 AS hold, series, ts, value, value > 40 AS breach
  FROM samples WHERE metric = 'click'
  UNION ALL
  SELECT 'ErrorsOrViews', 10800, series, ts, value, CASE WHEN metric = 'error' THEN value > 30 ELSE abs(value) < 5 END
  FROM samples WHERE metric IN ('error', 'view')
  UNION ALL
  SELECT 'UserThreeSignups', 0, series, ts, value, value >= 20
  FROM samples WHERE metric = 'signup' AND series = 'user=3'),
states AS (
  SELECT alert, hold, series, ts, bool_or(breach) AS breach, max(value) FILTER (WHERE breach) AS value
  FROM clauses GROUP BY ALL),
islands AS (
  SELECT *, sum((NOT breach)::INT) OVER (PARTITION BY alert, series ORDER BY ts) AS island FROM states),
stretches AS (
  SELECT alert, hold, series, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS samples, max(value) AS peak
  FROM islands WHERE breach GROUP BY alert, hold, series, island)"""

_SUITE = f"""{_DEFECTIVE},
counted AS (
  SELECT count(*) AS n, count(*) FILTER (match_id IS NULL) AS no_id, count(*) FILTER (home_goals < 0) AS below,
         count(*) FILTER (NOT regexp_matches(season, '^[0-9]{{4}}-[0-9]{{2}}$')) AS bad_season,
         count(*) FILTER (home_team = away_team) AS same
  FROM defective),
shared AS (
  SELECT coalesce(sum(c), 0)::BIGINT AS n
  FROM (SELECT count(*) AS c FROM defective WHERE match_id IS NOT NULL GROUP BY match_id HAVING count(*) > 1))"""

_NULLABLE = ["home_shots", "away_shots", "home_possession", "away_possession", "referee"]
_FULL = ["match_id", "match_date", "season", "home_team", "away_team", "home_goals", "away_goals", "stadium"]
_MART_COLUMNS = ["season", "team", "played", "won", "drawn", "lost", "gf", "ga", "gd", "points", "position"]


def _sql(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _null_profile() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS row_count FROM matches"
        for c in _FULL + _NULLABLE
    ]
    return _sql(_MATCHES, "\nUNION ALL ".join(parts))


def _expectations() -> str:
    prefix = "expect_column_values_to_"
    rules = [
        ("expect_table_columns_to_match_ordered_list", "", "0", "counted"),
        *[
            (prefix + "not_be_null", c, "no_id" if c == "match_id" else "0", "counted")
            for c in ["match_id", "season", "home_team", "away_team", "home_goals", "away_goals"]
        ],
        (prefix + "be_unique", "match_id", "n", "shared"),
        (prefix + "be_of_type", "home_goals", "0", "counted"),
        (prefix + "be_of_type", "away_goals", "0", "counted"),
        (prefix + "be_between", "home_goals", "below", "counted"),
        (prefix + "be_between", "away_goals", "0", "counted"),
        (prefix + "match_regex", "season", "bad_season", "counted"),
        ("expect_table_row_count_to_be_between", "", "CASE WHEN n BETWEEN 1 AND 500 THEN 0 ELSE n END", "counted"),
        ("expect_column_pair_values_to_not_be_equal", "home_team,away_team", "same", "counted"),
    ]
    parts = [
        f"SELECT {i} AS position, '{name}' AS expectation, '{column}' AS \"column\", ({count}) = 0 AS success, "
        f"CAST({count} AS BIGINT) AS unexpected_count FROM {table}"
        for i, (name, column, count, table) in enumerate(rules, start=1)
    ]
    return _sql(_SUITE, "\nUNION ALL ".join(parts))


def _column_tests() -> str:
    def row(table: str, column: str, test: str, count: str) -> str:
        return (
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test, ({count})::BIGINT AS failures, "
            f"({count}) = 0 AS passed"
        )

    def nulls(table: str, column: str) -> str:
        return f"SELECT count(*) FROM {table} WHERE {column} IS NULL"

    source = ["match_id", "season", "home_team", "away_team", "home_goals", "away_goals"]
    repeated = (
        "SELECT count(*) FROM (SELECT match_id FROM defective WHERE match_id IS NOT NULL "
        "GROUP BY match_id HAVING count(*) > 1)"
    )
    parts = [row("matches", c, "not_null", nulls("defective", c)) for c in source]
    parts.append(row("matches", "match_id", "unique", repeated))
    parts.append(
        "SELECT 'matches' AS table_name, 'matchday' AS column_name, 'not_null' AS test, NULL::BIGINT AS failures, "
        "false AS passed"
    )
    parts += [row("standings", c, "not_null", nulls("mart", c)) for c in _MART_COLUMNS]
    defective = _DEFECTIVE[len(_MATCHES):]
    return _sql(_MART + defective, "\nUNION ALL ".join(parts))


_QUALITY = f"""
SELECT 'row_count_reconciliation' AS check_name, abs(sent - stored) <= 100 AS passed,
       printf('kafka_offsets=%d, delta_rows=%d, diff=%d, tolerance=%d', sent, stored, abs(sent - stored), 100) AS details
FROM (SELECT (SELECT count(*) FROM orders) AS sent, (SELECT count(*) FROM keyed WHERE status <> 'O') AS stored)
UNION ALL
SELECT 'duplicate_primary_keys', n = 0, printf('table=%s, pk=%s, duplicate_groups=%d', 'matches', 'match_id', n)
FROM (SELECT count(*) AS n FROM (SELECT match_id FROM defective GROUP BY match_id HAVING count(*) > 1))
UNION ALL
SELECT 'referential_integrity', n = 0,
       printf('mart=%s, source=%s, orphaned_mart_rows=%d', 'lineitem', 'orders', n)
FROM (SELECT count(*) AS n FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'O') o
        ON l_orderkey = o_orderkey WHERE o_orderkey IS NULL)
UNION ALL
SELECT 'data_freshness', age <= 90000,
       printf('table=%s, latest_ts=%s, age_seconds=%d, threshold_seconds=%d', 'events',
              strftime(latest, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00', CAST(round(age) AS BIGINT), 90000)
FROM (SELECT max(ts) AS latest,
             (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(ts))) / 1000000.0 AS age FROM events)
UNION ALL
SELECT DISTINCT 'broken_check', false, 'Query failed:' FROM orders"""

_REASONS = """concat_ws(',', CASE WHEN match_id IS NULL THEN 'match_id_missing' END,
  CASE WHEN home_goals < 0 THEN 'home_goals_negative' END, CASE WHEN home_team = away_team THEN 'same_team' END,
  CASE WHEN NOT regexp_matches(season, '^[0-9]{4}-[0-9]{2}$') THEN 'season_malformed' END)"""

_WINNER = "CASE WHEN home_goals > away_goals THEN home_team WHEN away_goals > home_goals THEN away_team END"

ORACLE_SQL: dict[str, str] = {
    "enrich_matches": _sql(_ENRICHED, "SELECT * FROM enriched"),
    "stg_matches": _sql(
        _ENRICHED,
        f"SELECT match_id, season, home_team, away_team, home_goals, away_goals, {_WINNER} AS winning_team, "
        "result AS result_type FROM enriched WHERE match_id IS NOT NULL",
    ),
    "stg_matches_coded": _sql(
        _ENRICHED,
        "SELECT match_id, season, home_team, away_team, home_goals, away_goals, match_date, referee, "
        f"coalesce({_WINNER}, 'Draw') AS winning_team, "
        "CASE result WHEN 'home_win' THEN 'H' WHEN 'away_win' THEN 'A' ELSE 'D' END AS result_type FROM enriched",
    ),
    "team_result_rows": _sql(_SIDES, "SELECT season, team, win, draw, loss, gf, ga FROM sides"),
    "standings_view_rank": _sql(_RANKED, "SELECT * FROM ranked"),
    "standings_mart": _sql(_MART, "SELECT * FROM mart"),
    "standings_incremental": _sql(_MART, "SELECT * FROM mart"),
    "footer_profile": _sql(
        _MATCHES,
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) AS \"rows\", count({c}) AS known, CAST(min({c}) AS VARCHAR) AS low, "
            f"CAST(max({c}) AS VARCHAR) AS high FROM matches"
            for c in ("match_date", "home_goals", "home_shots", "home_possession", "referee")
        ),
    ),
    "standings_from_changes": _sql(
        _MART.replace(
            "matches AS (SELECT * EXCLUDE (k, status) FROM keyed)",
            "matches AS (SELECT * EXCLUDE (k, status) REPLACE (home_goals + (status = 'P')::INT AS home_goals) FROM keyed "
            "WHERE status <> 'F' OR k % 7 <> 0)",
        ),
        "SELECT * FROM mart",
    ),
    "standings_points_only": _sql(
        _SIDES,
        "SELECT season, team, (sum(win) * 3 + sum(draw))::BIGINT AS points, sum(gf)::BIGINT AS goals_for, "
        "sum(ga)::BIGINT AS goals_against, (sum(gf) - sum(ga))::BIGINT AS goal_diff, count(*) AS matches_played "
        "FROM sides GROUP BY season, team",
    ),
    "team_season_stats": _sql(
        _RANKED, "SELECT team, season, wins, draws, losses, goals_for, goals_against, points FROM tallied"
    ),
    "team_summary": _sql(
        _SIDES,
        f"SELECT *, row_number() OVER (ORDER BY points DESC, goal_diff DESC, team) AS position FROM ("
        f"SELECT team, {_SUMS}, CASE WHEN count(possession) > 0 THEN round_even("
        "CAST(sum(CAST(possession AS DECIMAL(18, 6))) AS DOUBLE) / count(possession), 1) ELSE 0.0 END "
        "AS avg_possession FROM sides GROUP BY team)",
    ),
    "team_stats_one": _sql(_SIDES, f"SELECT team, {_SUMS} FROM sides WHERE team = 'NATION_7' GROUP BY team"),
    "team_history": _sql(_RANKED, "SELECT * FROM ranked WHERE team = 'NATION_7'"),
    "season_table_one": _sql(_RANKED, "SELECT * FROM ranked WHERE season = '1997-98'"),
    "referee_summary": _sql(
        _ENRICHED,
        "SELECT referee, count(total_goals) AS matches, round_even(avg(total_goals), 2) AS avg_goals "
        "FROM enriched WHERE referee IS NOT NULL GROUP BY referee",
    ),
    "referee_stats": _sql(
        _ENRICHED,
        "SELECT referee, count(*) AS matches, round(avg(total_goals), 2) AS avg_goals, "
        "count(*) FILTER (high_scoring) AS high_scoring_games, max(total_goals) AS max_goals_in_game "
        "FROM enriched WHERE referee IS NOT NULL GROUP BY referee",
    ),
    "head_to_head": _sql(
        _MATCHES,
        "SELECT least(home_team, away_team) AS team_a, greatest(home_team, away_team) AS team_b, "
        "count(*) AS meetings, sum(home_goals + away_goals)::BIGINT AS total_goals, "
        "round(avg(home_goals + away_goals), 2) AS avg_goals FROM matches GROUP BY team_a, team_b",
    ),
    "top_matches": _sql(
        _ENRICHED,
        "SELECT match_label, total_goals, match_date FROM enriched ORDER BY total_goals DESC, match_id LIMIT 5",
    ),
    "high_scoring_matches": _sql(
        _ENRICHED, "SELECT match_label, total_goals, match_date, stadium FROM enriched WHERE total_goals >= 4"
    ),
    "distinct_teams": _sql(_MATCHES, "SELECT home_team AS team FROM matches UNION SELECT away_team FROM matches"),
    "distinct_seasons": _sql(_MATCHES, "SELECT DISTINCT season FROM matches"),
    "distinct_result_codes": _sql(
        _ENRICHED,
        "SELECT DISTINCT CASE result WHEN 'home_win' THEN 'H' WHEN 'away_win' THEN 'A' ELSE 'D' END AS result_type "
        "FROM enriched",
    ),
    "null_profile": _null_profile(),
    "expectation_results": _expectations(),
    "column_test_results": _column_tests(),
    "negative_goal_violations": _sql(
        _DEFECTIVE, "SELECT match_id, home_goals, away_goals FROM defective WHERE home_goals < 0 OR away_goals < 0"
    ),
    "quality_run_all": _sql(_DEFECTIVE, _QUALITY),
    "valid_rows": _sql(_DEFECTIVE, f"SELECT * FROM defective WHERE NOT coalesce({_BROKEN}, FALSE)"),
    "quarantined_rows": _sql(_DEFECTIVE, f"SELECT *, {_REASONS} AS reasons FROM defective WHERE {_BROKEN}"),
    "csv_multi_file": _sql(_MATCHES, "SELECT * FROM matches"),
    "lake_roundtrip": _sql(
        _ENRICHED,
        "SELECT match_label, total_goals, match_date, stadium, season FROM enriched "
        "WHERE total_goals >= 4 AND season >= '1998'",
    ),
    "merge_upsert": _sql(
        _MERGE,
        "SELECT * EXCLUDE (k, status) FROM old WHERE status = 'F' UNION ALL SELECT * EXCLUDE (k, status) FROM new",
    ),
    "merge_insert_only": _sql(
        _MERGE,
        "SELECT * EXCLUDE (k, status) FROM old UNION ALL SELECT * EXCLUDE (k, status) FROM new WHERE status = 'O'",
    ),
    "merge_partial": _sql(
        _MERGE,
        "SELECT * EXCLUDE (k, status) FROM old WHERE status = 'F' "
        "UNION ALL SELECT old.* EXCLUDE (k, status) REPLACE (new.home_goals AS home_goals, "
        "new.away_goals AS away_goals, new.result AS result, new.total_goals AS total_goals) "
        "FROM old JOIN new USING (match_id) "
        "UNION ALL SELECT * EXCLUDE (k, status) FROM new WHERE status = 'O'",
    ),
    "lake_merge_upsert": _sql(
        _MERGE,
        "SELECT * EXCLUDE (k, status) FROM keyed WHERE status = 'F' "
        "UNION ALL SELECT * EXCLUDE (k, status) FROM sent",
    ),
    "message_payload": _sql(
        _MATCHES,
        "SELECT season || ':' || match_id AS key, CAST(json_object("
        + ", ".join(
            f"'{c}', CAST({c} AS VARCHAR)"
            for c in [
                "match_id", "match_date", "season", "home_team", "away_team", "home_goals", "away_goals", "home_shots",
                "away_shots", "home_possession", "away_possession", "stadium", "referee",
            ]
        )
        + ") AS VARCHAR) AS value FROM matches",
    ),
    "parse_messages": _sql(
        _MATCHES,
        "SELECT match_id, season, home_team, away_team, CASE WHEN k % 29 <> 0 THEN home_goals + (status = 'P' AND delay = 0)::INT END "
        "AS home_goals, away_goals, strftime(make_timestamp((k + delay) * 1000000), '%Y-%m-%d %H:%M:%S.%f') AS kafka_timestamp "
        "FROM (SELECT *, 0 AS delay FROM keyed UNION ALL SELECT *, 3600 FROM keyed WHERE status = 'P') "
        "WHERE k % 23 <> 0",
    ),
    "stream_ingest_once": _sql(
        _MATCHES,
        "SELECT match_id, season, home_team, away_team, CASE WHEN k % 29 <> 0 THEN home_goals + (status = 'P')::INT END "
        "AS home_goals, away_goals, strftime(make_timestamp(k * 1000000), '%Y-%m-%d %H:%M:%S.%f') AS kafka_timestamp "
        "FROM keyed WHERE k % 23 <> 0",
    ),
    "stream_rejects": _sql(
        f"{_MATCHES}, {_SENT}",
        "SELECT concat(k % 4, ':', nr) AS place, CASE WHEN k % 23 = 0 THEN 'malformed' ELSE 'without_key' END AS reason, "
        "CASE WHEN k % 23 = 0 THEN 'NOT JSON {' ELSE CAST(json_object('match_id', ' ', 'season', season, 'home_team', home_team, "
        "'away_team', away_team, 'home_goals', goals, 'away_goals', CAST(away_goals AS VARCHAR)) AS VARCHAR) END AS value, "
        "strftime(make_timestamp((k + delay) * 1000000), '%Y-%m-%d %H:%M:%S.%f') AS kafka_timestamp, "
        "CAST(k % 4 AS INT) AS kafka_partition, CAST(nr AS BIGINT) AS kafka_offset FROM sent WHERE k % 23 = 0 OR k % 41 = 0",
    ),
    "stream_counts": _sql(
        f"{_MATCHES}, {_SENT}",
        "SELECT run::BIGINT AS run, count(*) AS messages, count(*) FILTER (k % 23 = 0) AS malformed, "
        "count(*) FILTER (k % 23 <> 0 AND k % 41 = 0) AS without_key, "
        "count(DISTINCT match_id) FILTER (k % 23 <> 0 AND k % 41 <> 0 AND k % 2 = run) AS merged, 'target' AS ended "
        "FROM sent JOIN (VALUES (0), (1)) AS runs(run) ON run = 1 OR k % 2 = 0 GROUP BY run",
    ),
    "staging_upsert": _sql(
        _MATCHES,
        "SELECT match_id, season, home_team, away_team, CASE WHEN k % 29 <> 0 THEN home_goals END AS home_goals, away_goals, "
        "strftime(make_timestamp((k + CASE WHEN status = 'P' THEN 3600 ELSE 0 END) * 1000000), '%Y-%m-%d %H:%M:%S.%f') "
        "AS kafka_timestamp FROM keyed WHERE k % 23 <> 0",
    ),
    "unscored_matches": _sql(_MATCHES, "SELECT * EXCLUDE (k, status) FROM keyed WHERE status <> 'F'"),
    "features": _sql(
        f"""{_MATCHES},
complete AS (SELECT * FROM keyed WHERE k % 31 <> 0 AND k % 37 <> 0),
teams AS (
  SELECT team, CAST(row_number() OVER (ORDER BY team) - 1 AS DOUBLE) AS code
  FROM (SELECT home_team AS team FROM complete UNION SELECT away_team FROM complete)),
seasons AS (
  SELECT season, CAST(row_number() OVER (ORDER BY season) - 1 AS DOUBLE) AS code
  FROM (SELECT DISTINCT season FROM complete))""",
        "SELECT match_id, h.code AS home_team_enc, a.code AS away_team_enc, s.code AS season_enc, "
        "CAST(home_goals - away_goals AS DOUBLE) AS goal_diff_hist, "
        "CAST(CASE WHEN home_goals > away_goals THEN 2 WHEN home_goals = away_goals THEN 1 ELSE 0 END AS DOUBLE) AS label "
        "FROM complete m JOIN teams h ON m.home_team = h.team JOIN teams a ON m.away_team = a.team "
        "JOIN seasons s ON m.season = s.season",
    ),
    "train_predict": _sql(
        _MATCHES,
        "SELECT match_id, CAST(CASE WHEN home_goals > away_goals THEN 2 WHEN home_goals = away_goals THEN 1 ELSE 0 END "
        "AS BIGINT) AS outcome, CAST(1.0 AS DOUBLE) AS probability_sum FROM keyed WHERE k % 31 <> 0 AND k % 37 <> 0",
    ),
    # The goal difference is a feature and decides the label, so every training row is told apart.
    "train_accuracy": _sql(_MATCHES, "SELECT DISTINCT CAST(1.0 AS DOUBLE) AS accuracy FROM matches"),
    "run_states": _sql(
        _RUNS,
        "SELECT run_id, stage AS job, strftime(start_ts, '%Y-%m-%d %H:%M:%S.%f') AS start_ts, "
        "CASE WHEN ended THEN strftime(end_ts, '%Y-%m-%d %H:%M:%S.%f') END AS end_ts, "
        "CASE WHEN NOT ended THEN 'RUNNING' WHEN stage = 'error' THEN 'FAIL' ELSE 'COMPLETE' END AS state, "
        "CASE WHEN ended THEN (epoch_us(end_ts) - epoch_us(start_ts)) / 1000000.0 END AS duration_sec FROM runs",
    ),
    "sla_breaches": _sql(_ENDED, _BREACHES),
    "sla_in_progress": _sql(_OPEN, _BREACHES),
    "breach_counts": _sql(
        _ENDED, f"SELECT stage, severity, count(*) AS breaches FROM ({_BREACHES}) GROUP BY stage, severity"
    ),
    "sustained_alerts": _sql(
        _ALERTS,
        "SELECT alert, 'warning' AS severity, series, strftime(start_ts, '%Y-%m-%d %H:%M:%S.%f') AS start_ts, "
        "strftime(end_ts, '%Y-%m-%d %H:%M:%S.%f') AS end_ts, "
        "(epoch_us(end_ts) - epoch_us(start_ts)) / 1000000.0 AS held_sec, samples, peak FROM stretches "
        "WHERE (epoch_us(end_ts) - epoch_us(start_ts)) / 1000000.0 >= hold",
    ),
    "increase_alerts": _sql(
        f"""{_growth(86400, "day")}, {_growth(21600, "quarter", False)},
states AS (
  SELECT 'ClicksGrew' AS alert, 'warning' AS severity, 3600 AS hold, series, ts, increase > 60 AS breach, increase AS value
  FROM day WHERE metric = 'click'
  UNION ALL
  SELECT 'UserTwoErrors', 'critical', 0, series, ts, increase > 0, increase
  FROM quarter WHERE metric = 'error' AND series = 'user=2'), {_STRETCHES}""",
        _HELD,
    ),
    "stalled_alerts": _sql(
        f"""{_growth(1800, "half")},
states AS (
  SELECT 'ViewsStalled' AS alert, 'warning' AS severity, 0 AS hold, series, ts, increase = 0 AS breach, increase / 1800 AS value
  FROM half WHERE metric = 'view'), {_STRETCHES}""",
        _HELD,
    ),
    "counter_increase": _sql(
        _GROWTH,
        "SELECT metric, series, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, increase FROM windowed",
    ),
    "counter_rate": _sql(
        _GROWTH.replace("RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW), 6)",
                        "RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW), 12)"),
        "SELECT metric, series, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, round(increase / 86400, 9) AS per_sec, "
        "increase = 0 AS stalled FROM windowed",
    ),
    "missing_series": _sql(
        _SAMPLES,
        "SELECT metric, series FROM samples GROUP BY metric, series "
        "HAVING count(*) FILTER (ts > TIMESTAMP '2024-01-30 23:33:20' AND ts <= TIMESTAMP '2024-02-01 00:00:00') = 0",
    ),
    "gauge_age": _sql(
        _SAMPLES,
        "SELECT metric, series, CAST(1706745600 AS DOUBLE) - floor(epoch_us(max(ts)) / 1000000.0) AS age_sec "
        "FROM samples GROUP BY metric, series HAVING 1706745600 - floor(epoch_us(max(ts)) / 1000000.0) > 88000",
    ),
    "metric_rollup": _sql(
        _SAMPLES,
        "SELECT metric, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, round(sum(value), 6) AS value "
        "FROM samples GROUP BY metric, ts",
    ),
}
