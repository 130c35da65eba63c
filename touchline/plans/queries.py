"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import fixed, schema
from touchline.operators import health, keyed, league, quality, reports, scoring
from touchline.operators.enrich import enrich, stage_matches, stage_matches_coded
from touchline.plans import batch, derived
from touchline.session import scratch_path
from touchline.sinks.kafka import to_messages
from touchline.sinks.lake import write_matches, write_table
from touchline.sinks.merge import merge_table, stage_messages
from touchline.sources.csv import load_matches
from touchline.sources.footers import table_profile
from touchline.sources.lake import read_lake
from touchline.streaming.ingest import Drained, drain, drain_until, parse_messages

Query = Callable[[SparkSession, str], DataFrame]
C = F.col

ONE_TEAM, ONE_SEASON = "NATION_7", "1997-98"
BUILT_BEFORE = "1998"
ALERT_RULES = [
    health.Rule("SlowClicks", "click", ">", 40.0, 6 * 3600),
    health.Rule("ErrorsOrViews", "error", ">", 30.0, 3 * 3600),
    health.Rule("ErrorsOrViews", "view", "<", 5.0, 3 * 3600, absolute=True),
    health.Rule("UserThreeSignups", "signup", ">=", 20.0, 0, labels={"user": "3"}),
]
GROWTH_RULES = [
    health.Rule("ClicksGrew", "click", ">", 60.0, 3600, window_sec=24 * 3600),
    health.Rule("UserTwoErrors", "error", ">", 0.0, 0, severity="critical", labels={"user": "2"}, window_sec=6 * 3600),
]
STALL_RULES = [health.Rule("ViewsStalled", "view", "==", 0.0, 0, window_sec=1800, per_second=True)]
DAY = 24 * 3600
SILENT_SEC = 88_000  # before the fixed instant; a part of the series has sent nothing since


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so that results compare equal across engines."""
    def plain(field):
        if isinstance(field.dataType, T.DateType):
            return F.date_format(field.name, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(field.name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        return C(field.name)

    timed = (T.DateType, T.TimestampType, T.TimestampNTZType)
    fields = df.schema.fields
    return df.select(*[plain(f) for f in fields]) if any(isinstance(f.dataType, timed) for f in fields) else df


# League tables and reports.


def on_matches(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(operator(derived.matches(spark, sf_dir)))


def on_enriched(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return on_matches(lambda matches: operator(enrich(matches)))


def standings_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the seasons are in the mart already, the rest are added."""
    matches = derived.matches(spark, sf_dir)
    built = league.standings_mart(matches.filter(C("season") < BUILT_BEFORE))
    return league.standings_increment(matches, built)


def with_long_sums(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, the one width both engines' sums and ranks cast to."""
    return df.select(
        *[C(f.name).cast("bigint").alias(f.name) if isinstance(f.dataType, T.IntegerType) else C(f.name)
          for f in df.schema.fields]
    )


# Quality.


def expectation_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    defective = derived.defective_matches(spark, sf_dir).select(*fixed.SUITE_COLUMNS)
    return quality.run_suite(defective, quality.match_suite())


def column_test_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = league.standings_mart(derived.matches(spark, sf_dir))
    return quality.column_tests({
        "matches": (derived.defective_matches(spark, sf_dir), fixed.SOURCE_COLUMN_TESTS),
        "standings": (mart, fixed.MART_COLUMN_TESTS),
    })


def quality_run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: derived.table(spark, sf_dir, name) for name in ("orders", "lineitem", "events")}
    defective = derived.defective_matches(spark, sf_dir)
    loaded = derived.matches_with(spark, sf_dir, "F", "P")
    return quality.run_checks(spark, {
        "row_count_reconciliation": lambda: quality.row_count_reconciliation(tables["orders"], loaded, 100),
        "duplicate_primary_keys": lambda: quality.duplicate_primary_keys(defective, "matches", "match_id"),
        "referential_integrity": lambda: quality.referential_integrity(
            tables["lineitem"], tables["orders"].filter("o_orderstatus <> 'O'"), "lineitem", "orders",
            "l_orderkey", "o_orderkey",
        ),
        "data_freshness": lambda: quality.data_freshness(tables["events"], "events", "ts", derived.as_of()),
        "broken_check": lambda: tables["orders"].agg(
            F.lit("broken_check").alias("check_name"), F.assert_true(F.count("*") < 0).isNull().alias("passed"),
            F.lit("").alias("details"),
        ),
    }).withColumn("details", F.when(C("check_name") == "broken_check", F.substring("details", 1, 13)).otherwise(C("details")))


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = quality.split_valid(derived.defective_matches(spark, sf_dir), quality.match_constraints())
    return portable(valid)


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, broken = quality.split_valid(derived.defective_matches(spark, sf_dir), quality.match_constraints())
    return portable(broken.withColumn("reasons", F.array_join("reasons", ",")))


# Files and merges.


def csv_multi_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches out to one CSV file per season and back in under the explicit schema, the season from the file's name."""
    folder = scratch_path(spark, "csv")
    raw = derived.matches(spark, sf_dir).withColumnRenamed("match_date", "date").select(*schema.RAW_CSV.names)
    unnamed = raw.withColumn("_file", C("season")).withColumn("season", F.lit("as the file says"))
    unnamed.repartition("_file").write.partitionBy("_file").option("header", True).csv(folder)
    _name_after_folders(spark, folder, "_file=")
    return portable(load_matches(spark, f"{folder}/*.csv", season_from_file=True))


def _name_after_folders(spark: SparkSession, folder: str, prefix: str) -> None:
    """Each partition folder's single file becomes a file of the folder's name."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.globStatus(path(f"{folder}/{prefix}*/part-*")):
        name = status.getPath().getParent().getName().removeprefix(prefix)
        files.rename(status.getPath(), path(f"{folder}/{name}.csv"))


def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched lake by season, then a pruned and filtered scan of it."""
    lake = scratch_path(spark, "lake")
    write_matches(enrich(derived.matches(spark, sf_dir)), lake)
    columns = ["match_label", "total_goals", "match_date", "stadium", "season"]
    wanted = (C("total_goals") >= fixed.HIGH_SCORING_TOTAL) & (C("season") >= BUILT_BEFORE)
    return portable(read_lake(spark, lake, columns=columns, where=wanted))


def on_merge(operator: Callable[..., DataFrame], *arguments) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        target = enrich(derived.merge_target(spark, sf_dir))
        source = derived.merge_source(spark, sf_dir)
        return portable(operator(target, enrich(source, "seq"), ["match_id"], *arguments, order_by=["seq"]))

    return run


def lake_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert against a stored table, applied twice: the second run must change nothing."""
    table = scratch_path(spark, "merge")
    write_table(derived.merge_target(spark, sf_dir), table)
    source = derived.merge_source(spark, sf_dir)
    for _ in range(2):
        merge_table(source, table, schema.MATCHES, ["match_id"], order_by=["seq"])
    return portable(read_lake(spark, table, schema.MATCHES))


def standings_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart brought up to date by changes alone: corrections downwards, late matches, then matches removed."""
    base = scratch_path(spark, "changes")
    lake, mart = f"{base}/matches", f"{base}/mart"
    higher = C("home_goals") + F.when(C("status") == "P", 3).otherwise(0)
    known = derived.match_base(spark, sf_dir).filter(C("status").isin("F", "P")).withColumn("home_goals", higher.cast("int"))
    write_table(known.select(*schema.MATCHES.names), lake, sort_by=["match_id"])
    batch.refresh_standings(spark, lake, mart)
    batch.merge_and_refresh(spark, derived.merge_source(spark, sf_dir), lake, mart, order_by=["seq"])
    removed = derived.match_base(spark, sf_dir).filter((C("status") == "F") & (C("k") % 7 == 0))
    batch.remove_and_refresh(spark, removed, lake, mart)
    return portable(read_lake(spark, mart, schema.STANDINGS))


def footer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and extremes of a stored table, numbers and dates from its footers."""
    table = scratch_path(spark, "profiled")
    write_table(derived.matches(spark, sf_dir), table, sort_by=["match_id"])
    return table_profile(spark, table, ["match_date", "home_goals", "home_shots", "home_possession", "referee"], schema.MATCHES)


# Messages.


def message_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_messages(derived.matches(spark, sf_dir))


def parsed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(parse_messages(derived.envelopes(spark, sf_dir)))


def stream_ingest_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages from files through the stream into a table, then all of them again under a new checkpoint."""
    base = scratch_path(spark, "stream")
    derived.envelopes(spark, sf_dir).write.parquet(f"{base}/messages")
    layout = "key BINARY, value BINARY, timestamp TIMESTAMP"
    for attempt in ("first", "replay"):
        stream = spark.readStream.schema(layout).parquet(f"{base}/messages")
        drain(stream, f"{base}/matches", f"{base}/checkpoint-{attempt}")
    return portable(read_lake(spark, f"{base}/matches", schema.STREAMED))


def _drained_twice(spark: SparkSession, sf_dir: str) -> tuple[str, list[Drained]]:
    """Messages with their places, drained by partition in two runs, the second of which sees the first one's again."""
    base = scratch_path(spark, "rejects")
    placed = derived.placed_envelopes(spark, sf_dir)
    runs = []
    for run in (0, 1):
        placed.filter(C("partition") % 2 == run).write.mode("append").parquet(f"{base}/messages")
        stream = spark.readStream.schema(placed.schema).parquet(f"{base}/messages")
        runs.append(drain_until(stream, f"{base}/matches", f"{base}/checkpoint-{run}", deadline_sec=None, rejects=f"{base}/rejects"))
    return base, runs


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that were turned away, with reason and place, each once."""
    base, _ = _drained_twice(spark, sf_dir)
    rejected = read_lake(spark, f"{base}/rejects", schema.REJECTED)
    return portable(rejected.select("place", "reason", C("value").cast("string").alias("value"), "kafka_timestamp", "kafka_partition", "kafka_offset"))


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the two runs read, turned away and merged, as observed in the batches."""
    _, runs = _drained_twice(spark, sf_dir)
    rows = [(k, r.read, r.malformed, r.without_key, r.merged, r.ended) for k, r in enumerate(runs)]
    return spark.createDataFrame(rows, "run BIGINT, messages BIGINT, malformed BIGINT, without_key BIGINT, merged BIGINT, ended STRING")


def staging_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drained messages into the staging table, twice: the last message of a match wins."""
    path = scratch_path(spark, "staging")
    messages = parse_messages(derived.envelopes(spark, sf_dir))
    for _ in range(2):
        stage_messages(messages, path, schema.STREAMED)
    return portable(read_lake(spark, path, schema.STREAMED))


# The outcome model.


def unscored_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final matches count as scored already."""
    scored = derived.matches_with(spark, sf_dir, "F")
    return portable(scoring.unscored(derived.matches(spark, sf_dir), scored))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.build_features(derived.matches_with_gaps(spark, sf_dir))


_registries: dict[tuple[str, str], str] = {}


def trained_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train with the default settings, register, reload, score in two steps. One session trains once per input."""
    name = (spark.sparkContext.applicationId, sf_dir)
    if name not in _registries:
        base = scratch_path(spark, "model")
        matches = derived.matches_with_gaps(spark, sf_dir)
        scoring.train(matches, f"{base}/registry")
        model, run_id = scoring.latest_model(spark, f"{base}/registry")
        for part in (matches.filter("status = 'F'"), matches):
            scoring.predict(part, f"{base}/predictions", model, run_id)
        _registries[name] = base
    return read_lake(spark, f"{_registries[name]}/predictions", schema.PREDICTIONS)


def train_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored predictions; the outcome and the probabilities' sum are checked."""
    total = C("proba_away") + C("proba_draw") + C("proba_home")
    stored = trained_predictions(spark, sf_dir)
    return stored.select("match_id", C("outcome").cast("bigint"), F.round(total, 6).alias("probability_sum"))


def train_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored predictions' accuracy on the rows they were trained on."""
    return scoring.prediction_accuracy(trained_predictions(spark, sf_dir), derived.matches_with_gaps(spark, sf_dir))


# Pipeline health.


def on_runs(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(operator(derived.stage_runs(spark, sf_dir)))


def stage_breaches(runs: DataFrame) -> DataFrame:
    return health.stage_breaches(runs, derived.EVENT_LIMITS_SEC)


def on_samples(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(operator(derived.metric_samples(spark, sf_dir)))


def rounded(df: DataFrame, column: str, digits: int = 6) -> DataFrame:
    """Sums of doubles differ in the last bits with the order of summation."""
    return df.withColumn(column, F.round(column, digits))


def missing_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = derived.metric_samples(spark, sf_dir)
    expected = samples.select("metric", health.series_name(C("labels")).alias("series"))
    return health.missing_series(samples, expected, derived.as_of(), SILENT_SEC)


QUERIES: dict[str, Query] = {
    "enrich_matches": on_matches(enrich),
    "stg_matches": on_matches(stage_matches),
    "stg_matches_coded": on_matches(stage_matches_coded),
    "team_result_rows": on_matches(league.team_rows),
    "standings_view_rank": on_matches(lambda m: with_long_sums(league.standings_ranked(m))),
    "standings_mart": on_matches(lambda m: with_long_sums(league.standings_mart(m))),
    "standings_incremental": lambda spark, sf_dir: with_long_sums(standings_incremental(spark, sf_dir)),
    "standings_points_only": on_matches(league.standings_points),
    "team_season_stats": on_matches(lambda m: league.team_season_stats(stage_matches(m))),
    "team_summary": on_matches(league.numbered_summary),
    "team_stats_one": on_matches(lambda m: league.team_stats(m, ONE_TEAM)),
    "team_history": on_matches(lambda m: with_long_sums(league.team_history(m, ONE_TEAM))),
    "season_table_one": on_matches(lambda m: with_long_sums(league.season_table(m, ONE_SEASON))),
    "referee_summary": on_enriched(reports.referee_summary),
    "referee_stats": on_enriched(reports.referee_stats),
    "head_to_head": on_matches(reports.head_to_head),
    "top_matches": on_enriched(reports.top_matches),
    "high_scoring_matches": on_enriched(reports.high_scoring_matches),
    "distinct_teams": on_matches(league.distinct_teams),
    "distinct_seasons": on_matches(lambda m: league.distinct_values(m, "season")),
    "distinct_result_codes": on_matches(lambda m: league.distinct_values(stage_matches_coded(m), "result_type")),
    "null_profile": on_matches(quality.null_profile),
    "expectation_results": expectation_results,
    "column_test_results": column_test_results,
    "negative_goal_violations": lambda spark, sf_dir: quality.negative_goals(
        derived.defective_matches(spark, sf_dir)
    ),
    "quality_run_all": quality_run_all,
    "valid_rows": valid_rows,
    "quarantined_rows": quarantined_rows,
    "csv_multi_file": csv_multi_file,
    "lake_roundtrip": lake_roundtrip,
    "merge_upsert": on_merge(keyed.upsert_rows),
    "merge_insert_only": on_merge(keyed.insert_only_rows),
    "merge_partial": on_merge(
        keyed.update_some_rows, ["home_goals", "away_goals", "result", "total_goals"]
    ),
    "lake_merge_upsert": lake_merge_upsert,
    "message_payload": message_payload,
    "parse_messages": parsed_messages,
    "standings_from_changes": standings_from_changes,
    "footer_profile": footer_profile,
    "stream_ingest_once": stream_ingest_once,
    "stream_rejects": stream_rejects,
    "stream_counts": stream_counts,
    "staging_upsert": staging_upsert,
    "unscored_matches": unscored_matches,
    "features": features,
    "train_predict": train_predict,
    "train_accuracy": train_accuracy,
    "run_states": lambda spark, sf_dir: portable(health.run_states(derived.run_events(spark, sf_dir))),
    "sla_breaches": on_runs(stage_breaches),
    "sla_in_progress": on_runs(
        lambda runs: health.breaches_in_progress(runs, derived.as_of(), derived.EVENT_LIMITS_SEC)
    ),
    "breach_counts": on_runs(lambda runs: health.breach_counts(stage_breaches(runs))),
    "sustained_alerts": on_samples(lambda s: health.sustained_alerts(s, ALERT_RULES)),
    "increase_alerts": on_samples(lambda s: rounded(health.sustained_alerts(s, GROWTH_RULES), "peak")),
    "stalled_alerts": on_samples(lambda s: rounded(health.sustained_alerts(s, STALL_RULES), "peak")),
    "counter_increase": on_samples(lambda s: rounded(health.counter_increase(s, DAY), "increase")),
    "counter_rate": on_samples(lambda s: rounded(health.counter_rate(s, DAY), "per_sec", 9)),
    "missing_series": missing_series,
    "gauge_age": lambda spark, sf_dir: health.gauge_age(
        derived.gauge_samples(spark, sf_dir), derived.as_of(), SILENT_SEC
    ),
    "metric_rollup": on_samples(lambda s: rounded(health.metric_rollup(s), "value")),
}
