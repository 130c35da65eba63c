"""Names, limits, patterns and text formats that results are compared on."""

# Outcome names, codes and numeric labels.
HOME_WIN, AWAY_WIN, DRAW = "home_win", "away_win", "draw"
RESULT_CODES = {HOME_WIN: "H", AWAY_WIN: "A", DRAW: "D"}
OUTCOME_LABELS = {AWAY_WIN: 0, DRAW: 1, HOME_WIN: 2}
NO_WINNER = "Draw"

# Scoring.
POINTS_WIN, POINTS_DRAW = 3, 1
HIGH_SCORING_TOTAL = 4
TOP_MATCHES = 5

# Seconds a pipeline stage may take, and the breach severity bands (actual / expected).
STAGE_LIMITS_SEC = {
    "streaming_ingest": 300,
    "validate": 120,
    "load_postgres": 600,
    "dbt_transform": 900,
    "ml_train": 1800,
    "batch_predict": 600,
}
CRITICAL_RATIO, HIGH_RATIO = 2.0, 1.5

# Freshness limit and the streaming trigger.
FRESHNESS_HOURS = 25
TRIGGER_INTERVAL = "10 seconds"

# The match expectation suite.
SUITE_COLUMNS = ["match_id", "season", "home_team", "away_team", "home_goals", "away_goals", "match_date"]
SUITE_NOT_NULL = ["match_id", "season", "home_team", "away_team", "home_goals", "away_goals"]
SUITE_GOAL_RANGE = (0, 20)
SUITE_SEASON_PATTERN = r"^\d{4}-\d{2}$"
SUITE_ROW_RANGE = (1, 500)

# Declared column tests of the source table and of the standings mart.
SOURCE_COLUMN_TESTS = {
    "match_id": ["not_null", "unique"],
    "season": ["not_null"],
    "matchday": ["not_null"],
    "home_team": ["not_null"],
    "away_team": ["not_null"],
    "home_goals": ["not_null"],
    "away_goals": ["not_null"],
}
MART_COLUMN_TESTS = {
    name: ["not_null"]
    for name in ["season", "team", "played", "won", "drawn", "lost", "gf", "ga", "gd", "points", "position"]
}
REQUIRED_COLUMNS = ["match_id", "season", "home_team", "away_team"]

# Detail texts of the post-load checks and the breach alert.
RECONCILIATION_DETAILS = "kafka_offsets=%d, delta_rows=%d, diff=%d, tolerance=%d"
DUPLICATE_DETAILS = "table=%s, pk=%s, duplicate_groups=%d"
INTEGRITY_DETAILS = "mart=%s, source=%s, orphaned_mart_rows=%d"
FRESHNESS_DETAILS = "table=%s, latest_ts=%s, age_seconds=%.0f, threshold_seconds=%d"
EMPTY_DETAILS = "table=%s has no rows"
FAILED_DETAILS = "Query failed: %s"
BREACH_SUMMARY = "SLA breach on stage '%s'"
BREACH_TEXT = "Stage '%s' took %.1fs (SLA=%ds, overrun=%.1fs)"

# Held threshold rules (alert, metric, comparison, limit, hold seconds, absolute value, severity).
HELD_RULES = [
    ("KafkaConsumerLagHigh", "kafka_consumergroup_lag", ">", 1000.0, 300, False, "warning"),
    ("KafkaConsumerLagCritical", "kafka_consumergroup_lag", ">", 5000.0, 120, False, "critical"),
    ("SparkBatchDurationHigh", "spark_streaming_batch_duration_ms", ">", 30000.0, 300, False, "warning"),
    ("AirflowDAGDurationHigh", "airflow_dag_run_duration", ">", 3600.0, 0, False, "warning"),
    ("AirflowDAGFailure", "airflow_dag_run_duration_success", "==", 0.0, 60, False, "critical"),
    ("AirflowDAGFailure", "airflow_dag_run_failed", ">", 0.0, 60, False, "critical"),
    ("ModelAccuracyDropped", "mlflow_latest_metric", "<", 0.70, 0, False, "warning"),
    ("DataFreshnessAlert", "data_freshness_seconds", ">", 90000.0, 300, False, "warning"),
    ("RowCountDeltaAlert", "row_count_delta", ">", 100.0, 300, True, "warning"),
    ("PipelineStageSlow", "pipeline_stage_duration_seconds", ">", 1800.0, 120, False, "warning"),
]
INCREASE_WINDOW_SEC = 3600

# Rules on growth within the last hour (alert, counter, severity, labels), and on counters that stand
# still (alert, counter, window seconds, hold seconds).
INCREASE_RULES = [
    ("SLABreachAlert", "sla_breaches_total", "warning", {}),
    ("SLACriticalBreachAlert", "sla_breaches_total", "critical", {"severity": "critical"}),
    ("QualityCheckFailureAlert", "quality_check_failures_total", "warning", {}),
]
STALLED_RULES = [("KafkaOffsetCommitRateDropped", "kafka_consumergroup_current_offset", 300, 300)]

# Training defaults.
BOOSTING_ROUNDS, TREE_DEPTH, LEARNING_RATE = 100, 4, 0.1

# How long a drain may take, and why a message is turned away.
DRAIN_SECONDS = 120
MALFORMED, WITHOUT_KEY = "malformed", "without_key"
