"""The one canonical match schema, the shapes derived from it, and the mapping of other layouts onto it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(), "DATE": T.DateType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(),
    "BIGINT": T.LongType(), "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType(), "BINARY": T.BinaryType(),
}


def _struct(columns: str) -> T.StructType:
    """`name TYPE` pairs; unlike a DDL string this needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# A reader never enforces NOT NULL, so nullability is checked by filters and quality rules, not here.
MATCHES = _struct(
    "match_id STRING, match_date DATE, season STRING, home_team STRING, away_team STRING, home_goals INT, "
    "away_goals INT, home_shots INT, away_shots INT, home_possession DOUBLE, away_possession DOUBLE, "
    "stadium STRING, referee STRING"
)

RAW_CSV = _struct(
    "match_id STRING, date STRING, season STRING, home_team STRING, away_team STRING, home_goals INT, "
    "away_goals INT, home_shots INT, away_shots INT, home_possession DOUBLE, away_possession DOUBLE, "
    "stadium STRING, referee STRING"
)

DERIVED = _struct(
    "result STRING, total_goals INT, goal_diff INT, high_scoring BOOLEAN, home_shot_acc DOUBLE, "
    "away_shot_acc DOUBLE, dominant_team STRING, match_label STRING"
)

# Explicit, because reading `season=2024` directories would otherwise infer INT and `season=2023-24` STRING.
LAKE = T.StructType(MATCHES.fields + DERIVED.fields)

STANDINGS = _struct(
    "season STRING, team STRING, played BIGINT, won BIGINT, drawn BIGINT, lost BIGINT, gf BIGINT, ga BIGINT, "
    "gd BIGINT, points BIGINT, position INT"
)

# Message payloads carry every value as text; numbers are cast leniently after parsing.
MESSAGE_PAYLOAD = _struct(
    "match_id STRING, season STRING, home_team STRING, away_team STRING, home_goals STRING, away_goals STRING"
)
STREAMED = _struct(
    "match_id STRING, season STRING, home_team STRING, away_team STRING, home_goals INT, away_goals INT, "
    "kafka_timestamp TIMESTAMP"
)

# The stored form: with each row the place of its message, so that a later batch can tell which of two came first.
STREAM_TABLE = T.StructType([*STREAMED.fields, *_struct("kafka_partition INT, kafka_offset BIGINT").fields])
REJECTED = _struct(
    "place STRING, reason STRING, value BINARY, kafka_timestamp TIMESTAMP, kafka_partition INT, kafka_offset BIGINT"
)

PREDICTIONS = _struct(
    "match_id STRING, outcome INT, proba_away DOUBLE, proba_draw DOUBLE, proba_home DOUBLE, "
    "model_run_id STRING, predicted_at TIMESTAMP"
)

BREACHES = _struct(
    "stage STRING, expected_sec INT, actual_sec DOUBLE, overrun_sec DOUBLE, severity STRING, breach_time TIMESTAMP"
)

_ALIASES = {"date": "match_date", "home_score": "home_goals", "away_score": "away_goals"}


def canonical(df: DataFrame) -> DataFrame:
    """Map any known match layout onto MATCHES; absent columns become NULL, unknown columns pass through."""
    for old, new in _ALIASES.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    known = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in MATCHES.fields
    ]
    return df.select(*known, *[c for c in df.columns if c not in MATCHES.names])
