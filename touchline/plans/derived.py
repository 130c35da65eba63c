"""Matches, messages, runs and metric samples derived from the driver's tables by Spark.

One order is one match between two nations. Everything is a function of whole tables, so the work grows with them.
Statuses stand for the life of a match: F is final, P a score that gets corrected, O a match still to be loaded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline import schema

C = F.col

FRESHNESS_AS_OF = "2024-02-01 00:00:00"
EVENT_LIMITS_SEC = {"signup": 60, "click": 45, "view": 30, "error": 20}  # no limit for `purchase`


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is taken from the file footers once and stated from then on."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def as_of() -> Column:
    return F.lit(FRESHNESS_AS_OF).cast("timestamp")


def _text(number: Column) -> Column:
    return number.cast("string")


def match_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical matches, plus the order's key `k` and `status`."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    k, ck, year = C("o_orderkey"), C("o_custkey"), F.year("o_orderdate")
    home = nation.select(C("n_nationkey").alias("hn"), C("n_name").alias("home_team"))
    away = nation.select(C("n_nationkey").alias("an"), C("n_name").alias("away_team"))
    games = (
        orders.join(customer, C("o_custkey") == C("c_custkey"))
        .select(
            k.alias("k"), ck.alias("ck"), C("o_orderstatus").alias("status"),
            C("o_orderdate").cast("date").alias("match_date"),
            C("c_nationkey").alias("hn"),
            ((C("c_nationkey") + 1 + k % 24) % 25).cast("int").alias("an"),
            F.when(F.month("o_orderdate") >= 8, year).otherwise(year - 1).alias("sy"),
        )
        .join(home, "hn")
        .join(away, "an")
    )
    k, ck = C("k"), C("ck")
    home_goals, away_goals = (k * 7 + ck) % 5, (k * 3 + ck * 11) % 4
    share = 300 + ck % 400

    def known_unless(divisor: int, value: Column) -> Column:
        return F.when(k % divisor != 0, value)

    return games.select(
        F.concat(F.lit("m"), _text(k)).alias("match_id"),
        "match_date",
        F.concat(_text(C("sy")), F.lit("-"), F.substring(_text(C("sy") + 1), 3, 2)).alias("season"),
        "home_team",
        "away_team",
        home_goals.cast("int").alias("home_goals"),
        away_goals.cast("int").alias("away_goals"),
        known_unless(11, home_goals + 3 + ck % 12).cast("int").alias("home_shots"),
        known_unless(17, away_goals + ck % 9).cast("int").alias("away_shots"),
        known_unless(19, share.cast("double") / 10).alias("home_possession"),
        known_unless(19, (1000 - share).cast("double") / 10).alias("away_possession"),
        F.concat(F.lit("Stadium "), C("home_team")).alias("stadium"),
        known_unless(13, F.concat(F.lit("Ref"), _text(ck % 20))).alias("referee"),
        "k",
        "status",
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_base(spark, sf_dir).select(*schema.MATCHES.names)


def matches_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All matches, some without home goals or season: what the outcome model has to leave out."""
    k = C("k")
    gaps = {"home_goals": F.when(k % 31 != 0, C("home_goals")), "season": F.when(k % 37 != 0, C("season"))}
    return match_base(spark, sf_dir).withColumns(gaps).select(*schema.MATCHES.names, "status")


def matches_with(spark: SparkSession, sf_dir: str, *statuses: str) -> DataFrame:
    return match_base(spark, sf_dir).filter(C("status").isin(*statuses)).select(*schema.MATCHES.names)


def defective_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All matches, some damaged: negative goals, no key, a team against itself, a bad season, repeated rows."""
    k = C("k")
    damaged = {
        "match_id": F.when(k % 101 != 0, C("match_id")),
        "home_goals": F.when(k % 97 == 0, -1 - C("home_goals")).otherwise(C("home_goals")),
        "away_team": F.when(k % 103 == 0, C("home_team")).otherwise(C("away_team")),
        "season": F.when(k % 107 == 0, F.lit("unknown")).otherwise(C("season")),
    }
    copies = F.when(k % 89 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        match_base(spark, sf_dir)
        .withColumns(damaged)
        .withColumn("_copy", F.explode(copies))
        .select(*schema.MATCHES.names)
    )


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches_with(spark, sf_dir, "F", "P")


def merge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections of P matches, sent twice, and the new O matches; `seq` orders them. The later, valid correction is
    the smaller one, so that no other order gives it."""
    base = match_base(spark, sf_dir).filter(C("status").isin("P", "O"))
    sent = base.withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2))))
    corrected = F.when(C("status") == "P", C("home_goals") + 3 - C("seq")).otherwise(C("home_goals"))
    return sent.withColumn("home_goals", corrected).select(*schema.MATCHES.names, "seq")


def placed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of `envelopes` with partition and offset, some of them without a key."""
    return envelopes(spark, sf_dir, placed=True)


def envelopes(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """Every match as a (key, value, timestamp) message; P matches are sent twice, the second time with a goal less,
    and some messages are broken."""
    k = C("k")
    times = F.when(C("status") == "P", F.array(F.lit(0), F.lit(3600))).otherwise(F.array(F.lit(0)))
    sent = match_base(spark, sf_dir).withColumn("delay", F.explode(times))
    early = ((C("status") == "P") & (C("delay") == 0)).cast("int")
    home_goals = F.when(k % 29 == 0, F.lit("n/a")).otherwise(_text(C("home_goals") + early))
    key = F.when(k % 41 != 0, C("match_id")).otherwise(" ") if placed else C("match_id")
    body = F.struct(
        key.alias("match_id"), "season", "home_team", "away_team",
        home_goals.alias("home_goals"), _text(C("away_goals")).alias("away_goals"),
    )
    value = F.when(k % 23 == 0, F.lit("NOT JSON {")).otherwise(F.to_json(body))
    return sent.select(
        F.concat_ws(":", "season", "match_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.timestamp_seconds(k + C("delay")).alias("timestamp"),
        *([(k % 4).cast("int").alias("partition"), (2 * k + (C("delay") > 0).cast("int")).cast("bigint").alias("offset")] if placed else []),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", C("ts").cast("timestamp"))


def _ends(start: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(start) + F.round(seconds * 1_000_000).cast("bigint"))


def stage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event: its type is the stage, its value the duration; every seventh run has not ended."""
    end = F.when(C("event_id") % 7 != 0, _ends(C("ts"), C("value")))
    return _events(spark, sf_dir).select(
        C("event_id").cast("string").alias("run_id"), C("event_type").alias("stage"),
        C("ts").alias("start_ts"), end.alias("end_ts"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """START and, for ended runs, COMPLETE or FAIL events, two rows from one scan."""
    runs = stage_runs(spark, sf_dir)
    final = F.when(C("stage") == "error", "FAIL").otherwise("COMPLETE")
    both = F.array(
        F.struct(F.lit("START").alias("state"), C("start_ts").alias("event_time")),
        F.struct(final.alias("state"), C("end_ts").alias("event_time")),
    )
    return runs.select("run_id", C("stage").alias("job"), F.inline(both)).filter(C("event_time").isNotNull())


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sample per event: metric is the type, the label `user` one of ten."""
    labels = F.create_map(F.lit("user"), _text(C("user_id") % 10))
    return _events(spark, sf_dir).select("ts", C("event_type").alias("metric"), labels.alias("labels"), "value")


def gauge_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same samples with their own Unix time as value."""
    return metric_samples(spark, sf_dir).withColumn("value", F.unix_seconds("ts").cast("double"))
