import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from touchline import fixed
from touchline.functions import timing
from touchline.operators import health
from touchline.plans.derived import EVENT_LIMITS_SEC

START = dt.datetime(2024, 1, 1)
SAMPLES = "ts TIMESTAMP, metric STRING, labels MAP<STRING, STRING>, value DOUBLE"


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def samples(spark, rows):
    return spark.createDataFrame([(at(s), m, labels, float(v)) for s, m, labels, v in rows], SAMPLES)


def runs(spark, *rows):
    data = [(run, stage, at(begin), None if end is None else at(end)) for run, stage, begin, end in rows]
    return spark.createDataFrame(data, "run_id STRING, stage STRING, start_ts TIMESTAMP, end_ts TIMESTAMP")


# Stage limits.


def test_breaches_are_strict_and_graded(spark):
    table = runs(
        spark, ("1", "validate", 0, 120), ("2", "validate", 0, 121), ("3", "validate", 0, 180), ("4", "validate", 0, 240),
        ("5", "unlimited", 0, 99999), ("6", "validate", 0, None),
    )
    found = {r.run_id: (r.severity, r.overrun_sec) for r in health.stage_breaches(table).collect()}
    assert found == {"2": ("warning", 1.0), "3": ("high", 60.0), "4": ("critical", 120.0)}
    row = health.stage_breaches(table).filter("run_id = '3'").first()
    assert row.summary == "SLA breach on stage 'validate'"
    assert row.description == "Stage 'validate' took 180.0s (SLA=120s, overrun=60.0s)"
    assert {(r.stage, r.severity, r.breaches) for r in health.breach_counts(health.stage_breaches(table)).collect()} == {
        ("validate", "warning", 1), ("validate", "high", 1), ("validate", "critical", 1),
    }


def test_limits_of_hours_do_not_overflow(spark):
    table = runs(spark, ("1", "nightly", 0, 100_000))
    assert health.stage_breaches(table, {"nightly": 40_000}).first().overrun_sec == 60_000.0


def test_time_buckets_are_exact_before_1970_too(spark):
    rows = spark.createDataFrame([(-1,), (0,), (9,), (10,), (-10,), (-11,)], "m BIGINT")
    found = [r[0] for r in rows.select(timing.time_bucket(F.col("m"), 10)).collect()]
    assert found == [-1, 0, 0, 1, -1, -2]


def test_runs_in_progress(spark):
    table = runs(
        spark, ("1", "validate", 0, None), ("2", "validate", 200, None), ("3", "validate", 0, 999),
        ("4", "ml_train", 0, None), ("5", "validate", 500, None),
    )
    found = {r.run_id: r.actual_sec for r in health.breaches_in_progress(table, F.lit(at(300))).collect()}
    assert found == {"1": 300.0}


def test_run_events_fold_to_runs(spark):
    events = spark.createDataFrame(
        [("a", "j", "START", at(0)), ("a", "j", "COMPLETE", at(60)), ("b", "j", "START", at(0)), ("b", "j", "FAIL", at(5)),
         ("c", "j", "START", at(0))],
        "run_id STRING, job STRING, state STRING, event_time TIMESTAMP",
    )
    found = {r.run_id: (r.state, r.duration_sec) for r in health.run_states(events).collect()}
    assert found == {"a": ("COMPLETE", 60.0), "b": ("FAIL", 5.0), "c": ("RUNNING", None)}


# Held rules.


def brute_force_stretches(rows, breaching, hold):
    by_series = {}
    for s, _, labels, v in rows:
        by_series.setdefault(tuple(sorted(labels.items())), {})[s] = v
    found = set()
    for labels, points in by_series.items():
        run = []
        for s in [*sorted(points), None]:
            if s is not None and breaching(points[s]):
                run.append(s)
                continue
            if run and run[-1] - run[0] >= hold:
                found.add((",".join("=".join(p) for p in labels), run[0], run[-1], len(run)))
            run = []
    return found


def random_series(seed, n=1500, hot=0.5):
    """A third or more of all samples in one series, gaps longer than a bucket, and long breaching stretches."""
    rng = random.Random(seed)
    rows, clocks, levels = [], {}, {}
    for _ in range(n):
        user = "hot" if rng.random() < hot else rng.choice("abc")
        clocks[user] = clocks.get(user, 0) + rng.choice([1, 20, 60, 60, 300, 4000])
        if rng.random() < 0.2:
            levels[user] = rng.choice([5, 50])
        rows.append((clocks[user], "lag", {"user": user}, levels.get(user, 5)))
    return rows


@pytest.mark.parametrize("buckets", [(1, 3600), (30,), (60, 300, 86400), (3600,), (10**7,), ()])
@pytest.mark.parametrize("hold", [0, 300, 5000])
def test_sustained_alerts_against_a_loop(spark, buckets, hold):
    rows = random_series(sum(buckets) + hold)
    rule = health.Rule("Lag", "lag", ">", 10.0, hold)
    found = {
        (r.series, int((r.start_ts - START).total_seconds()), int((r.end_ts - START).total_seconds()), r.samples)
        for r in health.sustained_alerts(samples(spark, rows), [rule], buckets).collect()
    }
    assert found == brute_force_stretches(rows, lambda v: v > 10, hold)


def test_alternatives_of_one_alert_join_their_stretches(spark):
    rows = [(0, "ok_runs", {}, 0), (30, "failed_runs", {}, 2), (60, "ok_runs", {}, 0), (90, "ok_runs", {}, 3)]
    rules = [health.Rule("Failure", "ok_runs", "==", 0, 60), health.Rule("Failure", "failed_runs", ">", 0, 60)]
    found = health.sustained_alerts(samples(spark, rows), rules).collect()
    assert [(r.held_sec, r.samples, r.peak) for r in found] == [(60.0, 3, 2.0)]


def test_absolute_values_labels_and_nulls(spark):
    rows = [(0, "delta", {"severity": "critical"}, -150), (0, "delta", {"severity": "info"}, -150)]
    frame = samples(spark, rows).unionByName(
        spark.createDataFrame([(at(1), "delta", {"severity": "critical"}, None)], SAMPLES)
    )
    rule = health.Rule("Delta", "delta", ">", 100.0, absolute=True, labels={"severity": "critical"})
    found = health.sustained_alerts(frame, [rule]).collect()
    assert [(r.series, r.samples, r.peak) for r in found] == [("severity=critical", 1, -150.0)]


def test_default_rules_run(spark):
    lag = [(s, "kafka_consumergroup_lag", {"consumergroup": g}, 6000) for s in range(0, 400, 30) for g in ("mine", "other")]
    model = [(0, "mlflow_latest_metric", {"metric": m, "model": "a"}, 0.1) for m in ("loss", "accuracy")]
    breaches = [(s, "sla_breaches_total", {"severity": v}, s) for s in (0, 60) for v in ("critical", "high")]
    still = [(s, "kafka_consumergroup_current_offset", {"consumergroup": "mine"}, 7) for s in range(0, 700, 50)]
    frame = samples(spark, lag + model + breaches + still)
    found = {(r.alert, r.series) for r in health.sustained_alerts(frame, health.default_rules("mine", model_name="a")).collect()}
    assert found == {
        ("KafkaConsumerLagHigh", "consumergroup=mine"), ("KafkaConsumerLagCritical", "consumergroup=mine"),
        ("ModelAccuracyDropped", "metric=accuracy,model=a"), ("SLABreachAlert", "severity=critical"),
        ("SLABreachAlert", "severity=high"), ("SLACriticalBreachAlert", "severity=critical"),
        ("KafkaOffsetCommitRateDropped", "consumergroup=mine"),
    }
    anyone = health.sustained_alerts(frame, health.default_rules()).filter("alert = 'KafkaConsumerLagHigh'")
    assert anyone.count() == 2


@pytest.mark.parametrize("sign", ["=>", "", "<>", None])
def test_unknown_comparisons_are_refused(sign):
    with pytest.raises(ValueError, match="comparison"):
        health.Rule("Odd", "m", sign, 1.0)


def test_a_third_of_all_samples_on_one_counter(spark):
    """Windows longer than any bucket and any stretch of buckets; every sample stays one row."""
    rows = [(60 * k, "c", {"user": "hot" if k % 3 == 0 else str(k % 50)}, k % 700) for k in range(6000)]
    rows = [(t, m, u, v) for t, m, u, v in rows]
    found = {
        (r.series.split("=")[1], int((r.ts - START).total_seconds())): r.increase
        for r in health.counter_increase(samples(spark, rows), 86400, 60).collect()
    }
    points = {}
    for t, _, labels, v in rows:
        points.setdefault(labels["user"], []).append((t, float(v)))
    assert len(found) == 6000
    for user, series in points.items():
        first, total, totals = 0, 0.0, []
        for k, (t, v) in enumerate(series):
            if k:
                total += v if v < series[k - 1][1] else v - series[k - 1][1]
            totals.append(total)
            while series[first][0] < t - 86400:
                first += 1
            assert found[user, t] == pytest.approx(total - totals[first])


# Counters.


def brute_force_increase(rows, window):
    by_series = {}
    for s, _, labels, v in rows:
        by_series.setdefault(labels["user"], {})[s] = float(v)
    found = {}
    for user, points in by_series.items():
        times = sorted(points)
        for t in times:
            inside = [x for x in times if t - window <= x <= t]
            pairs = zip(inside, inside[1:])
            found[(user, t)] = sum(
                points[b] if points[b] < points[a] else points[b] - points[a] for a, b in pairs
            )
    return found


@pytest.mark.parametrize("window, bucket", [(600, 600), (600, 3600), (3600, 60), (3600, 10**7)])
def test_counter_increase_against_a_loop(spark, window, bucket):
    rng = random.Random(window + bucket)
    rows, clocks, totals = [], {}, {}
    for _ in range(900):
        user = "hot" if rng.random() < 0.5 else rng.choice("ab")
        clocks[user] = clocks.get(user, 0) + rng.choice([1, 30, 300, 600, 3600, 9000])
        totals[user] = 0 if rng.random() < 0.05 else totals.get(user, 0) + rng.randint(0, 9)
        rows.append((clocks[user], "c", {"user": user}, totals[user]))
    found = {
        (r.series.split("=")[1], int((r.ts - START).total_seconds())): r.increase
        for r in health.counter_increase(samples(spark, rows), window, bucket).collect()
    }
    assert found == pytest.approx(brute_force_increase(rows, window))


def test_rates_and_stalled_counters(spark):
    rows = [(0, "offset", {"user": "a"}, 10), (60, "offset", {"user": "a"}, 130), (400, "offset", {"user": "a"}, 130)]
    found = [(r.per_sec, r.stalled) for r in health.counter_rate(samples(spark, rows), 120).orderBy("ts").collect()]
    assert found == [(0.0, True), (1.0, False), (0.0, True)]
    assert health.increased(samples(spark, rows), 120).count() == 1


# Absence, age and totals.


def test_missing_series(spark):
    rows = [(0, "lag", {"user": "a"}, 1), (170, "lag", {"user": "b"}, 1), (999, "lag", {"user": "a"}, 1)]
    expected = spark.createDataFrame([("lag", "user=a"), ("lag", "user=b"), ("lag", "user=c")], "metric STRING, series STRING")
    missing = health.missing_series(samples(spark, rows), expected, F.lit(at(180)), 180)
    assert {r.series for r in missing.collect()} == {"user=a", "user=c"}


def test_gauge_age(spark):
    stamp = START.replace(tzinfo=dt.timezone.utc).timestamp()
    rows = [(0, "beat", {"user": "a"}, stamp), (50, "beat", {"user": "a"}, stamp + 50), (0, "beat", {"user": "b"}, stamp)]
    old = health.gauge_age(samples(spark, rows), F.lit(at(100)), 60)
    assert [(r.series, r.age_sec) for r in old.collect()] == [("user=b", 100.0)]


def test_rollup_and_series_names(spark):
    rows = [(0, "m", {"b": "2", "a": "1"}, 1), (0, "m", {"a": "2"}, 2), (1, "m", {}, 4)]
    assert {r.value for r in health.metric_rollup(samples(spark, rows)).collect()} == {3.0, 4.0}
    names = {r[0] for r in samples(spark, rows).select(health.series_name(F.col("labels"))).collect()}
    assert names == {"a=1,b=2", "a=2", ""}


def test_any_number_of_limits(spark):
    assert set(EVENT_LIMITS_SEC) and len(fixed.STAGE_LIMITS_SEC) == 6
    table = runs(spark, ("1", "7", 0, 9), ("2", "s", 0, 9))
    assert [r.run_id for r in health.stage_breaches(table, {str(i): i for i in range(2000)}).collect()] == ["1"]
