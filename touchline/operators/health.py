"""Pipeline health over run, event and metric tables.

Metric samples are (ts, metric, labels, value). A single series may hold any share of all samples, so no window
spans the samples of a whole series: windows are cut into time buckets, and what crosses a bucket border is stitched
from a row per bucket (counters) or at most two (held rules), level by level.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline import fixed
from touchline.functions import timing
from touchline.operators.keyed import settled, small_enough

C = F.col
_MICROS = 1_000_000
_COMPARISONS = {">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__", "==": "__eq__", "!=": "__ne__"}


# Runs and stage limits.


def run_states(events: DataFrame) -> DataFrame:
    """START, COMPLETE and FAIL events folded to one row per run: its state, ends and duration."""
    started, ended = C("state") == "START", C("state").isin("COMPLETE", "FAIL")
    folded = events.groupBy("run_id", "job").agg(
        F.min(F.when(started, C("event_time"))).alias("start_ts"),
        F.max(F.when(ended, C("event_time"))).alias("end_ts"),
        F.max(F.when(ended, F.struct("event_time", "state"))).alias("_last"),
    )
    return folded.select(
        "run_id", "job", "start_ts", "end_ts",
        F.coalesce(C("_last.state"), F.lit("RUNNING")).alias("state"),
        timing.seconds_between(C("start_ts"), C("end_ts")).alias("duration_sec"),
    )


def _small_table(df: DataFrame, rows: list[tuple], ddl: str) -> DataFrame:
    """Rows known to the driver as a table beside df; broadcast while they are few."""
    made = df.sparkSession.createDataFrame(rows, ddl)
    return F.broadcast(made) if small_enough(len(rows), sum(len(str(r)) for r in rows)) else made


def _breaches(runs: DataFrame, end: Column, limits: Mapping[str, int]) -> DataFrame:
    expected = _small_table(runs, list(limits.items()), "stage STRING, expected_sec INT")
    timed = runs.join(expected, "stage").select(
        "run_id", "stage", "expected_sec",
        timing.seconds_between(C("start_ts"), end).alias("actual"),
        timing.overrun(C("start_ts"), end, C("expected_sec")).alias("over"),
        end.alias("breach_time"),
    )
    over = timed.filter(C("actual") > C("expected_sec"))  # strictly
    return over.select(
        "run_id", "stage", "expected_sec",
        F.bround("actual", 3).alias("actual_sec"),
        F.bround("over", 3).alias("overrun_sec"),
        timing.severity(C("actual"), C("expected_sec")).alias("severity"),
        "breach_time",
        timing.breach_summary(C("stage")).alias("summary"),
        timing.breach_text(C("stage"), C("actual"), C("expected_sec"), C("over")).alias("description"),
    )


def stage_breaches(runs: DataFrame, limits: Mapping[str, int] = fixed.STAGE_LIMITS_SEC) -> DataFrame:
    """Finished runs (run_id, stage, start_ts, end_ts) that took longer than their stage may."""
    return _breaches(runs.filter(C("end_ts").isNotNull()), C("end_ts"), limits)


def breaches_in_progress(
    runs: DataFrame, as_of: Column, limits: Mapping[str, int] = fixed.STAGE_LIMITS_SEC
) -> DataFrame:
    """Runs started by `as_of`, not finished, and already over their limit."""
    running = runs.filter(C("end_ts").isNull() & (C("start_ts") <= as_of))
    return _breaches(running, as_of, limits)


def breach_counts(breaches: DataFrame) -> DataFrame:
    return breaches.groupBy("stage", "severity").agg(F.count(F.lit(1)).alias("breaches"))


# Metric samples.


def series_name(labels: Column) -> Column:
    """One text per label set, whatever the map's order: `a=1,b=2`."""
    pairs = F.transform(F.map_entries(labels), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pairs), ",")


@dataclass(frozen=True)
class Rule:
    """A threshold that must hold for `hold_sec` on the series that carry all of `labels`.

    With `window_sec` the metric is a counter, and its growth over the trailing window is compared (with `per_second`,
    that growth as a rate). Rules with the same alert name are alternatives.
    """

    alert: str
    metric: str
    comparison: str
    limit: float
    hold_sec: int = 0
    absolute: bool = False
    severity: str = "warning"
    labels: Mapping[str, str] = field(default_factory=dict)
    window_sec: int = 0
    per_second: bool = False

    def __post_init__(self):
        if self.comparison not in _COMPARISONS:
            raise ValueError(f"unknown comparison {self.comparison!r} in rule {self.alert}")


def default_rules(
    consumer_group: str | None = None, dag_id: str | None = None, model_name: str | None = None
) -> list[Rule]:
    """The fixed rules. Those on a consumer group, a scheduled flow or a model watch the named one, or any if none is
    named; the accuracy rule watches accuracy only."""
    group = {"consumergroup": consumer_group} if consumer_group else {}
    flow = {"dag_id": dag_id} if dag_id else {}
    accuracy = {"metric": "accuracy", **({"model": model_name} if model_name else {})}
    of_metric = {"kafka_consumergroup_lag": group, "mlflow_latest_metric": accuracy}
    of_metric |= {f"airflow_dag_run_{name}": flow for name in ("duration", "duration_success", "failed")}
    held = [Rule(*row, labels=of_metric.get(row[1], {})) for row in fixed.HELD_RULES]
    grown = [
        Rule(alert, metric, ">", 0.0, 0, severity=severity, labels=labels, window_sec=fixed.INCREASE_WINDOW_SEC)
        for alert, metric, severity, labels in fixed.INCREASE_RULES
    ]
    stalled = [
        Rule(alert, metric, "==", 0.0, hold, labels=group, window_sec=window, per_second=True)
        for alert, metric, window, hold in fixed.STALLED_RULES
    ]
    return [*held, *grown, *stalled]


_RULE_DDL = (
    "alert STRING, metric STRING, comparison STRING, limit DOUBLE, hold_sec INT, absolute BOOLEAN, "
    "severity STRING, wanted MAP<STRING, STRING>"
)
_CONDITION = ["alert", "severity", "hold_sec", "series", "ts"]


def _watched(samples: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Samples of the rules' metrics only: a literal list, which reaches the scan."""
    return samples.filter(C("metric").isin(sorted({r.metric for r in rules})))


def _conditions(samples: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """A row per sample and rule that watches it."""
    rows = [
        (r.alert, r.metric, r.comparison, float(r.limit), r.hold_sec, r.absolute, r.severity, dict(r.labels))
        for r in rules
    ]
    carries = F.forall(
        F.map_entries("wanted"), lambda e: F.coalesce(F.try_element_at(C("labels"), e["key"]) == e["value"], F.lit(False))
    )
    probe = F.when(C("absolute"), F.abs("value")).otherwise(C("value"))
    met = reduce(
        lambda chain, sign: chain.when(C("comparison") == sign, getattr(probe, _COMPARISONS[sign])(C("limit"))),
        _COMPARISONS, F,
    )
    return (
        samples.join(_small_table(samples, rows, _RULE_DDL), "metric")
        .filter(carries)
        .withColumn("series", series_name(C("labels")))
        .select(*_CONDITION, F.coalesce(met, F.lit(False)).alias("breach"), "value")
    )


def rule_states(samples: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Whether each alert's condition is met, per series and instant: alert, series, ts, breach, value.

    An instant meets the condition if any alternative does. This also folds repeated samples of one instant.
    """
    parts = []
    for window in sorted({r.window_sec for r in rules}):
        for per_second in (False, True):
            some = [r for r in rules if r.window_sec == window and r.per_second == per_second]
            if not some:
                continue
            watched = _watched(samples, some)
            if window:
                grown = counter_growth(watched, window)
                growth = C("increase") / window if per_second else C("increase")
                watched = grown.select("ts", "metric", "labels", growth.alias("value"))
            parts.append(_conditions(watched, some))
    return (
        reduce(DataFrame.union, parts)
        .groupBy(*_CONDITION)
        .agg(F.bool_or("breach").alias("breach"), F.max(F.when(C("breach"), C("value"))).alias("value"))
    )


_SERIES = ["alert", "severity", "hold_sec", "series"]


def _held() -> Column:
    return timing.seconds_between(C("start_ts"), C("end_ts"))


def _stitch(segments: DataFrame, width_sec: int | None) -> DataFrame:
    """Join neighbouring segments within each time bucket (None: along the whole series).

    A segment is an optional clear sample followed by breaching ones, so it continues the segment before it exactly
    when it has no clear sample of its own. Inside a bucket only the first and last segment can grow any further;
    the others are closed: they stay spread by their own place from then on, or go if they were not held.
    """
    micros = F.unix_micros("place_ts")
    bucket = F.lit(0) if width_sec is None else timing.time_bucket(micros, width_sec * _MICROS)
    lane = ["closed", "lane"]
    within = Window.partitionBy(*_SERIES, *lane)
    joined = (
        segments.withColumn("lane", F.when(C("closed"), micros).otherwise(bucket))
        .withColumn("segment", F.count_if("cleared").over(within.orderBy("place_ts")))
        .groupBy(*_SERIES, *lane, "segment")
        .agg(
            F.min("place_ts").alias("place_ts"),
            F.bool_or("cleared").alias("cleared"),
            F.sum("samples").alias("samples"),
            F.min("start_ts").alias("start_ts"),
            F.max("end_ts").alias("end_ts"),
            F.max("peak").alias("peak"),
        )
        .withColumn("is_last", C("segment") == F.max("segment").over(within))
        .withColumn("closed", C("closed") | (C("cleared") & ~C("is_last")))
    )
    open_end = ~C("closed") & C("is_last")
    held = (C("samples") > 0) & (~C("closed") | (_held() >= C("hold_sec")))
    return joined.filter(open_end | held).drop("lane", "segment", "is_last")


def sustained_alerts(
    samples: DataFrame, rules: Sequence[Rule], buckets_sec: Sequence[int] = (1, 3600)
) -> DataFrame:
    """Stretches of consecutive breaching samples that last at least the rule's hold time.

    Stretches are joined within short buckets first, then within longer ones, then along the series. A task sees
    one bucket of one series: at most a million instants in a second of microsecond time stamps, two open segments
    per second in an hour, two per hour at the end. For series known to be sparse, `(3600,)` saves a shuffle.
    """
    breach = C("breach")
    segments = rule_states(samples, rules).select(
        *_SERIES,
        C("ts").alias("place_ts"),
        F.lit(False).alias("closed"),
        (~breach).alias("cleared"),
        F.when(breach, 1).otherwise(0).alias("samples"),
        F.when(breach, C("ts")).alias("start_ts"),
        F.when(breach, C("ts")).alias("end_ts"),
        C("value").alias("peak"),
    )
    for width in [*sorted(buckets_sec), None]:
        segments = _stitch(segments, width)
    return (
        segments.filter(C("samples") > 0)
        .withColumn("held_sec", _held())
        .filter(C("held_sec") >= C("hold_sec"))
        .select("alert", "severity", "series", "start_ts", "end_ts", "held_sec", "samples", "peak")
    )


_LEVEL = 1000  # buckets whose rows are summed up together, then as one row


def _stitched(buckets: DataFrame) -> DataFrame:
    """Per bucket of a series (first, last, inside: values and growth; NULL where it has only probes): the growth up to
    its first sample, the growth from the last sample before it to that one, and the total at the next bucket's start.

    Rows are summed within _LEVEL buckets first and then over one row for each such stretch, so a task's window grows
    with neither the series nor the samples in a bucket.
    """
    series = ["metric", "series"]
    low = Window.partitionBy(*series, "stretch").orderBy("bucket")
    earlier, later = low.rowsBetween(Window.unboundedPreceding, -1), low.rowsBetween(1, Window.unboundedFollowing)
    upto = low.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    high = Window.partitionBy(*series).orderBy("stretch")
    before, behind = high.rowsBetween(Window.unboundedPreceding, -1), high.rowsBetween(1, Window.unboundedFollowing)

    def step(previous: Column, value: Column) -> Column:
        grown = F.when(value < previous, value).otherwise(value - previous)
        return F.when(previous.isNull() | value.isNull(), 0.0).otherwise(grown)

    placed = buckets.withColumn("stretch", F.floor(C("bucket") / _LEVEL))
    placed = placed.withColumn("_previous", F.last("last", ignorenulls=True).over(earlier))
    stretches = placed.groupBy(*series, "stretch").agg(
        F.min(F.when(C("first").isNotNull(), F.struct("bucket", "first")))["first"].alias("_s_first"),
        F.max(F.when(C("last").isNotNull(), F.struct("bucket", "last")))["last"].alias("_s_last"),
        F.sum(step(C("_previous"), C("first")) + F.coalesce("inside", F.lit(0.0))).alias("_s_inside"),
    )
    stretches = (
        stretches.withColumn("_s_previous", F.last("_s_last", ignorenulls=True).over(before))
        .withColumn("_s_carry", step(C("_s_previous"), C("_s_first")))
        .withColumn("_s_start", F.coalesce(F.sum(C("_s_carry") + C("_s_inside")).over(before), F.lit(0.0)))
        .withColumn("_s_begin", F.when(C("_s_first").isNotNull(), C("_s_start") + C("_s_carry")))
        .withColumn("_s_next", F.first("_s_begin", ignorenulls=True).over(behind))
        .select(*series, "stretch", "_s_previous", "_s_start", "_s_next")
    )
    return (
        placed.join(stretches, [*series, "stretch"])
        .withColumn("_carry", step(F.coalesce("_previous", "_s_previous"), C("first")))
        .withColumn("_through", F.sum(C("_carry") + F.coalesce("inside", F.lit(0.0))).over(upto))
        .withColumn("begin", C("_s_start") + C("_through") - F.coalesce("inside", F.lit(0.0)))
        .withColumn("_begin", F.when(C("first").isNotNull(), C("begin")))
        .withColumn("next", F.coalesce(F.first("_begin", ignorenulls=True).over(later), C("_s_next")))
        .select(*series, "bucket", "begin", "next")
    )


def counter_growth(samples: DataFrame, window_sec: int, bucket_sec: int = 600) -> DataFrame:
    """For each sample, how much the counter grew over the trailing window: metric, series, labels, ts, increase.

    Growth is summed over neighbouring samples that both lie in the window; after a reset the new value counts. It is
    the running total at the sample less the running total at the first sample in the window. Totals run within short
    buckets and are stitched over one row per bucket; the first sample of a window is looked up in the bucket in which
    the window begins, or else is the first one of the next bucket that has any. A task sees one bucket of a series.
    """
    span, width = window_sec * _MICROS, bucket_sec * _MICROS
    series = ["metric", "series"]
    instants = (
        samples.groupBy("metric", series_name(C("labels")).alias("series"), "ts")
        .agg(F.max("value").alias("value"), F.any_value("labels").alias("labels"))
        .filter(C("value").isNotNull())
        .withColumn("at", F.unix_micros("ts"))
        .withColumn("bucket", timing.time_bucket(C("at"), width))
    )
    inside = Window.partitionBy(*series, "bucket").orderBy("at")
    previous = F.lag("value").over(inside)
    step = F.when(previous.isNull(), 0.0).when(C("value") < previous, C("value")).otherwise(C("value") - previous)
    so_far = Window.unboundedPreceding, Window.currentRow
    # Computed once: buckets, probes and the samples themselves are taken from it.
    running = settled(instants.withColumn("step", step).withColumn("run", F.sum("step").over(inside.rowsBetween(*so_far))))
    begin = C("at") - span

    sample_buckets = running.groupBy(*series, "bucket").agg(
        F.min_by("value", "at").alias("first"), F.max_by("value", "at").alias("last"), F.sum("step").alias("inside")
    )
    empty = [F.lit(None).cast("double").alias(n) for n in ("first", "last", "inside")]
    probe_buckets = running.select(*series, timing.time_bucket(begin, width).alias("bucket"), *empty)
    known = ["first", "last", "inside"]
    buckets = sample_buckets.union(probe_buckets).groupBy(*series, "bucket").agg(*[F.max(n).alias(n) for n in known])
    stitched = settled(_stitched(settled(buckets)))

    # In each bucket the samples, and a probe for each window that begins there. Read backwards, the sample last passed
    # is the window's first one.
    whole = running.join(stitched, [*series, "bucket"]).withColumn("total", C("begin") + C("run"))
    none = F.lit(None)
    sample = F.struct(
        C("bucket"), C("at"), F.lit(False).alias("probe"), C("total").alias("seen"), none.cast("timestamp").alias("ts"),
        none.cast("double").alias("now"), none.cast("map<string,string>").alias("labels"),
    )
    probe = F.struct(
        timing.time_bucket(begin, width).alias("bucket"), begin.alias("at"), F.lit(True).alias("probe"),
        none.cast("double").alias("seen"), C("ts"), C("total").alias("now"), C("labels"),
    )
    events = whole.select(*series, F.inline(F.array(sample, probe)))
    backwards = Window.partitionBy(*series, "bucket").orderBy(F.desc("at"), "probe")
    found = events.withColumn("_start", F.last("seen", ignorenulls=True).over(backwards.rowsBetween(*so_far))).filter("probe")
    following = stitched.select(*series, "bucket", "next")
    at_begin = F.coalesce("_start", "next")
    return found.join(following, [*series, "bucket"]).select(*series, "labels", "ts", (C("now") - at_begin).alias("increase"))


def counter_increase(
    samples: DataFrame, window_sec: int = fixed.INCREASE_WINDOW_SEC, bucket_sec: int = 600
) -> DataFrame:
    """Growth of each counter over the trailing window: metric, series, ts, increase."""
    return counter_growth(samples, window_sec, bucket_sec).drop("labels")


def counter_rate(samples: DataFrame, window_sec: int, bucket_sec: int = 600) -> DataFrame:
    """Growth per second over the trailing window, with a flag for a counter that stands still."""
    grown = counter_increase(samples, window_sec, bucket_sec)
    return grown.select(
        "metric", "series", "ts",
        (C("increase") / window_sec).alias("per_sec"),
        (C("increase") == 0).alias("stalled"),
    )


def increased(samples: DataFrame, window_sec: int = fixed.INCREASE_WINDOW_SEC) -> DataFrame:
    """Samples at which the counter has grown within the window: the `increase(...) > 0` alert."""
    return counter_increase(samples, window_sec).filter("increase > 0")


def missing_series(samples: DataFrame, expected: DataFrame, as_of: Column, hold_sec: int) -> DataFrame:
    """Expected (metric, series) pairs without a sample in the last hold_sec before `as_of`."""
    oldest = F.timestamp_micros(F.unix_micros(as_of) - F.lit(hold_sec * _MICROS).cast("bigint"))
    seen = (
        samples.filter((C("ts") > oldest) & (C("ts") <= as_of))  # plain comparisons, which reach the scan
        .select("metric", series_name(C("labels")).alias("series"))
        .distinct()
    )
    return expected.select("metric", "series").distinct().join(seen, ["metric", "series"], "left_anti")


def gauge_age(samples: DataFrame, as_of: Column, older_than_sec: float) -> DataFrame:
    """Series whose newest sample, itself a Unix time, lies more than older_than_sec before `as_of`."""
    newest = samples.groupBy("metric", series_name(C("labels")).alias("series")).agg(
        F.max(F.struct("ts", "value")).alias("_newest")
    )
    age = F.unix_micros(as_of) / F.lit(float(_MICROS)) - C("_newest.value")
    return newest.select("metric", "series", age.alias("age_sec")).filter(C("age_sec") > older_than_sec)


def metric_rollup(samples: DataFrame) -> DataFrame:
    """The sum over all label sets of a metric, per instant."""
    return samples.groupBy("metric", "ts").agg(F.sum("value").alias("value"))
