"""Data-quality operators: expectation suites, declared column tests, post-load checks, gates and quarantine.

All row-level rules of a suite are folded into one aggregate, so a table is scanned once for them and nothing is
shuffled but one partial row per task. A uniqueness rule needs its own grouping, which reads only its column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import fixed
from touchline.functions.text import iso_utc
from touchline.functions.timing import seconds_between
from touchline.operators.keyed import count_duplicate_keys, count_orphans

C = F.col


class DataQualityError(Exception):
    """Raised by the gates; names what failed."""


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Expectation suites.


@dataclass(frozen=True)
class Expectation:
    """One rule: exactly one of `violated` (a row predicate), `unique`, `bounds` (row count) or `holds` (schema)."""

    name: str
    column: str
    violated: Column | None = None
    unique: bool = False
    bounds: tuple[int, int] | None = None
    holds: Callable[[DataFrame], bool] | None = None


def columns_in_order(columns: Sequence[str]) -> Expectation:
    return Expectation(
        "expect_table_columns_to_match_ordered_list", "", holds=lambda df: df.columns == list(columns)
    )


def not_null(column: str) -> Expectation:
    return Expectation("expect_column_values_to_not_be_null", column, violated=C(column).isNull())


def unique(column: str) -> Expectation:
    return Expectation("expect_column_values_to_be_unique", column, unique=True)


def of_type(column: str, kind: str) -> Expectation:
    return Expectation(
        "expect_column_values_to_be_of_type",
        column,
        holds=lambda df: column in df.columns and df.schema[column].dataType.simpleString() == kind,
    )


def between(column: str, low, high) -> Expectation:
    return Expectation("expect_column_values_to_be_between", column, violated=~C(column).between(low, high))


def matches_pattern(column: str, pattern: str) -> Expectation:
    return Expectation("expect_column_values_to_match_regex", column, violated=~C(column).rlike(pattern))


def row_count_between(low: int, high: int) -> Expectation:
    return Expectation("expect_table_row_count_to_be_between", "", bounds=(low, high))


def pair_differs(first: str, second: str) -> Expectation:
    return Expectation(
        "expect_column_pair_values_to_not_be_equal", f"{first},{second}", violated=C(first) == C(second)
    )


def match_suite(
    columns: Sequence[str] = fixed.SUITE_COLUMNS, row_range: tuple[int, int] = fixed.SUITE_ROW_RANGE
) -> list[Expectation]:
    """The fifteen match expectations; the column list and the row-count range depend on the table checked."""
    return [
        columns_in_order(columns),
        *[not_null(c) for c in fixed.SUITE_NOT_NULL],
        unique("match_id"),
        of_type("home_goals", "int"),
        of_type("away_goals", "int"),
        between("home_goals", *fixed.SUITE_GOAL_RANGE),
        between("away_goals", *fixed.SUITE_GOAL_RANGE),
        matches_pattern("season", fixed.SUITE_SEASON_PATTERN),
        row_count_between(*row_range),
        pair_differs("home_team", "away_team"),
    ]


def _result_row(position: int, rule: Expectation, unexpected: Column, success: Column) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(rule.name).alias("expectation"),
        F.lit(rule.column).alias("column"),
        success.alias("success"),
        unexpected.cast("bigint").alias("unexpected_count"),
    )


def _counts_and_schema(df: DataFrame, rules: Sequence[tuple[int, Expectation]]) -> DataFrame:
    """Every rule but uniqueness, from one aggregate row."""
    counts = [F.count_if(rule.violated).alias(f"n{i}") for i, rule in rules if rule.violated is not None]
    rows = []
    for i, rule in rules:
        if rule.violated is not None:
            rows.append(_result_row(i, rule, C(f"n{i}"), C(f"n{i}") == 0))
        elif rule.bounds is not None:
            inside = C("n_rows").between(*rule.bounds)
            rows.append(_result_row(i, rule, F.when(inside, 0).otherwise(C("n_rows")), inside))
        else:
            held = rule.holds(df)
            rows.append(_result_row(i, rule, F.lit(0 if held else 1), F.lit(held)))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *counts).select(F.inline(F.array(*rows)))


def _uniqueness(df: DataFrame, position: int, rule: Expectation) -> DataFrame:
    """Rows that share their non-NULL value with another row."""
    groups = df.groupBy(rule.column).agg(F.count(F.lit(1)).alias("copies"))
    shared = groups.filter(C(rule.column).isNotNull() & (C("copies") > 1))
    total = shared.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n"))
    return total.select(F.inline(F.array(_result_row(position, rule, C("n"), C("n") == 0))))


def run_suite(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """One row per expectation: position, expectation, column, success, unexpected_count."""
    numbered = list(enumerate(suite, start=1))
    plain = [(i, rule) for i, rule in numbered if not rule.unique]
    parts = [_counts_and_schema(df, plain)] if plain else []
    parts += [_uniqueness(df, i, rule) for i, rule in numbered if rule.unique]
    return _union(parts)


def require_suite(df: DataFrame, suite: Sequence[Expectation]) -> None:
    """Raise with the list of failed expectations (at most one row per rule reaches the driver)."""
    failed = run_suite(df, suite).filter(~C("success")).orderBy("position").collect()
    if failed:
        lines = [f"{r.expectation}({r.column}): {r.unexpected_count} unexpected" for r in failed]
        raise DataQualityError(f"{len(failed)} expectation(s) failed:\n" + "\n".join(lines))


# Column tests and profiles.


def column_tests(tables: Mapping[str, tuple[DataFrame, Mapping[str, Sequence[str]]]]) -> DataFrame:
    """Declared not_null and unique tests of several tables: table, column, test, failures, passed.

    A uniqueness failure is one repeated value, however many rows carry it. A test on an absent column has failed.
    """
    parts = []
    for table, (df, declared) in tables.items():
        present = {c: tests for c, tests in declared.items() if c in df.columns}
        absent = [(table, c, test) for c, tests in declared.items() if c not in df.columns for test in tests]
        if absent:  # a declared test without its column has failed, by an unknown number
            names = "table_name STRING, column_name STRING, test STRING"
            lost = df.sparkSession.createDataFrame(absent, names)
            parts.append(lost.select("*", F.lit(None).cast("bigint").alias("failures"), F.lit(False).alias("passed")))
        not_nulls = [c for c, tests in present.items() if "not_null" in tests]
        if not_nulls:
            counts = df.agg(*[F.count_if(C(c).isNull()).alias(c) for c in not_nulls])
            parts.append(counts.select(F.inline(F.array(*[_test_row(table, c, "not_null", C(c)) for c in not_nulls]))))
        for c in [c for c, tests in present.items() if "unique" in tests]:
            repeated = count_duplicate_keys(df.filter(C(c).isNotNull()), c)
            parts.append(repeated.select(F.inline(F.array(_test_row(table, c, "unique", C("duplicate_groups"))))))
    return _union(parts)


def _test_row(table: str, column: str, test: str, failures: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(test).alias("test"),
        failures.cast("bigint").alias("failures"),
        (failures == 0).alias("passed"),
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column and the row count, in one pass: column_name, null_count, row_count."""
    chosen = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(C(c).isNull()).alias(c) for c in chosen])
    row = [
        F.struct(F.lit(c).alias("column_name"), C(c).alias("null_count"), C("_rows").alias("row_count"))
        for c in chosen
    ]
    return counts.select(F.inline(F.array(*row)))


def negative_goals(matches: DataFrame) -> DataFrame:
    """Rows that break the goals-are-not-negative rule."""
    return matches.select("match_id", "home_goals", "away_goals").filter("home_goals < 0 OR away_goals < 0")


def require_valid_rows(df: DataFrame, required: Sequence[str] | None = None) -> int:
    """Raise for an empty table, NULLs in required columns or negative goals; else the row count. One pass."""
    columns = list(df.columns if required is None else required)
    has_goals = {"home_goals", "away_goals"} <= set(df.columns)
    negative = F.count_if((C("home_goals") < 0) | (C("away_goals") < 0)) if has_goals else F.lit(0)
    seen = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        negative.alias("_negative"),
        *[F.count_if(C(c).isNull()).alias(c) for c in columns],
    ).first()
    errors = [f"{c}: {seen[c]} null(s)" for c in columns if seen[c]]
    if seen["_rows"] == 0:
        errors.insert(0, "the table is empty")
    if seen["_negative"]:
        errors.append(f"{seen['_negative']} row(s) with negative goals")
    if errors:
        raise DataQualityError("validation failed: " + "; ".join(errors))
    return seen["_rows"]


# Post-load checks. Each gives one row: check_name, passed, details.


def _check(counted: DataFrame, name: str, passed: Column, details: Column) -> DataFrame:
    return counted.select(F.lit(name).alias("check_name"), passed.alias("passed"), details.alias("details"))


def row_count_reconciliation(sent: DataFrame, stored: DataFrame, tolerance: int = 0) -> DataFrame:
    """Whether two tables' row counts differ by no more than the tolerance."""
    one = F.count(F.lit(1))
    sides = sent.agg(one.alias("sent"), F.lit(0).alias("stored")).unionByName(
        stored.agg(F.lit(0).alias("sent"), one.alias("stored"))
    )
    both = sides.agg(F.sum("sent").alias("sent"), F.sum("stored").alias("stored"))
    diff = F.abs(C("sent") - C("stored"))
    details = F.format_string(fixed.RECONCILIATION_DETAILS, C("sent"), C("stored"), diff, F.lit(tolerance))
    return _check(both, "row_count_reconciliation", diff <= tolerance, details)


def duplicate_primary_keys(df: DataFrame, table: str, pk: str) -> DataFrame:
    groups = C("duplicate_groups")
    details = F.format_string(fixed.DUPLICATE_DETAILS, F.lit(table), F.lit(pk), groups)
    return _check(count_duplicate_keys(df, pk), "duplicate_primary_keys", groups == 0, details)


def referential_integrity(
    mart: DataFrame, source: DataFrame, mart_table: str, source_table: str, fk: str, pk: str
) -> DataFrame:
    orphans = C("orphaned_rows")
    details = F.format_string(fixed.INTEGRITY_DETAILS, F.lit(mart_table), F.lit(source_table), orphans)
    return _check(count_orphans(mart, source, fk, pk), "referential_integrity", orphans == 0, details)


def data_freshness(
    df: DataFrame, table: str, ts_column: str, as_of: Column, limit_hours: int = fixed.FRESHNESS_HOURS
) -> DataFrame:
    """Whether the newest row is at most limit_hours old at `as_of`; an empty table fails."""
    limit = limit_hours * 3600
    newest = df.agg(F.max(C(ts_column).cast("timestamp")).alias("latest"))
    age = seconds_between(C("latest"), as_of)
    found = F.format_string(fixed.FRESHNESS_DETAILS, F.lit(table), iso_utc(C("latest")), age, F.lit(limit))
    details = F.when(C("latest").isNull(), F.format_string(fixed.EMPTY_DETAILS, F.lit(table))).otherwise(found)
    return _check(newest, "data_freshness", F.coalesce(age <= limit, F.lit(False)), details)


def run_checks(spark: SparkSession, checks: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """All checks in one result; a check that cannot be analysed or fails while it runs becomes a failed row.

    Each check is run here, on its own; its result is one row.
    """
    rows = []
    for name, build in checks.items():
        try:
            rows += [tuple(r) for r in build().select("check_name", "passed", "details").collect()]
        except PySparkException as error:
            rows.append((name, False, fixed.FAILED_DETAILS % str(error).splitlines()[0]))
    return spark.createDataFrame(rows, "check_name STRING, passed BOOLEAN, details STRING")


def check_summary(results: DataFrame) -> DataFrame:
    """One row: how many checks ran, passed and failed."""
    return results.agg(
        F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("passed"), F.count_if(~C("passed")).alias("failed")
    )


def with_measured_at(results: DataFrame) -> DataFrame:
    return results.withColumn("measured_at", F.current_timestamp())


def require_checks(results: DataFrame) -> None:
    """Raise when any check failed, naming them all."""
    failed = results.filter(~C("passed")).select("check_name", "details").collect()
    if failed:
        raise DataQualityError("; ".join(f"{r.check_name}: {r.details}" for r in failed))


# Quarantine.


def match_constraints() -> dict[str, Column]:
    """What a stored match must satisfy, as reason -> violated predicate."""
    missing = {f"{c}_missing": C(c).isNull() for c in fixed.SUITE_NOT_NULL}
    return {
        **missing,
        "home_goals_negative": C("home_goals") < 0,
        "away_goals_negative": C("away_goals") < 0,
        "same_team": C("home_team") == C("away_team"),
        "season_malformed": ~C("season").rlike(fixed.SUITE_SEASON_PATTERN),
    }


def allowed_results(column: str = "result") -> dict[str, Column]:
    allowed = C(column).isin(fixed.HOME_WIN, fixed.AWAY_WIN, fixed.DRAW)
    return {f"{column}_unknown": ~F.coalesce(allowed, F.lit(False))}


def with_reasons(df: DataFrame, constraints: Mapping[str, Column]) -> DataFrame:
    """Add the array of violated constraints, empty for a valid row."""
    hits = [F.when(violated, F.lit(reason)) for reason, violated in constraints.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*hits)))


def flagged(df: DataFrame, constraints: Mapping[str, Column]) -> DataFrame:
    """All rows with their reasons and `valid`: what split_valid gives, in one table."""
    return with_reasons(df, constraints).withColumn("valid", F.size("reasons") == 0)


def split_valid(df: DataFrame, constraints: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their reasons); together exactly the input."""
    broken = reduce(lambda a, b: a | b, [F.coalesce(v, F.lit(False)) for v in constraints.values()])
    return df.filter(~broken), with_reasons(df.filter(broken), constraints)
