"""The batch runs, composed from the operators: CSV -> lake, lake -> standings mart, lake -> database staging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import fixed, schema
from touchline.operators import league
from touchline.operators.enrich import enrich
from touchline.operators.keyed import settled
from touchline.operators.league import new_seasons_only, standings_mart, team_summary
from touchline.operators.quality import flagged, match_constraints, require_valid_rows
from touchline.sinks.jdbc import write_jdbc
from touchline.session import scratch_path
from touchline.sinks.lake import remove_paths, write_mart, write_matches, write_table
from touchline.sinks.merge import merge_table, remove_from_table
from touchline.sources.csv import load_matches
from touchline.sources.jdbc import JdbcTarget
from touchline.sources.lake import read_lake, read_table_or_none


def ingest_folder(spark: SparkSession, csv_path: str, lake: str, summary: str | None = None, **reading) -> int:
    """Validate CSV matches and write the enriched lake, and the team summary beside it; returns the rows read."""
    matches = load_matches(spark, csv_path, **reading)
    rows = require_valid_rows(matches, fixed.REQUIRED_COLUMNS)
    write_matches(enrich(matches), lake)
    if summary:
        write_mart(team_summary(read_lake(spark, lake), ordered=False), summary)
    return rows


def ingest_with_quarantine(spark: SparkSession, csv_path: str, lake: str, quarantine: str, **reading) -> None:
    """The lenient variant: valid rows go to the lake, the others to quarantine with their reasons.

    The CSV files are read once, into a table split by validity from which both are written when it is complete: a bad
    file fails the run before either table is touched.
    """
    staged = scratch_path(spark, "split")
    write_table(flagged(load_matches(spark, csv_path, **reading), match_constraints()), staged, partition_by="valid")
    rows = spark.read.parquet(staged)
    write_matches(enrich(rows.filter("valid = 'true'").select(*schema.MATCHES.names)), lake)
    write_table(rows.filter("valid = 'false'").drop("valid"), quarantine, partition_by=None)
    remove_paths(spark, [staged])


def refresh_standings(spark: SparkSession, lake: str, mart: str, refresh_seasons: Sequence[str] = ()) -> None:
    """Bring the stored mart up to date: only seasons it lacks (and those named) are read and written.

    Matches without a season never count, and a named season that has lost all its matches leaves the mart.
    """
    matches = read_lake(spark, lake, columns=schema.MATCHES.names)
    built = read_table_or_none(spark, mart, schema.STANDINGS)
    if built is None:
        write_table(standings_mart(matches.filter("season is not null")), mart)
        return
    named = built.filter(built.season.isin(list(refresh_seasons)))
    kept = built.filter(~built.season.isin(list(refresh_seasons))) if refresh_seasons else built
    new = standings_mart(new_seasons_only(matches, kept))
    emptied = []
    if refresh_seasons:
        old = named.select("season", F.col("_metadata.file_path").alias("file")).distinct()
        emptied = [r.file for r in old.join(new.select("season").distinct(), "season", "left_anti").collect()]
    write_table(new, mart)
    remove_paths(spark, emptied, encoded=True)


def standings_from_changes(spark: SparkSession, mart: str, changes: str) -> list[str]:
    """Bring the stored mart up to date with the changes that a merge has left; returns the seasons touched.

    Only the mart's rows of these seasons are read and written, and no match. Changes are to be applied once: should
    this be interrupted, `refresh_standings` with these seasons puts the mart right.
    """
    moved = league.standings_changes(spark.read.parquet(changes)).persist()
    try:
        # The mart's partitions, which Spark's file index lists on the driver anyway.
        touched = sorted(r.season for r in moved.select("season").distinct().collect())
        built = read_table_or_none(spark, mart, schema.STANDINGS)
        if not touched:
            return touched
        if built is None:
            built = spark.createDataFrame([], schema.STANDINGS)
            old_files = []
        else:
            built = built.filter(built.season.isin(touched))
            old_files = built.select("season", F.col("_metadata.file_path").alias("file")).distinct().collect()
        new = league.standings_after(built, moved).persist()
        filled = {r.season for r in new.select("season").distinct().collect()}
        # Dynamic overwrite replaces the partitions it reads only when its rows are complete; they are kept meanwhile.
        new = settled(new)
        write_table(new, mart)
        remove_paths(spark, [r.file for r in old_files if r.season not in filled], encoded=True)
        return touched
    finally:
        moved.unpersist()


def merge_and_refresh(spark: SparkSession, source: DataFrame, lake: str, mart: str, order_by: Sequence[str] = ()) -> list[str]:
    """Upsert matches into the lake's table and carry the changes on to the mart; late matches and corrections find their seasons."""
    changes = scratch_path(spark, "changes")
    if not merge_table(source, lake, schema.MATCHES, ["match_id"], order_by=order_by, changes=changes):
        return []
    touched = standings_from_changes(spark, mart, changes)
    remove_paths(spark, [changes])
    return touched


def remove_and_refresh(spark: SparkSession, gone: DataFrame, lake: str, mart: str) -> list[str]:
    """Delete matches by key from the lake's table and take them off the mart."""
    changes = scratch_path(spark, "changes")
    if not remove_from_table(gone, lake, schema.MATCHES, ["match_id"], changes=changes):
        return []
    touched = standings_from_changes(spark, mart, changes)
    remove_paths(spark, [changes])
    return touched


def load_staging(spark: SparkSession, lake: str, target: JdbcTarget, table: str) -> None:
    """Refill a database's staging table from the lake; the database then runs its own upsert statement."""
    write_jdbc(read_lake(spark, lake, columns=schema.MATCHES.names), target, table, truncate=True)
