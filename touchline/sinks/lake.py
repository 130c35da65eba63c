"""Partitioned table writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import schema


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: str | None = "season",
    fmt: str = "parquet",
    sort_by: Sequence[str] | None = None,
    replace_all: bool = False,
) -> None:
    """Write a table; overwriting replaces only the partitions that df has rows for, so a re-run changes nothing.

    `replace_all` makes an overwrite drop every other partition too.

    The rebalance hint lets adaptive execution size the files: a partition value with a third of all rows is cut
    into many tasks, rare ones do not leave a file per task.
    """
    if partition_by:
        df = df.hint("rebalance", F.col(partition_by))
        order = [partition_by, *[c for c in sort_by or [] if c != partition_by]]
    else:
        df = df.hint("rebalance")
        order = list(sort_by or [])
    if sort_by:
        df = df.sortWithinPartitions(*order)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
    if partition_by:
        overwrite = "static" if replace_all else "dynamic"
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", overwrite)
    writer.save(path)


def remove_paths(spark: SparkSession, paths: Sequence[str], encoded: bool = False) -> None:
    """Delete files or folders of a table through its file system; no job is run. `encoded`: as in _metadata.file_path."""
    java = spark.sparkContext._jvm
    for path in paths:
        place = java.org.apache.hadoop.fs.Path(java.java.net.URI(path) if encoded else path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def move_over(spark: SparkSession, new: str, path: str, partition_by: str | None) -> None:
    """Replace the table's partitions of which `new` has folders by these, or without partitions the table; `new` goes."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    moves = [(place(new), place(path))]
    if partition_by:
        folders = [s.getPath() for s in files.listStatus(place(new)) if s.isDirectory()]
        moves = [(f, place(place(path), f.getName())) for f in folders if f.getName().startswith(f"{partition_by}=")]
    for came, goes in moves:
        files.delete(goes, True)
        if not files.rename(came, goes):
            raise OSError(f"cannot move {came.toString()} to {goes.toString()}")
    if partition_by:
        files.delete(place(new), True)


def write_matches(enriched: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The enriched lake, by season, sorted by home team so that row groups can be skipped."""
    write_table(enriched.select(*schema.LAKE.names), path, mode, sort_by=["home_team"])


def write_mart(mart: DataFrame, path: str) -> None:
    """A small result table of its own, never inside a lake that is scanned."""
    write_table(mart, path, partition_by=None)


def append_breaches(breaches: DataFrame, path: str) -> None:
    rows = breaches.select(*[F.col(f.name).cast(f.dataType) for f in schema.BREACHES.fields])
    rows.withColumn("created_at", F.current_timestamp()).write.mode("append").parquet(path)
