"""Exact global row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.session import ensure_checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place inside its partition in the low 33 bits


def number_rows(df: DataFrame, *order_by, name: str = "position") -> DataFrame:
    """Add the 1-based place of each row in the given total order.

    The range-partitioned sort is checkpointed, so its partitions stay as they are; a row's number is then the
    number of rows in earlier partitions plus its place inside its own. Only one count per partition is
    gathered, whatever the number of rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*order_by).checkpoint()
    placed = ordered.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_place"),
    )
    counts = placed.groupBy("_part").count()
    before = F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    # One row per sort partition: spark.sql.shuffle.partitions bounds it.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_place") + 1)
        .drop("_part", "_place", "_before")
    )
