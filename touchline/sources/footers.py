"""Table profiles answered by Parquet footers: no row is read where the files' statistics tell counts and extremes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types whose extremes the reader takes from footers; text may be cut short there, time stamps may lack statistics.
TOLD = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType, T.DateType)
_SOURCES, _PUSHED = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


@contextmanager
def pushed_aggregates(spark: SparkSession) -> Iterator[None]:
    """Within it, Parquet is read by the reader that takes aggregates on; plans have to be made and run inside."""
    before = {k: spark.conf.get(k) for k in (_SOURCES, _PUSHED)}
    spark.conf.set(_SOURCES, ",".join(s for s in before[_SOURCES].split(",") if s.strip() != "parquet"))
    spark.conf.set(_PUSHED, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def profile_query(spark: SparkSession, path: str, columns: Sequence[str], layout: T.StructType) -> DataFrame:
    """One row: the number of rows, and of each column its known values, least and greatest one."""
    told = [F.count(F.lit(1)).alias("rows")]
    for k, c in enumerate(columns):
        told += [F.count(c).alias(f"known_{k}"), F.min(c).alias(f"low_{k}"), F.max(c).alias(f"high_{k}")]
    return spark.read.schema(layout).parquet(path).agg(*told)


def table_profile(spark: SparkSession, path: str, columns: Sequence[str], layout: T.StructType) -> DataFrame:
    """column, rows, known, low and high (as text) of a stored table's columns, one row for each.

    Columns of the types in TOLD are answered by footers, the others by a scan of these columns alone.
    """
    from_footers = [c for c in columns if isinstance(layout[c].dataType, TOLD)]
    by_scan = [c for c in columns if c not in from_footers]
    rows = []
    if from_footers:
        with pushed_aggregates(spark):
            rows += _rows(profile_query(spark, path, from_footers, layout), from_footers)
    if by_scan:
        rows += _rows(profile_query(spark, path, by_scan, layout), by_scan)
    return spark.createDataFrame(rows, "column STRING, rows BIGINT, known BIGINT, low STRING, high STRING")


def _rows(answer: DataFrame, columns: Sequence[str]) -> list[tuple]:
    found = answer.select("rows", *[F.col(f"{n}_{k}").cast("string") for k in range(len(columns)) for n in ("known", "low", "high")]).first()
    return [(c, found[0], int(found[1 + 3 * k]), found[2 + 3 * k], found[3 + 3 * k]) for k, c in enumerate(columns)]
