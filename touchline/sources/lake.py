"""Partitioned tables, read with an explicit schema, column projection and pushed-down filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from touchline import schema


def read_lake(
    spark: SparkSession,
    path: str,
    layout: T.StructType = schema.LAKE,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Scan a table. A filter on season prunes directories; other filters reach the row groups."""
    reader = spark.read.format(fmt)
    rows = (reader.schema(layout) if fmt == "parquet" else reader).load(path)
    rows = rows if where is None else rows.filter(where)
    return rows.select(*columns) if columns else rows


def read_table_or_none(
    spark: SparkSession, path: str, layout: T.StructType | str, fmt: str = "parquet"
) -> DataFrame | None:
    """The table, or None when nothing has been written there yet."""
    try:
        reader = spark.read.format(fmt)
        return (reader.schema(layout) if fmt == "parquet" else reader).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
