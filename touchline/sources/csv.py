"""Match CSV files under an explicit schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import schema

_FILE_STEM = r"([^/]+)\.csv$"


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when there is nothing to process; stops at the first row found."""
    if df.isEmpty():
        raise ValueError(f"No data found in {what}")
    return df


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    layout: T.StructType = schema.RAW_CSV,
    season: str | None = None,
    season_from_file: bool = False,
) -> DataFrame:
    """Read one file, several, or every *.csv of a folder.

    Cells are trimmed, empty ones become NULL, a cell that does not fit its type fails the job, and so does a
    header whose names are not the layout's. With `season_from_file` the season is the file name's stem; asking
    for one `season` then lists only that file.
    """
    paths = [path] if isinstance(path, str) else list(path)
    pattern = f"{season}.csv" if season_from_file and season else "*.csv"
    try:
        rows = (
            spark.read.schema(layout)
            .option("header", True)
            .option("enforceSchema", False)
            .option("ignoreLeadingWhiteSpace", True)
            .option("ignoreTrailingWhiteSpace", True)
            .option("mode", "FAILFAST")
            .option("pathGlobFilter", pattern)
            .csv(paths)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"CSV not found: {paths}") from error
        raise
    if season_from_file:
        stem = F.regexp_extract(F.col("_metadata.file_name"), _FILE_STEM, 1)
        return rows.select("*", stem.alias("_stem")).withColumn("season", F.col("_stem")).drop("_stem")
    return rows.filter(F.col("season") == season) if season else rows


def load_matches(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """CSV files as canonical matches; raises when there are none (FileNotFoundError) or when they hold no rows."""
    rows = read_csv(spark, path, **options)
    if not rows.inputFiles():
        raise FileNotFoundError(f"CSV not found: {path}")
    return require_rows(schema.canonical(rows), str(path))
