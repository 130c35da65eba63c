"""JDBC tables. Reads are split over executors by a numeric column or by explicit predicates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """Where a database lives; credentials are the caller's business."""

    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def properties(self) -> dict[str, str]:
        named = {"user": self.user, "password": self.password, "driver": self.driver}
        return {**{k: v for k, v in named.items() if v is not None}, **self.extra}


def postgres(host: str, port: int | str, database: str, user: str, password: str) -> JdbcTarget:
    return JdbcTarget(f"jdbc:postgresql://{host}:{port}/{database}", user, password, "org.postgresql.Driver")


def read_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Read a table; without a partition column or predicates one connection reads all of it."""
    if predicates:
        return spark.read.jdbc(target.url, table, predicates=list(predicates), properties=target.properties())
    if partition_column:
        if bounds is None or partitions is None:
            raise ValueError("a partitioned read needs bounds and a number of partitions")
        return spark.read.jdbc(
            target.url, table, column=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=partitions, properties=target.properties(),
        )
    return spark.read.jdbc(target.url, table, properties=target.properties())


def season_predicates(seasons: Sequence[str], column: str = "season") -> list[str]:
    """One disjoint predicate per season, plus one for rows without a season or with another one."""
    quoted = ["'" + s.replace("'", "''") + "'" for s in seasons]
    listed = ", ".join(quoted)
    return [f"{column} = {q}" for q in quoted] + [f"{column} IS NULL OR {column} NOT IN ({listed})"]
