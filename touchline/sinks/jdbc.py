"""JDBC writes and the SQL of a staging-to-target upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from touchline.sources.jdbc import JdbcTarget


def write_options(connections: int, batch_rows: int, truncate: bool) -> dict[str, str]:
    return {
        "numPartitions": str(connections),
        "batchsize": str(batch_rows),
        "truncate": "true" if truncate else "false",
    }


def write_jdbc(
    df: DataFrame,
    target: JdbcTarget,
    table: str,
    mode: str = "overwrite",
    truncate: bool = False,
    connections: int = 16,
    batch_rows: int = 500,
) -> None:
    """Write to a table over a bounded number of connections; `truncate` empties it instead of recreating it."""
    options = write_options(connections, batch_rows, truncate)
    df.write.options(**options).jdbc(target.url, table, mode=mode, properties=target.properties())


def upsert_statement(target: str, staging: str, columns: Sequence[str], key: str) -> str:
    """The statement a database runs to merge a refilled staging table into its target."""
    listed = ", ".join(columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c != key)
    return (
        f"INSERT INTO {target} ({listed}) SELECT {listed} FROM {staging} "
        f"ON CONFLICT ({key}) DO UPDATE SET {updates}"
    )
