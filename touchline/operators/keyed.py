"""Key-based operators: newest row per key, existence tests, and row merges.

The pattern throughout: a merge source is small next to its target, so the target is only ever streamed past the
source's keys. Keys are broadcast when measured to be few and short; otherwise Spark joins by shuffle, where
adaptive execution splits skewed partitions. Keys must not be NULL: a NULL equals nothing, so it never matches.

A source is reduced and checkpointed once: it is measured, its matches are found and its rows are taken from there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import ensure_checkpoint_dir

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 * 1024 * 1024


def newest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), oldest: bool = False
) -> DataFrame:
    """One row per key: the greatest by `order_by` (the least with `oldest`), ties by the remaining columns.

    An aggregate rather than a window, so the many copies of a hot key collapse before the shuffle. Comparing
    structs that hold text makes it a sort aggregate; it still sums up on the map side.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ranked = [*order_by, *[c for c in rest if c not in order_by]]
    return (
        df.groupBy(*keys)
        .agg((F.min if oldest else F.max)(F.struct(*ranked)).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def settled(df: DataFrame) -> DataFrame:
    """df computed once, into the checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def size_columns(df: DataFrame) -> list[Column]:
    """Aggregates for the row count and an upper estimate of the bytes a broadcast of df would ship."""
    def width(field: T.StructField) -> Column:
        text = isinstance(field.dataType, (T.StringType, T.BinaryType))
        return F.coalesce(F.octet_length(field.name), F.lit(0)) + 16 if text else F.lit(16)

    row_bytes = reduce(lambda a, b: a + b, [width(f) for f in df.schema.fields]).cast("bigint")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")]


def small_enough(rows: int, size: int) -> bool:
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Mark df for broadcast after counting its rows and bytes; a larger one is left to a shuffle join."""
    seen = df.agg(*size_columns(df)).first()
    return F.broadcast(df) if small_enough(seen["rows"], seen["bytes"]) else df


def without_keys(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in `known` (left anti join)."""
    return rows.join(known.select(*keys), list(keys), "left_anti")


def unseen(source: DataFrame, target: DataFrame, keys: Sequence[str], probe: DataFrame | None = None) -> DataFrame:
    """Source rows whose key the target does not hold.

    Joining the large target on the build side would shuffle it; instead it is narrowed to the source's own keys
    first (a scan of the key column when the probe is broadcast), and only those hits meet the source.
    """
    probe = broadcast_if_small(source.select(*keys)) if probe is None else probe
    hits = target.select(*keys).join(probe, list(keys), "left_semi")
    return without_keys(source, hits, keys)


def upsert_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """MERGE with all columns updated: source rows win, the other target rows stay."""
    newest = settled(newest_per_key(source, keys, order_by))
    kept = target.join(broadcast_if_small(newest.select(*keys)), list(keys), "left_anti")
    return kept.unionByName(newest.select(*target.columns))


def insert_only_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """MERGE without update: target rows win, unknown keys are added."""
    fresh = unseen(settled(newest_per_key(source, keys, order_by)), target, keys)
    return target.unionByName(fresh.select(*target.columns))


def update_some_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """MERGE where a match changes only the `update` columns and everything else keeps its stored value."""
    newest = settled(newest_per_key(source, keys, order_by))
    changes, probe = newest.select(*keys, *update), newest.select(*keys)
    seen = changes.agg(*size_columns(changes)).first()
    if small_enough(seen["rows"], seen["bytes"]):
        changes, probe = F.broadcast(changes), F.broadcast(probe)
    changes = changes.select(*keys, F.struct(*update).alias("_new"))
    found = F.col("_new").isNotNull()
    columns = [
        F.when(found, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
        for c in target.columns
    ]
    changed = target.join(changes, list(keys), "left").select(*columns)
    return changed.unionByName(unseen(newest, target, keys, probe).select(*target.columns))


def count_duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: the number of keys that occur more than once (a NULL key is a group like any other)."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .agg(F.count(F.lit(1)).alias("duplicate_groups"))
    )


def count_orphans(mart: DataFrame, source: DataFrame, fk: str, pk: str) -> DataFrame:
    """One row: mart rows whose key the source lacks; every copy counts and a NULL key is an orphan.

    Both sides are reduced to one row per key before they meet, so no hot key travels.
    """
    references = mart.groupBy(F.col(fk).alias("_key")).agg(F.count(F.lit(1)).alias("copies"))
    known = source.select(F.col(pk).alias("_key")).distinct()
    orphans = references.join(known, "_key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("orphaned_rows"))
