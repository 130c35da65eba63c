"""MERGE into a stored table by key.

Parquet tables have no row-level MERGE, so it is spelled out with joins: an insert-only merge appends what is new,
an upsert rewrites the partitions in which a row really changes. Both are safe to repeat. For catalogs with a MERGE of their own
(Delta, Iceberg) `merge_into_catalog_table` hands the work to it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators.keyed import (
    broadcast_if_small, newest_per_key, size_columns, small_enough, unseen, update_some_rows,
)
from touchline.sinks.lake import move_over, remove_paths, write_table
from touchline.sources.lake import read_table_or_none

def merge_table(
    source: DataFrame,
    path: str,
    layout: T.StructType,
    keys: Sequence[str],
    mode: str = "upsert",
    order_by: Sequence[str] = (),
    partition_by: str | None = "season",
    update: Sequence[str] | None = None,
    oldest: bool = False,
    guard: Sequence[str] = (),
    changes: str | None = None,
) -> int:
    """Merge source rows into the table at `path`, creating it if absent; returns the number of rows added or changed.

    `upsert` lets source rows win, `insert_only` lets stored rows win, or with `guard` the row that came first. With `update`, an upsert changes only those
    columns of a stored row and the others keep their stored values. Repeated keys in the source are reduced to the
    newest (with `oldest`, the oldest) by `order_by` first; those columns need not be stored. In an upsert, a stored row
    that is greater by the `guard` columns than the source's stays as it is. Rows equal to the stored ones are left out, so
    a repeated upsert writes nothing.

    With `changes`, a path of this merge's own, the changed rows are left there as (old, new) before the table is
    touched: old is NULL for an added row.
    """
    if mode not in ("upsert", "insert_only"):
        raise ValueError(f"unknown merge mode {mode!r}")
    ranked = source.select(*layout.names, *[c for c in order_by if c not in layout.names])
    newest = newest_per_key(ranked, keys, order_by, oldest).select(*layout.names).persist()
    try:
        probe = newest.select(*keys)
        lead = F.col(keys[0])
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        seen = probe.agg(
            *size_columns(probe), F.count_if(missing).alias("missing"), F.min(lead).alias("low"), F.max(lead).alias("high")
        ).first()
        if seen["missing"]:
            raise ValueError(f"cannot merge rows without a key ({', '.join(keys)})")
        rows = seen["rows"]
        if rows == 0:
            return 0
        target = read_table_or_none(source.sparkSession, path, layout)
        if target is None:
            _leave_changes(newest, changes, layout)
            write_table(newest, path, "append", partition_by, sort_by=keys)
            return rows
        few = small_enough(rows, seen["bytes"])
        if few:
            probe = F.broadcast(probe)
        # Only row groups whose key range meets the source's are read in search of matches; tables are written
        # sorted by key, so these are few when keys grow with time.
        reachable = target.filter(lead.between(seen["low"], seen["high"]))
        if mode == "insert_only" and not guard:
            return append_counted(unseen(newest, reachable, keys, probe), path, keys, partition_by, changes)
        # A broadcast probe narrows the table to its hits before they meet the source; without one that is one join more.
        if mode == "insert_only":
            near = reachable.join(probe, list(keys), "left_semi") if few else reachable
            places = near.select(*keys, F.struct(*guard).alias("_old"))
            judged = newest.join(places, list(keys), "left").withColumn("_earlier", F.struct(*guard) < F.col("_old"))
            judged = judged.filter("_old IS NULL OR _earlier").select(*layout.names, F.col("_old").isNotNull().alias("_earlier")).persist()
            try:
                fresh = judged.select(*layout.names)
                if judged.filter("_earlier").isEmpty():  # the common case: nothing stored is touched
                    return append_counted(fresh, path, keys, partition_by, changes)
                return _upsert_held(fresh, reachable, broadcast_if_small(fresh.select(*keys)), target, path, layout, keys, partition_by, update, (), changes)
            finally:
                judged.unpersist()
        if few or update is not None:
            return _upsert_held(newest, reachable, probe, target, path, layout, keys, partition_by, update, guard, changes)
        return _upsert(newest, reachable, target, path, layout, keys, partition_by, update, guard, changes)
    finally:
        newest.unpersist()


def _leave_changes(rows: DataFrame, path: str | None, layout: T.StructType, old: str = "_old", new: bool = True) -> None:
    """Rows as (old, new) at the path, if there is one."""
    if path:
        row = F.struct(*layout.names)
        before = F.col(old) if old in rows.columns else F.lit(None).cast(layout)
        rows.select(before.alias("old"), (row if new else F.lit(None).cast(layout)).alias("new")).write.parquet(path)


def _upsert_held(newest, reachable, probe, target, path, layout, keys, partition_by, update, guard, changes) -> int:
    """The same as _upsert, with the rows to be replaced fetched once."""
    held = reachable.join(probe, list(keys), "left_semi").select(*layout.names).persist()
    try:
        return _upsert(newest, held, target, path, layout, keys, partition_by, update, guard, changes)
    finally:
        held.unpersist()


def _upsert(newest, held, target, path, layout, keys, partition_by, update, guard, changes) -> int:
    """Write the rows that differ from those held; their partitions are replaced."""
    incoming = newest if update is None else update_some_rows(held, newest, keys, update)
    old = held.select(*keys, F.struct(*layout.names).alias("_old"))
    other = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_old.{c}")) for c in layout.names])
    if guard:
        other = other & ~F.coalesce(F.struct(*[F.col(f"_old.{c}") for c in guard]) > F.struct(*guard), F.lit(False))
    changed = incoming.join(old, list(keys), "left").filter(F.col("_old").isNull() | other)
    came_from = F.col(f"_old.{partition_by}" if partition_by else f"_old.{keys[0]}").alias("_from")
    replaces = F.col("_old").isNotNull().alias("_replaces")
    changed = changed.select(*layout.names, came_from, replaces, *(["_old"] if changes else [])).persist()
    try:
        rows = changed.count()
        if not rows:
            return 0
        _leave_changes(changed, changes, layout)
        touched = None
        if partition_by:
            # One value per partition, which Spark's file index keeps on the driver as well.
            both = F.when(F.col("_replaces"), F.array(partition_by, "_from")).otherwise(F.array(partition_by))
            touched = [r[0] for r in changed.select(F.explode(both).alias(partition_by)).distinct().collect()]
        _rewrite(changed.select(*layout.names), target, touched, path, layout, keys, partition_by)
        return rows
    finally:
        changed.unpersist()


def append_counted(fresh: DataFrame, path: str, keys: Sequence[str], partition_by: str | None, changes: str | None = None) -> int:
    """Append rows, leaving no files behind when there are none, and count them without a second join."""
    fresh = fresh.persist()
    try:
        rows = fresh.count()
        if rows:
            _leave_changes(fresh, changes, fresh.schema)
            write_table(fresh, path, "append", partition_by, sort_by=keys)
        return rows
    finally:
        fresh.unpersist()


def remove_from_table(
    gone: DataFrame, path: str, layout: T.StructType, keys: Sequence[str], partition_by: str = "season", changes: str | None = None
) -> int:
    """Delete the rows with these keys from a stored table, rewriting the partitions that hold any; returns their number.

    `changes` as in merge_table: new is NULL."""
    target = read_table_or_none(gone.sparkSession, path, layout)
    if target is None:
        return 0
    probe = broadcast_if_small(gone.select(*keys).distinct())
    held = target.join(probe, list(keys), "left_semi").select(*layout.names).persist()
    try:
        rows = held.count()
        if rows:
            _leave_changes(held.withColumn("_old", F.struct(*layout.names)), changes, layout, new=False)
            touched = [r[0] for r in held.select(partition_by).distinct().collect()]
            _rewrite(held, target, touched, path, layout, keys, partition_by, keep=False)
        return rows
    finally:
        held.unpersist()


def _rewrite(changed, target, touched, path, layout, keys, partition_by, keep: bool = True) -> None:
    """Replace the touched partitions (None: an unpartitioned table) by their merged rows, or without those of `changed`.

    The merged rows are written once, next to the table, under a name of their own and with its partitions: nothing is
    read while it is replaced, and two merges do not meet. Each partition's folder is then moved into the place of the old
    one; when this is interrupted, what is left of the copy has to be moved still.
    """
    spark = changed.sparkSession
    affected = target if touched is None else target.filter(_is_one_of(partition_by, touched))
    probe = broadcast_if_small(changed.select(*keys))
    merged = affected.join(probe, list(keys), "left_anti")
    merged = merged.unionByName(changed) if keep else merged

    staging = f"{path.rstrip('/')}__merge-{uuid.uuid4().hex}"
    write_table(merged, staging, "append", partition_by, sort_by=keys)
    staged = spark.read.schema(layout).parquet(staging)
    old_files = affected.select(F.col("_metadata.file_path").alias("file"), *([partition_by] if partition_by else []))
    emptied = []
    if partition_by:
        filled = [r[0] for r in staged.select(partition_by).distinct().collect()]
        gone = [v for v in touched if v not in filled]
        if gone:  # a partition whose last row moved away gets no new rows, so its files have to go
            emptied = [r[0] for r in old_files.filter(_is_one_of(partition_by, gone)).select("file").distinct().collect()]
    move_over(spark, staging, path, partition_by)
    remove_paths(spark, emptied, encoded=True)
    spark.catalog.refreshByPath(path)


def _is_one_of(column: str, values: list):
    listed = [v for v in values if v is not None]
    inside = F.col(column).isin(listed)
    return inside | F.col(column).isNull() if len(listed) < len(values) else inside


def message_order(columns: Sequence[str]) -> list[str]:
    """The columns that tell a message's place, as far as the rows have them."""
    return [c for c in ("kafka_timestamp", "kafka_partition", "kafka_offset") if c in columns]


def stage_messages(messages: DataFrame, path: str, layout: T.StructType, keys: Sequence[str] = ("match_id",)) -> int:
    """Upsert drained messages into the staging table, stamped with the time of ingest.

    The last message of a key wins, also over one that is drained after it: the place of a row's message is stored."""
    order = message_order(messages.columns)
    extra = [messages.schema[c] for c in order if c not in layout.names]
    stored = T.StructType([*layout.fields, *extra, T.StructField("ingested_at", T.TimestampType())])
    stamped = messages.select(*layout.names, *[f.name for f in extra]).withColumn("ingested_at", F.current_timestamp())
    return merge_table(stamped, path, stored, keys, order_by=[*order, "ingested_at"], guard=order)


def merge_into_catalog_table(
    source: DataFrame, table: str, keys: Sequence[str], mode: str = "upsert", order_by: Sequence[str] = ()
) -> None:
    """The same merge for a catalog table whose format supports MERGE."""
    newest = newest_per_key(source, keys, order_by).alias("source")
    same = F.expr(" AND ".join(f"{table}.{k} = source.{k}" for k in keys))
    merge = newest.mergeInto(table, same)
    if mode == "upsert":
        merge = merge.whenMatched().updateAll()
    merge.whenNotMatched().insertAll().merge()
