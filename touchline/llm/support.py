"""What the operators of this subpackage share: tables, stored intermediate results, connected components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from touchline.session import free_shuffles, scratch_path
from touchline.sinks.lake import remove_paths

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """The installed file of a public tokenizer, or the path itself when one is given."""
    return name if os.path.isabs(name) else str(public_tokenizers.path(name))


def stored(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared scratch folder and read back: its lineage ends there, so a lost executor repeats little."""
    free_shuffles(df.sparkSession)  # what is stored needs its shuffles no more
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more, also not the result to come."""
    for df in tables:
        remove_paths(df.sparkSession, [df.stored_at])


def carried(docs: DataFrame, own: tuple[str, ...] = ("doc_id", "text")) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with its own columns and all others, whatever their names, in one column `carried`; and the way back.

    What an operator adds in between can then clash with no column that rides along."""
    rest = [c for c in docs.columns if c not in own]
    packed = F.struct(*[docs[f"`{c}`"].alias(f"c{k}") for k, c in enumerate(rest)]) if rest else F.lit(0)

    def back(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in own else F.col(f"carried.c{rest.index(c)}").alias(c) for c in docs.columns])

    return docs.select(*[c for c in docs.columns if c in own], packed.alias("carried")), back


def arrow_rows(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, so many of them as Python values at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield from zip(*[c.to_pylist() for c in batch.slice(begin, rows).columns])


def batches_of(
    rows: Iterable[tuple], kinds: list[pa.DataType | None], names: list[str], own: DataType | None = None, size: int = 500
) -> Iterator[pa.RecordBatch]:
    """Arrow batches of so many rows each; a kind that is None is that of the Spark type `own`."""
    kinds = [to_arrow_type(own) if k is None else k for k in kinds]
    rows = iter(rows)
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """The smallest reachable node of each node in `edges` (a, b: bigint), as (node, component).

    Every round hangs each node under the smallest node among its neighbours and their parents, then replaces the
    ends of every edge by their roots; edges inside one tree vanish and the rest connects roots only, so the edge
    set shrinks geometrically. A hot node is an aggregate's key with partial sums before the shuffle, nothing is
    collected, and each round is a stored table. Rounds follow the logarithm of the longest chain.
    """
    links = stored(
        edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), label
    )
    nodes = links.select(F.explode(F.array("lo", "hi")).alias("node")).distinct().select("node", F.col("node").alias("root"))
    roots = stored(nodes, label)
    while not links.isEmpty():
        # The larger end of each edge takes the smallest neighbour as parent: parents are smaller, so no cycle forms.
        used = [links, roots]
        parent = stored(links.groupBy("hi").agg(F.min("lo").alias("up")), label)
        while True:  # pointer jumping: parents of parents until all of them are roots
            above = parent.select(F.col("hi").alias("up"), F.col("up").alias("top"))
            jumped = stored(
                parent.join(above, "up", "left").select("hi", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")),
                label,
            )
            used += [parent] if hasattr(parent, "stored_at") else []
            used.append(jumped)
            parent = jumped.select("hi", "up")
            if jumped.where("moved").isEmpty():
                break
        up = parent.select(F.col("hi").alias("root"), "up")
        roots = stored(roots.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), label)
        lo = parent.select(F.col("hi").alias("lo"), F.col("up").alias("lo_up"))
        hi = parent.select("hi", F.col("up").alias("hi_up"))
        ends = links.join(lo, "lo", "left").join(hi, "hi", "left").select(
            F.coalesce("lo_up", "lo").alias("x"), F.coalesce("hi_up", "hi").alias("y")
        )
        links = stored(ends.where("x <> y").select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).distinct(), label)
        dropped(*used)
    return roots.select("node", F.col("root").alias("component"))
