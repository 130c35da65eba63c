"""The prefix trie of rebuilt conversations, by composable fingerprints.

A rebuilt conversation is the head of a base conversation followed by a conversation's own turns behind its head. Its
prefixes are the trie's nodes. Turns multiply in a monoid whose product is a polynomial fingerprint modulo 2^127 - 1,

    f(t1 ... tn) = e1 + e2 B + ... + en B^(n-1),        f(x y) = f(x) + B^|x| f(y),

so that the fingerprint of a rebuilt prefix comes from two stored prefix products, of the base and of the own turns; no
rebuilt text is ever made. One pass over all turns in order gives running products, by which the product of any stretch
of a conversation is a difference times a power of B; a conversation may lie on any number of partitions.

A row (conversation, depth) refers to the stored turn that ends the prefix, by its SHA-256. Rows of equal depth and
fingerprint form a node. They are equal if they refer to equal turns and their parents, again nodes, are one; this is
checked for every node, and another B is taken if it fails.

A node is named by its smallest member. Down a path the smallest member grows, so each conversation names one stretch of
its own path, from its top to its end, and these stretches part the trie. Sums over subtrees follow: a node's own
stretch from it on, and for each other member the whole of that member's stretch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.support import arrow_rows, batches_of, stored
from touchline.operators.keyed import broadcast_if_small

PRIME = (1 << 127) - 1
MOST_HEAD = 5  # turns that a base lends at most
_LOW = (1 << 64) - 1
_KEY = ["depth", "f1", "f2"]
_LONG = pa.int64()
_MEMBER = ["conv", "depth", "f1", "f2", "p1", "p2", "t1", "t2", "chars", "ends"]
_MEMBER_DDL = ", ".join(f"{c} bigint" for c in _MEMBER)
_EMPTY = hashlib.sha256().hexdigest()


def base_of(seed: int) -> int:
    return int.from_bytes(hashlib.sha256(f"turns {seed}".encode()).digest()[:16], "big") % (PRIME - 2) + 2


def _halves(value: int) -> tuple[int, int]:
    """A number below 2^128 as two signed 64-bit ones."""
    high, low = value >> 64, value & _LOW
    return high - (high >> 63 << 64), low - (low >> 63 << 64)


def _whole(high: int, low: int) -> int:
    return (high & _LOW) << 64 | low & _LOW


def _products(turns: DataFrame, base: int) -> DataFrame:
    """The turns in order with the running products of their partition, before and after each of them.

    (part, place, conv, t1, t2, chars, rank, b1, b2, a1, a2): rank counts a conversation's turns within the partition.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            part = TaskContext.get().partitionId()
            value, power, last, rank = 0, 1, None, 0
            for place, (conv, name, chars) in enumerate(arrow_rows(batches)):
                number = int.from_bytes(name, "big")
                before, value = value, (value + (number % PRIME + 1) * power) % PRIME
                power = power * base % PRIME
                rank, last = rank + 1 if conv == last else 0, conv
                yield part, place, conv, *_halves(number), chars, rank, *_halves(before), *_halves(value)

        return batches_of(rows(), [_LONG] * 11, ["part", "place", "conv", "t1", "t2", "chars", "rank", "b1", "b2", "a1", "a2"], size=5000)

    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    slim = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.left(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), F.lit(32))).alias("name"),
        F.char_length(text).cast("bigint").alias("chars"),
    )
    ordered = slim.repartitionByRange("conv", "turn", "name").sortWithinPartitions("conv", "turn", "name")
    return ordered.select("conv", "name", "chars").mapInArrow(
        scan, "part bigint, place bigint, conv bigint, t1 bigint, t2 bigint, chars bigint, rank bigint, b1 bigint, b2 bigint, a1 bigint, a2 bigint"
    )


def _absolute(products: DataFrame, base: int) -> DataFrame:
    """The same over all partitions: `pos` instead of part and place. One row per partition passes through the driver."""
    ends = products.groupBy("part").agg(F.count("*").alias("n"), F.max_by(F.struct("a1", "a2"), "place").alias("end")).collect()
    offsets, total, rows = {}, 0, 0
    for end in sorted(ends, key=itemgetter("part")):
        power = pow(base, rows, PRIME)
        offsets[end["part"]] = total, power, rows
        total, rows = (total + power * _whole(*end["end"])) % PRIME, rows + end["n"]

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for part, place, conv, t1, t2, chars, rank, b1, b2, a1, a2 in arrow_rows(batches):
                total, power, first = offsets[part]
                before = _halves((total + power * _whole(b1, b2)) % PRIME)
                yield conv, first + place, t1, t2, chars, rank, *before, *_halves((total + power * _whole(a1, a2)) % PRIME)

        return batches_of(rows(), [_LONG] * 10, ["conv", "pos", "t1", "t2", "chars", "rank", "b1", "b2", "a1", "a2"], size=5000)

    return products.mapInArrow(
        shift, "conv bigint, pos bigint, t1 bigint, t2 bigint, chars bigint, rank bigint, b1 bigint, b2 bigint, a1 bigint, a2 bigint"
    )


def _shared(turns: DataFrame, sharing: Column, head: Column, most: int) -> DataFrame:
    """A row per conversation: where its turns begin, how many they are, its first ones, and the same of its base."""
    first_turns = F.collect_list(F.when(F.col("rank") < most, F.struct("pos", "t1", "t2", "chars", "b1", "b2", "a1", "a2")))
    facts = stored(
        turns.groupBy("conv").agg(F.count("*").alias("n"), F.min("pos").alias("first"), first_turns.alias("_h")).select(
            "conv", "n", "first", F.slice(F.sort_array("_h"), 1, most).alias("turns")
        ), "conversations",
    )
    named = facts.withColumn("conv_id", F.col("conv")).select("*", sharing.alias("of"), head.alias("head")).drop("conv_id")
    lent = facts.select(F.col("conv").alias("of"), F.col("n").alias("lent_n"), F.col("first").alias("lent_first"), F.col("turns").alias("lent"))
    return stored(named.join(lent, "of", "left"), "shared")


def _head_of(row: dict, base: int) -> list[int]:
    """Fingerprints of the rebuilt conversation's prefixes that its base lends, from the empty one on."""
    count = min(row["head"], row["lent_n"] or 0)
    if not count:
        return [0]
    start = _whole(row["lent"][0]["b1"], row["lent"][0]["b2"])
    scale = pow(base, -row["lent_first"], PRIME)
    return [0, *[(_whole(t["a1"], t["a2"]) - start) * scale % PRIME for t in row["lent"][:count]]]


def _members(turns: DataFrame, shared: DataFrame, base: int) -> DataFrame:
    """(conv, depth, fingerprint, parent's fingerprint, turn, chars, ends) of every prefix of every rebuilt conversation."""
    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for row in batch.to_pylist():
                    found = _head_of(row, base)
                    length = len(found) - 1 + max(0, row["n"] - row["head"])
                    for depth, value in enumerate(found):
                        turn = row["lent"][depth - 1] if depth else {"t1": 0, "t2": 0, "chars": 0}
                        parent = _halves(found[depth - 1] if depth else 0)
                        yield row["conv"], depth, *_halves(value), *parent, turn["t1"], turn["t2"], turn["chars"], int(depth == length)

        return batches_of(rows(), [_LONG] * 10, _MEMBER, size=5000)

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of conversations with own turns: the first one's place, and what turns a running product into a fingerprint."""
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for row in batch.to_pylist():
                    if row["n"] > row["head"]:
                        found, own = _head_of(row, base), row["turns"]
                        depth, start = len(found) - 1, row["first"] + row["head"]
                        before = (own[row["head"] - 1]["a1"], own[row["head"] - 1]["a2"]) if row["head"] else (own[0]["b1"], own[0]["b2"])
                        scale = pow(base, depth - start, PRIME)
                        yield row["conv"], start, depth, depth + row["n"] - row["head"], *_halves(found[-1]), *before, *_halves(scale)

        names = ["conv", "start", "lent", "length", "h1", "h2", "o1", "o2", "s1", "s2"]
        return batches_of(rows(), [_LONG] * 10, names, size=5000)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for conv, pos, t1, t2, chars, b1, b2, a1, a2, start, lent, length, h1, h2, o1, o2, s1, s2 in arrow_rows(batches):
                head, opening, scale = _whole(h1, h2), _whole(o1, o2), _whole(s1, s2)
                value = _halves((head + (_whole(a1, a2) - opening) * scale) % PRIME)
                parent = _halves((head + (_whole(b1, b2) - opening) * scale) % PRIME)
                depth = lent + pos - start + 1
                yield conv, depth, *value, *parent, t1, t2, chars, int(depth == length)

        return batches_of(rows(), [_LONG] * 10, _MEMBER, size=5000)

    ddl = ", ".join(f"{c} bigint" for c in ["conv", "start", "lent", "length", "h1", "h2", "o1", "o2", "s1", "s2"])
    begun = broadcast_if_small(stored(shared.mapInArrow(starts, ddl), "starts"))
    joined = turns.drop("rank").join(begun, "conv").where("pos >= start")
    return shared.mapInArrow(heads, _MEMBER_DDL).union(joined.mapInArrow(own, _MEMBER_DDL))


def _nodes(members: DataFrame) -> DataFrame:
    """A row per node; `torn` where its members do not all end in the same turn of the same parent."""
    same = ["p1", "p2", "t1", "t2"]
    found = members.groupBy(*_KEY).agg(
        F.min("conv").alias("rep"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.sum("ends").alias("n_ends"),
        F.min(F.when(F.col("ends") == 1, F.col("conv"))).alias("one_end"), *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"x{c}") for c in same],
    )
    torn = F.struct(*same) != F.struct(*[F.col(f"x{c}") for c in same])
    return found.select(*_KEY, "rep", "n_convs", "chars", "n_ends", "one_end", "p1", "p2", torn.alias("torn"))


def _stretches(nodes: DataFrame) -> DataFrame:
    """The nodes with `saved`, summed over their name's stretch from the node to its end, and `top`: its first node.

    Nodes are sorted by name and falling depth; what crosses a partition's border is settled by a row per partition.
    """
    names = [*nodes.columns, "part", "place", "run", "top"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, last, run, held = TaskContext.get().partitionId(), 0, None, 0, None
        for batch in batches:
            rep = batch.column("rep").to_numpy()
            if not len(rep):
                continue
            saved = (batch.column("n_convs").to_numpy() - 1) * batch.column("chars").to_numpy()
            opens = np.concatenate([[rep[0] != last], rep[1:] != rep[:-1]])
            sums = np.cumsum(saved)
            starts = np.flatnonzero(opens)
            before = np.zeros(len(rep), np.int64)
            before[: starts[0] if len(starts) else len(rep)] = -run  # the run goes on from the batch before
            if len(starts):
                before[starts[0] :] = np.repeat(sums[starts] - saved[starts], np.diff(np.append(starts, len(rep))))
            runs = sums - before
            if held is not None:
                yield close(held, bool(opens[0]))
            held = [*batch.columns, pa.array(np.full(len(rep), part)), pa.array(np.arange(place, place + len(rep))), pa.array(runs)], opens[1:]
            place, last, run = place + len(rep), rep[-1], int(runs[-1])
        if held is not None:
            yield close(held, None)

    def close(held: tuple, ends: bool | None) -> pa.RecordBatch:
        """top of a batch's last row is known by the next batch; of a partition's last row by the next partition."""
        columns, opens = held
        return pa.RecordBatch.from_arrays([*columns, pa.array([*opens.tolist(), ends], pa.bool_())], names)

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    ordered = nodes.repartitionByRange("rep", F.desc("depth")).sortWithinPartitions("rep", F.desc("depth"))
    local = stored(ordered.mapInArrow(scan, f"{ddl}, part bigint, place bigint, run bigint, top boolean"), "stretches")
    borders = local.groupBy("part").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.max_by("run", "place").alias("run")).collect()
    borders.sort(key=itemgetter("part"))
    rows, carry, last = [], 0, None
    for here, behind in zip(borders, [*borders[1:], None]):
        carry = carry if here["low"] == last else 0
        rows.append((here["part"], here["low"], carry, behind is None or behind["low"] != here["high"]))
        carry, last = here["run"] + (carry if here["low"] == here["high"] else 0), here["high"]
    spark = nodes.sparkSession
    # A row per partition of the sort above.
    known = F.broadcast(spark.createDataFrame(rows, "part bigint, low bigint, carry bigint, closes boolean"))
    saved = F.col("run") + F.when(F.col("rep") == F.col("low"), F.col("carry")).otherwise(0)
    return local.join(known, "part").select(*nodes.columns, saved.alias("saved"), F.coalesce("top", "closes").alias("top"))


def _end_digests(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes at which several conversations end.

    Ids are sorted over all partitions and joined to texts there; only these texts of a node pass through one task.
    """
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for key, group in groupby(arrow_rows(batches), itemgetter(0, 1, 2)):
                while some := [conv for *_, conv in zip(range(50_000), map(itemgetter(3), group))]:
                    yield *key, some[0], ",".join(map(str, some))

        return batches_of(rows(), [*[_LONG] * 4, pa.string()], [*_KEY, "first", "ids"], size=20)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for key, group in groupby(arrow_rows(batches, 20), itemgetter(0, 1, 2)):
                sha, begun = hashlib.sha256(), False
                for *_, ids in group:
                    sha.update((("," if begun else "") + ids).encode())
                    begun = True
                yield *key, sha.hexdigest()

        return batches_of(rows(), [*[_LONG] * 3, pa.string()], [*_KEY, "several_sha256"])

    several = broadcast_if_small(nodes.where("n_ends > 1").select(*_KEY))
    ends = members.where("ends = 1").select(*_KEY, "conv").join(several, _KEY, "left_semi")
    ordered = ends.repartitionByRange(*_KEY, "conv").sortWithinPartitions(*_KEY, "conv").select(*_KEY, "conv")
    joined = ordered.mapInArrow(texts, "depth bigint, f1 bigint, f2 bigint, first bigint, ids string")
    joined = joined.repartition(*_KEY).sortWithinPartitions(*_KEY, "first")
    return joined.mapInArrow(digest, "depth bigint, f1 bigint, f2 bigint, several_sha256 string")


def prefix_trie(
    turns: DataFrame, sharing: Column | None = None, head: Column | None = None, most_head: int = MOST_HEAD, seed: int = 0
) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node.

    `turns` has conv_id, turn, role and text; a conversation's turns are taken by turn (NULL first), equal ones by the
    SHA-256 of role and text. `sharing` names by conv_id the conversation whose first `head` turns (0 to most_head) replace
    as many own ones; by default nothing is shared. NULL roles and texts count as empty; rows without conv_id play no
    part, nor do further columns; equal rows are turns of their own. An empty table gives no node, else there is a root.
    """
    sharing = F.col("conv_id") if sharing is None else sharing
    head = F.lit(0) if head is None else head
    while True:
        base = base_of(seed)
        products = _absolute(stored(_products(turns, base), "products"), base)
        shared = _shared(products, sharing.cast("bigint"), head.cast("bigint"), most_head)
        members = stored(_members(products, shared, base), "members")
        nodes = _stretches(_nodes(members))
        if nodes.where("torn").isEmpty():
            break
        seed += 1  # two different sequences have one fingerprint
    nodes = stored(nodes, "nodes")
    tops = nodes.where("top").select(*_KEY, "rep", "p1", "p2", "saved")
    parent = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2")]
    hung = stored(tops.where("depth > 0").select(*parent).groupBy(*_KEY).agg(F.count("*").alias("hung")), "hung")
    above = tops.where("depth > 0").select(*parent, F.col("rep").alias("below")).join(nodes.select(*_KEY, F.col("rep").alias("above")), _KEY)
    at_end = F.col("one_end").eqNullSafe(F.col("rep"))
    # Names whose last node has children: prefixes of other conversations.
    inner = stored(nodes.where(at_end).join(hung, _KEY, "left_semi").select("rep"), "inner")
    inner = broadcast_if_small(inner.select("rep", F.lit(True).alias("goes_on")))
    leaf = F.when(F.col("goes_on"), 0).otherwise(1)
    names = tops.join(inner, "rep", "left").select(F.col("rep").alias("conv"), F.col("depth").alias("d0"), "saved", leaf.alias("leaf"))
    lower = members.select("conv", *_KEY).join(names, "conv").where("depth < d0").groupBy(*_KEY).agg(
        F.sum("saved").alias("more_saved"), F.sum("leaf").alias("more_leaves")
    )
    tops_above = tops.select(*_KEY, "rep").join(above.select(F.col("below").alias("rep"), "above"), "rep").select(*_KEY, "above")
    whole = nodes.join(hung, _KEY, "left").join(lower, _KEY, "left").join(tops_above, _KEY, "left")
    whole = whole.join(_end_digests(members, nodes), _KEY, "left").join(inner, "rep", "left")
    or_none = lambda c: F.coalesce(F.col(c), F.lit(0))
    one = F.when(F.col("n_ends") == 0, F.lit(_EMPTY)).when(F.col("n_ends") == 1, F.sha2(F.col("one_end").cast("string"), 256))
    return whole.select(
        F.col("rep").alias("conv_id"), "depth",
        F.when(F.col("depth") > 0, F.when(F.col("top"), F.col("above")).otherwise(F.col("rep"))).alias("parent_conv_id"), "n_convs",
        (or_none("hung") + F.when(at_end, 0).otherwise(1)).alias("n_children"), (leaf + or_none("more_leaves")).alias("n_leaves"),
        (F.col("saved") + or_none("more_saved")).alias("saved_tokens"), one.otherwise(F.col("several_sha256")).alias("ends_sha256"),
    )
