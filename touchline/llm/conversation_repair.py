"""Conversation structure repair: turns are aligned with the alternating role grammar (see turn_alignment).

Conversations of up to LONG turns are repaired where a hash of their id brings them together. A longer one, which may
hold any share of all rows, is numbered by a range sort and cut into pieces of PIECE turns. Each piece is aligned by a
task of its own between all states, the pieces' scripts are joined per conversation from its last piece on, and each
piece is then repaired by itself. One task per conversation sees its scripts (a letter for each turn, as they are in
the result) and, for the digest, the repaired text as a stream.

Rows are taken by turn (NULL first), then by role and the text's SHA-256. A NULL role or text counts as one blank, so a
NULL text is blank; rows without conv_id form a conversation of their own. Equal rows are repetitions. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.native import BLANKS
from touchline.llm.support import arrow_rows, batches_of, stored
from touchline.llm.turn_alignment import Turn, alignments, applied, joined, whole_alignment
from touchline.operators.keyed import broadcast_if_small
from touchline.operators.numbering import number_rows

LONG = 1024  # turns above which a conversation is cut into pieces
PIECE = 512
_LEGAL = ("su", "ua", "au")
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_LINES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, gone) with the faults that a hash of conversation and turn deals out.

    A dropped row stays as `gone`, so that a conversation of which nothing else is left keeps its id.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    text = F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.translate("_t", ".!?", "")).otherwise(F.col("_t"))
    copies = F.when(F.col("_f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.select("conv_id", "turn", blank("role").alias("_r"), blank("text").alias("_t"), code.alias("_f"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_f") == 4, "user").otherwise(F.col("_r")).alias("role"), text.alias("text"),
        (F.col("_f") == 0).alias("gone"), F.explode(copies).alias("_copy"),
    ).drop("_copy")


def _judged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone, empty, cut, name): with what can be said of a row alone; name: the text's digest."""
    blanks = "".join(BLANKS)
    end = F.right(F.rtrim("text", F.lit(blanks)), F.lit(1))
    gone = F.coalesce("gone", F.lit(False)) if "gone" in rows.columns else F.lit(False)
    filled = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), gone.alias("gone"),
    )
    return filled.select("*", (end == "").alias("empty"), (~end.isin(".", "!", "?")).alias("cut"), F.sha2("text", 256).alias("name"))


class _Faults:
    """Counts over a conversation's rows as they pass by."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last: str | None = None

    def turn(self, role: str, empty: bool, repeated: bool, cut: bool) -> Turn:
        initial = role[:1]
        self.illegal += self.last is not None and self.last + initial not in _LEGAL
        self.last = initial
        cut = cut and not (empty or repeated)
        self.blank += empty
        self.duplicate += repeated and not empty
        self.truncated += cut
        return Turn(initial, empty or repeated, cut)


def _short(rows: DataFrame, keep: bool) -> DataFrame:
    """The result rows of whole conversations, with their repaired turns if kept."""
    kind = rows.schema["conv_id"].dataType

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            for conv, group in groupby(arrow_rows(batches), itemgetter(0)):
                faults, seen, turns, lines, numbers = _Faults(), set(), [], [], set()
                for _, turn, role, text, gone, empty, cut, name in group:
                    if gone:
                        continue
                    turns.append(faults.turn(role, empty, (role, name) in seen, cut))
                    seen.add((role, name))
                    lines.append((role, text))
                    numbers.add(turn)
                numbers.discard(None)
                gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
                cost, audit = whole_alignment(turns)
                repaired = list(applied(audit, lines))
                digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
                counts = gaps, faults.blank, faults.duplicate, faults.truncated, faults.illegal, cost
                yield (conv, *counts, audit, digest, *([[{"role": r, "text": t} for r, t in repaired]] if keep else []))

        return batches_of(results(), [None, *[pa.int64()] * 6, pa.string(), pa.string(), *([_LINES] if keep else [])],
                          ["conv_id", *_COUNTS, "audit", "repaired_sha256", *(["repaired"] if keep else [])], kind)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "name")
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    lines = ", repaired array<struct<role:string,text:string>>" if keep else ""
    return ordered.mapInArrow(repair, f"conv_id {kind.simpleString()}, {counts}, audit string, repaired_sha256 string{lines}")


class _Long:
    """Conversations in pieces. `first`, the place of its first row among all, names a conversation."""

    def __init__(self, rows: DataFrame, piece: int):
        numbered = number_rows(rows.where("not gone"), "conv_id", "turn", "role", "name")
        self.convs = stored(numbered.groupBy("conv_id").agg(
            F.min("position").alias("first"),
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        ), "long-conversations")
        few = broadcast_if_small(self.convs.select(F.col("conv_id").alias("_c"), "first"))
        placed = numbered.join(few, numbered["conv_id"].eqNullSafe(F.col("_c"))).withColumn(
            "piece", F.floor((F.col("position") - F.col("first")) / piece).cast("bigint")
        )
        again = placed.groupBy("first", "role", "name").agg(F.min("position").alias("said"), F.count("*").alias("n")).where("n > 1").drop("n")
        told = placed.join(broadcast_if_small(again), ["first", "role", "name"], "left")
        repeated = F.coalesce(F.col("position") > F.col("said"), F.lit(False)).alias("repeated")
        self.rows = stored(told.select("first", "piece", "position", "role", "text", "empty", repeated, "cut"), "long-turns")

    def _pieces(self) -> DataFrame:
        return self.rows.repartition("first", "piece").sortWithinPartitions("first", "piece", "position")

    def tables(self) -> DataFrame:
        """A row per piece: its faults and its cheapest scripts between all states."""
        def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def results() -> Iterator[tuple]:
                for (first, piece), group in groupby(arrow_rows(batches), itemgetter(0, 1)):
                    faults, turns = _Faults(), []
                    for _, _, _, role, empty, repeated, cut in group:
                        turns.append(faults.turn(role, empty, repeated, cut))
                    table = [{"enter": e, "leave": x, "cost": c, "audit": a} for (e, x), (c, a) in alignments(turns).items()]
                    yield (first, piece, faults.blank, faults.duplicate, faults.truncated, faults.illegal, turns[0].initial, turns[-1].initial, table)

            way = pa.struct([("enter", pa.string()), ("leave", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
            names = ["first", "piece", "blank", "duplicate", "truncated", "illegal", "opens", "closes", "ways"]
            return batches_of(results(), [*[pa.int64()] * 6, pa.string(), pa.string(), pa.list_(way)], names)

        return self._pieces().select("first", "piece", "position", "role", "empty", "repeated", "cut").mapInArrow(
            align, "first bigint, piece bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, opens string, "
            "closes string, ways array<struct<enter:string,leave:string,cost:bigint,audit:string>>"
        )

    def plans(self) -> DataFrame:
        """A row per piece with its chosen script, and with the conversation's sums in that of piece 0."""
        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def results() -> Iterator[tuple]:
                for first, group in groupby(arrow_rows(batches, 100), itemgetter(0)):
                    sums, behind = [0, 0, 0, 0], None

                    def tables() -> Iterator[tuple]:
                        nonlocal behind
                        for _, piece, *counts, opens, closes, ways in group:
                            sums[:] = map(sum, zip(sums, counts))
                            sums[3] += behind is not None and closes + behind not in _LEGAL
                            behind = opens
                            yield piece, {(w["enter"], w["leave"]): (w["cost"], w["audit"]) for w in ways}

                    cost, plan = joined(tables())
                    before = 0
                    for piece, enter, audit in plan:
                        yield (first, piece, before, enter, audit, *([*sums, cost] if piece == 0 else [None] * 5))
                        before += len(audit) - audit.count("D")  # everything but a deletion leaves a turn

            names = ["first", "piece", "before", "enter", "audit", "blank", "duplicate", "truncated", "illegal", "cost"]
            return batches_of(results(), [*[pa.int64()] * 3, pa.string(), pa.string(), *[pa.int64()] * 5], names)

        ordered = self.tables().repartition("first").sortWithinPartitions("first", F.desc("piece"))
        return ordered.mapInArrow(
            choose, "first bigint, piece bigint, before bigint, enter string, audit string, blank bigint, duplicate bigint, truncated bigint, "
            "illegal bigint, cost bigint"
        )

    def repaired(self, plans: DataFrame) -> DataFrame:
        """(first, piece, repaired) of every piece."""
        def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def results() -> Iterator[tuple]:
                for (first, piece, enter, audit), group in groupby(arrow_rows(batches), itemgetter(0, 1, 2, 3)):
                    lines = applied(audit, ((role, text) for *_, role, text in group), enter)
                    yield first, piece, [{"role": r, "text": t} for r, t in lines]

            return batches_of(results(), [pa.int64(), pa.int64(), _LINES], ["first", "piece", "repaired"], size=20)

        script = broadcast_if_small(plans.select("first", "piece", "enter", "audit"))
        ordered = self.rows.join(script, ["first", "piece"]).repartition("first", "piece").sortWithinPartitions("first", "piece", "position")
        return ordered.select("first", "piece", "enter", "audit", "role", "text").mapInArrow(
            repair, "first bigint, piece bigint, repaired array<struct<role:string,text:string>>"
        )

    def results(self, plans: DataFrame, pieces: DataFrame) -> DataFrame:
        """The result rows; each conversation's repaired text passes through one task, which its digest asks for."""
        def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def results() -> Iterator[tuple]:
                for first, group in groupby(arrow_rows(batches, 20), itemgetter(0)):
                    sha, begun, audit, counts = hashlib.sha256(), False, [], None
                    for _, _, script, blank, duplicate, truncated, illegal, cost, repaired in group:
                        counts = counts or (blank, duplicate, truncated, illegal, cost)
                        audit.append(script)
                        for line in repaired:
                            sha.update((("\n" if begun else "") + f"{line['role']}:{line['text']}").encode())
                            begun = True
                    yield (first, *counts, "".join(audit), sha.hexdigest())

            names = ["first", *_COUNTS[1:], "audit", "repaired_sha256"]
            return batches_of(results(), [*[pa.int64()] * 6, pa.string(), pa.string()], names)

        ordered = plans.drop("before", "enter").join(pieces, ["first", "piece"]).repartition("first").sortWithinPartitions("first", "piece")
        counts = ", ".join(f"{c} bigint" for c in _COUNTS[1:])
        found = ordered.mapInArrow(digest, f"first bigint, {counts}, audit string, repaired_sha256 string")
        return self.convs.join(found, "first").select("conv_id", *_COUNTS, "audit", "repaired_sha256")


def _parted(rows: DataFrame, long: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the short conversations and of the long ones, if there are any."""
    judged = _judged(rows)
    sizes = rows.groupBy(F.col("conv_id").alias("_c")).agg(F.count("*").alias("n")).where(F.col("n") > long).select("_c")
    sizes = stored(sizes, "long")
    if sizes.isEmpty():
        return judged, None
    few = broadcast_if_small(sizes)  # fewer than one for each `long` rows
    same = judged["conv_id"].eqNullSafe(F.col("_c"))
    return judged.join(few, same, "left_anti"), judged.join(few, same, "left_semi")


def repair(rows: DataFrame, long: int = LONG, piece: int = PIECE) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every conversation.

    `rows` has conv_id, turn, role and text, and may have a boolean `gone` for rows that only name their conversation.
    An empty table gives an empty result; a conversation without rows has zeros, an empty audit and the empty text's digest.
    """
    short, rest = _parted(rows, long)
    found = _short(short, False)
    if rest is None:
        return found
    parts = _Long(rest, piece)
    plans = stored(parts.plans(), "plans")
    results = parts.results(plans, parts.repaired(plans))
    # A long conversation whose rows are all gone is repaired as a short one without rows.
    lost = rest.where("gone").join(broadcast_if_small(parts.convs.select(F.col("conv_id").alias("_c"))), F.col("conv_id").eqNullSafe(F.col("_c")), "left_anti")
    return found.unionByName(results).unionByName(_short(lost.dropDuplicates(["conv_id"]), False))


def repaired_turns(rows: DataFrame, long: int = LONG, piece: int = PIECE) -> DataFrame:
    """(conv_id, place, role, text): the turns after repair, numbered from 0 in each conversation; inserted ones have an empty text."""
    short, rest = _parted(rows, long)
    pieces = _short(short, True).select("conv_id", F.lit(0).cast("bigint").alias("before"), "repaired")
    if rest is not None:
        parts = _Long(rest, piece)
        plans = stored(parts.plans(), "plans")
        named = parts.repaired(plans).join(plans.select("first", "piece", "before"), ["first", "piece"])
        named = named.join(parts.convs.select("first", "conv_id"), "first")
        pieces = pieces.unionByName(named.select("conv_id", "before", "repaired"))
    return pieces.select("conv_id", "before", F.posexplode("repaired").alias("_at", "_turn")).select(
        "conv_id", (F.col("before") + F.col("_at")).alias("place"), "_turn.role", "_turn.text"
    )
