"""Removal of repeated byte strings, by suffix arrays over anchored contexts.

A byte goes when a string of LENGTH bytes that covers it also starts earlier. Equal strings are brought together by
anchors: the anchor of a string is the k-mer in it with the smallest hash, so equal strings have equal anchors at equal
offsets. Strings behind each other that share their anchor form a context; one scan yields a context for each anchor.

- Copies of a whole context go but for the first. Those within a batch are settled where they are read; so an anchor
  that occurs in a third of all documents sends one row per batch into the shuffle, not one per document.
- Where one anchor has different contexts, their suffixes are sorted (lyndon_suffixes): equal strings become neighbours
  in the suffix array, and all of them but the first go. Before that a context is halved: a string with enough bytes on the
  anchor's left equals only strings with the same ones there, and any other string has as many on the right. Halves
  that stand alone with those bytes cannot repeat and need no sorting.
- An anchor with very many different contexts would be one task's work. Its strings are compared one by one instead, by
  the same rule, with the string itself as the shuffle's key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import pretokens
from touchline.llm.lyndon_suffixes import suffix_array
from touchline.llm.support import stored
from touchline.operators.keyed import broadcast_if_small
from touchline.operators.numbering import number_rows

LENGTH = 100
ANCHOR_BYTES = 24
CONTEXTS_PER_ANCHOR = 2000  # beyond, an anchor's strings are compared one by one
SUFFIX_TEXT = 60_000  # bytes of contexts sorted together; a single anchor may bring more
_CHUNK = 1_000_000  # bytes worked on at once
_INDEX_BITS = np.uint64(22)  # place within a chunk, in the low bits of a k-mer's rank
_ROWS = "anchor bigint, content bigint, doc bigint, start bigint, strings int, gone boolean"
_OFFSET_BITS = 12  # a context's shape is its number of strings, then the anchor's offset in its first string
_GONE = "doc bigint, start bigint, stop bigint"


def _windows_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbouring values."""
    have, low = 1, values
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    return low


def contexts(data: bytes, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one text: anchor hash, content hash, first string, and packed shape of each context."""
    none = np.empty(0, np.int64)
    found = [(none.astype(np.uint64), none.astype(np.uint64), none, none)]
    for begin in range(0, max(0, len(data) - length + 1), _CHUNK):
        codes = np.frombuffer(data[begin : begin + _CHUNK + length - 1], np.uint8)
        places = np.arange(len(codes) - anchor + 1)
        kmers = pretokens.run_hashes(codes, places, places + anchor)
        ranked = (kmers >> _INDEX_BITS << _INDEX_BITS) | places.astype(np.uint64)
        at = (_windows_minimum(ranked, length - anchor + 1) & ((np.uint64(1) << _INDEX_BITS) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        strings = np.diff(np.append(first, len(at)))
        content = pretokens.run_hashes(codes, first, first + strings + length - 1)
        found.append((kmers[at[first]], content, first + begin, strings << _OFFSET_BITS | at[first] - first))
    return tuple(np.concatenate(x) for x in zip(*found))


def _context_rows(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """The contexts of (doc, text): the first of equal ones in a batch to be compared with others, the rest as gone."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column("doc").to_pylist(), batch.column("text").to_pylist()
            found = [contexts((t or "").encode(), length, anchor) for t in texts]
            anchors, content, start, strings = (np.concatenate(x) for x in zip(*found))
            doc = np.repeat(np.array(names, np.int64), [len(x[0]) for x in found])
            order = np.lexsort((start, doc, content, anchors))
            anchors, content, doc, start, strings = (x[order] for x in (anchors, content, doc, start, strings))
            again = np.zeros(len(order), bool)
            again[1:] = (anchors[1:] == anchors[:-1]) & (content[1:] == content[:-1])
            yield _batch(anchors.view(np.int64), content.view(np.int64), doc, start, strings, again)

    return docs.select("doc", "text").mapInArrow(rows, _ROWS)


def _batch(*columns: np.ndarray) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c).cast(t) for c, t in zip(columns, kinds)], ["anchor", "content", "doc", "start", "strings", "gone"]
    )


def _compared(rows: DataFrame, most: int) -> DataFrame:
    """Copies of a context but for the first are gone; the first ones stay open where their anchor has others, and vanish
    where it has none. `others`: how many different contexts the anchor has, counted up to `most` + 1. Rows of one anchor
    pass one after another, and no more than `most` of them are held until that number is known."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in settled_rows(([c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches), most):
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c).cast(t) for c, t in zip(columns, kinds)], ["anchor", "doc", "start", "strings", "gone", "others"]
            )

    # Rows that are gone need no company: they are dealt out at random by their own hash.
    key = F.when(F.col("gone"), F.xxhash64("content", "doc", "start")).otherwise(F.col("anchor"))
    keyed = rows.select(key.alias("anchor"), "content", "doc", "start", "strings", "gone")
    ordered = keyed.repartition("anchor").sortWithinPartitions("anchor", "gone", "content", "doc", "start")
    return ordered.mapInArrow(compare, "anchor bigint, doc bigint, start bigint, strings int, gone boolean, others bigint")


def settled_rows(batches: Iterable[list[np.ndarray]], most: int) -> Iterator[list[np.ndarray]]:
    """Columns (anchor, doc, start, strings, gone, others) of batches (anchor, content, doc, start, strings, gone) that come
    sorted by anchor, gone, content, doc and start; see _compared."""
    name = last = None  # anchor and content of the row before
    count, held = 0, []  # of that anchor: different contexts so far, and those whose fate is open, `most` at most

    def as_open(columns: list[np.ndarray], others: np.ndarray) -> list[np.ndarray]:
        return [*columns, np.zeros(len(others), bool), np.minimum(others, most + 1)]

    for anchors, content, doc, start, strings, gone in batches:
        if not len(anchors):
            continue
        new_anchor = np.append(anchors[0] != name, anchors[1:] != anchors[:-1])
        new_content = new_anchor | np.append(content[0] != last, content[1:] != content[:-1])
        first = ~gone & new_content
        group = np.cumsum(new_anchor)  # 0 is the anchor of the row before
        different = np.bincount(group[first], minlength=group[-1] + 1)
        different[0] += count
        known = different > most
        known[:-1] = True  # all but the last anchor are complete
        rows = [anchors, doc, start, strings]
        out = []
        if known[0]:
            out += [as_open(x, np.full(len(x[0]), different[0])) for x in held if different[0] > 1]
            held = []
        copies = ~first  # rows that came as gone, too
        out.append([*[c[copies] for c in rows], np.ones(int(copies.sum()), bool), np.zeros(int(copies.sum()), np.int64)])
        ready = first & known[group] & (different[group] > 1)
        out.append(as_open([c[ready] for c in rows], different[group][ready]))
        waiting = first & ~known[group]
        if waiting.any():
            held.append([c[waiting] for c in rows])
        name, last, count = anchors[-1], content[-1], int(different[-1])
        yield [np.concatenate(x) for x in zip(*out)]
    if count > 1 and held:
        yield [np.concatenate(x) for x in zip(*[as_open(x, np.full(len(x[0]), count)) for x in held])]


def repeated_strings(pieces: list[tuple[int, int, bytes]], length: int) -> list[tuple[int, int, int]]:
    """(doc, start, stop) of what repeats an earlier string, among pieces (doc, start, bytes)."""
    text: list[int] = []
    owner: list[int] = []
    for k, (_, _, data) in enumerate(pieces):
        text += [b + 2 for b in data]
        text.append(1)
        owner += [k] * (len(data) + 1)
    text.append(0)
    if not pieces:
        return []
    begins, at = [], 0
    for _, _, data in pieces:
        begins.append(at)
        at += len(data) + 1
    found, alike, string = [], [], None

    def close() -> None:
        if len(alike) > 1:
            alike.sort()
            found.extend((doc, start, start + length) for doc, start in alike[1:])

    for suffix in suffix_array(text)[1:]:
        k = owner[suffix]
        doc, start, data = pieces[k]
        offset = suffix - begins[k]
        if offset + length > len(data):
            continue
        own = data[offset : offset + length]
        if own != string:
            close()
            alike, string = [], own
        alike.append((doc, start + offset))
    close()
    return _merged(found)


def _merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans (doc, start, stop) without overlaps."""
    result: list[tuple[int, int, int]] = []
    for doc, start, stop in sorted(spans):
        if result and result[-1][0] == doc and start <= result[-1][2]:
            result[-1] = (doc, result[-1][1], max(stop, result[-1][2]))
        else:
            result.append((doc, start, stop))
    return result


def _gone_batch(spans: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*spans)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "start", "stop"])


def _halves(rows: list[tuple[int, int, int, bytes]], length: int, anchor: int) -> dict[tuple[int, bytes], list]:
    """The halves (doc, start, bytes) of one anchor's contexts (doc, start, offset, bytes), by side and the bytes there."""
    side = (length - anchor) // 2
    found: dict[tuple[int, bytes], list] = {}
    for doc, start, offset, data in rows:
        last, border = len(data) - length, offset - side  # strings up to the border have `side` bytes left of the anchor
        if border >= 0:
            part = data[: min(last, border) + length]
            found.setdefault((0, data[offset - side : offset]), []).append((doc, start, part))
        if border < last:
            first = max(0, border + 1)
            key = data[offset + anchor : offset + anchor + side]
            found.setdefault((1, key), []).append((doc, start + first, data[first:]))
    return found


def _by_suffixes(opened: DataFrame, length: int, anchor: int) -> DataFrame:
    """What is gone among open contexts (anchor, doc, start, offset, data), a bounded number for each anchor."""
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []  # different halves that may share strings
        gone: list[tuple[int, int, int]] = []
        size, name, rows = 0, None, []

        def settle() -> None:
            nonlocal size
            for half in _halves(rows, length, anchor).values():
                seen: set[bytes] = set()
                kept = []
                for doc, start, data in half:  # rows come in the order of documents and places
                    if data in seen:
                        gone.append((doc, start, start + len(data)))
                    else:
                        seen.add(data)
                        kept.append((doc, start, data))
                if len(kept) > 1:
                    held.extend(kept)
                    size += sum(len(x[2]) for x in kept)

        for batch in batches:
            for key, *row in zip(*[batch.column(k).to_pylist() for k in range(5)]):
                if key != name:
                    settle()
                    name, rows = key, []
                    if size >= SUFFIX_TEXT:  # whole anchors are sorted together
                        yield _gone_batch(gone + repeated_strings(held, length))
                        held, gone, size = [], [], 0
                rows.append(tuple(row))
        settle()
        yield _gone_batch(gone + repeated_strings(held, length))

    rows = opened.select("anchor", "doc", "start", "offset", "data")
    return rows.repartition("anchor").sortWithinPartitions("anchor", "doc", "start").mapInArrow(sort, _GONE)


def _by_strings(opened: DataFrame, length: int) -> DataFrame:
    """What is gone among open contexts of anchors with any number of contexts."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for anchor, doc, start, data in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                codes = np.frombuffer(data, np.uint8)
                at = np.arange(len(codes) - length + 1)
                rows.append((np.full(len(at), anchor), pretokens.run_hashes(codes, at, at + length), np.full(len(at), doc), at + start))
            if not rows:
                continue
            anchors, content, doc, start = (np.concatenate(x) for x in zip(*rows))
            order = np.lexsort((start, doc, content, anchors))
            anchors, content, doc, start = (x[order] for x in (anchors, content, doc, start))
            again = np.zeros(len(order), bool)
            again[1:] = (anchors[1:] == anchors[:-1]) & (content[1:] == content[:-1])
            key = pretokens.scrambled(anchors.view(np.uint64) + content).view(np.int64)
            yield _batch(key, content.view(np.int64), doc, start, np.full(len(order), 1 << _OFFSET_BITS), again)

    rows = opened.select("anchor", "doc", "start", "data").mapInArrow(strings, _ROWS)
    return _compared(rows, 1).where("gone").select("doc", "start", (F.col("start") + length).alias("stop"))


def _named(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, text): doc is the id itself, or a number in the order of ids and texts if ids repeat or are NULL."""
    rows = docs.select("doc_id", "text")
    ids = rows.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("n > 1 or doc_id is null").isEmpty():
        return rows.select(F.col("doc_id").cast("bigint").alias("doc"), "doc_id", "text")
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash")]
    numbered = number_rows(rows.select("*", F.xxhash64("text").alias("hash")), *order, name="doc")
    return stored(numbered.select("doc", "doc_id", "text"), "numbered")


def removed_spans(named: DataFrame, length: int = LENGTH, anchor: int = ANCHOR_BYTES, per_anchor: int = CONTEXTS_PER_ANCHOR) -> DataFrame:
    """(doc, start, stop) of the bytes that go, of rows (doc, text); spans may overlap or touch."""
    strings = F.shiftright("strings", _OFFSET_BITS)
    compared = stored(_compared(_context_rows(named, length, anchor), per_anchor), "contexts")
    whole = compared.where("gone").select("doc", "start", (F.col("start") + strings + length - 1).alias("stop"))
    wanted = broadcast_if_small(compared.where("not gone"))
    data = F.expr(f"substring(cast(text as binary), int(start) + 1, shiftright(strings, {_OFFSET_BITS}) + {length - 1})")
    opened = stored(named.select("doc", "text").join(wanted, "doc").select(
        "anchor", "doc", "start", "others", F.col("strings").bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1)).alias("offset"), data.alias("data")
    ), "open")
    some, many = opened.where(F.col("others") <= per_anchor), opened.where(F.col("others") > per_anchor)
    return whole.union(_by_suffixes(some, length, anchor)).union(_by_strings(many, length))


def suffix_dedup(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR_BYTES, per_anchor: int = CONTEXTS_PER_ANCHOR, keep: bool = True
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with `keep`, kept (binary) and spans of every document.

    Strings are judged on the input, across all documents in the order of their ids, and never cross documents. A NULL
    text has no bytes. Rows with equal ids are documents of their own, ordered by a hash of their texts; a NULL id comes
    first. Further columns are ignored, an empty table gives an empty result.
    """
    named = _named(docs)
    spans = removed_spans(named, length, anchor, per_anchor)
    by_doc = spans.groupBy(F.col("doc").alias("_doc")).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = named.join(by_doc, F.col("doc") == F.col("_doc"), "left").select("doc_id", "text", "spans.start", "spans.stop")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    schema += ", kept binary, spans array<struct<start:bigint,stop:bigint>>" if keep else ""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, starts, stops in zip(*[batch.column(k).to_pylist() for k in (1, 2, 3)]):
                data = (text or "").encode()
                cut = _merged([(0, a, b) for a, b in zip(starts or [], stops or [])])
                bounds = [0, *[x for _, a, b in cut for x in (a, b)], len(data)]
                kept = b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2]))
                rows.append((
                    len(data), len(data) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(), kept,
                    [{"start": a, "stop": b} for _, a, b in cut],
                ))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)][: 6 if keep else 4]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names[: len(columns)]])

    return joined.mapInArrow(remove, schema)
