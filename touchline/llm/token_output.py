"""Token ids in files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are replaced by their rank by frequency in the corpus, so that the common ones take one byte. A value takes one to
four bytes, least significant first; two control bits per value tell how many, and the control bits lie apart from the
values, four values to a control byte. Decoding looks each control byte up in a table of its four lengths and gathers
the value bytes with numpy.

A token store is a folder in shared storage with two tables. `ranks` holds the id of each rank. `blocks` holds the coded
ids: shards are ranges of ascending document id, a shard's blocks follow each other, and a block holds whole documents
(their ids and lengths) with its control bytes and its value bytes. Both are written by Spark's committed writes, so a
lost executor only repeats its tasks.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from touchline.llm import pretokens
from touchline.llm.native import BLANKS
from touchline.llm.support import BYTE_BPE, stored, tokenizer_file

END_ID = 0
BLOCK_IDS = 200_000  # ids after which a block ends with its document
LIBRARY_WORDS = 5_000  # words in one call of the library
JOINED_WORDS = 50
SHARD_BYTES = 32 * 1024 * 1024  # of staged ids, two bytes each
BLOCKS = (
    "shard int, block int, first_id bigint, doc_ids binary, lengths binary, control binary, data binary"
)

_LENGTHS = np.array([[1 + (control >> 2 * k & 3) for k in range(4)] for control in range(256)], np.uint8)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and value bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    sizes = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = sizes - 1
    quads = codes.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < sizes[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, count: int) -> np.ndarray:
    """What encode_values was given."""
    sizes = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    source = np.frombuffer(data, np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[:-1]
    values = np.zeros(count, np.uint32)
    for k in range(4):
        has = np.flatnonzero(sizes > k)
        values[has] |= source[starts[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def _ragged(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices starts[i] : starts[i] + sizes[i] of flat behind each other."""
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = BYTE_BPE, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids): the ids of every text as little-endian unsigned 16- or 32-bit integers, by vocabulary size, with the
    end id behind them. Each distinct pre-token is encoded by the tokenizers library once."""
    path = tokenizer_file(tokenizer)
    width = id_dtype(path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given the task its core
        library = Tokenizer.from_file(path)
        id_bytes = np.zeros(library.get_vocab_size(), np.int64)
        for token, i in library.get_vocab().items():
            id_bytes[i] = len(token)  # byte-level symbols: a character for each byte
        specials = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
        ids_of_special = list(specials.values())

        def results(words: list[str]) -> list[bytes]:
            """Ids of distinct pre-tokens. Words that a blank begins are pre-tokens behind each other as well, so many of them
            are one text for the library, and their byte lengths tell the ids apart."""
            found: list[bytes] = [b""] * len(words)
            apart, joined = [], []
            for k, w in enumerate(words):
                (joined if len(w) > 1 and w[0] == " " and w[1] not in BLANKS and not w[1].isspace() else apart).append(k)
            for begin in range(0, len(joined), LIBRARY_WORDS):
                some = joined[begin : begin + LIBRARY_WORDS]
                texts = ["".join([words[k] for k in some[j : j + JOINED_WORDS]]) for j in range(0, len(some), JOINED_WORDS)]
                lists = [np.array(e.ids, width) for e in library.encode_batch_fast(texts, add_special_tokens=False)]
                ids = np.concatenate(lists)
                stops = np.cumsum([len(words[k].encode()) for k in some])
                ends = (np.searchsorted(np.cumsum(id_bytes[ids]), stops) + 1).tolist()
                for k, a, b in zip(some, [0, *ends], ends):
                    found[k] = ids[a:b].tobytes()
            for begin in range(0, len(apart), LIBRARY_WORDS):
                some = apart[begin : begin + LIBRARY_WORDS]
                marks = ["\ud800" <= words[k] < "\udfff" for k in some]
                lists = library.encode_batch_fast(["" if m else words[k] for k, m in zip(some, marks)], add_special_tokens=False)
                for k, m, e in zip(some, marks, lists):
                    found[k] = np.array([ids_of_special[ord(words[k]) - 0xD800]] if m else e.ids, width).tobytes()
            return found

        memo = pretokens.kept_memo(("ids", path), results)
        for batch in pretokens.row_slices(batches):
            texts = batch.column("text").to_pylist()
            parts: list[list[bytes]] = [[] for _ in texts]
            for owners, slots, bounds in pretokens.encoded(texts, specials, True, None, memo):
                used, inverse = np.unique(slots, return_inverse=True)
                words = [memo.values[s] for s in used.tolist()]
                lengths = np.fromiter(map(len, words), np.int64, len(words)) // np.dtype(width).itemsize
                starts = np.cumsum(lengths) - lengths
                flat = np.frombuffer(b"".join(words), width)
                ids = _ragged(flat, starts[inverse], lengths[inverse])
                ends = np.concatenate([[0], np.cumsum(lengths[inverse])])[bounds].tolist()
                for k, begin, end in zip(owners, ends, ends[1:]):
                    parts[k].append(ids[begin:end].tobytes())
            close = np.array([end_id], width).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([b"".join(p) + close for p in parts], pa.binary())], ["doc_id", "ids"]
            )

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        encode, "doc_id bigint, ids binary"
    )


def id_dtype(path: str) -> str:
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def write_token_store(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = BYTE_BPE,
    end_id: int = END_ID, shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encode every text and write the store in ascending document id.

    A NULL text is the end id alone; rows with equal ids stay apart (in a fixed order), a NULL id
    comes first; other columns play no part; an empty table makes empty tables. The vocabulary bounds the rank table, not the corpus.
    """
    spark = docs.sparkSession
    width = id_dtype(tokenizer_file(tokenizer))
    staged = stored(tokenized(docs, id_col, text_col, tokenizer, end_id), "tokens")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pretokens.drop_memos()
        totals = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                seen = np.bincount(np.frombuffer(ids.as_buffer(), width))
                if len(seen) > len(totals):
                    totals = np.concatenate([totals, np.zeros(len(seen) - len(totals), np.int64)])
                totals[: len(seen)] += seen
        ids = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(totals[ids])], ["id", "n"])

    counts = staged.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    ranked = [r["id"] for r in sorted(counts, key=lambda r: (-r["n"], r["id"]))]
    spark.createDataFrame(list(enumerate(ranked)), "rank bigint, id bigint").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(max(ranked, default=0) + 1, np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pretokens.drop_memos()
        shard, block, written = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, written, size
            control, data = encode_values(rank_of[np.concatenate(held)])
            lengths = np.fromiter(map(len, held), "<u8", len(held))
            names = np.array([-(1 << 63) if d is None else d for d in doc_ids], "<i8")
            row = {
                "shard": shard, "block": block, "first_id": written, "doc_ids": names.tobytes(),
                "lengths": lengths.tobytes(), "control": control, "data": data,
            }
            block, written, size = block + 1, written + size, 0
            doc_ids.clear(), held.clear()
            kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), kinds)], list(row))

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                doc_ids.append(doc)
                held.append(np.frombuffer(ids.as_py(), width))
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield flush()
        if held:
            yield flush()

    total = staged.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    # The tie breaker is short because Spark samples the range keys on the driver.
    ordered = staged.withColumn("tie", F.xxhash64("ids")).repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "ids")
    ordered.mapInArrow(code, BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")


def _decoded(spark: SparkSession, folder: str) -> tuple[DataFrame, Callable]:
    """The blocks of a store, and the function that decodes a batch of them to (doc ids, starts, bounds, ids) block by block."""
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()
    id_of = np.array([r["id"] for r in ranks], np.int32)
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    shard_first = _shard_starts(blocks)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        pretokens.drop_memos()
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                lengths = np.frombuffer(row["lengths"], "<u8").astype(np.int64)
                ids = id_of[decode_values(row["control"], row["data"], int(lengths.sum()))]
                bounds = np.concatenate([[0], np.cumsum(lengths)])
                names = np.frombuffer(row["doc_ids"], "<i8")
                doc_ids = pa.array(names, mask=names == -(1 << 63))
                yield doc_ids, pa.array(shard_first[row["shard"]] + row["first_id"] + bounds[:-1]), bounds, ids

    return blocks, decode


def read_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) of every document in a store: ids is an array, start counts the ids of all documents before."""
    blocks, decode = _decoded(spark, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, starts, bounds, ids in decode(batches):
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([doc_ids, starts, lists], ["doc_id", "start", "ids"])

    return blocks.mapInArrow(read, "doc_id bigint, start bigint, ids array<int>")


def _shard_starts(blocks: DataFrame) -> dict[int, int]:
    """Ids before each shard: one number per shard on the driver, as Spark keeps several per file anyway."""
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [int(np.frombuffer(x.as_py(), "<u8").sum()) for x in batch.column("lengths")]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(n, pa.int64())], ["shard", "n"])

    found = blocks.select("shard", "lengths").mapInArrow(sizes, "shard int, n bigint").groupBy("shard").agg(F.sum("n").alias("n"))
    starts, before = {}, 0
    for row in sorted(found.collect(), key=lambda r: r["shard"]):
        starts[row["shard"]] = before
        before += row["n"]
    return starts


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in a store, as its files are decoded."""
    blocks, decode = _decoded(spark, folder)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, starts, bounds, ids in decode(batches):
            data = memoryview(ids.astype("<u4").tobytes())
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            columns = [doc_ids, starts, pa.array(np.diff(bounds)), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks.mapInArrow(digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
