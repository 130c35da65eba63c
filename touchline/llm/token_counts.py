"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a batch lie behind each other in one ragged symbol array. In each round every sequence finds
its lowest-ranked neighbouring pair and merges all its places at once; a sequence without a mergeable pair leaves the
arrays, and its number of symbols is its token count. Every symbol is made by one merge only, and a merge's parts are
made before it, so no pair of a lower rank can appear between two places of the same pair: the rounds give what one
merge at a time gives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import pretokens
from touchline.llm.bpe_files import byte_letters, load_vocabulary
from touchline.llm.support import WORD_BPE, tokenizer_file

TOKEN_LIMIT = 2048
_NO_RANK = np.int32(2**31 - 1)


class RankMerger:
    """Counts the symbols that are left of byte-level words when all merges are done."""

    def __init__(self, path: str):
        vocabulary = load_vocabulary(path)
        self.specials = vocabulary.specials
        letters = byte_letters()
        self.inner = np.array([vocabulary.ids[c] for c in letters], np.int32)
        self.final = np.array([vocabulary.ids[c + vocabulary.word_end] for c in letters], np.int32)
        left, right, made = (np.array(x, np.int64) for x in zip(*vocabulary.merges))
        keys = left << 20 | right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order].astype(np.int32)

    def ranks_of(self, symbols: np.ndarray) -> np.ndarray:
        """The rank of each symbol with its right neighbour."""
        keys = symbols[:-1].astype(np.int64) << 20 | symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NO_RANK)

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word; a word that stands for a special string is one token."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        counts = np.ones(len(words), np.int64)
        special = np.fromiter(("\ud800" <= w < "\udfff" for w in words), bool, len(words))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        symbols = np.frombuffer(b"".join(data), np.uint8)
        final = np.zeros(len(symbols), bool)
        final[bounds[1:] - 1] = True
        symbols = np.where(final, self.final[symbols], self.inner[symbols])
        owner = np.repeat(np.arange(len(words)), lengths)
        going = ~special[owner]
        symbols, owner = symbols[going], owner[going]
        while len(symbols):
            ranks = np.full(len(symbols), _NO_RANK, np.int32)
            same = owner[1:] == owner[:-1]
            ranks[:-1][same] = self.ranks_of(symbols)[same]
            first = np.flatnonzero(np.concatenate([[True], ~same]))
            sizes = np.diff(np.append(first, len(symbols)))
            lowest = np.minimum.reduceat(ranks, first)
            done = lowest == _NO_RANK
            counts[owner[first[done]]] = sizes[done]
            lowest = np.repeat(lowest, sizes)
            merge = (ranks == lowest) & (lowest != _NO_RANK)
            # In a run of places that overlap, as in "aaa", every second one counts, from the left.
            places = np.flatnonzero(merge)
            opens = np.concatenate([[True], np.diff(places) > 1])
            run_start = np.maximum.accumulate(np.where(opens, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - run_start) % 2 == 0] if len(places) else places
            pairs = symbols[places].astype(np.int64) << 20 | symbols[places + 1]
            symbols[places] = self.made[np.searchsorted(self.keys, pairs)]
            keep = ~np.repeat(done, sizes)
            keep[places + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return counts


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = WORD_BPE, token_limit: int = TOKEN_LIMIT
) -> DataFrame:
    """n_bytes, n_tokens and over_limit of every text, next to its id; one row for each input row.

    A NULL text counts as empty: no bytes and no tokens. Equal ids and equal texts stay separate rows, other columns
    play no part, an empty table gives an empty result. Texts of any length are worked off in pieces. There is no
    shuffle: rows are counted where they are read.
    """
    path = tokenizer_file(tokenizer)
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = RankMerger(path)
        memo = pretokens.WordMemo(merger.counts)
        for batch in pretokens.row_slices(batches):
            texts = batch.column("text").to_pylist()
            tokens = np.zeros(len(texts), np.int64)
            for owners, slots, bounds in pretokens.encoded(texts, merger.specials, False, pretokens.lower_nfc, memo):
                sums = np.concatenate([[0], np.cumsum(np.array(memo.values, np.int64)[slots])])
                np.add.at(tokens, owners, sums[bounds[1:]] - sums[bounds[:-1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(tokens), pa.array(tokens > token_limit)],
                [id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("n_bytes"),
    )
    return rows.mapInArrow(count, schema)
