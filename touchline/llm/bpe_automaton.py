"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens: a path from its start spells a token sequence, and exactly the sequences that the merges
produce have a path. It starts as one state that loops on every base symbol. Each merge u v -> w, in order of rank,
inserts one gadget: the state behind u is copied without its arc v (so u can no longer be followed by v), the arcs on
u lead to the copy, and wherever u could be read, w can be read now and leads where v led.

Copies are not written out. A state remembers which state it was copied from and which arc it lost, so that the state
behind a token is the chain of gadgets that made it: the token's own, then those of its right part until the merge,
then those of that part's right part, and so on. Likewise an arc w exists where the arc of its left part existed when w
was made. The transition table is filled by these records as texts ask for its entries.

The token that ends at a place of a word follows from the word up to there alone, so a word is read once from left to
right: at each place the one token whose arc leaves the state reached before it. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import pretokens
from touchline.llm.bpe_files import byte_letters, load_vocabulary
from touchline.llm.support import WORD_BPE, tokenizer_file

_EVER = 1 << 30
_START = -1


class TokenAutomaton:
    TABLE_LIMIT = 2_000_000  # entries of the transition table that are kept filled at a time

    def __init__(self, path: str):
        vocabulary = load_vocabulary(path)
        self.ids, self.specials, self.word_end = vocabulary.ids, vocabulary.specials, vocabulary.word_end
        self.labels = {i: s for s, i in [*vocabulary.ids.items(), *vocabulary.specials.items()]}
        self.letters = byte_letters()
        self.longest = max(len(s.removesuffix(self.word_end)) if self.word_end else len(s) for s in vocabulary.ids)
        self.lost: dict[tuple[int, int], int] = {}  # the gadget of (u, v): when the state behind u lost the arc v
        self.behind: dict[int, list[tuple[int, int, int]]] = {}  # a token's state: (owner of gadgets, from, until)
        self.arcs: dict[int, list[tuple[int, int, int]]] = {}  # what must not be lost for an arc: (arc, from, until)
        for i in vocabulary.ids.values():
            self.behind[i] = self.arcs[i] = [(i, -1, _EVER)]
        for rank, (u, v, w) in enumerate(vocabulary.merges):
            self._insert_gadget(u, v, w, rank)
        self.table: dict[int, bool] = {}

    def _insert_gadget(self, u: int, v: int, w: int, rank: int) -> None:
        self.lost[u, v] = rank
        # w leads where v led before u's state was copied; gadgets that v gets from now on are not w's.
        self.behind[w] = [(w, rank, _EVER), *[(y, a, min(b, rank)) for y, a, b in self.behind[v]]]
        # w can be read where u can be read now, that is after this gadget took effect.
        self.arcs[w] = [(w, rank, _EVER), *[(x, a, min(b, rank + 1)) for x, a, b in self.arcs[u]]]

    def has_arc(self, before: int, token: int) -> bool:
        """Is there an arc for the token at the state behind `before`?"""
        if before == _START:
            return True
        key = before << 20 | token
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= self.TABLE_LIMIT:
                self.table.clear()
            known = self.table[key] = self._find_arc(before, token)
        return known

    def _find_arc(self, before: int, token: int) -> bool:
        for x, made, used in self.arcs[token]:
            for y, since, until in self.behind[before]:
                when = self.lost.get((y, x))
                if when is not None and made < when < used and since < when < until:
                    return False
        return True

    def encode_word(self, word: str) -> list[int]:
        """Token ids of one pre-token."""
        if "\ud800" <= word < "\udfff":
            return [list(self.specials.values())[ord(word) - 0xD800]]
        text = "".join([self.letters[b] for b in word.encode("utf-8")])
        whole = self.ids.get(text + self.word_end)
        size, ids, has_arc = len(text), self.ids, self.has_arc
        reached, came = [_START] * (size + 1), [0] * (size + 1)
        if whole is not None and self._is_own_result(whole):
            return [whole]
        for end in range(1, size + 1):
            tail = self.word_end if end == size else ""
            for begin in range(max(0, end - self.longest), end):
                token = ids.get(text[begin:end] + tail)
                if token is not None and (not begin or reached[begin] != _START) and has_arc(reached[begin], token):
                    if self._is_own_result(token):
                        reached[end], came[end] = token, begin
                        break
            else:
                raise ValueError("the vocabulary lacks a base symbol")
        result, end = [], size
        while end:
            result.append(reached[end])
            end = came[end]
        return result[::-1]

    def _is_own_result(self, token: int) -> bool:
        """Base symbols and symbols that a merge makes: an arc of the automaton, unlike a bare vocabulary entry."""
        return len(self.arcs[token]) > 1 or len(self.labels[token].removesuffix(self.word_end or "\0")) == 1

    def decode(self, ids: list[int]) -> str:
        """The arc labels with a blank between them, as the vocabulary file's library does without a decoder."""
        return " ".join([self.labels[i] for i in ids])


@lru_cache(maxsize=2)
def _compiled(path: str) -> TokenAutomaton:
    """One automaton for the tasks of a worker process."""
    return TokenAutomaton(path)


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = WORD_BPE, keep: bool = True
) -> DataFrame:
    """Ids and decoded text of every text with their digests: id, n_tokens, ids_sha256, decoded_sha256 and, with `keep`,
    ids (array of int) and decoded.

    The ids are digested as little-endian unsigned 32-bit integers, the decoded text as UTF-8. A NULL text counts as
    empty: no ids, decoded to an empty text. Equal ids and texts stay separate rows, other columns play no part, an empty
    table gives an empty result. Texts of any length are worked off in pieces. There is no shuffle.
    """
    path = tokenizer_file(tokenizer)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if keep else ""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _compiled(path)

        def results(words: list[str]) -> list[tuple[bytes, bytes]]:
            found = map(automaton.encode_word, words)
            return [(np.array(ids, "<u4").tobytes(), automaton.decode(ids).encode()) for ids in found]

        memo = pretokens.kept_memo(("automaton", path), results, 120_000)
        for batch in pretokens.row_slices(batches):
            texts = batch.column("text").to_pylist()
            counts = [0] * len(texts)
            digests = [(hashlib.sha256(), hashlib.sha256()) for _ in texts]
            parts = [([], []) for _ in texts]
            for owners, slots, bounds in pretokens.encoded(texts, automaton.specials, False, pretokens.lower_nfc, memo):
                found, bounds = [memo.values[s] for s in slots.tolist()], bounds.tolist()
                for k, begin, end in zip(owners, bounds, bounds[1:]):
                    if begin == end:
                        continue
                    ids = b"".join([x for x, _ in found[begin:end]])
                    decoded = b" ".join([x for _, x in found[begin:end]])
                    digests[k][0].update(ids)
                    digests[k][1].update(b" " + decoded if counts[k] else decoded)
                    counts[k] += len(ids) // 4
                    if keep:
                        parts[k][0].append(ids)
                        parts[k][1].append(decoded)
            columns = [
                batch.column("id"), pa.array(counts, pa.int64()), pa.array([a.hexdigest() for a, _ in digests], pa.string()),
                pa.array([b.hexdigest() for _, b in digests], pa.string()),
            ]
            if keep:
                columns += [
                    pa.array([np.frombuffer(b"".join(ids), "<i4") for ids, _ in parts], pa.list_(pa.int32())),
                    pa.array([b" ".join(decoded).decode() for _, decoded in parts], pa.string()),
                ]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if keep else [])]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(encode, schema)
