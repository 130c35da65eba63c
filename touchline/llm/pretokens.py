"""Texts to pre-tokens, many at a time, as numpy arrays.

A batch of texts becomes one array of code points with a separator after each text. Class changes cut it into
pre-tokens; two independent 64-bit hashes name each pre-token, so a word that occurs a thousand times is encoded once.
Texts are cut in pieces before white space that follows other text, which is always a border, so that a batch's memory
does not depend on the longest text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SPACE, LETTER, NUMBER, OTHER, MARK = range(5)
BATCH_CHARS = 1_000_000  # code points worked on at once, about 60 bytes of arrays each
TEXT_END = "\udfff"  # surrogates never occur in valid text: they stand for the ends of texts and for special tokens
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
_WHITE = {*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
_BORDER = re.compile("(?<=[^ \t\n\v\f\r])[ \t\n\v\f\r]")


def _class(code: int) -> int:
    if code in _WHITE:
        return SPACE
    kind = unicodedata.category(chr(code))
    return MARK if kind == "Cs" else {"L": LETTER, "N": NUMBER}.get(kind[0], OTHER)


class _Tables:
    """Character classes, hash powers and multipliers, made once a process and extended when needed."""

    classes = np.empty(0, np.uint8)
    places = [np.empty(0, np.uint64), np.empty(0, np.uint64)]
    powers = np.ones(1, np.uint64)
    inverses = np.ones(1, np.uint64)

    @classmethod
    def classes_to(cls, highest: int) -> np.ndarray:
        if highest >= len(cls.classes):
            cls.classes = np.array([_class(c) for c in range(0x3000 if highest < 0x3000 else 0x110000)], np.uint8)
        return cls.classes

    @classmethod
    def places_to(cls, n: int, which: int) -> np.ndarray:
        """Odd multipliers without any relation between them, one for each place in a word."""
        if n > len(cls.places[which]):
            numbers = np.arange(1 << max(10, n.bit_length()), dtype=np.uint64) + np.uint64(which << 40)
            cls.places[which] = scrambled(scrambled(numbers) + np.uint64(_BASE)) | np.uint64(1)
        return cls.places[which]

    @classmethod
    def powers_to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.powers):
            size = 1 << n.bit_length()
            for name, base in (("powers", _BASE), ("inverses", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.powers, cls.inverses


def character_classes(codes: np.ndarray) -> np.ndarray:
    return _Tables.classes_to(int(codes.max(initial=0)))[codes]


def row_slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows, so that few texts are Python strings at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def special_marks(specials: dict[str, int]) -> tuple[re.Pattern | None, dict[str, str]]:
    """The pattern that finds special strings, and the surrogate that stands for each."""
    if not specials:
        return None, {}
    return (
        re.compile("(" + "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True)) + ")"),
        {s: chr(0xD800 + k) for k, s in enumerate(specials)},
    )


def lower_nfc(text: str) -> str:
    """NFC, then lower case character by character (a final sigma has no rule of its own)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def pieces(texts: list[str | None], limit: int = BATCH_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Batches of (text number, piece) of about `limit` characters; NULL is an empty text, every text has a piece."""
    batch, size = [], 0
    for k, text in enumerate(texts):
        text, at = text or "", 0
        while True:
            border = _BORDER.search(text, at + limit) if len(text) - at > limit else None
            end = border.start() if border else len(text)
            batch.append((k, text[at:end]))
            size += end - at
            if size >= limit:
                yield batch
                batch, size = [], 0
            at = end
            if at >= len(text):
                break
    if batch:
        yield batch


def cut(joined: str, keep_space: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and both hashes of the pre-tokens of texts that are each followed by TEXT_END, and which are such ends.

    keep_space=False: contractions, letter runs, single digits, runs of anything else; white space vanishes.
    keep_space=True: digit runs stay whole and a blank joins the run behind it; other white space is a run of its own.
    """
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = character_classes(codes)
    change = np.empty(len(kinds), bool)
    change[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=change[1:])
    change |= (kinds == MARK) if keep_space else (kinds == MARK) | (kinds == NUMBER)
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(kinds))
    kind = kinds[starts]

    quote = np.flatnonzero((kind == OTHER) & (ends - starts == 1) & (codes[starts] == 39))
    quote = quote[kind[quote + 1] == LETTER]  # a text ends in a mark, so there is a run behind
    if keep_space:
        quote = quote[(starts[quote] == 0) | (codes[starts[quote] - 1] != 32)]
    if len(quote):
        first, second = codes[starts[quote] + 1], codes[starts[quote] + 2]
        second = np.where(ends[quote + 1] - starts[quote + 1] > 1, second, 0)
        one = np.isin(first, [ord(c) for c in "stmd"])
        two = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
        taken = one * 1 + two * 2
        ends[quote] += taken
        starts[quote + 1] += taken

    keep = ends > starts
    if keep_space:
        blank = np.flatnonzero(kind == SPACE)
        joins = blank[kind[blank + 1] != MARK]
        blank_last = codes[ends[joins] - 1] == 32
        with_blank, apart = joins[blank_last], joins[~blank_last & (ends[joins] - starts[joins] > 1)]
        ends[with_blank] -= 1
        starts[with_blank + 1] -= 1
        keep &= ends > starts
        extra = ends[apart] - 1
        ends[apart] -= 1
        starts, ends = starts[keep], ends[keep]
        if len(extra):
            order = np.argsort(starts_all := np.concatenate([starts, extra]), kind="stable")
            starts, ends = starts_all[order], np.concatenate([ends, extra + 1])[order]
    else:
        keep &= kind != SPACE
        starts, ends = starts[keep], ends[keep]

    return starts, ends, word_hashes(codes, starts, ends, 2), codes[starts] == ord(TEXT_END)


def word_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, number: int = 1) -> np.ndarray:
    """`number` (1 or 2) independent 64-bit hashes of each run of codes, as rows; runs do not overlap.

    Each code, mixed, is multiplied by its place's own number. Unlike powers of a base these have no relation by which the
    places of two letters could cancel out, as they do in long words that alternate by a rule.
    """
    if not len(starts):
        return np.empty((number, 0), np.uint64)
    sizes = ends - starts
    mixed = codes.astype(np.uint64)
    mixed *= np.uint64(_MIX)
    mixed ^= mixed >> np.uint64(29)
    at = np.arange(len(codes), dtype=np.int32)
    at[starts[0] :] -= np.repeat(starts.astype(np.int32), np.diff(np.append(starts, len(codes))))
    longest = int(sizes.max())
    np.minimum(at, longest, out=at)  # what lies between the runs is left out of their sums
    found = np.empty((number, len(starts)), np.uint64)
    sums = np.zeros(len(codes) + 1, np.uint64)
    for which in range(number):
        np.cumsum(mixed * _Tables.places_to(longest + 1, which)[at], out=sums[1:])
        found[which] = scrambled(scrambled(sums[ends] - sums[starts]) + sizes.astype(np.uint64))
    return found


def run_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of codes, by differences of one running sum."""
    powers, inverses = _Tables.powers_to(len(codes))
    mixed = codes.astype(np.uint64) * np.uint64(_MIX)
    mixed ^= mixed >> np.uint64(29)
    mixed *= powers[: len(codes)]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    hashes = (sums[ends] - sums[starts]) * inverses[starts]
    hashes ^= (ends - starts).astype(np.uint64) * np.uint64(_BASE)
    return scrambled(hashes)


def scrambled(values: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(_MIX)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def blank_word_pieces(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, hashes) of each text's runs of anything but blank, tab, line feed, vertical tab, form feed and carriage
    return, with A-Z lower-cased. A long text comes in several pieces, in order; every text has one at least."""
    for batch in pieces(texts):
        joined = "".join(text + TEXT_END for _, text in batch)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        codes[(codes >= 65) & (codes <= 90)] += 32
        mark = codes == ord(TEXT_END)
        apart = mark | (codes == 32) | ((codes >= 9) & (codes <= 13))
        edges = np.diff(np.concatenate([[True], apart, [True]]).astype(np.int8))
        starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        hashes = word_hashes(codes, starts, ends)[0]
        bounds = np.concatenate([[0], np.searchsorted(starts, np.flatnonzero(mark))])
        for (k, _), begin, end in zip(batch, bounds[:-1], bounds[1:]):
            yield k, hashes[begin:end]


def blank_word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """The hashes of each whole text's words, see blank_word_pieces."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for k, hashes in blank_word_pieces(texts):
        found[k].append(hashes)
    return [np.concatenate(x) if len(x) > 1 else x[0] for x in found]


class WordMemo:
    """Results by word. `encode` gets new distinct words and returns a list or array of results in their order.

    Words are looked up by one hash and told apart by the other; a word that shares only the first with another one is
    encoded by itself. The first `limit` words stay; as many again are kept until that room is full. It is a matter of time
    and memory only.
    """

    def __init__(self, encode: Callable[[list[str]], list], limit: int = 300_000):
        self.encode, self.limit = encode, limit
        self.keys, self.others, self.slots, self.values = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), []

    def _forget(self) -> None:
        """Back to the first words that came, common ones among them."""
        first = self.slots < self.limit
        self.keys, self.others, self.slots = self.keys[first], self.others[first], self.slots[first]
        del self.values[self.limit :]

    def slots_of(self, joined: str, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The slot in `values` of each word, valid until the next call; `hashes` holds both hashes of each."""
        keys, others = hashes
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > 2 * self.limit or len(self.values) > 4 * self.limit:
            self._forget()
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        slots = np.empty(len(distinct), np.int64)
        slots[known] = self.slots[at[known]]
        named = others[first]
        named[known] = self.others[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            slots[new] = self._encoded(joined, starts[first[new]], ends[first[new]])
            self.keys = np.insert(self.keys, at[new], distinct[new])
            self.others = np.insert(self.others, at[new], named[new])
            self.slots = np.insert(self.slots, at[new], slots[new])
        result = slots[inverse]
        strange = np.flatnonzero(others != named[inverse])
        if len(strange):
            result[strange] = self._encoded(joined, starts[strange], ends[strange])
        return result

    def _encoded(self, joined: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """New slots with the results of these words."""
        slots = np.arange(len(self.values), len(self.values) + len(starts))
        self.values.extend(self.encode([joined[s:e] for s, e in zip(starts.tolist(), ends.tolist())]))
        return slots


_MEMOS: dict[tuple, WordMemo] = {}


def kept_memo(name: tuple, encode: Callable[[list[str]], list], limit: int = 300_000) -> WordMemo:
    """The memo of this name in a worker process, which serves several tasks."""
    memo = _MEMOS.setdefault(name, WordMemo(encode, limit))
    memo.encode = encode
    return memo


def drop_memos() -> None:
    """Free the memos of a worker process that has turned to other work."""
    _MEMOS.clear()


def encoded(
    texts: list[str | None], specials: dict[str, int], keep_space: bool, normal: Callable[[str], str] | None, memo: WordMemo
) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """For batches of pieces: the text number of each piece, the memo slot of each word, and each piece's word bounds.

    A special string is one word, the surrogate of special_marks; parts between them are normalised on their own.
    """
    find, marks = special_marks(specials)

    def plain(text: str) -> str:
        if find is None or not find.search(text):
            return normal(text) if normal else text
        return "".join(marks.get(p) or (normal(p) if normal else p) for p in find.split(text))

    for batch in pieces(texts):
        joined = "".join(plain(text) + TEXT_END for _, text in batch)
        starts, ends, hashes, last = cut(joined, keep_space)
        words = ~last
        bounds = np.concatenate([[0], np.cumsum(words)[last]])
        yield [k for k, _ in batch], memo.slots_of(joined, starts[words], ends[words], hashes[:, words]), bounds
