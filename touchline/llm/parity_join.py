"""Near-duplicate components by a parity-sketch join.

A document is its set of word shingles. Every shingle flips one bit of a sketch, so the Hamming distance of two sketches
is at most the size of the sets' symmetric difference. Two sets of sizes a and b with Jaccard similarity of at least t
differ in at most d = (a + b)(1 - t)/(1 + t) shingles. A sketch has more than d / (k + 1) parts, so that linked documents
have a part that differs in k bits at most (pigeonhole). With k = 0 a part is a word, and documents are looked up by their
words. Where t leaves less than some shingles to such a word, unrelated documents would share nearly empty ones: there
k = 1, a part has three words, of which at most one differs, and documents are looked up by each two of them. Sizes
form bands so that linked documents lie in one band or in neighbouring ones, and each band sets its number of parts.

Documents with equal sets are one from the start. Equal keys meet in buckets; buckets of the same members are one. There
sketches folded to one or four bits a shingle are compared, and only a spanning forest of the pairs that may be linked
leaves a bucket, never all pairs. The forest's edges are verified on the exact sets. Where an edge fails, its bucket
goes through further rounds: each gives, for each member, the next few partners that may be linked and lie in another
component by then, so no link is lost. A bucket of many members is dealt out as pairs of blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import pretokens
from touchline.llm.support import carried, components, dropped, stored
from touchline.operators.keyed import broadcast_if_small
from touchline.operators.numbering import number_rows

SHINGLE_WORDS = 3
PERCENT = 90
BLOCK = 2048  # members of a bucket that one task compares with another such block
FOLD_WORDS = 512  # at most so many sketch words are compared in buckets: sketches are folded by XOR, which keeps the bound
#: Sketch bits for each shingle in buckets, by the words of a part. More bits let fewer pairs look linked that are not; one bit
#: already tells unrelated sets apart, and where keys are many their rows have to be short.
FOLD_BITS = {1: 4, 3: 1}
FULL_WORD = 8  # shingles for each sketch word at least, or parts of three words are taken
OPEN = (-(1 << 63), -(1 << 63))  # no pair, but a sign that a bucket has more
_SALTS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingle_set(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of `size` words; of all words as one where there are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):  # the order of words counts, and so does their number
        total = pretokens.scrambled(total + words[k : k + len(total)] + _SALTS[k % 3])
    return np.unique(total)


def set_digest(elements: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit sums that name a set."""
    other = pretokens.scrambled(elements ^ _SALTS[1])
    return tuple(np.array([elements.sum(dtype=np.uint64), other.sum(dtype=np.uint64)], np.uint64).view(np.int64).tolist())


class Bands:
    """Size bands for a similarity in percent: band g is [lower[g], lower[g + 1])."""

    def __init__(self, percent: int = PERCENT):
        self.percent, self.lower = percent, [1]

    def band(self, n: int) -> int:
        while self.lower[-1] <= n:
            self.lower.append(self.lower[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.lower, n, "right")) - 1

    def differ(self, sizes: int) -> int:
        """The most elements in which two linked sets of so many elements together differ."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def largest(self, band: int) -> int:
        while len(self.lower) <= band + 1:
            self.band(self.lower[-1])
        return self.lower[band + 1] - 1

    @property
    def part_words(self) -> int:
        return 1 if 100 + self.percent >= 2 * FULL_WORD * (100 - self.percent) else 3

    def parts(self, band: int) -> int:
        """Sketch parts for sets up to the largest of the band; 0 where only equal sets are linked."""
        most = self.differ(2 * self.largest(band))
        return 0 if not most else most + 1 if self.part_words == 1 else most // 2 + 1

    def words(self, band: int) -> int:
        return self.parts(band) * self.part_words


def sketch(elements: np.ndarray, words: int) -> np.ndarray:
    """A bit sketch of so many 64-bit words: each element flips one bit."""
    bits = (elements % np.uint64(words)).astype(np.int64) * 64 + (elements >> np.uint64(58)).astype(np.int64)
    odd = (np.bincount(bits, minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<u8")


def folded(words: np.ndarray, largest: int, bits: int = 4) -> np.ndarray:
    """The sketch XOR-folded to so many bits for each element of the largest set, FOLD_WORDS words at most."""
    count = min(FOLD_WORDS, 1 + bits * largest // 64)
    if len(words) <= count:
        return words
    padded = np.zeros(-(-len(words) // count) * count, "<u8")
    padded[: len(words)] = words
    return np.bitwise_xor.reduce(padded.reshape(-1, count), axis=0)


def sketch_keys(words: np.ndarray, part_words: int, band: int) -> np.ndarray:
    """What a sketch is looked up by: its words, or each two of the three words of a part; the place counts."""
    place = np.arange(len(words), dtype=np.uint64) + np.uint64(band << 40)
    keys = pretokens.scrambled(words + pretokens.scrambled(place))
    if part_words == 3:
        keys = keys.reshape(-1, 3)
        keys = pretokens.scrambled(keys + _SALTS[0]) + np.roll(keys, 1, axis=1)
    return keys.reshape(-1).view(np.int64)


def _described(docs: DataFrame, size: int, percent: int, bits: int) -> DataFrame:
    """(rep, n, d1, d2, low, high): set size, digest, and the folded sketches for the pairs with band - 1 and band + 1."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in pretokens.row_slices(batches, 500):
            n, digests, low, high = [], [], [], []
            for words in pretokens.blank_word_hashes(batch.column("text").to_pylist()):
                elements = shingle_set(words, size)
                n.append(len(elements))
                digests.append(set_digest(elements))
                for found, step in ((low, 0), (high, 1)):
                    band = bands.band(len(elements)) + step if len(elements) else 0
                    count = bands.words(band) if len(elements) else 0
                    found.append(folded(sketch(elements, count), bands.largest(band), bits).tobytes() if count else None)
            digest = np.array(digests, np.int64).reshape(-1, 2)
            columns = [batch.column("rep"), *map(pa.array, (n, digest[:, 0], digest[:, 1])), pa.array(low, pa.binary()), pa.array(high, pa.binary())]
            yield pa.RecordBatch.from_arrays([columns[0], columns[1].cast(pa.int64()), *columns[2:]], ["rep", "n", "d1", "d2", "low", "high"])

    return docs.select("rep", "text").mapInArrow(describe, "rep bigint, n bigint, d1 bigint, d2 bigint, low binary, high binary")


def _keys(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(key, rep, upper) of every document's keys; upper: the document is of the pair's own, not of the lower band.

    Made from the texts each time: sketches of all documents, stored, would be larger than these."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in pretokens.row_slices(batches, 200):
            keys, reps, uppers = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, bool)]
            for rep, words in zip(batch.column("rep").to_pylist(), pretokens.blank_word_hashes(batch.column("text").to_pylist())):
                elements = shingle_set(words, size)
                for step in (0, 1) if len(elements) else ():
                    band = bands.band(len(elements)) + step
                    if bands.parts(band):
                        keys.append(sketch_keys(sketch(elements, bands.words(band)), bands.part_words, band))
                        reps.append(np.full(len(keys[-1]), rep))
                        uppers.append(np.full(len(keys[-1]), step == 0))
            columns = [pa.array(np.concatenate(x)) for x in (keys, reps, uppers)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "rep", "upper"])

    return docs.select("rep", "text").mapInArrow(explode, "key bigint, rep bigint, upper boolean")


def _near(sketches: np.ndarray, sizes: np.ndarray, one: int, others: np.ndarray, percent: int) -> np.ndarray:
    distance = np.bitwise_count(sketches[others] ^ sketches[one]).sum(axis=1, dtype=np.int64)
    return (100 + percent) * distance <= (100 - percent) * (sizes[others] + sizes[one])


def _forest(bucket: dict[str, np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs of a bucket's members that may be linked: a spanning forest of them."""
    reps, sizes, sketches, upper, found = bucket["rep"], bucket["n"], bucket["words"], bucket["upper"], []
    left = np.arange(len(reps))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            one = queue.pop(0)
            able = upper[left] | upper[one]  # two of the lower band meet in their own band's buckets
            near = able & _near(sketches, sizes, one, left, percent)
            found += [(int(reps[one]), int(reps[k])) for k in left[near]]
            queue += left[near].tolist()
            left = left[~near]
    return found


def _further(bucket: dict[str, np.ndarray], percent: int, turn: int) -> list[tuple[int, int]]:
    """Each member's partners number 8^turn - 1 to 8^(turn + 1) - 2 that may be linked, where they lie in other components.

    The members' order alone numbers the partners, so that each is met in one turn. OPEN tells that more are to come."""
    reps, sizes, sketches, upper, parts, found = *(bucket[k] for k in ("rep", "n", "words", "upper", "component")), []
    more = False
    for one in range(len(reps) - 1):
        others = np.arange(one + 1, len(reps))
        others = others[upper[others] | upper[one]]
        others = others[_near(sketches, sizes, one, others, percent)]
        apart = parts[others] != parts[one]
        begin, end = (1 << 3 * turn) - 1, (8 << 3 * turn) - 1
        found += [(int(reps[one]), int(reps[k])) for k in others[begin:end][apart[begin:end]]]
        more |= bool(apart[end:].any())
    return found + [OPEN] * more


def _bucket_pairs(rows: DataFrame, sketches: DataFrame, percent: int, turn: int | None = None) -> DataFrame:
    """(key, i, j, a, b) of rows (key, i, j, rep, upper, component) with their sketches (rep, n, low, high), each bucket by one
    task, sorted by rep: its forest, or what comes in a further turn."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        name = None

        def close() -> list[tuple]:
            if len(held) < 2:
                return []
            rep, n, upper, sketches, component = zip(*held)
            bucket = {
                "rep": np.array(rep), "n": np.array(n), "upper": np.array(upper), "component": np.array(component),
                "words": np.frombuffer(b"".join(sketches), "<u8").reshape(len(rep), -1),
            }
            pairs = _forest(bucket, percent) if turn is None else _further(bucket, percent, turn)
            return [(*name, min(p), max(p)) for p in pairs]

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            columns = list(zip(*found)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "i", "j", "a", "b"])

        for batch in batches:
            found = []
            for key, i, j, *member in zip(*[batch.column(k).to_pylist() for k in range(batch.num_columns)]):
                if (key, i, j) != name:
                    found += close()
                    name = (key, i, j)
                    held.clear()
                held.append(tuple(member))
            yield batch_of(found)
        yield batch_of(close())

    sketch = F.when(F.col("upper"), F.col("low")).otherwise(F.col("high")).alias("sketch")
    ordered = rows.join(sketches, "rep").select("key", "i", "j", "rep", "n", "upper", sketch, "component")
    ordered = ordered.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")
    return ordered.mapInArrow(pairs, "key bigint, i int, j int, a bigint, b bigint")


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Distinct pairs (a, b) with `linked`: whether their exact sets are as similar as asked."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pretokens.row_slices(batches, 500):
            found = [shingle_set(w, size).tobytes() for w in pretokens.blank_word_hashes(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(found, pa.binary())], ["rep", "elements"])

    needed = broadcast_if_small(stored(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "needed"))
    elements = stored(docs.join(needed, "rep", "left_semi").select("rep", "text").mapInArrow(sets, "rep bigint, elements binary"), "sets")
    both = pairs.join(elements.select(F.col("rep").alias("a"), F.col("elements").alias("x")), "a").join(
        elements.select(F.col("rep").alias("b"), F.col("elements").alias("y")), "b"
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pretokens.row_slices(batches, 500):
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    tested = stored(both.select("a", "b", "x", "y").mapInArrow(verify, "a bigint, b bigint, linked boolean"), "tested")
    dropped(elements)
    return tested


def _in_blocks(members: DataFrame, block: int) -> DataFrame:
    """(key, i, j, rep, upper, component): the rows of a bucket of so many `members`, once for each pair of its blocks."""
    blocks = F.ceil(F.col("members") / block).cast("int")
    dealt = members.withColumn("mine", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "rep", "upper", "component")


def _linked(docs: DataFrame, size: int, percent: int, block: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Of documents (rep, text) with unique ids: (rep, n_shingles), and edges (a, b) that connect each component."""
    described = stored(_described(docs, size, percent, bits), "described")
    # One document stands for all of equal set; links between different sets are looked for among these.
    filled = described.where("n > 0").select("rep", "n", "d1", "d2")
    groups = filled.groupBy("d1", "d2", "n").agg(F.min("rep").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    same = stored(filled.join(groups, ["d1", "d2", "n"]).where("rep <> first").select(F.col("rep").alias("a"), F.col("first").alias("b")), "copies")
    # The copies are fewer than the others: while they can be broadcast, no text is shuffled.
    members = docs.join(broadcast_if_small(same.select(F.col("a").alias("rep"))), "rep", "left_anti")
    met = stored(_keys(members, size, percent).groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "met")
    shared = stored(_keys(members, size, percent).join(met.select("key"), "key"), "shared")
    # Buckets of the same members are one: three sums of hashes tell members apart.
    sums = [F.sum(F.xxhash64(F.lit(k), "rep", "upper").bitwiseAND((1 << 40) - 1)).alias(f"h{k}") for k in range(3)]
    # Two of the lower band meet in their own band's buckets: one of the upper band has to be there.
    alike = shared.groupBy("key").agg(F.count("*").alias("members"), F.bool_or("upper").alias("upper"), *sums).where("upper").groupBy("members", "h0", "h1", "h2").agg(F.min("key").alias("key"))
    slim = stored(shared.join(alike.select("key", "members"), "key"), "buckets")
    dropped(met, shared)
    sketches = described.select("rep", "n", "low", "high")
    forest = stored(_bucket_pairs(_in_blocks(slim.withColumn("component", F.col("rep")), block), sketches, percent), "forest")
    tested = _verified(forest.where("a <> b").select("a", "b").distinct(), docs, size, percent)
    bucket = ["key", "i", "j"]
    unsettled = stored(forest.join(tested.where("not linked"), ["a", "b"], "left_semi").select(*bucket).distinct(), "unsettled")
    dropped(forest)
    turn = 0
    while not unsettled.isEmpty():
        known = components(tested.where("linked").select("a", "b"), "components-so-far").select(F.col("node").alias("rep"), "component")
        again = slim.join(broadcast_if_small(unsettled.select("key").distinct()), "key", "left_semi").join(known, "rep", "left")
        again = stored(again.withColumn("component", F.coalesce("component", "rep")), "again")
        mixed = again.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
        rest = _in_blocks(again.join(broadcast_if_small(stored(mixed, "mixed")), "key", "left_semi"), block)
        rest = rest.join(broadcast_if_small(unsettled), bucket, "left_semi")
        found = stored(_bucket_pairs(rest, sketches, percent, turn), "further")
        dropped(again, unsettled)
        sign = (F.col("a") == OPEN[0]) & (F.col("b") == OPEN[1])
        unsettled = stored(found.where(sign).select(*bucket).distinct(), "unsettled")
        new = stored(found.where(~sign & (F.col("a") != F.col("b"))).select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "new-pairs")
        more = _verified(new, docs, size, percent)
        both = stored(tested.unionByName(more), "tested")
        dropped(found, new, more, tested)
        tested, turn = both, turn + 1
    dropped(slim, unsettled)
    return described.select("rep", F.col("n").alias("n_shingles")), tested.where("linked").select("a", "b").union(same)


def _repeats(ids: DataFrame) -> bool:
    return not ids.groupBy("doc_id").count().where("count > 1").isEmpty()


def near_components(
    docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT, block: int = BLOCK, bits: int | None = None
) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every document.

    A NULL or empty text has no shingles and is linked with nothing. Rows with one doc_id are one document of several
    texts: each keeps its n_shingles, and they share a component. A NULL id is never linked, its component is NULL.
    Further columns are ignored; an empty table gives an empty result. `bits`: see FOLD_BITS.
    """
    bits = FOLD_BITS[Bands(percent).part_words] if bits is None else bits
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    named = plain.where("doc_id is not null")
    if not _repeats(named):
        counted, edges = _linked(named.withColumnRenamed("doc_id", "rep"), size, percent, block, bits)
        found = components(edges).withColumnRenamed("component", "component_id")
        joined = counted.join(found, counted["rep"] == F.col("node"), "left")
        result = joined.select(F.col("rep").alias("doc_id"), "n_shingles", F.coalesce("component_id", "rep").alias("component_id"))
    else:  # rows are numbered in the order of ids; those of one id are linked, so a component's smallest row has its smallest id
        numbered = stored(number_rows(named, F.col("doc_id"), F.xxhash64("text"), name="rep"), "numbered")
        counted, edges = _linked(numbered.select("rep", "text"), size, percent, block, bits)
        firsts = numbered.groupBy("doc_id").agg(F.min("rep").alias("first"))
        own = numbered.select("doc_id", "rep").join(firsts, "doc_id")
        found = components(edges.union(own.where("rep <> first").select("rep", "first")))
        joined = counted.join(found, counted["rep"] == F.col("node"), "left").withColumn("top", F.coalesce("component", "rep"))
        names = numbered.select(F.col("rep").alias("top"), F.col("doc_id").alias("component_id"))
        result = joined.join(numbered.select("rep", "doc_id"), "rep").join(names, "top").select("doc_id", "n_shingles", "component_id")
    # Rows without an id are counted alone.
    rest = _described(plain.where("doc_id is null").withColumnRenamed("doc_id", "rep"), size, percent, bits)
    return result.union(rest.select("rep", "n", F.lit(None).cast("bigint")))


def one_of_each(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents whose id is the smallest of their component, whole rows; one of rows with equal ids stays.

    Rows without an id stay, and so do texts without shingles. Columns of any name ride along."""
    docs, back = carried(docs)
    extra = near_components(docs, size, percent).where("component_id <> doc_id").select("doc_id").distinct()
    # The others are fewer than the kept: while they are few enough to broadcast, no text is shuffled.
    kept = docs.join(broadcast_if_small(stored(extra, "extra")), "doc_id", "left_anti")
    named = kept.where("doc_id is not null")
    if not _repeats(named):
        return back(kept)
    one = named.groupBy("doc_id").agg(F.min(F.struct("text", "carried")).alias("held")).select("doc_id", "held.*")
    return back(one.unionByName(docs.where("doc_id is null")))


def one_of_each_text(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """As one_of_each, but rows with one id and different texts are documents of their own, in the order of ids and hashes
    of texts. Of rows equal in both one stays; rows without an id stay."""
    if not _repeats(docs.where("doc_id is not null")):
        return one_of_each(docs, size, percent)
    docs, back = carried(docs)
    rows = docs.where("doc_id is not null").groupBy("doc_id", "text").agg(F.min("carried").alias("carried"))
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    numbered = stored(number_rows(rows, *order, name="number"), "numbered-texts")
    kept = one_of_each(numbered.select(F.col("number").alias("doc_id"), "text", F.struct("doc_id", "carried").alias("own")), size, percent)
    return back(kept.select("own.doc_id", "text", "own.carried").unionByName(docs.where("doc_id is null")))
