"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character n-grams within words, weighted by log(1 + count) and inverse document frequency, at unit
length. Document frequencies come from all documents that may be learned from. The weights are trained by
follow-the-regularised-leader (per-coordinate rates, elastic-net penalty: most weights stay exactly 0) on a bounded sample of
them; a part of the sample that the weights have not seen sets the temperature of the softmax.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm import pretokens

FOLDS = 5
ORDERS = (1, 2, 3)
BUCKETS = 1 << 14
SAMPLE_DOCS = 4000  # the most documents that the weights are trained on; some of each language, else smaller hashes of ids first
EPOCHS = 5
BATCH = 32
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.002, 0.0002
UNKNOWN = "und"


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that nothing is learned from: crc32 of the id as text, modulo the number of folds, is 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def gram_counts(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text, the buckets of its character n-grams and their counts; texts without a letter have none."""
    totals = [(np.empty(0, np.int32), np.empty(0, np.int64))] * len(texts)
    for batch in pretokens.pieces(texts):
        # A blank before and behind every piece: n-grams mark the ends of words.
        joined = "".join(" " + text.lower() + " " + pretokens.TEXT_END for _, text in batch)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = pretokens.character_classes(codes)
        ends = np.flatnonzero(kinds == pretokens.MARK)
        plain = np.where(kinds == pretokens.LETTER, codes, 32).astype(np.uint64)
        buckets = []
        for order in ORDERS:
            value = np.zeros(max(0, len(codes) - order + 1), np.uint64)
            inner = np.zeros(len(value), bool)
            for k in range(order):
                part = plain[k : len(plain) - order + 1 + k]
                value = pretokens.scrambled(value + part + np.uint64(order))
                inner |= part != 32  # n-grams of blanks alone say nothing
                if 0 < k < order - 1:
                    inner &= part != 32  # nor do those across two words, or across two pieces with their blanks
            buckets.append(np.where(inner, (value % np.uint64(BUCKETS)).astype(np.int64), -1))
        begin = 0
        for (k, _), end in zip(batch, ends.tolist()):
            own = np.concatenate([b[begin:end] for b in buckets])
            begin = end + 1
            counts = np.bincount(own[own >= 0], minlength=BUCKETS)
            seen = np.flatnonzero(counts)
            if len(totals[k][0]):
                counts[totals[k][0]] += totals[k][1]
                seen = np.flatnonzero(counts)
            totals[k] = (seen.astype(np.int32), counts[seen])
    return totals


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


class Model:
    """Weights by bucket and language, document-frequency weights, and the temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float = 1.0):
        self.languages, self.idf, self.weights, self.temperature = languages, idf, weights, temperature

    def features(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        values = np.log1p(counts) * self.idf[buckets]
        return values / max(float(np.sqrt(values @ values)), 1e-12)

    def scores(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.features(buckets, counts) @ self.weights[buckets] + self.weights[-1]

    def predict(self, buckets: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        shares = softmax(self.scores(buckets, counts) / self.temperature)
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best])


def softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def train_ftrl(
    samples: list[tuple[np.ndarray, np.ndarray, int]], idf: np.ndarray, languages: list[str], epochs: int = EPOCHS
) -> Model:
    """Weights for samples (buckets, counts, language number), in their order; the last weight row is the bias."""
    model = Model(languages, idf, np.zeros((len(idf) + 1, len(languages))))
    gradients, squares = np.zeros_like(model.weights), np.zeros_like(model.weights)
    prepared = [(np.append(b, len(idf)), np.append(model.features(b, c), 1.0), y) for b, c, y in samples]
    penalty = np.full((len(idf) + 1, 1), L1)
    penalty[-1] = 0  # the bias is free
    for _ in range(epochs):
        for begin in range(0, len(prepared), BATCH):
            batch = prepared[begin : begin + BATCH]
            rows = np.unique(np.concatenate([b for b, _, _ in batch]))
            z, n = gradients[rows], squares[rows]
            rate = (BETA + np.sqrt(n)) / ALPHA + L2
            weights = np.where(np.abs(z) <= penalty[rows], 0.0, -(z - np.sign(z) * penalty[rows]) / rate)
            model.weights[rows] = weights
            step = np.zeros_like(weights)
            for b, x, y in batch:
                at = np.searchsorted(rows, b)
                error = softmax(x @ weights[at])
                error[y] -= 1
                step[at] += np.outer(x, error)
            step /= len(batch)
            sigma = (np.sqrt(n + step**2) - np.sqrt(n)) / ALPHA
            gradients[rows] += step - sigma * weights
            squares[rows] += step**2
    rate = (BETA + np.sqrt(squares)) / ALPHA + L2
    model.weights = np.where(np.abs(gradients) <= penalty, 0.0, -(gradients - np.sign(gradients) * penalty) / rate)
    return model


def calibrate(model: Model, samples: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
    """Set the temperature that makes unseen samples most likely, by golden-section search on its logarithm."""
    if not samples:
        return
    scores = np.array([model.scores(b, c) for b, c, _ in samples])
    truth = np.array([y for _, _, y in samples])

    def loss(log_temperature: float) -> float:
        shares = softmax(scores / np.exp(log_temperature))
        return float(-np.log(np.maximum(shares[np.arange(len(truth)), truth], 1e-12)).mean())

    low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    model.temperature = float(np.exp((low + high) / 2))


def sampled_keys(hashed: DataFrame, sample_docs: int) -> DataFrame:
    """(lang, hash, tie) of the rows to train on, `sample_docs` at most: a quarter of them dealt out evenly to all languages,
    those with the smallest hashes first, the rest to the smallest hashes of all. Of more languages than rows the most
    frequent ones have one."""
    keys, order = ["lang", "hash", "tie"], ["hash", "lang", "tie"]
    frequent = hashed.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample_docs).select("lang")
    languages = [r[0] for r in frequent.collect()]
    quota = max(1, sample_docs // (4 * max(1, len(languages))))
    own = hashed.select(*keys).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "tie"))
    each = own.join(F.broadcast(hashed.sparkSession.createDataFrame([(x,) for x in languages], "lang string")), "lang", "left_semi")
    each = each.withColumn("_place", place).where(F.col("_place") <= quota).select(*order).collect()  # sample_docs rows at most
    chosen = dict.fromkeys(map(tuple, each))
    for row in own.orderBy(*order).limit(sample_docs).select(*order).collect():
        if len(chosen) >= sample_docs:
            break
        chosen[tuple(row)] = None
    return hashed.sparkSession.createDataFrame([(lang, h, tie) for h, lang, tie in chosen], "lang string, hash bigint, tie bigint")


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """A model of the documents outside the held-out fold whose language is known, or None without any.

    Document frequencies cover all of them. The weights see at most `sample_docs`, some of each language and
    else those with the smallest hashes of their ids; so the driver holds that many sparse vectors and one dense table, whatever the corpus.
    """
    learn = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, documents = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for buckets, _ in gram_counts(batch.column("text").to_pylist()):
                totals[buckets] += 1
                documents += 1
        used = np.append(np.flatnonzero(totals), -1)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.append(totals[used[:-1]], documents))], ["bucket", "n"])

    frequent = learn.select("text").mapInArrow(frequencies, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = {r["bucket"]: r["n"] for r in frequent.collect()}  # BUCKETS + 1 rows at most
    documents = found.pop(-1, 0)
    if not documents:
        return None
    df = np.zeros(BUCKETS)
    df[list(found)] = list(found.values())
    idf = np.log((1 + documents) / (1 + df)) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = gram_counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"), batch.column("hash"), pa.array([b.tobytes() for b, _ in pairs], pa.binary()),
                    pa.array([c.astype("<i4").tobytes() for _, c in pairs], pa.binary()),
                ],
                ["lang", "hash", "buckets", "counts"],
            )

    hashed = learn.select("text", "lang", F.xxhash64("doc_id").alias("hash"), F.xxhash64("text").alias("tie"))
    sample = hashed.join(F.broadcast(sampled_keys(hashed, sample_docs)), ["lang", "hash", "tie"]).dropDuplicates(["lang", "hash", "tie"])
    sample = sample.select("text", "lang", "hash")
    rows = sample.mapInArrow(vectors, "lang string, hash bigint, buckets binary, counts binary").collect()
    rows.sort(key=lambda r: (r["hash"], r["lang"], r["buckets"]))
    languages = sorted({r["lang"] for r in rows})
    samples = [
        (np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], "<i4"), languages.index(r["lang"])) for r in rows
    ]
    trained = {y for k, (_, _, y) in enumerate(samples) if k % 6}  # a language needs a row that the weights see
    apart = [len(samples) >= 60 and k % 6 == 0 and s[2] in trained for k, s in enumerate(samples)]
    unseen = [s for s, out in zip(samples, apart) if out]
    seen = [s for s, out in zip(samples, apart) if not out]
    model = train_ftrl(seen, idf, languages)
    calibrate(model, unseen)
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, from its whole text alone.

    A NULL text and one without a letter are `und` with score 0, and so is everything without a model. Rows with
    equal ids and equal texts have equal results; further columns are ignored, an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [
                model.predict(*pair) if model and has_letter(text) else (UNKNOWN, 0.0) for text, pair in zip(texts, gram_counts(texts))
            ]
            columns = [pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
