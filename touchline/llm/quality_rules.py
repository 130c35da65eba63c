"""Quality rules: surface counts, and the log-likelihood ratio between a trusted target and the raw corpus.

Words and pairs of neighbouring words are hashed to a fixed number of buckets. Two multinomials over the buckets, one of
the trusted documents and one of all documents, give each bucket a log ratio; a document's score is the mean over its
n-grams, and a document stays when its score reaches a fixed threshold and it passes the surface rules. Everything is
built-in column code. The corpus passes are one aggregate whose groups are the buckets (partial sums before the shuffle)
and one scan that looks ratios up in an array of fixed size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.native import BLANKS, blank_words, let, neighbours
from touchline.llm.support import carried, stored
from touchline.operators.keyed import broadcast_if_small

BUCKETS = 1 << 14
THRESHOLD = -0.08  # mean log ratio per n-gram, in nats
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"


def hashed_ngrams(words: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the lower-cased words and pairs of neighbouring words."""
    def bucket(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")

    def grams(lowered: Column) -> Column:
        return F.concat(
            F.transform(lowered, lambda a: bucket(a)), F.zip_with(*neighbours(lowered, 2), lambda a, b: bucket(a, b))
        )

    return let(F.transform(words, F.lower), grams)


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a window of three words which occurs at least twice in the text."""
    def covered(places: Column) -> Column:  # places of repeated windows, ascending: three words each, shared ones once
        steps = F.transform(places, lambda p, k: F.coalesce(F.least(F.lit(3), F.get(places, k + 1) - p), F.lit(3)))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def among(windows: Column) -> Column:  # structs (hash, place), sorted: repeated windows are neighbours
        def repeated(w: Column, k: Column) -> Column:
            before, behind = F.get(windows, k - 1)["h"], F.get(windows, k + 1)["h"]
            return F.coalesce(before == w["h"], F.lit(False)) | F.coalesce(behind == w["h"], F.lit(False))

        return let(F.sort_array(F.transform(F.filter(windows, repeated), lambda w: w["p"])), covered)

    def of(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(placed, among))

    def windows_of(a_words: Column) -> Column:
        triples = F.arrays_zip(*[part.alias(name) for part, name in zip(neighbours(a_words, 3), "abc")])
        return F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"]))

    return let(windows_of(words), of)


def surface_counts(text: Column, words: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    plain = text
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    letters = F.aggregate(words, F.lit(0), lambda total, word: total + F.length(word))
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": letters.cast("bigint"),
        "n_symbols": (F.length(text) - F.length(plain)).cast("bigint"),
        "n_dup_lines": let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("bigint"),
        "n_repeat_words": repeated_words(words).cast("bigint"),
    }


def bucket_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row with the array of log ratios, trusted over raw, each multinomial smoothed by one count a bucket.

    Trusted are the documents whose labels are all of quality 1. Without any, every ratio is 0.
    """
    trusted = (
        labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("_q"))
        .where("_q = 1").select(F.col("doc_id").alias("_id"), F.lit(1).alias("_trusted"))
    )
    texts = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text"))
    grams = texts.join(broadcast_if_small(trusted), F.col("_doc") == F.col("_id"), "left").select(
        F.coalesce("_trusted", F.lit(0)).alias("trusted"), F.explode(hashed_ngrams(blank_words(F.col("_text")), buckets)).alias("bucket")
    )
    counts = stored(grams.groupBy("bucket").agg(F.sum("trusted").alias("target"), F.count("*").alias("raw")), "bucket-counts")
    total = counts.agg(F.coalesce(F.sum("target"), F.lit(0)).alias("target_all"), F.coalesce(F.sum("raw"), F.lit(0)).alias("raw_all")).first()

    def log_share(count: str, everything: int) -> Column:
        return F.log((F.coalesce(count, F.lit(0)) + 1) / F.lit(float(everything + buckets)))

    ratio = log_share("target", total["target_all"]) - log_share("raw", total["raw_all"]) if total["target_all"] else F.lit(0.0)
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    return (
        every.join(counts, "bucket", "left").select("bucket", ratio.alias("ratio"))
        .agg(F.sort_array(F.collect_list(F.struct("bucket", "ratio"))).alias("pairs"))
        .select(F.col("pairs.ratio").alias("ratios"))
    )


def quality(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, keep_columns: bool = False
) -> DataFrame:
    """doc_id, surface counts, base_failed, kept and score of every document (with keep_columns: the rows of docs that are kept).

    A NULL or empty text has no words, so it fails the base rule. Score is NULL without n-grams. Equal ids and texts stay
    separate rows with equal results, further columns are ignored, empty tables give an empty result. Labels with a
    NULL id are ignored; labels that contradict each other are not trusted.
    """
    docs, back = carried(docs) if keep_columns else (docs.select("doc_id", "text"), None)
    text = F.col("text")
    found = F.transform(
        F.array(blank_words(text)),
        lambda words: F.struct(
            *[c.alias(name) for name, c in surface_counts(text, words).items()],
            hashed_ngrams(words, buckets).alias("grams"),
        ),
    )
    # A generator: filters on what it makes are not pushed below it, where each mention would count everything anew.
    counted = docs.select(
        *([F.col(c) for c in docs.columns] if keep_columns else [F.col("doc_id")]),
        F.explode(found).alias("_found"),
        bucket_ratios(docs, labels, buckets).scalar().alias("_ratios"),
    )
    total = F.aggregate("_found.grams", F.lit(0.0), lambda s, g: s + F.get("_ratios", g))
    counted = counted.withColumn("_score", total / F.nullif(F.size("_found.grams"), F.lit(0)))
    failed = (F.col("_found.n_words") < MIN_WORDS) | (
        100 * F.col("_found.n_repeat_words") > MAX_REPEATED_PERCENT * F.col("_found.n_words")
    )
    kept = ~failed & (F.coalesce("_score", F.lit(0.0)) >= threshold)
    if keep_columns:
        return back(counted.where(kept))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return counted.select(
        "doc_id", *[F.col(f"_found.{n}").alias(n) for n in names], failed.alias("base_failed"), kept.alias("kept"),
        F.col("_score").alias("score"),
    )
