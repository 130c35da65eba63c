"""Benchmark decontamination by a prefix-filtered set join.

Windows of an item's words are sets of positioned shingles. One scan of the documents finds every occurrence of any
benchmark shingle; the occurrences give each shingle's frequency, which orders the shingles by rarity. To occur, a
window needs all of its shingles, so its necessary prefix is its rarest one: occurrences of that shingle are the
candidates. The prefix narrows what is verified, not the scan, whose join takes every benchmark shingle. A candidate must
not start before the document's first word, and is verified by the exact places of all its shingles; that these end by
the document's last word follows from it. Only built-in column code is used; shingles are compared as text, not by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.native import neighbours
from touchline.llm.support import carried, stored
from touchline.operators.keyed import broadcast_if_small

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
_LOWER = {chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)}
_BREAKS = "[\\x00-/:-`{-\\x7F]+"


def spaced(text: Column) -> Column:
    """The words of a text, A-Z lower-cased, with one blank between them and none around them."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "".join(_LOWER), "".join(_LOWER.values()))
    return F.btrim(F.regexp_replace(lowered, _BREAKS, " "))


def word_list(line: Column) -> Column:
    return F.when(line == "", F.array().cast("array<string>")).otherwise(F.split(line, " "))


def word_number(line: Column) -> Column:
    return F.when(line == "", 0).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def shingle_rows(rows: DataFrame, keep: list[str], words: str, size: int) -> DataFrame:
    """A row (keep..., pos, s0, s1, ...) for each place of `size` words behind each other."""
    zipped = F.arrays_zip(*[part.alias(f"s{k}") for k, part in enumerate(neighbours(F.col(words), size))])
    return rows.select(*keep, F.posexplode(zipped).alias("pos", "_s")).select(
        *keep, "pos", *[F.col(f"_s.s{k}").alias(f"s{k}") for k in range(size)]
    )


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, window, words): the distinct windows of each item, named by hash; one of fewer words is a window itself."""
    items = benchmark.where("item_id is not null").select("item_id", word_list(spaced(F.col("text"))).alias("words"))
    last = F.greatest(F.size("words") - WINDOW_WORDS, F.lit(0))
    starts = items.where(F.size("words") > 0).select("item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    windows = starts.select("item_id", F.slice("words", F.col("at") + 1, F.lit(WINDOW_WORDS)).alias("words")).distinct()
    return windows.select("item_id", F.xxhash64("words").alias("window"), "words")


def _occurring(texts: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """(doc, text_hash, start, window) of the windows in `windows` (window, words) whose shingles have `size` words."""
    names = [f"s{k}" for k in range(size)]
    parts = stored(
        shingle_rows(windows, ["window"], "words", size).select("window", "pos", F.xxhash64(*names).alias("shingle"), *names), "parts"
    )
    known = broadcast_if_small(parts.select(F.col("shingle").alias("known"), *[F.col(n).alias(f"k_{n}") for n in names]).distinct())
    places = shingle_rows(texts, ["doc", "text_hash"], "words", size)
    same = F.xxhash64(*names) == F.col("known")
    for n in names:  # the hash finds, the text decides; as two comparisons, so that the hash alone is the join's key
        same = same & (F.col(n) >= F.col(f"k_{n}")) & (F.col(n) <= F.col(f"k_{n}"))
    hits = places.join(known, same).select("doc", "text_hash", "pos", F.col("known").alias("shingle")).distinct()
    hits = stored(hits, "occurrences")

    rarity = hits.groupBy("shingle").agg(F.count("*").alias("rarity"))
    needs = parts.groupBy("window").agg(F.count("*").alias("needed"))
    ranked = parts.join(broadcast_if_small(rarity), "shingle").groupBy("window").agg(
        F.count("*").alias("present"), F.min(F.struct("rarity", "pos", "shingle")).alias("prefix")
    )
    # A window with a shingle that occurs nowhere cannot occur itself.
    able = stored(
        ranked.join(needs, "window").where("present = needed").select(
            "window", "needed", F.col("prefix.pos").alias("offset"), F.col("prefix.shingle").alias("shingle")
        ), "prefixes",
    )
    candidates = (
        hits.join(broadcast_if_small(able), "shingle")
        .select("doc", "text_hash", "window", "needed", (F.col("pos") - F.col("offset")).alias("start")).where("start >= 0")
    )
    wanted = candidates.join(broadcast_if_small(parts.select("window", F.col("pos").alias("at"), "shingle")), "window").select(
        "doc", "text_hash", "window", "needed", "start", (F.col("start") + F.col("at")).alias("pos"), "shingle"
    )
    there = hits.select(F.col("doc").alias("d"), F.col("text_hash").alias("t"), F.col("pos").alias("p"), F.col("shingle").alias("s"))
    same = wanted["doc"].eqNullSafe(there["d"]) & (wanted["text_hash"] == there["t"])
    met = wanted.join(there, same & (wanted["pos"] == there["p"]) & (wanted["shingle"] == there["s"]), "left_semi")
    whole = met.groupBy("doc", "text_hash", "start", "window").agg(F.count("*").alias("n"), F.max("needed").alias("needed"))
    return whole.where("n = needed").select("doc", "text_hash", "start", "window")


def hit_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc, text_hash, n_hit, items) of the documents in which a window occurs; one row for equal ids and texts."""
    windows = stored(item_windows(benchmark), "windows")
    single = windows.select("window", "words").distinct()
    size_of = F.least(F.size("words"), F.lit(SHINGLE_WORDS))
    sizes = sorted(r[0] for r in single.select(size_of).distinct().collect())  # at most SHINGLE_WORDS of them
    texts = docs.select(
        F.col("doc_id").alias("doc"), F.xxhash64("text").alias("text_hash"), word_list(spaced(F.col("text"))).alias("words")
    )
    found = [_occurring(texts, single.where(size_of == size), size) for size in sizes or [SHINGLE_WORDS]]
    occurrences = found[0]
    for more in found[1:]:
        occurrences = occurrences.union(more)
    occurrences = stored(occurrences, "verified")
    of_window = windows.select("window", F.size("words").alias("length"), F.col("item_id").cast("string").alias("item"))
    lengths = broadcast_if_small(of_window.select("window", "length").distinct())
    covered = occurrences.join(lengths, "window").select(
        "doc", "text_hash", F.explode(F.expr("sequence(start, start + length - 1)")).alias("at")
    )
    hit = covered.distinct().groupBy("doc", "text_hash").agg(F.count("*").alias("n_hit"))
    items = (
        occurrences.select("doc", "text_hash", "window").distinct()
        .join(broadcast_if_small(of_window.select("window", "item")), "window").select(F.col("doc").alias("d"), F.col("text_hash").alias("t"), "item")
        .groupBy("d", "t").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    return stored(
        hit.join(items, hit["doc"].eqNullSafe(items["d"]) & (hit["text_hash"] == items["t"])).select("doc", "text_hash", "n_hit", "items"),
        "hit-documents",
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and items of every document.

    A NULL text has no words; an item without words or without id never occurs. Rows with one doc_id and different
    texts are told apart, equal rows have equal results, a NULL id is an id of its own; further columns are ignored.
    Empty documents give an empty result, an empty benchmark leaves every document clean.
    """
    hit = hit_documents(docs, benchmark)
    counted = docs.select("doc_id", F.xxhash64("text").alias("hash"), word_number(spaced(F.col("text"))).alias("n_words"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    same = counted["doc_id"].eqNullSafe(hit["doc"]) & (counted["hash"] == hit["text_hash"])
    return counted.join(broadcast_if_small(hit), same, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), listed.alias("items"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark window, whole rows; columns of any name ride along. See contamination."""
    docs, back = carried(docs)
    hit = hit_documents(docs, benchmark).select("doc", "text_hash")
    same = docs["doc_id"].eqNullSafe(F.col("doc")) & (F.xxhash64(docs["text"]) == F.col("text_hash"))
    return back(docs.join(broadcast_if_small(hit), same, "left_anti"))
