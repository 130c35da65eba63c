"""Secret scans with multipart credential linking.

Base kinds are reported wherever their pattern holds. Weak candidates - a login name, a random-looking string, an
endpoint - mean little alone, so they are reported only when complementary parts stand in the same scope: a secret
near an identifier, an identifier near a secret, an endpoint near both. Parts are intervals of a text; an interval join
finds neighbours by equal scope cells and then by distance, so that a cell holds only what fits into its characters, however
many parts a document has. Only built-in column code is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.native import let
from touchline.llm.support import carried, stored

# The base kinds, in the order in which spans of equal start are listed.
ASSIGN = """(?i:(password|passwd|secret|token|api_?key))["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ["assign", "access", "hex", "login", "linked", "endpoint"]

# Weak parts of this operator.
LOGIN = """(?i:\\b(?:user_?name|user|login|account|client_?id|access_?key(?:_?id)?))["']?\\x20*[:=]\\x20*["']?[A-Za-z0-9@._-]{3,}"""
RANDOM = "(?<![A-Za-z0-9+/_-])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}"
ENDPOINT = "(?i:\\b(?:https?|ftps?|ssh|amqps?|redis|mongodb|mysql|postgres(?:ql)?|jdbc:[a-z]+)://[^\\s\\x22'<>]+)"
SCOPE_CHARS = 200  # parts at most so far apart belong to one credential
CELL_CHARS = 512
SPAN = "struct<start:int,kind:int,stop:int>"


def spans(text: Column, pattern: str, kind: str, least: int = 1, value_group: int = 0) -> Column:
    """(start, kind, stop) of the matches whose value has `least` characters; code points, stop exclusive.

    The pieces between matches and the matches add up to the places.
    """
    def placed(gaps: Column, found: Column, values: Column) -> Column:
        def step(done: Column, k: Column) -> Column:
            start = done["at"] + F.length(F.get(gaps, k))
            stop = start + F.length(F.get(found, k))
            span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), stop.alias("stop"))
            good = F.length(F.get(values, k)) >= least
            return F.struct(
                stop.alias("at"), F.when(good, F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans")
            )

        zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), zero, step)["spans"]

    of = let(
        F.struct(
            F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("values"),
        ),
        lambda m: placed(m["gaps"], m["found"], m["values"]),
    )
    return F.when(text.rlike(pattern), of).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    # Runs of fewer characters are dropped matches; as runs are maximal, asking for the length finds the same ones.
    return F.concat(
        spans(text, ASSIGN, "assign", 6, 2), spans(text, ACCESS.replace("+", "{16,}"), "access"),
        spans(text, HEX.replace("+", "{24,}"), "hex"),
    )


def weak_spans(text: Column) -> Column:
    return F.concat(spans(text, LOGIN, "login"), spans(text, RANDOM, "linked"), spans(text, ENDPOINT, "endpoint"))


def linked_parts(parts: DataFrame) -> DataFrame:
    """Of parts (doc, text_hash, start, kind, stop), the weak ones that complementary parts within the scope support."""
    cell = lambda c: F.floor(c / CELL_CHARS).cast("int")
    kinds = {name: k for k, name in enumerate(KINDS)}
    weak = parts.where(F.col("kind") >= kinds["login"]).withColumn(
        "cell", F.explode(F.sequence(cell(F.col("start") - SCOPE_CHARS), cell(F.col("stop") + SCOPE_CHARS)))
    )
    near = parts.select(
        F.col("doc").alias("d"), F.col("text_hash").alias("t"), F.col("start").alias("s"), F.col("kind").alias("k"), F.col("stop").alias("e")
    ).withColumn("c", F.explode(F.sequence(cell(F.col("s")), cell(F.col("e")))))
    same = weak["doc"].eqNullSafe(near["d"]) & (weak["text_hash"] == near["t"]) & (weak["cell"] == near["c"])
    within = (near["s"] <= weak["stop"] + SCOPE_CHARS) & (near["e"] >= weak["start"] - SCOPE_CHARS)
    overlap = (near["s"] < weak["stop"]) & (near["e"] > weak["start"])
    is_base = near["k"] < kinds["login"]
    # A random string inside a login or an endpoint, or anything inside a base span, is that part and no second one.
    inside = overlap & (is_base | (weak["kind"] == kinds["linked"]) & near["k"].isin(kinds["login"], kinds["endpoint"]))
    flag = lambda c: F.max(c.cast("int")) == 1
    seen = weak.join(near, same & within).groupBy("doc", "text_hash", "start", "kind", "stop").agg(
        flag(inside).alias("inside"),
        flag(~overlap & near["k"].isin(kinds["access"], kinds["login"])).alias("identifier"),
        flag(~overlap & near["k"].isin(kinds["assign"], kinds["hex"], kinds["linked"])).alias("secret"),
    )
    supported = (
        F.when(F.col("kind") == kinds["login"], F.col("secret"))
        .when(F.col("kind") == kinds["linked"], F.col("identifier"))
        .otherwise(F.col("secret") & F.col("identifier"))
    )
    return seen.where(~F.col("inside") & supported).select("doc", "text_hash", "start", "kind", "stop")


def span_text(found: Column) -> Column:
    """kind:start:stop of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def secret_spans(docs: DataFrame, keep_columns: bool = False) -> DataFrame:
    """doc_id, base spans and all spans (arrays of start, kind, stop, sorted) of every document.

    A NULL text is empty and has no spans. Rows with one doc_id and different texts are told apart, equal rows have equal
    results, a NULL id is an id of its own, an empty table gives an empty result; further columns are ignored (with
    keep_columns they ride along).
    """
    text = F.coalesce("text", F.lit(""))
    scanned = docs.select(
        *(docs.columns if keep_columns else ["doc_id"]), F.xxhash64("text").alias("_hash"),
        F.sort_array(base_spans(text)).alias("_base"), weak_spans(text).alias("_weak"),
    )
    scanned = stored(scanned, "parts")
    parts = scanned.where(F.size("_weak") > 0).select(
        F.col("doc_id").alias("doc"), F.col("_hash").alias("text_hash"), F.inline(F.concat("_base", "_weak"))
    ).distinct()
    linked = linked_parts(parts).groupBy(F.col("doc").alias("_doc"), F.col("text_hash").alias("_text_hash")).agg(
        F.collect_list(F.struct("start", "kind", "stop")).alias("_more")
    )
    same = scanned["doc_id"].eqNullSafe(F.col("_doc")) & (scanned["_hash"] == F.col("_text_hash"))
    every = F.sort_array(F.concat("_base", F.coalesce("_more", F.array().cast(f"array<{SPAN}>"))))
    return scanned.join(linked, same, "left").select(
        *(docs.columns if keep_columns else ["doc_id"]), F.col("_base").alias("_base_spans"), every.alias("_all_spans")
    )


def secret_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every document."""
    def number(kind: str) -> Column:
        return F.size(F.filter("_base_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    return secret_spans(docs).select(
        "doc_id", *[number(kind) for kind in KINDS[:3]], F.sha2(span_text(F.col("_base_spans")), 256).alias("base_sha256"),
        span_text(F.col("_all_spans")).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span's characters replaced by `mark` (overlapping spans by one) and n_chars counted anew.

    A NULL text stays NULL; columns of any name ride along. See secret_spans."""
    docs, back = carried(docs, ("doc_id", "text", "n_chars"))

    def step(done: Column, span: Column) -> Column:
        gap = F.substring(F.col("text"), done["at"] + 1, span["start"] - done["at"])
        apart = span["start"] >= done["at"]
        return F.struct(
            F.greatest(done["at"], span["stop"]).alias("at"),
            F.when(apart, F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"]).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(
        "_all_spans", zero, step, lambda d: F.concat(d["out"], F.substring(F.col("text"), d["at"] + 1, F.length("text")))
    )
    has = F.size("_all_spans") > 0
    found = secret_spans(docs, keep_columns=True).withColumn("text", F.when(has, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(has, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return back(found.select(*docs.columns))
