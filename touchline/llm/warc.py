"""Web archives with a globally ordered capture index.

Pages are written as WARC records by Spark's text writer (a record ends in two line ends, which is the writer's line
separator), gzip-compressed. Of pages with equal payloads the one with the largest id is the response, the others are
revisits of it. Reading the archives back gives a capture entry for each record. Each file's entries are sorted where they are
read and form a run; runs are cut at common borders of (URL key, timestamp, page id), and each range merges its
pieces of all runs by a loser tree. So the index is ordered across its parts, a range holds a bounded number of entries, and a
URL with any number of captures spreads over ranges.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.keyed import broadcast_if_small

RECORDS_PER_FILE = 5_000
ENTRIES_PER_RANGE = 50_000
REVISIT_BYTES = 0  # payloads of fewer bytes are always written in full
FIRST_CAPTURE = "2024-01-01 00:00:00"  # pages carry no time: page n is dated n seconds after this one

# Fixed values of the WARC format.
VERSION, END, PROFILE = "WARC/1.1", "\r\n\r\n", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEX_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ENTRY = (
    "url_key string, stamp string, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, file string, place bigint, length bigint"
)


def base32_sha1(data: Column) -> Column:
    """The base32 form of a SHA-1: five hexadecimal digits make four of base 32."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), _HEX_DIGITS, _BASE32)


def with_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, n (bytes), digest, record_type and refers_to of every page."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("n"), base32_sha1(payload.cast("binary")).alias("digest"),
    )
    again = (
        rows.where(F.col("n") >= revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("latest"), F.count("*").alias("equal"))
        .where("equal > 1").select(F.col("digest").alias("_digest"), "latest")
    )
    joined = rows.join(broadcast_if_small(again), F.col("digest") == F.col("_digest"), "left")
    is_revisit = F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest"))
    return joined.select(
        "page_id", "url", "payload", "n", "digest", F.when(is_revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(is_revisit, F.col("latest")).alias("refers_to"),
    )


def record_text(first_capture: str = FIRST_CAPTURE) -> Column:
    """The record of a row of with_records, without its last two line ends."""
    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    name_of = lambda c: F.concat(F.lit("<urn:x-page:"), c.cast("string"), F.lit(">"))
    second = F.unix_timestamp(F.lit(first_capture)) + F.coalesce("page_id", F.lit(0))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END))
    block = F.concat(http, F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit("")))
    revisit = F.col("record_type") == "revisit"
    return F.concat(
        F.lit(f"{VERSION}\r\n"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", name_of(F.col("page_id"))),
        field("WARC-Target-URI", url),
        field("WARC-Date", F.date_format(F.timestamp_seconds(second), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("WARC-Refers-To", F.when(revisit, name_of(F.col("refers_to")))),
        field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block,
    )


def write_archives(pages: DataFrame, folder: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write a record for every page.

    NULL html is an empty payload, a NULL url leaves its field out, a NULL page_id names no record; a group whose ids are all
    NULL has responses only, and rows that share the largest id of their group are all responses. Further columns are
    ignored; an empty table makes an empty folder.
    """
    text = with_records(pages, revisit_bytes).select(record_text().alias("value"))
    writer = text.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.text(folder)


def url_key(url: str) -> str:
    """Host parts from the last to the first, then path and query, lower-cased: captures of one address sort together."""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    host = ",".join(reversed(host.removeprefix("www.").split(".")))
    query = "?" + "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{host}{f':{port}' if port not in (None, 80, 443) else ''}){parts.path or '/'}{query}".lower()


class _Inflated:
    """Bytes of a gzip file, inflated as they are read."""

    def __init__(self, data: bytes, step: int = 1 << 20):
        self.chunks = (data[k : k + step] for k in range(0, len(data), step))
        self.engine, self.buffer, self.place = zlib.decompressobj(31), b"", 0

    def _more(self) -> bool:
        if self.engine.eof:
            rest, self.engine = self.engine.unused_data, zlib.decompressobj(31)
            chunk = rest or next(self.chunks, b"")
        else:
            chunk = next(self.chunks, b"")
        if not chunk:
            return False
        self.buffer += self.engine.decompress(chunk)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What stands before the next mark, which is passed over; None at the end."""
        while (at := self.buffer.find(mark)) < 0:
            if not self._more():
                return None
        return self.take(at + len(mark))[:at]

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        if len(self.buffer) < n:
            raise ValueError("a record ends before its length")
        data, self.buffer = self.buffer[:n], self.buffer[n:]
        self.place += n
        return data


def parse_archive(data: bytes, file: str) -> Iterator[tuple]:
    """The capture entries of one archive, in file order; a payload that does not match its digest is an error."""
    source = _Inflated(data)
    while True:
        place = source.place
        head = source.until(b"\r\n\r\n")
        if head is None:
            return
        version, *lines = head.decode().split("\r\n")
        if version != VERSION:
            raise ValueError(f"no record at {place} of {file}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = source.take(int(fields["Content-Length"]))
        http, payload = block.split(b"\r\n\r\n", 1)
        http_fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload and digest differ at {place} of {file}")
        if source.take(4) != b"\r\n\r\n":
            raise ValueError(f"a record without an end at {place} of {file}")
        number = lambda name: int(fields[name][12:-1]) if name in fields else None
        stamp = "".join(c for c in fields["WARC-Date"] if c.isdigit())
        yield (
            url_key(fields.get("WARC-Target-URI", "")), stamp, number("WARC-Record-ID"), int(http_fields["Content-Length"]),
            digest, fields["WARC-Type"], number("WARC-Refers-To"), file, place, source.place - place,
        )


def _order(entry: tuple) -> tuple:
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[7], entry[8]


class LoserTree:
    """Merge of sorted lists: each inner node keeps the loser of its two sides, so the next winner takes one path up."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at, self.count = runs, [0] * len(runs), max(1, len(runs))
        self.keys = [_order(run[0]) if run else None for run in runs] or [None]
        self.losers = [-1] * self.count
        self.winner = self._play(1)

    def _beats(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None
        return self.keys[a] <= self.keys[b]

    def _play(self, node: int) -> int:
        if node >= self.count:
            return node - self.count
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        return winner

    def __iter__(self) -> Iterator[tuple]:
        while self.keys[self.winner] is not None:
            run = self.winner
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self.keys[run] = _order(self.runs[run][self.at[run]]) if self.at[run] < len(self.runs[run]) else None
            node = (run + self.count) // 2
            while node:
                if self._beats(self.losers[node], self.winner):
                    self.winner, self.losers[node] = self.losers[node], self.winner
                node //= 2


def _entry_batch(entries: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [field.split(" ")[0] for field in ENTRY.split(", ")]
    columns = [pa.array(c, t) for c, t in zip(list(zip(*entries)) or [[]] * len(kinds), kinds)]
    return pa.RecordBatch.from_arrays(columns, names)


def write_index(spark: SparkSession, archives: str, folder: str, per_range: int = ENTRIES_PER_RANGE) -> None:
    """Read all archives of a folder and write their capture entries in one global order, part after part."""
    def sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                run = sorted(parse_archive(content.as_py(), path.rsplit("/", 1)[-1]), key=_order)
                for k in range(0, len(run), 10_000):
                    yield _entry_batch(run[k : k + 10_000])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            for entry in zip(*[c.to_pylist() for c in batch.columns]):
                runs.setdefault(entry[7], []).append(entry)
        # A run's piece arrives in its order unless its stored file was read in parts.
        pieces = [run if all(map(lambda a, b: _order(a) <= _order(b), run, run[1:])) else sorted(run, key=_order) for run in runs.values()]
        held: list[tuple] = []
        for entry in LoserTree(pieces):
            held.append(entry)
            if len(held) == 10_000:
                yield _entry_batch(held)
                held = []
        yield _entry_batch(held)

    files = spark.read.format("binaryFile").load(archives).select("path", "content")
    runs_folder = f"{folder}-runs"
    files.mapInArrow(sorted_runs, ENTRY).write.parquet(runs_folder)
    runs = spark.read.schema(ENTRY).parquet(runs_folder)
    ranges = max(1, -(-runs.count() // per_range))
    runs.repartitionByRange(ranges, "url_key", "stamp", "page_id").mapInArrow(merged, ENTRY).write.parquet(folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ENTRY).parquet(folder)
