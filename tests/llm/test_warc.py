"""Archives and their index: round trip, revisits, global order."""

import base64
import gzip
import hashlib
import random

from touchline.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as n", "'x' as digest")


ROWS = [
    (1, "http://a.example.com/x?b=2&a=1", "same"), (2, "https://www.a.example.com/x?a=1&b=2", "same"), (3, "http://b.example.org", None),
    (4, None, ""), (5, "http://[bad", "line\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (6, "http://a.example.com:8080/\n", "é😀" * 5000),
    (7, "http://c.example.net/y", "same"), (8, "http://c.example.net/y", "x" * 200_000),
]


def read(spark, rows, folder, **options):
    warc.write_archives(pages(spark, rows), f"{folder}/archives", **options)
    warc.write_index(spark, f"{folder}/archives", f"{folder}/index", per_range=3)
    return warc.read_index(spark, f"{folder}/index").collect()


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 2)
    got = {r["page_id"]: r for r in read(spark, ROWS, tmp_path)}
    latest = {}
    for i, _, html in ROWS:
        latest[html or ""] = i
    assert len(got) == len(ROWS)
    for i, _, html in ROWS:
        data = (html or "").encode()
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        first = latest[html or ""]
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first == i else ("revisit", first))
    assert got[1]["url_key"] == got[2]["url_key"] == "com,example,a)/x?a=1&b=2"
    # Places lead to the records.
    for r in got.values():
        data = gzip.decompress((tmp_path / "archives" / r["file"]).read_bytes())
        record = data[r["place"] : r["place"] + r["length"]]
        assert record.startswith(b"WARC/1.1\r\n") and f"<urn:x-page:{r['page_id']}>".encode() in record and record.endswith(b"\r\n\r\n")


def test_global_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 7)
    dice = random.Random(1)
    rows = [(k, f"http://h{dice.choice([0, 0, 0, 1, 2, 3])}.example.com/", str(k % 5)) for k in range(120)]
    read(spark, rows, tmp_path)
    parts = sorted((tmp_path / "index").glob("part-*"))
    assert len(parts) > 5
    found = [(r["url_key"], r["stamp"], r["page_id"]) for p in parts for r in spark.read.parquet(str(p)).collect()]
    assert found == sorted(found) and len(found) == 120


def test_short_payloads_and_ties(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc"), (4, "u", "abc"), (None, "u", "abc")]
    got = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in read(spark, rows, tmp_path, revisit_bytes=3))
    assert got == [
        ("1", "response", None), ("2", "response", None), ("3", "revisit", 4), ("4", "response", None), ("4", "response", None),
        ("None", "revisit", 4),
    ]


def test_empty(spark, tmp_path):
    assert read(spark, [], tmp_path) == []


def test_loser_tree():
    dice = random.Random(4)
    for k in (0, 1, 2, 3, 7, 20):
        runs = [sorted(("k", "s", dice.randrange(50), 0, "", "", None, f"f{j}", n, 0) for n in range(dice.randrange(9))) for j in range(k)]
        runs = [sorted(r, key=warc._order) for r in runs]
        assert list(warc.LoserTree(runs)) == sorted(sum(runs, []), key=warc._order)
