from __future__ import annotations

import gzip
import io
import json
import urllib.parse
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spendscore.llm import warc

SCHEMA = "page_id long, url string, html string, sha1 string, last string, payload_bytes int"


def pages(spark, *rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def brute(rows):
    last = {}
    for page, _, html in rows:
        key = html or ""
        last[key] = max((x for x in (last.get(key), page) if x is not None), default=None)
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        response = page == last[html or ""]
        out.append((page or -1, len(payload), warc.digest(payload), "response" if response else "revisit", None if response else last[html or ""]))
    return sorted(out, key=str)


def run(spark, rows):
    found = warc.round_trip(pages(spark, *rows)).collect()
    return sorted(((r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found), key=str)


ROWS = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, "http://a\r\nX: y", "<p>é\r\n\r\nWARC/1.1\r\n</p>"),
    (4, None, None), (5, "u", ""), (9_007_199_254_740_993, "u", "big id"), (6, "u", "z" * 3_000_000), (7, "u", "z" * 3_000_000),
    (None, "u", "<p>one</p>"), (None, "u", "alone"), (8, "u", "twice"), (8, "u", "twice"),
]


def test_round_trip(spark):
    assert run(spark, ROWS) == brute(ROWS)


def test_empty(spark):
    assert run(spark, []) == []


def test_archives_and_index(spark, tmp_path):
    """The first archives are one stream each; the second have a member per record, as their index says."""
    whole, split = f"file://{tmp_path}/whole", f"file://{tmp_path}/split"
    df = pages(spark, *[(k, f"http://a/{k}", f"<p>{k % 40} text</p>" * (k % 9)) for k in range(300)]).repartition(3)
    files = warc.write_archives(df, whole, file_bytes=8000)
    first = sorted(Path(tmp_path, "whole").glob("*.gz"))
    assert files.count() == len(first) > 3 and files.agg(F.sum("records")).first()[0] == 300
    for path in first:
        assert path.read_bytes().count(b"\x1f\x8b\x08\x00") == 1
    index = warc.normalise(files, whole, split).collect()
    assert len(index) == 300
    by_file = {}
    for row in index:
        by_file.setdefault(row["file"], []).append(row)
    for name, rows in by_file.items():
        data = Path(tmp_path, "split", name).read_bytes()
        beside = [json.loads(x) for x in Path(tmp_path, "split", f"{name}.idx").read_text().splitlines()]
        assert [(x["offset"], x["length"]) for x in beside] == sorted((r["offset"], r["length"]) for r in rows)
        assert sum(r["length"] for r in rows) == len(data)
        for row in rows:
            record = gzip.decompress(data[row["offset"] : row["offset"] + row["length"]])
            assert record.startswith(b"WARC/1.1\r\n") and row["record_id"].encode() in record and record.endswith(b"\r\n\r\n")
    read = warc.read_records(spark.createDataFrame(index), split, partitions=4).collect()
    assert {r["payload"].decode() for r in read if r["record_type"] == "response"} == {f"<p>{k % 40} text</p>" * (k % 9) for k in range(300)}


@pytest.mark.parametrize("members", [1, 3])
def test_streams_in_pieces(members, monkeypatch):
    monkeypatch.setattr(warc, "PIECE", 100)
    whole = [warc.record(k, "u", bytes(range(256)) * k, warc.digest(b""), True, None) for k in range(6)]
    size = 6 // members
    data = b"".join(gzip.compress(b"".join(whole[k : k + size])) for k in range(0, 6, size))
    for stream in (data, b"".join(whole)):
        found = list(warc.records(warc.inflated(io.BytesIO(stream))))
        assert [x + b"\r\n\r\n" for _, x in found] == whole
        assert [h["warc-record-id"] for h, _ in found] == [f"<urn:page:{k}>" for k in range(6)]


def test_broken_streams():
    data = gzip.compress(warc.record(1, "u", b"x" * 1000, "s", True, None))
    for bad in (data[:-20], data[: len(data) // 2]):
        with pytest.raises(ValueError):
            list(warc.records(warc.inflated(io.BytesIO(bad))))
    with pytest.raises(ValueError):
        list(warc.records(iter([b"no record\r\n\r\n"])))


def test_header_lines():
    head = warc.record(1, "a\r\nb", b"", "s", True, None).split(b"\r\n\r\n")[0]
    assert warc.parsed(head)["warc-target-uri"] == urllib.parse.quote("a\r\nb")


def test_urls_of_any_length(spark):
    """Headers of 64 KB and more, over the borders of pieces."""
    rows = [(k, "u" * size, f"<p>{k}</p>") for k, size in enumerate((100_000, 900_000, 2_000_000, 100_000), 1)]
    assert run(spark, rows) == brute(rows)
    data = gzip.compress(warc.record(1, "u" * 2_000_000, b"x", "s", True, None))
    [(headers, _)] = warc.records(warc.inflated(io.BytesIO(data)))
    assert headers["warc-target-uri"] == "u" * 2_000_000
