"""WARC archives: written as whole-file gzip streams, normalised to one member a record, read by index.

A file that is one gzip stream can only be read from its start. The normaliser
inflates such a stream once, in pieces, and writes every record as a gzip member of its own,
with an index beside the file: a reader then fetches any record by offset and length. It works
on plain and on already split files alike.

Files lie in the shared folder and are opened by its URI, so that any executor
finds them. Their names are new for every attempt; only the files that a finished
task has reported are used, so a lost or repeated attempt leaves unused files at most.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscore.llm.common import removed, shipped, written_at
from spendscore.llm.filters import split_by_keys
from spendscore.sources.workdir import work_dir

#: Bytes inflated at once, and bytes of records after which a new file starts.
PIECE, FILE_BYTES = 1 << 20, 64 << 20
GZIP = 16 + zlib.MAX_WBITS
CRLF = b"\r\n"


def digest(payload: bytes) -> str:
    """SHA-1 in base32, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value) -> str:
    """A header value: no line breaks."""
    return re.sub(r"[\r\n\x00]", lambda m: f"%{ord(m[0]):02X}", str(value))


def record(page_id, url, payload: bytes, sha1: str, response: bool, refers_to) -> bytes:
    """A WARC record; a revisit has the headers alone."""
    block = payload if response else b""
    name = "none" if page_id is None else page_id
    headers = [
        ("WARC-Type", "response" if response else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Target-URI", None if url is None else _line(url)),
        ("WARC-Payload-Digest", f"sha1:{sha1}"),
        ("WARC-Refers-To", None if response else f"<urn:page:{'none' if refers_to is None else refers_to}>"),
        ("WARC-Profile", None if response else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("Payload-Length", len(payload)),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", len(block)),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogatepass") + CRLF + block + CRLF + CRLF


def parsed(head: bytes) -> dict[str, str]:
    """The headers of a record, names in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def _store(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, or of a plain file, in pieces."""
    data = stream.read(PIECE)
    if data[:2] != b"\x1f\x8b":
        while data:
            yield data
            data = stream.read(PIECE)
        return
    engine = zlib.decompressobj(GZIP)
    while data:
        if out := engine.decompress(data, PIECE):
            yield out
        if engine.eof:
            data = engine.unused_data.lstrip(b"\0") or stream.read(PIECE)
            engine = zlib.decompressobj(GZIP) if data else engine
        else:
            data = engine.unconsumed_tail or stream.read(PIECE)
    if rest := engine.flush():
        yield rest
    if not engine.eof:
        raise ValueError("a gzip stream that ends early")


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, bytes) of every record; at most one record is held."""
    held = bytearray()

    def filled(least: int) -> bool:
        while len(held) < least:
            more = next(pieces, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while filled(1):
        if filled(2) and held[:2] == CRLF:  # line breaks between records
            del held[:2]
            continue
        if not filled(5) or held[:5] != b"WARC/":
            raise ValueError(f"no WARC record: {bytes(held[:40])!r}")
        # A header may be of any length, as urls are; only what is new is searched.
        seen = 0
        while (end := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not filled(seen + 1):
                raise ValueError("a record without the end of its header")
        headers = parsed(bytes(held[:end]))
        size = end + 4 + int(headers["content-length"])
        if not filled(size):
            raise ValueError("a record that ends early")
        yield headers, bytes(held[:size])
        del held[:size]


def _digested(batches):
    """Pages with the length and digest of their payload."""
    for pdf in batches:
        payloads = [(x or "").encode("utf-8", "surrogatepass") for x in pdf["html"]]
        yield pdf.assign(payload_bytes=[len(p) for p in payloads], sha1=[digest(p) for p in payloads])


def _archived(batches, folder: str, file_bytes: int):
    """Write this task's records as whole-file gzip streams; one row per file."""
    store, base = _store(folder)
    out = name = None
    engine, count, size = None, 0, 0

    def closed():
        out.write(engine.flush())
        out.close()
        return pd.DataFrame({"file": [name], "records": [count]})

    for pdf in batches:
        for page_id, url, html, sha1, last in pdf[["page_id", "url", "html", "sha1", "last"]].itertuples(index=False):
            if out is None:
                store.create_dir(base, recursive=True)
                name = f"{uuid.uuid4().hex}.warc.gz"
                out, engine, count, size = store.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(6, zlib.DEFLATED, GZIP), 0, 0
            payload = (html or "").encode("utf-8", "surrogatepass")
            data = record(page_id, url, payload, sha1, page_id == last, last)
            out.write(engine.compress(data))
            count, size = count + 1, size + len(data)
            if size >= file_bytes:
                yield closed()
                out = None
    if out is not None:
        yield closed()


def _normalised(batches, source: str, folder: str):
    """Rewrite whole-file streams record by record; one row per record, and an index beside each file."""
    store, base = _store(source)
    target, to = _store(folder)
    for pdf in batches:
        for name in pdf["file"]:
            target.create_dir(to, recursive=True)
            new, offset, index = f"{uuid.uuid4().hex}.warc.gz", 0, []
            with store.open_input_stream(f"{base}/{name}", compression=None) as stream, target.open_output_stream(f"{to}/{new}", compression=None) as out:
                for headers, data in records(inflated(stream)):
                    engine = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                    member = engine.compress(data + CRLF + CRLF) + engine.flush()
                    out.write(member)
                    index.append((new, offset, len(member), headers.get("warc-record-id"), headers.get("warc-type")))
                    offset += len(member)
            with target.open_output_stream(f"{to}/{new}.idx", compression=None) as out:
                for row in index:
                    out.write((json.dumps(dict(zip(("file", "offset", "length", "record_id", "type"), row))) + "\n").encode())
            yield pd.DataFrame(index, columns=["file", "offset", "length", "record_id", "type"])


def _read(batches, folder: str):
    """The records that index rows point to, each inflated by itself."""
    store, base = _store(folder)
    opened: tuple[str, object] | None = None
    for pdf in batches:
        out = []
        for name, offset, length in pdf.sort_values(["file", "offset"])[["file", "offset", "length"]].itertuples(index=False):
            if opened is None or opened[0] != name:
                if opened is not None:
                    opened[1].close()
                opened = (name, store.open_input_file(f"{base}/{name}"))
            data = zlib.decompress(opened[1].read_at(int(length), int(offset)), GZIP)
            headers, whole = next(records(iter([data])))
            start = whole.index(b"\r\n\r\n") + 4
            out.append((headers, whole[start:]))
        rows = []
        for headers, block in out:
            sha1 = headers["warc-payload-digest"].removeprefix("sha1:")
            if headers["warc-type"] == "response" and digest(block) != sha1:
                raise ValueError(f"{headers['warc-record-id']} differs from its digest")
            rows.append({
                "record_id": headers["warc-record-id"], "url": headers.get("warc-target-uri"), "record_type": headers["warc-type"],
                "payload_bytes": int(headers.get("payload-length", len(block))), "payload_digest": sha1,
                "refers_to": headers.get("warc-refers-to"), "payload": block if headers["warc-type"] == "response" else None,
            })
        yield pd.DataFrame(rows, columns=["record_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])
    if opened is not None:
        opened[1].close()


RECORDS = "record_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   file_bytes: int = FILE_BYTES, least_bytes: int = 0) -> DataFrame:
    """Write a record per page under ``folder``, as whole-file gzip streams. Returns the files.

    Of pages with equal payload of ``least_bytes`` at least, the one with the largest
    id is the response and the others revisit it. NULL html is an empty payload. A NULL id
    comes before all others; equal ids with equal payload are equal records.
    """
    spark = shipped(pages.sparkSession)
    own = pages.select(F.col(id_col).cast("long").cast("string").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    sums, sums_at = written_at(
        own.mapInPandas(_digested, "page_id string, url string, html string, payload_bytes long, sha1 string"), "digests")
    groups, groups_at = written_at(
        sums.where(F.col("payload_bytes") >= least_bytes).groupBy("sha1", "payload_bytes")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("page_id").cast("long")).cast("string").alias("last")).where("n > 1").drop("n"),
        "copies",
    )
    alone = F.col("last_of_group").isNull()
    # Payloads of which there is one copy are not shuffled: they revisit nothing.
    by = F.xxhash64("sha1", "payload_bytes")
    may, single = split_by_keys(sums, groups, by, by)
    names = ("page_id", "url", "html", "sha1", "last")
    marked = (
        may.join(groups.withColumnRenamed("last", "last_of_group").withColumn("grouped", F.lit(True)), ["sha1", "payload_bytes"], "left")
        .withColumn("last", F.when(F.col("grouped").isNull() | alone, F.col("page_id")).otherwise(F.col("last_of_group")))
        # A revisit is written without its payload.
        .select(*names)
        .unionByName(single.withColumn("last", F.col("page_id")).select(*names))
    )
    files, _ = written_at(marked.mapInPandas(functools.partial(_archived, folder=folder, file_bytes=file_bytes), "file string, records long"), "archives")
    removed(spark, sums_at, groups_at)
    return files


def normalise(files: DataFrame, source: str, folder: str) -> DataFrame:
    """Rewrite the ``files`` of ``source`` into ``folder``, a member per record. Returns the index."""
    spark = shipped(files.sparkSession)
    n = max(1, files.count())
    listed = files.select("file").distinct().repartitionByRange(min(n, 10_000), "file")
    index, _ = written_at(
        listed.mapInPandas(functools.partial(_normalised, source=source, folder=folder),
                           "file string, offset long, length long, record_id string, type string"),
        "index",
    )
    return index


def read_records(index: DataFrame, folder: str, partitions: int | None = None) -> DataFrame:
    """The records of an index, fetched one by one from the files of ``folder``."""
    shipped(index.sparkSession)
    if partitions:
        index = index.repartitionByRange(partitions, "file", "offset")
    return index.select("file", "offset", "length").mapInPandas(functools.partial(_read, folder=folder), RECORDS)


def round_trip(pages: DataFrame, id_col: str = "page_id", **columns) -> DataFrame:
    """Write, normalise and read back: ``id_col``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    * NULL html and empty html are equal payloads of 0 bytes, and take part as any others.
    * Rows with the same id and payload are all responses if theirs is the largest id.
    * A NULL id is the response only where no equal payload has an id.
    * An empty table writes no files and gives no rows; further columns are ignored.
    """
    spark: SparkSession = pages.sparkSession
    whole, split = work_dir(spark, "warc"), work_dir(spark, "warc-members")
    files = write_archives(pages, whole, id_col, **columns)
    index = normalise(files, whole, split)
    removed(spark, whole)
    number = lambda name: F.nullif(F.regexp_extract(name, r"<urn:page:(-?\d+)>", 1), F.lit("")).cast("long")
    return read_records(index, split).select(
        number("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
