"""WARC archives compressed record by record with a shared Zstandard dictionary.

A dictionary is trained on a bounded sample of records. Every archive opens with a skippable frame that
embeds it, then holds one frame a record, so that any record can be decompressed alone. Archives are
written by Spark's text writer, with the bytes of some frames, about ``LINE_BYTES``, as a line; the line separator is
itself a valid empty skippable frame. What lands on storage is therefore a plain ``.warc.zst`` stream,
on any file system that Spark writes to, with its commit and retry rules. After ``LINES`` lines a task begins
a new archive, so their size does not grow with the table.

A record whose payload another record holds with a larger page id is written as a revisit.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.registry import query, table
from tallyline.llm.scratch import folder, sampled

#: Fixed values of the format: the skippable frame of the dictionary, and the empty one between records.
DICTIONARY_MAGIC = (0x184D2A5D).to_bytes(4, "little")
EMPTY_FRAME = (0x184D2A50).to_bytes(4, "little") + bytes(4)
ZSTD_MAGIC = (0xFD2FB528).to_bytes(4, "little")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SAMPLE_ROWS = 1_000
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
LINES = 64
LINE_BYTES = 1 << 20
SALTS = 32


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload if kind == "response" else b"")
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {(url or '').encode('unicode_escape').decode()}", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}", f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Refers-To-Page-ID: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(pages: DataFrame, payload: str, sample_rows: int = SAMPLE_ROWS) -> bytes:
    """A dictionary from about ``sample_rows`` different payloads, ``SAMPLE_BYTES`` of them; empty if there are too few."""
    chosen = sampled(pages.select(F.col(payload).alias("p")).where("length(p) > 0"), ["p"], sample_rows)
    starts = chosen.select(F.substring("p", 1, SAMPLE_BYTES // sample_rows).alias("t"))
    texts = sorted(r.t.encode() for r in starts.distinct().collect())  # copies of a payload are in or out together: one row
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples to train on
        return b""


def verdicts(pages: DataFrame, page_id: str, payload: Column, least: int) -> DataFrame:
    """(page_id, digest) rows with ``_first``: the largest page id of each payload held twice or more."""
    digest = F.unhex(F.sha1(payload))
    narrow = pages.select(F.col(page_id).alias("_page"), digest.alias("_digest"), F.length(payload).alias("_size"))
    twice = (narrow.where(F.col("_size") >= least).groupBy("_digest")
             .agg(F.count("*").alias("_n"), F.max("_page").alias("_first")).where("_n > 1"))
    salted = twice.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).drop("_n")
    return (narrow.select("_page", "_digest").distinct()
            .withColumn("_salt", F.pmod(F.xxhash64("_page"), F.lit(SALTS)).cast("int"))
            .join(salted, ["_digest", "_salt"]).where("_page is null or _page < _first")
            .select("_page", "_digest", "_first"))


def write(pages: DataFrame, path: str, dictionary: bytes, least: int = 0, page_id: str = "page_id", url: str = "url",
          html: str = "html", level: int = LEVEL) -> None:
    """Write one record a row of ``pages`` below ``path``.

    A null text is an empty payload. Of equal payloads of at least ``least`` bytes the one with the
    largest page id is the response and the others revisit it; a null page id is smaller than any, and
    rows that tie for the largest are all responses. An empty table writes no record.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    again = verdicts(pages, page_id, payload, least)
    rows = pages.select(F.col(page_id).cast("long").alias("_page"), F.col(url).cast("string").alias("_url"), payload.alias("_payload"))
    rows = rows.withColumn("_digest", F.unhex(F.sha1("_payload")))
    again = again.select(F.col("_page").alias("_p"), F.col("_digest").alias("_d"), F.col("_first").alias("_to"))
    joined = rows.join(again, F.col("_page").eqNullSafe(F.col("_p")) & (F.col("_digest") == F.col("_d")), "left")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=level, dict_data=made, write_content_size=True)
        opener = [DICTIONARY_MAGIC + len(dictionary).to_bytes(4, "little") + dictionary] if dictionary else []
        lines, held, size = 0, [], 0

        def line() -> pa.RecordBatch:
            first = opener if lines % LINES == 0 else []
            return pa.RecordBatch.from_arrays([pa.array([EMPTY_FRAME.join([*first, *held])], pa.binary())], names=["line"])

        for batch in batches:
            for p, u, b, to in zip(*(batch.column(c).to_pylist() for c in ("_page", "_url", "_payload", "_to")), strict=True):
                frame = press.compress(_record(p, u, b, "response" if to is None else "revisit", to))
                if held and size + len(frame) > LINE_BYTES:
                    yield line()
                    lines, held, size = lines + 1, [], 0
                held.append(frame)
                size += len(frame)
        if held:
            yield line()

    (joined.mapInArrow(pack, "line binary").select(F.col("line").cast("string").alias("value"))
     .write.options(lineSep=EMPTY_FRAME.decode("ascii"), maxRecordsPerFile=LINES).text(path))


def frames(blob: bytes) -> Iterator[bytes]:
    """Decompressed records of one archive."""
    at, opener = 0, zstandard.ZstdDecompressor()
    while at < len(blob):
        magic = blob[at:at + 4]
        if 0x184D2A50 <= int.from_bytes(magic, "little") <= 0x184D2A5F:
            size = int.from_bytes(blob[at + 4:at + 8], "little")
            if magic == DICTIONARY_MAGIC:
                opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(blob[at + 8:at + 8 + size]))
            at += 8 + size
            continue
        if magic != ZSTD_MAGIC:
            raise ValueError(f"no frame at byte {at}")
        one = opener.decompressobj()
        yield one.decompress(memoryview(blob)[at:])
        at = len(blob) - len(one.unused_data)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of every record below ``path``.

    Archives are read whole, one at a time; none is longer than ``LINES`` lines. Payloads are
    always checked against their digests; ``payloads=False`` leaves them null in the result.
    """
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                rows, held = [], 0
                for record in frames(blob.as_buffer().to_pybytes()):
                    f, payload = parse(record)
                    response = f["WARC-Type"] == "response"
                    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                    if response and (len(payload) != int(f["WARC-Payload-Length"])
                                     or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError("a payload differs from its digest")
                    to = f.get("WARC-Refers-To-Page-ID")
                    rows.append((int(f["WARC-Page-ID"]) if f["WARC-Page-ID"] else None, f["WARC-Target-URI"], f["WARC-Type"],
                                 int(to) if to else None, int(f["WARC-Payload-Length"]), digest, payload if response and payloads else None))
                    held += len(payload)
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return found.mapInArrow(unpack, "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
                                    "payload_digest string, payload binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    names = ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


@query("op8_warc")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = folder(spark)
    write(pages, path, train(pages, "html"))
    return read(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

