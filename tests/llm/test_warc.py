import base64
import hashlib

import pytest
import zstandard

from tallyline.llm import warc
from tallyline.llm.scratch import folder

PAGES = [
    (1, "http://a", "<p>same</p>"), (2, "http://b", "<p>same</p>"), (3, "http://c\r\nx: y", "<p>same</p>"),
    (4, None, None), (5, "http://e", ""), (6, "http://f", "é\r\n\r\n" * 50), (7, "http://g", "<p>other</p>"),
    (7, "http://g", "<p>other</p>"), (None, "http://h", "<p>same</p>"), (8, "http://i", "x" * 200_000),
    *[(k, f"http://n/{k}", f"<html><body><p>page {k} of many</p><p>{k * 7919}</p></body></html>") for k in range(20, 220)],
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "r", 1) for p in PAGES], "page_id long, url string, html string, payload string, frame int")


def want(least):
    out = []
    for i, _, h in PAGES:
        b = (h or "").encode()
        same = [p for p, _, x in PAGES if (x or "").encode() == b]
        top = max((p for p in same if p is not None), default=None)
        again = len(b) >= least and len(same) > 1 and top is not None and i != top
        out.append((-1 if i is None else i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", top if again else -1))
    return sorted(out)


@pytest.mark.parametrize("least", [0, 5])
def test_records_come_back(spark, pages, least):
    path = folder(spark)
    dictionary = warc.train(pages, "html")
    assert dictionary
    warc.write(pages.repartition(3), path, dictionary, least=least)
    rows = warc.read(spark, path).collect()
    assert sorted((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type,
                   -1 if r.refers_to is None else r.refers_to) for r in rows) == want(least)
    texts = {(i, (h or "").encode()) for i, _, h in PAGES}
    assert all((r.page_id, bytes(r.payload)) in texts for r in rows if r.record_type == "response")


def test_archive_starts_with_its_dictionary_and_records_open_alone(spark, pages):
    path = folder(spark)
    dictionary = warc.train(pages, "html")
    warc.write(pages.coalesce(1), path, dictionary)
    (blob,) = [bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect() if r.length]
    assert blob[:4] == warc.DICTIONARY_MAGIC
    size = int.from_bytes(blob[4:8], "little")
    assert blob[8:8 + size] == dictionary
    opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(blob[8:8 + size]))
    first = opener.decompressobj().decompress(blob[8 + size + len(warc.EMPTY_FRAME):])
    assert first.startswith(b"WARC/1.1\r\n")
    assert len(list(warc.frames(blob))) == len(PAGES)


def test_without_dictionary_and_empty_table(spark, pages):
    path = folder(spark)
    few = pages.where("page_id < 6")
    warc.write(few, path, warc.train(few.limit(0), "html"))
    assert warc.read(spark, path).count() == 5
    empty = folder(spark)
    warc.write(pages.limit(0), empty, b"")
    assert warc.read(spark, empty).count() == 0


def test_archives_roll_and_each_has_the_dictionary(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "LINE_BYTES", 400)
    monkeypatch.setattr(warc, "LINES", 5)
    path = folder(spark)
    dictionary = warc.train(pages, "html")
    warc.write(pages.coalesce(2), path, dictionary)
    blobs = [bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    assert len(blobs) > 6 and all(b.startswith(warc.DICTIONARY_MAGIC) for b in blobs)
    assert sum(len(list(warc.frames(b))) for b in blobs) == len(PAGES)
    assert max(len(b) - len(dictionary) for b in blobs) < 5 * (400 + 20_000)
    rows = warc.read(spark, path).collect()
    assert sorted((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type,
                   -1 if r.refers_to is None else r.refers_to) for r in rows) == want(0)


def test_a_payload_that_most_pages_hold_is_one_row_of_the_sample(spark):
    rows = [(i, f"<p>{i}</p>" if i % 3 else "<p>held by a third</p>") for i in range(3_000)]
    df = spark.createDataFrame(rows, "page_id long, html string")
    for size in (200, 500):
        seen = []
        train = zstandard.train_dictionary
        try:
            zstandard.train_dictionary = lambda n, texts, seen=seen: (seen.append(len(texts)), train(n, texts))[1]
            warc.train(df, "html", sample_rows=size)
        finally:
            zstandard.train_dictionary = train
        assert 0 < seen[0] < 2 * size


def test_query_on_a_folder(spark, pages, tmp_path):
    from tallyline.llm.queries import QUERIES

    pages.write.parquet(f"{tmp_path}/pages.parquet")
    df = QUERIES["op8_warc"](spark, str(tmp_path))
    assert dict(df.dtypes) == {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string",
                               "refers_to": "bigint"}
    assert sorted((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type,
                   -1 if r.refers_to is None else r.refers_to) for r in df.collect()) == want(0)
