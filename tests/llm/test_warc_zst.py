import hashlib
import random
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from towerlens.llm import queries, warc_zst

SCHEMA = "page_id long, url string, html string"


def expected(rows, least=1000):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = max(same, default=None)
        again = len(data) >= least and page != first
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def pages():
    rng = random.Random(2)
    body = "".join(f"<p>{rng.choice('abcdefgh') * rng.randint(1, 9)}</p>" for _ in range(300))
    rows = [(i, f"http://example.com/{i}", f"<html>{i}{body[:rng.randint(0, 3000)]}</html>") for i in range(300)]
    rows += [(1000 + i, f"http://copy.example.com/{i}", body) for i in range(200)]                 # a hot payload
    rows += [(2000, "u", None), (2001, None, ""), (2002, "u", "x" * 999), (2003, "u", "x" * 999), (2004, "u", "y" * 1000), (2005, "u", "y" * 1000),
             (2006, "é a\r\nX: 1", "é" * 499), (2007, "u", "é" * 500), (2008, "u", "é" * 500), (None, "u", "y" * 1000), (None, "v", "z" * 1000),
             (None, "v", "z" * 1000), (2009, "u", "\r\n\r\nWARC/1.1\r\n" * 100), (2010, "u", "w" * 3_000_000), (2011, "u", "w" * 3_000_000),
             (2012, "a", "twice" * 300), (2012, "b", "twice" * 300), (2001, "other", "not the same")]
    rng.shuffle(rows)
    return rows


def test_round_trip_of_pages(spark, tmp_path):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("payload", F.lit("x")).withColumn("key", F.lit(1)).withColumn("image", F.lit(1)).repartition(4)
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op13_warc_zst(spark, str(tmp_path))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)


def test_same_answer_when_repeats_are_joined_by_a_shuffle(spark, monkeypatch):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    monkeypatch.setattr("towerlens.llm.frames.BROADCAST_BYTES", 0)
    found = warc_zst.archived(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)


def test_payloads_and_other_readers(spark, tmp_path):
    """Archives are plain files to other readers: the dictionary leads, and any frame decodes alone."""
    rows = pages()
    warc_zst.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(2), f"{tmp_path}/images")
    images = [bytes(r["image"]) for r in spark.read.parquet(f"{tmp_path}/images").collect()]
    for i, data in enumerate(images):
        (tmp_path / "files").mkdir(exist_ok=True)
        (tmp_path / "files" / f"{i}.warc.zst").write_bytes(data)
        magic, n = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D
        words = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:8 + n]))
        offsets = [at for at, _ in warc_zst.read_archive(data)]
        for at, end in list(zip(offsets, [*offsets[1:], len(data)]))[::37]:
            assert zstandard.ZstdDecompressor(dict_data=words).decompress(data[at:end]).startswith(b"WARC/1.1\r\nWARC-Type: ")
    files = spark.read.format("binaryFile").load(f"{tmp_path}/files/*.warc.zst")
    back = warc_zst.read_archives(files, image="content", with_payload=True).where("record_type = 'response'").collect()
    texts = {}
    for p, _, h in rows:
        texts.setdefault(p, set()).add((h or "").encode())
    assert all(bytes(r["payload"]) in texts[r["page_id"]] for r in back)
    assert sorted({r["target_uri"] for r in back if r["page_id"] == 2006}) == ["%C3%A9%20a%0D%0AX:%201"]


def record(**change):
    whole = warc_zst.build_record(7, "http://example.com/", b"some payload", None, False)
    for old, new in change.get("swap", []):
        assert old in whole
        whole = whole.replace(old, new)
    return whole


@pytest.mark.parametrize("swap,problem", [
    ([(b"WARC/1.1", b"WARC/9.1")], "version line"),
    ([(b"WARC-Date: 1970-01-01T00:00:00Z\r\n", b"")], "no warc-date"),
    ([(b"WARC-Type: response", b"WARC-Type response")], "header line"),
    ([(b"WARC-Type: response\r\n", b"WARC-Type: response\r\nwarc-type: revisit\r\n")], "twice"),
    ([(b"some payload", b"some payloads")], "bytes in a block"),
    ([(b"some payload", b"same payload")], "digest"),
    ([(b"charset=utf-8\r\nContent-Length: 12", b"charset=utf-8\r\nContent-Length: 11")], "bytes in a payload of 11"),
    ([(b"HTTP/1.1", b"HTTQ/1.1")], "HTTP head"),
    ([(b"payload\r\n\r\n", b"payload\r\n\r\x0b")], "line ends"),
    ([(b"urn:x-page:", b"urn:x-pagf:")], "not one of a page"),
    ([(b"sha1:", b"md55:")], "payload digest"),
])
def test_records_that_break_the_format(swap, problem):
    warc_zst.read_page(record())
    with pytest.raises(warc_zst.BadRecord, match=problem):
        warc_zst.read_page(record(swap=swap))


def test_damaged_archives_are_reported_and_their_other_records_read(spark):
    packer = zstandard.ZstdCompressor(write_checksum=True)
    frames = [packer.compress(warc_zst.build_record(i, None, b"payload %d" % i * 50, None, False)) for i in range(4)]
    skipped = struct.pack("<II", 0x184D2A53, 3) + b"any"
    streamed = zstandard.ZstdCompressor().compressobj().compress(b"") + b""
    obj = zstandard.ZstdCompressor(write_content_size=False).compressobj()
    streamed = obj.compress(warc_zst.build_record(9, None, b"by a stream", None, False)) + obj.flush()
    broken = bytearray(frames[1])
    broken[-1] ^= 1                                                # the checksum
    images = [(1, frames[0] + bytes(broken) + skipped + frames[2] + streamed), (2, frames[3][:-6]), (3, b""), (4, b"not a frame at all"),
              (5, warc_zst.dictionary_frame(b"no dictionary") + frames[0]), (6, frames[0] + b"xy")]
    df = spark.createDataFrame([(n, bytearray(d)) for n, d in images], "n int, image binary")
    got = warc_zst.read_archives(df, strict=False).collect()
    assert sorted(r["page_id"] for r in got if r["problem"] is None) == [0, 0, 2, 9]
    told = " | ".join(sorted(r["problem"] for r in got if r["problem"]))
    assert told.count("|") == 4 and "does not decode" in told and "cut off" in told and "no frame" in told and "no dictionary" in told and "2 bytes where" in told
    with pytest.raises(Exception, match="does not decode"):
        warc_zst.read_archives(df.where("n = 1")).collect()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    assert queries.op13_warc_zst(spark, str(tmp_path)).collect() == []
