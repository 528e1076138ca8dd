"""Web archives of records compressed one by one with a shared Zstandard dictionary.

An archive is the public ``.warc.zst`` form: a skippable frame whose content is
the dictionary (itself compressed or not), then one Zstandard frame a record.
Each frame decodes alone, so a record is read at its offset without what lies
before it.  Frames are found by their block headers; nothing is decoded to
find the next one.

``write_archives`` trains one dictionary on a bounded sample, decides which
records repeat a payload, and writes archive images as rows of a Parquet
dataset ``(shard, file_no, image)``: Spark's commit protocol writes them, so a
retried task leaves no half-written archive, and any store that Spark writes to
will do.  ``read_archives`` takes any frame with a binary column of archives,
that dataset or Spark's ``binaryFile`` source, and gives one row a record.

A reader checks each record: version line, header syntax, the named fields that
every record needs, no field twice, ``Content-Length`` against the block, the
closing line ends, the HTTP head of responses and revisits, its
``Content-Length`` and the payload digest against the payload.  What is wrong
is an error, or with ``strict=False`` a row with ``problem`` set.

Of records with equal payloads of at least ``least`` bytes, the one with the
largest id is a response and the others are revisits that name it; a revisit
holds no payload, but its HTTP head keeps the payload's length and its header
the digest.  Equality is by SHA-256 of the payload.

Defined cases: null html is an empty payload; a null url leaves the target out;
rows that share the largest id and the payload are all responses; a null id
counts as smaller than any id (if all ids of equal payloads are null, all are
responses); an empty table gives no archive and no row; further columns are not
read.  A record's text is held whole in its task, four times at most.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import joined_small, map_texts, shared_folder, stored

LEAST_BYTES = 1000             # payloads below are never revisits
SAMPLE_RECORDS = 400           # of which the dictionary is trained ...
SAMPLE_BYTES = 8 << 10         # ... on so much of each (the dictionary changes sizes, not results)
DICTIONARY_BYTES = 64 << 10
IMAGE_BYTES = 8 << 20          # an archive is closed once it is this long
SALTS = 16

#: fixed values of the formats
_DICTIONARY_FRAME = 0x184D2A5D
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_FRAME = 0xFD2FB528
_DICTIONARY = 0xEC30A437
_VERSIONS = (b"WARC/1.0", b"WARC/1.1")
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")
_DATE = "1970-01-01T00:00:00Z"
_ID = "urn:x-page:"

IMAGES = "shard long, file_no int, n_records long, image binary"
RECORDS = ("record_type string, page_id long, target_uri string, refers_to long, payload_bytes long, payload_digest string, "
           "offset long, problem string")


class BadRecord(ValueError):
    """A record or archive that breaks its format."""


# --- records ---------------------------------------------------------------

def _target(url: str | None) -> str | None:
    """A url that fits into a header line: spaces, control and non-ASCII characters as percent codes."""
    return None if url is None else urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~")


def _name(page_id: int | None) -> str:
    return f"<{_ID}{'' if page_id is None else page_id}>"


def _number(name: str) -> int | None:
    if not (name.startswith(f"<{_ID}") and name.endswith(">")):
        raise BadRecord(f"record id {name!r} is not one of a page")
    digits = name[len(_ID) + 1:-1]
    return int(digits) if digits else None


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", _DATE),
              ("WARC-Target-URI", _target(url)), ("WARC-Payload-Digest", digest),
              ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    if revisit:
        fields += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", _name(refers_to))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Named fields by lower-case name; a line that begins with white space continues the one before."""
    out: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in (b" ", b"\t"):
            if last is None:
                raise BadRecord("a continuation before any field")
            out[last] += " " + line.decode().strip()
            continue
        name, colon, value = line.partition(b":")
        last = name.decode("ascii", "replace").lower()
        if not colon or not last or last != last.strip() or "�" in last:
            raise BadRecord(f"header line {line[:60]!r}")
        if last in out:
            raise BadRecord(f"field {last} twice")
        out[last] = value.decode().strip()
    return out


def _length(fields: dict[str, str], name: str = "content-length") -> int:
    value = fields.get(name, "")
    if not (value.isascii() and value.isdigit()):
        raise BadRecord(f"{name} {value!r}")
    return int(value)


def _sha1_hex(declared: str) -> str:
    kind, _, value = declared.partition(":")
    if kind.lower() == "sha1" and len(value) == 32:
        try:
            return base64.b32decode(value.upper()).hex()
        except ValueError:
            pass
    if kind.lower() == "sha1" and len(value) == 40:
        return value.lower()
    raise BadRecord(f"payload digest {declared!r}")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields and block of one record, which must be all there is."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise BadRecord("the header has no end")
    version, *lines = data[:end].split(b"\r\n")
    if version not in _VERSIONS:
        raise BadRecord(f"version line {version[:20]!r}")
    try:
        fields = _fields(lines)
    except UnicodeDecodeError:
        raise BadRecord("a header that is not UTF-8") from None
    missing = [n for n in _NEEDED if not fields.get(n)]
    if missing:
        raise BadRecord(f"no {', '.join(missing)}")
    at = end + 4
    n = _length(fields)
    if len(data) != at + n + 4:
        raise BadRecord(f"{len(data) - at - 4} bytes in a block of {n}")
    if data[at + n:] != b"\r\n\r\n":
        raise BadRecord("the record does not end with two line ends")
    return fields, data[at:at + n]


def read_page(data: bytes) -> tuple[str, int | None, str | None, int | None, int, str, bytes]:
    """Type, page id, target, page referred to, full length of the payload, its digest, and the payload as held."""
    fields, block = parse_record(data)
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return kind, None, fields.get("warc-target-uri"), None, len(block), hashlib.sha1(block).hexdigest(), block
    end = block.find(b"\r\n\r\n")
    status, *lines = block[:max(end, 0)].split(b"\r\n")
    if end < 0 or not status.startswith(b"HTTP/"):
        raise BadRecord("the block has no HTTP head")
    n, payload = _length(_fields(lines)), block[end + 4:]
    digest = _sha1_hex(fields.get("warc-payload-digest", ""))
    refers = None
    if kind == "response":
        if len(payload) != n:
            raise BadRecord(f"{len(payload)} bytes in a payload of {n}")
        if hashlib.sha1(payload).hexdigest() != digest:
            raise BadRecord("the payload is not what its digest says")
    else:
        if payload:
            raise BadRecord("a revisit that holds a payload")
        if fields.get("warc-profile") != _REVISIT:
            raise BadRecord(f"revisit profile {fields.get('warc-profile')!r}")
        refers = _number(fields.get("warc-refers-to", ""))
    return kind, _number(fields["warc-record-id"]), fields.get("warc-target-uri"), refers, n, digest, payload


# --- frames ----------------------------------------------------------------

def dictionary_frame(dictionary: bytes) -> bytes:
    """The skippable frame that opens an archive; the dictionary in it is compressed."""
    packed = zstandard.ZstdCompressor(level=9).compress(dictionary)
    return struct.pack("<II", _DICTIONARY_FRAME, len(packed)) + packed


def _magic(data: memoryview, at: int) -> int:
    if at + 4 > len(data):
        raise BadRecord(f"{len(data) - at} bytes where a frame should begin")
    return int.from_bytes(data[at:at + 4], "little")


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, from its block headers."""
    if _magic(data, at) in _SKIPPABLE:
        end = at + 8 + int.from_bytes(data[at + 4:at + 8], "little")
    else:
        try:
            head = bytes(data[at:at + 18])
            checksum = zstandard.get_frame_parameters(head).has_checksum
            end = at + zstandard.frame_header_size(head)
        except zstandard.ZstdError as e:
            raise BadRecord(f"no frame at {at}: {e}") from None
        last = False
        while not last:
            block = int.from_bytes(data[end:end + 3], "little")
            if end + 3 > len(data):
                raise BadRecord(f"the frame at {at} is cut off")
            last, kind = block & 1, block >> 1 & 3
            end += 3 + (1 if kind == 1 else block >> 3)      # one byte stands for a run
        end += 4 * checksum
    if end > len(data):
        raise BadRecord(f"the frame at {at} is cut off")
    return end


def read_dictionary(data: memoryview) -> tuple[bytes | None, int]:
    """Dictionary of an archive (none if it does not begin with one) and where its records begin."""
    if not len(data) or _magic(data, 0) != _DICTIONARY_FRAME:
        return None, 0
    end = frame_end(data, 0)
    content = bytes(data[8:end])
    magic = int.from_bytes(content[:4], "little")
    if magic == _FRAME:
        try:
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        except zstandard.ZstdError as e:
            raise BadRecord(f"the dictionary does not decode: {e}") from None
        magic = int.from_bytes(content[:4], "little")
    if magic != _DICTIONARY:
        raise BadRecord("the leading frame holds no dictionary")
    return content, end


def read_archive(data: bytes) -> Iterator[tuple[int, bytes | BadRecord]]:
    """Offset and bytes of each record, frame by frame; a frame that does not decode gives its error.

    An archive whose frames can't be told apart any more ends with one error."""
    view = memoryview(data)
    try:
        dictionary, at = read_dictionary(view)
    except BadRecord as e:
        yield 0, e
        return
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    while at < len(view):
        try:
            end = frame_end(view, at)
        except BadRecord as e:
            yield at, e
            return
        if _magic(view, at) not in _SKIPPABLE:
            try:
                one = reader.decompressobj()
                text = one.decompress(view[at:end])
                yield at, text if one.eof else BadRecord("a frame without its end")
            except zstandard.ZstdError as e:
                yield at, BadRecord(f"a frame that does not decode: {e}")
        at = end


# --- jobs ------------------------------------------------------------------

def train_dictionary(pages: DataFrame) -> bytes | None:
    """A dictionary from at most SAMPLE_RECORDS payloads, SAMPLE_BYTES of each; none if they are too few to train on.

    Some twice as many rows as needed pass a test on their hash, whatever the size of the table, and the limit takes
    them from the first partitions, so little more than the sample reaches the driver."""
    thin = max(1, pages.count() // (2 * SAMPLE_RECORDS))
    some = (pages.where(F.pmod(F.xxhash64("page_id", "url"), F.lit(thin)) == 0).limit(SAMPLE_RECORDS)
            .select("page_id", "url", F.substring("payload", 1, SAMPLE_BYTES).alias("payload")).collect())
    samples = [build_record(r["page_id"], r["url"], bytes(r["payload"]), None, False) for r in some]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return None


def _payloads(df: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                     F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary").alias("payload"))


def with_revisits(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Add ``revisit`` and ``refers_to``.  Only payload digests and ids are shuffled; what repeats is broadcast if its
    files are small, else joined with hot digests spread over SALTS tasks."""
    keyed = pages.withColumn("key", F.when(F.length("payload") >= least, F.sha2("payload", 256)))
    repeats = stored(keyed.where(F.col("key").isNotNull()).groupBy("key").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                     .where(F.col("n") > 1).select("key", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")), "repeats")
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    found = joined_small(salted, repeats, ["key", "salt"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return found.select("page_id", "url", "payload", again.alias("revisit"), F.when(again, F.col("first")).alias("refers_to"))


def write_archives(df: DataFrame, path: str, least: int = LEAST_BYTES, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", level: int = 3) -> None:
    """One record a row, in archives below ``path``."""
    pages = _payloads(df, id_col, url_col, html_col)
    dictionary = train_dictionary(pages)

    def images(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True)
        opening = dictionary_frame(dictionary) if dictionary else b""
        shard, file_no, frames, held = TaskContext.get().partitionId(), 0, [], 0

        def image() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([file_no], pa.int32()), pa.array([len(frames)], pa.int64()),
                 pa.array([opening + b"".join(frames)], pa.binary())], ["shard", "file_no", "n_records", "image"])

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, revisit, refers = (batch.column(c)[i].as_py() for c in ("page_id", "url", "payload", "revisit", "refers_to"))
                frames.append(packer.compress(build_record(page_id, url, payload, refers, revisit)))
                held += len(frames[-1])
                if held >= IMAGE_BYTES:
                    yield image()
                    file_no, frames, held = file_no + 1, [], 0
        if frames:
            yield image()

    with_revisits(pages, least).transform(map_texts, images, IMAGES).write.mode("overwrite").option("compression", "uncompressed").parquet(path)


def read_archives(archives: DataFrame, image: str = "image", strict: bool = True, with_payload: bool = False) -> DataFrame:
    """One row for each record of each archive in the binary column ``image``."""
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*(f.split()[0] for f in RECORDS.split(", ")), "payload"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        if not with_payload:
            names, kinds = names[:-1], kinds[:-1]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                rows, held = [], 0
                for at, data in read_archive(batch.column(0)[i].as_py() or b""):
                    try:
                        if isinstance(data, BadRecord):
                            raise data
                        kind, page, target, refers, n, digest, payload = read_page(data)
                        rows.append((kind, page, target, refers, n, digest, at, None, payload)[:len(names)])
                    except BadRecord as e:
                        if strict:
                            raise
                        rows.append((None, None, None, None, None, None, at, str(e), None)[:len(names)])
                    held += len(data) if with_payload and isinstance(data, bytes) else 0
                    if len(rows) >= 1000 or held >= IMAGE_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return archives.select(F.col(image)).transform(map_texts, records, RECORDS + ", payload binary" * with_payload)


def archived(df: DataFrame, least: int = LEAST_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    path = shared_folder(df.sparkSession, "warc")
    write_archives(df, path, least, id_col, url_col, html_col)
    return read_archives(df.sparkSession.read.schema(IMAGES).parquet(path))
