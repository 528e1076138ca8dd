"""Shapefiles and GeoPackages inside zip archives, read from any store that Spark reads.

Archives are listed and fetched by Spark's ``binaryFile`` source, one row an
archive, whatever their number; members are inflated as streams.

* ``read_shapefiles``: a zip member can only be inflated from its start, so one
  pass an archive cuts it into chunks of at most ``CHUNK_BYTES`` of shapes with
  their offsets and their own attribute bytes.  Chunks are written, and decoding
  them, which is the work, is spread over all tasks; a task holds one chunk's
  attributes, never a whole ``.dbf``.
* ``import_geopackage``: copies one table of each GeoPackage to Parquet, once.
  The file is an SQLite database, which only its own library reads and which
  is not split, so an archive is one task there; boxes, filters and joins are
  DataFrame steps on the copy.

An archive must fit a binary value (2 GB).
"""

from __future__ import annotations

import io
import sqlite3
import struct
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.operators.skew import written

CHUNK_BYTES = 4 << 20
CHUNK_RECORDS = 20_000
_COPY_ROWS = 5_000

_CHUNKS = "archive string, first long, offsets binary, shapes binary, attributes binary, field_start int, field_width int, record_bytes int"


def archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """``path`` and ``content`` of each archive at a path: a file, a folder (with all below it) or a pattern."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
            .select("path", "content"))


def _member(zf: zipfile.ZipFile, prefix: str | None, ext: str) -> str:
    for m in zf.namelist():
        base = m.rsplit("/", 1)[-1]
        if base.lower().endswith(ext) and (prefix is None or base[: -len(ext)] == prefix):
            return m
    raise FileNotFoundError(f"no {ext} member{' for ' + prefix if prefix else ''}")


def _exactly(stream, n: int, what: str) -> bytes:
    data = stream.read(n)
    if len(data) != n:
        raise ValueError(f"{what} ends {n - len(data)} bytes early")
    return data


def _field(dbf, name: str | None) -> tuple[int, int, int]:
    """Start and width of a field in a record of a dBASE stream (the first field if none is named), and a record's
    length; the stream is left at the first record."""
    head = _exactly(dbf, 32, "the attribute table")
    header_bytes, record_bytes = struct.unpack("<HH", head[8:12])
    rest = _exactly(dbf, header_bytes - 32, "the attribute table")
    at = 1                                         # behind the deletion flag
    for i in range(0, len(rest) - 31, 32):
        if rest[i] == 0x0D:
            break
        label, width = rest[i:i + 11].split(b"\0")[0].decode("latin-1"), rest[i + 16]
        if name is None or label.lower() == name.lower():
            return at, width, record_bytes
        at += width
    raise ValueError(f"no attribute {name!r}")


def _chunks(archive: str, content: bytes, prefix: str | None, field: str | None) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        with (zf.open(_member(zf, prefix, ".shx")) as shx, zf.open(_member(zf, prefix, ".shp")) as shp, zf.open(_member(zf, prefix, ".dbf")) as dbf):
            _exactly(shx, 100, "the shape index")
            start, width, record_bytes = _field(dbf, field)
            at = len(_exactly(shp, 100, "the shapes"))
            first = 0
            entry = shx.read(8)
            while entry:
                offsets, began, end = [], None, at
                while entry and len(offsets) < CHUNK_RECORDS:
                    where, words = struct.unpack(">ii", entry)
                    where, until = 2 * where, 2 * where + 8 + 2 * words
                    if where < end:
                        raise ValueError(f"{archive}: shapes are not in the order of their index")
                    began = where if began is None else began
                    if offsets and until - began > CHUNK_BYTES:
                        break
                    offsets.append((where - began, 2 * words))
                    end, entry = until, shx.read(8)
                _exactly(shp, began - at, "the shapes")
                shapes = _exactly(shp, end - began, "the shapes")
                at = end
                yield (archive, first, struct.pack(f"<{2 * len(offsets)}q", *[v for o in offsets for v in o]), shapes,
                       _exactly(dbf, len(offsets) * record_bytes, "the attribute table"), start, width, record_bytes)
                first += len(offsets)


def polygon_wkt(content: bytes) -> str | None:
    """Polygon record content -> POLYGON WKT; other shape types or rings under 4 points -> None."""
    if len(content) < 44 or struct.unpack("<i", content[:4])[0] != 5:
        return None
    num_parts, num_points = struct.unpack("<ii", content[36:44])
    parts = list(struct.unpack(f"<{num_parts}i", content[44:44 + 4 * num_parts])) + [num_points]
    base = 44 + 4 * num_parts
    coords = struct.unpack(f"<{2 * num_points}d", content[base:base + 16 * num_points])
    rings = []
    for a, b in zip(parts[:-1], parts[1:]):
        if b - a < 4:
            return None
        rings.append("(" + ", ".join(f"{coords[2 * j]!r} {coords[2 * j + 1]!r}" for j in range(a, b)) + ")")
    return f"POLYGON ({', '.join(rings)})" if rings else None


def read_shapefiles(spark: SparkSession, path: str, prefix: str | None = None, field: str | None = None) -> DataFrame:
    """The polygons of every zipped shapefile at ``path``, see ``shapes_in``."""
    return shapes_in(archives(spark, path), prefix, field)


def shapes_in(zipped: DataFrame, prefix: str | None = None, field: str | None = None) -> DataFrame:
    """``archive, record, attribute, wkt`` of the polygons in archives (``path`` and ``content``).

    ``prefix`` names the shapefile in an archive (else the first), ``field`` the attribute (else the first one), which
    comes as trimmed text.  Shapes that are no polygons, and rings of fewer than four points, have no wkt."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _CHUNKS.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
        for batch in batches:
            for archive, content in zip(batch.column("path"), batch.column("content")):
                for chunk in _chunks(archive.as_py(), content.as_py(), prefix, field):
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(chunk, kinds)], names)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                where = struct.unpack(f"<{len(c['offsets']) // 8}q", c["offsets"])
                texts, shapes = [], []
                for r, (at, n) in enumerate(zip(where[::2], where[1::2])):
                    begin = r * c["record_bytes"] + c["field_start"]
                    texts.append(c["attributes"][begin:begin + c["field_width"]].decode("latin-1").strip())
                    shapes.append(polygon_wkt(c["shapes"][at + 8:at + 8 + n]))          # behind the record's header
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c["archive"]] * len(texts)), pa.array(range(c["first"], c["first"] + len(texts)), pa.int64()),
                     pa.array(texts, pa.string()), pa.array(shapes, pa.string())], ["archive", "record", "attribute", "wkt"])

    chunks = written(zipped.select("path", "content").mapInArrow(cut, _CHUNKS), "shapes")
    return chunks.repartition("archive", "first").mapInArrow(decode, "archive string, record long, attribute string, wkt string")


def building_footprints(spark: SparkSession, path: str, prefix: str | None = None) -> DataFrame:
    """``height`` (the first attribute; NULL if it is no number) and ``wkt``."""
    return read_shapefiles(spark, path, prefix).select(F.col("attribute").try_cast("double").alias("height"), "wkt")


def import_geopackage(spark: SparkSession, path: str, table: str, schema: str, out: str, member: str | None = None) -> DataFrame:
    """Copy a table of every zipped GeoPackage at ``path`` to Parquet at ``out``; ``schema`` names its columns.

    S8, the box, is a filter on the copy."""
    wanted = spark.createDataFrame([], schema).schema

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(wanted)
        for batch in batches:
            for content in batch.column("content"):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as zf:
                    data = zf.read(member or next(m for m in zf.namelist() if m.lower().endswith(".gpkg")))
                con = sqlite3.connect(":memory:")
                try:
                    con.deserialize(data)
                    rows = con.execute(f"SELECT {', '.join(chr(34) + n + chr(34) for n in kinds.names)} FROM \"{table}\"")
                    while some := rows.fetchmany(_COPY_ROWS):
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds.types)], kinds.names)
                finally:
                    con.close()

    archives(spark, path).mapInArrow(copy, wanted).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)
