"""Zipped shapefiles and GeoPackages: several archives in one read, bounded chunks, damaged files."""

import os
import sqlite3
import tempfile
import zipfile

import pytest

from towerlens.plans.fixtures import shapefile_zip
from towerlens.sources import archives as A

SQUARE = [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]]
HOLED = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]]
TINY = [[(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]]


def folder(**files):
    d = tempfile.mkdtemp(prefix="tl-zip-")
    for name, data in files.items():
        os.makedirs(os.path.dirname(os.path.join(d, name)) or d, exist_ok=True)
        with open(os.path.join(d, f"{name}.zip"), "wb") as f:
            f.write(data)
    return d


def test_shapes_and_attributes(spark):
    d = folder(a=shapefile_zip(["12.5", "x", "", "7"] * 5, [SQUARE, HOLED, TINY, None] * 5))
    rows = A.building_footprints(spark, d, "bldg_footprints").collect()
    assert len(rows) == 20
    by = {(r["height"], r["wkt"]) for r in rows}
    assert (12.5, "POLYGON ((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 1.0, 0.0 0.0))") in by and (7.0, None) in by and (None, None) in by
    assert any(h is None and w and w.count("(") == 3 for h, w in by)


def test_several_archives_in_chunks_of_bounded_bytes(spark, monkeypatch):
    """Records keep their order and archive; no chunk holds more than the bound, in shapes or in attributes."""
    monkeypatch.setattr(A, "CHUNK_BYTES", 700)
    monkeypatch.setattr(A, "CHUNK_RECORDS", 4)
    square = [[[(x + i, y) for x, y in r] for r in SQUARE] for i in range(50)]
    d = folder(**{"a": shapefile_zip([str(i) for i in range(50)], square), "deep/b": shapefile_zip([f"b{i}" for i in range(9)], [HOLED] * 9),
                  "empty": shapefile_zip([], [])})
    chunks = [c for path in (f"{d}/a.zip", f"{d}/deep/b.zip") for c in A._chunks(path, open(path, "rb").read(), None, None)]
    assert max(len(c[3]) for c in chunks) <= 700 and max(len(c[4]) for c in chunks) <= 4 * 13 and len(chunks) > 15
    got = A.read_shapefiles(spark, d).collect()
    a = sorted((r["record"], r["attribute"], r["wkt"]) for r in got if r["archive"].endswith("a.zip"))
    assert [(r, t) for r, t, _ in a] == [(i, str(i)) for i in range(50)] and a[7][2].startswith("POLYGON ((7.0 0.0, 8.0 0.0")
    assert sorted(r["attribute"] for r in got if r["archive"].endswith("b.zip")) == [f"b{i}" for i in range(9)] and len(got) == 59


def test_named_field_and_wrong_names(spark):
    d = folder(a=shapefile_zip(["1"], [SQUARE], name="one"))
    assert A.read_shapefiles(spark, d, "one", "Height").first()["attribute"] == "1"
    with pytest.raises(Exception, match="no attribute"):
        A.read_shapefiles(spark, d, "one", "width")
    with pytest.raises(Exception, match="no .shx member for two"):
        A.read_shapefiles(spark, d, "two")


def test_a_cut_off_member_is_an_error(spark):
    d = folder(a=shapefile_zip(["1", "2"], [SQUARE, SQUARE]))
    with zipfile.ZipFile(f"{d}/a.zip") as zf:
        members = {n: zf.read(n) for n in zf.namelist()}
    with zipfile.ZipFile(f"{d}/a.zip", "w") as zf:
        for n, data in members.items():
            zf.writestr(n, data[:-20] if n.endswith(".shp") else data)
    with pytest.raises(Exception, match="bytes early"):
        A.read_shapefiles(spark, d)


def test_geopackages_are_copied_once(spark):
    d = tempfile.mkdtemp(prefix="tl-gpkg-")
    rows = [(i, 400 + 100 * (i % 2), 7.5 * (i % 3), f"9:{i}:{-i}" if i % 7 else None) for i in range(1, 101)]
    for name, part in (("a", rows[:60]), ("b", rows[60:])):
        con = sqlite3.connect(f"{d}/{name}.gpkg")
        con.execute("CREATE TABLE cells (fid INTEGER PRIMARY KEY, technology INTEGER, mindown REAL, h3_res9_id TEXT)")
        con.executemany("INSERT INTO cells VALUES (?, ?, ?, ?)", part)
        con.commit()
        con.close()
        with zipfile.ZipFile(f"{d}/{name}.zip", "w", zipfile.ZIP_DEFLATED) as zf:
            zf.write(f"{d}/{name}.gpkg", f"{name}.gpkg")
    copy = A.import_geopackage(spark, d, "cells", "fid long, technology int, mindown double, h3_res9_id string", f"{d}/copy")
    assert sorted(tuple(r) for r in copy.collect()) == rows
