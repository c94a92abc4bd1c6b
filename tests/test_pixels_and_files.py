"""Pixel operators, legend joins and file formats against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartolith.operators import control as C
from cartolith.operators import legend as L
from cartolith.operators import raster as R
from cartolith.sources import readers as S


def test_likeness_is_correlation():
    r = np.random.default_rng(1)
    image, template = r.integers(0, 256, (9, 11)).astype(np.uint8), r.integers(0, 256, (3, 4)).astype(np.uint8)
    got = R.likeness(image, template)
    for y in range(7):
        for x in range(8):
            assert got[y, x] == pytest.approx(np.corrcoef(image[y : y + 3, x : x + 4].ravel(), template.ravel())[0, 1])
    assert (R.likeness(np.full((5, 5), 7, np.uint8), template[:, :3]) == 0).all()


def test_turns_and_parts():
    t = np.arange(25, dtype=np.uint8).reshape(5, 5)
    assert (R.rotated(t, 0) == t).all() and (R.rotated(t, 360) == t).all()
    assert sorted(R.rotated(t, 90).ravel()) == sorted(t.ravel()) and (R.rotated(R.rotated(t, 90), 270) == t).all()
    mask = np.array([[1, 1, 0, 0], [0, 0, 0, 1], [0, 1, 0, 1], [0, 0, 1, 1]], bool)
    assert R.largest_part(mask).sum() == 4 and R.largest_part(mask)[3, 2]
    assert not R.largest_part(np.zeros((3, 3), bool)).any()
    one = np.zeros((7, 7), bool)
    one[3, 3] = True
    assert R.grown(one, 2).sum() == 25
    assert (R.gamma(np.array([0, 255], np.uint8), 0.5) == [0, 255]).all()


def test_template_is_found(spark):
    template = np.array([[255, 0, 255], [0, 0, 255], [255, 255, 255]], np.uint8)
    image = np.full((10, 12), 255, np.uint8)
    image[4:7, 5:8] = template
    rows = spark.createDataFrame([(1, 12, 10, bytes(image)), (2, 2, 2, bytes(4))], "id long, w int, h int, pixels binary")
    out = R.best_turns(R.template_matches(rows, template, 0.99)).collect()
    assert [(r["id"], r["x"], r["y"], r["rotation"]) for r in out if r["rotation"] == 0] == [(1, 5, 4, 0)]


def test_swatches_are_claimed_in_turn(spark):
    swatch = [(1, 1, "a", 0.5, 0, 0), (1, 2, "a", 0.9, 5, 0), (1, 3, "b", 0.8, 6, 0), (1, 4, "c", 0.8, 500, 0), (1, 5, "known", 0.8, 900, 900)]
    item = [(1, 10, "", 4, 0), (1, 11, "", 400, 0), (1, 12, "known", 0, 0)]
    a = spark.createDataFrame([(*s[:4], *map(float, (s[4], s[5], s[4] + 20, s[5] + 20))) for s in swatch], "raster_id long, seq long, class_name string, score double, x0 double, y0 double, x1 double, y1 double")
    b = spark.createDataFrame([(*s[:3], *map(float, (s[3], s[4], s[3] + 20, s[4] + 20))) for s in item], "raster_id long, seq long, class_name string, x0 double, y0 double, x1 double, y1 double")
    got = {r["class_name"]: (r["item_seq"], r["how"]) for r in L.joined_swatches(a, b).collect()}
    assert got == {"a": (10, "claimed"), "b": (None, "new"), "c": (None, "new"), "known": (12, "known")}


def test_words_become_lines(spark):
    words = [(1, 0, "FUMIOUS\nBANDER SNATCH"), (1, 1, "FUMIOUS"), (1, 2, "BANDER"), (1, 3, "SNATCH"), (2, 0, "alone")]
    rows = spark.createDataFrame([(d, n, t, 10 * n, n, 10 * n + 9, n + 1) for d, n, t in words], "doc_id long, seq int, text string, x0 long, y0 long, x1 long, y1 long")
    out = [(r["idx"], r["text"], r["x0"], r["x1"]) for r in L.text_lines(rows).orderBy("idx").collect()]
    assert out == [(0, "FUMIOUS", 10, 19), (1, "BANDER SNATCH", 20, 39)]


def test_inferred_longitude(spark):
    # Latitudes fall by 1 degree in 1000 pixels; at 60 degrees a degree of longitude is half as long.
    coords = spark.createDataFrame([(1, "lat", 0, 0.0, 0.0, 60.5), (1, "lat", 1, 0.0, 1000.0, 59.5), (1, "lon", 2, 100.0, 10.0, 100.0)], "raster_id int, axis string, seq int, x double, y double, degree double")
    rois = spark.createDataFrame([(1, 0.0, 0.0, 1000.0, 1000.0, -1, -1)], "raster_id int, x0 double, y0 double, x1 double, y1 double, lon_sign int, lat_sign int")
    (r,) = L.inferred(coords, rois).collect()
    assert (r["axis"], r["x"], r["y"]) == ("lon", 1000.0, 9.0)
    assert 100 - r["degree"] == pytest.approx(900 / 1000 / math.cos(math.radians(59.5)), rel=0.03)


def test_control_points_keep_apart(spark):
    r = np.random.default_rng(3)
    rows = [(1, n, float(x), float(y), n < 2, float(n % 3)) for n, (x, y) in enumerate(r.integers(0, 120, (40, 2)))]
    got = [(p["x"], p["y"]) for p in C.control_points(spark.createDataFrame(rows, "raster_id int, seq int, x double, y double, corner boolean, confidence double")).collect()]
    assert 1 < len(got) <= 8 and all(math.dist(a, b) > 30 for n, a in enumerate(got) for b in got[:n])


def test_text_files(spark, tmp_path):
    (tmp_path / "points.csv").write_text("raster_ID,row,col,NAD83_x,NAD83_y\nm1,10.6,20.2\nshort,1\nm1,30,40,-110.5,35\nm1,30,40,0,35\nm1,9999,1\nm1,1,1\n")
    out = S.query_points(S.lines(spark, str(tmp_path)), F.lit(100), F.lit(100)).orderBy("seq").collect()
    assert [(r["x"], r["y"], r["lon"], r["lat"]) for r in out] == [(20, 10, None, None), (40, 30, -110.5, 35.0), (40, 30, None, None)]
    rows = spark.createDataFrame([("a", 1), ('q"x', None)], "name string, n int")
    S.write_unquoted(rows, str(tmp_path / "out"))
    text = sorted(x for p in (tmp_path / "out").glob("part-*") for x in p.read_text().splitlines() if not x.startswith("name"))
    assert text == ["a,1", 'q"x,'] or text == ["a,1", 'q"x,""']


def test_images_by_their_first_bytes(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "image1.v2.png").write_bytes(bytes.fromhex("89504E470D0A1A0A"))
    (tmp_path / "image2.tif").write_bytes(b"II*\0....")
    (tmp_path / "notes.txt").write_text("no image")
    assert sorted(r["doc_id"] for r in S.images(spark, str(tmp_path)).collect()) == ["image1", "image2"]
