"""Keypoint fits of many points, connected parts, held groups, files and images, against plain code."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartolith.operators import keypoints as K
from cartolith.operators import outlines as O
from cartolith.operators import raster as R
from cartolith.operators.runs import chosen
from cartolith.sources import files as S
from cartolith.sources import tiff
from cartolith.sources.storage import work_folder

COORDS = "raster_id int, axis string, seq int, px double, degree double"


def plain_inliers(points):
    """points: (seq, px, degree); the rule in plain Python."""
    y = np.array([d for _, _, d in points])
    off = np.abs(y - np.median(y))
    threshold = (np.median(off) or off.mean()) * (max(4 / len(y), 0.5) if len(y) > 4 else 1)
    best = None
    for a, (i, xi, yi) in enumerate(points):
        for j, xj, yj in points[a + 1 :]:
            if xi == xj:
                continue
            slope = (yj - yi) / (xj - xi)
            far = [abs(d - (slope * x + yi - slope * xi)) for _, x, d in points]
            hits = [f for f in far if round(f, 9) <= round(threshold, 9)]
            key = (len(hits), -round(sum(hits), 6), -i, -j)
            if best is None or key > best[0]:
                best = key, [round(f, 9) <= round(threshold, 9) for f in far]
    return best[1] if best else [True] * len(points)


def test_line_inliers_are_the_rules(spark):
    r = np.random.default_rng(31)
    rows, want = [], {}
    for m in range(40):
        points = sorted((n, float(r.integers(0, 30)), float(r.integers(0, 20)) / 4) for n in range(int(r.integers(1, 9))))
        rows += [(m, "lat", *p) for p in points]
        want |= {(m, p[0]): ok for p, ok in zip(points, plain_inliers(points), strict=True)}
    got = K.inliers(spark.createDataFrame(rows, COORDS)).collect()
    assert {(x["raster_id"], x["seq"]): x["inlier"] for x in got} == want
    assert K.inliers(spark.createDataFrame([], COORDS)).count() == 0


def test_line_inliers_of_many_keypoints(spark):
    """More keypoints than all pairs are tried of: the line that most of them lie on is found."""
    r = np.random.default_rng(32)
    rows = [(1, "lon", n, float(n), 30 - n / 100 + (5.0 * r.random() + 3 if n % 5 == 0 else 0)) for n in range(500)]
    out = K.inliers(spark.createDataFrame(rows, COORDS), slope_sign=-1).collect()
    assert [x["inlier"] for x in sorted(out, key=lambda x: x["seq"])].count(True) >= 400
    assert all(x["inlier"] for x in out if x["seq"] % 5)


def test_connected_parts():
    r = np.random.default_rng(33)
    for _ in range(30):
        mask = r.random((9, 11)) < 0.55
        want, at = np.zeros(mask.shape, int), 0
        for y, x in zip(*np.nonzero(mask), strict=True):
            if want[y, x]:
                continue
            at, todo = y * 11 + x + 1, [(y, x)]
            while todo:
                a, b = todo.pop()
                if 0 <= a < 9 and 0 <= b < 11 and mask[a, b] and not want[a, b]:
                    want[a, b] = at
                    todo += [(a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)]
        assert (R.labelled(mask) == want).all()
    assert (R.labelled(np.zeros((3, 4), bool)) == 0).all()


def test_unions_and_hulls():
    """Areas against a count of fine pixels."""
    r = np.random.default_rng(35)
    x, y = np.meshgrid(np.arange(0.05, 40, 0.1), np.arange(0.05, 40, 0.1))

    def covers(ring):
        inside = np.zeros(x.shape, bool)
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
            if y0 != y1:
                inside ^= ((y0 > y) != (y1 > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
        return inside

    for _ in range(40):
        a, b = (O.hull([tuple(p) for p in (r.integers(0, 25, (5, 2)) + r.integers(0, 14, 2)).astype(float)]) for _ in range(2))
        if min(abs(O.signed_area(a)), abs(O.signed_area(b))) < 5:
            continue
        ring, both = O.united(a, b), covers(a) & covers(b)
        if ring is None:
            assert both.sum() < 40
        else:
            assert abs(abs(O.signed_area(ring)) - (covers(a) | covers(b)).sum() / 100) < 4
    box = lambda x, y, w=10, h=10: [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    assert O.united(box(0, 0), box(10, 0)) is None and O.united(box(0, 0), box(30, 0)) is None  # no area in common
    assert sorted(O.united(box(0, 0), box(2, 2, 3, 3))) == sorted(box(0, 0))
    assert sorted(O.united(box(0, 0), box(5, 0))) == sorted(box(0, 0, 15, 10))
    assert sorted(O.united(box(0, 0), box(0, 0))) == sorted(box(0, 0))
    assert len(O.united(box(0, 0), box(5, 5))) == 8 and len(O.united(box(0, 4, 10, 2), box(4, 0, 2, 10))) == 12
    assert len(O.merged_all([box(0, 0), box(30, 0), box(8, 0, 24, 2)])) == 1


def test_groups_longer_than_a_batch(spark):
    """Groups over several batches are chosen from as a whole."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.range(200).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
        out = chosen(rows, ["g"], ["v"], lambda c: [0, len(c["v"]) - 1]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((x["g"], x["v"]) for x in out) == [(0, 0), (0, 198), (1, 1), (1, 199), (2, 2), (2, 197)]


def test_images_come_back():
    r = np.random.default_rng(34)
    for shape in ((3, 5), (4, 2, 3), (1, 1)):
        pixels = r.integers(0, 256, shape, dtype=np.uint8)
        assert (tiff.decode(tiff.encode(pixels)) == pixels).all()
    with pytest.raises(ValueError):
        tiff.decode(b"none")
    assert tiff.normal(np.array([[0.0, 0.5, 1.0]]))[0, :, 0].tolist() == [0, 127, 255]
    assert tiff.normal(np.zeros((2, 2))).max() == 0


def test_files(spark):
    folder = work_folder(spark)
    rows = spark.createDataFrame([("a/x.bin", b"1"), ("a/empty", None), ("é y.json", b"{}")], "name string, content binary")
    assert {tuple(r) for r in S.write_bytes(rows, folder).collect()} == {("a/x.bin", 1), ("a/empty", 0), ("é y.json", 2)}
    assert S.listed(spark, folder, "*.bin").select("name").first()[0] == "a/x.bin"
    assert S.keys(spark, f"{folder}/a/", most=1) == ["empty"] and S.keys(spark, f"{folder}/none") == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        S.listed(spark, f"{folder}/none").count()
    with pytest.raises(ValueError, match="images, output"):
        S.required(spark, input=folder, output=f"{folder}/none", images="nostore://x")
    wanted = spark.createDataFrame([("a/x.bin",), ("gone",)], "name string")
    assert {r["name"]: r["content"] for r in S.looked_up(wanted, S.listed(spark, folder)).collect()} == {"a/x.bin": bytearray(b"1"), "gone": None}
