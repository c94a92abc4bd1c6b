"""Operators on fixtures, by properties, and against plain Python."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartolith.functions import geo, geodesy
from cartolith.functions import geometry as G
from cartolith.operators import control as C
from cartolith.operators import keypoints as K
from cartolith.operators import points as P
from cartolith.operators import segments as S

few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def boxes(spark, rows, names):
    df = spark.createDataFrame(rows, f"{names}, x0 int, y0 int, x1 int, y1 int")
    return df.withColumn("box", G.box(*(F.col(c) for c in ("x0", "y0", "x1", "y1")))).drop("x0", "y0", "x1", "y1")


@pytest.mark.parametrize("include", [False, True])
def test_text_filter_keeps_both(spark, include):
    ocr = boxes(spark, [("d", 0, "FUMIOUS", 4, 9, 89, 22), ("d", 1, "BANDERSNATCH SNICKER-SNACK", 3, 30, 157, 46)], "doc_id string, idx int, text string")
    seg = boxes(spark, [("d", "legend_points_lines", 0, 0, 100, 100), ("d", "map", 101, 100, 200, 200)], "doc_id string, class_label string")
    out = S.text_filter(ocr, seg, ["legend_points_lines", "map"], include=include).orderBy("idx")
    assert [r["text"] for r in out.collect()] == ["FUMIOUS", "BANDERSNATCH SNICKER-SNACK"]
    assert S.text_filter(ocr, seg.limit(0), ["map"]).count() == 0


@few
@given(st.lists(st.integers(0, 60), min_size=1, max_size=25))
def test_islands_are_clusters(spark, values):
    rows = spark.createDataFrame([(1, n, v / 8) for n, v in enumerate(values)], "k int, seq int, v double")
    got = {r["seq"]: r["cluster"] for r in K.islands(rows, "v", 0.375, ["k"]).collect()}
    near = [[abs(a - b) <= 3 for b in values] for a in values]
    for i in range(len(values)):
        assert (got[i] is None) == (sum(near[i]) < 2)
        for j in range(len(values)):
            if near[i][j] and got[i] is not None:
                assert got[i] == got[j]


@few
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=20))
def test_upsert_keys_are_unique(spark, pairs):
    rows = spark.createDataFrame([(1, n, "lat", float(d), float(p)) for n, (d, p) in enumerate(pairs)], "raster_id int, seq int, axis string, degree double, px double")
    out = K.collided(rows).collect()
    assert len({(r["degree"], r["key_px"]) for r in out}) == len(out)


@few
@given(st.integers(1, 5000), st.integers(1, 900))
def test_splits_cover_without_overlap(spark, size, limit):
    parts = one(spark, s=P.splits(F.lit(size), limit))["s"]
    assert parts[0]["a"] == 0 and parts[-1]["b"] == size
    assert all(p["b"] == q["a"] for p, q in zip(parts, parts[1:], strict=False))
    assert all(0 < p["b"] - p["a"] <= limit for p in parts)


def test_overlapped_tiles_cover_the_region(spark):
    roi = spark.createDataFrame([(1, 30, 40, 3000, 2100)], "raster_id int, x0 int, y0 int, x1 int, y1 int")
    tiles = P.overlapped_tiles(roi).collect()
    assert max(t["x_offset"] for t in tiles) + 1024 >= 3000 and max(t["y_offset"] for t in tiles) + 1024 >= 2100
    assert min(t["x_offset"] for t in tiles) == 30 and {t["width"] for t in tiles} == {1024}


@few
@given(st.integers(-720, 720), st.integers(0, 359), st.integers(0, 359))
def test_angle_ranges_go_round(spark, x, a, b):
    r = one(spark, p=geo.angle_in_range(F.lit(x), F.lit(a), F.lit(b)), q=geo.angle_in_range(F.lit(x + 360), F.lit(a), F.lit(b)))
    assert r["p"] == r["q"] == ((x - a) % 360 <= (b - a) % 360)


def test_range_rules(spark):
    r = one(spark, a=geo.in_range(F.lit(5.0), F.lit(-30.0), F.lit(2.0)), b=geo.in_range(F.lit(5.0), F.lit(-30.0), F.lit(2.0), strict_reference=False), c=geo.in_range(F.lit(25.0), F.lit(-30.0), F.lit(-20.0)))
    assert (r["a"], r["b"], r["c"]) == (False, True, True)


@pytest.mark.parametrize(("text", "want"), [("35°30'", (35.0, 30, None)), ("105°52'30\"", (105.0, 52, 30)), ("35°", (35.0, None, None)), ("105° W", (None, None, None)), ("49.25", (49.25, None, None)), ("none", (None, None, None))])
def test_angles_on_labels(spark, text, want):
    p = one(spark, p=geo.dms_parts(F.lit(text)))["p"]
    assert (p["d"], p["m"], p["s"]) == want


def test_geodesics(spark):
    r = one(spark, e=geodesy.destination(F.lit(0.0), F.lit(10.0), 90, F.lit(111.3194907932736)), n=geodesy.destination(F.lit(0.0), F.lit(0.0), 0, F.lit(110.5743885)), c=geodesy.to_conic(F.lit(33.5), F.lit(-118.0), 34.0, 35.5, 33.5, -118.0, 2e6, 5e5))
    assert r["e"]["lon"] == pytest.approx(11.0, abs=1e-9) and r["e"]["lat"] == pytest.approx(0, abs=1e-9)
    assert r["n"]["lat"] == pytest.approx(1.0, abs=1e-7)
    assert (r["c"]["easting"], r["c"]["northing"]) == (pytest.approx(2e6), pytest.approx(5e5))


def test_utm_known_point(spark):
    u = one(spark, u=geo.to_utm(F.lit(0.0), F.lit(3.0), F.lit(31)), v=geo.to_utm(F.lit(43.642567), F.lit(-79.387139), F.lit(17)))
    assert u["u"]["easting"] == pytest.approx(500_000) and u["u"]["northing"] == pytest.approx(0, abs=1e-6)
    assert u["v"]["easting"] == pytest.approx(630_084, abs=1) and u["v"]["northing"] == pytest.approx(4_833_439, abs=1)


def test_rings(spark):
    tri = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (10, 0), (0, 10))])
    far = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((20, 0), (30, 0), (20, 10))])
    r = one(spark, c=G.centroid(tri), a=G.point_in_ring(F.lit(2.0), F.lit(2.0), tri), b=G.point_in_ring(F.lit(6.0), F.lit(6.0), tri), e=G.point_in_ring(F.lit(5.0), F.lit(5.0), tri), m=G.rings_meet(tri, far), s=G.rings_meet(tri, tri))
    assert r["c"]["x"] == pytest.approx(10 / 3) and (r["a"], r["b"], r["e"], r["m"], r["s"]) == (True, False, True, False, True)


@few
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=20))
def test_suppression_keeps_distances(spark, xy):
    rows = spark.createDataFrame([(1, "c", n, float(x), float(y), float(n % 5)) for n, (x, y) in enumerate(xy)], "raster_id int, class_name string, seq int, x double, y double, score double")
    kept = [(r["x"], r["y"]) for r in P.suppressed(rows, 15.0).collect()]
    assert kept and all(math.dist(a, b) >= 15 for n, a in enumerate(kept) for b in kept[:n])
    assert all(any(math.dist(a, b) < 15 for b in kept) or a in kept for a in [(float(x), float(y)) for x, y in xy])


@few
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), min_size=1, max_size=12), st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), min_size=1, max_size=12))
def test_matches_are_one_to_one_and_nearest_first(spark, truth, found):
    a, b = (spark.createDataFrame([(1, n, float(x), float(y)) for n, (x, y) in enumerate(p)], "map_id long, seq long, x double, y double") for p in (truth, found))
    got = sorted((r["true_seq"], r["seq"]) for r in P.matched_points(a, b, 9.0, 8).collect())
    pairs, left, right, want = sorted((math.dist(p, q), i, j) for i, p in enumerate(truth) for j, q in enumerate(found) if math.dist(p, q) <= 9), set(), set(), []
    for _, i, j in pairs:
        if i not in left and j not in right:
            left.add(i)
            right.add(j)
            want.append((i, j))
    assert got == sorted(want)


def test_fits_recover_a_plane(spark):
    r = np.random.default_rng(1)
    rows = [(m, float(x), float(y), float(30 + m + 0.25 * x - 0.5 * y)) for m in range(3) for x, y in r.integers(0, 500, (6, 2))]
    fit = {p["raster_id"]: p for p in K.polynomial_fit(spark.createDataFrame([*rows, (9, 1.0, 1.0, 1.0), (9, 2.0, 2.0, 2.0)], "raster_id int, x double, y double, z double")).collect()}
    for m in range(3):
        assert (fit[m]["a"], fit[m]["b"], fit[m]["c"]) == (pytest.approx(30 + m), pytest.approx(0.25), pytest.approx(-0.5))
    assert fit[9]["b"] is None  # two points on a line


def test_georeference_of_a_clean_map(spark):
    rows = [(1, n, axis, float(px), float(py), (35 - py / 100) if axis == "lat" else (110 - px / 100), "lat_lon", "ok", 0.9) for n, (axis, px, py) in enumerate([(a, x, y) for a in ("lat", "lon") for x, y in ((0, 0), (400, 30), (20, 500), (410, 490))])]
    coords = spark.createDataFrame(rows, "raster_id int, seq int, axis string, px double, py double, degree double, source string, status string, confidence double")
    points = spark.createDataFrame([(1, 0, 200.0, 100.0), (2, 0, 1.0, 1.0)], "raster_id int, seq int, x double, y double")
    fences = spark.createDataFrame([(m, -115.0, -105.0, 25.0, 45.0) for m in (1, 2)], "raster_id int, lon_min double, lon_max double, lat_min double, lat_max double")
    out = {r["raster_id"]: r for r in C.georeferenced(points, coords.withColumn("px", F.col("px")), fences).collect()}
    assert (out[2]["lon"], out[2]["lat"], out[2]["confidence"]) == (-110.0, 35.0, 0.0)
    assert out[1]["lon"] == pytest.approx(-108.0) and out[1]["lat"] == pytest.approx(34.0) and out[1]["confidence"] > 0
