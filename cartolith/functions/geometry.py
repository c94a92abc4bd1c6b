"""Column functions on points, rings and boxes in pixel space (y grows downwards).

A point is struct<x, y>, a ring array<struct<x, y>>, a box struct<x0, y0, x1, y1>.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def box_of(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def ring_of(b: Column) -> Column:
    """The corners of a box, clockwise on the screen from the upper left one."""
    corners = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")]
    return F.array(*[F.struct(b[x].alias("x"), b[y].alias("y")) for x, y in corners])


def centre(b: Column) -> Column:
    return F.struct(((b["x0"] + b["x1"]) / 2).alias("x"), ((b["y0"] + b["y1"]) / 2).alias("y"))


def area(b: Column) -> Column:
    return F.greatest(b["x1"] - b["x0"], F.lit(0)) * F.greatest(b["y1"] - b["y0"], F.lit(0))


def overlap(a: Column, b: Column) -> Column:
    """Whether two boxes meet, their edges included."""
    return (a["x0"] <= b["x1"]) & (a["x1"] >= b["x0"]) & (a["y0"] <= b["y1"]) & (a["y1"] >= b["y0"])


def inside(a: Column, b: Column) -> Column:
    """Whether box a lies in box b, edges included."""
    return (a["x0"] >= b["x0"]) & (a["x1"] <= b["x1"]) & (a["y0"] >= b["y0"]) & (a["y1"] <= b["y1"])


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes; 0 for empty ones."""
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    common = F.greatest(w, F.lit(0)) * F.greatest(h, F.lit(0))
    union = area(a) + area(b) - common
    return F.when(union > 0, common / union).otherwise(F.lit(0.0))


def _edges(ring: Column) -> Column:
    """The ring's edges as (x1, y1, x2, y2)."""
    after = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(ring, after, lambda p, q: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")))


def ring_area2(ring: Column) -> Column:
    """Twice the signed area."""
    return F.aggregate(_edges(ring), F.lit(0.0), lambda s, e: s + (e["x1"] * e["y2"] - e["x2"] * e["y1"]))


def centroid(ring: Column) -> Column:
    """The centroid of a ring; of one without area, the mean of its points."""
    two = ring_area2(ring)

    def first(c: str) -> Column:
        return F.aggregate(_edges(ring), F.lit(0.0), lambda s, e: s + (e[f"{c}1"] + e[f"{c}2"]) * (e["x1"] * e["y2"] - e["x2"] * e["y1"]))

    def mean(c: str) -> Column:
        return F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[c]) / F.size(ring)

    return F.struct(*[F.when(two != 0, first(c) / (3 * two)).otherwise(mean(c)).alias(c) for c in ("x", "y")])


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Ray casting; points on an edge are in."""

    def crosses(e: Column) -> Column:
        straddles = (e["y1"] > y) != (e["y2"] > y)
        at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.when(e["y2"] != e["y1"], e["y2"] - e["y1"])
        return F.when(straddles & (x < at), 1).otherwise(0)

    def touches(e: Column) -> Column:
        cross = (x - e["x1"]) * (e["y2"] - e["y1"]) - (y - e["y1"]) * (e["x2"] - e["x1"])
        within = x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        return (cross == 0) & within

    odd = F.aggregate(_edges(ring), F.lit(0), lambda n, e: n + crosses(e)) % 2 == 1
    return odd | F.exists(_edges(ring), touches)


def rings_meet(a: Column, b: Column) -> Column:
    """Whether two rings have a common point: a corner of one in the other, or edges that cross."""

    def side(px: Column, py: Column, e: Column) -> Column:
        return F.signum((e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"]))

    def cut(e: Column, f: Column) -> Column:
        return (side(f["x1"], f["y1"], e) * side(f["x2"], f["y2"], e) <= 0) & (side(e["x1"], e["y1"], f) * side(e["x2"], e["y2"], f) <= 0)

    corner = F.exists(a, lambda p: point_in_ring(p["x"], p["y"], b)) | F.exists(b, lambda p: point_in_ring(p["x"], p["y"], a))
    return overlap(box_of(a), box_of(b)) & (corner | F.exists(_edges(a), lambda e: F.exists(_edges(b), lambda f: cut(e, f))))


def scaled(ring: Column, factor: Column) -> Column:
    """Coordinates times a factor, cut to whole pixels."""
    return F.transform(ring, lambda p: F.struct((p["x"] * factor).cast("int").alias("x"), (p["y"] * factor).cast("int").alias("y")))


def moved(ring: Column, dx: Column, dy: Column) -> Column:
    return F.transform(ring, lambda p: F.struct((p["x"] + dx).alias("x"), (p["y"] + dy).alias("y")))


def limited(ring: Column, w: Column, h: Column) -> Column:
    return F.transform(ring, lambda p: F.struct(F.least(F.greatest(p["x"], F.lit(0)), w).alias("x"), F.least(F.greatest(p["y"], F.lit(0)), h).alias("y")))


def roi_boxes(b: Column, w: Column, h: Column, share: float = 0.04, least: float = 100.0) -> Column:
    """Outer and inner box around a map's box: a margin of a share of the image's longer side, but
    no less than `least`; the inner one is moved in by the margin, the outer one cut at the image."""
    m = F.greatest(F.greatest(w, h) * F.lit(share), F.lit(least))
    outer = box(F.greatest(b["x0"] - m, F.lit(0.0)), F.greatest(b["y0"] - m, F.lit(0.0)), F.least(b["x1"] + m, w.cast("double")), F.least(b["y1"] + m, h.cast("double")))
    inner = box(b["x0"] + m, b["y0"] + m, b["x1"] - m, b["y1"] - m)
    return F.struct(outer.alias("outer"), inner.alias("inner"))


def normalised(b: Column, w: Column, h: Column, clip: bool = False) -> Column:
    """A box in thousandths of the page, cut to whole numbers."""

    def part(v: Column, size: Column) -> Column:
        n = (F.lit(1000) * v / size).cast("int")
        return F.least(F.greatest(n, F.lit(0)), F.lit(1000)) if clip else n

    return box(part(b["x0"], w), part(b["y0"], h), part(b["x1"], w), part(b["y1"], h))


def rotated(ax: Column, ay: Column, bx: Column, by: Column, angle: Column) -> Column:
    """b turned about a by an angle in radians, rounded half to even."""
    r = F.hypot(bx - ax, by - ay)
    t = F.atan2(by - ay, bx - ax) + angle
    return F.struct(F.bround(ax + r * F.cos(t)).cast("int").alias("x"), F.bround(ay + r * F.sin(t)).cast("int").alias("y"))
