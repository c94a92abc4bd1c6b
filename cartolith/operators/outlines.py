"""Unions and hulls of polygons. A polygon is a list of (x, y) without the first point again."""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

Ring = list[tuple[float, float]]
RING = "array<struct<x: double, y: double>>"
#: Polygons whose bounds are this far apart share nothing.
MARGIN = 1e-6


def signed_area(ring: Ring) -> float:
    return sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def place(p: tuple[float, float], ring: Ring) -> int:
    """1 inside, 0 on an edge, -1 outside."""
    x, y, inside = *p, False
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
        cross = (x1 - x0) * (y - y0) - (y1 - y0) * (x - x0)
        if abs(cross) < 1e-9 * (abs(x1 - x0) + abs(y1 - y0) + 1) and min(x0, x1) - 1e-9 <= x <= max(x0, x1) + 1e-9 and min(y0, y1) - 1e-9 <= y <= max(y0, y1) + 1e-9:
            return 0
        if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
            inside = not inside
    return 1 if inside else -1


def plain(ring: Ring) -> Ring:
    """Counter-clockwise, without points that repeat or lie between their neighbours on a line."""
    out = [p for n, p in enumerate(ring) if p != ring[n - 1]] if len(ring) > 1 else list(ring)
    if signed_area(out) < 0:
        out = out[::-1]
    bent = []
    for n, (x, y) in enumerate(out):
        (x0, y0), (x1, y1) = out[n - 1], out[(n + 1) % len(out)]
        if abs((x - x0) * (y1 - y) - (y - y0) * (x1 - x)) > 1e-9:
            bent.append((x, y))
    return bent


def hull(points: Ring) -> Ring:
    """The convex hull, counter-clockwise: lower and upper chain of the points in order."""

    def chain(rows: Ring) -> Ring:
        out: Ring = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    rows = sorted(set(points))
    return rows if len(rows) < 3 else chain(rows) + chain(rows[::-1])


def _cuts(p: tuple, q: tuple, ring: Ring) -> list[float]:
    """Where the edges and corners of a ring cut the way from p to q, as shares of it."""
    (px, py), (qx, qy) = p, q
    dx, dy, out = qx - px, qy - py, [0.0, 1.0]
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
        ex, ey = x1 - x0, y1 - y0
        turn = dx * ey - dy * ex
        if abs(turn) > 1e-12:
            t, u = ((x0 - px) * ey - (y0 - py) * ex) / turn, ((x0 - px) * dy - (y0 - py) * dx) / turn
            if -1e-12 <= u <= 1 + 1e-12:
                out.append(t)
        else:
            out += [((x - px) * dx + (y - py) * dy) / (dx * dx + dy * dy) for x, y in ((x0, y0), (x1, y1)) if abs((x - px) * dy - (y - py) * dx) < 1e-9]
    return sorted({round(t, 12) for t in out if 0 <= t <= 1})


def united(a: Ring, b: Ring) -> Ring | None:
    """The outline of two polygons that share some area; holes between them are filled. None: they
    share none. Every edge is cut at the other's edges, what lies inside the other goes, and the
    pieces that are left are walked round."""
    a, b = plain(a), plain(b)
    pieces: dict[tuple, list[tuple]] = {}
    met = False
    for ring, other, own in ((a, b, True), (b, a, False)):
        for p, q in zip(ring, ring[1:] + ring[:1], strict=True):
            cuts = _cuts(p, q, other)
            at = [(p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])) for t in cuts]
            for s, e in zip(at, at[1:], strict=False):
                mid = ((s[0] + e[0]) / 2, (s[1] + e[1]) / 2)
                where = place(mid, other)
                met |= where > 0
                if where == 0:  # along the other's edge: kept once, if both lie on one side of it
                    n = max(abs(e[0] - s[0]), abs(e[1] - s[1]))
                    left = (mid[0] - (e[1] - s[1]) / n * 1e-6, mid[1] + (e[0] - s[0]) / n * 1e-6)
                    same = place(left, other) > 0
                    met |= same
                    if not (same and own):
                        continue
                if where <= 0:
                    key = lambda v: (round(v[0], 9), round(v[1], 9))
                    if key(s) != key(e):
                        pieces.setdefault(key(s), []).append(key(e))
    if not met:
        return None
    rings = []
    while pieces:
        start = min(pieces)
        ring, now = [start], start
        while True:
            ends = pieces[now]
            after = ends.pop()
            if not ends:
                del pieces[now]
            if after == start or after not in pieces:
                break
            ring.append(after)
            now = after
        if len(ring) > 2:
            rings.append(plain(ring))
    outer = max(rings, key=lambda r: abs(signed_area(r)), default=None)
    return outer if outer else max((a, b), key=lambda r: abs(signed_area(r)))


def _bounds(ring: Ring) -> tuple[float, float, float, float]:
    """Left, lower, right and upper end, with a margin; of no points the whole plane."""
    if not ring:
        return -math.inf, -math.inf, math.inf, math.inf
    x, y = zip(*ring, strict=True)
    return min(x) - MARGIN, min(y) - MARGIN, max(x) + MARGIN, max(y) + MARGIN


def merged_all(rings: list[Ring]) -> list[Ring]:
    """Polygons, those that share area made one, however they are chained."""
    left, out = [(r, _bounds(r)) for r in map(plain, rings)], []
    while left:
        (one, a), grown = left.pop(0), True
        while grown:
            grown = False
            for n, (other, b) in enumerate(left):
                if a[0] > b[2] or b[0] > a[2] or a[1] > b[3] or b[1] > a[3]:
                    continue
                both = united(one, other)
                if both is not None:
                    one, a, grown = both, _bounds(both), True
                    left.pop(n)
                    break
        out.append(one)
    return out


def _apart(docs: np.ndarray, low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """For each of n documents, whether its stretches from low to high all lie apart."""
    by = np.lexsort((low, docs))
    docs, low, high = docs[by], low[by], high[by]
    out = np.ones(n, bool)
    out[docs[1:][(docs[1:] == docs[:-1]) & ~(low[1:] > high[:-1] + MARGIN)]] = False
    return out


def _plain_rings(rings: pa.ListArray) -> tuple[np.ndarray, pa.RecordBatch]:
    """Which documents need a look at their rings, and (row, n, ring) of the others: documents
    whose rings lie apart, on one axis at least, and have no points to leave out."""
    count = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = rings.flatten()
    size = pc.fill_null(pc.list_value_length(flat), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    points = flat.flatten()
    x, y = (pc.struct_field(points, c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in "xy")
    docs, start = np.repeat(np.arange(len(count)), count), np.cumsum(size) - size
    of, k = np.repeat(np.arange(len(size)), size), np.arange(len(x))
    before, after = k - 1, k + 1
    some = size > 0
    before[start[some]], after[(start + size - 1)[some]] = (start + size - 1)[some], start[some]
    bend = np.abs((x - x[before]) * (y[after] - y) - (y - y[before]) * (x[after] - x)) > 1e-9
    bad = ~bend | ((x == x[before]) & (y == y[before]))
    look = np.zeros(len(count), bool)
    look[docs[(size < 3) | (np.bincount(of, bad, len(size)) > 0)]] = True
    ends = []
    for v in (x, y):
        low, high = np.zeros(len(size)), np.zeros(len(size))
        if some.any():
            low[some], high[some] = np.minimum.reduceat(v, start[some]), np.maximum.reduceat(v, start[some])
        ends.append(_apart(docs, low, high, len(count)))
    look |= ~(ends[0] | ends[1])
    turned = np.bincount(of, x * y[after] - x[after] * y, len(size)) < 0
    keep = ~look[docs]
    first, length = start[keep], size[keep]
    offsets = np.concatenate([[0], np.cumsum(length)])
    step = np.arange(offsets[-1]) - np.repeat(offsets[:-1], length)
    at = np.repeat(first, length) + np.where(np.repeat(turned[keep], length), np.repeat(length, length) - 1 - step, step)
    out = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(x[at]), pa.array(y[at])], ["x", "y"]))
    number = np.arange(len(docs)) - np.repeat(np.cumsum(count) - count, count)
    return look, pa.RecordBatch.from_arrays([pa.array(docs[keep]), pa.array(number[keep].astype(np.int32)), out], names=["row", "n", "ring"])


def _ring(points) -> Ring:
    return [(float(p["x"]), float(p["y"])) for p in points]


def merged_pairs(rows: DataFrame) -> DataFrame:
    """(id, ring) of rows(id, a, b): the outline of both polygons where they overlap, else their
    convex hull; cut to whole numbers. One that is null leaves the other as it is."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            out = []
            for a, b in zip(t["a"], t["b"], strict=True):
                if a is None or b is None:
                    ring = None if a is None and b is None else _ring(b if a is None else a)
                else:
                    a, b = _ring(a), _ring(b)
                    ring = united(a, b) or plain(hull(a + b))
                out.append(None if ring is None else [{"x": float(int(x)), "y": float(int(y))} for x, y in ring])
            yield pd.DataFrame({"id": t["id"], "ring": out})

    return rows.select("id", "a", "b").mapInPandas(work, f"id long, ring {RING}")


def merged_polygons(rows: DataFrame) -> DataFrame:
    """(doc_id, n, ring) of rows(doc_id, rings): a document's polygons, overlapping ones united.
    Documents whose polygons lie apart are gone through a batch at a time."""
    point = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            look, rest = _plain_rings(b["rings"])
            ids = b["doc_id"].cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(rest["row"]), rest["n"], rest["ring"]], names=["doc_id", "n", "ring"])
            some = np.flatnonzero(look)
            for at in range(0, len(some), 1000):
                part = pa.array(some[at : at + 1000])
                out = [(d, n, [{"x": x, "y": y} for x, y in ring]) for d, rings in zip(ids.take(part).to_pylist(), b["rings"].take(part).to_pylist(), strict=True) for n, ring in enumerate(merged_all([_ring(r) for r in rings]))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), point), strict=True)], names=["doc_id", "n", "ring"])

    return rows.select("doc_id", "rings").mapInArrow(work, f"doc_id long, n int, ring {RING}")
