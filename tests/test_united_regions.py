"""Polygons of documents: united where they overlap, passed on where they lie apart."""

import numpy as np

from cartolith.operators import outlines as O


def merged_one_by_one(rings):
    """Every pair is tried, until none unites."""
    left, out = [O.plain(r) for r in rings], []
    while left:
        one, n = left.pop(0), 0
        while n < len(left):
            both = O.united(one, left[n])
            if both is None:
                n += 1
            else:
                one, n = both, 0 * len(left.pop(n))
        out.append(one)
    return out


def test_polygons_apart_are_not_tried(monkeypatch):
    """Only polygons whose bounds meet are laid over each other."""
    tried = []
    monkeypatch.setattr(O, "united", lambda a, b: tried.append((a, b)))
    box = lambda x, y: [(x, y), (x + 10.0, y), (x + 10.0, y + 10.0), (x, y + 10.0)]
    rings = [box(20.0 * x, 20.0 * y) for x in range(8) for y in range(8)]
    assert O.merged_all(rings) == rings and not tried
    assert len(O.merged_all([*rings, box(5.0, 5.0)])) == 65 and len(tried) == 1


def test_documents_of_polygons(spark):
    """Batches against each document on its own: boxes and hulls either way round, with repeated
    points and points on a line, touching, within each other, none at all."""
    r = np.random.default_rng(61)
    docs = []
    for d in range(300):
        rings = []
        for _ in range(int(r.integers(0, 6))):
            x, y, w, h = (float(v) for v in (*r.integers(0, 60, 2), *r.integers(1, 12, 2)))
            ring = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
            ring = O.hull([tuple(map(float, p)) for p in r.integers(0, 9, (5, 2)) + r.integers(0, 60, 2)]) if r.random() < 0.3 else ring
            if len(ring) < 3:
                continue
            ring = ring[::-1] if r.random() < 0.4 else ring
            ring = [ring[0], *ring] if r.random() < 0.1 else ring
            ring = [((ring[0][0] + ring[-1][0]) / 2, (ring[0][1] + ring[-1][1]) / 2), *ring] if r.random() < 0.1 else ring
            rings.append(ring)
        docs.append((d, rings))
    rows = spark.createDataFrame([(d, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for d, rings in docs], f"doc_id long, rings array<{O.RING}>")
    got = {(x["doc_id"], x["n"]): [tuple(p) for p in x["ring"]] for x in O.merged_polygons(rows).collect()}
    assert got == {(d, n): ring for d, rings in docs for n, ring in enumerate(merged_one_by_one(rings))}
    assert O.merged_polygons(rows.limit(0)).count() == 0
