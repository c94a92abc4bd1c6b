"""Queries against their SQL on small tables with what larger ones bring: wider keys, halves, borders."""

import duckdb
import pytest

from cartolith.plans import CATALOGUE


@pytest.fixture
def same(spark, tmp_path):
    """Compares a query with its SQL over one table, which a SELECT makes."""

    def check(name, **tables):
        con = duckdb.connect()
        for t, sql in tables.items():
            con.execute(f"COPY ({sql}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
        query, sql = CATALOGUE[name]
        got = query(spark, str(tmp_path))
        cols = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
        assert len(want) > 0
        assert sorted(map(tuple, got.select(*cols).collect())) == sorted(want)
        return got

    return check


def test_median_colours_of_even_counts(same):
    """A median between two whole numbers goes to the even one, as SQL's cast takes it."""
    same("a30_median_colour", lineitem="SELECT k % 20 AS l_suppkey, k * 13 AS l_partkey, k * k AS l_orderkey, k % 7 + 1 AS l_linenumber FROM range(200) t(k)")


def test_samples_of_every_image_size(same):
    """Scaling takes whole samples times one factor, whose product can end just below a whole number."""
    same("r8_normal_samples", supplier="SELECT k AS s_suppkey FROM range(70) t(k)")


def test_first_setting_by_wide_part_keys(same):
    """Part keys from 100 000 on outweigh a line number, as in the SQL's order."""
    same("o9_levers", lineitem="SELECT k % 9 AS l_orderkey, CAST(k % 7 + 1 AS INT) AS l_linenumber, k * 7919 % 300007 AS l_partkey, 'N' AS l_returnflag FROM range(60) t(k)")


def test_places_upserted_by_sequence(same):
    """Numbers above 1000 put old rows after new ones: the sequence decides."""
    same("x1_upsert_places", supplier="SELECT k * 97 AS s_suppkey, k % 4 AS s_nationkey FROM range(60) t(k)")


def test_utm_values_of_wide_keys(same):
    """Part keys in the millions still give northings of the zone, within the fence's latitudes."""
    same("d3_utm_extractor", lineitem="SELECT k // 4 AS l_orderkey, CAST(k % 4 + 1 AS INT) AS l_linenumber, k * 9973 AS l_partkey, k * 499 AS l_suppkey FROM range(240) t(k)")


def test_slopes_of_just_the_limit(spark):
    """Three keypoints whose slope is exactly 0.05 in whole numbers are never colinear, in any order."""
    from itertools import permutations

    from cartolith.operators import keypoints as K

    exact = [((127, 4), (77, 10), (27, 9)), ((291, 10), (191, 2), (291, 4)), ((123, 4), (63, 6), (143, 12)), ((162, 10), (242, 4), (262, 6))]
    for p in exact:
        up, across = (3 * sum(x * v[k] for (x, _), v in zip(p, p, strict=True)) - sum(x for x, _ in p) * sum(v[k] for v in p) for k in (1, 0))
        assert 20 * abs(up) == across
    groups = [[(x + s, y) for x, y in o] for p in exact for o in permutations(p) for s in range(60)]
    groups += [[(0, 0), (1000, 49), (2000, 98)], [(0, 0), (1000, -49), (2000, -98)]]
    rows = [(m, "lat", float(x), float(y)) for m, points in enumerate(groups) for x, y in points]
    got = K.colinear(spark.createDataFrame(rows, "raster_id int, axis string, px double, py double").coalesce(1))
    assert sorted(r["raster_id"] for r in got.collect()) == [len(groups) - 2, len(groups) - 1]
