"""Nearest neighbours by a block matrix join on int8 tiles, with quantisation error bounds.

Vectors become int8 with a scale of their own; the norm of what rounding took away is kept. For a
tile of queries and candidates, one matrix product of the int8 codes (in float32, in which it is
exact) gives the distance D between the rounded vectors, and by the triangle inequality the true
one lies within D -+ (both rounding norms). Pairs whose lower bound is beyond the k-th best known
upper bound are out for good; the others are worked out again in double precision on the original
vectors and merged into each query's heap of the k best. So the result is exact: recall is 1.

Defined cases: vectors that are null, zero, or hold a null or non-finite component take no part;
vectors of different lengths aren't compared; a query's own row is no candidate, but others with its
id are; each row of a repeated query id has its own k results; ties go to the smaller id; rows with
a null id take no part; empty tables give an empty result. Only the two named columns are read.
"""

import math
from collections.abc import Iterator
from heapq import heappush, heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import load, saved

#: Components of a query block's vectors, and rows of a candidate block.
QUERY_NUMBERS, CANDIDATES = 1 << 21, 1 << 20
#: Rows of a matrix product on both sides.
QUERY_TILE, CANDIDATE_TILE = 512, 2048


class Block:
    """Vectors of one length with int8 codes, scales and rounding norms."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        self.rows, self.ids, self.vectors = rows, ids, vectors
        self.scale = np.abs(vectors).max(1) / 127
        self.scale[self.scale == 0] = 5e-324  # a subnormal largest component
        codes = np.rint(vectors / self.scale[:, None])
        self.lost = np.sqrt(((vectors - codes * self.scale[:, None]) ** 2).sum(1)) * (1 + 1e-9)
        self.codes = codes.astype(np.int8)
        self.square = (codes**2).sum(1) * self.scale**2

    def part(self, a: int, b: int) -> "Block":
        out = object.__new__(Block)
        for k, v in self.__dict__.items():
            setattr(out, k, v[a:b])
        return out


def tile_bounds(q: Block, c: Block) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all distances of a tile."""
    kind = np.float32 if q.codes.shape[1] <= 1040 else np.float64  # 127 * 127 * 1040 < 2 ** 24
    dot = (q.codes.astype(kind) @ c.codes.astype(kind).T).astype(np.float64)
    square = q.square[:, None] + c.square - 2 * dot * q.scale[:, None] * c.scale
    middle = np.sqrt(np.maximum(square, 0))
    # What rounding of doubles can do to `middle`: relative to the terms, and more near zero.
    slip = np.sqrt(1e-13 * (q.square[:, None] + c.square))
    away = q.lost[:, None] + c.lost + slip
    return middle - away, middle + away


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of row pairs, in double precision, components in order."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += (a[:, k] - b[:, k]) ** 2
    return np.sqrt(total)


class Best:
    """The k nearest so far of each query of a block, in a heap that has the farthest on top."""

    def __init__(self, queries: Block, k: int):
        self.queries, self.k = queries, k
        self.found: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
        self.reach = np.full(len(queries.ids), np.inf)

    def merge(self, lo: int, hi: int, c: Block) -> None:
        q, k = self.queries.part(lo, hi), self.k
        least, most = tile_bounds(q, c)
        own = q.rows[:, None] == c.rows
        most[own] = np.inf
        reach = self.reach[lo:hi]
        if c.ids.size > k:
            reach = np.minimum(reach, np.partition(most, k - 1, axis=1)[:, k - 1])
        rows, cols = np.nonzero((least <= reach[:, None]) & ~own)
        exact = distances(q.vectors[rows], c.vectors[cols])
        for n, far, i in zip((lo + rows).tolist(), (-exact).tolist(), c.ids[cols].tolist(), strict=True):
            heap = self.found[n]
            if len(heap) < k:
                heappush(heap, (far, -i))
            elif (far, -i) > heap[0]:
                heapreplace(heap, (far, -i))
        for n in set((lo + rows).tolist()):
            if len(self.found[n]) == k:
                self.reach[n] = -self.found[n][0][0]


def usable(vector: str) -> Column:
    """The vector is no null, has no null or non-finite component, and isn't zero."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)) & ~F.isnan(x))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _blocks(batches: list[pa.RecordBatch]) -> dict[int, Block]:
    """Blocks by the vectors' length."""
    t = pa.Table.from_batches(batches).combine_chunks()
    lengths = pc.list_value_length(t["vector"]).to_numpy()
    out = {}
    for n in np.unique(lengths):
        own = t if len(t) == (lengths == n).sum() else t.filter(pa.array(lengths == n))
        flat = pc.list_flatten(own["vector"]).to_numpy().astype(np.float64)
        out[int(n)] = Block(own["row"].to_numpy(), own["id"].to_numpy(), flat.reshape(-1, n))
    return out


def nearest(rows: DataFrame, wanted: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each row for which `wanted` holds.

    Rows are numbered once, in a written table. Queries and candidates are dealt to blocks by hash,
    and each pair of blocks is a tile that a task goes through with the queries held (at most
    QUERY_NUMBERS components) and the candidates streaming by, of which there are any number. So
    queries move once for each candidate block and candidates once for each query block; a tile
    gives k rows a query, which are merged by query. Nothing comes to the driver but counts.
    """
    spark = rows.sparkSession
    good = rows.filter(usable(vector) & F.col(vec_id).isNotNull())
    flat = good.select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(wanted, F.lit(False)).alias("asked"))
    flat = saved(flat, "vectors")
    n, n_asked, longest = flat.agg(F.count("*"), F.count_if("asked"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    q_blocks = max(1, math.ceil(n_asked * longest / QUERY_NUMBERS))
    c_blocks = max(1, math.ceil(n / CANDIDATES), min(math.ceil(tasks / q_blocks), n // CANDIDATE_TILE))
    mine = F.xxhash64("row")
    numbers = lambda k: F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long"))
    asked = flat.filter("asked").select(F.pmod(mine, F.lit(q_blocks)).alias("q_block"), F.explode(numbers(c_blocks)).alias("c_block"), F.lit(0).alias("side"), "row", "id", "vector")
    others = flat.select(F.explode(numbers(q_blocks)).alias("q_block"), F.pmod(mine, F.lit(c_blocks)).alias("c_block"), F.lit(1).alias("side"), "row", "id", "vector")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A tile's queries come first, then its candidates."""
        tile, held, best = None, [], None

        def told() -> Iterator[pa.RecordBatch]:
            for b in (best or {}).values():
                found = [(row, i, -near, -far) for row, i, heap in zip(b.queries.rows.tolist(), b.queries.ids.tolist(), b.found, strict=True) for far, near in heap]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found, strict=True)], names=["query_row", "query_id", "vec_id", "score"])

        for b in batches:
            if not b.num_rows:
                continue
            kind = np.stack([b[c].to_numpy().astype(np.int64) for c in ("q_block", "c_block", "side")], 1)
            cuts = [0, *(np.flatnonzero((kind[1:] != kind[:-1]).any(1)) + 1), b.num_rows]
            for x, y in zip(cuts, cuts[1:], strict=False):
                part = b.slice(x, y - x)
                if tile != tuple(kind[x, :2]):
                    yield from told()
                    tile, held, best = tuple(kind[x, :2]), [], None
                if not kind[x, 2]:
                    held.append(part)
                    continue
                if best is None:
                    best = {n: Best(block, k) for n, block in _blocks(held).items()} if held else {}
                for n, block in _blocks([part]).items() if best else ():
                    for a in range(0, len(block.ids) if n in best else 0, CANDIDATE_TILE):
                        for q in range(0, len(best[n].queries.ids), QUERY_TILE):
                            best[n].merge(q, min(q + QUERY_TILE, len(best[n].queries.ids)), block.part(a, a + CANDIDATE_TILE))
        yield from told()

    dealt = asked.union(others).repartition(max(tasks, q_blocks * c_blocks), "q_block", "c_block").sortWithinPartitions("q_block", "c_block", "side")
    out = dealt.mapInArrow(search, "query_row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy("score", "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every embedding whose vec_id is divisible by 100, among all others."""
    return nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP10_SQL = """
WITH e AS (SELECT row_number() OVER () AS row_no, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.row_no, q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS score
      FROM e q JOIN e c ON q.row_no <> c.row_no AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY row_no ORDER BY score, vec_id) AS INT) AS rank, vec_id, score FROM p
QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY score, vec_id) <= 10
"""
