"""Near-duplicate documents by a chosen-path similarity join over minwise tokens.

A document's set is its distinct n-word shingles. Documents of equal sets form a class, which has
a number of its own. In each of several independent trees, which have minwise coordinates of their
own and whose number follows from a target recall, a class starts at the root; a node picks two
minwise coordinates, and the class goes on to the children named by its own minwise tokens there.
Two sets of similarity s share each pick with probability s, so at 0.8 the 1.6 common children a
node are enough for a pair to stay together on some path almost surely, at any depth. Nodes of few
classes are compared exhaustively, by the Hamming distance of 256-bit sketches; large ones, by
classes or by shingles, branch on.

A node that hardly shrinks is a crowd of near copies and isn't branched any more. Its centre is the
class nearest to the majority of the sketches' bits; all its classes are compared with the centre,
which for copies of one text links nearly all of them at a cost that is linear in the crowd. Pairs
of classes that both link with the centre needn't be looked at; the rest is compared with the whole
crowd, block by block, so nothing is cut off.

Sketches only propose. Links are confirmed on full sets: in nodes where every class has few
proposals, pair by pair; in the others the full sets of the classes with proposals are brought
together, and a spanning forest of the links is given back, those with the commonest shingles
first, until all are in one component. No pairs of a crowd are listed.

Defined cases: null or empty texts, and texts of white space, have an empty set, link with nothing
and are kept; texts of fewer words than a shingle are one shingle; rows that share a doc_id are one
vertex, which links the classes of all its texts; null ids can't be linked: such rows get a null
component and are kept; repeated rows give a row each; an empty table gives an empty result. Only
the named columns are read.
"""

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, forget, load, saved, words
from .components import components

#: Minwise coordinates of a class for each tree, how many of them each level may pick from, and how
#: many of all trees' are sketched with 4 bits each.
COORDINATES, LEVEL, SKETCHED = 32, 16, 64
#: Nodes up to so many classes, and so many shingles of theirs, are compared exhaustively; a crowd's
#: blocks are of this size.
NODE, WEIGHT = 2000, 1 << 21
#: A child that keeps more than this share of its parent isn't branched any more.
CROWD = 0.5
#: Most levels; data of any size reach nodes of NODE classes or crowds before.
DEPTH = 12
#: Words known to a worker before it starts anew.
CACHE = 200_000

U = np.uint64


def functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of n minwise functions, from a fixed seed."""
    drawn = np.random.default_rng(20240229).integers(0, 1 << 63, (n, 2), dtype=np.uint64)
    return drawn[:, 0] | U(1), drawn[:, 1]


def trees_for(recall: float, similarity: float) -> int:
    """The independent trees after which a pair of this similarity is found with probability
    `recall`. A tree loses it with the extinction probability of a branching process whose two
    children survive with probability `similarity` each, the smaller root of q = (1 - s + s q)^2."""
    lost = ((1 - similarity) / similarity) ** 2
    return 1 if lost == 0 else max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over the whole."""
    x = (x ^ (x >> U(31))) * U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


class Shingles:
    """The sorted distinct 64-bit shingle hashes of a text."""

    def __init__(self, n: int):
        self.n, self.known = n, {}

    def __call__(self, text: str) -> np.ndarray:
        found, known = words(text), self.known
        if not found:
            return np.zeros(0, np.uint64)
        if len(known) > CACHE:
            known.clear()
        try:
            h = np.array([known[w] for w in found], np.uint64)
        except KeyError:
            for w in found:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            h = np.array([known[w] for w in found], np.uint64)
        n = min(self.n, len(h))
        out = mixed(h[: len(h) - n + 1])
        for k in range(1, n):
            out = mixed(out * U(3) + h[k : len(h) - n + 1 + k])
        return np.unique(out + U(n))


def minwise(sets: list[np.ndarray], trees: int) -> np.ndarray:
    """The minwise tokens (32 bits) of nonempty sets, a row each: COORDINATES for each tree, and
    SKETCHED at least."""
    multiply, add = functions(max(trees * COORDINATES, SKETCHED))
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), len(add)), np.uint32)
    for k in range(len(add)):
        out[:, k] = np.minimum.reduceat((flat * multiply[k] + add[k]) >> U(32), starts)
    return out


def signatures(docs: DataFrame, n: int, trees: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, ver (hash of the text), n_shingles, set_key (128 bits of the set; null: empty), minwise."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Shingles(n)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                sets = [find(t) for t in b["text"].to_pylist()]
                full = [s for s in sets if len(s)]
                rows = iter(minwise(full, trees) if full else ())
                keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                tokens = [next(rows).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([b["doc_id"], b["ver"], pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(tokens, pa.binary())], names=["doc_id", "ver", "n_shingles", "set_key", "minwise"])

    return _texts(docs, doc_id, text).mapInArrow(work, "doc_id long, ver long, n_shingles long, set_key binary, minwise binary")


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("ver"), body.alias("text"))


# ---- trees -----------------------------------------------------------------------------------

def sketches(tokens: np.ndarray) -> np.ndarray:
    """The low 4 bits of the first minwise tokens, packed: 4 64-bit numbers a row."""
    low = (tokens[:, :SKETCHED] & np.uint32(15)).astype(np.uint8)
    return np.ascontiguousarray(low[:, ::2] << 4 | low[:, 1::2])


def branch(paths: np.ndarray, tokens: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The two children of each row's node: what the node picks depends on its path alone."""
    h = mixed(paths + U(level))
    block = level % (COORDINATES // LEVEL) * LEVEL
    a = (h % U(LEVEL)).astype(np.int64)
    b = (a + 1 + ((h >> U(20)) % U(LEVEL - 1)).astype(np.int64)) % LEVEL
    row = np.arange(len(tokens))
    return tuple(mixed(paths * U(5) + mixed(tokens[row, block + c].astype(np.uint64) + (c.astype(np.uint64) << U(40)) + U(level))) for c in (a, b))


def _expanded(rows: DataFrame, levels: range, trees: int, roots: int = 0) -> DataFrame:
    """(path, parent, rep, weight, sketch, tree) so many levels below the rows' `path`, or below each of `roots`
    trees' roots. With no levels: the roots' own rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                tokens = np.frombuffer(b"".join(b["minwise"].to_pylist()), np.uint32).reshape(b.num_rows, -1)
                drawn = pa.array([x.tobytes() for x in sketches(tokens)], pa.binary())
                tokens = tokens[:, : trees * COORDINATES].reshape(-1, trees, COORDINATES)
                if roots:
                    heads = [(mixed(np.full(len(tokens), 977 * (t + 1), np.uint64)), np.full(len(tokens), t, np.int32)) for t in range(roots)]
                else:
                    heads = [(np.asarray(b["path"]).view(np.uint64), np.asarray(b["tree"]))]
                for head, tree in heads:
                    own = tokens[np.arange(len(tokens)), tree]
                    ends = [(head, head)]
                    for level in levels:
                        ends = [(child, path) for path, _ in ends for child in branch(path, own, level)]
                    for path, parent in ends:
                        yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(parent.view(np.int64)), b["rep"], b["weight"], drawn, pa.array(tree)], names=["path", "parent", "rep", "weight", "sketch", "tree"])

    return rows.mapInArrow(work, "path long, parent long, rep long, weight long, sketch binary, tree int")


def leaves(reps: DataFrame, trees: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of nodes to compare (path, rep, sketch, tile 0, side -1), and those of crowds
    (path, rep, weight, sketch, blocks), if there are any. reps: rep, weight, minwise.

    Only large nodes are counted out (a pre-aggregated count by path, joined back by path); the
    classes in them take their minwise tokens along for another level. A table of large nodes has
    at most rows / NODE rows.
    """
    total, heavy = reps.agg(F.count("*"), F.coalesce(F.sum("weight"), F.lit(0))).first()
    level = 0 if total <= NODE and heavy <= WEIGHT else 1
    rows = _expanded(reps, range(level), trees, trees if level else 1)
    parts, crowds, above = [], [], None
    while True:
        counts = rows.groupBy("path", "parent").agg(F.count("*").alias("n"), F.sum("weight").alias("all")).filter((F.col("n") > NODE) | ((F.col("n") > 1) & (F.col("all") > WEIGHT)))
        if above is None:
            counts = counts.withColumn("crowd", F.lit(False))
        else:
            counts = counts.join(above, "parent").withColumn("crowd", (F.col("n") > CROWD * F.col("above")) | F.lit(level >= DEPTH))
        blocks = F.ceil(F.greatest(F.col("n") / NODE, F.col("all") / WEIGHT)).cast("int")
        large = saved(counts.select(F.col("path").alias("node"), "n", "crowd", blocks.alias("blocks")), "large")
        at_node = F.col("path") == F.col("node")
        parts.append(rows.join(large, at_node, "left_anti").select("path", "rep", "sketch", F.lit(0).alias("tile"), F.lit(-1).alias("side")))
        kinds = {r[0] for r in large.select("crowd").distinct().collect()}
        if True in kinds:
            crowds.append(rows.join(large.filter("crowd"), at_node).select("path", "rep", "weight", "sketch", "blocks"))
        if False not in kinds:
            break
        on = saved(rows.join(large.filter("not crowd"), at_node).select("path", "rep", "tree"), "on")
        on = reps.join(broadcast_if_small(on), "rep")
        above = large.select(F.col("node").alias("parent"), F.col("n").alias("above"))
        rows = saved(_expanded(on, range(level, level + 1), trees), "rows")
        level += 1
    return reduce(DataFrame.unionByName, parts), saved(reduce(DataFrame.unionByName, crowds), "crowds") if crowds else None


# ---- crowds ----------------------------------------------------------------------------------


def centres(crowds: DataFrame) -> DataFrame:
    """(node, centre): of each crowd, the class whose sketch is nearest to the majority of bits."""
    n = int(crowds.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each path, how often each bit is set less how often it isn't, batch by batch."""
        for b in batches:
            if b.num_rows:
                paths, which = np.unique(b["path"].to_numpy(), return_inverse=True)
                votes = np.zeros((len(paths), 256), np.int64)
                bits = np.unpackbits(np.frombuffer(b"".join(b["sketch"].to_pylist()), np.uint8).reshape(-1, 32), axis=1)
                np.add.at(votes, which, 2 * bits.astype(np.int64) - 1)
                yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array([v.tobytes() for v in votes], pa.binary())], names=["path", "votes"])

    def majority(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by path; one path's sums are held."""
        key, held = None, None

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([np.packbits(held > 0).tobytes()], pa.binary())], names=["node", "middle"])

        for b in batches:
            for path, votes in zip(b["path"].to_pylist(), b["votes"].to_pylist(), strict=True):
                if path != key:
                    if key is not None:
                        yield told()
                    key, held = path, np.zeros(256, np.int64)
                held += np.frombuffer(votes, np.int64)
        if key is not None:
            yield told()

    def away(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b[c].to_pylist()), np.uint64).reshape(-1, 4) for c in ("sketch", "middle"))
            yield pa.RecordBatch.from_arrays([b["path"], b["rep"], pa.array(_close(x, y), pa.int16())], names=["path", "rep", "away"])

    votes = crowds.select("path", "sketch").mapInArrow(ones, "path long, votes binary")
    middles = votes.repartition(n, "path").sortWithinPartitions("path").mapInArrow(majority, "node long, middle binary")
    # A row for each crowd, of which there are at most rows / NODE.
    near = crowds.select("path", "rep", "sketch").join(broadcast_if_small(saved(middles, "middles")), F.col("path") == F.col("node")).mapInArrow(away, "path long, rep long, away short")
    return saved(near.groupBy(F.col("path").alias("node")).agg(F.min(F.struct("away", "rep"))["rep"].alias("centre")), "centres")


def rest_tiles(crowds: DataFrame, centred: DataFrame, linked: DataFrame) -> DataFrame | None:
    """Tiles (path, rep, sketch, tile, side) of the classes that don't link with their crowd's
    centre (side 0), in blocks, against the blocks of the whole crowd (side 1); None: no such class."""
    every = crowds.join(broadcast_if_small(centred), F.col("path") == F.col("node")).drop("node")
    ties = linked.select(F.col("a").alias("x"), F.col("b").alias("y"))
    alone = every.filter("rep <> centre").withColumn("x", F.least("rep", "centre")).withColumn("y", F.greatest("rep", "centre")).join(ties, ["x", "y"], "left_anti")
    alone = saved(alone.select("path", "rep", "weight", "sketch", "blocks"), "alone")
    if not alone.head(1):
        return None
    size = F.ceil(F.greatest(F.count("*") / NODE, F.sum("weight") / WEIGHT)).cast("int")
    many = broadcast_if_small(saved(alone.groupBy(F.col("path").alias("node")).agg(size.alias("own_blocks")), "many"))
    block = F.xxhash64("rep")
    left = alone.join(many, F.col("path") == F.col("node")).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    left = left.select("path", "rep", "sketch", (F.pmod(block, F.col("own_blocks")) * F.col("blocks") + F.col("other")).cast("int").alias("tile"), F.lit(0).alias("side"))
    right = crowds.join(many, F.col("path") == F.col("node")).select("*", F.explode(F.sequence(F.lit(0), F.col("own_blocks") - 1)).alias("mine"))
    right = right.select("path", "rep", "sketch", (F.col("mine") * F.col("blocks") + F.pmod(block, F.col("blocks"))).cast("int").alias("tile"), F.lit(1).alias("side"))
    return left.unionByName(right)


# ---- proposals -------------------------------------------------------------------------------


def _close(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(-1, dtype=np.int16)


def proposals(nodes: DataFrame, reach: int) -> DataFrame:
    """Rows (a, b, null, null, null): pairs of classes, a < b, whose sketches differ in at most
    `reach` bits, from nodes in which no class has more than FEW such partners. Rows (a, null, path,
    tile, side): the classes with partners in the other nodes.

    Each task holds one node, or tile, at a time: at most 2 * NODE sketches.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, columns in _groups(batches):
            yield from _pairs(group, columns, reach)

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = nodes.select("path", "tile", "side", "rep", "sketch").repartition(n, "path", "tile").sortWithinPartitions("path", "tile")
    return dealt.mapInArrow(work, "a long, b long, path long, tile int, side int").distinct()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, dict]]:
    """Runs of whole groups: (group number of each row, columns). The last group of a batch waits
    for the next one."""
    held: pa.Table | None = None

    def cut(t: pa.Table, upto: int) -> tuple[np.ndarray, dict]:
        part = t.slice(0, upto)
        path, tile = (part[c].to_numpy() for c in ("path", "tile"))
        new = np.concatenate([[True], (path[1:] != path[:-1]) | (tile[1:] != tile[:-1])])
        sketch = np.frombuffer(b"".join(part["sketch"].to_pylist()), np.uint64).reshape(-1, 4)
        return np.cumsum(new) - 1, {"path": path, "tile": tile, "rep": part["rep"].to_numpy(), "side": part["side"].to_numpy(), "sketch": sketch}

    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        path, tile = held["path"].to_numpy(), held["tile"].to_numpy()
        other = np.flatnonzero((path != path[-1]) | (tile != tile[-1]))
        if len(other):
            upto = int(other[-1]) + 1
            yield cut(held, upto)
            held = held.slice(upto)
    if held is not None and held.num_rows:
        yield cut(held, held.num_rows)


#: Groups up to this size are compared by shifts over all rows at once.
SMALL = 24
#: Partners up to which a node's classes are confirmed pair by pair.
FEW = 4


def _pairs(group: np.ndarray, c: dict, reach: int) -> Iterator[pa.RecordBatch]:
    size = np.bincount(group)
    small = size[group] <= SMALL
    rows = np.flatnonzero(small)
    if len(rows):
        g, i, j = group[rows], [], []
        for shift in range(1, int(size[size <= SMALL].max())):
            x = np.flatnonzero(g[shift:] == g[:-shift])
            if not len(x):
                break
            ok = _close(c["sketch"][rows[x]], c["sketch"][rows[x + shift]]) <= reach
            i.append(rows[x[ok]])
            j.append(rows[x[ok] + shift])
        if i:
            yield from _emitted(group, c, np.concatenate(i), np.concatenate(j))
    starts = np.concatenate([[0], np.cumsum(size)])
    for n in np.flatnonzero(size > SMALL):
        a, b = starts[n], starts[n + 1]
        s = c["sketch"][a:b]
        i, j = [], []
        for at in range(0, b - a, 256):
            x, y = np.nonzero(_close(s[at : at + 256, None], s[None]) <= reach)
            ok = y > x + at
            i.append(a + at + x[ok])
            j.append(a + y[ok])
        yield from _emitted(group, c, np.concatenate(i), np.concatenate(j))


def _emitted(group: np.ndarray, c: dict, i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
    side, rep = c["side"], c["rep"]
    ok = (rep[i] != rep[j]) & ((side[i] != side[j]) | (side[i] < 0))
    i, j = i[ok], j[ok]
    if not len(i):
        return
    partners = np.bincount(np.concatenate([i, j]), minlength=len(rep))
    most = np.zeros(group[-1] + 1, np.int64)
    np.maximum.at(most, group, partners)
    few = most[group[i]] <= FEW
    a, b = rep[i[few]], rep[j[few]]
    if len(a):
        none = [pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), *none], names=["a", "b", "path", "tile", "side"])
    crowd = np.flatnonzero((partners > 0) & (most[group] > FEW))
    if len(crowd):
        yield pa.RecordBatch.from_arrays([pa.array(rep[crowd]), pa.nulls(len(crowd), pa.int64()), pa.array(c["path"][crowd]), pa.array(c["tile"][crowd]), pa.array(side[crowd])], names=["a", "b", "path", "tile", "side"])


# ---- confirmation ----------------------------------------------------------------------------


def full_sets(named: DataFrame, docs: DataFrame, n: int, doc_id: str, text: str) -> DataFrame:
    """(rep, own) of the classes in `named` (rep, first_id, first_ver), made anew from the texts of
    the rows that stand for them. Texts don't move, unless there are too many classes to broadcast."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, done = Shingles(n), set()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                rows = [(r, t) for r, t in zip(b["rep"].to_pylist(), b["text"].to_pylist(), strict=True) if r not in done and not done.add(r)]
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int64()), pa.array([find(t).tobytes() for _, t in rows], pa.binary())], names=["rep", "own"])

    rows = _texts(docs, doc_id, text).join(broadcast_if_small(named), (F.col("doc_id") == F.col("first_id")) & (F.col("ver") == F.col("first_ver")))
    out = saved(rows.select("rep", "text").mapInArrow(sets, "rep long, own binary"), "sets")
    # Rows that repeat a class's first row in other tasks give its set again.
    return out if out.count() == named.count() else saved(out.dropDuplicates(["rep"]), "sets")


def confirmed_pairs(pairs: DataFrame, full: DataFrame, similarity: tuple[int, int], meet: Column | None = None) -> DataFrame:
    """The pairs (a, b), a first as the smaller one, whose sets are similar. One side travels to the
    other as a row a pair; a task goes through them in order and holds one set. `meet`: where a
    pair meets at a, and not at b."""
    up, down = similarity

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            out = []
            for a, b, own in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["own"].to_pylist(), strict=True):
                s = np.frombuffer(own, np.uint64)
                if b is None:
                    key, held = a, s
                elif a == key:
                    common = len(held) + len(s) - len(np.union1d(held, s))
                    if common * down >= up * (len(held) + len(s) - common):
                        out.append((min(a, b), max(a, b)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"])

    # Each pair meets at the class named by a coin, so that a class with many pairs holds half of them.
    coin = F.pmod(F.xxhash64("a", "b"), F.lit(2)) == 0 if meet is None else meet
    turned = pairs.select(F.when(coin, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(coin, F.col("b")).otherwise(F.col("a")).alias("b"))
    travel = turned.join(full, F.col("b") == F.col("rep")).select("a", "b", "own")
    there = full.join(turned.select(F.col("a").alias("rep")).distinct(), "rep", "left_semi").select(F.col("rep").alias("a"), F.lit(None).cast("long").alias("b"), "own")
    k = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = there.union(travel).repartition(k, "a").sortWithinPartitions("a", F.col("b").asc_nulls_first())
    return dealt.mapInArrow(compare, "a long, b long").distinct()


#: Places of the matrix that a node's sets are laid against each other by (64 MB), and sets tried at once.
MATRIX, TRIED = 1 << 24, 128


def forest(sets: list[np.ndarray], tried: np.ndarray, similarity: tuple[int, int]) -> list[tuple[int, int]]:
    """A spanning forest (pairs of places) of the similar pairs of nonempty sets of which at least
    one is `tried`. A set that is tried is laid against all others at once, those of the commonest
    shingles first, until all are in one component: the first ones by marking their shingles, then,
    where the shingles that two sets or more have are few, many by one matrix product."""
    up, down = similarity
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    _, which = np.unique(np.concatenate(sets), return_inverse=True)
    held_by = np.bincount(which)
    central = np.add.reduceat(held_by[which], starts) / sizes
    label, out = np.arange(len(sets)), []
    rows = np.flatnonzero(tried)
    rows = rows[np.argsort(-central[rows], kind="stable")]

    def link(i: int, common: np.ndarray) -> None:
        alike = np.flatnonzero((label != label[i]) & (common * down >= up * (sizes[i] + sizes - common)))
        new, first = np.unique(label[alike], return_index=True)
        out.extend((int(i), int(alike[j])) for j in first)
        label[np.isin(label, new)] = label[i]

    shared = held_by > 1
    width = int(shared.sum())
    few = len(sets) * width <= min(MATRIX, 25 * len(which))
    marks, done = np.zeros(len(held_by), np.int32), 0
    for i in rows[: 8 if few else len(rows)]:
        if (label == label[i]).all():
            return out
        mine = which[starts[i] : starts[i] + sizes[i]]
        marks[mine] = 1
        link(i, np.add.reduceat(marks[which], starts))
        marks[mine] = 0
        done += 1
    if done < len(rows):
        column, of = np.cumsum(shared) - 1, np.repeat(np.arange(len(sets)), sizes)
        own = shared[which]
        table = np.zeros((len(sets), width), np.float32)  # counts stay exact in it
        table[of[own], column[which[own]]] = 1
        for at in range(done, len(rows), TRIED):
            if (label == label[0]).all():
                break
            some = rows[at : at + TRIED]
            for i, common in zip(some, (table[some] @ table.T).astype(np.int64), strict=True):
                link(i, common)
    return out


def confirmed_crowds(members: DataFrame, full: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """A spanning forest (a, b) of the similar pairs within each node of members(rep, path, tile,
    side); in tiles, of the pairs with side 0. Each task holds the full sets of one node, or tile,
    at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, reps, sides, sets = None, [], [], []

        def links() -> Iterator[pa.RecordBatch]:
            found = forest(sets, np.array(sides) <= 0, similarity) if len(reps) > 1 else []
            ends = [sorted((reps[i], reps[j])) for i, j in found if reps[i] != reps[j]]
            if ends:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in ends], pa.int64()), pa.array([y for _, y in ends], pa.int64())], names=["a", "b"])

        for b in batches:
            for path, tile, rep, side, own in zip(*(b[c].to_pylist() for c in ("path", "tile", "rep", "side", "own")), strict=True):
                if (path, tile) != key:
                    yield from links()
                    key, reps, sides, sets = (path, tile), [], [], []
                reps.append(rep)
                sides.append(side)
                sets.append(np.frombuffer(own, np.uint64))
        yield from links()

    k = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.join(full, "rep").select("path", "tile", "rep", "side", "own").repartition(k, "path", "tile").sortWithinPartitions("path", "tile")
    return dealt.mapInArrow(work, "a long, b long").distinct()


def shared_ids(some: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(shared, rep): the classes of each id that has several, or one beside an empty set; None: no
    such id. some: doc_id, set_key."""
    key = F.coalesce("set_key", F.lit(b""))
    ids = saved(some.groupBy(F.col("doc_id").alias("shared")).agg(F.min(key).alias("x"), F.max(key).alias("y")).filter("x <> y").select("shared"), "ids")
    if not ids.head(1):
        return None
    own = some.join(broadcast_if_small(ids), F.col("doc_id") == F.col("shared")).select("shared", "set_key").distinct()
    return saved(own.join(classes.select("set_key", "rep"), "set_key").select("shared", "rep"), "shared")


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: tuple[int, int] = (80, 100), recall: float = 0.9997, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row for each row of `docs`. The trees find a pair
    of just this similarity with probability `recall`."""
    trees = trees_for(recall, similarity[0] / similarity[1])
    every = saved(signatures(docs, shingle, trees, doc_id, text), "signatures")
    some = every.filter("doc_id is not null")
    best = F.min(F.struct("doc_id", "ver", "n_shingles", "minwise")).alias("m")
    grouped = some.filter("set_key is not null").groupBy("set_key").agg(best)
    grouped = grouped.select("set_key", F.col("m.doc_id").alias("first_id"), F.col("m.ver").alias("first_ver"), F.col("m.n_shingles").alias("weight"), F.col("m.minwise").alias("minwise"))
    classes = saved(grouped.withColumn("rep", F.monotonically_increasing_id()), "classes")
    nodes, crowds = leaves(classes.select("rep", "weight", "minwise"), trees)
    # 2 bits a differing coordinate are expected, at most 4; 6 standard deviations beyond the
    # expectation at the wanted similarity.
    s = similarity[0] / similarity[1]
    reach = math.ceil(2 * SKETCHED * (1 - s) + 6 * math.sqrt(SKETCHED * (4 * s * (1 - s) + (1 - s))))

    spent = []

    def sets_of(reps: DataFrame) -> DataFrame:
        named = saved(reps.distinct().join(classes.select("rep", "first_id", "first_ver"), "rep"), "named")
        spent.extend([named, full := full_sets(named, docs, shingle, doc_id, text)])
        return full

    def confirmed(rows: DataFrame, full: DataFrame | None = None) -> DataFrame:
        spent.append(found := saved(proposals(rows, reach), "proposals"))
        pairs, members = found.filter("b is not null").select("a", "b"), found.filter("b is null").select(F.col("a").alias("rep"), "path", "tile", "side")
        if full is None:
            full = sets_of(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).union(members.select("rep")))
        return confirmed_pairs(pairs, full, similarity).union(confirmed_crowds(members, full, similarity))

    links = confirmed(nodes)
    if crowds is not None:
        centred = centres(crowds)
        full = sets_of(crowds.select("rep"))
        stars = crowds.join(broadcast_if_small(centred), F.col("path") == F.col("node")).select(F.col("rep").alias("a"), F.col("centre").alias("b")).filter("a <> b").distinct()
        linked = saved(confirmed_pairs(stars, full, similarity, meet=F.lit(True)), "stars")
        tiles = rest_tiles(crowds, centred, linked)
        links = links.union(linked) if tiles is None else links.union(linked).union(confirmed(tiles, full))
    shared = shared_ids(some, classes)
    if shared is not None:
        least = shared.groupBy(F.col("shared").alias("id")).agg(F.min("rep").alias("a"))
        links = links.union(shared.join(least, F.col("shared") == F.col("id")).select("a", F.col("rep").alias("b")))
    labels = components(links)
    for table in spent:
        forget(table)
    own = classes.select("set_key", "rep", "first_id").join(labels, F.col("rep") == F.col("vertex"), "left").withColumn("label", F.coalesce("component", "rep"))
    least = own.filter("component is not null").groupBy(F.col("label").alias("at")).agg(F.min("first_id").alias("least"))
    named = own.join(least, F.col("label") == F.col("at"), "left").select("set_key", "rep", F.coalesce("least", "first_id").alias("component_id"))
    rows = every.select("doc_id", "n_shingles", "set_key").join(named.drop("rep").withColumnRenamed("set_key", "key"), F.col("set_key") == F.col("key"), "left")
    component = F.coalesce("component_id", "doc_id")
    if shared is not None:  # the rows of such an id, also that of an empty set, are one vertex
        vertex = shared.join(named.withColumnRenamed("component_id", "of_class"), "rep").groupBy("shared").agg(F.min("of_class").alias("of_id"))
        rows, component = rows.join(vertex, F.col("doc_id") == F.col("shared"), "left"), F.coalesce("of_id", "component_id", "doc_id")
    out = rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, 2-word shingles, similarity 0.8."""
    return near_duplicates(load(spark, sf_dir, "documents"), shingle=2)
