"""Language-model scores from a log-frequency Bloom filter.

Counts of words, word pairs and triples in the training texts are quantised on a logarithmic scale:
level q stands for counts from BASE^(q-1) up to BASE^q. An n-gram of level q is put into the filter
q times, as (n-gram, 1) ... (n-gram, q); to look a count up, membership of (n-gram, 1), (n-gram, 2),
... is probed until the first miss. The filter is cut into slices by hash, each built by one task,
of 8 bits an entry at any size; the number of slices grows with the texts.

Of texts whose filter takes up to MAX_BITS it is broadcast whole. A larger one never leaves the tasks
that build its slices: workers send each slice the distinct n-grams of a chunk of texts, with their
counts in training texts; the task puts the counts into the slice's filter, looks all its n-grams up
there and sends their levels back, for words their exact counts, too. Texts are tokenised once and
n-grams sent once. Both ways give the same counts, and so the same scores.

A word's probability is interpolated: with a history h that occurs c(h) times and gives the word
c(hw) times, it is s * (c(hw) - d) / c(h) + (1 - s) * (that of the shorter history), where
s = SHARE * c(h) / (c(h) + 1) and d = DISCOUNT, by order; without a history it is
p(w) = (c(w) + 1) / (N + V + 1). All counts are the filter's. Shares and discounts were chosen by
the likelihood of held-out texts. An n-gram that occurs once says little, one that comes again much.

The base score needs exact counts of words. Where the filter is broadcast, so are those of the most
frequent words, at most COMMON; each document's other words are joined to the whole table of counts.

Defined cases: null and empty texts are their end alone, one token; null ids are not held out and
learnt from; repeated rows are learnt from and scored each; without training text all counts are 0;
an empty table gives an empty result. Only the named columns are read.
"""

import gc
import math
import struct
import time
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_remainder, load, saved, words

U = np.uint64
BASE, PROBES, BITS_AN_ENTRY = 1.5, 4, 8
#: A filter up to this size is broadcast: 8 MB. A byte of text takes about 3 bits of it.
MAX_BITS, BITS_A_BYTE = 1 << 26, 4
#: Bytes of texts whose n-grams make about one slice, where that gives more slices than 4 a task.
SLICE_BYTES = 64 << 20
#: Words whose exact counts are broadcast: 16 bytes each.
COMMON = 1 << 20
#: Bits of an n-gram's hash, by order, what a longer history weighs and what is taken off its counts.
WIDTH, SHARE, DISCOUNT = (64, 48, 48), (0.0, 0.4, 0.8), (0.0, 0.5, 0.8)
#: Tokens that a worker scores at once, and counts at once.
CHUNK, COUNTED = 1 << 17, 1 << 20
CACHE = 200_000
START, END = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over the whole."""
    x = (x ^ (x >> U(31))) * U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


class Tokens:
    """Token hashes of texts, in chunks of whole texts."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, text: str) -> np.ndarray:
        found, known = words(text), self.known
        if len(known) > CACHE:
            known.clear()
        for w in set(found).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        out = np.empty(len(found) + 1, np.uint64)
        out[:-1] = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        out[-1] = END
        return out

    def chunks(self, batch: pa.RecordBatch, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, row after the last, tokens, number of tokens of each row)."""
        first, held, size = 0, [], 0
        texts = (t for at in range(0, batch.num_rows, 128) for t in batch.slice(at, 128)["text"].to_pylist())
        for n, t in enumerate(texts):
            held.append(self.of(t))
            size += len(held[-1])
            if size >= most:
                yield first, n + 1, np.concatenate(held), np.array([len(h) for h in held])
                first, held, size = n + 1, [], 0
        if held:
            yield first, batch.num_rows, np.concatenate(held), np.array([len(h) for h in held])


def grams(tokens: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The hashes of each token, of the token with the one before it and with the two before it;
    START stands before a text's first token."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = START
    pair = mixed(before * U(3) + tokens)
    earlier = np.empty_like(tokens)
    earlier[1:] = pair[:-1]
    earlier[starts] = START
    return [tokens, pair >> U(16), mixed(earlier * U(5) + tokens) >> U(16)]


def slice_of(h: np.ndarray, slices: int, order: int) -> np.ndarray:
    return ((h >> U(WIDTH[order - 1] - 32)) * U(slices) >> U(32)).astype(np.int64)


def packed(h: np.ndarray, order: int) -> bytes:
    """Hashes in as many bytes as they have."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : WIDTH[order - 1] // 8].tobytes()


def unpacked(data: bytes, order: int) -> np.ndarray:
    n = WIDTH[order - 1] // 8
    out = np.zeros((len(data) // n, 8), np.uint8)
    out[:, :n] = np.frombuffer(data, np.uint8).reshape(-1, n)
    return out.view("<u8").ravel().astype(np.uint64)


@cache
def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def tight(x: np.ndarray) -> bytes:
    """Whole numbers in as many bytes each as the largest takes, all first bytes before all second
    ones; from 1 KB on compressed. How many, of how many bytes and whether compressed comes first."""
    n = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    data = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T.tobytes()
    small = len(data) < 1024
    return struct.pack("<QBB", len(x), n, small) + (data if small else _codec().compress(data, asbytes=True))


def loose(data: bytes) -> np.ndarray:
    size, n, small = struct.unpack_from("<QBB", data)
    out = np.zeros((size, 8), np.uint8)
    out[:, :n] = np.frombuffer(data[10:] if small else _codec().decompress(data[10:], size * n, asbytes=True), np.uint8).reshape(n, size).T
    return out.view("<u8").ravel().astype(np.uint64, copy=False)


def steps(h: np.ndarray, drop: int) -> bytes:
    """Rising hashes, whose last `drop` bits are 0, by what each is above the one before it."""
    h = h >> U(drop)
    return h[:1].astype("<u8").tobytes() + tight(np.diff(h))


def summed(data: bytes, drop: int) -> np.ndarray:
    return np.cumsum(np.concatenate([np.frombuffer(data, "<u8", 1).astype(np.uint64), loose(data[8:])]), dtype=np.uint64) << U(drop)


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def typical(q: int) -> float:
    """The mean of the whole numbers of level q; its lower end where it has none."""
    low, high = math.ceil(BASE ** (q - 1) - 1e-9), math.ceil(BASE**q - 1e-9) - 1
    return (low + high) / 2 if high >= low else BASE ** (q - 1)


def places(h: np.ndarray, j: int, bits: np.ndarray | int) -> Iterator[np.ndarray]:
    for i in range(PROBES):
        yield mixed(h + U((j * PROBES + i) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % bits


def slice_filter(h: np.ndarray, n: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """(entries, largest level, bits, data) of the filter of n-grams h that occur n times each."""
    q = level(n)
    entries, top = int(q.sum()), int(q.max(initial=0))
    bits = max(64, BITS_AN_ENTRY * entries)
    marks = np.zeros(bits, bool)
    for j in range(1, top + 1):
        for x in places(h[q >= j], j, U(bits)):
            marks[x.astype(np.int64)] = True
    return entries, top, bits, np.packbits(marks, bitorder="little")


def put_together(model: DataFrame, order: int, slices: int) -> tuple:
    """What Filter takes, from an order's slices: plain values that can be broadcast. The slices
    come to the driver one by one, into one buffer."""
    own = model.filter(F.col("order") == order)
    sizes = {r["slice"]: (r["bits"], r["top"]) for r in own.select("slice", "bits", "top").collect()}
    bits, at, place = np.ones(slices, np.uint64), np.zeros(slices, np.uint64), 1
    for s, (n, _) in sorted(sizes.items()):
        bits[s], at[s] = n, 8 * place
        place += n // 8
    data = np.zeros(place, np.uint8)  # a slice without entries reads the zero bit at its beginning
    for r in own.select("slice", "data").toLocalIterator():
        start = int(at[r["slice"]]) // 8
        data[start : start + len(r["data"])] = np.frombuffer(r["data"], np.uint8)
    return order, slices, bits, at, data, max([0, *(top for _, top in sizes.values())])


class Filter:
    """One order's filter, or a slice of it."""

    def __init__(self, order: int, slices: int, bits: np.ndarray, at: np.ndarray, data: np.ndarray, top: int):
        self.order, self.slices, self.bits, self.at, self.data, self.top = order, slices, bits, at, data, top

    def levels(self, h: np.ndarray) -> np.ndarray:
        """Levels, by probing one after another until a miss; 0 for what isn't there."""
        q, alive, s = np.zeros(len(h), np.uint8), np.arange(len(h)), slice_of(h, self.slices, self.order)
        bits, at = self.bits[s], self.at[s]
        for j in range(1, self.top + 1):
            for i in range(PROBES):
                x = mixed(h[alive] + U((j * PROBES + i) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % bits[alive] + at[alive]
                alive = alive[(self.data[(x >> U(3)).astype(np.int64)] >> (x & U(7)).astype(np.uint8)) & 1 > 0]
            if not len(alive):
                break
            q[alive] = j
        return q


#: Counts by level.
COUNTS = np.array([0.0] + [typical(q) for q in range(1, 120)])


def log_p(counts: list[np.ndarray], sizes: np.ndarray, n_docs: int, total: int, types: int) -> np.ndarray:
    """log10 of each token's probability, from the counts of its n-grams of each order."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    p = (counts[0] + 1) / (total + types + 1)
    for k in (1, 2):
        history = np.empty(len(p))
        history[1:] = counts[k - 1][:-1]  # that of the n-gram that ends one token earlier
        history[starts] = n_docs
        share = SHARE[k] * history / (history + 1)
        p = share * np.maximum(np.minimum(counts[k], history) - DISCOUNT[k], 0) / np.maximum(history, 1) + (1 - share) * p
    return np.log10(np.minimum(p, 1.0))


def counted(train: DataFrame, slices: int) -> DataFrame:
    """Exact n-gram counts and filters, a row for each order and slice: order, slice, types, tokens,
    entries, top (largest level), bits, data (the filter), hashes and counts (words only), above
    (words with at least 2^i occurrences, for each i).

    Workers count in chunks and send each slice its sorted hashes and counts as one value, so the
    exchange moves a few large rows, pre-aggregated; a task merges one slice at a time.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, size = Tokens(), ([], [], []), 0

        def flush() -> Iterator[pa.RecordBatch]:
            for order, parts in enumerate(held, 1):
                h, n = np.unique(np.concatenate(parts), return_counts=True)
                parts.clear()
                cut = np.searchsorted(slice_of(h, slices, order), np.arange(slices + 1))
                full = [s for s in range(slices) if cut[s] < cut[s + 1]]
                for at in range(0, len(full), 16):
                    some = full[at : at + 16]
                    cols = [pa.array([order] * len(some), pa.int32()), pa.array(some, pa.int32())]
                    cols.append(pa.array([packed(h[cut[s] : cut[s + 1]], order) for s in some], pa.binary()))
                    cols.append(pa.array([n[cut[s] : cut[s + 1]].astype(np.uint32).tobytes() for s in some], pa.binary()))
                    yield pa.RecordBatch.from_arrays(cols, names=["order", "slice", "hashes", "counts"])

        for b in batches:
            for _, _, tokens, sizes in own.chunks(b, CHUNK):
                for parts, h in zip(held, grams(tokens, sizes), strict=True):
                    parts.append(h)
                size += len(tokens)
                if size >= COUNTED:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        fields = [("order", pa.int32()), ("slice", pa.int32()), ("types", pa.int64()), ("tokens", pa.int64()), ("entries", pa.int64()), ("top", pa.int32()), ("bits", pa.int64()), ("data", pa.binary()), ("hashes", pa.binary()), ("counts", pa.binary()), ("above", pa.list_(pa.int64()))]

        def built(order: int, s: int, parts: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
            h = np.concatenate([unpacked(x, order) for x, _ in parts])
            n = np.concatenate([np.frombuffer(x, np.uint32) for _, x in parts]).astype(np.int64)
            by = np.argsort(h, kind="stable")
            h, n = h[by], n[by]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            h, n = h[first], np.add.reduceat(n, first)
            entries, top, bits, data = slice_filter(h, n)
            one = order == 1
            above = [int((n >= 1 << i).sum()) if one else 0 for i in range(48)]
            row = {"order": order, "slice": s, "types": len(h), "tokens": int(n.sum()), "entries": entries, "top": top, "bits": bits, "data": data.tobytes(), "hashes": h.tobytes() if one else None, "counts": n.astype(np.uint64).tobytes() if one else None, "above": above}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema(fields))

        for b in batches:
            for order, s, h, n in zip(*(b[c].to_pylist() for c in ("order", "slice", "hashes", "counts")), strict=True):
                if key != (order, s):
                    if held:
                        yield built(*key, held)
                    key, held = (order, s), []
                held.append((h, n))
        if held:
            yield built(*key, held)

    parts = train.select("text").mapInArrow(count, "order int, slice int, hashes binary, counts binary")
    n = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.repartition(n, "order", "slice").sortWithinPartitions("order", "slice")
    return saved(dealt.mapInArrow(merge, "order int, slice int, types long, tokens long, entries long, top int, bits long, data binary, hashes binary, counts binary, above array<long>"), "ngrams")


def word_counts(model: DataFrame, least: int, most: int) -> DataFrame:
    """(h, c) of the words that occur `least` up to below `most` times."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y in zip(b["hashes"].to_pylist(), b["counts"].to_pylist(), strict=True):
                h, n = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                ok = (n >= least) & (n < most)
                yield pa.RecordBatch.from_arrays([pa.array(h[ok]), pa.array(n[ok])], names=["h", "c"])

    return model.filter("order = 1").select("hashes", "counts").mapInArrow(rows, "h long, c long")


def sorted_places(h: np.ndarray, drop: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in order, and where they stood. One sort of numbers, if both fit into 64 bits."""
    at = max(1, len(h) - 1).bit_length()
    if not drop or at > 16 + drop:
        by = np.argsort(h, kind="stable")
        return h[by], by
    both = np.sort((h >> U(drop)) << U(at) | np.arange(len(h), dtype=np.uint64))
    return (both >> U(at)) << U(drop), (both & U((1 << at) - 1)).astype(np.int64)


def exchanged_scores(rows: DataFrame, slices: int, n_docs: int, n_bytes: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    rows(doc_id, text, held_out) by a filter that stays in its slices.

    A chunk of texts sends its distinct n-grams and counts to the slices (order 1 to 3) and goes
    past them itself (order 0): its rows and the order of its words. A slice sends levels back, of
    words exact counts (order 4) and hashes (order 5), too. Pairs and triples keep 10 bits more than the texts have bytes,
    from 40 to 48, so that one in a thousand at most shares its hash.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    drop = 48 - min(48, max(40, n_bytes.bit_length() + 10))
    drops = (0, drop, drop)
    kind = rows.schema["doc_id"].dataType.simpleString()
    names, types = ["chunk", "order", "slice", "part", "counts"], (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, chunk, held, size = Tokens(), TaskContext.get().partitionId() << 32, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            tokens, sizes = (np.concatenate([h[k] for h in held]) for k in (1, 2))
            told = pa.Table.from_batches([h[0] for h in held]).append_column("size", pa.array(sizes))
            train = np.repeat(~told["held_out"].to_numpy(), sizes)
            held.clear()
            kinds, which = np.unique(tokens, return_inverse=True)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, told.schema) as w:
                w.write_table(told)
            out = [(chunk, 0, k, part, None) for k, part in enumerate((sink.getvalue().to_pybytes(), tight(which)))]
            for order, h in enumerate(grams(tokens, sizes), 1):
                if order == 1:
                    c = np.bincount(which[train], minlength=len(kinds))
                else:  # training or not is the last bit of what is sorted
                    h = np.sort((h >> U(drop)) << U(1) | train)
                    first = np.flatnonzero(np.concatenate([[True], h[1:] >> U(1) != h[:-1] >> U(1)]))
                    c = np.add.reduceat(h & U(1), first)
                    kinds = (h[first] >> U(1)) << U(drop)
                cut = np.searchsorted(slice_of(kinds, slices, order), np.arange(slices + 1))
                for s in np.flatnonzero(cut[1:] > cut[:-1]):
                    some = slice(cut[s], cut[s + 1])
                    out.append((chunk, order, s, steps(kinds[some], drops[order - 1]), tight(c[some])))
            for at in range(0, len(out), 64):
                yield batch(out[at : at + 64])

        for b in batches:
            for first, after, tokens, sizes in own.chunks(b, CHUNK):
                held.append((b.select(["doc_id", "held_out"]).take(pa.array(range(first, after))), tokens, sizes))  # a copy: texts can go
                size += len(tokens)
                if size >= COUNTED:
                    yield from flush()
                    chunk, size = chunk + 1, 0
        if held:
            yield from flush()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def answered() -> Iterator[pa.RecordBatch]:
            order, s = key
            parts = [summed(x, drops[order - 1]) for _, x, _ in held]
            c = np.concatenate([loose(x) for *_, x in held])
            h, by = sorted_places(np.concatenate(parts), drops[order - 1])
            first = np.concatenate([[True], h[1:] != h[:-1]])
            h, c = h[first], np.add.reduceat(c[by], np.flatnonzero(first)).astype(np.int64)
            there = c > 0
            _, top, bits, data = slice_filter(h[there], c[there])
            q = Filter(order, 1, np.array([bits], np.uint64), np.zeros(1, np.uint64), data, top).levels(h)
            which = np.empty(len(by), np.int64)
            which[by] = np.cumsum(first) - 1
            out, at = [], 0
            if order == 1:
                out.append((None, 1, s, None, tight(np.array([there.sum(), c.sum()]))))
            for (chunk, sent, _), p in zip(held, parts, strict=True):
                own = which[at : at + len(p)]
                out.append((chunk, order, s, tight(q[own]), None))
                if order == 1:
                    out += [(chunk, 4, s, tight(c[own]), None), (chunk, 5, s, sent, None)]
                at += len(p)
            held.clear()
            for at in range(0, len(out), 256):
                yield batch(out[at : at + 256])

        for b in batches:
            for chunk, order, s, part, counts in zip(*(b[c].to_pylist() for c in names), strict=True):
                if order == 0:
                    yield batch([(chunk, order, s, part, None)])
                    continue
                if key != (order, s):
                    if held:
                        yield from answered()
                    key = order, s
                held.append((chunk, part, counts))
        if held:
            yield from answered()

    schema = "chunk long, order int, slice int, part binary, counts binary"
    asked = rows.select("doc_id", "held_out", "text").mapInArrow(ask, schema)
    # What goes past the slices is dealt out by chunk.
    dealt = asked.repartition(n, "order", F.when(F.col("order") == 0, F.col("chunk")).otherwise(F.col("slice"))).sortWithinPartitions("order", "slice")
    answers = saved(dealt.mapInArrow(answer, schema), "answers")
    sums = [loose(bytes(r["counts"])) for r in answers.filter("chunk is null").select("counts").collect()]  # a row a slice
    del asked, dealt
    for _ in range(2):  # Spark deletes the exchange's files, which nothing needs now; listeners let go of a query a little later
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(1)
    kinds_, total = (sum(int(x[k]) for x in sums) for k in (0, 1))
    below, learnt = math.log10(total + kinds_ + 1), (n_docs, total, kinds_)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A chunk's own rows come first, then its answers by order and slice, which is the hashes' order."""
        key, own = None, {k: [] for k in range(6)}

        def told() -> pa.RecordBatch:
            docs = pa.ipc.open_stream(own[0][0]).read_all().combine_chunks()
            sizes = docs["size"].to_numpy()
            which = loose(own[0][1]).astype(np.int64)
            *levels, exact = (np.concatenate([loose(x) for x in own[k]]).astype(np.int64) for k in (1, 2, 3, 4))
            kinds = np.concatenate([summed(x, 0) for x in own[5]])
            counts = [COUNTS[levels[0]][which]]
            for h, q in zip(grams(kinds[which], sizes)[1:], levels[1:], strict=True):
                h, at = sorted_places((h >> U(drop)) << U(drop), drop)
                c = np.empty(len(h))
                c[at] = COUNTS[q][np.cumsum(np.concatenate([[False], h[1:] != h[:-1]]))]
                counts.append(c)
            starts = np.cumsum(sizes) - sizes
            sums = [np.add.reduceat(x, starts) for x in ((exact > 0).astype(np.int64)[which], (np.log10(exact + 1.0) - below)[which], log_p(counts, sizes, *learnt))]
            cols = [docs["doc_id"], docs["held_out"], docs["size"]]
            cols = [c.chunk(0) for c in cols] + [pa.array(x) for x in sums]
            return pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

        for b in batches:
            for chunk, order, part in zip(*(b[c].to_pylist() for c in names[:1] + names[1:2] + names[3:4]), strict=True):
                if chunk != key:
                    if key is not None:
                        yield told()
                    key, own = chunk, {k: [] for k in range(6)}
                own[order].append(part)
        if key is not None:
            yield told()

    home = answers.filter("chunk is not null").select("chunk", "order", "slice", "part").repartition(n, "chunk").sortWithinPartitions("chunk", "order", "slice")
    out = home.mapInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def scores(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; learns
    from those for which the condition `held_out` is false."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), held_out.alias("held_out"))
    train = rows.filter(~F.col("held_out"))
    n_docs, n_bytes = train.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    whole = BITS_A_BYTE * n_bytes <= MAX_BITS
    slices = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / SLICE_BYTES))
    if not whole:
        every = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        return exchanged_scores(rows, slices, n_docs, every)
    model = counted(train, slices)
    above = [F.coalesce(F.sum(F.get("above", i)), F.lit(0)) for i in range(48)]
    first = F.col("order") == 1
    told = model.agg(*[F.coalesce(F.sum(F.when(first, F.col(c))), F.lit(0)) for c in ("types", "tokens")], *above).first()
    types, total = told[:2]
    power = next(i for i in range(48) if told[2 + i] <= COMMON)
    common = word_counts(model, 1 << power, 1 << 62).toArrow()  # at most COMMON rows
    h, c = common["h"].to_numpy().view(np.uint64), common["c"].to_numpy()
    order = np.argsort(h)
    held = spark.sparkContext.broadcast(([put_together(model, k, slices) for k in (1, 2, 3)], h[order], c[order]))
    below, learnt = math.log10(total + types + 1), (n_docs, total, types)
    numbered = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "held_out", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (filters, known, exact), own = held.value, Tokens()
        filters = [Filter(*f) for f in filters]
        for b in batches:
            for first, after, tokens, sizes in own.chunks(b, CHUNK):
                starts = np.cumsum(sizes) - sizes
                kinds, which = np.unique(tokens, return_inverse=True)
                counts = [COUNTS[filters[0].levels(kinds)][which]]  # by probes, for each distinct n-gram of the chunk once
                for f, h in zip(filters[1:], grams(tokens, sizes)[1:], strict=True):
                    some, of = np.unique(h, return_inverse=True)
                    counts.append(COUNTS[f.levels(some)][of])
                score = np.add.reduceat(log_p(counts, sizes, *learnt), starts)
                # The base score, as far as words are common.
                if len(known):
                    at = np.minimum(np.searchsorted(known, kinds), len(known) - 1)
                    hit = known[at] == kinds
                    c = np.where(hit, exact[at], 0)
                else:
                    hit, c = np.zeros(len(kinds), bool), np.zeros(len(kinds), np.int64)
                base = np.where(hit, np.log10(c + 1.0) - below, 0.0)
                sums = [np.add.reduceat(x[which], starts) for x in (hit.astype(np.int64), base)]
                # Each row's other words, with their numbers.
                rare = np.flatnonzero(~hit[which])
                row = np.searchsorted(starts, rare, side="right") - 1
                code, n_rare = np.unique(np.stack([row.astype(np.uint64), tokens[rare]], 1), axis=0, return_counts=True) if len(rare) else (np.zeros((0, 2), np.uint64), np.zeros(0, np.int64))
                cut = np.searchsorted(code[:, 0], np.arange(len(sizes) + 1).astype(np.uint64)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x)) for x in (code[:, 1].copy().view(np.int64), n_rare.astype(np.int32))]
                part = b.slice(first, after - first)
                yield pa.RecordBatch.from_arrays([part["row"], part["doc_id"], part["held_out"], pa.array(sizes.astype(np.int64)), *map(pa.array, sums), pa.array(score), *lists], names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "score", "rare_h", "rare_n"])

    partial = saved(numbered.mapInArrow(score, f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, score double, rare_h array<long>, rare_n array<int>"), "partial")
    held.unpersist()
    other = partial.select("row", F.explode(F.arrays_zip("rare_h", "rare_n")).alias("r")).select("row", F.col("r.rare_h").alias("h"), F.col("r.rare_n").alias("n"))
    found = other.join(word_counts(model, 1, 1 << power), "h", "left")
    add = found.groupBy(F.col("row").alias("at")).agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * (F.log10(F.coalesce("c", F.lit(0)) + 1.0) - F.lit(below))).alias("more_base"),
    )
    out = partial.drop("rare_h", "rare_n").join(add, F.col("row") == F.col("at"), "left")
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
    )


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; those whose crc32(doc_id) mod 7 is 2 are held out."""
    return scores(load(spark, sf_dir, "documents"), id_remainder("doc_id", 7) == 2)
