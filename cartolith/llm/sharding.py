"""Sharding by histogram sort: near equal bytes in every shard, equal texts side by side.

Rows are ordered by (hash of the text, doc_id, row number). The splitters between shards are
found by counting: exact bytes below evenly spaced probes, over all partitions, then the same
inside the one interval that each unresolved splitter fell into, until the bytes below a probe are
within `tolerance` of what the splitter wants, or the interval holds one key. Only inside one hash
value that is heavier than the tolerance does the search go on by doc_id, and then by row number.
So equal texts stay in one shard, except for a group that must be split for the balance. Probe
counts are the only thing that the driver sees: at most probes x shards numbers a round.

Afterwards rows are exchanged once, by range of the same key, and numbered. The numbering is taken
from the written table, so that a lost executor can't change it.

Defined cases: null text counts as empty (size 1, crc 0); null ids come first among equal texts;
repeated rows are rows like others; an empty table gives an empty result; fewer rows than shards
leave shards empty. Only the named columns are read.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import load, saved

LOW, HIGH = -(1 << 63), (1 << 63) - 1
KEYS = ("__k1", "__k2", "__k3")
#: Each round deals a span among up to 1024 intervals.
PROBE_BITS = 10


def with_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and the columns `keep` of each row, with size, text_crc32 and the three keys."""
    body = F.coalesce(F.col(text), F.lit(""))
    raw = body.cast("binary")
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        *keep,
        (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(body).alias(KEYS[0]),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LOW)).alias(KEYS[1]),
        F.monotonically_increasing_id().alias(KEYS[2]),
    )


def splitters(keys: DataFrame, shards: int, tolerance: float = 0.002) -> list[tuple[int, int, int]]:
    """shards - 1 keys in order; shard s takes the keys from splitter s - 1 up to below splitter s."""
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    slack = tolerance * total / shards
    found: dict[int, tuple[int, int, int]] = {}
    # A search: (values fixed on earlier keys, low, high of this key, bytes below low).
    searching = {s: ((), LOW, HIGH, 0) for s in range(1, shards)}
    while searching:
        spans = sorted(set(searching.values()))
        counts = _histogram(keys, spans)
        for s, span in list(searching.items()):
            fixed, low, high, below = span
            want = total * s / shards
            edges, inner = [(abs(below - want), low)], None
            for least, most, got in counts[span]:  # in order of the key
                if below + got >= want:
                    inner = (least, most, below)
                    edges += [(abs(below - want), least), (abs(below + got - want), most + 1)]
                    break
                below += got
                edges.append((abs(below - want), most + 1))
            off, at = min(edges)
            if off <= slack or inner is None or (len(fixed) == 2 and inner[0] == inner[1]):
                found[s] = _key(fixed, at)
                del searching[s]
            elif inner[0] == inner[1]:
                searching[s] = ((*fixed, inner[0]), LOW, HIGH, inner[2])
            else:
                searching[s] = (fixed, *inner)
    return [found[s] for s in range(1, shards)]


def _key(fixed: tuple[int, ...], at: int) -> tuple[int, int, int]:
    """The whole key that begins with `fixed` and `at`; past a key's last value, the one after `fixed`."""
    if at > HIGH:
        return _key(fixed[:-1], fixed[-1] + 1) if fixed else (HIGH, HIGH, HIGH)
    return (*fixed, at, *(LOW,) * (2 - len(fixed)))


def _histogram(keys: DataFrame, spans: list) -> dict[tuple, list[tuple[int, int, int]]]:
    """By span, in order: (least key, greatest key, bytes) between two neighbouring probes.

    One pass, summed before the shuffle. The whole range of a key is probed by its top bits.
    """
    where, bucket, key = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("long")
    for n, (fixed, low, high, _) in enumerate(spans):
        k = F.col(KEYS[len(fixed)])
        inside = reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in zip(KEYS, fixed, strict=False)], k.between(F.lit(low), F.lit(high)))
        at = F.shiftright(k, 64 - PROBE_BITS) if high - low > HIGH else F.floor((k - F.lit(low)) / F.lit(((high - low) >> PROBE_BITS) + 1))
        where, bucket, key = F.when(inside, F.lit(n)).otherwise(where), F.when(inside, at.cast("long")).otherwise(bucket), F.when(inside, k).otherwise(key)
    rows = keys.select(where.alias("span"), bucket.alias("bucket"), key.alias("key"), "size").filter("span is not null")
    summed = rows.groupBy("span", "bucket").agg(F.min("key").alias("least"), F.max("key").alias("most"), F.sum("size").alias("size"))
    out: dict[tuple, list] = {s: [] for s in spans}
    for r in sorted(summed.collect(), key=lambda r: r["least"]):
        out[spans[r["span"]]].append((r["least"], r["most"], r["size"]))
    return out


def shard_of(bounds: list[tuple[int, int, int]]) -> Column:
    """The shard of a row of with_keys(), by comparing its key with the splitters."""
    out = F.lit(0)
    for n, (a, b, c) in enumerate(bounds, 1):
        k1, k2, k3 = (F.col(k) for k in KEYS)
        after = (k1 > F.lit(a)) | ((k1 == F.lit(a)) & ((k2 > F.lit(b)) | ((k2 == F.lit(b)) & (k3 >= F.lit(c)))))
        out = F.when(after, F.lit(n)).otherwise(out)
    return out


def numbered(keys: DataFrame, bounds: list[tuple[int, int, int]]) -> DataFrame:
    """keys with shard and slot, gapless from 0 in each shard.

    One exchange by range deals the whole key order evenly, whatever repeats in it. A row's number
    in its task and the tasks' counts, read from the written table, give the slot: rows of a shard
    never meet in one task.
    """
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.withColumn("shard", shard_of(bounds)).repartitionByRange(n, *KEYS).sortWithinPartitions(*KEYS)
    placed = saved(dealt.withColumn("at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("at", 33)
    counts = placed.groupBy(F.col("shard").alias("in_shard"), part.alias("in_part")).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("in_shard").orderBy("in_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("in_shard", "in_part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # At most tasks + shards rows of 32 bytes: the number of tasks is a setting, not the data's.
    out = placed.withColumn("part", part).join(F.broadcast(base), (F.col("shard") == F.col("in_shard")) & (F.col("part") == F.col("in_part")))
    return out.withColumn("slot", F.col("before") + F.col("at") - F.col("first")).drop("in_shard", "in_part", "first", "before", "at", "part")


def shard_documents(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of each row of `docs`."""
    keys = saved(with_keys(docs, doc_id, text), "keys")
    return numbered(keys, splitters(keys, shards)).select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards under the law `bytes`."""
    out = shard_documents(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
