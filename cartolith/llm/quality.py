"""Quality classification by naive Bayes support vectors.

A text is the set of its n-grams: byte trigrams and 4-grams, hashed into 2^18 features, and the
trigrams of a second sequence that says of each word whether it repeats the one before it. Each present feature is scaled by its class log-count ratio, the
vector brought to length 1, and a linear hinge-loss model fitted by dual coordinate descent. The
score is the logistic function of twice the margin.

The model is fitted on a bounded sample of labelled rows: at most `sample` of each class, those of
the smallest id hashes. Every text is scored whole, by itself, without an exchange.

Defined cases: null and empty texts have no n-grams and get the score of the bias; labels that are
null don't count, ids with several labels take the smallest; of rows that share a labelled id one
is learnt from; repeated rows and null ids are scored like any row (null ids are not held out); with labels of one class only, or none, all scores are
0.5; an empty table gives an empty result. Only the named columns are read.
"""

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_remainder, load

BITS = 18
#: Hashed features and the 8 trigrams of repeats.
SIZE = (1 << BITS) + 8


class Features:
    """The distinct features of texts, by one table of marks."""

    def __init__(self):
        self.seen = np.zeros(SIZE, bool)

    def __call__(self, text: str) -> np.ndarray:
        b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
        if len(b) > 2:
            x = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D)
            self.seen[(x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - BITS)] = True
            if len(b) > 3:
                y = x[:-1] * np.uint32(0x27D4EB2F) + b[3:] * np.uint32(0x165667B1)
                self.seen[(y ^ (y >> np.uint32(13))) * np.uint32(0x297A2D39) >> np.uint32(32 - BITS)] = True
        words = text.split()
        if len(words) > 3:
            same = np.fromiter(map(eq, words, words[1:]), np.int64, len(words) - 1)
            self.seen[(1 << BITS) + (same[:-2] << 2 | same[1:-1] << 1 | same[2:])] = True
        out = np.flatnonzero(self.seen).astype(np.int32)
        self.seen[out] = False
        return out


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """log of (smoothed share of each feature in class 1) / (its share in class 0)."""
    p, q = (alpha + np.bincount(np.concatenate([r for r, y in zip(rows, labels, strict=True) if (y > 0) == one]), minlength=SIZE) for one in (True, False))
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, cost: float = 10.0, rounds: int = 20, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge-loss model, one dual variable at a time."""
    w, bias, dual = np.zeros(SIZE), 0.0, np.zeros(len(rows))
    order, chance = np.arange(len(rows)), np.random.default_rng(seed)
    square = np.array([v @ v + 1 for v in values])  # the bias is a feature that is always 1
    for _ in range(rounds):
        chance.shuffle(order)
        moved = 0.0
        for i in order:
            slope = labels[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(dual[i] - slope / square[i], 0.0), cost)
            if new != dual[i]:
                step = (new - dual[i]) * labels[i]
                w[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(new - dual[i]))
                dual[i] = new
        if moved < 1e-4 * cost:
            break
    return w, bias


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", sample: int = 2500, doc_id: str = "doc_id", text: str = "text") -> tuple[np.ndarray, np.ndarray, float]:
    """(scaled weights, squared ratios, bias), fitted on at most 2 * `sample` rows of which `learn`
    (a condition on the labels' id column `doc_id`) holds."""
    own = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & learn).groupBy(F.col(doc_id).alias("sample_id")).agg(F.min(label).alias("y"))
    part = [own.filter(F.col("y") == y).orderBy(F.xxhash64("sample_id"), "sample_id").limit(sample) for y in (0, 1)]
    chosen = F.broadcast(part[0].unionByName(part[1]))  # at most 2 * sample rows

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Features()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["y"], pa.array([find(t).tobytes() for t in b["text"].to_pylist()], pa.binary())], names=["y", "features"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(chosen, F.col("doc_id") == F.col("sample_id"))
    # Of rows that share an id, the text of the smallest hash stands for all.
    one = rows.groupBy("doc_id").agg(F.min("y").cast("int").alias("y"), F.min_by("text", F.xxhash64("text")).alias("text"))
    got = one.select("y", "text").mapInArrow(features, "y int, features binary").collect()
    got = sorted((r["y"], bytes(r["features"])) for r in got)
    x, y = [np.frombuffer(f, np.int32) for _, f in got], np.array([1.0 if v else -1.0 for v, _ in got])
    if len(set(y)) < 2:
        return np.zeros(SIZE), np.ones(SIZE), 0.0
    ratio = log_count_ratio(x, y)
    values = [ratio[r] / max(np.sqrt((ratio[r] ** 2).sum()), 1e-12) for r in x]
    w, bias = dual_descent(x, values, y)
    return w * ratio, ratio**2, bias


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted and the columns `keep`, for every row. The model, 4 MB at any size, is broadcast."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (weights, square, bias), find = held.value, Features()
        for b in batches:
            margins = []
            for t in b["text"].to_pylist():
                f = find(t)
                margins.append(weights[f].sum() / max(np.sqrt(square[f].sum()), 1e-12) + bias)
            score = 1 / (1 + np.exp(-2 * np.clip(np.array(margins, float), -300, 300)))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(score), pa.array((score >= 0.5).astype(np.int32)), *(b["__" + c] for c in keep)], names=["doc_id", "held_out", "score", "predicted", *keep])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), (id_remainder(doc_id, 3) == 1).alias("held_out"), *(F.col(c).alias("__" + c) for c in keep))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, held_out boolean, score double, predicted int" + "".join(f", {c} {rows.schema['__' + c].dataType.simpleString()}" for c in keep))


def quality(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = (), **options) -> DataFrame:
    """Scores of all of `docs` by the model learnt from labelled rows that aren't held out."""
    return scored(docs, fit(docs, labels, id_remainder("doc_id", 3) != 1, **options), keep=keep)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by the labels whose crc32(doc_id) mod 3 is not 1."""
    return quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
