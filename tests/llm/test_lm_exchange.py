"""The language model's filter that stays in its slices: what it writes, how numbers are packed."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartolith.llm import lm_score as M


def size(root):
    return sum(p.stat().st_size for p in Path(root).rglob("*.parquet"))


def test_exchange_writes_little(spark, monkeypatch):
    """Texts, places and answers aren't all stored: what is saved takes less than the texts' bytes.
    Both ways give the same scores."""
    r = np.random.default_rng(51)
    texts = [" ".join(f"word{min(int(k), 30000)}" for k in r.zipf(1.2, 150)) for _ in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    monkeypatch.setattr(M, "BITS_AN_ENTRY", 400)  # so that the filters don't err
    out = {}
    for limit in (1 << 40, 0):
        monkeypatch.setattr(M, "MAX_BITS", limit)
        before = size(spark.conf.get("spark.checkpoint.dir"))
        rows = M.scores(docs, M.id_remainder("doc_id", 7) == 2).collect()
        written = size(spark.conf.get("spark.checkpoint.dir")) - before
        out[limit] = {x["doc_id"]: x for x in rows}
    assert written < sum(map(len, texts))
    assert len(out[0]) == 2000
    for i, x in out[0].items():
        y = out[1 << 40][i]
        assert [x[c] for c in ("held_out", "n_tokens", "n_known", "train_tokens")] == [y[c] for c in ("held_out", "n_tokens", "n_known", "train_tokens")]
        assert x["base_score"] == pytest.approx(y["base_score"], abs=1e-6) and x["score"] == pytest.approx(y["score"], abs=1e-6)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_ids_of_any_kind_come_home(spark, monkeypatch, kind):
    """Null, shared and large ids, null and empty texts, over several chunks and batches."""
    monkeypatch.setattr(M, "MAX_BITS", 0)
    monkeypatch.setattr(M, "COUNTED", 50)
    monkeypatch.setattr(M, "CHUNK", 20)
    rows = [(n % 60 + (1 << 53), f"some words {n % 7} again {n}") for n in range(90)] + [(None, "a b"), (None, None), (5, ""), (5, "a b a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    got = M.scores(docs, M.id_remainder("doc_id", 7) == 2).collect()
    key = lambda i, n: (str(i), n)
    assert sorted(key(x["doc_id"], x["n_tokens"]) for x in got) == sorted(key(i, len((t or "").split()) + 1) for i, t in rows)


def test_numbers_come_back():
    r = np.random.default_rng(52)
    for n in (0, 1, 2, 500, 5000):
        for top in (1, 200, 70000, 1 << 40, (1 << 64) - 1):
            x = r.integers(0, top, n, dtype=np.uint64, endpoint=True)
            assert (M.loose(M.tight(x)) == x).all()
    for drop in (0, 3, 8):
        h = r.integers(0, 1 << 48, 4000, dtype=np.uint64) >> np.uint64(drop) << np.uint64(drop)
        a, at = M.sorted_places(h, drop)
        assert (a == np.sort(h)).all() and (h[at] == a).all()
        assert (M.summed(M.steps(np.unique(h), drop), drop) == np.unique(h)).all()
    words = np.unique(r.integers(0, (1 << 64) - 1, 4000, dtype=np.uint64))
    assert (M.summed(M.steps(words, 0), 0) == words).all() and (M.summed(M.steps(words[-1:], 0), 0) == words[-1:]).all()
