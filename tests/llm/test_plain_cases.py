"""Each operator against a brute-force version, over nulls, empty and long texts, ties, repeated
rows, empty tables and extra columns with clashing names."""

import io
import itertools
import math
import time
import zipfile
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartolith.llm import decontaminate, line_dedup, lm_score, mixing, near_dedup, neighbours, quality, sharding, token_counts, warc
from cartolith.llm.common import load, saved, shared_dir, words
from cartolith.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, hash long, rep long, seed long, slot long"


def documents(spark, rows):
    """rows of (doc_id, text, source); the other columns clash with names that operators use."""
    return spark.createDataFrame([(i, t, "en", s, 1, -1, -1, -1, -1, -1, -1) for i, t, s in rows], SCHEMA)


def some(seed, n, vocabulary=60):
    r = np.random.default_rng(seed)
    names = [f"w{k}" for k in range(vocabulary)]
    return [" ".join(r.choice(names, size=int(r.integers(1, 40)))) for _ in range(n)]


ODD = [(None, "no id", "a"), (900, None, "b"), (901, "", None), (902, " \n\t ", None), (903, "Word", "c"), (904, "x " * 30_000, "c"), (905, "same row", "a"), (905, "same row", "a")]


# ---- archives -----------------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, path string")


BIG = (1 << 53) + 1  # no double holds it


@pytest.mark.parametrize("sizes", [(32 << 20, 4 << 20), (400, 300)])
def test_archives_round_trip(spark, monkeypatch, sizes):
    monkeypatch.setattr(warc, "PACKAGE_BYTES", sizes[0])
    monkeypatch.setattr(warc, "RANGE_BYTES", sizes[1])
    long, other = "a" * 100, "é" * 60
    rows = [(BIG, "a b%20c", "of its own"), (BIG + 2, "", "big" * 40), (BIG + 4, "é", "big" * 40), (3, "u", long), (1, None, long), (7, "u\r\nX: y", long), (2, "v", "short"), (4, "v", "short"), (5, "w", None), (6, "w", ""), (None, "n", long), (8, "x", other), (8, "x", other), (9, "y", "z" * 300_000)]
    ready = warc.with_roles(pages(spark, [(*r, "d", "p") for r in rows]))
    packages = warc.write_packages(ready, warc._uri(shared_dir(spark)))
    assert packages.count() == 1 or sizes[0] < 1000
    read = warc.read_packages(packages).collect()
    assert sorted((r["page_id"] or -1, r["url"] or "null") for r in read) == sorted((i or -1, u or "null") for i, u, _ in rows)
    got = sorted((r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in read)
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        same = [j for j, _, h in rows if j is not None and (h or "").encode() == body]
        first = min(same) if len(body) >= 100 and len([1 for _, _, h in rows if (h or "").encode() == body]) > 1 and same else i
        want.append((i or -1, len(body), sha256(body).hexdigest(), "response" if first == i else "revisit", None if first == i else first))
    assert got == sorted(want)


def test_archives_of_nothing(spark):
    ready = warc.with_roles(pages(spark, []))
    assert warc.read_packages(warc.write_packages(ready, warc._uri(shared_dir(spark)))).count() == 0


@pytest.mark.parametrize("wide", [False, True])
def test_directories_with_and_without_zip64(monkeypatch, wide):
    if wide:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a/first", b"1" * 40)
        z.writestr(warc.DATA, b"records")
        z.comment = b"PK comment"
    members = warc.directory(out, len(out.getvalue()))
    assert (b"PK\x06\x06" in out.getvalue()) == wide
    out.seek(warc.member_start(out, members[warc.DATA]))
    assert out.read(members[warc.DATA][1]) == b"records"
    with pytest.raises(ValueError):
        warc.directory(io.BytesIO(b"no archive"), 10)


# ---- lines --------------------------------------------------------------------------------------


def test_line_windows(spark):
    rows = [(1, "a\nb\nc\nd", "s"), (2, "x\na\nb\nc\nd\ny", "s"), (3, "a\nb", "s"), (4, "q\nq\nq\nq\nq", "s"), (5, "\n\n\n\n", "s"), (6, "\n\n\n\n", "s"), (7, "b\nc\nd\nb\nc\nd", "s"), (8, "\t\n\t\n\t\n\t", "s"), (9, " \n  \n\n ", "s"), (10, " \n  \n\n ", "s"), (None, "x\na\nb\nc\nnew", "s"), *ODD]
    got = {}
    for r in line_dedup.dedup_lines(documents(spark, rows)).collect():
        got.setdefault(r["doc_id"] if r["doc_id"] is not None or "no id" in r["text"] else -1, (r["text"], r["n_removed"]))
    seen, gone = set(), {}
    last = [(-1 if i is None and t != "no id" else i, t, s) for i, t, s in rows if t is not None]
    for i, t, _ in sorted(last, key=lambda r: (r[0] is None or r[0] < 0, r[0] or 0)):
        lines = t.split("\n")
        if i == 905 and i in gone:
            continue
        gone[i] = set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p : p + 3])
            if "".join(w).strip(" "):
                gone[i] |= {p, p + 1, p + 2} if w in seen else set()
                seen.add(w)
        assert got[i] == ("\n".join(x for n, x in enumerate(lines) if n not in gone[i]), len(gone[i]))
    assert got[2] == ("x\ny", 4) and got[-1] == ("new", 4) and got[8] == ("\t", 3) and got[10][1] == 0
    assert got[900] == (None, 0)
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


def test_texts_of_many_lines(spark):
    """Two texts of 120 000 lines: the work is linear in them."""
    text = "\n".join(f"line {n}" for n in range(120_000))
    docs = documents(spark, [(1, text, "s"), (2, text + "\nend", "s")])
    began = time.time()
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert got[1][1] == 0 and got[2] == ("end", 120_000)
    assert time.time() - began < 30


# ---- tokens -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def counter():
    import public_tokenizers

    return token_counts.PrefixCounter(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


TEXTS = ["", " ", "Hello World", "don't they're I'LL we'd 's '''s", "héllo ÉÀ ñ ß İ ΣΑΣ ΟΔΟΣ.", "aaaaaaaaaaaaaaaaaaaaaaa", "a<|endoftext|>b <|startoftext|><|startoftext|", "１２３ ½ 7thirteen", "日本語 テキスト 漢字", "éä", "x\x1cy\x1fz\x0b", " wide　space", "🙂🙂👩‍👩‍👧 ok", "!!??...,,;;--", "supercalifragilisticexpialidocious" * 5]


def test_counts_are_the_librarys(counter, library):
    for t in TEXTS + some(1, 50):
        assert counter.count(t) == len(library.encode(t, add_special_tokens=False).ids), t
    for t in TEXTS[:4] + some(1, 20):
        found = t.split()
        assert counter.word_ends(t).tolist() == [len(library.encode(" ".join(found[: k + 1]), add_special_tokens=False).ids) for k in range(len(found))]


def test_every_prefix(counter, library):
    for t in TEXTS[:13]:
        if "<|" in t:
            continue
        low = counter.normal(t)
        want = [len(library.encode(low[:k], add_special_tokens=False).ids) for k in range(len(low) + 1)]
        assert counter.prefix_counts(t).tolist() == want, t
    assert counter.prefix_counts("a<|endoftext|>b")[-1] == 3


def test_token_tables(spark, counter):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = documents(spark, [*ODD, (1, "Hello, wörld", "s")])
    got = {r["doc_id"]: tuple(r)[1:] for r in token_counts.token_counts(docs, path).collect()}
    assert got[1] == (13, counter.count("Hello, wörld"), False, 2)
    assert got[900] == got[901] == (0, 0, False, 0) and got[904] == (60_000, 30_000, True, 2048)
    assert token_counts.token_counts(docs, path).count() == len(ODD) + 1
    over = [{r["doc_id"]: r["over_limit"] for r in token_counts.token_counts(docs, path, limit=n).collect()}[904] for n in (29_999, 30_000)]
    assert over == [True, False]
    fits = {r["doc_id"]: r["fit_chars"] for r in token_counts.fitting(token_counts.token_prefixes(docs, path), 2).collect()}
    assert fits[1] == counter.fit("Hello, wörld", 2) and fits[900] == 0
    assert token_counts.token_counts(documents(spark, []), path).count() == 0


# ---- shards -------------------------------------------------------------------------------------


@pytest.mark.parametrize("hot", [0, 400])
def test_shards(spark, hot):
    rows = [(n, t, "s") for n, t in enumerate(some(2, 600))] + [(1000 + n, "the same words again " * 3, "s") for n in range(hot)] + ODD
    out = sharding.shard_documents(documents(spark, rows)).toPandas()
    assert len(out) == len(rows)
    sizes = out.groupby("shard")["size"].sum()
    assert sizes.sum() == sum(len((t or "").encode()) + 1 for _, t, _ in rows)
    plain = sizes.drop(index=out.loc[out.doc_id == 904, "shard"].iloc[0])
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    by = {i: t for i, t, _ in rows}
    assert all(zlib.crc32((by[i] or "").encode()) == c for i, c in zip(out.doc_id, out.text_crc32, strict=True) if not math.isnan(i))
    if not hot:  # no group is too heavy: equal texts lie in one shard, with or without an id
        assert out.groupby("text_crc32")["shard"].nunique().max() == 1
        return
    split = out[out.doc_id.between(1000, 1399)].groupby("shard").size()
    assert len(split) <= 16 and plain.max() > 0


def test_shards_are_even(spark):
    rows = [(n, t, "s") for n, t in enumerate(some(3, 4000))] + [(10_000 + n, "one group of equal texts", "s") for n in range(3000)]
    sizes = sharding.shard_documents(documents(spark, rows)).groupBy("shard").agg(F.sum("size").alias("b")).toPandas()["b"]
    assert len(sizes) == 16 and (sizes.max() - sizes.min()) / sizes.mean() < 0.06
    assert sharding.shard_documents(documents(spark, [])).count() == 0


# ---- language model -----------------------------------------------------------------------------


def test_base_scores(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "COMMON", 20)  # so that most words take the way through the join
    rows = [(n, t, "s") for n, t in enumerate(some(4, 120))] + ODD
    out = lm_score.scores(documents(spark, rows), lm_score.id_remainder("doc_id", 7) == 2).toPandas()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(i, [*words(t or ""), b"\n"]) for i, t, _ in rows]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((-1 if i is None else i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 4)) for i, ws in tokens)
    got = sorted((-1 if math.isnan(r.doc_id) else int(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out.itertuples())
    assert got == want
    assert (out.score < 0).all() and np.isfinite(out.score).all()
    assert lm_score.scores(documents(spark, []), lm_score.id_remainder("doc_id", 7) == 2).count() == 0


def test_filter_never_loses_counts():
    h = lm_score.mixed(np.arange(1, 5001, dtype=np.uint64))
    n = np.random.default_rng(5).integers(1, 2000, 5000)
    q = lm_score.level(n)
    bits = 8 * int(q.sum())
    marks = np.zeros(bits, bool)
    for j in range(1, q.max() + 1):
        for x in lm_score.places(h[q >= j], j, np.uint64(bits)):
            marks[x.astype(np.int64)] = True
    f = lm_score.Filter(1, 1, np.array([bits], np.uint64), np.array([0], np.uint64), np.packbits(marks, bitorder="little"), int(q.max()))
    assert (f.levels(h) >= q).all() and (f.levels(h) == q).mean() > 0.9
    assert (f.levels(lm_score.mixed(np.arange(10**6, 10**6 + 5000, dtype=np.uint64))) > 0).mean() < 0.1


@pytest.mark.parametrize("limit", [1 << 31, 1000])
def test_scores_are_the_models(spark, monkeypatch, limit):
    """By exact counts at their levels; with so many bits an entry that the filter doesn't err. What
    is held out isn't learnt. Broadcast, and asked for slice by slice."""
    monkeypatch.setattr(lm_score, "BITS_AN_ENTRY", 4000)
    monkeypatch.setattr(lm_score, "MAX_BITS", limit)
    monkeypatch.setattr(lm_score, "CHUNK", 700)
    monkeypatch.setattr(lm_score, "COUNTED", 900)
    rows = [(n, t, "s") for n, t in enumerate(some(4, 120))] + [r for r in ODD if r[0] != 904]
    out = lm_score.scores(documents(spark, rows), lm_score.id_remainder("doc_id", 7) == 2).toPandas()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    texts = [(i, ["<", "<", *words(t or ""), "\n"]) for i, t, _ in rows]
    train = [x for i, x in texts if not held(i)]
    counts = [Counter(tuple(x[k - n : k + 1] if n < 2 or k > 2 else ["<", x[k]]) for x in train for k in range(2, len(x))) for n in range(3)]
    # A text's first triple is its first token after START alone.
    step = lambda n: 0.0 if not n else lm_score.typical(int(lm_score.level(np.array([n]))[0]))
    total, types = sum(counts[0].values()), len(counts[0])
    want = []
    for i, x in texts:
        score = 0.0
        for k in range(2, len(x)):
            gram = lambda n, k=k: tuple(x[k - n : k + 1]) if n < 2 or k > 2 else ("<", x[k])
            p = (step(counts[0][gram(0)]) + 1) / (total + types + 1)
            for n in (1, 2):
                history = len(train) if k == 2 else step(counts[n - 1][gram(n - 1, k - 1)])
                share = lm_score.SHARE[n] * history / (history + 1)
                p = share * max(min(step(counts[n][gram(n)]), history) - lm_score.DISCOUNT[n], 0) / max(history, 1) + (1 - share) * p
            score += math.log10(min(p, 1))
        want.append((-1 if i is None else i, round(score, 6)))
    assert sorted((-1 if math.isnan(r.doc_id) else int(r.doc_id), round(r.score, 6)) for r in out.itertuples()) == sorted(want)


def test_model_is_a_distribution():
    """After any history the probabilities of all words add up to at most 1."""
    r = np.random.default_rng(22)
    for _ in range(200):
        n = r.integers(1, 9, 6)  # what follows the longer history, and at least as often the shorter one
        m = n + r.integers(0, 9, 6)
        ones = m + r.integers(0, 9, 6)
        total = 0
        for w in range(6):
            # Two tokens before it, by an n-gram count each.
            counts = [np.array([5.0, m.sum(), ones[w]]), np.array([3.0, n.sum(), m[w]]), np.array([1.0, 1.0, n[w]])]
            total += 10 ** lm_score.log_p(counts, np.array([3]), 4, int(ones.sum()), 6)[2]
        assert total <= 1 + 1e-9


# ---- classifier ---------------------------------------------------------------------------------


def test_quality_on_held_out(spark):
    good = [(n, t, "s") for n, t in enumerate(some(6, 200))]
    bad = [(1000 + n, " ".join(w + "$$$" for w in t.split()), "s") for n, t in enumerate(some(7, 200))]
    docs = documents(spark, good + bad + ODD)
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _, _ in good + bad] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.quality(docs, labels).toPandas()
    assert len(out) == 400 + len(ODD)
    held = out[out.held_out & (out.doc_id < 1400)]
    assert ((held.doc_id < 1000) == (held.predicted == 1)).mean() > 0.98
    assert out.score.between(0, 1).all() and ((out.score >= 0.5) == (out.predicted == 1)).all()
    # Each score by itself, from the model's weights.
    weights, square, bias = quality.fit(docs, labels, lm_score.id_remainder("doc_id", 3) != 1)
    find, texts = quality.Features(), {i: t for i, t, _ in good + bad + ODD}
    for r in out[out.doc_id.notna()].itertuples():
        f = find(texts[int(r.doc_id)] or "")
        margin = weights[f].sum() / max(math.sqrt(square[f].sum()), 1e-12) + bias
        assert r.score == pytest.approx(1 / (1 + math.exp(-2 * margin)), abs=1e-9)
    # A label that isn't learnt from makes no difference, nor do rows that share an id.
    other = labels.withColumn("quality", F.when(lm_score.id_remainder("doc_id", 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.quality(docs.unionByName(docs.limit(50)), other).dropDuplicates(["doc_id"]).toPandas()
    assert dict(zip(out.doc_id, out.score, strict=True))[5] == dict(zip(again.doc_id, again.score, strict=True))[5]
    nothing = quality.quality(docs, labels.limit(0)).toPandas()
    assert (nothing.score == 0.5).all()
    assert quality.quality(documents(spark, []), labels).count() == 0


def test_features_are_the_ngrams():
    """Equal sets of n-grams have equal features, and a repeated word shows."""
    find = quality.Features()
    assert set(find("abcd")) < set(find("abcde")) and len(find("ab")) == 0
    high = lambda t: sorted(f - (1 << quality.BITS) for f in find(t) if f >= 1 << quality.BITS)
    assert high("a b c d") == [0] and high("a b b c") == [2] and high("a a a a") == [7] and high("a b c") == []


def test_dual_descent_reaches_the_optimum():
    """Against a plain subgradient descent on the same objective."""
    r = np.random.default_rng(23)
    rows = [np.unique(r.integers(0, 12, 6)).astype(np.int32) for _ in range(40)]
    values = [np.ones(len(x)) / math.sqrt(len(x)) for x in rows]
    y = np.where([0 in x or 3 in x for x in rows], 1.0, -1.0)

    def loss(w, b):
        w = w[:12]
        return 0.5 * (w @ w + b * b) + 10 * sum(max(0, 1 - t * (w[x] @ v + b)) for x, v, t in zip(rows, values, y, strict=True))

    w, b = quality.dual_descent(rows, values, y, rounds=400)
    best, u, c = math.inf, np.zeros(12), 0.0
    for k in range(1, 4001):
        g, gb = u.copy(), c
        for x, v, t in zip(rows, values, y, strict=True):
            if t * (u[x] @ v + c) < 1:
                g[x] -= 10 * t * v
                gb -= 10 * t
        u, c = u - g / k, c - gb / k
        best = min(best, loss(u, c))
    assert loss(w, b) <= best * 1.01


# ---- near copies --------------------------------------------------------------------------------


def exact_components(rows, n):
    def shingles(t):
        w = words(t or "")
        return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()

    known = {}  # so that equal sets are one object
    sets = [(i, known.setdefault(s, s)) for i, s in ((i, shingles(t)) for i, t, _ in rows if i is not None)]
    up = {i: i for i, _ in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return {i: (len(s), top(i)) for i, s in sets}


def told_components(out):
    rows = [(int(r.doc_id), (r.n_shingles, int(r.component_id))) for r in out.itertuples() if not math.isnan(r.doc_id)]
    assert ((out.doc_id == out.component_id) | out.doc_id.isna()).eq(out.kept).all()
    return rows


@pytest.mark.parametrize("limits", [(2000, 24, 4, 1 << 21), (40, 3, 1, 1 << 21), (2000, 24, 4, 2000)])
def test_near_copies(spark, monkeypatch, limits):
    for name, value in zip(("NODE", "SMALL", "FEW", "WEIGHT"), limits, strict=True):
        monkeypatch.setattr(near_dedup, name, value)
    r = np.random.default_rng(8)
    base = some(9, 150, 400)
    rows = [(n, t, "s") for n, t in enumerate(base)]
    crowd = [f"v{k}" for k in range(80)]
    for n in range(90):  # a crowd of near copies, some of which are too far from all others
        w = list(crowd)
        for k in r.choice(80, size=int(r.integers(0, 9)), replace=False):
            w[k] = f"z{r.integers(0, 500)}"
        rows.append((2000 + n, " ".join(w), "s"))
    rows += [(5000 + n, base[n].upper(), "s") for n in range(20)] + ODD
    out = near_dedup.near_duplicates(documents(spark, rows), shingle=2).toPandas()
    assert len(out) == len(rows)
    assert dict(told_components(out)) == exact_components(rows, 2)


def test_rows_that_share_an_id_are_one_vertex(spark):
    a, b, c = ("the first of some texts", "another text beside it", "a third one of its own")
    rows = [(3, a, "s"), (5, a, "s"), (5, b, "s"), (9, b, "s"), (7, c, "s"), (7, c, "s"), (8, "", "s"), (8, c, "s"), (11, "", "s"), (12, None, "s")]
    out = near_dedup.near_duplicates(documents(spark, rows), shingle=2).toPandas()
    assert len(out) == len(rows)
    assert {(int(i), int(c)) for i, c in zip(out.doc_id, out.component_id, strict=True)} == {(3, 3), (5, 3), (9, 3), (7, 7), (8, 7), (11, 11), (12, 12)}


def test_one_id_for_a_crowd_of_texts(spark, monkeypatch):
    """A third of all rows share an id and no texts."""
    monkeypatch.setattr(near_dedup, "NODE", 30)
    texts = some(17, 300, 500)
    rows = [(1000 if n % 3 == 0 else n, t, "s") for n, t in enumerate(texts)] + [(2000, texts[0] + " w1", "s")]
    out = near_dedup.near_duplicates(documents(spark, rows), shingle=2).toPandas()
    assert out[out.doc_id == 1000].component_id.nunique() == 1
    assert dict(told_components(out)).keys() == {i for i, _, _ in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_large_crowds(spark, monkeypatch, seed):
    """More near copies than a node holds: those of a common text, those that only some of the
    others link with, and a second crowd."""
    monkeypatch.setattr(near_dedup, "NODE", 60)
    r = np.random.default_rng(seed)
    rows = []
    for c, most in enumerate((7, 12)):
        crowd = [f"v{c}x{k}" for k in range(60)]
        for n in range(250):
            w = list(crowd)
            for k in r.choice(60, size=int(r.integers(0, most)), replace=False):
                w[k] = f"z{r.integers(0, 800)}"
            rows.append((1000 * c + n, " ".join(w), "s"))
    rows += [(5000 + n, t, "s") for n, t in enumerate(some(seed, 150, 400))]
    out = near_dedup.near_duplicates(documents(spark, rows), shingle=2).toPandas()
    assert dict(told_components(out)) == exact_components(rows, 2)


def test_forests():
    r = np.random.default_rng(20)
    for _ in range(20):
        sets = [np.unique(r.integers(0, 40, int(r.integers(1, 30)))).astype(np.uint64) for _ in range(30)]
        tried = r.random(30) < 0.6
        up, want = list(range(30)), 0

        def top(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        for i in range(30):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if (tried[i] or tried[j]) and 100 * common >= 50 * (len(sets[i]) + len(sets[j]) - common) and top(i) != top(j):
                    up[top(i)] = top(j)
                    want += 1
        got = near_dedup.forest(sets, tried, (50, 100))
        assert len(got) == want and all(top(i) == top(j) for i, j in got)


@pytest.mark.parametrize("shingle", [2, 5])
def test_against_an_exact_join(spark, monkeypatch, shingle):
    """The documents of sf0.01, in nodes of few classes: no link is lost."""
    monkeypatch.setattr(near_dedup, "NODE", 50)
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r[0], r[1], "") for r in docs.select("doc_id", "text").collect()]
    out = near_dedup.near_duplicates(docs, shingle=shingle).toPandas()
    assert dict(told_components(out)) == exact_components(rows, shingle)


def test_trees_reach_their_recall():
    trees = near_dedup.trees_for(0.9997, 0.8)
    assert trees == 3 and near_dedup.trees_for(0.9999, 0.8) == 4
    r, lost = np.random.default_rng(16), 0
    for _ in range(12):
        common = [r.integers(0, 1 << 63, 80, dtype=np.uint64) for _ in range(5000)]
        sides = [[np.concatenate([c, r.integers(0, 1 << 63, 10, dtype=np.uint64)]) for c in common] for _ in range(2)]
        x, y = (near_dedup.minwise(side, trees)[:, : trees * near_dedup.COORDINATES].reshape(-1, trees, near_dedup.COORDINATES) for side in sides)  # 80 of 100 in common
        left = np.arange(len(x))
        for t in range(trees):
            p, row = np.full(len(left), near_dedup.mixed(np.full(1, 977 * (t + 1), np.uint64))[0]), np.arange(len(left))
            for level in range(6):
                ends = zip(near_dedup.branch(p, x[left[row], t], level), near_dedup.branch(p, y[left[row], t], level), strict=True)
                met = [(a[a == b], row[a == b]) for a, b in ends]
                p, row = np.concatenate([m[0] for m in met]), np.concatenate([m[1] for m in met])
            left = np.delete(left, np.unique(row))
        lost += len(left)
    assert lost <= 25, lost  # of 60 000 pairs; trees that shared coordinates lost 34 of these


def test_near_copies_of_nothing(spark):
    assert near_dedup.near_duplicates(documents(spark, [])).count() == 0


def test_components(spark):
    links = [(n, n + 1) for n in range(50)] + [(100, 200), (200, 300), (7, 7), (400, 300), (100, 200)]
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{n: 0 for n in range(51)}, **{n: 100 for n in (100, 200, 300, 400)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- mixing -------------------------------------------------------------------------------------


def test_mix(spark):
    rows = [(n, t, f"s{n % 4}") for n, t in enumerate(some(10, 400))] + [(2000 + n, "one two", None) for n in range(300)] + ODD
    out = mixing.mix(documents(spark, rows)).toPandas()
    assert len(out) == len(rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len(words(t or ""))
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    goal, weight = dict.fromkeys(order, 0.0), dict(zip(order, [5, 2, 1] * len(order), strict=False))
    left, free = 1.5 * sum(size.values()), [s for s in order if size[s]]
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = [s for s in free if share[s] > 2 * size[s]]
        for s in full or free:
            goal[s] = 2.0 * size[s] if full else share[s]
        left -= sum(goal[s] for s in full)
        free = [s for s in free if s not in full] if full else []
    longest = {s: max([len(words(t or "")) for _, t, x in rows if x == s]) for s in order}
    for s in order:
        own = out[out.source.isna()] if s is None else out[out.source == s]
        assert own.target.iloc[0] == pytest.approx(goal[s])
        assert abs((own.times * own["size"]).sum() - goal[s]) <= max(longest[s], 1)
        assert own.times.max() <= 2
    again = mixing.mix(documents(spark, rows)).toPandas()
    assert sorted(zip(out.doc_id.fillna(-1), out.times, strict=True)) == sorted(zip(again.doc_id.fillna(-1), again.times, strict=True))
    assert mixing.mix(documents(spark, [])).count() == 0


@pytest.mark.parametrize("same", [True, False])
def test_mix_with_a_heavy_id(spark, same):
    """Rows that share an id, or all three columns, are told apart at the threshold."""
    texts = some(18, 300)
    rows = [(n, t, "a") for n, t in enumerate(texts)] + [(7, "some of the same words " * 9 if same else t, "b" if n % 3 else "a") for n, t in enumerate(some(19, 200))]
    out = mixing.mix(documents(spark, rows)).toPandas()
    assert len(out) == len(rows)
    for s in "ab":
        own = out[out.source == s]
        assert abs((own.times * own["size"]).sum() - own.target.iloc[0]) <= own["size"].max()
        assert own.times.max() <= 2 and own.times.max() - own.times.min() <= 1
    again = mixing.mix(documents(spark, rows[::-1])).toPandas()
    key = ["doc_id", "source", "size", "times"]
    assert sorted(map(tuple, out[key].values)) == sorted(map(tuple, again[key].values))


# ---- decontamination ----------------------------------------------------------------------------


def exact_overlaps(docs, items, window=13):
    """Pairs of which a stretch agrees: 80 % of 13 words, of the whole item if shorter, all of one
    of fewer than 8."""
    found = set()
    texts = [(d, words(t or ""), set(words(t or ""))) for d, t in {(d, t) for d, t, _ in docs}]
    for i, item in {(i, t) for i, t in items}:
        x = words(item or "")
        size = min(window, len(x))
        need = size if size < 8 else math.ceil(0.8 * size - 1e-9)
        for d, y, has in texts:
            if len(x) - len([w for w in x if w not in has]) < need:
                continue
            for shift in range(-len(x) + 1, len(y)) if x else ():
                d0, i0 = max(shift, 0), max(-shift, 0)
                same = np.cumsum([0] + [a == b for a, b in zip(y[d0:], x[i0:], strict=False)])
                if len(same) > size and (same[size:] - same[:-size]).max() >= need:
                    found.add((d, i))
                    break
    return found


def test_overlaps(spark):
    r = np.random.default_rng(11)
    items = [(n, " ".join(f"b{r.integers(0, 300)}" for _ in range(25 + n))) for n in range(6)] + [(20, None), (21, ""), (22, " too short "), (None, "with no id at all but enough words to be found if it is there"), (None, "and one more of those that have no id but words"), (3, "clash")]
    items += [(30 + n, " ".join(f"c{r.integers(0, 40)}" for _ in range(n))) for n in range(2, 16)]
    rows, plain = [(n, t, "s") for n, t in enumerate(some(12, 100))], some(12, 100)
    for n in range(6):
        w = items[n][1].split()
        for k in range(0, len(w), 9):  # every ninth word replaced
            w[k] = "other"
        rows.append((500 + n, f"{plain[n]} {' '.join(w).upper()} {plain[n]}", "s"))
        rows.append((600 + n, f"{plain[n]} {' '.join(items[n][1].split()[3:23])}", "s"))  # a part
        rows.append((700 + n, " ".join(items[n][1].split()[:7]), "s"))  # too little of it
    for n in range(60):  # short items, whole or with some words replaced
        w = items[12 + n % 14][1].split()
        for k in r.choice(len(w), size=min(len(w), n // 14), replace=False):
            w[k] = "other"
        rows.append((800 + n, f"{plain[n]} {' '.join(w)} {plain[n]}", "s"))
    rows += [(None, "with no id at all but enough words to be found if it is there", "s"), (None, "clean", "s"), (500, "clean", "s"), (501, rows[103][1], "s"), (900, "too short", "s")]
    bench = spark.createDataFrame([(i, t, 0, 0) for i, t in items], "item_id long, text string, hits int, at int")
    docs = documents(spark, rows + ODD)
    got = decontaminate.overlaps(docs, bench).collect()
    want = exact_overlaps(rows + ODD, items)
    assert {(x["doc_id"], x["item_id"]) for x in got} == want and len(got) == len(want) > 40
    bad = {(d, t) for d, t, _ in rows + ODD if exact_overlaps([(d, t, "")], items)}
    left = decontaminate.decontaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(((x["doc_id"], x["text"]) for x in left.collect()), key=str) == sorted(((d, t) for d, t, _ in rows + ODD if (d, t) not in bad), key=str)
    twice = decontaminate.overlaps(documents(spark, rows + rows), bench)
    assert sorted(map(str, twice.collect())) == sorted(map(str, decontaminate.overlaps(documents(spark, rows), bench).collect()))
    assert decontaminate.overlaps(docs, bench.limit(0)).count() == 0
    assert decontaminate.overlaps(documents(spark, []), bench).count() == 0


def test_masks_leave_no_replaced_words_out():
    """Whatever 20 % of a stretch's words are replaced, some mask fits between them."""
    for n in range(8, 14):
        masks = decontaminate.MASKS + (decontaminate.SHORT_MASKS if n < 13 else ())
        for gone in itertools.combinations(range(n), n - math.ceil(0.8 * n - 1e-9)):
            free = [[at + k for k, c in enumerate(m) if c == "1"] for m in masks for at in range(n - len(m) + 1)]
            assert any(not set(p) & set(gone) for p in free), (n, gone)


def test_overlaps_of_random_texts(spark):
    """Few different words, so that there are many near misses."""
    r = np.random.default_rng(21)
    text = lambda n: " ".join(f"w{k}" for k in r.integers(0, 4, n))
    rows, items = [(n, text(int(r.integers(0, 60))), "s") for n in range(60)], [(n, text(n)) for n in range(1, 25)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.overlaps(documents(spark, rows), bench).collect()}
    assert got == exact_overlaps(rows, items)


# ---- neighbours ---------------------------------------------------------------------------------


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CANDIDATE_TILE", 50)
    monkeypatch.setattr(neighbours, "QUERY_TILE", 7)
    monkeypatch.setattr(neighbours, "QUERY_NUMBERS", 16 * 20)
    monkeypatch.setattr(neighbours, "CANDIDATES", 150)
    r = np.random.default_rng(13)
    rows = [(n, r.normal(size=16).astype(np.float32).tolist()) for n in range(400)]
    rows += [(1000 + n, rows[10][1]) for n in range(60)]  # many equal vectors
    rows += [(2000, None), (2010, [0.0] * 16), (2020, [math.nan] * 16), (2030, [math.inf] * 16), (2040, [None] + [1.0] * 15), (2050, [1.0, 2.0]), (None, [1.0] * 16), (2060, [1e-40] + [0.0] * 15), (20, rows[21][1])]
    table = spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")
    out = neighbours.nearest(table, F.col("vec_id") % 10 == 0, k=5).toPandas()
    fine = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    want = []
    for n, (q, x) in enumerate(fine):
        if q % 10 == 0:
            best = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y, strict=True))), i) for m, (i, y) in enumerate(fine) if m != n and len(y) == len(x))[:5]
            want += [(q, k + 1, i, round(s, 9)) for k, (s, i) in enumerate(best)]
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in out.itertuples()) == sorted(want)
    assert neighbours.nearest(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_tile_bounds_hold():
    r = np.random.default_rng(14)
    q, c = (neighbours.Block(np.arange(50), np.arange(50), r.normal(size=(50, 33)) * 10.0 ** r.integers(-6, 6, (50, 1))) for _ in range(2))
    low, high = neighbours.tile_bounds(q, c)
    true = np.sqrt(((q.vectors[:, None] - c.vectors[None]) ** 2).sum(2))
    assert (low <= true).all() and (true <= high).all()


def test_saved_tables_are_read_again(spark):
    df = saved(spark.createDataFrame([(1, "a")], "k int, v string"))
    assert df.collect() == [(1, "a")] and pd.DataFrame(df.toPandas()).shape == (1, 2)
