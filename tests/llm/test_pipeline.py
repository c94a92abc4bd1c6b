"""The pipeline's stages, one after another, against what their operators say."""

import corpus_pipeline
from cartolith.llm.common import load, saved, words
from cartolith.llm.decontaminate import overlaps
from cartolith.llm.mixing import mix
from cartolith.llm.near_dedup import near_duplicates
from cartolith.llm.quality import quality

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = load(spark, DATA, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = saved(stage(spark, docs, DATA), name)
        sizes.append(docs.count())
        if name != "sharding":
            assert docs.columns == columns
        ids = {r[0] for r in docs.select("doc_id").collect()}
        assert ids <= {r[0] for r in before.select("doc_id").collect()}
        if name == "quality":
            scores = quality(before, load(spark, DATA, "labels")).collect()
            assert ids == {r["doc_id"] for r in scores if r["predicted"]}
        if name == "near_dedup":
            assert near_duplicates(docs, shingle=5).filter("not kept").count() == 0
        if name == "decontamination":
            assert overlaps(docs, load(spark, DATA, "benchmark")).count() == 0
            total = sum(len(words(r[0])) for r in docs.select("text").collect())
        if name == "mixing":
            taken = sum(len(words(r[0])) for r in docs.select("text").collect())
            assert abs(taken - 1.5 * total) < 0.1 * total
            assert docs.groupBy("doc_id").count().filter("count > 2").count() == 0
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1] and sizes[-1] == sizes[-2]
    assert {r[0] for r in docs.select("shard").distinct().collect()} == set(range(16))


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0


def test_rows_without_an_id_or_with_the_same_one(spark):
    docs = load(spark, DATA, "documents")
    scores = quality(docs, load(spark, DATA, "labels"))
    rejected = {r["doc_id"] for r in scores.collect() if not r["predicted"]}
    rows = [r for r in docs.select(*corpus_pipeline.COLUMNS).collect()]
    bad, good = [r for r in rows if r["doc_id"] in rejected][:1], [r for r in rows if r["doc_id"] not in rejected and len(words(r["text"])) > 60][:4]
    item = next(r["text"] for r in load(spark, DATA, "benchmark").collect() if len(words(r["text"] or "")) > 14)
    schema = docs.select(*corpus_pipeline.COLUMNS).schema

    def told(some, ids):
        return spark.createDataFrame([(i, *r[1:]) for i, r in zip(ids, some, strict=True)], schema)

    for ids in ([None] * 5, [-5] * 5):
        both = docs.select(*corpus_pipeline.COLUMNS).unionByName(told(bad + good, ids))
        kept = [r for r in corpus_pipeline.keep_quality(spark, both, DATA).collect() if r["doc_id"] == ids[0]]
        assert sorted(r["text"] for r in kept) == sorted(r["text"] for r in good)
        copy = [(None, good[0]["text"] + " end", *good[0][2:])]
        kept = corpus_pipeline.drop_near_copies(spark, told(good + copy, ids), DATA).collect()
        assert len(kept) == 4 and {r["text"] for r in good[1:]} < {r["text"] for r in kept}
        leak = [(None, item, *good[0][2:])]
        kept = corpus_pipeline.drop_benchmark(spark, told(good + leak, ids), DATA).collect()
        assert sorted(r["text"] for r in kept) == sorted(r["text"] for r in good)
    many = told(rows[:60], [None] * 60)
    mixed = corpus_pipeline.mix_sources(spark, many, DATA).collect()
    times = {t: sum(r["text"] == t for r in mixed) for t in {r["text"] for r in rows[:60]}}
    want = {}
    for r in mix(many, keep=("text",)).collect():
        want[r["text"]] = want.get(r["text"], 0) + r["times"]
    assert times == want and len(set(want.values())) > 1
