"""The pipeline against a plain version of its stages."""

import corpus_pipeline
from starbeam.llm import pii, quality
from tests.conftest import SMOKE
from tests.llm import brute


def test_pipeline(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SMOKE}/labels.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()}
    scored = brute.quality([(i, r.text) for i, r in docs.items()], labels, quality.THRESHOLD, quality.BUCKETS, quality.SMOOTHING)
    texts = {r[0]: docs[r[0]].text for r in scored if r[-1]}
    classes = brute.near_classes(texts)
    texts = {i: t for i, t in texts.items() if classes[i] == i}
    texts = {i: t for i, t in texts.items() if not brute.contamination(t, items)[3]}
    texts = {i: pii.masked(t, pii.find_spans(t)) for i, t in texts.items()}
    sizes = {}
    for i, t in texts.items():
        sizes[docs[i].source] = sizes.get(docs[i].source, 0) + len(brute.words(t))
    target = brute.targets(sizes)

    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SMOKE).collect()}
    assert got.keys() == texts.keys()
    taken = {}
    for i, r in got.items():
        source = docs[i].source
        assert r["size"] == len(brute.words(texts[i])) and r.source_size == sizes[source]
        assert abs(r.target - target[source]) < 1e-6 and r.taken <= 2 * r["size"]
        taken[source] = taken.get(source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    docs = docs.unionByName(docs.limit(1).selectExpr("cast(null as bigint) doc_id", "cast(null as string) text", "lang", "cast(null as string) source", "n_chars"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMOKE)
        assert out.columns == docs.columns and out.count() > 0
        assert stage(spark, docs.limit(0), SMOKE).count() == 0


def test_mix_writes_the_masked_texts(spark, tmp_path):
    docs = spark.createDataFrame([(1, "mail a.b@c.de now", "a"), (2, "two words", "b")], "doc_id long, text string, source string")
    masked = corpus_pipeline.mask_pii(spark, docs, SMOKE)
    rows = corpus_pipeline.mix(spark, masked, SMOKE, f"{tmp_path}/corpus").collect()
    got = spark.read.parquet(f"{tmp_path}/corpus").collect()
    assert {"mail [EMAIL] now", "two words"} >= {p.text for r in got for p in r.parts if len(p.text.split()) > 1}
    assert sum(len(r.text.split()) for r in got) == sum(r.taken for r in rows) > 0
    assert not any("@" in r.text for r in got)
