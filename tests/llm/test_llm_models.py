"""Spelling variants, neural scores and whitening against plain versions, and on awkward rows."""

import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from starbeam.llm import minhash, neural_lm, pii, spelling, warc, whitening
from starbeam.llm.quality import quality_scores
from starbeam.llm.substring import dedup_substrings
from tests.conftest import SMOKE
from tests.llm.test_llm_operators import LONG, PROSE, ROWS, by_id, frame, labels_of, smoke


# ---- 11
def plain_counts(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 5:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 3}


def plain_variants(counts):
    gaps = {}
    for w in counts:
        for i in range(len(w)):
            gaps.setdefault((w[:i], w[i + 1 :]), []).append(w)
    near = {w: set() for w in counts}
    for w in counts:
        for i in range(len(w)):
            near[w].update(x for x in gaps[w[:i], w[i + 1 :]] if x != w)
            if (v := w[:i] + w[i + 1 :]) in counts:
                near[w].add(v)
                near[v].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= 2 * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), counts[w], len(near[w]), counts.get(form.get(w))) for w in counts}


def variants(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_word_counts(spark):
    for docs in (frame(spark), smoke(spark, "documents")):
        got = {r.word: r.n for r in spelling.word_counts(docs).collect()}
        assert got == plain_counts([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_spelling_variants_of_documents(spark):
    docs = smoke(spark, "documents")
    got = variants(spelling.spelling_variants(spelling.word_counts(docs)))
    assert got == plain_variants(plain_counts([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))


def test_spelling_variants_of_dense_words(spark):
    """Few letters, so that words run equal letters, share prefixes and lie near many others; also very long words."""
    rng = random.Random(3)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))): rng.choice([1, 2, 3, 5, 10, 40, 41, 100]) for _ in range(1500)}
    deep = "ab" * 3_000
    counts |= {deep: 5, deep + "b": 20, deep[:-1]: 1, "x" + deep[1:]: 2, "a": 1000, "aa": 7}
    rows = spark.createDataFrame(list(counts.items()), "word string, n int")
    assert variants(spelling.spelling_variants(rows.repartition(5))) == plain_variants(counts)
    assert spelling.spelling_variants(rows.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, 3), ("", 3), ("word", 3)], "word string, n int")
    assert variants(spelling.spelling_variants(odd)) == {"word": (None, "word", 3, 0, None)}


def test_trie_nodes_are_dense_and_shared(spark):
    words = ["b", "ba", "bar", "bat", "car", "cat", "c", "zebra"]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, word string")
    for parts in (1, 3, 20):
        got = {r.word: r.nodes for r in spelling.trie_nodes(rows, F.col("word"), parts).collect()}
        ids = {}
        for w, nodes in got.items():
            assert len(nodes) == len(w) + 1 and nodes[0] == 0
            for i, v in enumerate(nodes):
                assert ids.setdefault(w[:i], v) == v
        assert sorted(ids.values()) == list(range(len(ids)))


# ---- 12
def plain_base(rows):
    tokens = lambda t: [*re.split(r"[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    tokens_of = [(i, [w for w in tokens(t) if w != ""]) for i, t in rows]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, ws in tokens_of if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens_of]


@pytest.mark.parametrize("awkward", [True, False])
def test_neural_scores_base(spark, awkward):
    docs = frame(spark, [*ROWS, (30, "x" * 3000 + " y " + "X" * 3000, "a"), (31, "x" * 3000, "a")]) if awkward else smoke(spark, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = neural_lm.neural_scores(docs).collect()
    key = lambda r: (str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6))
    assert sorted(map(key, got)) == sorted(map(key, plain_base(rows)))
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    again = {}
    for r in got:
        assert math.isclose(again.setdefault((r.doc_id, r.n_tokens), r.score), r.score, rel_tol=1e-9)
    assert neural_lm.neural_scores(docs.limit(0)).count() == 0


def test_listed_and_joined_words_agree(spark):
    """Words outside the list get their counts by the join; the sums are the same."""
    docs = smoke(spark, "documents")
    few = by_id(neural_lm.neural_scores(docs, listed=300))
    for i, r in by_id(neural_lm.neural_scores(docs)).items():
        assert (r["n_known"], r["n_tokens"]) == (few[i]["n_known"], few[i]["n_tokens"])
        assert math.isclose(r["base_score"], few[i]["base_score"], rel_tol=1e-9)
        assert math.isclose(r["score"], few[i]["score"], rel_tol=1e-3)


def test_model_beats_counts_on_held_out_texts(spark):
    """Held-out accuracy: on texts that were not learnt from, the model's probabilities are above the counts'."""
    rows = neural_lm.neural_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").collect()
    n = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / n > sum(r.base_score for r in rows) / n + 0.02


def test_model_probabilities_are_normalised():
    rng = np.random.default_rng(1)
    f = rng.random(50)
    model = neural_lm.Model(f / f.sum(), 8, 2)
    for _ in range(30):
        model.learn(rng.integers(0, 51, (64, 2)), rng.integers(0, 50, 64), rng, 16, 0.1)
    context = np.repeat(rng.integers(0, 51, (20, 2)), 50, axis=0)
    p = np.exp(model.log_probabilities(context, np.tile(np.arange(50), 20), block=7)).reshape(20, 50)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_tables_of_pairs_give_the_summed_probabilities(monkeypatch):
    """Scores come from tables over pairs of outputs, made once, and are those of sums over the outputs of each context."""
    rng = np.random.default_rng(3)
    f = rng.random(50)
    model = neural_lm.Model(f / f.sum(), 8, 2)
    context, target = rng.integers(0, 51, (400, 2)), rng.integers(0, 50, 400)
    for seen in range(2):  # tables do not outlive a step of learning
        summed = model._summed(context, target, 64)
        with monkeypatch.context() as m:
            m.setattr(neural_lm.Model, "_summed", None)
            assert np.allclose(model.log_probabilities(context, target), summed, atol=1e-4)
        model.learn(context, target, rng, 16, 0.3)
    model.q[0] *= 1e6  # beyond the range of floats: summed as before
    model._tables = None
    assert np.isfinite(model.log_probabilities(context, target)).all() and model.tables() is None


def test_model_learns_successions():
    """After some passes over a fixed succession of outputs the next one is nearly certain."""
    f = np.full(10, 0.1)
    model, rng = neural_lm.Model(f, 16, 2), np.random.default_rng(2)
    line = np.arange(2000) % 10
    context, target = np.lib.stride_tricks.sliding_window_view(line, 2)[:-1], line[2:]
    for _ in range(60):
        model.learn(context, target, rng, 32, 0.3)
    assert model.log_probabilities(context, target).mean() > math.log(0.8)


def test_word_runs_cut_at_white_space():
    text = "Aé bC x\n" * 50 + "y" * 200 + "\tz"
    whole = [w for ws in neural_lm.word_runs(text) for w in ws]
    for size in (1, 7, 64):
        assert [w for ws in neural_lm.word_runs(text, size) for w in ws] == whole
    assert whole[:2] == ["aé".encode(), "bc x".encode()] and len(whole[-2]) == 33


# ---- 13
def plain_whitening(vectors, k):
    """By numpy's eigenvectors of the whole covariance."""
    x = {i: np.floor(64 * np.array(v, dtype=float)).astype(np.int64) + 1_000_000 for i, v in vectors.items()}
    u = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(u), u.sum(axis=0)
    c = (n * u - s) / n
    v = c.T @ c / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    return {i: ((n * a - s) / n) @ w / np.sqrt(e) for i, a in x.items()}, e / np.trace(v), n, {i: int(((n * a - s) ** 2).sum()) for i, a in x.items()}


def check_whitening(spark, vectors, k=16, **options):
    rows = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    got = whitening.whitened(rows.repartition(3), k=k, **options).collect()
    want, explained, n, deviation = plain_whitening(vectors, k)
    m = {(r.vec_id, r.component): r for r in got}
    assert len(m) == len(got) == len(vectors) * k
    a = np.array([[m[i, c + 1].whitened for c in range(k)] for i in vectors])
    b = np.array([want[i] for i in vectors])
    assert np.abs(a * np.sign((a * b).sum(axis=0)) - b).max() < 1e-8
    for r in got:
        assert r.n == n and r.deviation == deviation[r.vec_id]
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-9) and r.identity_error < 1e-10


def test_whitening_of_embeddings(spark):
    rows = smoke(spark, "embeddings").collect()
    check_whitening(spark, {r.vec_id: r.embedding for r in rows})


def test_whitening_beyond_the_block(spark):
    """A nearly flat spectrum of more dimensions than the block has columns; the wide block takes one step, the narrow ones rounds."""
    rng = np.random.default_rng(4)
    vectors = dict(enumerate(rng.normal(0, 1 + 0.002 * np.arange(40), (400, 40))))
    for spare in (2, 8, 40):
        check_whitening(spark, vectors, k=6, spare=spare)


def test_whitening_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    base = [(i, [math.sin(i), math.cos(3 * i), i % 3 / 4, 1.0]) for i in range(20)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [nan, 1.0, 1.0, 1.0]), (104, [1.0, inf, 0.0, 0.0]), (105, [1.0, 2.0]),
           (106, [1e300, 0.0, 0.0, 0.0]), (None, base[3][1]), (5, base[5][1])]
    df = spark.createDataFrame(base + odd, "vec_id long, embedding array<double>")
    for c in ("x", "n", "v", "d", "component", "at"):
        df = df.withColumn(c, F.lit("clash"))
    got = whitening.whitened(df).collect()
    # the last entry never varies: three components; repeated rows get equal results, the null id its own
    assert Counter((r.vec_id, r.component) for r in got) == Counter((i, c) for i in [*range(20), 5, None] for c in (1, 2, 3))
    assert {r.n for r in got} == {len({tuple(math.floor(64 * c) for c in v) for _, v in base})}
    by = {}
    for r in got:
        assert by.setdefault((r.vec_id, r.component), r.whitened) == r.whitened
    assert all(by[None, c] == by[3, c] for c in (1, 2, 3))
    for rows in (df.limit(0), df.filter("vec_id >= 100"), df.filter("vec_id = 5")):
        assert whitening.whitened(rows).count() == 0


def test_large_whole_numbers_stay_exact(spark):
    big = 2.0**40
    vectors = [(i, [big + i, (-1) ** i * big, float(i)]) for i in range(6)]
    got = whitening.whitened(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect()
    x = [[math.floor(64 * c) for c in v] for _, v in vectors]
    mean = [Fraction(sum(c), 6) for c in zip(*x, strict=True)]
    exact = [int(sum((6 * a - 6 * b) ** 2 for a, b in zip(v, mean, strict=True))) for v in x]
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 2**63 else None for i, d in enumerate(exact)}
    assert max(r.identity_error for r in got) < 1e-4
    assert whitening.deviations(np.array([[3, 1]]), 2, [2, 2]) == [16]


# ---- 1, 5, 6, 7, 8: column order, clashing names, spans that overlap, repeated ids
def test_extra_columns_follow(spark):
    assert quality_scores(frame(spark), labels_of(spark)).columns == [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"]
    assert dedup_substrings(frame(spark)).columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "n_spans"]


def test_plan_records_ignores_other_columns(spark):
    pages = spark.createDataFrame([(1, "u", "h" * 2000, "t"), (2, "u", "h" * 2000, "t")], "page_id long, url string, html string, time string")
    planned = warc.plan_records(pages.withColumns({c: F.lit("x") for c in ("_last", "_d", "digest", "_first")})).collect()
    assert {r.page_id: r.refers_to for r in planned} == {1: 2, 2: None}


@pytest.mark.parametrize(("text", "want"), [
    ("password=ab4111111111111111Secret9", "password=[SECRET]"), ("iban GB98 WEST 1000 0000 0004 20", "iban [IBAN]"),
    ('{"api_key": "abc12345xyz"}', '{"api_key": "[SECRET]"}'), ("'token' = 'a1b2c3d4e5'", "'token' = '[SECRET]'"),
])
def test_secrets_are_masked_whole(text, want):
    spans = pii.find_spans(text)
    assert pii.masked(text, spans) == want
    assert [s for s in spans if s.kind in pii.BASE_KINDS] == sorted(pii.base_spans(text), key=lambda s: s.start)


def test_texts_that_share_an_id(spark):
    rng = random.Random(9)
    a, b, c = (" ".join(f"{k}{rng.randint(0, 10**6)}" for _ in range(60)) for k in "abc")
    rows = spark.createDataFrame([(5, a), (5, b), (6, a), (7, b), (8, c), (5, a)], "doc_id long, text string")
    for name in ("content", "_content", "_id", "_hash", "kept", "rep"):
        rows = rows.withColumn(name, F.lit("x"))
    assert sorted((r.doc_id, r.class_id, r.kept) for r in minhash.near_duplicates(rows).collect()) == [
        (5, 5, True), (5, 5, True), (5, 5, True), (6, 5, False), (7, 5, False), (8, 8, True)]
    kept = minhash.one_of_each(rows)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(5, a), (5, b), (8, c)])


def test_near_texts_under_one_id(spark):
    """Two texts of one class with the same id: one of them stays."""
    rows = spark.createDataFrame([(5, PROSE), (5, PROSE + " indeed"), (6, PROSE), (9, LONG), (None, PROSE)], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in minhash.one_of_each(rows).collect()) == ["5", "9", "None"]


def test_recall_of_near_copies(spark):
    """At least 0.9 of all links of Jaccard similarity 0.8 and more, against all pairs of the smallest table."""
    from tests.llm import brute

    texts = {r.doc_id: r.text for r in smoke(spark, "documents").collect()}
    want = brute.near_classes(texts)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(smoke(spark, "documents")).collect()}
    linked = [i for i in texts if want[i] != i]
    assert len(linked) > 10 and sum(got[i] == want[i] for i in linked) >= 0.9 * len(linked)
    assert SMOKE
