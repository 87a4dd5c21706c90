"""Each operator against its plain version and on awkward rows."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from starbeam.llm import chat, minhash, pii, quality, substring, suffix, tokens, warc
from starbeam.llm.decontam import contaminated_spans, contamination
from starbeam.llm.mixing import Mix, mix_sources, mixed_corpus, permuted
from starbeam.llm.queries import ORACLE_SQL, QUERIES
from starbeam.llm.substring import dedup_substrings
from starbeam.llm.suffix import dedup_suffixes
from tests.conftest import SMOKE
from tests.llm import brute

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards box and nobody ever sees why it was done at all today"
#: (doc_id, text, source): nulls, empty and blank texts, repeated rows, a very long text, non-ASCII spaces
ROWS = [
    (1, PROSE, "a"), (2, PROSE, "a"), (3, PROSE + " indeed", "b"), (4, None, "a"), (5, "", None), (6, " \n\t ", "b"), (7, "one", None),
    (8, LONG, "c"), (9, LONG + " tail", "c"), (10, "é ß x y\x0bz", "b"), (11, PROSE, None), (11, PROSE, None),
    (None, PROSE + " nobody", "a"), (13, "\n".join([PROSE] * 4), "b"), (14, "mail a.b@c.de now, call +1 (555) 123-4567", "a"),
]
CLASH = ["size", "target", "kept", "n_words", "content", "item_id", "key", "n", "band", "ord", "text_hash", "batch", "rep", "start", "window"]


def frame(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for c in CLASH:  # columns of no interest with the names that operators use
        df = df.withColumn(c, F.lit("x"))
    return df


def labels_of(spark, rows=((1, 1, 0), (3, 1, 0), (9, 0, 0), (None, 1, 0), (14, 1, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def texts_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def smoke(spark, name):
    return spark.read.parquet(f"{SMOKE}/{name}.parquet")


def by_id(df):
    out = {}
    for r in df.collect():
        row = r.asDict()
        assert out.setdefault(row["doc_id"], row) == row  # repeated rows get equal results
    return out


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_sql(spark, con, key):
    df = QUERIES[key](spark, SMOKE)
    res = con.execute(ORACLE_SQL[key])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    want = sorted((tuple(dict(zip(names, r))[c] for c in order) for r in res.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in order) for r in df.collect()), key=str) == want


# ---- 1
@pytest.mark.parametrize("awkward", [True, False])
def test_quality_brute_force(spark, awkward):
    docs, labels = (frame(spark), labels_of(spark)) if awkward else (smoke(spark, "documents"), smoke(spark, "labels"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    known = {r.doc_id: (r.quality, r.toxic) for r in labels.collect() if r.doc_id is not None}
    want = {r[0]: r for r in brute.quality(rows, known, quality.THRESHOLD, 4096, 1.0)}
    got = by_id(quality.quality_scores(docs, labels, buckets=4096))
    assert got.keys() == want.keys()
    for i, r in got.items():
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert tuple(r[c] for c in names) == want[i][1:7], i
        assert math.isclose(r["llr"], want[i][7], abs_tol=1e-9)
        assert r["kept"] == want[i][8]


def test_quality_filter_and_empty(spark):
    docs = frame(spark)
    kept = quality.quality_filter(docs, labels_of(spark))
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in quality.quality_scores(docs, labels_of(spark)).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == ids and 4 not in ids and 13 not in ids
    none = quality.quality_scores(docs.limit(0), labels_of(spark))
    assert none.count() == 0
    unlabelled = quality.quality_scores(docs, labels_of(spark).limit(0))
    assert all(r.llr == 0 and r.kept == (not r.base_failed) for r in unlabelled.collect())


# ---- 2
@pytest.mark.parametrize("awkward", [True, False])
def test_mix_targets(spark, awkward):
    docs = frame(spark) if awkward else smoke(spark, "documents")
    rows = [(r.doc_id, r.source, len(brute.words(r.text))) for r in docs.select("doc_id", "source", "text").collect()]
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = brute.targets(sizes)
    got = mix_sources(docs, block=64).collect()
    again = mix_sources(docs.repartition(7), block=64).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert sorted((r.doc_id or -1, r["size"]) for r in got) == sorted((i or -1, n) for i, _, n in rows)
    taken = {}
    by_target = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        by_target.setdefault((r.source_size, round(r.target, 6)), []).append(r.taken)
    for s, n in sizes.items():
        taken.setdefault((n, round(want[s], 6)), 0)
        taken[n, round(want[s], 6)] += round(want[s])
    assert by_target.keys() == taken.keys()
    for k, v in by_target.items():
        assert abs(sum(v) - taken[k]) <= 3  # rounding, where sources share size and target


def test_mix_reads_no_text_for_running_sums(spark):
    mix = Mix(smoke(spark, "documents"))
    sized = mix.docs.select("doc_id", "source", "text", F.length("text").alias("size"), F.xxhash64("text").alias("_hash"))
    plan = mix.placed(sized)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("text#") and plan.count(",text#") == 1  # one relation whose text is read


def test_mix_empty(spark):
    assert mix_sources(frame(spark).limit(0)).count() == 0
    blank = mix_sources(frame(spark, [(1, "", "a"), (2, None, None)])).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in blank] == [(0, 0, 0.0, 0)] * 2


@pytest.mark.parametrize("awkward", [True, False])
def test_mixed_corpus(spark, awkward):
    docs = frame(spark) if awkward else smoke(spark, "documents")
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(" ".join(brute.words(r.text)))
    got = mixed_corpus(docs, block=64, shard=16).collect()
    report = mix_sources(docs, block=64, shard=16).collect()
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.slot)
        assert r.text == " ".join(p.text for p in r.parts) and 0 < len(r.text.split(" ")) <= 64
        assert all(any(f" {p.text} " in f" {t} " for t in texts[p.doc_id]) for p in r.parts)
    assert all(sorted(v) == list(range(16)) for k, v in shards.items() if k != max(shards))
    used = {}
    for r in got:
        for p in r.parts:
            used[p.doc_id] = used.get(p.doc_id, 0) + len(p.text.split(" "))
    taken = {}
    for r in report:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    assert used == {i: n for i, n in taken.items() if n}
    again = mixed_corpus(docs.repartition(7), block=64, shard=16).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    whole = {}
    for r in got:
        for p in r.parts:
            whole.setdefault((r.sid, p.start), set()).update(p.text.split(" "))
    full = {(r.doc_id, r["size"]) for r in report if r.taken >= 2 * r["size"] > 0}  # two whole epochs
    for i, n in full:
        t = next(t for t in texts[i] if len(t.split(" ")) == n)
        assert any(w == set(t.split(" ")) for w in whole.values())
    assert mixed_corpus(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 100, 1025])
def test_permutation(spark, n):
    df = spark.range(n).withColumn("n", F.lit(n).cast("long")).withColumn("k", F.lit(99).cast("long"))
    assert sorted(r.o for r in permuted(df, "id", "n", "k", "o").collect()) == list(range(n))


# ---- 3
@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokens.tokenizer_path(tokens.MODEL))


def test_segments_count_like_whole_texts(pieces):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "b", "the", "é", "▁", "ﬁ", "\x00", "<s>", "</s>", "x", "\r", "　", "日本", "😀", "<0x0A>", "ing"]
    for memory in (8, 10_000):
        counter = tokens.SegmentCounter(lambda t: pieces.encode(t, num_threads=1), memory)
        for _ in range(2000):
            text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
            assert counter.count(text) == len(pieces.encode(text)), text


def test_stretches_join(pieces):
    text = "ab cd\n  ef   gh" * 40 + "x" * 100 + " end "
    assert "".join(tokens.stretches(text, 16)) == text
    counter = tokens.SegmentCounter(lambda t: pieces.encode(t, num_threads=1))
    assert sum(counter.count(t) for t in [text]) == len(pieces.encode(text))


def test_token_counts(spark, pieces):
    docs = frame(spark).unionByName(frame(spark, [(20, LONG * 8, "z")]))
    got = by_id(tokens.token_counts(docs, batch_bytes=1000))
    for r in docs.collect():
        text = r.text or ""
        n = len(pieces.encode(text))
        assert got[r.doc_id] == {"doc_id": r.doc_id, "n_bytes": len(text.encode()), "n_tokens": n, "over_limit": n > 4096}
    assert tokens.token_counts(docs.limit(0)).count() == 0


# ---- 4
def test_suffix_spans_and_texts(spark):
    docs = frame(spark, [r for r in ROWS if r[0] not in (None, 11)])
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    want = brute.suffix_dedup(texts_of(docs))
    got = {r.doc_id: r for r in suffix.deduplicated(docs).collect()}
    assert got.keys() == texts.keys() and any(r.spans for r in got.values())
    for i, r in got.items():
        cut, at = b"", 0
        for s in r.spans:
            assert at <= s.begin < s.end
            cut, at = cut + texts[i][at : s.begin], s.end
        assert bytes(r.kept) == cut + texts[i][at:]
        assert (r.n_bytes, sum(s.end - s.begin for s in r.spans), len(r.spans), brute.sha(bytes(r.kept))) == want[i]


@pytest.mark.parametrize("awkward", [True, False])
def test_suffix_dedup(spark, awkward):
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    rows = [(i, "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 120))) + passage[rng.randint(0, 200) :][: rng.randint(40, 100)], "s")
            for i in range(60)]
    rows += [(70 + i, passage[i:], "s") for i in range(3)] + [(80, "ab" * 400, "s"), (81, "ab" * 30, "s"), (82, "short", "s"), (83, "short", "s")]
    rows += [(i, t, s) for i, t, s in ROWS if i not in (None, 11)] if awkward else []
    rows = [(i + 1000 * (i < 20 and len(rows) > 70), t, s) for i, t, s in rows]
    rows = list({r[0]: r for r in rows}.values())
    want = brute.suffix_dedup([(i, t) for i, t, _ in rows])
    got = by_id(dedup_suffixes(frame(spark, rows)))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == want


def test_suffix_dedup_ids(spark):
    got = [(r.doc_id, r.n_removed) for r in dedup_suffixes(frame(spark, [(1, PROSE, "a"), (1, PROSE, "a"), (None, PROSE, "a"), (0, None, "a")])).collect()]
    assert sorted(got, key=str) == sorted([(1, 0), (1, 0), (None, len(PROSE)), (0, 0)], key=str)
    assert dedup_suffixes(frame(spark).limit(0)).count() == 0


# ---- 5
def test_loser_tree():
    rng = random.Random(2)
    for _ in range(500):
        runs = [sorted((rng.randint(0, 20), i, j) for j in range(rng.randint(0, 9))) for i in range(rng.randint(0, 9))]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_warc_round_trip(spark):
    big = "x" * 1000 + "é\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://B.example/x?b=2&a=1#f", big), (2, "http://b.example/x?a=1&b=2", big), (3, None, None), (4, "", "tiny"), (5, "https://www.a.example:443/", "tiny"),
            (6, "http://a.example/\r\nX: y", big + "other"), (7, "http://a.example/", big), (7, "http://a.example/", big), (None, "http://z/", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("time", F.lit("2024-01-01T00:00:00Z"))
    pages = pages.withColumn("digest", F.lit("clash")).withColumn("path", F.lit(1))
    got = warc.archive_pages(pages, archive_bytes=3000).collect()
    keys = [(r.urlkey, r.time, r.page) for r in got]
    assert keys == sorted(keys) and len(got) == len(rows)
    kinds = sorted((r.page, r.record_type, r.refers_to or "", r.payload_bytes) for r in got)
    n = len(big.encode())
    assert kinds == sorted([("1", "revisit", "7", n), ("2", "revisit", "7", n), ("3", "response", "", 0), ("4", "response", "", 4), ("5", "response", "", 4),
                            ("6", "response", "", n + 5), ("7", "response", "", n), ("7", "response", "", n), ("", "response", "", n)])
    assert warc.url_key("http://B.example/x?b=2&a=1#f") == warc.url_key("http://b.example/x?a=1&b=2") == "example,b)/x?a=1&b=2"
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_index_ranges_follow_its_rows(spark):
    """A hot URL spreads over the ranges, whose number follows the rows."""
    key = F.when(F.col("id") % 3 == 0, "hot,a)/").otherwise(F.concat(F.lit("b)/"), (F.col("id") % 17).cast("string")))
    runs = spark.range(0, 2000, 1, 4).select(
        key.alias("urlkey"), F.concat(F.lit("2024-"), (F.col("id") * 7919 % 2000).cast("string")).alias("time"), F.col("id").cast("string").alias("page"),
        F.concat(F.lit("run"), (F.col("id") % 5).cast("string")).alias("archive"), F.col("id").alias("offset"), F.lit(1).cast("long").alias("length"),
        F.lit("response").alias("record_type"), F.lit(0).cast("long").alias("payload_bytes"), F.lit("").alias("payload_digest"),
        F.lit(None).cast("string").alias("refers_to"))
    got = warc.merged_index(runs, range_rows=100)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 400
    rows = [tuple(r)[:5] for r in got.collect()]
    assert rows == sorted(tuple(r)[:5] for r in runs.collect())


# ---- 6
def test_base_spans_brute_force():
    rng = random.Random(5)
    parts = ["1", "2", "0", "25", "255", "256", ".", ".", "@", "@", "a", "b.c", "-", " ", "+", "(", ")", "_", "%", "4111111111111111", "x.y", "\n", "é",
             "4111 1111 1111 1111", "+1 (555) 123-4567", "a@b.c", "1.2.3.4"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 18)))
        got = [(s.kind, s.start, s.end) for s in pii.find_spans(text) if s.kind in pii.BASE_KINDS]
        assert got == brute.base_spans(text), text


def test_added_spans():
    kinds = lambda t: [s.kind for s in pii.find_spans(t)]
    assert kinds("DE89 3704 0044 0532 0130 00") == ["iban"] and kinds("DE89 3704 0044 0532 0130 01") == []
    assert kinds("ssn 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    assert kinds("card 4222222222222") == ["card13"] and kinds("row 4222222222222") == []
    assert kinds('password="abcd1234efgh"') == ["secret"]
    text = "mail a.b@c.de and +1 (555) 123-4567."
    assert pii.masked(text, pii.find_spans(text)) == "mail [EMAIL] and [PHONE]."


def test_long_secret():
    token = "aB" * 990 + "x1" * 10  # no digit among its first 1,980 characters
    text = f"token={token} end"
    assert [(s.kind, s.start, s.end) for s in pii.find_spans(text)] == [("secret", 6, 6 + len(token))]
    assert pii.masked(text, pii.find_spans(text)) == "token=[SECRET] end"
    text = "password: " + "a1" * 50_000
    assert pii.masked(text, pii.find_spans(text)) == "password: [SECRET]"


@pytest.mark.parametrize("text", ["1" * 100_000, "a" * 100_000, "a.b" * 30_000, "@" * 100_000, "1.1" * 30_000, "+1(" * 30_000, "A" * 100_000])
def test_no_slow_text(text):
    assert pii.find_spans(text) is not None


def test_personal_data(spark):
    docs = frame(spark)
    got = by_id(pii.personal_data(docs))
    for r in docs.collect():
        spans = brute.base_spans(r.text or "")
        row = got[r.doc_id]
        assert [row[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == k for s in spans) for k in pii.BASE_KINDS]
        assert row["base_sha256"] == brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
    assert pii.personal_data(docs.limit(0)).count() == 0
    masked = pii.mask_personal_data(docs)
    assert masked.columns == docs.columns and masked.filter("text IS NULL").count() == 1
    assert masked.filter("doc_id = 14").first().text == "mail [EMAIL] now, call [PHONE]"


# ---- 7
def near_rows():
    rng = random.Random(7)
    base = [f"t{rng.randint(0, 5000)}" for _ in range(150)]
    rows = []
    for i in range(120):  # a large group, from barely to much changed
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6, 9])):
            w[rng.randrange(len(w))] = f"n{rng.randint(0, 10**6)}"
        rows.append((100 + i, " ".join(w), "s"))
    for g in range(15):
        w = [f"g{g}-{rng.randint(0, 400)}" for _ in range(rng.randint(1, 60))]
        rows += [(1000 + 10 * g + k, " ".join(w[: len(w) - k]), "s") for k in range(3)]
    return rows


def test_near_duplicates(spark):
    rows = near_rows() + [r for r in ROWS if r[0] not in (None, 11)]
    want = brute.near_classes({i: t for i, t, _ in rows})
    got = by_id(minhash.near_duplicates(frame(spark, rows)))
    assert {i: r["class_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (r["class_id"] == i) for i, r in got.items())


def test_near_duplicates_rows(spark):
    got = [(r.doc_id, r.class_id, r.kept) for r in minhash.near_duplicates(frame(spark)).collect()]
    assert got.count((11, 1, False)) == 2 and (None, None, True) in got
    assert (4, 4, True) in got and (5, 5, True) in got and (6, 6, True) in got
    assert minhash.near_duplicates(frame(spark).limit(0)).count() == 0


def test_repeated_passages_are_near_duplicates(spark):
    """Sets of shingles of Jaccard 0.8 and more, of which one text holds many far more often than the other."""
    rng = random.Random(17)
    rows = []
    for g in range(40):
        w = [f"g{g}x{rng.randint(0, 10**6)}" for _ in range(200)]
        tail = [f"n{g}x{rng.randint(0, 10**6)}" for _ in range(20)]
        rows += [(10 * g, " ".join(w), "s"), (10 * g + 1, " ".join(w + w[60:130] * 50 + tail), "s")]
    want = brute.near_classes({i: t for i, t, _ in rows})
    assert all(want[10 * g + 1] == 10 * g for g in range(40))
    assert {i: r["class_id"] for i, r in by_id(minhash.near_duplicates(frame(spark, rows))).items()} == want


def test_signatures_of_equal_sets():
    once, often = np.arange(1, 91, dtype=np.uint64), np.repeat(np.arange(1, 91, dtype=np.uint64), np.arange(90) % 40 + 1)
    text = np.repeat([0, 1], [len(once), len(often)])
    a, b = minhash.signatures(text, np.concatenate([once, often]), 2, 80)
    assert (a == b).all()


def test_components_of_a_path(spark):
    n = 40
    edges = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {(r.node, r.component) for r in minhash.components(edges).collect()} == {(i, 0) for i in range(n)}


# ---- 8
def test_substring_rows(spark):
    got = dedup_substrings(frame(spark)).collect()
    n = len(LONG.split())
    by = {r.doc_id: r for r in got}
    assert (by[8].n_words, by[8].n_removed) == (n, n) and (by[9].n_words, by[9].n_removed) == (n + 1, n)
    assert by[4].n_words == by[5].n_words == by[6].n_words == 0 and by[4].kept_sha256 == brute.sha("")
    assert by[1].n_removed == 0 and len(got) == len(ROWS)  # shorter than a window
    assert by[13].n_removed == by[13].n_words  # it repeats itself
    twice = dedup_substrings(frame(spark, [(1, PROSE + " " + PROSE.upper(), "a")] * 2)).collect()
    assert [r.n_removed for r in twice] == [len((PROSE + PROSE).split()) + 1] * 2
    assert dedup_substrings(frame(spark).limit(0)).count() == 0


def test_substring_spans_and_texts(spark):
    want = {r.doc_id: r for r in dedup_substrings(frame(spark)).collect()}
    texts = dict(texts_of(frame(spark)))
    for r in substring.deduplicated(frame(spark)).collect():
        w = brute.words(texts[r.doc_id])
        gone = {k for s in r.spans for k in range(s.begin, s.end)}
        assert r.kept == " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (len(w), len(gone), len(r.spans), brute.sha(r.kept)) == tuple(want[r.doc_id][1:])


# ---- 9
def test_chat_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>user\n<\\|x|>"), (1, 2, "assistant", None), (2, None, None, "a"),
            (2, 1, "tool\n<|im_end|>\"\\", "b"), (None, 0, "assistant", ""), (3, 1, "assistant", "same"), (3, 1, "assistant", "same")]
    rows += [(4, i, ("user", "assistant")[i % 2], f"turn {i} " * 3) for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit(0)).withColumn("piece", F.lit(""))
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv), key=lambda t: (t[0], t[1] or 0, *t[2:]))
        learned = "".join(t for _, _, role, t in turns if role == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == brute.sha("".join(f"{role}\n{t}\n" for _, _, role, t in turns))
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(learned), brute.sha(learned))
        assert got[conv].formatted_chars == len(chat.chatml([(role, t) for _, _, role, t in turns]))
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_rewriting_template_is_found(spark):
    def forgetful(turns):
        """Cuts the text of all turns but the last."""
        return "".join(f"[{role}] {text if i == len(turns) - 1 else text[:3]}\n" for i, (role, text) in enumerate(turns))

    rows = [(1, 0, "user", "hello there"), (1, 1, "assistant", "abc"), (2, 0, "user", "ab"), (2, 1, "assistant", "xyz")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.seq): (r.rewrote, r.begin) for r in chat.format_conversations(df, forgetful).collect()}
    assert got == {(1, 0): (False, None), (1, 1): (True, None), (2, 0): (False, None), (2, 1): (False, len("[user] ab\n[assistant] "))}


def test_templates_of_the_turn_number():
    """Above LONG turns, pieces of a template that counts its turns, and rewrites of turns in the middle."""
    def numbered(turns):
        return "".join(f"{i}:{role}|{text}\n" for i, (role, text) in enumerate(turns))

    def late(turns):
        """Cuts the text of turn 100 once there are 270 turns."""
        return "".join(f"[{role}] {text[:3] if i == 100 and len(turns) >= 270 else text}\n" for i, (role, text) in enumerate(turns))

    turns = [(("user", "assistant")[i % 2], f"turn {i}") for i in range(chat.LONG + 60)]
    renderer = chat.Renderer(numbered, {})
    got = [renderer.add(*t) for t in turns]
    whole = numbered(turns)
    assert "".join(piece for piece, _, _ in got) == whole and not renderer.rewrote
    assert [whole[begin:end] for _, begin, end in got] == [t for _, t in turns]
    renderer = chat.Renderer(late, {})
    assert [renderer.add(*t) and renderer.rewrote for t in turns].index(True) == 269
    renderer = chat.Renderer(chat.chatml, {})
    assert "".join(renderer.add(*t)[0] for t in turns) == chat.chatml(turns) and len(renderer.turns) <= chat.LONG

    def from_the_second(turns):
        return "".join(f"{role}: {f'({i}) ' if i else ''}{text}\n" for i, (role, text) in enumerate(turns))

    renderer, turns = chat.Renderer(from_the_second, {}), [("assistant", "one"), ("assistant", "two")]
    spans = [renderer.add(*t)[1:] for t in turns]
    assert [from_the_second(turns)[begin:end] for begin, end in spans] == ["one", "two"]


def test_declared_by_turn_is_checked():
    """A template that declares by_turn wrongly gets the pieces, spans and rewrites of one that doesn't declare it."""
    def numbered(turns):
        return "".join(f"{i}:{role}|{text}\n" for i, (role, text) in enumerate(turns))

    def late(turns):
        return "".join(f"[{role}] {text[:3] if i == 100 and len(turns) >= 270 else text}\n" for i, (role, text) in enumerate(turns))

    def early(turns):
        """Rewrites below LONG turns."""
        return "".join(f"[{role}] {text if len(turns) < 20 else text[:4]}\n" for role, text in turns)

    for n in (chat.LONG + 5, 3 * chat.LONG):
        turns = [(("user", "assistant")[i % 2], f"turn {i}") for i in range(n)]
        for template in (numbered, late, early):
            want = chat.rendered(template, turns, {})
            template.by_turn = True
            assert chat.rendered(template, turns, {}) == want
            del template.by_turn
        calls = []

        def counted(turns, calls=calls):
            calls.append(len(turns))
            return chat.chatml(turns)

        counted.by_turn = True
        got = chat.rendered(counted, turns, {})
        assert "".join(p for p, *_ in got) == chat.chatml(turns) and not any(r for *_, r in got)
        # whole prefixes: the end's, and those at doublings
        assert [c for c in calls if c > chat.LONG + 1] == ([n] if n < 2 * chat.LONG else [2 * chat.LONG, n])
    assert chat.rendered(chat.chatml, [], {}) == []


def test_escape_round_trip():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choice(["<", "|", "\\", "im_end", ">", "a"]) for _ in range(rng.randint(0, 12)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


# ---- 10
def test_contaminated_spans(spark):
    bench = spark.createDataFrame([(1, PROSE), (2, "Brown FOX jumps!"), (5, "seven-wizards box")], "item_id long, text string")
    docs = frame(spark, [(1, "a brown fox jumps brown fox jumps x seven wizards box", "a"), (2, "none", "a"), (3, PROSE, "a"), (4, None, "a")])
    got = {r.doc_id: ([tuple(s) for s in r.spans], r["items"]) for r in contaminated_spans(docs, bench).collect()}
    n = len(PROSE.split())
    assert got == {1: ([(1, 7), (8, 11)], ["2", "5"]), 2: ([], []), 3: ([(0, n)], ["1", "2", "5"]), 4: ([], [])}


def test_contamination(spark):
    items = [(1, PROSE), (2, "Brown FOX jumps!"), (3, None), (4, "..."), (5, "seven-wizards box"), (2, "Brown FOX jumps!"), (None, "nobody ever sees"), (6, "É ß")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit(1)).withColumn("word", F.lit(""))
    known = {"null" if i is None else i: t for i, t in items}
    docs = frame(spark).unionByName(frame(spark, [(20, PROSE.upper() + " x" * 500, "a"), (21, "fox. brown; FOX jumps", "a"), (22, "é ß É ß", "b")]))
    got = by_id(contamination(docs, bench))
    for r in docs.collect():
        n, hit, found, bad = brute.contamination(r.text, known)
        row = got[r.doc_id]
        assert (row["n_words"], row["n_hit"], row["n_items"], row["items_sha256"], row["contaminated"]) == (n, hit, len(found), brute.sha(",".join(found)), bad), r
    assert contamination(docs, bench).count() == docs.count()
    assert contamination(docs.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in contamination(docs, bench.limit(0)).collect())
