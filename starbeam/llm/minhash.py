"""Near-duplicate classes: ProbMinHash signatures, banding, verification.

*Signatures.*  A text is a set of shingles of five words, all of one weight
however often they occur, as verification compares sets.  Every shingle is a
Poisson process of rate one: its arrivals come after exponential
steps, each falls on one of ``REGISTERS`` registers, and a register keeps the
shingle that arrived there first.  A shingle is dropped once its next arrival
is later than every register's first, so each costs little more than one
draw.  Two texts' registers agree with the probability of their sets' Jaccard
similarity.

*Banding.*  Equal texts are one candidate.  Texts whose registers agree in
one of ``BANDS`` bands of ``ROWS`` share a bucket.

*Verification.*  A link is a pair of texts in one bucket whose sets of
shingles have a Jaccard similarity of ``SIMILARITY`` or more, computed
exactly; classes are the links' connected components.  No pairs of a whole
bucket are made.  First, each bucket's texts are compared with its most
central text only (the one whose buckets are largest), and linked ones are
merged.  Then the pairs that could still join two classes are compared, all
of them.  Few remain: two texts that share no rare shingle (one of at most
``RARE`` texts) have only core shingles in common, and texts on the fringe of
a group have too few of those; pairs that share a rare shingle are found by
it, and are at most ``RARE`` for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, frozen, let, words
from .wordhash import mix, range_hashes, text_bytes, word_spans

SHINGLE = 5
BANDS, ROWS = 20, 4
SIMILARITY = 0.8
#: a shingle of at most so many open texts is rare
RARE = 128
#: bytes of text that one round of signatures works on
STRETCH = 2 << 20


def shingle_runs(raw: np.ndarray, at: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every shingle; a text of fewer words, but not none, is one shingle."""
    starts, ends, text = word_spans(raw, at)
    h = range_hashes(raw, starts, ends)
    count = np.bincount(text, minlength=len(at) - 1)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    short = np.flatnonzero((count > 0) & (count < width))
    i = np.flatnonzero(text[width - 1 :] == text[: len(text) - width + 1]) if len(text) >= width else np.zeros(0, np.int64)
    begin, end = np.concatenate([i, first[short]]), np.concatenate([i + width, first[short] + count[short]])
    return text[begin], range_hashes(h, begin, end)


def signatures(text: np.ndarray, shingle: np.ndarray, n_texts: int, registers: int) -> np.ndarray:
    """ProbMinHash registers, ``n_texts`` x ``registers``; texts without shingles keep zeros."""
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    text, shingle = text[new], shingle[new]
    earliest = np.full(n_texts * registers, np.inf)
    holder = np.zeros(n_texts * registers, dtype=np.uint64)
    when, step = np.zeros(len(text)), 0
    while len(text):
        draw = mix(shingle + np.uint64((2 * step + 1) * 0x9E3779B97F4A7C15 % 2**64))
        when = when - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53)
        last = earliest.reshape(n_texts, registers).max(axis=1)
        live = when < last[text]  # early termination
        text, shingle, when, draw = text[live], shingle[live], when[live], draw[live]
        spot = text * registers + (mix(draw ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(earliest, spot, when)
        won = when == earliest[spot]
        holder[spot[won]] = shingle[won]
        step += 1
    return holder.reshape(n_texts, registers)


def band_keys(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, content (MD5 of the text) and bands (an array of ``bands`` keys; null without words)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(batch.column("n").to_numpy())
            start = 0
            while start < batch.num_rows:
                done = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, done + STRETCH, side="right")))
                part = batch.slice(start, stop - start)
                start = stop
                raw, at = text_bytes(part.column("text"))
                text, shingle = shingle_runs(raw, at)
                sig = signatures(text, shingle, part.num_rows, bands * rows).reshape(-1, rows)
                key = range_hashes(sig.reshape(-1), np.arange(len(sig)) * rows, np.arange(1, len(sig) + 1) * rows)
                has = np.bincount(text, minlength=part.num_rows) > 0
                ends = np.concatenate([[0], np.cumsum(np.where(has, bands, 0))]).astype(np.int32)
                flat = pa.array(key.reshape(-1, bands)[has].reshape(-1).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(ends), flat, mask=pa.array(~has))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("content"), lists], names=["doc_id", "content", "bands"])

    rows_in = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows_in = rows_in.withColumn("content", F.unhex(F.md5("text"))).withColumn("n", F.octet_length("text").cast("long"))
    return rows_in.mapInArrow(run, f"doc_id {id_type}, content binary, bands array<bigint>")


def shingle_set(text: Column, width: int = SHINGLE) -> Column:
    """The different shingles of a text as 64-bit hashes (JVM side)."""
    def windows(h: Column) -> Column:
        full = F.transform(F.slice(h, 1, F.greatest(F.size(h) - (width - 1), F.lit(0))),
                           lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, width)]))
        return F.when(F.size(h) >= width, full).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    return F.array_distinct(let(F.transform(words(text), lambda w: F.xxhash64(w)), windows))


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of the undirected edges (a, b).

    Alternating large-star and small-star steps: each edge list is written
    before the next step reads it, and the number of rounds grows with the
    logarithm of the longest path.
    """
    e = frozen(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    mark = lambda d: tuple(d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    state = mark(e)
    while state[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.filter("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        small = small.union(low.select("u", F.col("m").alias("v")))
        e = frozen(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        now = mark(e)
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def similar_pairs(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("_b"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("_a", "_b"))
    both = both.select("a", "b", common.alias("i"), (F.size("_a") + F.size("_b")).alias("n"))
    return both.filter(F.col("i") >= similarity * (F.col("n") - F.col("i"))).select("a", "b")


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, content (MD5 of the text), class_id and kept, see ``near_duplicates``.

    What is linked are texts, each a node of its own, so rows that share an
    id and differ in text stay apart unless their texts are near.
    """
    signed = frozen(band_keys(docs, bands, rows), "minhash-bands")
    texts = signed.filter(F.col("bands").isNotNull() & F.col("doc_id").isNotNull()).groupBy("content").agg(
        F.min("doc_id").alias("least_id"), F.max("bands").alias("bands"))
    # a number for each text, fixed by the write
    texts = frozen(texts.withColumn("rep", F.monotonically_increasing_id()), "minhash-texts")
    banded = texts.select("rep", F.posexplode("bands").alias("band", "key"))
    counted = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = frozen(banded.join(counted, ["band", "key"]), "minhash-shared")
    # how central a text is: the sizes of its buckets, all together
    central = shared.groupBy("rep").agg(F.sum("n").alias("score"))
    members = frozen(shared.drop("n").join(central, "rep"), "minhash-members")
    leaders = members.groupBy("band", "key").agg(F.min(F.struct(-F.col("score"), "rep")).alias("l"))
    leaders = leaders.select("band", "key", F.col("l.rep").alias("leader"))
    # one row of each text that shares a bucket
    candidates = texts.join(central.select("rep"), "rep").select("rep", F.col("least_id").alias("doc_id"), "content")
    named = docs.select("doc_id", "text", F.unhex(F.md5("text")).alias("content"))
    sets = named.join(candidates, ["doc_id", "content"]).select("rep", shingle_set(F.col("text")).alias("shingles"))
    sets = frozen(sets.dropDuplicates(["rep"]).filter(F.size("shingles") > 0), "minhash-sets")
    first = members.join(leaders, ["band", "key"]).filter(F.col("rep") != F.col("leader"))
    first = first.select(F.greatest("rep", "leader").alias("b"), F.least("rep", "leader").alias("a")).distinct()
    links = frozen(similar_pairs(first, sets, similarity), "minhash-links")

    # what is left: buckets that hold more than one class
    found = components(links)
    labelled = members.join(found, F.col("rep") == F.col("node"), "left").select(
        "band", "key", "rep", F.coalesce("component", "rep").alias("class"))
    split = labelled.groupBy("band", "key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo <> hi")
    mixed = frozen(labelled.join(split.select("band", "key"), ["band", "key"]), "minhash-mixed")
    open_sets = sets.join(mixed.select("rep").distinct(), "rep", "left_semi")
    single = frozen(open_sets.select("rep", F.size("shingles").alias("n"), F.explode("shingles").alias("s")), "minhash-single")
    often = frozen(single.groupBy("s").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "minhash-often")
    # of a text's shingles, how many some other open text has, and how many more than RARE texts have
    bound = single.join(often, "s").groupBy("rep").agg(
        F.first("n").alias("n"), F.count(F.lit(1)).alias("most"), F.sum(F.when(F.col("df") > RARE, 1).otherwise(0)).alias("core"))
    classed = mixed.select("rep", "class").distinct()
    able = frozen(bound.filter(F.col("most") >= similarity * F.col("n")).join(classed, "rep"), "minhash-able")

    def pairs(rows: DataFrame, on: list[str], most: str, once: Column = F.lit(True)) -> DataFrame:
        """Pairs of two classes that meet in ``on`` and could have enough in common, by the count ``most``."""
        x, y = rows.alias("x"), rows.alias("y")
        meet = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in on]
        common = F.least(f"x.{most}", f"y.{most}")
        fits = common >= similarity * (F.col("x.n") + F.col("y.n") - common)
        both = x.join(y, reduce(and_, [*meet, F.col("x.class") < F.col("y.class"), fits, once]))
        return both.select(F.greatest("x.rep", "y.rep").alias("b"), F.least("x.rep", "y.rep").alias("a"))

    # two texts share a rare shingle, or have only core ones in common
    rare = single.select("rep", "s").join(often.filter(F.col("df") <= RARE).select("s"), "s").join(able, "rep")
    central_pairs = mixed.drop("class").join(able.filter(F.col("core") >= similarity * F.col("n")), "rep")
    central_pairs = central_pairs.join(texts.select("rep", "bands"), "rep")
    # two texts meet in the first band that they have in common, not in each
    earlier = [F.slice(f"{side}.bands", F.lit(1), F.col("x.band")) for side in ("x", "y")]
    first_band = ~F.exists(F.zip_with(*earlier, lambda a, b: a == b), lambda t: t)
    rest = pairs(rare, ["s"], "most").union(pairs(central_pairs, ["band", "key"], "core", first_band)).distinct()
    more = similar_pairs(rest, sets, similarity)
    final = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    classes = texts.select("content", "rep", "least_id").join(final, F.col("rep") == F.col("node"), "left")
    classes = classes.select("content", "least_id", F.coalesce("component", "rep").alias("class"))
    best = classes.groupBy("class").agg(F.min(F.struct("least_id", "content")).alias("best"))
    classes = classes.join(best, "class").select(F.col("content").alias("_c"), "best")
    out = signed.join(classes, (F.col("content") == F.col("_c")) & F.col("bands").isNotNull(), "left")
    class_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("best.least_id", "doc_id"))
    best_one = (F.col("doc_id") == F.col("best.least_id")) & (F.col("content") == F.col("best.content"))
    return out.select("doc_id", "content", class_id.alias("class_id"),
                      (F.col("doc_id").isNull() | F.col("bands").isNull() | best_one).alias("kept"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, class_id (the smallest doc_id of its class), kept.

    ``kept`` is true for the row whose id is the class's, and whose text is,
    where rows of several texts have that id.  Equal texts are of one class.
    Rows that share a doc_id and differ in text belong to the classes of
    their texts; two such classes may bear the same class_id, and each keeps
    a row.  A null or empty text, or one of white space only, has no
    shingles and is a class of its own, as is a row without a doc_id (its
    class_id is null).  Repeated rows get equal results.  An empty table
    gives an empty result.
    """
    return near_classes(docs, similarity, bands, rows).drop("content")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each class of ``near_duplicates``, all without a doc_id."""
    c, i = fresh(docs, "content", "id")
    kept = near_classes(docs, similarity).filter("kept AND doc_id IS NOT NULL")
    kept = kept.select(F.col("doc_id").alias(i), F.col("content").alias(c)).distinct()
    named = docs.filter(F.col("doc_id").isNotNull()).withColumn(c, F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    both = kept.withColumnsRenamed({i: i + "_", c: c + "_"})
    one = named.join(both, (F.col("doc_id") == F.col(i + "_")) & (F.col(c) == F.col(c + "_")), "left_semi").dropDuplicates(["doc_id", c])
    return one.drop(c).unionByName(docs.filter(F.col("doc_id").isNull()))
