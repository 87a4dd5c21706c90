"""Spelling variants: a word's near words by the nodes of two tries.

Two words are near if one inserted, deleted or replaced character turns one
into the other.  The nodes of the trie of all words are numbered, and those
of the trie of all reversed words: a word is a path of prefix nodes in the
one and of suffix nodes in the other.  A pair (prefix node, suffix node)
stands for the two pieces of a word around a gap.  With one character skipped
in the gap the pair is a *skip* of the word, with none it is a *split*:

* two words with a common skip differ by the character skipped;
* a skip of one word that is a split of another is the other with that
  character put in.  In a run of equal characters only its first is skipped
  for this, so that two words meet once.

Both are equalities of integer pairs, so one shuffle brings near words, and
only these, together.  Words with a common skip differ in one character of a
fixed alphabet, so a group is no larger than the alphabet, however large the
dictionary is; its members take counts and best neighbours from it, and no
pairs leave it.

Numbering is by sorted order.  In a range partition of sorted words a word's
new nodes are those below what it shares with the word before, and are
counted up; what a partition's first word shares with the partition before
is settled with one row a partition: its first word, and its last word's
nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frozen

#: letters A-Z, a-z and the upper half of Latin-1, as the contract of the query names them
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: one in so many occurrences loses a character
SLIP = 97
SPLIT, FIRST_SKIP, SKIP = 0, 1, 2


def word_counts(docs: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): the runs of letters of all whole texts with ``length`` characters that occur ``count`` times.

    A run at which ``slip`` divides the crc32 of ``<doc_id>:<run>`` loses the
    character at the crc32 modulo its length first.  A null doc_id is the
    empty text there.
    """
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = runs.select(F.when(F.col("h") % slip == 0, less).otherwise(F.col("run")).alias("word"))
    return words.filter(F.char_length("word") >= length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= count)


def shared(a: str, b: str) -> int:
    """How many characters two words have in common from their start."""
    if a == b[: len(a)]:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Paths:
    """Numbers the trie nodes of sorted words, from 1 on; the root is 0."""

    def __init__(self) -> None:
        self.last, self.path, self.used = "", [0], 0

    def add(self, word: str) -> list[int]:
        common = shared(self.last, word)
        new = len(word) - common
        self.path = self.path[: common + 1] + list(range(self.used + 1, self.used + new + 1))
        self.last, self.used = word, self.used + new
        return self.path


def trie_nodes(words: DataFrame, word: Column, parts: int | None = None) -> DataFrame:
    """``words`` (word, id) with ``nodes``: the numbers of the trie nodes on the path of ``word``, root first.

    Nodes are numbered from 1 on without gaps, over all words.
    """
    spark = words.sparkSession
    if parts is None:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, paths, pos = TaskContext.get().partitionId(), Paths(), 0
        for batch in batches:
            texts = batch.column("key").to_pylist()
            nodes = [paths.add(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("key"), pa.array(nodes, pa.list_(pa.int64())),
                pa.array([part] * len(texts), pa.int32()), pa.array(range(pos, pos + len(texts)), pa.int64())],
                names=["id", "key", "local", "part", "pos"])
            pos += len(texts)

    dealt = words.select("id", word.alias("key")).repartitionByRange(parts, "key").sortWithinPartitions("key")
    local = frozen(dealt.mapInArrow(run, "id long, key string, local array<long>, part int, pos long"), "spelling-paths")
    # one row a partition: its first word, its last one with its path, and how many nodes it numbered
    ends = local.groupBy("part").agg(
        F.min_by("key", "pos").alias("first"), F.max_by("key", "pos").alias("last"), F.max_by("local", "pos").alias("path"),
        F.max(F.element_at("local", -1)).alias("used")).orderBy("part").collect()
    carried, total, before, last = [], 0, [0], ""
    for e in ends:
        common = shared(last, e.first)
        # nodes 1..common of the partition are its first word's, which the words before have already
        carried.append((e.part, before[: common + 1], total - common))
        before = [before[v] if v <= common else total - common + v for v in e.path]
        last, total = e.last, total + e.used - common
    carry = F.broadcast(spark.createDataFrame(carried, "part int, known array<long>, offset long"))  # a row for each partition
    node = F.transform("local", lambda v: F.when(v < F.size("known"), F.get("known", v.cast("int"))).otherwise(v + F.col("offset")))
    return local.join(carry, "part").select("id", F.col("key").alias("word"), node.alias("nodes"))


def node_pairs(words: DataFrame) -> DataFrame:
    """(left, right, member): the skips and splits of ``words`` (word, n, id) as pairs of node numbers.

    ``member`` is (kind, n, rank): rank is the negative id, so that of equal
    counts the smallest word is the largest member.
    """
    forward = trie_nodes(words, F.col("word"))
    backward = trie_nodes(words, F.reverse("word")).select("id", F.col("nodes").alias("ends"))
    both = forward.join(backward, "id").join(words.select("id", "n"), "id")
    size = F.char_length("word")
    gaps = both.select("id", "n", "word", "nodes", "ends", size.alias("size"), F.explode(F.sequence(F.lit(0), size)).alias("gap"))

    def pair(after: Column, kind: Column) -> Column:
        return F.struct(F.get("nodes", F.col("gap")).alias("left"), F.get("ends", F.col("size") - after).alias("right"),
                        F.struct(kind.cast("byte").alias("kind"), F.col("n"), (-F.col("id")).alias("rank")).alias("member"))

    letter = F.substring("word", F.col("gap") + 1, F.lit(1))
    repeated = (F.col("gap") > 0) & (letter == F.substring("word", F.col("gap"), F.lit(1)))
    split = pair(F.col("gap"), F.lit(SPLIT))
    skip = pair(F.col("gap") + 1, F.when(repeated, F.lit(SKIP)).otherwise(F.lit(FIRST_SKIP)))
    return gaps.select(F.inline(F.when(F.col("gap") < F.col("size"), F.array(split, skip)).otherwise(F.array(split))))


def neighbourhoods(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best): for each word with near words, their number and (n, rank) of the best of them."""
    met = pairs.groupBy("left", "right").agg(F.collect_list("member").alias("members")).filter(F.size("members") > 1)

    def near(a: Column) -> Column:
        def is_near(b: Column) -> Column:
            replaced = (a.kind != SPLIT) & (b.kind != SPLIT) & (a["rank"] != b["rank"])
            inserted = ((a.kind == SPLIT) & (b.kind == FIRST_SKIP)) | ((a.kind == FIRST_SKIP) & (b.kind == SPLIT))
            return replaced | inserted

        others = F.filter("members", is_near)
        return F.struct((-a["rank"]).alias("id"), F.size(others).alias("near"),
                        F.array_max(F.transform(others, lambda b: F.struct(b["n"].alias("n"), b["rank"].alias("rank")))).alias("best"))

    each = met.select(F.inline(F.transform("members", near))).filter("near > 0")
    return each.groupBy("id").agg(F.sum("near").cast("long").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root): where ``forms`` (id, form, n, form_n) lead, followed to the last.

    A form has at least twice the count, so a chain is no longer than the
    logarithm of the largest count; each round doubles the steps followed.
    """
    jump = forms.select("id", F.col("form").alias("root"))
    top, low = forms.agg(F.max("form_n"), F.min("n")).first()
    steps, reached = (0 if top is None else int(top // low).bit_length()), 1
    while reached < steps:
        on = jump.select(F.col("id").alias("via"), F.col("root").alias("next"))
        jump = frozen(jump.join(on, jump["root"] == on["via"], "left").select("id", F.coalesce("next", "root").alias("root")), "spelling-roots")
        reached *= 2
    return jump


def spelling_variants(counts: DataFrame) -> DataFrame:
    """For every row of ``counts`` (word, n; words distinct): word, form, root, n, n_near, form_n.

    A word's form is its near word with the largest n (of several, the
    smallest in code-point order), if that is at least twice the word's own;
    else null.  The root follows forms to the last; it is the word itself
    where there is none.  Null and empty words are left out.  An empty table gives
    an empty result.
    """
    from ..operators.numbering import assign_surrogate_keys

    words = counts.filter("word <> ''").select("word", F.col("n").cast("long").alias("n"))
    # numbers in code-point order
    words = frozen(assign_surrogate_keys(words, ["word"], "id"), "spelling-words")
    found = frozen(neighbourhoods(node_pairs(words)), "spelling-near")
    all_words = words.join(found, "id", "left")
    named = F.col("best.n") >= 2 * F.col("n")
    known = frozen(all_words.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(named, -F.col("best.rank")).alias("form"), F.when(named, F.col("best.n")).alias("form_n")), "spelling-known")
    ends = roots(known.filter("form IS NOT NULL").select("id", "form", "n", "form_n"))
    name = words.select(F.col("id").alias("of"), F.col("word").alias("name"))
    led = known.join(ends, "id", "left")
    led = led.join(name.select(F.col("of").alias("form"), F.col("name").alias("form_word")), "form", "left")
    led = led.join(name.select(F.col("of").alias("root"), F.col("name").alias("root_word")), "root", "left")
    return led.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
