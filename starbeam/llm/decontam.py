"""Benchmark decontamination: a prefix-filtered join, then exact containment.

A benchmark item is cut into windows of ``width`` consecutive words (an item
of fewer words is one window).  A window can only stand in a document that
holds every word of it, the rarest included, so its prefix for the join is
that one word: the benchmark's words are counted over the whole corpus, each
window is keyed by its rarest word, and document words join the windows on
that key.  A pair survives the positional and length bounds (the window must
begin and end inside the document) only if the document's words around the
key equal the window's, word by word.

Document words are dropped before the join where a fixed bitmap of the keys
(2^18 bits, a scalar subquery) says that no window has them; a full bitmap
would cost time, never results.  A document's words never leave it whole:
a candidate carries the ``2 * width - 1`` words around it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frozen

WIDTH = 13
BITS = 18

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII that is neither a digit nor a lower-case letter
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """Words of the text with A-Z lower-cased: runs of digits, a-z and non-ASCII characters; null has none."""
    text = F.coalesce(text, F.lit(""))
    # lower() would change other letters too, so it serves texts of ASCII only
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, NOT_WORD), "")


def place(word: Column, bits: int = BITS) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(1 << bits))


def bitmap(words: DataFrame, column: str, bits: int = BITS) -> Column:
    """Scalar subquery: an array of 2^bits / 64 longs with the bit of each word set."""
    spark, longs = words.sparkSession, (1 << bits) // 64
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("h") % 64).cast("int"))
    filled = words.select(place(F.col(column), bits).alias("h")).distinct()
    filled = filled.groupBy(F.floor(F.col("h") / 64).alias("id")).agg(F.bit_or(one).alias("v"))
    every = spark.range(0, longs, 1, 1).join(filled, "id", "left").select("id", F.coalesce("v", F.lit(0)).alias("v"))
    rows = F.sort_array(F.collect_list(F.struct("id", "v")))
    return every.agg(F.transform(rows, lambda x: x["v"]).alias("bits")).scalar()


def may_hold(bits_array: Column, word: Column, bits: int = BITS) -> Column:
    h = place(word, bits)
    return F.getbit(F.get(bits_array, F.floor(h / 64).cast("int")), (h % 64).cast("int")) == 1


def keyed_windows(benchmark: DataFrame, docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row for each window of each item: item_id, words, key (its rarest word) and at (the key's place in it).

    Rarity is the word's count over all of ``docs``.
    """
    items = benchmark.select("item_id", "text").distinct().select(
        "item_id", F.xxhash64("text").alias("_text"), plain_words(F.col("text")).alias("w"))
    single = frozen(items.select("item_id", "_text", F.posexplode("w").alias("i", "word")), "decontam-items")
    vocabulary = single.select("word").distinct()
    seen = docs.select(F.explode(plain_words(F.col("text"))).alias("word"))
    seen = seen.filter(may_hold(bitmap(vocabulary, "word"), F.col("word")))
    counts = seen.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    ranked = single.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    whole = ranked.groupBy("item_id", "_text").agg(F.sort_array(F.collect_list(F.struct("i", "word", "n"))).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    windows = whole.select("item_id", F.explode(F.transform(starts, lambda s: F.slice(F.col("w"), s, F.lit(width)))).alias("w"))
    rarest = F.array_min(F.transform("w", lambda x, j: F.struct(x["n"].alias("n"), x["word"].alias("word"), j.alias("j"))))
    windows = windows.withColumn("r", rarest)
    return windows.select("item_id", F.transform("w", lambda x: x["word"]).alias("window"),
                          F.col("r.word").alias("key"), F.col("r.j").alias("at")).distinct()


def joined_spans(hits: str) -> Column:
    """Sorted (s, e) as maximal runs (begin, end)."""
    empty = F.array().cast("array<struct<begin:int,end:int>>")
    closed = lambda a: F.when(a["begin"] < 0, a["done"]).otherwise(
        F.concat(a["done"], F.array(F.struct(a["begin"].alias("begin"), a["end"].alias("end")))))
    none = F.struct(empty.alias("done"), F.lit(-1).alias("begin"), F.lit(-1).alias("end"))

    def step(a: Column, x: Column) -> Column:
        on = x["s"] <= a["end"]
        return F.struct(F.when(on, a["done"]).otherwise(closed(a)).alias("done"), F.when(on, a["begin"]).otherwise(x["s"]).alias("begin"),
                        F.when(on, F.greatest(a["end"], x["e"])).otherwise(x["e"]).alias("end"))

    return F.aggregate(hits, none, step, closed)


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, text_hash, n_words, spans, items, n_hit, contaminated.

    ``spans`` are the maximal runs of hit words (begin and end, counted in
    words), ``items`` the ids of the items that hit, as sorted strings.

    A word is hit where it lies inside an occurrence of any item window.  A
    null or empty text has no words and is never contaminated; a null or
    empty item has no windows.  Repeated rows of either table are allowed:
    each document row gets its own result row, an item counts once.  Empty
    tables give an empty or an all-clean result.
    """
    windows = frozen(keyed_windows(benchmark, docs, width), "decontam-windows")
    bits = bitmap(windows, "key")
    around = width - 1
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), plain_words(F.col("text")).alias("_w"))
    # \0, which is in no word, stands before the words: its row carries the document to the result
    marked = F.posexplode(F.concat(F.array(F.lit("\0")), "_w")).alias("p", "word")
    rows = rows.select("doc_id", "text_hash", F.size("_w").alias("n_words"), "_w", marked)
    rows = rows.filter((F.col("p") == 0) | may_hold(bits, F.col("word")))
    low = F.greatest(F.col("p") - 1 - around, F.lit(0))  # the place of the first word that a candidate carries
    rows = rows.select(
        "doc_id", "text_hash", "n_words", "p",
        # carriers are dealt over all partitions
        F.when(F.col("p") > 0, F.col("word")).otherwise(F.concat(F.lit("\0"), F.xxhash64("doc_id", "text_hash").cast("string"))).alias("_key"),
        low.alias("_low"), F.when(F.col("p") > 0, F.slice("_w", low + 1, 2 * around + 1)).alias("_near"),
    )
    first = F.col("p") - 1 - F.col("at")  # where the window would begin
    last = first + F.size("window")
    inside = (first >= 0) & (last <= F.col("n_words"))
    equal = F.when(inside, F.slice("_near", first - F.col("_low") + 1, F.size("window")) == F.col("window")).otherwise(F.lit(False))
    found = rows.join(windows, (rows["_key"] == windows["key"]) & equal, "left")
    is_hit = F.col("window").isNotNull()
    hits = found.groupBy("doc_id", "text_hash", "n_words").agg(
        F.array_sort(F.collect_set(F.when(is_hit, F.struct(first.alias("s"), last.alias("e"))))).alias("_spans"),
        F.collect_set(F.when(is_hit, F.coalesce(F.col("item_id").cast("string"), F.lit("null")))).alias("_items"),
        F.sum(F.when(F.col("p") == 0, 1).otherwise(0)).alias("_copies"),
    )
    out = hits.withColumn("spans", joined_spans("_spans")).withColumn("n_words", F.col("n_words").cast("long"))
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))  # a repeated row gets as many results
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["begin"])
    out = out.select("doc_id", "text_hash", "n_words", "spans", F.array_sort("_items").alias("items"), n_hit.alias("n_hit"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``contaminated_spans`` as counts and a digest: doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated."""
    return contaminated_spans(docs, benchmark, width).select(
        "doc_id", "text_hash", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
