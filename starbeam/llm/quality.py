"""Quality rules: a hashed n-gram likelihood ratio beside a few base counts.

Every document is a bag of hashed unigrams and bigrams over ``buckets``
buckets.  Two multinomials are estimated: the *target*, from trusted
documents, and the *raw* one, from all documents.  A document's score is the
mean of ``log(target[b] / raw[b])`` over its n-grams, so its length does not
matter, and a document is kept where the score reaches a fixed threshold;
nothing is drawn at random.

Everything is DataFrame functions.  The corpus is read twice (counts, scores)
and only (bucket, count) partial sums are shuffled.  The weights are an array
of ``buckets`` doubles from a scalar subquery: its size is the parameter, not
the data's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words

#: tokens end at white space and before each of these marks, so a run of marks counts as several tokens
TOKEN_END = r"[ \t\n\x0B\f\r]+|(?=[#*$%&|<>{}=])"
BUCKETS = 1 << 14
SMOOTHING = 1.0
#: nats for each n-gram: clean documents score above -0.1, marked-up or tabulated junk mostly below -0.9
THRESHOLD = -0.25
#: bound on the trusted sample whose ids are broadcast: 20,000 ids, 160 kB
TRUSTED_ROWS = 20_000


def token_hashes(text: Column) -> Column:
    """Hashes of the text's word and mark tokens, in order; a null text has none."""
    tokens = F.split(F.coalesce(text, F.lit("")), TOKEN_END)
    return F.transform(F.array_remove(tokens, ""), lambda t: F.xxhash64(t))


def ngram_hashes(h: Column) -> Column:
    """Hashes of all unigrams and bigrams of a token sequence, repeats kept."""
    pairs = F.transform(F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))), lambda x, i: F.xxhash64(F.get(h, i), x))
    return F.concat(h, pairs)


def bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """At most ``rows`` ids of documents labelled good and not toxic, the lowest by hash."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
    ids = good.select(F.col("doc_id").alias("_trusted")).filter(F.col("_trusted").isNotNull()).distinct()
    return ids.orderBy(F.xxhash64("_trusted"), "_trusted").limit(rows)


def ngram_weights(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING,
                  trusted_rows: int = TRUSTED_ROWS) -> Column:
    """Scalar subquery: array of ``log(target[b] / raw[b])`` by bucket.

    Raw counts cover all of ``docs``.  Without any trusted document the
    weights are all zero, so nothing is rejected by them.
    """
    spark = docs.sparkSession
    flagged = docs.select("doc_id", "text").join(
        F.broadcast(trusted_ids(labels, trusted_rows)), F.col("doc_id") == F.col("_trusted"), "left"
    )
    counts = (
        flagged.select(F.col("_trusted").isNotNull().cast("long").alias("t"),
                       F.explode(let(token_hashes(F.col("text")), ngram_hashes)).alias("h"))
        .groupBy(bucket(F.col("h"), buckets).alias("b")).agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target"))
    )
    every = spark.range(0, buckets, 1, 1).select(F.col("id").cast("int").alias("b")).join(counts, "b", "left")
    table = every.agg(
        F.sort_array(F.collect_list(F.struct("b", F.coalesce("target", F.lit(0)).alias("t"),
                                             F.coalesce("raw", F.lit(0)).alias("r")))).alias("c"),
        F.coalesce(F.sum("target"), F.lit(0)).alias("n_t"), F.coalesce(F.sum("raw"), F.lit(0)).alias("n_r"),
    )
    mass = smoothing * buckets
    ratio = F.transform("c", lambda x: F.when(F.col("n_t") == 0, F.lit(0.0)).otherwise(
        F.log((x["t"] + smoothing) / (F.col("n_t") + mass)) - F.log((x["r"] + smoothing) / (F.col("n_r") + mass))))
    return table.select(ratio.alias("w")).scalar()


def score(text: Column, weights: Column, buckets: int = BUCKETS) -> Column:
    """Mean weight of the text's n-grams; 0 for a text without any."""
    def mean(v: Column) -> Column:
        h, w = v["h"], v["w"]
        at = lambda x: F.get(w, bucket(x, buckets))
        each = F.transform(h, lambda x, i: at(x) + F.when(i > 0, at(F.xxhash64(F.get(h, i - 1), x))).otherwise(F.lit(0.0)))
        return F.when(F.size(h) == 0, F.lit(0.0)).otherwise(
            F.aggregate(each, F.lit(0.0), lambda s, x: s + x) / (2 * F.size(h) - 1))

    return let(F.struct(token_hashes(text).alias("h"), weights.alias("w")), mean)


def window_hashes(wh: Column) -> Column:
    """Hashes of all eight-word windows, from hashes of the words by doubling the length three times."""
    def joined(h: Column, step: int) -> Column:
        return F.transform(F.slice(h, 1, F.greatest(F.size(h) - step, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + step)))

    return let(wh, lambda h1: let(joined(h1, 1), lambda h2: let(joined(h2, 2), lambda h4: joined(h4, 4))))


def words_covered(windows: Column) -> Column:
    """Words inside any eight-word window whose hash occurs twice or more in the text."""
    def covered(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        starts = F.array_sort(F.transform(F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))
        return F.aggregate(
            starts, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-8).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(i - a["last"], F.lit(8))).alias("n"), i.alias("last")),
        )["n"]

    return let(F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered)


def base_counts(docs: DataFrame, id_columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed beside the named columns of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    out = docs.select(*id_columns, "text", words(F.col("text")).alias("_w")).select(
        *id_columns,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.size(F.split(text, r"[#*$%&|<>]")) - 1).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        window_hashes(F.transform("_w", lambda w: F.xxhash64(w))).alias("_h"),
    )
    # only a text that has a repeated window pays for the sort
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    out = out.withColumn("n_repeat_words", F.when(repeats, words_covered(F.col("_h"))).otherwise(F.lit(0).cast("long"))).drop("_h")
    return out.withColumn(
        "base_failed", (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30))


def scored(docs: DataFrame, labels: DataFrame, id_columns: Sequence[str], threshold: float, buckets: int,
           smoothing: float, trusted_rows: int) -> DataFrame:
    weights = ngram_weights(docs, labels, buckets, smoothing, trusted_rows)
    out = docs.select(*id_columns, "text", weights.alias("_weights"))  # a subquery can't stand inside a lambda
    out = out.select(*id_columns, "text", score(F.col("text"), F.col("_weights"), buckets).alias("llr"))
    out = base_counts(out, [*id_columns, "llr"])
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(threshold)))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS,
                   smoothing: float = SMOOTHING, trusted_rows: int = TRUSTED_ROWS) -> DataFrame:
    """Base counts, ``kept`` and ``llr`` (the score) for every row of ``docs`` (doc_id, text); other columns are not read.

    A null or empty text has no words, fails the base rule and is not kept.
    Equal rows get equal results; an empty table gives an empty result; a
    null doc_id is never trusted.  Without labels the ratio keeps everything
    that passes the base rule.
    """
    out = scored(docs, labels, ["doc_id"], threshold, buckets, smoothing, trusted_rows)
    return out.select(*[c for c in out.columns if c != "llr"], "llr")


def quality_filter(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS,
                   smoothing: float = SMOOTHING, trusted_rows: int = TRUSTED_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``quality_scores`` keeps, with all their columns."""
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    whole = docs.select("doc_id", "text", row)
    kept = scored(whole, labels, ["_row"], threshold, buckets, smoothing, trusted_rows).filter("kept")
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
