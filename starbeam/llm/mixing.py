"""Mixing sources to target weights.

Each source's documents are packed, in a fixed order, into blocks of
``block`` words (the last one is shorter).  The output is cut into shards of
``shard`` slots.  Every shard draws its source counts from one multinomial
over the sources' quotas; where the draws of all shards together give a
source more slots than its quota, the surplus slots go to the sources that
got too few, so that each source fills its target exactly.  A source's slots
are numbered through the shards.  Slot ``r`` lies in epoch ``r // blocks`` at
place ``r % blocks``; a pseudorandom permutation of the source's block
numbers, one for each epoch, names the block, and slots join blocks by
(source, block).  The last slot of a source takes the first words of its
block only.  A slot's row holds the text of its block; what the mix takes of
a document is counted in these rows.

All draws come from hashes of slot numbers, so reruns agree.  Tables that
grow with the corpus meet only in joins on (source, block); running sums go
over chunks first and then over the chunks' totals, so that a source with a
third of all rows is not one task's work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import frozen, let, words, written

BLOCK = 512
SHARD = 1024
WEIGHTS = (3, 1, 2)
SHARE = 3, 2  # the mix holds 3/2 of all words
SEED = 20240601
#: rows of one task's running sum, about
CHUNK = 4096


def _before(order: Sequence[Column], keys: Sequence[str] = ()) -> Window:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def running_start(df: DataFrame, key: str, chunk: str, order: Sequence[str], value: str, out: str,
                  same: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same ``key`` that come before in (chunk, order).

    ``same`` holds the key, chunk and value of the same rows where it costs less to read than ``df``.
    """
    totals = (df if same is None else same).groupBy(key, chunk).agg(F.sum(value).alias("_t"))
    offsets = totals.select(key, chunk, F.coalesce(F.sum("_t").over(_before([F.col(chunk)], [key])), F.lit(0)).alias("_off"))
    inside = F.coalesce(F.sum(value).over(_before([F.col(c) for c in order], [key, chunk])), F.lit(0))
    return df.withColumn("_in", inside).join(offsets, [key, chunk]).withColumn(out, F.col("_off") + F.col("_in")).drop("_off", "_in")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE,
                   block: int = BLOCK) -> DataFrame:
    """One row for each source: sid, source_size, target, and how its target falls into epochs and blocks.

    Sources in code point order, null last, take ``weights`` in turn and share
    ``share`` of all words; a target stops at twice its source's size, and
    the excess goes to the others by weight until none is above.  That is one
    level for all uncapped sources: with sources by size / weight, a source
    is capped where the level over the rest reaches it.  The windows run over
    one row for each source.
    """
    num, den = share
    everything = Window.partitionBy()
    n = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = n.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    n = n.withColumn("weight", F.get(F.array(*[F.lit(w).cast("long") for w in weights]), F.col("sid") % len(weights)))
    n = n.withColumn("_all", F.sum("source_size").over(everything))
    by_ratio = [F.col("source_size") / F.col("weight"), F.col("sid")]
    n = n.withColumn("_done", F.coalesce(F.sum("source_size").over(_before(by_ratio)), F.lit(0)))
    n = n.withColumn("_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(_before(by_ratio)), F.lit(0)))
    # 2 * size <= level * weight, level = (share * all - 2 * done) / left, in whole numbers
    n = n.withColumn("_capped", F.col("source_size") * 2 * den * F.col("_left")
                     <= (F.col("_all") * num - F.col("_done") * 2 * den) * F.col("weight"))
    n = n.withColumn("_cap_size", F.sum(F.when(F.col("_capped"), F.col("source_size")).otherwise(0)).over(everything))
    n = n.withColumn("_free", F.sum(F.when(F.col("_capped"), 0).otherwise(F.col("weight"))).over(everything))
    shared = ((F.col("_all") * num - F.col("_cap_size") * 2 * den) * F.col("weight")).cast("double") / (F.col("_free") * den)
    n = n.withColumn("target", F.when(F.col("_capped"), F.col("source_size") * 2.0).otherwise(shared))
    n = n.withColumn("_words", F.floor(F.col("target") + 0.5))
    size = F.greatest(F.col("source_size"), F.lit(1))
    n = n.withColumn("full", F.floor(F.col("source_size") / block)).withColumn("blocks", F.ceil(F.col("source_size") / block))
    n = n.withColumn("epochs", F.floor(F.col("_words") / size)).withColumn("rest", F.col("_words") % size)
    n = n.withColumn("quota", F.col("epochs") * F.col("blocks") + F.ceil(F.col("rest") / block))
    n = n.withColumn("first", F.coalesce(F.sum("quota").over(_before([F.col("sid")])), F.lit(0)))
    return n.select("sid", "source", "source_size", "target", "full", "blocks", "epochs", "rest", "quota", "first")


def permuted(df: DataFrame, place: str, n: str, key: str, out: str, rounds: int = 4) -> DataFrame:
    """Add ``out``: a pseudorandom permutation of ``0 .. n - 1``, chosen by ``key``, at ``place``.

    A round mixes the two halves of the bits of the numbers below the
    greatest power of two within ``n`` (two Feistel steps), then rotates all
    numbers by a random amount; both are one to one on ``0 .. n - 1``.
    """
    shl = lambda x, k: F.call_function("shiftleft", x, k)
    shr = lambda x, k: F.call_function("shiftright", x, k)
    one, k, size = F.lit(1).cast("long"), F.col("_k"), F.greatest(F.col(n), F.lit(1)).cast("long")
    low, low_mask, high_mask = F.col("_lo"), shl(one, F.col("_lo")) - 1, shl(one, k - F.col("_lo")) - 1
    draw = lambda x, r: F.xxhash64(x, F.col(key), r)

    def one_round(x: Column, r: Column) -> Column:
        mixed = let(x.bitwiseXOR(draw(shr(x, low), r).bitwiseAND(low_mask)),
                    lambda y: y.bitwiseXOR(shl(draw(y.bitwiseAND(low_mask), r + 1).bitwiseAND(high_mask), low)))
        return (F.when(x < shl(one, k), mixed).otherwise(x) + F.pmod(draw(size, r + 2), size)) % size

    df = df.withColumn("_k", F.length(F.bin(size)) - 1).withColumn("_lo", F.floor(F.col("_k") / 2).cast("int"))
    steps = F.array(*[F.lit(3 * r) for r in range(rounds)])
    return df.withColumn(out, F.aggregate(steps, F.col(place).cast("long"), one_round)).drop("_k", "_lo")


def shard_slots(targets: DataFrame, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """One row for each output slot: shard, sid, r (the slot's number within its source, 0 .. quota - 1)."""
    spark = targets.sparkSession
    total = targets.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    parts = max(1, -(-total // 2_000_000))
    # a slot's draw is a number below the total; bins turn its lookup among the sources' ranges into an equality join
    bins = 1024
    ranges = targets.filter("quota > 0").select(
        "sid", "first", "quota",
        F.explode(F.sequence(F.floor(F.col("first") * bins / total).cast("long"),
                             F.floor((F.col("first") + F.col("quota") - 1) * bins / total).cast("long"))).alias("bin"),
    ) if total else targets.select("sid", "first", "quota", F.lit(0).cast("long").alias("bin")).limit(0)
    drawn = spark.range(0, total, 1, parts).select(
        F.floor(F.col("id") / shard).alias("shard"), F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(max(total, 1))).alias("u"))
    drawn = drawn.withColumn("bin", F.floor(F.col("u") * bins / max(total, 1)).cast("long"))
    counts = (
        drawn.join(ranges, "bin").filter((F.col("u") >= F.col("first")) & (F.col("u") < F.col("first") + F.col("quota")))
        .groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n"))
    )
    counts = counts.withColumn("_chunk", F.floor(F.col("shard") / CHUNK))
    counts = running_start(counts, "sid", "_chunk", ["shard"], "n", "start")
    counts = frozen(counts.join(targets.select("sid", "quota"), "sid").withColumn(
        "kept", F.greatest(F.lit(0), F.least(F.col("n"), F.col("quota") - F.col("start")))), "mix-draws")
    numbers = lambda a, b: F.explode(F.sequence(a, b - 1))
    own = counts.filter("kept > 0").select("shard", "sid", numbers(F.col("start"), F.col("start") + F.col("kept")).alias("r"))
    # surplus and shortage are of the order of the square root of all slots, and of equal size
    over = counts.filter("n > kept").withColumn("m", F.col("n") - F.col("kept"))
    over = over.withColumn("f", F.coalesce(F.sum("m").over(_before([F.col("sid"), F.col("shard")])), F.lit(0)))
    over = over.select("shard", numbers(F.col("f"), F.col("f") + F.col("m")).alias("f"))
    got = targets.select("sid", "quota").join(counts.groupBy("sid").agg(F.sum("n").alias("n")), "sid", "left")
    short = got.withColumn("n", F.coalesce("n", F.lit(0))).filter("n < quota").withColumn("m", F.col("quota") - F.col("n"))
    short = short.withColumn("f", F.coalesce(F.sum("m").over(_before([F.col("sid")])), F.lit(0)))
    short = short.withColumn("k", numbers(F.lit(0).cast("long"), F.col("m")))
    short = short.select("sid", (F.col("n") + F.col("k")).alias("r"), (F.col("f") + F.col("k")).alias("f"))
    return own.unionByName(over.join(short, "f").select("shard", "sid", "r"))


def mixed_blocks(targets: DataFrame, slots: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Slots with their block: the columns of ``slots``, block, n_take (words taken from the block's start)."""
    s = slots.join(targets.select("sid", "full", "blocks", "epochs", "rest"), "sid")
    s = s.withColumn("_epoch", F.floor(F.col("r") / F.col("blocks"))).withColumn("_place", F.col("r") % F.col("blocks"))
    s = s.withColumn("_key", F.xxhash64(F.lit(seed), F.col("sid"), F.col("_epoch")))
    s = permuted(s, "_place", "full", "_key", "_block")
    # the short last block keeps the last place of every epoch
    s = s.withColumn("block", F.when(F.col("_place") < F.col("full"), F.col("_block")).otherwise(F.col("_place")))
    s = s.withColumn("n_take", F.when(F.col("_epoch") < F.col("epochs"), F.lit(block)).otherwise(
        F.least(F.lit(block), F.col("rest") - F.col("_place") * block)))
    return s.select(*slots.columns, "block", "n_take")


def packed_pieces(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """Placed documents (sid, start, doc_id, size, text) cut at block bounds: sid, block, lo (the place of the piece's first
    word in its block), n (its words), doc_id, start (the document's place in its source), text (words with one space between)."""
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)

    def piece(w: Column, b: Column) -> Column:
        lo, hi = F.greatest(F.col("start"), b * block), F.least(F.col("start") + F.col("size"), (b + 1) * block)
        part = F.slice(w, (lo - F.col("start") + 1).cast("int"), (hi - lo).cast("int"))
        return F.struct(b.alias("block"), (lo - b * block).alias("lo"), (hi - lo).alias("n"), F.array_join(part, " ").alias("text"))

    cut = let(words(F.col("text")), lambda w: F.transform(F.sequence(first, last), lambda b: piece(w, b)))
    return placed.select("sid", "start", "doc_id", F.explode(cut).alias("_p")).select(
        "sid", "_p.block", "_p.lo", "_p.n", "doc_id", "start", "_p.text")


def numbered(slots: DataFrame, seed: int = SEED) -> DataFrame:
    """Add ``slot``, 0 .. shard - 1: a shard's slots in pseudorandom order, so that its sources lie mixed."""
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "sid", "r"), "sid", "r")
    return slots.withColumn("slot", F.row_number().over(order) - 1)


class Mix:
    """One mix of ``docs`` (doc_id, text, source): its documents' places, its sources' targets and its texts."""

    def __init__(self, docs: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> None:
        self.docs, self.block, self.shard, self.seed = docs, block, shard, seed
        sized = docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), F.xxhash64("text").alias("_hash"))
        self.sizes = frozen(sized, "mix-sizes")
        self.targets = frozen(source_targets(self.sizes, block=block).coalesce(1), "mix-targets")
        self.n_chunks = self.sizes.agg(F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK), F.lit(1))).first()[0]

    def keyed(self, rows: DataFrame) -> DataFrame:
        named = self.targets.select("sid", F.col("source").alias("_s"))
        return rows.join(named, rows["source"].eqNullSafe(F.col("_s"))).drop("_s", "source")

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows with words and their place ``start`` in their source; it depends on the rows' values only."""
        # the chunks' totals come from the written sizes: no text is split again for them
        return running_start(self.chunked(rows), "sid", "_chunk", ["doc_id", "size", "_hash"], "size", "start", self.chunked(self.sizes))

    def chunked(self, rows: DataFrame) -> DataFrame:
        chunk = F.pmod(F.xxhash64("doc_id", "size"), F.lit(self.n_chunks))
        return self.keyed(rows).filter("size > 0").withColumn("_chunk", chunk)

    def texts(self) -> DataFrame:
        """The mixed corpus, one row for each output slot: shard, slot, sid, text and parts (doc_id, start, text), of which text is made.

        Blocks and slots meet on (sid, block), of which no key has more than
        a block's words and one slot for each epoch.
        """
        sized = self.docs.select("doc_id", "source", "text", F.size(words(F.col("text"))).cast("long").alias("size"), F.xxhash64("text").alias("_hash"))
        pieces = packed_pieces(self.placed(sized), self.block)
        blocks = pieces.groupBy("sid", "block").agg(F.sort_array(F.collect_list(F.struct("lo", "n", "doc_id", "start", "text"))).alias("_pieces"))
        slots = numbered(shard_slots(self.targets, self.shard, self.seed), self.seed)
        picked = mixed_blocks(self.targets, slots, self.block, self.seed)
        left = lambda p: F.col("n_take") - p["lo"]
        cut = lambda p: F.when(p["n"] <= left(p), p["text"]).otherwise(
            F.array_join(F.slice(F.split(p["text"], " "), 1, left(p).cast("int")), " "))
        parts = F.transform(F.filter("_pieces", lambda p: p["lo"] < F.col("n_take")),
                            lambda p: F.struct(p["doc_id"].alias("doc_id"), p["start"].alias("start"), cut(p).alias("text")))
        made = picked.join(blocks, ["sid", "block"]).select("shard", "slot", "sid", parts.alias("parts"))
        return made.select("shard", "slot", "sid", F.array_join(F.col("parts.text"), " ").alias("text"), "parts")

    def report(self, texts: DataFrame) -> DataFrame:
        """For every row of ``docs``: doc_id, size, source_size, target and taken, its words in ``texts``."""
        used = texts.select("sid", F.explode("parts").alias("_p")).select("sid", "_p.start", F.size(words(F.col("_p.text"))).alias("n"))
        used = used.groupBy("sid", "start").agg(F.sum("n").alias("taken"))
        placed = self.placed(self.sizes).select("sid", "start", "doc_id", "size").join(used, ["sid", "start"], "left")
        rows = placed.select("sid", "doc_id", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
        empty = self.keyed(self.sizes).filter("size = 0").select("sid", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
        return rows.unionByName(empty).join(self.targets.select("sid", "source_size", "target"), "sid").select(
            "doc_id", "size", "source_size", "target", "taken")


def mixed_corpus(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """The mix of ``docs`` (doc_id, text, source), see ``Mix.texts``."""
    return Mix(docs, block, shard, seed).texts()


def mix_sources(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED, path: str | None = None) -> DataFrame:
    """For every row of ``docs`` (doc_id, text, source): size, source_size, target and taken, counted in the mix's texts.

    With ``path``, the mixed corpus is written there as Parquet first, and the
    counts are those of its files.  Null and empty texts have size 0 and are
    never taken.  A null source is a source of its own.  Repeated rows and ids
    are packed and counted separately.  An empty table gives an empty result.
    """
    mix = Mix(docs, block, shard, seed)
    texts = mix.texts()
    return mix.report(texts if path is None else written(texts, path))
