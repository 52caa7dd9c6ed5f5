"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree
(native expressions only).

1. Each source's documents are laid on a word axis in a hashed order, which is
   cut into blocks of equal length.  A source's target is its quota of block
   draws: whole epochs, then part of one, whose last block is drawn in part.
2. A binary tree divides the quotas of all sources among the output shards:
   at each node half of the node's draws go left, and how many of each source
   is a multivariate hypergeometric draw (one hypergeometric per source, by
   inversion with a hashed uniform).  Quotas add up exactly at every level.
3. Shard by shard, a source's draws are consecutive places of a permutation of
   its blocks, so shards are disjoint; within a shard a hash gives the order.

Everything follows from hashes of content, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewise.functions.core import q
from tablewise.llm.common import WORD, row_key, stored

#: Parts of a source's axis that are laid out independently, whatever its size.
BUCKETS = 4096
#: Multipliers of the block permutations; a block count has not both as factors.
_PRIMES = (99_999_989, 99_999_971)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_epochs: int = 3) -> DataFrame:
    """(source, source_size, source_no, weight, target) from one row a source.

    Sources in code-point order, null last, weigh 1, 2, 3, repeating, and share
    all words; a target stops at ``most_epochs`` times its source, the excess
    being shared again by weight.  Only this table, a row for each source, is
    ordered as a whole.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    t = sizes.withColumn("source_no", F.row_number().over(order) - 1)
    t = t.withColumn("weight", F.element_at(F.array(*(F.lit(w) for w in weights)), F.col("source_no") % len(weights) + 1))
    t = t.withColumn("most", most_epochs * F.col("source_size"))
    # sources that stop come first by most / weight; each sees what is left before it
    before = W.orderBy(F.col("most") / F.col("weight"), "source_no").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    t = t.withColumns({
        "words_left": F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0)),
        "weight_left": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))})
    stops = F.col("most") * F.col("weight_left") < F.col("words_left") * F.col("weight")
    t = t.withColumn("stops", stops)
    free = F.first(F.when(~F.col("stops"), F.struct("words_left", "weight_left")), ignorenulls=True).over(
        W.orderBy(F.col("most") / F.col("weight"), "source_no").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    t = t.withColumn("free", free)
    share = F.col("weight") * F.col("free.words_left") / F.col("free.weight_left")
    return t.select("source", "source_size", "source_no", "weight",
                    F.when(F.col("stops"), F.col("most")).otherwise(share).cast("double").alias("target"))


def _uniform(*cols: Column) -> Column:
    """In (0, 1), from a hash."""
    return (F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def _hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are marked, by inversion.  The
    probabilities are summed over the support within 12 standard deviations of
    the mean; what lies beyond is below the precision of a double."""
    n, k, d = total.cast("double"), marked.cast("double"), drawn.cast("double")
    mean = d * k / F.greatest(n, F.lit(1.0))
    sd = F.sqrt(F.greatest(mean * (1 - k / F.greatest(n, F.lit(1.0))) * (n - d) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.0)))
    low = F.greatest(F.lit(0.0), d - (n - k), F.floor(mean - 12 * sd - 12).cast("double")).cast("long")
    high = F.least(k, d, F.ceil(mean + 12 * sd + 12).cast("double")).cast("long")
    steps = F.when(high > low, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))
    ratio = lambda x: (k - x) * (d - x) / ((x + 1) * (n - k - d + x + 1))
    one = F.lit(1.0)
    whole = F.aggregate(steps, F.struct(one.alias("w"), one.alias("sum")),
                        lambda s, x: F.struct((s["w"] * ratio(x)).alias("w"), (s["sum"] + s["w"] * ratio(x)).alias("sum")))["sum"]
    return F.aggregate(
        steps, F.struct(one.alias("w"), one.alias("sum"), low.alias("at"), (u * whole).alias("goal")),
        lambda s, x: F.struct(
            (s["w"] * ratio(x)).alias("w"),
            F.when(s["sum"] < s["goal"], s["sum"] + s["w"] * ratio(x)).otherwise(s["sum"]).alias("sum"),
            F.when(s["sum"] < s["goal"], x + 1).otherwise(s["at"]).alias("at"), s["goal"].alias("goal")))["at"]


def split_quotas(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """(source_no, draws) -> (shard, source_no, draws) over 2**depth shards.

    A node's row holds one small struct a source.
    """
    nodes = quotas.select(F.lit(0).cast("long").alias("shard"), "source_no", "draws")
    for level in range(depth):
        listed = nodes.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("source_no", "draws"))).alias("q"),
                                            F.sum("draws").alias("total"))
        start = F.struct(F.col("total").alias("rest"), (F.col("total") / 2).cast("long").alias("take"),
                         F.array().cast("array<struct<source_no:int,draws:bigint,first:bigint>>").alias("out"))

        def place(s: Column, x: Column) -> Column:
            first = _hypergeometric(s["rest"], x["draws"], s["take"],
                                    _uniform(F.lit(seed), F.lit(level), F.col("shard"), x["source_no"]))
            return F.struct((s["rest"] - x["draws"]).alias("rest"), (s["take"] - first).alias("take"),
                            F.concat(s["out"], F.array(F.struct(x["source_no"].alias("source_no"), x["draws"].alias("draws"),
                                                               first.alias("first")))).alias("out"))
        halves = listed.select("shard", F.explode(F.aggregate("q", start, place)["out"]).alias("x"))
        nodes = stored(halves.select(F.explode(F.array(
            F.struct((2 * F.col("shard")).alias("shard"), F.col("x.source_no").alias("source_no"), F.col("x.first").alias("draws")),
            F.struct((2 * F.col("shard") + 1).alias("shard"), F.col("x.source_no").alias("source_no"),
                     (F.col("x.draws") - F.col("x.first")).alias("draws")))).alias("n")).select("n.*"), "quotas")
    return nodes


def _rank(block: Column, blocks: Column, seed: int, *salt: Column) -> Column:
    """Place of ``block`` in a permutation of 0 .. blocks - 1."""
    a, b = (F.when(blocks % x != 0, F.lit(x)).otherwise(F.lit(y)).cast("long") for x, y in (_PRIMES, _PRIMES[::-1]))
    pick = F.when(F.pmod(F.xxhash64(F.lit(seed), *salt), F.lit(2)) == 0, a).otherwise(b)
    return F.pmod(pick * block + F.pmod(F.xxhash64(F.lit(seed + 1), *salt), blocks), blocks)


def laid_out(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[int, ...] = (1, 2, 3), most_epochs: int = 3, seed: int = 7) -> DataFrame:
    """Per row: id, size, source, source_no, source_size, target, start (its
    first word on its source's axis; with size > 0 it names the row)."""
    text = F.coalesce(q(text_col), F.lit(""))
    size = F.regexp_count(text, F.lit(WORD)).cast("long")
    sized = stored(df.select(q(id_col).alias("id"), q(source_col).alias("source"), size.alias("size"),
                             row_key(F.lit(seed), q(id_col), text).alias("h")), "sizes")
    sources = stored(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_epochs), "targets")
    named = sources.select(F.col("source").alias("named"), "source_no", "source_size", "target")
    docs = (sized.join(named, F.col("source").eqNullSafe(F.col("named")), "left").drop("named")
            .withColumn("bucket", F.pmod("h", F.lit(BUCKETS))))
    parts = docs.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    offsets = parts.select("source_no", "bucket", (F.sum("words").over(
        W.partitionBy("source_no").orderBy("bucket")) - F.col("words")).alias("offset"))
    within = F.sum("size").over(W.partitionBy("source_no", "bucket").orderBy("h", "id", "size")
                                .rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    return stored(docs.withColumn("within", within).join(offsets, ["source_no", "bucket"]).select(
        "id", "size", "source", "source_no", "source_size", "target", (F.col("offset") + F.col("within")).alias("start")), "axis")


def mixture(placed: DataFrame, shards: int = 16, block_words: int = 512, seed: int = 7) -> DataFrame:
    """The draws of ``laid_out`` rows: id, source_no, start, shard, shard_order,
    epoch, block, first (word of the document) and words.

    A draw is a part of one document inside one block; a block that is drawn in
    several epochs is listed for each.  ``shards`` is a power of two.
    """
    depth = shards.bit_length() - 1
    if shards != 1 << depth:
        raise ValueError("shards must be a power of two")
    size = F.col("source_size")
    plan = placed.where("size > 0").select("source_no", "source_size", "target").distinct()
    plan = plan.withColumn("length", F.ceil(size / F.greatest(F.round(size / block_words), F.lit(1))).cast("long"))
    plan = plan.withColumn("blocks", F.ceil(size / F.col("length")).cast("long"))
    plan = plan.withColumn("epochs", F.floor(F.col("target") / size).cast("long"))
    plan = plan.withColumn("rest", F.round(F.col("target") - F.col("epochs") * size).cast("long"))
    plan = plan.withColumn("more", F.ceil(F.col("rest") / F.col("length")).cast("long"))
    plan = stored(plan.withColumn("draws", F.col("epochs") * F.col("blocks") + F.col("more")), "plan")
    quotas = split_quotas(plan.select("source_no", "draws"), depth, seed)
    ends = quotas.groupBy("source_no").agg(F.array_sort(F.collect_list(F.struct("shard", "draws"))).alias("shards"))
    plan = stored(plan.join(ends, "source_no").select("source_no", "length", "blocks", "epochs", "rest", "more", "shards"), "plan")

    end = F.col("start") + F.col("size")
    parts = placed.where("size > 0").select("id", "source_no", "start", "size").join(plan, "source_no")
    parts = parts.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / F.col("length")), F.floor((end - 1) / F.col("length")))))
    parts = parts.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs"))))
    parts = parts.withColumn("rank", _rank(F.col("block"), F.col("blocks"), seed, F.col("source_no"), F.col("epoch")))
    parts = parts.where("epoch < epochs or rank < more")
    block_start = F.col("block") * F.col("length")
    full = block_start + F.col("length")
    tail = block_start + F.col("rest") - (F.col("more") - 1) * F.col("length")
    stop = F.when((F.col("epoch") == F.col("epochs")) & (F.col("rank") == F.col("more") - 1), tail).otherwise(full)
    first = F.greatest(F.col("start"), block_start)
    parts = parts.withColumn("words", F.least(end, stop) - first).where("words > 0")
    place = F.col("epoch") * F.col("blocks") + F.col("rank")
    shard = F.aggregate("shards", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).cast("long").alias("at")),
                        lambda s, x: F.struct((s["sum"] + x["draws"]).alias("sum"),
                                              F.when((s["at"] < 0) & (place < s["sum"] + x["draws"]), x["shard"]).otherwise(s["at"]).alias("at")))["at"]
    return parts.select(
        "id", "source_no", "start", shard.alias("shard"),
        F.xxhash64(F.lit(seed), "source_no", "epoch", "block").alias("shard_order"),
        "epoch", "block", (first - F.col("start")).alias("first"), "words")


def write_shards(draws: DataFrame, path: str) -> None:
    """One folder a shard, its draws in the shuffled order."""
    (draws.repartition("shard").sortWithinPartitions("shard", "shard_order", "start", "first")
     .write.partitionBy("shard").parquet(path))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), most_epochs: int = 3, shards: int = 16,
        block_words: int = 512, seed: int = 7) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken.

    Null and empty texts have size 0 and nothing is taken of them; a null
    source is a source, the last.  Repeated rows are separate documents.  An
    empty table gives an empty result.
    """
    placed = laid_out(df, id_col, text_col, source_col, weights, most_epochs, seed)
    taken = mixture(placed, shards, block_words, seed).groupBy("source_no", "start").agg(F.sum("words").alias("taken"))
    got = taken.select(F.col("source_no").alias("of"), F.col("start").alias("at"), "taken")
    out = placed.join(got, (F.col("source_no") == F.col("of")) & (F.col("start") == F.col("at")) & (F.col("size") > 0), "left")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
