"""From shared band hashes to exact similarity components, without pairs inside groups.

Used by the operators that block sets by MinHash bands.  A set is known by its
class id (equal sets are one class).  Candidates are examined in three rounds:

1. Every bucket proposes its star, least class to each other one.  A family of
   G near copies costs G checks and not G squared.
2. Buckets whose other members are still in several components propose a second
   star, around the class with the fewest elements of its own: the one nearest
   to what its family has in common.
3. What is still apart meets by prefix filtering inside its family (classes
   connected by stars): two sets of the similarity asked for share one of their
   rarest elements, so many as the sizes of both leave open.  Independent edits
   of one text share few rare elements, so a family makes few pairs, and none
   that is similar enough is left out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewise.llm import hashing as H
from tablewise.llm.common import MOST_KEYS, stored
from tablewise.llm.graph import components

SKETCH_BITS = 512
#: Largest bucket whose classes all meet each other.
MOST_MET = 1 << 13


def sketches(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sketches, ``SKETCH_BITS / 64`` longs each, of the sets of distinct elements ``h[at[i]:at[i+1]]``."""
    group = (H.mix(h) % H.U(SKETCH_BITS)).astype(np.int64)
    n = len(at) - 1
    times = np.bincount(np.repeat(np.arange(n), np.diff(at)) * SKETCH_BITS + group, minlength=n * SKETCH_BITS)
    return np.packbits((times & 1).astype(np.uint8).reshape(n, SKETCH_BITS), axis=1).view(np.int64)


def equal_elements(both: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets, arrays of hashes, have the Jaccard similarity asked for."""
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= percent * (F.col("na") + F.col("nb") - common)).select("a", "b")


def rarest_elements(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of sets (family, c, n, s), arrays of hashes, their rarest elements (family, x, c, n, rank), so many as two
    sets of the similarity share one of, and (c, n, u), u of those being in no other set of the family."""
    listed = stored(sets.select("family", "c", F.explode("s").alias("x")), "elements")
    times = listed.groupBy("family", "x").agg(F.count(F.lit(1)).alias("times"))
    order = W.partitionBy("c").orderBy("times", "x")
    ranked = (listed.join(times, ["family", "x"]).withColumn("rank", F.row_number().over(order))
              .join(sets.select("c", "n"), "c").where(F.col("rank") <= F.col("n") - F.ceil(percent * F.col("n") / 100) + 1))
    ranked = stored(ranked, "ranked")
    own = ranked.where("times = 1").groupBy("c").agg(F.count(F.lit(1)).alias("u"))
    return ranked, sets.select("c", "n").join(own, "c", "left").select("c", "n", F.coalesce("u", F.lit(0)).alias("u"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, similar: Callable = equal_elements) -> DataFrame:
    """Pairs (a, b) of classes whose sets (c, n, s) have the similarity asked for."""
    left = sets.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    right = sets.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    return similar(pairs.join(left, "a").join(right, "b").where(
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")), percent)


def _reachable(n1: Column, u1: Column, n2: Column, u2: Column, percent: int) -> Column:
    """Whether sets of n1 and n2 elements, u1 and u2 of them in no other set, can be similar."""
    common = F.least(n1 - u1, n2 - u2)
    return 100 * common >= percent * (n1 + n2 - common)


def _apart(placed: DataFrame) -> DataFrame:
    """Rows of buckets that hold several components."""
    mixed = (placed.groupBy("b").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo <> hi").select("b"))
    return placed.join(mixed, "b")


def _placed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return (rows.join(labels.withColumnRenamed("node", "c"), "c", "left")
            .withColumn("component", F.coalesce("component", "c")))


def _rare_meetings(ranked: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes of one family and different components that share
    an element among the first ones, by rarity, that both sizes leave open."""
    rows = ranked.join(placed, "c").select("family", "x", "c", "n", "rank", "component")
    other = rows.select("family", "x", F.col("c").alias("c2"), F.col("n").alias("n2"), F.col("rank").alias("rank2"),
                        F.col("component").alias("component2"))
    need = F.ceil(percent * (F.col("n") + F.col("n2")) / (100 + percent))
    return (rows.join(other, (rows["family"] == other["family"]) & (rows["x"] == other["x"])
                      & (F.col("component") < F.col("component2"))
                      & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2"))
                      & (F.col("rank") <= F.col("n") - need + 1) & (F.col("rank2") <= F.col("n2") - need + 1))
            .select(F.least("c", "c2").alias("a"), F.greatest("c", "c2").alias("b")).distinct())


def _bucket_meetings(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes (b, c, component) of one bucket and different components whose
    sketches m leave them similar; the rest are not rows."""
    rows = placed.join(sets.select("c", "n", "m"), "c").select("b", "c", "component", "n", "m")
    other = rows.select(F.col("b").alias("b2"), *[F.col(x).alias(f"{x}2") for x in ("c", "component", "n", "m")])
    differ = sum((F.bit_count(F.col("m")[i].bitwiseXOR(F.col("m2")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    need = F.ceil(percent * (F.col("n") + F.col("n2")) / (100 + percent))
    return (rows.join(other, (F.col("b") == F.col("b2")) & (F.col("component") < F.col("component2"))
                      & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2"))
                      & (F.col("n") + F.col("n2") - differ >= 2 * need))
            .select(F.least("c", "c2").alias("a"), F.greatest("c", "c2").alias("b")).distinct())


def linked(members: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int,
           similar: Callable = equal_elements, rarest: Callable = rarest_elements) -> DataFrame:
    """(node, component) of the classes that have a link.

    ``members`` is (b, c), bucket and class, with repeats at will.  ``sets_of``
    gives (c, n, s), a class with the size and elements of its set, for a table
    of classes, one row each, and may give their sketches m.  Where s is something else than an array of
    hashes, ``similar`` and ``rarest`` compare it and give its rarest elements.
    """
    buckets = stored(members.groupBy("b").agg(F.min("c").alias("lead"), F.max("c").alias("last"))
                     .where("lead <> last").select("b", "lead"), "buckets")
    if buckets.limit(MOST_KEYS + 1).count() <= MOST_KEYS:  # two longs a row
        buckets = F.broadcast(buckets)
    shared = stored(members.join(buckets, "b").where("c <> lead"), "buckets")
    stars = stored(shared.select(F.col("lead").alias("a"), F.col("c").alias("b")).distinct(), "stars")
    sets = stored(sets_of(stars.select(F.explode(F.array("a", "b")).alias("c")).distinct()), "sets")
    links = stored(confirmed(stars, sets, percent, similar), "links")
    labels = components(links)
    # the lead's pairs are done; what is left are those of the others
    apart = stored(_apart(_placed(shared.select("b", "c").distinct(), labels)), "apart")
    if not apart.limit(1).count():
        return labels

    if "m" in sets.columns:
        times = apart.groupBy("b").agg(F.count(F.lit(1)).alias("times"))
        few = apart.join(times.where(F.col("times") <= MOST_MET).select("b"), "b")
        met = _bucket_meetings(few, sets, percent).join(
            stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
        more = stored(confirmed(met, sets, percent, similar), "links")
        if more.limit(1).count():
            links = links.unionAll(more)
            labels = components(links)
        many = apart.select("b", "c").join(times.where(F.col("times") > MOST_MET).select("b"), "b")
        apart = stored(_apart(_placed(many, labels)), "apart")
        if not apart.limit(1).count():
            return labels

    families = components(stars).select(F.col("node").alias("c"), F.col("component").alias("family"))
    classes = apart.select("c").distinct().join(families, "c")
    ranked, size = rarest(sets.join(classes, "c").select("family", "c", "n", "s"), percent)
    apart = stored(apart.join(size, "c"), "apart")
    lead = apart.groupBy("b").agg(F.min(F.struct("u", "c", "component", "n")).alias("lead"))
    second = stored(
        apart.join(lead, "b").where(F.col("component") != F.col("lead.component"))
        .where(_reachable(F.col("n"), F.col("u"), F.col("lead.n"), F.col("lead.u"), percent))
        .select(F.least("c", "lead.c").alias("a"), F.greatest("c", "lead.c").alias("b")).distinct()
        .join(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "stars")
    more = stored(confirmed(second, sets, percent, similar), "links")
    if more.limit(1).count():
        links = links.unionAll(more)
        labels = components(links)

    left = _apart(_placed(apart.select("b", "c"), labels)).select("c", "component").distinct()
    rest = _rare_meetings(ranked, left, percent).join(
        stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).unionAll(second), ["a", "b"], "left_anti")
    last = stored(confirmed(rest, sets, percent, similar), "links")
    return components(links.unionAll(last)) if last.limit(1).count() else labels
