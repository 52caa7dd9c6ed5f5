"""SimHash near-dedup: fingerprints of word shingles, compared exactly in tiles.

A fingerprint's population counts, one for each quarter of its bits, name its
cell.  Two fingerprints differ in at least as many bits as their quarters'
counts do, so a cell is compared only with the cells whose counts are within
the radius (129 of 83,521 at radius 3); all other tile pairs are skipped and
none that could hold a link is.  A cell is cut into tiles of about ``_TILE``
fingerprints and every tile meets the others as a block: one exclusive-or and
one bit count over the whole block.  What a block finds leaves it as a spanning
forest, so a family of G near copies gives some G links and not G squared.
Distributed union-find joins the links of distinct fingerprints.

The number of comparisons is quadratic in the distinct fingerprints, at 4.6 %
of all pairs for even bits; copies cost nothing, they share a fingerprint.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.functions.core import q
from tablewise.llm import hashing as H
from tablewise.llm.common import arrow_bytes, joined, slices, stored
from tablewise.llm.graph import components

_QUARTERS = 4
_TILE = 1024
_PENDING = 32 * _TILE
_PIECE = 1 << 16
#: Bits of every byte value, for counting bits from a histogram of bytes.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _spaced(raw: np.ndarray) -> np.ndarray:
    """Lower-cased (A-Z) words of one text, joined by single spaces."""
    space = H._IS_SPACE[raw]
    keep = ~space
    keep[1:] |= ~space[:-1]
    out = np.where(space, np.uint8(32), H.LOWER[raw])[keep]
    return out[:-1] if len(out) and out[-1] == 32 else out


def fingerprint(raw: np.ndarray, shingle: int, seed: int) -> int:
    """SimHash of one text's bytes, from the XXH64 of its word shingles, repeats included."""
    text = _spaced(raw)
    if not len(text):
        return 0
    gaps = np.flatnonzero(text == 32)
    n = max(len(gaps) + 2 - shingle, 1)
    starts = np.concatenate([[0], gaps + 1])[:n]
    ends = np.concatenate([gaps, [len(text)]])[-n:]
    data, digest = text.tobytes(), xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _PIECE):
        spans = zip(starts[i:i + _PIECE].tolist(), ends[i:i + _PIECE].tolist())
        h = np.array([digest(data[a:b], seed) for a, b in spans], np.uint64).view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            ones[8 * byte:8 * byte + 8] += np.bincount(h[:, byte], minlength=256) @ _BITS
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _signer(shingle: int, seed: int):
    def sign(batches):
        for batch in batches:
            raw, off = arrow_bytes(batch.column("text"))
            for a, b in slices(off):
                at = off[a:b + 1].tolist()
                fp = np.array([fingerprint(raw[x:y], shingle, seed) for x, y in zip(at, at[1:])], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.array(fp.view(np.int64))], ["id", "fp"])
    return sign


def forest(a: np.ndarray, b: np.ndarray, labels: np.ndarray) -> None:
    """Joins the components of nodes a[i] and b[i] in ``labels`` (least node of each component)."""
    while len(a):
        least = np.minimum(labels[a], labels[b])
        np.minimum.at(labels, labels[a], least)
        np.minimum.at(labels, labels[b], least)
        while True:  # every label becomes a root
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up
        apart = labels[a] != labels[b]
        a, b = a[apart], b[apart]


def _near(base: np.ndarray, others: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in ``base`` x ``others`` (base x base where others is
    empty): pairs of fingerprints."""
    both = np.concatenate([base, others])
    labels = np.arange(len(both))
    first, far = (len(base), others) if len(others) else (0, base)
    for i in range(0, len(far), 256):
        x, y = np.nonzero(np.bitwise_count(far[i:i + 256, None] ^ base[None, :]) <= radius)
        forest(first + i + x, y, labels)
    moved = np.flatnonzero(labels != np.arange(len(both)))
    return both[moved], both[labels[moved]]


def _comparer(radius: int):
    """Rows by tile, the tile's own first, then those of near cells that meet it."""
    def compare(batches):
        base, pending, size = np.zeros(0, np.uint64), [], 0

        def meet():
            nonlocal pending, size
            a, b = _near(base, np.concatenate(pending), radius)
            pending, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            lists = batch.column("fps")
            values, at = np.asarray(lists.values).view(np.uint64), np.asarray(lists.offsets)
            for own, i, j in zip(batch.column("own").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                if own:
                    if size:
                        yield meet()
                    base = values[i:j].copy()
                    pending, size = [np.zeros(0, np.uint64)], 0
                    yield meet()
                else:
                    pending.append(values[i:j].copy())
                    size += j - i
                    if size >= _PENDING:
                        yield meet()
        if size:
            yield meet()
    return compare


def _cell(fp: Column) -> Column:
    """Population counts of the quarters, five bits each."""
    parts = [F.shiftleft(F.bit_count(F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))), 5 * k) for k in range(_QUARTERS)]
    return parts[0] + parts[1] + parts[2] + parts[3]


def _offsets(radius: int) -> list[int]:
    """Cell numbers to add for the near cells, one of each opposite pair.  A count that
    leaves 0..16 gives a number that no cell has."""
    steps = [s for s in product(range(-radius, radius + 1), repeat=_QUARTERS) if sum(map(abs, s)) <= radius]
    return [sum(x << (5 * k) for k, x in enumerate(s)) for s in steps if s > (0,) * _QUARTERS]


def links(fps: DataFrame, radius: int) -> DataFrame:
    """(a, b) links that connect all distinct fingerprints ``fp`` within ``radius`` bits of each other."""
    spark = fps.sparkSession
    celled = stored(fps.select("fp", _cell(F.col("fp")).alias("cell")), "cells")
    # one row a cell: at most 17 ** 4, whatever the input
    size = F.broadcast(stored(celled.groupBy("cell").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(_TILE)).cast("long").alias("tiles")), "cell-sizes"))
    tiles = stored(celled.join(size, "cell").groupBy("cell", F.pmod(F.xxhash64("fp"), "tiles").alias("tile"))
                   .agg(F.collect_list("fp").alias("fps")), "tiles")
    own = tiles.select("cell", "tile", F.lit(True).alias("own"), "fps")
    to = size.select(F.col("cell").alias("to"), "tiles")
    inside = tiles.join(size, "cell").select(
        "cell", F.explode(F.sequence(F.col("tile") + 1, F.col("tiles"))).alias("tile"), "tiles", "fps").where("tile < tiles")
    near = (tiles.select(F.explode(F.transform(F.array(*map(F.lit, _offsets(radius))), lambda x: x + F.col("cell"))).alias("to"), "fps")
            .join(to, "to").select(F.col("to").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), "fps"))
    others = inside.select("cell", "tile", F.lit(False).alias("own"), "fps").unionByName(
        near.select("cell", "tile", F.lit(False).alias("own"), "fps"))
    # a stated count: the rows are few bytes and much work, which adaptive coalescing would gather in one task
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tiles.count() // 64)
    met = (own.unionByName(others).repartition(count, "cell", "tile")
           .sortWithinPartitions("cell", "tile", F.col("own").desc()))
    return met.select("own", "fps").mapInArrow(_comparer(radius), "a long, b long")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   radius: int = 3, seed: int = 42) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    Fingerprints within ``radius`` bits are linked; ``component_id`` is the least
    id reachable.  A text without a word, or a null one, has fingerprint zero,
    which links like any other.  Fewer words than ``shingle`` are one shingle.
    Repeated rows, and different rows of one id, are rows of their own.  A null
    id never is the least one, unless its component has only null ids.  Other
    columns of ``df`` are not read; an empty table gives an empty result.
    """
    texts = df.select(q(id_col).alias("id"), F.coalesce(q(text_col), F.lit("")).alias("text"))
    signed = stored(texts.mapInArrow(_signer(shingle, seed), T.StructType([
        T.StructField("id", texts.schema["id"].dataType), T.StructField("fp", T.LongType())])), "fingerprints")
    classes = stored(signed.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("times")), "classes")
    labels = components(links(classes, radius)).withColumnRenamed("node", "fp")
    placed = classes.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    answer = stored(placed.join(least, "component").select("fp", "times", "component_id"), "answers")
    return joined(signed, answer, "fp", "times").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
