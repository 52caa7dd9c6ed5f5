"""The rarest elements of sets, by counts that travel as compressed blocks.

Prefix filtering needs the elements of each set in the order of how many sets of their
family have them.  Sets are dealt into runs of about a million elements.  A run asks once
for each of its distinct elements: 48 bits of a hash of family and element, sorted, as one
compressed block for each range of hashes, with how often the run has them.  The blocks of a
range meet in one task, which answers each with the totals in the same order, and the run, made
again from its sets, orders them by the answers.  So no element is a row before it is known to be
among the rarest of its set.  Elements that share the 48 bits count as one: that can
make an element look less rare, the same for all sets, and never rarer.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewise.llm import hashing as H
from tablewise.llm.common import stored
from tablewise.llm.linebands import planes, values

#: Elements of a run, and of a range of hashes, as powers of 2.
_RUN_BITS = 20
_KEY_BITS = 48
_MOST_TIMES = (1 << 16) - 1


def _grouped(batches, name: str):
    """(value, table) for each run of equal values of a column."""
    at, held = None, []
    for batch in batches:
        v = batch.column(name).to_numpy(zero_copy_only=False)
        cuts = (np.flatnonzero(v[1:] != v[:-1]) + 1).tolist()
        for i, j in zip([0, *cuts], [*cuts, len(v)]):
            if i == j:
                continue
            if held and v[i] != at:
                yield at, pa.Table.from_batches(held)
                held = []
            at = v[i]
            held.append(batch.slice(i, j - i))
    if held:
        yield at, pa.Table.from_batches(held)


def _keys(family: np.ndarray, x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the elements of sets, each with its family."""
    return H.mix(x ^ np.repeat(H.mix(family.view(np.uint64)), np.diff(at))) >> H.U(64 - _KEY_BITS)


def _packed(*parts: tuple[np.ndarray, int]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes(v.astype(np.uint64), width) for v, width in parts))


def _unpacked(block: bytes, *widths: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    n = raw.size // sum(widths)
    ends = np.cumsum([0, *widths]) * n
    return [values(raw[i:j], width) for i, j, width in zip(ends, ends[1:], widths)]


def _asker(sets_in: Callable, ranges: int):
    """Runs of sets -> (range, run, block): their distinct elements, with counts."""
    shift = H.U(_KEY_BITS - (ranges - 1).bit_length())

    def ask(batches):
        for run, rows in _grouped(batches, "run"):
            x, at = sets_in(rows.column("s"))
            keys, times = np.unique(_keys(rows.column("family").to_numpy(), x, at), return_counts=True)
            cut = np.searchsorted(keys >> shift, np.arange(ranges + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(cut)).tolist()
            blocks = [_packed((np.diff(keys[cut[r]:cut[r + 1]], prepend=H.U(0)), _KEY_BITS // 8),
                              (np.minimum(times[cut[r]:cut[r + 1]], _MOST_TIMES), 2)) for r in some]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([run] * len(some), pa.int32()), pa.array(blocks, pa.binary())],
                                             ["range", "run", "block"])
    return ask


def _answerer(batches):
    """The blocks of a range -> (run, range, block): the totals, in each block's own order."""
    for r, rows in _grouped(batches, "range"):
        told = [_unpacked(block, _KEY_BITS // 8, 2) for block in rows.column("block").to_pylist()]
        keys = [np.cumsum(gaps) for gaps, _ in told]
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        times = np.bincount(place, weights=np.concatenate([n for _, n in told])).astype(np.int64)
        ends = np.cumsum([0, *map(len, keys)])
        blocks = [_packed((np.minimum(times[place[i:j]], _MOST_TIMES), 2)) for i, j in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_arrays([rows.column("run").combine_chunks(), pa.array([r] * len(blocks), pa.int32()),
                                          pa.array(blocks, pa.binary())], ["run", "range", "block"])


def _ranker(sets_in: Callable, percent: int):
    """The sets of a run and its answers -> (family, c, n, u, x, rank)."""
    def rank(batches):
        for _, rows in _grouped(batches, "run"):
            asked = np.flatnonzero(rows.column("range").to_numpy() >= 0)
            sets = rows.slice(0, int(asked[0]) if len(asked) else rows.num_rows)
            times = np.concatenate([np.zeros(0, np.uint64), *(_unpacked(block, 2)[0] for block in rows.column("block").take(pa.array(asked)).to_pylist())])
            x, at = sets_in(sets.column("s"))
            family = sets.column("family").to_numpy()
            times = times[np.unique(_keys(family, x, at), return_inverse=True)[1]]
            n = np.diff(at)
            line = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((x, times, line))
            x, times, place = x[order], times[order], np.arange(len(x)) - at[line] + 1
            first = place <= (n + (-percent * n // 100) + 1)[line]
            own = np.bincount(line[first & (times == 1)], minlength=len(n))
            shared = np.flatnonzero(first & (times > 1))
            ends = pa.array(np.searchsorted(line[shared], np.arange(len(n) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array(family), pa.array(sets.column("c").to_numpy()), pa.array(n, pa.int64()), pa.array(own, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(x[shared].view(np.int64))),
                pa.ListArray.from_arrays(ends, pa.array(place[shared].astype(np.int32)))], ["family", "c", "n", "u", "x", "rank"])
    return rank


def rarest(sets: DataFrame, sets_in: Callable, percent: int) -> DataFrame:
    """(family, c, n, u, x, rank) for each of the sets (family, c, n, s), whose elements ``sets_in`` makes of a
    column s: of its rarest elements, so many as two sets of ``percent`` similarity share one of, those x that
    other sets of the family have too, with their ranks by rarity, and the number u of those that none has."""
    spark = sets.sparkSession
    total = sets.agg(F.sum("n")).first()[0] or 0
    runs = 1 + (total >> _RUN_BITS)
    ranges = 1 << (total >> _RUN_BITS).bit_length()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), runs)
    dealt = stored(sets.select(F.pmod(F.xxhash64("c"), F.lit(runs)).cast("int").alias("run"), "family", "c", "s"), "runs")
    asked = dealt.repartition(tasks, "run").sortWithinPartitions("run").mapInArrow(_asker(sets_in, ranges), "range int, run int, block binary")
    told = asked.repartition(max(tasks, ranges), "range").sortWithinPartitions("range").mapInArrow(_answerer, "run int, range int, block binary")
    nothing = [F.lit(None).cast("long").alias("family"), F.lit(None).cast("long").alias("c"), F.lit(None).cast("string").alias("s")]
    both = (dealt.select("run", F.lit(-1).alias("range"), "family", "c", "s", F.lit(None).cast("binary").alias("block"))
            .unionByName(told.select("run", "range", *nothing, "block")))
    return stored(both.repartition(tasks, "run").sortWithinPartitions("run", "range").mapInArrow(
        _ranker(sets_in, percent), "family long, c long, n long, u long, x array<bigint>, rank array<int>"), "ranked")
