"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

The benchmark is the query set.  It is taken in blocks of bounded size; each
block's n-grams are broadcast and two passes go over the documents:

1. count how often every n-gram of the block occurs in the corpus.  A match
   of the score asked for leaves a least number of an item's n-grams unbroken
   (``unbroken``), whatever words were replaced, inserted or left out.  Of the
   n-grams that occur at all, the commonest ones below that number can't be all
   that is left, so the other, rarer ones are the item's seeds and no match
   is without one.  N is the widest for which that number isn't zero: 2 at
   60 %, where an insertion after every second word breaks all 3-grams, and 1
   for items of up to five words;
2. every occurrence of a seed places the item at a passage of the document,
   with as many words on either side as a match can have errors; passages that
   overlap are one.  They are aligned with the item by Smith-Waterman over
   words, many at a time.  A score of 60 % of a perfect match or more is
   contamination, which allows for replaced, inserted and left-out words; the
   words around a match are aligned again, as they may hold another one.

Both passes run inside the scan; only matches leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.functions.core import q
from tablewise.llm import hashing as H
from tablewise.llm.common import arrow_bytes, free_name, row_key, slices, stored, texts_of, without

#: Letters in lower case; ASCII punctuation parts words like white space does.
_PLAIN = H.LOWER.copy()
_PLAIN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 32
MATCH, MISMATCH, GAP = 2, -1, -1


def _words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return H.word_hashes(_PLAIN[raw], off)


def unbroken(length: np.ndarray, n: int, percent: int) -> np.ndarray:
    """N-grams of an item of ``length`` words, at least, that a match of ``percent`` leaves unbroken.

    With m words matched and e errors, ``2 m - e >= 2 length percent / 100``.
    The matched words are in e + 1 runs or fewer, each n - 1 short of its words
    in n-grams; the sum is least where all words match (n > 1)."""
    if n == 1:
        return -(-percent * length // 100)
    return -((100 * (n - 1) - length * (100 - MATCH * (n - 1) * (100 - percent))) // 100)


class Grams:
    """Sorted n-gram hashes of those items of a block that are ``mine``, with where they occur."""

    def __init__(self, words: np.ndarray, at: np.ndarray, n: int, mine: np.ndarray, least: np.ndarray):
        where, rows = H.inside(at, n)
        self.n, self.words, self.at, self.least = n, words, at, least
        h = H.grams(words, n)[where]
        item = np.repeat(np.arange(len(at) - 1), np.diff(rows))
        where, h, item = where[mine[item]], h[mine[item]], item[mine[item]]
        order = np.argsort(h, kind="stable")
        self.h, self.item, self.place = h[order], item[order], (where - at[:-1][item])[order]
        self.gram = np.unique(self.h)

    def filter_bits(self, grams: np.ndarray) -> np.ndarray:
        bits = np.zeros(1 << 20, bool)
        bits[(grams >> np.uint64(44)).astype(np.int64)] = True
        return bits

    def seeds(self, counts: np.ndarray) -> "Grams":
        """Keeps each item's rarest n-grams that occur, all but ``least - 1`` of them (ties with the last one stay)."""
        rare = counts[np.searchsorted(self.gram, self.h)]
        some = np.flatnonzero(rare > 0)
        order = some[np.lexsort((rare[some], self.item[some]))]
        item, rare_o = self.item[order], rare[order]
        first = np.searchsorted(item, np.arange(len(self.at) - 1))
        size = np.bincount(item, minlength=len(self.at) - 1)
        limit = np.zeros(len(size), rare.dtype)
        has = size >= self.least
        limit[has] = rare_o[(first + size - self.least)[has]]
        keep = (rare > 0) & (rare <= limit[self.item])
        self.h, self.item, self.place = self.h[keep], self.item[keep], self.place[keep]
        self.gram = np.unique(self.h)
        return self


def grams_of(words: np.ndarray, at: np.ndarray, n: int, percent: int) -> list[Grams]:
    """N-grams of the items of ``n`` words or more, each item at the widest n that a match can't break everywhere."""
    length, out = np.diff(at), []
    left = length >= n
    for k in range(n, 0, -1):
        least = unbroken(length, k, percent)
        mine = left & (least > 0)
        left &= ~mine
        if mine.any():
            out.append(Grams(words, at, k, mine, np.where(mine, least, 1)))
    return out


def _hits(w: np.ndarray, at: np.ndarray, n: int, grams: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of rows' n-grams that are among ``grams``, and their hashes."""
    where, _ = H.inside(at, n)
    h = H.grams(w, n)[where]
    maybe = np.flatnonzero(bits[(h >> np.uint64(44)).astype(np.int64)])
    h, where = h[maybe], where[maybe]
    spot = np.minimum(np.searchsorted(grams, h), len(grams) - 1)
    sure = grams[spot] == h
    return where[sure], h[sure]


def _counter(shared):
    def count(batches):
        bits = [g.filter_bits(g.gram) for g in shared.value]
        for batch in batches:
            raw, off = arrow_bytes(batch.column("text"))
            seen = [np.zeros(len(g.gram), np.int64) for g in shared.value]
            for a, b in slices(off):
                w, at = _words(raw[off[a]:off[b]], off[a:b + 1] - off[a])
                for g, bit, times in zip(shared.value, bits, seen):
                    _, h = _hits(w, at, g.n, g.gram, bit)
                    times += np.bincount(np.searchsorted(g.gram, h), minlength=len(times))
            for g, times in zip(shared.value, seen):
                some = np.flatnonzero(times)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), g.n)), pa.array(some), pa.array(times[some])],
                                                 ["n", "gram", "times"])
    return count


def align(items: np.ndarray, item_len: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """Best Smith-Waterman score of each row's item against its passage.  Rows are
    word hashes padded with 0 (items) and 1 (passages), which never match."""
    rows, width = passages.shape
    step = -GAP * np.arange(width, dtype=np.int32)
    above = np.zeros((rows, width), np.int32)
    best = np.zeros(rows, np.int32)
    for i in range(items.shape[1]):
        score = np.where(passages == items[:, i:i + 1], MATCH, MISMATCH).astype(np.int32)
        diagonal = np.zeros_like(above)
        diagonal[:, 1:] = above[:, :-1]
        here = np.maximum(np.maximum(diagonal + score, above + GAP), 0)
        here = np.maximum.accumulate(here + step, axis=1) - step  # gaps along the passage
        here[i >= item_len] = 0
        np.maximum(best, here.max(axis=1), out=best)
        above = here
    return best


def located(items: np.ndarray, item_len: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and the one behind the last of the matches that ``align`` scores.
    Cells hold the score in the high half and where their match begins in the low one."""
    rows, width = passages.shape
    fresh = np.arange(1, width + 1)[None, :]
    step = (-GAP * np.arange(width)) << 32
    above = np.broadcast_to(fresh, (rows, width)).copy()
    best, last, every = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.arange(rows)
    for i in range(items.shape[1]):
        score = np.where(passages == items[:, i:i + 1], MATCH, MISMATCH)
        diagonal = np.zeros_like(above)
        diagonal[:, 1:] = above[:, :-1]
        here = np.maximum(np.maximum(diagonal + (score << 32), above + (GAP << 32)), fresh)
        here = np.maximum.accumulate(here + step, axis=1) - step
        here[i >= item_len] = 0
        at = (here >> 32).argmax(axis=1)
        better = here[every, at] >> 32 > best >> 32
        best[better], last[better] = here[every, at][better], at[better] + 1
        above = here
    return best & 0xFFFFFFFF, last


def _shared_words(items: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """How many words of each row's item stand in its passage: no match has more."""
    count = np.zeros(len(items), np.int64)
    for i in range(items.shape[1]):
        count += (passages == items[:, i:i + 1]).any(axis=1)
    return count


def _side_by_side(words: np.ndarray, begin: np.ndarray, length: np.ndarray, pad: int) -> np.ndarray:
    """Rows of ``length`` words from ``begin`` on, padded to one width."""
    i = np.arange(length.max())[None, :]
    return np.where(i < length[:, None], words[np.minimum(i + begin[:, None], len(words) - 1)], np.uint64(pad))


def _occurrences(seeds: list[Grams], bits: list[np.ndarray], w: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Positions at which seeds occur, with the seed's place in its item and the item."""
    out = []
    for g, bit in zip(seeds, bits):
        where, h = _hits(w, at, g.n, g.gram, bit)
        lo, hi = np.searchsorted(g.h, h, "left"), np.searchsorted(g.h, h, "right")
        spread = np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)])[:-1], hi - lo) + np.arange((hi - lo).sum())
        out.append((np.repeat(where, hi - lo), g.place[spread], g.item[spread]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _aligner(shared, ids: pa.Array, percent: int):
    def match(batches):
        seeds = [g for g in shared.value if len(g.gram)]
        bits = [g.filter_bits(g.gram) for g in seeds]
        for batch in batches if seeds else ():
            g, length = seeds[0], np.diff(seeds[0].at)
            raw, off = arrow_bytes(batch.column("text"))
            for a, b in slices(off):
                w, at = _words(raw[off[a]:off[b]], off[a:b + 1] - off[a])
                where, place, item = _occurrences(seeds, bits, w, at)
                if not len(where):
                    continue
                row = np.searchsorted(at, where, "right") - 1
                start = where - place
                # a match has no more errors than ``reach``, so the words of its seeds' passages hold all of it
                order = np.lexsort((start, item, row))
                row, item, start = row[order], item[order], start[order]
                reach = MATCH * (100 - percent) * length // 100
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (start[1:] - start[:-1] > (length + 2 * reach)[item[1:]])
                head = np.flatnonzero(new)
                tail = np.concatenate([head[1:], [len(row)]]) - 1
                row, item = row[head], item[head]
                first = np.maximum(start[head] - reach[item], at[row])
                last = np.minimum(start[tail] + (length + reach)[item], at[row + 1])
                while len(row):
                    score = np.zeros(len(row), np.int64)
                    begin, end = first.copy(), last.copy()
                    for some in _alike(length[item], last - first):
                        n = length[item[some]]
                        left = _side_by_side(g.words, g.at[:-1][item[some]], n, 0)
                        right = _side_by_side(w, first[some], (last - first)[some], 1)
                        able = 100 * _shared_words(left, right) >= percent * n
                        some, n, left, right = some[able], n[able], left[able], right[able]
                        score[some] = align(left, n, right)
                        good = np.flatnonzero(100 * score[some] >= percent * MATCH * n)
                        if len(good):
                            a_word, b_word = located(left[good], n[good], right[good])
                            begin[some[good]] = first[some[good]] + a_word
                            end[some[good]] = first[some[good]] + b_word
                    found = np.flatnonzero(100 * score >= percent * MATCH * length[item])
                    row, item, first, last = row[found], item[found], first[found], last[found]
                    score, begin, end = score[found], begin[found], end[found]
                    yield pa.RecordBatch.from_arrays([
                        batch.column("id").take(pa.array(a + row)), batch.column("key").take(pa.array(a + row)),
                        ids.take(pa.array(item)), pa.array(score / (MATCH * length[item])),
                        pa.array(begin - at[row]), pa.array(end - at[row])],
                        ["id", "key", "item", "similarity", "first", "last"])
                    row, item = np.tile(row, 2), np.tile(item, 2)
                    first, last = np.concatenate([first, end]), np.concatenate([begin, last])
                    room = 100 * (last - first) >= percent * length[item]
                    row, item, first, last = row[room], item[room], first[room], last[room]
    return match


def _alike(item_len: np.ndarray, passage_len: np.ndarray, cells: int = 1 << 21) -> Iterator[np.ndarray]:
    """Rows in groups of similar lengths, each of about ``cells`` matrix cells."""
    order = np.lexsort((passage_len, item_len))
    i = 0
    while i < len(order):
        j = i + max(1, cells // int(max(passage_len[order[i:i + 4096]].max(), 1)))
        j = min(j, i + 4096, len(order))
        yield order[i:j]
        i = j


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", n: int = 3, percent: int = 60,
                 block_bytes: int = 4 << 20) -> DataFrame:
    """(id, key, item, similarity, first, last): one row per document and place
    where it holds a benchmark item; ``first`` and ``last`` bound the match in words.

    Words are lower-cased (A-Z) and parted by white space or ASCII punctuation.
    Items of fewer than ``n`` words, null and empty ones match nothing, as do
    null and empty texts.  Repeated rows match alike.  Empty tables give an
    empty result.  ``block_bytes`` bounds what of the benchmark is broadcast at
    a time; a larger benchmark takes more passes.
    """
    spark = df.sparkSession
    texts = texts_of(df, id_col, text_col)
    items = texts_of(benchmark, item_col, item_text_col)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    schema = T.StructType([
        T.StructField("id", texts.schema["id"].dataType), T.StructField("key", T.LongType()),
        T.StructField("item", items.schema["id"].dataType), T.StructField("similarity", T.DoubleType()),
        T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])
    out = None
    for k in range(blocks):
        block = items.where(F.pmod("key", F.lit(blocks)) == k).select("id", "text").toArrow()
        ids = block.column("id").combine_chunks()
        w, at = _words(*arrow_bytes(block.column("text")))
        grams = grams_of(w, at, n, percent)
        if not grams:
            continue
        counted = texts.select("text").mapInArrow(_counter(spark.sparkContext.broadcast(grams)), "n long, gram long, times long")
        counts = {g.n: np.zeros(len(g.gram), np.int64) for g in grams}
        for row in counted.groupBy("n", "gram").agg(F.sum("times").alias("times")).toLocalIterator():
            counts[row["n"]][row["gram"]] = row["times"]
        seeds = spark.sparkContext.broadcast([g.seeds(counts[g.n]) for g in grams])
        found = texts.mapInArrow(_aligner(seeds, ids, percent), schema)
        out = found if out is None else out.unionAll(found)
    return out if out is not None else spark.createDataFrame([], schema)


def decontaminate(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` without the documents that hold a benchmark item."""
    key = free_name(df, "leak_key")
    leaks = stored(contaminated(df, benchmark, id_col, text_col, **options).select("key").distinct(), "leaks")
    keyed = df.withColumn(key, row_key(q(id_col), F.coalesce(q(text_col), F.lit(""))))
    return without(keyed, leaks, key).select(*(q(c) for c in df.columns))
