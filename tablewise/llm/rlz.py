"""Substring dedup by relative Lempel-Ziv parsing against an index of the whole corpus.

Every document is a reference block.  The index holds its anchors: of each
window of 35 words the 8-gram with the least hash, so equal windows have equal
anchors at equal places, and each window belongs to one anchor.  The run of
windows of one anchor is a phrase (35 to 62 words).

* Anchors that occur once in the corpus end a factor and are dropped first.
* A phrase that recurs as a whole extends the factor greedily by all of its
  words; one reference occurrence stands for all of them, so thousands of
  copies cost one row each and never meet in pairs.
* Where an anchor recurs but its phrase does not, a factor ends inside the
  phrase.  There, and only there, single windows are compared, again one
  reference occurrence for each phrase.

A factor is a duplicate span if it has 35 words or more, which every phrase
and every window has.  The result equals that of comparing all windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.functions.core import q
from tablewise.llm import hashing as H
from tablewise.llm.common import arrow_bytes, free_name, narrowed, row_key, slices, stored, texts_of

U = np.uint64


def _least_of(x: np.ndarray, n: int) -> np.ndarray:
    """Least value of each n consecutive ones."""
    size = 1
    while size * 2 <= n:
        x = np.minimum(x[:len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (n - size)], x[n - size:]) if size < n else x


def phrases(w: np.ndarray, at: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Phrases of the rows at ``at``: row, first window, number of windows,
    anchor hash, phrase hash (of its words and the anchor's place)."""
    where, _ = H.inside(at, window)
    if not len(where):
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    small, large = H.grams(w, anchor), H.grams(w, window)
    bits = U(max(int(len(small)).bit_length(), 1))
    ranked = ((small >> bits) << bits) | np.arange(len(small), dtype=np.uint64)
    owner = (_least_of(ranked, window - anchor + 1)[where] & ((U(1) << bits) - U(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    last = np.concatenate([first[1:], [len(where)]]) - 1
    a, b, p = where[first], where[last], owner[first]
    row = np.searchsorted(at, a, "right") - 1
    whole = H.join_grams(large[a], large[b], 0x1D8E4E27C47D124F)
    whole = H.mix(whole + ((b - a).astype(np.uint64) << U(32)) + (p - a).astype(np.uint64))
    return row, a - at[row], b - a + 1, small[p], whole


def _indexer(window: int, anchor: int):
    def index(batches):
        for batch in batches:
            raw, off = arrow_bytes(batch.column("text"))
            keys = batch.column("key").to_numpy()
            for i, j in slices(off):
                w, at = H.word_hashes(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                row, start, n, small, whole = phrases(w, at, window, anchor)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[i + row], pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()),
                    pa.array(small.view(np.int64)), pa.array(whole.view(np.int64))],
                    ["key", "start", "n", "anchor", "phrase"])
    return index


def _list_column(column: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.offsets, np.int64), column.values


def _windower(window: int):
    def windows(batches):
        for batch in batches:
            raw, off = arrow_bytes(batch.column("text"))
            keys = batch.column("key").to_numpy()
            ends, marks = _list_column(batch.column("marks"))
            start, n = (np.asarray(marks.field(k), np.int64) for k in ("start", "n"))
            for i, j in slices(off):
                w, at = H.word_hashes(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                s, m = start[ends[i]:ends[j]], n[ends[i]:ends[j]]
                row = np.repeat(np.arange(j - i), np.diff(ends[i:j + 1]))
                row, first = np.repeat(row, m), np.repeat(s - (np.cumsum(m) - m), m)
                s = first + np.arange(len(row))
                h = H.grams(w, window)[at[row] + s] if len(s) else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[i + row], pa.int64()), pa.array(s, pa.int64()), pa.array(h.view(np.int64))],
                    ["key", "start", "h"])
    return windows


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   anchor: int = 8) -> DataFrame:
    """(key, spans) of the documents that hold a window of ``window`` words which
    also starts anywhere else; spans are [start, end) in words, unmerged.

    ``key`` is ``row_key`` of id and text: rows equal in both share it, and each
    makes the other's windows repeat.  Null and empty texts have no windows; an
    empty table gives an empty result; no other column is read.
    """
    texts = texts_of(df, id_col, text_col).select("key", "text")
    index = stored(texts.mapInArrow(_indexer(window, anchor), "key long, start long, n long, anchor long, phrase long"), "index")
    recurring = index.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("anchor")
    index = stored(index.join(recurring, "anchor", "left_semi"), "recurring")
    kinds = stored(index.groupBy("anchor", "phrase").agg(
        F.count(F.lit(1)).alias("times"), F.min("key").alias("reference")), "phrases")

    factors = (index.join(kinds.where("times > 1").select("anchor", "phrase"), ["anchor", "phrase"], "left_semi")
               .select("key", "start", (F.col("start") + F.col("n") + window - 1).alias("end")))

    # factor ends: the anchor has several phrases, each shown by its reference occurrence
    split = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("phrases")).where("phrases > 1").select("anchor")
    open_ends = kinds.join(split, "anchor", "left_semi").select("anchor", "phrase", F.col("reference").alias("key"))
    marks = stored(index.join(open_ends, ["anchor", "phrase", "key"], "left_semi")
                   .groupBy("key").agg(F.collect_set(F.struct("start", "n")).alias("marks")), "marks")
    ends = stored(narrowed(texts, marks.select("key")).join(marks, "key").dropDuplicates(["key"])
                  .mapInArrow(_windower(window), "key long, start long, h long"), "windows")
    again = ends.groupBy("h").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("h")
    checked = ends.join(again, "h", "left_semi").select("key", "start", (F.col("start") + window).alias("end"))

    return stored(factors.unionAll(checked).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")


def _cutter(digest: bool):
    """Drops the words inside the spans (none where there is no spans column)."""
    def cut(batches):
        for batch in batches:
            names = batch.schema.names
            texts = batch.column("text").to_pylist()
            if "spans" in names:
                ends, spans = _list_column(batch.column("spans"))
                start, end = (np.asarray(spans.field(k), np.int64) for k in ("start", "end"))
            total, removed, kept = [], [], []
            for i, text in enumerate(texts):
                parts = (text or "").encode().split()
                total.append(len(parts))
                if "spans" in names:
                    inside = np.zeros(len(parts) + 1, np.int64)
                    np.add.at(inside, start[ends[i]:ends[i + 1]], 1)
                    np.subtract.at(inside, end[ends[i]:ends[i + 1]], 1)
                    inside = np.cumsum(inside[:-1])
                    parts = [p for p, n in zip(parts, inside.tolist()) if not n]
                removed.append(total[-1] - len(parts))
                out = b" ".join(parts)
                kept.append(hashlib.sha256(out).hexdigest() if digest else out.decode())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in names if k not in ("text", "spans")), pa.array(total, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                [*(k for k in names if k not in ("text", "spans")), "n_words", "n_removed", "kept"])
    return cut


def repeat_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   anchor: int = 8) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256 (of the words
    that stay, joined by one space).  Texts without a span never leave their
    scan; only those with one are shuffled to meet their spans."""
    texts = texts_of(df, id_col, text_col)
    spans = repeated_spans(df, id_col, text_col, window, anchor)
    cut = (narrowed(texts.select("key", "text"), spans.select("key")).join(spans, "key").dropDuplicates(["key"])
           .mapInArrow(_cutter(True), "key long, n_words long, n_removed long, kept string")
           .select("key", F.col("n_removed").alias("cut"), F.col("kept").alias("rest")))
    id_type = texts.schema["id"].dataType
    plain = texts.mapInArrow(_cutter(True), T.StructType([
        T.StructField("id", id_type), T.StructField("key", T.LongType()), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]))
    return plain.join(cut, "key", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("cut", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("rest", "kept").alias("kept_sha256"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   anchor: int = 8) -> DataFrame:
    """``df`` with the repeated words cut out of its text; a text that loses
    words has the rest joined by one space, other texts stay as they are."""
    key, rest = (free_name(df, n) for n in ("rlz_key", "rlz_rest"))
    texts = texts_of(df, id_col, text_col).select("key", "text")
    spans = repeated_spans(df, id_col, text_col, window, anchor)
    cut = (narrowed(texts, spans.select("key")).join(spans, "key").dropDuplicates(["key"])
           .mapInArrow(_cutter(False), "key long, n_words long, n_removed long, kept string")
           .select(F.col("key").alias(key), F.col("kept").alias(rest)))
    keyed = df.withColumn(key, row_key(q(id_col), F.coalesce(q(text_col), F.lit("")))).join(cut, key, "left")
    return keyed.withColumn(text_col, F.coalesce(q(rest), q(text_col))).select(*(q(c) for c in df.columns))
