"""Fuzzy line dedup: MinHash over character shingles, exact verification, union-find.

Equal lines (A-Z lower-cased) are one line class before anything is compared.
A task signs each class it meets once a run and writes the band hashes of a run,
sorted, as one compressed block for each range of hashes (``linebands``); the blocks
of a range meet in one task, which gives back only the bands that several
classes share.  A band of a single class, as nearly all are, is never a row.
Classes that share a band are candidates, confirmed by the exact Jaccard
similarity of their shingle sets (``candidates.linked``, with sketches of the sets).  Confirmed links form
components by distributed union-find, and the first line of each, by document
id and line number, stays.  With 40 bands of 6 slots, as for near duplicates, a pair
at similarity 0.8 misses every band with probability 5e-6; slots are six because
lines of one language share some shingles, and with five chance meetings grow past the rest.
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
from tablewise.llm import rarity
from tablewise.llm.candidates import linked, sketches
from tablewise.llm.common import arrow_bytes, free_name, narrowed, row_key, slices, stored, texts_of
from tablewise.llm.linebands import bander, matcher, short

_SLICE = 1 << 20
#: Odd multipliers of a shingle's characters.
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(64)], np.uint64)


def _lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Characters of UTF-8 rows (A-Z lower-cased), start and end of every line
    (cut at \\n as ``str.split`` does), and the rows' offsets into the lines."""
    chars = np.frombuffer(H.LOWER[raw].tobytes().decode().encode("utf-32-le"), np.uint32)
    off = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets]
    breaks = np.flatnonzero(chars == 10)
    starts = np.sort(np.concatenate([off[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([breaks, off[1:]]), kind="stable")
    return chars, starts, ends, np.searchsorted(breaks, off) + np.arange(len(off))


def shingles(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-character shingles of each line, repeats included, and the
    lines' offsets into them; a shorter line is one shingle, an empty one none."""
    length = ends - starts
    count = np.where(length >= k, length - k + 1, np.minimum(length, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    wide = np.concatenate([chars, np.zeros(k, chars.dtype)]).astype(np.uint64) + np.uint64(1)
    whole = np.zeros(len(chars), np.uint64)
    for i in range(k):
        whole += wide[i:i + len(chars)] * _FACTORS[i]
    h = whole[np.repeat(starts - at[:-1], count) + np.arange(at[-1])]
    for line in np.flatnonzero((length > 0) & (length < k)).tolist():
        n = int(length[line])
        h[at[line]] = (wide[starts[line]:ends[line]] * _FACTORS[:n]).sum() + np.uint64(n << 40)
    return h, at


def worded_lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Characters, and of every line with a word: start, end, row, number in its row and class hash."""
    chars, starts, ends, at = _lines(raw, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    number = np.arange(len(starts)) - at[row]
    wordless = (chars == 32) | ((chars >= 9) & (chars <= 13))
    run = np.concatenate([[0], np.cumsum(~wordless)])
    worded = run[ends] > run[starts]
    starts, ends = starts[worded], ends[worded]
    return chars, starts, ends, row[worded], number[worded], H.span_hashes(chars, starts, ends)


def _classes(batches):
    """The class of every line with a word."""
    for batch in batches:
        raw, off = arrow_bytes(batch.column("text"))
        for a, b in slices(off, _SLICE):
            _, _, _, row, number, c = worded_lines(raw[off[a]:off[b]], off[a:b + 1] - off[a])
            take = pa.array(a + row)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(take), batch.column("key").take(take),
                                              pa.array(number, pa.int64()), pa.array(c.view(np.int64))], ["id", "key", "line", "c"])


def _finder(k: int):
    """The lines (line, c) listed in ``wanted``, with the sizes and sketches of their shingle sets."""
    def find(batches):
        for batch in batches:
            raw, off = arrow_bytes(batch.column("text"))
            wanted = batch.column("wanted")
            listed, values = np.asarray(wanted.offsets, np.int64), wanted.values
            lines, classes = np.asarray(values.field("line"), np.int64), np.asarray(values.field("c"), np.int64)
            for a, b in slices(off, _SLICE):
                chars, starts, ends, at = _lines(raw[off[a]:off[b]], off[a:b + 1] - off[a])
                part = slice(listed[a], listed[b])
                pick = np.repeat(at[:-1], np.diff(listed[a:b + 1])) + lines[part]
                h, hat = H.distinct_sets(*shingles(chars, starts[pick], ends[pick], k))
                m = sketches(h, hat)
                text = [chars[i:j].tobytes().decode("utf-32-le") for i, j in zip(starts[pick].tolist(), ends[pick].tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(classes[part], pa.int64()), pa.array(np.diff(hat), pa.int64()), pa.array(text, pa.string()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))],
                    ["c", "n", "s", "m"])
    return find


def _shingles_of(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of a column of lines, repeats included."""
    raw, off = arrow_bytes(column)
    chars = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    off = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[off]
    return shingles(chars, off[:-1], off[1:], k)


def _comparer(k: int, percent: int):
    def compare(batches):
        """The union of two sets is what is distinct of both; their sizes are known."""
        for batch in batches:
            _, off = arrow_bytes(batch.column("sa"))
            for a, b in slices(off, _SLICE):
                some = batch.slice(a, b - a)
                (ha, at), (hb, bt) = _shingles_of(some.column("sa"), k), _shingles_of(some.column("sb"), k)
                both = at + bt
                h = np.empty(both[-1], np.uint64)
                h[np.arange(len(ha)) + np.repeat(bt[:-1], np.diff(at))] = ha
                h[np.arange(len(hb)) + np.repeat(at[1:], np.diff(bt))] = hb
                union = np.diff(H.distinct_sets(h, both)[1])
                sizes = some.column("na").to_numpy() + some.column("nb").to_numpy()
                near = np.flatnonzero(100 * (sizes - union) >= percent * union)
                yield some.select(["a", "b"]).take(pa.array(near))
    return compare


def _rarest(k: int):
    """The rarest shingles of lines, as ``candidates.rarest_elements`` gives them; only those that several lines
    of a family have become rows."""
    def rarest(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
        found = rarity.rarest(sets, lambda column: H.distinct_sets(*_shingles_of(column, k)), percent)
        shared = found.select("family", "c", "n", F.explode(F.arrays_zip("x", "rank")).alias("at"))
        return shared.select("family", "at.x", "c", "n", "at.rank"), found.select("c", "n", "u")
    return rarest


def shared_bands(texts: DataFrame, lines: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """(b, c): the bands that several line classes share, with those classes."""
    spark = texts.sparkSession
    # ranges of band hashes, so many that one holds about a million entries
    ranges = 1 << max(6, (bands * lines.count() >> 20).bit_length())
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ranges // 4)
    blocks = texts.mapInArrow(bander(k, bands, rows, ranges), "range int, block binary")
    met = stored(blocks.repartition(count, "range").sortWithinPartitions("range").mapInArrow(matcher, "b long, short long"), "bands")
    # blocks know a class by some bits of its hash; who shares those bits is a candidate too
    classes = lines.select("c").distinct().select("c", short(F.col("c")).alias("short"))
    return stored(met.join(classes, "short").select("b", "c"), "members")


def repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                   percent: int = 80, bands: int = 40, rows: int = 6) -> DataFrame:
    """(key, removed): numbers of the lines that an earlier line of their
    component repeats, for the documents that have any.

    Lines without a word take no part.  A null id comes first.  Rows equal in
    id and text are one document (``key`` is ``row_key`` of both) and don't
    repeat each other.  Null and empty texts have no lines; other columns are
    not read; an empty table gives an empty result.
    """
    texts = texts_of(df, id_col, text_col)
    lines = stored(texts.mapInArrow(_classes, T.StructType([
        T.StructField("id", texts.schema["id"].dataType), T.StructField("key", T.LongType()),
        T.StructField("line", T.LongType()), T.StructField("c", T.LongType())])), "lines")

    def sets_of(classes: DataFrame) -> DataFrame:
        shown = lines.join(classes, "c").groupBy("c").agg(F.min("key").alias("key"))
        placed = (lines.select("key", "c", "line").join(shown, ["c", "key"])
                  .groupBy("key", "c").agg(F.min("line").alias("line")))
        wanted = stored(placed.groupBy("key").agg(F.collect_list(F.struct("line", "c")).alias("wanted")), "wanted")
        return (narrowed(texts.select("key", "text"), wanted.select("key")).join(wanted, "key").dropDuplicates(["key"])
                .mapInArrow(_finder(k), "c long, n long, s string, m array<bigint>"))

    members = shared_bands(texts.select("text"), lines, k, bands, rows)
    labels = linked(members, sets_of, percent,
                    lambda both, p: both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_comparer(k, p), "a long, b long"),
                    _rarest(k))
    several = (lines.groupBy("c").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("c")
               .unionAll(labels.select("node")).distinct()
               .join(labels.withColumnRenamed("node", "c"), "c", "left")
               .select("c", F.coalesce("component", "c").alias("component")))
    grouped = stored(lines.select("id", "key", "line", "c").join(several, "c").select(
        "component", F.struct("id", "key", "line").alias("at")), "grouped")
    first = grouped.groupBy("component").agg(F.min("at").alias("first"))
    return stored(grouped.join(first, "component").where("at <> first").select(F.col("at.key").alias("key"), F.col("at.line").alias("line"))
                  .groupBy("key").agg(F.collect_set("line").alias("removed")), "removed")


def _digester():
    """Digest of a text without the lines numbered in ``removed`` (all where there is no such column)."""
    def cut(batches):
        for batch in batches:
            names = batch.schema.names
            removed = batch.column("removed").to_pylist() if "removed" in names else [()] * batch.num_rows
            total, gone, kept = [], [], []
            for text, drop in zip(batch.column("text").to_pylist(), removed):
                lines, drop = (text or "").split("\n"), set(drop)
                stay = [x for i, x in enumerate(lines) if i not in drop] if drop else lines
                total.append(sum(bool(x.strip(" \t\n\x0b\x0c\r")) for x in stay) + len(drop))
                gone.append(len(drop))
                kept.append(hashlib.sha256("\n".join(stay).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names if n not in ("text", "removed")), pa.array(total, pa.int64()),
                 pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                [*(n for n in names if n not in ("text", "removed")), "n_lines", "n_removed", "kept"])
    return cut


def line_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: id, n_lines (with a word), n_removed, kept_sha256
    of the text without the removed lines.  Only texts that lose a line are shuffled."""
    texts = texts_of(df, id_col, text_col)
    removed = repeated_lines(df, id_col, text_col, **options)
    cut = (narrowed(texts.select("key", "text"), removed.select("key")).join(removed, "key").dropDuplicates(["key"])
           .mapInArrow(_digester(), "key long, n_lines long, n_removed long, kept string")
           .select("key", F.col("n_removed").alias("gone"), F.col("kept").alias("rest")))
    plain = texts.mapInArrow(_digester(), T.StructType([
        T.StructField("id", texts.schema["id"].dataType), T.StructField("key", T.LongType()),
        *(T.StructField(n, T.LongType()) for n in ("n_lines", "n_removed")), T.StructField("kept", T.StringType())]))
    return plain.join(cut, "key", "left").select(
        F.col("id").alias(id_col), "n_lines", F.coalesce("gone", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("rest", "kept").alias("kept_sha256"))


def _row_cutter(text_col: str, removed_col: str):
    """Rewrites the text of whole rows; a row that loses its last line with a word goes."""
    def cut(batches):
        for batch in batches:
            texts, stay = batch.column(text_col).to_pylist(), []
            for i, drop in enumerate(batch.column(removed_col).to_pylist()):
                if drop:
                    drop = set(drop)
                    lines = [x for j, x in enumerate(texts[i].split("\n")) if j not in drop]
                    texts[i] = "\n".join(lines)
                if not drop or any(x.strip(" \t\n\x0b\x0c\r") for x in lines):
                    stay.append(i)
            names = [n for n in batch.schema.names if n != removed_col]
            columns = [pa.array(texts, batch.schema.field(n).type) if n == text_col else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names).take(pa.array(stay, pa.int64()))
    return cut


def drop_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` with the repeated lines taken out of its text.  A document that
    loses all of its lines, a copy of earlier ones, goes; one that had none stays."""
    key, gone = free_name(df, "line_key"), free_name(df, "line_gone")
    removed = repeated_lines(df, id_col, text_col, **options).select(F.col("key").alias(key), F.col("removed").alias(gone))
    keyed = df.withColumn(key, row_key(q(id_col), F.coalesce(q(text_col), F.lit("")))).join(removed, key, "left").drop(key)
    return keyed.mapInArrow(_row_cutter(text_col, gone), df.schema)
