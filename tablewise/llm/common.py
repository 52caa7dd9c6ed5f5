"""Pieces shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.functions.core import q
from tablewise.session import checkpoint_dir

#: ASCII white space as the word pattern of all contracts sees it: space, tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Cuts the lineage: whatever uses the result twice neither repeats the work
    nor depends on an executor that may be lost.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(*cols: Column) -> Column:
    """64-bit key of a row's content.  Rows of equal content share the key, so
    whatever is computed per key joins back to each of them unchanged."""
    return F.xxhash64(*cols)


def texts_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, key) of any table, whatever its other columns are called."""
    text = F.coalesce(q(text_col), F.lit(""))
    return df.select(q(id_col).alias("id"), text.alias("text"),
                     row_key(q(id_col), text).alias("key"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def arrow_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string or binary column, without copying."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, most: int = 4 << 20) -> list[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; a longer row is a range of its own."""
    out, i, n = [], 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        out.append((i, j))
        i = j
    return out


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Largest key list that ``narrowed`` broadcasts: one long a row, some 40 MB as a hash table.
MOST_KEYS = 1_000_000


def narrowed(texts: DataFrame, keys: DataFrame, most: int = MOST_KEYS) -> DataFrame:
    """``texts`` whose key is in ``keys`` (distinct), before they are shuffled to
    be joined with what those keys have.  The list is broadcast only if a count
    proves it to be short; else ``texts`` as it is, which the join narrows."""
    if keys.limit(most + 1).count() > most:
        return texts
    return texts.join(F.broadcast(keys.select("key")), "key", "left_semi")


def without(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose column ``key`` is not among ``keys`` (column ``key``,
    distinct); a list that a count proves short is broadcast, else both sides meet in a shuffle."""
    keys = keys.select(F.col("key").alias(key))
    if keys.limit(MOST_KEYS + 1).count() <= MOST_KEYS:
        keys = F.broadcast(keys)
    return df.join(keys, key, "left_anti")


def joined(rows: DataFrame, answers: DataFrame, key: str, times: str) -> DataFrame:
    """``rows`` with what ``answers`` (one row a key, ``times`` of the rows have
    it) says of their key.  Keys that hold over a thousandth of all rows, so
    fewer than a thousand keys, are broadcast: none gathers its rows in one task."""
    total = answers.agg(F.sum(times)).first()[0] or 0
    often = F.col(times) * 1000 > F.lit(total)
    hot = F.broadcast(answers.where(often).drop(times))
    rare = answers.where(~often).drop(times)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(rare, key))
