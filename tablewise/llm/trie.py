"""Conversation prefix trie with depth-band rollup.

A node is a distinct sequence of first turns.  Its key is a polynomial in the
digests of its turns, 128 bits in two lanes, so the keys along a conversation
are running sums, which add up across pieces of a conversation that lie in
different tasks: a conversation that holds a third of all turns is read by as
many tasks as any other third.

Subtree totals are rolled up in bands of ``_BAND`` depths.  A node's value goes
to the root of its band; the band roots are a trie of their own, a ``_BAND``-th
as deep, whose totals are found the same way.  Each band root's completed total
is then handed to its parent, the lowest band above it, and every node explodes to
its ancestors inside its band.  A trie of depth D takes log(D) rounds, and no
node is exploded to more than ``_BAND`` rows in any of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.functions.core import q
from tablewise.llm.common import WORD, joined, stored

_BAND = 8
#: Conversation ids are listed for a hash in pieces of this many consecutive ids.
_PIECE = 4096
#: Odd factors of the two lanes and their inverses modulo 2 ** 64.
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_INVERSES = tuple(pow(x, -1, 1 << 64) for x in _FACTORS)
#: Key of the textless root, the empty sum.
ROOT = bytes(16)


def _powers(factor: int, n: int) -> np.ndarray:
    """factor ** 1 ... factor ** n modulo 2 ** 64."""
    return np.cumprod(np.full(n, factor, np.uint64))


def _lanes(column: pa.Array) -> np.ndarray:
    """The two lanes of each 16-byte key."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


def _keys(lanes: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(lanes), [None, pa.py_buffer(np.ascontiguousarray(lanes).tobytes())]).cast(pa.binary())


def _numberer(batches):
    """Sorted turns -> number and running key of each turn among those of its conversation
    in this task, and a row of totals for the first and the last conversation,
    the only ones that may go on in another task."""
    task = TaskContext.get().partitionId()
    carried = count = None
    key = np.zeros(2, np.uint64)
    began = False

    def rows(conv, n, lanes, words, total):
        return pa.RecordBatch.from_arrays([
            pa.array(conv, pa.int64()), pa.array(np.full(len(conv), task), pa.int32()), pa.array(n, pa.int64()),
            _keys(lanes), pa.array(words, pa.int64()), pa.array(np.full(len(conv), total))],
            ["conv", "task", "n", "key", "words", "total"])

    for batch in batches:
        conv = np.asarray(batch.column("conv"))
        if not len(conv):
            continue
        turns = _lanes(batch.column("digest"))
        starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        sizes = np.diff(starts, append=len(conv))
        same = carried is not None and conv[0] == carried
        if carried is not None and not same and not began:
            began = True
            yield rows([carried], [count], key[None, :], [0], True)
        local = np.arange(len(conv)) - np.repeat(starts, sizes)
        lanes = np.empty_like(turns)
        for k, factor in enumerate(_FACTORS):
            run = np.cumsum(turns[:, k] * _powers(factor, int(sizes.max()))[local])
            before = np.concatenate([np.zeros(1, np.uint64), run])[starts]
            lanes[:, k] = run - np.repeat(before, sizes)
        n = local + 1
        if same:
            head = slice(0, int(sizes[0]))
            for k, factor in enumerate(_FACTORS):
                lanes[head, k] = lanes[head, k] * np.uint64(pow(factor, count, 1 << 64)) + key[k]
            n[head] += count
        yield rows(conv, n, lanes, np.asarray(batch.column("words")), False)
        if not began and len(starts) > 1:
            began = True
            end = int(sizes[0]) - 1
            yield rows(conv[:1], n[end:end + 1], lanes[end:end + 1], [0], True)
        carried, count, key = conv[-1], int(n[-1]), lanes[-1].copy()
    if carried is not None:
        yield rows([carried], [count], key[None, :], [0], True)


def _offsets(pieces):
    """Totals of one conversation's pieces -> what lies before each of them."""
    pieces = pieces.sort_values("task")
    count, key, before, keys = 0, [0, 0], [], []
    for n, piece in zip(pieces["n"].tolist(), pieces["key"].tolist()):
        before.append(count)
        keys.append(np.array(key, np.uint64).tobytes())
        lanes = np.frombuffer(bytes(piece), np.uint64).tolist()
        key = [(x + pow(f, count, 1 << 64) * y) % (1 << 64) for x, f, y in zip(key, _FACTORS, lanes)]
        count += n
    return pieces.assign(before=before, before_key=keys)[["conv", "task", "before", "before_key"]]


def _shifted(power: str, plus: str, minus: str | None, inverse: bool):
    """key <- factor ** power * (key - minus) + plus, for each row."""
    factors = _INVERSES if inverse else _FACTORS

    def shift(batches):
        for batch in batches:
            lanes, add = _lanes(batch.column("key")).copy(), _lanes(batch.column(plus))
            by, at = np.unique(np.asarray(batch.column(power)), return_inverse=True)
            if minus:
                lanes -= _lanes(batch.column(minus))
            for k, factor in enumerate(factors):
                lanes[:, k] = lanes[:, k] * np.array([pow(factor, int(x), 1 << 64) for x in by], np.uint64)[at] + add[:, k]
            drop = {power, plus, minus}
            names = [n for n in batch.schema.names if n not in drop]
            yield pa.RecordBatch.from_arrays([_keys(lanes) if n == "key" else batch.column(n) for n in names], names)
    return shift


def numbered_turns(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, n, key, words): each turn's number in its conversation, the key of the turns up
    to it, and the words of its text.  Texts never leave their scan, only their digests do."""
    role, text = (F.coalesce(q(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    told = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = df.where(q(id_col).isNotNull()).select(
        q(id_col).cast("long").alias("conv"), q(turn_col).alias("turn"), role.alias("role"), told.alias("md5"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = ("conv", "turn", "role", "md5")
    sorted_turns = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stored(sorted_turns.select("conv", F.unhex("md5").alias("digest"), "words")
                    .mapInArrow(_numberer, "conv long, task int, n long, key binary, words long, total boolean"), "turns")
    # at most two rows a task; so are the offsets made of them
    totals = pieces.where("total").select("conv", "task", "n", "key")
    before = F.broadcast(stored(totals.groupBy("conv").applyInPandas(
        _offsets, "conv long, task int, before long, before_key binary").where("before > 0"), "offsets"))
    return (pieces.where("not total").join(before, ["conv", "task"], "left")
            .select("conv", (F.col("n") + F.coalesce("before", F.lit(0))).alias("n"), "key", "words",
                    F.coalesce("before", F.lit(0)).alias("by"), F.coalesce("before_key", F.lit(ROOT)).alias("plus"))
            .mapInArrow(_shifted("by", "plus", None, False), "conv long, n long, key binary, words long"))


def borrowed_heads(conv: Column) -> tuple[Column, Column]:
    """Whose first turns a conversation begins with and how many: those of the
    conversation at the start of its block of 20, crc32 of its decimal id modulo 4."""
    return conv - conv % 20, F.crc32(conv.cast("string")) % 4


def members(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", head: int = 3) -> DataFrame:
    """(conv, depth, node, words, ends): a row for each rebuilt conversation and each of its
    prefixes, the textless root (depth 0) included; ``ends`` marks the whole conversation.

    Turns are ordered by turn (null first), role and digest of the text; null role or
    text is empty; repeated rows are turns of their own.  Rows without an id are of no conversation.
    """
    turns = stored(numbered_turns(df, id_col, turn_col, role_col, text_col), "numbered")
    first = F.when(F.col("n") <= head, F.struct("n", "key", "words"))
    convs = stored(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("times"), F.array_sort(F.collect_list(first)).alias("first")), "conversations")
    base, h = borrowed_heads(F.col("conv"))
    bases = convs.where("conv % 20 = 0").select(F.col("conv").alias("base"), F.col("first").alias("lent"))
    key_at = lambda column, n: F.coalesce(F.try_element_at(F.transform(column, lambda x: x["key"]), n), F.lit(ROOT))
    built = (convs.withColumn("base", base).withColumn("h", h.cast("int")).join(bases, "base", "left")
             .withColumn("lent", F.slice(F.coalesce("lent", F.array().cast(convs.schema["first"].dataType)), F.lit(1), F.col("h")))
             .withColumn("k", F.size("lent"))
             .withColumn("depth", F.col("k") + F.greatest(F.col("times") - F.col("h"), F.lit(0))))
    no_h, no_k = F.col("h") == 0, F.col("k") == 0
    built = stored(built.select(
        "conv", "times", "h", "lent", "depth", (F.col("h") - F.col("k")).alias("by"),
        F.when(no_k, F.lit(ROOT)).otherwise(key_at(F.col("lent"), F.when(no_k, 1).otherwise(F.col("k")))).alias("plus"),
        # what the own turns' keys hold of the turns that are left out; needed where some are left
        F.when(no_h, F.lit(ROOT)).otherwise(key_at(F.col("first"), F.when(no_h, 1).otherwise(F.col("h")))).alias("minus")), "rebuilt")
    own = (joined(turns, built.drop("lent"), "conv", "times").where("n > h")
           .select("conv", (F.col("n") - F.col("by")).alias("at"), "key", "words", "depth", "by", "plus", "minus")
           .mapInArrow(_shifted("by", "plus", "minus", True), "conv long, at long, key binary, words long, depth long"))
    lent = built.select("conv", "depth", F.explode("lent").alias("x")).select(
        "conv", F.col("x.n").alias("at"), F.col("x.key").alias("key"), F.col("x.words").alias("words"), "depth")
    root = built.select("conv", F.lit(0).cast("long").alias("at"), F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("words"), "depth")
    rows = own.unionByName(lent).unionByName(root)
    return stored(rows.select("conv", F.col("at").alias("depth"), F.col("key").alias("node"), "words",
                              (F.col("at") == F.col("depth")).alias("ends")), "members")


def _band_of(depth: str) -> Column:
    return F.expr(f"{depth} div {_BAND}")


def with_parents(paths: DataFrame, *more: Column) -> DataFrame:
    """One row per node: conv (its smallest member), depth, parent (null at the root) and
    the aggregates ``more``.  The parent is the node before it on that member's path."""
    nodes = paths.groupBy("node").agg(F.min("conv").alias("conv"), F.max("depth").alias("depth"), *more)
    before = paths.select("conv", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    return nodes.join(before, ["conv", "depth"], "left")


def _ancestors(paths: DataFrame) -> DataFrame:
    """(node, above): the ancestors of each node inside its band, itself included, top first."""
    listed = paths.groupBy("conv", _band_of("depth")).agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("path"))
    steps = listed.select(F.posexplode("path").alias("i", "x"), F.transform("path", lambda x: x["node"]).alias("path"))
    return steps.select(F.col("x.node").alias("node"), F.slice("path", F.lit(1), F.col("i") + 1).alias("above")).dropDuplicates(["node"])


def subtree_totals(paths: DataFrame, values: DataFrame, names: list[str]) -> DataFrame:
    """(node, *names): ``values`` (node, parent, *names) summed over each node's subtree.

    ``paths`` (conv, depth, node) holds every node on at least one path from the root, all
    depths of a path with it.  ``parent`` is null at the root.
    """
    sums = [F.sum(c).alias(c) for c in names]
    above = stored(_ancestors(paths), "bands")
    deepest = paths.agg(F.max("depth")).first()[0] or 0
    if deepest >= _BAND:
        top = above.select("node", F.element_at("above", 1).alias("top"))
        band = values.join(top, "node").groupBy(F.col("top").alias("node")).agg(*sums)
        roots = stored(paths.where(F.col("depth") % _BAND == 0).select("conv", _band_of("depth").alias("depth"), "node"), "band-roots")
        done = subtree_totals(roots, stored(band.join(with_parents(roots).select("node", "parent"), "node"), "band-totals"), names)
        handed = (done.join(values.where("parent is not null").select("node", "parent"), "node")
                  .groupBy(F.col("parent").alias("node")).agg(*sums))
        values = values.select("node", *names).unionByName(handed).groupBy("node").agg(*sums)
    return stored(values.join(above, "node").select(F.explode("above").alias("node"), *names).groupBy("node").agg(*sums), "subtrees")


def _listed_hash(batches):
    """Rows by node and piece -> SHA-256 of each node's ids, streamed piece by piece."""
    at, out = None, None
    for batch in batches:
        told = []
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if node != at:
                if at is not None:
                    told.append((at, out.hexdigest()))
                at, out = node, hashlib.sha256()
            else:
                out.update(b",")
            out.update(ids.encode())
        if told:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in told], pa.binary()), pa.array([x for _, x in told])], ["node", "ends_sha256"])
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([out.hexdigest()])], ["node", "ends_sha256"])


def ends_hashes(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes where conversations end: the hash of their decimal
    ids, ascending and comma-joined.

    Ids are put in order and written in pieces of ``_PIECE`` consecutive ones; only where a
    node has several does one task read its pieces after each other, holding one at a time,
    since the hash is over the whole list.
    """
    pieces = stored(rows.where("ends").groupBy("node", F.expr(f"conv div {_PIECE}").alias("piece"))
                    .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids")), "ends")
    many = pieces.groupBy("node").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("node")
    few = pieces.join(many, "node", "left_anti").select("node", F.sha2("ids", 256).alias("ends_sha256"))
    long = (pieces.join(many, "node", "left_semi").repartition("node").sortWithinPartitions("node", "piece")
            .select("node", "ids").mapInArrow(_listed_hash, T.StructType([
                T.StructField("node", T.BinaryType()), T.StructField("ends_sha256", T.StringType())])))
    return few.unionByName(long)


def prefix_trie(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per node: node (key), conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    See ``members`` for nulls, ties and repeated rows.  A conversation that is rebuilt
    without a turn ends at the root.  Other columns are not read; an empty table has no
    conversation and gives no node.
    """
    rows = members(df, id_col, turn_col, role_col, text_col)
    nodes = stored(with_parents(rows, F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words")), "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")

    values = nodes.select("node", "parent", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
                          ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = subtree_totals(rows.select("conv", "depth", "node"), values, ["n_leaves", "saved_tokens"])
    parents = nodes.where("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"), F.col("n_children").alias("times"))
    below = joined(nodes.where("parent is not null"), parents, "parent", "times").select("node", "parent_conv_id")
    told = nodes.join(below, "node", "left").join(totals, "node").join(ends_hashes(rows), "node", "left")
    return told.select("node", F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                       "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
