"""Cross-tokenizer alignment with external spill counting.

Every text is encoded by a byte-level tokenizer (A) and a sentence-piece
tokenizer (B), word by word, each word once while it is remembered (``_Words``).  Byte offsets where tokens of both end cut the text into groups;
the A and B token that end there are linked.  How often a pair of ids is linked
in the whole corpus is counted by sorted runs:

1. A task sorts the (pair, document, times) records of its documents, B id
   first, whenever ``_RUN`` of them are gathered, and writes them as one zstd run
   for each of ``buckets`` radix buckets of the B id, with the run's pair counts.
2. Count runs of a bucket meet in k-way heap merges of ``_FAN`` runs at most,
   in as many rounds as that takes, so no merge depends on the size of the corpus.
3. The last merge sees a bucket's pairs in B-major order: all pairs of a B id
   pass together and give its highest count (at most one row for each A id is held).
4. The record runs, dealt out a few at a time, read their bucket's counts beside
   them and send sums back to their documents.

A pair that every document holds is one count a run in step 2 and in step 4 as
many records as its runs have documents, so no task sees it whole.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.functions.core import q
from tablewise.llm.common import arrow_bytes, slices, stored

_RUN = 1 << 20        # records a task gathers before it writes a run
_RUN_DOCS = 1 << 16   # documents of a run: their numbers take two bytes
_FRAME = 1 << 14      # entries of one zstd frame
_FAN = 64             # runs of one merge
_SHARE = 16           # record runs that share one reading of their bucket's counts
_TEXT = 1 << 20       # bytes of text worked on at a time
_TOGETHER = 1 << 12   # words encoded at a time
_REMEMBERED = 1 << 18  # words that a task remembers
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_COUNTS = (np.int64, np.int64)
_TABLE = (np.int64, np.int64, np.bool_)
_RECORDS = (np.int64, np.uint32, np.uint16, np.uint32)


def _pack(*arrays: np.ndarray) -> bytes:
    """One zstd frame; the first array ascends and is kept as differences."""
    first = np.diff(arrays[0], prepend=0)
    head = np.array([len(a) for a in arrays], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in (head, first, *arrays[1:])))


def _unpack(frame: bytes, kinds: tuple) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(frame)
    head, at, out = np.frombuffer(data, np.int64, len(kinds)), 8 * len(kinds), []
    for n, kind in zip(head.tolist(), kinds):
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    out[0] = np.cumsum(out[0])
    return out


@lru_cache(maxsize=2)
def _byte_level(path: str):
    """Tokenizer A and the bytes of its ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(path)
    coder.encode_special_tokens = True
    # the byte-level alphabet: printable Latin-1 characters are themselves, the rest follow from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(spare)}
    names = [coder.id_to_token(i) or "" for i in range(coder.get_vocab_size())]
    return coder, [bytes(byte[c] for c in x) if all(c in byte for c in x) else x.encode() for x in names]


@lru_cache(maxsize=2)
def _pieces(path: str):
    """Tokenizer B and the bytes of its ids."""
    import sentencepiece
    coder = sentencepiece.SentencePieceProcessor(model_file=path)
    told = [coder.id_to_piece(i) for i in range(coder.get_piece_size())]
    if any("▁" in x.lstrip("▁") for x in told):
        raise ValueError("a piece goes across words")
    return coder, [bytes([int(x[3:5], 16)]) if coder.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(told)]


class _Words:
    """Encodings of the words of texts, each worked out once while it is remembered.

    Texts are cut at single spaces between other characters.  Neither tokenizer has a token
    across such a place: the byte-level one starts a new piece there, and the pieces of
    the other hold a space only in front (checked when it is loaded).  So the tokens,
    groups and links of a text are those of its words, one after the other.
    """

    def __init__(self, byte_path: str, piece_path: str):
        self.coder_a, self.bytes_a = _byte_level(byte_path)
        self.coder_b, self.bytes_b = _pieces(piece_path)
        self.size_a, self.size_b = (np.array([len(x) for x in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        digits = [str(i).encode() for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.width = max(map(len, digits))
        self.digits = np.frombuffer(b"".join(d.ljust(self.width) for d in digits), np.uint8).reshape(-1, self.width)
        self.length = np.array([len(d) for d in digits], np.int64)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.counts: list[tuple[int, int, int, bool]] = []  # A tokens, B tokens, groups, whether both give the word back
        self.texts: list[bytes] = []
        self.pairs: list[np.ndarray] = []

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, bool]:
        """Both encodings of words joined by spaces, and whether they give them back."""
        text = " ".join(words)
        a = self.coder_a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.coder_b.encode(text, num_threads=1)
        raw = b" " + text.encode()
        same = b"".join([self.bytes_a[i] for i in a]) == raw and b"".join([self.bytes_b[i] for i in b]) == raw
        return np.array(a, np.int64), np.array(b, np.int64), same

    def learn(self, words: list[str]) -> None:
        plain = [w for w in words if w and w == w.strip()]
        for i in range(0, len(plain), _TOGETHER):
            self._learn(plain[i:i + _TOGETHER])
        for w in words:  # white space at the beginning or end of a text is split with what is beside it
            if w not in self.number:
                self._learn([w])

    def _learn(self, words: list[str]) -> None:
        a, b, same = self._encoded(words)
        if not same:
            if len(words) > 1:  # one of them: find it
                half = len(words) // 2
                self._learn(words[:half])
                self._learn(words[half:])
                return
            self._keep(words[0], 0, 0, 0, False, b"", np.zeros(0, np.int64))
            return
        stop_a, stop_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        # no token is empty, so one token of each side ends at a shared offset: one link a group
        _, end_a, end_b = np.intersect1d(stop_a, stop_b, assume_unique=True, return_indices=True)
        pairs = b[end_b] << 32 | a[end_a]
        # written as A ids, |, B ids, ; of each group after the other
        group_a, group_b = (np.searchsorted(e, np.arange(len(x))) for e, x in ((end_a, a), (end_b, b)))
        before = np.concatenate([[0], end_b + 1])
        place_a, place_b = np.arange(len(a)) + before[group_a], np.arange(len(b)) + end_a[group_b] + 1
        ids, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        mark[place_a[end_a]], mark[place_b[end_b]] = ord("|"), ord(";")
        length = self.length[ids]
        cells = np.empty((len(ids), self.width + 1), np.uint8)
        cells[:, :self.width] = self.digits[ids]
        cells[np.arange(len(ids)), length] = mark
        written = cells[np.arange(self.width + 1) <= length[:, None]].tobytes()
        after = np.cumsum(length + 1)[place_b[end_b]]
        # every word ends a group
        last = np.searchsorted(stop_a[end_a], np.cumsum([len(w.encode()) + 1 for w in words]))
        g = i = j = at = 0
        for w, k in zip(words, last.tolist()):
            x, y, to = int(end_a[k]) + 1, int(end_b[k]) + 1, int(after[k])
            self._keep(w, x - i, y - j, k + 1 - g, True, written[at:to - 1], pairs[g:k + 1])
            g, i, j, at = k + 1, x, y, to

    def _keep(self, word: str, n_a: int, n_b: int, n_groups: int, same: bool, text: bytes, pairs: np.ndarray) -> None:
        self.number[word] = len(self.counts)
        self.counts.append((n_a, n_b, n_groups, same))
        self.texts.append(text)
        self.pairs.append(pairs)


@dataclass
class _Aligned:
    """What is known of a text after some of its parts."""

    same: bool = True
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    digest: object = None
    keys: list = field(default_factory=list)
    times: list = field(default_factory=list)

    def add(self, words: _Words, parts: list[str]) -> bytes:
        """Adds words that are all known; gives their groups as text."""
        at = np.array([words.number[w] for w in parts], np.int64)
        some, times = np.unique(at, return_counts=True)
        counts = np.array([words.counts[i] for i in some.tolist()], np.int64)
        self.same &= bool(counts[:, 3].all())
        if not self.same:
            return b""
        sums = times @ counts
        self.n_a, self.n_b, self.n_groups = self.n_a + int(sums[0]), self.n_b + int(sums[1]), self.n_groups + int(sums[2])
        self.keys.append(np.concatenate([words.pairs[i] for i in some.tolist()]))
        self.times.append(np.repeat(times, counts[:, 2]))
        told = b";".join([words.texts[i] for i in at.tolist()])
        if self.digest is None:
            self.digest = hashlib.sha256()
        else:
            told = b";" + told
        self.digest.update(told)
        return told

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs (B id in the upper half) and how often the text has them."""
        if not self.keys or not self.same:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        return keys, np.bincount(at, weights=np.concatenate(self.times)).astype(np.int64)

    def row(self) -> tuple[int, int, int, str]:
        if self.digest is None or not self.same:
            return 0, 0, 0, ""
        return self.n_a, self.n_b, self.n_groups, self.digest.hexdigest()


def _segments(text: str) -> Iterator[str]:
    """A text in parts of about ``_TEXT`` characters, cut between words."""
    at = 0
    while len(text) - at > _TEXT and (cut := _BETWEEN.search(text, at + _TEXT)):
        yield text[at:cut.start()]
        at = cut.end()
    if at < len(text):
        yield text[at:]


def _aligned(batch: pa.RecordBatch, words: _Words, keep_groups: bool = False) -> Iterator[tuple[_Aligned, list[bytes]]]:
    """What becomes of each text, and its groups as text if they are kept."""
    column = batch.column("text")
    for i, j in slices(arrow_bytes(column)[1], _TEXT):
        out = [(_Aligned(), []) for _ in range(i, j)]
        held, size = [], 0

        def work():
            fresh = {w for _, parts in held for w in parts if w not in words.number}
            if len(words.number) + len(fresh) > _REMEMBERED:
                words.forget()
                fresh = {w for _, parts in held for w in parts}
            words.learn(sorted(fresh))
            for n, parts in held:
                told = out[n][0].add(words, parts)
                if keep_groups:
                    out[n][1].append(told)

        for n, text in enumerate(column.slice(i, j - i).to_pylist()):
            for part in _segments(text):
                held.append((n, _BETWEEN.split(part)))
                size += len(part)
                if size >= _TEXT:
                    work()
                    held, size = [], 0
        work()
        yield from out


def _frames(keys: np.ndarray, docs: np.ndarray, times: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Count frames and record frames of records that are sorted by pair and document."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sums = np.add.reduceat(times, first)
    counts = [_pack(keys[first[i:i + _FRAME]], sums[i:i + _FRAME]) for i in range(0, len(first), _FRAME)]
    records = []
    for i in range(0, len(keys), _FRAME):
        k = keys[i:i + _FRAME]
        new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        records.append(_pack(k[new], np.diff(new, append=len(k)).astype(np.uint32),
                             docs[i:i + _FRAME].astype(np.uint16), times[i:i + _FRAME].astype(np.uint32)))
    return counts, records


def _run_writer(byte_path: str, piece_path: str, buckets: int, names: list[str]):
    """Rows of two kinds: documents (bucket null) and runs (id null)."""
    def write(batches):
        run = TaskContext.get().partitionId() << 32
        made, size, docs = [], 0, 0
        words = _Words(byte_path, piece_path)

        def runs():
            keys, doc, times = (np.concatenate(x) for x in zip(*made))
            bucket = (keys >> 32) % buckets
            order = np.lexsort((doc, keys, bucket))
            keys, doc, times, bucket = keys[order], doc[order], times[order], bucket[order]
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            some = np.flatnonzero(np.diff(cut)).tolist()
            framed = [_frames(*(x[cut[b]:cut[b + 1]] for x in (keys, doc, times))) for b in some]
            n, none = len(some), lambda kind: pa.nulls(len(some), kind)
            return pa.RecordBatch.from_arrays([
                pa.array([run] * n, pa.int64()), none(pa.int32()), none(id_type), *(none(pa.int64()) for _ in range(3)), none(pa.string()),
                pa.array(some, pa.int32()), pa.array([x for x, _ in framed], pa.list_(pa.binary())),
                pa.array([x for _, x in framed], pa.list_(pa.binary()))], names)

        for batch in batches:
            id_type = batch.column("id").type
            told = []  # run, number in it, n_a, n_b, n_groups, digest
            for x, _ in _aligned(batch, words):
                if docs == _RUN_DOCS or size >= _RUN:
                    if size:
                        yield runs()
                    run, made, size, docs = run + 1, [], 0, 0
                told.append((run, docs, *x.row()))
                keys, times = x.pairs()
                if len(keys):
                    made.append((keys, np.full(len(keys), docs), times))
                    size += len(keys)
                docs += 1
            columns = list(zip(*told)) or [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            run_no, no, *rest = (pa.array(c, k) for c, k in zip(columns, kinds))
            empty = pa.nulls(len(told), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([run_no, no, batch.column("id"), *rest, pa.nulls(len(told), pa.int32()), empty, empty], names)
        if size:
            yield runs()
    return write


def _merged(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way merge of sorted count runs, a frame of each in memory: (pairs, counts) in order."""
    left = [iter(frames) for frames in runs]
    current, heap = {}, []

    def load(r: int) -> None:
        frame = next(left[r], None)
        current.pop(r, None)
        if frame is not None:
            current[r] = _unpack(frame, _COUNTS)
            heapq.heappush(heap, (int(current[r][0][-1]), r))

    for r in range(len(runs)):
        load(r)
    while heap:
        limit = heap[0][0]  # every run shows all it has up to here
        keys, sums = [], []
        for r, (k, s) in current.items():
            n = int(np.searchsorted(k, limit, "right"))
            keys.append(k[:n])
            sums.append(s[:n])
            current[r] = (k[n:], s[n:])
        k, s = np.concatenate(keys), np.concatenate(sums)
        order = np.argsort(k, kind="stable")
        k, s = k[order], s[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        yield k[first], np.add.reduceat(s, first)
        while heap and heap[0][0] == limit:
            load(heapq.heappop(heap)[1])


def _with_best(chunks: Iterator) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Adds whether a pair's count is the highest of its B id; pairs come B id first."""
    def judged(k, s):
        first = np.flatnonzero(np.concatenate([[True], np.diff(k >> 32) != 0]))
        return k, s, s == np.repeat(np.maximum.reduceat(s, first), np.diff(first, append=len(k)))

    kept_k, kept_s = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for k, s in chunks:
        k, s = np.concatenate([kept_k, k]), np.concatenate([kept_s, s])
        cut = int(np.searchsorted(k, (k[-1] >> 32) << 32))  # the last B id may go on
        kept_k, kept_s = k[cut:], s[cut:]
        if cut:
            yield judged(k[:cut], s[:cut])
    if len(kept_k):
        yield judged(kept_k, kept_s)


def _merger(last: bool):
    """Merges the runs of each (bucket, part); the last round adds the maxima."""
    def merge(batches):
        def done(at, runs):
            chunks = _with_best(_merged(runs)) if last else _merged(runs)
            frames = [_pack(*(x[i:i + _FRAME] for x in c)) for c in chunks for i in range(0, len(c[0]), _FRAME)]
            return pa.RecordBatch.from_arrays([
                pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int64()), pa.array([frames], pa.list_(pa.binary()))],
                ["bucket", "part", "frames"])

        at, runs = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "part", "frames"))):
                if row[:2] != at:
                    if runs:
                        yield done(at, runs)
                    at, runs = row[:2], []
                runs.append(row[2])
        if runs:
            yield done(at, runs)
    return merge


def _contributor(batches):
    """Rows by (bucket, share), counts first: sums of each record run by document number."""
    keys = sums = best = None
    for batch in batches:
        for run, frames in zip(batch.column("run").to_pylist(), batch.column("frames")):
            frames = frames.as_py()
            if run is None:
                keys, sums, best = (np.concatenate(x) for x in zip(*(_unpack(f, _TABLE) for f in frames)))
                continue
            count, hits = np.zeros(_RUN_DOCS, np.int64), np.zeros(_RUN_DOCS, np.int64)
            top = 0
            for frame in frames:
                k, n, docs, times = _unpack(frame, _RECORDS)
                at = np.repeat(np.searchsorted(keys, k), n)
                np.add.at(count, docs, sums[at] * times)
                np.add.at(hits, docs, best[at] * times.astype(np.int64))
                top = max(top, int(docs.max()) + 1)
            packed = zstandard.ZstdCompressor(level=1).compress(count[:top].tobytes() + hits[:top].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([run], pa.int64()), pa.array([packed], pa.binary())], ["run", "sums"])


def _summer(batches):
    """Rows by run: the sums of all buckets, one row a document that has any."""
    def done(run, total):
        some = np.flatnonzero(total[0])
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(some), run), pa.int64()), pa.array(some, pa.int32()),
            pa.array(total[0][some]), pa.array(total[1][some])], ["run", "no", "count_sum", "n_best"])

    at, total = None, None
    for batch in batches:
        for run, sums in zip(batch.column("run").to_pylist(), batch.column("sums").to_pylist()):
            if run != at:
                if at is not None:
                    yield done(at, total)
                at, total = run, np.zeros((2, _RUN_DOCS), np.int64)
            part = np.frombuffer(zstandard.ZstdDecompressor().decompress(sums), np.int64).reshape(2, -1)
            total[:, :part.shape[1]] += part
    if at is not None:
        yield done(at, total)


def _dealt(df: DataFrame, rows: int, *order: str) -> DataFrame:
    """``df`` by its first two columns of ``order``, some 128 of its ``rows`` a task; the
    count is stated, since adaptive coalescing knows the bytes only and not the work."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, rows // 128), *order[:2]).sortWithinPartitions(*order)


def _lister(batches):
    """(pair, count, best) rows of the count table."""
    for batch in batches:
        for frames in batch.column("frames"):
            for frame in frames:
                k, s, best = _unpack(frame.as_py(), _TABLE)
                yield pa.RecordBatch.from_arrays([
                    pa.array(k & 0xFFFFFFFF), pa.array(k >> 32), pa.array(s), pa.array(best)], ["a_id", "b_id", "links", "best"])


def align(df: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
          buckets: int = 32) -> tuple[DataFrame, DataFrame]:
    """Documents and pairs.

    The first has one row per input row: id, n_a, n_b, n_groups, n_links,
    n_best (links whose pair has the highest count of its B id, ties included),
    count_sum (of the pairs' counts, over links), groups_sha256.  The second has
    a row for each linked pair: a_id, b_id, links, best.

    Null and empty texts, and those that an encoding doesn't give back byte by
    byte (a normalised character, say), have no tokens: zeros and an empty
    digest.  Repeated rows and rows of one id are counted each; a null id stays
    null.  Other columns of ``df`` are not read; an empty table gives empty ones.
    Special tokens' names inside a text are text.
    """
    spark = df.sparkSession
    texts = df.select(q(id_col).alias("id"), F.coalesce(q(text_col), F.lit("")).alias("text"))
    blobs = T.ArrayType(T.BinaryType())
    fields = [("run", T.LongType()), ("no", T.IntegerType()), ("id", texts.schema["id"].dataType), ("n_a", T.LongType()),
              ("n_b", T.LongType()), ("n_groups", T.LongType()), ("groups_sha256", T.StringType()),
              ("bucket", T.IntegerType()), ("counts", blobs), ("records", blobs)]
    written = stored(texts.mapInArrow(_run_writer(byte_path, piece_path, buckets, [n for n, _ in fields]),
                                      T.StructType([T.StructField(n, t) for n, t in fields])), "runs")
    docs = written.where("bucket is null").select("run", "no", "id", "n_a", "n_b", "n_groups", "groups_sha256")
    runs = written.where("bucket is not null")
    shape = runs.agg(F.count(F.lit(1)), F.countDistinct("run")).first()
    rows, n_runs = int(shape[0]), int(shape[1])

    state, left = runs.select("bucket", F.col("run").alias("part"), F.col("counts").alias("frames")), n_runs
    while True:
        left = -(-left // _FAN) or 1
        parted = state.select("bucket", F.pmod(F.xxhash64("part"), F.lit(left)).alias("part"), "frames")
        state = stored(_dealt(parted, rows, "bucket", "part").mapInArrow(
            _merger(left == 1), "bucket int, part long, frames array<binary>"), "counts")
        rows = buckets * left
        if left == 1:
            break

    shares = -(-n_runs // _SHARE) or 1
    table = state.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))).alias("share"),
                         F.lit(None).cast("long").alias("run"), "frames")
    asked = runs.select("bucket", F.pmod(F.xxhash64("run"), F.lit(shares)).alias("share"), "run", F.col("records").alias("frames"))
    sums = (_dealt(table.unionByName(asked), int(shape[0]) + buckets * shares, "bucket", "share", "run")
            .select("run", "frames").mapInArrow(_contributor, "run long, sums binary"))
    told = (sums.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_runs // 4), "run").sortWithinPartitions("run")
            .mapInArrow(_summer, "run long, no int, count_sum long, n_best long"))
    out = docs.join(told, ["run", "no"], "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
    return out, state.select("frames").mapInArrow(_lister, "a_id long, b_id long, links long, best boolean")


def groups(df: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, groups) with the groups written as ``a1,a2|b1;a3|b2,b3``, empty where there are no tokens."""
    texts = df.select(q(id_col).alias("id"), F.coalesce(q(text_col), F.lit("")).alias("text"))

    def tell(batches):
        words = _Words(byte_path, piece_path)
        for batch in batches:
            told = [b"".join(parts).decode() if x.same else "" for x, parts in _aligned(batch, words, True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(told, pa.string())], ["id", "groups"])
    return (texts.mapInArrow(tell, T.StructType([T.StructField("id", texts.schema["id"].dataType), T.StructField("groups", T.StringType())]))
            .withColumnRenamed("id", id_col))
