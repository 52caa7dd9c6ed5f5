"""WARC records in ZIP-packaged archives: write, and range-read without extraction.

An archive is a ZIP with stored members: ``archive/data.warc.gz``, one gzip
member a record, and ``indexes/index.cdxj``, one line a record with its offset
and length inside the former.  The reader finds the end of the central
directory (ZIP64 where there is one), lists the members, takes the index by one
range read and each record by another; the archive is never unpacked.  Files go
through pyarrow's file systems, so a path may be a shared mount or an object
store.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.functions.core import q
from tablewise.llm.common import stored

#: Fixed values of the ZIP format: signatures of the directory's records and the ZIP64 marks.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32, ZIP64_EXTRA = 0xFFFF, 0xFFFFFFFF, 1
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_TIME = "2024-01-01T00:00:00Z"
#: A task starts another archive beyond this many bytes of records.
ARCHIVE_BYTES = 64 << 20


def _open(path: str) -> tuple[fs.FileSystem, str]:
    system, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return system, inner


def _uri(path: str) -> str:
    """file:/x and file:///x are one path to Spark; pyarrow knows the latter."""
    return "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path

#: Most payloads with several records whose list is broadcast instead of shuffling the pages to it.
MOST_HEADS = 200_000


class ZipView:
    """Members of a ZIP file, by range reads only: name -> (offset of the data, stored size)."""

    def __init__(self, file: pa.NativeFile):
        self.file, size = file, file.size()
        tail_at = max(0, size - (22 + FULL16 + 20))
        tail = file.read_at(size - tail_at, tail_at)
        at = tail.rfind(END)
        if at < 0:
            raise ValueError("no end of central directory")
        entries, length, start = struct.unpack_from("<10xHII", tail, at)
        if at >= 20 and tail[at - 20:at - 16] == LOCATOR64:
            where, = struct.unpack_from("<8xQ", tail, at - 20)
            end64 = file.read_at(56, where)
            if end64[:4] != END64:
                raise ValueError("no ZIP64 end of central directory")
            entries, length, start = struct.unpack_from("<32xQQQ", end64)
        self.members = dict(self._entries(file.read_at(length, start), entries))

    def _entries(self, directory: bytes, entries: int) -> Iterator[tuple[str, tuple[int, int]]]:
        at = 0
        for _ in range(entries):
            if directory[at:at + 4] != ENTRY:
                raise ValueError("broken central directory")
            method, packed, plain, n_name, n_extra, n_comment, start = struct.unpack_from("<10xH8xIIHHH8xI", directory, at)
            name = directory[at + 46:at + 46 + n_name].decode()
            extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
            wide, i = [], 0
            while i + 4 <= len(extra):  # the ZIP64 field has, in this order, what is full above
                tag, n = struct.unpack_from("<HH", extra, i)
                if tag == ZIP64_EXTRA:
                    wide = list(struct.unpack_from(f"<{n // 8}Q", extra, i + 4))
                i += 4 + n
            plain = wide.pop(0) if plain == FULL32 else plain
            packed = wide.pop(0) if packed == FULL32 else packed
            start = wide.pop(0) if start == FULL32 else start
            if method == 0:  # stored
                yield name, (start, packed)
            at += 46 + n_name + n_extra + n_comment

    def place(self, name: str) -> tuple[int, int]:
        """Offset and size of a member's bytes; its local header has names of its own length."""
        start, size = self.members[name]
        head = self.file.read_at(30, start)
        if head[:4] != LOCAL:
            raise ValueError("no local header")
        n_name, n_extra = struct.unpack_from("<26xHH", head)
        return start + 30 + n_name + n_extra, size


def _record(page_id, url: str, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has no payload."""
    name = lambda i: "<urn:page:" + ("" if i is None else str(i)) + ">"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http + (payload if kind == "response" else b"")
    head = {"WARC-Type": kind, "WARC-Record-ID": name(page_id), "WARC-Date": _TIME, "WARC-Target-URI": url,
            "Content-Type": "application/http;msgtype=response",
            "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()}
    if kind == "revisit":
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 "WARC-Refers-To": name(refers_to)}
    head["Content-Length"] = str(len(body))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload (what follows the HTTP header) of one record."""
    head, _, rest = gzip.decompress(data).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def _pack(records: list[tuple[bytes, dict]]) -> memoryview:
    out, at, lines = io.BytesIO(), 0, []
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as f:
            for packed, entry in records:
                f.write(packed)
                lines.append(json.dumps(entry | {"offset": at, "length": len(packed)}))
                at += len(packed)
        z.writestr(zipfile.ZipInfo(INDEX), "\n".join(lines))
    return out.getbuffer()


def _writer(folder: str):
    def write(batches):
        """A retried task writes under another name; only the names it returns count."""
        records, size = [], 0

        def flush():
            path = f"{folder}/{uuid.uuid4().hex}.wacz"
            system, inner = _open(path)
            with system.open_output_stream(inner) as f:
                f.write(_pack(records))
            return pa.RecordBatch.from_pydict({"path": [path], "records": [len(records)]})
        for batch in batches:
            for page_id, url, html, digest, kind, to in zip(*(batch.column(n).to_pylist() for n in (
                    "page_id", "url", "html", "digest", "kind", "refers_to"))):
                packed = gzip.compress(_record(page_id, url or "", (html or "").encode(), digest, kind, to), 6, mtime=0)
                records.append((packed, {"id": page_id, "type": kind}))
                size += len(packed)
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    records, size = [], 0
        if records:
            yield flush()
    return write


def _lister(batches):
    """Index lines of each archive: path, offset in the file, length, in the order of the records."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, inner = _open(path)
            with system.open_input_file(inner) as f:
                view = ZipView(f)
                data, _ = view.place(DATA)
                at, size = view.place(INDEX)
                entries = [json.loads(x) for x in f.read_at(size, at).decode().split("\n") if x]
            for i in range(0, len(entries), 10_000):
                part = entries[i:i + 10_000]
                yield pa.RecordBatch.from_pydict({
                    "path": [path] * len(part), "at": [data + e["offset"] for e in part], "length": [e["length"] for e in part]},
                    schema=pa.schema([("path", pa.string()), ("at", pa.int64()), ("length", pa.int64())]))


def _reader(batches):
    """Range-reads records; the digest of a payload that is there is taken from its bytes."""
    name, file = None, None
    for batch in batches:
        rows = []
        for path, at, length in zip(*(batch.column(n).to_pylist() for n in ("path", "at", "length"))):
            if path != name:
                system, inner = _open(path)
                name, file = path, system.open_input_file(inner)
            fields, payload = parse_record(file.read_at(length, at))
            told = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            whole = fields["WARC-Type"] == "response"
            if whole and hashlib.sha1(payload).hexdigest() != told:
                raise ValueError(f"{path}, {at}: the payload is not what its digest says")
            ident = [fields.get(k, "").removeprefix("<urn:page:").removesuffix(">") or None for k in ("WARC-Record-ID", "WARC-Refers-To")]
            rows.append((ident[0], fields["WARC-Target-URI"], fields["WARC-Type"], ident[1], told,
                         len(payload) if whole else None, payload.decode() if whole else None))
        yield pa.RecordBatch.from_pydict(dict(zip(
            ("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"), map(list, zip(*rows)))) if rows else {
                n: [] for n in ("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload")},
            schema=_RECORDS)


_RECORDS = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
                      ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.string())])


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   text_col: str = "html", least_bytes: int = 1000) -> DataFrame:
    """Writes one record per row; returns the archives (path, records).

    Of the rows with equal payloads of ``least_bytes`` bytes or more, the one
    with the greatest id is a response and the others revisit it; rows that tie
    at the greatest id are responses, and so are all where every id is null.  A
    null text is an empty payload, a null URL an empty one.  An empty table
    writes no archive.
    """
    text = F.coalesce(q(text_col), F.lit(""))
    pages = df.select(q(id_col).alias("page_id"), q(url_col).alias("url"), text.alias("html"),
                      F.sha1(text.cast("binary")).alias("digest"), F.octet_length(text).alias("bytes"))
    heads = (pages.where(F.col("bytes") >= least_bytes).groupBy("digest")
             .agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("times")).where("times > 1").select("digest", "head"))
    heads = stored(heads, "heads")
    if heads.limit(MOST_HEADS + 1).count() <= MOST_HEADS:  # some hundred bytes each
        heads = F.broadcast(heads)
    told = pages.join(heads, "digest", "left")
    revisit = F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head")) & (F.col("bytes") >= least_bytes)
    told = told.select("page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "digest",
                       F.when(revisit, "revisit").otherwise("response").alias("kind"),
                       F.when(revisit, F.col("head")).alias("refers_to"))
    return stored(told.mapInArrow(_writer(_uri(folder)), "path string, records long"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Records of the archives listed in ``path``: page_id, url, record_type,
    refers_to (ids as text), payload_digest (hex), payload_bytes, payload; the
    last two are null for revisits.  Indexes are read first, then the records,
    spread by archive and position."""
    spark = archives.sparkSession
    index = archives.select("path").repartition("path").mapInArrow(_lister, "path string, at long, length long")
    spread = index.repartition(F.col("path"), F.floor(F.col("at") / (8 << 20))).sortWithinPartitions("path", "at")
    return spread.mapInArrow(_reader, T.StructType([
        T.StructField(n, T.LongType() if n == "payload_bytes" else T.StringType()) for n in _RECORDS.names]))


def new_folder(spark: SparkSession) -> str:
    """A folder for archives beside the checkpoints, which all executors share."""
    from tablewise.session import checkpoint_dir
    folder = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    system, inner = _open(_uri(folder))
    system.create_dir(inner)
    return folder


def round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
               least_bytes: int = 1000) -> DataFrame:
    """Writes the archives and reads them back: one row per record with page_id,
    payload_bytes and payload_digest (of the full payload), record_type, refers_to.
    A revisit's bytes are those of the record that it refers to."""
    kind = df.schema[id_col].dataType
    records = read_archives(write_archives(df, new_folder(df.sparkSession), id_col, url_col, text_col, least_bytes))
    read = stored(records.select(F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type",
                                 F.col("refers_to").cast(kind)), "records")
    full = (read.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("digest"))
            .agg(F.max("payload_bytes").alias("bytes")))
    seen = read.where("record_type = 'revisit'").join(full, F.col("payload_digest") == F.col("digest"), "left")
    return read.where("record_type = 'response'").unionAll(
        seen.select("page_id", F.col("bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")).withColumnRenamed("page_id", id_col)
