"""File sources and sinks and column-name rules.

The header line is read in full through the Hadoop FileSystem API; encoding,
separator and column types are decided by scans of the whole file, and the table
is then read with ``spark.read.csv``; nothing data-sized passes the driver.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.functions.core import nan_to_null, q

# pandas' default NA strings (read_csv ``na_values``).
PANDAS_NA = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# Encodings and separators tried by the robust reader.
ENCODINGS = ("utf-8", "utf-8-sig", "latin1", "cp1252")
SEPARATORS = (",", ";")
SNIFF_SEPARATORS = (",", ";", "\t", "|")


def normalize_names(names: Sequence[str]) -> list[str]:
    """Trim, lower, spaces to '_', drop non-word characters; collisions get a suffix."""
    out, seen = [], {}
    for n in names:
        s = re.sub(r"[^\w]", "", str(n).strip().lower().replace(" ", "_"))
        if s in seen:
            seen[s] += 1
            s = f"{s}_{seen[s]}"
        else:
            seen[s] = 0
        out.append(s)
    return out


def with_normalized_names(df: DataFrame) -> DataFrame:
    return df.toDF(*normalize_names(df.columns))


def normalize_na(df: DataFrame, na_values: Sequence[str] = PANDAS_NA) -> DataFrame:
    """pandas' default NA strings become null in text columns; NaN -> null."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            out.append(F.when(q(f.name).isin(list(na_values)), F.lit(None)).otherwise(q(f.name)).alias(f.name))
        else:
            out.append(q(f.name))
    return nan_to_null(df.select(*out))


#: What pandas reads as a whole number, a number and a truth value.
_WHOLE = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|inf|Inf|INF|infinity|Infinity|INFINITY)\s*$"
_TRUTH = r"^(true|True|TRUE|false|False|FALSE)$"


def infer_types(df: DataFrame) -> DataFrame:
    """Types of text columns whose NA strings are null already, by one aggregate over all
    columns: bigint if every value is a whole number, else double if every value is a
    number, else boolean, else text.  Nulls don't matter; a column without a value is double."""
    kinds = {}
    for i, c in enumerate(df.columns):
        x = q(c)
        kinds[f"n{i}"] = F.count(x)
        kinds[f"w{i}"] = F.count_if(x.rlike(_WHOLE) & x.try_cast("bigint").isNotNull())
        kinds[f"d{i}"] = F.count_if(x.rlike(_NUMBER))
        kinds[f"t{i}"] = F.count_if(x.rlike(_TRUTH))
    seen = df.agg(*[v.alias(k) for k, v in kinds.items()]).first()
    out = []
    for i, c in enumerate(df.columns):
        n = seen[f"n{i}"]
        kind = next((k for k, t in (("w", "bigint"), ("d", "double"), ("t", "boolean")) if n and seen[f"{k}{i}"] == n), None)
        to = {"w": "bigint", "d": "double", "t": "boolean"}.get(kind, "string" if n else "double")
        out.append(q(c) if to == "string" else F.trim(q(c)).cast(to).alias(c))
    return df.select(*out)


#: Spark's names of charsets.  cp1252 differs from ISO-8859-1 in 0x80 to 0x9F only, which are
#: put right after reading, so that no charset beyond Spark's own is needed.
SPARK_CHARSETS = {"latin1": "ISO-8859-1", "latin-1": "ISO-8859-1", "cp1252": "ISO-8859-1", "windows-1252": "ISO-8859-1"}


def _cp1252_texts() -> tuple[str, str]:
    """Characters that ISO-8859-1 gives for the bytes 0x80 to 0x9F, and those that cp1252 has there."""
    told = {chr(b): bytes([b]).decode("cp1252", errors="ignore") for b in range(0x80, 0xA0)}
    told = {k: v for k, v in told.items() if v}
    return "".join(told), "".join(told.values())


def _decoded(df: DataFrame, encoding: str) -> DataFrame:
    if encoding.lower() not in ("cp1252", "windows-1252"):
        return df
    wrong, right = _cp1252_texts()
    to = str.maketrans(wrong, right)
    return df.select(*[F.translate(q(c), wrong, right).alias(c.translate(to)) for c in df.columns])


def read_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "utf-8", infer: bool = True,
             index_col: str | None = None) -> DataFrame:
    """CSV with header; NA tokens to null, then type inference (``infer_types``), so a
    column of numbers and NA is a number; an index column (S2) is moved first."""
    df = (spark.read.option("header", True).option("inferSchema", False).option("sep", sep)
               .option("encoding", "UTF-8" if encoding.lower().startswith("utf-8") else SPARK_CHARSETS.get(encoding.lower(), encoding))
               .option("nullValue", "").option("mode", "PERMISSIVE").csv(path))
    df = _decoded(df.toDF(*[c.lstrip("﻿").strip() for c in df.columns]), encoding)
    df = normalize_na(df)
    if infer:
        df = infer_types(df)
    if index_col:
        df = df.select(q(index_col), *[q(c) for c in df.columns if c != index_col])
    return df


def header_line(spark: SparkSession, path: str) -> bytes:
    """The first line, however long, of the first data file under ``path``, through the Hadoop
    FileSystem API (works for HDFS / S3 / local)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(p).isDirectory():
        files = sorted((st.getPath().toString() for st in fs.listStatus(p)
                        if st.isFile() and not st.getPath().getName().startswith(("_", "."))))
        if not files:
            return b""
        p = jvm.org.apache.hadoop.fs.Path(files[0])
    lines = jvm.org.apache.hadoop.util.LineReader(fs.open(p))
    try:
        line = jvm.org.apache.hadoop.io.Text()
        lines.readLine(line)
        return bytes(line.copyBytes())
    finally:
        lines.close()


def sniff_separator(spark: SparkSession, path: str, encoding: str = "utf-8",
                    candidates: Sequence[str] = SNIFF_SEPARATORS, fallback: str = ",") -> str:
    """The separator that most lines of the file hold as often as the header does, at
    least once; the earlier candidate among equals, ``fallback`` when none is in the header."""
    try:
        header = header_line(spark, path).decode(encoding).lstrip("﻿")
    except (UnicodeDecodeError, LookupError):
        return fallback
    held = [c for c in candidates if c in header]
    if not held:
        return fallback
    lines = spark.read.text(path).where(F.trim("value") != "")
    times = lambda c: F.length("value") - F.length(F.replace("value", F.lit(c)))
    alike = lines.agg(*[F.count_if(times(c) == header.count(c)).alias(f"c{i}") for i, c in enumerate(held)]).first()
    return max(zip(alike, range(0, -len(held), -1), held))[2]


def _is_utf8(spark: SparkSession, path: str) -> bool:
    """Whether every line decodes: a scan of the whole file, which stops at the first that doesn't."""
    return spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1).count() == 0


def safe_read_csv(spark: SparkSession, path: str, encodings: Sequence[str] = ENCODINGS,
                  separators: Sequence[str] = SEPARATORS) -> DataFrame:
    """S3: first (encoding, separator) that decodes the whole file and splits its
    header into more than one column; header names stripped.  latin1 decodes
    any byte, so cp1252 is reached only if every earlier attempt gave one
    column; ask for it by ``encodings=("utf-8", "cp1252")``."""
    header = header_line(spark, path)
    utf8, last = None, "no encoding fits"
    for enc in encodings:
        if enc.lower().startswith("utf-8"):
            utf8 = _is_utf8(spark, path) if utf8 is None else utf8
            if not utf8:
                last = "not UTF-8"
                continue
        first = header.decode(enc, errors="replace").lstrip("﻿")
        for sep in separators:
            if len(first.split(sep)) > 1:
                df = read_csv(spark, path, sep=sep, encoding="utf-8" if enc.startswith("utf-8") else enc)
                return df.toDF(*[c.strip() for c in df.columns])
    raise RuntimeError(f"could not read CSV file: {last}")


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV sink with header, no index; a BOM is prefixed to the header when asked."""
    w = df.write.mode("overwrite").option("header", True)
    if bom:
        first = df.columns[0]
        df = df.withColumnRenamed(first, "﻿" + first)
        w = df.write.mode("overwrite").option("header", True)
    w.csv(path)


def publish_variants(variants: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Several variants of one prepared table, one folder per variant."""
    for name, df in variants.items():
        df.write.mode("overwrite").format(fmt).option("header", True).save(f"{path.rstrip('/')}/variant={name}")


def sample_n(df: DataFrame, row_id: str, n: int, seed: int = 42, kind: str = "xxhash") -> DataFrame:
    """Exactly ``min(n, rows)`` rows chosen by a seeded hash of the row id
    (deterministic; independent of partitioning); ``TakeOrderedAndProject``."""
    from tablewise.operators.learn import split_hash
    return df.withColumn("_h", split_hash(q(row_id), seed, kind)).orderBy("_h", q(row_id)).limit(n).drop("_h")


def synthetic(spark: SparkSession, kind: str, n: int, seed: int = 42, noise: float = 0.1,
              centers: int = 3, n_features: int = 2) -> DataFrame:
    """Seeded generators on ``spark.range``: ``regression`` (x, y = 3x + 2 +
    noise), ``moons`` (two interleaving half circles), ``blobs`` (gaussian
    clusters around seeded centres), ``normal2d`` (correlated 2-D normal)."""
    import math
    r = spark.range(n)
    if kind == "regression":
        x = F.randn(seed)
        return r.select("id", x.alias("x")).withColumn("y", 3 * F.col("x") + 2 + noise * F.randn(seed + 1))
    if kind == "moons":
        t = F.rand(seed) * math.pi
        upper = (F.col("id") % 2) == 0
        x = F.when(upper, F.cos(t)).otherwise(1 - F.cos(t)) + noise * F.randn(seed + 1)
        y = F.when(upper, F.sin(t)).otherwise(0.5 - F.sin(t)) + noise * F.randn(seed + 2)
        return r.select("id", x.alias("x"), y.alias("y"), F.when(upper, 0).otherwise(1).alias("label"))
    if kind == "blobs":
        import random
        rnd = random.Random(seed)
        cs = [[rnd.uniform(-10, 10) for _ in range(n_features)] for _ in range(centers)]
        lab = (F.col("id") % centers).cast("int")
        cols = []
        for j in range(n_features):
            cm = F.create_map(*[F.lit(v) for i, c in enumerate(cs) for v in (i, c[j])])
            cols.append((cm[lab] + F.randn(seed + j)).alias(f"x{j}"))
        return r.select("id", *cols, lab.alias("label"))
    if kind == "normal2d":
        z1, z2 = F.randn(seed), F.randn(seed + 1)
        return r.select("id", z1.alias("x"), (0.5 * z1 + math.sqrt(0.75) * z2).alias("y"))
    raise ValueError(kind)
