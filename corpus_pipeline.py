"""Training corpus from ``documents``: quality rules, fuzzy line dedup, near-duplicate
removal, benchmark decontamination, mixing to target weights.

Every stage takes (spark, docs, sf_dir); what it returns is written as Parquet
and read again as the next one's ``docs``.  All but the last return the columns
of their input, whatever else they are called.  Null texts count as empty, null ids,
languages and sources are values of their own, repeated rows are rows of their own
unless a stage says otherwise, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewise.llm.common import read, stored
from tablewise.llm.decontam import decontaminate
from tablewise.llm.linededup import drop_repeated_lines
from tablewise.llm.mixing import mix
from tablewise.llm.neardup import drop_near_duplicates
from tablewise.llm.quality import keep_good
from tablewise.session import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: null, empty and very short texts among them.
    Repeated rows are judged alike."""
    ship_package(spark)
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-equal lines the first one stays, by document id (null first) and line; documents
    left without a line go, those that had none stay.  Rows equal in id and text are
    one document and don't repeat each other."""
    ship_package(spark)
    return drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays (5-word shingles, similarity 0.8), that of the least
    id, a null one last; of rows equal in id and text one stays.  Texts without a word all stay."""
    ship_package(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, copies of them too; null and empty texts stay.
    Items that are null, empty or of fewer than three words match nothing."""
    ship_package(spark)
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes: one row for each row, none of a null or
    empty text; a null source is a source of its own, the last."""
    ship_package(spark)
    return mix(docs)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SQL for the rows of ``run``: the stages' signatures, alignments and draws have no such form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
