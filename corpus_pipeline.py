"""The corpus pipeline: from raw documents to a decontaminated mix, one written table per stage.

Every stage works on all rows its predecessor kept and takes ``(spark, docs, sf_dir)``. All but the
last return the columns of ``docs``; the last adds the output shard and the pass of each copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm.common import table
from tallyfold.llm.decontaminate import remove_contaminated
from tallyfold.llm.linededup import drop_repeated_lines
from tallyfold.llm.mixing import mixed
from tallyfold.llm.queries import toxic_labels
from tallyfold.llm.simhash import drop_near_duplicates
from tallyfold.llm.toxicity import drop_toxic
from tallyfold.session import staged


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity lexicon does not reject."""
    return drop_toxic(docs, toxic_labels(docs, table(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier line; a document of repeats only stays, empty."""
    return drop_repeated_lines(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs, shingle=3, radius=3)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents mixed to their sources' targets, in shuffled shards."""
    return mixed(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", without_near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("mixing", mix),
]

#: The lexicon, the similarity join, the components and the draws have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
