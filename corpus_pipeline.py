"""From raw documents to packed training sequences, in five stages.

Each stage reads what the one before it wrote. All but the last return documents with the columns they came
with; ``n_chars`` follows the text.

1. toxicity: documents that the classifier rejects go.
2. line_dedup: lines that a large share of a source's documents carry go; the documents stay.
3. near_duplicates: of every component of linked documents, the one with the least id stays.
4. decontamination: documents that hold a benchmark window go.
5. packing: the pieces of the training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, jaccard, lines, packing, toxicity
from tidemark.llm.support import stored

#: A model and an encoder are no SQL; the tests compare the stages with brute-force versions.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return toxicity.keep(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.cleaned(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
