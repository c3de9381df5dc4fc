"""The corpus pipeline: toxic documents go, repeated lines go, one document of each near-duplicate
class stays, documents with benchmark passages go, and what is left is packed into batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscora.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from fiscora.llm.common import Workspace, by_place
from fiscora.llm.labels import fold


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold, learnt from the rows outside the held-out third."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.acceptable(docs, labels, fold("doc_id", 3) != 1)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; ``n_chars`` follows the text."""
    plain, names, at = by_place(line_dedup.cleaned(docs))
    if "n_chars" not in names:
        return plain.toDF(*names)
    kind = docs.schema.fields[names.index("n_chars")].dataType
    counted = F.length(at["text"]).cast(kind)
    return plain.select(*(counted if i == names.index("n_chars") else F.col(f"c{i}") for i in range(len(names)))).toDF(*names)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class at similarity 0.8 over five-word shingles."""
    return near_dedup.deduplicated(docs, size=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of what is left."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: Learning, sketching and optimal buckets have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each stage's rows are written, and read again as the next one's input."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = work.put(stage(spark, docs, sf_dir), name)
        if i > 0:
            work.drop(STAGES[i - 1][0])
    return docs
