"""Labelled training rows of the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscora.llm.common import narrow

SAMPLE_ROWS = 20_000


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``. NULL for a row without an id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def training_texts(documents: DataFrame, labels: DataFrame, label: str, learn: Column, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text``, ``y`` (0 or 1) of at most ``sample_rows`` labelled documents.

    ``learn`` is a condition on ``doc_id``. The sample is the rows with the least hash of
    the id, the same on every run; it is small enough to go to every task, so texts are
    not shuffled. A document with several labels counts as 1 if any of them is; a
    document that occurs again is learnt again.
    """
    chosen = (
        narrow(labels, "doc_id", label)
        .filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learn)
        .groupBy("doc_id")
        .agg(F.max((F.col(label) == 1).cast("int")).alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    return narrow(documents, "doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y")
