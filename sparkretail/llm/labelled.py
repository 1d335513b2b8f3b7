"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.common import held_out


def training_rows(docs: DataFrame, labels: DataFrame, target: str, limit: int) -> DataFrame:
    """(doc_id, text, y) of at most ``limit`` labelled documents that are not held out.

    The sample is the ``limit`` labels with the smallest hash of their id, so it does not
    depend on the layout; it is small by that bound and therefore broadcast. Repeated
    labels of an id count once: 1 if any of them is. Of the rows of a repeated id the one
    whose text has the smallest hash stays, so the bound holds for rows.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(target).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    texts = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    one = texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "y").agg(
        F.min(F.struct(F.xxhash64("text"), "text")).alias("least")
    )
    return one.select("doc_id", "least.text", "y")
