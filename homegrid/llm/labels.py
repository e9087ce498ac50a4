"""Labelled rows and splits, shared by the operators that learn."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F


def remainder(parts: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id gives -1, which is in no fold."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts)).cast("int"), F.lit(-1))


def training_sample(docs: DataFrame, labels: DataFrame, column: str, most: int) -> tuple[DataFrame, float]:
    """doc_id, text, label of labelled documents outside the held-out fold, and label 1's share of all.

    At most ``most`` of each label, those with the smallest hash of their id, so that the
    sample is the same each time. Rows without id, text or label, and labels other than 0
    and 1, are left out; of repeated labels the larger one holds.
    """
    usable = (
        labels.select("doc_id", F.col(column).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)").where(remainder(5) != 0)
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    share = usable.agg(F.avg("label").alias("share")).first()["share"]
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = usable.where("label = 0").orderBy(*order).limit(most).unionByName(usable.where("label = 1").orderBy(*order).limit(most))
    # at most twice ``most`` pairs of an id and a label
    return docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id"), float(share or 0.0)


def log_odds(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))
