"""A bounded sample of labelled rows for fitting a classifier, and the held-out rule."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.llm._common import text_col

#: Bytes of the sample's texts at most: rows of the sample beyond them, in its order, take no part in fitting.
FIT_BYTES = 128 << 20


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text is divisible by 5; a null id counts as the empty text, which is held out."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int, most_bytes: int = FIT_BYTES) -> Iterator[tuple[str, int]]:
    """At most `limit` labelled (text, label) pairs that are not held out, in the order of a hash of the id, as many as `most_bytes` hold.

    They come one by one, so that the driver needn't hold the texts. Of several labels of one id the largest counts; ids and labels that are null take no part.
    """
    own = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label")).where("id is not null and label is not null")
    own = own.groupBy("id").agg(F.max("label").alias("label")).where(~held_out("id"))
    chosen = own.withColumn("draw", F.md5(F.col("id").cast("string"))).orderBy("draw", "id").limit(limit)
    texts = docs.select(F.col("doc_id").alias("id"), text_col().alias("text"))
    # `limit` bounds the side that is broadcast, so the texts aren't shuffled.
    rows = texts.join(F.broadcast(chosen), "id").withColumn("hash", F.xxhash64("text"))
    order = ["draw", "id", F.length("text"), "hash"]
    first = rows.orderBy(*order).limit(limit)
    upto = F.sum(F.octet_length("text").cast("long")).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for r in first.withColumn("upto", upto).where(F.col("upto") <= most_bytes).select("text", "label").toLocalIterator():
        yield r["text"], r["label"]
