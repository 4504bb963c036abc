"""The corpus pipeline: stages over `documents`, each written as Parquet and read again as the next one's input.

1. quality: documents that the ordinal regression rejects go.
2. near_duplicates: one document of each near-duplicate class stays.
3. decontamination: documents that a benchmark item leaks into go.
4. mixing: each source keeps the token prefix that its budget allows; no document is repeated.
5. sharding: what is left is dealt into shards of near-equal bytes.

Defined results, all through: a null text counts as empty; texts of any length are taken whole; of equal
texts one row stays (the least doc_id, nulls last); null ids, languages and sources are values of their
own; extra columns are carried along up to the last stage, whatever their names; empty tables of
documents, labels or benchmark items are fine (no rows, every document kept, no leaks).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagequarry.llm._common import removed, shared_dir, table
from pagequarry.llm.decontamination import clean
from pagequarry.llm.mixing import DEFAULT_WEIGHTS, default_levels, mix
from pagequarry.llm.near_duplicates import deduplicated
from pagequarry.llm.quality import accepted
from pagequarry.llm.sharding import shards

#: Share of the tokens that the mixture takes in all.
BUDGET_SHARE = 0.8
SHARDS = 40


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = mix(docs, levels=default_levels(), weights=DEFAULT_WEIGHTS, budget_share=BUDGET_SHARE, max_epochs=1, seed=42)
    return out.select(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shards(docs, count=SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The regression, the darts and the packing aren't expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage wrote goes once the next one has read it."""
    docs, before = table(spark, sf_dir, "documents"), []
    home = f"{shared_dir(spark)}/pagequarry/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{name}")
        docs = spark.read.parquet(f"{home}/{name}")
        removed(spark, before)
        before = [f"{home}/{name}"]
    return STAGES[-1][1](spark, docs, sf_dir)
