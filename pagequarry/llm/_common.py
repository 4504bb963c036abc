"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch of texts: bounds a Python worker's memory when texts are long.
TEXT_BATCH = 512

WORD = re.compile(r"\w+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_col(name: str = "text") -> Column:
    """The text; a null one counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def small_batches(spark: SparkSession, rows: int = TEXT_BATCH) -> None:
    """Keep Arrow batches of texts small; a smaller setting of the session's own stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for cut lineages, named in spark.checkpoint.dir; where that is unset, a folder of this machine if the session runs on it alone, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="pagequarry-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


_open: list[list[str]] = []


def written(df: DataFrame, name: str, *, keep: bool = False) -> DataFrame:
    """df as a table written to the shared folder: a lost executor costs a reread, not a recomputation.

    Within `scratch` it goes at the end, unless it is to be kept for the result that is returned.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pagequarry/{name}-{uuid.uuid4().hex}"
    if _open and not keep:
        _open[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, paths: Iterable[str]) -> None:
    """Deletes folders of the shared file system."""
    for path in paths:
        of = spark._jvm.org.apache.hadoop.fs.Path(path)
        of.getFileSystem(spark._jsc.hadoopConfiguration()).delete(of, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end; what is returned may only read tables that are kept."""
    _open.append([])
    try:
        yield
    finally:
        removed(spark, _open.pop())


def fresh(df: DataFrame, name: str) -> str:
    """A column name like `name` that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits that name a row by its id and text (equal rows share it; null ids are a value of their own)."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.lit(":"), text_col(text))))


def mix64(x: np.ndarray) -> np.ndarray:
    """Avalanche of unsigned 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ragged(lengths: Iterable[int] | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) of a ragged array with these lengths, and each element's row."""
    n = np.asarray(lengths, dtype=np.int64)
    starts = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(n, out=starts[1:])
    return starts, np.repeat(np.arange(len(n)), n)
