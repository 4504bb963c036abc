"""Writers of statements and changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pagequarry.model import distinct_statements
from pagequarry.operators.render import marked, render


def table(statements: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Statements as Parquet, a folder for each dataset."""
    statements.write.mode(mode).partitionBy("dataset").parquet(path)


def text(statements: DataFrame, path: str, form: str, codec: str = "bzip2", mode: str = "overwrite") -> dict[str, int]:
    """Lines in a format, a folder for each dataset, bad addresses commented out; the numbers of lines and bad ones."""
    watch = Observation()
    lines = marked(render(statements, form)).observe(watch, F.count(F.lit(1)).alias("lines"), F.sum(F.col("line").startswith("# BAD").cast("long")).alias("bad"))
    lines.write.mode(mode).partitionBy("dataset").option("compression", codec).text(path)
    return {k: v or 0 for k, v in watch.get.items()}


def all_formats(statements: DataFrame, path: str, forms: list[str]) -> None:
    for form in forms:
        text(statements, f"{path}/{form}", form)


def tee(df: DataFrame, *sinks: Callable[[DataFrame], object]) -> None:
    """One frame to several sinks, computed once."""
    held = df.persist()
    try:
        for sink in sinks:
            sink(held)
    finally:
        held.unpersist()


def marker(spark: SparkSession, path: str, run: Callable[[], object]) -> None:
    """A file that stands while `run` works, and one named for its end after it: what is neither running nor done has failed."""
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # noqa: N806
    fs = Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(Path(f"{path}.done"), False)
    fs.create(Path(path), True).close()
    run()
    fs.create(Path(f"{path}.done"), True).close()
    fs.delete(Path(path), False)


def wrapped(sink: Callable[[DataFrame], object], *steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], object]:
    """A sink behind steps that change what it gets, the first one first."""

    def write(df: DataFrame) -> object:
        for step in steps:
            df = step(df)
        return sink(df)

    return write


def distinct_per_page(statements: DataFrame, page: str) -> DataFrame:
    """Statements once each within a page."""
    return statements.dropDuplicates([page, "subject", "predicate", "value", "datatype", "language"])


def distinct(statements: DataFrame) -> DataFrame:
    return distinct_statements(statements)


def limited(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def page_tables(pages: DataFrame) -> dict[str, DataFrame]:
    """The page, revision and text tables of a wiki's own database."""
    return {
        "page": pages.select("page_id", F.col("ns").alias("page_namespace"), F.regexp_replace("title", " ", "_").alias("page_title"), F.col("redirect").isNotNull().cast("int").alias("page_is_redirect"), F.col("revision").alias("page_latest"), F.length("source").alias("page_len")),
        "revision": pages.select(F.col("revision").alias("rev_id"), F.col("page_id").alias("rev_page"), F.col("revision").alias("rev_text_id"), F.col("contributor_name").alias("rev_user_text"), F.col("ts").alias("rev_timestamp")),
        "text": pages.select(F.col("revision").alias("old_id"), F.col("source").alias("old_text")),
    }


def jdbc(pages: DataFrame, url: str, properties: dict[str, str]) -> None:
    for name, df in page_tables(pages).items():
        df.write.jdbc(url, name, mode="append", properties=properties)


def changes(diff: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Changes as compressed lines, a folder for each operation."""
    from pagequarry.operators.render import FORMATS

    diff.select("op", FORMATS["n-triples"]().alias("line")).write.mode(mode).partitionBy("op").option("compression", "gzip").text(path)


def file_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Path, bytes, lines and a checksum of each file below a folder, from its lines, so that no file is held whole.

    The checksum is the exclusive or of the hashes of numbered lines: equal files have equal ones. Bytes
    are those of the text, decompressed.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("packed"), "value")
    at = F.xxhash64("value")
    out = lines.groupBy("path", "packed").agg(F.sum(F.octet_length("value").cast("long") + 1).alias("bytes"), F.count(F.lit(1)).alias("lines"), F.bit_xor(at).alias("all"), F.sum(at % 1_000_003).alias("sum"))
    return out.select("path", "packed", "bytes", "lines", F.lower(F.hex(F.xxhash64("all", "sum", "lines"))).alias("checksum"))
