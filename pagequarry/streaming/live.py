"""Incremental extraction: feeds, de-duplication, debouncing, queues, stateful differences and publishing.

The functions on plain frames work on batches and, where they say so, on streams alike.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagequarry.model import STATEMENT_KEY
from pagequarry.operators.post import cut, set_difference, small

ITEM_SCHEMA = "item_id long, priority int, name string, modified timestamp, deleted boolean, xml string"


def feed(spark: SparkSession, folder: str, schema: str = ITEM_SCHEMA, files_per_trigger: int = 1, form: str = "parquet") -> DataFrame:
    """A folder as a stream; the rate bounds what a micro-batch holds."""
    return spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(folder)


def accepted(items: DataFrame, namespaces: list[int], language: str) -> DataFrame:
    """Items of the namespaces and language wanted, with a timestamp. Streams too."""
    return items.where(F.col("ns").isin(namespaces) & (F.col("lang") == language) & F.col("modified").isNotNull())


def once_per_timestamp(df: DataFrame, key: str, ts: str, delay: str = "10 minutes") -> DataFrame:
    """A row for each key and timestamp; on a stream within the watermark."""
    if df.isStreaming:
        return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key, ts])
    return df.dropDuplicates([key, ts])


def debounced(df: DataFrame, key: str, ts: str, value: str, gap: str) -> DataFrame:
    """Sessions of a key closed by a pause of at least `gap`: opened, n and the latest value. Streams too, given a watermark."""
    kind = dict(df.dtypes)[ts]
    s = df.withColumn("at", F.col(ts).cast("timestamp"))
    out = s.groupBy(key, F.session_window("at", gap).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.max_by(value, F.struct(F.col("at"), F.col(value))).alias("latest")
    )
    return out.select(key, F.col("w.start").cast(kind).alias("opened"), "n", "latest")


def throughput(df: DataFrame, ts: str, widths: list[str]) -> DataFrame:
    """Counts in tumbling windows of each width."""
    out = None
    for w in widths:
        one = df.groupBy(F.window(F.col(ts).cast("timestamp"), w).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(w).alias("width"), F.col("w.start").cast("timestamp_ntz").alias("opened"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def queue(items: DataFrame, name: str, priority: str, ts: str, ranges: int = 64) -> DataFrame:
    """Each name once, at its best priority and then its earliest time, with its place from 1.

    Names are ranked within ranges of the order; the sizes of the ranges before, which are few, are added.
    """
    best = items.groupBy(name).agg(F.min(F.struct(F.col(priority).alias("priority"), F.col(ts).alias("ts"))).alias("b")).select(name, "b.priority", "b.ts")
    order = ["priority", "ts", name]
    ranged = best.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id())
    ranged = cut(ranged, "queue")
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    firsts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(before, F.lit(0)).alias("first"))
    place = (F.col("first") + F.row_number().over(Window.partitionBy("range").orderBy(*order))).cast("int")
    return ranged.join(F.broadcast(firsts), "range").withColumn("place", place).drop("range", "first")


def oldest(df: DataFrame, key: str, ts: str, before: str, n: int) -> DataFrame:
    """The n keys that were seen last before a time, the longest ago first."""
    last = df.groupBy(key).agg(F.max(ts).alias("last_seen"))
    return last.where(F.col("last_seen") < F.lit(before).cast("timestamp_ntz")).orderBy("last_seen", key).limit(n)


# --- stateful differences ---------------------------------------------------------------------------

DIFF_SCHEMA = "page string, subject string, predicate string, value string, datatype string, language string, op string"
STATE_SCHEMA = "rows array<string>, times int"
CLEAN_EVERY = 5


def _differ(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The latest version of a page against the one in the state; a deleted page clears it."""
    new = pd.concat(list(batches))
    new = new[new["version"] == new["version"].max()]
    columns = ["subject", "predicate", "value", "datatype", "language"]
    old, times = (set(state.get[0]), state.get[1]) if state.exists else (set(), 0)
    rows = {json.dumps([None if v is None or v != v else str(v) for v in r]) for r in new.loc[~new["deleted"].astype(bool), columns].itertuples(index=False)}
    out = [(r, "added") for r in sorted(rows - old)] + [(r, "deleted") for r in sorted(old - rows)]
    if times and times % CLEAN_EVERY == 0:
        out += [(r, "reinserted") for r in sorted(rows & old)]
    if rows:
        state.update((sorted(rows), times + 1))
    elif state.exists:
        state.remove()
    parts = [[key[0], *json.loads(r), op] for r, op in out]
    yield pd.DataFrame(parts, columns=["page", *columns, "op"])


def page_differences(statements: DataFrame) -> DataFrame:
    """A stream (page, version, deleted, subject, predicate, value, datatype, language) as its changes.

    Each page's last statements are the state; every fifth update gives what stayed as reinserted.
    """
    return statements.groupBy("page").applyInPandasWithState(_differ, DIFF_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


def restricted(diff: DataFrame, rules: DataFrame) -> DataFrame:
    """Changes under extractor rules (predicate, status: active, purge, keep): purged ones become deletions, kept ones none; without a rule they pass."""
    out = diff.join(small(rules.select(F.col("predicate"), F.col("status"))), "predicate", "left")
    op = F.when((F.col("status") == "purge") & (F.col("op") == "added"), "deleted").when(F.col("status") == "keep", "unmodified").otherwise(F.col("op"))
    return out.withColumn("op", op).drop("status")


def affected_pages(mapping_edits: DataFrame, usage: DataFrame) -> DataFrame:
    """Pages that use an edited template: a stream of edits joined with the table of uses."""
    return mapping_edits.join(usage, "template").select("page", "modified")


#: Bounds of what is published at once: pages, and statements of any operation.
FLUSH_PAGES, FLUSH_STATEMENTS = 400, 5000


def flushes(changes: DataFrame, pages: int = FLUSH_PAGES, statements: int = FLUSH_STATEMENTS) -> DataFrame:
    """changes (seq, page, op, ...) with flush: the number of the publication that each page's changes are part of.

    A flush holds at most so many pages and, unless one page alone has more, so many statements of any
    operation; pages keep the order of their first change (seq). Pages are dealt to flushes by running
    sums, which is an upper bound of the number that a page by page decision would need.
    """
    per_op = changes.groupBy("page", "op").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("seq"))
    sizes = per_op.groupBy("page").agg(F.max("n").alias("n"), F.min("seq").alias("seq"))
    upto = Window.orderBy("seq", "page").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(upto), F.lit(0))
    numbered = sizes.select("page", "seq", F.floor(before(F.lit(1)) / pages).alias("a"), F.floor(before("n") / statements).alias("b"))
    flush = F.dense_rank().over(Window.orderBy("a", "b"))
    return changes.join(numbered.select("page", flush.alias("flush")), "page")


def files_per_trigger(waiting: int, threshold: int, most: int) -> int:
    """How many files the next micro-batch of low-priority work may take while `waiting` items queue: `most` below the threshold, fewer in proportion above it, one at least."""
    return max(1, most if waiting <= threshold else most * threshold // waiting)


def export_cache(cache: DataFrame) -> DataFrame:
    """Statements of a cache (page, json: datasets with their statements) for a full export."""
    schema = "map<string, array<struct<subject: string, predicate: string, value: string, datatype: string, language: string, context: string>>>"
    rows = cache.select("page", F.explode(F.from_json("json", schema)).alias("dataset", "held")).select("page", "dataset", F.explode("held").alias("s"))
    return rows.select("s.language", "dataset", "s.subject", "s.predicate", "s.value", "s.context", "s.datatype")


def publish(changes: DataFrame, folder: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Changes as files by operation, a folder for each micro-batch; replays overwrite their own."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("op").parquet(f"{folder}/batch={number}")

    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


#: Parts of the state table: a micro-batch rewrites only those that its pages fall into.
STATE_PARTS = 256


def process(items: DataFrame, extract: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str, parts: int = STATE_PARTS) -> StreamingQuery:
    """Each micro-batch: every name once by priority and time, extracted, compared with the state and published.

    `extract` gives statements whose context is the page's name. The state (folder/state) holds for each
    page its statements, how often and when it changed, and the error if it couldn't be extracted; it is
    dealt by a hash of the page into parts, of which a batch writes new versions (part=/version=) beside
    the old ones, so that a replay starts from the same versions. Changes go to folder/diff by batch.
    A page that fails keeps its statements and is noted with its error.
    """
    columns = [*STATEMENT_KEY, "context"]

    def latest_versions(spark: SparkSession, wanted: list[int], before: int) -> DataFrame | None:
        """The newest version before a batch of each part wanted."""
        Path = spark._jvm.org.apache.hadoop.fs.Path  # noqa: N806
        fs = Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        paths = []
        for part in wanted:
            home = Path(f"{folder}/state/part={part}")
            if fs.exists(home):
                found = [int(x.getPath().getName().partition("=")[2]) for x in fs.listStatus(home) if x.getPath().getName().startswith("version=") and fs.exists(Path(f"{x.getPath().toString()}/_SUCCESS"))]
                if own := [v for v in found if v < before]:
                    paths.append(f"{folder}/state/part={part}/version={max(own)}")
        return spark.read.parquet(*paths) if paths else None

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        latest = cut(batch.groupBy("name").agg(F.max_by(F.struct(*batch.columns), F.struct(F.col("modified"), F.col("item_id"))).alias("i")).select("i.*").withColumn("part", F.pmod(F.xxhash64("name"), F.lit(parts)).cast("int")), "batch")
        touched = [r["part"] for r in latest.select("part").distinct().collect()]  # at most `parts`
        error, new = None, None
        try:
            new = cut(extract(latest.where("not coalesce(deleted, false)")).select(*columns), "extracted")
        except Exception as failed:  # the pages of this batch keep what they had
            error = str(failed)[:1000]
        held = latest_versions(spark, touched, number)
        none = "array<struct<subject: string, predicate: string, value: string, datatype: string, language: string>>"
        if held is None:
            held = spark.createDataFrame([], f"page string, statements {none}, times int, changed timestamp, error string, part int")
        state = held.select("page", "statements", "times", "changed", "error", F.pmod(F.xxhash64("page"), F.lit(parts)).cast("int").alias("part"))
        old = state.select(F.col("page").alias("context"), F.explode("statements").alias("s")).select("s.*", "context").join(latest.select(F.col("name").alias("context")), "context", "left_semi").select(*columns)
        if error is None:
            set_difference(old, new, columns).where("op <> 'unmodified'").write.mode("overwrite").partitionBy("op").parquet(f"{folder}/diff/batch={number}")
            made = new.groupBy("context").agg(F.array_sort(F.collect_set(F.struct(*STATEMENT_KEY))).alias("new"))
            joined = latest.select(F.col("name").alias("page"), "part", "modified", "deleted").join(state.drop("part"), "page", "left").join(made.withColumnRenamed("context", "page"), "page", "left")
            now = joined.where("not coalesce(deleted, false)").select("page", F.coalesce("new", F.array().cast(none)).alias("statements"), (F.coalesce("times", F.lit(0)) + 1).alias("times"), F.col("modified").alias("changed"), F.lit(None).cast("string").alias("error"), "part")
        else:
            joined = latest.select(F.col("name").alias("page"), "part", "modified").join(state.drop("part"), "page", "left")
            now = joined.select("page", F.coalesce("statements", F.array().cast(none)).alias("statements"), F.coalesce("times", F.lit(0)).alias("times"), "changed", F.lit(error).alias("error"), "part")
        rest = state.join(latest.select(F.col("name").alias("page")), "page", "left_anti")
        whole = cut(rest.select(*now.columns).unionByName(now), "state")
        for part in touched:
            whole.where(F.col("part") == part).drop("part").coalesce(1).write.mode("overwrite").parquet(f"{folder}/state/part={part}/version={number}")

    return items.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step).trigger(availableNow=True).start()


def pages_of_state(spark: SparkSession, folder: str) -> DataFrame:
    """page, statements, times, changed and error of every page in a state that `process` keeps."""
    rows = spark.read.option("basePath", f"{folder}/state").parquet(f"{folder}/state")
    newest = rows.groupBy("part").agg(F.max("version").alias("version"))
    return rows.join(F.broadcast(newest), ["part", "version"]).drop("part", "version")
