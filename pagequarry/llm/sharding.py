"""Shards of near-equal bytes: best-fit-decreasing bin packing of indivisible groups of equal texts.

Groups are packed as items, largest first; each enters the bin whose remaining capacity is the
tightest that still holds it, found in a balanced tree of remaining capacities (a sorted list of
bins, searched by bisection). The capacity is the smallest found by bisection for which the items
fit into the given number of bins, so that the bins end up near equal.

The plan that the driver packs is bounded, whatever the corpus: groups that hold at least
1 / (shards * FINE) of all bytes are items of their own, at most shards * FINE of them; all smaller
ones are dealt by hash into at most shards * FINE bundles, which are items too. A group is never
split, so a group of copies larger than a fair share makes its shard larger than the rest.

Defined results: a null text counts as empty, of size OVERHEAD, and is in one group with the empty
ones; an empty table gives no rows; a text of any length is one item; equal rows get a slot each; extra
columns aren't read, whatever their names; slots are gapless from 0 in each shard, in the order of a hash
bucket, then doc_id (nulls first) and text. At scale nearly all items are bundles.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.llm._common import text_col, written

#: Bytes that every row takes besides its text.
OVERHEAD = 16
#: Items per shard that the plan is bounded to, twice: large groups, and bundles of small ones.
FINE = 512
#: Rows of a hash bucket of a shard, about; the rows of one are numbered in one task.
BUCKET_ROWS = 20_000


def best_fit_decreasing(sizes: list[int], capacity: int, bins: int) -> list[int] | None:
    """Bin of each size (sorted descending), or None if they don't fit into so many bins."""
    free = [(capacity, b) for b in range(bins)]  # ordered by remaining capacity
    placed = []
    for size in sizes:
        at = bisect_left(free, (size, -1))
        if at == len(free):
            return None
        left, b = free.pop(at)
        placed.append(b)
        insort(free, (left - size, b))
    return placed


def pack(sizes: list[int], bins: int) -> list[int]:
    """Bin of each size (sorted descending) at the least capacity that bisection finds."""
    if not sizes:
        return []
    low, high = max(sizes[0], -(-sum(sizes) // bins)), max(sizes[0], 2 * -(-sum(sizes) // bins) + sizes[0])
    best = best_fit_decreasing(sizes, high, bins)
    assert best is not None  # half-empty bins always leave room
    while low < high:
        middle = (low + high) // 2
        if (placed := best_fit_decreasing(sizes, middle, bins)) is None:
            low = middle + 1
        else:
            best, high = placed, middle
    return best


def group_key(text: Column) -> Column:
    """128 bits of a text; equal texts share it."""
    return F.unhex(F.md5(text))


def shards(docs: DataFrame, *, count: int = 40, fine: int = FINE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law) of every row."""
    spark = docs.sparkSession
    text = text_col()
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + OVERHEAD).alias("size"), F.crc32(text).alias("text_crc32"), group_key(text).alias("key"))
    rows = written(rows, "sizes", keep=True)
    bound = count * fine
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    total, there = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    large = F.col("bytes") * bound >= F.lit(total)  # at most `bound` groups can be
    bundle = F.pmod(F.xxhash64("key"), F.lit(bound))
    items = (
        groups.select(F.when(large, F.col("key")).alias("key"), F.when(~large, bundle).alias("bundle"), "bytes")
        .groupBy("key", "bundle").agg(F.sum("bytes").alias("bytes"))
        .collect()
    )
    items.sort(key=lambda r: (-r["bytes"], r["key"] or b"", -1 if r["bundle"] is None else r["bundle"]))
    where = pack([r["bytes"] for r in items], count)
    alone = [(bytes(r["key"]), b) for r, b in zip(items, where, strict=True) if r["key"] is not None]
    bundled = [-1] * bound
    for r, b in zip(items, where, strict=True):
        if r["key"] is None:
            bundled[r["bundle"]] = b
    plan = spark.createDataFrame(alone, "key binary, own int")
    of_bundle = spark.createDataFrame([(k, b) for k, b in enumerate(bundled) if b >= 0], "bundle long, theirs int")
    placed = (
        rows.join(F.broadcast(plan), "key", "left")
        .withColumn("bundle", F.when(F.col("own").isNull(), bundle))
        .join(F.broadcast(of_bundle), "bundle", "left")
        .select("doc_id", "size", "text_crc32", "key", F.coalesce("own", "theirs").alias("shard"))
    )
    buckets = max(1, -(-there // (count * BUCKET_ROWS)))
    return numbered(placed, [F.col("doc_id").asc_nulls_first(), F.col("key")], buckets).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def numbered(placed: DataFrame, order: list[Column], buckets: int) -> DataFrame:
    """placed with a gapless slot from 0 in each shard; a shard's rows are numbered in `buckets` tasks, whose row counts the driver adds up."""
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64(*[c for c in placed.columns if c != "shard"], F.lit("slot")), F.lit(buckets)).cast("int"))
    sizes = {(r["shard"], r["bucket"]): r["count"] for r in placed.groupBy("shard", "bucket").count().collect()}
    starts, at = [], 0
    for shard, b in sorted(sizes):
        at = 0 if not starts or starts[-1][0] != shard else at
        starts.append((shard, b, at))
        at += sizes[shard, b]
    offsets = placed.sparkSession.createDataFrame(starts, "shard int, bucket int, first long")
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy(*order))
    return placed.join(F.broadcast(offsets), ["shard", "bucket"]).withColumn("slot", F.col("first") + within - 1).drop("bucket", "first")
