"""Near-duplicate classes by weighted minwise signatures from hashed darts, and banded joining.

A text is a weighted set: its five-word shingles with their number of occurrences, kept as unit
regions (shingle, k-th occurrence). Darts are thrown at every region at hashed times, one after
another, each at a hashed coordinate of the signature; a text's signature holds, for each coordinate,
the earliest dart in its regions. Two texts agree on a coordinate with the probability of their
weighted Jaccard similarity. Time runs only until every coordinate is likely hit, so a long text has
few of its regions hit at all (the signature costs k log k darts, not k times its length); texts with
a coordinate still empty run on for twice as long.

Texts that agree on a whole band are candidates. Equal texts are one node. In a band's bucket every
node is compared with two leaders of the bucket (the one that most texts agree with, and one drawn by
a hash of bucket and node, so that bands differ) by the exact similarity of the shingles. Buckets
that the verified links leave in several classes are resolved exactly: small ones by their pairs
across classes, larger ones (crowds) in groups of bounded size, where the common shingles of all
members are counted by matrix products and only the links that join two classes leave the task. A
crowd that exceeds a group is dealt into parts, and each two parts meet in a group of their own.
Classes are the connected components of the verified links; they are those of all links between
texts that agree on a band. Neither a bucket nor a class is ever collected, and no pairs of a crowd
become rows.

Defined results: a null text counts as empty; texts without words are near only to equal ones (null
and '' are equal); texts of one to four words have one shingle, all of their words; texts of any length
are compared whole; a class is named by its least doc_id (null if all are null); repeated rows are of one
class; an empty table gives no rows; extra columns are carried along by `deduplicated`, whatever their
names, and not read by `classes`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm._common import WORD, fresh, mix64, ragged, row_key, scratch, small_batches, text_col, written
from pagequarry.llm.components import components

WIDTH = 5
SIMILARITY = 0.8
#: Bands and rows of a band: two texts of similarity 0.8 miss all bands with a probability of 3e-5.
BANDS, ROWS = 20, 4
#: Members of a bucket that falls into several classes up to which its pairs across classes are rows.
SMALL = 8
#: Members of a crowd, and their shingles, in a part; two parts meet in a task.
PART_NODES, PART_REGIONS = 1024, 1_000_000
#: Shingles whose columns are multiplied at a time.
COLUMNS = 2048
#: Rows of a leader's shingles that meet its pairs, so that a leader of many isn't one task's.
PAIRS_PER_COPY = 256
REMEMBERED = 500_000


class Shingles:
    """Unit regions of texts; remembers hashes of words."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.known: dict[str, int] = {}

    def word_ids(self, text: str) -> np.ndarray:
        found = WORD.findall(text.lower())
        try:
            return np.array([self.known[w] for w in found], dtype=np.uint64)
        except KeyError:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            for w in found:
                if w not in self.known:
                    self.known[w] = int.from_bytes(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
            return np.array([self.known[w] for w in found], dtype=np.uint64)

    def regions(self, text: str) -> np.ndarray:
        """A distinct number for each (shingle, occurrence), sorted."""
        ids = self.word_ids(text)
        if not len(ids):
            return ids
        width = min(self.width, len(ids))
        h = np.zeros(len(ids) - width + 1, dtype=np.uint64)
        for k in range(width):
            h = mix64(h ^ ids[k : len(ids) - width + 1 + k])
        h.sort()
        first = np.ones(len(h), dtype=bool)
        first[1:] = h[1:] != h[:-1]
        if not first.all():
            at = np.arange(len(h))
            nth = at - np.maximum.accumulate(np.where(first, at, 0))
            h = np.where(nth > 0, mix64(h + nth.astype(np.uint64)), h)
            h.sort()
        return h


def signatures(regions: list[np.ndarray], k: int) -> np.ndarray:
    """The earliest dart of each coordinate (0: the text has no regions), a row for each text."""
    count = np.array([len(r) for r in regions], dtype=np.int64)
    out = np.zeros((len(regions), k), dtype=np.uint64)
    assert out.size < 1 << 20  # coordinates of all texts share 20 bits of a key below
    todo = np.flatnonzero(count)
    until = np.zeros(len(regions))
    until[todo] = (k * np.log(k) + 2 * k) / count[todo]
    while len(todo):
        flat = np.concatenate([regions[i] for i in todo])
        _, row = ragged(count[todo])
        limit = until[todo][row]
        time, chain = np.zeros(len(flat)), flat
        times, rows, cells, darts = [], [], [], []
        while len(flat):
            chain = mix64(chain ^ np.uint64(0xD1B54A32D192ED03))
            # An exponential wait: the darts at a region are a Poisson process.
            time = time - np.log(((chain >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53)
            hit = time <= limit
            flat, row, limit, time, chain = flat[hit], row[hit], limit[hit], time[hit], chain[hit]
            times.append(time)
            rows.append(row)
            dart = mix64(chain)
            darts.append(dart | np.uint64(1))
            cells.append((dart >> np.uint64(32)) % np.uint64(k))
        t, dart = np.concatenate(times), np.concatenate(darts)
        at = np.concatenate(rows) * k + np.concatenate(cells).astype(np.int64)
        # Positive doubles order like their bits: the coordinate and the leading bits of the time in one key.
        order = np.argsort((at.astype(np.uint64) << np.uint64(44)) | (t.view(np.uint64) >> np.uint64(20)))
        at = at[order]
        first = np.ones(len(at), dtype=bool)
        first[1:] = at[1:] != at[:-1]
        got = np.zeros(len(todo) * k, dtype=np.uint64)
        got[at[first]] = dart[order][first]
        got = got.reshape(len(todo), k)
        whole = (got != 0).all(axis=1)
        out[todo[whole]] = got[whole]
        todo = todo[~whole]
        until[todo] *= 2
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.tile(np.arange(bands, dtype=np.uint64), (len(signature), 1))
    for r in range(rows):
        key = mix64(key ^ signature[:, r::rows][:, :bands])
    return key.view(np.int64)


def classes(docs: DataFrame, *, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """row_key, doc_id, root (names the class) and class_id (least doc_id of the class) of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    text = text_col()
    texts = docs.select("doc_id", row_key().alias("row_key"), F.unhex(F.md5(text)).alias("text_key"), text.alias("text"))

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            regions = [shingles.regions(t) for t in batch.column(1).to_pylist()]
            has = np.array([len(r) > 0 for r in regions], dtype=bool)
            keys = band_keys(signatures(regions, bands * rows), bands, rows)[has]
            own = batch.column(0).filter(pa.array(has))
            starts = pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([own, pa.ListArray.from_arrays(starts, pa.array(keys.ravel()))], ["node", "keys"])

    signed = texts.select("text_key", "text").mapInArrow(banded, "node binary, keys array<bigint>")
    with scratch(spark):
        # Rows of one text give equal keys, so buckets count and hold distinct texts.
        buckets = written(signed.select(F.explode("keys").alias("bucket"), "node").distinct(), "bands")
        # Written, so that the join's own exchange of a hot bucket can be split.
        sizes = written(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
        members = written(buckets.join(sizes, "bucket"), "members")
        # The more texts agree with one, the better it leads: the original of many copies comes first.
        central = members.groupBy("node").agg(F.sum("n").alias("central"))
        members = written(members.join(central, "node"), "members")
        pairs = written(led(members.withColumn("root", F.col("node"))), "pairs")
        links = written(similar(pairs, texts, similarity), "links")
        roots = components(links)

        labelled = members.join(roots, "node", "left").select("bucket", "node", "n", "central", F.coalesce("root", "node").alias("root"))
        parts = labelled.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
        parts = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "root")).alias("top")).where("parts > 1")
        torn = written(parts.select("bucket", F.col("top.root").alias("largest")), "torn")
        mixed = written(labelled.join(torn, "bucket"), "mixed")
        few = mixed.where(F.col("n") <= SMALL)
        minor = few.where("root <> largest").select("bucket", F.col("node").alias("b"), F.col("root").alias("own"))
        across = minor.join(few.select("bucket", F.col("node").alias("a"), "root"), "bucket").where("own <> root").select("a", "b")
        tested = pairs.union(pairs.select("b", "a"))
        more = written(across.distinct().join(tested, ["a", "b"], "left_anti"), "more")
        found = [] if more.isEmpty() else [written(similar(more, texts, similarity), "links")]
        crowds = mixed.where(F.col("n") > SMALL).select("bucket", "node", "root")
        if not crowds.isEmpty():
            found.append(written(crowd_links(crowds, texts, similarity), "links"))
        if found:
            roots = components(reduce(DataFrame.union, found, links))
        roots = written(roots, "roots", keep=True)
    named = texts.select("doc_id", "row_key", "text_key").join(roots.withColumnRenamed("node", "text_key"), "text_key", "left")
    named = named.select("row_key", "doc_id", F.coalesce("root", "text_key").alias("root"))
    # Written, so that the join's own exchange of a large class can be split.
    least = written(named.groupBy("root").agg(F.min("doc_id").alias("class_id")), "least", keep=True)
    return named.join(least, "root").select("row_key", "doc_id", "root", "class_id")


def led(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each bucket's members (bucket, node, central, root) with its leaders of another class: the most central one and one drawn by hash."""
    draw = F.struct(F.xxhash64("bucket", "node").alias("draw"), F.col("node").alias("node"), F.col("root").alias("root"))
    leaders = members.groupBy("bucket").agg(F.max(F.struct("central", "node", "root")).alias("most"), F.min(draw).alias("drawn"))
    both = F.array_distinct(F.array(F.struct("most.node", "most.root"), F.struct("drawn.node", "drawn.root")))
    leaders = written(leaders.select("bucket", both.alias("leaders")), "leaders")
    met = members.select("bucket", F.col("node").alias("a"), F.col("root").alias("own")).join(leaders, "bucket")
    other = F.filter("leaders", lambda x: x["root"] != F.col("own"))
    return met.select("a", F.explode(other).alias("b")).select("a", F.col("b.node").alias("b")).distinct()


def shingle_sets(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """node and regions of the texts whose keys are in nodes (node, distinct), written."""
    # One row of each text.
    one = texts.select(F.col("text_key").alias("node"), "row_key").groupBy("node").agg(F.min("row_key").alias("row_key")).join(nodes, "node").select("row_key")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            regions = [shingles.regions(t).view(np.int64) for t in batch.column(1).to_pylist()]
            starts, _ = ragged([len(r) for r in regions])
            flat = pa.array(np.concatenate(regions) if regions else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), flat)], ["node", "regions"])

    read = texts.join(one, "row_key").select("text_key", "text").mapInArrow(shingled, "node binary, regions array<bigint>")
    return written(read.dropDuplicates(["node"]), "regions")


def common(regions: list[np.ndarray]) -> np.ndarray:
    """Numbers of common regions of each two lists: columns of frequent regions by matrix products, the others pair by pair."""
    n = len(regions)
    _, row = ragged([len(r) for r in regions])
    _, column, count = np.unique(np.concatenate(regions), return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    place = np.empty(len(count), dtype=np.int64)
    place[order] = np.arange(len(count))
    column, count = place[column], count[order]
    out = np.zeros((n, n), dtype=np.float32)
    frequent = int(np.searchsorted(-count, -max(2, n // 16), side="right"))
    for k in range(0, frequent, COLUMNS):
        here = (column >= k) & (column < min(k + COLUMNS, frequent))
        x = np.zeros((n, min(COLUMNS, frequent - k)), dtype=np.float32)
        x[row[here], column[here] - k] = 1
        out += x @ x.T
    rare = column >= frequent
    row, column = row[rare], column[rare]
    row = row[np.argsort(column, kind="stable")]
    count = count[frequent:]
    starts = np.cumsum(count) - count
    for p in np.unique(count[count > 1]):
        at = starts[count == p]
        for k in range(0, len(at), max(1, (1 << 20) // int(p * p))):
            members = row[at[k : k + max(1, (1 << 20) // int(p * p))][:, None] + np.arange(p)]
            pair = (members[:, :, None] * n + members[:, None, :]).ravel()
            cell, times = np.unique(pair, return_counts=True)
            out.ravel()[cell] += times
    return out


def joining_links(root: list[bytes], regions: list[np.ndarray], least: float) -> tuple[list[int], list[int]]:
    """Pairs of similar lists of different classes, as few as join the classes that they join."""
    number = {r: k for k, r in enumerate(dict.fromkeys(root))}
    own = np.array([number[r] for r in root])
    both = common(regions)
    size = np.array([len(r) for r in regions], dtype=np.float64)
    a, b = np.nonzero((both >= least * (size[:, None] + size[None, :] - both)) & (own[:, None] < own[None, :]))
    parent = list(range(len(number)))

    def top(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    out: tuple[list[int], list[int]] = ([], [])
    _, first = np.unique(own[a] * len(number) + own[b], return_index=True)
    for i, j in zip(a[first].tolist(), b[first].tolist(), strict=True):
        x, y = top(own[i]), top(own[j])
        if x != y:
            parent[x] = y
            out[0].append(i)
            out[1].append(j)
    return out


def crowd_links(crowds: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between the classes of each bucket's members (bucket, node, root)."""
    sets = shingle_sets(crowds.select("node").distinct(), texts)
    sizes = crowds.join(sets.select("node", F.size("regions").alias("size")), "node").groupBy("bucket").agg(F.count(F.lit(1)).alias("nodes"), F.sum("size").alias("size"))
    parts = sizes.select("bucket", F.ceil(F.greatest(F.col("nodes") / PART_NODES, F.col("size") / PART_REGIONS)).cast("int").alias("parts"))
    dealt = crowds.join(written(parts, "parts"), "bucket").withColumn("part", F.pmod(F.xxhash64("node", "bucket"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = dealt.select("bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "node", "root").join(sets, "node")

    def resolved(group: pa.Table) -> pa.Table:
        nodes, flat = group["node"].combine_chunks(), group["regions"].combine_chunks()
        starts = flat.offsets.to_numpy()
        values = flat.values.to_numpy()
        i, j = joining_links(group["root"].to_pylist(), [values[s:e] for s, e in zip(starts[:-1], starts[1:], strict=True)], least)
        return pa.table({"a": nodes.take(pa.array(i, pa.int64())), "b": nodes.take(pa.array(j, pa.int64()))})

    return met.groupBy("bucket", "low", "high").applyInArrow(resolved, "a binary, b binary")


def similar(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of text keys, b the more shared, whose weighted Jaccard similarity of shingles is at least `least`."""
    read = shingle_sets(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), texts)
    # The side that many pairs share is copied, so that its pairs are spread.
    shared = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_COPY).cast("int").alias("copies"))
    spread = pairs.join(shared, "b").withColumn("copy", F.pmod(F.xxhash64("a"), F.col("copies")).cast("int")).drop("copies")
    right = read.select(F.col("node").alias("b"), F.col("regions").alias("right")).join(shared, "b")
    right = right.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    left = spread.join(read.select(F.col("node").alias("a"), F.col("regions").alias("left")), "a")
    both = F.size(F.array_intersect("left", "right"))
    met = left.join(right, ["b", "copy"]).select("a", "b", both.alias("both"), (F.size("left") + F.size("right")).alias("all"))
    return met.where(F.col("both") >= least * (F.col("all") - F.col("both"))).select("a", "b")


def deduplicated(docs: DataFrame, **settings) -> DataFrame:
    """One row of docs for each class: that of the least doc_id (nulls last), of several the one of the least row key."""
    named = classes(docs, **settings)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row_key"))
    key = fresh(docs, "key__")
    chosen = named.groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.row_key").alias(key))
    kept = docs.withColumn(key, row_key()).join(written(chosen, "chosen", keep=True), key)
    return kept.dropDuplicates([key]).drop(key)
