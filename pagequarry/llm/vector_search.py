"""Exact top-k search by inner product over vector-approximation files.

Vectors become integers (floor of a scale times each component). The approximation file holds a byte
for each component: the cell of the block's own range that it lies in. A query is scanned against the
cells alone: between the two ends of all cells lie the bounds of its score. What an upper bound below
the kth best lower bound excludes is done with; the exact vectors of the others are read, in the order
of their upper bounds as far as each query needs, and give the scores. Only cells travel to meet the
queries; exact vectors travel for the candidates that are left, a few for each query.

A task scans blocks of cells for a block of queries, so that neither side is ever held whole, and
keeps each query's kth best lower bound over all the blocks it has seen.

Defined results: vectors that are null, empty or hold null or non-finite components take no part,
neither do null ids; vectors of different lengths don't meet; a query never meets rows of its own id;
repeated rows are candidates each; ties go to the smaller id; a query with fewer candidates gets
fewer rows; an empty table gives no rows; extra columns aren't read; a component that exceeds LARGEST
after scaling is an error, since scores might not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.llm._common import small_batches, written

#: Vectors in a block of cells and in one of queries.
BLOCK = 4096
QUERY_BLOCK = 2048
#: Blocks of cells that a task scans.
BLOCKS_PER_TASK = 8
#: Cells of a component.
CELLS = 256
#: Scaled components are at most this; scores of up to 2,048 components then fit a long.
LARGEST = 1 << 25
#: Survivors whose keys are broadcast at most; with more of them both sides are shuffled.
BROADCAST_KEYS = 200_000
LOWEST = -(1 << 62)


def usable(vector: str = "embedding") -> Column:
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~bad


def integers(vectors: DataFrame, scale: float) -> DataFrame:
    """vec_id, ref (tells rows of one id apart) and v (whole numbers) of the usable vectors."""
    wanted = vectors.where(usable("embedding") & F.col("vec_id").isNotNull())
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    ok = F.when(F.exists("v", lambda x: F.abs(x) > LARGEST), F.raise_error(F.lit(f"a scaled component exceeds {LARGEST}"))).otherwise(F.col("v"))
    return wanted.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")).select("vec_id", F.xxhash64("v").alias("ref"), ok.alias("v"))


def approximation(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of each component, and for each component the least value and the width of a cell."""
    low = v.min(axis=0)
    width = -(-(v.max(axis=0) - low + 1) // CELLS)
    return ((v - low) // width).astype(np.uint8), low, width


def packed(rows: DataFrame, size: int, cells: bool) -> DataFrame:
    """Blocks of at most `size` rows (vec_id, ref, v) of one dimension: dim, ids, refs and the vectors, as cells or in full."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, refs, v = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            out = {"dim": pa.array([dim], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()), "refs": pa.array([refs.tobytes()], pa.binary())}
            if cells:
                cell, low, width = approximation(v)
                out |= {"cells": pa.array([cell.tobytes()], pa.binary()), "ends": pa.array([np.stack([low, width]).tobytes()], pa.binary())}
            else:
                out["v"] = pa.array([v.tobytes()], pa.binary())
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            ids, refs = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            offsets, flat = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy(zero_copy_only=False)
            lengths = np.diff(offsets)
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                v = flat[offsets[at][:, None] + np.arange(dim)]
                for k in range(0, len(at), size):
                    part = slice(k, k + size)
                    if dim in held and sum(len(x) for x, *_ in held[dim]) + len(at[part]) > size:
                        yield block(dim)
                    held.setdefault(dim, []).append((ids[at[part]], refs[at[part]], v[part]))
        for dim in list(held):
            yield block(dim)

    fields = "dim int, ids binary, refs binary, " + ("cells binary, ends binary" if cells else "v binary")
    return rows.select("vec_id", "ref", "v").mapInArrow(blocks, fields)


class Scan:
    """Bounds of a block of queries against blocks of cells; remembers each query's kth best lower bound."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.best = np.full((len(ids), k), LOWEST, dtype=np.int64)

    def block(self, ids: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query's index, candidate's index, lower bound, upper bound) of the candidates that aren't excluded."""
        q = self.q
        product = (q * width).astype(np.float64) @ cells.astype(np.float64).T
        # Sums of products below 2^53 are whole; beyond, the bounds give way by what rounding may take.
        give = np.ceil((np.abs(q) * width).sum(axis=1) * float(CELLS) * 2.0**-44).astype(np.int64)
        give[give < 2] = 0
        base = np.rint(product).astype(np.int64) + (q @ low)[:, None]
        under = (np.minimum(q, 0) * (width - 1)).sum(axis=1) - give
        span = (np.abs(q) * (width - 1)).sum(axis=1) + 2 * give
        lower = base + under[:, None]
        lower[self.ids[:, None] == ids[None, :]] = LOWEST
        if lower.shape[1] > self.k:
            top = -np.partition(-lower, self.k - 1, axis=1)[:, : self.k]
        else:
            top = lower
        self.best = -np.sort(-np.concatenate([self.best, top], axis=1), axis=1)[:, : self.k]
        who, at = np.nonzero((lower > LOWEST) & (lower + span[:, None] >= self.kth[:, None]))
        found = lower[who, at]
        return who, at, found, found + span[who]

    @property
    def kth(self) -> np.ndarray:
        return self.best[:, -1]


def scanned(work: DataFrame, k: int) -> DataFrame:
    """query_id, query_ref, vec_id, ref, lower and upper of what no task's own blocks exclude; work: cells next to queries, in order of the queries' block."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[bytes, bytes] | None = None
        seen: Scan | None = None
        refs = np.empty(0, np.int64)
        held: list[tuple[np.ndarray, ...]] = []

        def out() -> pa.RecordBatch:
            who, ids, own, lower, upper = (np.concatenate(x) for x in zip(*held, strict=True))
            keep = upper >= seen.kth[who]
            arrays = [seen.ids[who], refs[who], ids, own, lower, upper]
            return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in arrays], ["query_id", "query_ref", "vec_id", "ref", "lower", "upper"])

        for batch in batches:
            for r in range(len(batch)):
                dim = batch.column(0)[r].as_py()
                ids, own, cells, ends, q_ids, q_refs, q = (batch.column(c)[r].as_buffer() for c in range(1, 8))
                key = (q_ids.to_pybytes(), q_refs.to_pybytes())
                if key != now:
                    if held:
                        yield out()
                    now, held = key, []
                    refs = np.frombuffer(q_refs, dtype=np.int64)
                    seen = Scan(np.frombuffer(q_ids, dtype=np.int64), np.frombuffer(q, dtype=np.int64).reshape(-1, dim), k)
                low, width = np.frombuffer(ends, dtype=np.int64).reshape(2, dim)
                c_ids = np.frombuffer(ids, dtype=np.int64)
                who, at, lower, upper = seen.block(c_ids, np.frombuffer(cells, dtype=np.uint8).reshape(-1, dim), low, width)
                held.append((who, c_ids[at], np.frombuffer(own, dtype=np.int64)[at], lower, upper))
        if held:
            yield out()

    columns = work.select("dim", "ids", "refs", "cells", "ends", "q_ids", "q_refs", "q_v")
    return columns.mapInArrow(scan, "query_id long, query_ref long, vec_id long, ref long, lower long, upper long")


def top_k(queries: DataFrame, candidates: DataFrame, *, k: int = 5, scale: float = 256.0, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score: the k best candidates of every query, both (vec_id, embedding).

    Equal query rows are one query; different vectors of one id are one query with the best of each.
    """
    small_batches(queries.sparkSession, block)
    asked = integers(queries.select("vec_id", "embedding"), scale).dropDuplicates(["vec_id", "ref"])
    exact = integers(candidates.select("vec_id", "embedding"), scale)
    parts = max(1, -(-queries.count() // query_block))
    shares = max(1, candidates.count() // (BLOCKS_PER_TASK * block))
    q = packed(asked.repartition(parts, "vec_id", "ref"), query_block, cells=False)
    q = q.select("dim", F.col("ids").alias("q_ids"), F.col("refs").alias("q_refs"), F.col("v").alias("q_v"), F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int").alias("q"))
    # Fragment and replicate: each block of cells goes once to each part of the queries, each block of
    # queries once to each share of the cells. Pairs of blocks meet, never pairs of rows.
    cells = packed(exact, block, cells=True).withColumn("share", F.pmod(F.xxhash64("ids"), F.lit(shares)).cast("int"))
    cells = cells.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    q = q.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    work = cells.join(q, ["dim", "q", "share"]).sortWithinPartitions("dim", "q", "share", F.xxhash64("q_ids", "q_refs"))
    found = scanned(work, k)
    # Over all tasks: the kth best lower bound of a query excludes what can't reach it.
    best = Window.partitionBy("query_id", "query_ref").orderBy(F.col("lower").desc())
    kth = F.nth_value("lower", k).over(best.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    left = found.withColumn("kth", kth).where(F.col("kth").isNull() | (F.col("upper") >= F.col("kth"))).drop("kth")
    left = written(left, "survivors")
    keys = left.select("vec_id", "ref").distinct()
    few = keys.count() <= BROADCAST_KEYS
    read = exact.join(F.broadcast(keys) if few else keys, ["vec_id", "ref"], "left_semi").dropDuplicates(["vec_id", "ref"])
    mine = asked.select(F.col("vec_id").alias("query_id"), F.col("ref").alias("query_ref"), F.col("v").alias("q_v"))
    score = F.aggregate(F.zip_with("q_v", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    scored = left.join(read, ["vec_id", "ref"]).join(mine, ["query_id", "query_ref"]).select("query_id", "vec_id", score.alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
