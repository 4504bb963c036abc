"""Mixing sources to target weights by hierarchical budgets.

The leaves are the sources under their language under their domain. A budget in tokens flows down:
each node parts its budget among its children by weight; a child that cannot take its part (its
leaves hold too few tokens, over all epochs allowed) gives the shortage to its siblings, by weight,
and only what no sibling can take goes up to the siblings of their parent. Each leaf then takes a
prefix, in tokens, of its epochs: an epoch is all rows of the leaf in an order drawn from the seed,
the epoch and the row; the row at the budget's edge is taken if at least half of it lies inside.

A narrow table of leaves, tokens and keys is made once; from it come the leaves' sums, the sums of
ranges of draws (a range holds about RANGE_ROWS rows, however large the leaf) and the row at which the
edge lies, since only the rows of the range that the edge falls into are ordered. Then one pass over the
documents takes what lies before its leaf's edge. A row's draw comes with the result, so a prefix can be
repeated or carried on.

The tree's domains are a parameter; `default_levels` deals them by the checksum of the source's name,
a stand-in where the tables have none. So are tokens: the default counts words between white space,
which costs no Python; pass a column for a tokenizer's counts.

Defined results: null domain, language or source are the value '(none)'; a null or empty text has no
tokens and is taken whenever its draw lies before the edge; of equal rows, which have equal draws, as
many are taken as fit; weights that are missing are 1, and a node whose children all have weight 0 gives
them nothing; texts of any length are taken or left whole; an empty table gives no rows; extra columns
are carried along, whatever their names, but for one named mix__, which the result replaces; more than
LEAVES leaves are an error, since their budgets are parted on the driver.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.llm._common import row_key, scratch, text_col, written

NONE = "(none)"
#: Rows in a range of draws, about; those of one range in a leaf are ordered in one task.
RANGE_ROWS = 1000
LEAVES = 200_000

Path = tuple[str, ...]


def share(budget: float, weights: Mapping[str, float], room: Mapping[str, float]) -> dict[str, float]:
    """Parts of a budget by weight, none above its room; what one can't take goes to the others by weight."""
    got = dict.fromkeys(weights, 0.0)
    open_, left = {k for k, w in weights.items() if w > 0 and room[k] > 0}, min(budget, sum(room[k] for k, w in weights.items() if w > 0))
    while open_ and left > 1e-9:
        total = sum(weights[k] for k in sorted(open_))
        full = {k for k in open_ if got[k] + left * weights[k] / total >= room[k] - 1e-9}
        if not full:
            for k in sorted(open_):
                got[k] += left * weights[k] / total
            break
        for k in sorted(full):
            left -= room[k] - got[k]
            got[k] = room[k]
        open_ -= full
    return got


def budgets(tokens: Mapping[Path, int], weights: Mapping[Path, float], budget: float, max_epochs: float) -> dict[Path, float]:
    """Tokens that each leaf shall give. weights: of nodes at any depth, by their path from the root."""
    children: dict[Path, set[str]] = defaultdict(set)
    room: dict[Path, float] = defaultdict(float)
    for leaf, n in tokens.items():
        for d in range(len(leaf)):
            children[leaf[:d]].add(leaf[d])
        usable = all(weights.get(leaf[: d + 1], 1.0) > 0 for d in range(len(leaf)))
        for d in range(len(leaf) + 1):
            room[leaf[:d]] += n * max_epochs * usable
    out = {(): float(budget)}
    for node in sorted(children, key=lambda p: (len(p), p)):
        below = sorted(children[node])
        parts = share(out[node], {c: weights.get((*node, c), 1.0) for c in below}, {c: room[*node, c] for c in below})
        out |= {(*node, c): x for c, x in parts.items()}
    return {leaf: out[leaf] for leaf in tokens}


def word_tokens(text: Column) -> Column:
    """Words between white space, a stand-in for a tokenizer's count that costs no Python."""
    return F.when(F.trim(text) == "", 0).otherwise(F.size(F.split(F.trim(text), r"\s+"))).cast("long")


def mix(
    docs: DataFrame,
    *,
    levels: Mapping[str, Column],
    weights: Mapping[Path, float],
    budget_share: float = 1.0,
    max_epochs: int = 4,
    seed: int = 1,
    tokens: Column | None = None,
) -> DataFrame:
    """Rows taken, with all columns of docs and a column mix__ (levels, tokens, epoch, draw).

    levels: the tree from the top, a column for each depth; budget_share: of all tokens there are.
    """
    spark, names = docs.sparkSession, list(levels)
    counted = word_tokens(text_col()) if tokens is None else tokens
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns if c != "mix__"])
    leaf = [F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for n, c in levels.items()]
    fields, at_leaf = ", ".join(f"`{n}` string" for n in names), [F.col(f"`{n}`") for n in names]
    with scratch(spark):
        narrow = written(docs.select(*leaf, counted.cast("long").alias("tokens"), row_key().alias("key")), "leaves")
        sums = narrow.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")).limit(LEAVES + 1).collect()
        if len(sums) > LEAVES:
            raise ValueError(f"more than {LEAVES} leaves")
        held = {tuple(r[n] for n in names): int(r["tokens"] or 0) for r in sums}
        goal = budgets(held, weights, sum(held.values()) * budget_share, max_epochs)
        # Of each leaf: whole epochs, the tokens of the epoch that is cut, and the ranges of its draws.
        cuts = []
        for r in sums:
            own = tuple(r[n] for n in names)
            n = held[own]
            whole = int(goal[own] // n) if n else int(goal[own] > 0 or budget_share >= 1)
            rest = goal[own] - whole * n
            if n and n - rest < 1e-6 * n:  # rounding
                whole, rest = whole + 1, 0.0
            cuts.append((*own, min(whole, max_epochs), float(rest if whole < max_epochs else 0), -(-r["rows"] // RANGE_ROWS)))
        leaves = spark.createDataFrame(cuts, f"{fields}, whole int, rest double, ranges int")
        # A row's draw in an epoch: a hash of the seed, the epoch and the row.
        draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("whole").cast("string"), F.lit(":"), F.hex("key")))
        range_ = (F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") * F.col("ranges") / 2**32).cast("int")
        drawn = narrow.join(F.broadcast(leaves.where("rest > 0")), names).withColumn("draw", draw).withColumn("range", range_)
        by_range = drawn.groupBy(*names, "range").agg(F.sum("tokens").alias("n"), F.first("rest").alias("rest"))
        before = F.sum("n").over(Window.partitionBy(*names).orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
        edges = by_range.withColumn("before", F.coalesce(before, F.lit(0))).where("before < rest and before + n >= rest")
        edge = [(*(r[n] for n in names), r["range"], float(r["rest"] - r["before"])) for r in edges.collect()]
        on_edge = drawn.join(F.broadcast(spark.createDataFrame(edge, f"{fields}, range int, inside double")), [*names, "range"])
        order = Window.partitionBy(*names).orderBy("draw", "key")
        upto = F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        # The rows taken are a prefix of the order: that up to a row, of whose equals some may be left.
        judged = on_edge.withColumn("taken", upto - F.col("tokens") / 2 <= F.col("inside"))
        alike = judged.groupBy(*names, "range", "draw", "key").agg(F.count(F.lit(1)).alias("rows"), F.count_if("taken").alias("taken"))
        last = alike.where("taken > 0").groupBy(*names, "range").agg(F.max(F.struct("draw", "key", "rows", "taken")).alias("last"))
        ends = {tuple(r[n] for n in names): (r["last"]["draw"], bytes(r["last"]["key"]), r["last"]["rows"], r["last"]["taken"]) for r in last.collect()}
    # Ranges before the edge's are taken whole; where the edge takes no row of its own range, up to that range.
    at = {tuple(e[: len(names)]): e[len(names)] for e in edge}
    plan = [(*c, at.get(tuple(c[: len(names)])), *ends.get(tuple(c[: len(names)]), (None, None, None, None))) for c in cuts]
    kinds = f"{fields}, whole int, rest double, ranges int, edge int, last_draw string, last_key binary, last_rows long, last_taken long"
    here = docs.select(row.alias("row"), *leaf, counted.cast("long").alias("tokens"), row_key().alias("key"))
    here = here.join(F.broadcast(spark.createDataFrame(plan, kinds)), names).withColumn("draw", draw).withColumn("range", range_)
    end = (F.col("draw") == F.col("last_draw")) & (F.col("key") == F.col("last_key"))
    inside = (F.col("range") < F.col("edge")) | ((F.col("range") == F.col("edge")) & F.coalesce((F.col("draw") < F.col("last_draw")) | ((F.col("draw") == F.col("last_draw")) & (F.col("key") <= F.col("last_key"))), F.lit(False)))
    partly = F.coalesce(end & (F.col("last_taken") < F.col("last_rows")), F.lit(False))
    cut_here = F.coalesce(inside, F.lit(False)) & ~partly
    whole = F.when(F.col("whole") > 0, F.sequence(F.lit(0), F.col("whole") - 1)).otherwise(F.array().cast("array<int>"))
    epochs = F.concat(whole, F.when(cut_here, F.array("whole")).otherwise(F.array().cast("array<int>")))
    # The draw tells the place in the cut epoch; in a whole one every row has its place.
    info = F.struct(*at_leaf, "tokens", F.col("epoch"), F.when(F.col("epoch") == F.col("whole"), F.col("draw")).alias("draw")).alias("mix__")
    out = here.withColumn("epoch", F.explode(epochs)).select("row.*", info)
    if any(taken is not None and taken < rows for *_, rows, taken in ends.values()):
        nth = F.row_number().over(Window.partitionBy(*names).orderBy("draw"))
        some = here.where(partly).withColumn("nth", nth).where(F.col("nth") <= F.col("last_taken")).withColumn("epoch", F.col("whole"))
        out = out.unionByName(some.select("row.*", info))
    return out


#: The domain of a source, as the default tree has it.
DOMAINS = ("web", "reference", "books", "forum")


def default_levels() -> dict[str, Column]:
    """domain (dealt by the checksum of the source's name), lang and source."""
    names = F.array(*map(F.lit, DOMAINS))
    domain = F.when(F.col("source").isNull(), F.lit(NONE)).otherwise(F.element_at(names, (F.crc32(F.col("source")) % len(DOMAINS) + 1).cast("int")))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


#: Target weights: web text counts half of what the other domains do; English twice any other language; sources alike.
DEFAULT_WEIGHTS: dict[Path, float] = {("web",): 2.0, ("reference",): 4.0, ("books",): 3.0, ("forum",): 1.0, **{(d, "en"): 2.0 for d in DOMAINS}}
