"""Relational post-processing of statements: joins, closures, set operations, statistics."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.model import OWL, RDFS, STATEMENT_KEY

#: Fixed value: the note that a rewritten object leaves in its context.
MAPPED_FROM = "&objectMappedFrom="
#: Side tables of at most so many rows are broadcast; beyond that Catalyst picks a shuffled join.
BROADCAST_ROWS = 200_000
#: Tasks of a step that parses: by core, and at least (executors may join late) unless the session's shuffles have fewer.
TASKS_PER_CORE, LEAST_TASKS = 3, 48
#: Pages whose parts a Python worker holds at once.
PYTHON_ROWS = 256


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if a look at its first rows shows that it is small; else it is shuffled, whatever its files' size says of it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df.hint("merge")


def spread(df: DataFrame, key: str = "page_id") -> DataFrame:
    """df dealt over tasks by its key: what is parsed takes far longer than to be read, so the tasks that files give are too few."""
    spark = df.sparkSession
    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, min(LEAST_TASKS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return df.repartition(tasks, key) if key in df.columns else df.repartition(tasks)


def cut(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the cluster's shared checkpoint folder, which bounds the lineage of iterations."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="pagequarry-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/pagequarry/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --- rewriting resources ----------------------------------------------------------------------


def map_objects(statements: DataFrame, mapping: DataFrame) -> DataFrame:
    """Objects replaced by every target that mapping (src, dst) has; literals and unmapped ones pass."""
    m = mapping.select(F.col("src").alias("map_src"), F.col("dst").alias("map_dst"))
    hit = (F.col("value") == F.col("map_src")) & F.col("datatype").isNull()
    out = statements.join(m, hit, "left")
    noted = F.concat(F.coalesce("context", F.lit("")), F.lit(MAPPED_FROM), F.col("value"))
    out = out.withColumn("context", F.when(F.col("map_dst").isNotNull(), noted).otherwise(F.col("context")))
    return out.withColumn("value", F.coalesce("map_dst", "value")).drop("map_src", "map_dst")


def map_subjects(statements: DataFrame, mapping: DataFrame) -> DataFrame:
    """Subjects replaced by every target; unmapped ones pass."""
    m = mapping.select(F.col("src").alias("map_src"), F.col("dst").alias("map_dst"))
    out = statements.join(m, F.col("subject") == F.col("map_src"), "left")
    return out.withColumn("subject", F.coalesce("map_dst", "subject")).drop("map_src", "map_dst")


def canonicalize(statements: DataFrame, mapping: DataFrame, prefix: str, new_prefix: str) -> DataFrame:
    """Subjects and objects under prefix rewritten by the mapping, dropped where it has none; predicates change prefix; the rest passes."""
    m = mapping.dropDuplicates(["src", "dst"])
    inside = lambda c: F.col(c).startswith(prefix)
    s = m.select(F.col("src").alias("s_src"), F.col("dst").alias("s_dst"))
    o = m.select(F.col("src").alias("o_src"), F.col("dst").alias("o_dst"))
    resource = F.col("datatype").isNull() & inside("value")
    out = statements.join(s, F.col("subject") == F.col("s_src"), "left").where(~inside("subject") | F.col("s_dst").isNotNull())
    out = out.join(o, F.when(resource, F.col("value")) == F.col("o_src"), "left").where(~resource | F.col("o_dst").isNotNull())
    renamed = F.when(inside("predicate"), F.concat(F.lit(new_prefix), F.expr(f"substring(predicate, {len(prefix) + 1})"))).otherwise(F.col("predicate"))
    out = out.withColumn("subject", F.coalesce("s_dst", "subject")).withColumn("value", F.coalesce("o_dst", "value")).withColumn("predicate", renamed)
    return out.drop("s_src", "s_dst", "o_src", "o_dst")


# --- links ---------------------------------------------------------------------------------------


def reciprocal(links: DataFrame) -> DataFrame:
    """links (src, dst) with both_ways: whether the reverse link exists. Repeated links count once."""
    own = links.select("src", "dst").distinct()
    back = own.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(True).alias("found"))
    return own.join(back, ["src", "dst"], "left").select("src", "dst", F.coalesce("found", F.lit(False)).alias("both_ways"))


def interlanguage(links: DataFrame) -> DataFrame:
    """src, predicate, dst: links that go both ways say the same, the others see also."""
    return reciprocal(links).select("src", F.when(F.col("both_ways"), OWL + "sameAs").otherwise(RDFS + "seeAlso").alias("predicate"), "dst")


def both_ways(links: DataFrame) -> DataFrame:
    own = links.select("src", "dst").distinct()
    return own.join(own.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"], "left_semi")


def one_way(links: DataFrame) -> DataFrame:
    own = links.select("src", "dst").distinct()
    return own.join(own.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"], "left_anti")


def pairs_in_group(members: DataFrame, group: str, kind: str, name: str) -> DataFrame:
    """Ordered pairs of a group's members of different kinds (an item's titles in its languages; groups are as small as there are kinds)."""
    a = members.select(F.col(group), F.col(kind).alias("kind_a"), F.col(name).alias("name_a"))
    b = members.select(F.col(group), F.col(kind).alias("kind_b"), F.col(name).alias("name_b"))
    return a.join(b, group).where("kind_a <> kind_b")


def double_links(sitelinks: DataFrame) -> DataFrame:
    """item and site with more than one title: errors in the source."""
    return sitelinks.groupBy("item", "site").agg(F.count_distinct("title").alias("titles")).where("titles > 1")


# --- closures ------------------------------------------------------------------------------------


def redirect_closure(edges: DataFrame) -> DataFrame:
    """src and its final dst. A source has one edge (the least target); members of a cycle and what leads into one are dropped.

    Pointers double in each round, so chains of length n take log2(n) rounds, each cut to a table.
    """
    step = edges.where("src is not null and dst is not null").groupBy("src").agg(F.min("dst").alias("dst"))
    current = cut(step, "closure")
    nodes, steps = current.count(), 1
    while steps <= nodes:
        ahead = current.select(F.col("src").alias("dst"), F.col("dst").alias("further"))
        current = cut(current.join(ahead, "dst", "left").select("src", F.coalesce("further", "dst").alias("dst")), "closure")
        steps *= 2
        if current.join(step.select(F.col("src").alias("dst")), "dst", "left_semi").isEmpty():
            break
    # Whoever still points at a source after that many steps is on a cycle or leads into one.
    return current.join(step.select(F.col("src").alias("dst")), "dst", "left_anti").select("src", "dst")


def class_closure(edges: DataFrame) -> DataFrame:
    """class, ancestor and the least depth, itself at 0, over edges (class, base), however deep; cycles are fine.

    Known paths are joined end to end, so their length doubles in each round until no pair is new.
    """
    up = edges.where("class <> base").select("class", F.col("base").alias("ancestor"), F.lit(1).alias("depth")).distinct()
    classes = edges.select("class").union(edges.select(F.col("base").alias("class"))).distinct()
    known = cut(classes.select("class", F.col("class").alias("ancestor"), F.lit(0).alias("depth")).union(up), "classes")
    pairs = known.count()
    while True:
        further = known.select(F.col("class").alias("ancestor"), F.col("ancestor").alias("top"), F.col("depth").alias("more"))
        joined = known.join(further, "ancestor").groupBy("class", F.col("top").alias("ancestor")).agg(F.min(F.col("depth") + F.col("more")).alias("depth"))
        known, before = cut(joined, "classes"), pairs
        pairs = known.count()
        if pairs == before:
            return known


def fill_from_parents(known: DataFrame, edges: DataFrame) -> DataFrame:
    """node, label, depth: a node without a label gets that of the nearest labelled ancestor (the least label of several), however deep."""
    done, depth = cut(known.select("node", "label", F.lit(0).alias("depth")), "fill"), 0
    front = done
    while True:
        depth += 1
        reach = edges.select(F.col("child").alias("node"), F.col("parent")).join(front.select(F.col("node").alias("parent"), "label"), "parent")
        front = cut(reach.join(done, "node", "left_anti").groupBy("node").agg(F.min("label").alias("label")).withColumn("depth", F.lit(depth)), "fill")
        if front.isEmpty():
            return done
        done = cut(done.union(front), "fill")


# --- statistics --------------------------------------------------------------------------------


def count_values(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def statement_statistics(statements: DataFrame, by: str = "language") -> DataFrame:
    """Distinct subjects, predicates and objects, and statements, for each language and in all (null).

    Each column's distinct values are counted once for the languages, and those once more for all of them.
    """
    columns = {"subjects": F.col("subject"), "predicates": F.col("predicate"), "objects": F.when(F.col("datatype").isNull(), F.col("value"))}
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.md5(c.cast("string")).alias("value")) for k, c in columns.items()])
    each = statements.select(F.col(by).alias("by"), F.explode(kinds).alias("k")).where("k.value is not null").select("by", "k.kind", "k.value").distinct()
    per = each.groupBy("by").pivot("kind", list(columns)).count()
    every = each.select("kind", "value").distinct().groupBy(F.lit(None).cast(statements.schema[by].dataType).alias("by")).pivot("kind", list(columns)).count()
    rows = statements.groupBy(F.col(by).alias("by")).agg(F.count(F.lit(1)).alias("statements"))
    rows = rows.withColumn("total", F.lit(False)).unionByName(rows.agg(F.sum("statements").alias("statements")).select(F.lit(None).cast(statements.schema[by].dataType).alias("by"), "statements").withColumn("total", F.lit(True)))
    counts = per.withColumn("total", F.lit(False)).unionByName(every.withColumn("total", F.lit(True)))
    out = rows.join(counts, rows["by"].eqNullSafe(counts["by"]) & (rows["total"] == counts["total"]), "left")
    return out.select(rows["by"].alias(by), *[F.coalesce(c, F.lit(0)).alias(c) for c in columns], "statements")


def merged_statistics(documents: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Rows of several statistics documents (language, keys, sums) as one table: a row for each language and key, and one for all languages (language null)."""
    per = documents.groupBy("language", *keys).agg(*[F.sum(c).alias(c) for c in sums])
    return per.unionByName(per.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]).withColumn("language", F.lit(None).cast("string")))


def by_size(counts: DataFrame, language: str = "language", n: str = "n") -> DataFrame:
    """Languages in the order of their pages, the most first, ties by code; place: from 1. A row for each language."""
    return counts.withColumn("place", F.row_number().over(Window.orderBy(F.col(n).desc(), language)))


def usage_counts(uses: DataFrame, redirects: DataFrame) -> DataFrame:
    """template and n: uses (template) counted under what redirects (src, dst) finally lead to."""
    final = uses.join(redirects.select(F.col("src").alias("template"), "dst"), "template", "left")
    return final.groupBy(F.coalesce("dst", "template").alias("template")).agg(F.count(F.lit(1)).alias("n"))


def frequent(counts: DataFrame, group: str, n: str, factor: int = 10) -> DataFrame:
    """group, uses and most of the groups whose largest count (n) times a factor exceeds their sum."""
    return counts.groupBy(group).agg(F.sum(n).alias("uses"), F.max(n).alias("most")).where(F.col("most") * factor > F.col("uses"))


def with_lookup(rows: DataFrame, table: DataFrame, key: str, value: str, rest: str) -> DataFrame:
    """rows with the value that a side table has for a key, else `rest`; the table is broadcast if it is small."""
    return rows.join(small(table.select(key, value)), key, "left").withColumn(value, F.coalesce(value, F.lit(rest)))


def members_of(rows: DataFrame, keys: DataFrame, key: str, inside: bool = True) -> DataFrame:
    """Rows whose key is, or isn't, among keys."""
    return rows.join(keys.select(key), key, "left_semi" if inside else "left_anti")


def concatenated(rows: DataFrame, group: str, value: str, separator: str = ", ") -> DataFrame:
    """group and its distinct values in order, as one text."""
    return rows.groupBy(group).agg(F.array_join(F.array_sort(F.collect_set(value)), separator).alias("values"))


def coverage(usage: DataFrame, mapped: DataFrame, name: str, uses: str) -> DataFrame:
    """How much of the names, and of their uses, is mapped."""
    seen = usage.join(mapped.select(name).distinct().withColumn("is_mapped", F.lit(True)), name, "left")
    on = F.coalesce("is_mapped", F.lit(False))
    out = seen.agg(
        F.count(F.lit(1)).alias("names"), F.sum(on.cast("long")).alias("mapped_names"),
        F.sum(uses).alias("uses"), F.sum(F.when(on, F.col(uses)).otherwise(0)).alias("mapped_uses"),
    )
    return out.withColumn("name_share", F.round(F.col("mapped_names") / F.col("names"), 6)).withColumn("use_share", F.round(F.col("mapped_uses") / F.col("uses"), 6))


def drift(now: DataFrame, before: DataFrame, key: str, n: str, least: float) -> DataFrame:
    """Signed relative change of counts between two releases, where it is at least `least` either way."""
    both = now.select(key, F.col(n).alias("now")).join(before.select(key, F.col(n).alias("before")), key, "full_outer")
    both = both.select(key, F.coalesce("now", F.lit(0)).alias("now"), F.coalesce("before", F.lit(0)).alias("before"))
    change = F.when(F.col("before") == 0, F.lit(1.0)).otherwise((F.col("now") - F.col("before")) / F.col("before"))
    return both.withColumn("change", F.round(change, 6)).where(F.abs("change") >= least)


def set_difference(before: DataFrame, after: DataFrame, key: list[str] | None = None) -> DataFrame:
    """All statements of either with op: added, deleted or unmodified, by their key."""
    key = key or STATEMENT_KEY
    a = before.select(*key).distinct().withColumn("was", F.lit(True))
    b = after.select(*key).distinct().withColumn("is", F.lit(True))
    same = [a[c].eqNullSafe(b[c]) for c in key]
    out = a.join(b, same, "full_outer")
    op = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "deleted").otherwise("unmodified")
    return out.select(*[F.coalesce(a[c], b[c]).alias(c) for c in key], op.alias("op"))


def line_citations(facts: DataFrame, citations: DataFrame, most: int = 4) -> DataFrame:
    """Facts (page, line, fact) with the citations (page, line, cite) of their line, where a line has at most so many facts."""
    crowd = F.count(F.lit(1)).over(Window.partitionBy("page", "line"))
    return facts.withColumn("on_line", crowd).where(F.col("on_line") <= most).drop("on_line").join(citations, ["page", "line"])


def last_before(rows: DataFrame, marks: str, group: str, order: list[str]) -> Column:
    """As-of: the last mark at or before each row in its group."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(marks, ignorenulls=True).over(w)


def overlapping(a: DataFrame, b: DataFrame, group: str, width: int = 1000) -> DataFrame:
    """Pairs of spans [begin, end) of a group that overlap: a join on the buckets that a span touches, then the exact test."""
    def bucketed(df: DataFrame, p: str) -> DataFrame:
        named = df.select(F.col(group), F.col("id").alias(f"{p}_id"), F.col("begin").alias(f"{p}_begin"), F.col("end").alias(f"{p}_end"))
        return named.withColumn("bucket", F.explode(F.sequence(F.floor(F.col(f"{p}_begin") / width), F.floor((F.greatest(F.col(f"{p}_end"), F.col(f"{p}_begin") + 1) - 1) / width))))

    met = bucketed(a, "a").join(bucketed(b, "b"), [group, "bucket"]).where("a_begin < b_end and b_begin < a_end")
    return met.drop("bucket").distinct()


# --- statistical typing -----------------------------------------------------------------------------


def type_scores(facts: DataFrame, types: DataFrame) -> DataFrame:
    """resource, type and score of untyped and typed resources alike.

    facts (resource, predicate), types (resource, type). A predicate's weight is the sum over types of
    the squared difference of P(type) and P(type | predicate); a resource's score for a type is the
    weighted mean of P(type | predicate) over its predicates.
    """
    uses = cut(facts.groupBy("resource", "predicate").agg(F.count(F.lit(1)).alias("tf")), "uses")
    typed = types.distinct()
    total = typed.select("resource").distinct().agg(F.count(F.lit(1)).alias("total"))
    prior = typed.groupBy("type").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(total)).select("type", (F.col("n") / F.col("total")).alias("p"))
    on_typed = uses.join(typed.select("resource").distinct(), "resource", "left_semi")
    of_predicate = on_typed.groupBy("predicate").agg(F.sum("tf").alias("all"))
    given = uses.join(typed, "resource").groupBy("predicate", "type").agg(F.sum("tf").alias("n")).join(of_predicate, "predicate").select("predicate", "type", (F.col("n") / F.col("all")).alias("p_given"))
    # Types that a predicate never meets add their squared prior.
    whole = prior.agg(F.sum(F.col("p") * F.col("p")).alias("squares"))
    met = given.join(small(prior), "type").groupBy("predicate").agg(F.sum(F.pow(F.col("p") - F.col("p_given"), 2) - F.pow("p", F.lit(2))).alias("shift"))
    weight = met.join(F.broadcast(whole)).select("predicate", (F.col("squares") + F.col("shift")).alias("weight"))
    scored = uses.join(weight, "predicate").join(given, "predicate")
    of_resource = uses.join(weight, "predicate").groupBy("resource").agg(F.sum(F.col("tf") * F.col("weight")).alias("mass"))
    out = scored.groupBy("resource", "type").agg(F.sum(F.col("tf") * F.col("weight") * F.col("p_given")).alias("raw")).join(of_resource, "resource")
    return out.select("resource", "type", F.when(F.col("mass") > 0, F.col("raw") / F.col("mass")).otherwise(0.0).alias("score"))


def best_types(scores: DataFrame, threshold: float = 0.01, first: bool = True) -> DataFrame:
    """Types above the threshold, the best one only if `first`; ties go to the lesser name."""
    rank = F.row_number().over(Window.partitionBy("resource").orderBy(F.col("score").desc(), "type"))
    out = scores.where(F.col("score") >= threshold).withColumn("rank", rank)
    return out.where("rank = 1") if first else out


# --- consistency of types --------------------------------------------------------------------


def disjoint_closure(closure: DataFrame, disjoint: DataFrame) -> DataFrame:
    """Pairs of classes of which any ancestors are declared disjoint, in both directions."""
    both = disjoint.select("a", "b").union(disjoint.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    left = closure.select(F.col("class").alias("c1"), F.col("ancestor").alias("a"))
    right = closure.select(F.col("class").alias("c2"), F.col("ancestor").alias("b"))
    return left.join(both, "a").join(right, "b").select("c1", "c2").distinct()


def type_consistency(statements: DataFrame, types: DataFrame, properties: DataFrame, closure: DataFrame, disjoint: DataFrame) -> DataFrame:
    """statements (subject, predicate, value) with domain_ok and range_ok.

    types (resource, class: one each), properties (predicate, domain, range). Untyped resources,
    undeclared properties and undeclared sides are fine; so is all that isn't declared disjoint.
    """
    bad = disjoint_closure(closure, disjoint)
    t_s = types.select(F.col("resource").alias("subject"), F.col("class").alias("s_class"))
    t_o = types.select(F.col("resource").alias("value"), F.col("class").alias("o_class"))
    out = statements.join(small(properties), "predicate", "left").join(t_s, "subject", "left").join(t_o, "value", "left")
    d = bad.select(F.col("c1").alias("s_class"), F.col("c2").alias("domain"), F.lit(False).alias("d_ok"))
    r = bad.select(F.col("c1").alias("o_class"), F.col("c2").alias("range"), F.lit(False).alias("r_ok"))
    out = out.join(small(d), ["s_class", "domain"], "left").join(small(r), ["o_class", "range"], "left")
    return out.select("subject", "predicate", "value", F.coalesce("d_ok", F.lit(True)).alias("domain_ok"), F.coalesce("r_ok", F.lit(True)).alias("range_ok"))
