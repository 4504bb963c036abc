"""Joins by similarity: candidates share an n-gram, the score decides, the best one wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.similarity import ngrams


def best_matches(left: DataFrame, right: DataFrame, left_col: str, right_col: str, threshold: float = 0.5) -> DataFrame:
    """a, best and score (Jaccard of n-gram sets, rounded to six places): the best other text of each a; ties go to the lesser one.

    Two sets of a similarity of at least t share one of the n - ceil(t * n) + 1 rarest n-grams of each, so
    only those are joined: the commonest, on which most texts would meet, join nothing, and no pair is lost.
    """
    a = left.select(F.col(left_col).alias("a")).distinct().withColumn("g", ngrams(F.col("a")))
    b = right.select(F.col(right_col).alias("b")).distinct().withColumn("h", ngrams(F.col("b")))
    frequency = a.select(F.explode("g").alias("gram")).unionByName(b.select(F.explode("h").alias("gram"))).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))

    def rarest(texts: DataFrame, text: str, grams: str) -> DataFrame:
        each = texts.select(text, F.size(grams).alias("size"), F.explode(grams).alias("gram")).join(frequency, "gram")
        sets = each.groupBy(text).agg(F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("ordered"))
        # Scores are rounded before they meet the threshold, so half a unit of the last place is given.
        keep = F.col("size") - F.ceil((F.lit(threshold) - 5e-7) * F.col("size")).cast("int") + 1
        return sets.select(text, F.explode(F.slice(F.col("ordered"), F.lit(1), F.greatest(F.least(keep, F.col("size")), F.lit(0)))).alias("x")).select(text, F.col("x.gram").alias("gram"))

    met = rarest(a, "a", "g").join(rarest(b, "b", "h"), "gram").where("a <> b").select("a", "b").distinct()
    both = F.size(F.array_intersect("g", "h"))
    scored = met.join(a, "a").join(b, "b").select("a", "b", F.round(both / (F.size("g") + F.size("h") - both), 6).alias("score")).where(F.col("score") >= threshold)
    best = scored.groupBy("a").agg(F.min_by(F.struct("b", "score"), F.struct(-F.col("score"), F.col("b"))).alias("m"))
    return best.select("a", F.col("m.b").alias("best"), F.col("m.score").alias("score"))


def assign_ids(texts: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """text and id: that of an equal known text, else of the best similar one, else a new id (a hash of the text)."""
    exact = texts.join(known.select("text", F.col("id").alias("exact")).dropDuplicates(["text"]), "text", "left")
    best = best_matches(texts, known, "text", "text", threshold).select(F.col("a").alias("text"), F.col("best").alias("near"))
    near = best.join(known.select(F.col("text").alias("near"), F.col("id").alias("near_id")).dropDuplicates(["near"]), "near").select("text", "near_id")
    out = exact.join(near, "text", "left")
    return out.select("text", F.coalesce("exact", "near_id", F.substring(F.md5("text"), 1, 12)).alias("id"))
