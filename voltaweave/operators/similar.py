"""Names within an edit distance of each other, all of them, by an inverted index of q-grams.

An edit touches at most q of a name's q-grams, so two names within k edits have
all but k * q of the longer one's in common; and if the q-grams of both are put in
one order, the first k * q + 1 of each have one in common.  Only these are joined,
rarest first, so that what many names share is looked up by few, and only with
names whose length differs by at most k.  Names so short that nothing need be
shared (up to k * q - q + 1 letters) meet by what is left of them after deletions,
of which they have few.  Every pair found is measured, so no link is lost and none
is wrong.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _grams(name: Column, q: int) -> Column:
    """A name's q-grams, padded at both ends, each with how many equal ones come before it."""
    padded = F.concat(F.lit("\x01" * (q - 1)), name, F.lit("\x02" * (q - 1)))
    starts = F.sequence(F.lit(1), F.char_length(name) + q - 1)
    inorder = F.array_sort(F.transform(starts, lambda i: F.substring(padded, i, F.lit(q))))
    return F.transform(inorder, lambda g, i: F.struct(g.alias("gram"), (i - F.array_position(inorder, g)).cast("int").alias("nth")))


def _first(names: DataFrame, name: str, counts: DataFrame, k: int, q: int) -> DataFrame:
    """(name, size, gram, nth) of the first k * q + 1 grams of each name, rarest first."""
    each = names.select(name, F.explode(_grams(F.col(name), q)).alias("g")).select(name, "g.gram", "g.nth").join(counts, ["gram", "nth"], "left")
    ranked = each.groupBy(name).agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "nth"))).alias("all"))
    few = ranked.select(name, F.char_length(name).alias("size"), F.explode(F.slice("all", 1, k * q + 1)).alias("g"))
    return few.select(name, "size", "g.gram", "g.nth")


def _shortened(names: DataFrame, name: str, k: int, longest: int) -> DataFrame:
    """(name, rest) of names of up to ``longest`` letters: each after up to k deletions."""
    # by an explosion, not a filter: one that moves below the expressions of the names would repeat them
    out = level = names.select(name, F.explode(F.when(F.char_length(name) <= longest, F.array(name))).alias("rest"))
    for _ in range(k):
        places = F.sequence(F.lit(1), F.char_length("rest"))
        shorter = F.transform(places, lambda i: F.concat(F.substring(F.col("rest"), F.lit(1), i - 1), F.substring(F.col("rest"), i + 1, F.lit(longest))))
        level = level.filter("rest <> ''").select(name, F.explode(shorter).alias("rest")).distinct()
        out = out.unionByName(level)
    return out.distinct()


def within_distance(left: DataFrame, right: DataFrame, left_name: str, right_name: str, k: int = 2, q: int = 2) -> DataFrame:
    """(left_name, right_name, distance) of all pairs of distinct names at an edit distance of at most ``k``; null names have none.

    A gram that very many names have is still one key; it is met with each length by
    itself, and the sides are plain shuffled tables, which AQE splits.
    """
    a, b = left.select(F.col(left_name).alias("a")).distinct(), right.select(F.col(right_name).alias("b")).distinct()
    counts = b.select(F.explode(_grams(F.col("b"), q)).alias("g")).groupBy("g.gram", "g.nth").agg(F.count(F.lit(1)).alias("n"))
    asked = _first(a, "a", counts, k, q).withColumn("size", F.explode(F.sequence(F.col("size") - k, F.col("size") + k)))
    met = asked.join(_first(b, "b", counts, k, q), ["gram", "nth", "size"]).select("a", "b")
    longest = k * q - q + 1
    if longest > 0:
        met = met.unionByName(_shortened(a, "a", k, longest).join(_shortened(b, "b", k, longest), "rest").select("a", "b"))
    pairs = met.distinct().withColumn("distance", F.levenshtein("a", "b", k))
    return pairs.filter("distance >= 0").select(F.col("a").alias(left_name), F.col("b").alias(right_name), "distance")
