"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A window (ten words of an item in a row) is a set of two-word shingles, and a
document contains it only if it holds every one of them.  So, with shingles
ordered from rare to common by their counts over all documents, one prefix
token is enough: the window's rarest shingle.  A first pass counts items'
shingles over all documents, a second one looks prefix tokens up; their places
give a window's start in the document, which must leave room for the whole
window (positional and length bounds); the words at that place are then
compared with the window's, so that what is reported is exact.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, row_digest, sized, written

#: Between words: all of ASCII but digits and letters.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Up to so many shingles of items (16 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_SHINGLES = 1_000_000


def words_of(text: Column) -> Column:
    """The words of a text in order, with A-Z lower-cased and nothing else changed.

    ``lower`` would change letters beyond ASCII too, so texts that have any are
    lower-cased word by word, by ``translate`` where a word has such letters.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.split(F.lower(text), GAP)
    ascii_only = lambda x: F.octet_length(x) == F.char_length(x)
    other = F.transform(
        F.split(text, GAP),
        lambda w: F.when(ascii_only(w), F.lower(w)).otherwise(
            F.translate(w, string.ascii_uppercase, string.ascii_lowercase)
        ),
    )
    return F.when(ascii_only(text), plain).otherwise(other)


def trimmed(words: Column) -> Column:
    """Without the empty strings that a leading or closing gap leaves."""
    return F.filter(words, lambda w: w != "")


def count_words(words: Column) -> Column:
    """The number of words in the result of :func:`words_of`."""
    edge = lambda i: F.when(F.element_at(words, i) == "", 1).otherwise(0)
    n = F.size(words)
    return F.when(n == 1, 1 - edge(1)).otherwise(n - edge(1) - edge(-1)).cast("long")


def shingles_of(words: Column) -> Column:
    """A hash for each word and its successor; the last word's has none."""
    return F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.xxhash64(a, b))


def item_windows(benchmark: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(words, items): the distinct windows, each with the sorted ids of the items that have it."""
    words = benchmark.select(F.col(id_col).cast("string").alias("item_id"), trimmed(words_of(F.col(text_col))).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - width + 1, F.lit(1)))
    return (
        words.filter(F.size("words") > 0)
        .select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("words", F.col("start"), width).alias("words"))
        .groupBy("words")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )


def covered(spans: Column) -> Column:
    """How many positions the sorted (start, length) spans cover together."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("end"))

    def add(acc, s):
        stop = s["start"].cast("long") + s["length"]
        begin = F.greatest(acc["end"], s["start"].cast("long"))
        return F.struct((acc["n"] + F.greatest(stop - begin, F.lit(0))).alias("n"), F.greatest(acc["end"], stop).alias("end"))

    return F.aggregate(spans, zero, add)["n"]


def classify(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """For each row: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated.

    Items of fewer than ``width`` words, but not none, are one window; items
    without words match nothing.  Null and empty texts have no words.  Rows
    that repeat both id and text get the same answer; null ids are answered as
    any other.  An item id that is null is not listed.  Empty tables give an
    empty result or no hits.
    """
    return classified(docs, benchmark, width, id_col, text_col, item_id_col, item_text_col).drop("row")


def placed_shingles(rows: DataFrame, singles: bool) -> DataFrame:
    """(row, pos, shingle) for all words of (row, words); ``singles``: also for words alone."""
    found = rows.select("row", F.posexplode(shingles_of(F.col("words"))).alias("pos", "shingle"))
    if singles:
        alone = F.transform("words", lambda w: F.xxhash64(w, F.lit("alone")))
        found = found.unionByName(rows.select("row", F.posexplode(alone).alias("pos", "shingle")))
    return found


def classified(docs: DataFrame, benchmark: DataFrame, width: int, id_col: str, text_col: str, item_id_col: str, item_text_col: str) -> DataFrame:
    """The result of :func:`classify` with each row's digest, row."""
    windows = written(item_windows(benchmark, width, item_id_col, item_text_col).withColumn("window", F.monotonically_increasing_id()), "windows")
    # a window's shingles and where in it they stand; one of a single word has that word's
    alone = F.array(F.xxhash64(F.element_at("words", 1), F.lit("alone")))
    own = F.when(F.size("words") == 1, alone).otherwise(F.slice(shingles_of(F.col("words")), 1, F.greatest(F.size("words") - 1, F.lit(1))))
    tokens = windows.select("window", F.posexplode(own).alias("at", "shingle"))
    wanted = written(tokens.select("shingle").distinct(), "item-shingles")
    singles = not windows.filter(F.size("words") == 1).isEmpty()
    row = row_digest(id_col, text_col)
    words = docs.select(row.alias("row"), words_of(F.col(text_col)).alias("words"))
    found = placed_shingles(words, singles)

    # first only counts, of items' shingles over all documents
    every = found.select("shingle")
    if wanted.count() <= BROADCAST_SHINGLES:
        rarity = every.join(F.broadcast(wanted), "shingle").groupBy("shingle").agg(F.count(F.lit(1)).alias("df"))
    else:
        rarity = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).join(wanted, "shingle")
    rarity = written(rarity, "rarity")
    # a window that has a shingle which no document has occurs nowhere
    prefix = (
        tokens.join(rarity, "shingle", "left")
        .groupBy("window")
        .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "shingle", "at")).alias("rarest"))
        .filter("rarest.df > 0")
        .select("window", "rarest.shingle", "rarest.at")
    )
    prefix = written(prefix.join(windows.select("window", F.size("words").alias("length")), "window"), "prefix-tokens")
    # then places, of prefix tokens alone
    sought = F.broadcast(prefix) if prefix.count() <= BROADCAST_SHINGLES else prefix
    asked = found.join(sought, "shingle").select("row", (F.col("pos") - F.col("at")).alias("start"), "length", "window").filter("start >= 0")
    asked = written(asked.distinct(), "candidates")

    # only the texts that have a candidate travel
    ids = written(asked.select("row").distinct(), "candidate-rows")
    texts = docs.select(row.alias("row"), F.col(text_col).alias("text"))
    texts = texts.join(sized(ids), "row", "left_semi").dropDuplicates(["row"])
    candidates = asked.groupBy("row").agg(F.collect_list(F.struct("start", "length", "window")).alias("asked"))
    there = lambda c: F.struct(c["start"].alias("start"), c["length"].alias("length"), c["window"].alias("window"), F.slice(F.col("words"), c["start"] + 1, c["length"]).alias("said"))
    inside = lambda c: c["start"] + c["length"] <= F.size("words")
    hits = (
        texts.join(candidates, "row")
        .select("row", words_of(F.col("text")).alias("words"), "asked")
        .select("row", F.explode(F.transform(F.filter("asked", inside), there)).alias("c"))
        .select("row", "c.*")
        .join(windows.select("window", F.col("words").alias("window_words"), "items"), "window")
        .filter(F.col("said") == F.col("window_words"))
        .select("row", "start", "length", "items")
    )
    hits = written(hits, "hits")
    items = hits.select("row", F.explode("items").alias("item")).groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    spans = hits.groupBy("row").agg(covered(F.sort_array(F.collect_set(F.struct("start", "length")))).alias("hit"))
    told = written(spans.join(items, "row", "left").withColumnRenamed("row", "hit_row"), "told")
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    names = F.coalesce("items", F.array().cast("array<string>"))
    return (
        docs.select(F.col(id_col).alias("doc_id"), row.alias("row"), count_words(words_of(F.col(text_col))).alias("n_words"))
        .join(told, F.col("row") == F.col("hit_row"), "left")
        .select(
            "doc_id",
            "row",
            "n_words",
            n_hit.alias("n_hit"),
            F.size(names).cast("long").alias("n_items"),
            F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold any window of an item, all columns as they were."""
    bad_row = fresh(docs, "bad_row")
    found = classified(docs, benchmark, 10, id_col, text_col, "item_id", "text").filter("contaminated")
    bad = written(found.select(F.col("row").alias(bad_row)).distinct(), "contaminated")
    return docs.join(sized(bad), row_digest(id_col, text_col) == F.col(bad_row), "left_anti")
