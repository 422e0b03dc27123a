"""Operators on keyed rows: de-duplication, collisions, filling upserts and cascades of matches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from . import similar


_FLAT = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")


def _packed(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool) -> DataFrame:
    """One row for each key by an aggregate, which combines before the shuffle.

    Where all columns have a fixed width and whole numbers order them, columns are
    picked one by one: a task then holds one row for each key and sorts none.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    kinds = dict(df.dtypes)
    if len(order) == 1 and df.select(*order).dtypes[0][1] in ("tinyint", "smallint", "int") and all(kinds[c] in _FLAT for c in rest):
        at = F.coalesce(order[0].cast("long"), F.lit(-(2**63)))  # nulls come first, as in a struct
        return df.groupBy(*keys).agg(*(pick(c, at).alias(c) for c in rest)).select(*df.columns)
    return df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def last_wins(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """Of rows with one key, the one that comes last in ``order``, which must be total."""
    return _packed(df, keys, order, last=True)


def first_wins(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """Of rows with one key, the one that comes first in ``order``, which must be total."""
    return _packed(df, keys, order, last=False)


def rename_collisions(left: DataFrame, right: DataFrame, key: str, suffix: str, also: Sequence[str] = ()) -> DataFrame:
    """All rows of ``left``, and of ``right`` with ``suffix`` on keys (and ``also``) that ``left`` has.

    A renamed row replaces a row of ``left`` or ``right`` that has its new key.
    """
    taken = left.select(F.col(key).alias("_taken")).distinct()
    met = right.join(taken, F.col(key) == F.col("_taken"), "left")
    hit = F.col("_taken").isNotNull()
    renamed = met.withColumns({c: F.when(hit, F.concat(F.col(c), F.lit(suffix))).otherwise(F.col(c)) for c in [key, *also]})
    ranked = left.withColumn("_rank", F.lit(0)).unionByName(
        renamed.withColumn("_rank", F.when(hit, 2).otherwise(1)).drop("_taken")
    )
    return last_wins(ranked, [key], F.col("_rank")).drop("_rank")


def masked_fill_upsert(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str], masks: Mapping[int, Sequence[str]], source: str, *order: Column
) -> DataFrame:
    """Merge records of one key: the first in (source, order) is the base, later ones fill its nulls.

    A later record of source s fills only the fields in ``masks[s]``; the base
    keeps all its fields, whatever its source's mask.
    """
    rank = F.struct(F.col(source), *order)
    base = F.min_by(F.struct(*fields), rank)

    def fill(f: str) -> Column:
        allowed = [s for s, names in masks.items() if f in names]
        usable = F.col(f).isNotNull() & F.col(source).isin(*allowed) if allowed else F.lit(False)
        return F.min_by(F.when(usable, F.col(f)), F.when(usable, rank))

    merged = df.groupBy(*keys).agg(base.alias("_base"), F.min(rank).alias("_first"), *(fill(f).alias(f"_fill_{f}") for f in fields))
    return merged.select(*keys, *(F.coalesce(F.col("_base")[f], F.col(f"_fill_{f}")).alias(f) for f in fields), F.col("_first")[source].alias(source))


def priority_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str, candidates: Sequence[tuple[Column, bool]], normal, order: str | None = None) -> DataFrame:
    """Join each row of ``left`` to the row of ``right`` that its best candidate key finds.

    ``candidates`` are columns of ``left`` with whether they are tried in the
    form that ``normal`` gives, best first; null candidates are skipped.
    ``right_key`` is unique; where several of its keys have one normal form,
    the first by ``order`` (a column of ``right``) stands for them, or the least
    key if none is given.  All candidates are matched by one equi-join.
    """
    rest = [c for c in right.columns if c != right_key]
    first = F.struct(*([order] if order else []), right_key)
    exact = right.select(F.lit(False).alias("_loose"), F.col(right_key).alias("_match"), F.struct(right_key, *rest).alias("_found"), first.alias("_first"))
    loose = right.select(F.lit(True).alias("_loose"), normal(F.col(right_key)).alias("_match"), F.struct(right_key, *rest).alias("_found"), first.alias("_first"))
    loose = loose.groupBy("_loose", "_match").agg(F.min_by("_found", "_first").alias("_found"), F.min("_first").alias("_first"))
    tries = F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(is_loose).alias("loose"), (normal(c) if is_loose else c).alias("match")) for i, (c, is_loose) in enumerate(candidates)))
    tried = left.select(left_key, F.explode(tries).alias("t")).select(left_key, F.col("t.rank").alias("_rank"), F.col("t.loose").alias("_loose"), F.col("t.match").alias("_match"))
    best = (
        tried.join(exact.unionByName(loose), ["_loose", "_match"])
        .groupBy(left_key)
        .agg(F.min(F.struct("_rank", "_found")).alias("_best"))
        .select(F.col(left_key).alias("_left"), F.col("_best._rank").alias("match_rank"), *(F.col("_best._found")[c].alias(c) for c in [right_key, *rest]))
    )
    return left.join(best, F.col(left_key) == F.col("_left"), "left").drop("_left")


def fuzzy_candidates(left: DataFrame, right: DataFrame, left_key: str, right_key: str, most: int = 2, best: int = 3) -> DataFrame:
    """(left_key, right_key, distance, rank) of the ``best`` nearest names of ``right`` for each name of ``left``, by what is left of both without articles, accents and tension.

    All names at an edit distance of at most ``most`` are candidates (see
    ``operators.similar``); the nearest comes first, then the nearest tension, then
    the least name.  A repeated name counts once; null names are empty ones.
    """

    def named(df: DataFrame, key: str, p: str) -> DataFrame:
        articles = r"^(?:(?:LA|EL|LAS|LOS|SET|SE|ST|SUBESTACION) )+"
        once = df.select(F.col(key).alias(f"{p}_key")).distinct()
        # step by step: a column that the next step names several times is computed once
        one = once.withColumn("_name", text.stripped(F.regexp_replace(text.accents_folded(text.normal_key(F.col(f"{p}_key"))), r"[.,'_-]+", " ")))
        two = one.withColumn("_base", F.regexp_replace(text.without_tension(F.col("_name")), articles, ""))
        three = two.withColumn("_base", F.regexp_replace("_base", r"\s*KV$", "")).withColumn("_name", F.regexp_replace("_name", r"\s*KV$", ""))
        return three.select(f"{p}_key", text.without_tension(F.col("_base")).alias(f"{p}_base"), text.tension_of_end(F.col("_name")).alias(f"{p}_kv"))

    a, b = named(left, left_key, "_l"), named(right, right_key, "_r")
    # distinct forms are compared, however many rows have them
    forms = similar.within_distance(a, b, "_l_base", "_r_base", most)
    off = F.coalesce(F.abs(F.col("_l_kv") - F.col("_r_kv")), F.lit(2**30))
    met = a.join(forms, "_l_base").join(b, "_r_base").select("_l_key", "distance", off.alias("off"), "_r_key")
    ranked = top_per_group(met, ["_l_key"], best, F.col("distance"), F.col("off"), F.col("_r_key"))
    return ranked.select(F.col("_l_key").alias(left_key), F.col("_r_key").alias(right_key), "distance", "rank")


def fuzzy_link(left: DataFrame, right: DataFrame, left_key: str, right_key: str, most: int = 2) -> DataFrame:
    """Rows of ``left`` with the first of :func:`fuzzy_candidates` and its ``distance``; null if there is none."""
    best = fuzzy_candidates(left, right, left_key, right_key, most, best=1).select(F.col(left_key).alias("_l_key"), right_key, "distance")
    return left.join(best, F.col(left_key) == F.col("_l_key"), "left").drop("_l_key")


def top_per_group(df: DataFrame, keys: Sequence[str], n: int, *order: Column, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group in ``order``, which must be total, numbered from 1."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= n)
