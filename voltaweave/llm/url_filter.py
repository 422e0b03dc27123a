"""URL filtering by explicit rules and by association rules mined with FP-growth.

Explicit rules come first: a rule fits its host and all subdomains where the
url's path starts with the rule's path, and the longest that fits decides.

The urls that they decide serve as labels (others may be given): FP-growth
mines the combinations of tokens that occur together with a verdict, tokens
that the explicit rules name left out, since these are what the labels were
made from.  Association rules are pruned by confidence, by support, and where a
shorter rule says the same at least as surely.  They are kept in an inverted
index, each under its rarest token, and matched to urls by one equi-join on
tokens and a containment test.

DataFrame and Spark ML operations only.
"""

from __future__ import annotations

import math
import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import digest, forget, written

MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.9
#: Rows that a combination needs besides the support, so that small tables don't make rules of single urls.
MIN_ROWS = 5
DEFAULT = "allow"

#: The explicit rules (host and path, verdict).
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def explicit(rules: dict[str, str], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule = verdict = None
    for text in sorted(rules, key=lambda r: (-len(r), r)):
        at = text.find("/") if "/" in text else len(text)
        own, start = text[:at], text[at:]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, rules[text]) if verdict is None else verdict.when(fits, rules[text])
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: host labels, path segments (their numbers as 0), file ending, query and fragment parts."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^?#]*(.*)$", 1)
    parts = lambda text, gap, kind: F.transform(
        F.filter(F.split(text, gap), lambda x: x != ""), lambda x: F.concat(F.lit(kind), x)
    )
    numbers = F.regexp_replace(path, "[0-9]+", "0")
    return F.array_distinct(
        F.concat(parts(host, r"\.", "host:"), parts(numbers, "/", "path:"), parts(rest, "[?#&]", "query:"))
    )


def standing(labelled: DataFrame, least: int) -> DataFrame:
    """(token, members, n, sure): one token for all that stand in the same rows of (tid, tokens, label), of those in ``least`` rows or more.

    Tokens that always come together say the same in any rule, and a rule with
    two of them is never better than one with either.  ``sure`` is the label of a token
    all of whose rows have it: no longer rule with that token can be surer.
    """
    return (
        labelled.select("tid", "label", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("tid")).alias("one"), F.bit_xor(F.xxhash64("tid", F.lit(1))).alias("other"),
            F.nullif(F.min("label"), F.when(F.min("label") != F.max("label"), F.min("label"))).alias("sure"),
        )
        .filter(F.col("n") >= least)
        .groupBy("n", "one", "other", "sure")
        .agg(F.sort_array(F.collect_list("token")).alias("members"))
        .select(F.col("members")[0].alias("token"), "members", "n", "sure")
    )


def compact_rules(labelled: DataFrame, support: float, confidence: float) -> tuple[DataFrame, DataFrame] | None:
    """Pruned rules (antecedent, said, confidence, support, rarest) of standing tokens, and (item, token) of what these stand for.

    A combination needs the support and at least ``MIN_ROWS`` rows; with fewer rows in all there is nothing to mine.
    Tokens that are sure by themselves are rules and are not mined further: rows that
    share any number of them have no exponentially many frequent subsets to go through.
    """
    labelled = written(labelled.withColumn("tid", F.monotonically_increasing_id()), "labelled")
    n = labelled.count()
    least = max(MIN_ROWS, math.ceil(support * n))
    if n < least:
        forget(labelled)
        return None
    stand = written(standing(labelled, least), "standing-tokens")
    items = (
        labelled.select("tid", "label", F.explode_outer("tokens").alias("token"))
        .join(stand.filter("sure is null").select("token", F.col("token").alias("item")), "token", "left")
        .groupBy("tid", "label")
        .agg(F.collect_list("item").alias("items"))
        .select(F.concat("items", F.array(F.concat(F.lit("@"), F.col("label")))).alias("items"))
    )
    items = written(items, "transactions")
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=confidence).fit(items)
    rules = (
        model.associationRules.filter(F.element_at("consequent", 1).startswith("@") & ~F.exists("antecedent", lambda x: x.startswith("@")))
        .select(
            F.array_sort("antecedent").alias("antecedent"),
            F.expr("substring(consequent[0], 2)").alias("said"),
            "confidence",
            "support",
        )
    )
    single = model.freqItemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), F.col("freq"))
    posted = (
        rules.select("*", F.explode("antecedent").alias("token"))
        .join(single, "token")
        .groupBy("antecedent", "said", "confidence", "support")
        .agg(F.min(F.struct("freq", "token"))["token"].alias("rarest"))
    )
    sure = stand.filter("sure is not null").select(
        F.array("token").alias("antecedent"), F.col("sure").alias("said"), F.lit(1.0).alias("confidence"), (F.col("n") / n).alias("support"), F.col("token").alias("rarest")
    )
    posted = written(posted.unionByName(sure), "association-rules")
    forget(labelled, items)
    # a rule goes if a shorter one, found in the index under its rarest token, is at least as sure of the same
    shorter = posted.select(F.col("antecedent").alias("part"), F.col("said").alias("part_said"), F.col("confidence").alias("part_confidence"), F.col("rarest").alias("token"))
    covered = (
        posted.select("antecedent", "said", "confidence", F.explode("antecedent").alias("token"))
        .join(shorter, "token")
        .filter(
            (F.col("said") == F.col("part_said"))
            & (F.col("part_confidence") >= F.col("confidence"))
            & (F.size("part") < F.size("antecedent"))
            & (F.size(F.array_except("part", "antecedent")) == 0)
        )
        .select("antecedent", "said")
        .distinct()
    )
    rules = written(posted.join(covered, ["antecedent", "said"], "left_anti"), "pruned-rules")
    forget(posted)
    return rules, stand.select(F.col("token").alias("item"), F.explode("members").alias("token"))


def mined_rules(labelled: DataFrame, support: float, confidence: float) -> DataFrame | None:
    """(antecedent, said, confidence, support, rarest) from rows of (tokens, label), pruned; all tokens of a row count.

    A rule of :func:`compact_rules` holds for each choice of the tokens that its own
    ones stand for: this lists them all, a row each, for those who read rules.
    """
    found = compact_rules(labelled, support, confidence)
    if found is None:
        return None
    rules, stand = found
    every = rules.withColumn("tokens", F.array().cast("array<string>")).withColumn("left", F.col("antecedent"))
    longest = rules.agg(F.max(F.size("antecedent"))).first()[0] or 0
    for _ in range(longest):  # one token of each antecedent at a time
        done = every.filter(F.size("left") == 0)
        more = every.filter(F.size("left") > 0).withColumn("item", F.col("left")[0]).join(stand, "item")
        more = more.withColumn("rarest", F.when(F.col("rarest") == F.col("item"), F.col("token")).otherwise(F.col("rarest")))
        more = more.withColumn("tokens", F.concat("tokens", F.array("token"))).withColumn("left", F.expr("slice(left, 2, size(left))"))
        every = done.unionByName(more.select(done.columns))
    return written(every.select(F.array_sort("tokens").alias("antecedent"), "said", "confidence", "support", "rarest"), "listed-rules")


def judge(
    pages: DataFrame,
    rules: dict[str, str] | None = None,
    labels: DataFrame | None = None,
    support: float = MIN_SUPPORT,
    confidence: float = MIN_CONFIDENCE,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """For each row: page_id, host, path, rule, verdict, and why the method decided (mined).

    A null url, or one without ``://``, has an empty host and path and no
    tokens: no rule fits and the verdict is the default, allow.  Where no mined
    rule matches it is the default too; of several the surest decides, then the
    better supported, then the longer.  ``labels`` (page_id, label) replace the
    explicit rules' verdicts as what is mined.  Rows that repeat id and url get
    the same answer.  With nothing to mine from, only explicit rules and the
    default apply.  An empty table gives an empty result.
    """
    rules = RULES if rules is None else rules
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = explicit(rules, F.col("host"), F.col("path"))
    rows = rows.select("*", rule.alias("rule"), verdict.alias("decided"), tokens_of(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    named = sorted({f"host:{x}" for r in rules for x in r.split("/")[0].split(".")} | {f"path:{x}" for r in rules for x in r.split("/")[1:] if x})
    if labels is None:
        taught = rows.filter("rule is not null").select("tokens", F.col("decided").alias("label"))
    else:
        taught = rows.join(labels.select(F.col("page_id").alias("labelled_id"), "label"), F.col("page_id") == F.col("labelled_id")).filter("label is not null").select("tokens", "label")
    free = F.array_except("tokens", F.array(*map(F.lit, named)).cast("array<string>"))
    found = compact_rules(taught.select(free.alias("tokens"), "label"), support, confidence)
    key = digest("page_id", "url")
    if found is None:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("decided", F.lit(DEFAULT)).alias("verdict"), F.lit(None).cast("string").alias("mined"))
    found, stand = found
    # a url's tokens become the items that stand for them, and rules are matched on items
    held = rows.filter("rule is null").select(key.alias("row"), F.explode("tokens").alias("token")).distinct().join(stand, "token")
    held = held.groupBy("row", "item").agg(F.max("token").alias("token")).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("item", "token"))).alias("of"))
    own = F.array_join(F.array_sort(F.transform("antecedent", lambda x: F.element_at("of", x))), " ")
    matched = (
        held.select("row", "of", F.explode(F.map_keys("of")).alias("rarest"))
        .join(found, "rarest")
        .filter(F.forall("antecedent", lambda x: F.map_contains_key("of", x)))
        .groupBy("row")
        .agg(F.max(F.struct("confidence", "support", F.size("antecedent").alias("n"), own.alias("mined"), "said")).alias("best"))
        .select("row", "best.said", "best.mined")
    )
    return (
        rows.withColumn("key", key)
        .join(matched, F.col("key") == F.col("row"), "left")
        .select("page_id", "host", "path", "rule", F.coalesce("decided", "said", F.lit(DEFAULT)).alias("verdict"), F.when(F.col("rule").isNull(), F.col("mined")).alias("mined"))
    )
