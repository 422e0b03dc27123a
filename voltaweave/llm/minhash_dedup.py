"""Near-duplicate documents by b-bit MinHash.

Documents are sketched, banded, confirmed on full shingle sets and joined into
components by :mod:`neardup`, with forty bands of five minima, each read by one
band: two documents at the threshold miss all bands about twice in 100,000.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import neardup
from .common import fresh, keyed, row_digest, sized, written

PLAN = neardup.Plan()


def classify(docs: DataFrame, plan: neardup.Plan = PLAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: doc_id, n_shingles, component_id and kept.

    Rows are linked if 100 * intersection >= ``plan.percent`` * union of their
    shingle sets.  Null and empty texts and texts without words have an empty
    set and stay alone.  Rows that repeat an id are one document and share its
    component; equal texts are linked.  Rows with a null id take no part: their
    component is null and they are kept.  Ids are cast to long, so text ids
    must be numbers.  Texts of any length are read whole.  An empty table gives
    an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    made, roots = neardup.clusters(rows, plan)
    component = F.coalesce("root", "id")
    return (
        made.select("id", "n_shingles", "lo", "hi")
        .join(roots, ["id", "lo", "hi"], "left")
        .select(
            F.col("id").alias("doc_id"),
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        )
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, all columns as they were.

    Rows are told apart by id and text: of a component the row with the
    smallest id stays (null before all; of one id, the smallest digest of the
    text), and rows that repeat both stay or go together.  Null and empty texts
    and texts without words all stay.  An empty table gives an empty result.
    """
    rows = keyed(docs, id_col, text_col)
    odd = "doc_id" in rows.columns
    texts = rows.select(F.col("key").alias("id"), "text")
    _, roots = neardup.clusters(texts.dropDuplicates(["id"]) if odd else texts, PLAN)
    gone = written(roots.filter("id <> root").select("id").distinct(), "near-duplicates")
    gone_row = fresh(docs, "gone_row")
    if not odd:
        return docs.join(sized(gone).withColumnRenamed("id", gone_row), F.col(id_col).cast("long") == F.col(gone_row), "left_anti")
    lost = rows.join(gone, F.col("key") == F.col("id"), "left_semi").select(row_digest("doc_id", "text").alias(gone_row)).distinct()
    return docs.join(sized(written(lost, "near-duplicate-rows")), row_digest(id_col, text_col) == F.col(gone_row), "left_anti")
