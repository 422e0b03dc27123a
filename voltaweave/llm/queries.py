"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    archive, chat, decontam, exact_dedup, minhash_dedup, negatives, packing, quality, repair, substring_dedup, suffix_dedup, toxicity, url_filter,
)
from .common import ship

END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; learnt from labelled rows that are not held out. Null, empty, repeated and long texts: see :func:`toxicity.score`."""
    held_out = lambda doc_id: F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page; null urls and those without ``://`` have neither host nor path and get the default."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log weight, key and whether it is drawn. Null and empty texts weigh 0; see :func:`quality.resample`."""
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces; a null or empty text is the one piece of the closing id."""
    return packed(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that lie in a window of an item; null and empty texts have none."""
    return decontam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts; null counts as empty, and empty texts equal each other."""
    return exact_dedup.classify(table(spark, sf_dir, "documents"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near-duplicates; texts without words stay alone."""
    return minhash_dedup.classify(table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and one of control strings, formatted and read back; null texts and roles are empty."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    odd = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.format_paths(chat.linear(rows.unionByName(odd)), unique=True))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document an earlier one has: passages of over 50 words. Null texts are empty; shorter texts lose nothing."""
    return substring_dedup.repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.aggregate(F.zip_with("starts", "ends", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y).alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        "keep_ids",
        F.char_length("kept_text").cast("long").alias("kept_chars"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 100-byte strings that start earlier; null texts are empty, shorter ones lose nothing."""
    return suffix_dedup.digests(suffix_dedup.repeats(table(spark, sf_dir, "documents")))


def op11_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as ARC, converted to WARC and read back; null payloads are empty, and empty ones equal each other."""
    return archive.convert(table(spark, sf_dir, "pages")).drop("record_id")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after faults dealt out by a hash: its gaps and faults, and the cheapest repair. Null roles and texts are one space."""
    rows = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(rows))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive; rows without a label or a whole finite vector take no part."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_url_filter,
        op3_quality,
        op4_packing,
        op5_decontamination,
        op6_exact_dedup,
        op7_minhash_dedup,
        op8_chat,
        op9_substring_dedup,
        op10_suffix_dedup,
        op11_arc_to_warc,
        op12_conversation_repair,
        op13_hard_negatives,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ESCAPED = "text"
for _control, _escape in chat.ESCAPES:
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', '{_escape}')"

ORACLE_SQL = {
    "op5_decontamination": f"""
        WITH item AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
        win AS (SELECT item_id, ws[i : i + 9] AS w FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM item WHERE len(ws) > 0)),
        doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
        place AS (SELECT doc_id, n, i, ws[i : i + n - 1] AS w FROM (
            SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM doc, (SELECT DISTINCT len(w) AS n FROM win))),
        hit AS (SELECT DISTINCT doc_id, n, i, item_id FROM place JOIN win USING (w)),
        word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
    """,
    "op7_minhash_dedup": f"""
        WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        shingle AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s FROM (
            SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM doc WHERE len(ws) > 0)),
        size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
        met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        link AS (SELECT a, b FROM met JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) LEFT JOIN size USING (doc_id)
    """,
    "op8_chat": f"""
        WITH row AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
            SELECT conv_id, turn, role, text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length({_ESCAPED}) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
                        ELSE 18 + length({_ESCAPED.replace('text', 'role')}) END) AS BIGINT) AS formatted_chars
        FROM row GROUP BY 1
    """,
    "op11_arc_to_warc": """
        WITH page AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        hex AS (SELECT *, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM page)
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST(((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM hex
    """,
    "op12_conversation_repair": r"""
        WITH RECURSIVE raw AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, crc AS fault FROM (
                SELECT *, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(0, length(k)), lambda i: CAST(ascii(substr(k, i + 1, 1)) AS BIGINT))),
                                  lambda c, b: list_reduce(list_concat([xor(c, b)], range(0, 8)), lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)),
                              4294967295) % 20 AS crc
                FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations))),
        hit AS (SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
                       CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
                FROM raw, range(0, CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
        row AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i, rtrim(text, E' \t\n\x0b\x0c\r') AS t FROM hit),
        told AS (SELECT *, CASE WHEN t = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                                WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS f, left(role, 1) AS r FROM row),
        pair AS (SELECT *, lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS p FROM told),
        step AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS i, {'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])} AS n,
                   {'c': 99999999, 'a': '', 't': CAST([] AS VARCHAR[])} AS s, {'c': 99999999, 'a': '', 't': CAST([] AS VARCHAR[])} AS u,
                   {'c': 99999999, 'a': '', 't': CAST([] AS VARCHAR[])} AS a
            FROM (SELECT DISTINCT conv_id FROM conversations)
            UNION ALL
            SELECT conv_id, i, {'c': n.c + 2, 'a': n.a || 'D', 't': n.t},
                   list_sort([{'c': s.c + 2, 'a': s.a || 'D', 't': s.t}, {'c': CASE WHEN live AND r = 's' THEN n.c + cut ELSE 99999999 END, 'a': n.a || 'K', 't': list_append(n.t, line)}])[1],
                   list_sort([{'c': u2.c + 2, 'a': u2.a || 'D', 't': u2.t},
                              {'c': CASE WHEN live AND r = 'u' THEN before.c + cut ELSE 99999999 END, 'a': before.a || 'K', 't': list_append(before.t, line)},
                              {'c': CASE WHEN live THEN before.c + cut + 1 ELSE 99999999 END, 'a': before.a || 'R', 't': list_append(before.t, 'user:' || text)}])[1],
                   list_sort([{'c': a2.c + 2, 'a': a2.a || 'D', 't': a2.t},
                              {'c': CASE WHEN live AND r = 'a' THEN u2.c + cut ELSE 99999999 END, 'a': u2.a || 'K', 't': list_append(u2.t, line)},
                              {'c': CASE WHEN live THEN u2.c + cut + 1 ELSE 99999999 END, 'a': u2.a || 'R', 't': list_append(u2.t, 'assistant:' || text)}])[1]
            FROM (SELECT *, list_sort([a, {'c': u2.c + 5, 'a': u2.a || 'I', 't': list_append(u2.t, 'assistant:')}])[1] AS a2
                  FROM (SELECT *, list_sort([u, {'c': before.c + 5, 'a': before.a || 'I', 't': list_append(before.t, 'user:')}])[1] AS u2
                        FROM (SELECT step.conv_id, told.i, n, s, u, a, list_sort([n, s, a])[1] AS before, r, f NOT IN ('b', 'd') AS live,
                                     CASE f WHEN 't' THEN 5 ELSE 0 END AS cut, role || ':' || text AS line, text
                              FROM step JOIN told ON step.conv_id IS NOT DISTINCT FROM told.conv_id AND told.i = step.i + 1)))),
        last AS (SELECT conv_id, arg_max(n, i) AS n, arg_max(s, i) AS s, arg_max(u, i) AS u, arg_max(a, i) AS a FROM step GROUP BY 1),
        done AS (SELECT conv_id, list_sort([n, a, {'c': u.c + 5, 'a': u.a || 'I', 't': list_append(u.t, 'assistant:')},
                                            {'c': s.c + 10, 'a': s.a || 'II', 't': list_append(list_append(s.t, 'user:'), 'assistant:')}])[1] AS best FROM last),
        stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE f = 'b') AS blank,
                         count(*) FILTER (WHERE f = 'd') AS duplicate, count(*) FILTER (WHERE f = 't') AS truncated,
                         count(*) FILTER (WHERE p NOT IN ('su', 'ua', 'au')) AS illegal FROM pair GROUP BY 1)
        SELECT done.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
        FROM done LEFT JOIN stats ON done.conv_id IS NOT DISTINCT FROM stats.conv_id
    """,
    "op13_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        met AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
                FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        pos AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM met WHERE same
                QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        neg AS (SELECT pos.*, met.id AS negative_id, met.score AS negative_score,
                       CAST(row_number() OVER (PARTITION BY pos.anchor_id, positive_id ORDER BY met.score DESC, met.id) AS INTEGER) AS rank
                FROM pos JOIN met ON met.anchor_id = pos.anchor_id AND NOT met.same AND 30 * positive_score <= 100 * met.score AND 100 * met.score <= 90 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 10
    """,
}
