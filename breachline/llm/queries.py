"""The operators of this package as queries over whole tables, and the SQL they must agree with."""

from __future__ import annotations

import importlib
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    embedding_dedup,
    filter_audit,
    html_extraction,
    language_id,
    line_dedup,
    merkle,
    mixing,
    quality,
    quality_rules,
    simhash,
    suffix_dedup,
    token_counts,
)

VOCABULARY = "piece_bpe_32k.model"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, and the smallest id in its group."""
    marked = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    smallest = marked.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    printed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return marked.join(smallest, "group").select("doc_id", printed, "component_id")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 400 bytes that occur elsewhere."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return suffix_dedup.remove_repeats(documents).select(
        "doc_id", size, "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embedding_dedup.near_embeddings(_table(spark, sf_dir, "embeddings"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the later copies of repeated line runs."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    n_lines = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0))
    rows = documents.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(n_lines))
    gone = F.aggregate("deleted_runs", F.lit(0), lambda n, r: n + r["e"] - r["s"])
    return line_dedup.dedup_lines(rows).select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        gone.cast("long").alias("n_deleted"),
        F.size("deleted_runs").cast("long").alias("n_runs"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    documents = _table(spark, sf_dir, "documents")
    out = language_id.held_out(F.col("doc_id"))
    return language_id.identify(
        documents.select("doc_id", "text"), documents.where(~out).select("lang", "text")
    ).select(
        "doc_id",
        out.alias("held_out"),
        "lang_pred",
        F.col("lang_margin").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a curriculum over all sources takes of every document, in training order."""
    plan = mixing.mix(_table(spark, sf_dir, "documents"))
    first = F.get("passes", F.lit(0))["position"].alias("first_position")
    rows = plan.select("doc_id", "size", "source_size", "target", "taken", first)
    return rows.orderBy("first_position", "doc_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    path = importlib.import_module("public_tokenizers").path(VOCABULARY)
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), path)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that leaks into a document, and by how many edits."""
    found = decontamination.find_leaks(
        _table(spark, sf_dir, "documents").select("doc_id", "text"),
        _table(spark, sf_dir, "benchmark"),
    )
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", "leak.item_id", "leak.edits"
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, and whether to keep it."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_documents(documents)
    return scored.select(
        "doc_id", "weak_label", "quality", (F.col("quality") >= 0.5).alias("keep")
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extraction.extract_pages(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of every source, in all orders."""
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by rules that vote, and whether to keep it."""
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return judged.select("doc_id", *base, "kept", F.round("quality", 6).alias("quality"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents, checked against rows of which some are tampered with."""
    capitals, small = string.ascii_uppercase, string.ascii_lowercase
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(hit, F.translate("text", capitals, small)).otherwise(F.col("text"))
    seen = merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    made = merkle.manifest(_table(spark, sf_dir, "documents"), carry={"seen": seen})
    again = made.withColumn("folded_root", merkle.folded(F.col("seen"), F.col("proof")))
    return again.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_language_id": op5_language_id,
    "op6_mixing": op6_mixing,
    "op7_token_counts": op7_token_counts,
    "op8_decontamination": op8_decontamination,
    "op9_quality": op9_quality,
    "op10_html_extraction": op10_html_extraction,
    "op11_filter_audit": op11_filter_audit,
    "op12_quality_rules": op12_quality_rules,
    "op13_merkle": op13_merkle,
}

ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": r"""
WITH RECURSIVE split AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents WHERE text IS NOT NULL
), ranked AS (
    SELECT doc_id, pos, line, md5(line) AS h,
           len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w
    FROM split
), win AS (  -- every start and length that occurs more than once, a line longer each time
    SELECT doc_id, pos AS s, 1 AS n, h AS key, w FROM ranked
    UNION ALL
    SELECT x.doc_id, s, n + 1, md5(key || h), x.w + r.w
    FROM (SELECT *, count(*) OVER (PARTITION BY key) AS c FROM win) x
        JOIN ranked r ON r.doc_id = x.doc_id AND r.pos = s + n
    WHERE c > 1
), later AS (
    SELECT doc_id, s, max(s + n) AS e
    FROM (SELECT *, row_number() OVER (PARTITION BY n, key ORDER BY doc_id, s) AS nth FROM win)
    WHERE nth > 1 AND w >= 8 GROUP BY doc_id, s
), marked AS (
    SELECT r.doc_id, pos, line, coalesce(max(e) OVER (PARTITION BY r.doc_id ORDER BY pos), 0) > pos AS gone
    FROM ranked r LEFT JOIN later l ON l.doc_id = r.doc_id AND l.s = r.pos
), edged AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS begins
    FROM marked
), kept AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted,
           count(*) FILTER (begins) AS n_runs,
           coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS rest
    FROM edged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
       coalesce(n_runs, 0) AS n_runs, sha256(rest) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
""",
    "op6_mixing": r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(md5(doc_id::VARCHAR), repeat('0', 32)) AS o,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, list_extract([3.0, 1.0, 2.0]::DOUBLE[], (n % 3 + 1)::INT) AS w, source_size * 2.0::DOUBLE AS cap,
           (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget
    FROM sources
), levelled AS (
    SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, n
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
              / sum(w) OVER (ORDER BY cap / w, n
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), targets AS (
    SELECT source, source_size, n,
           CASE WHEN cap <= level * w THEN cap
                ELSE (SELECT arg_min(level, cap / w) FROM levelled x WHERE x.cap > x.level * x.w) * w
           END AS target
    FROM levelled
), placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.n, t.target, floor(t.target + 0.5) AS goal,
           sum(s.size) OVER (PARTITION BY s.source ORDER BY s.o, s.doc_id NULLS FIRST, s.size
               ROWS UNBOUNDED PRECEDING) - s.size AS start
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), passes AS (
    SELECT *, greatest(0, least(size, goal - start)) AS w0,
           greatest(0, least(size, goal - source_size - start)) AS w1,
           list_extract([1.5, 0.5, 1.0]::DOUBLE[], (n % 3 + 1)::INT) AS s,
           list_extract([0.5, 1.5, 1.0]::DOUBLE[], (n % 3 + 1)::INT) AS e
    FROM placed
), shares AS (
    SELECT *, CASE WHEN w0 > 0 THEN (start::DOUBLE + w0::DOUBLE / 2.0::DOUBLE) / goal::DOUBLE
              END AS u
    FROM passes
)
SELECT doc_id, size, source_size, target, (w0 + w1)::BIGINT AS taken,
       2.0::DOUBLE * u / (s + sqrt(s * s + 2.0::DOUBLE * (e - s) * u)) AS first_position
FROM shares
""",
    "op11_filter_audit": r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), worded AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY text) AS least
    FROM texts
), known AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), marked AS (
    SELECT part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
           regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > least, false) AS e,
           coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM worded LEFT JOIN known USING (doc_id)
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, step::INTEGER AS step, filter_order[step] AS letter,
           filter_order[1:step - 1] AS before
    FROM orders, range(1, 6) t(step)
), masks AS (
    SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END,
                        CASE WHEN c THEN 'C' ELSE '' END, CASE WHEN d THEN 'D' ELSE '' END,
                        CASE WHEN e THEN 'E' ELSE '' END) AS mask,
           count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM marked GROUP BY ALL
), judged AS (
    SELECT *, contains(mask, letter) AS fails,
           len(list_intersect(string_split(mask, ''), string_split(before, ''))) > 0
               AND mask <> '' AND before <> '' AS gone
    FROM masks, steps
), counted AS (
    SELECT part, filter_order, step, letter,
           coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (mask = letter), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
    FROM judged GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
""",
    "op13_merkle": r"""
WITH RECURSIVE base AS (
    SELECT doc_id, source, sha256(concat(
               coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
               coalesce(strlen(source) || ':' || source, '-'),
               coalesce(strlen(lang) || ':' || lang, '-'),
               coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'))
               || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           sha256(concat(
               coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
               coalesce(strlen(source) || ':' || source, '-'),
               coalesce(strlen(lang) || ':' || lang, '-'),
               coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'))
               || coalesce(strlen(text) || ':' || translate(text,
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered
    FROM documents
), units AS (
    SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS unit
    FROM (SELECT DISTINCT source FROM documents)
), bits AS (  -- CRC-32, bit by bit: eight steps for every byte of the id
    SELECT DISTINCT doc_id, 4294967295::BIGINT AS crc, 0 AS step FROM documents WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT doc_id, CASE WHEN now % 2 = 1 THEN xor(now // 2, 3988292384) ELSE now // 2 END, step + 1
    FROM (SELECT doc_id, step, CASE WHEN step % 8 = 0
                     THEN xor(crc, ascii(substr(doc_id::VARCHAR, step // 8 + 1, 1))::BIGINT)
                     ELSE crc END AS now
          FROM bits WHERE step < 8 * strlen(doc_id::VARCHAR))
), tampered AS (
    SELECT doc_id FROM bits
    WHERE step = 8 * strlen(doc_id::VARCHAR) AND xor(crc, 4294967295::BIGINT) % 5 = 0
), leaves AS (
    SELECT b.doc_id, u.unit, b.leaf, CASE WHEN t.doc_id IS NULL THEN b.leaf ELSE b.lowered END AS seen,
           row_number() OVER (PARTITION BY u.unit ORDER BY b.doc_id NULLS FIRST, b.leaf) - 1 AS place,
           count(*) OVER (PARTITION BY u.unit) AS total
    FROM base b JOIN units u ON b.source IS NOT DISTINCT FROM u.source
        LEFT JOIN tampered t USING (doc_id)
), tree AS (
    SELECT unit, 0 AS lvl, place AS pos, leaf AS h, total AS n FROM leaves
    UNION ALL
    SELECT unit, lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
    FROM tree WHERE n > 1 GROUP BY unit, lvl, pos // 16
), tops AS (
    SELECT unit, lvl AS depth, h FROM tree WHERE n = 1
), upper AS (
    SELECT 0 AS lvl, unit AS pos, h, (SELECT count(*) FROM tops) AS n FROM tops
    UNION ALL
    SELECT lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
    FROM upper WHERE n > 1 GROUP BY lvl, pos // 16
), runs AS (
    SELECT unit, lvl, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM tree WHERE n > 1 GROUP BY ALL
    UNION ALL
    SELECT -1, lvl, pos // 16, list(h ORDER BY pos) FROM upper WHERE n > 1 GROUP BY ALL
), walk AS (
    SELECT doc_id, leaf, l.unit, unit AS tree_of, place AS pos, 0 AS lvl, seen AS now, '' AS proof, depth
    FROM leaves l JOIN tops t USING (unit)
    UNION ALL
    SELECT doc_id, leaf, w.unit,
           CASE WHEN w.lvl + 1 = depth AND tree_of >= 0 THEN -1 ELSE tree_of END,
           CASE WHEN w.lvl + 1 = depth AND tree_of >= 0 THEN w.unit ELSE pos // 16 END,
           CASE WHEN w.lvl + 1 = depth AND tree_of >= 0 THEN 0 ELSE w.lvl + 1 END,
           sha256(array_to_string(hs[1:pos % 16], '') || now || array_to_string(hs[pos % 16 + 2:], '')),
           proof || array_to_string(hs[1:pos % 16], '') || array_to_string(hs[pos % 16 + 2:], ''), depth
    FROM (SELECT * REPLACE (CASE WHEN depth = 0 AND tree_of >= 0 THEN -1 ELSE tree_of END AS tree_of,
                            CASE WHEN depth = 0 AND tree_of >= 0 THEN unit ELSE pos END AS pos) FROM walk) w
        JOIN runs r ON r.unit = w.tree_of AND r.lvl = w.lvl AND r.run = w.pos // 16
), ends AS (
    SELECT *, (SELECT h FROM upper WHERE n = 1) AS root, (SELECT max(lvl) FROM upper) AS height FROM walk
)
SELECT doc_id, leaf, t.h AS subroot, root, sha256(proof) AS proof_sha256, now AS folded_root,
       now = root AS verified
FROM ends e JOIN tops t USING (unit)
WHERE (tree_of = -1 AND lvl = height) OR (height = 0 AND e.depth = 0)
""",
}
