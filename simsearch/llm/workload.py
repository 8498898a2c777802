"""One query per operator over its whole table, and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simsearch.llm import collocations, decontamination, exact_dedup, fingerprints, hard_negatives
from simsearch.llm import html_text, jaccard_join, language_id, line_dedup, lm_scoring, mixing
from simsearch.llm import substring_dedup, token_counts

Query = Callable[[SparkSession, str], DataFrame]

LINE_THRESHOLD = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark, sf_dir):
    return token_counts.length_histogram(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark, sf_dir):
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"), remainder(10) == 0)


def op3_substring_dedup(spark, sf_dir):
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_html_text(spark, sf_dir):
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op5_decontamination(spark, sf_dir):
    hits = decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return hits.select("doc_id", "item_id", "score", "question_overlap", "answer_overlap")


def op6_jaccard_join(spark, sf_dir):
    found = jaccard_join.similar_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def remainder(modulus: int):
    """crc32 of doc_id as text, to divide documents into folds; a null id goes to fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % modulus


def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder(3) == 1)
    profiles = language_id.learn_profiles(docs.where("not held_out"))
    return language_id.predict_language(docs, profiles, ["doc_id", "held_out"])


def op8_source_mix(spark, sf_dir):
    sized, taken = mixing.mix(table(spark, sf_dir, "documents"))
    draws = taken.groupBy(*mixing.ROW).agg(F.count("*").alias("draws"))
    return (
        sized.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .join(draws, mixing.ROW, "left")
        .select("doc_id", "source", "size", "source_size", "target",
                (F.coalesce("draws", F.lit(0)) * F.col("size")).alias("taken"))
    )


def op9_exact_dedup(spark, sf_dir):
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_line_dedup(spark, sf_dir):
    kept = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"), LINE_THRESHOLD)
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op11_fingerprints(spark, sf_dir):
    found = fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next",
    )


def op12_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_html_text": op4_html_text,
    "op5_decontamination": op5_decontamination,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_language_id": op7_language_id,
    "op8_source_mix": op8_source_mix,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_fingerprints": op11_fingerprints,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_collocations": op13_collocations,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES: dict[str, str] = {
    "op3_substring_dedup": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ),
        windows AS (
            SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS k
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)
        ),
        repeated AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
        covered AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows JOIN repeated USING (k)
        ),
        words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
        kept AS (
            SELECT a.doc_id, count(c.p) AS n_removed,
                   string_agg(a.word, ' ' ORDER BY a.p) FILTER (WHERE c.p IS NULL) AS kept
            FROM words a LEFT JOIN covered c ON c.doc_id = a.doc_id AND c.p = a.p
            GROUP BY a.doc_id
        )
        SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN kept k ON k.doc_id = w.doc_id
    """,
    "op6_jaccard_join": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                              '[^\x20\x09-\x0D]+') AS ws
            FROM documents
        ),
        grams AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 4)
            UNION ALL
            SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 3
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
            FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
        ),
        links AS (
            SELECT x, y FROM common JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
            WHERE 100 * k >= 85 * (sx.n + sy.n - k)
        ),
        sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reached(doc_id, r) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT a.doc_id, s.y FROM reached a JOIN sides s ON s.x = a.r
        )
        SELECT a.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id
        FROM reached a LEFT JOIN sizes s ON s.doc_id = a.doc_id GROUP BY a.doc_id
    """,
    "op9_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER best AS keep_id,
               CAST(count(*) OVER (PARTITION BY text_sha256) AS BIGINT) AS group_size,
               row_number() OVER best = 1 AS kept,
               text_sha256
        FROM texts
        WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
    """,
    "op10_line_dedup": rf"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS position
            FROM documents
        ),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ),
        common AS (
            SELECT key FROM keyed WHERE key <> ''
            GROUP BY key HAVING count(DISTINCT doc_id) >= {LINE_THRESHOLD}
        )
        SELECT k.doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
               sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.position)
                               FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
        FROM keyed k LEFT JOIN common c ON c.key = k.key
        GROUP BY k.doc_id
    """,
    "op12_hard_negatives": """
        WITH rows AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        pairs AS (
            SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
                   CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
            FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
        ),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE label = own
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER best AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN pairs USING (anchor_id)
        WHERE label <> own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER best <= 3
    """,
    "op13_collocations": rf"""
        WITH pieces AS MATERIALIZED (
            SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
            FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                                         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
        ),
        grams AS MATERIALIZED (
            SELECT lang, k, g, count(*) AS f
            FROM (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS g
                  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
                        FROM (SELECT lang, ws, unnest([1, 2, 3]) AS k FROM pieces) WHERE len(ws) >= k))
            GROUP BY ALL
        ),
        totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang),
        candidates AS MATERIALIZED (
            SELECT lang, g, f AS a, string_split(g, ' ') AS ws FROM grams WHERE k > 1 AND f >= 10
        ),
        cuts AS MATERIALIZED (
            SELECT lang, g, a, len(ws) AS size, k, array_to_string(ws[1:k], ' ') AS head,
                   array_to_string(ws[k + 1:], ' ') AS tail
            FROM (SELECT *, unnest(range(1, len(ws))) AS k FROM candidates)
        ),
        scored AS (
            SELECT c.lang, c.g, a, size, l.f AS l, r.f AS r,
                   CAST((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
            FROM cuts c JOIN grams l ON l.lang = c.lang AND l.g = head
            JOIN grams r ON r.lang = c.lang AND r.g = tail
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.g
                                       ORDER BY (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f), c.k) = 1
        ),
        held AS (
            SELECT DISTINCT c.lang, c.g FROM candidates c
            JOIN (SELECT lang, a, unnest([head, tail]) AS g FROM cuts WHERE size = 3) t
              ON t.lang = c.lang AND t.g = c.g
            WHERE 100 * t.a >= 50 * c.a
        )
        SELECT c.lang, row_number() OVER best AS rank, c.g AS phrase, a, l, r, n, score
        FROM scored c JOIN totals t ON t.lang = c.lang LEFT JOIN held h ON h.lang = c.lang AND h.g = c.g
        WHERE h.g IS NULL
        WINDOW best AS (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.g)
        QUALIFY row_number() OVER best <= 2000
    """,
}
