"""The same queries as SQL, written from the definitions of the operators."""

from __future__ import annotations

from simsearch.functions.stopwords import stopwords
from simsearch.functions.text import LANGUAGES
from simsearch.operators import lsh
from simsearch.workload.queries import (
    CORPORA,
    CORPUS,
    DIGITS,
    FRAME,
    HOP,
    K,
    LIKE_TEXT,
    NBITS,
    RADIUS,
    SPAN,
)

# Words of parts whose stem differs, worked out by hand from the published rules:
# a final e goes after a long syllable, y after a consonant turns to i.
PART_STEMS = {"large": "larg", "economy": "economi"}

CLEAN = "regexp_replace(lower(text), '[^a-zA-Z0-9_À-ÿ]', ' ', 'g')"
LANGUAGE = (
    "CASE lang "
    + " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in LANGUAGES.items())
    + " ELSE 'english' END"
)


def _quoted(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def _r(expression: str, digits: int = DIGITS) -> str:
    return f"round({expression}, {digits}) + 0.0"


def _stop() -> str:
    rows = ", ".join(
        f"('{name}', {_quoted(w)})" for name in LANGUAGES.values() for w in stopwords(name)
    )
    return f"stop(lang, word) AS (VALUES {rows})"


def _postings(docs: str = "documents") -> str:
    """CTEs from documents to postings and terms, without stemming."""
    return f"""{_stop()},
    docs AS (SELECT doc_id, {LANGUAGE} AS lang, {CLEAN} AS clean FROM {docs}),
    raw AS (SELECT doc_id, lang, unnest(string_split_regex(clean, ' +')) AS token FROM docs),
    kept AS (
        SELECT r.doc_id, r.lang, r.token AS term FROM raw r
        LEFT JOIN stop s ON s.lang = r.lang AND s.word = r.token
        WHERE r.token <> '' AND s.word IS NULL
    ),
    postings AS (SELECT term, doc_id, count(*) AS tf FROM kept GROUP BY ALL),
    terms AS (
        SELECT term, count(*) AS df, sum(log10(1 + tf) ^ 2) AS tf_square FROM postings GROUP BY ALL
    ),
    n AS (SELECT count(*) AS n FROM {docs})"""


def _query_terms(source: str = "SELECT item_id AS qid, text FROM benchmark", lang="english"):
    return f"""qtext AS ({source}),
    qraw AS (SELECT qid, unnest(string_split_regex(lower(text), '\\s+')) AS term FROM qtext),
    q AS (
        SELECT qid, term, count(*) AS tf FROM qraw
        WHERE term <> '' AND term NOT IN (SELECT word FROM stop WHERE lang = '{lang}')
        GROUP BY ALL
    )"""


_SCORES = """w AS (
        SELECT q.qid, q.term, log10(1.0 * n.n / t.df) AS idf,
               log10(1 + q.tf) * log10(1.0 * n.n / t.df) AS wq
        FROM q JOIN terms t USING (term) CROSS JOIN n
    ),
    matched AS (
        SELECT w.qid, p.doc_id, w.term, w.wq, log10(1 + p.tf) * w.idf AS wd
        FROM w JOIN postings p USING (term)
    ),
    per_query AS (SELECT qid, sqrt(sum(wq * wq)) AS norm_query FROM w GROUP BY qid),
    per_all AS (SELECT qid, sqrt(sum(wd * wd)) AS norm_global FROM matched GROUP BY qid),
    per_doc AS (
        SELECT qid, doc_id, sum(wq * wd ORDER BY term) AS dot, sqrt(sum(wd * wd)) AS norm_doc
        FROM matched GROUP BY qid, doc_id
    ),
    scores AS (
        SELECT qid, doc_id, dot,
               CASE WHEN norm_query = 0 OR norm_global = 0 OR norm_doc = 0 THEN 0.0
                    ELSE dot / (norm_query * norm_global) END AS similarity
        FROM per_doc JOIN per_query USING (qid) JOIN per_all USING (qid)
    ),
    ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY qid ORDER BY round(similarity, 12) DESC, doc_id) AS rank
        FROM scores
    )"""

_PAIRS = """v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    pairs AS (
        SELECT a.vec_id AS qid, b.vec_id, list_distance(a.e, b.e) AS distance
        FROM v a CROSS JOIN v b
    )"""
_FLAT = """flat AS (
        SELECT vec_id, label, unnest(range(len(embedding))) AS coef,
               unnest(embedding)::DOUBLE AS value FROM embeddings
    )"""
_CENTRE = f"""{_FLAT},
    pooled AS (SELECT coef, avg(value) AS value FROM flat GROUP BY coef),
    centre AS (SELECT list(value ORDER BY coef) AS q FROM pooled),
    d AS (
        SELECT vec_id, list_distance(embedding::DOUBLE[], q) AS distance
        FROM embeddings CROSS JOIN centre
    )"""


def _bits() -> str:
    """Sign bits of every vector against the planes, given as values."""
    planes = lsh.hyperplanes(NBITS, 64)
    rows = ", ".join(f"({i}, {row.tolist()})" for i, row in enumerate(planes))
    return f"""planes(bit, p) AS (VALUES {rows}),
    bits AS (
        SELECT vec_id, bit,
               CASE WHEN list_dot_product(embedding::DOUBLE[], p::DOUBLE[]) >= 0
                    THEN 1 ELSE 0 END AS b
        FROM embeddings CROSS JOIN planes
    ),
    signs AS (SELECT vec_id, list(b ORDER BY bit) AS s FROM bits GROUP BY vec_id),
    text_signs AS (SELECT vec_id, array_to_string(s, '')::BIT AS s FROM signs),
    hamming AS (
        SELECT a.vec_id AS qid, b.vec_id, bit_count(xor(a.s, b.s))::BIGINT AS hamming
        FROM text_signs a CROSS JOIN text_signs b
    ),
    closest AS (
        SELECT * FROM hamming
        QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hamming, vec_id) <= {K}
    )"""


_SIGNALS = """means AS (SELECT user_id, avg(value) AS mean FROM events GROUP BY user_id),
    signals AS (
        SELECT e.user_id AS signal_id, e.value - m.mean AS value,
               row_number() OVER (PARTITION BY e.user_id ORDER BY ts, event_id) - 1 AS pos
        FROM events e JOIN means m USING (user_id)
    )"""


def _searched(head: str, select: str) -> str:
    return f"WITH {head}, {_query_terms()}, {_SCORES} {select}"


def _corpora() -> str:
    parts = []
    for n in CORPORA:
        docs = f"(SELECT * FROM documents ORDER BY doc_id LIMIT {n})"
        inner = _searched(
            _postings(docs),
            f"SELECT qid, rank, doc_id, {_r('similarity')} AS similarity, "
            f"{n}::BIGINT AS corpus_n FROM ranked WHERE rank <= {K}",
        )
        parts.append(f"SELECT * FROM ({inner})")
    return " UNION ALL ".join(parts)


def oracles() -> dict[str, str]:
    postings = _postings()
    lists = f"""WITH {postings},
    blocks AS (SELECT *, floor(doc_id / {SPAN})::BIGINT AS block FROM postings)"""
    top = f"qid, rank, doc_id, {_r('similarity')} AS similarity FROM ranked WHERE rank <= {K}"
    by_distance = "PARTITION BY qid ORDER BY distance, vec_id"
    nearest = f"""near AS (
        SELECT qid, row_number() OVER ({by_distance}) AS rank, vec_id, distance FROM pairs
        QUALIFY rank <= {K}
    )"""
    knn = f"""WITH {_PAIRS}, {nearest}
    SELECT qid, rank, vec_id, {_r('distance')} AS distance FROM near"""
    lsh_knn = f"""WITH {_bits()}, {_PAIRS}
    SELECT c.qid, row_number() OVER (PARTITION BY c.qid ORDER BY p.distance, c.vec_id) AS rank,
           c.vec_id, c.hamming, {_r('p.distance')} AS distance
    FROM closest c JOIN pairs p ON p.qid = c.qid AND p.vec_id = c.vec_id"""
    matched = f"""{_stop()},
    raw AS (SELECT doc_id, unnest(string_split_regex({CLEAN}, ' +')) AS term FROM documents),
    kept AS (
        SELECT DISTINCT doc_id, term FROM raw
        WHERE term <> '' AND term NOT IN (SELECT word FROM stop WHERE lang = 'english')
    ),
    q AS (
        SELECT DISTINCT item_id AS qid, unnest(string_split_regex({CLEAN}, ' +')) AS term
        FROM benchmark
    ),
    found AS (SELECT DISTINCT q.qid, k.doc_id FROM q JOIN kept k USING (term))"""
    percentiles = ", ".join(f"({p}.0::DOUBLE)" for p in (10, 30, 50, 70, 90))
    found = {
        "src_documents": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "src_tracks": "SELECT * FROM part",
        "corpus_slice": (
            f"SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT {CORPUS}"
        ),
        "read_vectors": f"WITH {_FLAT} SELECT vec_id, label, coef, value FROM flat",
        "write_vectors": f"WITH {_FLAT} SELECT vec_id, label, coef, value FROM flat",
        "index_roundtrip": (
            f"WITH {postings} SELECT term, df, doc_id, tf, n AS n_docs "
            "FROM postings JOIN terms USING (term) CROSS JOIN n"
        ),
        "postings_text": f"""{lists}
            SELECT term, block, term || ' (DF: ' || df || '): ' || string_agg(
                '(' || doc_id || ', ' || tf || ')', ', ' ORDER BY doc_id) AS line
            FROM blocks JOIN terms USING (term) GROUP BY term, block, df""",
        "postings_parse": (
            f"WITH {postings} SELECT term, df, doc_id, tf FROM postings JOIN terms USING (term)"
        ),
        "text_concat": "SELECT p_partkey, p_name || ' ' || p_brand || ' ' || p_type AS text FROM part",
        "text_clean": f"SELECT doc_id, {CLEAN} AS clean FROM documents",
        "lang_resolve": f"SELECT doc_id, {LANGUAGE} AS language FROM documents",
        "tokens": f"""WITH raw AS (
                SELECT doc_id, unnest(string_split_regex({CLEAN}, ' +')) AS token FROM documents)
            SELECT doc_id, count(*) AS tokens, count(DISTINCT token) AS words
            FROM raw WHERE token <> '' GROUP BY doc_id""",
        "tokens_nostop": (
            f"WITH {postings} SELECT lang, term AS token, count(*) AS n FROM kept GROUP BY ALL"
        ),
        "analyze_docs": (
            f"WITH {postings} SELECT doc_id, term, count(*) AS n FROM kept GROUP BY ALL"
        ),
        "query_terms": f"WITH {_stop()}, {_query_terms()} SELECT qid, term, tf FROM q",
        "term_freq": f"WITH {postings} SELECT term, doc_id, tf FROM postings",
        "doc_freq": f"WITH {postings} SELECT term, df FROM terms",
        "posting_lists": f"""{lists}
            SELECT term, block, row_number() OVER (
                PARTITION BY term, block ORDER BY doc_id) - 1 AS pos, doc_id, tf FROM blocks""",
        "index_sorted": f"WITH {postings} SELECT term, doc_id, tf FROM postings ORDER BY 1, 2",
        "index_merge": f"WITH {postings} SELECT term, df, n AS n_docs FROM terms CROSS JOIN n",
        "index_build": (
            f"WITH {postings} SELECT term, df, {_r('tf_square')} AS tf_square, n AS n_docs "
            "FROM terms CROSS JOIN n"
        ),
        "term_lookup": (
            f"WITH {postings}, {_query_terms()} SELECT term, df, doc_id, tf "
            "FROM postings JOIN terms USING (term) WHERE term IN (SELECT term FROM q)"
        ),
        "idf": (
            f"WITH {postings} SELECT term, df, {_r('log10(1.0 * n / df)')} AS idf "
            "FROM terms CROSS JOIN n"
        ),
        "query_weights": _searched(
            postings,
            f"SELECT qid, term, {_r('wq')} AS wq, {_r('norm_query * norm_global')} AS norm "
            "FROM w JOIN per_query USING (qid) JOIN per_all USING (qid)",
        ),
        "doc_weights": (
            f"WITH {postings} SELECT term, doc_id, "
            f"{_r('log10(1 + tf) * log10(1.0 * n / df)')} AS wd "
            "FROM postings JOIN terms USING (term) CROSS JOIN n"
        ),
        "dot_scores": _searched(
            postings, f"SELECT qid, doc_id, {_r('dot')} AS dot FROM scores"
        ),
        "cosine_scores": _searched(
            postings, f"SELECT qid, doc_id, {_r('similarity')} AS similarity FROM scores"
        ),
        "text_topk": _searched(postings, f"SELECT {top}"),
        "search_topk": _searched(postings, f"SELECT {top}"),
        "hits_metadata": _searched(
            postings,
            f"""SELECT r.qid, r.doc_id, coalesce(l.quality::VARCHAR, 'Unknown') AS quality,
                       coalesce(l.toxic::VARCHAR, 'Unknown') AS toxic
                FROM ranked r LEFT JOIN labels l USING (doc_id) WHERE r.rank <= {K}""",
        ),
        "liketo": f"""WITH {postings}, {_query_terms(
                f"SELECT 0 AS qid, {_quoted(LIKE_TEXT)} AS text", "spanish")}, {_SCORES}
            SELECT r.doc_id, d.source AS title, d.lang AS artist, 'Unknown' AS album,
                   'Unknown' AS release_date, {_r('r.similarity')} AS similarity
            FROM ranked r JOIN documents d USING (doc_id) WHERE r.rank <= 5""",
        "match_any": f"WITH {matched} SELECT qid, doc_id FROM found",
        "match_any_limit": f"""WITH {matched} SELECT qid, doc_id FROM found
            QUALIFY row_number() OVER (PARTITION BY qid ORDER BY doc_id) <= {K}""",
        "search_by_corpus": _corpora(),
        "l2_distance": f"""SELECT vec_id, {_r(
            'list_distance(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[])')} AS distance
            FROM embeddings""",
        "knn_exact": knn,
        "knn_pca_full": knn,
        "range_search": f"""WITH {_PAIRS}
            SELECT qid, vec_id, {_r('distance')} AS distance FROM pairs
            WHERE distance <= {RADIUS}""",
        "knn_ties": f"""WITH {_PAIRS}
            SELECT qid, vec_id, {_r('distance')} AS distance FROM pairs
            QUALIFY rank() OVER (PARTITION BY qid ORDER BY distance) <= {K}""",
        "lsh_signature": f"""WITH {_bits()}
            SELECT vec_id, (bit // 64)::BIGINT AS word, sum(CASE WHEN b = 0 THEN 0
                WHEN bit % 64 = 63 THEN -9223372036854775808
                ELSE 1::BIGINT << (bit % 64) END)::BIGINT AS bits
            FROM bits GROUP BY ALL""",
        "hamming_topk": f"""WITH {_bits()}
            SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY hamming, vec_id) AS rank,
                   vec_id, hamming FROM closest""",
        "knn_lsh": lsh_knn,
        "knn_lsh_stored": lsh_knn,
        "distances": f"""WITH {_FLAT},
            pooled AS (SELECT label, coef, avg(value) AS value FROM flat GROUP BY ALL),
            centres AS (
                SELECT label::BIGINT AS qid, list(value ORDER BY coef) AS q FROM pooled GROUP BY label)
            SELECT qid, vec_id, {_r('list_distance(embedding::DOUBLE[], q)')} AS distance
            FROM embeddings CROSS JOIN centres""",
        "distance_percentiles": f"""WITH {_CENTRE}, p(percentile) AS (VALUES {percentiles})
            SELECT percentile, {_r('quantile_cont(distance, percentile / 100)')} AS distance
            FROM d CROSS JOIN p GROUP BY percentile""".replace(
            "quantile_cont(distance, percentile / 100)",
            "CASE percentile "
            + " ".join(
                f"WHEN {p} THEN quantile_cont(distance, {p / 100})" for p in (10, 30, 50, 70, 90)
            )
            + " END",
        ),
        "distance_hist": f"""WITH {_CENTRE},
            lim AS (SELECT min(distance) AS lo, (max(distance) - min(distance)) / 50 AS w FROM d),
            counts AS (
                SELECT least(floor((distance - lo) / w)::BIGINT, 49) AS bin, count(*) AS n
                FROM d CROSS JOIN lim GROUP BY ALL)
            SELECT r.bin, {_r('lo + r.bin * w')} AS low, {_r('lo + (r.bin + 1) * w')} AS high,
                   coalesce(c.n, 0) AS n
            FROM (SELECT unnest(range(50)) AS bin) r CROSS JOIN lim
            LEFT JOIN counts c ON c.bin = r.bin""",
        "hits_tracks": f"""WITH {_PAIRS}, {nearest}
            SELECT qid, rank, vec_id, {_r('distance')} AS distance, p_name, p_brand
            FROM near JOIN part ON p_partkey = vec_id""",
        "mean_pool": (
            f"WITH {_FLAT} SELECT label, coef, {_r('avg(value)')} AS value FROM flat GROUP BY ALL"
        ),
        "coef_stats": f"""WITH {_FLAT} SELECT coef, {_r('avg(value)')} AS mean,
            {_r('stddev_pop(value)')} AS std FROM flat GROUP BY coef""",
        "minmax": f"""WITH {_FLAT},
            lim AS (SELECT vec_id, min(value) AS lo, max(value) AS hi FROM flat GROUP BY vec_id)
            SELECT vec_id, coef, CASE WHEN hi = lo THEN 0.0
                ELSE {_r('(value - lo) / (hi - lo)')} END AS value
            FROM flat JOIN lim USING (vec_id)""",
        "zero_crossings": f"""WITH {_SIGNALS},
            s AS (SELECT signal_id, pos, value < -1e-10 AS neg FROM signals),
            c AS (SELECT signal_id, neg, lag(neg) OVER (
                PARTITION BY signal_id ORDER BY pos) AS before FROM s)
            SELECT signal_id, sum(CASE WHEN before <> neg THEN 1 ELSE 0 END)::BIGINT AS crossings
            FROM c GROUP BY signal_id""",
        "rms_frames": f"""WITH {_SIGNALS},
            f AS (
                SELECT signal_id, value, pos, unnest(range(0, pos // {HOP} + 1)) AS frame
                FROM signals)
            SELECT signal_id, frame, {_r('sqrt(avg(value * value))')} AS rms FROM f
            WHERE pos < frame * {HOP} + {FRAME}
            GROUP BY ALL HAVING count(*) = {FRAME}""",
        "shape_profile": """SELECT vec_id, len(embedding)::BIGINT AS size,
            (SELECT count(*) FROM embeddings) AS total FROM embeddings ORDER BY vec_id LIMIT 10""",
        "extract_features": """SELECT page_id, length(html)::BIGINT AS n_chars,
            (length(html) - length(replace(html, '<', '')))::BIGINT AS n_tags,
            (length(html) - length(replace(html, chr(10), '')))::BIGINT AS n_lines FROM pages""",
    }
    stems = ", ".join(f"('{word}', '{stem}')" for word, stem in PART_STEMS.items())
    found["stems_of_parts"] = f"""WITH words AS (
            SELECT DISTINCT unnest(string_split_regex(lower(p_name || ' ' || p_type), '[^a-z]+')) AS token
            FROM part),
        differ(token, stem) AS (VALUES {stems})
        SELECT token, coalesce(stem, token) AS stem FROM words LEFT JOIN differ USING (token)
        WHERE token <> ''"""
    found["corpus_slice_cut"] = found["corpus_slice"]
    found["liketo_stored"] = found["liketo"]
    found["match_any_stored"] = found["match_any_limit"]
    for name, plain in (("search_topk_blocks", "search_topk"), ("search_topk_cells", "search_topk"), ("knn_cells", "knn_exact"), ("range_cells", "range_search"), ("knn_ties_cells", "knn_ties")):
        found[name] = found[plain]
    found["range_pca_full"] = found["range_search"]
    found["zero_crossings_cut"] = found["zero_crossings"]
    centred = f"""{_FLAT},
        pooled AS (SELECT coef, avg(value) AS m FROM flat GROUP BY coef),
        c AS (SELECT vec_id, coef, value - m AS x FROM flat JOIN pooled USING (coef))"""
    found["pca_norms"] = f"""WITH {centred}
        SELECT vec_id, {_r('sum(x * x)')} AS norm FROM c GROUP BY vec_id"""
    found["pca_moments"] = f"""WITH {centred},
        cov AS (SELECT a.coef AS i, b.coef AS j, sum(a.x * b.x) AS v
                FROM c a JOIN c b USING (vec_id) GROUP BY ALL),
        squared AS (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM cov a JOIN cov b ON a.j = b.i GROUP BY ALL),
        t AS (SELECT sum(v) AS t FROM cov WHERE i = j)
        SELECT 1.0::DOUBLE AS first,
               {_r('(SELECT sum(v * v) FROM cov) / t ^ 2')} AS second,
               {_r('(SELECT sum(s.v * c.v) FROM squared s JOIN cov c ON s.i = c.j AND s.j = c.i) / t ^ 3')} AS third
        FROM t"""
    found["components_kept"] = f"""WITH {_FLAT},
        v AS (SELECT coef, var_pop(value) AS v FROM flat GROUP BY coef),
        r AS (SELECT row_number() OVER o AS component,
                     sum(v) OVER o / sum(v) OVER () AS cumulative FROM v
              WINDOW o AS (ORDER BY v DESC, coef))
        SELECT min(component) AS components FROM r WHERE cumulative >= 0.5"""
    return found
