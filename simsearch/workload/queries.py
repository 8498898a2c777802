"""One query per operator, bound to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsearch.functions.text import clean_text, concat_text, resolve_language
from simsearch.functions.vectors import l2_distance, minmax_normalize
from simsearch.operators import analysis, distribution, features, index, lsh, neighbours
from simsearch.operators import reduction, search
from simsearch.operators.product import blocked_scores
from simsearch.plans.joins import lookup_join
from simsearch.plans.selection import number_rows
from simsearch.plans.storage import materialize, new_table_path
from simsearch.sources import index_store, tables
from simsearch.sources import vectors as vector_files

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL side.
K = 10
CORPUS = 500
CORPORA = (100, 300, 600)
RADIUS = 1.1
NBITS = 64
FRAME, HOP = 8, 4
SPAN = index.BLOCK_SPAN
LIKE_TEXT = "esbo para thion the ciónrr ertion"
DIGITS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def text_queries(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")


def embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


def vector_queries(spark, sf_dir):
    return embeddings(spark, sf_dir).select(
        F.col("vec_id").alias("qid"), F.col("embedding").alias("q")
    )


def centroid(spark, sf_dir, by: list[str]) -> DataFrame:
    """Mean vectors of the collection as queries, one per value of ``by``."""
    rows = features.coefficients(embeddings(spark, sf_dir), "embedding", by)
    pooled = rows.groupBy(*by, "coef").agg(F.avg("value").alias("value"))
    lists = pooled.groupBy(*by).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("coef", "value"))), lambda x: x["value"]
        ).alias("q")
    )
    qid = F.col(by[0]).cast("long") if by else F.lit(0).cast("long")
    return lists.select(qid.alias("qid"), "q")


def signals(spark, sf_dir, ranges: int | None = None) -> DataFrame:
    """One signal per user: event values about the user's mean, in time order."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    means = events.groupBy("user_id").agg(F.avg("value").alias("mean"))
    centred = lookup_join(events, means, ["user_id"], salt_by=["event_id"])
    placed = number_rows(centred, "user_id", ["ts", "event_id"], "pos", ranges)
    return placed.select(
        F.col("user_id").alias("signal_id"), "pos", (F.col("value") - F.col("mean")).alias("value")
    )


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Round what was summed in another order elsewhere; and no negative zero."""
    return df.withColumns({n: F.round(n, DIGITS) + F.lit(0.0) for n in names})


def plain_index(spark, sf_dir, vocabulary: DataFrame | None = None) -> index.Index:
    return index.build_index(documents(spark, sf_dir), stem=False, vocabulary=vocabulary)


def plain_terms(spark, sf_dir) -> DataFrame:
    return analysis.analyze_queries(text_queries(spark, sf_dir), stem=False)


def queried_index(spark, sf_dir) -> tuple[index.Index, DataFrame]:
    terms = plain_terms(spark, sf_dir)
    return plain_index(spark, sf_dir, terms), terms


# --- Sources and sinks -------------------------------------------------------


def src_documents(spark, sf_dir):
    return tables.read_songs(spark, f"{sf_dir}/documents.parquet")


def src_tracks(spark, sf_dir):
    return tables.read_tracks(spark, f"{sf_dir}/part.parquet", id_col="p_partkey")


def corpus_slice(spark, sf_dir):
    return tables.corpus_slice(documents(spark, sf_dir), CORPUS).select("doc_id", "lang", "n_chars")


def corpus_slice_cut(spark, sf_dir):
    """The same slice, found by cutting the order into ranges as a long one is."""
    cut = tables.corpus_slice(documents(spark, sf_dir), CORPUS, at_once=0)
    return cut.select("doc_id", "lang", "n_chars")


def _long_vectors(df: DataFrame) -> DataFrame:
    return features.coefficients(df, "embedding", ["vec_id", "label"])


def read_vectors(spark, sf_dir):
    return _long_vectors(vector_files.read_vectors(spark, f"{sf_dir}/embeddings.parquet"))


def write_vectors(spark, sf_dir):
    path = new_table_path(spark, "vectors")
    vector_files.write_vectors(embeddings(spark, sf_dir), path)
    return _long_vectors(vector_files.read_vectors(spark, path))


def index_roundtrip(spark, sf_dir):
    path = new_table_path(spark, "index")
    index_store.write_index(plain_index(spark, sf_dir), path)
    stored = index_store.read_index(spark, path)
    joined = lookup_join(
        stored.postings, stored.terms.select("term", "df"), ["term"], salt_by=["doc_id"]
    )
    return joined.select("term", "df", "doc_id", "tf", F.lit(stored.n_docs).cast("long").alias("n_docs"))


def postings_text(spark, sf_dir):
    return index.format_postings(plain_index(spark, sf_dir).postings)


def postings_parse(spark, sf_dir):
    return index.parse_postings(index.format_postings(plain_index(spark, sf_dir).postings))


# --- Text normalisation ------------------------------------------------------


def text_concat(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return concat_text(parts, ["p_name", "p_brand", "p_type"]).select("p_partkey", "text")


def text_clean(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", clean_text(F.col("text")).alias("clean"))


def lang_resolve(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", resolve_language(F.col("lang")).alias("language")
    )


def tokens(spark, sf_dir):
    rows = analysis.document_tokens(documents(spark, sf_dir), by_id=True)
    return rows.groupBy("doc_id").agg(
        F.count("*").alias("tokens"), F.countDistinct("token").alias("words")
    )


def tokens_nostop(spark, sf_dir):
    rows = analysis.remove_stopwords(analysis.document_tokens(documents(spark, sf_dir)))
    return rows.groupBy("lang", "token").agg(F.count("*").alias("n"))


def tokens_stemmed(spark, sf_dir):
    rows = analysis.remove_stopwords(analysis.document_tokens(documents(spark, sf_dir)))
    return analysis.stem_vocabulary(rows)


def stems_of_parts(spark, sf_dir):
    """English stems of the words that parts are described with."""
    rows = analysis.document_tokens(
        table(spark, sf_dir, "part"), "p_partkey", ("p_name", "p_type"), None
    )
    return analysis.stem_vocabulary(rows, ["english"]).select("token", "stem")


def analyze_docs(spark, sf_dir):
    rows = analysis.analyze_documents(documents(spark, sf_dir), stem=False)
    return rows.groupBy("doc_id", "term").agg(F.count("*").alias("n"))


def analyze_docs_stemmed(spark, sf_dir):
    rows = analysis.analyze_documents(documents(spark, sf_dir))
    return rows.groupBy("doc_id", "term").agg(F.count("*").alias("n"))


def query_terms(spark, sf_dir):
    return plain_terms(spark, sf_dir)


# --- Index -------------------------------------------------------------------


def term_freq(spark, sf_dir):
    rows = analysis.analyze_documents(documents(spark, sf_dir), stem=False, by_id=True)
    return index.term_frequencies(rows)


def doc_freq(spark, sf_dir):
    return index.document_frequencies(term_freq(spark, sf_dir))


def posting_lists(spark, sf_dir):
    lists = index.posting_lists(plain_index(spark, sf_dir).postings)
    flat = lists.select("term", "block", F.posexplode("postings").alias("pos", "p"))
    return flat.select(
        "term", "block", F.col("pos").cast("long").alias("pos"), "p.doc_id", "p.tf"
    )


def index_sorted(spark, sf_dir):
    return index.sorted_index(plain_index(spark, sf_dir).postings)


def index_merge(spark, sf_dir):
    docs = documents(spark, sf_dir)
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    parts = [index.build_index(docs.where(side), stem=False) for side in (english, ~english)]
    merged = index.merge_indexes(*parts)
    return merged.terms.select("term", "df", F.lit(merged.n_docs).cast("long").alias("n_docs"))


def index_build(spark, sf_dir):
    built = plain_index(spark, sf_dir)
    return rounded(
        built.terms.select("term", "df", "tf_square", F.lit(built.n_docs).cast("long").alias("n_docs")),
        "tf_square",
    )


def index_build_stemmed(spark, sf_dir):
    built = index.build_index(documents(spark, sf_dir))
    return built.terms.select("term", "df", F.lit(built.n_docs).cast("long").alias("n_docs"))


# --- Text search -------------------------------------------------------------


def term_lookup(spark, sf_dir):
    built, terms = queried_index(spark, sf_dir)
    return search.lookup_terms(built, terms)


def idf(spark, sf_dir):
    built = plain_index(spark, sf_dir)
    return rounded(search.idf(built.terms.select("term", "df"), built.n_docs), "idf")


def query_weights(spark, sf_dir):
    built, terms = queried_index(spark, sf_dir)
    weights = search.query_weights(built, terms)
    return rounded(weights.select("qid", "term", "wq", "norm"), "wq", "norm")


def doc_weights(spark, sf_dir):
    return rounded(search.doc_weights(plain_index(spark, sf_dir)), "wd")


def _scores(spark, sf_dir):
    built, terms = queried_index(spark, sf_dir)
    return search.score(built, search.query_weights(built, terms))


def dot_scores(spark, sf_dir):
    return rounded(_scores(spark, sf_dir).select("qid", "doc_id", "dot"), "dot")


def cosine_scores(spark, sf_dir):
    return rounded(_scores(spark, sf_dir).select("qid", "doc_id", "similarity"), "similarity")


def text_topk(spark, sf_dir):
    best = search.top_k(_scores(spark, sf_dir), K)
    return rounded(
        best.select("qid", F.col("rank").cast("long").alias("rank"), "doc_id", "similarity"),
        "similarity",
    )


def _search(spark, sf_dir):
    built, terms = queried_index(spark, sf_dir)
    return search.search_top_k(built, text_queries(spark, sf_dir), K, query_terms=terms)


def search_topk(spark, sf_dir):
    return rounded(_search(spark, sf_dir), "similarity")


def search_topk_blocks(spark, sf_dir):
    """The same through a stored index whose block maxima say what has to be read."""
    path = new_table_path(spark, "index")
    built = index.build_index(documents(spark, sf_dir), stem=False)
    index_store.write_index(built, path, span=32)
    found = search.search_top_k(
        index_store.read_index(spark, path), text_queries(spark, sf_dir), K,
        query_terms=plain_terms(spark, sf_dir), by_blocks=True,
    )
    return rounded(found, "similarity")


def search_topk_cells(spark, sf_dir):
    """The same as if the queries were too many to be sent to every task."""
    terms = materialize(plain_terms(spark, sf_dir), "query")
    built = index.build_index(documents(spark, sf_dir), stem=False, vocabulary=terms)
    weights = materialize(search.query_weights(built, terms), "weights")
    found = search.top_k(blocked_scores(built, weights, K, block_weights=500, cell_postings=5000), K)
    found = found.select("qid", F.col("rank").cast("long").alias("rank"), "doc_id", "similarity")
    return rounded(found, "similarity")


def search_topk_stemmed(spark, sf_dir):
    terms = analysis.analyze_queries(text_queries(spark, sf_dir))
    built = index.build_index(documents(spark, sf_dir), vocabulary=terms)
    hits = search.search_top_k(built, text_queries(spark, sf_dir), K, query_terms=terms)
    return rounded(hits, "similarity")


def hits_metadata(spark, sf_dir):
    hits = _search(spark, sf_dir).select("qid", "doc_id")
    return search.attach_metadata(
        hits, table(spark, sf_dir, "labels"), {"quality": "quality", "toxic": "toxic"}
    )


def liketo(spark, sf_dir):
    hits = search.liketo(
        documents(spark, sf_dir), "text", LIKE_TEXT, stem=False,
        metadata={"title": "source", "artist": "lang"},
    )
    return rounded(hits, "similarity")


def _stored(spark, sf_dir, lang_col: str | None):
    path = new_table_path(spark, "index")
    built = index.build_index(documents(spark, sf_dir), lang_col=lang_col, stem=False)
    index_store.write_index(built, path)
    return index_store.read_index(spark, path)


def liketo_stored(spark, sf_dir):
    hits = search.liketo(
        documents(spark, sf_dir), "text", LIKE_TEXT, stem=False,
        metadata={"title": "source", "artist": "lang"}, index=_stored(spark, sf_dir, "lang"),
    )
    return rounded(hits, "similarity")


def match_any_stored(spark, sf_dir):
    return search.match_any(
        None, "text", text_queries(spark, sf_dir), K, stem=False, index=_stored(spark, sf_dir, None)
    )


def match_any(spark, sf_dir):
    return search.match_any(
        documents(spark, sf_dir), "text", text_queries(spark, sf_dir), stem=False
    )


def match_any_limit(spark, sf_dir):
    return search.match_any(
        documents(spark, sf_dir), "text", text_queries(spark, sf_dir), K, stem=False
    )


def search_by_corpus(spark, sf_dir):
    terms = plain_terms(spark, sf_dir)
    found = None
    for n in CORPORA:
        built = search.with_corpus(documents(spark, sf_dir), n, stem=False, vocabulary=terms)
        hits = search.search_top_k(built, text_queries(spark, sf_dir), K, query_terms=terms)
        hits = hits.withColumn("corpus_n", F.lit(n).cast("long"))
        found = hits if found is None else found.unionByName(hits)
    return rounded(found, "similarity")


# --- Vector search -----------------------------------------------------------


def l2(spark, sf_dir):
    rows = embeddings(spark, sf_dir)
    distance = l2_distance(F.col("embedding"), F.reverse("embedding"))
    return rounded(rows.select("vec_id", distance.alias("distance")), "distance")


def knn_exact(spark, sf_dir):
    found = neighbours.knn(embeddings(spark, sf_dir), vector_queries(spark, sf_dir), K)
    return rounded(found, "distance")


def range_search(spark, sf_dir):
    found = neighbours.range_search(
        embeddings(spark, sf_dir), vector_queries(spark, sf_dir), RADIUS
    )
    return rounded(found, "distance")


# A query table of any size counts as large, and cells are small, as if there were many.
CELLS = {"query_bytes": 0, "cell_rows": 25}


def knn_cells(spark, sf_dir):
    found = neighbours.knn(embeddings(spark, sf_dir), vector_queries(spark, sf_dir), K, **CELLS)
    return rounded(found, "distance")


def range_cells(spark, sf_dir):
    found = neighbours.range_search(
        embeddings(spark, sf_dir), vector_queries(spark, sf_dir), RADIUS, **CELLS
    )
    return rounded(found, "distance")


def knn_ties_cells(spark, sf_dir):
    found = neighbours.knn_with_ties(embeddings(spark, sf_dir), vector_queries(spark, sf_dir), K, **CELLS)
    return rounded(found, "distance")


def knn_ties(spark, sf_dir):
    found = neighbours.knn_with_ties(embeddings(spark, sf_dir), vector_queries(spark, sf_dir), K)
    return rounded(found, "distance")


def lsh_signature(spark, sf_dir):
    signed = lsh.lsh_signature(embeddings(spark, sf_dir), NBITS)
    return signed.select("vec_id", F.posexplode("signature").alias("word", "bits")).select(
        "vec_id", F.col("word").cast("long").alias("word"), "bits"
    )


def hamming_topk(spark, sf_dir):
    signed = lsh.lsh_signature(embeddings(spark, sf_dir), NBITS)
    return lsh.hamming_top_k(signed, signed.withColumnRenamed("vec_id", "qid"), K)


def knn_lsh(spark, sf_dir):
    found = lsh.knn_lsh(embeddings(spark, sf_dir), vector_queries(spark, sf_dir), K, NBITS)
    return rounded(found, "distance")


def knn_lsh_stored(spark, sf_dir):
    rows = embeddings(spark, sf_dir)
    signed = lsh.lsh_signature(rows, NBITS)
    found = lsh.knn_lsh(rows, vector_queries(spark, sf_dir), K, NBITS, signatures=signed)
    return rounded(found, "distance")


def distances(spark, sf_dir):
    found = neighbours.distances(embeddings(spark, sf_dir), centroid(spark, sf_dir, ["label"]))
    return rounded(found, "distance")


def _to_centre(spark, sf_dir):
    return neighbours.distances(embeddings(spark, sf_dir), centroid(spark, sf_dir, []))


def distance_percentiles(spark, sf_dir):
    found = distribution.distance_percentiles(_to_centre(spark, sf_dir))
    return rounded(found, "distance")


def distance_hist(spark, sf_dir):
    found = distribution.distance_histogram(_to_centre(spark, sf_dir))
    return rounded(found, "low", "high")


def hits_tracks(spark, sf_dir):
    found = neighbours.knn(embeddings(spark, sf_dir), vector_queries(spark, sf_dir), K)
    hits = neighbours.attach_tracks(
        found, table(spark, sf_dir, "part"), "p_partkey", ["p_name", "p_brand"]
    )
    return rounded(hits, "distance")


# --- Reduction ---------------------------------------------------------------


def pca_project(spark, sf_dir):
    rows = embeddings(spark, sf_dir)
    reduced = reduction.reduce_vectors(reduction.fit_pca(rows, 8), rows)
    return rounded(features.coefficients(reduced, "embedding", ["vec_id"]), "value")


def pca_variance(spark, sf_dir):
    found = reduction.explained_variance(embeddings(spark, sf_dir))
    return rounded(found, "ratio", "cumulative")


def pca_components(spark, sf_dir):
    return reduction.choose_components(reduction.explained_variance(embeddings(spark, sf_dir)))


def pca_norms(spark, sf_dir):
    """Squared lengths of the projections at full rank: squared distances to the mean."""
    rows = embeddings(spark, sf_dir)
    reduced = reduction.reduce_vectors(reduction.fit_pca(rows), rows)
    flat = features.coefficients(reduced, "embedding", ["vec_id"])
    norms = flat.groupBy("vec_id").agg(F.sum(F.col("value") * F.col("value")).alias("norm"))
    return rounded(norms, "norm")


def pca_moments(spark, sf_dir):
    """Power sums of the variance shares, which are traces of powers of the covariance."""
    ratio = F.col("ratio")
    shares = reduction.explained_variance(embeddings(spark, sf_dir)).agg(
        F.sum(ratio).alias("first"), F.sum(ratio * ratio).alias("second"),
        F.sum(ratio * ratio * ratio).alias("third"),
    )
    return rounded(shares, "first", "second", "third")


def components_kept(spark, sf_dir):
    """How many coefficients, by falling variance, keep half of it."""
    stats = features.coefficient_stats(embeddings(spark, sf_dir))
    spread = stats.select("coef", (F.col("std") * F.col("std")).alias("v"))
    order = Window.orderBy(F.col("v").desc(), "coef")  # one row per coefficient
    ranked = spread.withColumns({
        "component": F.row_number().over(order).cast("long"),
        "cumulative": F.sum("v").over(order) / F.sum("v").over(Window.partitionBy()),
    })
    return reduction.choose_components(ranked, 0.5)


def range_pca_full(spark, sf_dir):
    rows = embeddings(spark, sf_dir)
    model = reduction.fit_pca(rows)
    found = neighbours.range_search(
        reduction.reduce_vectors(model, rows),
        reduction.reduce_queries(model, vector_queries(spark, sf_dir)), RADIUS,
    )
    return rounded(found, "distance")


def zero_crossings_cut(spark, sf_dir):
    """Crossings of signals whose rows were numbered in several ranges, as long ones are."""
    return features.zero_crossings(signals(spark, sf_dir, ranges=5))


def _knn_reduced(spark, sf_dir, n):
    rows = embeddings(spark, sf_dir)
    model = reduction.fit_pca(rows, n)
    found = neighbours.knn(
        reduction.reduce_vectors(model, rows),
        reduction.reduce_queries(model, vector_queries(spark, sf_dir)), K,
    )
    return rounded(found, "distance")


def knn_pca(spark, sf_dir):
    return _knn_reduced(spark, sf_dir, 28)


def knn_pca_full(spark, sf_dir):
    return _knn_reduced(spark, sf_dir, None)


# --- Features ----------------------------------------------------------------


def mean_pool(spark, sf_dir):
    frames = features.coefficients(embeddings(spark, sf_dir), "embedding", ["label"])
    return rounded(features.mean_pool(frames, "label"), "value")


def coef_stats(spark, sf_dir):
    return rounded(features.coefficient_stats(embeddings(spark, sf_dir)), "mean", "std")


def minmax(spark, sf_dir):
    rows = embeddings(spark, sf_dir).select(
        "vec_id", minmax_normalize(F.col("embedding")).alias("embedding")
    )
    return rounded(features.coefficients(rows, "embedding", ["vec_id"]), "value")


def zero_crossings(spark, sf_dir):
    return features.zero_crossings(signals(spark, sf_dir))


def rms_frames(spark, sf_dir):
    return rounded(features.rms_frames(signals(spark, sf_dir), FRAME, HOP), "rms")


def shape_profile(spark, sf_dir):
    return features.shape_profile(embeddings(spark, sf_dir))


def _page_features(html: str) -> dict:
    return {"n_chars": len(html), "n_tags": html.count("<"), "n_lines": html.count("\n")}


def extract_features(spark, sf_dir):
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("n_chars", "n_tags", "n_lines")])
    return features.extract_features(
        table(spark, sf_dir, "pages"), _page_features, schema, "page_id", "html"
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        src_documents, src_tracks, corpus_slice, corpus_slice_cut, read_vectors, write_vectors,
        index_roundtrip, postings_text, postings_parse,
        text_concat, text_clean, lang_resolve, tokens, tokens_nostop, tokens_stemmed,
        stems_of_parts,
        analyze_docs, analyze_docs_stemmed, query_terms,
        term_freq, doc_freq, posting_lists, index_sorted, index_merge, index_build,
        index_build_stemmed,
        term_lookup, idf, query_weights, doc_weights, dot_scores, cosine_scores, text_topk,
        search_topk, search_topk_blocks, search_topk_cells, search_topk_stemmed, hits_metadata, liketo, liketo_stored,
        match_any, match_any_limit, match_any_stored,
        search_by_corpus,
        knn_exact, range_search, knn_ties, knn_cells, range_cells, knn_ties_cells, lsh_signature, hamming_topk, knn_lsh,
        knn_lsh_stored, distances, distance_percentiles, distance_hist, hits_tracks,
        pca_project, pca_variance, pca_components, pca_norms, pca_moments, components_kept,
        knn_pca, knn_pca_full, range_pca_full,
        mean_pool, coef_stats, minmax, zero_crossings, zero_crossings_cut,
        rms_frames, shape_profile,
        extract_features,
    )
}
QUERIES["l2_distance"] = l2
