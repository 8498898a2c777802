"""Ranked and boolean text search for tables of queries."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simsearch.functions.stopwords import sql_list
from simsearch.operators.analysis import analyze_documents, analyze_queries
from simsearch.operators.index import Index, block_of, build_index, tf_weight
from simsearch.operators.product import blocked_scores
from simsearch.plans.joins import fits_broadcast, lookup_join
from simsearch.plans.storage import materialize
from simsearch.sources.tables import corpus_slice

UNKNOWN = "Unknown"

# Query terms put into the scan as literals; see ``narrow``.
LITERAL_TERMS = 1000
# Hits of one text that are shown by literals.
LITERAL_HITS = 1000
# Pairs of query and posting that one task of ``score`` adds up, and the most tasks: beyond
# that the aggregate of a task spills instead.
TASK_PAIRS = 500_000
MOST_TASKS = 20_000
# Pairs from which on block maxima are asked first, and blocks scored at once to bound the k-th.
BLOCK_PAIRS = 50_000_000
PROBED = 2
# Queries up to which each block lists those that want it; a listed query is looked for one by one.
LISTED_QUERIES = 1000
# What adding up in another order may change in a similarity, and what counts as tied.
_SLACK = 2e-12


def narrow(index: Index, terms: DataFrame, most: int = LITERAL_TERMS) -> Index:
    """The index with only the given terms in sight, when they are few.

    As literals they reach the scan of a stored index, which is sorted by term,
    and leave out the row groups without them. More terms than ``most`` are left
    to the join.
    """
    found = terms.select("term").distinct().limit(most + 1).collect()
    if not found or len(found) > most:
        return index
    return _of_terms(index, [row.term for row in found])


def _of_terms(index: Index, terms: Iterable[str]) -> Index:
    wanted = F.expr(f"term IN ({sql_list(sorted(terms))})")
    blocks = None if index.blocks is None else index.blocks.where(wanted)
    return replace(
        index, postings=index.postings.where(wanted), terms=index.terms.where(wanted), blocks=blocks
    )


def lookup_terms(index: Index, terms: DataFrame) -> DataFrame:
    """Rows ``(term, df, doc_id, tf)`` of the given terms; absent ones give none."""
    index = narrow(index, terms)
    wanted = lookup_join(
        index.terms.select("term", "df"), terms.select("term").distinct(), ["term"], "left_semi"
    )
    return lookup_join(index.postings, wanted, ["term"], salt_by=["doc_id"]).select(
        "term", "df", "doc_id", "tf"
    )


def idf(terms: DataFrame, n_docs: int) -> DataFrame:
    """``log10(N / df)`` per term, without smoothing."""
    return terms.withColumn("idf", F.log10(F.lit(float(n_docs)) / F.col("df")))


def query_weights(
    index: Index, query_terms: DataFrame, broadcast: bool | None = None
) -> DataFrame:
    """Rows ``(qid, term, df, idf, wq, norm)`` for the query terms the index knows.

    ``norm`` is the whole divisor of the query's scores: the length of the query
    times the length of everything it matches. The latter needs only the sum of
    squared tf weights kept with each term, so no posting is read for it.
    """
    terms = idf(index.terms, index.n_docs)
    if fits_broadcast(query_terms) if broadcast is None else broadcast:
        known = lookup_join(terms, query_terms, ["term"], broadcast=True)
    else:
        known = lookup_join(query_terms, terms, ["term"], salt_by=["qid"], broadcast=False)
    weighted = known.withColumn("wq", tf_weight(F.col("tf")) * F.col("idf"))
    query = Window.partitionBy("qid")
    query_length = F.sqrt(F.sum(F.col("wq") * F.col("wq")).over(query))
    matched_length = F.sqrt(F.sum(F.col("idf") * F.col("idf") * F.col("tf_square")).over(query))
    return weighted.select(
        "qid", "term", "df", "idf", "wq", (query_length * matched_length).alias("norm")
    )


def doc_weights(index: Index) -> DataFrame:
    """Rows ``(term, doc_id, wd)`` for every posting."""
    terms = materialize(idf(index.terms, index.n_docs).select("term", "idf"), "idf")
    joined = lookup_join(index.postings, terms, ["term"], salt_by=["doc_id"])
    return joined.select(
        "term", "doc_id", (tf_weight(F.col("tf")) * F.col("idf")).alias("wd")
    )


def _pairs(weights: DataFrame) -> int:
    """Pairs of query and posting, which the document frequencies tell in advance."""
    return weights.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]


def _tasks(weights: DataFrame, pairs: int | None = None) -> int:
    """Tasks that keep the scores each of them adds up in memory.

    The work grows with the pairs, which the bytes of the postings do not tell.
    """
    pairs = _pairs(weights) if pairs is None else pairs
    session = weights.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return max(int(session), min(MOST_TASKS, math.ceil(pairs / TASK_PAIRS)))


def score(
    index: Index,
    weights: DataFrame,
    broadcast: bool | None = None,
    query_terms: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Rows ``(qid, doc_id, dot, similarity)`` of all matching documents.

    The postings the queries ask for are shuffled by document before they meet the
    queries: a posting that many queries share travels once, and each task then
    adds up whole scores. The similarity divides by the query's ``norm``, one
    constant per query, and is 0 where that is 0. ``query_terms`` names the terms
    asked for where that is cheaper than reading them from the weights. Weights
    with a ``block`` meet the postings of that block only. Weights too many to be
    sent to every task meet the postings in cells.
    """
    postings, on = index.postings, ["term"]
    if "block" in weights.columns:
        postings, on = postings.withColumn("block", block_of(index.span)), ["term", "block"]
    if broadcast is None:
        broadcast = fits_broadcast(weights)
    if broadcast:
        asked = (weights if query_terms is None else query_terms).select(*on).distinct()
        wanted = lookup_join(postings, asked, on, "left_semi", broadcast=True)
        matches = lookup_join(
            wanted.repartition(tasks or _tasks(weights), "doc_id"), weights, on, broadcast=True
        )
    elif on == ["term"]:
        return blocked_scores(index, weights)
    else:
        matches = lookup_join(postings, weights, on, salt_by=["doc_id"], broadcast=False)
    wd = tf_weight(F.col("tf")) * F.col("idf")
    dots = matches.groupBy("qid", "doc_id").agg(
        F.sum(F.col("wq") * wd).alias("dot"), F.max("norm").alias("norm")
    )
    similarity = F.when(F.col("norm") != 0, F.col("dot") / F.col("norm")).otherwise(F.lit(0.0))
    return dots.select("qid", "doc_id", "dot", similarity.alias("similarity"))


def score_blocks(index: Index, weights: DataFrame, wanted: DataFrame) -> DataFrame:
    """``score`` within the blocks ``wanted (qid, block)`` only, for few queries whose weights are sent to every task.

    The postings asked for are dealt by block to the queries that want the block, where their
    scores are added up: a posting travels once, and pairs of query and document never do.
    """
    asked = weights.select("term").distinct()
    postings = lookup_join(index.postings, asked, ["term"], "left_semi", broadcast=True)
    queries = wanted.groupBy("block").agg(F.collect_set("qid").alias("qids"))
    tasks = _tasks(weights)
    dealt = postings.withColumn("block", block_of(index.span)).repartition(tasks, "block")
    met = dealt.join(queries.repartition(tasks, "block").hint("shuffle_hash"), "block")
    matches = lookup_join(met, weights.drop("df"), ["term"], broadcast=True)
    matches = matches.where(F.array_contains("qids", F.col("qid")))
    wd = tf_weight(F.col("tf")) * F.col("idf")
    # What is dealt by block is so by block, query and document, too.
    dots = matches.groupBy("block", "qid", "doc_id").agg(
        F.sum(F.col("wq") * wd).alias("dot"), F.max("norm").alias("norm")
    )
    similarity = F.when(F.col("norm") != 0, F.col("dot") / F.col("norm")).otherwise(F.lit(0.0))
    return dots.select("qid", "doc_id", "dot", similarity.alias("similarity"))


def best_first() -> list[Column]:
    return [F.round("similarity", 12).desc(), F.col("doc_id").asc()]


def top_k(
    scores: DataFrame, k: int, by: str | None = "qid", order: list[Column] | None = None
) -> DataFrame:
    """The k best rows, overall or per query, ties going to the smaller id.

    Tasks keep their own best k before anything is shuffled. Similarities are
    sums whose last bits depend on the order of adding, so those that agree in
    twelve decimals count as tied: copies of a document stay in id order.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    if order is None:
        order = best_first()
    if by is None:
        return scores.orderBy(*order).limit(k)
    ranked = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return scores.withColumn("rank", ranked).where(F.col("rank") <= k)


def _kth(rows: DataFrame, column: str, k: int) -> DataFrame:
    """Rows ``(qid, least)``: the k-th greatest value of each query that has as many."""
    best = top_k(rows, k, order=[F.col(column).desc()])
    full = best.groupBy("qid").agg(F.count("*").alias("n"), F.min(column).alias("least"))
    return full.where(F.col("n") >= k).select("qid", "least")


def block_bounds(index: Index, weights: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Weights by block of ids: those of ``weights`` and ``block``, ``df`` within it and ``most``.

    ``most`` is what the term adds at most to a similarity in that block, and does
    add for one of its documents.
    """
    on = lookup_join(index.blocks, weights.drop("df"), ["term"], salt_by=["block"], broadcast=broadcast)
    most = F.col("wq") * F.col("idf") * tf_weight(F.col("max_tf"))
    return on.select(
        "qid", "term", "block", F.col("n").alias("df"), "idf", "wq", "norm",
        F.when(F.col("norm") != 0, most / F.col("norm")).otherwise(F.lit(0.0)).alias("most"),
    )


def needed_blocks(index: Index, weights: DataFrame, k: int, probed: int = PROBED) -> DataFrame:
    """``block_bounds`` with ``needed``: whether the block can hold one of the query's k best.

    Each block has a document that scores its best term's share, so the k-th best
    of those bounds the answer before any posting is read. Then the ``probed``
    blocks of the highest bounds are scored, which raises it. A block all of whose
    terms together stay below is not needed.
    """
    bounds = materialize(block_bounds(index, weights), "bounds")
    return lookup_join(bounds, _judged(index, weights, bounds, k, probed, False), ["qid", "block"])


def _judged(
    index: Index, weights: DataFrame, bounds: DataFrame, k: int, probed: int, small: bool
) -> DataFrame:
    """Rows ``(qid, block, needed)``; ``small`` says that ``score_blocks`` may score the probed ones."""
    cells = bounds.groupBy("qid", "block").agg(F.sum("most").alias("bound"), F.max("most").alias("sure"))
    cells = materialize(cells, "cells")
    first = top_k(cells, probed, order=[F.col("bound").desc(), F.col("block").asc()])
    first = materialize(first.select("qid", "block"), "probed")
    if small:
        scores = score_blocks(index, weights, first)
    else:
        probes = lookup_join(bounds, first, ["qid", "block"], "left_semi").drop("most")
        scores = score(index, materialize(probes, "probes"))
    scores = scores.select("qid", F.col("similarity").alias("sure"))
    # A probed block's documents are known: its share counts no second time.
    others = lookup_join(cells, first, ["qid", "block"], "left_anti").select("qid", "sure")
    least = materialize(_kth(scores.unionByName(others), "sure", k), "least")
    judged = lookup_join(cells, least, ["qid"], "left").select(
        "qid", "block",
        (F.col("least").isNull() | (F.col("bound") * (1 + 1e-9) + _SLACK >= F.col("least"))).alias("needed"),
    )
    return materialize(judged, "judged")


def search_top_k(
    index: Index,
    queries: DataFrame,
    k: int = 10,
    lang: str = "en",
    stem: bool = True,
    clean: bool = False,
    query_terms: DataFrame | None = None,
    by_blocks: bool | None = None,
) -> DataFrame:
    """Rows ``(qid, rank, doc_id, similarity)`` for a table ``(qid, text)``.

    ``query_terms`` passes queries that were analysed already. With block maxima
    in the index and many pairs of query and posting (or where ``by_blocks`` says
    so) only the postings of blocks that can hold an answer are scored.
    """
    if query_terms is None:
        query_terms = analyze_queries(queries, lang, stem, clean)
    query_terms = materialize(query_terms, "query")
    index = narrow(index, query_terms)
    # A weighted row is no wider than a few numbers more than a query term.
    small = fits_broadcast(query_terms)
    weights = materialize(query_weights(index, query_terms, broadcast=small), "weights")
    if by_blocks is None:
        by_blocks = index.blocks is not None and _pairs(weights) >= BLOCK_PAIRS
    if by_blocks and small and query_terms.agg(F.countDistinct("qid")).first()[0] <= LISTED_QUERIES:
        # By block first: so the bounds of a query's terms are added up where they are made.
        asked = lookup_join(
            index.blocks, weights.select("term").distinct(), ["term"], "left_semi", broadcast=True
        )
        dealt = replace(index, blocks=asked.repartition(_tasks(weights), "block"))
        judged = _judged(index, weights, block_bounds(dealt, weights, True), k, PROBED, True)
        scores = score_blocks(index, weights, judged.where("needed"))
    elif by_blocks:
        needed = needed_blocks(index, weights, k).where("needed").drop("needed", "most")
        scores = score(index, materialize(needed, "needed"))
    elif small:
        scores = score(index, weights, True, query_terms)
    else:
        scores = blocked_scores(index, weights, k)
    best = top_k(scores, k)
    return best.select("qid", F.col("rank").cast("long").alias("rank"), "doc_id", "similarity")


def attach_metadata(
    hits: DataFrame,
    meta: DataFrame,
    columns: dict[str, str],
    id_col: str = "doc_id",
    small: bool | None = None,
) -> DataFrame:
    """Add columns of ``meta`` to each hit; what is missing reads 'Unknown'.

    ``columns`` maps output names to columns of ``meta``. When the hits are few only
    their ids travel to the metadata; ``small`` says so, otherwise the hits are
    written once and measured.
    """
    if small is None:
        hits = materialize(hits, "hits")
        small = fits_broadcast(hits)
    kept = meta.select(
        F.col(id_col).alias("doc_id"),
        *[F.col(source).cast("string").alias(name) for name, source in columns.items()],
    )
    if small:
        # Few rows of the metadata come back, one or some for each hit.
        ids = hits.select("doc_id").distinct()
        kept = kept.join(F.broadcast(ids), "doc_id", "left_semi")
        joined = hits.join(kept, "doc_id", "left")
    else:
        joined = lookup_join(hits, kept, ["doc_id"], "left")
    return joined.select(
        *hits.columns, *[F.coalesce(n, F.lit(UNKNOWN)).alias(n) for n in columns]
    )


# What the search surface shows, and the song columns behind it.
ALL_COLUMNS = ["doc_id", "title", "artist", "album", "release_date", "similarity"]
SONG_COLUMNS = {
    "title": "track_name",
    "artist": "track_artist",
    "album": "track_album_name",
    "release_date": "track_album_release_date",
}


def liketo(
    table: DataFrame,
    field: str,
    text: str,
    columns: str | Iterable[str] = "*",
    limit: int = 5,
    lang: str = "es",
    stem: bool = True,
    id_col: str = "doc_id",
    lang_col: str | None = "lang",
    metadata: dict[str, str] | None = None,
    index: Index | None = None,
) -> DataFrame:
    """``SELECT columns FROM table WHERE field LIKETO text LIMIT limit``.

    Ranks the rows of ``table`` by their ``field``. ``metadata`` maps the shown
    names to columns of the table; a shown column without one reads 'Unknown'.
    With a (stored) ``index`` of the field the table is read only to show the
    hits; ``stem`` must say how that index was built.
    """
    if field not in table.columns and index is None:
        raise ValueError(f"unknown field: {field}")
    wanted = ALL_COLUMNS if columns == "*" else list(columns)
    unknown = [c for c in wanted if c not in ALL_COLUMNS]
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    mapping = SONG_COLUMNS if metadata is None else metadata
    mapping = {name: source for name, source in mapping.items() if source in table.columns}
    spark = table.sparkSession
    one = spark.createDataFrame([(0, text)], "qid long, text string")
    # The words of one text, what the index knows of them and the hits are few rows each:
    # they travel as literals instead of tables.
    asked = analyze_queries(one, lang, stem, few=True).collect()
    terms = spark.createDataFrame([tuple(r) for r in asked], "qid long, term string, tf long")
    if index is None:
        index = build_index(table, id_col, [field], lang_col, stem, vocabulary=terms)
    elif asked:
        index = _of_terms(index, [r["term"] for r in asked])
    known = query_weights(index, terms, broadcast=True)
    rows = [tuple(r) for r in known.collect()] if asked else []
    weights = spark.createDataFrame(rows, known.schema)
    tasks = _tasks(weights, sum(r[known.columns.index("df")] for r in rows))
    scores = score(index, weights, True, terms, tasks).select("doc_id", "similarity")
    hits = top_k(scores, limit, by=None)
    few = limit <= LITERAL_HITS
    if few:
        found = hits.collect() if rows else []
        hits = spark.createDataFrame([tuple(r) for r in found], hits.schema)
        ids = ", ".join(str(r["doc_id"]) for r in found)
        # Literals reach the scan of the table.
        table = table.where(F.expr(f"`{id_col}` IN ({ids})") if found else F.lit(False))
    else:
        hits = materialize(hits, "hits")
    shown = attach_metadata(hits, table, mapping, id_col, small=few)
    for name in ALL_COLUMNS:
        if name not in shown.columns:
            shown = shown.withColumn(name, F.lit(UNKNOWN))
    return shown.orderBy(*best_first()).select(*wanted)


def match_any(
    df: DataFrame | None,
    field: str,
    queries: DataFrame,
    limit: int | None = None,
    id_col: str = "doc_id",
    stem: bool = True,
    index: Index | None = None,
) -> DataFrame:
    """Rows ``(qid, doc_id)``: documents holding any word of the query.

    Both sides are normalised as English, whatever the documents' language. With
    ``limit`` each query keeps its first documents by id. With a (stored)
    ``index`` of the field, built without a language column and stemmed as
    ``stem`` says, its postings are read and no document is.
    """
    terms = analyze_queries(queries, "en", stem, clean=True).select("qid", "term")
    terms = materialize(terms, "query")
    if index is None:
        tokens = analyze_documents(df, id_col, [field], None, stem)
        # Words nobody asks for go first, and a word counts once for a document.
        asked = lookup_join(tokens, terms.select("term").distinct(), ["term"], "left_semi")
        held = asked.select("doc_id", "term")
        held = held.distinct() if limit is None else held
    else:
        held = narrow(index, terms).postings.select("doc_id", "term")
    if limit is not None:
        # A query's first documents are among the first of each of its terms: no more are paired.
        if limit <= 0:
            raise ValueError("k must be positive")
        place = F.dense_rank().over(Window.partitionBy("term").orderBy("doc_id"))
        held = held.withColumn("_place", place).where(F.col("_place") <= limit).drop("_place")
    found = lookup_join(held, terms, ["term"], salt_by=["doc_id"]).select("qid", "doc_id")
    if limit is None:
        return found.distinct()
    return top_k(found.distinct(), limit, order=[F.col("doc_id").asc()]).select("qid", "doc_id")


def with_corpus(
    df: DataFrame,
    n: int | None,
    id_col: str = "doc_id",
    **options,
) -> Index:
    """Index of the first n documents, N counted from that slice."""
    corpus = df if n is None else corpus_slice(df, n, id_col)
    return build_index(corpus, id_col, **options)
