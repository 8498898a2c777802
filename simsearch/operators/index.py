"""The inverted index as two tables: postings and term statistics."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simsearch.operators.analysis import (
    apply_stems,
    document_tokens,
    remove_stopwords,
    stem_vocabulary,
)
from simsearch.plans.joins import fits_broadcast, lookup_join
from simsearch.plans.storage import MOST_PARTS, materialize

# Width in ids of one stretch of a posting list. A list is split by document id,
# so a term found in every document still comes in pieces of at most this many.
BLOCK_SPAN = 4096
# Width in ids of the blocks whose greatest term frequencies are kept with a stored index.
MAXIMA_SPAN = 256
# Postings of which a task takes the block maxima.
MAXIMA_ROWS = 1_000_000


@dataclass(frozen=True)
class Index:
    """``postings (term, doc_id, tf)``, ``terms (term, df, tf_square)`` and N.

    ``blocks (term, block, n, max_tf)``, if there, has the postings of each term by
    blocks of ``span`` ids and their greatest term frequency.
    """

    postings: DataFrame
    terms: DataFrame
    n_docs: int
    blocks: DataFrame | None = None
    span: int = MAXIMA_SPAN


def tf_weight(tf: Column) -> Column:
    return F.log10(tf + F.lit(1.0))


def term_frequencies(tokens: DataFrame) -> DataFrame:
    """Rows ``(term, doc_id, tf)`` from ``(doc_id, term)``."""
    return tokens.groupBy("term", "doc_id").agg(F.count("*").alias("tf"))


def document_frequencies(postings: DataFrame) -> DataFrame:
    """Rows ``(term, df)``: the documents each term occurs in."""
    return postings.groupBy("term").agg(F.count("*").alias("df"))


def term_statistics(postings: DataFrame) -> DataFrame:
    """``df`` and the sum of squared tf weights, which the score norm needs."""
    square = tf_weight(F.col("tf")) * tf_weight(F.col("tf"))
    return postings.groupBy("term").agg(
        F.count("*").alias("df"), F.sum(square).alias("tf_square")
    )


def block_of(span: int) -> Column:
    """Number of the block of ``span`` ids that ``doc_id`` is in."""
    return F.expr(f"(doc_id - pmod(doc_id, {int(span)})) div {int(span)}")


def block_maxima(postings: DataFrame, span: int = MAXIMA_SPAN) -> DataFrame:
    """Rows ``(term, block, n, max_tf)``: what bounds the scores of a block before it is read."""
    # Ranges of term and block come in the order in which they are written, and shuffled once.
    # Their rows, not their bytes, fill the memory of a task: these are few by row.
    tasks = max(1, min(MOST_PARTS, math.ceil(postings.count() / MAXIMA_ROWS)))
    ranged = postings.select("term", block_of(span).alias("block"), "tf")
    ranged = ranged.repartitionByRange(tasks, "term", "block")
    return ranged.groupBy("term", "block").agg(F.count("*").alias("n"), F.max("tf").alias("max_tf"))


def posting_lists(postings: DataFrame, span: int = BLOCK_SPAN) -> DataFrame:
    """Rows ``(term, block, postings)``: ordered lists, split by document id."""
    return postings.groupBy("term", block_of(span).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")
    )


def sorted_index(postings: DataFrame) -> DataFrame:
    """Postings in term order over the whole table, documents ascending."""
    return postings.orderBy("term", "doc_id")


def merge_postings(*parts: DataFrame) -> DataFrame:
    """Postings of several partial indexes; a document seen twice counts once."""
    if not parts:
        raise ValueError("no indexes to merge")
    rows = functools.reduce(DataFrame.unionByName, parts)
    return rows.groupBy("term", "doc_id").agg(F.sum("tf").cast("long").alias("tf"))


def merge_indexes(*indexes: Index) -> Index:
    """Merge indexes; a document that several of them hold is one document.

    Such documents are told by their postings, so one without any term must not
    be counted by two parts.
    """
    postings = materialize(merge_postings(*[i.postings for i in indexes]), "merged")
    held = sum(i.postings.select("doc_id").distinct().count() for i in indexes)
    repeated = held - postings.select("doc_id").distinct().count()
    n_docs = sum(i.n_docs for i in indexes) - repeated
    return Index(postings, term_statistics(postings), n_docs)


def build_index(
    df: DataFrame,
    id_col: str = "doc_id",
    text_cols: Iterable[str] = ("text",),
    lang_col: str | None = "lang",
    stem: bool = True,
    stopword_lists: dict[str, Iterable[str]] | None = None,
    vocabulary: DataFrame | None = None,
) -> Index:
    """Index of a table of documents, N being all its rows.

    With ``vocabulary`` (a column ``term``) only those terms are indexed: enough
    to answer the queries they come from, and far less to shuffle. Postings
    are written once, as the statistics and whatever else read them.
    """
    by_id = vocabulary is None and not stem
    tokens = remove_stopwords(
        document_tokens(df, id_col, text_cols, lang_col, by_id), stopword_lists
    )
    if vocabulary is not None:
        return _partial_index(tokens, vocabulary, stem, df.count())
    if stem:
        # Counted once and written, so that the text is read once: dictionary and postings use it.
        counted = materialize(
            tokens.groupBy("lang", "token", "doc_id").agg(F.count("*").alias("tf")), "counted"
        )
        stemmed = apply_stems(counted, stem_vocabulary(counted))
        postings = stemmed.groupBy("term", "doc_id").agg(F.sum("tf").alias("tf"))
    else:
        counted = term_frequencies(tokens.select("doc_id", F.col("token").alias("term")))
        postings = materialize(counted, "postings")
    return Index(postings, term_statistics(postings), df.count())


def _partial_index(
    tokens: DataFrame, vocabulary: DataFrame, stem: bool, n_docs: int
) -> Index:
    wanted = vocabulary.select("term").distinct()
    if stem:
        dictionary = stem_vocabulary(tokens)
        wanted = lookup_join(
            dictionary, wanted.withColumnRenamed("term", "stem"), ["stem"], "left_semi"
        )
        kept = apply_stems(tokens, wanted)
    else:
        kept = lookup_join(
            tokens.select("doc_id", F.col("token").alias("term")), wanted, ["term"],
            "left_semi", ["doc_id"],
        )
    postings = materialize(term_frequencies(kept), "postings")
    return Index(postings, term_statistics(postings), n_docs)


# --- Text form ---------------------------------------------------------------


def format_postings(postings: DataFrame, span: int = BLOCK_SPAN) -> DataFrame:
    """Lines ``term (DF: n): (doc, tf), (doc, tf)`` as rows ``(term, block, line)``.

    A list longer than one block goes over several lines, each with the term's
    full document frequency.
    """
    postings = materialize(postings, "postings")
    lists = posting_lists(postings, span)
    pairs = F.transform(
        "postings",
        lambda p: F.concat(F.lit("("), p["doc_id"], F.lit(", "), p["tf"], F.lit(")")),
    )
    listed = lists.select("term", "block", F.concat_ws(", ", pairs).alias("pairs"))
    frequencies = materialize(document_frequencies(postings), "frequencies")
    small = fits_broadcast(frequencies)
    # A shuffled join reads its larger side twice.
    listed = listed if small else materialize(listed, "listed")
    whole = lookup_join(listed, frequencies, ["term"], salt_by=["block"], broadcast=small)
    return whole.select(
        "term", "block",
        F.concat("term", F.lit(" (DF: "), "df", F.lit("): "), "pairs").alias("line"),
    )


# The shape of one index line and of its list, pairs put as '#'.
LINE = r"^(.+?) \(DF: (\d+)\): (.+)$"
PAIR = r"\((-?\d+), (\d+)\)"
PAIRS = "^#(?:, #)*$"


def parse_postings(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Rows ``(term, df, doc_id, tf)``; a malformed line is an error naming it.

    Ids may be negative or have leading zeros; a number beyond 64 bits is an error.
    """
    parts = lines.select(F.trim(F.col(line_col)).alias("_line")).select(
        "_line",
        F.regexp_extract("_line", LINE, 1).alias("term"),
        F.regexp_extract("_line", LINE, 2).alias("_df"),
        F.regexp_extract("_line", LINE, 3).alias("_pairs"),
    )
    malformed = F.raise_error(
        F.concat(F.lit("malformed index line: "), F.coalesce("_line", F.lit("null")))
    )

    def numbers(group: int):
        found = F.regexp_extract_all("_pairs", F.lit(PAIR), F.lit(group))
        return F.transform(found, lambda x: x.try_cast("bigint"))

    df = F.col("_df").try_cast("bigint")
    pairs = F.arrays_zip(numbers(1).alias("doc_id"), numbers(2).alias("tf"))
    small = df.isNotNull() & ~F.exists(
        pairs, lambda p: p["doc_id"].isNull() | p["tf"].isNull()
    )
    valid = F.regexp_replace("_pairs", PAIR, "#").rlike(PAIRS) & small
    checked = F.when(valid, pairs).otherwise(malformed.cast("array<struct<doc_id:bigint,tf:bigint>>"))
    return parts.select("term", df.alias("df"), F.explode(checked).alias("_pair")).select(
        "term", "df", "_pair.doc_id", "_pair.tf"
    )
