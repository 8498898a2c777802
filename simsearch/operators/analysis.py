"""From documents and queries to terms."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.functions.stemming import stem as stem_column
from simsearch.functions.stopwords import is_stopword
from simsearch.functions.text import (
    concat_text,
    language_name,
    resolve_language,
    tokenize,
    word_tokens,
)
from simsearch.plans.joins import lookup_join
from simsearch.plans.storage import balanced, dealt, materialize


def document_tokens(
    df: DataFrame,
    id_col: str = "doc_id",
    text_cols: Iterable[str] = ("text",),
    lang_col: str | None = "lang",
    by_id: bool = False,
) -> DataFrame:
    """Rows ``(doc_id, lang, token)``, one per occurrence, before stopwords.

    With ``by_id`` the texts are dealt to tasks by document first: their words take more
    than they do, and can then be counted by document without a shuffle.
    """
    language = resolve_language(F.col(lang_col) if lang_col else F.lit(None).cast("string"))
    docs = concat_text(df, list(text_cols), "_text").select(
        F.col(id_col).cast("long").alias("doc_id"), language.alias("lang"), "_text"
    )
    return (dealt if by_id else balanced)(docs, "doc_id").select(
        "doc_id", "lang", F.explode(word_tokens(F.col("_text"))).alias("token")
    )


def remove_stopwords(
    tokens: DataFrame, lists: dict[str, Iterable[str]] | None = None
) -> DataFrame:
    """Drop tokens in the list of their own language."""
    return tokens.where(~is_stopword("token", "lang", lists))


def stem_vocabulary(
    tokens: DataFrame, languages: Iterable[str] | None = None
) -> DataFrame:
    """Dictionary ``(lang, token, stem)`` of the distinct tokens.

    The work grows with the vocabulary; the dictionary is written once, so that
    measuring and joining it does not stem again.
    """
    words = tokens.select("lang", "token").distinct()
    # Few bytes but long work: keep every core busy.
    words = words.repartition(tokens.sparkSession.sparkContext.defaultParallelism)
    stems = words.withColumn("stem", stem_column("token", "lang", languages))
    return materialize(stems, "stems")


def apply_stems(tokens: DataFrame, stems: DataFrame) -> DataFrame:
    """Replace ``lang, token`` by the ``term`` the dictionary gives."""
    rest = [c for c in tokens.columns if c not in ("lang", "token")]
    joined = lookup_join(tokens, stems, ["lang", "token"], salt_by=rest)
    return joined.select(*rest, F.col("stem").alias("term"))


def analyze_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_cols: Iterable[str] = ("text",),
    lang_col: str | None = "lang",
    stem: bool = True,
    stopword_lists: dict[str, Iterable[str]] | None = None,
    by_id: bool = False,
) -> DataFrame:
    """Rows ``(doc_id, term)``, one per occurrence of a term in a document; see ``document_tokens``."""
    tokens = remove_stopwords(
        document_tokens(df, id_col, text_cols, lang_col, by_id), stopword_lists
    )
    if not stem:
        return tokens.select("doc_id", F.col("token").alias("term"))
    return apply_stems(tokens, stem_vocabulary(tokens)).select("doc_id", "term")


def analyze_queries(
    queries: DataFrame,
    lang: str = "en",
    stem: bool = True,
    clean: bool = False,
    qid_col: str = "qid",
    text_col: str = "text",
    stopword_lists: dict[str, Iterable[str]] | None = None,
    few: bool = False,
) -> DataFrame:
    """Rows ``(qid, term, tf)`` in one language for all queries.

    Punctuation stays in query words unless ``clean`` is set, so ``"love,"`` is
    not the term ``love``. The words of a ``few`` queries are stemmed as they come,
    without a dictionary.
    """
    language = language_name(lang)
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = word_tokens(text) if clean else tokenize(F.lower(text))
    tokens = queries.select(
        F.col(qid_col).alias("qid"), F.lit(language).alias("lang"), F.explode(words).alias("token")
    )
    tokens = remove_stopwords(tokens, stopword_lists)
    counted = tokens.groupBy("qid", "lang", "token").agg(F.count("*").alias("tf"))
    if not stem:
        return counted.select("qid", F.col("token").alias("term"), "tf")
    if few:
        stemmed = counted.withColumn("term", stem_column("token", "lang", [language]))
    else:
        stemmed = apply_stems(counted, stem_vocabulary(counted, [language]))
    return stemmed.groupBy("qid", "term").agg(F.sum("tf").alias("tf"))
