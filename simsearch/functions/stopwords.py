"""Stopword lists by language, and the test against them."""

from __future__ import annotations

import functools
import os
import zipfile
from collections.abc import Iterable

import pyspark
from pyspark import SparkContext
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from simsearch.functions.text import LANGUAGES

# How the customary English list differs from the one in Spark.
ENGLISH_ADDED = """
    d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn
    shan shouldn wasn weren won wouldn that'll should've mightn't needn't
""".split()
ENGLISH_REMOVED = """
    i'll he'll she'll we'll they'll i'd he'd she'd we'd they'd i'm he's we're they're i've
    we've they've can't here's how's let's that's there's what's when's where's who's why's
    cannot could ought would
""".split()


def _from_spark(language: str) -> list[str]:
    if SparkContext._active_spark_context is not None:
        return StopWordsRemover.loadDefaultStopWords(language)
    # The same resource, for callers that only need the words and run no session.
    jars = os.path.join(os.path.dirname(pyspark.__file__), "jars")
    jar = next(n for n in os.listdir(jars) if n.startswith("spark-mllib_"))
    with zipfile.ZipFile(os.path.join(jars, jar)) as z:
        name = f"org/apache/spark/ml/feature/stopwords/{language}.txt"
        return z.read(name).decode("utf-8").split()


@functools.lru_cache(maxsize=None)
def stopwords(language: str) -> tuple[str, ...]:
    if language not in LANGUAGES.values():
        raise ValueError(f"no stopwords for language: {language}")
    words = set(_from_spark(language))
    if language == "english":
        words = (words - set(ENGLISH_REMOVED)) | set(ENGLISH_ADDED)
    return tuple(sorted(words))


def sql_list(words: Iterable[str]) -> str:
    quoted = (w.replace("\\", "\\\\").replace("'", "\\'") for w in words)
    return ", ".join(f"'{w}'" for w in quoted)


def is_stopword(
    token: str, language: str, lists: dict[str, Iterable[str]] | None = None
) -> Column:
    """Whether the column ``token`` is in the list of its own row's ``language``.

    The lists are literals, so the test is a hash lookup inside the scan stage.
    """
    if lists is None:
        lists = {name: stopwords(name) for name in LANGUAGES.values()}
    tests = [
        f"({language} = '{name}' AND {token} IN ({sql_list(words)}))"
        for name, words in lists.items() if words
    ]
    return F.expr(" OR ".join(tests) or "false")
