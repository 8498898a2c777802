"""Text normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Language codes with a stopword list and a stemmer.
LANGUAGES = {
    "es": "spanish",
    "en": "english",
    "fr": "french",
    "de": "german",
    "it": "italian",
}
DEFAULT_LANGUAGE = "english"

# The characters of a word, and all others. The others are listed
# rather than negated, which the JVM matches several times faster.
WORD = "[a-zA-Z0-9_À-ÿ]"
NON_WORD = r"[\x00-/:-@\[-^`{-\xbf\x{100}-\x{10ffff}]"

# Whitespace in the Unicode sense, and the four ASCII separators.
_WHITESPACE = "(?U)[\\s\\x1c-\\x1f]+"


def language_name(code: str | None) -> str:
    return LANGUAGES.get(code or "", DEFAULT_LANGUAGE)


def concat_text(df: DataFrame, cols: list[str], out: str = "text") -> DataFrame:
    """Join columns with one space; a null or non-string column counts as empty."""
    strings = {name for name, kind in df.dtypes if kind == "string"}
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    parts = [F.coalesce(F.col(c), F.lit("")) if c in strings else F.lit("") for c in cols]
    return df.withColumn(out, F.concat_ws(" ", *parts))


def clean_text(text: Column) -> Column:
    """Lower-case, then blank every character outside Latin-1 words."""
    return F.regexp_replace(F.lower(text), NON_WORD, " ")


def word_tokens(text: Column) -> Column:
    """The words of cleaned text in one pass: ``tokenize(clean_text(text))``."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD + "+"), 0)


def resolve_language(code: Column) -> Column:
    pairs = [F.lit(v) for item in LANGUAGES.items() for v in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), code), F.lit(DEFAULT_LANGUAGE))


def tokenize(text: Column) -> Column:
    """Words between whitespace, without empty ones; no text gives no words."""
    words = F.split(F.coalesce(text, F.lit("")), _WHITESPACE)
    return F.filter(words, lambda w: w != "")
