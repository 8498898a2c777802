import random

import pytest

SYLLABLES = {
    "en": ["the", "ing", "and", "er", "th", "on", "ly", "sh"],
    "de": ["ung", "ein", "sch", "ver", "keit", "en", "ch", "zu"],
    "es": ["ción", "os", "ado", "ñ", "mente", "que", "rr", "ja"],
}


def prose(seed, words, lang="en"):
    """Invented prose: words of one to three syllables, some commas and full stops."""
    rng = random.Random(f"{seed}-{lang}")
    out = []
    for _ in range(words):
        word = "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3)))
        out.append(word + rng.choice(["", "", "", "", ",", "."]))
    return " ".join(out)


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def messy_rows():
    """Rows with every kind of trouble: doc_id, text, lang, source and clashing columns."""
    shared = prose(99, 60)
    texts = [
        (1, prose(1, 300), "en", "b"), (2, prose(1, 300), "en", "b"), (3, prose(3, 120, "de"), "de", "a"),
        (4, None, None, None), (5, "", "en", ""), (6, " \t\n\x0b ", "en", "a"),
        (7, "one two", "en", "a"), (8, "one  two", "en", "c"), (9, "solo", None, "c"),
        (None, prose(10, 80), "en", "c"), (None, prose(11, 80), "en", None),
        (12, prose(12, 50, "es"), "es", "b"), (12, prose(13, 50, "es"), "es", "b"),
        (14, prose(14, 40), "en", "a"), (14, prose(14, 40), "en", "a"),
        (15, prose(15, 30_000), "en", "a"), (16, "St " * 400 + "end", "en", "b"),
        (17, prose(17, 40) + "\n" + shared, "en", "b"), (18, shared + "\n" + prose(18, 50), "en", "c"),
        (19, "x" * 20_000, "en", "c"), (20, "1234 !! 5", "de", "c"), (21, "ÉÑ ß œ 日本語", "es", "c"),
        (-5, prose(3, 120, "de").upper(), "de", "a"),
    ]
    return [(d, t, la, s, len(t or ""), 7, "x", 1.5) for d, t, la, s in texts]


SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_k1 int, shard string, n double"
)


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
