"""Language identification by hyperdimensional profiles.

Every letter has a random vector of signs, derived from its code point. A
trigram's vector binds (multiplies) the vectors of its three letters, the first
and second rolled on by two places and one; a text's vector bundles (adds) those
of all its trigrams. A language's prototype bundles the vectors of its training
texts, and a text gets the language whose prototype has the largest cosine.

Letters are taken in lower case; all else is one space between words, and the
space has a vector too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm.texts import pieces

DIMENSIONS = 1024
# Trigrams turned into vectors at once, and texts' counts held at once.
_TRIGRAMS, _TEXTS = 2048, 256
_PIECE = 1 << 20
UNKNOWN = "und"
# Cosines of unrelated vectors spread by 1 / 32 around 0: three times that is hardly chance.
LEAST_SCORE = 3 / DIMENSIONS**0.5
# A text with fewer code points is too short to be told from chance.
JUDGED_CHARS = 40


class _Letters:
    """Which code points are letters, and their vectors; one per task."""

    def __init__(self, seed: int):
        self.seed = seed
        self.known = np.zeros(0x110000, np.int8)  # 0 not seen, 1 other, 2 letter
        self.vectors: dict[int, np.ndarray] = {}

    def spaced(self, points: np.ndarray) -> np.ndarray:
        """Code points with 0 for what is no letter."""
        state = self.known[points]
        if not state.all():
            for point in np.unique(points[state == 0]).tolist():
                self.known[point] = 2 if chr(point).isalpha() else 1
            state = self.known[points]
        return np.where(state == 2, points, 0)

    def vector(self, point: int) -> np.ndarray:
        found = self.vectors.get(point)
        if found is None:
            random = np.random.default_rng([self.seed, point])
            found = self.vectors[point] = random.integers(0, 2, DIMENSIONS, np.int8) * 2 - 1
        return found


def _trigrams(texts: list[str | None], letters: _Letters):
    """Row number and trigram number of every trigram, the trigrams' letters, and rows with letters."""
    # A line break cannot stand in for a letter, so it parts the texts.
    joined = "\n".join(["", *[(t or "").lower().replace("\n", " ") for t in texts], ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    row = np.cumsum(points == 10) - 1
    spaced = letters.spaced(points)
    keep = np.ones(len(points), bool)
    keep[1:] = (spaced[1:] != 0) | (spaced[:-1] != 0) | (points[1:] == 10)
    spaced, row = spaced[keep], row[keep]
    alphabet, code = np.unique(spaced, return_inverse=True)
    width = len(alphabet)
    same = row[:-2] == row[2:]
    # The break before a text counts as its first space, the next one ends it.
    same |= (spaced[2:] == 0) & (row[:-2] + 1 == row[2:]) & (row[1:-1] == row[:-2])
    triple = (code[:-2] * width + code[1:-1]) * width + code[2:]
    same &= (spaced[:-2] != 0) | (spaced[1:-1] != 0)
    used, number = np.unique(triple[same], return_inverse=True)
    shape = np.stack([used // (width * width), used // width % width, used % width])
    has = np.zeros(len(texts), bool)
    has[row[:len(spaced)][spaced != 0]] = True
    return row[:-2][same], number, alphabet[shape], has


def _vectors(shape: np.ndarray, letters: _Letters) -> np.ndarray:
    alphabet, code = np.unique(shape, return_inverse=True)
    code = code.reshape(shape.shape)
    table = np.stack([letters.vector(p) for p in alphabet.tolist()])
    first, second = np.roll(table, 2, axis=1), np.roll(table, 1, axis=1)
    return (first[code[0]] * second[code[1]] * table[code[2]]).astype(np.float32)


def text_vectors(texts: list[str | None], letters: _Letters) -> tuple[np.ndarray, np.ndarray]:
    """Bundled trigram vectors of the texts, and which of them have letters."""
    row, number, shape, has = _trigrams(texts, letters)
    bundled = np.zeros((len(texts), DIMENSIONS), np.float32)
    for start in range(0, shape.shape[1], _TRIGRAMS):
        size = min(_TRIGRAMS, shape.shape[1] - start)
        part = (number >= start) & (number < start + size) if size < shape.shape[1] else slice(None)
        counts = np.bincount(row[part] * size + number[part] - start, minlength=len(texts) * size)
        counts = counts.reshape(len(texts), size).astype(np.float32)
        bundled += counts @ _vectors(shape[:, start:start + size], letters)
    return bundled, has


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.sqrt((vectors * vectors).sum(axis=-1, keepdims=True))
    return vectors / np.where(length > 0, length, 1)


def _parts(batches):
    for batch in pieces(batches, limit=_PIECE):
        for start in range(0, batch.num_rows, _TEXTS):
            yield batch.slice(start, _TEXTS)


def _learn(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = _Letters(seed), {}
        for batch in _parts(batches):
            langs = batch.column("lang").to_pylist()
            bundled, _ = text_vectors(batch.column("text").to_pylist(), letters)
            unit = _unit(bundled)
            for lang in set(langs):
                own = unit[[i for i, x in enumerate(langs) if x == lang]].sum(axis=0, dtype=np.float64)
                sums[lang] = sums.get(lang, 0) + own
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array(list(sums), pa.string()),
            "profile": pa.array(list(sums.values()), pa.list_(pa.float64())),
        })

    return run


def learn_profiles(labelled: DataFrame, seed: int = 5) -> dict[str, np.ndarray]:
    """Prototype of every language in ``labelled`` (text, lang), each text with equal weight.

    All rows are learnt from; each task adds up its own, so what reaches the
    driver is one vector of 1024 numbers per language (languages, not rows,
    bound it). Rows with a null lang are left out.
    """
    sums = (
        labelled.where("lang is not null").select("text", "lang")
        .mapInArrow(_learn(seed), "lang string, profile array<double>")
        .select("lang", F.posexplode("profile"))
        .groupBy("lang", "pos").agg(F.sum("col").alias("v"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("p"))
        .select("lang", "p.v").collect()
    )
    return {r["lang"]: _unit(np.array(r["v"])) for r in sorted(sums)}


def _predict(names: list[str], table: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _Letters(seed)
        for batch in _parts(batches):
            bundled, has = text_vectors(batch.column("text").to_pylist(), letters)
            if names:
                cosine = _unit(bundled) @ table.T.astype(np.float32)
                best = cosine.argmax(axis=1)
                score = np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(np.float64)
            else:
                best, score = np.zeros(len(has), int), np.zeros(len(has))
            found = [names[b] if h and names else UNKNOWN for b, h in zip(best.tolist(), has.tolist())]
            columns = {n: batch.column(n) for n in batch.schema.names if n != "text"}
            yield pa.RecordBatch.from_pydict(columns | {
                "lang_pred": pa.array(found, pa.string()),
                "score": pa.array(np.where(has, score, 0.0)),
            })

    return run


def _ordered(profiles: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray]:
    names = sorted(profiles)
    return names, np.stack([profiles[n] for n in names]) if names else np.zeros((0, DIMENSIONS))


def predict_language(
    docs: DataFrame, profiles: dict[str, np.ndarray], keep: list[str], seed: int = 5
) -> DataFrame:
    """``keep`` columns of every row, its language and the cosine with that language's prototype.

    Only ``text`` is looked at. A text that is null, empty or without letters is
    ``und`` with score 0, as is every text if there are no profiles.
    """
    names, table = _ordered(profiles)
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return docs.select(*keep, "text").mapInArrow(
        _predict(names, table, seed), ", ".join([*fields, "lang_pred string, score double"])
    )


def _known(names: list[str], table: np.ndarray, seed: int, accepted: frozenset[str] | None, least: float):
    predict = _predict(names, table, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keep = []
            lengths = [len(t or "") for t in batch.column("text").to_pylist()]
            for part in predict(iter([batch.select(["text"])])):
                langs, scores = (part.column(c).to_pylist() for c in ("lang_pred", "score"))
                for lang, score in zip(langs, scores):
                    sure = score >= least or lengths[len(keep)] < JUDGED_CHARS
                    keep.append(lang != UNKNOWN and sure and (accepted is None or lang in accepted))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def keep_known(
    docs: DataFrame, profiles: dict[str, np.ndarray], accepted: list[str] | None = None, seed: int = 5,
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or not among ``accepted`` (null: any).

    A text of JUDGED_CHARS code points or more goes too if its cosine with every
    prototype is under ``least_score``: it is in none of the languages. All columns
    stay as they are, whatever their names; only ``text`` is looked at. Without
    profiles whatever has letters stays; an empty table stays empty.
    """
    if not profiles:
        profiles, least_score = {"": np.zeros(DIMENSIONS)}, 0.0
    names, table = _ordered(profiles)
    wanted = None if accepted is None else frozenset(accepted)
    return docs.mapInArrow(_known(names, table, seed, wanted, least_score), docs.schema)
