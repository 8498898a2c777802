"""Benchmark decontamination: BM25 over an inverted index of the test items, with block-max WAND.

Every training document is cut into overlapping passages, and each passage is a
query against the items. An item's score is taken as a share of the score it
gets from its own text, and all items above a threshold are retrieved: items lie
in blocks, each term has its largest impact per block, and a block is opened for
a passage only if it holds a term without which no item there can reach the
threshold, and if the passage's impacts in that block add up to it. What is
retrieved is verified word by word, for the question and the answer alike.

The items are the stated query set: they are taken in chunks of a bounded size,
each made into an index and sent to all tasks; documents are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm.rows import KEY, attach, running, with_key, without
from simsearch.llm.texts import list_column, pieces
from simsearch.llm.words import Words
from simsearch.plans.storage import materialize

# The usual constants of BM25.
K1, B = 1.2, 0.75
RETRIEVE = 0.5  # share of an item's own score
VERIFY, SHINGLE = 0.8, 5  # share of words within common runs of five
BLOCK_ITEMS = 16
CHUNK_BYTES = 8 << 20
# Words are runs of letters and digits: all other ASCII characters separate them.
SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_SENTENCE = re.compile(r"[.!?\n]+")


def _words(column: pa.Array) -> Words:
    return Words(pc.utf8_lower(column.cast(pa.large_string())), separators=SEPARATORS)


def _answer_start(text: str, count: int) -> int:
    """Word at which the answer begins: the last sentence, of five words at least if there are ten."""
    parts = [p for p in _SENTENCE.split(text) if len(_words(pa.array([p])))]
    last = len(_words(pa.array([parts[-1]]))) if parts else 0
    if count < 2 * SHINGLE:
        return 0
    return count - min(max(last, SHINGLE), count - SHINGLE)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct terms of each item, and its number of words."""
    for batch in pieces(batches):
        words = _words(batch.column("text"))
        hashes, out = words.hashes(), []
        for a, b in zip(words.first[:-1], words.first[1:]):
            out.append(np.unique(hashes[a:b]).view(np.int64))
        counts = np.array([len(x) for x in out], np.int64)
        yield pa.RecordBatch.from_pydict({
            "term": list_column(np.concatenate(out), counts), "length": pa.array(words.counts),
        })


class Index:
    """Inverted index of one chunk of items, impacts as shares of each item's own score."""

    def __init__(self, items: list[tuple], df: dict[int, int], total: int, mean: float):
        self.ids = [i for i, _ in items]
        words = _words(pa.array([t for _, t in items], pa.large_string()))
        hashes = words.hashes()
        self.hashes = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        self.answer = [_answer_start(t or "", len(h)) for (_, t), h in zip(items, self.hashes)]
        self.longest = int(max(words.counts, default=1))
        self.terms, number = np.unique(hashes, return_inverse=True)
        pair, tf = np.unique(words.rows * max(1, len(self.terms)) + number, return_counts=True)
        item, term = pair // max(1, len(self.terms)), pair % max(1, len(self.terms))
        found = np.array([df[t] for t in self.terms.view(np.int64).tolist()], float)
        idf = np.log(1 + (total - found + 0.5) / (found + 0.5))
        norm = K1 * (1 - B + B * words.counts / max(mean, 1e-9))
        impact = idf[term] * tf * (K1 + 1) / (tf + norm[item])
        impact /= np.bincount(item, impact, len(items))[item]

        self.blocks = max(1, -(-len(items) // BLOCK_ITEMS))
        key = term * self.blocks + item // BLOCK_ITEMS
        order = np.argsort(key, kind="stable")
        self.item, self.impact = item[order], impact[order]
        # Only cells that occur: a term is in few blocks.
        self.cells, first = np.unique(key[order], return_index=True)
        self.start = np.append(first, len(order))
        self.block_max = np.maximum.reduceat(self.impact, first) if len(order) else np.zeros(0)

        # An item's commonest terms that together stay below the threshold are not essential:
        # whatever reaches the threshold holds one of the others.
        order = np.lexsort((idf[term], item))
        sums = np.cumsum(impact[order])
        first = np.searchsorted(item[order], np.arange(len(items) + 1))
        before = np.concatenate([[0.0], sums])[first[:-1]]
        essential = sums - before[item[order]] >= RETRIEVE - 1e-9
        opens = np.unique(key[order][essential])
        self.open_block = opens % self.blocks
        self.open_start = np.searchsorted(opens // self.blocks, np.arange(len(self.terms) + 1))

    def cell(self, keys: np.ndarray) -> np.ndarray:
        """Place of each (term, block) among the cells, -1 for one without postings."""
        at = np.minimum(np.searchsorted(self.cells, keys), max(0, len(self.cells) - 1))
        return np.where(self.cells[at] == keys, at, -1) if len(self.cells) else np.full(len(keys), -1)

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Term number of each word, -1 for what no item holds."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)


def _expand(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges starts..ends: the range each element belongs to, and the elements."""
    counts = ends - starts
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, starts[owner] + inside


def retrieve(index: Index, words: Words, hashes: np.ndarray):
    """(row, item, score) of every passage and item that reach the threshold, best passage first."""
    step = index.longest
    number = index.number(hashes)
    at = np.flatnonzero(number >= 0)
    rows = np.searchsorted(words.first, at, "right") - 1
    passages = np.maximum(1, -(-words.counts // step) - 1)
    base = np.cumsum(passages) - passages
    window = (at - words.first[rows]) // step
    last = np.minimum(window, passages[rows] - 1)
    early = np.maximum(window - 1, 0)
    term = number[at]
    both = early < last  # a word lies in two passages, but for the ends
    term = np.concatenate([term, term[both]])
    passage = np.concatenate([base[rows] + last, (base[rows] + early)[both]])

    opening = index.open_start[term + 1] > index.open_start[term]
    owner, block = _expand(index.open_start[term[opening]], index.open_start[term[opening] + 1])
    pairs = np.unique(passage[opening][owner] * index.blocks + index.open_block[block])
    if not len(pairs):
        return np.zeros((0,), int), np.zeros((0,), int), np.zeros((0,))
    asked, block = pairs // index.blocks, pairs % index.blocks

    wanted = np.isin(passage, asked)
    held = np.unique(passage[wanted] * len(index.terms) + term[wanted])
    held_passage, held_term = held // len(index.terms), held % len(index.terms)
    owner, place = _expand(
        np.searchsorted(held_passage, asked), np.searchsorted(held_passage, asked, "right")
    )
    cell = index.cell(held_term[place] * index.blocks + block[owner])
    owner, cell = owner[cell >= 0], cell[cell >= 0]
    bound = np.bincount(owner, index.block_max[cell], len(pairs))
    keep = bound >= RETRIEVE - 1e-9
    owner, cell = owner[keep[owner]], cell[keep[owner]]
    posting_owner, posting = _expand(index.start[cell], index.start[cell + 1])
    owner = owner[posting_owner]
    scored = np.bincount(
        owner * BLOCK_ITEMS + index.item[posting] % BLOCK_ITEMS, index.impact[posting],
        len(pairs) * BLOCK_ITEMS,
    )
    hit = np.flatnonzero(scored >= RETRIEVE - 1e-9)
    row = np.searchsorted(base, asked[hit // BLOCK_ITEMS], "right") - 1
    item = block[hit // BLOCK_ITEMS] * BLOCK_ITEMS + hit % BLOCK_ITEMS
    order = np.lexsort((-scored[hit], item, row))
    row, item, score = row[order], item[order], scored[hit][order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
    return row[new], item[new], score[new]


def overlap(item: np.ndarray, answer: int, document: np.ndarray) -> tuple[float, float]:
    """Shares of the question's and the answer's words within runs of five that the document has."""
    length = min(SHINGLE, len(item))
    if not length or len(document) < length:
        return 0.0, 0.0
    runs = {document[i:i + length].tobytes() for i in
            np.flatnonzero(np.isin(document[:len(document) - length + 1], item))}
    covered = np.zeros(len(item), bool)
    for i in range(len(item) - length + 1):
        if item[i:i + length].tobytes() in runs:
            covered[i:i + length] = True
    question = covered[:answer] if answer else covered
    return float(question.mean()), float(covered[answer:].mean())


def _search(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in pieces(batches):
            words = _words(batch.column("text"))
            hashes = words.hashes()
            out = []
            for row, item, score in zip(*(x.tolist() for x in retrieve(index, words, hashes))):
                own = hashes[words.first[row]:words.first[row + 1]]
                question, answer = overlap(index.hashes[item], index.answer[item], own)
                if question >= VERIFY and answer >= VERIFY:
                    out.append((row, index.ids[item], score, question, answer))
            rows, ids, scores, questions, answers = zip(*out) if out else ((),) * 5
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "_k1": batch.column("_k1").take(taken), "_k2": batch.column("_k2").take(taken),
                "doc_id": batch.column("doc_id").take(taken), "_item": pa.array(ids, pa.int64()),
                "score": pa.array(scores, pa.float64()),
                "question_overlap": pa.array(questions, pa.float64()),
                "answer_overlap": pa.array(answers, pa.float64()),
            })

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item whose question and answer it contains.

    Reads ``doc_id, text`` and ``item_id, text``. Columns: the row key, doc_id,
    item_id, score (best passage's BM25 as a share of the item's own) and the two
    overlaps. Letters count in lower case. Null and empty texts, and items
    without words, are in no row; repeated rows (on either side) give repeated
    rows. No documents or no items give no rows.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        "item_id", F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("_item", F.monotonically_increasing_id())
    items = materialize(items.withColumn("_bytes", F.octet_length("text") + 1), "items")
    items = running(items, ["_item"], {"_before": "_bytes"})
    items = materialize(
        items.withColumn("_chunk", F.floor(F.col("_before") / CHUNK_BYTES).cast("int")), "items"
    )
    terms = items.select("text").mapInArrow(_terms, "term array<long>, length long")
    total, mean = terms.agg(F.count("*"), F.avg("length")).first()
    frequency = materialize(
        terms.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df")),
        "terms",
    )
    texts = with_key(docs.select("doc_id", "text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    fields = (
        f"_k1 long, _k2 long, doc_id {id_type}, _item long, score double, "
        "question_overlap double, answer_overlap double"
    )
    hits = spark.createDataFrame([], fields)
    chunks = (items.agg(F.max("_chunk")).first()[0] or 0) + 1 if total else 0
    for chunk in range(chunks):
        own = items.where(F.col("_chunk") == chunk)
        held = [tuple(r) for r in own.select("_item", "text").orderBy("_item").collect()]
        if not held:
            continue
        mine = own.select("text").mapInArrow(_terms, "term array<long>, length long")
        mine = mine.select(F.explode("term").alias("term")).distinct()
        df = dict(map(tuple, frequency.join(mine, "term", "left_semi").collect()))
        # One index at a time: its hits are written before the next is built.
        sent = spark.sparkContext.broadcast(Index(held, df, total, mean or 0.0))
        found = materialize(texts.mapInArrow(_search(sent), fields), "hits")
        sent.destroy()
        hits = hits.unionByName(found)
    return attach(hits, items.select("_item", "item_id"), ["_item"], "inner").select(
        *KEY, "doc_id", "item_id", "score", "question_overlap", "answer_overlap"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain a benchmark item."""
    return without(docs, contaminated(docs, benchmark))
