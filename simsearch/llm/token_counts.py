"""Token counts: an exact histogram of encoded lengths that answers every context limit.

Documents are encoded whole, one pass over the text, and only their lengths are
shuffled, added up per length before that. Suffix sums over the histogram then
give, for any limit, how many documents and tokens lie beyond it, the quantile
it stands at and the tokens left when every document is cut there. The sums are
taken in two levels (blocks of lengths, lengths in a block), so no task orders
the whole histogram.
"""

from __future__ import annotations

import base64
import importlib.util
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simsearch.llm.texts import pieces
from simsearch.plans.storage import materialize

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCK = 128
# What the splitting pattern counts as white space. It makes one piece of a run of it,
# but for the last character of a run before other text, and fails on very long ones.
LONG_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")
_encodings: dict[str, object] = {}


def load_vocabulary(folder: str = TOKENIZERS, name: str = VOCABULARY) -> tuple[str, bytes, str]:
    """Name, ranks and splitting pattern of a public tokenizer, read on the driver.

    A vocabulary is a fixed file of about a megabyte; it travels with the tasks,
    so executors need no folder of their own.
    """
    spec = importlib.util.spec_from_file_location("public_tokenizers", f"{folder}/__init__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    with open(os.path.join(folder, name), "rb") as file:
        return name, file.read(), module.PATTERN


def _encoding(name: str, ranks: bytes, pattern: str):
    if name not in _encodings:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _encodings[name] = tiktoken.Encoding(
            name, pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
    return _encodings[name]


def encoded_length(encoding, text: str) -> int:
    """Tokens of a whole text; long runs of white space are encoded as the pieces they are."""
    total = at = 0
    for run in LONG_SPACES.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        total += len(encoding.encode_ordinary(text[at:run.start()]))
        total += len(encoding._encode_single_piece(text[run.start():end]))
        at = end
    return total + len(encoding.encode_ordinary(text[at:]))


def _lengths(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(*vocabulary.value)
        for batch in pieces(batches):
            found = [encoded_length(encoding, t) if t else 0 for t in batch.column("text").to_pylist()]
            columns = {n: batch.column(n) for n in batch.schema.names if n != "text"}
            yield pa.RecordBatch.from_pydict(columns | {"n_tokens": pa.array(found, pa.int64())})

    return run


def token_lengths(docs: DataFrame, keep: list[str], vocabulary=None) -> DataFrame:
    """``keep`` columns of every row and the tokens of its whole text; null and empty have none."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary or load_vocabulary())
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return docs.select(*keep, "text").mapInArrow(_lengths(sent), ", ".join([*fields, "n_tokens long"]))


def length_histogram(docs: DataFrame, vocabulary=None) -> DataFrame:
    """One row per length that occurs, with sums over all shorter and longer documents.

    Columns: n_tokens; documents, tokens (of that length); documents_at_least,
    tokens_at_least (that length or longer); quantile (share of documents of at
    most that length); truncated_tokens (tokens left when every document is cut
    at that length). Every row of ``docs`` counts, null texts with length 0; an
    empty table gives no rows.
    """
    counts = token_lengths(docs, [], vocabulary).groupBy("n_tokens").agg(
        F.count("*").alias("documents")
    )
    counts = materialize(counts.withColumn("tokens", F.col("n_tokens") * F.col("documents")), "lengths")
    return with_suffix_sums(counts)


def with_suffix_sums(counts: DataFrame) -> DataFrame:
    """The sums of ``length_histogram`` from rows (n_tokens, documents, tokens)."""
    blocked = counts.withColumn("_block", F.floor(F.col("n_tokens") / BLOCK))
    later = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # One row per BLOCK lengths: the longest document bounds this table.
    blocks = blocked.groupBy("_block").agg(
        F.sum("documents").alias("_d"), F.sum("tokens").alias("_t")
    )
    blocks = blocks.select(
        "_block", F.coalesce(F.sum("_d").over(later), F.lit(0)).alias("_docs"),
        F.coalesce(F.sum("_t").over(later), F.lit(0)).alias("_tokens"),
    )
    own = Window.partitionBy("_block").orderBy(F.col("n_tokens").desc())
    total = counts.agg(F.sum("documents").alias("_all"), F.sum("tokens").alias("_sum"))
    found = blocked.join(blocks, "_block").crossJoin(F.broadcast(total)).withColumns({
        "documents_at_least": F.sum("documents").over(own) + F.col("_docs"),
        "tokens_at_least": F.sum("tokens").over(own) + F.col("_tokens"),
    })
    return found.select(
        "n_tokens", "documents", "tokens", "documents_at_least", "tokens_at_least",
        ((F.col("_all") - F.col("documents_at_least") + F.col("documents")) / F.col("_all"))
        .alias("quantile"),
        (F.col("_sum") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("documents_at_least"))
        .alias("truncated_tokens"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: documents that fit, documents cut, tokens kept and tokens lost.

    Any limit can be asked for, also lengths that do not occur.
    """
    wanted = [F.lit(int(x)).cast("long") for x in limits]
    if not wanted:
        raise ValueError("no limits given")
    asked = histogram.select("n_tokens", "documents", "tokens", F.explode(F.array(*wanted)).alias("limit"))
    fits = F.col("n_tokens") <= F.col("limit")
    kept = F.when(fits, F.col("tokens")).otherwise(F.col("limit") * F.col("documents"))
    return asked.groupBy("limit").agg(
        F.sum(F.when(fits, F.col("documents")).otherwise(0)).alias("documents_fit"),
        F.sum(F.when(fits, 0).otherwise(F.col("documents"))).alias("documents_cut"),
        F.sum(kept).alias("tokens_kept"),
        F.sum(F.col("tokens") - kept).alias("tokens_lost"),
    )
