"""Lines found in many documents, removed from all of them.

Normalised lines are hashed (128 bits), each document counts once for a hash,
and lines over the threshold are dropped by position. Only hashes and
positions are shuffled; a text meets its positions at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm.rows import KEY, attach, with_key
from simsearch.llm.texts import pieces
from simsearch.plans.storage import materialize


def line_key(line: str) -> bytes:
    """White space stripped from both ends, A-Z in lower case."""
    return line.encode().strip().lower()


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        rows = zip(batch.column("_k1").to_pylist(), batch.column("_k2").to_pylist(),
                   batch.column("text").to_pylist())
        out: dict[str, list] = {c: [] for c in ("_k1", "_k2", "position", "hash", "first")}
        for k1, k2, text in rows:
            seen: set[bytes] = set()
            for position, line in enumerate((text or "").split("\n")):
                key = line_key(line)
                if not key:
                    continue
                digest = hashlib.blake2b(key, digest_size=16).digest()
                for name, value in zip(out, (k1, k2, position, digest, digest not in seen)):
                    out[name].append(value)
                seen.add(digest)
        yield pa.RecordBatch.from_pydict({
            "_k1": pa.array(out["_k1"], pa.int64()), "_k2": pa.array(out["_k2"], pa.int64()),
            "position": pa.array(out["position"], pa.int32()),
            "hash": pa.array(out["hash"], pa.binary()), "first": pa.array(out["first"], pa.bool_()),
        })


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        kept, lines, gone = [], [], []
        for text, dropped in zip(
            batch.column("text").to_pylist(), batch.column("dropped").to_pylist()
        ):
            parts, out = (text or "").split("\n"), set(dropped or ())
            kept.append("\n".join([x for i, x in enumerate(parts) if i not in out]))
            lines.append(len(parts))
            gone.append(len(out))
        columns = {n: batch.column(n) for n in batch.schema.names if n not in ("text", "dropped")}
        yield pa.RecordBatch.from_pydict(columns | {
            "n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(gone, pa.int64()),
            "kept_text": pa.array(kept, pa.string()),
        })


def drop_common_lines(docs: DataFrame, threshold: int = 10) -> DataFrame:
    """Every row with the text that is left of it: doc_id, n_lines, n_dropped, kept_text.

    Reads ``doc_id, text``; other columns are ignored. Lines end at \\n; null and
    empty text is one empty line. A line's key is the line stripped of white
    space and with A-Z in lower case; an empty key is never dropped. A key found
    in at least ``threshold`` rows loses all its lines. Repeated rows count one
    by one. An empty table gives no rows.
    """
    texts = with_key(docs.select("doc_id", "text"))
    lines = materialize(
        texts.select(*KEY, "text").mapInArrow(
            _lines, "_k1 long, _k2 long, position int, hash binary, first boolean"
        ),
        "lines",
    )
    common = materialize(
        lines.where("first").groupBy("hash").count().where(F.col("count") >= threshold)
        .select("hash"),
        "common_lines",
    )
    dropped = (
        attach(lines.select("hash", "position", *KEY), common, ["hash"], "left_semi")
        .groupBy(*KEY).agg(F.collect_set("position").alias("dropped"))
    )
    dropped = materialize(dropped, "dropped_lines")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return attach(texts, dropped, KEY, "left").select("doc_id", "text", "dropped").mapInArrow(
        _rebuilt, f"doc_id {id_type}, n_lines long, n_dropped long, kept_text string"
    )
