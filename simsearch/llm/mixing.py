"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents of a source are dealt by hash into blocks of about ``block_words``
words. A source's target becomes an exact quota of block draws; where it ends
inside a block, that block is drawn short. The quotas of all sources are split
among the output shards by a binary tree whose nodes draw from the multivariate
hypergeometric distribution, so every shard is a fair sample of the mix and no
quota is off by one. A shard then takes its own stretch of each source's
permuted blocks, and its documents are put in random order there.

Everything random follows from a seed and the documents, so reruns agree. The
tree works on counts of blocks; documents move once, when the mix is written.
One row per source (name, total, quota) must fit a task; documents need not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm.rows import attach, packed, running, with_key
from simsearch.plans.storage import materialize

WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2
BLOCK_WORDS, BLOCK_ROWS = 65_536, 4_096
SHARD_BLOCKS = 64
WORD = r"[^\x20\x09-\x0D]+"
ROW = ["_k1", "_k2"]


def sizes(docs: DataFrame) -> DataFrame:
    """Rows that agree in doc_id, text and source as one, with their words and number."""
    keyed = with_key(docs.select("doc_id", "text", "source"), ("doc_id", "text", "source"))
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    return (
        keyed.select(*ROW, "doc_id", "source", words.alias("size"))
        .groupBy(*ROW, "doc_id", "source", "size").agg(F.count("*").alias("copies"))
        .withColumn("words", F.col("size") * F.col("copies"))
    )


def targets(sized: DataFrame, weights=WEIGHTS, share=SHARE, limit=LIMIT) -> DataFrame:
    """Per source: number in code point order (null last), weight, size, rows, target.

    Targets share ``share`` times all words by weight and stop at ``limit`` times
    their source; what is over goes to the others by weight until none is above.
    """
    sources = sized.groupBy("source").agg(
        F.sum("words").alias("source_size"), F.sum("copies").alias("rows"),
        F.lit(1).alias("_one"),
    )
    order = [F.col("source").asc_nulls_last()]
    sources = running(sources, order, {"number": "_one"}).drop("_one")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = materialize(
        sources.withColumn("weight", cycle[(F.col("number") % len(weights)).cast("int")]),
        "sources",
    )
    cap = limit * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, None
    while True:  # Each round caps at least one more source, or ends.
        capped = cap <= level * F.col("weight")
        state = sources.agg(
            F.sum(F.when(capped, cap)).alias("fixed"), F.count_if(capped).alias("n"),
            F.sum(F.when(~capped, F.col("weight"))).alias("free"),
        ).first()
        if state["n"] == full or not state["free"]:
            break
        full = state["n"]
        level = (share * total - (state["fixed"] or 0)) / state["free"]
    return sources.withColumn(
        "target", F.least(cap.cast("double"), F.lit(level) * F.col("weight"))
    )


def _halve(shards, number, quota, start, seed):
    """Split one node's quotas between the lower and the upper half of its shards."""
    lower, upper = shards
    middle = (lower + upper) // 2
    total = int(quota.sum())
    take = total * (middle - lower) // (upper - lower)
    random = np.random.default_rng([seed, lower, upper])
    left = random.multivariate_hypergeometric(quota, take, method="marginals")
    return ((lower, middle), number, left, start), ((middle, upper), number, quota - left, start + left)


def _grow(seed: int, width: int):
    """Expand tree nodes until they cover at most ``width`` shards."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for node in frame.itertuples(index=False):
                stack = [((node.lower, node.upper), np.array(node.number, np.int64),
                          np.array(node.quota, np.int64), np.array(node.start, np.int64))]
                while stack:
                    shards, number, quota, start = stack.pop()
                    some = quota > 0
                    number, quota, start = number[some], quota[some], start[some]
                    if shards[1] - shards[0] > width:
                        stack += _halve(shards, number, quota, start, seed)
                    else:
                        yield pd.DataFrame({
                            "lower": [shards[0]], "upper": [shards[1]], "number": [number],
                            "quota": [quota], "start": [start],
                        })

    return run


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Per shard and source number, the stretch of the source's draws that is the shard's own."""
    columns = "lower long, upper long, number array<long>, quota array<long>, start array<long>"
    root = quotas.groupBy().agg(
        F.sort_array(F.collect_list(F.struct("number", "draws"))).alias("q")
    ).where("size(q) > 0").select(
        F.lit(0).cast("long").alias("lower"), F.lit(shards).cast("long").alias("upper"),
        F.col("q.number").alias("number"), F.col("q.draws").alias("quota"),
        F.expr("transform(q, x -> 0L)").alias("start"),
    )
    top = max(1, int(np.sqrt(shards)))
    nodes = root.mapInPandas(_grow(seed, top), columns)
    if top > 1:
        nodes = nodes.repartition("lower").mapInPandas(_grow(seed, 1), columns)
    leaf = nodes.select("lower", F.explode(F.arrays_zip("number", "quota", "start")).alias("s"))
    return leaf.select(F.col("lower").alias("shard"), "s.number", "s.quota", "s.start")


def _fill(frame: pd.DataFrame) -> pd.DataFrame:
    """Documents of one cut block: in random order, then the longest that fit, then one exchange."""
    frame = frame.sort_values("_order", kind="stable")
    words, left = frame["words"].to_numpy(), float(frame["rest"].iloc[0])
    taken = np.cumsum(words) <= left
    left -= words[taken].sum()
    for i in np.argsort(-words, kind="stable"):
        if not taken[i] and words[i] <= left:
            taken[i] = True
            left -= words[i]
    # Exchange one drawn document (or none) for one not drawn, where that ends nearer.
    inside, outside = np.flatnonzero(taken), np.flatnonzero(~taken)
    if len(outside):
        outside = outside[np.argsort(words[outside], kind="stable")]
        gone = np.append(words[inside], 0)
        at = np.searchsorted(words[outside], gone + left)
        pairs = [(abs(gone + left - words[outside[k]]), k)
                 for k in (np.clip(at, 0, len(outside) - 1), np.clip(at - 1, 0, len(outside) - 1))]
        miss = np.minimum(pairs[0][0], pairs[1][0])
        best = int(np.argmin(miss))
        if miss[best] < left:
            k = pairs[0][1] if pairs[0][0][best] <= pairs[1][0][best] else pairs[1][1]
            taken[outside[k[best]]] = True
            if best < len(inside):
                taken[inside[best]] = False
    return frame[taken][ROW]


def mix(docs: DataFrame, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """Sized documents with their source's figures, and the mix: one row per draw of a document.

    Reads ``doc_id, text, source``. A null text has no words; a null source is a
    source of its own, the last. Documents are drawn whole, each at most
    ``LIMIT`` times; rows that agree in all three columns are drawn together.
    The first table has the row key, doc_id, source, size, copies, source_size
    and target; the second the row key, shard, place (within the shard) and pass.
    Empty tables give empty ones.
    """
    sized = materialize(sizes(docs), "sizes")
    sources = materialize(
        targets(sized).withColumn(
            "blocks",
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / BLOCK_WORDS),
                       F.ceil(F.col("rows") / BLOCK_ROWS)).cast("long"),
        ).withColumn("whole", F.when(F.col("source_size") > 0,
                                     F.floor(F.col("target") / F.col("source_size"))).otherwise(0)),
        "targets",
    )
    named = sources.withColumn("_source", F.coalesce("source", F.lit("")))
    named = named.withColumn("_none", F.col("source").isNull()).drop("source")
    sized = sized.withColumn("_source", F.coalesce("source", F.lit("")))
    sized = attach(sized.withColumn("_none", F.col("source").isNull()), named, ["_source", "_none"])
    sized = materialize(
        sized.drop("_source", "_none").withColumn(
            "block", F.pmod(F.xxhash64(F.lit(seed), *ROW), F.col("blocks"))
        ),
        "sized",
    )

    blocks = sized.groupBy("number", "block").agg(F.sum("words").alias("words")).where("words > 0")
    draws = attach(blocks, sources.select("number", "whole", "target"), ["number"], "inner")
    draws = draws.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("whole"))))
    draws = draws.withColumn("_order", F.xxhash64(F.lit(seed), "number", "pass", "block"))
    draws = draws.withColumn("_one", F.lit(1))
    draws = running(
        draws, ["number", "pass", "_order", "block"], {"_rank": "_one", "_before": "words"}
    )
    firsts = draws.groupBy("number").agg(
        F.min("_rank").alias("_rank0"), F.min("_before").alias("_before0")
    )
    draws = attach(draws, firsts, ["number"], "inner").withColumns({
        "rank": F.col("_rank") - F.col("_rank0"),
        "rest": F.col("target") - (F.col("_before") - F.col("_before0")),
    })
    draws = materialize(
        draws.where("rest > 0").select("number", "block", "pass", "rank", "rest", "words"), "draws"
    )

    cut = draws.where("rest < words").select("number", "block", "pass", "rest")
    part = attach(sized.select(*ROW, "number", "block", "words"), cut, ["number", "block"], "inner")
    part = part.withColumn("_order", F.xxhash64(F.lit(seed + 1), *ROW))
    part = part.groupBy("number", "block").applyInPandas(_fill, "_k1 long, _k2 long")

    quotas = draws.groupBy("number").agg(F.count("*").alias("draws"))
    shards = max(1, round(draws.count() / SHARD_BLOCKS))
    own = split_quotas(quotas, shards, seed)
    own = own.select("shard", "number", F.explode(
        F.sequence(F.col("start"), F.col("start") + F.col("quota") - 1)).alias("rank"))
    dealt = materialize(
        draws.join(own, ["number", "rank"])
        .select("number", "block", "pass", "shard", (F.col("rest") < F.col("words")).alias("short")),
        "dealt",
    )
    members = sized.where("words > 0").select(*ROW, "number", "block")
    full = members.join(dealt.where("not short"), ["number", "block"])
    short = members.join(part, ROW, "left_semi").join(dealt.where("short"), ["number", "block"])
    taken = full.unionByName(short).select(*ROW, "shard", "pass")
    return sized, taken.withColumn("place", F.xxhash64(F.lit(seed + 2), "shard", "pass", *ROW))


def mixed_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as drawn, by shard in random order.

    Adds ``shard`` and ``place``, which take the place of columns of those names.
    """
    _, taken = mix(docs, seed)
    taken = materialize(taken, "taken")
    names = [F.col(f"_row.`{c}`") for c in docs.columns if c not in ("shard", "place")]
    rows = packed(docs, ("doc_id", "text", "source"))
    return (
        attach(rows, taken, ROW, "inner")
        .select(*names, "shard", "place")
        .repartition("shard").sortWithinPartitions("shard", "place")
    )
