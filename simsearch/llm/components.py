"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm.rows import attach
from simsearch.plans.storage import Scratch


def _renamed(table: DataFrame, key: str, value: str, new_key: str, new_value: str) -> DataFrame:
    return table.select(F.col(key).alias(new_key), F.col(value).alias(new_value))


def contract(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, comp) with the components joined that ``links`` (a, b) connect.

    Every round hooks each component to its least neighbour and halves the
    chains until they are gone. Links, labels and parents stay tables throughout;
    those of past rounds are removed.
    """
    scratch = Scratch(labels.sparkSession)
    found = attach(links.select("a", "b"), _renamed(labels, "node", "comp", "a", "ca"), ["a"], "inner")
    found = attach(found, _renamed(labels, "node", "comp", "b", "cb"), ["b"], "inner")
    edges = scratch.table(found.where("ca <> cb").select("ca", "cb").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("cb").alias("ca"), F.col("ca").alias("cb")))
        parents = scratch.table(
            both.groupBy("ca").agg(F.min("cb").alias("p"))
            .select(F.col("ca").alias("c"), F.least("ca", "p").alias("p")),
            "parents",
        )
        while True:
            next_up = attach(parents, _renamed(parents, "c", "p", "p", "pp"), ["p"])
            next_up = scratch.table(
                next_up.select("c", F.coalesce("pp", "p").alias("p"),
                               (F.coalesce("pp", "p") != F.col("p")).alias("moved")),
                "parents",
            )
            still = next_up.where("moved").isEmpty()
            parents = next_up.select("c", "p")
            if still:
                break
        labels = scratch.table(
            attach(labels, _renamed(parents, "c", "p", "comp", "p"), ["comp"])
            .select("node", F.coalesce("p", "comp").alias("comp")),
            "labels",
        )
        edges = attach(edges, _renamed(parents, "c", "p", "ca", "pa"), ["ca"], "inner")
        edges = attach(edges, _renamed(parents, "c", "p", "cb", "pb"), ["cb"], "inner")
        edges = scratch.table(
            edges.where("pa <> pb").select(F.col("pa").alias("ca"), F.col("pb").alias("cb")).distinct(),
            "edges",
        )
        scratch.keep(edges, labels)
    scratch.keep(labels)
    return labels
