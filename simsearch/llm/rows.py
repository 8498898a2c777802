"""What a row is, and joins that leave long texts where they lie.

A document is a row. Rows are told apart by a 128-bit key of their id and text,
so a null or repeated id does no harm: rows that agree in both are twins, and
whatever is decided for one holds for the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simsearch.plans.joins import fits_broadcast
from simsearch.plans.storage import materialize

KEY = ["_k1", "_k2"]


def with_key(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """Add the row key; null and empty differ."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return docs.withColumns(
        {"_k1": F.xxhash64(F.lit(0), *parts), "_k2": F.xxhash64(F.lit(1), *parts)}
    )


def attach(big: DataFrame, small: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join on keys without nulls; ``small`` is sent to every task only if it measures small."""
    return big.join(F.broadcast(small) if fits_broadcast(small) else small, on, how)


def packed(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """Whole rows as one struct ``_row`` beside their key, so no column can clash with ours."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *columns)
    return with_key(keyed, columns).select("_row", *KEY)


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is not among ``rejected``; all columns stay as they are."""
    return attach(packed(docs), rejected.select(*KEY).distinct(), KEY, "left_anti").select("_row.*")


def one_of_twins(docs: DataFrame, twins: DataFrame) -> DataFrame:
    """``docs`` with a single row for each key in ``twins``; other rows stay as they are."""
    if twins.isEmpty():
        return docs
    rows = packed(docs)
    single = attach(rows, twins, KEY, "left_semi").dropDuplicates(KEY)
    return attach(rows, twins, KEY, "left_anti").unionByName(single).select("_row.*")


def running(df: DataFrame, order: list, sums: dict[str, str]) -> DataFrame:
    """Add, for each ``sums`` entry (new column: summed column), the sum over all earlier rows.

    ``order`` must tell all rows apart. Rows are range-partitioned, so no task
    orders more than its range; only the ranges' totals pass through the driver.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    totals = sorted(
        ranged.groupBy("_range").agg(*[F.sum(c).alias(n) for n, c in sums.items()]).collect()
    )
    starts, so_far = [], [0] * len(sums)
    for total in totals:
        starts.append((total["_range"], *so_far))
        so_far = [a + (total[n] or 0) for a, n in zip(so_far, sums)]
    fields = ", ".join(["_range int", *[f"_start_{n} long" for n in sums]])
    earlier = Window.partitionBy("_range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    found = ranged.join(F.broadcast(spark.createDataFrame(starts, fields)), "_range")
    return found.withColumns(
        {n: F.col(f"_start_{n}") + F.coalesce(F.sum(c).over(earlier), F.lit(0)) for n, c in sums.items()}
    ).drop("_range", *[f"_start_{n}" for n in sums])
