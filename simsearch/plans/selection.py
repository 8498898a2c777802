"""Exact order statistics and row numbers without one task sorting everything.

Rows are cut into equally filled ranges at approximate quantiles. Only the
range counts, a bounded table, are looked at as a whole; rows are ordered
inside their own range.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsearch.plans.storage import materialize

# Rows one task may order within a range.
RANGE_ROWS = 1_000_000


def _ranges(rows: int) -> int:
    return max(1, math.ceil(rows / RANGE_ROWS))


def cut_ranges(df: DataFrame, column: str, ranges: int, out: str = "_range") -> DataFrame:
    """Add the number of the equally filled range that ``column`` falls into."""
    if ranges <= 1:
        return df.withColumn(out, F.lit(0.0))
    probabilities = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(df.approxQuantile(column, probabilities, 0.5 / ranges)))
    splits = [-math.inf, *cuts, math.inf]
    return Bucketizer(
        splits=splits, inputCol=column, outputCol=out, handleInvalid="keep"
    ).transform(df)


def order_statistics(
    df: DataFrame, column: str, ranks: list[int], ranges: int | None = None
) -> list:
    """Values of ``column`` at the zero-based ``ranks`` of its ascending order.

    Equal values are counted together before they are ordered, so a value
    holding a large share of the rows costs one row. Nulls are left out.
    """
    values = df.select(F.col(column).alias("x")).where("x is not null")
    values = values.withColumn("_lead", F.col("x").cast("double"))
    if ranges is None:
        ranges = _ranges(values.count())
    ranked = cut_ranges(values, "_lead", ranges)
    sizes = {r["_range"]: r["n"] for r in
             ranked.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    starts, total = {}, 0
    for number in sorted(sizes):
        starts[number] = total
        total += sizes[number]
    wanted = sorted(set(ranks))
    if not wanted:
        return []
    if not 0 <= wanted[0] <= wanted[-1] < total:
        raise ValueError(f"ranks must lie in 0..{total - 1}")
    homes = [b for b in sizes if any(starts[b] <= r < starts[b] + sizes[b] for r in wanted)]
    start = F.create_map(*[F.lit(v) for b in homes for v in (b, starts[b])])
    running = Window.partitionBy("_range").orderBy("x").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    spans = (
        ranked.where(F.col("_range").isin(homes))
        .groupBy("_range", "x").agg(F.count("*").alias("n"))
        .withColumn("end", start[F.col("_range")] + F.sum("n").over(running))
    )
    holds = F.filter(
        F.array(*[F.lit(r) for r in wanted]),
        lambda r: (r < F.col("end")) & (r >= F.col("end") - F.col("n")),
    )
    found = spans.select("x", F.explode(holds).alias("rank")).collect()
    at = {row["rank"]: row["x"] for row in found}
    return [at[r] for r in ranks]


def _total_order(df: DataFrame, order: list) -> list:
    """``order``, and a hash of the whole row for what is equal in it."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return [*[F.col(c) if isinstance(c, str) else c for c in order], F.xxhash64(*plain)]


def number_rows(
    df: DataFrame, key: str, order: list[str], out: str, ranges: int | None = None
) -> DataFrame:
    """Zero-based position of every row within its ``key``, in ``order`` (nulls first).

    Rows with a null key are a key of their own. The whole order, ties broken by a
    hash of the row, is cut into ranges of equal size whatever its types, so no
    task orders more than one range and a key may span any number of them.
    """
    if ranges is None:
        ranges = _ranges(df.count())
    rows = df.withColumn("_tie", _total_order(df, [])[0])
    full = [*order, "_tie"]
    if ranges == 1:
        within = Window.partitionBy(key).orderBy(*full)
        return rows.withColumn(out, (F.row_number().over(within) - 1).cast("long")).drop("_tie")
    ranged = materialize(
        rows.repartitionByRange(ranges, key, *full).withColumn("_range", F.spark_partition_id()),
        "ranged",
    )
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(key, "_range").agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(F.col(key).alias("_key"), F.col("_range").alias("_own"), "_start")
    )
    within = Window.partitionBy(key, "_range").orderBy(*full)
    return (
        ranged.withColumn("_row", F.row_number().over(within) - 1)
        .join(starts, (F.col(key).eqNullSafe(F.col("_key"))) & (F.col("_range") == F.col("_own")))
        .withColumn(out, (F.col("_start") + F.col("_row")).cast("long"))
        .drop("_tie", "_range", "_start", "_row", "_key", "_own")
    )


def first_rows(df: DataFrame, order: list[str], n: int, at_once: int) -> DataFrame:
    """The n rows that come first in ``order`` (nulls first), ties broken by a hash of the row.

    Up to ``at_once`` rows are a sorted limit. More are found by cutting the order
    into ranges: all before one range belong to the answer, and the row at which
    that one is cut bounds it. Both ways give the same rows.
    """
    tie = _total_order(df, [])[0]
    if n <= at_once:
        return df.orderBy(*order, tie).limit(n)
    keys = df.select(*order, tie.alias("_tie"))
    full = [*order, "_tie"]
    ranged = materialize(
        keys.repartitionByRange(*full).withColumn("_range", F.spark_partition_id()), "ranged"
    )
    before, home = 0, None
    for row in sorted(ranged.groupBy("_range").count().collect()):
        if before + row["count"] >= n:
            home = row["_range"]
            break
        before += row["count"]
    if home is None:
        return df
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*full))
    bound = (
        ranged.where(F.col("_range") == home).withColumn("_row", within)
        .where(F.col("_row") == n - before).select(F.struct(*full).alias("_bound"))
    )
    ahead = F.struct(*[F.col(c) for c in order], tie.alias("_tie"))
    marked = df.withColumn("_at", ahead).join(F.broadcast(bound))  # one row
    less = marked.where(F.col("_at") < F.col("_bound")).drop("_at", "_bound")
    # Rows equal in everything may stand on both sides of the cut.
    equal = marked.where(F.col("_at") == F.col("_bound")).drop("_at", "_bound")
    return less.unionByName(equal.limit(n - less.count()))
