"""How distances are spread: percentiles and a histogram."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.plans.selection import RANGE_ROWS, order_statistics
from simsearch.plans.storage import materialize

# The percentiles a search radius is chosen from.
PERCENTILES = (10, 30, 50, 70, 90)


def distance_percentiles(
    df: DataFrame,
    percentiles: tuple[float, ...] = PERCENTILES,
    column: str = "distance",
    exact_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Rows ``(percentile, distance)``, interpolated linearly between ranks."""
    if any(not 0 <= p <= 100 for p in percentiles):
        raise ValueError("percentiles must lie in 0..100")
    # The distances may come out of a long job: once is enough.
    df = materialize(df.select(column), "distances")
    rows = df.agg(F.count(column)).first()[0]
    shares = [p / 100 for p in percentiles]
    labels = F.array(*[F.lit(float(p)) for p in percentiles])
    if rows <= exact_rows:
        values = df.agg(
            F.percentile(column, F.array(*[F.lit(s) for s in shares])).alias("v")
        )
        return values.select(
            F.explode(F.arrays_zip(labels.alias("percentile"), F.col("v").alias("distance")))
        ).select("col.percentile", "col.distance")
    # One aggregate would hold every distinct distance; pick the ranks instead.
    spots = [s * (rows - 1) for s in shares]
    ranks = sorted({r for s in spots for r in (math.floor(s), math.ceil(s))})
    at = dict(zip(ranks, order_statistics(df, column, ranks)))
    found = [
        (float(p), at[math.floor(s)] + (s - math.floor(s)) * (at[math.ceil(s)] - at[math.floor(s)]))
        for p, s in zip(percentiles, spots)
    ]
    return df.sparkSession.createDataFrame(found, "percentile double, distance double")


def distance_histogram(df: DataFrame, bins: int = 50, column: str = "distance") -> DataFrame:
    """Rows ``(bin, low, high, n)`` of equal width, the last one closed above."""
    if bins <= 0:
        raise ValueError("bins must be positive")
    df = materialize(df.select(column), "distances")
    low, high = df.agg(F.min(column), F.max(column)).first()
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "bin long, low double, high double, n long")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    number = F.least(
        F.floor((F.col(column) - F.lit(low)) / F.lit(width)).cast("long"), F.lit(bins - 1)
    )
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(number.alias("bin")).agg(F.count("*").alias("n"))
    )
    every = spark.range(bins).select(
        F.col("id").alias("bin"),
        (F.lit(low) + F.col("id") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("id") + 1) * F.lit(width)).alias("high"),
    )
    # At most ``bins`` rows on either side.
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin", "low", "high", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )
