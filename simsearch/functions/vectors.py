"""Vector arithmetic as column expressions, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def l2_distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays; different lengths are an error."""
    squares = F.zip_with(
        a, b, lambda x, y: (x.cast("double") - y.cast("double"))
        * (x.cast("double") - y.cast("double"))
    )
    distance = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, v: total + v))
    wrong = F.raise_error(
        F.format_string("vectors of different length: %d and %d", F.size(a), F.size(b))
    )
    return F.when(F.size(a) == F.size(b), distance).otherwise(wrong.cast("double"))


def minmax_normalize(values: Column) -> Column:
    """Scale an array to 0..1; a constant array becomes zeros."""
    low = F.array_min(values).cast("double")
    high = F.array_max(values).cast("double")
    # A one-element array holds the bounds, so they are worked out once per row.
    scaled = F.transform(
        F.array(F.struct(low.alias("low"), (high - low).alias("span"))),
        lambda b: F.transform(
            values,
            lambda v: F.when(b["span"] == 0, F.lit(0.0)).otherwise(
                (v.cast("double") - b["low"]) / b["span"]
            ),
        ),
    )
    return F.when(values.isNotNull(), scaled[0])
