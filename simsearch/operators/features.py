"""Features of frames, signals and files."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

# Samples one task orders at a time.
CHUNK = 65_536
# Fixed value: samples this small count as zero, and zero as positive.
ZERO = 1e-10


def mean_pool(
    frames: DataFrame,
    id_col: str = "id",
    coef_col: str = "coef",
    value_col: str = "value",
) -> DataFrame:
    """Rows ``(id, coef, value)``: mean over the frames of each coefficient."""
    return frames.groupBy(id_col, coef_col).agg(
        F.avg(F.col(value_col).cast("double")).alias(value_col)
    )


def coefficients(df: DataFrame, vector_col: str = "embedding", keep: list[str] = []) -> DataFrame:
    """Long form of a vector column: ``coef`` and ``value`` beside the kept columns."""
    return df.select(*keep, F.posexplode(vector_col).alias("coef", "value")).withColumn(
        "coef", F.col("coef").cast("long")
    ).withColumn("value", F.col("value").cast("double"))


def coefficient_stats(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows ``(coef, mean, std)`` with the population standard deviation."""
    return coefficients(vectors, vector_col).groupBy("coef").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )


def zero_crossings(
    signals: DataFrame,
    id_col: str = "signal_id",
    pos_col: str = "pos",
    value_col: str = "value",
    chunk: int = CHUNK,
) -> DataFrame:
    """Rows ``(id, crossings)``: sign changes between neighbouring samples.

    Positions count up by one. A signal is cut into chunks, the last sample of
    each also standing before the next, so one long signal is many groups.
    """
    number = F.floor(F.col(pos_col) / F.lit(chunk))
    last = F.pmod(F.col(pos_col), F.lit(chunk)) == chunk - 1
    copies = F.when(last, F.array(number, number + 1)).otherwise(F.array(number))
    negative = F.col(value_col) < -ZERO
    cut = signals.select(
        id_col, pos_col, negative.alias("_negative"), number.alias("_own"),
        F.explode(copies).alias("_chunk"),
    )
    before = F.lag("_negative").over(Window.partitionBy(id_col, "_chunk").orderBy(pos_col))
    changes = cut.withColumn("_before", before).where("_own = _chunk")
    crossed = (F.col("_before") != F.col("_negative")).cast("long")
    return changes.groupBy(id_col).agg(F.sum(F.coalesce(crossed, F.lit(0))).alias("crossings"))


def rms_frames(
    signals: DataFrame,
    frame: int,
    hop: int,
    id_col: str = "signal_id",
    pos_col: str = "pos",
    value_col: str = "value",
) -> DataFrame:
    """Rows ``(id, frame, rms)`` for the frames filled completely.

    Samples are first summed in steps that both frame and hop are made of, so
    only those sums, not the samples, are repeated for overlapping frames.
    """
    if frame <= 0 or hop <= 0:
        raise ValueError("frame and hop must be positive")
    step = math.gcd(frame, hop)
    per_frame, per_hop = frame // step, hop // step
    value = F.col(value_col).cast("double")
    sums = signals.groupBy(
        id_col, F.floor(F.col(pos_col) / F.lit(step)).cast("long").alias("_step")
    ).agg(F.sum(value * value).alias("_energy"), F.count(value).alias("_n"))
    first = F.greatest(
        F.ceil((F.col("_step") - F.lit(per_frame - 1)) / F.lit(per_hop)), F.lit(0)
    ).cast("long")
    last = F.floor(F.col("_step") / F.lit(per_hop)).cast("long")
    # A hop longer than the frame leaves steps that no frame covers.
    covered = F.when(first <= last, F.sequence(first, last))
    spread = sums.select(id_col, "_energy", "_n", F.explode(covered).alias("frame"))
    return (
        spread.groupBy(id_col, "frame")
        .agg(F.sum("_energy").alias("_energy"), F.sum("_n").alias("_n"))
        .where(F.col("_n") == frame)
        .select(id_col, "frame", F.sqrt(F.col("_energy") / F.lit(frame)).alias("rms"))
    )


def shape_profile(
    vectors: DataFrame, n: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Rows ``(id, size, total)``: sizes of the first n entries and the row count."""
    if n <= 0:
        raise ValueError("n must be positive")
    total = vectors.select(F.count("*").alias("total"))
    first = vectors.select(id_col, F.size(vector_col).cast("long").alias("size"))
    return first.orderBy(id_col).limit(n).withColumn("total", total.scalar())


def extract_features(
    catalog: DataFrame,
    extractor: Callable[[Any], Mapping[str, Any]],
    schema: T.StructType,
    id_col: str = "id",
    payload_col: str = "content",
    failures: bool = False,
) -> DataFrame:
    """Apply a user's extractor to every payload: rows ``(id, features...)``.

    A payload that raises is dropped, or with ``failures`` those rows alone are
    returned as ``(id, error)``. Large payloads are passed to Python in small batches:
    the session's ``spark.sql.execution.arrow.maxBytesPerBatch`` bounds them in bytes.
    """
    names = schema.fieldNames()
    out = T.StructType(
        [catalog.schema[id_col], *schema.fields, T.StructField("_error", T.StringType())]
    )

    def run(batches):
        for batch in batches:
            rows = []
            for key, payload in zip(batch[id_col], batch[payload_col]):
                try:
                    found = extractor(payload)
                    rows.append([key, *[found[name] for name in names], None])
                except Exception as error:
                    rows.append([key, *[None] * len(names), f"{type(error).__name__}: {error}"])
            yield pd.DataFrame(rows, columns=out.fieldNames(), dtype=object)

    # Nullable, since a failed row has no features.
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in out.fields])
    done = catalog.select(id_col, payload_col).mapInPandas(run, loose)
    if failures:
        return done.where(F.col("_error").isNotNull()).select(id_col, F.col("_error").alias("error"))
    return done.where(F.col("_error").isNull()).select(id_col, *names)
