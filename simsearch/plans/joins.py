"""Joins against a lookup side whose size is measured before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsearch.plans.storage import materialize

# Largest lookup side, in estimated bytes, that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

# Rows of one join key that a task may get; a key with more is spread over as many
# tasks as it needs, and only such a key's lookup rows are repeated.
HOT_ROWS = 5_000_000

_ROW_OVERHEAD = 16


def _width(field: T.StructField):
    """Estimated bytes of one value as a column expression."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("long") + 8
    if isinstance(field.dataType, T.ArrayType):
        return F.greatest(F.size(column), F.lit(0)).cast("long") * 8 + 8
    return F.lit(8).cast("long")


def estimated_bytes(df: DataFrame, per_row: int = 0) -> int:
    """Bytes the rows of ``df`` take, and ``per_row`` more each, by one aggregate."""
    row = F.lit(_ROW_OVERHEAD + per_row).cast("long")
    for field in df.schema.fields:
        row = row + _width(field)
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("b")).first()["b"]


def fits_broadcast(
    df: DataFrame, limit_bytes: int | None = None, per_row: int = 0
) -> bool:
    limit = BROADCAST_BYTES if limit_bytes is None else limit_bytes
    return estimated_bytes(df, per_row) <= limit


def _salted(big: DataFrame, lookup: DataFrame, on: list[str], by: list[str], hot_rows: int):
    """Both sides with a salt: 0 for most keys, more for the keys that hold many rows."""
    counts = big.groupBy(*on).agg(F.count("*").alias("_rows")).where(F.col("_rows") > hot_rows)
    hot = materialize(
        counts.select(*on, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_salts")), "hot"
    )
    spread = F.pmod(F.xxhash64(*by), F.col("_salts")).cast("int")
    no_key = F.lit(False)
    for name in on:
        no_key = no_key | F.col(name).isNull()
    # Rows without a key meet nothing, wherever they are.
    alone = F.pmod(F.xxhash64(*by), F.lit(1024)).cast("int")
    # There is at most one hot key per ``hot_rows`` rows.
    left = big.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.when(no_key, alone).otherwise(F.coalesce(spread, F.lit(0)))
    ).drop("_salts")
    right = lookup.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    ).drop("_salts")
    return left, right


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    salt_by: list[str] | None = None,
    broadcast: bool | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``big`` with ``lookup`` without ever gathering one hot key.

    ``broadcast`` says whether the lookup side is small; when it is ``None``
    the side is measured. A lookup side over the limit is joined by shuffle: keys
    with more than ``hot_rows`` rows in ``big`` are counted out first and spread by
    a hash of ``salt_by`` (by default all columns of ``big``), with a copy of their
    lookup rows for each part; all other keys are joined as they are. ``how`` is one
    of inner, left, left_semi and left_anti, where a repeated lookup row meets
    each row of ``big`` exactly once.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    if broadcast is None:
        broadcast = fits_broadcast(lookup)
    if broadcast:
        return big.join(F.broadcast(lookup), on, how)
    left, right = _salted(big, lookup, on, salt_by or big.columns, hot_rows)
    # In the column order of an unsalted join.
    return left.join(right, [*on, "_salt"], how).drop("_salt")
