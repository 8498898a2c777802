"""Vector tables in files of bounded size."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from simsearch.sources.tables import corpus_slice


def read_vectors(
    spark: SparkSession, path: str, num: int | None = None, id_col: str = "vec_id"
) -> DataFrame:
    """Vectors of every file below ``path``, or the first ``num`` of them by id.

    Files that cannot be read are skipped, also where one would have been asked
    for the schema.
    """
    if num is not None and num <= 0:
        raise ValueError("num must be positive")
    reader = spark.read.option("ignoreCorruptFiles", True)
    try:
        vectors = reader.parquet(path)
    except AnalysisException:
        vectors = reader.option("mergeSchema", True).parquet(path)
    return vectors if num is None else corpus_slice(vectors, num, id_col)


def write_vectors(
    df: DataFrame, path: str, batch_size: int = 1000, mode: str = "errorifexists"
) -> None:
    """Write vectors in files of at most ``batch_size`` rows."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    df.write.mode(mode).option("maxRecordsPerFile", batch_size).parquet(path)
