"""Tables written between jobs, in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# Tasks for a split of texts whose words are counted, and the most tasks.
SPLIT_PARTS, MOST_PARTS = 8, 20_000


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; one of our own only in local mode."""
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{_SETTING} must name a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="simsearch-")
    spark.conf.set(_SETTING, folder)
    return folder


def new_table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a scan of what was written; such a scan comes back as it is."""
    if is_stored(df):
        return df
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._stored = True
    return found


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` is what ``materialize`` returned, and nothing made from it."""
    return getattr(df, "_stored", False) is True


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that ``materialize`` or ``new_table_path`` has placed; others are left alone."""
    if not path.startswith(shared_folder(spark).rstrip("/") + "/"):
        raise ValueError(f"not a table between jobs: {path}")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Tables of a loop, of which each round needs only those of the round before."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, DataFrame] = {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = new_table_path(self.spark, name)
        df.write.parquet(path)
        found = self.spark.read.schema(df.schema).parquet(path)
        self.paths[path] = found
        return found

    def keep(self, *tables: DataFrame) -> None:
        """Remove all tables but these."""
        for path, table in list(self.paths.items()):
            if not any(table is kept for kept in tables):
                discard(self.spark, path)
                del self.paths[path]


def balanced(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan of fewer splits than the cluster has cores.

    A corpus of many splits comes back unchanged; a file or two would otherwise
    leave heavy per-row work to a few tasks.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(key) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, key: str) -> DataFrame:
    """All rows of a key in one task, in tasks of a part of a split each.

    What is counted by the key afterwards, however much more that is, need not be shuffled.
    """
    session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    splits = df.rdd.getNumPartitions()
    # A split is at most 128 MB; a part of it leaves the counts in memory.
    few = splits < df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(session if few else max(session, min(MOST_PARTS, splits * SPLIT_PARTS)), key)
