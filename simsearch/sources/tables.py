"""Song and track tables, and slices of a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsearch.plans.selection import first_rows

# The columns of the song and track files.
SONGS = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [
        T.StructField(name, T.StringType())
        for name in (
            "track_id", "lyrics", "track_name", "track_artist", "track_album_name",
            "playlist_name", "playlist_genre", "playlist_subgenre", "language",
            "track_album_release_date",
        )
    ]
)
SONG_TEXT = [
    "lyrics", "track_name", "track_artist", "track_album_name", "playlist_name",
    "playlist_genre", "playlist_subgenre",
]
TRACKS = T.StructType(
    [
        T.StructField("track_id", T.StringType()),
        T.StructField("track_title", T.StringType()),
        T.StructField("artist_name", T.StringType()),
    ]
)

# Rows a sorted limit may bring together; longer slices are cut at a bound.
SLICE_ROWS = 10_000


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def read_songs(
    spark: SparkSession, path: str, schema: T.StructType = SONGS
) -> DataFrame:
    """Songs from CSV with a header, lyrics over many lines; or from Parquet."""
    return _read(spark, path, schema)


def read_tracks(
    spark: SparkSession, path: str, schema: T.StructType = TRACKS, id_col: str = "track_id"
) -> DataFrame:
    """Tracks with the id as a number, so that '037156' is 37156."""
    return _read(spark, path, schema).withColumn(id_col, F.col(id_col).cast("long"))


def corpus_slice(
    df: DataFrame, n: int, id_col: str = "doc_id", at_once: int = SLICE_ROWS
) -> DataFrame:
    """The n rows with the smallest ids, null ids first; exactly n if there are as many."""
    if n <= 0:
        raise ValueError("n must be positive")
    return first_rows(df, [id_col], n, at_once)
