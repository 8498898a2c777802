"""An index on disk: tables sorted by term, in blocks of bounded size."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsearch.operators.index import MAXIMA_SPAN, Index, block_maxima, term_statistics
from simsearch.plans.storage import discard, is_stored, new_table_path

POSTINGS = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("tf", T.LongType()),
    ]
)
TERMS = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("df", T.LongType()),
        T.StructField("tf_square", T.DoubleType()),
    ]
)
BLOCKS = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("max_tf", T.LongType()),
    ]
)
# An index written without block maxima has no span.
META = T.StructType([T.StructField("n_docs", T.LongType()), T.StructField("span", T.LongType())])


def write_index(
    index: Index,
    path: str,
    partitions: int | None = None,
    block_rows: int = 1_000_000,
    mode: str = "errorifexists",
    span: int = MAXIMA_SPAN,
) -> None:
    """Write postings, terms and block maxima sorted by term, so a lookup reads few row groups.

    The ranges run over term and document: a very frequent term is split over as
    many files as it needs. Finding the ranges and sorting both read the postings,
    and the statistics read the sorted ones, so they are written as they come
    first, unless they were, and the documents are analysed once.
    """
    spark = index.postings.sparkSession
    unsorted = None if is_stored(index.postings) else new_table_path(spark, "unsorted")
    postings = index.postings.select("term", "doc_id", "tf")
    if unsorted:
        postings.write.parquet(unsorted)
        postings = spark.read.schema(POSTINGS).parquet(unsorted)
    keys = ["term", "doc_id"]
    ranged = (
        postings.repartitionByRange(partitions, *keys)
        if partitions else postings.repartitionByRange(*keys)
    )
    (
        ranged.sortWithinPartitions(*keys)
        .write.mode(mode).option("maxRecordsPerFile", block_rows).parquet(f"{path}/postings")
    )
    written = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
    for name, table, order in (
        ("terms", term_statistics(written).repartitionByRange("term"), ["term"]),
        ("blocks", block_maxima(written, span), ["term", "block"]),
    ):
        (
            table.sortWithinPartitions(*order)
            .write.mode(mode).option("maxRecordsPerFile", block_rows).parquet(f"{path}/{name}")
        )
    if unsorted:
        discard(spark, unsorted)
    # Last: an index without its count of documents is not one, and is not read.
    meta = spark.range(1).select(
        F.lit(index.n_docs).cast("long").alias("n_docs"), F.lit(span).cast("long").alias("span")
    )
    meta.write.mode(mode).parquet(f"{path}/meta")


def read_index(spark: SparkSession, path: str) -> Index:
    meta = spark.read.schema(META).parquet(f"{path}/meta").first()
    postings = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
    terms = spark.read.schema(TERMS).parquet(f"{path}/terms")
    if meta["span"] is None:
        return Index(postings, terms, meta["n_docs"])
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return Index(postings, terms, meta["n_docs"], blocks, meta["span"])
