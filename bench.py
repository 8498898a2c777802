"""Time the headline queries: one JSON line.

Each is run to the end into a sink that drops its rows, once to warm up and then
twice, the better time counting. Text search runs over a stored index, as the
published figures leave index building out; building is timed on its own.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from simsearch.operators import index, lsh, search
from simsearch.operators.analysis import analyze_queries
from simsearch.plans.session import with_settings
from simsearch.plans.storage import materialize, new_table_path
from simsearch.sources import index_store
from simsearch.workload.queries import (
    K, LIKE_TEXT, QUERIES, documents, embeddings, text_queries, vector_queries,
)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = 2
HEADLINE = [
    "doc_freq", "match_any", "match_any_limit", "search_topk", "search_topk_stemmed", "knn_exact", "range_search",
    "knn_ties", "knn_lsh", "knn_pca", "distance_percentiles", "pca_variance", "coef_stats",
    "zero_crossings", "rms_frames", "extract_features",
]


def session() -> SparkSession:
    spark = (
        with_settings(SparkSession.builder)
        .master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def best(work) -> float:
    work()
    return min(timed(work) for _ in range(REPEATS))


def main() -> None:
    spark = session()
    seconds: dict[str, float] = {}
    texts, docs = text_queries(spark, SF_DIR), documents(spark, SF_DIR)

    def write(path: str, stem: bool, lang_col: str | None = "lang") -> index.Index:
        built = index.build_index(docs, stem=stem, lang_col=lang_col)
        index_store.write_index(built, path, mode="overwrite")
        return index_store.read_index(spark, path)

    for name, stem in (("", False), ("_stemmed", True)):
        path = new_table_path(spark, "index")
        write(path, stem)
        seconds[f"index_write{name}"] = timed(lambda: write(path, stem))
        stored = index_store.read_index(spark, path)
        # One text, which shows the metadata of its five hits.
        seconds[f"liketo_stored{name}"] = best(lambda: drain(search.liketo(
            docs, "text", LIKE_TEXT, stem=stem, index=stored, metadata={"title": "source"}
        )))
        terms = analyze_queries(texts, stem=stem)
        seconds[f"search_stored{name}"] = best(
            lambda: drain(search.search_top_k(stored, texts, K, query_terms=terms))
        )
    english = write(new_table_path(spark, "index"), True, None)
    seconds["match_any_stored"] = best(
        lambda: drain(search.match_any(None, "text", texts, K, index=english))
    )
    vectors = embeddings(spark, SF_DIR)
    signed = materialize(lsh.lsh_signature(vectors, 128), "signed")
    seconds["knn_lsh_stored"] = best(lambda: drain(
        lsh.knn_lsh(vectors, vector_queries(spark, SF_DIR), K, 128, signatures=signed)
    ))
    for name in HEADLINE:
        seconds[name] = best(lambda: drain(QUERIES[name](spark, SF_DIR)))

    n_texts, n_vectors = texts.count(), spark.read.parquet(f"{SF_DIR}/embeddings.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "text_queries_per_sec": round(n_texts / seconds["search_stored"], 1),
                "text_ms_per_query": round(1000 * seconds["search_stored"] / n_texts, 3),
                "knn_queries_per_sec": round(n_vectors / seconds["knn_exact"], 1),
                "knn_pairs_per_sec": round(n_vectors * n_vectors / seconds["knn_exact"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
