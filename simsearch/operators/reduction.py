"""Principal components of a vector collection."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.operators.blocks import to_matrix

# Fixed value: the share of the variance to keep.
KEPT_VARIANCE = 0.985


@dataclass(frozen=True)
class PcaModel:
    """Mean, components (one per column) and the variance share of each."""

    mean: np.ndarray
    components: np.ndarray
    ratio: np.ndarray


def fit_pca(
    vectors: DataFrame, n: int | None = None, vector_col: str = "embedding"
) -> PcaModel:
    """Fit on the whole collection; the largest loading of a component is positive."""
    rows = vectors.where(F.col(vector_col).isNotNull()).select(
        array_to_vector(F.transform(vector_col, lambda x: x.cast("double"))).alias("v")
    )
    mean = rows.select(Summarizer.mean(F.col("v"))).first()[0].toArray()
    n = len(mean) if n is None else n
    if not 1 <= n <= len(mean):
        raise ValueError(f"components must lie in 1..{len(mean)}")
    model = PCA(k=n, inputCol="v", outputCol="p").fit(rows)
    components = model.pc.toArray()
    largest = np.abs(components).argmax(axis=0)
    signs = np.sign(components[largest, np.arange(n)])
    return PcaModel(mean, components * signs, model.explainedVariance.toArray())


def reduce_vectors(
    model: PcaModel, vectors: DataFrame, vector_col: str = "embedding"
) -> DataFrame:
    """Replace the vectors by their centred projections, a batch at a time."""
    kept = [c for c in vectors.columns if c != vector_col]
    mean, components = model.mean, model.components

    def project(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            points = (to_matrix(batch.column(len(kept))) - mean) @ components
            offsets = np.arange(0, points.size + 1, points.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(points.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], lists], [*kept, vector_col]
            )

    rows = vectors.select(*kept, vector_col).where(F.col(vector_col).isNotNull())
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema]
    return rows.mapInArrow(project, ", ".join([*fields, f"`{vector_col}` array<double>"]))


def reduce_queries(model: PcaModel, queries: DataFrame, query_col: str = "q") -> DataFrame:
    """Project queries with the model of the collection they are put to."""
    return reduce_vectors(model, queries, query_col)


def explained_variance(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows ``(component, ratio, cumulative)``, one per dimension."""
    ratio = fit_pca(vectors, None, vector_col).ratio
    rows = [
        (i + 1, float(r), float(c)) for i, (r, c) in enumerate(zip(ratio, np.cumsum(ratio)))
    ]
    return vectors.sparkSession.createDataFrame(
        rows, "component long, ratio double, cumulative double"
    )


def choose_components(variance: DataFrame, share: float = KEPT_VARIANCE) -> DataFrame:
    """One row ``components``: the first count that keeps ``share``."""
    return variance.where(F.col("cumulative") >= share).agg(
        F.min("component").alias("components")
    )
