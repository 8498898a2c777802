import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import tuples
from simsearch.functions.vectors import minmax_normalize
from simsearch.operators import features
from simsearch.plans.selection import number_rows


def test_minmax(spark):
    df = spark.createDataFrame([([2.0, 4.0, 6.0],), ([7.0, 7.0],), (None,)], "v array<double>")
    got = [r[0] for r in df.select(minmax_normalize(F.col("v"))).collect()]
    assert got == [[0.0, 0.5, 1.0], [0.0, 0.0], None]


def signal(spark, values, name=1):
    return spark.createDataFrame(
        [(name, i, float(v)) for i, v in enumerate(values)],
        "signal_id long, pos long, value double",
    )


@pytest.mark.parametrize("chunk", [1, 2, 3, 100])
def test_zero_crossings(spark, chunk):
    golden = signal(spark, [1, -1, -2, 3, 0, -1])
    tiny = signal(spark, [-1e-11, 1, -1], 2)
    flat = signal(spark, [4], 3)
    got = features.zero_crossings(golden.union(tiny).union(flat), chunk=chunk)
    assert tuples(got) == [(1, 3), (2, 1), (3, 0)]


@pytest.mark.parametrize("frame,hop", [(8, 4), (6, 4), (4, 6), (3, 3), (5, 1)])
def test_rms(spark, frame, hop):
    values = np.random.RandomState(1).normal(size=41)
    got = tuples(features.rms_frames(signal(spark, values), frame, hop))
    want = [
        (1, f, float(np.sqrt(np.mean(values[f * hop : f * hop + frame] ** 2))))
        for f in range((len(values) - frame) // hop + 1)
    ]
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_pool_and_stats(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 10.0], 0), (2, [3.0, 20.0], 0)], "vec_id long, embedding array<float>, id int"
    )
    frames = features.coefficients(df, "embedding", ["id"])
    assert tuples(features.mean_pool(frames)) == [(0, 0, 2.0), (0, 1, 15.0)]
    assert tuples(features.coefficient_stats(df)) == [(0, 2.0, 1.0), (1, 15.0, 5.0)]


def test_shapes(spark):
    df = spark.createDataFrame(
        [(3, [1.0]), (1, [1.0, 2.0]), (2, [])], "vec_id long, embedding array<float>"
    )
    assert tuples(features.shape_profile(df, 2)) == [(1, 2, 3), (2, 0, 3)]


@pytest.mark.parametrize("ranges", [1, 6])
def test_positions_of_a_hot_key(spark, ranges):
    rows = [(i % 7 and 1, i * 37 % 101, i) for i in range(500)] + [(5, None, 1000), (1, None, 1001)]
    df = spark.createDataFrame(rows, "k long, t long, e long").repartition(4)
    got = number_rows(df, "k", ["t", "e"], "pos", ranges).collect()
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in got if r.k == key), key=lambda r: r.pos)
        assert [r.pos for r in mine] == list(range(len(mine)))
        order = [(r.t is not None, r.t or 0, r.e) for r in mine]
        assert order == sorted(order)


@pytest.mark.parametrize("kind", ["bigint", "string", "date", "timestamp", "double"])
def test_positions_are_the_same_however_they_are_cut(spark, kind):
    rows = [(None if i % 5 == 0 else i % 3, i % 4 and i % 11, i) for i in range(120)]
    at = {"date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("t")),
          "timestamp": F.timestamp_seconds(F.col("t"))}.get(kind, F.col("t").cast(kind))
    df = spark.createDataFrame(rows, "k int, t int, e int").select("k", at.alias("t"), "e").repartition(4)
    for order in (["t", "e"], ["t"]):  # the second leaves ties to the row itself
        one, many = (sorted(map(str, number_rows(df, "k", order, "pos", n).collect())) for n in (1, 7))
        assert one == many and len(one) == 120


def test_one_moment_for_all(spark):
    df = spark.range(60).select(F.lit(1).alias("k"), F.lit(None).cast("date").alias("t"), "id")
    got = number_rows(df, "k", ["t"], "pos", 6)
    assert sorted(r.pos for r in got.collect()) == list(range(60))


def test_extractor_failures_are_set_aside(spark):
    def extractor(text):
        if text == "bad":
            raise RuntimeError("no frames")
        return {"n": len(text), "share": 0.5}

    schema = T.StructType(
        [T.StructField("n", T.LongType()), T.StructField("share", T.DoubleType())]
    )
    files = spark.createDataFrame([("a", "xyz"), ("b", "bad")], "id string, content string")
    got = features.extract_features(files, extractor, schema)
    assert got.columns == ["id", "n", "share"] and tuples(got) == [("a", 3, 0.5)]
    failed = features.extract_features(files, extractor, schema, failures=True)
    assert tuples(failed) == [("b", "RuntimeError: no frames")]
