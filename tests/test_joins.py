import pytest
from pyspark.sql import functions as F

from conftest import tuples
from simsearch.plans import joins


@pytest.fixture(scope="module")
def sides(spark):
    rows = [("hot", i) for i in range(400)] + [(f"k{i % 7}", i) for i in range(60)] + [(None, i) for i in range(50)]
    big = spark.createDataFrame(rows, "k string, v long").repartition(4)
    lookup = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), ("absent", 5), (None, 6)], "k string, w long")
    return big, lookup


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_all_ways_agree(sides, how):
    big, lookup = sides
    plain = big.join(lookup, ["k"], how)
    for options in ({"broadcast": True}, {"broadcast": False}, {"broadcast": False, "hot_rows": 30}, {}):
        got = joins.lookup_join(big, lookup, ["k"], how, **options)
        assert got.columns == plain.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_only_hot_keys_are_repeated(sides):
    big, lookup = sides
    left, right = joins._salted(big, lookup, ["k"], big.columns, 30)
    copies = dict(tuples(right.groupBy("k").agg(F.countDistinct("_salt")).where("k is not null")))
    assert copies == {"hot": 14, "k1": 1, "k2": 1, "absent": 1}
    parts = left.where("k = 'hot'").groupBy("_salt").count().collect()
    assert len(parts) == 14 and max(r["count"] for r in parts) < 60
