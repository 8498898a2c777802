import importlib
import re
from collections import Counter

import pytest
from llm_rows import messy, nothing, prose  # noqa: F401

from simsearch.plans.storage import materialize

pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    items = [(i, prose(3000 + i, 30)) for i in range(5)]
    rows = [(i, prose(i, 90, ["en", "de", "es"][i % 3]), ["en", "de", "es"][i % 3], f"s{i % 4}") for i in range(120)]
    rows += [(200 + i, rows[i][1].replace(" ", "  "), rows[i][2], "s1") for i in range(6)]  # equal
    rows += [(300 + i, rows[i][1] + " one more", rows[i][2], "s2") for i in range(10, 15)]  # similar
    rows += [(400 + i, prose(400 + i, 40) + " " + items[i][1], "en", "s3") for i in range(5)]  # leaks
    rows += [(500, "12 34 !!", "en", "s0"), (501, None, "en", "s0"), (None, prose(502, 60), "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.selectExpr("*", "cast(length(text) as long) as n_chars", "1 as _k1").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids, kept = [], docs
    for name, stage in pipeline.STAGES:
        out = stage(spark, kept, folder)
        if name != "source_mix":
            assert out.dtypes == docs.dtypes, name
        kept = materialize(out, name)
        ids.append([r.doc_id for r in kept.select("doc_id").collect()])
    clean = list(range(120))
    by_key = lambda found: sorted(found, key=repr)
    leaks = [400 + i for i in range(5)]
    similar = [310, 311, 312, 313, 314]
    # Equal texts: the one with more code points stays.
    assert by_key(ids[0]) == by_key([*clean, *range(200, 206), *similar, *leaks, None])
    assert by_key(ids[1]) == by_key([*range(6, 120), *range(200, 206), *similar, *leaks, None])
    assert by_key(ids[2]) == by_key([*range(6, 120), *range(200, 206), *leaks, None])
    assert by_key(ids[3]) == by_key([*range(6, 120), *range(200, 206), None])
    times = Counter(ids[4])
    assert set(times) <= set(ids[3]) and max(times.values()) <= 2


def test_texts_in_no_known_language_go(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    strange = "".join(chr(0x4E00 + i * 37 % 5000) for i in range(200))
    rows = [(900, strange, None, "s0"), (901, "日本語", None, "s0"), (902, prose(902, 60), None, "s0")]
    more = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    more = docs.unionByName(more, allowMissingColumns=True)
    kept = {r.doc_id for r in pipeline.known_language(spark, more, folder).select("doc_id").collect()}
    # The short text cannot be told from chance.
    assert 900 not in kept and {901, 902} <= kept


def test_empty_tables_and_no_labels(spark, tmp_path, messy, nothing):
    for name, docs in (("none", nothing), ("unlabelled", messy.withColumn("lang", messy.lang.substr(1, 0)))):
        docs = docs if name == "none" else docs.selectExpr("*", "cast(null as string) as l").drop("lang")
        docs = docs.withColumnRenamed("l", "lang") if name != "none" else docs
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        rows = pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert (len(rows) == 0) == (name == "none")
        assert all(re.search(r"[^\W\d_]", r.text) for r in rows)


def test_run_equals_its_stages(spark, folder):
    rows = pipeline.run(spark, folder)
    assert {"shard", "place"} <= set(rows.columns) and rows.count() > 0


def test_entry_without_the_subpackage(monkeypatch):
    entry = importlib.import_module("__spark_entry__")
    real = entry.find_spec
    monkeypatch.setattr(entry, "find_spec", lambda name: None if "llm" in name or "pipeline" in name else real(name))
    assert not [n for n in entry.queries() if re.match(r"op\d+_|pipeline", n)]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_a_query_for_each_operator():
    entry = importlib.import_module("__spark_entry__")
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
