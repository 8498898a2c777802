import pytest
from pyspark.sql import functions as F

from conftest import tuples
from simsearch.operators import index
from simsearch.operators.analysis import analyze_documents
from simsearch.plans.storage import materialize
from simsearch.sources.index_store import read_index, write_index

LINES = [
    "blue (DF: 1): (3, 1)",
    "love (DF: 2): (0, 2), (1, 1)",
    "night (DF: 2): (0, 1), (2, 1)",
    "song (DF: 2): (1, 1), (3, 1)",
    "train (DF: 3): (2, 1), (3, 1), (4, 1)",
]


@pytest.fixture(scope="module")
def built(songs):
    return index.build_index(songs, lang_col=None, stem=False, stopword_lists={})


def test_golden_lines(built):
    lines = index.format_postings(built.postings).orderBy("term")
    assert [r.line for r in lines.collect()] == LINES


def test_parse_undoes_format(built):
    lines = index.format_postings(built.postings)
    want = built.postings.join(built.terms, "term").select("term", "df", "doc_id", "tf")
    assert tuples(index.parse_postings(lines)) == tuples(want)


def test_long_lists_go_over_blocks(spark):
    rows = spark.range(10_000).select(
        F.lit("hot").alias("term"), F.col("id").alias("doc_id"), F.lit(1).cast("long").alias("tf")
    )
    lists = index.posting_lists(rows, span=4096)
    assert tuples(lists.select("block", F.size("postings"))) == [(0, 4096), (1, 4096), (2, 1808)]
    parsed = index.parse_postings(index.format_postings(rows, span=4096))
    assert parsed.where("df = 10000").agg(F.countDistinct("doc_id")).first()[0] == 10_000
    whole = index.parse_postings(index.format_postings(rows, span=10_000))
    assert whole.count() == 10_000


@pytest.mark.parametrize(
    "line", ["love", "love (DF: x): (1, 1)", "love (DF: 1): (1 1)", "love (DF: 1): (1, 1) (2, 1)"]
)
def test_malformed_line_is_named(spark, line):
    lines = spark.createDataFrame([(line,)], "line string")
    with pytest.raises(Exception, match="malformed index line: love"):
        index.parse_postings(lines).collect()


def test_numbers_of_any_shape_are_read(spark):
    lines = spark.createDataFrame(
        [("love (DF: 2): (037156, 2), (1, 1)",), ("night (DF: 1): (-5, 3)",)], "line string")
    assert tuples(index.parse_postings(lines)) == [
        ("love", 2, 1, 1), ("love", 2, 37156, 2), ("night", 1, -5, 3)]
    back = spark.createDataFrame([("a", -9, 2), ("a", 7, 1)], "term string, doc_id long, tf long")
    assert tuples(index.parse_postings(index.format_postings(back))) == [("a", 2, -9, 2), ("a", 2, 7, 1)]


@pytest.mark.parametrize("pair", ["(99999999999999999999, 1)", "(1, 99999999999999999999)"])
def test_too_large_a_number_names_its_line(spark, pair):
    lines = spark.createDataFrame([(f"love (DF: 1): {pair}",)], "line string")
    with pytest.raises(Exception, match="malformed index line: love"):
        index.parse_postings(lines).collect()


def test_merged_parts_may_share_documents(songs):
    parts = [
        index.build_index(songs.where(c), lang_col=None, stem=False, stopword_lists={})
        for c in ("doc_id < 4", "doc_id >= 2")
    ]
    assert index.merge_indexes(*parts).n_docs == 5


def test_writing_an_index_leaves_no_copy(spark, built, tmp_path):
    import os

    from simsearch.plans.storage import discard, shared_folder

    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    write_index(built, str(tmp_path / "idx"))
    assert set(os.listdir(folder)) == before
    with pytest.raises(ValueError):
        discard(spark, str(tmp_path / "idx"))


def test_df_is_list_size_and_tf_adds_up(built):
    sizes = built.postings.groupBy("term").count()
    assert built.terms.join(sizes, "term").where("df <> count").count() == 0
    assert built.postings.agg(F.sum("tf")).first()[0] == 11


def test_merge_equals_whole(songs, built):
    parts = [
        index.build_index(songs.where(c), lang_col=None, stem=False, stopword_lists={})
        for c in ("doc_id < 2", "doc_id >= 2")
    ]
    merged = index.merge_indexes(*parts)
    assert merged.n_docs == 5
    assert tuples(merged.postings) == tuples(built.postings)
    assert tuples(merged.terms.select("term", "df")) == tuples(built.terms.select("term", "df"))


def test_merge_counts_a_shared_document_once(spark):
    part = spark.createDataFrame([("love", 1, 2)], "term string, doc_id long, tf long")
    merged = index.merge_postings(part, part)
    assert tuples(merged) == [("love", 1, 4)]
    assert tuples(index.document_frequencies(merged)) == [("love", 1)]


def test_stored_index(spark, built, tmp_path):
    write_index(built, str(tmp_path / "i"), partitions=3)
    stored = read_index(spark, str(tmp_path / "i"))
    assert stored.n_docs == 5
    assert tuples(stored.postings) == tuples(built.postings)
    assert tuples(stored.terms.select("term", "df")) == tuples(built.terms.select("term", "df"))
    plan = stored.postings.where(F.col("term").isin("love", "night"))
    assert "PushedFilters: [In(term" in plan._jdf.queryExecution().toString()


def test_vocabulary_restricts_the_index(spark, songs, built):
    words = spark.createDataFrame([("love",), ("zebra",)], "term string")
    part = index.build_index(
        songs, lang_col=None, stem=False, stopword_lists={}, vocabulary=words
    )
    assert part.n_docs == 5
    assert tuples(part.postings) == tuples(built.postings.where("term = 'love'"))
    stemmed = index.build_index(songs, lang_col=None, vocabulary=words)
    assert tuples(stemmed.postings) == tuples(built.postings.where("term = 'love'"))


def test_sorted_by_code_point(spark):
    rows = spark.createDataFrame(
        [("b", 2, 1), ("a", 1, 1), ("é", 1, 1), ("b", 1, 1), ("Z", 9, 1)],
        "term string, doc_id long, tf long",
    )
    got = [(r.term, r.doc_id) for r in index.sorted_index(rows).collect()]
    assert got == [("Z", 9), ("a", 1), ("b", 1), ("b", 2), ("é", 1)]


def test_counts_by_document_are_not_shuffled_again(spark):
    rows = [(i % 50 if i % 7 else None, f"a b{i % 3} a c{i}", "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for by_id in (False, True):
        found = index.term_frequencies(analyze_documents(docs, stem=False, by_id=by_id))
        shuffles = found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        held = sorted(map(str, found.collect()))
        if by_id:
            assert shuffles == 1 and held == before
        before = held


def test_a_written_table_is_not_written_again(spark):
    written = materialize(spark.range(3), "ids")
    assert materialize(written, "ids") is written
    assert materialize(written.where("id > 0"), "ids") is not written
