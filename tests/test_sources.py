import pytest
from pyspark.sql import functions as F

from conftest import tuples
from simsearch.plans import storage
from simsearch.sources import media, tables, vectors


def test_songs_from_csv(spark, tmp_path):
    head = ",".join(f.name for f in tables.SONGS)
    path = tmp_path / "songs.csv"
    path.write_text(
        head + '\n7,t1,"line one\nline ""two"", end",Name,Artist,,,,,es,2001\n', encoding="utf-8"
    )
    row = tables.read_songs(spark, str(path)).first()
    assert row.doc_id == 7 and row.lyrics == 'line one\nline "two", end'
    assert row.track_album_name is None and row.language == "es"


def test_track_ids_are_numbers(spark, tmp_path):
    path = tmp_path / "tracks.csv"
    path.write_text("track_id,track_title,artist_name\n037156,Song,Ana\n")
    assert tuples(tables.read_tracks(spark, str(path))) == [(37156, "Song", "Ana")]


@pytest.mark.parametrize("at_once", [10_000, 0])
def test_slices(spark, at_once):
    df = spark.range(100).select((F.col("id") * 3).alias("doc_id")).repartition(3)
    got = tables.corpus_slice(df, 20, at_once=at_once)
    assert sorted(r.doc_id for r in got.collect()) == [3 * i for i in range(20)]
    assert tables.corpus_slice(df, 500, at_once=at_once).count() == 100
    with pytest.raises(ValueError):
        tables.corpus_slice(df, 0)


@pytest.mark.parametrize("kind", ["bigint", "string", "date", "timestamp"])
@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 9])
def test_slices_of_null_and_repeated_ids(spark, kind, n):
    rows = [(1, "a"), (2, "b"), (2, "c"), (2, "c"), (3, "d"), (None, "e"), (None, "f")]
    ids = {"bigint": F.col("i"), "string": F.col("i").cast("string"),
           "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("i")),
           "timestamp": F.timestamp_seconds(F.col("i"))}[kind]
    df = spark.createDataFrame(rows, "i int, v string").select(ids.alias("doc_id"), "v").repartition(3)
    small, cut = (sorted(map(str, tables.corpus_slice(df, n, at_once=a).collect())) for a in (10_000, 0))
    assert small == cut and len(cut) == min(n, 7)
    assert sum("None" in r for r in cut) == min(n, 2)


def test_vector_files(spark, tmp_path):
    path = str(tmp_path / "v")
    df = spark.range(25).select(
        F.col("id").alias("vec_id"), F.array(F.col("id").cast("float")).alias("embedding")
    ).coalesce(1)
    vectors.write_vectors(df, path, batch_size=10)
    files = [p for p in (tmp_path / "v").iterdir() if p.suffix == ".parquet"]
    assert len(files) == 3
    (tmp_path / "v" / "broken.parquet").write_bytes(b"not parquet")
    read = vectors.read_vectors(spark, path)
    assert tuples(read) == tuples(df)
    assert sorted(r.vec_id for r in vectors.read_vectors(spark, path, 4).collect()) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        vectors.read_vectors(spark, path, 0)


def test_media(spark, tmp_path):
    for name in ("000/a.b.mp3", "001/c.MP3", "007/d.wav", "other/e.mp3", "001/f.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"xy")
    root = str(tmp_path)
    found = media.media_catalog(spark, root).select("id", "folder", "length")
    assert tuples(found) == [("a.b", "000", 2), ("d", "007", 2), ("e", "other", 2)]
    some = media.media_catalog(spark, root, [".mp3"], (0, 5), ignore_case=True)
    assert sorted(r.id for r in some.collect()) == ["a.b", "c"]
    assert media.media_catalog(spark, root, limit=1).count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_shared_folder_is_the_sessions(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert storage.new_table_path(spark, "x").startswith(folder)


def test_songs_are_searched_by_their_text_columns(spark):
    from simsearch.operators import index, search

    empty = [None] * len(tables.SONGS)
    names = tables.SONGS.fieldNames()

    def song(**fields):
        row = dict(zip(names, empty), **fields)
        return tuple(row[n] for n in names)

    songs = spark.createDataFrame(
        [
            song(doc_id=1, lyrics="Bailando sola", track_name="Tarde", language="es"),
            song(doc_id=2, lyrics="dancing alone", playlist_genre="latin dance", language="en"),
            song(doc_id=3, lyrics=None, track_artist="Ana Baila", language="es"),
        ],
        tables.SONGS,
    )
    built = index.build_index(songs, text_cols=tables.SONG_TEXT, lang_col="language")
    terms = {r.term: r.df for r in built.terms.collect()}
    assert terms["bail"] == 2 and terms["danc"] == 1 and terms["tard"] == 1
    hits = search.liketo(
        songs, "lyrics", "bailan", ["title", "artist"], lang_col="language"
    ).collect()
    assert [tuple(r) for r in hits] == [("Tarde", "Unknown")]
