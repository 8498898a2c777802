import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from simsearch.llm import sketch, substring_dedup
from simsearch.llm.texts import pieces, utf8
from simsearch.llm.words import Words, sliding

TEXTS = st.lists(
    st.one_of(st.none(), st.text(alphabet="aAb é日\t\n\x0b\x0c\r \x1f\xa0", max_size=30)), max_size=8
)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_words_are_runs_without_white_space(texts):
    words = Words(pa.array(texts, pa.string()))
    found = [words.raw[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends)]
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert found == [w for ws in split for w in ws]
    assert words.counts.tolist() == [len(ws) for ws in split]
    numbers = {w: h for w, h in zip(found, words.hashes().tolist())}
    assert all(numbers[w] == h for w, h in zip(found, words.hashes().tolist()))
    assert len(set(numbers.values())) == len(numbers)


def test_runs_agree_wherever_they_stand():
    words = Words(pa.array(["a b c d", None, "x a b c", "b a c"]))
    runs, fits = words.runs(words.hashes(), 3), words.fits(3)
    assert fits.tolist() == [True, True, False, False, True, True, False, False, True, False, False]
    assert runs[0] == runs[5] and len(set(runs[fits].tolist())) == 4


def test_lower_case_is_ascii_only():
    a, b = (Words(pa.array([t]), lower=True).hashes().tolist() for t in ("ABÉ", "abÉ"))
    assert a == b != Words(pa.array(["abé"]), lower=True).hashes().tolist()


def test_sliding():
    values = np.array([5, 3, 9, 1, 4, 2])
    assert sliding(np.minimum, values, 4).tolist() == [1, 1, 1, 1, 2, 2]
    assert sliding(np.maximum, values[:1], 4).tolist() == [5]


@pytest.mark.parametrize("size", range(21))
def test_sliding_of_any_size(size):
    values = np.random.default_rng(size).integers(0, 100, size)
    assert sliding(np.minimum, values, 16).tolist() == [values[i:i + 16].min() for i in range(size)]


def test_a_table_of_one_short_row(spark):
    docs = spark.createDataFrame([(1, "five words are not many")], "doc_id long, text string")
    got = substring_dedup.remove_repeats(docs).first()
    assert (got.n_words, got.n_removed, got.kept_text) == (5, 0, "five words are not many")


def test_pieces_keep_all_rows_and_sliced_columns():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * 50, None, "b", "c" * 300, ""])}).slice(1)
    parts = list(pieces(iter([batch]), limit=100))
    assert [t for p in parts for t in p.column("text").to_pylist()] == [None, "b", "c" * 300, ""]
    raw, at = utf8(batch.column("text"))
    assert raw.tobytes() == b"b" + b"c" * 300 and at.tolist() == [0, 0, 1, 301, 301]


def test_sketch_misses_nothing_repeated(spark):
    values = np.random.default_rng(0).integers(0, 2**63, 30_000).astype(np.uint64)
    hashes = np.concatenate([values, values[:500]])
    bits, rows = sketch.width_bits(len(hashes), 2), 2

    def run(batches):
        for batch in batches:
            own = hashes[batch.column("id").to_numpy()]
            yield from sketch.sketched(iter([own]), bits, rows)

    parts = spark.range(len(hashes)).repartition(4).mapInArrow(run, sketch.PARTS)
    repeated = sketch.merged(parts, bits, rows)
    assert repeated(values[:500]).all()
    assert repeated(values[500:]).mean() < 0.1
    narrow = sketch.merged(spark.range(0).mapInArrow(run, sketch.PARTS), bits, rows)
    assert not narrow(values).any()


def test_a_saturated_sketch_only_overestimates():
    hashes = np.arange(2_000_000, dtype=np.uint64)
    part = sketch.partition_sketch(hashes, sketch.SLICE_BITS, 1)
    merged = list(sketch._merge(iter([part])))
    slices = [(b.column("slice")[0].as_py(), b.column("cells")[0].as_py()) for b in merged]
    repeated = sketch.Repeated(slices, sketch.SLICE_BITS, 1)
    assert repeated(hashes).mean() > 0.8
