import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lectern.llm import token_codes

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 255), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=1500), st.data())
def test_round_trip_and_random_access(ids, data):
    reader = token_codes.Reader(token_codes.encode(np.array(ids, np.uint32)))
    assert len(reader) == len(ids)
    assert reader.slice(0, len(ids)).tolist() == ids
    if ids:
        i = data.draw(st.integers(0, len(ids) - 1))
        j = data.draw(st.integers(i, len(ids)))
        assert reader[i] == ids[i]
        assert reader.slice(i, j).tolist() == ids[i:j]


def test_files_against_plain_encoding(spark, sf):
    whole = Tokenizer.from_file(PATH)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(10**6, None), (10**6 + 1, ""), (-5, "one two " * 20_000), (10**6 + 3, "<|endoftext|> 漢字🙂"), (10**6 + 4, "A <|startoftext|>b"), (10**6 + 5, "<|ENDOFTEXT|>")]
    frame = spark.createDataFrame([(t, d, 0) for d, t in docs], "text string, doc_id long, part int")
    got = sorted((tuple(r) for r in token_codes.encode_and_read(frame, PATH, segment_ids=5000).collect()))
    want, start = [], 0
    for doc, text in sorted(docs, key=lambda x: x[0]):
        ids = np.array([*(whole.encode(text, add_special_tokens=False).ids if text else []), 2], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want


def test_repeated_and_null_ids(spark):
    frame = spark.createDataFrame([(None, "b"), (1, "a"), (1, "a"), (None, "b c")], "doc_id long, text string")
    rows = sorted(token_codes.encode_and_read(frame, PATH).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 1, 1]
    assert [r.start for r in rows] == list(np.cumsum([0, *[r.n_tokens for r in rows]])[:-1])


def test_ids_of_other_types(spark):
    frame = spark.createDataFrame([("2020-01-02", "b c"), ("2020-01-01", "a"), (None, "d")], "d string, text string").selectExpr("cast(d as date) as doc_id", "text")
    rows = sorted(token_codes.encode_and_read(frame, PATH).collect(), key=lambda r: r.start)
    assert [str(r.doc_id) for r in rows] == ["None", "2020-01-01", "2020-01-02"]


def test_empty_table(spark):
    assert token_codes.encode_and_read(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
