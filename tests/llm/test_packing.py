import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lectern.llm import packing, tokenizing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a  b\n\n c\t d 's it's", "  x", "x   y", "áb é", "I'll  do<|endoftext|>  ok", "\x1c a;\x1cb", "漢字 テスト🙂 x", "a b  c", "", "   ", "\n", "x" * 3000, "don't_do 12,5!?", "A.B_c'd", "<|endoftext|>", "a <|endoftext|> b", "A<|STARTOFTEXT|>b <|startoftext|>\n<|EndOfText|>", "a <| b |>", "hello <|endoftext|><|endoftext|> world"]


def library(path):
    return Tokenizer.from_file(path)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_as_whole_texts_do(spark, sf, name):
    encode, whole = tokenizing.PieceEncoder(public_tokenizers.path(name), remembered=50), library(public_tokenizers.path(name))
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text[:80]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é'.,\n\t  _1²ΣÄ-s"), max_size=30))
def test_any_text_encodes_as_the_library_does(text):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        assert np.frombuffer(tokenizing.encoder(path)(text), "<u4").tolist() == tokenizing.encoder(path).whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "\n", "word", "é", "."]), max_size=12))
def test_special_strings_encode_as_the_library_does(parts):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        plain = Tokenizer.from_file(path) if name not in _PLAIN else _PLAIN[name]
        _PLAIN[name] = plain
        assert np.frombuffer(tokenizing.encoder(path)("".join(parts)), "<u4").tolist() == plain.encode("".join(parts), add_special_tokens=False).ids


_PLAIN = {}


def test_special_strings_as_text():
    whole = library(PATH)
    whole.encode_special_tokens = True
    for text in ODD:
        assert np.frombuffer(tokenizing.encoder(PATH, True)(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=40))
def test_histogram_is_used_exactly(histogram):
    bins = packing.pack_histogram(histogram, 64)
    used = Counter()
    for parts, n in bins:
        assert sum(parts) <= 64 and n > 0
        for p in parts:
            used[p] += n
    assert used == Counter(histogram)
    total = sum(k * v for k, v in histogram.items())
    assert sum(n for _, n in bins) <= 2 * -(-total // 64) + 1


def test_pattern_packing_is_nearly_full():
    rng = random.Random(3)
    histogram = Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(50_000))
    bins = packing.pack_histogram(histogram)
    assert sum(n for _, n in bins) <= 1.01 * -(-sum(k * v for k, v in histogram.items()) // 2048)


def test_pack_against_plain_encoding(spark, sf):
    whole = library(PATH)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(10**6 + i, t) for i, t in enumerate(ODD)] + [(None, None), (None, "same"), (5 * 10**6, "same"), (5 * 10**6, "same"), (7, "one two " * 20_000)]
    frame = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, length int, sequence_id int")
    rows = packing.pack(frame, PATH).collect()
    want = Counter()
    for doc, text in docs:
        ids = [*(whole.encode(text, add_special_tokens=False).ids if text else []), 0]
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)] if len(ids) > 2048 else [0, len(ids)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= 1.08 * -(-sum(r.length for r in rows) // 2048) + 1


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (2, None), (3, "x y " * 40)], "doc_id long, text string")
    rows = packing.sequences(docs, PATH, capacity=32).collect()
    whole = library(PATH)
    want = sorted(i for t in ("a b c", "", "", "x y " * 40) for i in [*whole.encode(t, add_special_tokens=False).ids, 0])
    assert sorted(i for r in rows for i in r.ids) == want
    assert all(len(r.ids) <= 32 and r.ends[-1] == len(r.ids) for r in rows)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
