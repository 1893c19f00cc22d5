import hashlib
import random
import re
import struct
import zlib

import xxhash
import zstandard
from pyspark.sql import functions as F

from lectern.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held, train = langid.in_training()
    model = langid.fit_dictionaries(docs, train)
    assert sorted(model) == ["de", "en", "es", "fr"] and model == langid.fit_dictionaries(docs.repartition(5), train)
    rows = langid.identify(docs.withColumn("held", held), model, keep=("doc_id", "lang", "held")).collect()
    assert len(rows) == docs.count()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r.held]
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.96 * len(tested)
    assert sum(r.rejected for r in rows) <= 0.02 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_and_ids_are_no_inputs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit_dictionaries(docs)
    shuffled = docs.select((F.col("doc_id") + 7).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    ask = lambda d: sorted((r.lang_pred, r.score) for r in langid.identify(d, model).collect())
    assert ask(docs) == ask(shuffled)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "12 34!? \n"), (4, "the " * 50_000), (5, "ab"), (5, "ab"), (None, "é")]
    frame = spark.createDataFrame([(d, t, True, 1.0) for d, t in rows], "doc_id long, text string, rejected boolean, score double")
    model = {"aa": b"the of and to " * 40, "bb": b"der die das und " * 40}
    got = langid.identify(frame, model).collect()
    assert [(r.doc_id, r.lang_pred) for r in got if r.doc_id in (1, 2, 3)] == [(i, "und") for i in (1, 2, 3)]
    assert [r.lang_pred for r in got if r.doc_id == 4] == ["aa"]
    assert len(got) == len(rows) and all(r.lang_pred in ("aa", "bb", "und") for r in got)
    kept = langid.keep_identified(frame, model)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} >= {4} and not {1, 2, 3} & {r.doc_id for r in kept.collect()}


def test_equal_sizes_are_rejected():
    classify = langid.Classifier({"a": b"one two three", "b": b"one two three"})
    assert classify("one two three four") == ("a", 0.5, True)


def spark_hash(doc, seed):
    """xxhash64(doc, seed) as Spark has it: the columns one after the other, each seeded by the hash before."""
    h = xxhash.xxh64_intdigest(struct.pack("<i", seed), xxhash.xxh64_intdigest(struct.pack("<q", doc), 42))
    return h - (1 << 64) if h >> 63 else h


def bare(text):
    """Lower case, whatever is no ASCII letter as space, but for other bytes; single spaces."""
    return re.sub(rb"[^a-z\x80-\xff]+", b" ", text.lower().encode()).strip()


def test_dictionaries_and_sizes_against_brute_force(spark):
    """The sample, the dictionaries and every decision again, in plain Python from the description."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.collect()]
    want = {}
    for lang in {l for *_, l in rows if l}:
        own = sorted(((spark_hash(d, 7), d, t) for d, t, l in rows if l == lang))[:30]
        cut = [(d, t[(a := spark_hash(d, 8) % (max(0, len(t) - 400) + 1)) : a + 400]) for _, d, t in own if t]
        want[lang] = b" ".join(bare(piece) for _, piece in sorted(cut))
    model = langid.fit_dictionaries(docs, sample_docs=30)
    assert model == want
    how = zstandard.ZstdCompressionParameters(window_log=19, hash_log=min(17, max(map(len, want.values())).bit_length()), chain_log=min(17, max(map(len, want.values())).bit_length()), search_log=4, min_match=4, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_dict_id=False)
    for text in [t for _, t, _ in rows[:150]] + ["short", "une phrase courte"]:
        data, found = bare(text), {}
        if not re.search("[^\\W\\d_]", text):
            continue
        for lang, words in want.items():
            given = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            given.precompute_compress(compression_params=how)
            total = 0
            for i in range(0, len(data), 4096):
                block = data[i : i + 4096]
                while len(block) < 256:
                    block = (data[i : i + 4096] + b" ") * (len(block) // (len(data[i : i + 4096]) + 1) + 1)
                total += len(zstandard.ZstdCompressor(dict_data=given, compression_params=how).compress(block))
            found[lang] = total
        lang, score, rejected = langid.Classifier(model)(text)
        least, second = sorted(found.values())[:2]
        assert lang == min(found, key=lambda x: (found[x], x)) and rejected == ((second - least) / second < 0.002)


def test_many_languages(spark):
    words = [[hashlib.sha256(f"{lang}-{w}".encode()).hexdigest().translate(str.maketrans("0123456789", "ghijklmnop"))[:7] for w in range(40)] for lang in range(90)]
    rows = [(i, " ".join(random.Random(i).choices(words[i % 90], k=60)), f"l{i % 90:02}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_dictionaries(docs, all_slices=450)
    assert len(model) == 90
    got = langid.identify(docs.where("doc_id < 90"), model, keep=("doc_id", "lang")).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.9 * len(got)


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.fit_dictionaries(empty) == {}
    rows = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.fit_dictionaries(rows) == {}
    assert [(r.lang_pred, r.rejected) for r in langid.identify(rows, {}).collect()] == [("und", True)]
    assert langid.identify(empty, {}).count() == 0
