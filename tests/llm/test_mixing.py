import re
from collections import Counter, defaultdict
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, weights, epochs):
    """Clamp and reshare until no source is above its cap."""
    total, clamped = sum(sizes), set()
    while True:
        rest = total - sum(epochs * sizes[i] for i in clamped)
        open_ = [i for i in range(len(sizes)) if i not in clamped]
        weight = sum(weights[i] for i in open_)
        target = [Fraction(epochs * s) for s in sizes]
        for i in open_:
            target[i] = Fraction(rest * weights[i], weight)
        over = [i for i in open_ if target[i] > epochs * sizes[i]]
        if not over:
            return target
        clamped.update(over)


def test_targets_against_resharing(spark):
    @settings(max_examples=12, deadline=None)
    @given(st.lists(st.integers(0, 10_000), min_size=1, max_size=12))
    def run(sizes):
        frame = spark.createDataFrame([(f"s{i:02}", n) for i, n in enumerate(sizes)], "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
        want = filled(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(sizes))], 3)
        for i, t in enumerate(want):
            assert abs(got[f"s{i:02}"] - float(t)) <= 1e-9 * max(1, sum(sizes))

    run()


def check(docs, rows):
    sizes = defaultdict(int)
    for d, t, s in docs:
        sizes[s] += len(WORD.findall(t or ""))
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = dict(zip(names, filled([sizes[s] for s in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))], 3)))
    assert Counter((r.doc_id, r.size, r.source_size) for r in rows) == Counter((d, len(WORD.findall(t or "")), sizes[s]) for d, t, s in docs)
    by_size = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        by_size[r.source_size, round(r.target, 6)] += r.taken
    expected = defaultdict(int)
    for s in names:
        expected[sizes[s], round(float(want[s]), 6)] += want[s]
    for key, total in expected.items():
        assert abs(by_size[key] - total) <= len(names)
    return want


def test_whole_table_and_odd_rows(spark, sf):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    for more in ([], [(10**6, None, "a"), (10**6 + 1, "", None), (10**6 + 2, "one two", None), (None, "null id", "é"), (5, "same", "a"), (5, "same", "a"), (10**6 + 3, "long " * 50_000, "Z")]):
        frame = spark.createDataFrame([(d, t, s, 1, "x") for d, t, s in docs + more], "doc_id long, text string, source string, size int, target string")
        rows = mixing.mix_report(frame).collect()
        check(docs + more, rows)
        assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.mix_report(frame.repartition(3)).collect()))


def test_the_mix_itself(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("target", F.lit("kept")).withColumn("_carry", F.lit(1)).withColumn("_row", F.lit(2))
    taken = {r.doc_id: r.taken for r in mixing.mix_report(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words, texts = defaultdict(int), {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert r.target == "kept" and (r._carry, r._row) == (1, 2) and r.n_chars is not None
        assert r.text == texts[r.doc_id] or WORD.findall(texts[r.doc_id])[: len(WORD.findall(r.text))] == r.text.split(" ")
    assert words == {d: n for d, n in taken.items() if n}
    assert abs(sum(taken.values()) - sum(len(WORD.findall(t)) for t in texts.values())) <= 20


def test_word_count(spark):
    texts = [None, "", " ", "a", "a\x1cb c", " a\tb\x0b\x0cc\r\n", "w" * 1000, "ä ö ü"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", mixing.word_count(F.col("t")).alias("n")).collect()
    assert {r.i: r.n for r in rows} == {i: len(WORD.findall(t or "")) for i, t in enumerate(texts)}


def test_empty_table(spark):
    assert mixing.mix_report(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
