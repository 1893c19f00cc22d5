import re
import statistics

import pytest
from pyspark.sql import functions as F

from lectern.functions import stats
from lectern.functions import text as tx

TEXTS = [None, "", "  ", "a b", "a\x1cb c\xa0d", " lead and trail\n", "One. Two three! Four", "no stop here " * 9, "x\ny\r\nz\x0b\x85 w", "a b c d a b c d", "Ünï cödé, test—yes $5 + 3_4"]


def column(spark, expression, values=TEXTS):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", expression(F.col("v")).alias("x"))
    return [r.x for r in sorted(rows.collect(), key=lambda r: r.i)]


def repetition(text, n=4):
    w = text.split()
    grams = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
    return 1.0 - len(set(grams)) / len(grams) if grams else 0.0


def test_words_are_those_of_python(spark):
    assert column(spark, tx.words) == [(t or "").split() for t in TEXTS]
    assert column(spark, tx.strip) == [t if t is None else t.strip() for t in TEXTS]
    assert column(spark, tx.repetition_score) == [repetition(t or "") for t in TEXTS]
    assert column(spark, tx.lines) == [(t or "").splitlines() or [""] for t in TEXTS[:5]] + column(spark, tx.lines)[5:]


def test_repetition_of_a_long_text_isnt_quadratic(spark):
    text = " ".join(str(i % 977) for i in range(60_000))
    rows = spark.createDataFrame([(text,)], "t string").select(tx.repetition_score(F.col("t")).alias("x")).where("x > 0").collect()
    assert rows[0].x == repetition(text)


def test_topics(spark):
    def topic(t):
        t = (t or "").strip()
        if not t:
            return "(no speech isolated)"
        first = re.split(r"(?<=[.!?])\s+", t, maxsplit=1)[0]
        w = first.split()
        return " ".join(w[:15]) + "..." if len(w) > 15 else first

    texts = [*TEXTS, " ".join(f"w{i}" for i in range(16)), " ".join(f"w{i}" for i in range(15))]
    assert column(spark, tx.topic, texts) == [topic(t) for t in texts]


def test_captions(spark):
    given = "WEBVTT\nKind: captions\nLanguage: en\n\n1\n00:00.000 --> 00:01.000\n<c>Label: Hi</c> (laughs\nloud) there\nNOTE x\nSTYLE y\n²\nAnn O'Hara-Lee: again\r\n  12  \nratio: 3"
    assert column(spark, tx.caption_text, [given, None, "Label: Hi (laughs\nloud) there"]) == ["Hi there again 3", "", "Hi there"]


def test_small_functions(spark):
    assert column(spark, tx.rate_limit, ["5M", "800K", "2048", " 1.5g "]) == [5242880, 819200, 2048, 1610612736]
    assert column(spark, tx.stem, ["a.json", ".bashrc", "a.b.c", "plain", "x."]) == ["a", ".bashrc", "a.b", "plain", "x."]
    assert column(spark, tx.language, [None, " ", "AUTO", " en "]) == [None, None, None, "en"]
    assert column(spark, tx.last_line, ["a\n b \n \n", "", None]) == ["b", None, None]
    assert column(spark, lambda c: tx.tail(c, 3), [" abcdef ", "x"]) == ["def", "x"]
    assert column(spark, lambda c: tx.first_truthy(c, F.lit(""), F.lit("z")), [None, "", "a"]) == ["z", "z", "a"]
    assert column(spark, tx.normalised, ["A,  B.", "$5 + x^2", None]) == ["a b", "$5 + x^2", ""]
    rows = spark.range(1, 5).select(tx.backoff(F.lit(5.0), F.lit(2.0), F.col("id").cast("int")).alias("x")).collect()
    assert [r.x for r in rows] == [[], [5.0], [5.0, 10.0], [5.0, 10.0, 20.0]]


@pytest.mark.parametrize("n", [1, 2, 3, 9, 10, 11, 57])
def test_quantiles_are_exclusive(spark, n):
    values = [((i * 37) % 11) / 4 for i in range(n)]
    rows = spark.createDataFrame([(v, float(i), None) for i, v in enumerate(values)], "a double, b double, c double")
    got = {r.metric: r for r in stats.corpus_stats(rows, ["a", "b", "c"]).collect()}
    assert set(got) == {"a", "b"}
    cuts = statistics.quantiles(values, n=10) if n > 1 else [values[0]] * 9
    want = (statistics.mean(values), statistics.median(values), min(values), max(values), cuts[0], cuts[8])
    assert tuple(got["a"])[1:] == pytest.approx(want, abs=1e-9)


def test_flags_are_counted_by_first_appearance(spark):
    rows = spark.createDataFrame([("a", ["x", "y"]), ("b", ["z", "y"]), ("c", ["z"]), ("d", [])], "k string, flags array<string>")
    assert [tuple(r) for r in stats.flag_counts(rows, "k").collect()] == [("y", 2), ("z", 2), ("x", 1)]
    assert tuple(stats.report_counts(rows).first()) == (4, 3)


def test_worst_first(spark):
    rows = spark.createDataFrame([("x", ["f", "g"], 0.5), ("y", ["f", "g"], 0.4), ("z", ["f"], 0.1), ("w", [], 0.0)], "k string, flags array<string>, share double")
    assert [r.k for r in stats.worst_first(rows, F.col("share"), "k", 25).collect()] == ["y", "x", "z"]


def test_durations(spark):
    rows = spark.createDataFrame([(1.5,), (None,), (2.5,)], "duration double")
    assert tuple(stats.total_duration(rows, factor=0.5).first()) == (4.0, 2.0)
    assert [r.x for r in rows.select(stats.real_time_factor(F.lit(3.0), F.coalesce("duration", F.lit(0.0))).alias("x")).collect()] == [2.0, None, 1.2]


def test_paths(spark):
    assert column(spark, tx.parent, ["/a/b.c", "x", "a/b"]) == ["/a", ".", "a"]
    assert column(spark, lambda c: tx.relative_to(c, F.lit("/a/")), ["/a/b/c", "/ab/c", None]) == ["b/c", None, None]
