import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import accuracy, acquisition, alignment, export, ledger, models, pairs, quality
from lectern.schemas import METADATA, TRANSCRIPT


def turns(spark, rows):
    return spark.createDataFrame([("v", s, float(a), float(b)) for s, a, b in rows], "video_id string, speaker string, start double, end double")


def test_equal_totals_go_to_the_first_turn(spark):
    stats = alignment.speaker_stats(turns(spark, [("B", 0, 2), ("A", 2, 5), ("B", 5, 6)]), "video_id")
    assert {r.speaker: (r.total_seconds, r.turn_count) for r in stats.collect()} == {"A": (3.0, 1), "B": (3.0, 2)}
    assert alignment.target_speaker(stats, "video_id").first().target_speaker == "B"
    with pytest.raises(ValueError):
        alignment.target_speaker(stats, "video_id", strategy="other")


def test_midpoints_on_the_ends_are_inside(spark):
    words = spark.createDataFrame([("v", i, a, b) for i, (a, b) in enumerate([(0.5, 1.5), (1.5, 2.5), (2.0, 2.2)])], "video_id string, i int, start double, end double")
    assert sorted(r.i for r in alignment.in_turns(words, turns(spark, [("A", 1, 2)]), "video_id").collect()) == [0, 1]
    odd = words.union(spark.createDataFrame([("v", 9, None, 1.0), (None, 8, 1.0, 1.2), ("v", 0, 0.5, 1.5), ("other", 7, 1.0, 1.2)], words.schema))
    held = turns(spark, [("A", 0, 0.2), ("A", 1, 2), ("A", 1, 1.5), ("A", 5, 4), ("A", 30, 40)])
    held = held.union(spark.createDataFrame([("v", "A", None, 99.0), ("v", "A", 0.0, None), (None, "A", 0.0, 99.0)], held.schema))
    assert sorted(r.i for r in alignment.in_turns(odd, held, "video_id").collect()) == [0, 0, 1]
    nested = words.withColumn("t", F.array(F.struct(F.lit(1.0).alias("start"), F.lit(2.0).alias("end"))))
    assert sorted(r.i for r in nested.where(alignment.in_turn_array((F.col("start") + F.col("end")) / 2, F.col("t"))).collect()) == [0, 1]


def transcript(words, text="t", duration=100.0):
    segments = [(0, 0.0, 100.0, text, words)]
    return ("v", "v.wav", "en", 1.0, duration, ("m", "cpu", "int8"), segments, text, "now")


def test_isolation_end_to_end(spark):
    rng = random.Random(2)
    spoken = [("A" if rng.random() < 0.6 else "B", float(i), float(i + 1)) for i in range(60)]
    words = [(i + 0.1, i + 0.7, f" w{i}", 0.9) for i in range(60)]
    doc = spark.createDataFrame([transcript(words), ("silent", None, None, None, None, None, [], "", None)], TRANSCRIPT)
    got = alignment.isolate(doc, turns(spark, spoken)).collect()
    assert [r.video_id for r in got] == ["v"]
    total = {s: sum(b - a for x, a, b in spoken if x == s) for s in "AB"}
    target = max(total, key=total.get)
    want, run = [], []
    for i, (s, _, _) in enumerate(spoken):
        if s == target:
            run.append(i)
        elif run:
            want.append(run)
            run = []
    want += [run] if run else []
    assert got[0].target_speaker == target
    assert [(s.id, s.start, s.end, s.text) for s in got[0].target_speaker_segments] == [(k, r[0] + 0.1, r[-1] + 0.7, " ".join(f"w{i}" for i in r)) for k, r in enumerate(want)]
    assert got[0].target_speaker_text == " ".join(f"w{i}" for r in want for i in r)
    assert {k: (v.total_seconds, v.turn_count) for k, v in got[0].speakers.items()} == {s: (total[s], sum(x == s for x, _, _ in spoken)) for s in "AB"}


def test_segments_without_words_are_glued(spark):
    doc = spark.createDataFrame([("v", None, None, None, 4.0, None, [(0, 0.0, 1.0, "Hello", None), (1, 1.0, 2.0, "world", [])], "", None)], TRANSCRIPT)
    assert alignment.isolate(doc, turns(spark, [("A", 0, 4)])).first().target_speaker_text == "Helloworld"


def test_transcript_quality(spark):
    docs = [transcript([(0.0, 8.0, "a", 0.2), (2.0, 9.0, "b", None)], "a b c d a b c d", 10.0), ("e", None, None, None, None, None, None, None, None)]
    rows = {r.video_id: r for r in quality.transcript_quality(spark.createDataFrame(docs, TRANSCRIPT)).collect()}
    assert rows["v"].speech_coverage_ratio == 1.0 and rows["v"].avg_word_confidence == 0.2 and rows["v"].low_confidence_word_ratio == 1.0
    assert rows["v"].flags == ["low_avg_confidence", "many_low_confidence_words", "implausibly_slow"]
    assert rows["v"].repetition_score == pytest.approx(0.2)
    assert rows["e"].flags == ["low_speech_coverage", "empty_transcript"] and rows["e"].avg_word_confidence is None


def test_diarization_quality(spark):
    schema = "video_id string, duration double, speakers map<string,struct<total_seconds:double,turn_count:int>>, target_speaker string, turns array<struct<speaker:string,start:double,end:double>>, target_speaker_segments array<struct<id:int,start:double,end:double,text:string>>, target_speaker_text string"
    docs = [("none", None, {}, None, [], [], ""), ("some", 10.0, {"A": (1.0, 2), "B": (9.0, 1)}, "A", [("A", 0.0, 0.2), ("A", 1.0, 1.8), ("B", 2.0, 9.0)], [(0, 0.0, 1.0, "x"), (1, 3.0, 2.0, "y")], "a b c d e")]
    counts = spark.createDataFrame([("some", 0), ("other", 5)], "video_id string, full_transcript_word_count int")
    rows = {r.video_id: r for r in quality.diarization_quality(spark.createDataFrame(docs, schema), counts).collect()}
    assert rows["none"].flags == ["empty_target_text", "single_speaker_detected"]
    some = rows["some"]
    assert (some.target_speaker_share, some.short_turn_ratio, some.avg_target_segment_seconds, some.target_words_per_second) == (0.1, 0.5, 0.5, 5.0)
    assert some.target_text_retention_ratio is None
    assert some.flags == ["low_target_speaker_share", "fragmented_turns", "implausibly_fast"]


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j - 1] + (x != y), before[j] + 1, row[j - 1] + 1))
    return row[-1]


def whole_table(a, b):
    """(hits, substitutions, deletions, insertions) from the whole table of costs, walked back by the rule."""
    cost = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + (a[i - 1] != b[j - 1]), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
    i, j, n = len(a), len(b), [0, 0, 0, 0]
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + (a[i - 1] != b[j - 1]):
            i, j, k = i - 1, j - 1, int(a[i - 1] != b[j - 1])
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i, k = i - 1, 2
        else:
            j, k = j - 1, 3
        n[k] += 1
    return tuple(n)


def test_alignments_against_the_whole_table():
    rng = random.Random(11)
    for letters in ("ab", "abc", "abcdefgh"):
        for _ in range(300):
            a, b = ([rng.choice(letters) for _ in range(rng.randrange(0, 14))] for _ in range(2))
            assert accuracy.align(a, b) == whole_table(a, b), (a, b)
    assert accuracy.align("a b".split(), "b a".split()) == (0, 2, 0, 0)


def test_long_texts_of_many_different_words(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = spark.createDataFrame([("a", long, "x"), ("b", "x", long), ("c", " ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i}" for i in range(1, 3001)))], "video_id string, reference string, hypothesis string")
    got = {r.video_id: r for r in rows.select("video_id", accuracy.word_rates(F.col("reference"), F.col("hypothesis")).alias("m")).select("video_id", "m.*").collect()}
    assert (got["a"].wer, got["b"].wer, got["c"].wer) == (1.0, 60_000.0, 2 / 3000)
    assert got["c"].mer == pytest.approx(2 / 3001) and got["c"].wil == pytest.approx(1 - (2999 / 3000) ** 2)


def test_error_rates(spark):
    rng = random.Random(5)
    data = [(str(i), " ".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 30))), " ".join(rng.choice("abcdef") for _ in range(rng.randrange(0, 30)))) for i in range(60)]
    data += [("same", "Hello, World!", "hello world"), ("none", "...", "x y"), ("both", "...", "")]
    rows = {r.video_id: r for r in accuracy.score(spark.createDataFrame(data, "video_id string, reference string, hypothesis string")).collect()}
    for k, ref, hyp in data[:60]:
        a, b = ref.split(), hyp.split()
        assert rows[k].wer == plain_distance(a, b) / len(a)
        assert rows[k].cer == plain_distance(ref, hyp) / len(ref)
        h, s, d, i = accuracy.align(a, b)
        assert s + d + i == plain_distance(a, b) and h + s + d == len(a) and h + s + i == len(b)
        assert rows[k].mer == (s + d + i) / (len(a) + i)
        assert rows[k].wil == (1 - h * h / (len(a) * len(b)) if b else 1.0)
    assert (rows["same"].wer, rows["same"].cer, rows["same"].mer, rows["same"].wil) == (0.0, 0.0, 0.0, 0.0)
    assert rows["none"].wer == 2.0 and rows["both"].wer == 0.0


def test_reference_buckets(spark):
    refs = spark.createDataFrame([("a", "x"), ("b", " "), ("c", " "), ("d", None)], "video_id string, reference string")
    hyps = spark.createDataFrame([("a", "x"), ("b", "y"), ("d", "z")], "video_id string, hypothesis string")
    rows = accuracy.covered(refs, hyps)
    assert {r.video_id: r.bucket for r in rows.collect()} == {"a": "scored", "b": "empty_reference", "c": "missing_transcript", "d": "empty_reference"}
    assert tuple(accuracy.coverage_counts(rows).first()) == (1, 1, 2)


def test_ledger(spark):
    stale = spark.createDataFrame([("a", "success", "x"), ("b", "failed", "y"), ("", "success", "z")], "video_id string, status string, other string")
    full = ledger.migrate(stale)
    assert full.columns == list(ledger.DOWNLOAD) and {r["mode"] for r in full.collect()} == {"video"}
    assert [tuple(r) for r in ledger.completed(full, ("video_id", "mode")).collect()] == [("a", "video")]
    items = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "video_id string")
    finished = ledger.done(full, items.where("video_id = 'c'"))
    assert sorted(r.video_id for r in ledger.pending(items, finished).collect()) == ["b", "d"]
    rows = ledger.classify(items, finished, required=items.where("video_id <> 'd'"))
    assert {r.video_id: r.status for r in rows.collect()} == {"a": "skipped", "b": "would_process", "c": "skipped", "d": "missing"}
    assert tuple(ledger.summary(rows, ("skipped", "missing", "would_process")).first()) == (2, 1, 1, 4)
    paths = spark.createDataFrame([("s", "s.mp4"), ("s", "s.mkv"), ("t", "t.mp4")], "stem string, path string")
    assert sorted(r.path for r in ledger.first_of_stem(paths).collect()) == ["s.mkv", "t.mp4"]


def test_numbers_follow_the_order(spark, monkeypatch):
    monkeypatch.setattr(ledger, "RANGES", 7)
    rng = random.Random(12)
    keys = rng.sample(range(100_000), 300)
    rows = spark.createDataFrame([(k, rng.choice(["a", "b", None]), "x") for k in keys] + [(None, "a", "y")], "k long, s string, _row string").repartition(5)
    for by in (None, "s"):
        got = ledger.numbered(rows, "k", by).collect()
        assert len(got) == 301
        for group in {r.s if by else 0 for r in got}:
            own = sorted([r for r in got if not by or r.s == group], key=lambda r: r.i)
            assert [r.i for r in own] == list(range(1, len(own) + 1)) and {r.n for r in own} == {len(own)}
            assert own == sorted(own, key=lambda r: (r.k is not None, r.k or 0))
    words = spark.createDataFrame([(w,) for w in ("é", "a", "Z", "b", "")], "w string")
    assert [r.w for r in sorted(ledger.numbered(words, "w").collect(), key=lambda r: r.i)] == ["", "Z", "a", "b", "é"]
    assert ledger.numbered(rows.limit(0), "k").count() == 0


def test_export(spark):
    rows = spark.createDataFrame([("a", " Hi there. More."), ("b", None), ("c", "x"), ("d", "y")], "video_id string, text string")
    titles = spark.createDataFrame([("a", "Title"), ("c", None)], "video_id string, title string")
    topics = {r.video_id: (r.topic, r.title_source) for r in export.with_topics(rows, titles).collect()}
    assert topics == {"a": ("Title", "title"), "b": ("(no speech isolated)", "unknown"), "c": ("x", "known_failure"), "d": ("y", "unknown")}
    text = export.combined(export.blocks(export.with_topics(rows.where("video_id in ('a', 'c')"), None))).first().text
    assert text == "Topic: Hi there.\nText: Hi there. More.\n" + "\n" + "-" * 80 + "\n\n" + "Topic: x\nText: x\n"


def test_acquisition(spark):
    rows = spark.createDataFrame([(0, None), (1, "a"), (2, "b")], "position int, id string")
    assert [r.id for r in acquisition.entries(rows, 2).collect()] == ["a"]
    assert acquisition.entries(rows, 0).count() == 0 and acquisition.entries(rows).count() == 2
    info = spark.createDataFrame([("a", 3)], "id string, surplus int")
    assert acquisition.metadata(info).columns == [c.split()[0] for c in METADATA.split(", ")]
    with pytest.raises(Exception, match="unsupported audio format"):
        info.select(acquisition.codec(F.lit("ogg"))).collect()


def test_models_keep_failures(spark):
    def load():
        def model(row):
            if row["n"] == 2:
                raise RuntimeError("bad " + "x" * 600)
            return {"twice": row["n"] * 2}

        return model

    rows = spark.createDataFrame([("a", 1), ("b", 2)], "video_id string, n int")
    done = models.apply_model(rows, "twice", load, "twice int", attempts=2)
    got = {r.video_id: r for r in done.collect()}
    assert got["a"].result.twice == 2 and got["a"].error is None
    assert got["b"].result is None and len(got["b"].error) == 500
    assert {r.video_id: r.status for r in models.outcomes(done).collect()} == {"a": "success", "b": "failed"}


def test_pairs(spark):
    rows = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "r"), (1, 3, "user", "open")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in pairs.prompt_response(rows).collect()] == [(1, 1, "q", "r")]
