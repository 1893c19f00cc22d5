import random
import re
from collections import Counter

import pytest

from lectern.llm import jaccard
from lectern.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text, n=5):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(docs):
    sets = [grams(t) for _, t in docs]
    parent = list(range(len(docs)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(docs)
    for i in range(len(docs)):
        for j in range(i):
            same = (docs[i][1] or "") == (docs[j][1] or "")
            shared = len(sets[i] & sets[j])
            if same or (shared and 5 * shared >= 4 * len(sets[i] | sets[j])):
                links[i] += 1
                links[j] += 1
                parent[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least.setdefault(top(i), []).append((doc is None, doc))
    return sorted(((docs[i][0], min(least[top(i)], key=lambda x: (x[0], x[1] or 0))[1], links[i]) for i in range(len(docs))), key=repr)


def frame(spark, docs):
    return spark.createDataFrame([(d, t, b"x", 1) for d, t in docs], "doc_id long, text string, k binary, copies int")


def ask(spark, docs, **options):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.similar(frame(spark, docs), **options).collect()), key=repr)


def test_whole_table_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = ask(spark, docs)
    assert got == brute(docs)
    assert any(n for _, _, n in got)


@pytest.mark.parametrize("block", [1, 2, 1000])
def test_groups_of_near_copies_and_odd_rows(spark, block):
    rng = random.Random(block)
    base = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(w if rng.random() > 0.02 else f"e{rng.randrange(9)}" for w in base)) for i in range(40)]
    docs += [(100 + i, " ".join(f"v{rng.randrange(50)}" for _ in range(30))) for i in range(10)]
    docs += [(200, None), (201, ""), (202, "  "), (203, "a b"), (204, "a  b"), (204, "a  b"), (205, "a b c"), (None, docs[0][1]), (None, "lone null id words here now"), (300, docs[3][1]), (0, "same id other text with words")]
    docs += [(400, "long " + " ".join(f"u{i}" for i in range(30_000))), (401, " ".join(f"u{i}" for i in range(30_000)))]
    assert ask(spark, docs, block=block) == brute(docs)


def test_keep_one(spark):
    docs = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "x y z"), (None, None), (5, "")]
    rows = jaccard.keep_one(frame(spark, docs)).collect()
    assert sorted((repr(r.doc_id), r.text or "") for r in rows) == sorted([("1", "a b c d e f"), ("2", "x y z"), ("5", "")])
    assert rows[0].k == b"x"


def test_bands_reach_the_recall():
    bands, rows = jaccard.choose_bands()
    assert bands * rows <= jaccard.HASHES
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999


@pytest.mark.parametrize("threshold", [0.01, 0.05, 0.3, 0.5, 0.9, 0.99, 1.0])
def test_any_threshold_has_its_recall(threshold):
    bands, rows = jaccard.choose_bands(threshold)
    assert 1 - (1 - threshold**rows) ** bands >= 0.9999


def test_many_blocks_and_hot_keys(spark, monkeypatch):
    """One large group of near copies and many small ones, with keys that count as hot from three rows on."""
    monkeypatch.setattr("lectern.llm.common.HOT_ROWS", 3)
    rng = random.Random(3)
    docs, n = [], 0
    for group, size in [("a", 60), ("b", 7), ("c", 2), ("d", 1), ("e", 3)] + [(f"g{i}", 2) for i in range(20)]:
        base = [f"{group}{i}" for i in range(50)]
        for _ in range(size):
            docs += [(n, " ".join(w if rng.random() > 0.015 else f"x{rng.randrange(99)}" for w in base))] * (1 + (n % 9 == 0))
            n += 1
    assert ask(spark, docs, block=4) == brute(docs)


@pytest.mark.parametrize("n", [0, 1, 500])
def test_filter_keeps_what_it_holds(spark, n):
    from pyspark.sql import functions as F

    from lectern.llm.common import may_hold

    rows = spark.range(5000).select(F.md5(F.col("id").cast("string").cast("binary")).alias("k"), "id")
    got = {r.id for r in may_hold(rows, rows.where(F.col("id") < n).select("k"), "k", n).collect()}
    assert set(range(n)) <= got and len(got) < n + 400


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(25)] + [(7, 7)]
    with Scratch(spark) as scratch:
        got = {r.k: r.c for r in jaccard.connected(spark.createDataFrame(edges, "a long, b long"), scratch).collect()}
    assert all(got[i] == 0 for i in range(61))
    assert all(got[a] == got[b] for a, b in edges)
    sizes = Counter(got.values())
    assert all(min(k for k, c in got.items() if c == head) == head for head in sizes)


def test_empty_table(spark):
    assert jaccard.similar(frame(spark, [])).count() == 0
