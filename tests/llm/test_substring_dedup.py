import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from lectern.llm import substring_dedup
from lectern.llm.common import WordHashes, window_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window):
    words = [WORD.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x", 3) for d, t in docs], "doc_id long, text string, batch string, n_words int")


def test_whole_table_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, substring_dedup.remove_repeats(frame(spark, docs)).collect()), key=repr)
    assert got == brute(docs, 35)
    assert any(r[2] for r in got) and any(not r[2] for r in got)


def test_levels_double():
    assert substring_dedup.levels(35) == [18, 35] and substring_dedup.levels(35, 1) == [1, 2, 3, 5, 9, 18, 35]
    for window in range(1, 200):
        for shortest in range(1, 40):
            found = substring_dedup.levels(window, shortest)
            assert found[-1] == window and all(a < b <= 2 * a for a, b in zip(found, found[1:]))
            assert found[0] >= min(window, shortest)


@pytest.mark.parametrize("window, shortest", [(1, 16), (2, 1), (5, 2), (20, 16), (35, 1), (35, 4), (35, 16), (50, 8), (100, 16)])
def test_planted_repeats(spark, window, shortest, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BATCH_DOCS", 7)
    monkeypatch.setattr(substring_dedup, "PART_BYTES", 5000)
    rng = random.Random(window)
    passage = [f"p{i}" for i in range(130)]
    docs = []
    for i in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(0, 200))]
        for _ in range(rng.randrange(3)):
            a = rng.randrange(100)
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[a : a + rng.randrange(10, 120)]
        docs.append((i, "  ".join(words)))
    docs += [(100, "same " * 90), (101, None), (102, ""), (103, "a\x1cb c"), (None, " ".join(passage)), (104, docs[5][1]), (104, docs[5][1]), (105, "a b a b " * 60)]
    got = sorted(map(tuple, substring_dedup.remove_repeats(frame(spark, docs), window=window, shortest=shortest).collect()), key=repr)
    assert got == brute(docs, window)


def test_kept_text(spark):
    docs = [(1, "a b c d e x"), (2, "y a b c d e"), (3, None)]
    rows = substring_dedup.remove_repeats(frame(spark, docs), window=5, with_text=True).collect()
    assert sorted((r.doc_id, r.kept) for r in rows) == [(1, "x"), (2, "y"), (3, "")]


def test_empty_table(spark):
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_window_hashes_tell_windows_apart():
    words = [b"a", b"b", b"c", b"a", b"b", b"c", b"b", b"a"] * 3
    for length in (1, 2, 3, 5, 8, 11):
        found = window_hashes(WordHashes().of(words), length)
        by = {}
        for i, h in enumerate(found.tolist()):
            by.setdefault(h, set()).add(tuple(words[i : i + length]))
        assert len(found) == len(words) - length + 1
        assert all(len(v) == 1 for v in by.values()) and len(by) == len({tuple(words[i : i + length]) for i in range(len(found))})


def test_minima_cover_every_span():
    values = np.random.default_rng(0).integers(0, 40, 500).astype(np.uint64)
    for span in (1, 2, 3, 7, 18, 499, 500, 600):
        want = sorted({i + int(values[i : i + span].argmin()) for i in range(max(1, len(values) - span + 1))})
        assert substring_dedup.minima(values, span).tolist() == want
