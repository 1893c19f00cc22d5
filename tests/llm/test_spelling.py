import random
import re
import zlib
from collections import Counter

from lectern.llm import spelling as S

DOCS = "doc_id long, text string"


def plain_words(rows, every, min_chars=5, min_count=3):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if every and h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}


def apart(a, b):
    """Edit distance one, by trying every edit."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(words):
    out = {}
    for w, n in words.items():
        near = [v for v in words if apart(w, v)]
        top = min(near, key=lambda v: (-words[v], v), default=None)
        form = top if top is not None and words[top] >= 2 * n else None
        out[w] = (form, n, len(near), words[form] if form is not None else None)
    result = set()
    for w, (form, n, many, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        result.add((w, form, root, n, many, form_n))
    return result


def found(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_words_and_variants_of_documents(spark):
    rng = random.Random(2)
    syllables = ["ba", "be", "É", "ÿ", "lo", "ma", "×", "ni", "ra", "SO"]
    pool = ["".join(rng.choice(syllables) for _ in range(rng.randrange(2, 5))) for _ in range(60)]
    rows = [(k, " ".join(rng.choice(pool) + rng.choice(["", ".", "_1", "漢", "\n"]) for _ in range(rng.randrange(0, 150)))) for k in range(150)]
    rows += [(None, None), (None, pool[0] + " " + pool[1]), (7, ""), rows[3], rows[3], (999, (pool[2] + " ") * 30_000)]
    docs = spark.createDataFrame(rows, DOCS)
    for every in (None, 3, 97):
        wanted = plain_words(rows, every)
        assert {r.word: r.n for r in S.count_words(docs, misspell_every=every).collect()} == wanted
    assert found(S.variants_of_documents(docs)) == plain_variants(plain_words(rows, 97)) != set()


def test_tries_against_every_pair(spark, monkeypatch):
    rng = random.Random(5)
    words = {"".join(rng.choice("abcé漢") for _ in range(rng.randrange(1, 7))): rng.randrange(1, 9) ** 3 for _ in range(600)}
    table = spark.createDataFrame([*words.items()], "word string, n long")
    wanted = plain_variants(words)
    assert found(S.group_variants(table)) == wanted
    monkeypatch.setattr(S, "SHARD_WORDS", 70)  # many shards, many waves
    monkeypatch.setattr(S, "WAVE_CHARS", 4000)
    near = S.near_words(table, wave_chars=4000)
    assert {(r.word, r.n_near) for r in near.collect()} == {(w, many) for w, _, _, _, many, _ in wanted}
    assert found(S.group_variants(table)) == wanted


def test_chain_of_forms(spark):
    words = {"a" * k + "bcdef": 3 * 2**k for k in range(20)}
    rows = found(S.group_variants(spark.createDataFrame([*words.items()], "word string, n long")))
    assert rows == plain_variants(words) and {r[2] for r in rows} == {"a" * 19 + "bcdef"}


def test_one_apart_and_odd_words(spark):
    assert S.one_apart("", "a") and S.one_apart("ab", "b") and S.one_apart("abc", "axc") and S.one_apart("aa", "a")
    assert not S.one_apart("", "") and not S.one_apart("ab", "ba") and not S.one_apart("abc", "a")
    odd = spark.createDataFrame([("x", 1, "n"), ("x", 2, "n"), (None, 4, ""), ("", 5, ""), ("y", None, ""), ("z" * 5000, 9, ""), ("z" * 4999, 3, "")], "word string, n long, near string")
    assert found(S.group_variants(odd)) == {("x", None, "x", 3, 0, None), ("z" * 5000, None, "z" * 5000, 9, 1, None), ("z" * 4999, "z" * 5000, "z" * 5000, 3, 1, 9)}
    assert S.group_variants(spark.createDataFrame([], "word string, n long")).count() == 0
    assert S.variants_of_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    words = plain_words([(r.doc_id, r.text) for r in docs.collect()], 97)
    assert {r.word: r.n for r in S.count_words(docs, misspell_every=97).collect()} == words
    some = dict(sorted(words.items())[:1500])
    assert found(S.group_variants(spark.createDataFrame([*some.items()], "word string, n long"))) == plain_variants(some)
