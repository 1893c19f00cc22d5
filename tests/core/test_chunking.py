import itertools
import math
import random
from collections import Counter

from pyspark.sql import functions as F

from lectern.operators import answers, chunking


def plain_cuts(gains, sizes, longest):
    """Every way to cut."""
    best = None
    for marks in itertools.product((0, 1), repeat=len(sizes) - 1):
        at = [i + 1 for i, m in enumerate(marks) if m]
        chunks = list(zip([0, *at], [*at, len(sizes)]))
        if all(sum(sizes[a:b]) <= longest or b - a == 1 for a, b in chunks):
            score = (round(sum(gains[i - 1] for i in at), 9), -len(at))
            best = max(best or score, score)
    return best


def test_cuts_against_every_way():
    rng = random.Random(1)
    for _ in range(400):
        n = rng.randrange(1, 10)
        gains, sizes, longest = [rng.choice([-1.0, -0.5, 0.0, 0.5, 1.0]) for _ in range(n - 1)], [rng.randrange(1, 9) for _ in range(n)], rng.randrange(4, 20)
        at = chunking.cuts(gains, sizes, longest)
        assert all(sum(sizes[a:b]) <= longest or b - a == 1 for a, b in zip([0, *at], [*at, n]))
        assert (round(sum(gains[i - 1] for i in at), 9), -len(at)) == plain_cuts(gains, sizes, longest)


def plain_cohesion(bags, block):
    out = []
    for g in range(1, len(bags)):
        a, b = sum(bags[max(0, g - block) : g], Counter()), sum(bags[g : g + block], Counter())
        norms = math.sqrt(sum(n * n for n in a.values())) * math.sqrt(sum(n * n for n in b.values()))
        out.append(sum(n * b[w] for w, n in a.items()) / norms if norms else 0.0)
    return out


def plain_depths(values):
    out = []
    for i, v in enumerate(values):
        left, right, a, b = v, v, i, i
        while a > 0 and values[a - 1] >= left:
            a, left = a - 1, values[a - 1]
        while b + 1 < len(values) and values[b + 1] >= right:
            b, right = b + 1, values[b + 1]
        out.append(left + right - 2 * v)
    return out


def test_cohesion_and_depths_of_all_documents(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select(answers.sentences(F.col("text")).alias("s")).collect()
    for r in rows:
        bags = [Counter(chunking._WORD.findall(s.lower())) for s in r.s]
        for block in (1, 3):
            values = chunking.cohesion(bags, block)
            assert all(abs(a - b) < 1e-9 for a, b in zip(values, plain_cohesion(bags, block))) and len(values) == max(0, len(bags) - 1)
        assert all(abs(a - b) < 1e-9 for a, b in zip(chunking.depths(values), plain_depths(values)))


def test_planted_changes_of_topic_are_found():
    rng = random.Random(2)
    topics = [[f"t{t}w{k}" for k in range(15)] for t in range(8)]
    hits = wanted = made = 0
    for _ in range(60):
        parts, marks = [], []
        for t in rng.sample(range(8), 4):
            marks.append(len(parts))
            parts += [" ".join(rng.choice(topics[t] + ["the", "of", "and"]) for _ in range(12)) + "." for _ in range(rng.randrange(5, 12))]
        found = chunking.split(parts, 400)
        hits, wanted, made = hits + len(set(found) & set(marks[1:])), wanted + 3, made + len(found)
    assert hits >= 0.95 * wanted and hits >= 0.6 * made


def test_chunks_hold_all_sentences(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit(1).alias("chunk"))
    odd = spark.createDataFrame([(None, "One. Two."), (-1, None), (-2, ""), (-3, "word " * 500 + ". b c.")], "doc_id long, text string").withColumn("chunk", F.lit(1))
    rows = docs.union(odd)
    want = {r.doc_id: r.s for r in rows.select("doc_id", answers.sentences(F.col("text")).alias("s")).collect() if r.s}
    got = {}
    for r in sorted(chunking.topic_chunks(rows, "doc_id", max_words=60).collect(), key=lambda r: r.chunk):
        assert r.n_words <= 60 or r.text in want[r.doc_id]
        assert r.chunk == len(got.setdefault(r.doc_id, [])) and r.n_words == len(r.text.split())
        got[r.doc_id].append(r.text)
    assert {k: " ".join(v) for k, v in got.items()} == {k: " ".join(v) for k, v in want.items()}
    assert chunking.topic_chunks(rows.limit(0), "doc_id").count() == 0
