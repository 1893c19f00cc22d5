import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from lectern.operators import answers as op
from lectern.operators import chunking, vectors
from lectern.plans import answers, files


@pytest.fixture(scope="module")
def con(sf):
    with duckdb.connect() as c:
        for name in os.listdir(sf):
            c.execute(f"create view {name.removesuffix('.parquet')} as select * from '{sf}/{name}'")
        yield c


QUERIES, SQL = {**files.queries(), **answers.queries()}, {**files.oracle_sql(), **answers.oracle_sql()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_give_what_sql_says(spark, sf, con, name):
    found = QUERIES[name](spark, sf)
    got = sorted((tuple(r[c] for c in sorted(found.columns)) for r in found.collect()), key=repr)
    told = con.execute(SQL[name])
    names = [d[0] for d in told.description]
    assert sorted(names) == sorted(found.columns)
    assert got == sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in told.fetchall()), key=repr) and got


def test_queries_without_sql(spark, sf):
    """What the index finds has the exact search's scores; topic chunks are those of the plain function, all documents."""
    assert set(QUERIES) - set(SQL) == {"indexed_search", "topic_chunks"}
    exact = {(r.query_id, r.vec_id): r.score for r in QUERIES["retrieved"](spark, sf).collect()}
    found = QUERIES["indexed_search"](spark, sf).collect()
    assert len(found) == len(exact) and sum((r.query_id, r.vec_id) in exact for r in found) >= 0.9 * len(exact)
    assert all(exact.get((r.query_id, r.vec_id), r.score) == r.score for r in found)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", op.sentences(F.col("text")).alias("s")).collect()
    want = set()
    for r in docs:
        begins = [0, *chunking.split(r.s, 100), len(r.s)] if r.s else []
        want |= {(r.doc_id, c, hashlib.md5(" ".join(r.s[a:b]).encode()).hexdigest()) for c, (a, b) in enumerate(zip(begins, begins[1:]))}
    assert {(r.doc_id, r.chunk, r.text_md5) for r in QUERIES["topic_chunks"](spark, sf).collect()} == want


def test_cleaning(spark):
    texts = {"Um, so it was... uh fine. er, and then? hmm": "So it was... Fine. And then?", None: "", "  ": "", "umbrella erm": "Umbrella", "a\u00a0b!  c": "A b! C"}
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", op.clean(F.col("t")).alias("c")).collect()
    assert [r.c for r in sorted(rows)] == list(texts.values())


def test_chunks_hold_whole_sentences(spark):
    text = "One two three. Four five! Six? Seven eight nine ten eleven twelve. End"
    rows = op.chunks(spark.createDataFrame([("a", text), ("b", None), ("c", "")], "id string, text string"), "id", max_words=5).collect()
    assert [(r.chunk, r.n_words, r.text) for r in sorted(rows, key=lambda r: r.chunk)] == [(0, 5, "One two three. Four five!"), (1, 7, "Six? Seven eight nine ten eleven twelve."), (2, 1, "End")]


def test_metrics_of_odd_pairs(spark):
    pairs = [("same", "a b c d e", "a b c d e"), ("none", "", ""), ("null", None, "x"), ("part", "the cat sat on the mat", "the cat on the mat"), ("apart", "a b c d", "e f g h")]
    rows = {r.video_id: r for r in op.gram_metrics(spark.createDataFrame(pairs, "video_id string, reference string, hypothesis string")).collect()}
    assert tuple(rows["same"])[1:] == (1.0, 1.0, 1.0)
    assert all(tuple(rows[k])[1:] == (0.0, 0.0, 0.0) for k in ("none", "null", "apart"))
    assert rows["part"].rouge1 == pytest.approx(10 / 11) and rows["part"].rouge2 == pytest.approx(2 * 3 / 9) and rows["part"].bleu == 0.0


def test_queries_in_waves(spark):
    rows = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(12)] + [(90, None), (91, []), (92, [0.0, 0.0]), (93, [1.0])], "vec_id long, embedding array<double>")
    asked = rows.withColumnRenamed("vec_id", "query_id")
    want = sorted(map(tuple, op.retrieve(rows, asked, k=3).collect()))
    assert [r[:3] for r in want if r[0] == 0] == [(0, 1, 0), (0, 2, 1), (0, 3, 2)] and [r[:3] for r in want if r[0] > 11] == [(93, 1, 93)]
    assert sorted(map(tuple, vectors.nearest(rows, asked, k=3, wave=2).collect())) == want
