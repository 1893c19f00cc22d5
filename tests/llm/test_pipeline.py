import hashlib
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lectern.llm import common, langid, mixing, packing, pii
from tests.llm.test_jaccard import brute as similar
from tests.llm.test_mixing import WORD, filled


def plain_run(spark, sf):
    """All stages in plain Python, but for the sampling of the dictionaries."""
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    classify = langid.Classifier(langid.fit_dictionaries(frame))
    docs = [(r.doc_id, r.text, r.source) for r in frame.collect()]
    docs = [d for d in docs if not classify(d[1])[2]]
    keep = {c for _, c, _ in similar([(d, t) for d, t, _ in docs])}
    docs = [d for d in docs if d[0] in keep]
    counts = Counter(key for _, t, _ in docs for *_, key in pii.candidates(t))
    model = pii.train(dict(counts), pii.reliabilities(dict(counts))[0])
    clean = []
    for doc, text, source in docs:
        out, done = "", 0
        for a, b, kind, key in pii.candidates(text):
            if kind not in pii.BASE and pii.decide(key, model) < pii.THRESHOLD:
                continue
            if a >= done:
                out += text[done:a] + f"[{kind}]"
            done = max(done, b)
        clean.append((doc, out + text[done:], source))
    sizes = defaultdict(int)
    for _, text, source in clean:
        sizes[source] += len(WORD.findall(text))
    names = sorted(sizes)
    targets = dict(zip(names, filled([sizes[s] for s in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))], 3)))
    mixed = []
    for source in names:
        whole = targets[source] // sizes[source]
        left = int(targets[source] - whole * sizes[source] + Fraction(1, 2))
        own = [(hashlib.md5(f"{mixing.SEED}:{d}".encode()).hexdigest(), d, t) for d, t, s in clean if s == source]
        for _, doc, text in sorted(own):
            words = WORD.findall(text)
            mixed += [(doc, text)] * int(whole)
            if left >= len(words):
                mixed.append((doc, text))
            elif left:
                mixed.append((doc, " ".join(words[:left])))
            left -= min(left, len(words))
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = Counter()
    for doc, text in mixed:
        ids = [*whole.encode(text, add_special_tokens=False).ids, 0]
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)] if len(ids) > 2048 else [0, len(ids)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            pieces[doc, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    return pieces


def test_against_plain_python(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == plain_run(spark, sf)
    ends = defaultdict(list)
    for r in rows:
        ends[r.sequence_id].append((r.offset, r.length))
    for places in ends.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_stages_return_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "n-gram Jaccard join", "personal data", "mixing sources", "best-fit packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).dtypes == docs.dtypes


def test_stages_on_odd_rows(spark, sf):
    """Nulls in every column, empty and very long texts, repeated rows, and names that the operators use themselves."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.limit(40).collect()]
    rows += [(None, None, None, None, None), (10**6, None, "en", "src0", None), (10**6 + 1, "", None, None, 0), (None, rows[0][1], None, "src1", 3)]
    rows += [rows[5], rows[5], (10**6 + 2, rows[1][1] * 200, "en", None, None), (10**6 + 3, " \n", "en", "new", 2)]
    clash = ["k", "h", "bands", "_row", "_carry", "spans", "_salt", "size", "target", "length", "sequence_id", "class_id", "rejected"]
    frame = spark.createDataFrame([(*r, *range(len(clash))) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in clash))
    left = frame
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for given in (frame, left):
            out = stage(spark, given, sf)
            assert out.columns == frame.columns, name
            found = out.collect()
            assert all(tuple(r)[5:] == tuple(range(len(clash))) for r in found) and found, name
        left = spark.createDataFrame(found, frame.schema)
    for given in (frame, left):
        packed = corpus_pipeline.STAGES[-1][1](spark, given, sf).collect()
        assert {r.doc_id for r in packed} == {r.doc_id for r in given.collect()}


def test_intermediate_tables_are_deleted(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda _: f"file://{tmp_path}")
    names = lambda: sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.glob("lectern-*/*"))
    since = common.kept()
    assert corpus_pipeline.run(spark, sf).count()
    assert names() == ["pack-counts", "pack-pieces", "stage-mixing-sources"]
    common.release(spark, since)
    assert names() == []


def test_stages_on_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0
