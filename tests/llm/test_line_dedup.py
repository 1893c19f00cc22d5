import hashlib
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.llm import line_dedup as L

SCHEMA = "doc_id long, text string"
STRIP = " \t\n\x0b\x0c\r"


def lowered(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(STRIP))


def plain(rows, min_docs=10, min_chars=1, keep_first=False):
    """(doc_id, text) -> (lines, dropped, kept text), one line at a time."""
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda d: (d[0] is not None, d[0] or 0, d[1]))
    where = defaultdict(list)
    for d in docs:
        for at, line in enumerate(d[1].split("\n")):
            where[lowered(line)].append((d, at))
    gone = set()
    for key, places in where.items():
        if len(key) >= min_chars and len({d for d, _ in places}) >= min_docs:
            gone |= set(places[1:] if keep_first else places)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for at, x in enumerate(lines) if ((i, t or ""), at) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(spark, rows, partitions="4", batch="10000", **options):
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        docs = spark.createDataFrame(rows, SCHEMA)
        found = L.drop_lines(docs, L.keep_bitmaps(docs, **options), with_text=True).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert all(r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest() for r in found)
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in found), key=str)


def made(seed, n):
    rng = random.Random(seed)
    pool = ["hot", " HOT\t", "é", "É", "", "  ", *[f"line {k % 7} {k}" for k in range(40)]]
    rows = [(k, "\n".join(rng.choice(pool[: rng.choice([2, 6, 46])]) for _ in range(rng.randrange(1, 12)))) for k in range(n)]
    return [*rows, (None, None), (None, "hot\nhot"), (3, ""), rows[0], rows[0], (n, "x" * 300_000 + "\nhot")]


@pytest.mark.parametrize("partitions, batch, options", [("1", "10000", {}), ("40", "3", {}), ("7", "5", {"min_docs": 2, "keep_first": True}), ("7", "5", {"min_docs": 5, "min_chars": 5}), ("3", "5", {"min_docs": 1})])
def test_against_plain_lines(spark, partitions, batch, options):
    rows = made(5, 80)
    found, wanted = run(spark, rows, partitions, batch, **options), plain(rows, **options)
    if options.get("keep_first"):  # which of one id's texts is first is open: it goes by a hash
        assert [r[:2] for r in found] == [r[:2] for r in wanted]
        assert sum(r[2] for r in found) == pytest.approx(sum(r[2] for r in wanted), abs=4)
    else:
        assert found == wanted


def test_first_occurrence_stays(spark):
    rows = [(k, f"own {k}\nall") for k in range(30)]
    for partitions in ("1", "9"):
        found = run(spark, rows, partitions, "4", min_docs=2, keep_first=True)
        assert found == plain(rows, 2, 1, True)


def test_a_hot_line_is_spread_over_ranges():
    """The stream alone: a key that fills many ranges, or ends and begins at their edges."""
    lines = sorted((h, d, at) for h, count in ((1, 3), (2, 60), (3, 2), (4, 12)) for d in range(count) for at in range(1 + d % 2))
    for cut in (1, 2, 5, 13, 64):
        for batch in (1, 3, 100):
            shown = []
            for part, a in enumerate(range(0, len(lines), cut)):
                stream, piece = L._Stream(part, 10, False), lines[a : a + cut]
                for b in range(0, len(piece), batch):
                    h, d, at = (list(x) for x in zip(*piece[b : b + batch]))
                    shown += stream.show(pa.RecordBatch.from_pydict({"h1": h, "h2": h, "doc_id": d, "copy": d, "at": pa.array(at, pa.int32()), "lines": pa.array([2] * len(h), pa.int32())}))
                shown += stream.close(pa.int64(), True)
            rows = [r for b in shown for r in b.to_pylist()]
            ends = [r for r in rows if r["docs"] is not None]
            total, last = defaultdict(int), {}
            for r in sorted(ends, key=lambda r: (r["h1"], r["part"])):
                total[r["h1"]] += r["docs"] - (last.get(r["h1"]) == r["first_copy"])
                last[r["h1"]] = r["last_copy"]
            gone = [(r["doc_id"], r["at"]) for r in rows if r["docs"] is None and (r["h1"] is None or total[r["h1"]] >= 10)]
            assert sorted(gone) == sorted((d, at) for h, d, at in lines if h in (2, 4))


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert L.drop_repeated_lines(empty).count() == 0
    clashing = spark.createDataFrame([(k, "same\nown %d" % k, 1, 2, "x") for k in range(12)], "doc_id long, text string, copy int, keep int, h1 string")
    assert {(r.n_lines, r.n_dropped) for r in L.drop_repeated_lines(clashing).collect()} == {(2, 1)}
    named = spark.createDataFrame([(f"d{k}", "same") for k in range(12)], "doc_id string, text string")
    assert {r.n_dropped for r in L.drop_repeated_lines(named).collect()} == {1}


def test_bitmaps_hold_no_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bitmaps = L.keep_bitmaps(docs, min_docs=3)
    assert bitmaps.columns == ["doc_id", "copy", "n_lines", "n_dropped", "keep"]
    for r in bitmaps.collect():
        keep = L.kept_lines(r.keep, r.n_lines)
        assert len(keep) - keep.sum() == r.n_dropped > 0
    found = L.drop_lines(docs, bitmaps, with_text=True).agg(F.sum("n_dropped").alias("n")).first().n
    assert found == bitmaps.agg(F.sum("n_dropped").alias("n")).first().n
