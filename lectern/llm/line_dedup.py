"""Line deduplication: line hashes sorted by range are streamed once, and each document gets back a bitmap of what it keeps."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, short_batches, written

#: Documents a key must be found in, and code points it must have, before its lines go.
MIN_DOCS, MIN_CHARS = 10, 1
#: The white space that is stripped from both ends of a line.
WHITE = b" \t\n\x0b\x0c\r"
#: Lines of one range, about, and lines that a task hands on at a time.
RANGE_LINES, OUT_LINES = 2_000_000, 50_000


def line_key(line: bytes) -> bytes:
    """What lines are compared by: stripped of WHITE, A-Z lower-cased and nothing else."""
    return line.strip(WHITE).lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars)


def _lines(min_chars: int):
    """(h1, h2, doc_id, copy, at, lines) of every line that may go; others never leave their document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[pa.RecordBatch]:
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            ids, copies = batch.column("doc_id").take(pa.array(owners)), batch.column("copy").take(pa.array(owners))
            whole = pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), ids, copies, pa.array(places, pa.int32()), pa.array(sizes, pa.int32())], names=["h1", "h2", "doc_id", "copy", "at", "lines"])
            for a in range(0, len(owners), OUT_LINES):
                yield whole.slice(a, OUT_LINES)

        for batch in batches:
            owners, places, sizes, digests = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                lines = (text or b"").split(b"\n")
                for at, line in enumerate(lines):
                    key = line_key(line)
                    if _long_enough(key, min_chars):
                        owners.append(i)
                        places.append(at)
                        sizes.append(len(lines))
                        digests.append(xxhash.xxh3_128_digest(key))
                if len(owners) >= OUT_LINES:
                    yield from made()
                    owners, places, sizes, digests = [], [], [], []
            if owners:
                yield from made()

    return run


_VERDICT = "part int, h1 long, h2 long, lead boolean, doc_id {kind}, copy long, at int, lines int, docs long, first_copy long, last_copy long"


class _Stream:
    """One range of sorted lines. A run is the lines of one key; its lines are held back only while it has too few documents.

    The first and the last run may go on in the ranges beside this one. What isn't sure of them is passed on as open, with
    the key, and each gives a row of counts.
    """

    def __init__(self, part: int, min_docs: int, keep_first: bool):
        self.part, self.min_docs, self.keep_first = part, min_docs, keep_first
        self.key, self.runs, self.docs, self.first, self.last, self.last_at = None, 0, 0, 0, 0, 0
        self.held: list[tuple[pa.RecordBatch, np.ndarray]] = []  # lines of the current run, and which of them leads it

    def _rows(self, lines: pa.RecordBatch, lead: np.ndarray, open_: np.ndarray) -> pa.RecordBatch:
        n, shut = lines.num_rows, pa.array(~open_)
        key = [pa.array(lines.column(c).to_numpy(), mask=shut.to_numpy(zero_copy_only=False)) for c in ("h1", "h2")]
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, self.part, np.int32)), *key, pa.array(lead), *[lines.column(c) for c in ("doc_id", "copy", "at", "lines")], none, none, none], names=_names())

    def _counts(self, kind: pa.DataType, key: tuple[int, int], docs: int, first: int, last: int) -> pa.RecordBatch:
        long, int_ = pa.int64(), pa.int32()
        one = [pa.array([x], k) for x, k in zip((self.part, *key, None, None, None, None, None, docs, first, last), (int_, long, long, pa.bool_(), kind, long, int_, int_, long, long, long))]
        return pa.RecordBatch.from_arrays(one, names=_names())

    def close(self, kind: pa.DataType, at_end: bool) -> Iterator[pa.RecordBatch]:
        """Ends the current run: of runs in the middle of the range what is held stays in its documents."""
        if self.runs == 1 or at_end:
            for lines, lead in self.held:
                yield self._rows(lines, lead, np.ones(lines.num_rows, bool))
            yield self._counts(kind, self.key, self.docs, self.first, self.last)
        self.held = []

    def show(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n, kind = batch.num_rows, batch.schema.field("doc_id").type
        h1, h2, copy, at = (batch.column(c).to_numpy() for c in ("h1", "h2", "copy", "at"))
        goes_on = self.key == (int(h1[0]), int(h2[0]))
        new_run = np.concatenate([[not goes_on], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        new_doc = new_run | np.concatenate([[goes_on and int(copy[0]) != self.last], copy[1:] != copy[:-1]])
        # a row that repeats the one before (a repeated document) adds nothing
        new_row = new_doc | np.concatenate([[goes_on and int(at[0]) != self.last_at], at[1:] != at[:-1]])
        if not goes_on and self.key is not None:
            yield from self.close(kind, False)
        starts = np.flatnonzero(new_run)
        starts = np.concatenate([[0], starts]) if goes_on else starts
        docs = np.add.reduceat(new_doc.astype(np.int64), starts)
        docs[0] += self.docs if goes_on else 0
        number = self.runs + np.arange(len(starts)) + (0 if goes_on else 1)  # of each run in the range, from 1
        run_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
        enough = docs >= self.min_docs
        if goes_on and enough[0] and self.held:
            for lines, lead in self.held:
                yield from self._gone(lines, lead, np.full(lines.num_rows, self.runs == 1))
            self.held = []
        sure = np.flatnonzero(enough[run_of] & new_row)
        if len(sure):
            yield from self._gone(batch.take(pa.array(sure)), new_run[sure], number[run_of[sure]] == 1)
        first, last_run = self.first if goes_on else int(copy[0]), len(starts) - 1

        def unsure(r: int) -> list:
            some = np.flatnonzero((run_of == r) & new_row)
            return [(batch.take(pa.array(some)), new_run[some])] if len(some) else []

        if last_run:  # the run at the beginning ends here
            if number[0] == 1:
                for lines, lead in [] if enough[0] else [*self.held, *unsure(0)]:
                    yield self._rows(lines, lead, np.ones(lines.num_rows, bool))
                yield self._counts(kind, (int(h1[0]), int(h2[0])), int(docs[0]), first, int(copy[starts[1] - 1]))
            self.held, first = [], int(copy[starts[-1]])
        if not enough[last_run]:
            self.held += unsure(last_run)
        self.key, self.runs, self.docs, self.first, self.last, self.last_at = (int(h1[-1]), int(h2[-1])), int(number[-1]), int(docs[-1]), first, int(copy[-1]), int(at[-1])

    def _gone(self, lines: pa.RecordBatch, lead: np.ndarray, of_first: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Lines of keys that are in enough documents. If the first of a key stays, that of the first run is open."""
        open_ = lead & of_first if self.keep_first else np.zeros(len(lead), bool)
        stays = lead & ~of_first if self.keep_first else np.zeros(len(lead), bool)
        if not stays.all():
            some = np.flatnonzero(~stays)
            yield self._rows(lines.take(pa.array(some)), lead[some], open_[some])


def _names() -> list[str]:
    return [c.split()[0] for c in _VERDICT.split(", ")]


def _verdicts(min_docs: int, keep_first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        stream, kind = _Stream(TaskContext.get().partitionId(), min_docs, keep_first), None
        for batch in batches:
            if batch.num_rows:
                kind = batch.schema.field("doc_id").type
                yield from stream.show(batch)
        if stream.key is not None:
            yield from stream.close(kind, True)

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dropped, keeps = [], []
        for n, ats in zip(batch.column("n_lines").to_pylist(), batch.column("ats")):
            keep = np.ones(n, bool)
            keep[ats.values.to_numpy()] = False
            dropped.append(n - int(keep.sum()))
            keeps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("copy"), batch.column("n_lines"), pa.array(dropped, pa.int64()), pa.array(keeps, pa.binary())], names=["doc_id", "copy", "n_lines", "n_dropped", "keep"])


def kept_lines(keep: bytes, n_lines: int) -> np.ndarray:
    """A bitmap of keep_bitmaps() as n_lines booleans."""
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines).astype(bool)


def _named(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("copy"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def keep_bitmaps(docs: DataFrame, *, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """doc_id, copy, n_lines, n_dropped, keep for each document of docs (doc_id, text) that loses a line.

    Lines end at \\n; a null or empty text is one empty line. Lines are equal if their keys are (line_key; 128-bit hashes).
    Keys of at least min_chars code points that are in at least min_docs documents lose all their lines, or all but the
    first by doc_id (nulls first), copy and position if keep_first. keep is a zlib-compressed bitmap, a bit a line
    (kept_lines), copy a hash of doc_id and text: rows in which both are equal are one document, with one bitmap; a null
    id is an id like any other. Documents that lose nothing have no row. Extra columns are ignored. Empty table: no rows.

    Only hashes and positions are shuffled: by ranges of (hash, doc_id, copy, position), so the lines of a hot key are
    spread over as many ranges as they need. Each range is read as a stream that holds the lines of fewer than min_docs
    documents. What it can't decide, as a key goes on in the next range, is settled by counts of two rows a range.
    """
    spark = docs.sparkSession
    short_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    with Scratch(spark) as scratch:
        lines = scratch.written(_named(docs).mapInArrow(_lines(min_chars), f"h1 long, h2 long, doc_id {kind}, copy long, at int, lines int"), "lines")
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines.count() // RANGE_LINES))
        order = ["h1", "h2", "doc_id", "copy", "at"]
        verdicts = scratch.written(lines.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(_verdicts(min_docs, keep_first), _VERDICT.format(kind=kind)), "verdicts")
        before = F.lag("last_copy").over(Window.partitionBy("h1", "h2").orderBy("part"))
        ends = verdicts.where("docs is not null").withColumn("docs", F.col("docs") - F.coalesce((before == F.col("first_copy")).cast("long"), F.lit(0)))
        totals = ends.groupBy("h1", "h2").agg(F.sum("docs").alias("total"), F.min("part").alias("first_part"))
        open_ = verdicts.where("docs is null and h1 is not null").drop("docs").join(F.broadcast(totals), ["h1", "h2"])  # two rows a range
        leads = F.lit(keep_first) & F.col("lead") & (F.col("part") == F.col("first_part"))
        gone = verdicts.where("docs is null and h1 is null").unionByName(open_.where((F.col("total") >= min_docs) & ~leads), allowMissingColumns=True)
        each = gone.groupBy("doc_id", "copy").agg(F.max("lines").cast("long").alias("n_lines"), F.collect_list("at").alias("ats"))
        return written(each.mapInArrow(_pack, f"doc_id {kind}, copy long, n_lines long, n_dropped long, keep binary"), "bitmaps")


def drop_lines(docs: DataFrame, bitmaps: DataFrame, *, with_text: bool = False) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 (and kept) for every row of docs, given its keep_bitmaps().

    Lines that stay are joined by \\n. Texts are shuffled once, here, and sorted nowhere. Rows without a bitmap keep all; null texts are empty. Repeated rows are treated alike.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, dropped, shas, texts = [], [], [], []
            for text, keep in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist()):
                n = text.count(b"\n") + 1
                if keep is not None:
                    stays = kept_lines(keep, n)
                    text = b"\n".join([x for x, s in zip(text.split(b"\n"), stays.tolist()) if s])
                    dropped.append(n - int(stays.sum()))
                else:
                    dropped.append(0)
                sizes.append(n)
                shas.append(hashlib.sha256(text).hexdigest())
                texts.append(text.decode("utf-8", "replace") if with_text else None)
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(dropped, pa.int64()), pa.array(shas, pa.string()), *([pa.array(texts, pa.string())] if with_text else [])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_lines", "n_dropped", "kept_sha256", *["kept"] * with_text])

    short_batches(docs.sparkSession)
    found = bitmaps.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), "keep")
    # texts meet their bitmaps by a shuffle at every size; what a task holds in memory is bitmaps, not texts
    joined = _named(docs).join(found.hint("shuffle_hash"), F.expr("copy = _copy and doc_id <=> _id"), "left").select("doc_id", "text", "keep")
    return joined.mapInArrow(run, f"doc_id {kind}, n_lines long, n_dropped long, kept_sha256 string" + ", kept string" * with_text)


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document, with the defaults of keep_bitmaps()."""
    return drop_lines(docs, keep_bitmaps(docs))


_KEY = r"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = f"""
with parts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
places as (select doc_id, unnest(lines) as line, unnest(range(len(lines))) as place from parts),
keyed as (select doc_id, place, line, {_KEY} as key from places),
gone as (select key from keyed where length(key) >= {MIN_CHARS} group by key having count(distinct doc_id) >= {MIN_DOCS}),
marked as (select k.doc_id, k.place, k.line, g.key is not null as dropped from keyed k left join gone g on k.key = g.key)
select doc_id, count(*) as n_lines, cast(sum(cast(dropped as integer)) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id
"""
