"""Token ids as directly addressable codes: 8-bit chunks by level, continuation bitmaps, rank directories."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, shared_path, short_batches
from .tokenizing import encoder

END_ID = 2
MAGIC = b"DAC1"
CHUNK_BITS = 8
#: Bits of a bitmap between two entries of its rank directory.
RANK_BITS = 512
#: A segment is closed once it holds so many ids; a document is never split over segments.
SEGMENT_IDS = 1 << 20


def encode(ids: np.ndarray) -> bytes:
    """Layout, little-endian: magic, levels (u32), then for each level its count (u64), chunks (one byte each) and, but
    for the last level, the bitmap of those that continue (bit i of byte i // 8) and the ones before every 512 bits (u32).
    """
    rest, levels = np.asarray(ids, np.uint32), []
    while True:
        more = (rest >> CHUNK_BITS) > 0
        chunks = (rest & 0xFF).astype(np.uint8).tobytes()
        if not more.any():
            levels.append(struct.pack("<Q", len(rest)) + chunks)
            return MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.int64)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4")
        levels.append(struct.pack("<Q", len(rest)) + chunks + bits.tobytes() + ranks.tobytes())
        rest = rest[more] >> CHUNK_BITS


class Reader:
    """Random access into an encoded segment; nothing but the asked-for places is decoded."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        (levels,), at = struct.unpack_from("<I", data, 4), 8
        self.levels: list[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]] = []
        for k in range(levels):
            (n,), at = struct.unpack_from("<Q", data, at), at + 8
            chunks, at = np.frombuffer(data, np.uint8, n, at), at + n
            if k == levels - 1:
                self.levels.append((chunks, None, None))
                break
            width, entries = (n + 7) // 8, -(-n // RANK_BITS)
            bits = np.frombuffer(data, np.uint8, width, at)
            ranks = np.frombuffer(data, "<u4", entries, at + width)
            at += width + 4 * entries
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, i: int) -> int:
        """Ones before bit i."""
        _, bits, ranks = self.levels[level]
        block = min(i // RANK_BITS, len(ranks) - 1)
        part = np.unpackbits(bits[block * RANK_BITS // 8 : (i + 7) // 8], bitorder="little")[: i - block * RANK_BITS]
        return int(ranks[block]) + int(part.sum())

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value, shift = 0, 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[i]) << shift
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                break
            i, shift = self._rank(level, i), shift + CHUNK_BITS
        return value

    def slice(self, a: int, b: int, level: int = 0) -> np.ndarray:
        """ids a to b, b exclusive: what continues is contiguous in the next level too."""
        chunks, bits, _ = self.levels[level]
        out = chunks[a:b].astype("<u4")
        if bits is not None and b > a:
            more = np.unpackbits(bits[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 : a % 8 + b - a].astype(bool)
            if more.any():
                first = self._rank(level, a)
                out[more] |= self.slice(first, first + int(more.sum()), level + 1) << CHUNK_BITS
        return out


_FILE = "part int, segment int, n_ids long, doc_ids array<{kind}>, lengths array<long>, codes binary"


def _write(path: str, end_id: int, segment_ids: int, special_as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, segment = TaskContext.get().partitionId(), 0
        ids, end = encoder(path, special_as_text), int(end_id).to_bytes(4, "little")
        docs, lengths, held, n, kind = [], [], [], 0, None

        def closed() -> pa.RecordBatch:
            data = np.frombuffer(b"".join(held), "<u4")
            columns = [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([n], pa.int64()), pa.array([docs], pa.list_(kind)), pa.array([lengths], pa.list_(pa.int64())), pa.array([encode(data)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "segment", "n_ids", "doc_ids", "lengths", "codes"])

        for batch in batches:
            kind = batch.schema.types[0]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = ids(text) + end
                docs.append(doc)
                lengths.append(len(data) // 4)
                held.append(data)
                n += len(data) // 4
                if n >= segment_ids:
                    yield closed()
                    segment += 1
                    docs, lengths, held, n = [], [], [], 0
        if docs:
            yield closed()

    return run


def write_codes(docs: DataFrame, tokenizer: str, path: str, *, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS, special_as_text: bool = False) -> None:
    """Writes the ids of docs (doc_id, text), each with the end id, in ascending doc_id order (nulls first, equal ids by text).

    The files are Parquet containers of segments, committed by Spark's writer, so any file system it writes to will do
    and a lost executor's work is done again; `codes` is the encoding above, (part, segment) the order. Texts are
    range-partitioned once, by id and a hash of the text, so one repeated id doesn't make one task. Ids may be of any type
    that sorts; null and empty texts are the end id alone; extra columns are ignored. With special_as_text the strings of
    special tokens in a text are ordinary text.
    """
    spark = docs.sparkSession
    short_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
    ordered = keyed.repartitionByRange(n, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    ordered.mapInArrow(_write(tokenizer, end_id, segment_ids, special_as_text), _FILE.format(kind=kind)).write.option("compression", "none").parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            reader, lengths = Reader(row.column("codes")[0].as_buffer().to_pybytes()), row.column("lengths")[0].values.to_numpy()
            starts = np.cumsum(lengths) - lengths
            crcs = [zlib.crc32(reader.slice(int(a), int(a + n)).tobytes()) for a, n in zip(starts, lengths)]
            n = len(lengths)
            columns = [pa.array(np.full(n, row.column(c)[0].as_py()), pa.int32()) for c in ("part", "segment")]
            yield pa.RecordBatch.from_arrays([*columns, row.column("doc_ids")[0].values, pa.array(starts), pa.array(lengths), pa.array(crcs, pa.int64())], names=["part", "segment", "doc_id", "own_start", "n_tokens", "ids_crc32"])


def read_report(docs_schema_kind: str, files: DataFrame) -> DataFrame:
    """From written files: doc_id, start (ids of all documents before), n_tokens, ids_crc32 of what is read back.

    A row a document, repeated rows and null ids as they were written; null and empty texts have the end id alone. What is
    summed up over all parts is a row a segment. Files of an empty table: no rows.
    """
    rows = files.select("part", "segment", "doc_ids", "lengths", "codes").mapInArrow(_read, f"part int, segment int, doc_id {docs_schema_kind}, own_start long, n_tokens long, ids_crc32 long")
    sums = files.groupBy("part", "segment").agg(F.sum("n_ids").alias("_n"))
    parts = sums.groupBy("part").agg(F.sum("_n").alias("_part_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_part_n").over(before), F.lit(0)).alias("_part_start"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(parts, "part").select("part", "segment", (F.col("_part_start") + F.col("_in")).alias("_start"))
    return rows.join(starts, ["part", "segment"]).select("doc_id", (F.col("_start") + F.col("own_start")).alias("start"), "n_tokens", "ids_crc32")


def encode_and_read(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """write_codes() to a new folder under the shared one, and read_report() of what stands there. Empty table: empty."""
    spark = docs.sparkSession
    path = keep(shared_path(spark, "token-codes"))
    write_codes(docs, tokenizer, path, **options)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return read_report(kind, spark.read.schema(_FILE.format(kind=kind)).parquet(path))
