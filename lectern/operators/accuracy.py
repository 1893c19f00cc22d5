"""Error rates against reference texts: character and word rates by bit-parallel distances, match and information rates by alignment."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalised, strip, words


def covered(references: DataFrame, transcripts: DataFrame, key: str = "video_id") -> DataFrame:
    """references (key, reference) beside transcripts (key, hypothesis), with bucket: missing_transcript, then
    empty_reference, then scored. One left join.
    """
    rows = references.join(transcripts.withColumn("_there", F.lit(True)), key, "left")
    empty = strip(F.coalesce("reference", F.lit(""))) == ""
    return rows.withColumn("bucket", F.when(F.col("_there").isNull(), F.lit("missing_transcript")).when(empty, F.lit("empty_reference")).otherwise(F.lit("scored"))).drop("_there")


def coverage_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if(F.col("bucket") == "scored").alias("num_scored"), F.count_if(F.col("bucket") == "missing_transcript").alias("missing_transcript"), F.count_if(F.col("bucket") == "empty_reference").alias("empty_reference"))


#: Rows that a Python worker is handed at a time, at most: texts may be long.
BATCH = 256
#: Bits of the places of items that a pair keeps: 64 MB. Items up to which places are found item by item, which is faster for few.
KEPT_BITS, FEW = 1 << 29, 2048


def scored_by(score, kind: str, reference: Column, hypothesis: Column) -> Column:
    """A function of two Series of texts as a column. The session's batches are lowered to BATCH rows, and stay so."""
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", SparkSession.active().conf
    if not 0 < int(conf.get(name)) <= BATCH:
        conf.set(name, str(BATCH))
    return F.pandas_udf(score, kind)(reference, hypothesis)


def _places(a: Sequence, b: Sequence):
    """item -> the places in a of an item of b, as bits."""
    if len(a) <= FEW:
        found, bit = dict.fromkeys(b, 0), 1
        for item in a:
            if item in found:
                found[item] |= bit
            bit <<= 1
        return found.__getitem__
    a, b = _coded(a, b)
    found, size = {}, len(a)

    def places(item) -> int:
        same = found.get(item)
        if same is None:
            same = int.from_bytes(np.packbits(a == item, bitorder="little").tobytes(), "little")
            if (len(found) + 1) * size <= KEPT_BITS:
                found[item] = same
        return same

    codes = iter(b.tolist())  # asked in the order of b
    return lambda _: places(next(codes))


def distances(references: Sequence[Sequence], hypotheses: Sequence[Sequence]) -> list[int]:
    """The edit distance of each pair of sequences of hashable items (characters of a string, words).

    Bit-parallel: a column of the table of distances is two bit vectors as long as the longer side, of how neighbours
    differ, and each item of the shorter one moves them by a few operations on machine words: Python's integers are
    such vectors of any length. What both sides begin and end with costs nothing, so it is cut off. Memory is linear: the
    places of the shorter side's items in the longer one are kept up to KEPT_BITS and found again beyond that.
    """
    return [_distance(a, b) for a, b in zip(references, hypotheses)]


def _coded(a: Sequence, b: Sequence) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(a, str) and isinstance(b, str):
        return tuple(np.frombuffer(x.encode("utf-32-le", "surrogatepass"), "<u4") for x in (a, b))
    codes: dict = {}
    return tuple(np.fromiter((codes.setdefault(x, len(codes)) for x in side), np.uint32, len(side)) for side in (a, b))


def _differing(a: Sequence, b: Sequence) -> tuple[Sequence, Sequence]:
    """The longer side and the other without what both begin and end with."""
    if len(a) < len(b):
        a, b = b, a
    n, start, end = len(b), 0, 0
    while start < n and a[start] == b[start]:
        start += 1
    while end < n - start and a[-1 - end] == b[-1 - end]:
        end += 1
    return a[start : len(a) - end], b[start : n - end]


def _distance(a: Sequence, b: Sequence) -> int:
    a, b = _differing(a, b)
    size = len(a)
    if not len(b):
        return size
    places = _places(a, b)
    full, top = (1 << size) - 1, size - 1
    up, down, distance = full, 0, size  # where going down a column adds one, and where it takes one away
    for item in b:
        same = places(item)
        zero = (((same & up) + up) ^ up) | same | down
        right_up, right_down = down | ~(zero | up), up & zero
        distance += (right_up >> top & 1) - (right_down >> top & 1)
        right_up, right_down = right_up << 1 | 1, right_down << 1
        up, down = (right_down | ~(zero | right_up)) & full, right_up & zero & full
    return distance


def common_subsequence(a: Sequence, b: Sequence) -> int:
    """The length of the longest common subsequence, bit-parallel like distances(): a bit for each item of the longer side
    that falls where the length grows.
    """
    if len(a) < len(b):
        a, b = b, a
    full, places = (1 << len(a)) - 1, _places(a, b)
    row = full
    for item in b:
        same = places(item)
        shared = row & same
        row = ((row + shared) | (row - shared)) & full
    return len(a) - row.bit_count()


def character_error_rate(reference: Column, hypothesis: Column) -> Column:
    """Of normalised texts, in code points; null texts are empty."""
    rates = lambda r, h: pd.Series([_rate(d, len(x)) for d, x in zip(distances(r, h), r)], dtype="float64")
    return scored_by(rates, "double", normalised(reference), normalised(hypothesis))


def _rate(errors: int, length: int) -> float:
    return errors / length if length else float(errors)


def align(reference: list[str], hypothesis: list[str]) -> tuple[int, int, int, int]:
    """(hits, substitutions, deletions, insertions) of one cheapest alignment: going back, a diagonal step if it is
    cheapest, then a deletion, then an insertion.

    Two rows of costs and of hits are held, so memory follows the hypothesis, and time the product of both; words are coded
    by a dictionary. The step back from a cell depends on costs next to it alone, so the hits on its way are carried along;
    cells that come by insertions take those of the last cell in the row that doesn't. The counts follow from hits and cost.
    """
    codes: dict[str, int] = {}
    ref, hyp = (np.array([codes.setdefault(w, len(codes)) for w in side], np.int64) for side in (reference, hypothesis))
    n, m = len(ref), len(hyp)
    ramp = np.arange(m + 1)
    cost, hits = ramp.copy(), np.zeros(m + 1, np.int64)
    step, came = np.empty(m + 1, np.int64), np.empty(m + 1, np.int64)
    for word in ref:
        differs = hyp != word
        diagonal = cost[:-1] + differs
        step[0], came[0] = cost[0] + 1, hits[0]
        step[1:] = np.minimum(diagonal, cost[1:] + 1)
        row = np.minimum.accumulate(step - ramp) + ramp
        came[1:] = np.where(diagonal == row[1:], hits[:-1] + ~differs, hits[1:])
        hits = came[np.maximum.accumulate(np.where(step == row, ramp, 0))]
        cost = row
    h, errors = int(hits[m]), int(cost[m])
    insertions = errors - n + h
    deletions = insertions + n - m
    return h, n - h - deletions, deletions, insertions


def _rates(reference: pd.Series, hypothesis: pd.Series) -> pd.DataFrame:
    out = []
    for ref, hyp in zip(reference, hypothesis):
        ref, hyp = ref.split(), hyp.split()
        h, s, d, i = align(ref, hyp)
        errors = s + d + i
        wer = errors / len(ref) if ref else float(errors)
        mer = errors / (errors + h) if errors + h else 0.0
        wil = 1 - h * h / (len(ref) * len(hyp)) if ref and hyp else float(bool(ref or hyp))
        out.append((wer, mer, wil))
    return pd.DataFrame(out, columns=["wer", "mer", "wil"])


def word_rates(reference: Column, hypothesis: Column) -> Column:
    """A struct of wer, mer, wil of two texts, of any number of words."""
    return scored_by(_rates, "wer double, mer double, wil double", normalised(reference), normalised(hypothesis))


def word_error_rate(reference: Column, hypothesis: Column) -> Column:
    """The word error rate alone, of normalised texts; null texts are empty."""
    def rates(r: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([_rate(_distance(x, y), len(x)) for x, y in zip(map(str.split, r), map(str.split, h))], dtype="float64")

    return scored_by(rates, "double", normalised(reference), normalised(hypothesis))


def dealt(pairs: DataFrame) -> DataFrame:
    """The rows spread over all tasks by a hash of their texts."""
    return pairs.repartition(F.xxhash64("reference", "hypothesis"))


def score(pairs: DataFrame, key: str = "video_id") -> DataFrame:
    """key, reference_word_count, hypothesis_word_count, wer, cer, mer, wil of scored pairs (key, reference, hypothesis).

    Null texts are empty; of two empty texts all rates are 0. Repeated rows stay repeated. Pairs are dealt out first: what
    they cost is the product of their lengths, and moving them is little beside it.
    """
    ref, hyp = F.col("reference"), F.col("hypothesis")
    rows = dealt(pairs).withColumn("_m", word_rates(ref, hyp))
    return rows.select(
        key, F.size(words(ref)).alias("reference_word_count"), F.size(words(hyp)).alias("hypothesis_word_count"),
        F.col("_m.wer").alias("wer"), character_error_rate(ref, hyp).alias("cer"), F.col("_m.mer").alias("mer"), F.col("_m.wil").alias("wil"),
    )


def worst(scores: DataFrame, key: str = "video_id", top_n: int = 20) -> DataFrame:
    return scores.orderBy(F.desc("wer"), key).limit(top_n)
