"""Chunks that end where the talk turns to something else: lexical cohesion between neighbouring blocks of sentences, cuts by dynamic programming."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .answers import CHUNK_WORDS, sentences

#: Sentences of a block on each side of a gap.
BLOCK = 3
_WORD = re.compile(r"\w+")


def cohesion(bags: Sequence[Counter], block: int = BLOCK) -> list[float]:
    """For each gap between two sentences the cosine of the word counts of up to `block` sentences before and after it."""
    # whole numbers, kept up as sentences come and go: the dot product, and both squared lengths
    before, after, out = Counter(), Counter(), []
    dot = long_before = long_after = 0
    for bag in bags[:block]:
        for w, n in bag.items():
            long_after += n * (2 * after[w] + n)
            after[w] += n
    for gap in range(1, len(bags)):
        for w, n in bags[gap - 1].items():
            a, b = after[w], before[w]
            long_after -= n * (2 * a - n)
            long_before += n * (2 * b + n)
            dot += (b + n) * (a - n) - a * b
            after[w], before[w] = a - n, b + n
        if gap > block:
            for w, n in bags[gap - 1 - block].items():
                b = before[w]
                long_before -= n * (2 * b - n)
                dot -= n * after[w]
                before[w] = b - n
        if gap + block - 1 < len(bags):
            for w, n in bags[gap + block - 1].items():
                a = after[w]
                long_after += n * (2 * a + n)
                dot += n * before[w]
                after[w] = a + n
        both = math.sqrt(long_before) * math.sqrt(long_after)
        out.append(dot / both if both else 0.0)
    return out


def depths(values: Sequence[float]) -> list[float]:
    """How far each value lies below the nearest peaks on both sides: as far as values rise without a fall."""
    def rises(order: Sequence[float]) -> list[float]:
        out, peak = [], 0.0
        for i, v in enumerate(order):
            peak = max(v, peak) if i and order[i - 1] >= v else v  # going down since the peak, else on a new one
            out.append(peak - v)
        return out

    left, right = rises(values), rises(list(reversed(values)))[::-1]
    return [a + b for a, b in zip(left, right)]


def cuts(gains: Sequence[float], sizes: Sequence[int], longest: int) -> list[int]:
    """The sentences before which to cut: of all ways in which no chunk has more than `longest` words, or one sentence alone
    if that has, the one of greatest total gain; of equal ones the one of fewest cuts, then of the latest last cut.

    gains[i] is what a cut before sentence i + 1 is worth. Time is sentences times sentences of a chunk.
    """
    n = len(sizes)
    best: list[tuple[float, int]] = [(0.0, 0)]  # for the first j sentences: gain, cuts against
    came = [0] * (n + 1)
    for j in range(1, n + 1):
        held, found = 0, None
        for i in range(j - 1, -1, -1):  # the last chunk is i .. j - 1
            held += sizes[i]
            if held > longest and i < j - 1:
                break
            total = (best[i][0] + (gains[i - 1] if i else 0.0), best[i][1] - (1 if i else 0))
            if found is None or total[0] > found[0] + 1e-12 or (total[0] > found[0] - 1e-12 and total[1] > found[1]):
                found, came[j] = total, i
        best.append(found)
    out, j = [], n
    while came[j]:
        j = came[j]
        out.append(j)
    return out[::-1]


def split(parts: Sequence[str], longest: int = CHUNK_WORDS, block: int = BLOCK, sizes: Sequence[int] | None = None) -> list[int]:
    """The sentences before which a new chunk begins; sizes are their words, if they are known. A gap is worth its depth, less the mean depth and half a deviation, so
    that only gaps deeper than most are cut, and others where the length asks for it.
    """
    if len(parts) < 2:
        return []
    deep = depths(cohesion([Counter(_WORD.findall(s.lower())) for s in parts], block))
    mean = sum(deep) / len(deep)
    least = mean + 0.5 * math.sqrt(sum((d - mean) ** 2 for d in deep) / len(deep))
    return cuts([d - least for d in deep], sizes or [len(s.split()) for s in parts], longest)


def topic_chunks(rows: DataFrame, key: str, text: str = "text", max_words: int = CHUNK_WORDS, block: int = BLOCK) -> DataFrame:
    """key, chunk (from 0), n_words, text: whole sentences, cut where the words on both sides have least in common, each chunk of
    at most max_words words, or one longer sentence. No shuffle.

    Null and empty texts have no chunks; repeated rows have theirs each; null keys are kept; extra columns are ignored.
    """
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, chunk, sizes, texts = [], [], [], []
            for i, parts in enumerate(batch.column("parts").to_pylist()):
                words = [len(s.split()) for s in parts]
                begins = [0, *split(parts, max_words, block, words), len(parts)] if parts else []
                for c, (a, b) in enumerate(zip(begins, begins[1:])):
                    owner.append(i)
                    chunk.append(c)
                    sizes.append(sum(words[a:b]))
                    texts.append(" ".join(parts[a:b]))
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(owner, pa.int64())), pa.array(chunk, pa.int32()), pa.array(sizes, pa.int64()), pa.array(texts, pa.string())], names=[key, "chunk", "n_words", "text"])

    return rows.select(F.col(key).alias("key"), sentences(F.col(text)).alias("parts")).mapInArrow(run, f"`{key}` {kind}, chunk int, n_words long, text string")
