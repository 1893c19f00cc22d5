"""From transcripts to ranked context and judged answers: cleaning, chunks of whole sentences, retrieval by cosine, n-gram metrics."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import GAP, strip, words
from . import accuracy, vectors

#: Words that carry nothing, with the comma after them. Fixed values.
FILLERS = ("um", "umm", "uh", "uhh", "er", "erm", "hmm", "mhm")
_FILLER = r"(?i)(^|[^\p{L}\p{N}])(?:(?:" + "|".join(FILLERS) + r")(?:,|\.\.\.)?(?:[ ]+|$))+"
#: The same places, found faster: a letter that a filler begins with is looked for first, and what stands before it isn't taken.
#: The run is possessive, so that Java goes over it in a loop; a run that could be given back costs stack for each filler.
_FILLERS_HERE = r"(?i)(?=[" + "".join(sorted({f[0] for f in FILLERS})) + r"])(?<![\p{L}\p{N}])" + _FILLER.removeprefix(r"(?i)(^|[^\p{L}\p{N}])") + "+"
#: A mark that stands in no text for the end of a sentence.
_CUT = "\x01"
CHUNK_WORDS, TOP_K, LONGEST_GRAM = 200, 10, 4


def sentences(text: Column) -> Column:
    """The sentences of a text, stripped: it is cut at white space after `.`, `!` or `?`. None for an empty text."""
    cut = F.regexp_replace(F.coalesce(text, F.lit("")), rf"([.!?])[{GAP}]+", "$1" + _CUT)
    return F.filter(F.transform(F.split(cut, _CUT), strip), lambda s: s != "")


def clean(text: Column) -> Column:
    """A text without fillers, white space as single spaces, each sentence with a capital letter first, if there is one of a
    single character (not for ß). Null is empty.
    """
    spoken = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{GAP}]+", " "), _FILLERS_HERE, "")
    capital = lambda c: F.when(F.length(F.upper(c)) == 1, F.upper(c)).otherwise(c)
    return F.array_join(F.transform(sentences(spoken), lambda s: F.concat(capital(F.substring(s, 1, 1)), F.substr(s, F.lit(2)))), " ")


def chunks(rows: DataFrame, key: str, text: str = "text", max_words: int = CHUNK_WORDS) -> DataFrame:
    """key, chunk (from 0), n_words, text: whole sentences, a new chunk with each that begins at or after another max_words words.

    A chunk is longer than max_words by less than its last sentence. Null and empty texts have none; repeated keys with
    the same text give their chunks twice over in one, so keys should be unique.
    """
    parts = rows.select(key, F.posexplode(sentences(F.col(text))).alias("pos", "_s")).withColumn("_n", F.size(words(F.col("_s"))))
    before = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("_at", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / max_words).cast("int"))
    joined = F.array_join(F.array_sort(F.collect_list(F.struct("pos", "_s")))["_s"], " ")
    grouped = placed.groupBy(key, "_at").agg(F.sum("_n").alias("n_words"), joined.alias("text"))
    return grouped.select(key, (F.dense_rank().over(Window.partitionBy(key).orderBy("_at")) - 1).alias("chunk"), "n_words", "text")


def cosine(a: Column, b: Column) -> Column:
    """Of two arrays of numbers of one length, in double precision; null if either has no length or is null."""
    total = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return total(a, b) / F.nullif(F.sqrt(total(a, a)) * F.sqrt(total(b, b)), F.lit(0.0))


def retrieve(index: DataFrame, queries: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = TOP_K) -> DataFrame:
    """query_id, rank, key, score: for each of the queries (query_id, vector) the k rows of highest cosine, ties to the smaller
    key, by vectors.nearest(): exact, a matrix product a batch. For tables that many ask, vectors.write_index() and search().
    """
    return vectors.nearest(index, queries, key=key, vector=vector, k=k)


def rouge_l(reference: Column, hypothesis: Column) -> Column:
    """F1 of the longest common subsequence of words, in lower case; 0 if both texts are empty or either is."""
    def scores(r: pd.Series, h: pd.Series) -> pd.Series:
        pairs = [(x.split(), y.split()) for x, y in zip(r, h)]
        return pd.Series([2 * accuracy.common_subsequence(x, y) / (len(x) + len(y)) if x or y else 0.0 for x, y in pairs], dtype="float64")

    return accuracy.scored_by(scores, "double", _lower(reference), _lower(hypothesis))


def _lower(text: Column) -> Column:
    """What Python's str.split() cuts into words()."""
    return F.lower(F.coalesce(text, F.lit("")))


def _grams(words: list[str], n: int) -> Counter:
    return Counter(zip(*[words[i:] for i in range(n)]))


def _scores(reference: list[str], hypothesis: list[str], longest: int) -> tuple[float, float, float]:
    """rouge1, rouge2, bleu."""
    shared = [sum((_grams(reference, n) & _grams(hypothesis, n)).values()) for n in range(1, longest + 1)]
    counts = [(max(len(reference) - n, 0), max(len(hypothesis) - n, 0)) for n in range(longest)]
    f1 = [2 * s / (r + h) if r + h else 0.0 for s, (r, h) in zip(shared, counts)]
    if not all(shared):
        return f1[0], f1[1], 0.0
    logs = sum(math.log(s / h) for s, (_, h) in zip(shared, counts))
    return f1[0], f1[1], math.exp(logs / longest + min(0.0, 1 - len(reference) / len(hypothesis)))


def gram_metrics(pairs: DataFrame, key: str = "video_id", longest: int = LONGEST_GRAM) -> DataFrame:
    """key, rouge1, rouge2 (F1 of word and word-pair counts) and bleu of pairs (key, reference, hypothesis), in lower case.

    BLEU is the geometric mean of the clipped precisions of 1 to `longest` (2 or more) words times the brevity penalty; 0 if any is 0.
    Empty texts score 0. A pair is counted where it stands, so nothing is shuffled; its n-grams are held one length at a time.
    """
    def scores(r: pd.Series, h: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_scores(x.split(), y.split(), longest) for x, y in zip(r, h)], columns=["rouge1", "rouge2", "bleu"])

    scored = accuracy.scored_by(scores, "rouge1 double, rouge2 double, bleu double", _lower(F.col("reference")), _lower(F.col("hypothesis")))
    return pairs.select(key, scored.alias("_s")).select(key, "_s.rouge1", "_s.rouge2", "_s.bleu")
