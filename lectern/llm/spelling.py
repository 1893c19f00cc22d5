"""Spelling variants: each word's distance-one automaton is intersected, depth first, with broadcast shards of a compact trie."""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, hot_keys, meet, short_batches, written

#: Code points and occurrences that a word must have; times that a form must be as frequent as its variant.
MIN_CHARS, MIN_COUNT, RATIO = 5, 3, 2
#: One in so many (document, word) pairs is misspelt by the registered query, which plants variants that way.
MISSPELT_EVERY = 97
#: Different words that a task counts before it hands them on.
WORDS_HELD = 200_000
#: Words and characters of a shard, at most; characters of the shards that are sent to the executors at a time.
SHARD_WORDS, SHARD_CHARS, WAVE_CHARS = 65_536, 2_000_000, 16_000_000

#: Letters are A-Z, a-z and U+00C0 to U+00FF; in Latin-1 a code point is a byte. A-Z become a-z, all others a space.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """The maximal runs of letters, A-Z lower-cased, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def misspelt(word: bytes, seed: int, every: int) -> bytes:
    """The word, or, if `every` divides the CRC-32 of what came before and the word in UTF-8, the word without one code point."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
    return word if h % every else word[: h % len(word)] + word[h % len(word) + 1 :]


def _count(min_chars: int, every: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                own = Counter(words_of(text))
                if every:
                    seed = zlib.crc32(f"{doc}:".encode())
                    for word, n in own.items():
                        word = misspelt(word, seed, every)
                        if len(word) >= min_chars:
                            held[word] += n
                else:
                    for word, n in own.items():
                        if len(word) >= min_chars:
                            held[word] += n
                if len(held) >= WORDS_HELD:
                    yield made()
                    held.clear()
        yield made()

    return run


def count_words(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, misspell_every: int | None = None) -> DataFrame:
    """word, n: how often each word of docs (doc_id, text) occurs in all, of at least min_chars code points and min_count
    occurrences.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased. With misspell_every a word loses a code
    point in one of so many documents, chosen by the CRC-32 of `<doc_id>:<word>` (a null id is empty): variants whose
    originals are known. Null and empty texts have no words; repeated rows count each; extra columns are ignored; an empty
    table has no words. Tasks count before anything is shuffled, so a hot word is a row a task.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.mapInArrow(_count(min_chars, misspell_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def one_apart(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes b of a."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1 :] or (len(a) == len(b) and a[i + 1 :] == b[i + 1 :])


class Trie:
    """Sorted words with counts. Nodes are numbered breadth first, so the edge at place e of `labels` leads to node e + 1.

    A node under which there is one word alone is a leaf and holds the rest of the word as its tail.
    """

    def __init__(self, labels: str, edges: array, tails: str, tail_at: array, counts: array):
        self.labels, self.edges, self.tails, self.tail_at, self.counts = labels, edges, tails, tail_at, counts

    @classmethod
    def build(cls, words: list[str], counts: list[int]) -> Trie:
        labels, tails, edges, tail_at, held = [], [], array("I", [0]), array("I", [0]), array("q")
        level, depth, chars = [(0, len(words))], 0, 0
        while level:
            below = []
            for a, b in level:
                if b - a == 1:
                    tails.append(words[a][depth:])
                    chars += len(tails[-1])
                    held.append(counts[a])
                else:
                    ends = b > a and len(words[a]) == depth
                    held.append(counts[a] if ends else 0)
                    a += ends
                    while a < b:
                        label, first = words[a][depth], a
                        while a < b and words[a][depth] == label:
                            a += 1
                        labels.append(label)
                        below.append((first, a))
                edges.append(len(labels))
                tail_at.append(chars)
            level, depth = below, depth + 1
        return cls("".join(labels), edges, "".join(tails), tail_at, held)

    def match(self, node: int, rest: str) -> int:
        """The count of the word that goes on from the node with `rest`, 0 if there is none."""
        edges, labels, i = self.edges, self.labels, 0
        while True:
            a, b = edges[node], edges[node + 1]
            if a == b:
                return self.counts[node] if self.tails[self.tail_at[node] : self.tail_at[node + 1]] == rest[i:] else 0
            if i == len(rest):
                return self.counts[node]
            node = labels.find(rest[i], a, b) + 1
            if not node:
                return 0
            i += 1

    def near(self, word: str, found: dict[str, int]) -> None:
        """Adds the words at distance one, with their counts. The automaton's states are a place in the word and whether the
        edit is spent: along the word's own path it isn't, and each node there is left by every edit.
        """
        edges, labels, node, n = self.edges, self.labels, 0, len(word)
        for i in range(n + 1):
            a, b = edges[node], edges[node + 1]
            if a == b:
                tail = self.tails[self.tail_at[node] : self.tail_at[node + 1]]
                if self.counts[node] and one_apart(word[i:], tail):
                    found[word[:i] + tail] = self.counts[node]
                return
            head, rest, after = word[:i], word[i:], word[i + 1 :]
            if i < n and (count := self.match(node, after)):
                found[head + after] = count
            own = labels.find(word[i], a, b) if i < n else -1
            for e in range(a, b):
                if count := self.match(e + 1, rest):
                    found[head + labels[e] + rest] = count
                if e != own and i < n and (count := self.match(e + 1, after)):
                    found[head + labels[e] + after] = count
            if own < 0:
                return
            node = own + 1


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tries of sorted words, each of bounded size; a longer word is a shard of its own."""
    from pyspark import TaskContext

    part, made = TaskContext.get().partitionId(), 0

    def closed() -> pa.RecordBatch:
        trie = Trie.build(words, counts)
        first, second = "".join(sorted({w[:1] for w in words})), "".join(sorted({w[1:2] for w in words}))
        row = {"shard": f"{part:09d}-{made:09d}", "chars": len(trie.tails) + 16 * len(trie.counts), "first": first, "second": second, "labels": trie.labels, "edges": trie.edges.tobytes(), "tails": trie.tails, "tail_at": trie.tail_at.tobytes(), "counts": trie.counts.tobytes()}
        return pa.RecordBatch.from_pylist([row], schema=pa.schema([(c, pa.int64() if c == "chars" else pa.binary() if isinstance(v, bytes) else pa.string()) for c, v in row.items()]))

    words, counts, chars = [], [], 0
    for batch in batches:
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            if words and (len(words) >= SHARD_WORDS or chars + len(word) > SHARD_CHARS):
                yield closed()
                words, counts, chars, made = [], [], 0, made + 1
            words.append(word)
            counts.append(n)
            chars += len(word)
    if words:
        yield closed()


_SHARD = "shard string, chars long, first string, second string, labels string, edges binary, tails string, tail_at binary, counts binary"


class Wave:
    """The shards that are searched together. Those that can't hold a near word by their words' first two letters are passed over."""

    def __init__(self, rows: list[tuple]):
        self.tries, self.first, self.second = [], {}, {}
        for at, (first, second, labels, edges, tails, tail_at, counts) in enumerate(rows):
            self.tries.append(Trie(labels, array("I", edges), tails, array("I", tail_at), array("q", counts)))
            for by, letters in ((self.first, first), (self.second, second)):
                for c in letters:
                    by[c] = by.get(c, 0) | 1 << at
        self.all = (1 << len(rows)) - 1

    def near(self, word: str) -> dict[str, int]:
        found: dict[str, int] = {}
        some = self.all
        if len(word) > 2:  # an edit leaves the first letter, or moves the second one by a place at most
            a, b = word[0], word[1]
            some = self.first.get(a, 0) | self.first.get(b, 0) | self.second.get(a, 0) | self.second.get(b, 0)
        while some:
            self.tries[(some & -some).bit_length() - 1].near(word, found)
            some &= some - 1
        return found


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave = Wave(shared.value)
        for batch in batches:
            many, best, best_n = [], [], []
            for word in batch.column("word").to_pylist():
                found = wave.near(word)
                top = min(found, key=lambda w: (-found[w], w), default=None)
                many.append(len(found))
                best.append(top)
                best_n.append(found.get(top))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(many, pa.int64()), pa.array(best, pa.string()), pa.array(best_n, pa.int64())], names=["word", "n", "n_near", "near", "near_n"])

    return run


def near_words(words: DataFrame, *, wave_chars: int = WAVE_CHARS) -> DataFrame:
    """word, n, n_near, near, near_n for each of words (word, n): how many others are at distance one, and the most frequent
    of them (ties: the smallest in code-point order), null if there is none.

    Distance one is one inserted, deleted or replaced code point. The words, sorted by range, become tries of at most
    SHARD_WORDS words; the shards go out in waves of bounded size, each word meets every shard of a wave in one task and
    gives one row, and a wave's rows are written before the next is sent. A word given twice counts once, with its n added
    up; null and empty words, and n that are null, take no part. Extra columns are ignored. Empty table: no rows.
    """
    spark = words.sparkSession
    with Scratch(spark) as scratch:
        usable = words.where("word is not null and word <> '' and n is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
        vocabulary = scratch.written(usable, "words")
        count = vocabulary.count()
        ranges = max(1, -(-count // SHARD_WORDS))
        shards = scratch.written(vocabulary.repartitionByRange(ranges, "word").sortWithinPartitions("word").mapInArrow(_shards, _SHARD), "shards")
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // SHARD_WORDS))
        dealt = scratch.written(vocabulary.repartition(tasks), "dealt")
        sizes = [(r["shard"], r["chars"]) for r in shards.select("shard", "chars").orderBy("shard").collect()]  # a row a shard
        waves: list[list[str]] = []
        held = wave_chars
        for shard, chars in sizes:
            if held + chars > wave_chars:
                waves.append([])
                held = 0
            waves[-1].append(shard)
            held += chars
        found = None
        for wave in waves:
            rows = shards.where(F.col("shard").between(wave[0], wave[-1])).orderBy("shard").drop("shard", "chars").collect()
            shared = spark.sparkContext.broadcast([tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in rows])
            one = scratch.written(dealt.mapInArrow(_search(shared), "word string, n long, n_near long, near string, near_n long"), "near")
            shared.destroy()
            found = one if found is None else found.union(one)
        if found is None:
            return spark.createDataFrame([], "word string, n long, n_near long, near string, near_n long")
        order: Column = F.when(F.col("near").isNotNull(), F.struct(-F.col("near_n"), F.col("near")))
        reduced = found.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), F.min_by("near", order).alias("near"), F.max("near_n").alias("near_n"))
        return written(reduced, "near")


def roots(forms: DataFrame) -> DataFrame:
    """The columns of forms (word, form, ...) and root: from the word, forms followed to the last one.

    Pointers are doubled until none moves; as every form is more frequent than its word there are no circles, and few
    rounds. Pointers at one word are dealt out where they are many.
    """
    spark = forms.sparkSession
    with Scratch(spark) as scratch:
        at = scratch.written(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
        while True:
            onward = at.where("root <> word").select(F.col("word").alias("_at"), F.col("root").alias("_next"))
            moving = at.where("root <> word").withColumnRenamed("root", "_at")
            hot = hot_keys(moving.groupBy("_at").agg(F.count("*").alias("n")), "_at")
            moved = meet(moving, onward, "_at", hot, "left").select("word", F.coalesce("_next", "_at").alias("root"), F.col("_next").isNotNull().alias("_moved"))
            after = scratch.written(moved.unionByName(at.where("root = word").withColumn("_moved", F.lit(False))), "roots")
            at = after.drop("_moved")
            if after.where("_moved").isEmpty():
                return written(forms.join(at, "word"), "variants")


def group_variants(words: DataFrame, *, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for each of words (word, n), as near_words() has them.

    A word's form is its most frequent near word if that occurs at least `ratio` (2 or more) times as often; else null.
    root is where following forms ends, the word itself if it has none.
    """
    if ratio < 2:
        raise ValueError("a form must occur at least twice as often as its variant")
    near = near_words(words)
    taken = F.col("near_n") >= ratio * F.col("n")
    forms = near.select("word", F.when(taken, F.col("near")).alias("form"), "n", "n_near", F.when(taken, F.col("near_n")).alias("form_n"))
    return roots(forms).select("word", "form", "root", "n", "n_near", "form_n")


def variants_of_documents(docs: DataFrame) -> DataFrame:
    """group_variants() of all words of docs, one in MISSPELT_EVERY of each document's misspelt."""
    return group_variants(count_words(docs, misspell_every=MISSPELT_EVERY))
