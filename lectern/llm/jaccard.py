"""N-gram Jaccard join: MinHash bands find pairs, whole n-gram sets verify them, hot buckets are met block by block."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordHashes, hot_keys, may_hold, meet, mixed, short_batches, text_key, window_hashes, written

WORDS = 5
THRESHOLD = 0.8
#: Share of the pairs at the threshold that share a band; pairs above it are found more surely.
RECALL = 0.9999
#: Hashes of a text within which bands are chosen; more are taken only where single rows don't reach the recall otherwise.
HASHES = 80
#: Distinct texts, and bytes of them, of one bucket that are compared in one task; larger buckets are met by pairs of blocks.
BLOCK, BLOCK_BYTES = 768, 8_000_000
#: Distinct texts, and bytes of them, that one call takes together, about.
TOGETHER, TOGETHER_BYTES = 400, 8_000_000


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest false candidates, that reach the recall at the threshold within so many
    hashes; where even single rows need more, single rows and as many bands as the recall takes.
    """
    best = None
    for rows in range(1, hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if best is None or bands * rows <= hashes:
            best = (bands, rows)
    return best


def shingles(words: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of n words; a shorter text is one run of all its words, none has none."""
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(words, min(n, len(words))))


class MinHash:
    """Band keys of shingle sets."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.times = draw.integers(0, 2**63, (bands * rows, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = draw.integers(0, 2**63, (bands * rows, 1), dtype=np.uint64)

    def keys(self, found: np.ndarray) -> np.ndarray:
        """One 64-bit key per band, the band's number mixed in."""
        if not len(found):
            return np.empty(0, np.int64)
        least = np.full(self.bands * self.rows, np.iinfo(np.uint64).max, np.uint64)
        for a in range(0, len(found), 4096):
            least = np.minimum(least, (found[None, a : a + 4096] * self.times + self.plus).min(1))
        by_band = least.reshape(self.bands, self.rows)
        key = np.arange(self.bands, dtype=np.uint64)
        for i in range(self.rows):
            key = mixed(key, by_band[:, i])
        return key.view(np.int64)


_HASHES = WordHashes()


def _signatures(bands: int, rows: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash(bands, rows)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keys = [minhash.keys(shingles(_HASHES.of((t or b"").split()), words)) for t in texts]
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)))
            sizes = pa.array([len(t or b"") for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("k"), lists, sizes], names=["doc_id", "k", "bands", "size"])

    return run


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(k, c) for every node of the undirected edges (a, b): c is the least node of its component.

    Alternating large and small stars; each round is a written table, the loop ends when a round changes nothing. A
    centre with many neighbours is dealt out by salts. The driver sees a count and a checksum per round, and at most
    HOT_KEYS centres. Null nodes have no edges.
    """
    first = len(scratch.paths)
    edges = scratch.written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
    now = state(edges)
    while now[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        least = scratch.written(least, "least")
        large = meet(both, least.select("u", "m"), "u", hot_keys(least, "u")).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = scratch.written(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()
        edges = scratch.written(small, "edges")
        before, now = now, state(edges)
        scratch.drop(first, len(scratch.paths) - 1)
        if now == before:
            break
    return edges.select(F.col("a").alias("k"), F.col("b").alias("c")).union(edges.select(F.col("b").alias("k"), F.col("b").alias("c")).distinct())


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets (arrays of distinct values) have in common; a set with itself: those that others have too."""
    g = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    every, owner = np.concatenate(sets), np.repeat(np.arange(g), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(every)))
    shared = np.zeros((g, g))
    if (count > 1).any():
        # elements that the same sets hold count together
        marks = np.random.default_rng(5).integers(0, 2**63, g, dtype=np.uint64)
        pattern = np.add.reduceat(marks[owner], first)
        many = np.flatnonzero(count > 1)
        _, one, weight = np.unique(pattern[many], return_index=True, return_counts=True)
        rows = many[one]
        for a in range(0, len(rows), 2048):
            part, w = rows[a : a + 2048], weight[a : a + 2048].astype(np.float32)
            m = np.zeros((len(part), g), np.float32)
            lens = count[part]
            at = np.repeat(first[part] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
            m[np.repeat(np.arange(len(part)), lens), owner[at]] = 1
            shared += m.T @ (m * w[:, None])
    return np.rint(shared).astype(np.int64)


def linked(sets: list[np.ndarray], bands: list[np.ndarray], threshold: Fraction, split: int | None = None) -> np.ndarray:
    """Which pairs of shingle sets that share a band have a Jaccard similarity of the threshold or more, exactly; with
    `split`, only pairs of one set before it and one from it on.
    """
    found = shared_counts(bands) > 0
    np.fill_diagonal(found, False)
    if split is not None:
        found[:split, :split] = found[split:, split:] = False
    if found.any():
        shared, sizes = shared_counts(sets), np.array([len(s) for s in sets], np.int64)
        union = sizes[:, None] + sizes[None, :] - shared
        found &= shared * threshold.denominator >= union * threshold.numerator
    return found


def _verify(threshold: Fraction, words: int):
    def one(keys: list[bytes], weights: np.ndarray, texts: list, bands: list[np.ndarray], split: int | None) -> tuple[np.ndarray, list[bytes]]:
        if len(keys) < 2 or split in (0, len(keys)):  # nothing to meet here
            return np.zeros(len(keys), np.int64), keys
        sets = [shingles(_HASHES.of((t or b"").split()), words) for t in texts]
        found = linked(sets, bands, threshold, split)
        label = np.arange(len(keys))
        while True:
            least = np.minimum(label, np.where(found, label[None, :], len(keys)).min(1))
            least = np.minimum(least, least[least])
            if (least == label).all():
                break
            label = least
        return found @ weights, [keys[i] for i in label]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("lower", "ascending"), ("upper", "ascending"), ("blk", "ascending"), ("k", "ascending")])
        lower, upper, blk = (table[c].to_numpy() for c in ("lower", "upper", "blk"))
        k, w, texts = table["k"].to_pylist(), table["w"].to_numpy(), table["text"].to_pylist()
        bands = [np.array(h, np.int64) for h in table["hs"].to_pylist()]
        links, roots = [], []
        ends = np.flatnonzero(np.concatenate([(lower[1:] != lower[:-1]) | (upper[1:] != upper[:-1]), [True]])) + 1
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
            split = int((blk[a:b] == lower[a]).sum()) if lower[a] != upper[a] else None
            n, root = one(k[a:b], w[a:b], texts[a:b], bands[a:b], split)
            links.append(n)
            roots += root
        return pa.table({"k": pa.array(k, pa.binary()), "links": pa.array(np.concatenate(links), pa.int64()), "root": pa.array(roots, pa.binary())})

    return run


def _pairs_of_blocks(reps: DataFrame, scratch: Scratch, block: int) -> DataFrame:
    """k, w, size, hs, blk, lower, upper: each text that shares a band, once for each pair of blocks in which it meets others.

    A text's block is its largest bucket, or one of the parts of that, if it holds more than a block. Two blocks are met
    if some bucket has texts of both; a text is sent to the blocks of its own buckets alone. So every two texts that
    share a band are together in exactly one pair of blocks, and what is sent follows the pairs that share a band, divided by
    the size of a block where buckets are large. An odd block number is that of a part.
    """
    in_bands = reps.select("k", F.explode("bands").alias("h"))
    buckets = scratch.written(in_bands.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    hot = hot_keys(buckets, "h")
    members = meet(in_bands, buckets, "h", hot).groupBy("k").agg(F.collect_list("h").alias("hs"), F.max(F.struct("n", "h"))["h"].alias("home"))
    members = scratch.written(members.join(reps.select("k", F.col("copies").alias("w"), "size"), "k"), "members")
    homes = members.groupBy("home").agg(F.count("*").alias("n"), F.sum("size").alias("_bytes"))
    parts = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("_bytes") / BLOCK_BYTES), F.lit(1)).cast("int")
    homes = scratch.written(homes.select("home", "n", parts.alias("parts")), "homes")
    part = F.shiftleft(F.xxhash64("home", F.pmod(F.xxhash64("k"), F.col("parts"))), 1).bitwiseOR(F.lit(1))
    blk = F.when(F.col("parts") == 1, F.shiftleft("home", 1)).otherwise(part)
    placed = meet(members, homes, "home", hot_keys(homes, "home"))
    placed = scratch.written(placed.select("k", "hs", "w", "size", blk.alias("blk"), (F.col("n") > 1).alias("own")), "placed")
    by_bucket = placed.select("k", "blk", F.explode("hs").alias("h"))
    several = by_bucket.groupBy("h").agg(F.collect_set("blk").alias("blks")).where(F.size("blks") > 1)
    others = meet(by_bucket.select("h", "k"), several, "h", hot).groupBy("k").agg(F.array_distinct(F.flatten(F.collect_list("blks"))).alias("blks"))
    met = F.array_remove(F.coalesce("blks", F.array().cast("array<bigint>")), F.col("blk"))
    met = F.when(F.col("own"), F.array_append(met, F.col("blk"))).otherwise(met)
    rows = placed.join(others, "k", "left").select("k", "w", "size", "hs", "blk", F.explode(met).alias("_other"))
    return scratch.written(rows.select("k", "w", "size", "hs", "blk", F.least("blk", "_other").alias("lower"), F.greatest("blk", "_other").alias("upper")), "met")


def classes(docs: DataFrame, *, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per distinct text of docs (doc_id, text): k, rep_id (least id), n_rep (rows with that id and text), copies,
    n_links (other rows of similarity >= threshold, copies included), keep_k, class_id (least key and id of the class).

    Copies are one text from the first shuffle on. Band keys are shuffled, not texts, so rows follow texts times bands.
    Every two texts that share a band, and no others, are verified on their whole n-gram sets, once; only texts that share a
    band are shuffled. Classes are the components of the verified links. Hot buckets, classes and texts are dealt out.
    """
    spark = docs.sparkSession
    short_batches(spark)
    exact = Fraction(str(threshold))
    bands, rows = choose_bands(threshold, recall)
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("k"), F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    with Scratch(spark) as scratch:
        signed = keyed.mapInArrow(_signatures(bands, rows, words), f"doc_id {kind}, k binary, bands array<long>, size long")
        by_id = signed.groupBy("k", "doc_id").agg(F.count("*").alias("n"), F.first("bands").alias("bands"), F.first("size").alias("size"))
        least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n")).alias("least")
        reps = by_id.groupBy("k").agg(least, F.sum("n").alias("copies"), F.first("bands").alias("bands"), F.first("size").alias("size"))
        reps = scratch.written(reps.select("k", F.col("least.doc_id").alias("rep_id"), F.col("least.n").alias("n_rep"), "copies", "bands", "size"), "texts")
        met = _pairs_of_blocks(reps, scratch, block)
        total, size = met.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        groups = max(1, -(-total // TOGETHER), -(-size // TOGETHER_BYTES))
        members = met.select("k").distinct()
        texts = may_hold(keyed.select("k", "text"), members, "k", total).groupBy("k").agg(F.first("text").alias("text"))
        alone = F.col("lower").bitwiseOR(F.col("upper")).bitwiseAND(F.lit(1)) == 1
        ways = {"_g": F.when(alone, F.col("lower")).otherwise(F.pmod(F.xxhash64("lower", "upper"), F.lit(groups))), "_h": F.when(alone, F.col("upper"))}
        sent = met.join(texts, "k").select("k", "w", "hs", "blk", "lower", "upper", "text", *[c.alias(n) for n, c in ways.items()])
        checked = scratch.written(sent.groupBy("_g", "_h").applyInArrow(_verify(exact, words), "k binary, links long, root binary"), "verified")
        joined = connected(checked.where("k <> root").select(F.col("k").alias("a"), F.col("root").alias("b")), scratch)
        links = checked.groupBy("k").agg(F.sum("links").alias("links"))
        joined = joined.join(reps.select("k", "rep_id"), "k")
        first = F.min(F.struct(F.col("rep_id").isNull().alias("none"), "rep_id", "k")).alias("first")
        heads = scratch.written(joined.groupBy("c").agg(first, F.count("*").alias("n")), "heads")
        heads_of = heads.select("c", F.col("first.rep_id").alias("class_id"), F.col("first.k").alias("keep_k"))
        classed = meet(joined.select("k", "c"), heads_of, "c", hot_keys(heads, "c")).drop("c")
        out = reps.join(links, "k", "left").join(classed, "k", "left")
        own = F.col("keep_k").isNull()
        n_links = F.coalesce(F.col("links"), F.lit(0)) + F.col("copies") - 1
        out = out.select("k", "rep_id", "n_rep", "copies", n_links.alias("n_links"), F.coalesce("keep_k", "k").alias("keep_k"), F.when(own, F.col("rep_id")).otherwise(F.col("class_id")).alias("class_id"))
        return written(out, "classes")


def similar(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, copy_id, n_copies, n_links for every row of docs (doc_id, text).

    class_id is the least doc_id of the near-duplicate class (documents joined by chains of links), copy_id that of the
    exact copies, n_links the number of other rows whose n-gram sets have a Jaccard similarity of the threshold or more, of
    those that share a band.
    Null texts are empty; texts without words are linked to their exact copies alone; texts of fewer words than an
    n-gram are one n-gram. Very long texts are read whole, in blocks of their own. Repeated rows are copies. Ids may be null (a class of null ids alone has a null class_id).
    Extra columns are ignored. Empty table: empty result.
    """
    found = classes(docs, **options)
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("k"))
    of_text = found.select("k", "class_id", F.col("rep_id").alias("copy_id"), F.col("copies").alias("n_copies"), "n_links")
    return meet(keyed, of_text, "k", hot_keys(found, "k", "copies")).select("doc_id", "class_id", "copy_id", "n_copies", "n_links")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, all columns, but of each near-duplicate class only one: the least doc_id (nulls last), then the least text key.

    Null texts are empty texts, and copies of each other; of repeated rows one stays. Columns may have any names. Empty
    table: empty result.
    """
    names = docs.columns
    heads = classes(docs, **options).where("k = keep_k").select("k", "rep_id", "n_rep")
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").alias("_id"), text_key(F.col("text")).alias("k"))
    kept = boxed.join(heads, (boxed["k"] == heads["k"]) & boxed["_id"].eqNullSafe(heads["rep_id"])).select("_row", boxed["k"], "n_rep")
    alone, repeated = kept.where("n_rep = 1").select("_row"), kept.where("n_rep > 1")
    one = repeated.groupBy("k").agg(F.first("_row").alias("_row")).select("_row")
    return alone.union(one).select(*[F.col("_row").getField(c).alias(c) for c in names])
