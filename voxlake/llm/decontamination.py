"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Test items are a stated query set: they are taken in blocks of at most ``BLOCK_BYTES`` of text, each
block is broadcast, all documents are scanned against it, and it is let go. Seeds are three words in order, in
a row or with one word skipped, on either side, so that they stand over replaced, inserted and left-out words; every
one of an item is a seed, however many documents hold it: copies of an edited leak lack just the seeds
over the edit, and no count tells those from the rest. Rare seeds do the work all the same: the words around
the hits of an item are aligned with it only if they share enough words with it to reach the
score at all, which drops no match and which common seeds alone don't. A document is contaminated if a local
alignment reaches ``MIN_SCORE`` of a full match, edited and paraphrased copies included, or the score
of ``PASSAGE_WORDS`` words in a row, so that a passage of a long item is a leak too.

Defined cases: a null or empty text is clean; an item of fewer than ``N`` words is found where its
words stand exactly; an item without words is not searched; equal rows get equal results; equal items
are each reported; an empty table on either side gives no hits; further columns pass through unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import Scratch, WordHashes, bound_batches, shingles, spread, words_of

N = 4
SEEDS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
MIN_SCORE = 0.5
PASSAGE_WORDS = 25
MATCH, MISMATCH, GAP = 2, -1, 1
BLOCK_BYTES = 16 << 20


def seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the seeds and where they begin."""
    found, at = [], []
    for x, y, z in SEEDS:
        n = len(words) - z
        if n > 0:
            found.append(spread((words[x : x + n] * np.uint64(0x9E3779B97F4A7C15) + words[y : y + n]) * np.uint64(0xD6E8FEB86659FD93) + words[z : z + n]))
            at.append(np.arange(n))
    return (np.concatenate(found), np.concatenate(at)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


class Block:
    """Items with an index of their seeds; short ones by their whole words."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        hashes = WordHashes()
        self.ids, self.words, self.bags = [], [], []
        self.short: dict[int, list[tuple[int, int]]] = {}
        grams, owner, place = [], [], []
        for item_id, text in sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
            w = hashes.of(words_of(text))
            if not len(w):
                continue
            if len(w) < N:
                self.short.setdefault(len(w), []).append((int(shingles(w, len(w))[0]), len(self.ids)))
            else:
                g, at = seeds(w)
                grams.append(g)
                owner.append(np.full(len(g), len(self.ids), np.int32))
                place.append(at.astype(np.int32))
            self.ids.append(item_id)
            self.words.append(w)
            self.bags.append(np.unique(w, return_counts=True))
        g, o, p = (np.concatenate(x) if x else np.zeros(0, d) for x, d in ((grams, np.uint64), (owner, np.int32), (place, np.int32)))
        self._index(g, o, p)

    def _index(self, grams: np.ndarray, owner: np.ndarray, place: np.ndarray) -> None:
        order = np.argsort(grams, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.keys, self.first = np.unique(grams[order], return_index=True)
        self.last = np.append(self.first[1:], len(grams))
        bits = min(26, max(16, len(self.keys).bit_length() + 5))
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(self.keys >> self.shift).astype(np.int64)] = True

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the text that hold a seed, and the seed's key index."""
        g, begin = seeds(words)
        at = np.flatnonzero(self.table[(g >> self.shift).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.keys, g[at]), max(0, len(self.keys) - 1))
        same = self.keys[k] == g[at] if len(self.keys) else np.zeros(len(at), bool)
        return begin[at[same]], k[same]

    def short_hits(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Short items that stand in a text: index, range of words."""
        for n, held in self.short.items():
            if len(words) >= n:
                g = shingles(words, n)
                for h, i in held:
                    at = np.flatnonzero(g == np.uint64(h))
                    if len(at):
                        yield i, int(at[0]), int(at[0]) + n


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment score, and the end of its range in the text."""
    step = GAP * np.arange(len(text), dtype=np.int64)
    row = np.zeros(len(text), np.int64)
    best, end = 0, 0
    for word in item:
        diagonal = np.where(text == word, MATCH, MISMATCH)
        diagonal[1:] += row[:-1]
        row = np.maximum(np.maximum(diagonal, row - GAP), 0)
        row = np.maximum.accumulate(row + step) - step
        j = int(row.argmax())
        if row[j] > best:
            best, end = int(row[j]), j + 1
    return best, end


def shared(bag: tuple[np.ndarray, np.ndarray], text: np.ndarray) -> int:
    """Words that an item and a text have in common; an alignment matches no more."""
    words, counts = bag
    k = np.minimum(np.searchsorted(words, text), len(words) - 1)
    return int(np.minimum(np.bincount(k[words[k] == text], minlength=len(words)), counts).sum())


def least_score(item: np.ndarray, min_score: float) -> float:
    """The alignment score from which on a text holds the item."""
    return MATCH * min(min_score * len(item), PASSAGE_WORDS)


def best_match(item: np.ndarray, bag: tuple[np.ndarray, np.ndarray], text: np.ndarray, starts: np.ndarray, least: float) -> tuple[float, int, int]:
    """Best score and the words it covers; 0 if it can't reach the least. starts: where the item would begin, by each hit, in order."""
    slack = len(item) // 4 + 8
    lo, hi = np.maximum(starts - slack, 0), np.minimum(starts + len(item) + slack, len(text))
    new = np.flatnonzero(lo[1:] > hi[:-1]) + 1
    found = (0, 0, 0)
    for a, b in zip(lo[np.append(0, new)].tolist(), hi[np.append(new - 1, len(hi) - 1)].tolist(), strict=True):
        if MATCH * shared(bag, text[a:b]) < least:
            continue
        score, end = align(item, text[a:b])
        if score > found[0]:
            found = (score, a, a + end)
    score, a, end = found
    if not score:
        return 0, 0, 0
    back = align(item[::-1], text[a:end][::-1])[1]
    return score, end - back, end


def matches(block: Block, words: np.ndarray, min_score: float) -> list[tuple[int, float, int, int]]:
    """Items that a text holds: index, score as a share of a full match, range of words."""
    out = [(i, 1.0, lo, hi) for i, lo, hi in block.short_hits(words)]
    at, key = block.hits(words)
    if not len(at):
        return out
    n = block.last[key] - block.first[key]
    s = np.repeat(block.last[key] - np.cumsum(n), n) + np.arange(n.sum())  # places of the hit keys
    owner, start = block.owner[s], np.repeat(at, n) - block.place[s]
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    for o in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(owner)) + 1):
        i = int(owner[o[0]])
        item = block.words[i]
        least = least_score(item, min_score)
        score, lo, hi = best_match(item, block.bags[i], words, start[o], least)
        if score >= least:
            out.append((i, score / (MATCH * len(item)), lo, hi))
    return out


def _texts(batch: pa.RecordBatch, hashes: WordHashes) -> Iterator[np.ndarray]:
    for x in batch.column("text"):
        yield hashes.of(words_of(x.as_py()))


def item_blocks(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The items in blocks that can be broadcast."""
    bound_batches(docs.sparkSession)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(1.5 * size / block_bytes))
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b).select("item_id", "text") for b in range(count)]


def _sent(block: DataFrame):
    spark = block.sparkSession
    return spark.sparkContext.broadcast(Block([(r.item_id, r.text) for r in block.collect()]))


_FOUND = "doc_id long, item_id long, score double, first_word int, end_word int"


def _hits(docs: DataFrame, sent, min_score: float) -> DataFrame:
    def scan(batches):
        block, hashes = sent.value, WordHashes()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, words in zip(batch.column("doc_id"), _texts(batch, hashes), strict=True):
                for i, score, lo, hi in matches(block, words, min_score):
                    for column, value in zip(out, (doc_id.as_py(), block.ids[i], score, lo, hi), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["doc_id", "item_id", "score", "first_word", "end_word"])

    return docs.select("doc_id", "text").mapInArrow(scan, _FOUND)


def _clean(docs: DataFrame, sent, min_score: float, flip: bool = False) -> DataFrame:
    def run(batches):
        block, hashes = sent.value, WordHashes()
        for batch in batches:
            yield batch.filter(pa.array([bool(matches(block, words, min_score)) == flip for words in _texts(batch, hashes)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def find_contamination(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, score, first_word, end_word of every contaminated document and item it holds."""
    blocks = item_blocks(docs, items, block_bytes)
    if len(blocks) == 1:
        return _hits(docs, _sent(blocks[0]), min_score)
    scratch = Scratch(docs.sparkSession, "leaks")
    found = []
    for k, block in enumerate(blocks):
        sent = _sent(block)
        found.append(scratch.save(_hits(docs, sent, min_score), f"block={k}"))
        sent.destroy()
    return docs.sparkSession.read.schema(_FOUND).parquet(*(scratch.path(f"block={k}") for k in range(len(found))))


def remove_contaminated(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The clean documents, with all their columns."""
    blocks = item_blocks(docs, items, block_bytes)
    if len(blocks) == 1:
        return _clean(docs, _sent(blocks[0]), min_score)
    scratch = Scratch(docs.sparkSession, "leaks")
    key = F.sha2(F.coalesce("text", F.lit("")), 256)
    for k, block in enumerate(blocks):  # equal texts are clean or not together
        sent = _sent(block)
        scratch.save(_clean(docs.select("text"), sent, min_score, flip=True).select(key.alias("leak")).distinct(), f"block={k}")
        sent.destroy()
    leaks = docs.sparkSession.read.schema("leak string").parquet(*(scratch.path(f"block={k}") for k in range(len(blocks)))).distinct()
    return docs.join(leaks, key == F.col("leak"), "left_anti")


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")


def op1_seeded_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, exactly or edited, with the words it covers."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_contamination(docs, _benchmark(spark, sf_dir)).withColumn("score", F.round("score", 6))


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, _benchmark(spark, sf_dir))
