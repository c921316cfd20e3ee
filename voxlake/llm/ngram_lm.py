"""Language-model scoring with an Elias-Fano n-gram trie of three levels.

The vocabulary is an Elias-Fano sequence of sorted word hashes with their counts; a word's id is its
place. A level lists, for each context in order, its successors: monotone pointers (one Elias-Fano
sequence) say where a context's successors begin, and the successors' ids, each context's counted on
from the last value before it, form another. An n-gram is found by a search for the successor of its
context-relative value. A context of the second level is a word, one of the third is a bigram, named
by its place in the second. A node has a probability quantised to ``CODES`` levels of its logarithm;
a context's weight for what backs off follows from its count.

    p(w)       = (c(w) + 0.1) / (N + 0.1 (V + 1))
    p(w | h)   = c(h w) / (c(h) + K) + K / (c(h) + K) p(w)             (Dirichlet smoothing; sums to 1)
    p(w | g h) = c(g h w) / (c(g h) + L) + L / (c(g h) + L) p(w | h)   (from the second word of a text on)

Texts are tokenised once, in batches of about ``BATCH_TOKENS``: a batch is kept as a compressed stream
of places in its own sorted words. Level by level, every batch asks for its distinct words, bigrams
and trigrams, with their counts in training texts; the questions are shuffled to segments of the
level, which add up the counts, make their part of the trie from them, look everything asked up in
it and answer the batches. A segment is a range of hashes (words) or holds stretches of contexts; a context that would
fill a segment by itself is split by its successors. So no task holds more than a segment or a batch,
nobody holds the model, and nothing is pruned: every word, bigram and trigram of the corpus counts.
The model's segments can stay in the shared folder as flat buffers that are read in place; documents
scored later ask these instead of training.

Defined cases: a null text is empty: one end token; a document without id trains if the checksum of
the empty text says so; equal rows count each; further columns are ignored; without training text
every token has probability 0.1 / 0.1 = 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import Scratch, WordHashes, spread, words_of
from voxlake.llm.elias_fano import EliasFano, pack, unpack

FOLDS = 10
ADD = 0.1
DIRICHLET = (100.0, 20.0)
CODES, LOWEST = 254, 12.0  # levels of -log10 p, from 0
ABSENT = 255
SEGMENT_TOKENS = 500_000  # of a bigram or trigram segment
WORD_SEGMENT_TOKENS = 8_000_000  # their distinct words by batch are some hundredths
BATCH_TOKENS = 1_000_000
END = xxhash.xxh3_64_intdigest(b"") >> 1  # no word is empty; as a context, the start


def is_held_out(doc_id):
    """crc32 of the id as text modulo 10 is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def encode(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers, compressed by planes of bytes: of their steps where they rise."""
    head, parts = [len(arrays)], []
    for a in arrays:
        a = np.asarray(a).astype(np.uint64)
        rising = len(a) > 1 and bool((a[1:] >= a[:-1]).all())
        x = np.diff(a, prepend=np.uint64(0)) if rising else a
        width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
        head += [len(a), width, int(rising)]
        parts.append(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(np.array(head, np.int64).tobytes() + b"".join(parts))


def decode(block: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    count = int(raw[:8].view(np.int64)[0])
    head = raw[8 : 8 + 24 * count].view(np.int64).reshape(-1, 3)
    out, at = [], 8 + 24 * count
    for n, width, rising in head.tolist():
        x = np.zeros((n, 8), np.uint8)
        x[:, :width] = raw[at : at + n * width].reshape(width, n).T
        x = x.view(np.int64).ravel()
        out.append(np.cumsum(x) if rising else x)
        at += n * width
    return out


# -- a batch ---------------------------------------------------------------------------------

_ROWS = "kind string, segment long, batch long, doc_ids array<long>, sizes array<long>, trains array<long>, blob binary"
_KINDS = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())


def _record(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _KINDS, strict=True)], [x.split()[0] for x in _ROWS.split(", ")])


def _runs(groups: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each run of equal groups."""
    edge = np.concatenate(([0], np.flatnonzero(np.diff(groups)) + 1, [len(groups)])) if len(groups) else np.zeros(1, np.int64)
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        yield int(groups[a]), slice(a, b)


def _tokenised(bits: int, batch_tokens: int):
    """Batches of texts (doc_id, train, text): their streams, and their words with counts by segment."""

    def flush(number: int, ids: list, trains: list, sizes: list, parts: list) -> pa.RecordBatch:
        words, at, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        trained = np.bincount(at, np.repeat(np.array(trains, np.int64), sizes), len(words)).astype(np.int64)
        order = np.argsort(-counts, kind="stable")  # frequent words get small numbers, which compress
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        batch = (TaskContext.get().partitionId() << 24) + number
        rows = [("stream", None, batch, ids, sizes, trains, encode(rank[at], order))]
        for s, run in _runs((words >> np.uint64(63 - bits)).astype(np.int64)):
            rows.append(("words", s, batch, None, None, None, encode(words[run], trained[run])))
        return _record(rows)

    def run(batches):
        hashes, number, n = WordHashes(), 0, 0
        ids, trains, sizes, parts = [], [], [], []
        end = np.array([END], np.uint64)
        for b in batches:
            for doc_id, train, x in zip(b.column("doc_id").to_pylist(), b.column("train").to_pylist(), b.column("text"), strict=True):
                h = hashes.of(words_of(x.as_py())) >> np.uint64(1)
                parts += [h, end]
                ids.append(doc_id), trains.append(int(train)), sizes.append(len(h) + 1)
                n += len(h) + 1
                if n >= batch_tokens:
                    yield flush(number, ids, trains, sizes, parts)
                    ids, trains, sizes, parts, n, number = [], [], [], [], 0, number + 1
        if ids:
            yield flush(number, ids, trains, sizes, parts)

    return run


class Batch:
    """A batch with the answers it has got so far. Words go by their place among its own sorted words."""

    def __init__(self, stream: pa.Table, answers: pa.Table, model: Model):
        rank, order = decode(stream.column("blob")[0].as_py())
        self.number = stream.column("batch")[0].as_py()
        self.ids, self.sizes, self.trains = stream.column("doc_ids")[0].values, *(stream.column(c)[0].values.to_numpy() for c in ("sizes", "trains"))
        self.words = order[rank]
        self.n, self.model = len(order), model
        self.first = np.zeros(len(self.words), bool)
        self.first[np.concatenate(([0], np.cumsum(self.sizes)[:-1]))] = True
        said: dict[str, list] = {"words": [], "bigrams": [], "trigrams": []}
        for kind, segment, blob in sorted(zip(*(answers.column(c).to_pylist() for c in ("kind", "segment", "blob")), strict=True)):
            said[kind].append((segment, decode(blob)))
        count, word_id = [], []
        for s, (counts, places) in said["words"]:
            i = np.full(len(counts), -1, np.int64)
            i[counts > 0] = places + model.words.start(s)
            count.append(counts), word_id.append(i)
        self.count, self.word_id = (np.concatenate(x) for x in (count, word_id))
        self._bigrams(said["bigrams"])
        self._trigrams(said["trigrams"])

    def _asked(self, key: np.ndarray, ask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys that are asked for, each token's place among them (-1: not asked), and their counts in training."""
        each, at = np.unique(key[ask], return_inverse=True)
        place = np.full(len(key), -1, np.int64)
        place[ask] = at
        return each, place, np.bincount(at, np.repeat(self.trains, self.sizes)[ask], len(each)).astype(np.int64)

    def _bigrams(self, said: list) -> None:
        """Each token with the one before it; the first of a text with END, which closes the text before it."""
        self.before = np.concatenate((self.words[-1:], self.words[:-1]))
        known = self.word_id >= 0
        self.pairs, self.pair, self.pair_counts = self._asked(self.before * self.n + self.words, known[self.before] & known[self.words])
        h, w = self.pairs // self.n, self.pairs % self.n
        self.pair_contexts, self.pair_totals, self.pair_words = self.word_id[h], self.count[h], self.word_id[w]
        if not said:
            return
        codes, ids, counts = np.full(len(self.pairs), ABSENT), np.full(len(self.pairs), -1, np.int64), np.zeros(len(self.pairs), np.int64)
        segment, order = self.model.bigrams.dealt(self.pair_contexts, self.pair_words)
        answers = dict(said)
        for s, run in _runs(segment):
            at = order[run]
            codes[at], places, n = answers[s]
            found = at[codes[at] != ABSENT]
            ids[found], counts[found] = places + self.model.bigrams.start(s), n
        self.pair_codes, self.pair_ids, self.pair_n = codes, ids, counts

    def _trigrams(self, said: list) -> None:
        if not hasattr(self, "pair_ids"):
            return
        self.before_pair = np.where(self.first, -1, np.concatenate(([-1], self.pair[:-1])))
        there = np.append(self.pair_ids >= 0, False)  # -1 is none
        self.context_n = np.append(self.pair_n, 0)[self.before_pair]
        self.triples, self.triple, self.triple_counts = self._asked(self.before_pair * self.n + self.words, there[self.before_pair] & (self.word_id[self.words] >= 0))
        p, w = self.triples // self.n, self.triples % self.n
        self.triple_contexts, self.triple_totals, self.triple_words = self.pair_ids[p], self.pair_n[p], self.word_id[w]
        if not said:
            return
        self.triple_codes = np.full(len(self.triples), ABSENT)
        segment, order = self.model.trigrams.dealt(self.triple_contexts, self.triple_words)
        answers = dict(said)
        for s, run in _runs(segment):
            self.triple_codes[order[run]] = answers[s][0]

    def questions(self, level: Level) -> pa.RecordBatch:
        """Contexts, their totals if they are split (else the segment can count), successors of each, words, counts: by segment."""
        if level.name == "bigrams":
            contexts, totals, words, counts = self.pair_contexts, self.pair_totals, self.pair_words, self.pair_counts
        else:
            contexts, totals, words, counts = self.triple_contexts, self.triple_totals, self.triple_words, self.triple_counts
        segment, order = level.dealt(contexts, words)
        rows = []
        for s, run in _runs(segment):
            at = order[run]
            c = contexts[at]
            begin = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
            rows.append((level.name, s, self.number, None, None, None, encode(c[begin], totals[at][begin] if s >= level.n_segments else totals[:0], np.diff(np.append(begin, len(at))), words[at], counts[at])))
        return _record(rows)

    def scores(self) -> pa.Table:
        chance = self.model.chances(self.count)
        k, m = self.model.dirichlet
        chances = 10.0 ** (-LOWEST / CODES * np.arange(ABSENT + 1))
        chances[ABSENT] = 0.0
        own = lambda codes, place: np.append(chances[codes], 0.0)[place] if len(codes) else 0.0
        p = chance[self.words]
        base = np.log10(p)
        h = self.count[self.before]
        p = own(getattr(self, "pair_codes", ()), self.pair) + k / (h + k) * p
        if hasattr(self, "context_n"):
            p = own(getattr(self, "triple_codes", ()), self.triple) + m / (self.context_n + m) * p
        begin = np.flatnonzero(self.first)
        total = lambda x: np.add.reduceat(x, begin)
        known = total((self.count[self.words] > 0).astype(np.int64))
        return pa.table({"doc_id": self.ids, "n_tokens": pa.array(self.sizes, pa.int64()), "n_known": pa.array(known, pa.int64()), "base_score": total(base), "score": total(np.log10(p))})


# -- the model -------------------------------------------------------------------------------


@dataclass
class Level:
    """Segments of a level: how many, which contexts have some of their own, and where each segment's nodes are numbered from."""

    name: str
    n_contexts: int = 0
    n_words: int = 0
    n_segments: int = 1
    stretch: int = 6  # contexts are dealt by stretches of 2**stretch: neighbours compress well, and no segment gets all that is frequent
    hot: dict[int, tuple[int, int]] = field(default_factory=dict)  # context: first segment, number
    segments: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    size: int = 0
    path: str = ""

    def counted(self, rows: list) -> None:
        """rows: segment, n."""
        rows = sorted((r.segment, r.n) for r in rows)
        self.segments = np.array([s for s, _ in rows], np.int64)
        self.starts = np.concatenate(([0], np.cumsum([n for _, n in rows]))).astype(np.int64)
        self.size = int(self.starts[-1])

    def start(self, segment: int) -> int:
        at = int(np.searchsorted(self.segments, segment))
        return int(self.starts[at]) if at < len(self.segments) and self.segments[at] == segment else 0

    def heat(self, counts: dict[int, int]) -> None:
        """Contexts that would fill a segment by themselves get their own."""
        at = self.n_segments
        for context, n in sorted(counts.items()):
            parts = -(-2 * n // SEGMENT_TOKENS)
            self.hot[context] = (at, parts)
            at += parts

    def dealt(self, contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Segments in order, and the places of what belongs to them, in the order given."""
        out = (spread((contexts >> self.stretch).astype(np.uint64)) % np.uint64(self.n_segments)).astype(np.int64)
        if self.hot:
            hot = np.array(sorted(self.hot), np.int64)
            at = np.flatnonzero(np.isin(contexts, hot))
            first, parts = (np.array([self.hot[h][k] for h in hot.tolist()], np.int64)[np.searchsorted(hot, contexts[at])] for k in (0, 1))
            out[at] = first + words[at] * parts // max(1, self.n_words)
        order = np.argsort(out, kind="stable")
        return out[order], order


@dataclass
class Model:
    """What the driver knows of a trained model: sizes and places, not its nodes."""

    dirichlet: tuple[float, float]
    bits: int
    total: int = 0
    words: Level = field(default_factory=lambda: Level("words"))
    bigrams: Level = field(default_factory=lambda: Level("bigrams"))
    trigrams: Level = field(default_factory=lambda: Level("trigrams", stretch=10))

    def chances(self, counts: np.ndarray) -> np.ndarray:
        """Smoothed probabilities of words with these counts."""
        return (counts + ADD) / (self.total + ADD * (self.words.size + 1))


_ANSWERS = "kind string, segment long, batch long, n long, total long, hot array<long>, hot_n array<long>, blob binary"


def _answers(rows: list[tuple]) -> pa.Table:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
    return pa.table({x.split()[0]: pa.array([r[k] for r in rows], t) for k, (x, t) in enumerate(zip(_ANSWERS.split(", "), kinds, strict=True))})


def _asked_of(table: pa.Table) -> tuple[list[tuple[int, list[np.ndarray]]], bytes | None]:
    """Questions by batch, and the stored segment if there is one (a row without batch)."""
    batches, blobs = table.column("batch").to_pylist(), table.column("blob")
    stored = next((blobs[k].as_py() for k, b in enumerate(batches) if b is None), None)
    return [(b, decode(blobs[k].as_py())) for k, b in enumerate(batches) if b is not None], stored


def _word_segment(hot_from: int, keep: bool):
    def run(key, table):
        asked, stored = _asked_of(table)
        segment = key[0].as_py()
        values, at = np.unique(np.concatenate([x[0] for _, x in asked] or [np.zeros(0, np.int64)]).astype(np.uint64), return_inverse=True)
        rows = []
        if stored is None:
            counts = np.bincount(at, np.concatenate([x[1] for _, x in asked]), len(values)).astype(np.int64)
            trained = counts > 0
            counts = counts[trained]
            stored = pack([*EliasFano.of(values[trained]).arrays(), counts])
            hot = np.flatnonzero(counts > hot_from)
            rows = [("model", segment, None, len(counts), int(counts.sum()), hot, counts[hot], stored if keep else None)]
        *sequence, n = unpack(np.frombuffer(stored, np.uint8))
        place, same = EliasFano.from_arrays(*sequence).successor(values)
        count = np.where(same, np.append(n, 0)[place], 0)
        begin = 0
        for batch, (hashes, _) in asked:
            mine = at[begin : begin + len(hashes)]
            begin += len(hashes)
            c = count[mine]
            rows.append(("words", segment, batch, None, None, None, None, encode(c, place[mine][c > 0])))
        return _answers(rows)

    return run


def _segment_blob(contexts: np.ndarray, words: np.ndarray, counts: np.ndarray, totals: np.ndarray, weight: float) -> bytes:
    """A segment from n-grams sorted by context and word: contexts, pointers, successors, codes, counts."""
    held, first = np.unique(contexts, return_index=True)
    if not len(words):
        return pack([a for x in (held, [0], held) for a in EliasFano.of(np.array(x)).arrays()] + [np.zeros(0, np.uint8), counts])
    last = np.append(first[1:], len(words)) - 1
    base = np.concatenate(([0], np.cumsum(words[last] + 1)))[:-1]  # the value before a context's first
    values = words + 1 + np.repeat(base, last - first + 1)
    codes = np.clip(np.rint(-np.log10(counts / (totals + weight)) * (CODES / LOWEST)), 0, CODES).astype(np.uint8)
    sequences = (EliasFano.of(x) for x in (held, np.append(first, len(words)), values))
    return pack([a for e in sequences for a in e.arrays()] + [codes, counts.astype(np.uint32) if not len(counts) or counts.max() < 1 << 32 else counts])


def look_up(blob: bytes, contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, code (``ABSENT`` for none) and count of n-grams in a segment; contexts and words sorted."""
    parts = unpack(np.frombuffer(blob, np.uint8))
    held, pointers, values = (EliasFano.from_arrays(*parts[k : k + 4]) for k in (0, 4, 8))
    codes, counts = parts[12], parts[13]
    if not len(codes):
        return np.zeros(len(words), np.int64), np.full(len(words), ABSENT), np.zeros(len(words), np.int64)
    each, back = np.unique(contexts, return_inverse=True)
    k, there = held.successor(each.astype(np.uint64))
    k = np.where(there, k, 0)
    begin, end = (pointers.get(x).astype(np.int64) for x in (k, k + 1))
    base = np.where(begin > 0, values.get(np.maximum(begin - 1, 0)), np.uint64(0))
    place, same = values.successor(base[back] + words.astype(np.uint64) + np.uint64(1))
    good = same & there[back] & (place < end[back])
    place = np.where(good, place, 0)
    return place, np.where(good, codes[place], ABSENT), np.where(good, counts[place], 0).astype(np.int64)


def _level_segment(name: str, weight: float, hot_from: int, keep: bool):
    def run(key, table):
        asked, stored = _asked_of(table)
        segment, empty = key[0].as_py(), np.zeros(0, np.int64)
        join = lambda k: np.concatenate([x[k] for _, x in asked] or [empty])
        each, mine = np.unique(join(0), return_inverse=True)
        of = np.repeat(mine, join(2))
        words = join(3)
        span = int(words.max(initial=0)) + 1
        values, at = np.unique(of * span + words, return_inverse=True)
        c, w = values // span, values % span
        rows = []
        if stored is None:
            counts = np.bincount(at, join(4), len(values)).astype(np.int64)
            totals = np.bincount(c, counts, len(each)).astype(np.int64)  # every word of a context but the last has one after it
            if len(given := join(1)):
                totals[mine] = given
            kept = counts > 0
            ck, counts = c[kept], counts[kept]
            stored = _segment_blob(each[ck], w[kept], counts, totals[ck], weight)
            hot = np.flatnonzero(counts > hot_from)
            rows = [("model", segment, None, len(counts), None, hot, counts[hot], stored if keep else None)]
        place, code, count = look_up(stored, each[c], w)
        begin = 0
        for batch, x in asked:
            mine = at[begin : begin + len(x[3])]
            begin += len(x[3])
            answer = [code[mine]]
            if name == "bigrams":
                found = mine[code[mine] != ABSENT]
                answer += [place[found], count[found]]
            rows.append((name, segment, batch, None, None, None, None, encode(*answer)))
        return _answers(rows)

    return run


def _tiers(n_tokens: int, size: int) -> int:
    return max(1, round(n_tokens / size))


def _answered(questions: DataFrame, segment, model: Model, level: Level, scratch: Scratch, train: bool) -> DataFrame:
    """Questions put to their segments; the answers. Training sets the level's numbers and keeps its segments."""
    questions = questions.select("segment", "batch", "blob")
    if not train:  # with the stored segments that are asked
        questions = scratch.save(questions, f"{level.name}-asked")
        stored = scratch.spark.read.schema(_ANSWERS).parquet(level.path).where("kind = 'model'").select("segment", F.lit(None).cast("long").alias("batch"), "blob")
        questions = questions.unionByName(stored.join(questions.select("segment").distinct(), "segment", "left_semi"))
    out = scratch.save(questions.groupBy("segment").applyInArrow(segment, _ANSWERS), level.name, by="kind")
    if train:
        rows = out.where("kind = 'model'").drop("blob").collect()  # one of each segment
        level.path = scratch.path(level.name)
        level.counted(rows)
        if level.name == "words":
            model.total = sum(r.total for r in rows)
        following = {"words": model.bigrams, "bigrams": model.trigrams}.get(level.name)
        if following:
            following.n_contexts, following.n_words = level.size, model.words.size
            following.n_segments = _tiers(model.total, SEGMENT_TOKENS)
            following.stretch = min(following.stretch, max(0, (following.n_contexts // (8 * following.n_segments)).bit_length() - 1))
            following.heat({level.start(r.segment) + h: n for r in rows for h, n in zip(r.hot, r.hot_n, strict=True)})
    return out.where("kind <> 'model'").select("kind", "segment", "batch", "blob")


def _run(docs: DataFrame, scratch: Scratch, model: Model | None, dirichlet: tuple[float, float], keep: bool = True) -> tuple[DataFrame, Model]:
    """Scores of all documents (doc_id, train, text), and the model, which is trained if there is none."""
    train = model is None
    if model is None:
        n_tokens = (docs.where("train").agg(F.sum(F.length("text"))).first()[0] or 0) / 6
        model = Model(dirichlet, max(0, _tiers(n_tokens, WORD_SEGMENT_TOKENS) - 1).bit_length())
    tokens = scratch.save(docs.mapInArrow(_tokenised(model.bits, BATCH_TOKENS), _ROWS), "tokens", by="kind")
    streams = tokens.where("kind = 'stream'").select("batch", "doc_ids", "sizes", "trains", "blob")
    answers = _answered(tokens.where("kind = 'words'"), _word_segment(SEGMENT_TOKENS // 2, keep), model, model.words, scratch, train)
    scratch.drop("tokens/kind=words")
    for level, weight in ((model.bigrams, model.dirichlet[0]), (model.trigrams, model.dirichlet[1])):
        if not model.words.size or (level is model.trigrams and not model.bigrams.size):
            break
        ask = streams.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_question(model, level), _ROWS)
        answers = answers.unionByName(_answered(ask, _level_segment(level.name, weight, SEGMENT_TOKENS // 2, keep), model, level, scratch, train))
    out = streams.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_score(model), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(model.total).cast("long")), model


def _question(model: Model, level: Level):
    def run(stream: pa.Table, answers: pa.Table) -> pa.Table:
        return pa.Table.from_batches([Batch(stream, answers, model).questions(level)])

    return run


def _score(model: Model):
    def run(stream: pa.Table, answers: pa.Table) -> pa.Table:
        return Batch(stream, answers, model).scores()

    return run


def train_and_score(docs: DataFrame, scratch: Scratch, dirichlet: tuple[float, float] = DIRICHLET, keep: bool = True) -> tuple[DataFrame, Model]:
    """A model of the texts marked ``train``, and doc_id, n_tokens, n_known, base_score (by words
    alone), score (by the trie), train_tokens of all documents. ``docs``: doc_id, train, text. Without
    ``keep`` the segments are not written once they have answered; the model can't score other documents then."""
    return _run(docs.select("doc_id", "train", "text"), scratch, None, dirichlet, keep)


def score_documents(docs: DataFrame, model: Model, scratch: Scratch) -> DataFrame:
    """The same columns of other documents (doc_id, text), by a model trained and kept before."""
    return _run(docs.select("doc_id", F.lit(False).alias("train"), "text"), scratch, model, model.dirichlet)[0]


def op9_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and trie scores of every document, learned from nine in ten."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", (~is_held_out(F.col("doc_id"))).alias("train"), "text")
    out, _ = train_and_score(docs, Scratch(spark, "lm"), keep=False)  # nothing is scored later
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
