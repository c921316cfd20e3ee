"""Toxicity by compression distance.

Two dictionaries are trained by zstandard, one on toxic and one on ordinary text; every window of
``WINDOW`` words of a text is compressed with either, and the difference in length tells which kind
of text it is closer to. A logistic model on the differences of a document's windows, fitted on
labelled documents that its dictionaries have not seen, turns them into a score; 0.5 is its threshold.

The trainer's samples of a class are those words of its texts that are typical of it (``GRAM``-byte
sequences whose share of documents in one class exceeds that in the other by far), ``JOINED`` in a row;
from whole texts it would pick what is common to all text, which tells nothing. What it makes of them stands, without
its header, before a tail that both share, trained on ordinary text: at the same distance in both,
what is common costs the same in either, and only what is typical of one kind makes a difference.

Training reads at most ``TOXIC_DOCS`` toxic and ``ORDINARY_DOCS`` ordinary labelled documents, the first
by a hash of the id, with their whole texts, as scoring does. The sample is halved by a hash of the
text: dictionaries of either half give the windows' differences of the other, on which the logistic
model is fitted; the dictionaries that score are those of both halves. The three trainings are tasks;
the driver gets their dictionaries and differences only.

Defined cases: a null or empty text scores as a text of one empty window; without labels of both
kinds every score is the share of toxic labels; conflicting labels of a document both count; of
labelled rows that share an id the smallest text is learned; equal texts score equal; further columns
are ignored by ``score_documents`` and pass through ``keep_ordinary``; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import bound_batches

WINDOW = 32
LEVEL = 16
GRAM = 5
DICTIONARY_BYTES, COMMON_BYTES = 2048, 256
COVER = {"k": 16, "d": 8}  # the trainer's segments and what it counts in them, in bytes
JOINED = 4
TOXIC_DOCS, ORDINARY_DOCS = 2000, 4000
MIN_RATIO = 30.0
MIN_DOCS = 3
_BUCKETS = 1 << 20
FOLDS = 5


def is_held_out(doc_id):
    """crc32 of the id as text modulo 5 is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def normalised(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def windows(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """Consecutive windows of words, one at least; a space on either side marks word ends."""
    return [b" " + b" ".join(words[k : k + size]) + b" " for k in range(0, max(len(words), 1), size)]


def _grams(joined: bytes) -> np.ndarray:
    """Bucket of the byte sequence at each position."""
    a = np.frombuffer(joined, np.uint8).astype(np.uint64)
    if len(a) < GRAM:
        return np.zeros(0, np.int64)
    h = np.zeros(len(a) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        h = h * np.uint64(0x100000001B3) + a[k : len(a) - GRAM + 1 + k]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(44)).astype(np.int64)


def _document_counts(texts: list[bytes]) -> np.ndarray:
    n = np.zeros(_BUCKETS, np.int64)
    for t in texts:
        n[np.unique(_grams(t))] += 1
    return n


def _samples(texts: list[bytes], mark: np.ndarray) -> list[bytes]:
    """The marked parts of the texts cut to words, a few in each sample."""
    found: list[bytes] = []
    for t in texts:
        edge = np.flatnonzero(np.diff(np.concatenate(([0], mark[_grams(t)].astype(np.int8), [0]))))
        for a, b in zip(edge[::2], edge[1::2], strict=True):
            parts = t[a : b + GRAM - 1].split(b" ")
            found += [b" " * (k > 0) + p + b" " * (k < len(parts) - 1) for k, p in enumerate(parts) if len(p) >= GRAM - 1]
    return [b"".join(found[k : k + JOINED]) for k in range(0, len(found), JOINED)]


def _trained(samples: list[bytes]) -> bytes:
    """What zstandard's trainer picks from the samples, without the header of its dictionary."""
    try:
        made = zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3, **COVER).as_bytes()
    except zstandard.ZstdError:  # too little to train on: all of it
        return b"".join(dict.fromkeys(samples))[-DICTIONARY_BYTES:]
    whole = b"\0".join(samples)
    start = next((k for k in range(8, len(made)) if made[k : k + COVER["d"] + 2] in whole), 0)
    return made[start:]


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """Contents of the toxic and the ordinary dictionary."""
    n_toxic, n_ordinary = _document_counts(toxic), _document_counts(ordinary)
    ratio = np.log((n_toxic + 0.5) / (len(toxic) + 1)) - np.log((n_ordinary + 0.5) / (len(ordinary) + 1))
    samples = [w for t in ordinary for w in windows(t.split())]
    try:
        common = zstandard.train_dictionary(16384, samples, level=3).as_bytes()[-COMMON_BYTES:]
    except zstandard.ZstdError:  # too little text to train on
        common = b"".join(samples)[-COMMON_BYTES:]
    high = np.log(MIN_RATIO)
    parts = (_trained(_samples(toxic, (ratio > high) & (n_toxic >= MIN_DOCS))), _trained(_samples(ordinary, (ratio < -high) & (n_ordinary >= MIN_DOCS))))
    return tuple(p + common or b" " for p in parts)


class Model:
    """Dictionaries and the calibration of a score; small, sent to the executors as it is."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.contents = (toxic, ordinary)
        self.weights = self.mean = self.scale = None
        self.prior = 0.0

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for content in self.contents:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            p = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=256, dict_size=len(content), write_content_size=0, write_checksum=0, write_dict_id=0)
            d.precompute_compress(compression_params=p)
            out.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p))
        return out

    def features(self, text: str | None, compressors: list) -> list[float]:
        """Of the windows' bytes saved by the toxic dictionary: the largest, the sum of the three largest, the mean, the scaled sum of clear savings; and the logarithm of the number of windows."""
        toxic, ordinary = compressors
        w = windows(normalised(text))
        saved = np.sort([len(ordinary.compress(x)) - len(toxic.compress(x)) for x in w])[::-1]
        return [saved[0], saved[:3].sum(), saved.mean(), np.maximum(saved - 2, 0).sum() / len(w) ** 0.5, np.log(len(w))]

    def fit(self, features: np.ndarray, labels: np.ndarray, share: float, rounds: int = 100, ridge: float = 1.0) -> None:
        """Logistic regression by Newton's method with halved steps, its constant shifted from the sample's share of toxic texts to that of all labelled ones."""
        self.prior = share
        if len(set(labels.tolist())) < 2:
            return
        self.mean, self.scale = features.mean(0), features.std(0) + 1e-9
        x = np.c_[np.ones(len(features)), self._expand((features - self.mean) / self.scale)]
        w = np.zeros(x.shape[1])

        def loss(w: np.ndarray) -> float:
            z = x @ w
            return float((np.logaddexp(0, z) - labels * z).sum() + ridge / 2 * (w @ w))

        at = loss(w)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (labels - p) - ridge * w)
            while (new := loss(w + step)) > at and np.abs(step).max() > 1e-9:
                step /= 2
            if at - new < 1e-9 * abs(at):
                break
            w, at = w + step, new
        odds = lambda p: np.log(p / (1 - p))
        w[0] += odds(share) - odds(float(labels.mean()))
        self.weights = w

    @staticmethod
    def _expand(z: np.ndarray) -> np.ndarray:
        """With squares and products."""
        i, j = np.triu_indices(z.shape[1])
        return np.c_[z, z[:, i] * z[:, j]]

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.prior)
        x = np.c_[np.ones(len(features)), self._expand((features - self.mean) / self.scale)]
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS, ordinary_docs: int = ORDINARY_DOCS) -> Model:
    """A model from labelled documents outside the held-out fold. ``labels``: doc_id, toxic."""
    bound_batches(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))).select("doc_id", (F.col("toxic") > 0).alias("toxic"))
    n = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        model = Model(b" ", b" ")
        model.prior = float(True in n)
        return model
    share = n[True] / (n[True] + n[False])
    # by id hash, so that texts are read of a bounded sample only
    order = F.xxhash64("doc_id")
    sample = None
    for kind, most in ((True, toxic_docs), (False, ordinary_docs)):
        part = known.where(F.col("toxic") == kind).orderBy(order, "doc_id").limit(most) if n[kind] > most else known.where(F.col("toxic") == kind)
        sample = part if sample is None else sample.union(part)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    texts = texts.select("toxic", "text", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half"), F.explode(F.array(*map(F.lit, _TRAININGS))).alias("training"))
    made = {r.training: r for r in texts.groupBy("training").applyInArrow(_training, "training int, toxic binary, ordinary binary, differences array<array<double>>, labels array<double>").collect()}
    if _WHOLE not in made or not made[_WHOLE].toxic:
        model = Model(b" ", b" ")
        model.prior = share
        return model
    model = Model(made[_WHOLE].toxic, made[_WHOLE].ordinary)
    x, y = ([v for k in _TRAININGS if k in made for v in made[k][c]] for c in ("differences", "labels"))
    model.fit(np.array(x).reshape(-1, 5), np.array(y), share)
    return model


_WHOLE = 2
_TRAININGS = (0, 1, _WHOLE)  # the half that is learned, or both


def _training(table: pa.Table) -> pa.Table:
    """Dictionaries of one training, and the differences they give for the half they have not seen. Its texts are a bounded sample."""
    k = table.column("training")[0].as_py()
    # in the order of a hash: the trainer picks from each stretch of the samples, which should all be alike
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("text", "toxic", "half")), strict=True), key=lambda r: (xxhash.xxh3_64_intdigest(r[0].encode("utf-8", "surrogatepass")), r))
    learned = {t: [b" " + b" ".join(normalised(x)) + b" " for x, toxic, half in rows if toxic == t and k in (half, _WHOLE)] for t in (True, False)}
    contents, x, y = (b"", b""), [], []
    if learned[True] and learned[False]:
        contents = train_dictionaries(learned[True], learned[False])
        model = Model(*contents)
        c = model.compressors()
        for text, toxic, half in rows:
            if k not in (half, _WHOLE):
                x.append([float(v) for v in model.features(text, c)])
                y.append(float(toxic))
    kind = pa.list_(pa.list_(pa.float64()))
    return pa.table({"training": pa.array([k], pa.int32()), "toxic": pa.array([contents[0]], pa.binary()), "ordinary": pa.array([contents[1]], pa.binary()), "differences": pa.array([x], kind), "labels": pa.array([y], pa.list_(pa.float64()))})


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every document."""

    def run(batches):
        compressors = model.compressors()
        for batch in batches:
            x = np.array([model.features(t.as_py(), compressors) for t in batch.column("text")]).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(model.scores(x), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_ordinary(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, with their columns."""

    def run(batches):
        compressors = model.compressors()
        for batch in batches:
            x = np.array([model.features(t.as_py(), compressors) for t in batch.column("text")]).reshape(-1, 5)
            yield batch.filter(pa.array(model.scores(x) < 0.5, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3_compression_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
