"""Shared pieces of the training-data operators: text units and shared scratch tables."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()`` and ``bytes.lower()`` agree with it and with A-Z lower-casing.
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8, with A-Z lower-cased; none for null."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Only a local master may go without that setting (tests); it then gets a folder of its own.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="voxlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def bound_batches(spark: SparkSession) -> None:
    """Texts reach Python in batches of few MB, however long they are; one text is the least a batch holds."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for as long as the block runs."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive lost executors.

    The folder goes when the driver's Python ends; ``drop`` frees a table earlier.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        bound_batches(spark)
        self.root = f"{shared_folder(spark)}/voxlake-{label}-{uuid.uuid4().hex[:12]}"
        atexit.register(self._remove_all)

    def _remove_all(self) -> None:
        with contextlib.suppress(Exception):
            remove(self.spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write and reread; ``by`` makes a folder of each value. The shuffle files of the job go when it has ended."""
        with setting(self.spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            writer = df.write.mode("overwrite")
            (writer.partitionBy(by) if by else writer).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        remove(self.spark, self.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class WordHashes(dict):
    """64-bit hashes of words, kept while they are few enough."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def spread(h: np.ndarray) -> np.ndarray:
    """Hashes whose every bit depends on all bits of the input."""
    h = (h ^ (h >> np.uint64(32))) * _SPREAD
    h = (h ^ (h >> np.uint64(29))) * _SPREAD
    return h ^ (h >> np.uint64(32))


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n words; one of all words if there are fewer; none without words."""
    size = len(hashes)
    if not size:
        return hashes
    n = min(n, size)
    out = hashes[: size - n + 1].copy()
    for k in range(1, n):
        out = out * _MIX + hashes[k : size - n + 1 + k]
    return spread(out + np.uint64(n))
