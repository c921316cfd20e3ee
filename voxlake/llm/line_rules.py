"""Quality rules with cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space folded) and hashed; the distinct documents that
hold a line are counted per host; lines of more than ``max_docs`` documents of their host, and of
more than ``max_share`` of them, are boilerplate. A document is depleted, and rejected, if its other lines leave fewer than ``min_words``
words or less than ``min_share`` of its words. Equal texts of a host count as one document (exact
copies are a matter for deduplication), so a frequent line is one that different texts share.

One Arrow pass computes the counts of each text and its line hashes; the rest are aggregates and
joins of hashes. Counts are combined before the shuffle, and the join with frequent lines is left to
adaptive execution, which broadcasts them only if they are measured small and splits hot lines
otherwise.

Defined cases: a null or empty text has no words and fails; a null host is a host of its own; equal
rows get equal verdicts; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import WORD, Scratch

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_DOCS, MAX_SHARE = 10, 0.001
MIN_SHARE = 0.5


def repeated_words(words: list, n: int = WINDOW) -> int:
    """Words in windows of n words that occur twice or more."""
    size = len(words) - n + 1
    if size < 2:
        return 0
    codes = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    ids, base = codes[:size], int(codes.max()) + 1
    for k in range(1, n):  # below len(words) ** 2
        ids = pd.factorize(ids * base + codes[k : size + k])[0].astype(np.int64)
    again = np.bincount(ids)[ids] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:size] += again
    edge[n : n + size] -= again
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = len(text) - sum(map(text.count, "\x20\t\n\v\f\r"))
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def line_hashes(text: str | None) -> tuple[list[int], list[int]]:
    """Hashes of a text's distinct normalised lines, and the words of each, repeats counted."""
    counts: Counter[bytes] = Counter()
    size = {}
    for line in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n"):
        if words := line.split():
            key = b" ".join(words)
            counts[key] += len(words)
            size[key] = 1
    return [xxhash.xxh3_64_intdigest(k) - (1 << 63) for k in counts], list(counts.values())


_FEATURES = (
    "doc_id long, host string, text_key binary, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lines array<long>, line_words array<int>"
)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, counts, lines, sizes = [], [], [], []
        for x in batch.column("text"):
            text = x.as_py()
            keys.append(xxhash.xxh3_128_digest((text or "").encode("utf-8", "surrogatepass")))
            counts.append(text_counts(text))
            hashes, words = line_hashes(text)
            lines.append(hashes)
            sizes.append(words)
        columns = [batch.column("doc_id").cast(pa.int64()), batch.column("host").cast(pa.string()), pa.array(keys, pa.binary())]
        columns += [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)] if counts else [pa.array([], pa.int64())] * 5
        columns += [pa.array(lines, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _FEATURES.split(", ")])


def frequent_lines(texts: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """Lines (key of host and line) of more than max_docs, and more than a share, of the distinct texts of a host."""
    hosts = texts.groupBy("host").agg(F.count("*").alias("n_texts")).withColumnRenamed("host", "n_host")
    lines = texts.select("host", F.explode(F.transform("lines", lambda x: F.xxhash64("host", x))).alias("line"))
    counts = lines.groupBy("line").agg(F.first("host").alias("host"), F.count("*").alias("n_docs")).where(F.col("n_docs") > max_docs)
    return counts.join(hosts, F.col("host").eqNullSafe(F.col("n_host"))).where(F.col("n_docs") > max_share * F.col("n_texts")).select("line", "n_docs")


def score_documents(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """Counts, removed words and verdict of every document."""
    scratch = Scratch(docs.sparkSession, "lines")
    features = scratch.save(docs.select("doc_id", F.col(host).alias("host"), "text").mapInArrow(_features, _FEATURES), "features")
    texts = features.where(F.size("lines") > 0).groupBy("host", "text_key").agg(F.first("lines").alias("lines"), F.first("line_words").alias("line_words"))
    pairs = texts.select("host", "text_key", F.explode(F.arrays_zip(F.transform("lines", lambda x: F.xxhash64("host", x)).alias("line"), F.col("line_words").alias("words"))).alias("x"))
    pairs = pairs.select("host", "text_key", F.col("x.line").alias("line"), F.col("x.words").alias("words"))
    removed = pairs.join(frequent_lines(texts, max_docs, max_share), "line").groupBy("host", "text_key").agg(F.sum("words").alias("removed"))
    left = features.drop("lines", "line_words").alias("f")
    right = removed.withColumnsRenamed({"host": "r_host", "text_key": "r_key"})
    out = left.join(right, (F.col("text_key") == F.col("r_key")) & F.col("host").eqNullSafe(F.col("r_host")), "left")
    n, gone = F.col("n_words"), F.coalesce("removed", F.lit(0))
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    depleted = (n - gone < min_words) | (n - gone < min_share * n)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", gone.alias("n_removed_words"), failed.alias("base_failed"), (~failed & ~depleted).alias("kept")
    )


def op8_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the line-frequency verdict of every document, by source as host."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text"))


OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), base AS (
  SELECT doc_id, source, text, w, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls
  FROM d
), texts AS (SELECT DISTINCT source, text, w, ls FROM base),
grams AS (
  SELECT source, text, i, w[i:i+{WINDOW - 1}] AS g
  FROM (SELECT source, text, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM texts WHERE len(w) >= {WINDOW})
), again AS (
  SELECT source, text, i FROM (SELECT *, count(*) OVER (PARTITION BY source, text, g) AS c FROM grams) WHERE c > 1
), repeats AS (
  SELECT source, text, count(DISTINCT p)::BIGINT AS n FROM (SELECT source, text, unnest(range(i, i + {WINDOW})) AS p FROM again) GROUP BY ALL
), lines AS (
  SELECT source, text, array_to_string(regexp_extract_all(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), ' ') AS line,
    len(regexp_extract_all(l, '{WORD}')) AS words
  FROM (SELECT source, text, unnest(ls) AS l FROM texts)
), frequent AS (
  SELECT l.source, line FROM lines l JOIN (SELECT source, count(*) AS n FROM texts WHERE len(ls) > 0 GROUP BY source) h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, line, h.n HAVING count(DISTINCT text) > {MAX_DOCS} AND count(DISTINCT text) > {MAX_SHARE} * h.n
), removed AS (
  SELECT l.source, l.text, sum(l.words)::BIGINT AS n FROM lines l JOIN frequent f ON l.source IS NOT DISTINCT FROM f.source AND l.line = f.line GROUP BY ALL
), s AS (
  SELECT b.*, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(x.n, 0) AS gone,
    b.n_words < {MIN_WORDS} OR 100 * coalesce(r.n, 0) > {MAX_REPEAT_PERCENT} * b.n_words AS base_failed
  FROM base b
  LEFT JOIN repeats r ON b.text = r.text AND b.source IS NOT DISTINCT FROM r.source
  LEFT JOIN removed x ON b.text = x.text AND b.source IS NOT DISTINCT FROM x.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, gone AS n_removed_words, base_failed,
  NOT base_failed AND n_words - gone >= {MIN_WORDS} AND n_words - gone >= {MIN_SHARE} * n_words AS kept
FROM s
"""
