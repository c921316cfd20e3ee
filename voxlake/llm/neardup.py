"""Near-duplicate detection: MinHash bands, Odd sketches, exact confirmation, components.

Each text's distinct word shingles give ``BANDS`` x ``ROWS`` MinHash samples. The samples are banded
to find candidates, and folded into a parity bitmap (an Odd sketch): the population count of the XOR
of two sketches estimates a high similarity closely, and candidates whose estimate lies more than
``SIGMAS`` standard errors under the threshold are dropped. The others are confirmed on full sets.

Texts with equal sets are one class, named after its smallest id; only classes are compared. Where rows
share an id, several classes may have one name: each keeps its own set and sketch, and a link to any
of them is a link to the name. No bucket is expanded into all its pairs: its members are first compared with the bucket's
smallest member, and confirmed links make components. In buckets whose members then belong to
several components, the members outside the largest are compared with the others: as candidate pairs
where the bucket is small, and in blocks of at most ``BLOCK`` x ``BLOCK`` exact set intersections
where it is large (of about ``BLOCK_SHINGLES`` shingles, if texts are long), each block a task's work of its own, so that no
link between different texts that share a band is lost and no task holds a whole bucket.

A pair at the threshold t shares a band with probability 1 - (1 - t**ROWS)**BANDS: a miss has
probability 1e-9 at 0.85 and 4e-7 at 0.8.

Defined cases: texts without words link with nothing; texts of fewer words than a shingle are one
shingle; rows that share an id are one document for linking, whatever their texts, and so in one
component in any order of rows; rows without id take the component of an
equal or linked text, else none, and are then kept; further columns are ignored by ``near_duplicates``
and pass through ``keep_one``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import WORD, Scratch, WordHashes, shingles, spread, words_of
from voxlake.llm.components import connected_components

BANDS, ROWS = 28, 4
SKETCH_WORDS = 8  # of 64 bits
SIGMAS = 5.5
SMALL, BLOCK, BLOCK_SHINGLES = 16, 1024, 2_000_000
BROADCAST_IDS = 2_000_000  # 8 bytes each
_CHUNK = 2048  # shingles hashed at a time
_COLUMNS = 2048  # shingles of a matrix product

_rng = np.random.default_rng(7)
_MUL = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def shingle_set(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of a text's distinct n-word shingles."""
    return np.unique(shingles(hashes.of(words_of(text)), n))


def min_hashes(items: np.ndarray) -> np.ndarray:
    """The MinHash samples of a non-empty set of hashes."""
    out = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(items), _CHUNK):
        np.minimum(out, (items[k : k + _CHUNK, None] * _MUL + _ADD).min(axis=0), out=out)
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples, as 64-bit words: each sample flips the bit it hashes to."""
    bits = SKETCH_WORDS * 64
    at = (spread(samples + np.arange(len(samples), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(bits)).astype(np.int64)
    parity = (np.bincount(at, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.uint64)


def most_differing_bits(threshold: float, sigmas: float = SIGMAS) -> int:
    """XOR population count beyond which a pair is dropped: that of ``sigmas`` standard errors under the threshold."""
    k, bits = BANDS * ROWS, SKETCH_WORDS * 64
    differ = min(k, k * (1 - threshold) + sigmas * math.sqrt(k * threshold * (1 - threshold)))
    expected = bits / 2 * (1 - (1 - 2 / bits) ** (2 * differ))
    return math.ceil(expected + 2 * math.sqrt(differ))  # and bits that happen to meet, or not to


_FEATURES = "doc_id long, n_shingles long, set_key binary, bands array<long>, sketch array<long>"


def _features(n: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sizes, keys, bands, sketches = [], [], [], []
            for x in batch.column("text"):
                s = shingle_set(x.as_py(), n, hashes)
                sizes.append(len(s))
                if not len(s):
                    keys.append(None), bands.append(None), sketches.append(None)
                    continue
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                m = min_hashes(s)
                h = np.arange(BANDS, dtype=np.uint64)
                for r in range(ROWS):
                    h = spread(h + m[r::ROWS])
                bands.append(h.view(np.int64))
                sketches.append(odd_sketch(m).view(np.int64))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, longs), pa.array(sketches, longs)],
                ["doc_id", "n_shingles", "set_key", "bands", "sketch"],
            )

    return run


def _sets(n: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(x.as_py(), n, hashes).view(np.int64) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["node", "items"])

    return run


def differing_bits(a: Column, b: Column) -> Column:
    """XOR population count of two sketches."""
    return reduce(lambda x, y: x + y, (F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(SKETCH_WORDS)))


def _confirmed(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the sketches let pass and whose sets are similar enough."""
    left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    near = pairs.join(left, "a").join(right, "b").where(differing_bits(F.col("sketch_a"), F.col("sketch_b")) <= most_differing_bits(percent / 100)).select("a", "b").distinct()
    both = near.join(sets.select(F.col("node").alias("b"), F.col("items").alias("items_b")), "b").join(sets.select(F.col("node").alias("a"), F.col("items").alias("items_a")), "a")
    common = F.size(F.array_intersect("items_a", "items_b"))
    return both.where(100 * common >= percent * (F.size("items_a") + F.size("items_b") - common)).select("a", "b").distinct()


def block_links(loose: list[tuple[int, int, np.ndarray]], others: list[tuple[int, int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links between nodes of different labels, one for each loose node and label. Each node: id, label, its set."""
    if not loose or not others:
        return []
    columns = np.unique(np.concatenate([s for _, _, s in loose]))
    common = np.zeros((len(loose), len(others)), np.float32)

    def places(rows):
        at = [np.minimum(np.searchsorted(columns, s), len(columns) - 1) for _, _, s in rows]
        at = [c[columns[c] == s] for c, (_, _, s) in zip(at, rows, strict=True)]
        return np.repeat(np.arange(len(rows)), [len(c) for c in at]), np.concatenate(at)

    (ra, ca), (rb, cb) = places(loose), places(others)
    for k in range(0, len(columns), _COLUMNS):
        x, y = np.zeros((len(loose), _COLUMNS), np.float32), np.zeros((len(others), _COLUMNS), np.float32)
        ma, mb = (ca >= k) & (ca < k + _COLUMNS), (cb >= k) & (cb < k + _COLUMNS)
        x[ra[ma], ca[ma] - k] = 1
        y[rb[mb], cb[mb] - k] = 1
        common += x @ y.T  # counts below 2**24 are exact
    n_a, n_b = (np.array([len(s) for _, _, s in rows]) for rows in (loose, others))
    union = n_a[:, None] + n_b[None, :] - common
    differ = np.array([x[1] for x in loose])[:, None] != np.array([x[1] for x in others])[None, :]
    first: dict[tuple[int, int], tuple[int, int]] = {}
    for i, j in zip(*np.nonzero((100 * common >= percent * union) & differ), strict=True):
        first.setdefault((loose[i][0], others[j][1]), (loose[i][0], others[j][0]))
    return list(first.values())


def _block(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rows = list(
            zip(
                table.column("node").to_pylist(), table.column("label").to_pylist(), table.column("role").to_pylist(),
                [np.asarray(x.values) for x in table.column("items")], strict=True,
            )
        )
        links = block_links([(n, c, s) for n, c, r, s in rows if r == 0], [(n, c, s) for n, c, r, s in rows if r == 1], percent)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def _rest(members: DataFrame, labels: DataFrame, sketches: DataFrame, sets: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Links between components that share a bucket. members: bucket, node, n_shingles."""
    named = members.join(labels, "node", "left").select("bucket", "node", "n_shingles", F.coalesce("label", "node").alias("label"))
    counts = named.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    largest = F.struct("n", "label")
    mixed = counts.groupBy("bucket").agg(
        F.sum("n").alias("n_members"), F.sum("s").alias("s_members"), F.count("*").alias("n_labels"), F.max_by("label", largest).alias("main"), F.max("n").alias("n_main"), F.max_by("s", largest).alias("s_main")
    )
    mixed = mixed.where("n_labels > 1").drop("n_labels")
    rows = scratch.save(named.join(mixed, "bucket"), "mixed")
    few = rows.where(F.col("n_members") <= SMALL).select("bucket", "node", "label", "main")
    x, y = few.where("label <> main").alias("x"), few.alias("y")
    unlike = (F.col("x.label") != F.col("y.label")) & ((F.col("y.label") == F.col("y.main")) | (F.col("x.node") < F.col("y.node")))
    pairs = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & unlike).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    found = _confirmed(pairs, sketches, sets, percent)
    many = rows.where(F.col("n_members") > SMALL)
    blocks_of = lambda n, s: F.greatest(F.ceil(n / BLOCK), F.ceil(s / BLOCK_SHINGLES)).cast("int")
    many = many.withColumn("n_i", blocks_of(F.col("n_members") - F.col("n_main"), F.col("s_members") - F.col("s_main")))
    many = many.withColumn("n_j", blocks_of(F.col("n_members"), F.col("s_members")))
    deal = F.xxhash64("node")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    loose = many.where("label <> main").select("bucket", "node", "label", F.lit(0).alias("role"), F.pmod(deal, "n_i").cast("int").alias("i"), upto("n_j").alias("j"))
    others = many.select("bucket", "node", "label", F.lit(1).alias("role"), upto("n_i").alias("i"), F.pmod(deal, "n_j").cast("int").alias("j"))
    grid = loose.unionByName(others).join(sets, "node")
    return found.unionByName(grid.groupBy("bucket", "i", "j").applyInArrow(_block(percent), "a long, b long")).distinct()


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, set_key, component_id of every row: texts whose sets of n-word shingles have
    a Jaccard similarity of at least ``percent`` / 100 are linked."""
    scratch = Scratch(docs.sparkSession, "near")
    docs = docs.select("doc_id", "text")
    features = scratch.save(docs.mapInArrow(_features(n), _FEATURES), "features")
    # a table of its own, so that adaptive execution can split the joins on the key of a text with many copies
    classes = scratch.save(features.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("node")), "classes")
    nodes = scratch.save(
        features.join(classes.where("node IS NOT NULL"), "set_key").where("doc_id = node").select("node", "set_key", "n_shingles", "bands", "sketch").dropDuplicates(["node", "set_key"]), "nodes"
    )
    bands = nodes.select("node", "n_shingles", F.posexplode("bands").alias("band", "h")).select("node", "n_shingles", F.xxhash64("band", "h").alias("bucket"))
    buckets = bands.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    members = scratch.save(bands.join(buckets, "bucket").select("bucket", "first", "node", "n_shingles"), "members")
    wanted = members.select("node").distinct()
    sets = scratch.save(_by_id(docs, wanted.withColumnRenamed("node", "doc_id"), "left_semi").mapInArrow(_sets(n), "node long, items array<long>").dropDuplicates(), "sets")
    sketches = nodes.select("node", "sketch")
    stars = members.where("first <> node").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = scratch.save(_confirmed(stars, sketches, sets, percent).unionByName(_same_id(features, classes, scratch)), "star-links")
    labels = connected_components(links, scratch, "stars")
    more = scratch.save(_rest(members.groupBy("bucket", "node").agg(F.sum("n_shingles").alias("n_shingles")), labels, sketches, sets, scratch, percent), "more-links")
    labels = connected_components(links.unionByName(more), scratch, "all")
    for name in ("sets", "mixed", "members", "nodes"):
        scratch.drop(name)
    named = classes.join(labels, "node", "left").select("set_key", F.coalesce("label", "node").alias("component_id"))
    named = scratch.save(named.withColumnRenamed("set_key", "class_key"), "named")
    out = features.select("doc_id", "n_shingles", "set_key").join(named, F.col("set_key") == F.col("class_key"), "left")
    return out.select("doc_id", "n_shingles", "set_key", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _same_id(features: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) between the classes of rows that share an id."""
    twice = features.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y")).where("x <> y").select("doc_id")
    twice = scratch.save(twice, "twice")
    rows = features.join(twice, "doc_id").select("doc_id", "set_key").distinct().join(classes, "set_key").select("doc_id", "node")
    first = rows.groupBy("doc_id").agg(F.min("node").alias("a"))
    return rows.join(first, "doc_id").where("a <> node").select("a", F.col("node").alias("b")).distinct()


def kept(doc_id: Column, component_id: Column) -> Column:
    return F.coalesce(doc_id == component_id, component_id.isNull())


def _by_id(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of documents with distinct ids (doc_id): texts aren't shuffled while the ids are few enough to broadcast."""
    ids = ids.select(F.col("doc_id").alias("_id"))
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.join(ids, docs["doc_id"] == ids["_id"], how)


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Documents with one of each component, all columns. Of rows that share an id the one with the
    smallest text stays; rows without id can't be told apart, and stay."""
    scratch = Scratch(docs.sparkSession, "keep")
    found = scratch.save(near_duplicates(docs, n, percent).where("doc_id IS NOT NULL").select("doc_id", "component_id"), "found")
    copies = found.where(~kept(F.col("doc_id"), F.col("component_id"))).select("doc_id").distinct()
    twice = found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    chosen = _by_id(docs, copies, "left_anti")
    if twice.isEmpty():
        return chosen
    names = F.struct(*docs.columns)
    double = _by_id(chosen, twice, "left_semi").groupBy("doc_id").agg(F.min_by(names, F.struct("text")).alias("row")).select("row.*")
    return _by_id(chosen, twice, "left_anti").unionByName(double)


def op7_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by 3-word shingles at a similarity of 0.85."""
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 3, 85)
    return out.select("doc_id", "n_shingles", "component_id", kept(F.col("doc_id"), F.col("component_id")).alias("kept"))


OP7_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS g FROM w),
n AS (SELECT doc_id, len(g)::BIGINT AS n_shingles FROM s),
x AS (SELECT doc_id, unnest(g) AS h FROM s), common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n_shingles + q.n_shingles - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT n.doc_id, n_shingles, least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS component_id, n.doc_id = least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS kept
FROM n LEFT JOIN reach r ON r.a = n.doc_id GROUP BY n.doc_id, n_shingles
"""
