"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records hash into thousands of slots that never change. Bytes are summed per slot, and a map from
slots to shards, kept as a versioned table, decides where a slot lives. Rebalancing and growing edit
the map: slots move whole, and every version stays readable. A corpus is sharded by the latest
version in the stored map: the first run places the slots, later ones edit what they find only if its
shards have grown uneven, so that most records stay where they are. Only the slot table (``n_slots`` rows,
a parameter) comes to the driver, whatever the number of records.

The slot of a record comes from its id and text together, so that repeated or missing ids spread.

Defined cases: a null text counts no bytes and has checksum 0; a null id is hashed like any other
value; equal rows fall into one slot and get places of their own; an empty table gives an empty
result; further columns are ignored by ``shard_records`` and kept by ``shard_documents``, which puts
an underscore after its own where a column has that name already.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlake.llm.common import Scratch

N_SLOTS = 4096
RECORD_OVERHEAD = 8


@dataclass
class SlotMap:
    """Which shard holds each slot, as of a version."""

    shards: list[int]
    n_shards: int
    version: int = 1
    moved: list[tuple[int, int, int]] = field(default_factory=list)  # slot, from, to: the edit that made this version

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, self.n_shards, s, d) for s, d in enumerate(self.shards)]
        return spark.createDataFrame(rows, "version int, n_shards int, virtual_slot int, shard int")

    def save(self, spark: SparkSession, path: str) -> None:
        """Append this version to the stored map."""
        self.frame(spark).coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A stored version, by default the latest."""
    stored = spark.read.schema("n_shards int, virtual_slot int, shard int, version int").parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.where(F.col("version") == version).orderBy("virtual_slot").collect()
    return SlotMap([r.shard for r in rows], rows[0].n_shards, version)


def current_map(spark: SparkSession, path: str, slot_bytes: list[int], n_shards: int, tolerance: float = 0.01) -> SlotMap:
    """The latest stored version, edited and stored as the next one if its shards differ by more than
    ``tolerance`` of the mean or in number; where none is stored, a first one is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        old = load_map(spark, path)
        if len(old.shards) != len(slot_bytes):
            raise ValueError(f"the map at {path} has {len(old.shards)} slots; the number of slots is fixed")
        new = rebalance(old, slot_bytes, n_shards, tolerance)
        if not new.moved and new.n_shards == old.n_shards:
            return old
    else:
        new = place_slots(slot_bytes, n_shards)
    new.save(spark, path)
    return load_map(spark, path)


def place_slots(slot_bytes: list[int], n_shards: int) -> SlotMap:
    """A first map: the largest slots first, each into the lightest shard; empty slots in turn."""
    load = [(0, 0, d) for d in range(n_shards)]
    heapq.heapify(load)
    shards = [0] * len(slot_bytes)
    for s in sorted(range(len(slot_bytes)), key=lambda s: (-slot_bytes[s], s)):
        size, n, d = heapq.heappop(load)
        shards[s] = d
        heapq.heappush(load, (size + slot_bytes[s], n + 1, d))
    return SlotMap(shards, n_shards)


def rebalance(current: SlotMap, slot_bytes: list[int], n_shards: int | None = None, tolerance: float = 0.01) -> SlotMap:
    """The next version: moves slots from the heaviest to the lightest shard until they differ by
    less than ``tolerance`` of the mean or no move helps. More shards start empty; of fewer shards
    the last ones are emptied."""
    n = n_shards or current.n_shards
    shards, moved = list(current.shards), []
    held: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    load = [0] * n
    homeless = []
    for s, d in enumerate(shards):
        if d < n:
            insort(held[d], (slot_bytes[s], s))
            load[d] += slot_bytes[s]
        else:
            homeless.append(s)

    def move(s: int, to: int) -> None:
        moved.append((s, shards[s], to))
        shards[s] = to
        insort(held[to], (slot_bytes[s], s))
        load[to] += slot_bytes[s]

    for s in sorted(homeless, key=lambda s: -slot_bytes[s]):
        move(s, min(range(n), key=lambda d: (load[d], d)))
    mean = sum(load) / n
    for _ in range(4 * len(shards)):
        hi, lo = max(range(n), key=lambda d: (load[d], -d)), min(range(n), key=lambda d: (load[d], d))
        gap = load[hi] - load[lo]
        if gap <= tolerance * mean:
            break
        k = bisect_left(held[hi], (gap / 2 + 0.5, -1))
        near = [x for x in held[hi][max(0, k - 1) : k + 1] if 0 < x[0] < gap]
        if not near:
            break
        best = min(near, key=lambda x: (abs(x[0] - gap / 2), x))
        held[hi].remove(best)
        load[hi] -= best[0]
        move(best[1], lo)
    return SlotMap(shards, n, current.version + 1, moved)


def grow(current: SlotMap, slot_bytes: list[int]) -> SlotMap:
    """The next version with one more shard, which takes slots from the others; none else move."""
    n = current.n_shards
    shards, moved, load = list(current.shards), [], [0] * n
    for s, d in enumerate(shards):
        load[d] += slot_bytes[s]
    want, taken = sum(load) / (n + 1), 0
    for s in sorted(range(len(shards)), key=lambda s: (-slot_bytes[s], s)):
        d = shards[s]
        if taken + slot_bytes[s] <= want and load[d] - slot_bytes[s] >= want * 0.98:
            moved.append((s, d, n))
            shards[s] = n
            load[d] -= slot_bytes[s]
            taken += slot_bytes[s]
    return SlotMap(shards, n + 1, current.version + 1, moved)


def record_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_OVERHEAD).cast("long")


def virtual_slot(keys: list[Column], n_slots: int = N_SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n_slots)).cast("int")


def slot_totals(records: DataFrame, n_slots: int = N_SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of each slot; ``records`` has virtual_slot and size."""
    size, rows = [0] * n_slots, [0] * n_slots
    for r in records.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        size[r.virtual_slot], rows[r.virtual_slot] = r.b, r.n
    return size, rows


def shard_records(
    docs: DataFrame, n_shards: int = 24, n_slots: int = N_SLOTS, slot_map: SlotMap | None = None, map_path: str | None = None
) -> tuple[DataFrame, SlotMap]:
    """Every record with size, text_crc32, virtual_slot, shard and its place in the shard.

    The map is ``slot_map``, else the latest version at ``map_path`` (by default a new folder), made or
    edited there as ``current_map`` says. A place is the number of rows in earlier slots of the shard
    plus the rank in the slot, so that no task sorts a whole shard.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    records = docs.select(
        "doc_id", record_bytes(F.col("text")).alias("size"), F.crc32(text).alias("text_crc32"), virtual_slot([F.col("doc_id"), text], n_slots).alias("virtual_slot")
    )
    size, rows = slot_totals(records.select("virtual_slot", "size"), n_slots)
    slot_map = slot_map or current_map(spark, map_path or Scratch(spark, "slots").path("map"), size, n_shards)
    start, first = [0] * slot_map.n_shards, []
    for s, d in enumerate(slot_map.shards):
        first.append((s, d, start[d]))
        start[d] += rows[s]
    places = spark.createDataFrame(first, "virtual_slot int, shard int, first long")
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    out = records.withColumn("rank", rank).join(F.broadcast(places), "virtual_slot")  # n_slots rows, a parameter
    return out.select("doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("first") + F.col("rank") - 1).alias("slot")), slot_map


def shard_documents(docs: DataFrame, n_shards: int = 24, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """Documents with their virtual_slot and shard, for writing by shard, by the map at ``map_path`` as in ``shard_records``."""
    spark = docs.sparkSession
    names = {}
    for own in ("virtual_slot", "shard"):
        while own.lower() in {c.lower() for c in docs.columns}:
            own += "_"
        names[own.rstrip("_")] = own
    keyed = docs.select(F.struct(*docs.columns).alias("row"), virtual_slot([F.col("doc_id"), F.coalesce("text", F.lit(""))], n_slots).alias("virtual_slot"), record_bytes(F.col("text")).alias("size"))
    size, _ = slot_totals(keyed.select("virtual_slot", "size"), n_slots)
    places = current_map(spark, map_path or Scratch(spark, "slots").path("map"), size, n_shards).frame(spark).select("virtual_slot", "shard")
    out = keyed.join(F.broadcast(places), "virtual_slot")  # n_slots rows, a parameter
    return out.select("row.*", *(F.col(a).alias(b) for a, b in names.items()))


def op5_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 of nearly equal bytes, by a stored map."""
    out, _ = shard_records(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot"
    )
