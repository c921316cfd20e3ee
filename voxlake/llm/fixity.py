"""Merkle fixity audit of WARC replicas.

A replica is laid out by itself: its records go to files and to places in them by the digest of their
WARC-Record-ID, and its offsets follow from its own lengths. The digests of records make those of
nodes, 16 ways by the next digit of that key, up to one root per file and, over the files, one root
per archive. A node's digest binds the byte range, counted from its own start, of everything
below it. So a record that is lost, longer or foreign changes the digests on its own path to the root
and no others, although all later offsets move.

To compare replicas their roots are joined, then only the children of nodes that differ, level by
level, down to the records. Trees and mismatches are tables in the shared folder: a descent reads
a few rows of each level, each level is joined once, and a lost executor costs one level at most.

Files hold about ``FILE_BYTES``, so that no task orders more than a file. Equal records (id and
content) are counted before they are shuffled and are one leaf. A WARC-Record-ID is unique by the
standard: the records that share one lie in one node.

Defined cases: null url or html count as empty; equal rows are copies of one record, and a missing
copy is a lost record; a record or a node that only one replica has counts as a mismatch; empty
archives give an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlake.llm.common import Scratch

FANOUT = 16  # a hexadecimal digit of the key
FILE_BYTES = 32 << 20
WARC_DATE = "2026-01-01T00:00:00Z"
DAMAGE_ONE_IN = 19


def record_urn(*parts: Column) -> Column:
    """A WARC-Record-ID from the digest of what identifies a capture."""
    m = F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *(F.substring(m, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))))


def warc_record(record_id: Column, url: Column, html: Column, date: str = WARC_DATE) -> Column:
    """A WARC resource record as text: header block, payload, two line ends."""
    body = F.coalesce(html, F.lit(""))
    uri = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <"), record_id, F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def _digest_number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def file_count(records: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    return max(1, math.ceil((records.agg(F.sum("length")).first()[0] or 0) / file_bytes))


def lay_out(records: DataFrame, n_files: int) -> DataFrame:
    """Leaves of ``records`` (replica, record_id, page_id, length, digest): equal records counted, with file and byte range (lo, hi)."""
    leaves = records.groupBy("replica", "record_id", "digest").agg(F.min("page_id").alias("page_id"), F.max("length").alias("length"), F.count("*").alias("copies"))
    key = F.md5("record_id")
    leaves = leaves.withColumn("key", key).withColumn("file", _digest_number(key) % n_files)
    size = F.col("length") * F.col("copies")
    upto = F.sum(size).over(Window.partitionBy("replica", "file").orderBy("key", "digest").rowsBetween(Window.unboundedPreceding, 0))
    return leaves.withColumn("hi", upto).withColumn("lo", F.col("hi") - size)


class Archive:
    """The trees of replicas over the same files: one table a level with replica, scope (file, -1 above files), node, digest, lo, hi."""

    def __init__(self, leaves: DataFrame, scratch: Scratch):
        self.leaves, self.scratch = leaves, scratch
        ends = leaves.groupBy("replica", "file").agg(F.count("*").alias("n")).agg(F.max("n"), F.max("file")).first()
        depth = lambda n: max(1, math.ceil(math.log(max(n, 1), FANOUT) - 1e-9))
        self.digits, self.archive_levels = depth((ends[0] or 0) / FANOUT), depth((ends[1] or 0) + 1)
        below = leaves.select("replica", F.col("file").alias("scope"), F.col("key").alias("node"), F.concat_ws(":", "record_id", "digest", "copies").alias("digest"), "lo", "hi")
        self.levels: list[DataFrame] = []
        for k in range(1, self.digits + self.archive_levels + 2):
            scope, node = self.parent(k - 1)
            child = F.struct("lo", "node", "digest", "hi")
            up = below.groupBy("replica", scope.alias("scope"), node.alias("node")).agg(
                F.array_sort(F.collect_list(child)).alias("below"), F.min("lo").alias("start"), F.max("hi").alias("end"), F.sum(F.col("hi") - F.col("lo")).alias("size")
            )
            parts = F.transform("below", lambda x: F.concat_ws(",", x["node"], x["digest"], (x["lo"] - F.col("start")).cast("string"), (x["hi"] - x["lo"]).cast("string")))
            inside = k <= self.digits + 1
            up = up.select("replica", "scope", "node", F.sha2(F.array_join(parts, ";"), 256).alias("digest"), *([F.col("start").alias("lo"), F.col("end").alias("hi")] if inside else [F.lit(0).cast("long").alias("lo"), F.col("size").alias("hi")]))
            below = scratch.save(up, f"level-{k}")
            self.levels.append(below)

    def parent(self, level: int) -> tuple[Column, Column]:
        """Scope and name of the node above one of this level, 0 being the records."""
        if level <= self.digits:  # within a file: one digit of the key less each time, none for the file
            return F.col("scope"), F.substring("node", 1, self.digits - level)
        at = F.col("scope") if level == self.digits + 1 else F.col("node").cast("long")
        return F.lit(-1).cast("long"), F.floor(at / FANOUT).cast("string")

    def root(self, replica: str) -> str | None:
        row = self.levels[-1].where(F.col("replica") == replica).first()
        return row.digest if row else None

    def mismatches(self, a: str, b: str, name: str = "wrong") -> DataFrame:
        """Records that differ, found from the roots down: record_id, page_id, file, status (changed,
        lost: only a has it, extra: only b has it), offset_from and offset_to (in a, of an extra one in b),
        digest_a, digest_b, lost_copies, extra_copies."""
        wrong = None
        for k in range(len(self.levels), 0, -1):
            level = self.levels[k - 1]
            level = level if wrong is None else self._under(level, wrong, k)
            x, y = (level.where(F.col("replica") == r).select("scope", "node", F.col("digest").alias(f"digest_{s}")) for r, s in ((a, "a"), (b, "b")))
            wrong = self.scratch.save(x.join(y, ["scope", "node"], "full").where(~F.col("digest_a").eqNullSafe(F.col("digest_b"))).select("scope", "node"), f"{name}-{k}")
        records = self._under(self.leaves.withColumnsRenamed({"file": "scope", "key": "node"}), wrong, 0).withColumnRenamed("scope", "file")
        own = ["file", "record_id", "digest"]
        x, y = (records.where(F.col("replica") == r).select(*own, *(F.col(c).alias(f"{c}_{s}") for c in ("page_id", "copies", "lo", "hi"))) for r, s in ((a, "a"), (b, "b")))
        both = x.join(y, own, "full").withColumns({"n_a": F.coalesce("copies_a", F.lit(0)), "n_b": F.coalesce("copies_b", F.lit(0))}).where("n_a <> n_b")
        lost, extra = F.col("n_a") > F.col("n_b"), F.col("n_b") > F.col("n_a")
        found = both.groupBy("file", "record_id").agg(
            F.coalesce(F.min("page_id_a"), F.min("page_id_b")).alias("page_id"),
            F.min(F.when(lost, F.col("digest"))).alias("digest_a"),
            F.min(F.when(extra, F.col("digest"))).alias("digest_b"),
            F.sum(F.when(lost, F.col("n_a") - F.col("n_b")).otherwise(0)).alias("lost_copies"),
            F.sum(F.when(extra, F.col("n_b") - F.col("n_a")).otherwise(0)).alias("extra_copies"),
            F.coalesce(F.min(F.when(lost, F.col("lo_a"))), F.min("lo_b")).alias("offset_from"),
            F.coalesce(F.max(F.when(lost, F.col("hi_a"))), F.max("hi_b")).alias("offset_to"),
        )
        status = F.when(F.col("digest_b").isNull(), "lost").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
        return found.select("record_id", "page_id", "file", status.alias("status"), "offset_from", "offset_to", "digest_a", "digest_b", "lost_copies", "extra_copies")

    def _under(self, rows: DataFrame, wrong: DataFrame, level: int) -> DataFrame:
        """The rows of a level whose parent is among the wrong ones."""
        scope, node = self.parent(level)
        up = wrong.select(F.col("scope").alias("up_scope"), F.col("node").alias("up_node"))
        return rows.join(up, (scope == F.col("up_scope")) & (node == F.col("up_node")), "left_semi")


def _records(pages: DataFrame, replica: str) -> DataFrame:
    record = warc_record(F.col("record_id"), F.col("url"), F.col("html"))
    return pages.select(F.lit(replica).alias("replica"), "record_id", "page_id", F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest"))


def decayed(pages: DataFrame) -> DataFrame:
    """A stand-in for a replica that decayed: by a digest of the record id, of ``DAMAGE_ONE_IN`` records
    each one has the first byte of its payload changed (where that is ASCII), one is gone, and one is followed by a foreign record."""
    kind = _digest_number(F.md5(F.concat(F.col("record_id"), F.lit("#")))) % DAMAGE_ONE_IN
    text = F.coalesce("html", F.lit(""))
    first = F.substring(text, 1, 1)
    bad = F.when((kind == 0) & (F.octet_length(first) == 1), F.concat(F.when(first == "X", F.lit("Y")).otherwise(F.lit("X")), F.substring(text, 2, 2147483647))).otherwise(text)
    foreign = pages.where(kind == 2).select("page_id", record_urn(F.lit("foreign"), F.col("record_id")).alias("record_id"), "url", F.lit("<p>foreign</p>").alias("html"))
    return pages.where(kind != 1).select("page_id", "record_id", "url", bad.alias("html")).unionByName(foreign)


def op2_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed, lost and foreign records of a decayed replica of all pages, found against the sound one."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    pages = pages.withColumn("record_id", record_urn(F.col("page_id"), F.col("url"), F.col("html")))
    scratch = Scratch(spark, "fixity")
    records = scratch.save(_records(pages, "sound").unionByName(_records(decayed(pages), "decayed")), "records")
    leaves = scratch.save(lay_out(records, file_count(records.where("replica = 'sound'"))), "leaves")
    return Archive(leaves, scratch).mismatches("sound", "decayed")


def _sql() -> str:
    n = "chr(13) || chr(10)"
    uri = "replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A')"

    def rec(h: str) -> str:
        return (
            f"'WARC/1.1' || {n} || 'WARC-Type: resource' || {n} || 'WARC-Record-ID: <' || record_id || '>' || {n} || 'WARC-Date: {WARC_DATE}' || {n} || 'WARC-Target-URI: ' || {uri} || {n} || "
            f"'Content-Type: text/html' || {n} || 'Content-Length: ' || strlen({h})::VARCHAR || {n} || {n} || {h} || {n} || {n}"
        )

    def urn(x: str) -> str:
        return "'urn:uuid:' || " + " || '-' || ".join(f"substr(md5({x}), {a}, {k})" for a, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))

    number = lambda x: f"('0x' || substr({x}, 1, 12))::BIGINT"
    identity = "coalesce(page_id::VARCHAR, '') || '|' || coalesce(url, '') || '|' || coalesce(html, '')"
    bad = "CASE WHEN kind = 0 AND strlen(substr(h, 1, 1)) = 1 THEN (CASE WHEN substr(h, 1, 1) = 'X' THEN 'Y' ELSE 'X' END) || substr(h, 2) ELSE h END"
    foreign = "'foreign|' || record_id"
    laid = lambda r: f"""SELECT *, sum(size) OVER (PARTITION BY file ORDER BY key, digest) AS hi FROM (
    SELECT record_id, digest, min(page_id) AS page_id, count(*) AS copies, max(length) * count(*) AS size, md5(record_id) AS key,
      {number('md5(record_id)')} % greatest(1, ceil((SELECT sum(length) FROM a0) / {FILE_BYTES}))::BIGINT AS file FROM {r} GROUP BY record_id, digest)"""  # noqa: E731
    return f"""
WITH r AS (SELECT *, {number("md5(record_id || '#')")} % {DAMAGE_ONE_IN} AS kind FROM (SELECT page_id, url, coalesce(html, '') AS h, {urn(identity)} AS record_id FROM pages)),
b1 AS (SELECT page_id, url, record_id, {bad} AS h FROM r WHERE kind <> 1 UNION ALL SELECT page_id, url, {urn(foreign)} AS record_id, '<p>foreign</p>' AS h FROM r WHERE kind = 2),
a0 AS (SELECT page_id, record_id, strlen({rec('h')})::BIGINT AS length, sha256({rec('h')}) AS digest FROM r),
b0 AS (SELECT page_id, record_id, strlen({rec('h')})::BIGINT AS length, sha256({rec('h')}) AS digest FROM b1),
a AS ({laid('a0')}), b AS ({laid('b0')}),
d AS (
  SELECT coalesce(a.file, b.file) AS file, coalesce(a.record_id, b.record_id) AS record_id, coalesce(a.digest, b.digest) AS digest, a.page_id AS pa, b.page_id AS pb,
    coalesce(a.copies, 0) AS na, coalesce(b.copies, 0) AS nb, a.hi - a.size AS la, a.hi AS ha, b.hi - b.size AS lb, b.hi AS hb
  FROM a FULL JOIN b ON a.record_id = b.record_id AND a.digest = b.digest
), g AS (
  SELECT record_id, coalesce(min(pa), min(pb)) AS page_id, file, min(digest) FILTER (na > nb) AS digest_a, min(digest) FILTER (nb > na) AS digest_b,
    coalesce(min(la) FILTER (na > nb), min(lb))::BIGINT AS offset_from, coalesce(max(ha) FILTER (na > nb), max(hb))::BIGINT AS offset_to,
    sum(greatest(na - nb, 0))::BIGINT AS lost_copies, sum(greatest(nb - na, 0))::BIGINT AS extra_copies
  FROM d WHERE na <> nb GROUP BY file, record_id
)
SELECT *, CASE WHEN digest_b IS NULL THEN 'lost' WHEN digest_a IS NULL THEN 'extra' ELSE 'changed' END AS status FROM g
"""


OP2_SQL = _sql()
