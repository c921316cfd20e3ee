"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash. Of each source the mix takes whole passes over all its
documents and, of one more pass, the documents whose hash is below a threshold. The threshold comes
from sums of words by source and hash bucket: the bucket in which the budget runs out is refined by
the next bits of the hash, and only it, until it holds a single hash. Nothing is sorted.

The document at the threshold does not fit; what its place leaves of the budget goes to a nested
threshold over the documents behind it that are no longer than the rest, and so on for ``ROUNDS``
rounds, so that long documents leave no large gap.

Defined cases: a null text has no words; a null source is a source of its own, the last one; equal
rows (id and text) share a hash and are taken together; empty tables give empty results.
One row per source comes to the driver; sources are a catalogue, not data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlake.llm.common import WORD, Scratch

WEIGHTS = (3, 1, 2)
BITS, LEVELS = 12, 5
ROUNDS = 4
NEAR = 0.001
#: A source table with more rows than this is joined without a broadcast.
BROADCAST_ROWS = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of a digest of id and text."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("long")


def source_targets(sizes: dict[str | None, int], share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> dict[str | None, float]:
    """Targets by weight that stop at ``most`` times a source's size, the excess reshared."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), list(order), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if per * weight[s] > most * sizes[s]]
        for s in over or open_:
            target[s] = most * sizes[s] if over else per * weight[s]
        if not over:
            break
        left -= sum(target[s] for s in over)
        open_ = [s for s in open_ if s not in target]
    return target


@dataclass
class Plan:
    """What the mix takes of a source: whole passes, then hashes in [lo, hi) of documents of up to ``longest`` words."""

    size: int
    target: float
    passes: int = 0
    rest: float = 0.0
    ranges: list[tuple[int, int, int]] = field(default_factory=list)


def _thresholds(keyed: DataFrame, budgets: dict[str, tuple[int, int, float]]) -> dict[str, tuple[int, int]]:
    """For each source key the first hash at or after ``start`` that no longer fits the budget, and
    the words before it. budgets: start, longest document, budget. Documents: key, size, hash."""
    spark = keyed.sparkSession
    all_bits = BITS * LEVELS
    found: dict[str, tuple[int, int]] = {}
    state = {k: (start, longest, budget, 0, 0) for k, (start, longest, budget) in budgets.items()}  # ..., prefix, words before
    for level in range(LEVELS):
        if not state:
            break
        shift = all_bits - BITS * (level + 1)
        frame = spark.createDataFrame([(k, int(a), int(m), float(b), int(p)) for k, (a, m, b, p, _) in state.items()], "key string, start long, longest long, budget double, prefix long")
        frame = F.broadcast(frame) if len(state) <= BROADCAST_ROWS else frame
        inside = keyed.join(frame, "key").where(
            (F.col("hash") >= F.col("start")) & (F.col("size") <= F.col("longest")) & (F.shiftright("hash", all_bits - BITS * level) == F.col("prefix"))
        )
        sums = inside.groupBy("key", F.shiftright("hash", shift).alias("bucket"), "budget").agg(F.sum("size").alias("n"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
        upto = F.sum("n").over(Window.partitionBy("key").orderBy("bucket"))  # 2**BITS rows a source at most
        over = sums.withColumn("upto", upto).where(F.col("upto") > F.col("budget"))
        edge = over.groupBy("key").agg(F.min_by(F.struct("bucket", "n", "upto", "lo", "hi"), "bucket").alias("e")).collect()
        total = None
        new = {}
        for r in edge:
            start, longest, budget, _, before = state[r.key]
            words = before + r.e.upto - r.e.n
            if r.e.lo == r.e.hi:
                found[r.key] = (r.e.lo, words)
            else:
                new[r.key] = (start, longest, budget - (r.e.upto - r.e.n), r.e.bucket, words)
        if missing := [k for k in state if k not in new and k not in found]:  # all fits
            total = {r.key: r.n for r in inside.where(F.col("key").isin(missing)).groupBy("key").agg(F.sum("size").alias("n")).collect()}
            for k in missing:
                found[k] = (1 << all_bits, state[k][4] + total.get(k, 0))
        state = new
    return found


def plan_mix(keyed: DataFrame, targets: Callable[[dict], dict] = source_targets) -> dict[str | None, Plan]:
    """Plans by source. ``keyed``: key (of the source), source, size, hash."""
    sizes = {r.key: (r.source, r.n or 0) for r in keyed.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("n")).collect()}
    goal = targets({s: n for s, n in sizes.values()})
    plans = {k: Plan(n, float(goal[s])) for k, (s, n) in sizes.items()}
    for p in plans.values():
        p.passes = int(p.target // p.size) if p.size else 0
        p.rest = p.target - p.passes * p.size
    start = dict.fromkeys(plans, 0)
    for _ in range(ROUNDS):
        open_ = {k: (start[k], int(p.rest) if p.ranges else p.size, p.rest) for k, p in plans.items() if p.rest >= 1 and p.rest > NEAR * p.target and start[k] < 1 << (BITS * LEVELS)}
        if not open_:
            break
        for k, (edge, words) in _thresholds(keyed, open_).items():
            plans[k].ranges.append((open_[k][0], edge, open_[k][1]))
            plans[k].rest -= words
            start[k] = edge
    return plans


def source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def copies_taken(keyed: DataFrame, plans: dict[str, Plan]) -> DataFrame:
    """``keyed`` with source_size, target and copies (how often the mix takes a document)."""
    spark = keyed.sparkSession
    rows = [(k, p.size, p.target, p.passes, [(int(a), int(b), int(m)) for a, b, m in p.ranges]) for k, p in plans.items()]
    frame = spark.createDataFrame(rows, "key string, source_size long, target double, passes int, ranges array<struct<lo:long,hi:long,longest:long>>")
    frame = F.broadcast(frame) if len(rows) <= BROADCAST_ROWS else frame
    once = F.exists("ranges", lambda r: (F.col("hash") >= r["lo"]) & (F.col("hash") < r["hi"]) & (F.col("size") <= r["longest"]))
    return keyed.join(frame, "key").withColumn("copies", F.col("passes") + once.cast("int"))


def keyed_documents(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", source_key(F.col("source")).alias("key"), n_words(F.col("text")).alias("size"), document_hash(F.col("doc_id"), F.col("text")).alias("hash"))


def mix_documents(docs: DataFrame, targets: Callable[[dict], dict] = source_targets) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    scratch = Scratch(docs.sparkSession, "mix")
    plans = plan_mix(scratch.save(keyed_documents(docs).drop("doc_id"), "keyed"), targets)
    names = [c for c in docs.columns]
    whole = docs.select(
        F.struct(*names).alias("row"), source_key(F.col("source")).alias("key"), n_words(F.col("text")).alias("size"), document_hash(F.col("doc_id"), F.col("text")).alias("hash")
    )
    taken = copies_taken(whole, plans).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def op4_hash_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document when sources weigh 3, 1, 2 and share 150 % of all words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    keyed = Scratch(spark, "mix").save(keyed_documents(docs), "keyed")
    out = copies_taken(keyed, plan_mix(keyed.drop("doc_id")))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def _sql() -> str:
    end = 1 << (BITS * LEVELS)
    ctes = [
        rf"""d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents)""",
        "s0 AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source)",
        f"s1 AS (SELECT source, n, {list(WEIGHTS)}[(k - 1) % {len(WEIGHTS)} + 1]::DOUBLE AS w FROM s0)",
        # sources by the share at which they are full: the full ones are the first of them
        "s2 AS (SELECT *, 1.5::DOUBLE * sum(n) OVER () - coalesce(sum(2 * n) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_w, 2 * n / w AS full_at FROM s1 WINDOW o AS (ORDER BY 2 * n / w, source))",
        "per AS (SELECT rest / open_w AS p FROM s2 WHERE rest / open_w <= full_at ORDER BY full_at, source LIMIT 1)",
        "t AS (SELECT source, n, CASE WHEN p * w > 2 * n THEN 2.0::DOUBLE * n ELSE p * w END AS target FROM s1, per)",
        "p0 AS (SELECT source, n, target, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS passes, target - n * CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS rest, 0::BIGINT AS start FROM t)",
    ]
    for r in range(1, ROUNDS + 1):
        longest = "n" if r == 1 else "floor(rest)"
        ctes += [
            f"o{r} AS (SELECT *, {longest} AS longest, rest >= 1 AND rest > {NEAR} * target AND start < {end} AS go FROM p{r - 1})",
            f"c{r} AS (SELECT o.source, o.rest, d.h, sum(d.size) OVER (PARTITION BY o.source ORDER BY d.h) AS upto FROM o{r} o JOIN d ON d.source IS NOT DISTINCT FROM o.source WHERE go AND d.h >= o.start AND d.size <= o.longest)",
            f"e{r} AS (SELECT source, coalesce(min(h) FILTER (upto > rest), {end}) AS edge, coalesce(max(upto) FILTER (upto <= rest), 0) AS words FROM c{r} GROUP BY source)",
            f"p{r} AS (SELECT o.* EXCLUDE (rest, start, longest, go), o.rest - CASE WHEN go THEN coalesce(words, 0) ELSE 0 END AS rest, CASE WHEN go THEN coalesce(edge, {end}) ELSE start END AS start, "
            f"CASE WHEN go THEN start ELSE {end} END AS lo{r}, CASE WHEN go THEN coalesce(edge, {end}) ELSE 0 END AS hi{r}, longest AS m{r} FROM o{r} o LEFT JOIN e{r} e ON o.source IS NOT DISTINCT FROM e.source)",
        ]
    once = " OR ".join(f"(h >= lo{r} AND h < hi{r} AND size <= m{r})" for r in range(1, ROUNDS + 1))
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, size, n AS source_size, target, (size * (passes + ({once})::INT))::BIGINT AS taken FROM d JOIN p{ROUNDS} p ON d.source IS NOT DISTINCT FROM p.source"


OP4_SQL = _sql()
