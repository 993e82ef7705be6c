"""Sharding by histogram sort: splitters of equal bytes are found by counting, then every document moves once.

Documents are ordered by the hash of their text, then the hash of their id, then their place in the written table, so equal texts are neighbours.
A splitter starts with the whole range of hashes. Each round cuts every open range into 2^bits equal probes, counts the exact bytes below each of
them over all partitions, and keeps the probe that holds the splitter's target, until a probe's edge lies within `tolerance` of it. A range that
is one text alone ends there if one of its edges is within `whole` of the target, so groups of equal texts stay together; a group of more bytes
than twice that is cut by its ids' hashes, and repeated rows by their places. Then each row's shard is the number of splitters at or below it,
and one exchange deals the rows out by shard and bucket, where they get their slots.

The driver sees histograms of at most shards * 2^bits counts a round, never rows. A shard is dealt over buckets of about SLOT_ROWS rows, so no
task holds a shard; slots are gapless over a shard's buckets, in hash order within a bucket.

Defined results: the size of a document is its text's bytes in UTF-8 and one more; a null text has none, and counts as equal to an empty one.
Rows with a null doc_id and repeated rows are dealt like any other. A document larger than a shard goes whole into one. No rows give no rows.
The original row is one struct column, so further columns can't clash with those of the result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.storage import staged

SHARDS = 8
#: Shares of a mean shard: how near a splitter has to come to its target, and how far it may stay away to keep equal texts together.
TOLERANCE = 0.001
WHOLE = 0.025
#: Probes of all open ranges together in a round; rows of a bucket.
PROBES = 1 << 15
SLOT_ROWS = 100_000
#: What the rows are ordered by.
ORDER = ("key", "tie", "place")
LEAST = -(1 << 63)


@dataclass(frozen=True)
class Range:
    """Rows whose first columns of ORDER equal `same` and whose next one, shifted right by `shift`, is `prefix`; bytes of all rows before them."""

    same: tuple[int, ...] = ()
    shift: int = 64
    prefix: int = 0
    before: int = 0

    def holds(self) -> Column:
        out = F.lit(True)
        for name, value in zip(ORDER, self.same, strict=False):
            out = out & (F.col(name) == value)
        return out if self.shift == 64 else out & (F.shiftright(ORDER[len(self.same)], self.shift) == self.prefix)

    def start_of(self, value: int) -> tuple[int, ...]:
        """The least row with this value in the range's own column."""
        return (*self.same, value, *([LEAST] * (len(ORDER) - len(self.same) - 1)))


@dataclass(frozen=True)
class Probe:
    """A cut of a range: its number, bytes, rows, least and largest value."""

    number: int
    size: int
    rows: int
    low: int
    high: int


def tagged(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """document (the whole row), size, key, tie, place; written, so that every round counts the same rows."""
    body = F.coalesce(F.col(text), F.lit(""))
    named = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("document"), (F.octet_length(body) + 1).cast("long").alias("size"), F.xxhash64(body).alias("key"), F.xxhash64(F.col(doc_id)).alias("tie"))
    return staged(named.withColumn("place", F.monotonically_increasing_id()), "keyed-documents")


def probed(rows: DataFrame, ranges: list[Range], bits: int) -> dict[Range, list[Probe]]:
    """One pass: exact bytes of every probe of the ranges, in order."""
    which, at, value = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("long")
    for i, r in enumerate(ranges):
        column = F.col(ORDER[len(r.same)])
        which, at, value = F.when(r.holds(), i).otherwise(which), F.when(r.holds(), F.shiftright(column, max(r.shift - bits, 0))).otherwise(at), F.when(r.holds(), column).otherwise(value)
    cut = rows.select(which.alias("which"), at.alias("at"), value.alias("value"), "size").filter("which IS NOT NULL")
    found = cut.groupBy("which", "at").agg(F.sum("size").alias("size"), F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
    out: dict[Range, list[Probe]] = {r: [] for r in ranges}
    for r in sorted(found, key=lambda r: (r["which"], r["at"])):
        out[ranges[r["which"]]].append(Probe(r["at"], r["size"], r["rows"], r["low"], r["high"]))
    return out


def narrowed(r: Range, probes: list[Probe], target: float, near: float, apart: float, bits: int) -> tuple[int, ...] | Range:
    """The splitter, if the probes tell it: the least row behind it; else the range that holds it."""
    below = r.before
    for p in probes:
        if below + p.size >= target:
            break
        below += p.size
    after = below + p.size
    left, right = target - below, after - target
    edge = r.start_of(p.low) if left <= right else (*r.start_of(p.high)[: len(r.same)], p.high + 1, *r.start_of(p.high)[len(r.same) + 1 :])
    single = p.low == p.high
    if min(left, right) <= near or p.rows == 1 or (single and not r.same and min(left, right) <= apart) or (single and len(r.same) == len(ORDER) - 1):
        return edge
    return Range((*r.same, p.low), before=below) if single else Range(r.same, max(r.shift - bits, 0), p.number, below)


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE, whole: float = WHOLE) -> list[tuple[int, ...]]:
    """shards - 1 splitters of equal bytes over rows(size, key, tie, place); none where there are no rows."""
    total = rows.agg(F.sum("size")).first()[0]
    if not total or shards < 2:
        return []
    mean, bits = total / shards, max(3, int(math.log2(PROBES / shards)))
    found: dict[int, tuple[int, ...]] = {}
    open_ = {k: Range() for k in range(1, shards)}
    while open_:
        counts = probed(rows, sorted(set(open_.values()), key=lambda r: (r.same, r.shift, r.prefix)), bits)
        for k, r in list(open_.items()):
            step = narrowed(r, counts[r], k * mean, tolerance * mean, whole * mean, bits)
            if isinstance(step, Range):
                open_[k] = step
            else:
                found[k] = step
                del open_[k]
    return [found[k] for k in sorted(found)]


def shard_of(bounds: list[tuple[int, ...]]) -> Column:
    """How many splitters are at or below a row."""
    out = F.lit(0)
    for bound in bounds:
        reached = F.col(ORDER[-1]) >= bound[-1]
        for name, value in list(zip(ORDER, bound, strict=True))[-2::-1]:
            reached = (F.col(name) > value) | ((F.col(name) == value) & reached)
        out = out + reached.cast("int")
    return out


def sharded(documents: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, whole: float = WHOLE, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """document, size, shard, slot: every row of documents(doc_id, text, ...) in one of `shards` shards of near equal bytes."""
    rows = tagged(documents)
    placed = rows.withColumn("shard", shard_of(splitters(rows, shards, tolerance, whole)))
    buckets = {r["shard"]: -(-r["n"] // slot_rows) for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # a row a shard
    least = -(-int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards)
    wide = F.element_at(F.create_map(*(F.lit(x) for s in range(shards) for x in (s, max(least, buckets.get(s, 1))))), F.col("shard"))
    dealt = placed.withColumn("bucket", F.pmod(F.xxhash64("place"), wide))
    order = Window.partitionBy("shard").orderBy("bucket")
    starts = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select("shard", "bucket", (F.sum("n").over(order) - F.col("n")).alias("before"))
    nth = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy(*ORDER)) - 1
    return dealt.withColumn("nth", nth).join(starts, ["shard", "bucket"]).select("document", "size", "shard", (F.col("before") + F.col("nth")).alias("slot"))


def write_shards(placed: DataFrame, folder: str) -> None:
    """The documents of sharded() as Parquet files, a folder for each shard, with their slots."""
    placed.select("document.*", "slot", "shard").write.partitionBy("shard").parquet(folder)


def digest(placed: DataFrame) -> DataFrame:
    """One row for each document of sharded()."""
    body = F.coalesce(F.col("document.text"), F.lit(""))
    return placed.select(F.col("document.doc_id").alias("doc_id"), "size", F.crc32(body.cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
