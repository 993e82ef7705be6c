from __future__ import annotations

import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np

from barloom.llm import sharding


def digests(df, **more):
    return [tuple(r[c] for c in ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")) for r in sharding.digest(sharding.sharded(df, **more)).collect()]


def holds(found, rows, shards, spare):
    """Every row once with its size and checksum, gapless slots, bytes as near equal as `spare`."""
    body = lambda t: (t or "").encode()
    assert Counter(f[:3] for f in found) == Counter((r[0], len(body(r[1])) + 1, zlib.crc32(body(r[1]))) for r in rows)
    assert all(f[3] == "bytes" and f[6] is None for f in found)
    slots, size = defaultdict(list), Counter()
    for _, n, _, _, shard, slot, _ in found:
        slots[shard].append(slot)
        size[shard] += n
    assert set(slots) <= set(range(shards)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(size.values()) / shards
    assert max(abs(size[s] - mean) for s in range(shards)) <= spare, size


def test_shards_of_near_equal_bytes(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "x" * int(n) + str(i)) for i, n in enumerate(rng.integers(0, 400, 3000))]
    rows += [(5000 + i, f"copy {i % 20} " * 3) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = digests(df)
    holds(found, rows, 8, 0.06 * sum(f[1] for f in found) / 8)
    shards_of = defaultdict(set)
    for f in found:
        shards_of[f[2]].add(f[4])
    assert all(len(s) == 1 for s in shards_of.values())  # equal texts stay together
    assert sorted(f[:5] for f in digests(df.repartition(2))) == sorted(f[:5] for f in found)
    holds(digests(df, shards=3, slot_rows=40), rows, 3, 1000)


def test_groups_larger_than_a_shard_are_cut(spark):
    """Half of all bytes are one text under one id, a third of the rest one text under many ids."""
    rows = [(7, "one text under one id")] * 600 + [(i, "one text under many ids") for i in range(400)] + [(None, "no id at all, many times")] * 300 + [(i, f"text {i:05d}") for i in range(500)]
    found = digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    holds(found, rows, 8, 60)


def test_odd_rows(spark):
    rows = [(1, None, "a", 1, 2, "x"), (1, "", "b", 1, 2, "x"), (None, "ü" * 50_000, "c", 1, 2, "x"), (2, "a", None, 1, 2, "x"), (2, "a", None, 1, 2, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Shard string, slot int, size int, key string")
    found = digests(df)
    assert sorted((f[1], f[2]) for f in found)[:2] == [(1, 0), (1, 0)] and len(found) == 5 and max(f[1] for f in found) == 100_001
    kept = sharding.sharded(df).select("document.*").collect()
    assert Counter(r["Shard"] for r in kept) == Counter(["a", "b", "c", None, None])
    assert digests(df.limit(0)) == [] and len(digests(df.limit(1))) == 1


def test_written_shards_hold_the_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = tempfile.mkdtemp(prefix="spark-") + "/shards"
    sharding.write_shards(sharding.sharded(docs), folder)
    back = spark.read.parquet(folder)
    assert back.select(*docs.columns).exceptAll(docs).isEmpty() and back.count() == docs.count()
    assert back.filter("shard = 3").select("slot").distinct().count() == back.filter("shard = 3").count() > 0
