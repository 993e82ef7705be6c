"""Packing token sequences with few gaps: exact-complement hashing over counts of lengths, then best fit.

Texts are tokenized and cut where they are read; only lengths matter after that. The counts of each length (one number for each of at
most `capacity` lengths, whatever the number of documents) are planned on the driver: lengths are taken from the longest down, and
an index of the lengths still available, of their pair sums and of their triple sums gives combinations that fill the gap exactly. A
combination is consumed as often as its scarcest length allows, so at most `capacity` steps are needed. What no combination fills
goes by best fit. A plan says which ranks of a length go where; a piece's rank is its count within its partition plus
what earlier partitions hold of that length, so no length, however frequent, is numbered in one task.

Defined results: a null text is empty; an empty document is its end mark alone, one piece of length 1. Rows with a null doc_id and
repeated rows are packed like any other. No rows give no pieces. Further columns are ignored. Very long texts are tokenized whole and
cut into pieces of `capacity`; the first piece takes the remainder.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from barloom.llm.storage import staged

CAPACITY = 2048
END_ID = 0
#: A run of so much white space is encoded by the slower library.
SPACES = 500_000
_SPACES = re.compile(rf"\s{{{SPACES}}}")
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"
PLACE = StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())])


@functools.lru_cache(maxsize=1)
def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character: itself where it is one, else the next from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=1)
def tokenizer(json_path: str, pattern: str) -> Callable[[str], list[int]]:
    """The ids of a text by a byte-level BPE vocabulary in the JSON form of the tokenizers library, added tokens included, in a fifth of its time.

    Ids of merged pairs rise with the merges, so they serve as ranks; added tokens must be of the plain kind that is found wherever it stands."""
    given, byte = json.loads(Path(json_path).read_text(encoding="utf-8")), _byte_of()
    added = {t["content"]: t["id"] for t in given["added_tokens"]}
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in given["added_tokens"]) or given["normalizer"]:
        raise ValueError("this vocabulary's added tokens or normaliser aren't plain")
    ranks = {bytes(byte[c] for c in token): i for token, i in given["model"]["vocab"].items() if token not in added}
    bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
    names = set(added)

    def encode(text: str) -> list[int]:
        if len(text) > SPACES and _SPACES.search(text):  # beyond what the fast one's patterns can take
            return Tokenizer.from_file(json_path).encode(text, add_special_tokens=False).ids
        if any(name in text for name in names):
            return bpe.encode(text, allowed_special=names, disallowed_special=())
        return bpe.encode_ordinary(text)

    return encode


def cuts(length: int, capacity: int = CAPACITY) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    first = length if length <= capacity else length % capacity or capacity
    yield 0, first
    for start in range(first, length, capacity):
        yield start, capacity


def pieces(documents: DataFrame, json_path: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece; part and nth say where it was cut and how many of its length were cut there before."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, part = tokenizer(json_path, pattern), [0] * (capacity + 1), TaskContext.get().partitionId()
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "part", "nth"))])
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = array("I", encode(text.as_py() or ""))
                ids.append(END_ID)
                held = memoryview(ids)
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    for column, value in zip(rows, (doc_id, k, start, length, zlib.crc32(held[start : start + length].cast("B")), part, seen[length]), strict=True):
                        column.append(value)
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECE)


def exact_fill(available: np.ndarray, gap: int) -> list[int]:
    """One, two or three available lengths whose sum is gap, the longest first; empty if there are none."""
    if gap < len(available) and available[gap] > 0:
        return [gap]

    def pair(total: int, counts: np.ndarray) -> list[int]:
        long = np.arange(min(total - 1, len(counts) - 1), (total - 1) // 2, -1)
        short = total - long
        fits = (counts[long] > 0) & (counts[short] > np.where(long == short, 1, 0))
        at = int(fits.argmax()) if len(fits) else 0
        return [int(long[at]), int(short[at])] if len(fits) and fits[at] else []

    if found := pair(gap, available):
        return found
    present = np.flatnonzero(available > 0)
    sums = np.zeros(gap + 1, dtype=bool)  # the index of pair sums
    for a in present[present < gap]:
        b = present[(present <= gap - a) & ((present != a) | (available[a] > 1))]
        sums[a + b] = True
    for a in present[present < gap][::-1]:
        if sums[gap - a]:
            available[a] -= 1
            found = pair(gap - int(a), available)
            available[a] += 1
            if found:
                return [int(a), *found]
    return []


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """counts[length] to (lengths of a sequence, number of such sequences); every piece is used exactly once."""
    available, out = counts.astype(np.int64).copy(), []
    rest = np.zeros_like(available)
    for length in range(capacity, 0, -1):
        while available[length]:
            available[length] -= 1
            fill = exact_fill(available, capacity - length) if length < capacity else []
            available[length] += 1
            if length < capacity and not fill:
                rest[length], available[length] = available[length], 0
                break
            lengths = [length, *fill]
            need = {x: lengths.count(x) for x in lengths}
            times = min(int(available[x]) // n for x, n in need.items())
            for x, n in need.items():
                available[x] -= n * times
            out.append((lengths, times))
    open_: list[tuple[int, list[int], int]] = []  # gap, lengths, number; best fit takes the smallest gap that holds a length
    for length in range(capacity, 0, -1):
        while (n := int(rest[length])) > 0:
            fitting = [x for x in open_ if x[0] >= length]
            if not fitting:
                open_.append((capacity - length, [length], n))
                rest[length] = 0
                continue
            best = min(fitting, key=lambda x: x[0])
            open_.remove(best)
            gap, lengths, have = best
            if have > n:
                open_.append((gap, lengths, have - n))
            open_.append((gap - length, [*lengths, length], min(n, have)))
            rest[length] -= min(n, have)
    return out + [(lengths, n) for _, lengths, n in open_]


def slots(planned: list[tuple[list[int], int]], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, sequence of that rank, offset), sorted: the plan as intervals of ranks."""
    used, sequence, rows = [0] * (capacity + 1), 0, []
    for lengths, times in planned:
        offset = 0
        for x in lengths:
            rows.append((x, used[x], sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pack(documents: DataFrame, json_path: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """documents(doc_id, text): a row for each piece with its sequence_id and its offset there."""
    cut = staged(pieces(documents, json_path, pattern, capacity), "pieces")
    held = staged(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in held.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[row["length"]] = row["n"]
    table = slots(plan(counts, capacity), capacity)
    keys = table[:, 0] * (1 << 48) + table[:, 1]

    @F.pandas_udf(PLACE)
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(keys, length.to_numpy() * (1 << 48) + rank.to_numpy(), "right") - 1
        return pd.DataFrame({"sequence_id": table[at, 2] + rank.to_numpy() - table[at, 1], "offset": table[at, 3]})

    before = held.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    placed = cut.join(before, ["part", "length"]).withColumn("_place", place("length", F.col("before") + F.col("nth")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "_place.sequence_id", "_place.offset")
