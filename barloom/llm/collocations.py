"""Phrase collocations: counts of frequent phrases by a multikey quicksort of suffix pointers, scored by their weakest cut.

Texts are encoded once, chunk by chunk: a word list for each language and the word numbers of its pieces, written. Counts of single words come
from the lists. Bitmaps of a fixed size go to all tasks: of the hashes of frequent words, of the hash slots that pairs of them fill often enough,
and of those that triples of such pairs, and runs of four of such triples do. A suffix ends before its first infrequent run; a false
hit of a bitmap only leaves it longer than need be. Equal suffixes of a chunk combine, then they are routed over the cluster by their language and
first two words: their hash deals them to BUCKETS buckets, and what a chunk has for a bucket is one compressed row, so rows grow with the chunks however
many phrases are frequent. There a three-way quicksort, bucket by bucket, splits pointers to them by one word after another: the size of the part that equals the pivot is the count of the words
that all its suffixes begin with, and parts below the least count are abandoned unsorted, as nothing that begins so can be frequent.

Leading words with many suffixes would make one task long: pairs, and then triples, with more than HOT_SHARE of all words (at most 1 / HOT_SHARE of
either) are routed by one word more. The counts of such a pair are then sums over tasks, which keep their parts whatever their size.

A phrase's score, cut after its first k words, is (2000000 a) div (l + r); counts are whole numbers and products decimals, so it is exact. The lowest
cut counts, the smallest k of equal ones. Phrases inside a longer frequent phrase with four fifths of their count go.

Defined results: A-Z are lowered; a null text is empty, a null lang is `und`. Rows with a null doc_id and repeated rows count like any other. No rows,
or none with a frequent phrase, give no rows. Further columns are ignored. Long texts are split over no chunks; a chunk ends with a text.
"""

from __future__ import annotations

import array
import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.storage import staged

LONGEST = 4
LEAST = 30
COVERED = (80, 100)
BEST = 2000
#: Words of a chunk, about; share of all words beyond which leading words are routed by one more; bits of the bitmap, 4 MB.
CHUNK_WORDS = 1_000_000
HOT_SHARE = 1 / 20_000
BITMAP_BITS = 1 << 25
_MAP_BITS = 1 << 15
#: Parts of the runs' slots that are summed apart, and tasks that each part's sums begin in.
SLOT_PARTS, SALTS = 16, 8
SEED = 42
#: Parts that suffixes are routed to; a task sorts one at a time.
BUCKETS = 256
#: A byte that UTF-8 never has, for the ends of pieces; A-Z small, a tab as a space.
_END = b"\xff"
_FOLDED = bytes(255 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)).lower()
ENCODED = "lang string, words array<string>, counts array<bigint>, spelled binary, ids binary, n long, hot array<struct<w1:string,w2:string,w3:string,n:bigint>>"
SLOTS = "part int, salt int, slots binary, n binary"
PACKED = "lang string, bucket int, spelled binary, suffixes binary"


def pieces_of(text: str | None) -> list[bytes]:
    """The words of a text, lowered, with _END behind each piece."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLDED).replace(_END, b" \xff ").split() + [_END]


def common_runs(ids: np.ndarray, size: int, words: int, least: int) -> list[tuple[int, int]]:
    """Runs of so many words (numbers above 0 and below size) that occur at least `least` times: the place of one, and how often."""
    n = len(ids) - words + 1
    if n <= 0:
        return []
    whole, mixed = np.ones(n, dtype=bool), np.zeros(n, dtype=np.uint64)
    for k in range(words):
        part = ids[k : k + n]
        whole &= part > 0
        mixed = (mixed + part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    at = np.flatnonzero(whole)
    slot = (mixed[at] >> np.uint64(44)).astype(np.int64)
    at = at[np.bincount(slot, minlength=1 << 20)[slot] >= least]  # places whose run may be common; few are left to sort
    runs = np.zeros(len(at), dtype=object if size**words > 1 << 62 else np.int64)
    for k in range(words):
        runs = runs * size + ids[at + k]
    _, first, times = np.unique(runs, return_index=True, return_counts=True)
    return [(int(at[f]), int(c)) for f, c in zip(first, times, strict=True) if c >= least]


def encoded(documents: DataFrame, chunk_words: int = CHUNK_WORDS, hot_share: float = HOT_SHARE) -> DataFrame:
    """A row for each chunk and language: words (the first ends a piece), their counts, the words once more as one compressed text, the compressed numbers
    of all words in order, and often repeated pairs and triples. Tasks in Python read the compressed columns alone."""

    def row(lang: str, vocabulary: dict[bytes, int], numbers: array.array) -> pa.RecordBatch:
        ids, words = np.frombuffer(numbers, dtype=np.int32), [w.decode("utf-8", "replace") if w != _END else "" for w in vocabulary]
        counts = np.bincount(ids, minlength=len(words))
        counts[0] = 0
        least = max(2, int(hot_share * len(ids)))
        hot = [{"w1": words[ids[at]], "w2": words[ids[at + 1]], "w3": words[ids[at + 2]] if k == 3 else None, "n": n} for k in (2, 3) for at, n in common_runs(ids, len(words), k, least)]
        return pa.RecordBatch.from_arrays([
            pa.array([lang]), pa.array([words], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64())),
            pa.array([zlib.compress(b"\n".join(w if w != _END else b"" for w in vocabulary), 1)], pa.binary()), pa.array([zlib.compress(ids.astype("<i4").tobytes(), 1)], pa.binary()), pa.array([int(counts.sum())]),
            pa.array([hot], pa.list_(pa.struct([("w1", pa.string()), ("w2", pa.string()), ("w3", pa.string()), ("n", pa.int64())])))], names=["lang", "words", "counts", "spelled", "ids", "n", "hot"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, tuple[dict[bytes, int], array.array]] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if lang not in open_:
                    vocabulary: dict[bytes, int] = defaultdict()
                    vocabulary.default_factory = vocabulary.__len__
                    vocabulary[_END]
                    open_[lang] = vocabulary, array.array("i")
                vocabulary, numbers = open_[lang]
                numbers.extend(map(vocabulary.__getitem__, pieces_of(text.as_py())))
                if len(numbers) >= chunk_words:
                    yield row(lang, *open_.pop(lang))
        for lang, held in open_.items():
            yield row(lang, *held)

    return staged(documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(chunks, ENCODED), "encoded-words")


def bitmap(words: DataFrame) -> np.ndarray:
    """A bit for each hash of words(lang, phrase): BITMAP_BITS of them, put together from their parts."""
    bit = F.pmod(F.xxhash64("lang", "phrase"), F.lit(BITMAP_BITS))
    parts = words.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / _MAP_BITS).alias("part")).agg(F.bitmap_construct_agg(F.col("bit") % _MAP_BITS).alias("bits")).collect()
    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for p in parts:
        out[p["part"] * _MAP_BITS // 8 : (p["part"] + 1) * _MAP_BITS // 8] = np.frombuffer(p["bits"], dtype=np.uint8)
    return out


def hashes_of(lang: str, words: list[bytes]) -> np.ndarray:
    """The hash of each word of a language, as Spark's xxhash64(lang, word) gives it."""
    seed, digest = xxhash.xxh64_intdigest(lang.encode(), SEED), xxhash.xxh64_intdigest
    return np.array([digest(w, seed) for w in words], dtype=np.uint64)


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """Each chunk's language, words and numbers."""
    for batch in batches:
        for lang, spelled, ids in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
            yield lang.as_py(), zlib.decompress(spelled.as_py()).split(b"\n"), np.frombuffer(zlib.decompress(ids.as_py()), dtype="<i4")


def held_bits(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 > 0


def run_slots(hashes: np.ndarray, ids: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
    """The slot of BITMAP_BITS of each run of so many words that starts at these places."""
    mixed = hashes[ids[at]]
    for k in range(1, words):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[ids[at + k]]
    return ((mixed * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(65 - BITMAP_BITS.bit_length())).astype(np.int64)


def open_runs(hashes: np.ndarray, numbers: np.ndarray, bitmaps: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The word numbers of a chunk, 0 where a piece ends or a word is infrequent, with zeros behind; and for 1, 2, ... words, as far as there are bitmaps
    and one word beyond, whether the run that starts at each place may be frequent, as all runs within it may."""
    good = held_bits(bitmaps[0], (hashes & np.uint64(BITMAP_BITS - 1)).astype(np.int64))
    good[0] = False
    ids = np.concatenate([np.where(good[numbers], numbers, 0), np.zeros(LONGEST, dtype=np.int32)])
    passed = [ids > 0]
    for words in range(2, len(bitmaps) + 2):
        on = np.append(passed[-1][:-1] & passed[-1][1:], False)
        if words <= len(bitmaps):
            at = np.flatnonzero(on)
            on[at] = held_bits(bitmaps[words - 1], run_slots(hashes, ids, at, words))
        passed.append(on)
    return ids, passed


def run_bitmap(chunks: DataFrame, bitmaps: list[np.ndarray], least: int) -> np.ndarray:
    """A bit for each slot that runs of one word more than the last of these bitmaps tells of fill `least` times. A chunk's counts, cut off at `least`,
    are added up part by part: first in SALTS tasks each, as long as they come, then those sums."""
    spark, size, words = chunks.sparkSession, BITMAP_BITS // SLOT_PARTS, len(bitmaps) + 1
    shared, top = spark.sparkContext.broadcast(bitmaps), min(least, 255)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, spelled, numbers in unpacked(batches):
            hashes = hashes_of(lang, spelled)
            ids, passed = open_runs(hashes, numbers, shared.value)
            slot, n = np.unique(run_slots(hashes, ids, np.flatnonzero(passed[-1]), words), return_counts=True)
            ends = np.searchsorted(slot, np.arange(SLOT_PARTS + 1) * size)
            parts = [(p, ends[p], ends[p + 1]) for p in range(SLOT_PARTS) if ends[p] < ends[p + 1]]
            yield pa.RecordBatch.from_arrays([
                pa.array([p for p, _, _ in parts], pa.int32()), pa.array([len(ids) % SALTS] * len(parts), pa.int32()),
                pa.array([zlib.compress(np.diff(slot[i:j] - p * size, prepend=0).astype("<u4").tobytes(), 1) for p, i, j in parts], pa.binary()),
                pa.array([zlib.compress(np.minimum(n[i:j], top).astype(np.uint8).tobytes(), 1) for _, i, j in parts], pa.binary())], names=["part", "salt", "slots", "n"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, steps, n in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                slot = np.cumsum(np.frombuffer(zlib.decompress(steps.as_py()), dtype="<u4"), dtype=np.int64)
                held = sums.setdefault(part, np.zeros(size, dtype=np.uint16))
                held[slot] = np.minimum(held[slot] + np.frombuffer(zlib.decompress(n.as_py()), dtype=np.uint8), top)
        for part, held in sums.items():
            slot = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([0], pa.int32()), pa.array([zlib.compress(np.diff(slot, prepend=0).astype("<u4").tobytes(), 1)], pa.binary()), pa.array([zlib.compress(held[slot].astype(np.uint8).tobytes(), 1)], pa.binary())], names=["part", "salt", "slots", "n"])

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in summed(batches):
            for part, steps, n in zip(batch.column(0), batch.column(2), batch.column(3), strict=True):
                full = np.zeros(size, dtype=bool)
                slot = np.cumsum(np.frombuffer(zlib.decompress(steps.as_py()), dtype="<u4"), dtype=np.int64)
                full[slot[np.frombuffer(zlib.decompress(n.as_py()), dtype=np.uint8) >= top]] = True
                yield pa.RecordBatch.from_arrays([pa.array([part.as_py()], pa.int32()), pa.array([np.packbits(full, bitorder="little").tobytes()], pa.binary())], names=["part", "bits"])

    counts = chunks.select("lang", "spelled", "ids").mapInArrow(slots, SLOTS).repartition("part", "salt").mapInArrow(summed, SLOTS)
    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for r in counts.repartition("part").mapInArrow(bits, "part int, bits binary").collect():  # SLOT_PARTS rows, 4 MB
        out[r["part"] * size // 8 : (r["part"] + 1) * size // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def suffixes(chunks: DataFrame, words: DataFrame, hot: dict[str, set[tuple[str, ...]]], least: int = LEAST, buckets: int = BUCKETS) -> DataFrame:
    """Of each chunk the different suffixes of two to LONGEST words that may be frequent, how often each occurs, and by how many leading words it is routed:
    a row for each bucket, with the words that its suffixes use and their numbers among these (0: none), counts and leads, column by column."""
    bitmaps = [bitmap(words)]
    while len(bitmaps) < LONGEST:
        bitmaps.append(run_bitmap(chunks, bitmaps, least))
    shared = chunks.sparkSession.sparkContext.broadcast((bitmaps, hot))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps, busy = shared.value
        for lang, spelled, numbers in unpacked(batches):
            hashes = hashes_of(lang, spelled)
            ids, passed = open_runs(hashes, numbers, maps)
            at = np.flatnonzero(passed[1])
            columns = [c.astype(np.int64) for c in (ids[at], ids[at + 1], *(np.where(passed[k][at], ids[at + k], 0) for k in range(2, LONGEST)))]
            size = len(spelled)
            _, head = np.unique(columns[0] * size + columns[1], return_inverse=True)
            _, tail = np.unique(columns[2] * size + columns[3], return_inverse=True)
            _, first, n = np.unique(head * (tail.max(initial=0) + 1) + tail, return_index=True, return_counts=True)
            columns = [c[first] for c in columns]
            lead = np.full(len(first), 2, dtype=np.int32)
            number = {w: i for i, w in enumerate(spelled)} if lang in busy else {}
            leading = [tuple(number.get(w.encode(), 0) for w in p) for p in busy.get(lang, ())]
            lead[np.isin(columns[0] * size + columns[1], np.array([p[0] * size + p[1] for p in leading if len(p) == 2 and all(p)], dtype=np.int64))] = 3
            for p in leading:
                if len(p) == 3 and all(p):
                    lead[(columns[0] == p[0]) & (columns[1] == p[1]) & (columns[2] == p[2]) & (lead == 3)] = 4
            mixed = np.zeros(len(first), dtype=np.uint64)
            for k, c in enumerate(columns):
                mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + np.where((k < lead) & (c > 0), hashes[c], np.uint64(0))
            bucket = ((mixed * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            table = np.stack([*columns, n, lead])[:, order]
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            parts = []
            for i, (start, end) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                if start < end:
                    part = table[:, start:end]
                    used = np.union1d(part[:LONGEST], [0])  # number 0, where a suffix ends, comes first
                    part = np.concatenate([np.searchsorted(used, part[:LONGEST]), part[LONGEST:]]).astype("<i4")
                    parts.append((i, zlib.compress(b"\n".join(spelled[w] for w in used.tolist()), 1), zlib.compress(part.tobytes(), 1)))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(parts), pa.string()), pa.array([p[0] for p in parts], pa.int32()), *(pa.array([p[k] for p in parts], pa.binary()) for k in (1, 2))], names=["lang", "bucket", "spelled", "suffixes"])

    return chunks.select("lang", "spelled", "ids").mapInArrow(made, PACKED)


def frequent(columns: list[np.ndarray], weights: np.ndarray, pointers: np.ndarray, lead: int, least: int) -> list[tuple[int, int, int]]:
    """Multikey three-way quicksort of pointers to suffixes, whose k-th words are columns[k] (column 0 tells the language, -1 ends a suffix): (words,
    a pointer, count) of every beginning of two or more words that is frequent, or whose suffixes may also be elsewhere as it is shorter than lead."""
    found, todo, add = [], [(pointers, weights.take(pointers), 0)], np.add.reduce
    while todo:
        p, w, depth = todo.pop()
        key = columns[depth].take(p)
        pivot = key[len(key) // 2]
        less, more = key < pivot, key > pivot
        for side in (less, more):
            part = w.compress(side)
            # what begins so is frequent nowhere, if all of it is here
            if len(part) and (add(part) >= least or 2 < lead > depth):
                todo.append((p.compress(side), part, depth))
        if pivot < 0:
            continue
        same = ~(less | more)
        part = w.compress(same)
        count, whole = int(add(part)), lead == 2 or depth >= lead
        if whole and count < least:
            continue
        equal = p.compress(same)
        if depth >= 2:
            found.append((depth, int(equal[0]), count))
        if depth < LONGEST:
            todo.append((equal, part, depth + 1))
    return found


def unrouted(rows: list[tuple[str, bytes, bytes]]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, list[str], list[bytes]]:
    """Of rows(lang, spelled, suffixes) the columns of frequent(), how often each suffix occurs, its lead, and the languages and words that the columns number."""
    langs: dict[str, int] = defaultdict()
    langs.default_factory = langs.__len__
    words: dict[bytes, int] = defaultdict()
    words.default_factory = words.__len__
    parts = []
    for lang, spelled, suffixes in rows:
        part = np.frombuffer(zlib.decompress(suffixes), dtype="<i4").reshape(LONGEST + 2, -1)
        known = np.array([-1, *map(words.__getitem__, zlib.decompress(spelled).split(b"\n")[1:])], dtype=np.int32)
        parts.append(np.concatenate([np.full((1, part.shape[1]), langs[lang], dtype=np.int32), known[part[:LONGEST]], part[LONGEST:]]))
    table = np.concatenate(parts, axis=1)
    return list(table[: LONGEST + 1]), table[LONGEST + 1].astype(np.int64), table[LONGEST + 2], list(langs), list(words)


def counted(routed: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, phrase, words, a: the frequent phrases of two and more words; a task sorts what is routed to it, one bucket after the other."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(b.column(k).to_pylist() for k in (1, 0, 2, 3)), strict=True))
        for _, held in itertools.groupby(rows, key=lambda row: row[0]):
            codes, weights, lead, langs, words = unrouted([row[1:] for row in held])
            found = [x for k in (2, 3, 4) if (at := np.flatnonzero(lead == k)).size for x in frequent(codes, weights, at, k, least)]
            size, at = np.array([f[0] for f in found], dtype=np.int32), np.array([f[1] for f in found], dtype=np.int64)
            spelled = pa.array(words, pa.binary()).cast(pa.string())
            parts = [spelled.take(pa.array(codes[k].take(at), mask=size < k)) for k in range(1, LONGEST + 1)]
            phrase = pc.binary_join_element_wise(*parts, " ", null_handling="skip")
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()).take(pa.array(codes[0].take(at))), phrase, pa.array(size), pa.array([f[2] for f in found], pa.int64())], names=["lang", "phrase", "words", "a"])

    parts = routed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(sort, "lang string, phrase string, words int, a long")
    return parts.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).filter(F.col("a") >= least)


def phrases(documents: DataFrame, least: int = LEAST, chunk_words: int = CHUNK_WORDS, hot_share: float = HOT_SHARE) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, a) of every frequent phrase, single words included, and (lang, n), the words of each language."""
    chunks = encoded(documents, chunk_words, hot_share)
    totals = chunks.groupBy("lang").agg(F.sum("n").alias("n"))
    listed = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).filter("x.counts > 0").groupBy("lang", F.col("x.words").alias("phrase")).agg(F.sum("x.counts").alias("a"))
    words = staged(listed.filter(F.col("a") >= least), "frequent-words")
    total = chunks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    busy = chunks.select("lang", F.explode("hot").alias("x")).groupBy("lang", "x.w1", "x.w2", "x.w3").agg(F.sum("x.n").alias("n")).filter(F.col("n") >= max(2.0, hot_share * total)).collect()
    hot: dict[str, set[tuple[str, ...]]] = {}
    for r in busy:
        hot.setdefault(r["lang"], set()).add(tuple(r[w] for w in ("w1", "w2", "w3") if r[w] is not None))
    longer = staged(counted(suffixes(chunks, words, hot, least), least), "frequent-phrases")
    return words.select("lang", "phrase", F.lit(1).alias("words"), "a").union(longer), totals


def collocations(documents: DataFrame, best: int = BEST, least: int = LEAST, covered: tuple[int, int] = COVERED, chunk_words: int = CHUNK_WORDS, hot_share: float = HOT_SHARE) -> DataFrame:
    """documents(text, lang): lang, rank, phrase, a, l, r, n, score of each language's best phrases."""
    counts, totals = phrases(documents, least, chunk_words, hot_share)
    asked = counts.filter("words > 1")
    part, whole = covered
    split = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("words") - k + 1), lambda i: F.array_join(F.slice(split, i, k), " "))))
    cover = asked.filter("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = asked.join(cover, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") * whole < F.col("a") * part)).drop("longer")
    cuts = kept.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", F.array_join(F.slice(split, F.lit(1), F.col("k")), " ").alias("first"), F.array_join(F.slice(split, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
    of = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("a").alias(n))
    sides = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    scored = sides.withColumn("score", F.expr("(CAST(2000000 AS DECIMAL(38, 0)) * CAST(a AS DECIMAL(19, 0))) DIV CAST(l + r AS DECIMAL(20, 0))").cast("long"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = weakest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


#: The same rows, by counting every phrase.
SQL = r"""
WITH pieces AS (SELECT row_number() OVER () AS p, lang, piece FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents) q),
listed AS (SELECT p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed WHERE len(w) > 0),
runs AS (SELECT lang, list_aggregate(w[i : i + k - 1], 'string_agg', ' ') AS phrase, k FROM starts CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS k) z WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, phrase, k, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
inside AS (SELECT lang, phrase AS longer, a, string_split(phrase, ' ') AS s, k FROM f WHERE k > 2),
cover AS (SELECT lang, list_aggregate(s[i : i + m - 1], 'string_agg', ' ') AS phrase, max(a) AS longer FROM inside CROSS JOIN (SELECT unnest([1, 2, 3]) AS i) x CROSS JOIN (SELECT unnest([2, 3]) AS m) y WHERE m < k AND i + m - 1 <= k GROUP BY 1, 2),
kept AS (SELECT f.lang, f.phrase, f.k, f.a, string_split(f.phrase, ' ') AS s FROM f LEFT JOIN cover USING (lang, phrase) WHERE f.k > 1 AND (longer IS NULL OR 100 * longer < 80 * f.a)),
cuts AS (SELECT lang, phrase, a, c, list_aggregate(s[1 : c], 'string_agg', ' ') AS head, list_aggregate(s[c + 1 : k], 'string_agg', ' ') AS rest FROM kept CROSS JOIN (SELECT unnest([1, 2, 3]) AS c) z WHERE c < k),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, c, lf.a AS l, rf.a AS r, CAST((CAST(2000000 AS HUGEINT) * cuts.a) // (lf.a + rf.a) AS BIGINT) AS score FROM cuts JOIN f lf ON lf.lang = cuts.lang AND lf.phrase = cuts.head JOIN f rf ON rf.lang = cuts.lang AND rf.phrase = cuts.rest),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest) q JOIN totals USING (lang) WHERE rank <= 2000
"""
