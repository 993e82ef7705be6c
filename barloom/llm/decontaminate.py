"""Benchmark decontamination by the q-gram lemma.

Texts and items are compared in lower case without white space. An item of m characters that occurs with at most k edits
shares at least m - q + 1 - k q of its q-grams with the place, all on diagonals (text place minus item place) that differ by at most k.
Shared q-grams are counted in diagonal bands of width 2 w that overlap by half, w > k, so every such occurrence lies whole in one band;
bands that reach the bound give regions, and banded alignment finds each region's smallest edit distance. Nothing within the budget
is missed, and nothing beyond it is reported.

Items shorter than a q-gram can't be found by the lemma: they have no edits to spend and are looked up unchanged, as whole words.

Defined results: null and empty texts hold nothing; null and empty items match nothing. Rows with a null doc_id or item_id are examined and
reported like any other; repeated rows are reported once each. An item that occurs several times in a text gives one row with its best place,
the first of equal ones. Further columns are ignored. Memory and time grow with a text's length, however repetitive text and items are.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

#: Characters of a q-gram; the share of an item's characters that may be edited.
Q = 12
EDIT_SHARE = 0.05
#: Bands that are aligned together.
ALIGNED = 4096
#: Characters of items that are matched in one pass over the documents: what a task holds, whatever the benchmark's size.
BLOCK_CHARS = 4_000_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
FOUND = "doc_id long, item_id long, start long, end long, edits int, similarity double"


def normalised(text: str | None) -> str:
    return "".join((text or "").lower().split())


def budget(chars: int, share: float = EDIT_SHARE, q: int = Q) -> int:
    """Edits allowed in an item: its share, as far as the lemma still asks for a shared q-gram."""
    return max(0, min(int(chars * share), (chars - q) // q))


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def gram_hashes(points: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of each q-gram, by doubling: a hash of two halves is made of theirs."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    h, width, done, at = points.astype(np.uint64) + np.uint64(1), 1, None, 0
    while width <= q:
        if q & width:  # this power of two is part of q
            part = h[at : len(points) - q + 1 + at]
            done = part.copy() if done is None else (done * _MULTIPLIER + part) ^ (done >> np.uint64(29))
            at += width
        if 2 * width <= q:
            h = (h[:-width] * _MULTIPLIER + h[width:]) ^ (h[:-width] >> np.uint64(31))
        width *= 2
    return done


class Index:
    """The q-grams of a block of items (id, text)."""

    def __init__(self, items: list[tuple[int | None, str]], share: float = EDIT_SHARE, q: int = Q):
        self.q = q
        self.ids = [i for i, _ in items]
        self.texts = [normalised(t) for _, t in items]
        self.points = [points_of(t) for t in self.texts]
        self.lengths = np.array([len(p) for p in self.points], dtype=np.int64)
        self.budgets = np.array([budget(n, share, q) for n in self.lengths], dtype=np.int64)
        self.bound = self.lengths - q + 1 - self.budgets * q
        grams = [gram_hashes(p, q) for p in self.points]
        keys = np.concatenate([*grams, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, np.int64)])
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner, self.place = keys[order], owner[order], place[order]
        self.bits = max(16, int(len(keys)).bit_length() + 5)
        self.marks = np.zeros(1 << self.bits, dtype=bool)
        self.marks[self.slots(keys)] = True
        self.short = None
        for i, (_, text) in enumerate(items):
            if 0 < self.lengths[i] < q:
                self.short = self.short or ahocorasick.Automaton()
                words = " ".join(text.lower().split())
                self.short.add_word(words, (words, [*self.short.get(words, (words, []))[1], i]))
        if self.short is not None:
            self.short.make_automaton()

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.intp)

    def regions(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(item, diagonals of the middles of its bands with enough shared q-grams), for the items that have such bands.

        A place of an item is shared in all bands that its q-gram's places in the text reach. Places of one q-gram at most two half bands apart
        reach bands without a gap, so each run of them is one interval of bands, however often the q-gram is repeated, and bands are counted
        from the ends of intervals."""
        hashes = gram_hashes(points, self.q)
        at = np.flatnonzero(self.marks[self.slots(hashes)])
        if not len(at):
            return
        at = at[np.argsort(hashes[at], kind="stable")]
        found = hashes[at]
        first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        last = np.append(first[1:], len(at))  # the text's places of each q-gram: at[first:last], rising
        low, high = np.searchsorted(self.keys, found[first], "left"), np.searchsorted(self.keys, found[first], "right")
        times = high - low
        if not times.any():
            return
        gram = np.repeat(np.arange(len(first)), times)
        entry = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        shared = np.bincount(self.owner[entry], minlength=len(self.ids))
        wanted = np.flatnonzero(shared >= np.maximum(self.bound, 1))
        held = np.isin(self.owner[entry], wanted)
        gram, entry = gram[held], entry[held]
        order = np.argsort(self.owner[entry], kind="stable")
        gram, entry = gram[order], entry[order]
        for item in wanted:
            part = slice(*np.searchsorted(self.owner[entry], [item, item + 1]))
            wide = int(self.budgets[item]) + 1
            own, which = np.unique(gram[part], return_inverse=True)
            size = last[own] - first[own]
            places = at[np.repeat(first[own], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
            starts = np.concatenate(([True], places[1:] - places[:-1] > 2 * wide))
            starts[np.cumsum(size)[:-1]] = True
            runs = np.flatnonzero(starts)
            ends = np.append(runs[1:], len(places)) - 1
            run_of = np.searchsorted(runs, np.concatenate(([0], np.cumsum(size))))  # the runs of each q-gram
            n = (run_of[1:] - run_of[:-1])[which]
            run = np.repeat(run_of[which], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            place = np.repeat(self.place[entry[part]], n)
            begin, end = np.floor_divide(places[runs[run]] - place, wide) - 1, np.floor_divide(places[ends[run]] - place, wide) + 1
            edges, back = np.unique(np.concatenate([begin, end]), return_inverse=True)
            step = np.bincount(back, np.repeat([1, -1], len(begin)), len(edges)).cumsum()
            enough = np.flatnonzero(step >= max(int(self.bound[item]), 1))
            bands = [np.arange(edges[i], edges[i + 1]) for i in enough]
            if bands:
                yield int(item), (np.concatenate(bands) + 1) * wide

    def aligned(self, points: np.ndarray, item: int, diagonals: np.ndarray) -> tuple[int, int, int] | None:
        """The best (edits, start, end) of the item on diagonals within one half band of a middle and the budget beyond, if within the budget.
        Bands are aligned ALIGNED at a time, a character of the item a step; bands without hope are left out on the way."""
        most, best = int(self.budgets[item]), None
        for some in range(0, len(diagonals), ALIGNED):
            found = self._aligned_some(points, self.points[item], diagonals[some : some + ALIGNED, None], most)
            if found and (best is None or found < best):
                best = found
        return best

    def _aligned_some(self, points: np.ndarray, pattern: np.ndarray, middles: np.ndarray, most: int) -> tuple[int, int, int] | None:
        reach = 2 * most + 1
        slope = np.arange(2 * reach + 1)
        offsets = middles - reach + slope
        far = np.int64(1 << 30)
        cost, start = np.where((offsets >= 0) & (offsets <= len(points)), np.int64(0), far), offsets.copy()
        gap = np.full((len(offsets), 1), far)
        for j in range(len(pattern)):
            ends = offsets + j  # the text character that a match on this diagonal uses
            here = (ends >= 0) & (ends < len(points))
            same = here & (points[np.clip(ends, 0, max(len(points) - 1, 0))] == pattern[j])
            step = np.where(here, cost + ~same, far)
            drop = np.hstack([cost[:, 1:] + 1, gap])  # the item's character is missing in the text
            new_cost, new_start = np.where(drop < step, drop, step), np.where(drop < step, np.hstack([start[:, 1:], gap]), start)
            lifted = new_cost - slope  # extra characters in the text: a running minimum along the band
            low = np.minimum.accumulate(lifted, axis=1)
            source = np.maximum.accumulate(np.where(lifted == low, slope, 0), axis=1)
            cost, start = low + slope, np.take_along_axis(new_start, source, axis=1)
            cost = np.where((ends + 1 >= 0) & (ends + 1 <= len(points)), cost, far)
            hope = cost.min(axis=1) <= most
            if not hope.all():
                if not hope.any():
                    return None
                cost, start, offsets, gap = cost[hope], start[hope], offsets[hope], gap[hope]
        row, column = np.divmod(int(np.lexsort((start.ravel(), cost.ravel()))[0]), cost.shape[1])
        return (int(cost[row, column]), int(start[row, column]), int(offsets[row, column] + len(pattern))) if cost[row, column] <= most else None

    def short_ones(self, text: str, found: dict[int, tuple[int, int, int]]) -> None:
        """Items shorter than a q-gram stand unchanged as whole words: the first place of each."""
        if self.short is None:
            return
        spaced = " ".join(text.lower().split())
        for end, (plain, items) in self.short.iter(spaced):
            start = end + 1 - len(plain)
            if (start and spaced[start - 1].isalnum() and plain[0].isalnum()) or (end + 1 < len(spaced) and spaced[end + 1].isalnum() and plain[-1].isalnum()):
                continue
            if items[0] not in found:
                at = start - spaced.count(" ", 0, start)
                for item in items:
                    found[item] = (0, at, at + len(self.texts[item]))

    def search(self, text: str | None) -> dict[int, tuple[int, int, int]]:
        """The best (edits, start, end) of each item found, in characters of the normalised text."""
        plain, found = normalised(text), {}
        if not plain:
            return found
        points = points_of(plain)
        for item, diagonals in self.regions(points):
            if (at := plain.find(self.texts[item])) >= 0:  # whole, unchanged items need no alignment
                found[item] = (0, at, at + len(self.texts[item]))
            elif best := self.aligned(points, item, diagonals):
                found[item] = best
        self.short_ones(text, found)
        return found


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """The benchmark in blocks of a bounded number of characters, an iterator over partitions: the driver holds one block."""
    block, chars = [], 0
    for row in benchmark.select("item_id", "text").filter(F.col("text").isNotNull()).toLocalIterator():
        if size := len(normalised(row["text"])):
            if block and chars + size > block_chars:
                yield block
                block, chars = [], 0
            block.append((row["item_id"], row["text"]))
            chars += size
    if block:
        yield block


def _holds_any(block: Broadcast, share: float):
    """A Pandas UDF: does a text hold an item of the block?"""

    @F.pandas_udf(BooleanType())
    def holds(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(block.value, share)
        for batch in texts:
            yield pd.Series([bool(index.search(text)) for text in batch], dtype=bool)

    return holds


def clean(documents: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS, share: float = EDIT_SHARE) -> DataFrame:
    """The documents in whose texts no item is found, their rows and columns untouched. One pass for each block of items."""
    out = documents
    for block in item_blocks(benchmark, block_chars):
        out = out.filter(~_holds_any(documents.sparkSession.sparkContext.broadcast(block), share)("text"))
    return out


def contaminated(documents: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS, share: float = EDIT_SHARE) -> DataFrame:
    """documents(doc_id, text), benchmark(item_id, text): a row for each document and item found in it within the edit budget: start and
    end in characters of the normalised text, edits, and similarity = 1 - edits / item length. One pass over the documents for each
    block of items, no shuffle."""
    spark, parts = documents.sparkSession, []
    for block in item_blocks(benchmark, block_chars):
        shared = spark.sparkContext.broadcast(block)

        def searched(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = Index(shared.value, share)
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                    rows += [(doc_id, index.ids[i], s, e, k, 1 - k / int(index.lengths[i])) for i, (k, s, e) in index.search(text).items()]
                frame = pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "end", "edits", "similarity"])
                yield frame.astype({"doc_id": "Int64", "item_id": "Int64"})

        parts.append(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(searched, FOUND))
    if not parts:
        return spark.createDataFrame([], FOUND)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
