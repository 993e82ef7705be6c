"""Ranked lexical search by K2-treaps over grids of terms and documents.

Each chunk of documents is a grid: a row for each term, in the order of the terms' hashes, a column for each document, in the order of doc_id, and
in a cell the term's impact there, (1e9 tf) div (1000 tf + 8 m). The grid is cut into quarters again and again; of a quadtree's cells only those
that hold something are kept, level by level, as one bit for each quarter and the amount by which its largest impact falls below its parent's.
As there are more terms than documents, the first levels halve the rows alone, and the last LEAN ones the columns alone, so that the cells in
between are wide in documents and narrow in terms. A chunk's treap, its terms, their document counts and its ids are one row of the index, which
is written once and serves any queries.

A query's terms walk down the treap together. An entry of the search is a range of documents with the cell of each term that covers it; the
weighted sum of the cells' maxima bounds every score in the range. The entries of the highest bound are halved first, many at a time; those
whose bound doesn't reach the best scores found so far, or reaches them only with larger ids, are left. A range of one document has its exact score.
A task carries an item's best scores from one chunk to the next; the best of all tasks are the result.

Weights and lengths are those of the whole table: one pass counts terms, one builds the index, one sums the queries' document counts. Queries go
in blocks of a bounded number of characters, a pass over the index for each.

Defined results: terms are told by 64-bit hashes. A null text has no terms, and a document without any takes no part. Rows with a null doc_id are
documents like others, after all ids where scores are equal; repeated rows are documents of their own. Rows of one item_id (null ones too) are one
item with the terms of all of them; items without terms and tables without rows give no rows. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.storage import staged

BEST = 10
#: Postings of a chunk, about; a document is never cut.
CHUNK_POSTINGS = 1_000_000
#: Last levels that halve the columns alone; entries that are halved at a time.
LEAN = 4
AT_A_TIME = 128
#: Characters of queries that go to every task at once.
BLOCK_CHARS = 1_000_000
#: Stands for a null id within a chunk.
NO_ID = (1 << 63) - 1
INDEX = "ids array<bigint>, terms binary, counts binary, peak int, row_bits int, column_bits int, cells array<binary>, drops array<binary>"
#: Term characters: digits, letters in either case as small ones, and all beyond ASCII; the rest separates.
_FOLDED = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLDED).split()


def levels_of(row_bits: int, column_bits: int) -> list[str]:
    """What each level halves: rows, both or columns."""
    both = min(row_bits, max(column_bits - LEAN, 0))
    return ["rows"] * (row_bits - both) + ["both"] * both + ["columns"] * (column_bits - both)


def grown(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, row_bits: int, column_bits: int) -> tuple[int, list[bytes], list[bytes]]:
    """The treap over cells (row, column) that hold an impact: its peak, and from the top level down the bits of the cells kept and by how much
    the maximum of each falls below its parent's."""
    kinds = levels_of(row_bits, column_bits)
    code, r, c = np.zeros(len(rows), dtype=np.uint64), row_bits, column_bits
    for kind in kinds:
        if kind != "columns":
            r -= 1
            code = (code << np.uint64(1)) | ((rows >> r) & 1).astype(np.uint64)
        if kind != "rows":
            c -= 1
            code = (code << np.uint64(1)) | ((columns >> c) & 1).astype(np.uint64)
    order = np.argsort(code, kind="stable")
    code, most = code[order], impacts[order].astype(np.int32)
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    code, most = code[first], np.maximum.reduceat(most, first)
    cells, drops = [], []
    for kind in reversed(kinds):
        bits = 2 if kind == "both" else 1
        parent = code >> np.uint64(bits)
        new = np.concatenate([[True], parent[1:] != parent[:-1]])
        first = np.flatnonzero(new)
        above, place = np.maximum.reduceat(most, first), np.cumsum(new) - 1
        present = np.zeros(len(first) << bits, dtype=bool)
        present[(place << bits) + (code & np.uint64((1 << bits) - 1)).astype(np.int64)] = True
        cells.append(np.packbits(present).tobytes())
        drops.append((above[place] - most).astype("<i4").tobytes())
        code, most = parent[first], above
    return int(most[0]), cells[::-1], drops[::-1]


class Treap:
    """A row of the index, unpacked: for each level the numbers of every cell's parts on the next level, and the maxima of the cells there. The
    number behind a level's last cell is that of no cell; its maximum is 0."""

    def __init__(self, row: dict) -> None:
        unpack = zstandard.ZstdDecompressor().decompress
        self.row_bits, self.column_bits = row["row_bits"], row["column_bits"]
        self.kinds = levels_of(self.row_bits, self.column_bits)
        self.ids = np.array([NO_ID if i is None else i for i in row["ids"]], dtype=np.int64)
        self.terms = np.frombuffer(row["terms"], dtype="<u8")
        self.parts, self.most = [], [np.array([row["peak"], 0], dtype=np.int64)]
        for kind, packed, drop in zip(self.kinds, row["cells"], row["drops"], strict=True):
            n, width = len(self.most[-1]) - 1, 4 if kind == "both" else 2
            present = np.unpackbits(np.frombuffer(unpack(packed), dtype=np.uint8), count=n * width).astype(bool)
            held = np.flatnonzero(present)
            part = np.full((n + 1) * width, len(held), dtype=np.int32)
            part[held] = np.arange(len(held), dtype=np.int32)
            self.parts.append(part)
            self.most.append(np.append(self.most[-1][held // width] - np.frombuffer(unpack(drop), dtype="<i4"), 0))

    def best(self, hashes: np.ndarray, weights: np.ndarray, k: int, held: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The k best of held and this chunk's documents as (score, id), highest first, equal ones by id."""
        rows = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        there = self.terms[rows] == hashes
        rows, weights = rows[there], weights[there]
        if not len(rows):
            return held
        nodes, left, level = np.zeros((1, len(rows)), dtype=np.int64), self.row_bits, 0
        while level < len(self.kinds) and self.kinds[level] == "rows":
            left -= 1
            nodes = self.parts[level][nodes * 2 + ((rows >> left) & 1)].astype(np.int64)
            level += 1
        top, end = level, len(self.kinds)
        bits = {}
        for i in range(top, end):
            left -= self.kinds[i] == "both"
            bits[i] = ((rows >> left) & 1) * 2 if self.kinds[i] == "both" else np.int64(0)
        front = {top: (self.most[top][nodes] @ weights, np.zeros(1, dtype=np.int64), nodes)}
        if top == end:  # a chunk of one document
            return sorted([*held, (int(front[top][0][0]), int(self.ids[0]))], key=lambda x: (-x[0], x[1]))[:k]
        least = held[-1] if len(held) == k else (1, NO_ID)
        while front:
            level = max(front, key=lambda i: front[i][0].max())
            bound, column, nodes = front.pop(level)
            reach = (bound > least[0]) | ((bound == least[0]) & (self.ids[np.minimum(column << (end - level), len(self.ids) - 1)] <= least[1]))
            if not reach.all():
                bound, column, nodes = bound[reach], column[reach], nodes[reach]
            if not len(bound):
                continue
            if len(bound) > AT_A_TIME:
                order = np.lexsort((column, -bound))
                later = order[AT_A_TIME:]
                front[level] = bound[later], column[later], nodes[later]
                column, nodes = column[order[:AT_A_TIME]], nodes[order[:AT_A_TIME]]
            base = nodes * (4 if self.kinds[level] == "both" else 2) + bits[level]
            parts = self.parts[level][np.stack([base, base + 1], axis=1).reshape(-1, base.shape[1])].astype(np.int64)
            column = (np.repeat(column * 2, 2).reshape(-1, 2) + (0, 1)).ravel()
            bound = self.most[level + 1][parts] @ weights
            some = bound >= least[0]
            bound, column, parts = bound[some], column[some], parts[some]
            if level + 1 == end:
                ids = self.ids[column]
                order = np.lexsort((ids, -bound))[:k]
                held = sorted([*held, *zip(bound[order].tolist(), ids[order].tolist(), strict=True)], key=lambda x: (-x[0], x[1]))[:k]
                if len(held) == k:
                    least = held[-1]
            elif len(bound):
                more = front.get(level + 1)
                front[level + 1] = (bound, column, parts) if more is None else tuple(np.concatenate(x) for x in zip(more, (bound, column, parts), strict=True))
        return held


@dataclass(frozen=True)
class Index:
    """The written treaps, and what the weights need: documents with terms, and all their terms."""

    table: DataFrame
    documents: int
    terms: int


def length_weight(n: int, documents: int, terms: int) -> int:
    """A document's m: how much its length damps its impacts."""
    return 100 - 90 + (90 * n * documents) // terms


def build(documents: DataFrame, chunk_postings: int = CHUNK_POSTINGS) -> Index:
    """documents(doc_id, text): the index over every row with a term."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [n for n in (len(terms_of(t.as_py())) for t in batch.column(0)) if n]
            yield pa.RecordBatch.from_pydict({"documents": pa.array([len(found)], pa.int64()), "terms": pa.array([sum(found)], pa.int64())})

    whole = documents.select("text").mapInArrow(lengths, "documents long, terms long").agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    count, total = whole

    def chunk(ids: list[int | None], sizes: list[int], postings: list[int], tfs: list[int], damps: list[int], vocabulary: dict[bytes, int]) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=3).compress
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        terms, row = np.unique(np.array([xxhash.xxh64_intdigest(t) for t in vocabulary], dtype=np.uint64), return_inverse=True)
        document, tf = np.repeat(np.arange(len(ids)), sizes), np.array(tfs, dtype=np.int64)
        rows, columns = row[np.array(postings, dtype=np.int64)], place[document]
        impacts = (1_000_000_000 * tf) // (1000 * tf + 8 * np.array(damps, dtype=np.int64)[document])
        shape = (len(terms) - 1).bit_length(), (len(ids) - 1).bit_length()
        peak, cells, drops = grown(rows, columns, impacts, *shape)
        made = [pa.array([[ids[i] for i in order]], pa.list_(pa.int64())), pa.array([terms.astype("<u8").tobytes()], pa.binary()), pa.array([np.bincount(rows, minlength=len(terms)).astype("<i4").tobytes()], pa.binary())]
        made += [pa.array([v], pa.int32()) for v in (peak, *shape)] + [pa.array([[pack(x) for x in part]], pa.list_(pa.binary())) for part in (cells, drops)]
        return pa.RecordBatch.from_arrays(made, names=["ids", "terms", "counts", "peak", "row_bits", "column_bits", "cells", "drops"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh():
            vocabulary: dict[bytes, int] = defaultdict()
            vocabulary.default_factory = vocabulary.__len__
            return [], [], [], [], [], vocabulary

        ids, sizes, postings, tfs, damps, vocabulary = fresh()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                counts = Counter(words)
                ids.append(doc_id.as_py())
                sizes.append(len(counts))
                postings.extend(map(vocabulary.__getitem__, counts))
                tfs.extend(counts.values())
                damps.append(length_weight(len(words), count, total))
                if len(postings) >= chunk_postings:
                    yield chunk(ids, sizes, postings, tfs, damps, vocabulary)
                    ids, sizes, postings, tfs, damps, vocabulary = fresh()
        if ids:
            yield chunk(ids, sizes, postings, tfs, damps, vocabulary)

    return Index(staged(documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(chunks, INDEX), "treaps"), count, total)


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, list[int]]]]:
    """Items and the hashes of their terms in blocks of so many characters, an iterator over partitions."""
    block, chars = [], 0
    for row in items.groupBy("item_id").agg(F.array_join(F.collect_set("text"), "\n").alias("text")).toLocalIterator():
        terms = sorted({xxhash.xxh64_intdigest(t) for t in terms_of(row["text"])})
        if terms:
            if block and chars + len(row["text"]) > block_chars:
                yield block
                block, chars = [], 0
            block.append((row["item_id"], terms))
            chars += len(row["text"])
    if block:
        yield block


def term_weights(index: Index, hashes: list[int]) -> dict[int, int]:
    """The weight of each of these terms that some document holds: one pass over the index's terms and counts."""
    asked = index.table.sparkSession.sparkContext.broadcast(np.array(hashes, dtype=np.uint64))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, counts in zip(batch.column(0), batch.column(1), strict=True):
                known, n = np.frombuffer(terms.as_py(), dtype="<u8"), np.frombuffer(counts.as_py(), dtype="<i4")
                rows = np.minimum(np.searchsorted(known, asked.value), len(known) - 1)
                there = known[rows] == asked.value
                yield pa.RecordBatch.from_pydict({"place": pa.array(np.flatnonzero(there), pa.int32()), "df": pa.array(n[rows[there]].astype(np.int64))})

    found = index.table.select("terms", "counts").mapInArrow(counted, "place int, df long").groupBy("place").agg(F.sum("df").alias("df")).collect()  # a row a term of the block
    return {hashes[r["place"]]: math.floor(1000 * math.log((2 * index.documents + 2) / (2 * r["df"] + 1))) for r in found}


def search(index: Index, items: DataFrame, k: int = BEST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """items(item_id, text): item_id, rank, doc_id, score of each item's k best documents of a score above 0."""
    spark, parts = index.table.sparkSession, []
    for block in item_blocks(items, block_chars):
        weights = term_weights(index, sorted({h for _, terms in block for h in terms}))
        asked = [(item, np.array(known, dtype=np.uint64), np.array([weights[h] for h in known], dtype=np.int64)) for item, terms in block if (known := [h for h in terms if weights.get(h, 0) > 0])]
        shared = spark.sparkContext.broadcast(asked)

        def searched(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held: list[list[tuple[int, int]]] = [[] for _ in shared.value]
            for batch in batches:
                for i in range(batch.num_rows):
                    treap = Treap(batch.slice(i, 1).to_pylist()[0])
                    for j, (_, hashes, w) in enumerate(shared.value):
                        held[j] = treap.best(hashes, w, k, held[j])
            rows = [(item, None if doc_id == NO_ID else doc_id, score) for (item, _, _), found in zip(shared.value, held, strict=True) for score, doc_id in found]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["item_id", "doc_id", "score"])

        parts.append(index.table.mapInArrow(searched, "item_id long, doc_id long, score long"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


#: The same rows, by scoring every document that holds one of an item's terms.
SQL = r"""
WITH words AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
lengths AS (SELECT d, doc_id, w, len(w) AS n FROM words WHERE len(w) > 0),
whole AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM lengths),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
held AS (SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(w) AS t FROM lengths) u WHERE t IN (SELECT t FROM asked) GROUP BY d, t),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * nd + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM held CROSS JOIN whole GROUP BY t, nd),
scored AS (SELECT item_id, d, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * nd) // nt))))) AS BIGINT) AS score
  FROM asked JOIN held USING (t) JOIN weights USING (t) JOIN lengths USING (d) CROSS JOIN whole GROUP BY item_id, d)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored JOIN lengths USING (d) WHERE score > 0) q WHERE rank <= 10
"""
