"""Approximate nearest neighbours by additive quantisation.

A vector is approximated by a sum of codewords, one from each of several full-dimensional codebooks. The codebooks are fitted on a bounded
sample: residual k-means, then least-squares updates of all codewords together. Every row is encoded by beam search over the codebooks once; its
codes, the norm of its approximation and its coarse cell are stored with it, sorted by cell. A query's inner products with all codewords form a
lookup table, so its squared distance to an approximation is |q|^2 - 2 sum(table[code]) + norm.

A search reads the index twice. The first pass scores the rows of the cells near a query by their codes alone and finds the query's
`shortlist`-th best score over the whole table; the second ranks every row at or under that score by its exact double-precision distance. So the
shortlist is one for the whole table, all rows tied with its last one are in it, and no result depends on how the rows are dealt out.

How many cells are near is chosen on the sample, so that they hold PROBED of its own true neighbours; vectors without clusters get all cells, and
so does a query whose near cells hold fewer than k candidates.
Rows are scored where they are read; what is shuffled is each task's best scores and best k of each query. Queries are a stated set, taken in
blocks of bounded size, two passes a block, whose results are added to one table.

Defined results: vectors that are null, zero, hold null or non-finite components, or have another length than most of the sample take no part,
neither as queries nor as candidates, nor do rows with a null vec_id. Ties go to the smaller vec_id. Of differing vectors of one vec_id the least
is its query. Repeated rows of one vec_id are candidates of their own; none is the candidate of a query with its vec_id. Fewer candidates than k
give fewer rows; an empty table none. Further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.storage import shared_dir, staged

#: Rows that codebooks and cells are fitted on: the first by hash of vec_id. Every row is indexed.
TRAINING_ROWS = 10_000
CODEBOOKS = 40
CODEWORDS = 64
BEAM = 4
#: Coarse cells; the share of the sample's true neighbours that the probed ones must hold; sampled rows that ask.
CELLS = 64
PROBED = 0.99
ASKING = 400
#: Rows of a query that get an exact distance, and all tied with the last of them.
SHORTLIST = 256
#: Rows and queries that are scored together, and queries of one search.
BLOCK_ROWS = 8192
SOME_QUERIES = 256
TILE = 192
QUERY_BLOCK = 4096
SEED = 7
RESULT = "query_id long, rank int, vec_id long, score double"


@dataclass
class Codebooks:
    """words[m, k]: the k-th codeword of the m-th codebook."""

    words: np.ndarray

    def encode(self, x: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """The codes of each row: the beam keeps the best partial sums by their distance to the row. Rows are padded to whole tiles of a
        matrix product, so a row's codes don't depend on its place and equal vectors get equal codes."""
        whole, (books, size, _) = len(x), self.words.shape
        x = np.vstack([x, np.zeros((-len(x) % TILE, x.shape[1]))])
        n = len(x)
        codes = np.zeros((n, 1, books), dtype=np.uint8)
        residual = x[:, None, :].astype(np.float32)
        for m in range(books):
            w = self.words[m].astype(np.float32)
            gain = (w * w).sum(1)[None, None, :] - 2 * residual @ w.T + (residual * residual).sum(2)[:, :, None]
            flat = gain.reshape(n, -1)
            keep = min(beam, flat.shape[1])
            best = np.argpartition(flat, keep - 1, axis=1)[:, :keep]
            parent, word = np.divmod(best, size)
            rows = np.arange(n)[:, None]
            codes = codes[rows, parent]
            codes[:, :, m] = word
            residual = residual[rows, parent] - w[word]
        return codes[np.arange(n), (residual * residual).sum(2).argmin(1)][:whole]

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return sum(self.words[m][codes[:, m]] for m in range(len(self.words)))


def nearest_centre(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1)[None, :] - 2 * x @ centres.T).argmin(1)


def sums_by(x: np.ndarray, label: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the labels, and the sum of the rows of each."""
    order, counts = np.argsort(label, kind="stable"), np.bincount(label, minlength=size)
    used, out = np.flatnonzero(counts), np.zeros((size, x.shape[1]))
    out[used] = np.add.reduceat(x[order].astype(np.float64), (np.cumsum(counts) - counts)[used], axis=0)
    return counts, out


def k_means(x: np.ndarray, size: int, rng: np.random.Generator, rounds: int = 4) -> np.ndarray:
    x = x.astype(np.float32)
    centres = x[rng.choice(len(x), size=size, replace=len(x) < size)]
    for _ in range(rounds):
        counts, sums = sums_by(x, nearest_centre(x, centres), size)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres).astype(np.float32)
    return centres


def fit(x: np.ndarray, books: int = CODEBOOKS, size: int = CODEWORDS, rounds: int = 1) -> Codebooks:
    """Residual k-means, then a round of encoding and a joint least-squares update of all codewords."""
    size = min(size, len(x))
    rng, residual, words = np.random.default_rng(SEED), x.astype(np.float64).copy(), np.zeros((books, size, x.shape[1]))
    for m in range(books):
        words[m] = k_means(residual, size, rng)
        residual -= words[m][nearest_centre(residual, words[m])]
    book = Codebooks(words)
    for _ in range(rounds):
        codes = book.encode(x)
        place = codes.astype(np.int64) + np.arange(books) * size
        normal, right = 1e-2 * np.eye(books * size), 1e-2 * book.words.reshape(books * size, -1)
        for m in range(books):  # how often two codewords are used together, and the sum of the rows that use one
            here = slice(m * size, (m + 1) * size)
            normal[here] += np.bincount(((place[:, m, None] - m * size) * books * size + place).ravel(), minlength=size * books * size).reshape(size, -1)
            right[here] += sums_by(x, codes[:, m], size)[1]
        book = Codebooks(np.linalg.solve(normal, right).reshape(books, size, -1))
    return book


def cells_by_distance(q: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argsort((centres * centres).sum(1)[None, :] - 2 * q @ centres.T, axis=1, kind="stable")


def fit_cells(x: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Centres of coarse cells, and how many of a query's nearest cells hold PROBED of its k nearest in the sample."""
    rng = np.random.default_rng(SEED)
    centres = k_means(x.astype(np.float64), min(CELLS, len(x)), rng)
    asking = rng.choice(len(x), size=min(ASKING, len(x)), replace=False)
    away = (x * x).sum(1)[None, :] - 2 * x[asking] @ x.T
    away[np.arange(len(asking)), asking] = np.inf
    near = np.argsort(away, axis=1)[:, : min(k, len(x) - 1)]
    order = cells_by_distance(x[asking], centres)
    place = np.argsort(order, axis=1)  # the rank of each cell for each query
    ranks = np.sort(np.take_along_axis(place, nearest_centre(x, centres)[near], axis=1).ravel())
    return centres, int(ranks[min(len(ranks) - 1, int(np.ceil(PROBED * len(ranks))))]) + 1 if len(ranks) else len(centres)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v of the rows that take part, their length aside."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    held = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return held.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).filter(fine)


def indexed(rows: DataFrame, book: Codebooks, centres: np.ndarray, width: int) -> DataFrame:
    """rows(vec_id, v) of this width with their cell, codes (a byte each) and norm, written once; sorted by cell, a full cell being split."""
    shared = rows.sparkSession.sparkContext.broadcast((book, centres))

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book, centres = shared.value
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[at : at + BLOCK_ROWS]
                x = np.stack(part["v"].to_numpy()).astype(np.float64)
                codes = book.encode(x)
                norms = (book.decode(codes) ** 2).sum(1).astype(np.float32)
                yield pd.DataFrame({"vec_id": part["vec_id"].to_numpy(), "v": part["v"].to_numpy(), "cell": nearest_centre(x, centres).astype(np.int32), "codes": [c.tobytes() for c in codes], "norm": norms})

    index = rows.filter(F.size("v") == width).mapInPandas(encoded, "vec_id long, v array<double>, cell int, codes binary, norm float")
    return staged(index.repartitionByRange("cell", F.xxhash64("vec_id")).sortWithinPartitions("cell"), "vector-index")


class Search:
    """A block of queries: their ids, vectors, lookup tables and near cells; what a task needs to score rows."""

    def __init__(self, book: Codebooks, centres: np.ndarray, probes: int, ids: np.ndarray, q: np.ndarray):
        self.ids, self.q = ids, q
        self.table = np.einsum("qd,mkd->mkq", q, book.words).astype(np.float32)
        near = cells_by_distance(q, centres)[:, :probes]
        self.asked = np.zeros((len(centres), len(ids)), dtype=bool)  # by cell and query
        self.asked[near.ravel(), np.repeat(np.arange(len(ids)), near.shape[1])] = True

    def scores(self, batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows of the batch, queries, their scores): a cell's rows with the queries that ask for it; a query's own rows score infinity."""
        cells, own = batch["cell"].to_numpy(), batch["vec_id"].to_numpy()
        for cell in np.unique(cells):
            asking = np.flatnonzero(self.asked[cell])
            mine = np.flatnonzero(cells == cell)
            for at in range(0, len(mine), BLOCK_ROWS):
                rows = mine[at : at + BLOCK_ROWS]
                codes = np.frombuffer(b"".join(batch["codes"].iloc[rows]), dtype=np.uint8).reshape(len(rows), -1)
                norms = batch["norm"].to_numpy()[rows]
                for some in range(0, len(asking), SOME_QUERIES):
                    these = asking[some : some + SOME_QUERIES]
                    score = np.zeros((len(rows), len(these)), dtype=np.float32)
                    for m in range(codes.shape[1]):
                        score += self.table[m][:, these][codes[:, m]]
                    score = norms[:, None] - 2 * score
                    score[own[rows][:, None] == self.ids[None, these]] = np.inf
                    yield rows, these, score


def _bounds(index: DataFrame, search, shortlist: int) -> dict[int, tuple[int, float]]:
    """How many rows each query has scored, up to the shortlist, and the shortlist-th best score over all of them."""

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.full((len(search.value.ids), 0), np.inf, dtype=np.float32)
        for batch in batches:
            found = np.full((len(held), shortlist), np.inf, dtype=np.float32)
            found[:, : held.shape[1]] = held
            for _, these, score in search.value.scores(batch):
                both = np.hstack([found[these], score.T])
                found[these] = np.partition(both, shortlist - 1, axis=1)[:, :shortlist]
            held = found
        found = np.flatnonzero(np.isfinite(held).any(axis=1))
        if len(found):
            yield pd.DataFrame({"q": found, "best": [held[i][np.isfinite(held[i])].astype(float) for i in found]})

    scored = index.select("vec_id", "cell", "codes", "norm").mapInPandas(best, "q long, best array<double>")
    lists = scored.groupBy("q").agg(F.array_sort(F.flatten(F.collect_list("best"))).alias("best"))
    bound = F.coalesce(F.get("best", F.lit(shortlist - 1)), F.lit(float("inf")))
    return {r["q"]: (r["n"], r["bound"]) for r in lists.select("q", F.least(F.size("best"), F.lit(shortlist)).alias("n"), bound.alias("bound")).collect()}  # two numbers for each query of the block


def _search_block(index: DataFrame, search: Search, k: int, shortlist: int) -> DataFrame:
    context = index.sparkSession.sparkContext
    shared = context.broadcast(search)
    held = _bounds(index, shared, shortlist)
    few = [i for i in range(len(search.ids)) if held.get(i, (0, 0.0))[0] < k]
    if few and not search.asked[:, few].all():  # their cells hold too little: they ask for all of them
        every = search.asked.copy()
        search.asked[:] = False
        search.asked[:, few] = True
        held |= _bounds(index, context.broadcast(search), shortlist)
        search.asked |= every
        shared = context.broadcast(search)
    bounds = context.broadcast(np.array([held.get(i, (0, -np.inf))[1] for i in range(len(search.ids))]))

    def ranked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s, best = shared.value, {}
        for batch in batches:
            own = batch["vec_id"].to_numpy()
            for rows, these, score in s.scores(batch):
                near = (score <= bounds.value[these]) & np.isfinite(score)
                for c in np.flatnonzero(near.any(axis=0)):
                    at = rows[np.flatnonzero(near[:, c])]
                    far = np.sqrt(((np.stack(batch["v"].iloc[at].to_numpy()) - s.q[these[c]]) ** 2).sum(1))
                    d, i = best.get(these[c], (far[:0], own[:0]))
                    d, i = np.append(d, far), np.append(i, own[at])
                    first = np.lexsort((i, d))[:k]
                    best[these[c]] = d[first], i[first]
        for q, (d, i) in best.items():
            yield pd.DataFrame({"query_id": s.ids[q], "vec_id": i, "score": d})

    found = index.mapInPandas(ranked, "query_id long, vec_id long, score double")
    placed = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return placed.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query_blocks(rows: DataFrame, every: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The queries' ids and vectors, so many at a time."""
    ids, block = [], []
    for row in rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")).toLocalIterator():
        ids.append(row["vec_id"])
        block.append(row["v"])
        if len(ids) == size:
            yield np.array(ids, dtype=np.int64), np.array(block)
            ids, block = [], []
    if ids:
        yield np.array(ids, dtype=np.int64), np.array(block)


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, shortlist: int = SHORTLIST, training_rows: int = TRAINING_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """vectors(vec_id, embedding): for each row whose vec_id is divisible by `every`, its k nearest others, (query_id, rank, vec_id, score)."""
    spark: SparkSession = vectors.sparkSession
    rows = usable(vectors)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(training_rows).select("v").collect()
    if not sample:
        return spark.createDataFrame([], RESULT)
    lengths = [len(r["v"]) for r in sample]
    width = max(sorted(set(lengths)), key=lengths.count)
    x = np.array([r["v"] for r in sample if len(r["v"]) == width])
    book, (centres, probes) = fit(x), fit_cells(x, k)
    index = indexed(rows, book, centres, width)
    out, none = f"{shared_dir(spark)}/nearest-{uuid.uuid4().hex}", True
    for ids, block in query_blocks(index, every, query_block):
        _search_block(index, Search(book, centres, probes, ids, block), k, max(shortlist, k)).write.mode("append").parquet(out)
        none = False
    return spark.createDataFrame([], RESULT) if none else spark.read.schema(RESULT).parquet(out)
