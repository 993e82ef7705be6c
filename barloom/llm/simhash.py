"""Near-duplicate detection: 64-bit SimHash fingerprints, linked through a segment-popcount embedding.

A fingerprint's segments are mapped to their counts of one bits. Two fingerprints that differ in d bits have count vectors whose
Manhattan distance is at most d, so that distance is a lower bound, and the range join under it loses no link. The range join
runs on the integer grid: two grid points at most two apart share a point that is at most one step from each, so every
fingerprint is put into its own cell and the cells one step away, equal cells meet, and the bits are compared exactly. What lies in full cells is
embedded anew with smaller segments.

Fingerprints of 64 bits can't surely tell texts of a similarity of 0.8 (they differ in some ten bits) from others. So representatives(), which
has to link all of those, compares what this range join links, then the sets that this leaves apart (see jaccard): the same embedding of
the shingle sets themselves, counts of a set's hashes in segments of the hash space, bounds the shingles that two sets don't share.

Defined results: a null text has no words, as an empty one; no words give fingerprint zero, which links like any other. Rows with a
null doc_id are fingerprinted and link, but are never the smallest id; a group without any id has a null component_id. Repeated
rows keep one output row each. Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from barloom.llm import jaccard
from barloom.llm.graph import connected_components
from barloom.llm.storage import staged

SHINGLE_WORDS = 3
SEED = 42
#: Bits of a segment, coarse first. 16 segments of 4 bits give about 1e9 even cells, 32 of 2 bits some 1e15.
SEGMENT_BITS = (4, 2)
#: Cells with more fingerprints than this are embedded with the next smaller segments, at last linked by exact one-bit variants instead of by pairs.
CELL_ROWS = 64

_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_SLOT = np.arange(8, dtype=np.intp) * 256


def fingerprint_of(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The fingerprint as a signed 64-bit number. A-Z are lowered, words are runs without ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(b" ".join(s), SEED) for s in shingles], dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of these 64-bit hashes, as a signed number; 0 of none."""
    counts = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _BYTE_SLOT).ravel(), minlength=2048).reshape(8, 256) @ _BIT_OF_BYTE
    return int(np.packbits((counts.ravel() * 2 > len(hashes)).astype(np.uint8), bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([fingerprint_of(t) for t in batch], dtype="int64")


def popcount_cells(fp: str, segment_bits: int = SEGMENT_BITS[0]) -> Column:
    """An array of packed cells: the fingerprint's own and those one step away on the grid of segment counts."""
    width = segment_bits.bit_length()
    counts = [F.bit_count(F.shiftrightunsigned(fp, at).bitwiseAND((1 << segment_bits) - 1)).cast("long") for at in range(0, 64, segment_bits)]
    if width * len(counts) > 64:
        raise ValueError("these segments don't fit into a 64-bit cell number")
    own = F.lit(0).cast("long")
    for i, c in enumerate(counts):
        own = own.bitwiseOR(F.shiftleft(c, width * i))
    moved = lambda i, c, to: own.bitwiseXOR(F.shiftleft(c.bitwiseXOR(to), width * i))
    near = [F.when(c < segment_bits, moved(i, c, c + 1)) for i, c in enumerate(counts)] + [F.when(c > 0, moved(i, c, c - 1)) for i, c in enumerate(counts)]
    return F.array_compact(F.array(own, *near))


def links(fingerprints: DataFrame, segment_bits: tuple[int, ...] = SEGMENT_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Distinct fingerprints(fp) in; (a, b) out, a < b: links that join exactly those reachable over 2 or fewer differing bits.

    Cells of up to cell_rows fingerprints are compared pair by pair. The fingerprints of fuller cells go on to the next smaller segments; those
    that stay in full cells are put under each of their 65 variants of at most one flipped bit: all that share a variant are within two
    bits of each other, at most 65 in number, and one star of links joins them. So no cell, however full, makes pairs that grow with
    its square.
    """
    found, rest = [], fingerprints
    for bits in segment_bits:
        cells = staged(rest.select("fp", F.explode(popcount_cells("fp", bits)).alias("cell")), "cells")
        sizes = staged(cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1"), "cell-sizes")
        few = cells.join(sizes.filter(F.col("n") <= cell_rows).select("cell"), "cell")
        near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)
        found.append(few.select("cell", F.col("fp").alias("a")).join(few.select("cell", F.col("fp").alias("b")), "cell").filter(near).select("a", "b"))
        full = sizes.filter(F.col("n") > cell_rows).select("cell")
        if full.isEmpty():
            break
        rest = staged(cells.join(full, "cell").select("fp").distinct(), "crowded")
    else:
        flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)]
        stars = rest.select("fp", F.explode(F.array(*flips)).alias("variant")).groupBy("variant").agg(F.array_sort(F.collect_set("fp")).alias("fps")).filter(F.size("fps") > 1)
        found.append(stars.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, 64)).alias("b")))
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    return out.distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """documents(doc_id, text): one row each with fp (signed), component_id and group_fp, which names the group even where no id does."""
    docs = staged(documents.select("doc_id", fingerprint("text").alias("fp")), "fingerprints")
    fps = staged(docs.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    labels = connected_components(links(fps.select("fp"))).select(F.col("node").alias("fp"), F.col("label").alias("group_fp"))
    grouped = fps.join(labels, "fp", "left").select("fp", "least_id", F.coalesce("group_fp", "fp").alias("group_fp"))
    linked = fps.join(labels, "fp").groupBy("group_fp").agg(F.min("least_id").alias("group_id"))
    classes = grouped.join(linked, "group_fp", "left").select("fp", "group_fp", F.coalesce("group_id", "least_id").alias("component_id"))
    return docs.join(classes, "fp").select("doc_id", "fp", "component_id", "group_fp")


def representatives(documents: DataFrame, least: tuple[int, int] = jaccard.LEAST, words: int = jaccard.SHINGLE_WORDS) -> DataFrame:
    """One row of each group of texts whose sets of shingles are similar, whole: a document with the group's smallest id; of several texts under
    that id, one with the smallest hash of its set, and one of repeated rows. Of a group without any id one row stays. The sets' fingerprints are
    linked by links(), as near_duplicates() links those of texts, and compared first."""
    return jaccard.representatives(documents, least, words, fingerprint=majority, near=links)
