"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. A trigram's vector binds (multiplies) its letters' vectors, each permuted
(rotated) by its place; a text's vector bundles (adds) its trigrams' vectors. A language's prototype is the sum of the unit text
vectors of its documents, less the mean of all prototypes, which holds what the languages share. A text goes to the prototype with
the largest cosine.

Which language is nearest says nothing of whether the text is like it. `recognised` can therefore leave out texts that are unlike every
language: those of at least LEAST_SPREAD different trigrams (repeats weigh less) whose cosine with each language's bundle, before the
mean is taken off, is no larger than chance may give, in standard deviations of 1 / sqrt(DIMENSIONS). Shorter texts say too little and
stay, and so does every text while fewer than ENOUGH have taught.

Defined results: a null text or one without any letter is `und` with score 0. Ties go to the smaller language name. Without any
learnable row every text is `und`. A null doc_id counts as an empty one when the fold is drawn. Repeated rows keep one output row
each. Columns of the input that are named like an output, in either case, make way for it. Texts are read whole, however long: what is held of a
text beside its trigrams is PIECE bound vectors at a time.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from barloom.llm.storage import unused

DIMENSIONS = 1024
SEED = 20240501
#: Symbols: 0 stands for whatever is no letter, the rest for letters, a-z first.
SYMBOLS = 1024
#: Planes of Unicode with letters: the basic one, the supplementary one and two of ideographs.
PLANES = 4
#: Documents whose trigrams are counted together, and different trigrams that are bound together.
BLOCK_ROWS = 256
PIECE = 8192
#: Trigrams of a text, as (sum of counts)^2 / sum of squared counts, from which on it can be unlike every language; texts that have to be learned for that.
LEAST_SPREAD = 128
ENOUGH = 100

PREDICTION = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("alike", BooleanType())])


@functools.lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """The symbol of each code point of the planes that hold letters, and 0 at the end for all beyond; letters beyond a-z share the symbols from 27 on."""
    return np.array([ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % (SYMBOLS - 27) if c.isalpha() else 0 for c in map(chr, range(PLANES * 65536))] + [0], dtype=np.int32)


def trigram_codes(text: str | None, symbols: np.ndarray) -> np.ndarray:
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    s = symbols[np.minimum(points, len(symbols) - 1)]
    s = np.concatenate(([0], s, [0]))
    s = s[np.concatenate(([True], (s[1:] > 0) | (s[:-1] > 0)))]  # runs of other characters count as one
    return (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:] if s.any() else s[:0]


def letter_vectors(dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), size=(SYMBOLS, dimensions))


class Encoder:
    """Text vectors of unit length, a block of texts at a time."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.symbols, letters = symbol_table(), letter_vectors(dimensions)
        self.first, self.second, self.third = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters
        self.dimensions = dimensions

    def bound(self, codes: np.ndarray) -> np.ndarray:
        """The vectors of trigrams, a row each."""
        a, rest = np.divmod(codes, SYMBOLS * SYMBOLS)
        b, c = np.divmod(rest, SYMBOLS)
        return (self.first[a] * self.second[b] * self.third[c]).astype(np.float32)

    def counted(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each text's different trigrams and how often they stand there."""
        return [np.unique(trigram_codes(t, self.symbols), return_counts=True) for t in texts]

    def vectors(self, texts: list[str | None]) -> np.ndarray:
        return self.bundled(self.counted(texts))

    def bundled(self, counted: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        every = np.unique(np.concatenate([*(codes for codes, _ in counted), np.zeros(0, np.int32)]))
        out = np.zeros((len(counted), self.dimensions), dtype=np.float32)
        for at in range(0, len(every), PIECE):
            part = every[at : at + PIECE]
            bound = self.bound(part)
            for i, (codes, counts) in enumerate(counted):
                low, high = np.searchsorted(codes, [part[0], part[-1] + 1])
                if low < high:
                    out[i] += counts[low:high].astype(np.float32) @ bound[np.searchsorted(part, codes[low:high])]
        return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9)

    def blocks(self, batch: pd.Series, rows: int = BLOCK_ROWS) -> Iterator[tuple[int, np.ndarray]]:
        for at in range(0, len(batch), rows):
            yield at, self.vectors(list(batch.iloc[at : at + rows]))


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def spread(counts: np.ndarray) -> float:
    """How many different trigrams a text has, where one that fills most of it counts for little beside it."""
    c = counts.astype(np.float64)
    return float(c.sum() ** 2 / (c @ c)) if len(c) else 0.0


def bundles(labelled: DataFrame, dimensions: int = DIMENSIONS) -> tuple[dict[str, np.ndarray], int]:
    """labelled(text, lang) to one unit vector a language and the number of texts; all rows count. Sums of dimensions combine before the
    shuffle, and what reaches the driver is one vector a language, whatever the number of rows."""

    def bundled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, sums, texts = Encoder(dimensions), {}, Counter()
        for batch in batches:
            for at, vectors in encoder.blocks(batch["text"]):
                langs = batch["lang"].iloc[at : at + len(vectors)].to_numpy()
                for lang in set(langs):
                    sums[lang] = sums.get(lang, 0) + vectors[langs == lang].sum(axis=0, dtype=np.float64)
                texts.update(langs)
        for lang, v in sums.items():  # the number of texts stands before the first axis
            yield pd.DataFrame({"lang": lang, "axis": np.arange(-1, dimensions, dtype=np.int32), "value": np.append(texts[lang], v)})

    summed = labelled.select("text", "lang").mapInPandas(bundled, "lang string, axis int, value double").groupBy("lang", "axis").agg(F.sum("value").alias("value"))
    vectors: dict[str, np.ndarray] = {}
    learned = 0
    for row in summed.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("axis", "value"))), lambda x: x["value"]).alias("v")).collect():
        texts, *v = row["v"]
        learned += int(texts)
        if np.any(v):
            vectors[row["lang"]] = np.array(v) / np.linalg.norm(v)
    return vectors, learned


def centred(vectors: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The unit vectors less what they share, of unit length, by language."""
    if len(vectors) > 1:
        mean = np.mean(list(vectors.values()), axis=0)
        vectors = {k: v - mean for k, v in vectors.items()}
    return {k: v / max(np.linalg.norm(v), 1e-9) for k, v in sorted(vectors.items())}


def prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """labelled(text, lang) to one centred unit vector a language."""
    return centred(bundles(labelled, dimensions)[0])


def classifier(profiles: dict[str, np.ndarray], dimensions: int = DIMENSIONS, whole: dict[str, np.ndarray] | None = None, chance: float = 0.0):
    """A Pandas UDF of text to (lang_pred, score, alike); the score is the cosine, with 0 for negative ones. whole: the bundles; a text is
    alike if it comes nearer to one of them than `chance` standard deviations, or is too short to tell. Without them all texts are."""
    names, matrix = list(profiles), np.array(list(profiles.values()), dtype=np.float32).reshape(len(profiles), dimensions)
    bundle, bound = np.array(list((whole or {}).values()), dtype=np.float32).reshape(len(whole or {}), dimensions), chance / np.sqrt(dimensions)

    @F.pandas_udf(PREDICTION)
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(dimensions)
        for batch in batches:
            langs, scores, alike = [], [], []
            for at in range(0, len(batch), BLOCK_ROWS):
                counted = encoder.counted(list(batch.iloc[at : at + BLOCK_ROWS]))
                vectors = encoder.bundled(counted)
                if len(bundle):
                    likeness = (vectors @ bundle.T).max(axis=1)
                    alike += [bool(x > bound) or spread(counts) < LEAST_SPREAD for x, (_, counts) in zip(likeness, counted, strict=True)]
                else:
                    alike += [True] * len(vectors)
                near = vectors @ matrix.T if names else np.zeros((len(vectors), 1), np.float32)
                for i, best in enumerate(near.argmax(axis=1)):
                    known = bool(names) and (vectors[i].any() or has_letter(batch.iloc[at + i]))
                    langs.append(names[best] if known else "und")
                    scores.append(float(min(1.0, max(0.0, near[i, best]))) if known else 0.0)
            yield pd.DataFrame({"lang_pred": pd.Series(langs, dtype=object), "score": pd.Series(scores, dtype="float64"), "alike": pd.Series(alike, dtype=bool)})

    return classify


def fold(doc_id: str = "doc_id", folds: int = 3) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def predict(documents: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """documents(doc_id, text, lang): every column of the input that isn't named like an output in either case, with held_out, lang_pred and score.

    Learns from the rows outside the held-out fold that have a lang; lang is no input of any prediction."""
    learnable = documents.filter((fold() != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    classify = classifier(prototypes(learnable, dimensions), dimensions)
    held = unused(documents, "language_found")
    kept = [F.col(f"`{c}`") for c in documents.columns if c.lower() not in ("held_out", "lang_pred", "score")]
    return documents.select(*kept, (fold() == 1).alias("held_out"), classify("text").alias(held)).select(*kept, "held_out", f"{held}.lang_pred", f"{held}.score")


def recognised(documents: DataFrame, least: float, dimensions: int = DIMENSIONS, chance: float | None = None) -> DataFrame:
    """The documents, rows and columns untouched, whose language is known with at least this score. chance: those that are unlike every
    language go too, by so many standard deviations."""
    learnable = documents.filter((fold() != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    whole, learned = bundles(learnable, dimensions)
    judged = chance is not None and learned >= ENOUGH
    held = unused(documents, "language_found")
    found = documents.withColumn(held, classifier(centred(whole), dimensions, whole if judged else None, chance or 0.0)("text"))
    return found.filter((F.col(f"{held}.lang_pred") != "und") & (F.col(f"{held}.score") >= least) & F.col(f"{held}.alike")).select(*(F.col(f"`{c}`") for c in documents.columns))
