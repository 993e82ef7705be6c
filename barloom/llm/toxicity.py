"""Toxicity scores over deobfuscated text.

Stretches that look disguised, of any length, are decoded as a noisy channel: runs of letters and readable symbols that hold both, wherever the
symbols stand; words with a letter three times in a row; three or more single letters in a row, whatever separates them. Each character
opens a few arcs of a lattice (itself, the letters that it may stand for, nothing for a separator or a repeat, the end of a word for a separator),
with fixed channel costs, and Viterbi finds the path that is most likely under them and a character trigram model, in one step a character.
The restored words, beside the original ones, are scored by logistic regression over their beginnings.

The trigram model, the choice of features and the weights are fitted on one row of each labelled doc_id outside the held-out fold; toxic rows weigh
at least half as much as the others. What the rows have of the features to choose from is written once, and counts and weights are made of that by
Spark; only counts of the most frequent trigrams and features and the weights reach the driver. Nothing but the text is an input of a score.

Defined results: a null text is an empty one, which gets the score of no features. A null doc_id counts as an empty one when the fold is drawn and is
never learned from; several labels of a doc_id: toxic if any is; several texts of one: the first by hash teaches. Null labels teach nothing.
Without both labels every score is 0. Repeated rows keep one output row each; further columns are ignored. Texts are scored whole.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from barloom.llm.storage import staged

#: Features that get a weight; documents that must hold a feature; rounds of fitting at most, and the weight of the squared weights in its loss.
FEATURES = 768
LEAST_ROWS = 4
ROUNDS = 100
PENALTY = 1e-4
#: Labelled ids, of two numbers, that may go to every task at once: some 8 MB. Beyond that the texts outside the held-out fold are shuffled once.
MOST_SENT = 500_000
#: Lengths of word beginnings that are features beside the whole word.
STEMS = (4, 5, 6, 7, 8)
#: A beginning that occurs so often in a text is a feature of its own.
TIMES = (1, 2, 3)
#: Features of the toxic rows, the most frequent ones, that are counted in the others; trigrams of the language model, the most frequent ones.
CANDIDATES = 30_000
TRIGRAMS = 60_000
#: Fixed readings of symbols, each with the letters that it may stand for.
READINGS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "€": "e", "£": "l"}
#: Fixed channel costs, in nats: a symbol read as a letter, a separator dropped, a repeat dropped, a character kept as it is.
READ, DROP, REPEAT, KEEP = 0.5, 0.1, 1.5, 8.0

#: Stands for whatever separates single letters; decoded stretches up to this length are kept for the next time.
GAP = " "
KEPT_CHARS = 64
#: Words that a task keeps counts or stems of; then it starts anew.
KEPT_WORDS = 200_000


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point below 65,536: 1 letter, 2 digit or symbol that may stand for one."""
    kinds = np.array([1 if c.isalpha() else 0 for c in map(chr, range(65536))], dtype=np.uint8)
    for c in READINGS:
        kinds[ord(c)] |= 2
    return kinds


def taken_apart(text: str) -> tuple[list[str], list[str]]:
    """The words of a lowered text, and its disguised stretches: a few passes over arrays of code points. Letters beyond the first
    65,536 code points separate words."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = _classes()[np.minimum(points, 65535)]
    letter = (kind & 1) > 0
    words = np.where(letter, points, 32).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split()
    if len(points) < 3:
        return words, []
    token = kind > 0
    edge = np.flatnonzero(np.diff(token, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]  # runs of letters and readable symbols
    if not len(start):
        return words, []
    size = end - start
    letters = np.add.reduceat(np.append(letter, False).astype(np.int32), edge)[::2]
    triple = np.zeros(len(points) + 1, dtype=np.int32)
    triple[2:-1] = letter[2:] & (points[2:] == points[1:-1]) & (points[1:-1] == points[:-2])
    thrice = np.add.reduceat(triple, edge)[::2] > 0
    mixed = (letters > 0) & (letters < size) & (size > 2)
    shown = [text[start[i] : end[i]] for i in np.flatnonzero(mixed | thrice)]
    single = np.flatnonzero(np.diff(size == 1, prepend=False, append=False))
    for a, b in zip(single[::2], single[1::2], strict=True):  # tokens a to b are single characters
        if b - a > 2 and letters[a:b].sum() > 1:
            shown.append(GAP.join(map(chr, points[start[a:b]].tolist())))
    return words, shown


class Decoder:
    """Viterbi over the lattice of a stretch; a state is the last two letters read."""

    def __init__(self, trigrams: dict[str, int]):
        self.counts = trigrams
        self.pairs: Counter = Counter()
        for gram, n in trigrams.items():
            self.pairs[gram[:2]] += n
        self.known: dict[str, str] = {}

    def cost(self, pair: str, letter: str) -> float:
        return -math.log((self.counts.get(pair + letter, 0) + 0.05) / (self.pairs.get(pair, 0) + 0.05 * 40))

    def decode(self, stretch: str) -> list[str]:
        """The words that the stretch most likely stands for."""
        text = stretch.lower()
        if text in self.known:
            return self.known[text]
        words = self.best(text)[1].split()
        if len(text) <= KEPT_CHARS:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[text] = words
        return words

    def arcs(self, state: str, c: str) -> list[tuple[str, float, str]]:
        """(next state, cost, what is read) of a character after the two letters of a state."""
        found = []
        if c == GAP:
            return [(state, DROP, ""), ("  ", self.cost(state, " "), " ")]
        for letter in READINGS.get(c, ""):
            found.append((state[1] + letter, READ + self.cost(state, letter), letter))
            if state[1] == letter:
                found.append((state, READ + REPEAT, ""))
        if c.isalpha():
            found.append((state[1] + c, self.cost(state, c), c))
            if state[1] == c:
                found.append((state, REPEAT, ""))
        else:
            found.append((state, KEEP, ""))  # a symbol that means nothing
        return found

    def best(self, text: str) -> tuple[float, str]:
        """The least cost of a path through the text's lattice, and what it reads; of equal ones, the first met. Paths are chains of their last
        readings, so a step copies none."""
        states: dict[str, tuple[float, tuple | None]] = {"  ": (0.0, None)}
        for c in text:
            after: dict[str, tuple[float, tuple | None]] = {}
            for state, (cost, path) in states.items():
                for to, more, read in self.arcs(state, c):
                    if to not in after or cost + more < after[to][0]:
                        after[to] = (cost + more, (path, read) if read else path)
            states = after
        cost, path = min(((cost + self.cost(state, " "), path) for state, (cost, path) in states.items()), key=lambda x: x[0])
        out = []
        while path is not None:
            path, read = path
            out.append(read)
        return cost, "".join(reversed(out))


class Known:
    """A set of features, and the first letters that a word must have to make any of them."""

    def __init__(self, features):
        self.features = frozenset(features)
        self.heads = frozenset(f[1:5] for f in self.features)
        self.stems = frozenset(f[1:] for f in self.features if f[0] != "=")
        self.seen: dict[str, list[str]] = {}

    def stems_of(self, word: str) -> list[str]:
        found = self.seen.get(word)
        if found is None:
            if len(self.seen) > KEPT_WORDS:
                self.seen.clear()
            found = self.seen[word] = [s for s in _stems(word) if s in self.stems]
        return found


def _stems(word: str) -> list[str]:
    return [word[:size] for size in STEMS if len(word) >= size]


def features_of(text: str | None, decoder: Decoder | None, known: Known | None = None) -> set[str]:
    """What a text has of words, as =word, and of word beginnings that occur so many times, as 1stem, 2stem and 3stem; its disguised
    stretches count as what they stand for beside the text itself. known: only these."""
    plain = (text or "").lower()
    listed, disguised = taken_apart(plain)
    words = Counter(listed)
    if decoder is not None:
        for stretch in disguised:
            words.update(decoder.decode(stretch))
    if known is not None:
        heads = known.heads
        words = {w: n for w, n in words.items() if w[:4] in heads}
    stems: Counter = Counter()
    stems_of = _stems if known is None else known.stems_of
    for word, n in words.items():
        for stem in stems_of(word):
            stems[stem] += n
    out = {"=" + w for w in words if len(w) > 2}
    out.update(f"{k}{stem}" for stem, n in stems.items() for k in TIMES if n >= k)
    return out if known is None else out & known.features


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def training_rows(documents: DataFrame, labels: DataFrame, rows: int | None = None) -> DataFrame:
    """(text, toxic) of the labelled rows to learn from, one for each id. rows: for the first so many ids of either label by hash alone. Only
    ids are broadcast, and so many at most, so other texts stay where they are read."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold() != 0)).groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    if rows is not None:
        first = lambda k: known.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        known = first(0).union(first(1))
    chosen = F.broadcast(known) if known.count() <= MOST_SENT else known
    held = documents.select("doc_id", "text").filter(fold() != 0).join(chosen, "doc_id")
    return held.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")


def fit_decoder(rows: DataFrame, trigrams: int = TRIGRAMS) -> Decoder:
    """Counts of the most frequent character trigrams in the rows' words, toxic rows weighing as much as all others together."""

    def grams(words: list[Counter]) -> pd.DataFrame:
        counts: list[Counter] = [Counter(), Counter()]
        for toxic, held in enumerate(words):
            for word, n in held.items():
                padded = f"  {word} "
                for i in range(len(padded) - 2):
                    counts[toxic][padded[i : i + 3]] += n
            held.clear()
        return pd.DataFrame([(g, k, n) for k, c in enumerate(counts) for g, n in c.items()], columns=["gram", "toxic", "n"])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: list[Counter] = [Counter(), Counter()]
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                words[toxic].update(taken_apart((text or "").lower())[0])
                if len(words[toxic]) > KEPT_WORDS:
                    yield grams(words)
        yield grams(words)

    summed = rows.mapInPandas(counted, "gram string, toxic int, n long").groupBy("gram").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    found = summed.orderBy(F.desc(F.col("t") + F.col("c")), "gram").limit(trigrams).collect()
    weight = max(1.0, sum(r["c"] for r in found) / max(1, sum(r["t"] for r in found)))
    return Decoder({r["gram"]: round(r["t"] * weight) + r["c"] for r in found})


def candidate_features(rows: DataFrame, decoder: Decoder, candidates: int = CANDIDATES) -> list[str]:
    """The features that are most frequent in toxic rows."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(features_of(text, decoder))
                if len(counts) > 10 * KEPT_WORDS:
                    yield pd.DataFrame(list(counts.items()), columns=["feature", "n"])
                    counts.clear()
        yield pd.DataFrame(list(counts.items()), columns=["feature", "n"])

    summed = rows.filter("toxic = 1").mapInPandas(counted, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    return [r["feature"] for r in summed.filter(F.col("n") >= LEAST_ROWS).orderBy(F.desc("n"), "feature").limit(candidates).collect()]


def marked_rows(rows: DataFrame, decoder: Decoder, listed: list[str]) -> DataFrame:
    """(held, toxic): the places in the list of the features that each row holds."""
    place = {f: i for i, f in enumerate(listed)}
    known = Known(listed)

    def active(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"held": [sorted(map(place.__getitem__, features_of(t, decoder, known))) for t in batch["text"]], "toxic": batch["toxic"].astype("int32")})

    return rows.mapInPandas(active, "held array<int>, toxic int")


def choose_features(marked: DataFrame, listed: list[str], features: int, held: dict[int, int]) -> list[int]:
    """The places of the features whose presence says most about the label, by the squared difference of their shares over their variance.
    held: the number of rows of each label."""
    counts = np.zeros((2, len(listed)))
    for r in marked.select("toxic", F.explode("held").alias("i")).groupBy("toxic", "i").agg(F.count("*").alias("n")).collect():
        counts[r["toxic"], r["i"]] = r["n"]
    share = counts.sum(0) / (held[0] + held[1])
    power = (counts[1] / held[1] - counts[0] / held[0]) ** 2 / (share * (1 - share) + 1e-6)
    return sorted(sorted(range(len(listed)), key=lambda i: (-power[i], listed[i]))[:features], key=listed.__getitem__)


def fit_weights(marked: DataFrame, chosen: list[int], held: dict[int, int]) -> tuple[np.ndarray, float]:
    """Logistic regression with an L2 penalty; toxic rows weigh at least half as much as the others. Weights are rounded, as the last places
    depend on the order of adding."""
    if not chosen:
        return np.zeros(0), math.log(max(1.0, 0.5 * held[0] / held[1]) * held[1] / held[0])
    vectors = CountVectorizerModel.from_vocabulary([str(i) for i in chosen], "words", "x").transform(marked.select(F.transform("held", lambda i: i.cast("string")).alias("words"), "toxic"))
    weighed = vectors.select("x", F.col("toxic").cast("double").alias("label"), F.when(F.col("toxic") == 1, max(1.0, 0.5 * held[0] / held[1])).otherwise(1.0).alias("w"))
    model = LogisticRegression(featuresCol="x", weightCol="w", maxIter=ROUNDS, regParam=PENALTY, standardization=False, family="binomial").fit(weighed)
    return np.round(model.coefficients.toArray(), 6), round(float(model.intercept), 6)


@functools.lru_cache(maxsize=1)
def _none() -> Decoder:
    return Decoder({})


def score(documents: DataFrame, labels: DataFrame, train_rows: int | None = None, features: int = FEATURES, candidates: int = CANDIDATES, trigrams: int = TRIGRAMS) -> DataFrame:
    """documents(doc_id, text), labels(doc_id, toxic): doc_id, held_out, score and predicted of each document."""
    rows = staged(training_rows(documents, labels, train_rows), "training-rows")
    held = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    model: tuple[Decoder, dict[str, float], float] | None = None
    if len(held) == 2:
        decoder = fit_decoder(rows, trigrams)
        listed = candidate_features(rows, decoder, candidates)
        marked = staged(marked_rows(rows, decoder, listed), "marked-rows")
        chosen = choose_features(marked, listed, features, held)
        weights, bias = fit_weights(marked, chosen, held)
        model = (decoder, dict(zip((listed[i] for i in chosen), weights.tolist(), strict=True)), bias)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def rated(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder, weights, bias = shared.value or (_none(), {}, -math.inf)
        known = Known(weights)
        for batch in batches:
            sums = [bias + sum(weights.get(f, 0.0) for f in sorted(features_of(t, decoder, known))) for t in batch]
            yield pd.Series(1 / (1 + np.exp(-np.array(sums, dtype="float64"))))

    found = documents.select("doc_id", (fold() == 0).alias("held_out"), rated("text").alias("score"))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
