from __future__ import annotations

import random
import time

import numpy as np
import pytest

from barloom.llm import decontaminate as d


def plain_regions(index: d.Index, points: np.ndarray) -> dict[int, set[int]]:
    """Bands by counting, for each, the item's places with a shared q-gram on its diagonals."""
    grams, out = d.gram_hashes(points).tolist(), {}
    where: dict[int, list[int]] = {}
    for t, g in enumerate(grams):
        where.setdefault(g, []).append(t)
    for item, own in enumerate(index.points):
        wide, held = int(index.budgets[item]) + 1, {}
        for p, g in enumerate(d.gram_hashes(own).tolist()):
            for t in where.get(g, []):
                for band in ((t - p) // wide, (t - p) // wide - 1):
                    held.setdefault(band, set()).add(p)
        enough = {(b + 1) * wide for b, ps in held.items() if len(ps) >= max(1, index.bound[item])}
        if enough:
            out[item] = enough
    return out


@pytest.mark.parametrize("seed", range(6))
def test_bands_equal_plain_counts(seed):
    rng = random.Random(seed)
    word = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    letters = "ab" if seed % 2 else "abcdefgh"
    items = [(i, word(rng.randint(12, 120), letters)) for i in range(6)] + [(6, "ab" * 40), (7, "a" * 60), (8, "xyz" * 30)]
    index = d.Index(items)
    pieces = [t for _, t in rng.sample(items, 4)] + [word(60, letters), "ab" * 70, "a" * 90, "xyz" * 25]
    rng.shuffle(pieces)
    points = d.points_of("".join(p[:-3] + "q" + p[-2:] if rng.random() < 0.5 else p for p in pieces))
    assert {i: set(b.tolist()) for i, b in index.regions(points)} == plain_regions(index, points)


def test_long_repetitive_texts_take_linear_time():
    items = [(0, "ab" * 200), (1, "a" * 399 + "b"), (2, "abc" * 130), (3, "z" * 12)]
    index = d.Index(items)
    begin = time.time()
    assert set(index.search("a" * 120_000)) == {1}  # one edit
    assert set(index.search("ab" * 500_000)) == {0}
    assert index.search("的" * 1_000_000) == {}
    assert time.time() - begin < 60


def test_short_items_stand_as_words(spark):
    items = [(1, "yes"), (2, "What is 7 x 8?"), (3, None), (4, "  "), (None, "never ever once"), (6, "yes")]
    docs = [(1, "Oh Yes!", 5), (2, "yesterday", 5), (3, "so: what  is\n7 X 8? 56", 5), (None, "NEVER ever  once more", 5), (4, None, 5), (5, "", 5), (1, "Oh Yes!", 5)]
    table = spark.createDataFrame(docs, "doc_id long, text string, Similarity int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((str(r["doc_id"]), str(r["item_id"]), r["start"], r["end"]) for r in d.contaminated(table, bench).collect())
    assert found == [("1", "1", 2, 5), ("1", "1", 2, 5), ("1", "6", 2, 5), ("1", "6", 2, 5), ("3", "2", 3, 13), ("None", "None", 0, 13)]
    assert sorted(str(r["doc_id"]) for r in d.clean(table, bench).collect()) == ["2", "4", "5"]
    assert d.clean(table.limit(0), bench).collect() == [] and d.clean(table, bench.limit(0)).count() == len(docs)


def test_an_item_of_36_characters_is_found(spark):
    item = "abcdef ghij klmnop qrstuvw xyzab cde"
    table = spark.createDataFrame([(1, item), (2, item.replace("klm", "kxm"))], "doc_id long, text string")
    found = {r["doc_id"]: r["edits"] for r in d.contaminated(table, spark.createDataFrame([(9, item)], "item_id long, text string")).collect()}
    assert found == {1: 0, 2: 1}
