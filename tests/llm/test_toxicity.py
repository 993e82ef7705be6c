from __future__ import annotations

import itertools
import random
import time

import pytest

from barloom.llm import toxicity as t

WORDS = ("idiot", "moron", "loser", "stupid", "shit", "ass", "kill")


def decoder() -> t.Decoder:
    return t.Decoder({g: 50 for w in WORDS for p in [f"  {w} "] for g in (p[i : i + 3] for i in range(len(p) - 2))})


@pytest.mark.parametrize("seed", range(20))
def test_best_path_of_all_paths(seed):
    rng, d = random.Random(seed), decoder()
    text = "".join(rng.choice("il1!$s50o t") for _ in range(rng.randint(1, 7)))
    best = min(
        cost
        for choice in itertools.product(range(6), repeat=len(text))
        if (cost := walk(d, text, choice)) is not None
    )
    cost, read = d.best(text)
    assert cost == pytest.approx(best)
    assert read == d.best(text)[1]


def walk(d: t.Decoder, text: str, choice: tuple[int, ...]) -> float | None:
    """The cost of one path through the lattice, the k-th arc of each character; None if there is no such arc."""
    state, total = "  ", 0.0
    for c, k in zip(text, choice, strict=True):
        arcs = d.arcs(state, c)
        if k >= len(arcs):
            return None
        state, more, _ = arcs[k]
        total += more
    return total + d.cost(state, " ")


@pytest.mark.parametrize(("text", "word"), [("you shi7 there", "shit"), ("an a55 here", "ass"), ("so a$$ it is", "ass"), ("go ki11 it", "kill"), ("m.o.r.o.n", "moron"), ("a m / o \t r\n\no  n z", "moron"), ("1 d 1 0 t", "idiot"), ("__1d10t__1d10t__", "idiot"), ("stuuupid", "stupid"), ("$tupid", "stupid")])
def test_disguises_are_read(text, word):
    d = decoder()
    read = {w for stretch in t.taken_apart(text)[1] for w in d.decode(stretch)}
    assert word in read or any(word in w for w in read)


def test_plain_text_has_no_stretch():
    assert t.taken_apart("the letters in a row of 12 words, e.g. this one (a) 1999: 3 4 5 6 hello")[1] == []
    assert t.taken_apart("") == ([], [])


def test_long_stretches_take_linear_time():
    d, begin = decoder(), time.time()
    assert d.decode("1d10t" * 20_000)
    spaced = t.taken_apart(" ".join("moron" * 8_000))[1]
    assert len(spaced) == 1 and "moron" in d.decode(spaced[0])
    assert time.time() - begin < 40
    assert not d.known


def test_repeated_and_clashing_rows(spark):
    docs = [(i, "a fine day " + ("idiot" if i % 3 == 0 else "friend"), 1) for i in range(90)] * 2 + [(7, "another text of this id", 1)] * 500 + [(None, "idiot", 1)]
    labels = [(i, int(i % 3 == 0)) for i in range(90)] * 3
    rows, given = spark.createDataFrame(docs, "doc_id long, text string, Score int"), spark.createDataFrame(labels, "doc_id long, toxic int")
    assert t.training_rows(rows, given, 10).count() == 20
    assert t.training_rows(rows, given, 1000).filter("toxic = 0").count() <= 60
    found = t.score(rows, given).collect()
    assert len(found) == len(docs)
    assert all(r["predicted"] == int(r["doc_id"] is None or r["doc_id"] % 3 == 0) for r in found if r["doc_id"] != 7)


def test_every_labelled_id_teaches(spark):
    """6,400 rows of either label, of which 6,000 were learned from; a toxic word that few rows hold is learned too."""
    docs = spark.range(16_000).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN 'a fine day, friend' WHEN id % 1000 = 1 THEN 'what a scoundrel' ELSE 'you idiot' END AS text")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic")
    rows = t.training_rows(docs, labels)
    assert rows.count() == docs.filter(t.fold() != 0).count() > 12_000
    found = t.score(docs, labels)
    assert found.filter("predicted <> doc_id % 2").count() == 0 and found.count() == 16_000
