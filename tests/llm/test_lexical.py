from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np

from barloom.llm import lexical, queries
from compare import same

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, k=10):
    held = [(d, Counter(t)) for d, text in docs if (t := terms(text))]
    count, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    w = {t: math.floor(1000 * math.log((2 * count + 2) / (2 * n + 1))) for t, n in df.items()}
    out, asked = [], {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    for item, words in asked.items():
        scored = []
        for d, c in held:
            m = 100 - 90 + 90 * sum(c.values()) * count // total
            score = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in words if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(docs, items, **more):
    return sorted(map(tuple, lexical.search(lexical.build(docs, more.pop("chunk_postings", lexical.CHUNK_POSTINGS)), items, **more).collect()), key=str)


def test_ranks_equal_scoring_every_document(spark):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(300)] + ["Éa", "naïve", "日本", "x y"]
    share = 1 / (1 + np.arange(len(words)))
    pick = lambda n: " ".join(rng.choice(words, n, p=share / share.sum()))
    docs = [(i, pick(int(n))) for i, n in enumerate(rng.integers(1, 60, 900))] + [(2000 + i, "same words w250 w251 w252") for i in range(60)]
    docs += [(None, "W250 w251"), (None, "w250 w251"), (5, docs[5][1]), (3000, None), (3001, ""), (3002, " .,;"), (3003, "w3 " * 30_000 + "w260")]
    items = [(i, pick(12)) for i in range(25)] + [(90, "w250-w251 W252"), (91, None), (92, "unknown"), (None, "w260"), (None, "w3"), (93, "w260!"), (93, "w261")]
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, Score string").repartition(3)
    q = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int")
    want = expected(docs, items)
    assert found(d, q) == want
    assert found(d, q, chunk_postings=200, block_chars=100) == want
    assert found(d, q, k=3) == expected(docs, items, 3)
    assert found(d.limit(0), q) == [] and found(d, q.limit(0)) == []


def test_a_treap_keeps_every_cell():
    rng = np.random.default_rng(1)
    for row_bits, column_bits in ((0, 0), (0, 3), (5, 0), (7, 3), (3, 8), (6, 6)):
        cells = np.unique(rng.integers(0, 1 << (row_bits + column_bits), 40))
        rows, columns, impacts = cells >> column_bits, cells & ((1 << column_bits) - 1), rng.integers(1, 1000, len(cells))
        peak, bits, drops = lexical.grown(rows, columns, impacts, row_bits, column_bits)
        pack = lexical.zstandard.ZstdCompressor().compress
        row = {"ids": list(range(1 << column_bits)), "terms": np.arange(1 << row_bits, dtype="<u8").tobytes(), "peak": peak, "row_bits": row_bits, "column_bits": column_bits, "cells": [pack(b) for b in bits], "drops": [pack(d) for d in drops]}
        treap = lexical.Treap(row)
        for r in set(rows.tolist()):  # every row of an index has a cell
            want = sorted(((int(i), int(c)) for rr, c, i in zip(rows, columns, impacts, strict=True) if rr == r), key=lambda x: (-x[0], x[1]))
            assert treap.best(np.array([r], dtype=np.uint64), np.array([1]), 1000, []) == want


def test_query_equals_sql(spark, sf_dir):
    same(spark, sf_dir, queries.QUERIES["op11_lexical"], queries.ORACLE_SQL["op11_lexical"])
