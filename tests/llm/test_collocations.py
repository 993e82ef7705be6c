from __future__ import annotations

import re
from collections import Counter

import numpy as np

from barloom.llm import collocations, queries
from compare import same


def expected(docs, least, best=2000):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    asked = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    gone = set()
    for (lang, words), a in asked.items():
        for k in range(2, len(words)):
            gone |= {(lang, words[i : i + k]) for i in range(len(words) - k + 1) if 100 * a >= 80 * f[lang, words[i : i + k]]}
    out = []
    for lang in n:
        rows = []
        for (of, words), a in asked.items():
            if of == lang and (of, words) not in gone:
                score, _, left, right = min((2_000_000 * a // (f[of, words[:k]] + f[of, words[k:]]), k, f[of, words[:k]], f[of, words[k:]]) for k in range(1, len(words)))
                rows.append((-score, -a, " ".join(words).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:best])]
    return sorted(out)


def corpus(rng, rows):
    words = [f"w{i}" for i in range(40)] + ["Été", "日本", "a b", "\x1cx"]
    share = 1 / (1 + np.arange(len(words)))
    pick = lambda n: "".join(str(w) + str(rng.choice([" ", "  ", "\t", ". ", "\r\n", ";"], p=[0.8, 0.05, 0.05, 0.04, 0.03, 0.03])) for w in rng.choice(words, n, p=share / share.sum()))
    return [(pick(int(k)), ["en", "fr", None, "und"][int(g)]) for k, g in zip(rng.integers(1, 90, rows), rng.integers(0, 4, rows), strict=True)]


def found(df, least, **more):
    return sorted(map(tuple, collocations.collocations(df, least=least, **more).collect()))


def test_phrases_equal_counting_all(spark):
    docs = corpus(np.random.default_rng(3), 400)
    docs += [("Of the first kind. of the second kind", "en")] * 40 + [("alpha beta gamma delta epsilon", "fr")] * 35 + [(None, "en"), ("", None), (" .,; ", "de"), ("long word run " * 20_000, "es")]
    df = spark.createDataFrame([(i % 9 or None, *d, "x") for i, d in enumerate(docs)], "doc_id long, text string, lang string, phrase string").repartition(3)
    for least in (30, 5):
        want = expected(docs, least)
        assert len(want) > 20
        assert found(df, least) == want
        assert found(df, least, chunk_words=300, hot_share=0.002) == want  # leading words of a five-hundredth of all are routed by one more
    assert found(df, 5, best=7) == expected(docs, 5, 7)
    assert found(df.limit(0), 2) == [] and found(df.limit(3), 1_000_000) == []


def test_routed_rows_grow_with_chunks_not_with_phrases(spark):
    """Five times the text has far more phrases over the least count; what is routed is a row a chunk and bucket."""
    docs = corpus(np.random.default_rng(5), 500)
    for part in (docs[:100], docs):
        chunks = collocations.encoded(spark.createDataFrame(part, "text string, lang string").coalesce(1), 1000)
        words = chunks.select("lang", collocations.F.explode("words").alias("phrase")).distinct()
        packed = collocations.suffixes(chunks, words, {"en": {("w0", "w1"), ("w0", "w1", "w2")}}, 2, buckets=4).collect()
        assert 0 < len(packed) <= 4 * chunks.count()
        *_, weights, lead, langs, spelled = collocations.unrouted([(r["lang"], r["spelled"], r["suffixes"]) for r in packed])
        assert len(weights) > 4 * len(packed) and weights.min() > 0 and set(lead.tolist()) <= {2, 3, 4} and "en" in langs and b"w0" in spelled


def test_quicksort_counts_beginnings():
    rng = np.random.default_rng(8)
    rows = rng.integers(-1, 4, (500, 5)).astype(np.int32)
    rows[:, 0] = rng.integers(0, 2, 500)
    rows[:, 1:3] = np.abs(rows[:, 1:3])
    rows[:, 4] = np.where(rows[:, 3] < 0, -1, rows[:, 4])
    weights = rng.integers(1, 4, 500)
    for lead in (2, 3, 4):
        sums = Counter()
        for r, w in zip(rows.tolist(), weights.tolist(), strict=True):
            for k in range(2, 5):
                if r[k] >= 0:
                    sums[tuple(r[: k + 1])] += w
        want = {p: c for p, c in sums.items() if c >= 9 or len(p) - 1 < lead}
        got = collocations.frequent(list(rows.T), weights, np.arange(500), lead, 9)
        assert {tuple(rows[at][: k + 1].tolist()): c for k, at, c in got} == want and len(got) == len(want)


def test_query_equals_sql(spark, sf_dir):
    same(spark, sf_dir, queries.QUERIES["op13_collocations"], queries.ORACLE_SQL["op13_collocations"])
