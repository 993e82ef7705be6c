from __future__ import annotations

import numpy as np
import pandas as pd

from barloom.llm import ann, urlfilter


def test_nearest_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16)).astype("float32")
    rows = [(i, [float(v) for v in x[i]], "x") for i in range(1500)] + [(2000, None, "x"), (2001, [0.0] * 16, "x"), (2002, [float("nan")] * 16, "x"), (2003, [1.0], "x"), (None, [1.0] * 16, "x"), (2100, [None] * 16, "x"), (7, [float(v) for v in x[7]], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    found = ann.nearest(df).collect()
    assert {r["query_id"] for r in found} == set(range(0, 1500, 100))
    hits = 0
    for q in range(0, 1500, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and all(abs(d[m[1]] - m[2]) < 1e-9 for m in mine)
        hits += len({m[1] for m in mine} & set(np.lexsort((np.arange(1500), d))[:10].tolist()))
    assert hits >= 0.9 * 150
    assert ann.nearest(df.limit(0)).collect() == []
    few = ann.nearest(spark.createDataFrame([(100, [1.0, 2.0]), (3, [2.0, 1.0]), (2, [2.0, 1.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r["rank"], r["vec_id"]) for r in few] == [(1, 2), (2, 3)]


def test_shortlist_is_one_for_the_whole_table(spark):
    """A hundredth of the rows ranked exactly, clustered vectors, the same rows however they are dealt out."""
    rng = np.random.default_rng(9)
    x = (rng.normal(size=(12, 48))[rng.integers(0, 12, 20_000)] * 2 + rng.normal(size=(20_000, 48))).astype("float32")
    x[5000:5300] = x[400]  # copies, more than a shortlist holds
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(20_000), "embedding": x.tolist(), "Cell": 1}))
    one = sorted(map(tuple, ann.nearest(df.repartition(1), shortlist=200).collect()))
    many = sorted(map(tuple, ann.nearest(df.repartition(7), shortlist=200, query_block=90).collect()))
    assert one == many
    hits, y = 0, x.astype(float)
    for q in range(0, 20_000, 100):
        d = ((y - y[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len({r[2] for r in one if r[0] == q} & set(np.lexsort((np.arange(20_000), d))[:10].tolist()))
    assert hits >= 0.9 * 2000
    assert [r[2] for r in one if r[0] == 400] == list(range(5000, 5010))


def test_urls(spark):
    rows = [(1, None, "x"), (2, "no scheme", "x"), (3, "HTTP://Shop.Example.COM/en/7?a", "x"), (3, "HTTP://Shop.Example.COM/en/7?a", "x"), (4, "http://a.net/de/8#x", "x"), (None, "http://notcom/en/1", "x"), (5, "http://x.com/en/1", "x"), (6, "http://b.example.net/de/81", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    found = {r["page_id"]: r for r in urlfilter.judge(df).collect()}
    assert urlfilter.judge(df).count() == len(rows)
    assert (found[1]["host"], found[1]["path"], found[2]["rule"]) == ("", "", None)
    assert (found[3]["host"], found[3]["path"], found[3]["rule"], found[3]["verdict"]) == ("shop.example.com", "/en/7", "example.com/en/7", "allow")
    assert found[4]["rule"] == "net/de/" and found[4]["verdict"] == "block" and found[6]["verdict"] == "block"
    assert found[6]["rule"] == "example.net/de/8" and found[None]["rule"] is None and found[5]["verdict"] == "block"
    assert urlfilter.judge(df.limit(0)).collect() == []

