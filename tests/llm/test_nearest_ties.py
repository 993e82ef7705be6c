from __future__ import annotations

import numpy as np

from barloom.llm import ann


def test_copies_tie_by_id_and_own_rows_take_no_place(spark):
    rng = np.random.default_rng(4)
    vectors = [[float(v) for v in row] for row in rng.normal(size=(60, 8)).astype("float32")]
    copies = [(i, vectors[0]) for i in range(3000, 0, -1)] + [(20_000, vectors[1])]
    found = ann.nearest(spark.createDataFrame(copies, "vec_id long, embedding array<float>").coalesce(1), every=20_000).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in found) == [(i, i) for i in range(1, 11)]
    own = [(20_000, vectors[0])] * 2000 + [(i, vectors[i]) for i in range(1, 60)]
    found = ann.nearest(spark.createDataFrame(own, "vec_id long, embedding array<float>").coalesce(1), every=20_000).collect()
    x = np.array(vectors)
    d = np.sqrt(((x[1:] - x[0]) ** 2).sum(1))
    assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"])] == (np.argsort(d)[:10] + 1).tolist()
