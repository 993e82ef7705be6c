from __future__ import annotations

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import decontaminate, langid, packing, secrets, storage


def groups(texts: list[str]) -> list[int]:
    """The first index of each text's group of similar sets of five-word shingles, by all pairs."""
    words = [t.lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def least_edits(item: str, text: str) -> int:
    """The fewest edits that turn the item into some stretch of the text, by the whole table of prefixes and places."""
    t = np.array(list(map(ord, text)), dtype=np.int64)
    slope, row = np.arange(len(t) + 1), np.zeros(len(t) + 1, dtype=np.int64)
    for i, c in enumerate(item, 1):
        new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (t != ord(c)))])
        row = np.minimum.accumulate(new - slope) + slope
    return int(row.min())


def test_pipeline_equals_plain_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    known = langid.predict(docs).filter(F.col("lang_pred") != "und").select("doc_id")
    texts = {r["doc_id"]: r["text"] for r in docs.join(known, "doc_id", "left_semi").orderBy("doc_id").collect()}
    ids = sorted(texts)
    kept = {ids[i] for i in set(groups([texts[d] for d in ids]))}
    items = [decontaminate.normalised(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    grams = lambda t: {t[i : i + decontaminate.Q] for i in range(len(t) - decontaminate.Q + 1)}
    of_items = [grams(t) for t in items]

    def dirty(text: str) -> bool:
        plain = decontaminate.normalised(text)
        own = grams(plain)
        return any(own & g and least_edits(t, plain) <= decontaminate.budget(len(t)) for t, g in zip(items, of_items, strict=True))

    kept = {d for d in kept if not dirty(texts[d])}
    clean = secrets.redacted(docs.filter(F.col("doc_id").isin(sorted(kept))))
    assert clean.columns == columns
    encode = packing.tokenizer(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    lengths = {r["doc_id"]: len(encode(r["text"])) + 1 for r in clean.collect()}
    got: dict[int, int] = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == lengths


def test_odd_rows_go_through(spark, tmp_path):
    """Null ids and texts, repeated rows, and columns that are named like working ones in either case."""
    rows = [(None, "the river and the road", "en", "s", 22, 1), (1, None, "en", "s", 0, 1), (2, "", None, None, 0, 1), (3, "der fluss und die straße token=abcdefgh12", "de", "s", 40, 1), (3, "der fluss und die straße token=abcdefgh12", "de", "s", 40, 1), (4, "the winter of the north", "en", "s", 23, 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars int, "
    docs = spark.createDataFrame(rows, schema + "Found int").withColumns({c: F.lit(1) for c in ("Text_Hash", "SET", "Keys", "Language_Found", "secrets_text", "Held_5")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "nothing of the kind stands here at all, not one bit")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, given, str(tmp_path)).columns == docs.columns, name
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["3", "4", "None"]


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf_dir).collect() == []


def test_python_gets_texts_in_small_batches(spark, sf_dir, monkeypatch):
    """Every job of a stage that hands texts to Python runs under the small batches; behind the stage the session has its own setting again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    own, seen = spark.conf.get(storage.ARROW_ROWS), []

    def watched(df, name, made=storage.staged):
        seen.append((name, int(spark.conf.get(storage.ARROW_ROWS))))
        return made(df, name)

    for module in (corpus_pipeline, packing, corpus_pipeline.simhash, corpus_pipeline.simhash.jaccard):
        monkeypatch.setattr(module, "staged", watched)
    for name, stage in corpus_pipeline.STAGES:
        if name != "secrets":  # no Python
            stage(spark, docs, sf_dir)
            assert spark.conf.get(storage.ARROW_ROWS) == own
    assert {"language_id", "keyed-documents", "shingle-sets", "decontamination", "pieces"} <= {n for n, _ in seen}
    assert {rows for _, rows in seen} == {storage.BATCH_TEXTS}


def test_small_batches_hold_for_jobs_run_in_them(spark):
    @F.pandas_udf("long")
    def together(ids: pd.Series) -> pd.Series:
        return pd.Series([len(ids)] * len(ids))

    rows = spark.range(0, 3000, numPartitions=1).select(together("id").alias("n"))
    most = lambda df: df.agg(F.max("n")).first()[0]
    with storage.small_batches(spark):
        inside = storage.staged(rows, "sizes")
        with storage.small_batches(spark, 7):
            assert most(rows) == 7
            with storage.small_batches(spark):  # a smaller setting stays
                assert most(rows) == 7
    assert most(inside) == storage.BATCH_TEXTS and most(rows) == 3000
    assert storage.written(inside, "again") is inside and storage.written(rows, "sizes") is not rows


def test_language_stage_rejects_texts_unlike_every_language(spark, sf_dir):
    """Long texts in letters that no learned text has, or in none's order, go; short ones and all that is given stay. Where little is learned, all stay."""
    rng = np.random.default_rng(5)
    kinds = {"cyrillic": map(chr, range(0x430, 0x450)), "greek": map(chr, range(0x3B1, 0x3CA)), "han": map(chr, range(0x4E00, 0x5200)), "latin": "abcdefghijklmnopqrstuvwxyz"}
    rows = []
    for k, letters in enumerate(map(list, kinds.values())):
        word = lambda letters=letters: "".join(rng.choice(letters, 6))
        rows += [(1_000_000 + 100 * k + i, " ".join(word() for _ in range(60 if i < 10 else 2))) for i in range(20)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    kept = lambda df: {r["doc_id"] for r in corpus_pipeline.identify_language(spark, df.unionByName(planted, allowMissingColumns=True), "").collect()}
    given, short = {r["doc_id"] for r in docs.collect()}, {d for d, _ in rows if d % 100 >= 10}
    assert kept(docs) == given | short
    few = docs.limit(40)
    assert kept(few) == {r["doc_id"] for r in few.collect()} | {d for d, _ in rows}
