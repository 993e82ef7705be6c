from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from barloom.llm import jaccard, langid, simhash


def groups(texts: list[str]) -> list[int]:
    """The first index of each text's group, by all pairs."""
    words = [t.lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def edited_texts() -> list[str]:
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    line = " ".join(word() for _ in range(8))
    texts = ["", "one", "ONE", "one two", "a b c d e", "a b c d e f"]
    for _ in range(12):
        base = [word() for _ in range(rng.randint(20, 150))]
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy) + (f"\n{line}" if rng.random() < 0.5 else ""))
    return texts


@pytest.mark.parametrize("bucket_rows", [2, 64])
def test_representatives_equal_all_pairs(spark, bucket_rows):
    texts = edited_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    label = groups(texts)
    assert len(set(label)) < len(set(texts)) - 10
    assert sorted(r["doc_id"] for r in jaccard.representatives(docs, bucket_rows=bucket_rows).collect()) == sorted(set(label))


def test_stage_drops_near_copies_with_edits(spark):
    words = [f"w{i}" for i in range(200)]
    edited = [*words[:60], "x", *words[61:140], "y", *words[141:]]
    other = [*words[:60], *(f"v{i}" for i in range(140))]
    docs = spark.createDataFrame([(5, " ".join(edited)), (3, " ".join(words)), (9, " ".join(other))], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == [3, 9]


def test_stage_keeps_different_texts_of_one_id(spark):
    rows = [(1, "a b c d e f g"), (1, "h i j k l m n"), (2, "h i j k l m n"), (2, "o p q r s t u"), (None, "o p q r s t u"), (None, "v w x y z"), (None, "v w x y z"), (1, "a b c d e f g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert kept == [(0, "v w x y z"), (1, "a b c d e f g"), (1, "h i j k l m n"), (2, "o p q r s t u")]
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").collect() == []


def test_simhash_representatives_keep_different_texts_of_one_id(spark):
    rows = [(1, "a b c d e f g"), (1, "h i j k l m n"), (2, "h i j k l m n"), (2, "o p q r s t u"), (None, "o p q r s t u"), (1, "a b c d e f g")]
    kept = simhash.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, "a b c d e f g"), (1, "h i j k l m n"), (2, "o p q r s t u")]


def test_language_stage_keeps_every_decided_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    decided = {r["doc_id"] for r in langid.predict(docs).filter("lang_pred <> 'und'").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert kept == decided
    assert {r["text"] for r in docs.filter("text in ('Von.', 'Osrañ.')").collect()} <= {r["text"] for r in docs.filter(docs.doc_id.isin(sorted(kept))).collect()}


def test_a_passage_in_many_different_texts_makes_no_pairs(spark):
    """26 shared words and 5 of their own: all stay; the plan's joins see few rows."""
    passage = " ".join(f"shared{i}" for i in range(26))
    rows = [(i, f"{passage} " + " ".join(f"own{i}x{k}" for k in range(5))) for i in range(3000)] + [(9000, f"{passage} " + " ".join(f"own7x{k}" for k in range(5)) + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in jaccard.representatives(docs).collect()) == list(range(3000))


def test_stage_compares_what_the_fingerprint_cells_link(spark, monkeypatch):
    """Pairs come from the popcount cells of simhash.links() first; keys then join only sets that these leave apart."""
    words = [f"w{i}" for i in range(900)]
    texts = [" ".join(words), " ".join(words[:899]), " ".join(words[1:]), *edited_texts()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tried, made = [], simhash.jaccard.likely

    def watched(sets, near):
        assert near is simhash.links
        tried.extend(made(sets, near).collect())
        return made(sets, near)

    monkeypatch.setattr(jaccard, "likely", watched)
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == sorted(set(groups(texts)))
    signed = lambda s: int(np.uint64(jaccard.xxhash.xxh64_intdigest(s.tobytes(), jaccard.SEED)).view(np.int64))
    fps = {signed(s): simhash.majority(s) for s in map(jaccard.shingles_of, texts)}
    assert tried and all(((fps[r["a"]] ^ fps[r["b"]]) & (1 << 64) - 1).bit_count() <= 2 for r in tried)


def test_sets_come_back_in_small_batches(monkeypatch):
    monkeypatch.setattr(jaccard, "BATCH_TEXTS", 3)
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(["a b c d e f"] * 8)], names=["set", "text"])
    parts = list(jaccard._cut(iter([batch])))
    assert [p.num_rows for p in parts] == [3, 3, 2] and pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert jaccard._lists([jaccard.shingles_of("a b c d e f"), jaccard.shingles_of(None)]).to_pylist() == [jaccard.shingles_of("a b c d e f").tolist(), []]


def test_parities_bound_the_shingles_of_one_set():
    rng = np.random.default_rng(4)
    for shared, own in ((0, 5), (300, 90), (3000, 40), (9000, 2500)):
        both = rng.integers(-(1 << 63), 1 << 63, shared, dtype=np.int64)
        x, y = (np.unique(np.concatenate([both, rng.integers(-(1 << 63), 1 << 63, own, dtype=np.int64)])) for _ in range(2))
        bits = [np.unpackbits(np.frombuffer(jaccard.parities(s), dtype=np.uint8)) for s in (x, y)]
        assert len(bits[0]) == jaccard.PARITIES and (bits[0] != bits[1]).sum() <= len(np.setxor1d(x, y))
    assert not any(jaccard.parities(np.empty(0, dtype=np.int64)))


def test_whole_sets_go_only_to_pairs_that_parities_leave(spark, monkeypatch):
    """Texts that share a passage and are not similar, though their segment counts are near; repeated rows make no more pairs."""
    passage = " ".join(f"shared{i}" for i in range(220))
    texts = [f"{passage} " + " ".join(f"own{i}x{k}" for k in range(31)) for i in range(30)] + [f"{passage} " + " ".join(f"own3x{k}" for k in range(29))]
    assert len(set(groups(texts))) == 30
    docs = spark.createDataFrame([*enumerate(texts), *[(3, texts[3])] * 20], "doc_id long, text string")
    written, made = {}, jaccard.staged

    def counted(df, name):
        out = made(df, name)
        written[name] = written.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "staged", counted)
    monkeypatch.setattr(jaccard, "COMMON", 1000)  # so that keys of the passage come early
    assert sorted(r["doc_id"] for r in jaccard.representatives(docs).collect()) == list(range(30))
    assert written["near-sets"] > 100 > 5 >= written["close-sets"] > 0
