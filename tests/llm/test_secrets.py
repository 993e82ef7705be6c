from __future__ import annotations

import random
import re
import string

from barloom.llm import secrets

PLAIN = ["configuration_manager_service", "internationalization", "getUserAccountSettingsById", "src/main/java/com/example/Main", "2024-01-31_report_final_version", "AbstractSingletonProxyFactoryBean", "https-proxy-agent-keepalive", "================", "4845168114407329"]


def test_random_strings_are_told_from_identifiers(spark, sf_dir):
    """Held-out tokens of several alphabets, letters only among them, against identifiers and the words of the corpus."""
    rng = random.Random(11)
    alphabets = [(string.ascii_letters + string.digits, 24), (string.ascii_lowercase, 20), (string.ascii_letters, 32), (string.ascii_letters + string.digits + "+/", 40)]
    planted = ["".join(rng.choice(a) for _ in range(n)) for a, n in alphabets for _ in range(30)] + ["AbX9f83kLmQz72PdsT0vYw1Z"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [(-1 - i, f"\U0001f600 see {t}, please") for i, t in enumerate([*planted, *PLAIN])]
    found = {r["doc_id"]: r["found"] for r in secrets.scan(docs.union(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    spans = lambda i: [(s["kind"], s["start"], s["end"]) for s in found[-1 - i]]
    hits = [i for i, t in enumerate(planted) if spans(i) == [("random", 6, 6 + len(t))]]
    assert len(hits) >= 0.85 * len(planted) and len(planted) - 1 in hits
    assert [t for i, t in enumerate(PLAIN) if spans(len(planted) + i)] == []
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert not [d for d, f in found.items() if d is not None and d >= 0 and any(s["kind"] == "random" for s in f)]
    assert any(re.search(secrets.RUN, t) for t in texts.values())


def test_many_matches_in_a_long_text(spark):
    text = "password=abcdefgh1 " * 3000
    rows = secrets.digest(secrets.scan(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"))).collect()
    assert {r["doc_id"]: r["n_assign"] for r in rows} == {1: 3000, 2: 0}
    clean = secrets.redacted(spark.createDataFrame([(1, "x password=abcdefgh1 y", 22, "a")], "doc_id long, text string, n_chars int, Held_0 string")).collect()
    assert [tuple(r) for r in clean] == [(1, "x [SECRET] y", 12, "a")]
