"""Text vectors against a plain build, letters of all planes."""

from __future__ import annotations

import sys

import numpy as np

from barloom.llm import langid

GOTHIC = "".join(map(chr, range(0x10330, 0x10340)))
TEXTS = ["Hello, World! hello", "", "12 .. 3", "Größe  ßtraße", "a", GOTHIC + " " + GOTHIC[3:9], "x" * 300 + "\U00020000\U0001f600y"]


def plain_vector(text: str, dimensions: int) -> np.ndarray:
    """A trigram at a time: the letters' vectors, rotated by their places, multiplied; runs of other characters are one blank."""
    letters = langid.letter_vectors(dimensions).astype(np.int64)
    symbols = [0]
    for c in text.lower():
        s = (ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % (langid.SYMBOLS - 27)) if c.isalpha() else 0
        if s or symbols[-1]:
            symbols.append(s)
    if symbols[-1]:
        symbols.append(0)
    total = np.zeros(dimensions, np.int64)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False):
        total += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    size = np.sqrt((total * total).sum())
    return total / size if size else total.astype(float)


def test_vectors_equal_a_plain_build():
    found = langid.Encoder(128).vectors(TEXTS)
    for text, v in zip(TEXTS, found, strict=True):
        np.testing.assert_allclose(v, plain_vector(text, 128), atol=1e-5)


def test_no_letter_is_beyond_the_table():
    table = langid.symbol_table()
    assert not any(chr(k).isalpha() for k in range(len(table) - 1, sys.maxunicode + 1)) and table[-1] == 0
    assert (table[[ord(c) for c in GOTHIC]] > 0).all() and langid.trigram_codes(chr(sys.maxunicode), table).size == 0


def test_letters_beyond_the_basic_plane_are_learned(spark):
    rows = [(k, GOTHIC[k % 7 : k % 7 + 6] + " " + GOTHIC[2:9] if k % 2 else "the cat sat on the mat and the dog", "got" if k % 2 else "en") for k in range(60)]
    found = langid.predict(spark.createDataFrame([*rows, (99, GOTHIC[1:8], None)], "doc_id long, text string, lang string")).collect()
    truth = {k: lang for k, _, lang in rows} | {99: "got"}
    assert all(r["lang_pred"] == truth[r["doc_id"]] and r["score"] > 0 for r in found)
