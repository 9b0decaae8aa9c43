"""Rows of the awkward documents, for fixtures and for brute force alike."""

import random

CLASH = ("id", "hash", "kept", "size", "shard", "slot", "t0", "t1", "rid", "n", "lines", "cuts", "target",
         "taken", "group", "cluster", "part", "fp", "score", "lang_pred", "pos", "start", "first", "_t0", "_t1",
         "_found", "_words", "_turns", "_n", "_kept", "_g", "_hot", "_salt")
SCHEMA = ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long",
                    *(f"{c} string" for c in CLASH)])


def words(seed, n, alphabet="abcdefgh"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(1, 6))) for _ in range(n))


def odd_documents():
    """(doc_id, text, lang, source) of rows that break careless code."""
    line = "a line that is long enough to be counted as shared text"
    rows = [
        (1, "one two  three\nfour", "en", "a"),
        (2, "one two three four", "en", "b"),
        (1, "one two  three\nfour", "en", "a"),  # a repeated row
        (None, "one\ttwo three four", None, None),
        (None, None, None, None),
        (3, None, "en", "a"),
        (4, "", "de", None),
        (5, " \n\t ", "de", "c"),
        (6, "12345 !!! ???", "fr", "c"),
        (7, words(1, 30_000), "en", "a"),
        (8, "x", None, "z"),
        (9, "\n\n", "fr", "a"),
        (10, "ZÜRICH été İ K", "de", "\U0001f600"),
    ]
    rows += [(20 + i, f"{line}\n{words(i, 12)}\n {line.upper()} ", "en", "a") for i in range(6)]
    rows += [(40 + i, words(50, 90) + f" tail{i % 3}", "en", "b") for i in range(8)]
    rows += [(60 + i, "same text in many rows", "en", "a") for i in range(25)]
    return rows


def full(rows):
    return [(i, t, lang, s, None if t is None else len(t), *(["x"] * len(CLASH))) for i, t, lang, s in rows]
