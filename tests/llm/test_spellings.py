"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tickwell.llm import spellings

RANDOM = random.Random(11)
LETTERS = "abcdez" + "éßÿÀ÷"


def word(n):
    return "".join(RANDOM.choice(LETTERS) for _ in range(n))


def damaged(text):
    at = RANDOM.randrange(len(text))
    return RANDOM.choice(
        [text[:at] + text[at + 1 :], text[:at] + RANDOM.choice(LETTERS) + text[at:], text[:at] + RANDOM.choice(LETTERS) + text[at + 1 :]]
    )


def one_edit(a, b):
    """By trying every edit of the longer word."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def plain_variants(counts):
    out = {}
    for w, n in counts.items():
        others = [o for o in counts if one_edit(w, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] < 2 * n:
            best = None
        out[w] = [best, n, len(others), counts.get(best)]
    for w, row in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        row.append(root)
    return {w: tuple(row) for w, row in out.items()}


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def got(frame):
    rows = [(r.word, (r.form, r.n, r.n_near, r.form_n, r.root)) for r in frame.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


@pytest.fixture(scope="module")
def counts():
    seeds = [word(RANDOM.randint(5, 9)) for _ in range(40)]
    words = set(seeds)
    for _ in range(260):
        words.add(damaged(RANDOM.choice(sorted(words))))
    # Anagrams of one word, a chain of forms, ties, and very long words.
    words |= {"".join(RANDOM.sample("abcdef", 6)) for _ in range(60)} | {"a" * k for k in range(5, 14)}
    words |= {"b" * 700, "b" * 701, "b" * 350 + "c" + "b" * 350}
    out = {w: RANDOM.choice([3, 3, 4, 7, 20, 100]) for w in sorted(words) if len(w) >= 5}
    return out | {"a" * k: 3 * 2**k for k in range(5, 14)}


@pytest.mark.parametrize(("groups", "block", "guests"), [(8, 2048, 8192), (1, 7, 20), (3, 5, 1), (12, 2, 9)])
def test_variants(spark, counts, groups, block, guests):
    frame = spark.createDataFrame([*counts.items(), (None, 5)], "word string, n bigint").repartition(3)
    assert got(spellings.variants(frame, groups, block=block, guests=guests)) == plain_variants(counts)


def test_every_edit_is_one_move_or_none():
    """From either side a pair of near words meets exactly once."""
    for groups in (1, 4, 8):
        moves = {tuple(m) for m in spellings.steps(groups)}
        assert not moves & {tuple(-np.array(m)) for m in moves}
        for _ in range(300):
            a = word(RANDOM.randint(5, 8))
            b = damaged(a)
            x, y = (np.bincount([spellings.LETTER[ord(c)] % groups for c in w], minlength=groups) for w in (a, b))
            ways = (tuple(y - x) in moves) + (tuple(x - y) in moves) + (x == y).all()
            assert ways == 1


ROWS = [
    (1, None), (2, ""), (None, "Straße straße strasse Strase"), (None, "1234 ×÷ ÀÉ-ÿ"), (3, "Colour COLOUR colour color; colors, Colors"),
    (3, "Colour COLOUR colour color; colors, Colors"), (4, "don't x" + "y" * 5000), (5, "x" + "y" * 5000 + " É" * 7),
    *((10 + k, " ".join(RANDOM.choice(["colour", "Color", "coloürs", "étude", "étudé", "Étude", "etude", "house", "mouse", "horse"]) for _ in range(200))) for k in range(40)),
]


def test_whole_texts(spark):
    shape = "doc_id bigint, text string, word string, n string"
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in ROWS], shape).repartition(3)
    words = spellings.vocabulary(docs)
    want = plain_words(ROWS)
    assert {r.word: r.n for r in words.collect()} == want
    assert got(spellings.variants(words)) == plain_variants(want)


def test_flush_of_held_words(spark, monkeypatch):
    monkeypatch.setattr(spellings, "HELD", 3)
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    assert {r.word: r.n for r in spellings.vocabulary(docs).collect()} == plain_words(ROWS)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert spellings.variants(spellings.vocabulary(none)).collect() == []


def test_query_against_plain(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    counts = plain_words([(r.doc_id, r.text) for r in docs])
    found = got(spellings.op13(spark, folder))
    assert {w: row[1] for w, row in found.items()} == counts
    some = dict(sorted(counts.items())[:: max(1, len(counts) // 60)])
    for w in some:
        others = [o for o in counts if abs(len(o) - len(w)) <= 1 and one_edit(w, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form = best if best is not None and counts[best] >= 2 * counts[w] else None
        assert (found[w][0], found[w][2], found[w][3]) == (form, len(others), counts.get(form))
