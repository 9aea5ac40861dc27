"""Fingerprints against a plain vote, tables against all pairs, edited texts against the rule."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tickwell.llm import fingerprints as fp

RANDOM = random.Random(5)
VOCABULARY = ["".join(RANDOM.choice("abcdeéß") for _ in range(RANDOM.randint(1, 9))) for _ in range(400)]
M = (1 << 64) - 1


def say(n):
    return " ".join(RANDOM.choice(VOCABULARY) for _ in range(n))


def plain_mix(v):
    v = ((v ^ (v >> 31)) * 0xD6E8FEB86659FD93) & M
    v = ((v ^ (v >> 29)) * 0xA0761D6478BD642F) & M
    return v ^ (v >> 32)


def plain_print(text):
    words = [w[k : k + 24] for w in text.encode().lower().split() for k in range(0, len(w), 24)]
    one = [xxhash.xxh64_intdigest(w, 11) for w in words]
    two = [plain_mix((a * 0x9E3779B97F4A7C15 + b) & M) for a, b in zip(one, one[1:], strict=False)]
    votes = [0] * 128
    for term, times in Counter(one + two).items():
        weight = round(16 * (1 + math.log2(times)))
        bits = term.to_bytes(8, "little") + plain_mix(term ^ M).to_bytes(8, "little")
        for k in range(128):
            votes[k] += weight if bits[k // 8] >> (7 - k % 8) & 1 else -weight
    return int("".join("1" if v > 0 else "0" for v in votes), 2).to_bytes(16)


LONG = say(9000)
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (None, "a lone text " + say(30)), (None, None), (5, "One"), (5, "One"), (5, "Two of five"),
    (6, "é😀"), (7, LONG), (8, "ab" * 600), (9, "漢字かな" * 40), *((20 + k, "The same " + say(0) + " text of them all") for k in range(9)),
    *((40 + k, say(RANDOM.randint(1, 90))) for k in range(30)),
]


def frame(spark, rows, parts=3):
    shape = "doc_id bigint, text string, mark string, salt string, print string"
    return spark.createDataFrame([(i, t, "m", "s", "p") for i, t in rows], shape).repartition(parts)


def test_fingerprints_against_plain(spark):
    made = fp.with_fingerprint(frame(spark, TEXTS), "print_").collect()
    assert len(made) == len(TEXTS)
    for r in made:
        assert bytes(r["print_"]) == plain_print(r.text or "") and r.print == "p"


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(fp, "KNOWN", 5)
    monkeypatch.setattr(fp, "SLICE", 3)
    of = fp.Fingerprinter()
    for text in ("a b c d e f g h", say(50), "a b c d e f g h"):
        assert of(text) == plain_print(text)
    assert len(of.known) < 60


def rows_of(found):
    return Counter((r.doc_id, r.n_chars, r.edited_sha256, bytes(r.print), bytes(r.edited_print), r.near_edited, r.near_next) for r in found)


def plain_edits(texts):
    """`texts` in the order of the chain."""
    out = Counter()
    for (i, t), (_, after) in zip(texts, texts[1:] + texts[:1], strict=True):
        half = len(t) // 2
        changed = t[: len(t) - half] + after[:half]
        a, b, c = map(plain_print, (t, changed, after))
        near = [1 - sum(x != y for x, y in zip(f"{int.from_bytes(a):0128b}", f"{int.from_bytes(o):0128b}", strict=True)) / 128 for o in (b, c)]
        out[i, len(t), hashlib.sha256(changed.encode()).hexdigest(), a, b, *near] += 1
    return out


def in_order(rows):
    """Falling ids, null last; equal ids by the signed hash of their text."""
    mark = lambda t: np.uint64(xxhash.xxh64_intdigest(t, 42)).astype(np.int64)
    return sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), mark(r[1])))


@pytest.mark.parametrize("parts", [1, 5])
def test_edits_against_plain(spark, parts):
    assert rows_of(fp.next_edits(frame(spark, TEXTS, parts)).collect()) == plain_edits(in_order(TEXTS))


@pytest.mark.parametrize("rows", [[], [(4, "alone in the table")], [(4, "x y"), (4, "x y")], [(None, "a b c d"), (2, "e f g")]])
def test_small_tables(spark, rows):
    assert rows_of(fp.next_edits(frame(spark, rows)).collect()) == (plain_edits(in_order(rows)) if rows else Counter())


def test_leads_cover_every_pair():
    for total in (1, 1000, 1 << 20, 1 << 33, 1 << 45):
        marks = [int.from_bytes(m) for m in fp.leads(total, 6)]
        for _ in range(50):
            flips = sum(1 << k for k in RANDOM.sample(range(128), 6))
            assert any(not flips & m for m in marks)
        assert min(m.bit_count() for m in marks) >= min(50, total.bit_length())


def close_prints(count):
    base = [RANDOM.getrandbits(128) for _ in range(12)] + [0, (1 << 128) - 1]
    out = {b: 1 for b in base}
    while len(out) < count:
        near = RANDOM.choice(base) ^ sum(1 << k for k in RANDOM.sample(range(128), RANDOM.randint(1, 9)))
        out[near] = RANDOM.randint(1, 5)
    return out


@pytest.mark.parametrize(("radius", "tile"), [(6, 8192), (6, 10), (0, 8192), (3, 25)])
def test_tables_against_all_pairs(spark, radius, tile):
    prints = close_prints(300)
    rows = [(p.to_bytes(16), n) for p, n in prints.items()]
    table = spark.createDataFrame(rows, "print binary, docs bigint").repartition(4)
    got = {int.from_bytes(r.print): r.n_near for r in fp.neighbours(table, radius, tile).collect()}
    want = {p: sum(n for q, n in prints.items() if (p ^ q).bit_count() <= radius) - 1 for p in prints}
    assert got == want


def test_many_tables(spark, monkeypatch):
    """More blocks than the radius needs, as for very many fingerprints."""
    prints = close_prints(200)
    rows = [(p.to_bytes(16), n) for p, n in prints.items()]
    table = spark.createDataFrame(rows, "print binary, docs bigint")
    marks = fp.leads(1 << 40, 6)
    assert len(marks) > 50
    monkeypatch.setattr(fp, "leads", lambda total, radius: marks)
    got = {int.from_bytes(r.print): r.n_near for r in fp.neighbours(table, 6).collect()}
    assert got == {p: sum(n for q, n in prints.items() if (p ^ q).bit_count() <= 6) - 1 for p in prints}


def test_no_fingerprints(spark):
    assert fp.neighbours(spark.createDataFrame([], "print binary, docs bigint")).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = fp.op11(spark, folder).collect()
    want = plain_edits(in_order(docs))
    got = Counter(
        (r.doc_id, r.n_chars, r.edited_sha256, bytes.fromhex(r.fingerprint), bytes.fromhex(r.edited_fingerprint), r.near_edited, r.near_next)
        for r in found
    )
    assert got == want
    prints = [int.from_bytes(plain_print(t or "")) for _, t in docs]
    near = {i: sum((p ^ q).bit_count() <= 6 for q in prints) - 1 for (i, _), p in zip(docs, prints, strict=True)}
    assert {r.doc_id: r.n_near for r in found} == near
    # Half a text still looks like the text; the next one does not.
    assert np.mean([r.near_edited > r.near_next for r in found if r.n_chars > 200]) > 0.97
