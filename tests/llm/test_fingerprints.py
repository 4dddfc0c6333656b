from __future__ import annotations

import hashlib
import random

from loglathe.llm import fingerprints as fp
from tests.llm import data


def test_spans_and_extensions():
    rng = random.Random(1)
    a = "".join(rng.choice("ab\U0001F600") for _ in range(400))
    b = "xyz" + a[:150] + "?" + a[151:]
    x, y = fp.prefixes(fp.code_points(a)), fp.prefixes(fp.code_points(b))
    for _ in range(300):
        n = rng.randrange(0, 60)
        i, j = rng.randrange(len(a) - n + 1), rng.randrange(len(b) - n + 1)
        assert fp.equal_spans(x, i, y, j, n) == (a[i:i + n] == b[j:j + n])
        k = 0
        while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
            k += 1
        assert fp.longest_extension(x, i, y, j) == k
    assert fp.longest_extension(x, 0, y, 3) == 150


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def in_report(r):
    return r[0] is None, r[0] or 0, r[1], r[2]


def check(docs, rows):
    out = sorted(map(tuple, fp.compare_neighbours(docs).collect()),
                 key=in_report)
    expected = []
    ordered = in_order([r[:2] for r in rows])
    for k, (doc_id, text, *_) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        expected.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), text, changed, following))
    expected.sort(key=in_report)
    marks = {}
    assert len(out) == len(expected)
    for got, (doc_id, n, digest, text, changed, following) in zip(out, expected):
        assert got[:3] == (doc_id, n, digest)
        for value, mark in ((text, got[3]), (changed, got[4])):
            assert marks.setdefault(value, mark) == mark
        assert got[5] == (1.0 if text == changed else got[5]) and 0 <= got[5] <= 1
        assert (got[6] == 1.0) == (text == following)
        if n > 200 and text != changed:
            assert 0.4 <= got[5] <= 0.9
    assert len(set(marks.values())) == len(marks)


def test_against_brute_force_in_several_ranges(spark):
    rows = data.documents()
    for parts in (1, 8):
        kept = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            check(data.with_clashes(data.table(spark).repartition(3)), rows)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_single_document_and_empty_table(spark):
    check(data.table(spark, [(5, "abcd", "en", "a", 4)]), [(5, "abcd")])
    check(data.table(spark, [(None, None, None, None, None)]), [(None, None)])
    assert fp.compare_neighbours(data.table(spark, [])).count() == 0


def test_likeness_of_shifted_and_moved_text():
    rng = random.Random(4)

    def mark(text):
        return fp.Mark(fp.prefixes(fp.code_points(text)))

    for n in (2_000, 18_000, 60_000):
        text = "".join(rng.choice("abcdefgh \U0001F600") for _ in range(n))
        half = n // 2
        cuts = sorted(rng.sample(range(n), 3))
        cases = [("?" + text, 0.95), (text[1:], 0.95), (text[half:] + text[:half], 0.9),
                 ("".join(c for i, c in enumerate(text) if i not in cuts), 0.85), (text[:half], 0.45)]
        for other, least in cases:
            assert least <= fp.alike(mark(text), mark(other)) < 1, (n, len(other), least)
            assert least <= fp.alike(mark(other), mark(text)) < 1
        assert fp.alike(mark(text), mark(text)) == 1.0
        assert fp.alike(mark(text), mark("".join(rng.sample(text, n)))) < 0.02


def test_likeness_never_exceeds_what_plain_matching_finds():
    from difflib import SequenceMatcher
    rng = random.Random(6)
    base = "".join(rng.choice("abcdefgh") for _ in range(1_500))
    for _ in range(20):
        i, j = sorted(rng.sample(range(len(base)), 2))
        other = base[:i] + "".join(rng.choice("xyz") for _ in range(rng.randrange(40))) + base[j:]
        one, two = (fp.Mark(fp.prefixes(fp.code_points(t))) for t in (base, other))
        found = SequenceMatcher(None, base, other, autojunk=False).get_matching_blocks()
        plain = sum(b.size for b in found) / max(len(base), len(other))
        got = fp.alike(one, two)
        # Up to two spans are cut where a stretch begins or ends, and short chance matches count.
        assert plain - 0.12 <= got <= plain + 1e-9
