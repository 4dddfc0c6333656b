from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from loglathe.llm import katz
from tests.llm import data


def factors(of):
    """Good-Turing, smoothed by a line in logarithms, or half a count."""
    attempts = [list(of)]
    if all(of):
        x = np.log(np.arange(1, 7))
        slope, level = np.polyfit(x, np.log(of), 1)
        attempts.append(list(np.exp(level + slope * x)))
    for n in attempts:
        if all(n) and 6 * n[5] < n[0]:
            over = 6 * n[5] / n[0]
            f = [((r + 1) * n[r] / n[r - 1] / r - over) / (1 - over) for r in range(1, 6)]
            if all(0 < v < 1 for v in f):
                return f
    return [1 - 0.5 / r for r in range(1, 6)]


class Plain:
    """The model with dictionaries."""

    def __init__(self, texts):
        self.words, self.after = Counter(), defaultdict(Counter)
        for w in texts:
            self.words.update(w)
            for a, b in zip([None, *w], w):
                self.after[a][b] += 1
        self.total = sum(self.words.values())
        times = Counter(self.words.values())
        d = factors([times[r] for r in range(1, 7)])
        p = {w: (d[c - 1] if c <= 5 else 1) * c / self.total for w, c in self.words.items()}
        if 1 - sum(p.values()) < 1e-12:
            p = {w: v * self.total / (self.total + 1) for w, v in p.items()}
        self.single, self.unknown = p, 1 - sum(p.values())
        times = Counter(c for m in self.after.values() for c in m.values())
        d = factors([times[r] for r in range(1, 7)])
        self.pairs, self.weight = {}, {}
        for h, m in self.after.items():
            n = sum(m.values())
            scale = 1 if min(m.values()) <= 5 else n / (n + 1)
            self.pairs[h] = {w: (d[c - 1] if c <= 5 else 1) * c / n * scale for w, c in m.items()}
            self.weight[h] = (1 - sum(self.pairs[h].values())) / (1 - sum(p[w] for w in m))

    def p(self, h, w):
        low = self.single.get(w, self.unknown)
        if h not in self.pairs:
            return low
        return self.pairs[h].get(w, self.weight[h] * low)


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def check(spark, rows):
    texts = [(r[0], [*data.words_of(r[1]), "\n"]) for r in rows]
    model = Plain([w for i, w in texts if not held_out(i)])
    kinds = len(model.words)
    expected = []
    for i, w in texts:
        base = sum(math.log10((model.words[x] + 1) / (model.total + kinds + 1)) for x in w)
        score = sum(math.log10(model.p(h, x)) for h, x in zip([None, *w], w))
        expected.append((i is None, i or 0, held_out(i), len(w), sum(x in model.words for x in w),
                         model.total, base, score))
    found = [(r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"],
              r["train_tokens"], r["base_score"], r["score"])
             for r in katz.scores(data.with_clashes(data.table(spark, rows))).collect()]
    assert len(found) == len(expected)
    for one, two in zip(sorted(found), sorted(expected)):
        assert one[:6] == two[:6]
        assert one[6:] == pytest.approx(two[6:], rel=1e-9)
    for h in list(model.pairs)[:20]:
        assert sum(model.p(h, w) for w in model.words) + model.p(h, "unknown") == pytest.approx(1)


def test_against_dictionaries(spark):
    check(spark, data.documents())


def test_frequent_words_are_split_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(katz, "RANGE_ROWS", 20)
    rng = random.Random(5)
    rows = [(i, " ".join("the " + w for w in data.prose(rng, 60).split()), "en", "a", 0) for i in range(60)]
    rows += [(500 + i, "so so " * 40 + "good", "en", "a", 0) for i in range(30)]
    check(spark, rows)


def test_small_corpora(spark):
    check(spark, [(1, "a", "en", "a", 1), (2, None, "en", "a", 0)])
    assert katz.scores(data.table(spark, [])).count() == 0
    (row,) = katz.scores(data.table(spark, [(next(i for i in range(99) if held_out(i)), "a b", "en", "a", 1)])).collect()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["score"] == 0.0 and row["base_score"] == 0.0


def test_packing():
    numbers = np.array([0, 1, 255, 256, 70000, 2 ** 32 - 1])
    assert katz.unpacked(katz.packed(numbers)).tolist() == numbers.tolist()
    assert katz.unpacked(katz.packed(numbers[:0])).tolist() == []
    wide = np.array([0, 2 ** 48 - 1, 12345678901234], np.uint64)
    assert katz.from_six(katz.six_bytes(wide)).tolist() == wide.tolist()
