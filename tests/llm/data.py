"""Small tables with every awkward case, and plain restatements of what words are."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return [w.translate(_LOWER) for w in WORD.findall(text or "")]


def prose(rng: random.Random, n: int) -> str:
    syllables = "ba be bi bo da de di do ka ke ki ko la le li lo ma me mi mo éa ñu".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def edited(rng: random.Random, text: str, edits: int) -> str:
    parts = text.split(" ")
    for _ in range(edits):
        parts[rng.randrange(len(parts))] = f"edit{rng.randrange(10 ** 6)}"
    return " ".join(parts)


def documents(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    base, shared = prose(rng, 120), prose(rng, 60)
    texts = [
        None, "", " \t\n\x0b\f\r ", "one", "One  two", "a b c d", "a b c d e", "A B C D E",
        "a b c d e f", base, base, base + " ", base.replace(" ", "  "), shared,
        prose(rng, 40) + " " + shared + " " + prose(rng, 50), shared + " " + prose(rng, 90),
        prose(rng, 70) + "\n" + edited(rng, shared, 3), "    \U0001F600 ﬁ", "x" * 5000,
        prose(rng, 9000), "la " * 3000, "Äİ \x1c\x1d",
    ]
    texts += [edited(rng, base, rng.randrange(1, 12)) for _ in range(20)]
    texts += [prose(rng, rng.randrange(1, 200)) for _ in range(30)]
    sources = [None, "b", "a", "a", "c", "B"]
    rows = [(7 * i - 3, t, rng.choice(["en", None]), sources[i % len(sources)], len(t or ""))
            for i, t in enumerate(texts)]
    # Repeated rows, a repeated id, and a row without an id.
    rows += [rows[10], rows[0], (rows[5][0], "another text", "en", "a", 12), (None, base, "de", "a", 1),
             (None, None, None, None, None)]
    return rows


def table(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def with_clashes(docs):
    """More columns, named like the operators' own."""
    from pyspark.sql import functions as F
    for name in ("row", "size", "digest", "key", "class", "taken", "score", "copies_", "id_", "kept_id",
                 "Text_Score", "words", "src", "component", "n", "doc"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    return docs
