from __future__ import annotations

import hashlib
import random
from collections import Counter

from loglathe.llm import middle
from loglathe.llm.queries import ORACLES
from tests.llm import data


def plain_example(doc_id, text, rate=100, spm=50):
    """The definition, with strings only."""
    lines, rest = [], text
    while rest:
        line, mark, rest = rest.partition("\n")
        lines.append(line + mark)
    n = len(lines)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or c % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((a % (n + 1), b % (n + 1)))
    prefix, mid, suffix = ("".join(p) for p in (lines[:low], lines[low:high], lines[high:]))
    if d % 100 < spm:
        return n, "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return n, "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


def rows_with_lines():
    rng = random.Random(5)
    rows = data.documents()
    texts = ["\n", "\n\n", "a", "a\n", "a\nb", "<P>", "x <S> y", "<M", "<", "<<\n<\n<P\n", "é\r\nü z\n",
             "<S\n>\n<\nP>\n"]
    texts += ["\n".join(data.prose(rng, rng.randrange(0, 9)) for _ in range(rng.randrange(1, 40)))
              for _ in range(40)]
    rows += [(10_000 + i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    rows += [(20_000 + i, "<\n<P\n<S\n<M\nS>\n", "en", "a", 1) for i in range(40)]
    return rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests_equal_the_definition(spark):
    rows = rows_with_lines()
    want = Counter()
    for r in rows:
        n, form, p, m, out = plain_example(r[0], r[1] or "")
        want[r[0], n, form, p, m, sha(out), sha(r[1] or "")] += 1
    got = Counter(tuple(r) for r in middle.digests(data.table(spark, rows)).collect())
    assert got == want
    assert {k[2] for k in got} == {"plain", "psm", "spm"}


def test_transform_and_restore_give_every_text_back(spark):
    docs = data.table(spark, rows_with_lines())
    for options in ({}, {"unit": "char", "rate": 70, "spm_share": 20, "seed": "s"}):
        out = middle.restore(middle.transform(docs, **options))
        rows = out.collect()
        assert all(r["restored"] == (r["text"] or "") for r in rows)
        assert len({r["form"] for r in rows}) == 3
        made = [r for r in rows if r["form"] != "plain"]
        assert all(len(r["output"]) == len(r["text"]) + 9 for r in made)


def test_transform_keeps_columns_with_clashing_names(spark):
    docs = data.with_clashes(data.table(spark)).withColumn("output", data_lit("own"))
    docs = docs.withColumn("argument_1", data_lit("own")).withColumn("form", data_lit("own"))
    out = middle.transform(docs)
    assert out.columns == [*docs.columns, "_n", "_form", "prefix_chars", "middle_chars", "_output"]
    assert {(r["output"], r["form"], r["argument_1"], r["n"]) for r in out.collect()} == {
        ("own", "own", "own", "own n")}
    back = middle.restore(out, "_output", "_form").collect()
    assert all(r["restored"] == (r["text"] or "") for r in back)
    assert middle.digests(docs).count() == docs.count()


def data_lit(value):
    from pyspark.sql import functions as F
    return F.lit(value)


def test_outputs_that_are_not_of_their_form_restore_to_null(spark):
    rows = [("<P>a<S>b", "psm"), ("x<P>a<S>b<M>c", "psm"), ("a", "other"), (None, "plain"), ("a", None)]
    out = middle.restore(spark.createDataFrame(rows, "output string, form string"))
    assert [r["restored"] for r in out.collect()] == [None] * 5


def test_cutting_splits_descriptors_only():
    table = middle.PieceTable.over("abcdef")
    assert [table.cut(k) for k in (2, 4, 4, 0, 6)] == [1, 2, 2, 0, 3]
    assert table.pieces == [(0, 0, 2), (0, 2, 4), (0, 4, 6)]
    assert table.arranged(table.pieces[::-1]).text() == "efcdab"
    assert table.parts(2, 2)[1] == []


def test_empty_table(spark):
    assert middle.digests(data.table(spark, [])).count() == 0
    assert middle.restore(middle.transform(data.table(spark, []))).count() == 0


def test_query_has_sql():
    assert "op13_fill_in_middle" in ORACLES
