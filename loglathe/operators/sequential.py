"""Template mining for leaves that hold several line shapes.

Lines join the most similar template of their leaf if it reaches a similarity
threshold, and start a new template otherwise; the positions where a line differs
from its template become wildcards. The result depends on the order of the lines,
yet lines that change nothing need no order. So each round walks in order through
the next lines of every leaf that is still open (a bounded number, more in later rounds), and
then looks in parallel for the first later line that would change a template. All
lines before that one are settled. Rounds repeat from there until no line changes
anything; no line is left out and no leaf is gathered in one task.

The state has one row per template. A walk is handed only the templates that one of its lines
can be similar to, found through the index of ``similar``, and keeps such an index itself; so a leaf
of thousands of templates costs a line no more than its candidates.

A template is kept as its first line and, per position, the arrival position from
which it is a wildcard, so the state at any line can be told afterwards.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loglathe.operators.similar import (
    BEFORE_ALL, TEMPLATE_SCHEMA, LeafIndex, changes, needed_hits, template_text, with_template,
)
from loglathe.operators.skew import attach_by_key, fits_broadcast
from loglathe.operators.templates import DEFAULT_SIMILARITY
from loglathe.session import cut_lineage, materialize

# Lines walked in order per leaf: in the first round, and at most (a window group limit takes
# the first lines of a leaf on the map side already). Each round walks GROWTH times more.
CHUNK_LINES = 1000
MAX_CHUNK_LINES = 32_000
GROWTH = 4

_WALKED = f"{TEMPLATE_SCHEMA}, settled bigint"
_KEY = ["leaf", "generation", "place"]


def line_cluster(lines: DataFrame, templates: DataFrame,
                 similarity: float = DEFAULT_SIMILARITY) -> DataFrame:
    """Add ``_cluster``: the template a line joined, else the one it started."""
    return with_template(lines, templates, similarity)


def sequential_values(cluster: Column) -> Column:
    """The tokens of a line at the wildcards of its template, its own break included."""
    picked = F.zip_with("tokens", cluster["breaks"],
                        lambda token, at: F.when(at <= F.col("seq"), token))
    return F.coalesce(F.array_compact(picked), F.array().cast("array<string>"))


def sequential_template(cluster: Column) -> Column:
    """The template as text, as a line leaves it."""
    return template_text(cluster, F.col("seq"))


def _whole(value) -> int | None:
    return None if value is None or value != value else int(value)


def _stepper(similarity: float, generation: int):
    def step(lines: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values(["generation", "place"])
        index = LeafIndex([
            {"generation": int(g), "place": int(p), "born": int(b), "tokens": list(t),
             "breaks": [_whole(at) for at in breaks]}
            for g, p, b, t, breaks in zip(known["generation"], known["place"], known["born"],
                                          known["tokens"], known["breaks"])], similarity)
        touched, leaf, last = set(), None, None
        for leaf, last, tokens in lines.sort_values("seq")[["leaf", "seq", "tokens"]].itertuples(index=False):
            last, tokens = int(last), list(tokens)
            number = index.best(tokens)
            if number is None:
                touched.add(len(index.templates))
                index.add({"generation": generation, "place": last, "born": last, "tokens": tokens,
                           "breaks": [None] * len(tokens)})
            elif index.widen(number, tokens, last):
                touched.add(number)
        rows = [{"leaf": leaf, **index.templates[k], "settled": None} for k in sorted(touched)]
        if last is not None:
            rows.append({"leaf": leaf, "generation": None, "place": None, "born": None,
                         "tokens": None, "breaks": None, "settled": last})
        out = pd.DataFrame(rows, columns=["leaf", "generation", "place", "born", "tokens", "breaks",
                                          "settled"])
        return out.astype({"generation": "Int32", "place": "Int64", "born": "Int64", "settled": "Int64"})

    return step


def _index_keys(rows: DataFrame, need: Column | None) -> DataFrame:
    """Entries under which a template can be found, and under which a line looks."""
    pairs = F.posexplode(F.concat(F.array(F.lit("")), F.col("tokens")))
    out = rows.select(*rows.columns, pairs.alias("pos", "token"))
    if need is None:
        return out
    # A line looks under position 0 only where any template will do.
    return out.filter((F.col("pos") > 0) == (need > 0))


def _candidates(head: DataFrame, state: DataFrame, similarity: float) -> DataFrame:
    """The templates that some line of ``head`` may join.

    Per line the positions whose tokens fewest templates have are looked up, as many as are sure
    to hold a hit.
    """
    length = F.size("tokens")
    lines = head.select("leaf", "tokens").distinct().withColumn("line", F.xxhash64("leaf", "tokens"))
    entries = _index_keys(state.select(*_KEY, "tokens"), None).drop("tokens")
    sizes = entries.groupBy("leaf", "pos", "token").agg(F.count("*").alias("n"))
    looks = _index_keys(lines, needed_hits(length, similarity)).withColumn(
        "most", F.when(F.col("pos") == 0, 1).otherwise(length - needed_hits(length, similarity) + 1))
    looks = looks.drop("tokens").join(sizes, ["leaf", "pos", "token"], "left")
    ranked = looks.groupBy("leaf", "line").agg(
        F.first("most").alias("most"), F.array_sort(F.collect_list(
            F.struct(F.coalesce("n", F.lit(0)).alias("n"), "pos", "token"))).alias("all"))
    wanted = ranked.select("leaf", F.explode(F.slice("all", 1, F.col("most"))).alias("k")).filter(
        "k.n > 0").select("leaf", "k.pos", "k.token").distinct()
    keys = entries.join(wanted, ["leaf", "pos", "token"]).select(*_KEY).distinct()
    return state.join(keys, _KEY, "left_semi")


def mine_sequential(lines: DataFrame, similarity: float = DEFAULT_SIMILARITY,
                    chunk_lines: int = CHUNK_LINES,
                    prior: DataFrame | None = None) -> DataFrame:
    """All templates of ``lines(leaf, seq, tokens)``, a row each, on shared storage.

    ``prior`` has the same form, from ``cluster_state``.
    """
    spark = lines.sparkSession
    lines = materialize(lines.select("leaf", "seq", "tokens"), "leaf-lines")
    state = spark.createDataFrame([], TEMPLATE_SCHEMA) if prior is None else prior
    generation = (state.agg(F.max("generation")).first()[0] or 0) + 1
    pending, chunk, first = lines, chunk_lines, prior is None
    while True:
        rank = F.row_number().over(W.partitionBy("leaf").orderBy("seq"))
        head = materialize(pending.withColumn("_rank", rank).filter(
            F.col("_rank") <= chunk).drop("_rank"), "leaf-heads")
        known = state if first else _candidates(head, state, similarity)
        walked = materialize(head.groupBy("leaf").cogroup(known.groupBy("leaf")).applyInPandas(
            _stepper(similarity, generation), _WALKED), "walked")
        ends = walked.filter("settled IS NOT NULL").select("leaf", "settled")
        changed = walked.filter("settled IS NULL").drop("settled")
        state = materialize(
            changed if first else state.join(changed, _KEY, "left_anti").unionByName(changed),
            "templates")
        first = False
        ahead = attach_by_key(pending, ends, "leaf", fits_broadcast(ends)).filter(
            F.col("seq") > F.col("settled")).select("leaf", "seq", "tokens")
        # Lines alike meet the same templates, so the first of them stands for all.
        ahead = materialize(ahead.groupBy("leaf", "tokens").agg(F.min("seq").alias("seq")), "ahead")
        next_change = cut_lineage(with_template(ahead, state, similarity).filter(
            changes(F.col("_cluster"), F.col("tokens"), F.col("seq"))
        ).groupBy("leaf").agg(F.min("seq").alias("_next")))
        if next_change.isEmpty():
            return state
        pending = attach_by_key(lines, next_change, "leaf", fits_broadcast(next_change)).filter(
            F.col("seq") >= F.col("_next")).drop("_next")
        chunk = min(chunk * GROWTH, max(chunk_lines, MAX_CHUNK_LINES))


def cluster_state(mined: DataFrame) -> DataFrame:
    """What a later run needs to know: templates that precede all its lines."""
    return mined.select(
        "leaf", "generation", "place", F.lit(BEFORE_ALL).alias("born"), "tokens",
        F.transform("breaks", lambda at: F.when(at.isNotNull(), F.lit(BEFORE_ALL))).alias("breaks"))


def cluster_templates(mined: DataFrame) -> DataFrame:
    """The learned templates, numbered within their leaf in order of appearance."""
    order = W.partitionBy("leaf").orderBy("generation", "place")
    template = F.zip_with("tokens", "breaks", lambda token, at: F.when(
        at.isNotNull(), F.lit("<*>")).otherwise(token))
    return mined.select(F.col("leaf").alias("leaf_key"), F.row_number().over(order).alias("template_id"),
                        template.alias("template"))
