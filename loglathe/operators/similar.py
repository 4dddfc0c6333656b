"""Lines and the most similar of many templates of their leaf.

A template is a row: ``leaf``, its age (``generation`` and ``place``), the line it was ``born``
at, its ``tokens``, and per token the line from which on it is a wildcard (``breaks``). A
line belongs to the template that agrees with it in most constant positions, if that is a
large enough share of all positions.

Leaves of few templates carry them in one array, and no line is shuffled. For other leaves the
templates are indexed by (position, token). A line that agrees in at least ``t`` of ``n``
positions agrees in one of any ``n - t + 1``, so only its ``n - t + 1`` positions with
the fewest templates are looked up: it meets candidates, never all templates of its leaf. What all
templates have in common (a leading word, say) is never looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglathe.contracts import WILDCARD
from loglathe.operators.skew import attach_by_key, fits_broadcast
from loglathe.session import materialize

TEMPLATE_SCHEMA = ("leaf string, generation int, place bigint, born bigint, "
                   "tokens array<string>, breaks array<bigint>")
# Arrival position of what earlier runs have learned.
BEFORE_ALL = -(2**62)
# Up to so many templates of a leaf are compared as one array.
FEW = 32
# Guards the least number of agreeing positions against rounding; the share itself decides.
_ROUNDING = 1e-9
_AGE = ["generation", "place"]


def needed_hits(length: Column, similarity: float) -> Column:
    """A number of agreeing positions below which no template is similar."""
    return F.greatest(F.ceil(length * F.lit(similarity) - _ROUNDING), F.lit(0)).cast("int")


def _score(cluster: Column, token_array: Column, seq: Column) -> Column:
    """How a template compares with a line, as it was just before that line."""
    same = F.zip_with(cluster["tokens"], token_array, lambda t, token: t == token)
    hits = F.size(F.filter(
        F.zip_with(same, cluster["breaks"], lambda s, at: s & F.coalesce(at >= seq, F.lit(True))),
        lambda hit: hit))
    wild = F.size(F.filter(cluster["breaks"], lambda at: at < seq))
    # The most similar one wins, then the one with more wildcards, then the oldest.
    return F.struct(hits.alias("hits"), wild.alias("wild"), (-cluster["generation"]).alias("g"),
                    (-cluster["place"]).alias("p"), cluster.alias("cluster"))


def _close(best: Column, token_array: Column, similarity: float) -> Column:
    length = F.size(token_array)
    return F.when((length == 0) | (best["hits"] / F.greatest(length, F.lit(1)) >= similarity), best)


def changes(cluster: Column, token_array: Column, seq: Column) -> Column:
    """Whether a line starts a template (it has none) or wildcards a position of its own."""
    differs = F.zip_with(cluster["tokens"], token_array, lambda t, token: t != token)
    fresh = F.zip_with(differs, cluster["breaks"],
                       lambda differ, at: differ & F.coalesce(at >= seq, F.lit(True)))
    return cluster.isNull() | F.exists(fresh, lambda f: f)


def _bundled() -> Column:
    return F.struct("generation", "place", "born", "tokens", "breaks")


def with_template(lines: DataFrame, templates: DataFrame, similarity: float,
                  name: str = "_cluster") -> DataFrame:
    """``lines`` (with ``leaf``, ``seq`` and ``tokens``) and the template each belongs to.

    ``templates`` is read several times and has to be stored. Of a leaf no line may share its ``seq``
    with another one.
    """
    counts = templates.groupBy("leaf").agg(F.count("*").alias("n"))
    counts = materialize(counts, "leaf-sizes")
    crowded = counts.filter(F.col("n") > FEW).select("leaf")
    small = templates if crowded.isEmpty() else templates.join(crowded, "leaf", "left_anti")
    arrays = small.groupBy("leaf").agg(F.collect_list(_bundled()).alias("_templates"))
    best = F.array_max(F.filter(
        F.transform("_templates", lambda c: _score(c, F.col("tokens"), F.col("seq"))),
        lambda s: s["cluster"]["born"] < F.col("seq")))
    own = F.get(F.filter("_templates", lambda c: c["born"] == F.col("seq")), F.lit(0))
    few = attach_by_key(lines, arrays, "leaf", fits_broadcast(arrays)).withColumn("_best", best)
    few = few.withColumn(name, F.coalesce(
        _close(F.col("_best"), F.col("tokens"), similarity)["cluster"], own))
    if crowded.isEmpty():
        return few.drop("_templates", "_best")
    is_crowded = crowded.withColumn("_crowded", F.lit(True))
    marked = attach_by_key(few, is_crowded, "leaf", fits_broadcast(is_crowded))
    rest = marked.filter(F.col("_crowded").isNull()).drop("_templates", "_best", "_crowded")
    many = marked.filter("_crowded").drop("_templates", "_best", "_crowded", name)
    found = best_of_many(many.select("leaf", "seq", "tokens"),
                         templates.join(crowded, "leaf", "left_semi"), similarity)
    own_rows = templates.select(
        "leaf", F.col("born").alias("seq"), _bundled().alias("_own")).filter(F.col("seq") != BEFORE_ALL)
    many = many.join(found.withColumnRenamed("cluster", name), ["leaf", "seq"], "left")
    many = many.join(own_rows, ["leaf", "seq"], "left").withColumn(
        name, F.coalesce(name, "_own")).drop("_own")
    return rest.unionByName(many.select(*rest.columns))


def best_of_many(lines: DataFrame, templates: DataFrame, similarity: float) -> DataFrame:
    """``leaf, seq, cluster`` of the lines that have a similar template, through the index."""
    # Templates without tokens, and thresholds that anything meets, share one entry per leaf.
    entries = templates.select(
        "leaf", *_AGE, F.posexplode(F.concat(F.array(F.lit("")), F.col("tokens"))).alias("pos", "token"))
    entries = materialize(entries, "template-index")
    sizes = entries.filter("pos > 0").groupBy("leaf", "pos", "token").agg(F.count("*").alias("n"))
    length = F.size("tokens")
    plain = lines.withColumn("need", needed_hits(length, similarity))
    exploded = plain.filter((F.col("need") > 0)).select(
        "leaf", "seq", (length - F.col("need") + 1).alias("looked_up"),
        F.posexplode("tokens").alias("pos", "token")).withColumn("pos", F.col("pos") + 1)
    # Few positions per line are kept: the rarest, those without any template first.
    ranked = exploded.join(sizes, ["leaf", "pos", "token"], "left").groupBy("leaf", "seq").agg(
        F.first("looked_up").alias("looked_up"),
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "pos", "token"))).alias("all"))
    keys = ranked.select("leaf", "seq", F.explode(F.slice("all", 1, F.col("looked_up"))).alias("k")).filter(
        "k.n > 0").select("leaf", "seq", "k.pos", "k.token")
    keys = keys.unionByName(plain.filter("need <= 0").select(
        "leaf", "seq", F.lit(0).alias("pos"), F.lit("").alias("token")))
    pairs = keys.join(entries, ["leaf", "pos", "token"]).select("leaf", "seq", *_AGE).distinct()
    met = pairs.join(templates.select("leaf", *_AGE, _bundled().alias("cluster")), ["leaf", *_AGE]).select(
        "leaf", "seq", "cluster").filter(F.col("cluster.born") < F.col("seq"))
    scored = met.join(lines, ["leaf", "seq"]).select(
        "leaf", "seq", F.size("tokens").alias("length"),
        _score(F.col("cluster"), F.col("tokens"), F.col("seq")).alias("score"))
    similar = scored.filter((F.col("length") == 0) | (
        F.col("score.hits") / F.greatest("length", F.lit(1)) >= similarity))
    # Numbers are compared and aggregated; the templates of the winners are fetched by them.
    rank = F.struct("score.hits", "score.wild", "score.g", "score.p")
    best = similar.groupBy("leaf", "seq").agg(F.max(rank).alias("best")).select(
        "leaf", "seq", (-F.col("best.g")).alias("generation"), (-F.col("best.p")).alias("place"))
    return best.join(templates.select("leaf", *_AGE, _bundled().alias("cluster")), ["leaf", *_AGE]).select(
        "leaf", "seq", "cluster")


class LeafIndex:
    """Templates of one leaf, looked up by position and token while lines arrive in order."""

    def __init__(self, templates: list[dict], similarity: float):
        self.templates, self.similarity = [], similarity
        self.at: dict[tuple[int, str], set[int]] = {}
        for template in templates:
            self.add(template)

    def add(self, template: dict) -> None:
        number = len(self.templates)
        self.templates.append(template)
        for p, (token, broken) in enumerate(zip(template["tokens"], template["breaks"])):
            if broken is None:
                self.at.setdefault((p, token), set()).add(number)

    def candidates(self, tokens: list[str]):
        length = len(tokens)
        need = int(-(-(length * self.similarity - _ROUNDING) // 1))
        if need <= 0:
            return range(len(self.templates))
        found = sorted((self.at.get(key, ()) for key in enumerate(tokens)), key=len)
        return set().union(*found[:length - need + 1])

    def best(self, tokens: list[str]) -> int | None:
        """The most similar template of older ones first, or None if none is similar enough."""
        best, chosen = None, None
        for number in self.candidates(tokens):
            template = self.templates[number]
            hits = sum(at is None and t == token for t, token, at in zip(
                template["tokens"], tokens, template["breaks"]))
            rank = (hits, sum(at is not None for at in template["breaks"]), -number)
            if best is None or rank > best:
                best, chosen = rank, number
        if best is None or tokens and best[0] / len(tokens) < self.similarity:
            return None
        return chosen

    def widen(self, number: int, tokens: list[str], seq: int) -> bool:
        """Wildcard where a line differs from a template; whether anything changed."""
        template, changed = self.templates[number], False
        for p, token in enumerate(tokens):
            if template["breaks"][p] is None and template["tokens"][p] != token:
                template["breaks"][p] = seq
                self.at[p, template["tokens"][p]].discard(number)
                changed = True
        return changed


def template_text(cluster: Column, seq: Column | None = None) -> Column:
    """A template as text, as the line ``seq`` leaves it, or in the end."""
    return F.array_join(F.zip_with(
        cluster["tokens"], cluster["breaks"],
        lambda token, at: F.when(at.isNotNull() if seq is None else at <= seq, WILDCARD)
        .otherwise(token)), " ")
