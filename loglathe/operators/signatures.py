"""Template mining over distinct masked lines.

A line's *signature* is its tokens with every digit-bearing token masked. Lines are reduced to
their distinct signatures first, with a count, by one partial aggregation; all that follows handles
signatures, of which there are few, and a leaf or a signature with a third of all lines costs no more
than any other.

Within a leaf, signatures are taken in the order of their line counts, then of their text. A signature that agrees
with an earlier *leader* in a large enough share of positions (masked ones agree with nothing)
follows it, and otherwise becomes a leader itself. In the end every follower belongs to the earlier leader
it agrees with most; of equals to the one with more masked positions, then to the earliest. A template is
what all signatures of a leader agree in.
Leaders are found in rounds: the first undecided signatures of each leaf are walked in order, then all that are
similar to a new leader leave, through the index of ``similar``. So a signature meets
candidates only, and no pair of followers is ever compared.

The outcome does not depend on the order of lines. It also describes the first line of a shape.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loglathe.contracts import WILDCARD
from loglathe.operators.similar import LeafIndex, with_template
from loglathe.operators.skew import attach_by_key, fits_broadcast
from loglathe.operators.templates import DEFAULT_SIMILARITY
from loglathe.session import cut_lineage, materialize

CHUNK_SIGNATURES = 1000
MAX_CHUNK_SIGNATURES = 32_000
GROWTH = 4
# A masked position of a leader, and one of a signature that looks for a leader: no token is like them.
_MASK, _LOOKING = "\x00", "\x02"
_SEPARATOR = "\x1f"

SIGNATURE_STATE_SCHEMA = "leaf string, signature string, tokens array<string>, n_lines bigint"


def signature(token_array: Column) -> Column:
    """A line's tokens, digit-bearing ones masked, as one text."""
    return F.array_join(masked(token_array), _SEPARATOR)


def masked(token_array: Column) -> Column:
    return F.transform(token_array, lambda t: F.when(t.rlike(r"\d"), WILDCARD).otherwise(t))


def distinct_signatures(lines: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """``leaf, signature, tokens, n_lines`` of ``lines(leaf, tokens)`` and of earlier ones."""
    found = lines.groupBy("leaf", signature(F.col("tokens")).alias("signature")).agg(
        F.count("*").alias("n_lines"))
    if prior is not None:
        found = found.unionByName(prior.select("leaf", "signature", "n_lines")).groupBy(
            "leaf", "signature").agg(F.sum("n_lines").alias("n_lines"))
    tokens = F.when(F.col("signature") == "", F.array().cast("array<string>")).otherwise(
        F.split("signature", _SEPARATOR))
    return found.select("leaf", "signature", tokens.alias("tokens"), "n_lines")


def _leaders_of(similarity: float):
    def step(rows: pd.DataFrame) -> pd.DataFrame:
        index, leaf = LeafIndex([], similarity), None
        for leaf, place, tokens in rows.sort_values("place")[["leaf", "place", "plain"]].itertuples(index=False):
            tokens = list(tokens)
            if index.best(tokens) is None:
                # Masked positions are broken from the outset.
                index.add({"place": int(place), "tokens": tokens,
                           "breaks": [0 if t == _MASK else None for t in tokens]})
        return pd.DataFrame({"leaf": leaf, "place": [t["place"] for t in index.templates]})

    return step


def _as_template(place: Column) -> list[Column]:
    """A leader in the form of ``similar``; masked positions count as wildcards of old."""
    return [F.col("leaf"), F.lit(0).alias("generation"), place.alias("place"), place.alias("born"),
            F.col("plain").alias("tokens"),
            F.transform("plain", lambda t: F.when(t == _MASK, F.lit(0).cast("bigint"))).alias("breaks")]


def _looking(signatures: DataFrame) -> DataFrame:
    """Signatures in the form of lines that look for the most similar leader before them."""
    return signatures.select("leaf", F.col("place").alias("seq"), F.transform(
        "plain", lambda t: F.when(t == _MASK, _LOOKING).otherwise(t)).alias("tokens"))


def _numbered(signatures: DataFrame) -> DataFrame:
    """Add ``plain`` (masked tokens that equal nothing) and the order within the whole table.

    ``place`` grows with a signature's order inside its leaf. Ranges of one sort give it, so no leaf
    is gathered in one task.
    """
    plain = F.transform("tokens", lambda t: F.when(t == WILDCARD, _MASK).otherwise(t))
    ordered = signatures.withColumn("plain", plain).orderBy("leaf", F.desc("n_lines"), "signature")
    return materialize(ordered.withColumn("place", F.monotonically_increasing_id() + 1), "signatures")


def mine_signatures(lines: DataFrame, similarity: float = DEFAULT_SIMILARITY,
                    prior: DataFrame | None = None,
                    chunk: int = CHUNK_SIGNATURES) -> DataFrame:
    """``leaf, signature, tokens, n_lines, leader, template``, a row per signature.

    ``leader`` numbers the templates; ``template`` is an array of tokens and wildcards.
    ``prior`` is what ``signature_state`` left of earlier runs.
    """
    table = _numbered(distinct_signatures(lines, prior))
    open_, leaders = table, None
    while True:
        rank = F.row_number().over(W.partitionBy("leaf").orderBy("place"))
        head = open_.select("leaf", "place", "plain").withColumn("_rank", rank).filter(
            F.col("_rank") <= chunk).drop("_rank")
        chosen = materialize(head.groupBy("leaf").applyInPandas(
            _leaders_of(similarity), "leaf string, place bigint"), "leaders")
        new = materialize(table.join(chosen.drop("leaf"), "place", "left_semi").select(
            *_as_template(F.col("place"))), "leader-templates")
        leaders = new if leaders is None else materialize(leaders.unionByName(new), "all-leaders")
        # What the walk has passed and what is similar to a new leader leaves.
        left = with_template(_looking(open_), new, similarity).filter(F.col("_cluster").isNull()).select(
            F.col("seq").alias("place"))
        left = cut_lineage(left)
        if left.isEmpty():
            break
        open_ = materialize(table.join(left, "place", "left_semi"), "open-signatures")
        chunk = min(chunk * GROWTH, MAX_CHUNK_SIGNATURES)
    owners = with_template(_looking(table), leaders, similarity).select(
        F.col("seq").alias("place"), F.col("_cluster.place").alias("leader"))
    owned = materialize(table.join(owners, "place").select(
        "leaf", "signature", "tokens", "n_lines", "leader"), "owned-signatures")
    agreed = owned.select("leader", F.posexplode("tokens").alias("pos", "token")).groupBy(
        "leader", "pos").agg(F.min("token").alias("least"), F.max("token").alias("most")).groupBy("leader").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "least", "most"))),
                    lambda p: F.when(p["least"] == p["most"], p["least"]).otherwise(WILDCARD)).alias("template"))
    return materialize(owned.join(agreed, "leader", "left").select(
        "leaf", "signature", "tokens", "n_lines", "leader",
        F.coalesce("template", F.array().cast("array<string>")).alias("template")), "signature-templates")


def signature_state(mined: DataFrame) -> DataFrame:
    """What a later run needs to know: the signatures with their line counts."""
    return mined.select("leaf", "signature", "tokens", "n_lines")


def with_signature_template(df: DataFrame, mined: DataFrame) -> DataFrame:
    """Add ``_template``, the template of each line's signature (null without tokens)."""
    known = mined.select(F.col("signature").alias("_signature"), F.col("template").alias("_template"))
    df = df.withColumn("_signature", signature(F.col("tokens")))
    return attach_by_key(df, known, "_signature", fits_broadcast(known)).drop("_signature")


def template_values_at(template: Column, token_array: Column) -> Column:
    """The tokens of a line at the wildcards of its template."""
    return F.array_compact(F.zip_with(
        template, token_array, lambda t, token: F.when(t == WILDCARD, token)))


def signature_templates(mined: DataFrame) -> DataFrame:
    """The templates with their numbers of signatures and lines."""
    return mined.groupBy("leaf", "leader").agg(
        F.first("template").alias("template"), F.count("*").alias("n_signatures"),
        F.sum("n_lines").alias("n_lines")).select(
        F.col("leaf").alias("leaf_key"), "template", "n_signatures", "n_lines")
