"""Chains of column steps.

A parser is a list of stages, each a set of columns over those of the stages
before. Keeping intermediate results in columns of their own evaluates them once
and keeps generated code small. Building columns costs more than planning them, so
the stage lists are cached; columns hold no data and can be shared by all queries.
"""

from __future__ import annotations

from itertools import zip_longest

from pyspark.sql import Column, DataFrame

Stages = list[dict[str, Column]]


def side_by_side(chains: list[Stages]) -> Stages:
    """Independent chains as one, as long as the longest of them.

    Every stage is a projection that copies the row, so fewer are better.
    """
    merged: Stages = []
    for level in zip_longest(*chains, fillvalue={}):
        merged.append({name: column for stage in level for name, column in stage.items()})
    return merged


def apply_stages(df: DataFrame, stages: Stages, keep: list[str]) -> DataFrame:
    """Add all columns of all stages, then drop those not listed in ``keep``."""
    added: set[str] = set()
    for stage in stages:
        df = df.withColumns(stage)
        added.update(stage)
    return df.drop(*sorted(added - set(keep)))
