"""Unrecognised lines as a stream whose templates live in Spark's state store.

A leaf is described by its first line and, per position, by the first line that differs there
(see ``operators.templates``). Two such descriptions of different lines of a leaf merge into the
description of all of them. So lines are dealt by leaf and *salt*: each (leaf, salt) keeps the
description of its own lines in the state store, and a leaf with a third of all lines is spread over as many
tasks as there are salts. A description changes at most once per position; only changes leave the
operator. They are merged per leaf with what the leaf was known as, and appended to a log of
changes. Nothing is copied from batch to batch: the log has at most one row per leaf and position that
broke, however long the stream runs.

Positions name the line they broke at, so any later description tells how an earlier line
saw its leaf. A batch that is repeated after a failure reads the log without its own rows and
writes them again. Lines have to arrive in the order of ``seq``, as the tail source delivers them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from loglathe.contracts import RAW_EVENT_SCHEMA
from loglathe.functions.clock import utc_now
from loglathe.operators import templates
from loglathe.operators.normalize import (
    NormalizeOptions, outcomes_of_known_formats, outcomes_of_leaves, unknown_lines,
)
from loglathe.operators.skew import fits_broadcast
from loglathe.plans.batch import EventStore
from loglathe.session import materialize
from loglathe.sources import tables

SALTS = 16
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# The description of some lines of a leaf. ``break_seq`` is null where no line differs.
DESCRIPTION = "leaf string, first_seq bigint, first_tokens array<string>, break_seq array<bigint>"
_LINE = [f.name for f in RAW_EVENT_SCHEMA.fields] + ["tokens"]


def merged(first: dict | None, second: dict) -> dict:
    """The description of the lines of both; each has ``seq``, ``tokens``, ``breaks``."""
    if first is None:
        return second
    old, new = sorted((first, second), key=lambda d: d["seq"])
    breaks = []
    for p, token in enumerate(old["tokens"]):
        # The first line of the younger part is the first of that part to differ, if it does.
        later = new["breaks"][p] if new["tokens"][p] == token else new["seq"]
        known = [at for at in (old["breaks"][p], later) if at is not None]
        breaks.append(min(known) if known else None)
    return {"seq": old["seq"], "tokens": old["tokens"], "breaks": breaks}


def describe(lines: Iterator[tuple[int, list[str]]], known: dict | None) -> dict | None:
    """What ``lines`` (of one leaf, in any order) add to a description."""
    for seq, tokens in lines:
        known = merged(known, {"seq": seq, "tokens": tokens, "breaks": [None] * len(tokens)})
    return known


class LeafProcessor(StatefulProcessor):
    """Per (leaf, salt): its description, and out with it when a batch changes it.

    Lines pass through with null in the description's columns.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "seq bigint, tokens array<string>")
        self.breaks = handle.getMapState("breaks", "pos int", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = None
        if self.first.exists():
            seq, tokens = self.first.get()
            broken = {int(k[0]): int(v[0]) for k, v in self.breaks.iterator()}
            known = {"seq": int(seq), "tokens": list(tokens),
                     "breaks": [broken.get(p) for p in range(len(tokens))]}
        before = known
        for batch in rows:
            batch = batch.drop(columns="salt")
            known = describe(((int(s), list(t)) for s, t in zip(batch["seq"], batch["tokens"])), known)
            yield batch.assign(first_seq=None, first_tokens=None, break_seq=None)
        if known == before:
            return
        if before is None or known["seq"] != before["seq"]:
            self.first.update((known["seq"], known["tokens"]))
        for p, at in enumerate(known["breaks"]):
            if at is not None and (before is None or before["breaks"][p] != at):
                self.breaks.updateValue((p,), (at,))
        change = dict.fromkeys(_LINE)
        change |= {"leaf": key[0], "first_seq": known["seq"], "first_tokens": known["tokens"],
                   "break_seq": known["breaks"]}
        yield pd.DataFrame([change])

    def close(self) -> None:
        pass


def _out_schema() -> T.StructType:
    line = [T.StructField(f.name, f.dataType) for f in RAW_EVENT_SCHEMA.fields]
    line += [T.StructField("tokens", T.ArrayType(T.StringType()))]
    return T.StructType(line + T.StructType.fromDDL(DESCRIPTION).fields)


def described(raw: DataFrame, options: NormalizeOptions, salts: int = SALTS) -> DataFrame:
    """The unrecognised lines of a stream of raw events, and the changed descriptions."""
    names = _out_schema().fieldNames()
    lines = unknown_lines(raw, options.depth).select(
        *_LINE, "leaf", F.pmod(F.xxhash64("event_id"), F.lit(salts)).alias("salt"))
    return lines.groupBy("leaf", "salt").transformWithStateInPandas(
        statefulProcessor=LeafProcessor(), outputStructType=_out_schema(),
        outputMode="append", timeMode="none").select(names)


def _log_path(store: EventStore) -> str:
    return f"{store.root}/template_changes"


def current(store: EventStore, before: str | None = None) -> DataFrame:
    """The newest description of every leaf, of runs ``before`` one if given."""
    schema = T.StructType.fromDDL(DESCRIPTION + ", run string")
    log = tables.read_table(store.spark, _log_path(store), schema)
    if before is not None:
        log = log.filter(F.col("run") < before)
    newest = F.max_by(F.struct("first_seq", "first_tokens", "break_seq"), "run")
    return log.groupBy("leaf").agg(newest.alias("d")).select("leaf", "d.*")


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """One description of a leaf from those of its parts, at most one per salt and the old one."""
    known = None
    for seq, tokens, breaks in zip(rows["first_seq"], rows["first_tokens"], rows["break_seq"]):
        known = merged(known, {"seq": int(seq), "tokens": list(tokens),
                               "breaks": [None if at is None or at != at else int(at) for at in breaks]})
    return pd.DataFrame({"leaf": [rows["leaf"].iloc[0]], "first_seq": [known["seq"]],
                         "first_tokens": [known["tokens"]], "break_seq": [known["breaks"]]})


def process_described(store: EventStore, options: NormalizeOptions, batch: DataFrame,
                      batch_id: int) -> None:
    """Templates and outcomes of one micro-batch."""
    options = replace(options, normalized_at=options.normalized_at or utc_now())
    run = f"u{batch_id:012d}"
    # The stateful operator runs once; what it gave is read from here.
    staged = materialize(batch, "described")
    parts = staged.filter("first_seq IS NOT NULL").select("leaf", "first_seq", "first_tokens", "break_seq")
    if not parts.isEmpty():
        known = current(store, before=run)
        touched = known.join(parts.select("leaf").distinct(), "leaf", "left_semi")
        whole = parts.unionByName(touched).groupBy("leaf").applyInPandas(_merge, DESCRIPTION)
        changed = whole.exceptAll(touched)
        tables.write_table(changed, f"{_log_path(store)}/run={run}")
    lines = staged.filter("first_seq IS NULL").select(*_LINE, "leaf")
    state = materialize(current(store).join(
        lines.select("leaf").distinct(), "leaf", "left_semi"), "leaves")
    found = outcomes_of_leaves(lines, (state, fits_broadcast(state)), options)
    tables.write_outcomes(found, store.outcome_path, run)


def _raw_stream(store: EventStore, max_files: int | None) -> DataFrame:
    reader = store.spark.readStream.schema(RAW_EVENT_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(store.stream_raw_path)


def _started(writer, interval: str, available_now: bool) -> StreamingQuery:
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def start_unknown_stream(store: EventStore, checkpoint: str, options: NormalizeOptions | None = None,
                         interval: str = "1.5 seconds", available_now: bool = False,
                         max_files: int | None = None, salts: int = SALTS) -> StreamingQuery:
    """Outcomes of stored raw events in no known format; templates stay in the state store.

    ``running`` templates only. Beside ``start_known_stream`` on the same store.
    """
    options = options or NormalizeOptions()
    if options.mode != templates.MODE_RUNNING:
        raise ValueError(f"the state store keeps running templates, not {options.mode}")
    store.spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    writer = described(_raw_stream(store, max_files), options, salts).writeStream.outputMode(
        "append").foreachBatch(
        lambda batch, batch_id: process_described(store, options, batch, batch_id)).option(
        "checkpointLocation", checkpoint)
    return _started(writer, interval, available_now)


def start_known_stream(store: EventStore, checkpoint: str, options: NormalizeOptions | None = None,
                       interval: str = "1.5 seconds", available_now: bool = False,
                       max_files: int | None = None) -> StreamingQuery:
    """Outcomes of stored raw events in a known format; needs no state."""
    options = options or NormalizeOptions()

    def process(raw: DataFrame, batch_id: int) -> None:
        fixed = replace(options, normalized_at=options.normalized_at or utc_now())
        tables.write_outcomes(outcomes_of_known_formats(raw, fixed), store.outcome_path,
                              f"k{batch_id:012d}")

    writer = _raw_stream(store, max_files).writeStream.foreachBatch(process).option(
        "checkpointLocation", checkpoint)
    return _started(writer, interval, available_now)
