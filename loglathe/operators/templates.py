"""Template mining for unrecognised lines, and field guessing from its output.

Lines are routed to a *leaf* by token count and leading tokens. Within a leaf the
first line is the template; a token position turns into a wildcard at the first
later line that differs there. So a leaf is fully described by its first line and,
per position, by the arrival position of that *break*: line ``n`` sees position
``p`` as a wildcard exactly if ``break[p] <= n``.

That description is found with two partial aggregations over the lines: the first
line per leaf, then the earliest difference per leaf and position. No line is
shuffled or sorted by leaf, and a leaf that holds a third of all lines costs no
more than any other.

Leaves too many to be sent to all tasks, as free text has, are described in one pass. A task
describes the lines it reads, a bounded number at a time, and what it has learned of a leaf is
merged by leaf: where the first lines of two descriptions differ, the later first line is a break.
So a leaf is shuffled as its first lines, not as all its lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.contracts import UNKNOWN_ACTION_WORDS, WILDCARD
from loglathe.functions.text import map_words, tokens
from loglathe.operators.skew import attach_by_key, fits_broadcast
from loglathe.session import cut_lineage, materialize

DEFAULT_DEPTH = 4
DEFAULT_SIMILARITY = 0.4

MODE_RUNNING = "running"
MODE_TWO_PASS = "two_pass"
MODE_SEQUENTIAL = "sequential"
MODE_SIGNATURES = "signatures"
MODES = (MODE_RUNNING, MODE_TWO_PASS, MODE_SEQUENTIAL, MODE_SIGNATURES)

# A break before every line, for positions that an earlier run already wildcarded.
_ALREADY_BROKEN = -(2**62)

LEAF_STATE_SCHEMA = T.StructType([
    T.StructField("leaf", T.StringType(), False),
    T.StructField("first_tokens", T.ArrayType(T.StringType())),
    T.StructField("broken", T.ArrayType(T.BooleanType())),
    T.StructField("n_lines", T.LongType()),
])

# Characters of first lines that a task holds before it hands its descriptions on.
HELD_CHARS = 8_000_000
# Between the tokens of a line as one text: white space, which no token holds.
_BETWEEN = "\x1f"
# A position without a break, where breaks are numbers.
_NEVER = 2**63 - 1

# Field shapes (fixed values)
_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z?$"
_ADDRESS = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"
_ADDRESS_PORT = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}:\d{1,5}$"
_PORT = r"^\d{1,5}$"
_MAX_PORT = 65535

_GUESS_FIELDS = {
    "timestamp": "string", "src_ip": "string", "dst_ip": "string",
    "src_port": "bigint", "dst_port": "bigint", "action": "string",
}


# -- routing ---------------------------------------------------------------

def leaf_key(token_array: Column, depth: int = DEFAULT_DEPTH) -> Column:
    """Token count and leading tokens; a token with a digit routes as a wildcard.

    A search tree of ``depth`` levels spends one on the root, one on the token
    count and one on the leaf itself; the others hold leading tokens.
    """
    parts = [F.size(token_array).cast("string")]
    for i in range(max(depth - 3, 0)):
        token = F.get(token_array, F.lit(i))
        parts.append(F.when(token.rlike(r"\d"), WILDCARD).otherwise(token))
    return F.concat_ws(" ", *parts)


def tokenize_lines(df: DataFrame, when: Column | None = None,
                   depth: int = DEFAULT_DEPTH) -> DataFrame:
    """Add ``tokens`` and ``leaf`` (null where ``when`` does not hold)."""
    split = tokens(F.col("raw_text"))
    df = df.withColumn("tokens", split if when is None else F.when(when, split))
    return df.withColumn(
        "leaf", F.when(F.col("tokens").isNotNull(), leaf_key(F.col("tokens"), depth)))


# -- mining ----------------------------------------------------------------

def mine_leaves(lines: DataFrame, prior: DataFrame | None = None) -> tuple[DataFrame, bool]:
    """Describe every leaf of ``lines(leaf, seq, tokens)``.

    Returns ``(leaf, first_tokens, break_seq, n_lines)`` on reliable storage and
    whether that table is small enough to broadcast. ``prior`` is leaf state from
    earlier lines; its templates come first.
    """
    # Only numbers are aggregated; the tokens of the few first lines are fetched by them.
    starts = cut_lineage(lines.groupBy("leaf").agg(
        F.min("seq").alias("seq"), F.count("*").alias("n_lines")))
    if not fits_broadcast(starts):
        state = _many_leaves(lines, prior)
        return state, fits_broadcast(state)
    firsts = lines.select("leaf", "seq", "tokens").join(F.broadcast(starts), ["leaf", "seq"]).dropDuplicates(
        ["leaf"]).select("leaf", F.col("tokens").alias("first_tokens"), "n_lines")
    if prior is None:
        firsts = firsts.withColumn("broken", F.lit(None).cast("array<boolean>"))
    else:
        firsts = firsts.alias("new").join(prior.alias("old"), "leaf", "full").select(
            "leaf",
            F.coalesce("old.first_tokens", "new.first_tokens").alias("first_tokens"),
            (F.coalesce("old.n_lines", F.lit(0)) + F.coalesce("new.n_lines", F.lit(0)))
            .alias("n_lines"),
            "old.broken",
        )
    firsts = cut_lineage(firsts)
    if not fits_broadcast(firsts):
        state = _many_leaves(lines, prior)
        return state, fits_broadcast(state)

    known = firsts.select("leaf", F.col("first_tokens").alias("first"))
    # Lines that equal the first of their leaf break nothing and are not taken apart.
    pairs = attach_by_key(lines, known, "leaf", True).filter(
        F.col("tokens") != F.col("first")).select(
        "leaf", "seq", F.posexplode(F.arrays_zip("tokens", "first")).alias("pos", "pair"))
    breaks = (
        pairs.filter(F.col("pair.tokens") != F.col("pair.first"))
        .groupBy("leaf", "pos").agg(F.min("seq").alias("at"))
    )
    per_leaf = breaks.groupBy("leaf").agg(
        F.map_from_entries(F.collect_list(F.struct("pos", "at"))).alias("found"))
    break_seq = F.transform(
        F.col("first_tokens"),
        lambda _, p: F.when(F.get("broken", p), F.lit(_ALREADY_BROKEN))
        .otherwise(F.try_element_at("found", p)))
    state = firsts.join(per_leaf, "leaf", "left").select(
        "leaf", "first_tokens", break_seq.alias("break_seq"), "n_lines")
    state = cut_lineage(state)
    # The state is wider than the first lines, so it is measured by itself.
    return state, fits_broadcast(state)


_DESCRIBED = pa.schema([
    ("leaf", pa.string()), ("seq", pa.int64()), ("line", pa.string()),
    ("breaks", pa.list_(pa.int64())), ("n_lines", pa.int64())])
_DESCRIBED_DDL = "leaf string, seq bigint, line string, breaks array<bigint>, n_lines bigint"


class _Leaf:
    """What is known of a leaf from some of its lines: the first one, its breaks, if any, and their number."""

    __slots__ = ("seq", "line", "breaks", "n_lines")

    def __init__(self):
        self.seq, self.line, self.breaks, self.n_lines = None, None, None, 0

    def add(self, seq: int | None, line: str | None, breaks: list[int] | None, n_lines: int) -> None:
        """Take in what is known from other lines, in any order."""
        self.n_lines += n_lines
        # Lines without a place in the order are counted, and break nothing.
        if seq is None:
            return
        if self.seq is None:
            self.seq, self.line, self.breaks = seq, line, breaks
            return
        if seq < self.seq:
            self.seq, self.line, self.breaks, seq, line, breaks = seq, line, breaks, self.seq, self.line, self.breaks
        if line != self.line:
            first, other = self.line.split(_BETWEEN), line.split(_BETWEEN)
            # Where the others begin otherwise, their first line breaks already.
            at = [seq if one != two else _NEVER for one, two in zip(first, other)]
            breaks = at if breaks is None else list(map(min, at, breaks))
        if breaks is not None:
            self.breaks = breaks if self.breaks is None else list(map(min, self.breaks, breaks))


def _rows_of(leaves: list[tuple[str, _Leaf]]) -> pa.RecordBatch:
    rows = [(leaf, d.seq, d.line, d.breaks, d.n_lines) for leaf, d in leaves]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), _DESCRIBED)], schema=_DESCRIBED)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Descriptions of the leaves of lines; a leaf may have several."""
    leaves: dict[str, _Leaf] = {}
    held = 0
    for batch in batches:
        for leaf, seq, line in zip(*(c.to_pylist() for c in batch.columns)):
            found = leaves.get(leaf)
            if found is None:
                found = leaves[leaf] = _Leaf()
                held += len(line)
            found.add(seq, line, None, 1)
            if held > HELD_CHARS:
                yield _rows_of(list(leaves.items()))
                leaves, held = {}, 0
    if leaves:
        yield _rows_of(list(leaves.items()))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One description a leaf; rows of a leaf follow each other."""
    name, found, done, held = None, None, [], 0
    for batch in batches:
        for leaf, *described in zip(*(c.to_pylist() for c in batch.columns)):
            if leaf != name:
                if found is not None:
                    done.append((name, found))
                    held += len(found.line or "")
                if held > HELD_CHARS:
                    yield _rows_of(done)
                    done, held = [], 0
                name, found = leaf, _Leaf()
            found.add(*described)
    if found is not None:
        done.append((name, found))
    if done:
        yield _rows_of(done)


def _many_leaves(lines: DataFrame, prior: DataFrame | None) -> DataFrame:
    """The states of more leaves than are sent to all tasks (stored)."""
    parts = lines.filter("leaf IS NOT NULL").select("leaf", "seq", F.array_join("tokens", _BETWEEN).alias("line"))
    parts = parts.mapInArrow(_describe, _DESCRIBED_DDL)
    if prior is not None:
        # Earlier templates come before all lines.
        parts = parts.unionByName(prior.select(
            "leaf", F.lit(_ALREADY_BROKEN).alias("seq"), F.array_join("first_tokens", _BETWEEN).alias("line"),
            F.transform("broken", lambda b: F.when(b, _ALREADY_BROKEN).otherwise(_NEVER)).alias("breaks"),
            F.col("n_lines").cast("bigint").alias("n_lines")))
    merged = parts.repartition("leaf").sortWithinPartitions("leaf").mapInArrow(_merge, _DESCRIBED_DDL)
    first_tokens = F.when(F.col("line") == "", F.array().cast("array<string>")).otherwise(
        F.split("line", _BETWEEN, -1))
    break_seq = F.transform(
        "first_tokens", lambda _, p: F.nullif(F.get("breaks", p), F.lit(_NEVER)))
    return materialize(merged.filter("seq IS NOT NULL").withColumn("first_tokens", first_tokens).select(
        "leaf", "first_tokens", break_seq.alias("break_seq"), "n_lines"), "leaf-states")


def leaf_state(mined: DataFrame) -> DataFrame:
    """What a later run needs to know of the leaves mined so far."""
    return mined.select(
        "leaf", "first_tokens",
        F.transform("break_seq", lambda at: at.isNotNull()).alias("broken"), "n_lines")


def template_table(mined: DataFrame) -> DataFrame:
    """The learned templates with their line counts."""
    template = F.transform(
        F.col("first_tokens"),
        lambda token, p: F.when(F.get("break_seq", p).isNotNull(), WILDCARD).otherwise(token))
    return mined.select(
        F.col("leaf").alias("leaf_key"), F.lit(1).alias("template_id"),
        template.alias("template"), "n_lines")


# -- use of templates ------------------------------------------------------

def _is_wildcard(at: Column, mode: str) -> Column:
    if mode == MODE_TWO_PASS:
        return at.isNotNull()
    return at <= F.col("seq")


def line_template(mode: str = MODE_RUNNING) -> Column:
    """The template as text, as a line finds it on arrival."""
    return F.array_join(F.transform(
        F.col("first_tokens"),
        lambda token, p: F.when(_is_wildcard(F.get("break_seq", p), mode), WILDCARD)
        .otherwise(token)), " ")


def mined_values(mode: str = MODE_RUNNING) -> Column:
    """The tokens of a line at the wildcards of its leaf."""
    pairs = F.arrays_zip("tokens", "break_seq")
    return F.filter(pairs, lambda pair: _is_wildcard(pair["break_seq"], mode))["tokens"]


def template_values(template: Column, raw_text: Column) -> Column:
    """The tokens of a line at the wildcards of a given template text.

    Empty without a template or when the token counts differ.
    """
    shape, found = F.split(template, " "), tokens(raw_text)
    pairs = F.zip_with(shape, found, lambda t, token: F.when(t == WILDCARD, token))
    usable = (template != "") & (F.size(shape) == F.size(found))
    return F.when(usable, F.array_compact(pairs)).otherwise(F.array().cast("array<string>"))


def classify_tokens(values: Column) -> Column:
    """Guess event fields from extracted values, in their order of appearance."""
    def with_kind(value: Column) -> Column:
        kind = (
            F.when(value.rlike(_TIMESTAMP), "time").when(value.rlike(_ADDRESS_PORT), "endpoint")
            .when(value.rlike(_ADDRESS), "address").when(value.rlike(_PORT), "port")
            .otherwise("word")
        )
        return F.struct(value.alias("text"), kind.alias("kind"))

    start = F.struct(*[F.lit("unknown" if name == "action" else None).cast(kind).alias(name)
                       for name, kind in _GUESS_FIELDS.items()],
                     F.lit(None).cast("string").alias("last_address"))

    def step(seen: Column, item: Column) -> Column:
        text, kind = item["text"], item["kind"]
        number = F.substring_index(text, ":", -1).try_cast("bigint")
        port = F.when(kind.isin("endpoint", "port") & (number <= _MAX_PORT), number)
        address = F.when(kind == "address", text).when(
            kind == "endpoint", F.substring_index(text, ":", 1))
        no_src, no_dst = seen["src_ip"].isNull(), seen["dst_ip"].isNull()
        new_src = address.isNotNull() & no_src
        new_dst = address.isNotNull() & ~no_src & no_dst
        # A bare number is a port only right behind the address it belongs to.
        follows = (kind == "port") & port.isNotNull() & seen["last_address"].isNotNull()
        src_port_here = follows & seen["src_port"].isNull() & seen["last_address"].eqNullSafe(
            seen["src_ip"])
        dst_port_here = follows & ~src_port_here & seen["dst_port"].isNull() & seen[
            "last_address"].eqNullSafe(seen["dst_ip"])
        stamped = F.when(F.endswith(text, F.lit("Z")), text).otherwise(F.concat(text, F.lit("Z")))
        acts = (seen["action"] == "unknown") & (kind == "word")
        return F.struct(
            F.when(kind == "time", stamped).otherwise(seen["timestamp"]).alias("timestamp"),
            F.when(new_src, address).otherwise(seen["src_ip"]).alias("src_ip"),
            F.when(new_dst, address).otherwise(seen["dst_ip"]).alias("dst_ip"),
            F.when(new_src | src_port_here, port).otherwise(seen["src_port"]).alias("src_port"),
            F.when(new_dst | dst_port_here, port).otherwise(seen["dst_port"]).alias("dst_port"),
            F.when(acts, map_words(F.lower(text), UNKNOWN_ACTION_WORDS, "unknown"))
            .otherwise(seen["action"]).alias("action"),
            F.when(kind == "address", text).alias("last_address"),
        )

    def finish(seen: Column) -> Column:
        return F.struct(*[seen[name].alias(name) for name in _GUESS_FIELDS])

    return F.aggregate(F.transform(values, with_kind), start, step, finish)
