"""Language-model scores by Katz backoff, of order two.

Counts are discounted by Good-Turing, and the mass taken off goes to the next lower order
with weights that make every distribution sum to one: of a word after another to the words
not seen there, by their unigram probabilities; of single words to the one unknown word.

The corpus is cut into blocks of texts, stored as word numbers beside the block's distinct
words. A block asks for each of its distinct words, and then for each of its distinct word
pairs, once. Askings are packed arrays, dealt out by hash; pairs by their first word, and
those of frequent first words by both. Each range of the hash counts its words or pairs
over all blocks and answers every block; what a range holds in memory has one bound at any
size of the corpus, as the number of ranges grows with it. Blocks are bucketed, so they
meet their answers without being moved.

Cases: a null text is empty and is scored as an end alone; a null ``doc_id`` is hashed as
the empty text; repeated rows are counted and scored as often as they occur. An empty
table gives an empty table. With no training tokens every probability is that of an
unknown word, which is then 1.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.llm import words
from loglathe.llm.common import stored, text_or_empty
from loglathe.session import scratch_path

# Text of a block, and words or pairs that one range answers for, roughly.
BLOCK_BYTES = 6 << 20
RANGE_ROWS = 1_500_000
# Good-Turing applies to counts up to this.
GOOD_TURING = 5
# Documents whose crc32 leaves this remainder are held out of the training.
FOLDS, HELD_OUT = 7, 2
_END = np.uint64(0xE4D0E4D0E4D0E4D1)
_START = np.uint64(0x57A2757A2757A275)
_ODD = np.uint64(0x9FB21C651E98DF25)
_LOW48 = np.uint64((1 << 48) - 1)


def packed(numbers) -> bytes:
    """Small numbers, compressed by planes of bytes."""
    flat = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(flat).tobytes(), 1)


def unpacked(data: bytes, wide=np.int64) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel().astype(wide)


def six_bytes(numbers: np.ndarray) -> bytes:
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def from_six(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.view("<u8").ravel()


# -- discounts -----------------------------------------------------------------

def _good_turing(of: list[float]) -> np.ndarray | None:
    """Factors for counts 1 to GOOD_TURING, or None where one is not between 0 and 1."""
    k = GOOD_TURING
    if not all(n > 0 for n in of):
        return None
    over = (k + 1) * of[k] / of[0]
    if over >= 1:
        return None
    factor = np.array([((r + 1) * of[r] / of[r - 1] / r - over) / (1 - over) for r in range(1, k + 1)])
    return factor if ((factor > 0) & (factor < 1)).all() else None


def discounts(of: list[int]) -> np.ndarray:
    """Factors for counts 0 to GOOD_TURING (the first is unused); larger counts keep all.

    ``of[r - 1]`` items occurred r times. Where these numbers are too uneven for Good-Turing,
    they are smoothed by a line through their logarithms; where that fails too, as in tiny
    corpora, half a count is taken off.
    """
    factor = _good_turing(of)
    if factor is None and all(n > 0 for n in of):
        r = np.log(np.arange(1, GOOD_TURING + 2))
        slope, level = np.polyfit(r, np.log(of), 1)
        factor = _good_turing(np.exp(level + slope * r).tolist())
    if factor is None:
        factor = 1 - 0.5 / np.arange(1, GOOD_TURING + 1)
    return np.append(1.0, factor)


def discounted(counts: np.ndarray, factor: np.ndarray) -> np.ndarray:
    return counts * factor[np.where(counts <= GOOD_TURING, counts, 0)] if len(counts) else counts * 1.0


class Unigrams:
    """Probabilities of single words from their counts, and of the unknown word."""

    def __init__(self, of: list[int], total: int, kinds: int):
        self.factor, self.total, self.kinds = discounts(of), total, kinds
        taken = sum((1 - self.factor[r]) * r * of[r - 1] for r in range(1, GOOD_TURING + 1))
        # If nothing was taken off, one count is set aside for the unknown.
        self.scale = 1.0 if taken > 0 else total / (total + 1)
        self.unknown = taken / total if taken > 0 else 1 / (total + 1)

    def p(self, counts: np.ndarray) -> np.ndarray:
        seen = discounted(counts, self.factor) * (self.scale / max(self.total, 1))
        return np.where(counts > 0, seen, self.unknown)


def backoff(after: np.ndarray, rare: np.ndarray, of: np.ndarray, lower: np.ndarray,
            factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each first word: the factor of what was seen after it, and the weight for the rest.

    ``after`` counts its occurrences, ``rare`` says whether any word after it is discounted,
    ``of[:, r - 1]`` counts the words seen r times after it, and ``lower`` is the lower-order
    probability of all words seen after it. Where nothing is discounted, one count is set
    aside for words not seen.
    """
    r = np.arange(1, GOOD_TURING + 1)
    left = (of * r * (1 - factor[1:])).sum(1) / np.maximum(after, 1)
    left = np.where(rare, left, 1 / (after + 1.0))
    weight = np.where(after > 0, left / np.maximum(1 - lower, 1e-12), 1.0)
    return np.where(rare, 1.0, after / (after + 1.0)), weight


# -- blocks --------------------------------------------------------------------

_BLOCK = "block bigint, words binary, tokens binary, sizes array<int>, ids array<bigint>, held array<boolean>"


def _held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_OUT


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, made = TaskContext.get().partitionId(), 0
    ids: list = []
    hashes: list[np.ndarray] = []
    sizes: list[int] = []
    held = 0

    def finish() -> pa.RecordBatch:
        nonlocal made, held
        # Every text ends with an end.
        flat = np.concatenate([part for h in hashes for part in (h, [_END])]).astype(np.uint64)
        known, tokens = np.unique(flat, return_inverse=True)
        row = [task << 32 | made, known.tobytes(), packed(tokens), list(sizes), list(ids),
               [_held_out(i) for i in ids]]
        made, held = made + 1, 0
        for kept in (ids, hashes, sizes):
            kept.clear()
        types = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()),
                 pa.list_(pa.bool_()))
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row, types)],
            names=["block", "words", "tokens", "sizes", "ids", "held"])

    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            rows = batch.slice(start, 512)
            doc_ids = rows.column(0).to_pylist()
            for first, piece in words.chunks(rows.column(1).to_pylist()):
                found, counts, _ = words.word_hashes(piece)
                ends = np.cumsum(counts)
                for k, text in enumerate(piece):
                    hashes.append(found[ends[k] - counts[k]:ends[k]])
                    sizes.append(int(counts[k]) + 1)
                    ids.append(doc_ids[first + k])
                    held += len(text) + 1
                if held >= BLOCK_BYTES:
                    yield finish()
    if ids:
        yield finish()


def blocks(docs: DataFrame, buckets: int) -> DataFrame:
    """The corpus as word numbers, one row per block, bucketed by block."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")
                       ).mapInArrow(_block_rows, _BLOCK)
    name = f"blocks_{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, "block").option("path", scratch_path(spark, "blocks")).saveAsTable(name)
    table = spark.table(name)
    # The files stay; only the name goes.
    spark.sql(f"DROP TABLE {name}")
    return table


class _Block:
    """A block's words and tokens; pairs are numbered in order of their codes."""

    def __init__(self, row: dict):
        self.id = row["block"]
        self.words = np.frombuffer(row["words"], np.uint64)
        # Word numbers and rows of a block fit in 32 bits.
        self.tokens = unpacked(row.pop("tokens"), np.int32)
        sizes = np.array(row["sizes"], np.int64)
        self.owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.ids, self.held = row["ids"], np.array(row["held"], bool)
        self.trains = ~self.held[self.owner]
        self.width = len(self.words) + 1
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        # The start, before each first word, is numbered after all words.
        before[np.cumsum(sizes) - sizes] = len(self.words)
        self.before = before

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and second word of each distinct pair, and the pair of each token."""
        code = self.before.astype(np.int64) * self.width
        code += self.tokens
        code, at = np.unique(code, return_inverse=True)
        return code // self.width, code % self.width, at.astype(np.int32)

    def dealt(self, first, second, counts, total: int, starts: int, ranges: int):
        """Range of every pair, and the ranges of frequent first words, as (range, word) codes."""
        seen = np.append(counts, starts)
        parts = np.clip(np.ceil(seen * (ranges / max(total, 1))).astype(np.int64), 1, ranges)
        hashes = np.append(self.words, _START)
        salt = (self.words[second] >> np.uint64(8)) % parts[first].astype(np.uint64)
        to = (words.mix(hashes[first] + salt * _ODD) % np.uint64(ranges)).astype(np.int64)
        frequent = np.flatnonzero(parts > 1)
        owner = np.repeat(frequent, parts[frequent])
        every = np.arange(len(owner)) - np.repeat(
            np.cumsum(parts[frequent]) - parts[frequent], parts[frequent])
        also = (words.mix(hashes[owner] + every.astype(np.uint64) * _ODD) % np.uint64(ranges)).astype(np.int64)
        width = self.width
        return to * width + first, also * width + owner, parts > 1, hashes


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


# -- single words --------------------------------------------------------------

def _ask_words(ranges: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches):
            block = _Block(row)
            n = np.bincount(block.tokens[block.trains], minlength=len(block.words))
            # Words are in order of their hashes, so each range is a slice.
            to = (block.words >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
            cut = np.searchsorted(to, np.arange(ranges + 1))
            used = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_pydict({
                "range": pa.array(used, pa.int32()), "block": pa.array([block.id] * len(used), pa.int64()),
                "words": pa.array([block.words[cut[r]:cut[r + 1]].tobytes() for r in used], pa.binary()),
                "n": pa.array([packed(n[cut[r]:cut[r + 1]]) for r in used], pa.binary())})

    return ask


_ANSWER = pa.schema([("block", pa.int64()), ("range", pa.int32()), ("counts", pa.binary()),
                     ("rare", pa.binary()), ("places", pa.binary()), ("kinds", pa.binary()), ("lower", pa.binary()),
                     ("of", pa.list_(pa.int64())), ("total", pa.int64()), ("types", pa.int64())])
_ANSWER_DDL = ("block bigint, range int, counts binary, rare binary, places binary, kinds binary, lower binary, "
               "of array<bigint>, total bigint, types bigint")


def _answers(rows: list[tuple], key: int, counts: np.ndarray) -> pa.Table:
    """Answers to blocks, and one row about the counts themselves."""
    of = np.bincount(counts[counts <= GOOD_TURING + 1], minlength=GOOD_TURING + 2)[1:]
    rows = rows + [(None, key, None, None, None, None, None, of.tolist(), int(counts.sum()),
                    int((counts > 0).sum()))]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ANSWER)], schema=_ANSWER)


def _count_words(table: pa.Table) -> pa.Table:
    asked = [np.frombuffer(w, np.uint64) for w in table["words"].to_pylist()]
    n = np.concatenate([unpacked(x) for x in table["n"].to_pylist()])
    _, at = np.unique(np.concatenate(asked), return_inverse=True)
    counts = np.bincount(at, n).astype(np.int64)
    rows, start = [], 0
    key = table["range"][0].as_py()
    for block, own in zip(table["block"].to_pylist(), asked):
        rows.append((block, key, packed(counts[at[start:start + len(own)]]), None, None, None, None,
                     None, None, None))
        start += len(own)
    return _answers(rows, key, counts)


def _summary(answers: DataFrame) -> tuple[list[int], int, int]:
    """How many items occurred 1, 2, ... times; all occurrences; all items."""
    of = [F.coalesce(F.sum(F.col("of")[r]), F.lit(0)) for r in range(GOOD_TURING + 1)]
    row = answers.filter("block IS NULL").agg(
        F.array(*of).alias("of"), F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("types"), F.lit(0)).alias("types")).first()
    return list(row["of"]), row["total"], row["types"]


def _meet(table: DataFrame, *answers: DataFrame) -> DataFrame:
    """Blocks with their answers, which are sent to where the blocks lie."""
    for k, answer in enumerate(answers):
        by_block = answer.filter("block IS NOT NULL").groupBy("block").agg(F.collect_list(
            F.struct("range", "counts", "rare", "places", "kinds", "lower")).alias(f"answers_{k}"))
        table = table.join(by_block, "block")
    return table


def _word_counts(answers: list[dict]) -> np.ndarray:
    ordered = sorted(answers, key=lambda a: a["range"])
    return np.concatenate([unpacked(a["counts"]) for a in ordered])


# -- pairs ---------------------------------------------------------------------

def _ask_pairs(total: int, starts: int, ranges: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches):
            block, counts = _Block(row), _word_counts(row["answers_0"])
            first, second, at = block.pairs()
            n = np.bincount(at[block.trains], minlength=len(first))
            # Only words and pairs are needed from here on.
            del at, row, block.tokens, block.before, block.owner, block.trains
            code, also, frequent, hashes = block.dealt(first, second, counts, total, starts, ranges)
            order = np.argsort(code, kind="stable")
            asked = np.union1d(code, also)
            runs = np.bincount(np.searchsorted(asked, code), minlength=len(asked))
            upto = np.append(0, np.cumsum(runs))
            second, n = second[order], n[order]
            del code, order
            owner = asked % block.width
            cut = np.searchsorted(asked // block.width, np.arange(ranges + 1))
            out = []
            for r in np.flatnonzero(np.diff(cut)):
                low, high = cut[r], cut[r + 1]
                inside = slice(upto[low], upto[high])
                out.append((
                    int(r), block.id, hashes[owner[low:high]].tobytes(), packed(runs[low:high]),
                    packed(frequent[owner[low:high]]), six_bytes(block.words[second[inside]] & _LOW48),
                    packed(n[inside]), packed(counts[second[inside]])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), *[pa.binary()] * 6))],
                names=["range", "block", "firsts", "runs", "frequent", "seconds", "n", "single"])

    return ask


_ASKED_PAIRS = ("range int, block bigint, firsts binary, runs binary, frequent binary, seconds binary, "
                "n binary, single binary")


def _count_pairs(single: Unigrams) -> Callable[[pa.Table], pa.Table]:
    def count(table: pa.Table) -> pa.Table:
        asked = table.to_pylist()
        firsts = [np.frombuffer(a["firsts"], np.uint64) for a in asked]
        runs = [unpacked(a["runs"]) for a in asked]
        names, owner = np.unique(np.concatenate(firsts), return_inverse=True)
        first = np.repeat(owner, np.concatenate(runs))
        second = np.concatenate([from_six(a["seconds"]) for a in asked])
        n = np.concatenate([unpacked(a["n"]) for a in asked])
        alone = np.concatenate([unpacked(a["single"]) for a in asked])
        order = np.lexsort((second, first))
        f, s = first[order], second[order]
        new = np.ones(len(f), bool)
        new[1:] = (f[1:] != f[:-1]) | (s[1:] != s[:-1])
        kind = np.cumsum(new) - 1
        counts = np.bincount(kind, n[order]).astype(np.int64) if len(f) else np.zeros(0, np.int64)
        own_first, p = f[new], single.p(alone[order][new])
        seen = counts > 0
        lower = np.bincount(own_first[seen], p[seen], len(names))
        of = np.stack([np.bincount(own_first[counts == r], minlength=len(names))
                       for r in range(1, GOOD_TURING + 1)], 1)
        each = np.empty(len(f), np.int64)
        each[order] = counts[kind]
        rows, at, place = [], 0, 0
        for a, own, run in zip(asked, firsts, runs):
            size = int(run.sum())
            answer = each[at:at + size]
            blank = np.bincount(np.repeat(np.arange(len(own)), run), answer == 0, len(own)) > 0
            # Weights matter where a pair was never seen, here or in another range.
            told = np.flatnonzero(blank | (unpacked(a["frequent"]) > 0))
            which = owner[place:place + len(own)][told]
            rare = of[owner[place:place + len(own)]].any(1)
            rows.append((a["block"], a["range"], packed(answer), packed(rare), packed(told),
                         packed(of[which].ravel()), lower[which].tobytes(), None, None, None))
            at, place = at + size, place + len(own)
        return _answers(rows, asked[0]["range"], counts)

    return count


# -- scores --------------------------------------------------------------------

_SCORE = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("base_score", pa.float64()), ("score", pa.float64())])
_SCORE_DDL = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
              "score double")


def _score(single: Unigrams, factor: np.ndarray, starts: int, ranges: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches):
            block, counts = _Block(row), _word_counts(row["answers_0"])
            first, second, at = block.pairs()
            code, also, _, _ = block.dealt(first, second, counts, single.total, starts, ranges)
            del block.before, block.trains
            order = np.argsort(code, kind="stable")
            asked = np.union1d(code, also)
            del code
            cut = np.searchsorted(asked // block.width, np.arange(ranges + 1))
            pair = np.empty(len(first), np.int64)
            of, lower = np.zeros((block.width, GOOD_TURING), np.int64), np.zeros(block.width)
            rare = np.zeros(block.width, bool)
            answers = sorted(row.pop("answers_1"), key=lambda a: a["range"])
            del row
            pair[order] = np.concatenate([unpacked(a["counts"]) for a in answers])
            for a in answers:
                own = asked[cut[a["range"]]:cut[a["range"] + 1]] % block.width
                rare[own[unpacked(a["rare"]) > 0]] = True
                own = own[unpacked(a["places"])]
                np.add.at(of, own, unpacked(a["kinds"]).reshape(-1, GOOD_TURING))
                np.add.at(lower, own, np.frombuffer(a["lower"], np.float64))
            del answers, order, asked
            after = np.append(counts, starts)
            scale, weight = backoff(after, rare, of, lower, factor)
            alone = single.p(counts)
            high = discounted(pair, factor) * scale[first] / np.maximum(after[first], 1)
            p = np.where(pair > 0, high, weight[first] * alone[second])
            logs = np.log10(np.maximum(p, 1e-300))
            docs = len(block.ids)
            base = np.log10((counts + 1) / (single.total + single.kinds + 1))
            total = lambda v: np.bincount(block.owner, v, docs)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((
                block.ids, block.held, total(None).astype(np.int64),
                total(counts[block.tokens] > 0).astype(np.int64), total(base[block.tokens]),
                total(logs[at])), _SCORE)], schema=_SCORE)

    return score


def scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    sizes = docs.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    table = blocks(docs, max(8, int(sizes["bytes"] / BLOCK_BYTES)))
    # A token has five bytes or more with its space, mostly; twice as many do no harm.
    ranges = max(64, int(sizes["bytes"] / 6 / RANGE_ROWS))
    starts = docs.filter(F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")),
                                F.lit(FOLDS)) != HELD_OUT).count()
    single_answers = stored(table.mapInArrow(
        _ask_words(ranges), "range int, block bigint, words binary, n binary"
    ).groupBy("range").applyInArrow(_count_words, _ANSWER_DDL), "word-counts")
    of, total, kinds = _summary(single_answers)
    single = Unigrams(of, total, kinds) if total else Unigrams([0] * 6, 0, 0)
    pair_answers = stored(_meet(table, single_answers).mapInArrow(
        _ask_pairs(total, starts, ranges), _ASKED_PAIRS
    ).groupBy("range").applyInArrow(_count_pairs(single), _ANSWER_DDL), "pair-counts")
    factor = discounts(_summary(pair_answers)[0])
    return _meet(table, single_answers, pair_answers).mapInArrow(
        _score(single, factor, starts, ranges), _SCORE_DDL
    ).withColumn("train_tokens", F.lit(total).cast("long"))
