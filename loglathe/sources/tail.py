"""A streaming source that follows growing log files.

Spark's file source never looks at a file again, so lines appended to a known file
need a source of their own. Its offset is the byte length taken so far of every
file. The driver lists the folder and opens no file: a line belongs to the batch
and the range that hold its line end, and executors look back for its start. A long backlog of one
file is split over many tasks. The folder has to be on storage that all executors share.

Rules: only files that match the pattern, right below the folder; only lines that
are complete (a line still being written waits for its line end); blank lines are
dropped and others stripped; a file that shrinks yields nothing until it outgrows
its former length, and then goes on from there.

With ``statePath`` offsets are lists of changes against a snapshot of all lengths, kept in that
folder, so that thousands of quiet files cost an offset nothing. ``maxBytesPerTrigger`` (which needs
``statePath``) bounds a batch: polls go round the files in the order of their names, each going on
where the last one stopped, so that no file starves another. With ``notices`` a file found shorter
than before gives a row of its own, see ``NOTICE_SCHEMA``.
"""

from __future__ import annotations

import fnmatch
import json
import logging
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import LongType, StructField, StructType

from loglathe.contracts import LINES_SCHEMA
from loglathe.functions.text import WHITESPACE

FORMAT = "log_tail"
_LOG = logging.getLogger(__name__)

_CHUNK_BYTES = 64 * 1024 * 1024
_LOOK_BACK = 64 * 1024
_BATCH_LINES = 10_000

_READ_BYTES = 1 << 20
_LINE_END = re.compile(rb"[\r\n]")
# Changed files after which an offset begins a new snapshot, and older snapshots that stay.
_SNAPSHOT_AFTER = 1000
_SNAPSHOTS_KEPT = 3

# Lines, and in rows without text the present and the former length of a shrunk file.
NOTICE_SCHEMA = StructType([
    *LINES_SCHEMA.fields, StructField("shrunk_to", LongType()), StructField("shrunk_from", LongType())])

_ARROW_SCHEMA = pa.schema([
    ("source_name", pa.string()), ("line_no", pa.int64()), ("seq", pa.int64()),
    ("raw_text", pa.string()),
])


_NOTICE_ARROW = pa.schema([
    *_ARROW_SCHEMA, ("shrunk_to", pa.int64()), ("shrunk_from", pa.int64())])


@dataclass
class ByteRange(InputPartition):
    """Lines that end within ``[start, stop)`` of one file."""

    name: str
    start: int
    stop: int
    # Added to a byte position to get the arrival position over all files.
    shift: int


def last_line_end(stream, size: int) -> int:
    """The position behind the last line end before ``size``, reading backwards."""
    stop = size
    while stop > 0:
        start = max(0, stop - _LOOK_BACK)
        stream.seek(start)
        block = stream.read(stop - start)
        found = max(block.rfind(b"\n"), block.rfind(b"\r"))
        if found >= 0:
            return start + found + 1
        stop = start
    return 0


def lines_in_range(stream, start: int, stop: int) -> Iterator[tuple[int, str]]:
    """``(position, text)`` of the non-blank lines whose line end lies within the range."""
    for position, _, text in _ended_lines(stream, start, stop):
        yield position, text


def _ended_lines(stream, start: int, stop: int) -> Iterator[tuple[int, int, str]]:
    """Also the position of the line end, by which a line is counted once."""
    position = last_line_end(stream, start)
    stream.seek(position)
    rest, at = b"", position
    while at < stop:
        block = stream.read(min(_READ_BYTES, stop - at))
        if not block:
            return
        at += len(block)
        *ended, rest = _LINE_END.split(rest + block)
        for piece in ended:
            end = position + len(piece)
            text = piece.decode("utf-8", errors="replace").strip(WHITESPACE)
            # Line ends that the look back has passed belong to ranges before.
            if text and end >= start:
                yield position, end, text
            position = end + 1


@dataclass
class Notice(InputPartition):
    """A file that was found shorter than before."""

    name: str
    size: int
    former: int


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.pattern = options.get("pathglobfilter", "*.log")
        self.starting = options.get("startingoffsets", "latest")
        self.chunk_bytes = int(options.get("chunkbytes", _CHUNK_BYTES))
        self.budget = int(options.get("maxbytespertrigger", 0))
        self.state_path = options.get("statepath")
        self.notices = options.get("notices", "false").lower() == "true"
        if self.starting not in ("latest", "earliest"):
            raise ValueError(f"startingOffsets must be latest or earliest: {self.starting}")
        if self.budget and not self.state_path:
            # After a restart the next batch has to go on from the last one's end.
            raise ValueError("maxBytesPerTrigger needs a statePath")
        # Taken bytes per file, so far; of those, what changed since the snapshot.
        self.known: dict[str, int] = {}
        self.snapshot, self.changed, self.arrived, self.next = 0, {}, 0, ""
        self.snapshots: dict[int, dict[str, int]] = {0: {}}
        # Files warned about, with the length they had then and before.
        self.shrunk: dict[str, list[int]] = {}
        self.loaded, self.initial, self.cleaned = False, None, 0

    # -- files ---------------------------------------------------------------

    def _open(self, path: str):
        if path.startswith("/"):
            return pafs.LocalFileSystem(), path.rstrip("/")
        filesystem, folder = pafs.FileSystem.from_uri(path)
        return filesystem, folder.rstrip("/")

    def _sizes(self) -> list[tuple[str, int]]:
        """Name and size of the files that match, from one listing."""
        filesystem, folder = self._open(self.path)
        selector = pafs.FileSelector(folder, recursive=False, allow_not_found=True)
        return sorted((info.base_name, info.size) for info in filesystem.get_file_info(selector)
                      if info.type == pafs.FileType.File and fnmatch.fnmatchcase(info.base_name, self.pattern))

    def _write_state(self, name: str, content: dict) -> None:
        filesystem, folder = self._open(self.state_path)
        filesystem.create_dir(folder, recursive=True)
        with filesystem.open_output_stream(f"{folder}/.{name}") as stream:
            stream.write(json.dumps(content).encode())
        filesystem.move(f"{folder}/.{name}", f"{folder}/{name}")

    def _read_state(self, name: str) -> dict | None:
        filesystem, folder = self._open(self.state_path)
        if filesystem.get_file_info(f"{folder}/{name}").type == pafs.FileType.NotFound:
            return None
        with filesystem.open_input_file(f"{folder}/{name}") as stream:
            return json.loads(stream.read())

    def _snapshot(self, number: int) -> dict[str, int]:
        if number not in self.snapshots:
            found = self._read_state(f"snapshot-{number}")
            if found is None:
                raise ValueError(f"statePath has no snapshot {number}: {self.state_path}")
            self.snapshots[number] = found
        return self.snapshots[number]

    # -- offsets -------------------------------------------------------------

    def _offset(self) -> dict:
        shrunk = {"shrunk": dict(sorted(self.shrunk.items()))} if self.notices and self.shrunk else {}
        if not self.state_path:
            return {"files": dict(sorted(self.known.items())), **shrunk}
        return {"snapshot": self.snapshot, "changed": dict(sorted(self.changed.items())),
                "arrived": self.arrived, "next": self.next, **shrunk}

    def _take_over(self, offset: dict) -> None:
        """Go on from an offset that an earlier reader gave."""
        if "files" in offset:
            for name, length in offset["files"].items():
                self.known[name] = max(length, self.known.get(name, 0))
        elif not self.loaded or offset["arrived"] > self.arrived:
            self.snapshot, self.changed = offset["snapshot"], dict(offset["changed"])
            self.arrived, self.next = offset["arrived"], offset["next"]
            self.known = {**self._snapshot(self.snapshot), **self.changed}
        self.shrunk.update({k: list(v) for k, v in offset.get("shrunk", {}).items()})
        self.loaded = True

    def _poll(self, budget: int) -> None:
        sizes = self._sizes()
        # Go round from where the last poll stopped.
        turn = next((i for i, (name, _) in enumerate(sizes) if name >= self.next), 0)
        left = budget or float("inf")
        for name, size in sizes[turn:] + sizes[:turn]:
            before = self.known.get(name, 0)
            if size <= before:
                self.known.setdefault(name, before)
                if size < before and self.shrunk.get(name, [None])[0] != size:
                    self.shrunk[name] = [size, before]
                    _LOG.warning("%s shrank from %d bytes to %d; nothing is read until it "
                                 "outgrows that length", name, before, size)
                continue
            self.shrunk.pop(name, None)
            taken = int(min(size - before, left))
            if taken:
                self.known[name] = self.changed[name] = before + taken
                self.arrived += taken
                left -= taken
            if left <= 0:
                self.next = name
                break
        else:
            self.next = ""
        if self.state_path and len(self.changed) > _SNAPSHOT_AFTER:
            self.snapshot, self.changed = self.snapshot + 1, {}
            self.snapshots[self.snapshot] = dict(self.known)
            self._write_state(f"snapshot-{self.snapshot}", self.known)

    def _begin(self) -> None:
        """The state before the next poll, which a restart asks for before it names an offset."""
        if self.loaded:
            return
        last = self._read_state("last") if self.state_path else None
        if last is not None:
            self.initial = self._read_state("initial")
            self._take_over(last)
            return
        self.loaded = True
        if self.starting == "latest":
            # What is there already is the baseline, not an arrival.
            self._poll(0)
            self.arrived = 0
        self.initial = self._offset()
        if self.state_path:
            self._write_state("initial", self.initial)

    def initialOffset(self) -> dict:
        # Spark may have asked for the latest offset first.
        self._begin()
        return self.initial

    def latestOffset(self) -> dict:
        self._begin()
        self._poll(self.budget)
        return self._issued()

    def _issued(self) -> dict:
        offset = self._offset()
        if self.state_path:
            self._write_state("last", offset)
        return offset

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self._take_over(start)
        ranges: list[InputPartition] = []
        if "files" in end:
            arrived, before, after = sum(start["files"].values()), start["files"], end["files"]
            names = after
        else:
            arrived = start["arrived"]
            before = {**self._snapshot(start["snapshot"]), **start["changed"]}
            after = {**self._snapshot(end["snapshot"]), **end["changed"]}
            names = end["changed"] if start["snapshot"] == end["snapshot"] else after
        for name in sorted(names):
            begin, stop = before.get(name, 0), after[name]
            for chunk in range(begin, stop, self.chunk_bytes):
                ranges.append(ByteRange(name, chunk, min(chunk + self.chunk_bytes, stop),
                                        arrived - begin))
            arrived += max(0, stop - begin)
        for name, (size, former) in end.get("shrunk", {}).items():
            if start.get("shrunk", {}).get(name) != [size, former]:
                ranges.append(Notice(name, size, former))
        return ranges

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Notice):
            columns = [[partition.name], [None], [None], [None], [partition.size], [partition.former]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _NOTICE_ARROW)], schema=_NOTICE_ARROW)
            return
        filesystem, folder = self._open(self.path)
        positions: list[int] = []
        arrivals: list[int] = []
        texts: list[str] = []

        def batch() -> pa.RecordBatch:
            columns = [
                pa.array([partition.name] * len(texts), pa.string()),
                pa.array(positions, pa.int64()),
                pa.array(arrivals, pa.int64()),
                pa.array(texts, pa.string()),
            ]
            if not self.notices:
                return pa.RecordBatch.from_arrays(columns, schema=_ARROW_SCHEMA)
            columns += [pa.nulls(len(texts), pa.int64())] * 2
            return pa.RecordBatch.from_arrays(columns, schema=_NOTICE_ARROW)

        with filesystem.open_input_file(f"{folder}/{partition.name}") as stream:
            for position, end, text in _ended_lines(stream, partition.start, partition.stop):
                positions.append(position)
                arrivals.append(end + partition.shift)
                texts.append(text)
                if len(texts) == _BATCH_LINES:
                    yield batch()
                    positions, arrivals, texts = [], [], []
        if texts:
            yield batch()

    def commit(self, end: dict) -> None:
        """Snapshots that no offset needs any more go."""
        oldest = end.get("snapshot", 0) - _SNAPSHOTS_KEPT
        if not self.state_path or oldest <= self.cleaned:
            return
        filesystem, folder = self._open(self.state_path)
        for info in filesystem.get_file_info(pafs.FileSelector(folder)):
            kind, _, number = info.base_name.partition("-")
            if kind == "snapshot" and int(number) <= oldest:
                self.snapshots.pop(int(number), None)
                filesystem.delete_file(info.path)
        self.cleaned = oldest


class LogTailSource(DataSource):
    """``spark.readStream.format("log_tail").load(folder)``

    Options: ``startingOffsets`` (latest, earliest), ``pathGlobFilter`` (``*.log``),
    ``chunkBytes`` (bytes per task), ``maxBytesPerTrigger``, ``statePath``, ``notices``.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        notices = {k.lower(): v for k, v in self.options.items()}.get("notices", "false")
        return NOTICE_SCHEMA if notices.lower() == "true" else LINES_SCHEMA

    def streamReader(self, schema: StructType) -> TailReader:
        return TailReader({key.lower(): value for key, value in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LogTailSource)

