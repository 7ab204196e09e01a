"""Tail of log files as a stream whose micro-batches are bounded by entries (S8-S10, ST1).

The built-in file source admits whole files.  This one admits lines: an offset
says how far each file has been read, and a micro-batch goes at most ``entries``
lines further, so a batch ends, and a restart resumes, inside a file.  Only the
batch's line ends are looked for where the query is planned; the lines are read
by tasks, one byte range each.

Options: ``path``, a folder; ``progress``, a shared file of the query's own,
which remembers what was planned last (the checkpoint holds the offsets, but a
source isn't told them before it has to name the next one); ``entries`` a
batch (2,500); ``batches`` that a micro-batch takes at most (1; with more, a column
``batch`` numbers them from 0 within the micro-batch); ``start``, ``beginning`` or ``end`` (S9: what is there when
the query first starts isn't read at all); ``task_bytes`` of a byte range.

Files are read in the order of their names.  They may grow at the end, new ones
may come; a line counts when its line end is there, or a file of a later name.
Paths are those that ``pyarrow.fs`` opens on the driver and on the executors.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Fixed value: entries after which the reference forwarder flushes.
ENTRIES = 2_500
TASK_BYTES = 1 << 20
SCHEMA = "raw string, source string, line_offset long"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path; a plain path is a local or mounted one."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file:///") else path)
    return fs.LocalFileSystem(), path


class Range(InputPartition):
    """Bytes of a file, whole lines, of one batch of the micro-batch."""

    def __init__(self, name: str, begin: int, end: int, batch: int = 0):
        self.name, self.begin, self.end, self.batch = name, begin, end, batch


class TailReader(DataSourceStreamReader):
    """Offsets are {"files": {name: bytes read}, "entries": lines so far}."""

    def __init__(self, options: dict):
        self.path, self.entries, self.batches = options["path"], int(options.get("entries", ENTRIES)), int(options.get("batches", 1))
        self.from_end = options.get("start", "beginning") == "end"
        self.task_bytes, self.progress = int(options.get("task_bytes", TASK_BYTES)), options["progress"]
        self.planned: dict | None = None

    def _files(self) -> list[tuple[str, int]]:
        files, path = _open(self.path)
        found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return sorted((f.base_name, f.size) for f in found if f.is_file and not f.base_name.startswith((".", "_")))

    def _remembered(self) -> dict | None:
        files, path = _open(self.progress)
        if files.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with files.open_input_stream(path) as f:
            return json.loads(f.read())

    def _remember(self, offset: dict) -> None:
        files, path = _open(self.progress)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        with files.open_output_stream(path + ".new") as f:
            f.write(json.dumps(offset).encode())
        files.move(path + ".new", path)

    def initialOffset(self) -> dict:
        at = {"files": {name: size for name, size in self._files()} if self.from_end else {}, "entries": 0}
        self._remember(at)
        self.planned = at
        return at

    def latestOffset(self) -> dict:
        """At most ``batches`` times ``entries`` lines after what was planned last."""
        if self.planned is None:
            self.planned = self._remembered() or self.initialOffset()
        most = self.entries * self.batches
        read, left = dict(self.planned["files"]), most
        there = self._files()
        for i, (name, size) in enumerate(there):
            if left <= 0:
                break
            at = read.get(name, 0)
            if size > at:
                end, lines = self._advance(name, at, size, left, last=i + 1 == len(there))
                if lines:
                    read[name], left = end, left - lines
        return {"files": read, "entries": self.planned["entries"] + most - left}

    def _advance(self, name: str, begin: int, size: int, most: int, last: bool) -> tuple[int, int]:
        """(where reading ends, lines up to there) after ``most`` lines or at the file's end."""
        files, path = _open(self.path)
        end, lines, at = begin, 0, begin
        with files.open_input_file(f"{path}/{name}") as f:
            while at < size and lines < most:
                f.seek(at)
                data = f.read(min(self.task_bytes, size - at))
                found = data.count(b"\n")
                if lines + found < most:
                    lines += found
                    end = at + data.rfind(b"\n") + 1 if found else end
                    at += len(data)
                    continue
                place = -1
                for _ in range(most - lines):
                    place = data.index(b"\n", place + 1)
                return at + place + 1, most
        if not last and lines < most and end < size:
            return size, lines + 1  # a last line without an end, in a file that no longer grows
        return end, lines

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.planned = end
        self._remember(end)
        out = []
        for name, begin, to, batch in self._batches(start, end):
            while begin < to:
                stop = to
                if to - begin > self.task_bytes:
                    stop = self._line_end(name, begin + self.task_bytes, to)
                out.append(Range(name, begin, stop, batch))
                begin = stop
        return out

    def _batches(self, start: dict, end: dict) -> Iterator[tuple[str, int, int, int]]:
        """(file, begin, end, batch): a batch is full after ``entries`` lines, wherever in
        a file that is, and goes on in the next file until then."""
        batch, room = 0, self.entries
        for name, to in sorted(end["files"].items()):
            begin = start["files"].get(name, 0)
            while begin < to:
                if self.batches == 1:
                    stop = to
                else:
                    if not room:
                        batch, room = batch + 1, self.entries
                    stop, lines = self._advance(name, begin, to, room, last=False)
                    room -= lines
                yield name, begin, stop, batch
                begin = stop

    def _line_end(self, name: str, at: int, most: int) -> int:
        """The end of the line that the byte at ``at`` is in, ``most`` at the latest."""
        files, path = _open(self.path)
        with files.open_input_file(f"{path}/{name}") as f:
            while at < most:
                f.seek(at)
                data = f.read(min(1 << 16, most - at))
                if b"\n" in data:
                    return at + data.index(b"\n") + 1
                at += len(data)
        return most

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        files, path = _open(self.path)
        with files.open_input_file(f"{path}/{partition.name}") as f:
            f.seek(partition.begin)
            data = f.read(partition.end - partition.begin)
        lines = data.split(b"\n")
        if not lines[-1]:
            lines.pop()
        offsets, at = [], partition.begin
        for line in lines:
            offsets.append(at)
            at += len(line) + 1
        for i in range(0, len(lines), 10_000):
            part = [x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines[i : i + 10_000]]
            columns = {"raw": pa.array(part, pa.string()), "source": pa.array([f"{self.path}/{partition.name}"] * len(part), pa.string()),
                       "line_offset": pa.array(offsets[i : i + 10_000], pa.int64())}
            if self.batches > 1:
                columns["batch"] = pa.array([partition.batch] * len(part), pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def commit(self, end: dict) -> None:
        """The checkpoint and ``progress`` hold all there is to remember."""

    def stop(self) -> None:
        pass


class Tail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "orrery_tail"

    def schema(self) -> str:
        return SCHEMA + ", batch long" * (int(self.options.get("batches", 1)) > 1)

    def streamReader(self, schema) -> TailReader:
        return TailReader(dict(self.options))


def tail(spark: SparkSession, path: str, progress: str, entries: int = ENTRIES, start: str = "beginning", batches: int = 1) -> DataFrame:
    """Stream of (raw, source, line_offset), at most ``entries`` lines a micro-batch;
    with ``batches`` > 1 so many times as many, and their ``batch``."""
    spark.dataSource.register(Tail)
    reader = spark.readStream.format("orrery_tail").option("path", path).option("progress", progress)
    return reader.option("entries", str(entries)).option("start", start).option("batches", str(batches)).load()
