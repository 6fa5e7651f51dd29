"""Growing-file tail source (A2, with A3's byte offsets), as a Python data source.

Spark's built-in file stream only picks up new files; a log file that keeps
growing needs a source whose offset is a byte position per file. The offset
of a micro-batch is ``{file: position}``; a batch reads, for each file, the
byte range from the previous position to the last newline currently in the
file (a half-written last line waits for the next batch). Ranges larger than
``partitionBytes`` are cut at line starts into several partitions, so a
burst on one file is read by several tasks. Files are accessed through
``pyarrow.fs``, so local paths, HDFS and object stores work alike.

Lines end at ``\\n``, ``\\r\\n`` or a lone ``\\r`` (universal newlines);
bytes that are not UTF-8 become U+FFFD. ``offset`` is the byte position
after the line, as a tail reader's ``tell()`` reports it.

``read_from``: ``start``/``begin`` -> byte 0, ``end`` -> after the last
complete line present when the stream starts (files created later are read
from 0); anything else is an error.

``maxBytesPerTrigger`` caps the bytes taken from each file per micro-batch
(whole lines; a longer single line is taken whole), the counterpart of the
reference's lines-per-poll limit. Spark asks a source for its newest offset
before it tells where the query stands, so the capped reader takes the
query's ``checkpoint`` folder and finds the last planned offset there: the
cap holds from the first batch on, also after a restart.
"""

from __future__ import annotations

from typing import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "raw_data string, offset long, file_path string"
NAME = "logtail"
PROBE = 1 << 16
DEFAULT_PARTITION_BYTES = 64 << 20


def _fs(path: str):
    from pyarrow import fs as pafs

    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _files(path: str, recursive: bool = False) -> list[str]:
    """The file itself, or the regular files inside a directory (sorted; below it too when ``recursive``).
    Names starting with '.' or '_' (e.g. _SUCCESS) are skipped."""
    from pyarrow import fs as pafs

    fs, p = _fs(path)
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.File:
        return [path]
    if info.type != pafs.FileType.Directory:
        return []
    prefix = path[: len(path) - len(p)] if "://" in path else ""
    sel = pafs.FileSelector(p, recursive=recursive)
    out = [prefix + i.path for i in fs.get_file_info(sel) if i.type == pafs.FileType.File]
    return sorted(f for f in out if not f.rsplit("/", 1)[-1].startswith((".", "_")))


def _size(path: str) -> int:
    fs, p = _fs(path)
    return fs.get_file_info(p).size or 0


def _last_line_end(path: str, lo: int, hi: int) -> int:
    """Position just after the last line terminator in [lo, hi); ``lo`` when there is none."""
    if hi <= lo:
        return lo
    fs, p = _fs(path)
    with fs.open_input_file(p) as f:
        end = hi
        while end > lo:
            start = max(lo, end - PROBE)
            f.seek(start)
            buf = f.read(end - start)
            i = max(buf.rfind(b"\n"), buf.rfind(b"\r"))
            if i >= 0:
                # A '\r' as the very last byte may be the first half of '\r\n': wait for more.
                if buf[i : i + 1] == b"\r" and start + i + 1 == hi:
                    end = start + i
                    continue
                return start + i + 1
            end = start
    return lo


def _next_line_start(f, pos: int, hi: int) -> int:
    """First line start at or after ``pos`` (``pos`` itself if the byte before is a terminator)."""
    if pos <= 0:
        return 0
    f.seek(pos - 1)
    prev = f.read(1)
    if prev == b"\n" or (prev == b"\r" and f.read(1) != b"\n"):
        return pos
    cur = pos
    while cur < hi:
        f.seek(cur)
        buf = f.read(min(PROBE, hi - cur))
        if not buf:
            break
        i = buf.find(b"\n")
        if i >= 0:
            return cur + i + 1
        cur += len(buf)
    return hi


class TailRange(InputPartition):
    """Bytes ``start`` to ``end`` of the whole lines ``lo`` to ``hi``; the task moves inner bounds to line starts."""

    def __init__(self, path: str, start: int, end: int, lo: int, hi: int):
        super().__init__((path, start, end, lo, hi))
        self.path, self.start, self.end, self.lo, self.hi = path, start, end, lo, hi

    def lines(self, f) -> tuple[int, int]:
        start = self.start if self.start == self.lo else _next_line_start(f, self.start, self.hi)
        return start, self.hi if self.end == self.hi else _next_line_start(f, self.end, self.hi)


def _ranges(path: str, start: int, end: int, chunk: int) -> list[TailRange]:
    """Plain byte ranges; no file is opened here."""
    cuts = [*range(start, end, chunk), end]
    return [TailRange(path, a, b, start, end) for a, b in zip(cuts, cuts[1:]) if b > a]


def _split_lines(buf: bytes, base: int) -> tuple[list[str], list[int]]:
    """(lines, offset after each) for a buffer of whole lines starting at byte ``base``."""
    from itertools import accumulate

    if b"\r" not in buf:  # common case: C-level split, no per-byte scanning
        parts = buf.split(b"\n")
        if parts and parts[-1] == b"":
            parts.pop()
            ends = [len(p) + 1 for p in parts]
        else:  # the range ends without a terminator (not produced by our ranges, kept for safety)
            ends = [len(p) + 1 for p in parts[:-1]] + [len(parts[-1])]
        return [p.decode("utf-8", errors="replace") for p in parts], list(accumulate(ends, initial=base))[1:]
    lines: list[str] = []
    offs: list[int] = []
    i, n = 0, len(buf)
    while i < n:
        j_n = buf.find(b"\n", i)
        j_r = buf.find(b"\r", i)
        if j_r != -1 and (j_n == -1 or j_r < j_n):
            stop, after = j_r, j_r + 1
            if after < n and buf[after : after + 1] == b"\n":
                after += 1
        elif j_n != -1:
            stop, after = j_n, j_n + 1
        else:
            stop, after = n, n
        lines.append(buf[i:stop].decode("utf-8", errors="replace"))
        offs.append(base + after)
        i = after
    return lines, offs


def _batch(lines: list[str], offs: list[int], path: str):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [pa.array(lines, pa.string()), pa.array(offs, pa.int64()), pa.array([path] * len(lines), pa.string())],
        names=["raw_data", "offset", "file_path"],
    )


def _read_range(part: TailRange, step: int = 8 << 20) -> Iterator:
    """Read a range of whole lines in bounded chunks, as Arrow record batches; a chunk is
    emitted up to its last terminator (a trailing '\r' waits, it may be the first half of '\r\n')."""
    fs, p = _fs(part.path)
    with fs.open_input_file(p) as f:
        start, end = part.lines(f)
        f.seek(start)
        pending, base, pos = b"", start, start
        while pos < end:
            buf = f.read(min(step, end - pos))
            if not buf:
                break
            pos += len(buf)
            data = pending + buf
            if pos < end:
                limit = len(data) - 1 if data.endswith(b"\r") else len(data)
                cut = max(data.rfind(b"\n", 0, limit), data.rfind(b"\r", 0, limit))
                if cut < 0:
                    pending = data
                    continue
                whole, pending = data[: cut + 1], data[cut + 1 :]
            else:
                whole, pending = data, b""
            lines, offs = _split_lines(whole, base)
            if lines:
                yield _batch(lines, offs, part.path)
            base += len(whole)


def _start_mode(read_from: str) -> str:
    r = (read_from or "end").strip().lower()
    if r in ("start", "begin", "beginning", "earliest"):
        return "start"
    if r in ("end", "latest"):
        return "end"
    raise ValueError(f"read_from must be 'start', 'begin' or 'end', got {read_from!r}")


def _flag(options, name: str) -> bool:
    return str(options.get(name, "false")).lower() in ("true", "1", "yes")


class _TailBatchReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.recursive = _flag(options, "recursive")
        self.chunk = int(options.get("partitionBytes", DEFAULT_PARTITION_BYTES))

    def partitions(self):
        parts: list[TailRange] = []
        for f in _files(self.path, self.recursive):
            parts += _ranges(f, 0, _last_line_end(f, 0, _size(f)), self.chunk)
        return parts or [TailRange(self.path, 0, 0, 0, 0)]

    def read(self, partition):
        if partition.end <= partition.start:
            return iter(())
        return _read_range(partition)


def _planned_offset(checkpoint: str) -> dict | None:
    """This source's offset in the last batch that the query planned, from the checkpoint's offset log."""
    import json

    fs, root = _fs(checkpoint.removeprefix("file://") if checkpoint.startswith("file:///") else checkpoint)
    logs = [f for f in _files(checkpoint.rstrip("/") + "/offsets") if f.rsplit("/", 1)[-1].isdigit()]
    if not logs:
        return None
    with fs.open_input_stream(_fs(max(logs, key=lambda f: int(f.rsplit("/", 1)[-1])))[1]) as f:
        lines = f.read().decode("utf-8").split("\n")
    found = [x for x in (json.loads(y) for y in lines[2:] if y.startswith("{")) if isinstance(x.get("files"), dict)]
    return found[0] if found else None


class _TailStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.mode = _start_mode(options.get("read_from", "end"))
        self.recursive = _flag(options, "recursive")
        self.chunk = int(options.get("partitionBytes", DEFAULT_PARTITION_BYTES))
        cap = options.get("maxBytesPerTrigger")
        self.cap = int(cap) if cap else None
        self._last: dict | None = None  # end offsets handed out last (the next batch's start)
        checkpoint = options.get("checkpoint")
        if checkpoint:
            self._last = _planned_offset(checkpoint) or self.initialOffset()
        elif self.cap:
            raise ValueError("maxBytesPerTrigger needs the query's checkpoint folder")

    def _end_for(self, f: str, prev: int) -> int:
        size = _size(f)
        if size < prev:  # truncated or replaced
            prev = 0
        if self.cap is None or size - prev <= self.cap:
            return _last_line_end(f, prev, size)
        end = _last_line_end(f, prev, prev + self.cap)
        if end == prev:  # one line longer than the cap: take that whole line
            fs, p = _fs(f)
            with fs.open_input_file(p) as h:
                end = _next_line_start(h, prev + self.cap, size)
            end = min(end, _last_line_end(f, prev, size)) if end > prev else prev
        return end

    def initialOffset(self) -> dict:
        if self.mode == "start":
            return {"files": {}}
        return {"files": {f: _last_line_end(f, 0, _size(f)) for f in _files(self.path, self.recursive)}}

    def latestOffset(self) -> dict:
        before = (self._last or {}).get("files", {})
        files = dict(before)  # a file that a listing misses keeps its position
        for f in _files(self.path, self.recursive):
            files[f] = self._end_for(f, int(before.get(f, 0))) if self.cap else _last_line_end(f, 0, _size(f))
        out = {"files": files}
        self._last = out
        return out

    def partitions(self, start: dict, end: dict):
        before = start.get("files", {})
        self._last = {"files": {**before, **(self._last or end).get("files", {})}}
        parts: list[TailRange] = []
        for f, e in sorted(end.get("files", {}).items()):
            s = int(before.get(f, 0))
            if e < s:  # truncated or replaced: read the new content from the beginning
                s = 0
            parts += _ranges(f, s, int(e), self.chunk)
        return parts

    def read(self, partition):
        return _read_range(partition)

    def commit(self, end: dict) -> None:
        pass


class TailDataSource(DataSource):
    """``spark.read/readStream.format("logtail").option("path", ...)``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _TailBatchReader(self.options)

    def streamReader(self, schema):
        return _TailStreamReader(self.options)


def register_tail_source(spark: SparkSession) -> None:
    spark.dataSource.register(TailDataSource)


def stream_log_tail(
    spark: SparkSession,
    path: str,
    read_from: str = "end",
    partition_bytes: int | None = None,
    recursive: bool = False,
    max_bytes_per_trigger: int | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Stream the lines appended to a file (or the files of a directory) (A2).

    ``max_bytes_per_trigger`` needs ``checkpoint``, the folder given to the
    query as ``checkpointLocation`` (one tail source per query).
    """
    _start_mode(read_from)
    if max_bytes_per_trigger and not checkpoint:
        raise ValueError("max_bytes_per_trigger needs the query's checkpoint folder")
    register_tail_source(spark)
    r = spark.readStream.format(NAME).option("path", path).option("read_from", read_from).option("recursive", str(recursive))
    if checkpoint:
        r = r.option("checkpoint", checkpoint)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if partition_bytes:
        r = r.option("partitionBytes", str(partition_bytes))
    return r.load()


def read_log_tail(spark: SparkSession, path: str, partition_bytes: int | None = None, recursive: bool = False) -> DataFrame:
    """Batch read of the same source from byte 0: (raw_data, offset, file_path)."""
    register_tail_source(spark)
    r = spark.read.format(NAME).option("path", path).option("recursive", str(recursive))
    if partition_bytes:
        r = r.option("partitionBytes", str(partition_bytes))
    return r.load()
