"""Files of lines that grow, as a stream: a Python data source whose offsets are bytes of each file.

A batch reads each file from where the last one ended to its last line break; a line that is not finished waits for the next batch.  Offsets
are kept in the stream's checkpoint, so after a restart no line is lost or read twice.  Files only grow: what has been read is not looked at
again, and a file that became shorter is an error."""

from __future__ import annotations

from pyarrow.fs import FileSelector, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..sources.archive import opened

#: Bytes of a partition, and of the pieces in which a file's end is searched for its last line break.
PART, PIECE = 32 << 20, 1 << 16


class _Range(InputPartition):
    def __init__(self, path: str, low: int, high: int, end: int):
        self.path, self.low, self.high, self.end = path, low, high, end


def whole_lines(folder: str, suffix: str, known: dict[str, int]) -> dict[str, int]:
    """For each file the byte after its last line break; nothing before what is known is read."""
    store, root = opened(folder)
    found = {}
    for f in store.get_file_info(FileSelector(root, recursive=True)):
        if f.type != FileType.File or not f.path.endswith(suffix):
            continue
        least, at = known.get(f.path, 0), f.size
        if f.size < least:
            raise ValueError(f"{f.path} has become shorter")
        with store.open_input_file(f.path) as stream:
            while at > least:
                low = max(least, at - PIECE)
                stream.seek(low)
                place = stream.read(at - low).rfind(b"\n")
                at = low
                if place >= 0:
                    at = low + place + 1
                    break
        found[f.path] = at
    return found


class _Reader(DataSourceStreamReader):
    def __init__(self, folder: str, suffix: str, part: int):
        self.folder, self.suffix, self.part, self.known = folder, suffix, part, {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        self.known = self.known | whole_lines(self.folder, self.suffix, self.known)
        return self.known

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        self.known = self.known | {k: max(v, self.known.get(k, 0)) for k, v in end.items()}
        spans = [(path, start.get(path, 0), high) for path, high in sorted(end.items())]
        return [_Range(path, at, min(at + self.part, high), high) for path, low, high in spans for at in range(low, high, self.part)]

    def read(self, partition: _Range):
        """Lines that begin in the partition's bytes: the first is the one after a line break, unless a batch or a file begins there."""
        store, _ = opened(self.folder)
        with store.open_input_file(partition.path) as stream:
            at = partition.low
            if at:
                stream.seek(at - 1)
                if stream.read(1) != b"\n":
                    at += len(_rest(stream, partition.end))
            stream.seek(at)
            while at < partition.high:
                line = _rest(stream, partition.end)
                yield partition.path, at, line.rstrip(b"\r\n").decode("utf-8", "replace")
                at += len(line)


def _rest(stream, end: int) -> bytes:
    """From where the stream stands to the end of the line."""
    out = b""
    while stream.tell() < end:
        began = stream.tell()
        piece = stream.read(min(PIECE, end - began))
        place = piece.find(b"\n")
        if place >= 0:
            stream.seek(began + place + 1)
            return out + piece[: place + 1]
        out += piece
    return out


class GrowingLines(DataSource):
    """``spark.readStream.format("tidemark_lines").option("path", folder)``: (file, offset, value)."""

    @classmethod
    def name(cls):
        return "tidemark_lines"

    def schema(self):
        return "file string, offset long, value string"

    def streamReader(self, schema):
        return _Reader(self.options["path"], self.options.get("suffix", ".jsonl"), int(self.options.get("part", PART)))


def lines(spark: SparkSession, folder: str, suffix: str = ".jsonl", part: int = PART) -> DataFrame:
    """(file, offset, value): the lines of a folder's files as a stream."""
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format("tidemark_lines").option("path", folder).option("suffix", suffix).option("part", part).load()
