"""``spark.read.format("fasta")`` and ``"genbank"``, for files at rest and for files that arrive.

Files are cut into splits of ``splitBytes``; a split has the records that begin in it and reads on to the
end of its last one, so a large file is read by many tasks and each record once. A stream takes files in
the order of their times of change, so a file should come into the folder whole, under its last name. Files are opened
through Arrow's file systems; for stores that only Spark's own readers open, use ``fasta.read`` and
``genbank.read``.

Rows carry the file and the place of the record in it, which name a record however files are split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from strandweave.sources import genbank

CHUNK, ROWS = 1 << 20, 256
PLACE = (("file", pa.string()), ("place", pa.int64()))


@dataclass
class Split(InputPartition):
    file: str
    start: int
    end: int


def _files(path: str) -> list[tuple[int, str, int]]:
    """(time of change, file, bytes) of a file or of a folder's files, but hidden ones, in that order."""
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    info = system.get_file_info(base)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(base, recursive=False))
    return sorted((f.mtime_ns or 0, f.path, f.size) for f in found if f.is_file and not f.base_name.startswith(("_", ".")))


def _system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")[0]


def records(stream, start: int, end: int, mark: bytes) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of the records that begin in [start, end): lines that start with ``mark``."""
    cut = b"\n" + mark
    at = max(0, start - 1)  # the line end before a record may be the last byte of the split before
    stream.seek(at)
    held = bytearray(stream.read(CHUNK)) if start else bytearray(b"\n" + stream.read(CHUNK))
    base = at if start else -1  # where the held bytes begin
    begin, search = None, 0
    while True:
        found = held.find(cut, search)
        if found < 0:
            search = max(0, len(held) - len(cut) + 1)
            if begin is None and base + search + 1 >= end:
                return
            more = stream.read(CHUNK)
            if not more:
                if begin is not None:
                    yield base + begin, bytes(held[begin:])
                return
            held += more
            continue
        if begin is not None:
            yield base + begin, bytes(held[begin : found + 1])
        begin = found + 1
        if base + begin >= end:
            return
        del held[:begin]
        base, begin, search = base + begin, 0, 0


def _fasta(text: str) -> dict:
    head, _, body = text.replace("\r", "").partition("\n")
    description = head[1:]
    return {"sequence_id": (description.split() or [""])[0], "description": description, "sequence": re.sub(r"\s", "", body).upper()}


class _Files(DataSource):
    mark: bytes
    fields: tuple
    ddl: str

    @staticmethod
    def parse(text: str) -> dict | None:
        raise NotImplementedError

    def schema(self) -> str:
        return f"{self.ddl}, file string, place long"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, type(self))

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(self.options, type(self))


class FastaSource(_Files):
    """Records of FASTA files: id (the header's first word), description, letters in upper case."""

    mark, fields, ddl = b">", tuple((n, pa.string()) for n in ("sequence_id", "description", "sequence")), "sequence_id string, description string, sequence string"
    parse = staticmethod(_fasta)

    @classmethod
    def name(cls) -> str:
        return "fasta"


class GenbankSource(_Files):
    """Records of GenBank files, as ``genbank.read`` gives them."""

    mark, fields, ddl = b"LOCUS", genbank.RECORD, genbank.RECORD_DDL

    @classmethod
    def name(cls) -> str:
        return "genbank"

    @staticmethod
    def parse(text: str) -> dict | None:
        record = genbank.parse_record(text.split("\n//")[0])
        return record and genbank.as_row(record)


class _Shared:
    def __init__(self, options: dict, kind: type[_Files]):
        self.path, self.kind = options["path"], kind
        self.bytes = int(options.get("splitbytes", options.get("splitBytes", 64 << 20)))

    def splits(self, files) -> list[Split]:
        return [Split(name, a, min(size, a + self.bytes)) for _, name, size in files for a in range(0, size, self.bytes)]

    def rows(self, split: Split) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*self.kind.fields, *PLACE])
        out = []
        with _system(self.path).open_input_file(split.file) as stream:
            for place, text in records(stream, split.start, split.end, self.kind.mark):
                record = self.kind.parse(text.decode("utf-8", "replace"))
                if record:
                    out.append(record | {"file": split.file, "place": place})
                if len(out) >= ROWS:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)


class _Reader(_Shared, DataSourceReader):
    def partitions(self) -> list[Split]:
        return self.splits(_files(self.path)) or [Split("", 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        if partition.file:
            yield from self.rows(partition)


class _StreamReader(_Shared, DataSourceStreamReader):
    """Offsets are the last file taken: its time of change and its name."""

    def initialOffset(self) -> dict:  # noqa: N802
        return {"time": -1, "file": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        files = _files(self.path)
        return {"time": files[-1][0], "file": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Split]:
        low, high = (start["time"], start["file"]), (end["time"], end["file"])
        return self.splits([f for f in _files(self.path) if low < f[:2] <= high])

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        yield from self.rows(partition)

    def commit(self, end: dict) -> None:
        """Files stay where they are."""


def register(spark: SparkSession) -> None:
    """Make the formats known to the session."""
    for source in (FastaSource, GenbankSource):
        spark.dataSource.register(source)
