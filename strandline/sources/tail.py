"""Records of files that still grow, as a stream: readStream.format("records").

An offset is, for each file, the byte up to which it holds whole records: a line ends with its line feed, a FASTQ record with its fourth, a
FASTA record where the next one starts. What lies behind waits for more. Offsets come from the end of each file alone, so the driver reads
a window of every file that has grown, whatever their sizes; what is between two offsets is read by tasks in ranges, as a batch is.
A file is complete once a file of the same name and the option `done` (".done") lies beside it: then all of it is read, as a batch
would, and a packed file is read at all. Offsets depend on the files alone, so a stream that is started again goes on where it was.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSourceStreamReader, InputPartition

from .files import PACKED, Range, RecordReader, place

#: Bytes from the end of a file that are looked at first; twice as many each time until a record starts in them.
WINDOW = 1 << 16


def _fastq_end(data: bytes, start: bool) -> int | None:
    """The end of the last whole record of some bytes; start: whether a record starts with them. None: none starts there that can be told."""
    ends = [k + 1 for k, c in enumerate(data) if c == 10]
    begins = [0, *ends]
    first = 0
    if not start:
        text = lambda k: data[begins[k] : ends[k] - 1].rstrip(b"\r")
        first = next((k for k in range(1, len(ends) - 3) if text(k)[:1] == b"@" and text(k + 2)[:1] == b"+" and len(text(k + 1)) == len(text(k + 3))), None)
        if first is None:
            return None
    whole = (len(ends) - first) // 4 * 4
    return begins[first + whole]


def whole_end(f, size: int, start: int, kind: str) -> int:
    """The byte up to which a file of `size` bytes holds whole records, a record starting at `start`."""
    n = WINDOW
    while True:
        at = max(start, size - n)
        f.seek(at)
        data = f.read(size - at)
        if kind == "lines":
            end = data.rfind(b"\n") + 1 or None
        elif kind == "fasta":
            end = data.rfind(b"\n>") + 1 or None
        else:
            end = _fastq_end(data, at == start)
        if end is not None:
            return at + end
        if at == start:
            return start
        n *= 2


class RecordStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.batch = RecordReader(options)
        if self.batch.kind == "bam":
            raise ValueError("a BAM is no stream")
        self.done = options.get("done", ".done")
        #: What this reader has found so far, so that a file that hasn't grown isn't looked at again.
        self.seen: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out = {}
        for p in self.batch.paths:
            where, path = place(p)
            info = where.get_file_info(path)
            every = where.get_file_info(fs.FileSelector(path, recursive=True)) if info.type == fs.FileType.Directory else [info]
            names = {x.path for x in every}
            prefix = p[: len(p) - len(path)] if p.endswith(path) else ""
            for x in every:
                if x.is_file and not x.base_name.startswith(("_", ".")) and not x.path.endswith(self.done):
                    complete = x.path + self.done in names or (info.is_file and where.get_file_info(x.path + self.done).is_file)
                    out[prefix + x.path] = self._end(where, x, complete)
        return {k: out[k] for k in sorted(out) if out[k]}

    def _end(self, where: fs.FileSystem, x: fs.FileInfo, complete: bool) -> int:
        if complete or x.path.endswith(PACKED):
            return x.size if complete else 0
        size, end = self.seen.get(x.path, (0, 0))
        if x.size != size:
            with where.open_input_file(x.path) as f:
                end = whole_end(f, x.size, end, self.batch.kind)
            self.seen[x.path] = (x.size, end)
        return end

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out: list[InputPartition] = []
        for path, b in end.items():
            a = start.get(path, 0)
            if path.endswith(PACKED):
                out += [Range(path, 0, 1 << 62)] if a < b else []
            else:
                out += [Range(path, k, min(b, k + self.batch.most)) for k in range(a, b, self.batch.most)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.batch.read(partition)
