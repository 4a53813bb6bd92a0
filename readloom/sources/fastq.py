"""FASTQ data source, with the head of each file and filters on path and place pushed into it.

Files are read where pyarrow finds them: a file or folder that every executor sees, plain or .gz. Plain
FASTQ files are cut into byte ranges; a range's task starts at the first record that begins in it and
ends the last one that does. Rows travel as Arrow batches.
"""

from __future__ import annotations

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RANGE_BYTES = 64 << 20
BATCH_ROWS = 10_000


def records(lines):
    """(place, name, seq, qual) of an iterator of (place, line). Lines before a name are skipped; a record
    whose third line isn't a '+' line is an error."""
    it = iter(lines)
    for at, line in it:
        name = line.rstrip("\r\n")
        if not name.startswith("@"):
            continue
        seq, plus, qual = (next(it, (0, ""))[1].rstrip("\r\n") for _ in range(3))
        if not plus.startswith("+"):
            raise ValueError(f"no '+' line in the record of {name}")
        yield at, name, seq, qual


def resumed(lines, start: int, stop: int):
    """(place, line) from the first record that begins at ``start`` or later to the end of the last one
    that begins before ``stop``. A '@' line is a name, and not qualities, if a '+' line is the second after
    it: behind qualities comes a name and then a sequence, which has no '+'."""
    it = iter(lines)
    held = []
    if start:
        for x in it:
            held = [*held[-2:], x]
            if len(held) == 3 and held[0][1].startswith("@") and held[2][1].startswith("+"):
                break
        else:
            return
    inside = 0

    def every():
        yield from held
        yield from it

    for at, line in every():
        if not inside % 4 and at >= stop:
            return
        if inside % 4 or line.startswith("@"):
            inside += 1
        yield at, line


def _batches(rows, schema):
    """Rows as record batches."""
    import itertools

    import pyarrow as pa

    it = iter(rows)
    while part := list(itertools.islice(it, BATCH_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


class FastqSource(DataSource):
    """spark.read.format("fastq_reads").load(path)"""

    @classmethod
    def name(cls):
        return "fastq_reads"

    def schema(self):
        return "path string, ordinal long, name string, seq string, qual string"

    def reader(self, schema):
        head = self.options.get("head")
        return FastqReader(self.options["path"], int(self.options.get("rangeBytes", RANGE_BYTES)), int(head) if head else None)


class _Files(DataSourceReader):
    def __init__(self, path):
        self.path = path

    def _system(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def files(self):
        """(path, bytes) of the data files."""
        from pyarrow import fs

        system, path = self._system()
        info = system.get_file_info(path)
        found = [info] if info.is_file else [f for f in system.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file and f.base_name[0] not in "._"]
        return sorted((f.path, f.size or 0) for f in found)

    def lines(self, path, start=0):
        """(place, line) from a byte of a plain file on; by number in a compressed one."""
        import io

        system = self._system()[0]
        if path.endswith(".gz"):
            with system.open_input_stream(path) as f:
                yield from enumerate(io.TextIOWrapper(f, "latin-1"))
            return
        with system.open_input_file(path) as f:
            # The line that a range begins in belongs to the range before.
            f.seek(max(start - 1, 0))
            lines = io.BufferedReader(f, 1 << 20)
            at = max(start - 1, 0)
            if start:
                at += len(lines.readline())
            for line in lines:
                yield at, line.decode("latin-1")
                at += len(line)


def base_name(path: str) -> str:
    """A file's path without the part number that a writer of named outputs gave it."""
    stem, _, part = path.rpartition(".")
    return stem if len(part) == 5 and part.isdigit() else path


class FastqReader(_Files):
    """head: only so many first records of each file, its parts taken together; later ranges aren't opened."""

    def __init__(self, path, range_bytes=RANGE_BYTES, head=None):
        super().__init__(path)
        self.range_bytes, self.head = range_bytes, head
        self.paths, self.low, self.high = None, 0, None

    def pushFilters(self, filters):
        """Filters on the path choose files, filters on the place choose ranges; Spark applies them to the rows as well."""
        for f in filters:
            kind, column, value = type(f).__name__, getattr(f, "attribute", None), getattr(f, "value", None)
            if column == ("path",) and kind in ("EqualTo", "In"):
                mine = {value} if kind == "EqualTo" else set(value)
                self.paths = mine if self.paths is None else self.paths & mine
            elif column == ("ordinal",) and self.head is None:
                if kind in ("GreaterThan", "GreaterThanOrEqual", "EqualTo"):
                    self.low = max(self.low, value)
                if kind in ("LessThan", "LessThanOrEqual", "EqualTo"):
                    most = value + (kind != "LessThan")
                    self.high = most if self.high is None else min(self.high, most)
            yield f

    def partitions(self):
        files = [(p, n) for p, n in self.files() if self.paths is None or p in self.paths]
        if self.head is not None:
            by: dict[str, list] = {}
            for path, _ in files:
                by.setdefault(base_name(path), []).append((path, 0, None))
            return [InputPartition(parts) for parts in by.values()] or [InputPartition([])]
        out = []
        for path, size in files:
            if path.endswith(".gz"):
                out.append(InputPartition([(path, 0, None)]))
                continue
            for a in range(0, max(size, 1), self.range_bytes):
                if a + self.range_bytes > self.low and (self.high is None or a < self.high):
                    out.append(InputPartition([(path, a, a + self.range_bytes)]))
        return out or [InputPartition([])]

    def read(self, partition):
        import itertools

        import pyarrow as pa

        def rows():
            for path, start, stop in partition.value:
                lines = self.lines(path, start)
                if stop is not None:
                    lines = resumed(lines, start, stop)
                for r in records(lines):
                    yield (path, *r)

        schema = pa.schema([("path", pa.string()), ("ordinal", pa.int64()), ("name", pa.string()), ("seq", pa.string()), ("qual", pa.string())])
        yield from _batches(itertools.islice(rows(), self.head), schema)
