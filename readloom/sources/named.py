"""Text outputs under names of their own: a Python data source that commits whole or leaves nothing.

``df`` (file, value) is written with ``spark.write.format("named_text")``: a line goes to the file that its row names. Tasks
write to a hidden folder; the commit moves their files into place, an abort removes them. A name whose
lines came from one task is one file, else it has parts ``name.00000``, ``name.00001``.. in the tasks' order. Files are
written where pyarrow finds the path, as in ``fastq``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

PENDING = "_pending"
#: Files that a task keeps open; lines of names beyond that close the file longest unused, which is appended to later.
OPEN = 64


@dataclass
class Written(WriterCommitMessage):
    partition: int
    folder: str
    names: list


class NamedText(DataSource):
    @classmethod
    def name(cls):
        return "named_text"

    def schema(self):
        return "file string, value string"

    def writer(self, schema, overwrite):
        return NamedTextWriter(self.options["path"], self.options["job"])


class NamedTextWriter(DataSourceArrowWriter):
    def __init__(self, path: str, job: str):
        self.path, self.job = path.rstrip("/"), job

    def _at(self, path: str):
        """(file system, path in it)."""
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    def write(self, iterator):
        import uuid

        from pyspark import TaskContext

        k = TaskContext.get().partitionId()
        system, base = self._at(f"{self.path}/{PENDING}/{self.job}/{k:05d}-{uuid.uuid4().hex}")
        system.create_dir(base, recursive=True)
        parts, open_files, names = {}, {}, []
        for batch in iterator:
            lines: dict[str, list[str]] = {}
            for name, value in zip(batch["file"].to_pylist(), batch["value"].to_pylist()):
                if not name or "/" in name or name[0] in "._":
                    raise ValueError(f"{name!r} can't name an output")
                lines.setdefault(name, []).append(value or "")
            for name, values in lines.items():
                f = open_files.pop(name, None)
                if f is None:
                    if len(open_files) >= OPEN:
                        open_files.pop(next(iter(open_files))).close()
                    parts[name] = parts.get(name, -1) + 1
                    names.append((name, parts[name]))
                    f = system.open_output_stream(f"{base}/{name}.{parts[name]:05d}")
                open_files[name] = f
                f.write(("\n".join(values) + "\n").encode("utf-8"))
        for f in open_files.values():
            f.close()
        return Written(k, base, names)

    def _clean(self):
        system, base = self._at(f"{self.path}/{PENDING}/{self.job}")
        from pyarrow import fs

        if system.get_file_info(base).type != fs.FileType.NotFound:
            system.delete_dir(base)
        pending = base.rsplit("/", 1)[0]
        if system.get_file_info(pending).type != fs.FileType.NotFound and not system.get_file_info(fs.FileSelector(pending)):
            system.delete_dir(pending)

    def commit(self, messages):
        system, base = self._at(self.path)
        of: dict[str, list[str]] = {}
        for m in sorted((m for m in messages if m is not None), key=lambda m: m.partition):
            for name, part in sorted(m.names):
                of.setdefault(name, []).append(f"{m.folder}/{name}.{part:05d}")
        for name, files in of.items():
            for i, f in enumerate(files):
                system.move(f, f"{base}/{name}" if len(files) == 1 else f"{base}/{name}.{i:05d}")
        self._clean()

    def abort(self, messages):
        self._clean()


def write_named(df: DataFrame, path: str) -> None:
    """df (file, value) to files by name in the folder ``path``. The lines of a name keep their order where df comes in
    range partitions by name (``ordered.in_order``)."""
    import uuid

    spark = df.sparkSession
    spark.dataSource.register(NamedText)
    df.select("file", "value").write.format("named_text").mode("append").option("job", uuid.uuid4().hex).save(path)


def read_named(spark: SparkSession, path: str) -> DataFrame:
    """(file, value) of such a folder: the lines with the names that they were written under."""
    from pyspark.sql import functions as F

    from .lines import ranged

    name = F.regexp_extract("file", r"([^/]+?)(?:\.\d{5})?$", 1)
    return ranged(spark, path).select(name.alias("file"), "value")
