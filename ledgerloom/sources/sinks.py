"""Batch request files with commit and abort, as a Spark data source.

    requests.write.format("batch_requests").option("stem", "batch").mode("append").save("file:///…")

Rows (file_no, line_no, key, line) that are dealt by file_no and sorted by line_no become one file each: ``<stem>.jsonl`` where all lie in one,
``<stem>_<n>.jsonl`` else, with a key map ``<stem>_<n>_keys.csv`` beside it where rows name what a key stands for. A task writes
under ``_pending``; files take their names when all tasks are done, and a failed job leaves none.
"""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..plans.scratch import materialize


def _filesystem(uri: str):
    """The file system of a path and the path in it, as executors and the driver reach it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "file://", 1))


@dataclass
class Written(WriterCommitMessage):
    """(file number, pending path, whether it is a key map) of what a task wrote."""

    files: list[tuple[int, str, bool]]
    lines: int


class RequestWriter(DataSourceWriter):
    def __init__(self, path: str, stem: str, run: str, overwrite: bool, columns: list[str]):
        self.path, self.stem, self.run, self.overwrite, self.columns = path.rstrip("/"), stem, run, overwrite, columns

    @property
    def pending(self) -> str:
        return f"{self.path}/_pending-{self.run}"

    def write(self, iterator: Iterator) -> Written:
        """One pending file a batch file, streamed line by line; each attempt of a task has names of its own."""
        fs, top = _filesystem(self.pending)
        fs.create_dir(top, recursive=True)
        attempt, found, n, now = uuid.uuid4().hex, [], 0, None
        out = keys = None

        def close() -> None:
            for f in (out, keys):
                if f is not None:
                    f.close()

        def cells(*values: str) -> bytes:
            text = io.StringIO()
            csv.writer(text).writerow(values)
            return text.getvalue().encode()

        try:
            for row in iterator:
                r = dict(zip(self.columns, row))
                if r["file_no"] != now:
                    close()
                    now, keys = r["file_no"], None
                    if any(f[0] == now for f in found):
                        raise ValueError(f"rows of file {now} are not together")
                    name = f"{top}/{now}-{attempt}"
                    out = fs.open_output_stream(name)
                    found.append((now, name, False))
                    if "name" in r:
                        keys = fs.open_output_stream(f"{name}-keys")
                        keys.write(cells("key", "name"))
                        found.append((now, f"{name}-keys", True))
                out.write(r["line"].encode() + b"\n")
                if keys is not None:
                    keys.write(cells(r["key"], r["name"] or ""))
                n += 1
        finally:
            close()
        return Written(found, n)

    def _names(self, messages: list) -> list[tuple[str, str]]:
        files = sorted(f for m in messages if m is not None for f in m.files)
        numbers = {f[0] for f in files}
        twice = [f[0] for f in files if not f[2]]
        if len(twice) != len(set(twice)):
            raise ValueError("a file's rows lie in several tasks; deal them by file_no")
        stem = lambda n: self.stem if len(numbers) == 1 else f"{self.stem}_{n}"
        return [(p, f"{stem(n)}_keys.csv" if keys else f"{stem(n)}.jsonl") for n, p, keys in files]

    def commit(self, messages: list) -> None:
        from pyarrow import fs as pafs

        fs, top = _filesystem(self.path)
        names = self._names(messages)
        old = [x.path for x in fs.get_file_info(pafs.FileSelector(top)) if x.is_file and x.base_name.startswith((f"{self.stem}.", f"{self.stem}_"))]
        if old and not self.overwrite:
            self.abort(messages)
            raise FileExistsError(f"{old[0]} is there; overwrite asks for another")
        for path in old:
            fs.delete_file(path)
        for path, name in names:
            fs.move(path, f"{top}/{name}")
        self._drop(fs)

    def abort(self, messages: list) -> None:
        self._drop(_filesystem(self.path)[0])

    def _drop(self, fs) -> None:
        at = _filesystem(self.pending)[1]
        if fs.get_file_info(at).type.name == "Directory":
            fs.delete_dir(at)


class BatchRequests(DataSource):
    """Write-only source of batch request files; options path, stem."""

    @classmethod
    def name(cls) -> str:
        return "batch_requests"

    def writer(self, schema, overwrite: bool) -> RequestWriter:
        columns = [f.name for f in schema]
        lacking = {"file_no", "line_no", "key", "line"} - set(columns)
        if lacking:
            raise ValueError(f"missing columns: {', '.join(sorted(lacking))}")
        return RequestWriter(self.options["path"], self.options.get("stem", "batch"), uuid.uuid4().hex, overwrite, columns)


def write_requests(numbered: DataFrame, path: str, stem: str = "batch", keys: DataFrame | None = None, overwrite: bool = False) -> None:
    """Write numbered requests (file_no, line_no, key, line) as batch files, with key maps of keys(key, name) where given."""
    spark = numbered.sparkSession
    spark.dataSource.register(BatchRequests)
    df = numbered.select("file_no", "line_no", "key", "line")
    if keys is not None:
        df = df.join(keys.select("key", "name"), "key", "left").select("file_no", "line_no", "key", "line", "name")
    settled = materialize(df)  # numbers come from ranges of a sample, so they are fixed before they are dealt
    dealt = settled.repartition("file_no").sortWithinPartitions("file_no", "line_no")
    dealt.write.format("batch_requests").option("stem", stem).mode("overwrite" if overwrite else "append").save(path)
