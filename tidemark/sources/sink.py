"""A sink that hands rows over in batches of n, as a Python data source.

Every task writes its batches, one JSON-lines file each, into a folder of the write that readers do not see. When all tasks have reported what they
wrote, the driver drops what failed attempts left and renames the folder, and only then are the rows there: `spark.read.json(path, recursiveFileLookup=True)`
finds the batches of committed writes and nothing else. A write that fails is taken away.

Register it once per session with `register(spark)`, then

    df.write.format("tidemark_batches").option("path", path).option("batch", 1000).mode("append").save()
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

# the tasks get this module with the writer, so it need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "tidemark_batches"


@dataclass
class Wrote(WriterCommitMessage):
    """What one task wrote: file names and rows."""

    names: list[str]
    rows: int


def _plain(value: Any) -> Any:
    """Nested rows as maps, other values that JSON lacks as text."""
    if isinstance(value, Row):
        return {k: _plain(v) for k, v in value.asDict().items() if v is not None}
    if isinstance(value, dict):
        return {str(k): _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, (str, int, float, bool)) or value is None:
        return value
    return value.isoformat() if hasattr(value, "isoformat") else str(value)


class BatchWriter(DataSourceWriter):
    def __init__(self, path: str, size: int, replace: bool):
        self.path, self.size, self.replace, self.name = path.rstrip("/"), size, replace, uuid.uuid4().hex

    def _files(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")

    def write(self, iterator: Iterator[Row]) -> Wrote:
        files, root = self._files()
        names, held, rows = [], [], 0

        def flush() -> None:
            # attempts of one task have names of their own
            name = f"{uuid.uuid4().hex}.json"
            with files.open_output_stream(f"{root}/_writing-{self.name}/{name}") as out:
                out.write("".join(held).encode())
            names.append(name)
            held.clear()

        files.create_dir(f"{root}/_writing-{self.name}", recursive=True)
        for row in iterator:
            held.append(json.dumps(_plain(row), ensure_ascii=False, allow_nan=False) + "\n")
            rows += 1
            if len(held) == self.size:
                flush()
        if held:
            flush()
        return Wrote(names, rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        files, root = self._files()
        kept = {n for m in messages if m is not None for n in m.names}
        staged = f"{root}/_writing-{self.name}"
        for info in files.get_file_info(fs.FileSelector(staged, allow_not_found=True)):
            if info.base_name not in kept:
                files.delete_file(info.path)
        older = [i.path for i in files.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.base_name.startswith("write-")] if self.replace else []
        if kept:
            files.move(staged, f"{root}/write-{self.name}")
        for path in older:
            files.delete_dir(path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = self._files()
        files.delete_dir_contents(f"{root}/_writing-{self.name}", missing_dir_ok=True)


class BatchSink(DataSource):
    """Options: `path`, a folder that all executors reach, and `batch`, the rows of a batch (1,000). Mode overwrite replaces earlier writes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        size = int(self.options.get("batch", 1_000))
        if size < 1:
            raise ValueError("batch must be at least 1")
        return BatchWriter(self.options["path"], size, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BatchSink)


def write_in_batches(df: DataFrame, path: str, batch: int = 1_000, mode: str = "append") -> None:
    """Hand the rows over in batches of at most `batch`; the last batch of each task may be shorter. Not-a-number values are refused, as JSON has none."""
    register(df.sparkSession)
    df.write.format(FORMAT).option("path", path).option("batch", batch).mode(mode).save()
