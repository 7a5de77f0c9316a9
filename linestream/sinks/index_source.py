"""SNK-2 as a data source: documents go out in bulk requests, a run or an epoch
becomes visible as a whole.

A task cuts its lines into requests of N actions, some bytes or some seconds
(`writers.bulk_requests`), and sends each one as it is full; here a request is
a file in the index's hidden folder for the run. When all tasks have succeeded
the commit keeps the files that their messages name (a second attempt of a task
leaves others) and shows them by renaming the folder; a failed run is removed,
one that dies with its driver stays hidden. A run adds to the index. An epoch
of a stream has the stream's name and its number as run, so a replayed one
takes the place of the first.

    lines.write.format("linestream_index").options(path=root, index="i", type="t", actions=1000).mode("append").save()
    lines.writeStream.format("linestream_index").options(path=root, index="i", type="t", run="a-name")...

Input: one column `value`, lines of `writers.bulk_lines`. Files are reached
through Arrow's filesystems (local or shared folders, HDFS and object stores
by their URI).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from .writers import bulk_requests

FORMAT = "linestream_index"
#: What a bulk request holds at most, besides the number of actions.
MOST_BYTES, MOST_SECONDS = 1 << 30, 5.0


@dataclass
class Sent(WriterCommitMessage):
    """One task's requests, and the hidden folder they are in."""

    folder: str
    files: list[str]
    documents: int


class _Requests:
    """What both writers share: sending requests, showing or removing a run."""

    def __init__(self, options: dict):
        missing = [o for o in ("path", "index", "type") if not options.get(o)]
        if missing:
            raise ValueError(f"{FORMAT} needs the options {', '.join(missing)}")
        self.folder = f"{options['path'].rstrip('/')}/index={options['index']}/type={options['type']}"
        self.actions = int(options.get("actions", 1000))
        self.most_bytes = int(options.get("bytes", MOST_BYTES))
        self.most_seconds = float(options.get("seconds", MOST_SECONDS))
        self.staged = f"{self.folder}/_staged-{uuid.uuid4().hex}"  # Spark reads folders with "=" even if they begin with "_"

    def _open(self, path: str) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(path)

    def send(self, batches: Iterator[pa.RecordBatch]) -> Sent:
        from pyspark import TaskContext

        lines = (line for batch in batches for line in batch.column(0).to_pylist())
        attempt = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}"
        files, documents = [], 0
        filesystem, folder = self._open(self.staged)
        for i, request in enumerate(bulk_requests(lines, self.actions, self.most_bytes, self.most_seconds)):
            if not files:
                filesystem.create_dir(folder, recursive=True)
            name = f"{attempt}-{i:06d}.txt"
            with filesystem.open_output_stream(f"{folder}/{name}") as out:
                out.write(("\n".join(request) + "\n").encode())
            files.append(name)
            documents += len(request)
        return Sent(folder, files, documents)

    def show(self, messages: list[Sent | None], run: str) -> None:
        filesystem, shown = self._open(f"{self.folder}/run={run}")
        if filesystem.get_file_info(shown).type != pafs.FileType.NotFound:
            filesystem.delete_dir(shown)  # the same epoch, written before
        sent = [m for m in messages if m is not None and m.files]
        if not sent:
            return
        folder = sent[0].folder
        names = {name for m in sent for name in m.files}
        for m in sent:  # tasks may have had writers of their own
            if m.folder != folder:
                for name in m.files:
                    filesystem.move(f"{m.folder}/{name}", f"{folder}/{name}")
        for info in filesystem.get_file_info(pafs.FileSelector(folder)):
            if info.base_name not in names:  # of an attempt that does not count
                filesystem.delete_file(info.path)
        filesystem.move(folder, shown)

    def remove(self, messages: list[Sent | None]) -> None:
        filesystem, folder = self._open(self.staged)
        for f in {folder, *(m.folder for m in messages if m is not None)}:
            if filesystem.get_file_info(f).type != pafs.FileType.NotFound:
                filesystem.delete_dir(f)


class IndexWriter(_Requests, DataSourceArrowWriter):
    def __init__(self, options: dict):
        super().__init__(options)
        self.run = options.get("run") or f"{time.time_ns() // 1_000_000:013d}-{uuid.uuid4().hex[:8]}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
        return self.send(iterator)

    def commit(self, messages) -> None:
        self.show(messages, self.run)

    def abort(self, messages) -> None:
        self.remove(messages)


class IndexStreamWriter(_Requests, DataSourceStreamArrowWriter):
    def __init__(self, options: dict):
        super().__init__(options)
        if not options.get("run"):
            raise ValueError("a stream into an index needs a name (option run), the same after every restart")
        self.run = options["run"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
        return self.send(iterator)

    def commit(self, messages, batchId: int) -> None:
        self.show(messages, f"{self.run}-{batchId:012d}")

    def abort(self, messages, batchId: int) -> None:
        self.remove(messages)


class IndexSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> IndexWriter:
        if overwrite:
            raise ValueError("an index is only added to: use mode append")
        return IndexWriter(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> IndexStreamWriter:
        return IndexStreamWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(IndexSource)


def options(root: str, index: str, doc_type: str, actions: int, **more) -> dict:
    return {"path": root, "index": index, "type": doc_type, "actions": str(actions), **{k: str(v) for k, v in more.items()}}


def bulk_write(lines: DataFrame, root: str, index: str, doc_type: str, actions: int = 1000, **more) -> str:
    """Add the lines to the index in bulk requests, as one run; returns the type's folder."""
    register(lines.sparkSession)
    lines.write.format(FORMAT).options(**options(root, index, doc_type, actions, **more)).mode("append").save()
    return f"{root.rstrip('/')}/index={index}/type={doc_type}"


def bulk_stream(lines: DataFrame, root: str, index: str, doc_type: str, name: str, actions: int = 1000, **more):
    """The same for a stream: a writer for `streaming.runner.start`."""
    register(lines.sparkSession)
    return lines.writeStream.format(FORMAT).options(**options(root, index, doc_type, actions, run=name, **more))
