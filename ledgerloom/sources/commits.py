"""A sink for text lines by branch that shows all lines of a job, or of a micro-batch, or none of them.

Tasks write files under ``files/route=<branch>/`` and send their names to the driver. When all tasks have succeeded, the driver
writes these names into one manifest, in one step, and only files that a manifest names are ever read. A job that fails has
its files deleted; what a lost executor leaves behind is named nowhere. A job has an id, a micro-batch its number: done again,
it replaces its own manifest, so that each line is there once.

The driver holds the names of a job's files, at most one per task and branch, and no lines.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "committed_branches"
MANIFESTS, FILES = "_manifests", "files"
_ENTRY = "name string, rows long"


@dataclass
class Written(WriterCommitMessage):
    """The files of one task: names below ``files`` and their rows."""

    files: list[tuple[str, int]]


def _escaped(value: str) -> str:
    """As Spark reads names of partitions: characters with a meaning in paths as their code, all others as they are."""
    return re.sub(r"""[\x00-\x20\x7f"#%'*+/:=?\\{}\[\]^]""", lambda c: f"%{ord(c[0]):02X}", value)


class _Folder:
    """A folder on any file system that pyarrow knows."""

    def __init__(self, path: str) -> None:
        local = re.fullmatch(r"(?:file:)?/*(/.*)", path)
        self.system, self.root = (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(path)
        self.root = self.root.rstrip("/")

    def create(self, name: str):
        path = f"{self.root}/{name}"
        self.system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return self.system.open_output_stream(path)

    def delete(self, names: list[str]) -> None:
        for name in names:
            if self.system.get_file_info(f"{self.root}/{name}").type != fs.FileType.NotFound:
                self.system.delete_file(f"{self.root}/{name}")

    def names(self, folder: str) -> list[str]:
        found = self.system.get_file_info(fs.FileSelector(f"{self.root}/{folder}", allow_not_found=True))
        return [f"{folder}/{f.base_name}" for f in found if f.is_file and f.base_name.endswith(".json")]

    def entries(self, name: str) -> list[str]:
        """The files that a manifest names, or none where there is no manifest."""
        if self.system.get_file_info(f"{self.root}/{name}").type == fs.FileType.NotFound:
            return []
        with self.system.open_input_stream(f"{self.root}/{name}") as f:
            return [f"{FILES}/{json.loads(line)['name']}" for line in f.read().decode().splitlines()]

    def unnamed(self, run: str = "") -> list[str]:
        """Files that no manifest names, of one run or of all."""
        named = {name for manifest in self.names(MANIFESTS) for name in self.entries(manifest)}
        found = self.system.get_file_info(fs.FileSelector(f"{self.root}/{FILES}", allow_not_found=True, recursive=True))
        names = ["/".join((FILES, *f.path.rsplit("/", 2)[1:])) for f in found if f.is_file and f.base_name.startswith(run)]
        return [name for name in names if name not in named]

    def publish(self, name: str, files: list[tuple[str, int]]) -> None:
        """Put a manifest in its place in one step."""
        hidden = f"{MANIFESTS}/.{uuid.uuid4().hex}"
        with self.create(hidden) as f:
            f.write("".join(json.dumps({"name": n, "rows": rows}) + "\n" for n, rows in files).encode())
        self.system.move(f"{self.root}/{hidden}", f"{self.root}/{name}")


class _Writer:
    """What batch and stream writers share."""

    def __init__(self, path: str, branch: str) -> None:
        self.path, self.branch = path, branch
        self.run = uuid.uuid4().hex  # the same in all tasks

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        folder, token = _Folder(self.path), f"{self.run}-{uuid.uuid4().hex}"
        streams: dict[str, object] = {}
        rows: dict[str, int] = {}
        try:
            for batch in iterator:
                branches = batch.column(self.branch).cast(pa.string())
                for branch in pc.unique(branches):
                    mine = pc.is_null(branches) if not branch.is_valid else pc.equal(branches, branch)
                    lines = pc.fill_null(batch.column("value").filter(mine), "").to_pylist()
                    if not lines:
                        continue
                    value = _escaped(branch.as_py()) if branch.is_valid else "__HIVE_DEFAULT_PARTITION__"
                    name = f"{self.branch}={value}/{token}.txt"
                    if name not in streams:
                        streams[name], rows[name] = folder.create(f"{FILES}/{name}"), 0
                    streams[name].write(("\n".join(lines) + "\n").encode())
                    rows[name] += len(lines)
        except BaseException:
            for stream in streams.values():
                stream.close()
            folder.delete([f"{FILES}/{name}" for name in streams])
            raise
        for stream in streams.values():
            stream.close()
        return Written(list(rows.items()))

    def _commit(self, messages: list[Written | None], manifest: str, alone: bool = False) -> None:
        folder = _Folder(self.path)
        before = folder.names(MANIFESTS) if alone else [manifest]
        old = [name for m in before for name in folder.entries(m)]
        files = [f for m in messages if m is not None for f in m.files]
        folder.publish(manifest, files)
        folder.delete([m for m in before if m != manifest])
        # From here on no manifest names what was there before.
        folder.delete([name for name in old if name not in {f"{FILES}/{n}" for n, _ in files}])

    def _abort(self) -> None:
        """Also deletes what killed tasks had written, of which no message tells."""
        folder = _Folder(self.path)
        folder.delete(folder.unnamed(self.run))


class BatchBranches(_Writer, DataSourceArrowWriter):
    def __init__(self, path: str, branch: str, job: str, overwrite: bool) -> None:
        super().__init__(path, branch)
        self.job, self.overwrite = job, overwrite

    def commit(self, messages: list[Written | None]) -> None:
        self._commit(messages, f"{MANIFESTS}/job-{_escaped(self.job)}.json", alone=self.overwrite)

    def abort(self, messages: list[Written | None]) -> None:
        self._abort()


class StreamBranches(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self._commit(messages, f"{MANIFESTS}/batch-{batchId:012d}.json")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._abort()


class CommittedBranches(DataSource):
    """Options: ``path``; ``branch``, the column that parts the lines (default ``route``); ``job``, the id of a batch job (default:
    a new one, so that the job adds its lines)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> BatchBranches:
        options = self.options
        return BatchBranches(options["path"], options.get("branch", "route"), options.get("job", uuid.uuid4().hex), overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamBranches:
        return StreamBranches(self.options["path"], self.options.get("branch", "route"))


def _lines(df: DataFrame, branch: str) -> DataFrame:
    df.sparkSession.dataSource.register(CommittedBranches)
    return df.select("value", branch)


def write_committed(df: DataFrame, path: str, job: str | None = None, branch: str = "route", overwrite: bool = False) -> None:
    """Write ``value`` by ``branch``. A job that is run again under its id ``job`` replaces what it wrote before; with
    ``overwrite`` it replaces all that is there."""
    writer = _lines(df, branch).write.format(FORMAT).mode("overwrite" if overwrite else "append").option("branch", branch)
    (writer if job is None else writer.option("job", job)).save(path)


def stream_committed(df: DataFrame, path: str, checkpoint: str, branch: str = "route"):
    """A stream writer of ``value`` by ``branch``, to set a trigger on and start. ``path`` belongs to one query."""
    writer = _lines(df, branch).writeStream.format(FORMAT).option("path", path).option("branch", branch)
    return writer.option("checkpointLocation", checkpoint)


def read_committed(spark: SparkSession, path: str, branch: str = "route") -> DataFrame:
    """``value`` and the branch of all lines that have been committed."""
    folder = _Folder(path)
    names = [name for manifest in folder.names(MANIFESTS) for name in folder.entries(manifest)]
    if not names:
        return spark.createDataFrame([], f"value string, {branch} string")
    root = path.rstrip("/")
    schema = StructType().add("value", "string").add(branch, "string")
    return spark.read.schema(schema).option("basePath", f"{root}/{FILES}").text([f"{root}/{name}" for name in names])


def remove_unnamed(path: str) -> int:
    """Delete all files that no commit names, and say how many. Only while no job writes to ``path``."""
    folder = _Folder(path)
    names = folder.unnamed()
    folder.delete(names)
    return len(names)


def committed_rows(spark: SparkSession, path: str, branch: str = "route") -> DataFrame:
    """Branch and ``n``, how many lines have been committed, from the manifests alone."""
    folder = _Folder(path)
    manifests = [f"{path.rstrip('/')}/{name}" for name in folder.names(MANIFESTS)]
    if not manifests:
        return spark.createDataFrame([], f"{branch} string, n long")
    name = F.url_decode(F.regexp_extract("name", "=([^/]*)/", 1))
    value = F.when(name != "__HIVE_DEFAULT_PARTITION__", name).alias(branch)
    return spark.read.schema(_ENTRY).json(manifests).groupBy(value).agg(F.sum("rows").alias("n"))
