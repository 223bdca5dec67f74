"""Arrivals of whole objects as a stream source, and one file per row as a sink.

``object_arrivals`` (SRC-09, STR-08/09): every object that lands in a folder is one
row, empty ones too.  The driver only lists names; what it finds new becomes a
numbered listing in a log beside the checkpoint, and the stream's offset is the
number of the last listing.  So a batch that is run again reads the same objects,
and a restarted query goes on after the last committed listing.  Contents are
opened by the tasks.

``object_files`` (SNK-06): every row becomes the file ``label/name``.  Tasks write
into hidden folders of their attempts; when all are done, the files of those
that count are moved into place, so a failed attempt leaves nothing that a
reader lists.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

ARRIVAL_SCHEMA = "path string, name string, size long, content binary"
FILE_SCHEMA = "label string, name string, content binary"
# a stream's source runs on the driver in a Python process that doesn't get the shipped package: classes travel whole
cloudpickle.register_pickle_by_value(sys.modules[__name__])
#: Where a null label's files go.
NO_LABEL = "none__"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a URI or an absolute path, and the path in it."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path)


def visible_objects(system: fs.FileSystem, root: str) -> list[tuple[str, int]]:
    """``(path below root, size)`` of all files, without those that have a part beginning with ``_`` or ``.``."""
    root = root.rstrip("/")
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    below = ((i.path[len(root) + 1:], i.size) for i in found if i.type == fs.FileType.File)
    return sorted((p, s) for p, s in below if not any(part[0] in "_." for part in p.split("/")))


@dataclass
class Objects(InputPartition):
    """Some objects of one listing, read by one task."""

    paths: list[tuple[str, int]]


class ObjectStream(DataSourceStreamReader):
    """Listings as offsets; see the module's docstring.

    Options: ``path`` (folder of the objects), ``log`` (folder of the listings, one
    per query), ``objects_per_task`` and ``bytes_per_task`` (what a task reads at
    most, but one object at least)."""

    def __init__(self, options: dict):
        self.root, self.log = options["path"], options["log"]
        self.objects_per_task = int(options.get("objects_per_task", 10_000))
        self.bytes_per_task = int(options.get("bytes_per_task", 128 << 20))

    def _listings(self) -> tuple[fs.FileSystem, str, list[str]]:
        system, log = file_system(self.log)
        system.create_dir(log, recursive=True)
        return system, log, sorted(i.path for i in system.get_file_info(fs.FileSelector(log)) if i.base_name.startswith("listing-"))

    @staticmethod
    def _read(system: fs.FileSystem, path: str) -> list[tuple[str, int]]:
        with system.open_input_stream(path) as f:
            return [(r["path"], r["size"]) for r in map(json.loads, f.read().decode().splitlines())]

    def initialOffset(self) -> dict:
        return {"listing": 0}

    def latestOffset(self) -> dict:
        system, log, done = self._listings()
        known = {p for path in done for p, _ in self._read(system, path)}
        store, root = file_system(self.root)
        new = [o for o in visible_objects(store, root) if o[0] not in known]
        if new:  # moved into place whole: a listing is all there or not there
            part = f"{log}/_part-{uuid.uuid4().hex}"
            with system.open_output_stream(part) as f:
                f.write("\n".join(json.dumps({"path": p, "size": s}) for p, s in new).encode())
            system.move(part, f"{log}/listing-{len(done) + 1:09d}")
        return {"listing": len(done) + bool(new)}

    def partitions(self, start: dict, end: dict) -> list[Objects]:
        system, _, done = self._listings()
        parts: list[Objects] = []
        size = 0
        for path in done[start["listing"]:end["listing"]]:
            for p, s in self._read(system, path):
                if not parts or len(parts[-1].paths) >= self.objects_per_task or size + s > self.bytes_per_task:
                    parts.append(Objects([]))
                    size = 0
                parts[-1].paths.append((p, s))
                size += s
        return parts or [Objects([])]

    def read(self, partition: Objects) -> Iterator[tuple]:
        system, root = file_system(self.root)
        for path, _ in partition.paths:
            with system.open_input_stream(f"{root.rstrip('/')}/{path}") as f:
                content = f.read()
            yield path, path.rsplit("/", 1)[-1], len(content), bytes(content)

    def commit(self, end: dict) -> None:
        """Progress is the checkpoint's; the listings stay, since they say which objects are known."""


class ObjectArrivals(DataSource):
    @classmethod
    def name(cls) -> str:
        return "object_arrivals"

    def schema(self) -> str:
        return ARRIVAL_SCHEMA

    def streamReader(self, schema) -> ObjectStream:
        return ObjectStream(self.options)


def object_arrivals(spark: SparkSession, folder: str, log: str, **options) -> DataFrame:
    """SRC-09: a stream of ``path, name, size, content``, one row per object that arrives in ``folder``.

    Each trigger takes the objects that came since the last one.  Objects are told
    apart by path: one that is written anew under its old path doesn't come again.
    Names that begin with ``_`` or ``.`` are left out, with all below them.  Listing
    reads the names of ``folder`` and of the log on the driver: move objects away
    when they are done with, as with any landing folder."""
    spark.dataSource.register(ObjectArrivals)
    return spark.readStream.format("object_arrivals").options(path=folder, log=log, **options).load()


@dataclass
class Written(WriterCommitMessage):
    """What one task has written: its attempt's folder below ``_attempts``."""

    attempt: str


class ObjectWriter(DataSourceArrowWriter):
    """Tasks write below ``_attempts``; the commit lists the attempts that count in the file ``commit``."""

    def __init__(self, options: dict):
        self.root, self.list = options["path"].rstrip("/"), options["commit"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = file_system(self.root)
        attempt = uuid.uuid4().hex
        base, folders, names = f"{root}/_attempts/{attempt}", set(), set()
        try:
            system.create_dir(base, recursive=True)
            for batch in iterator:
                for label, name, content in zip(*(batch.column(c).to_pylist() for c in ("label", "name", "content")), strict=True):
                    folder = quote(label or NO_LABEL, safe=" ")
                    path = f"{folder}/{quote(name or '', safe=' ')}"
                    if not name or path in names:
                        raise ValueError(f"every row needs a name of its own: {path!r}")
                    names.add(path)
                    if folder not in folders:
                        system.create_dir(f"{base}/{folder}", recursive=True)
                        folders.add(folder)
                    with system.open_output_stream(f"{base}/{path}", compression=None) as f:
                        f.write(content or b"")
        except BaseException:
            system.delete_dir(base)
            raise
        return Written(attempt)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = file_system(self.list)
        with system.open_output_stream(path, compression=None) as f:
            f.write("\n".join(m.attempt for m in messages if m).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing of the job has been put in place; :func:`write_objects` clears its attempts."""


class ObjectFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "object_files"

    def schema(self) -> str:
        return FILE_SCHEMA

    def writer(self, schema, overwrite: bool) -> ObjectWriter:
        return ObjectWriter(self.options)


def put_in_place(root: str):
    """For ``mapInArrow``: move the files of each attempt named in a batch to their places below ``root``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(root)
        for batch in batches:
            moved = []
            for attempt in batch.column("attempt").to_pylist():
                files = visible_objects(system, f"{base}/_attempts/{attempt}")
                for folder in {p.rsplit("/", 1)[0] for p, _ in files}:
                    system.create_dir(f"{base}/{folder}", recursive=True)
                for path, _ in files:  # done again after a lost task, it moves what is left
                    system.move(f"{base}/_attempts/{attempt}/{path}", f"{base}/{path}")
                moved.append(len(files))
            yield pa.RecordBatch.from_arrays([pa.array(moved, pa.int64())], ["files"])

    return run


def write_objects(df: DataFrame, folder: str, label: str, name, content) -> None:
    """SNK-06: one file ``label/name`` per row of ``df`` in ``folder``; ``name`` and ``content`` are columns.

    Characters of labels and names that are no path are percent-escaped, a null or
    empty label is ``none__``, null content an empty file.  Names must be there,
    and unique within a label (of equal names in different tasks one wins; in one task
    they raise).  Tasks write below a hidden folder, one row in memory at a time;
    once all of them are done, a second distributed job moves the files of the
    attempts that count into place.  A job that fails before leaves nothing that a
    reader lists; ``_SUCCESS`` marks the end."""
    spark = df.sparkSession
    spark.dataSource.register(ObjectFiles)
    folder = folder.rstrip("/")
    system, root = file_system(folder)
    commit = f"{folder}/_attempts/commit-{uuid.uuid4().hex}"
    system.create_dir(f"{root}/_attempts", recursive=True)
    rows = df.select(df[label].cast("string").alias("label"), name.cast("string").alias("name"), content.cast("binary").alias("content"))
    rows.write.format("object_files").mode("append").option("path", folder).option("commit", commit).save()
    attempts = spark.read.text(commit).withColumnRenamed("value", "attempt")  # a row per task
    # by number: by key, these few short rows would be merged into one task that moves all files
    attempts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(put_in_place(folder), "files long").write.format("noop").mode("overwrite").save()
    system.delete_file(file_system(commit)[1])
    with system.open_output_stream(f"{root}/_SUCCESS", compression=None):
        pass
