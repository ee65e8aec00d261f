"""A vault of Markdown notes as a Spark data source, `vault`: one note a row, read and written in parallel.

Rows are path (below the vault's folder, `stars/a.md`) and text. A write commits in two phases. Tasks put their notes
into a folder of the write's own; when all have ended well, the driver writes a journal that names these folders, and
from then on the write counts: its notes are moved into place, and whoever opens the vault next moves what a killed
driver has left. A write that ends before its journal leaves nothing that anyone sees. Notes that are there are never
touched in the mode `insert`; in the mode `update` those of the same text aren't written again.

The driver never holds the notes: each task lists its own in its folder, and the driver moves them, some at a time,
list by list. The folder can be any that pyarrow's file systems and all executors reach.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Where writes lie before they are in place.
PENDING = ".pending"
#: Notes that are moved into place at once.
MOVES = 16
#: Bytes of notes that a partition of a scan reads, about, and rows that it hands on at a time.
SPLIT, ROWS = 32 << 20, 2_000


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _there(files: fs.FileSystem, path: str) -> bool:
    return files.get_file_info(path).type != fs.FileType.NotFound


def _read(files: fs.FileSystem, path: str) -> bytes:
    with files.open_input_stream(path) as f:
        return f.read()


def _put(files: fs.FileSystem, path: str, data: bytes, made: set[str]) -> None:
    """Write a file that nobody looks at yet; made holds the folders that are there."""
    folder = posixpath.dirname(path)
    if folder not in made:
        files.create_dir(folder)
        made.add(folder)
    with files.open_output_stream(path) as f:
        f.write(data)


def _write(files: fs.FileSystem, path: str, data: bytes) -> None:
    """The whole file or none: it is written beside its place and moved there."""
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    _put(files, beside, data, set())
    files.move(beside, path)


def _safe(path: str) -> str:
    """A note's path as it was given, if it stays inside the vault."""
    parts = path.split("/")
    if not path.endswith(".md") or path.startswith("/") or any(p in ("", ".", "..") or p.startswith(".") for p in parts):
        raise ValueError(f"not a note's path below the vault: {path!r}")
    return path


def recover(root: str) -> int:
    """Finish the writes that have a journal; returns how many. Doing it twice, or at once with another, does no harm."""
    files, base = _open(root)
    done = 0
    if not _there(files, f"{base}/{PENDING}"):
        return 0
    for entry in files.get_file_info(fs.FileSelector(f"{base}/{PENDING}")):
        if entry.type == fs.FileType.Directory and _there(files, f"{entry.path}/JOURNAL"):
            for task in json.loads(_read(files, f"{entry.path}/JOURNAL")):
                paths = json.loads(_read(files, f"{entry.path}/{task}/LIST"))
                for folder in {posixpath.dirname(f"{base}/{p}") for p in paths}:
                    files.create_dir(folder)

                def place(path: str, staged: str = f"{entry.path}/{task}/notes") -> None:
                    if _there(files, f"{staged}/{path}"):
                        files.move(f"{staged}/{path}", f"{base}/{path}")

                with ThreadPoolExecutor(MOVES) as pool:
                    list(pool.map(place, paths))
            files.delete_dir(entry.path)
            done += 1
    return done


@dataclass
class _Files(InputPartition):
    paths: list[str]


class _Reader(DataSourceReader):
    def __init__(self, root: str):
        self.root = root

    def partitions(self) -> list[_Files]:
        recover(self.root)
        files, base = _open(self.root)
        parts, size = [_Files([])], 0
        if _there(files, base):
            found = files.get_file_info(fs.FileSelector(base, recursive=True))
            for f in sorted((f for f in found if f.type == fs.FileType.File), key=lambda f: f.path):
                path = posixpath.relpath(f.path, base)
                if path.endswith(".md") and not any(p.startswith(".") for p in path.split("/")):
                    if parts[-1].paths and size + f.size > SPLIT:
                        parts, size = [*parts, _Files([])], 0
                    parts[-1].paths.append(path)
                    size += f.size
        return parts

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        files, base = _open(self.root)
        for i in range(0, len(partition.paths), ROWS):
            paths = partition.paths[i : i + ROWS]
            texts = [_read(files, f"{base}/{p}").decode("utf-8", "replace") for p in paths]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], ["path", "text"])


@dataclass
class _Task(WriterCommitMessage):
    folder: str
    written: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, root: str, mode: str, write: str):
        self.root, self.mode, self.id = root, mode, write

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Task:
        files, base = _open(self.root)
        task = uuid.uuid4().hex
        where, listed, made = f"{base}/{PENDING}/{self.id}/{task}", [], set()
        for batch in iterator:
            for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = (text or "").encode()
                if _there(files, f"{base}/{_safe(path)}") and (self.mode == "insert" or _read(files, f"{base}/{path}") == data):
                    continue
                _put(files, f"{where}/notes/{path}", data, made)
                listed.append(path)
        if listed:
            _put(files, f"{where}/LIST", json.dumps(listed).encode(), made)
        return _Task(task, len(listed))

    def commit(self, messages: list[_Task | None]) -> None:
        files, base = _open(self.root)
        tasks = [m for m in messages if m is not None and m.written]
        if tasks:
            _write(files, f"{base}/{PENDING}/{self.id}/JOURNAL", json.dumps([m.folder for m in tasks]).encode())
            recover(self.root)
        elif _there(files, f"{base}/{PENDING}/{self.id}"):
            files.delete_dir(f"{base}/{PENDING}/{self.id}")
        _write(files, f"{base}/{PENDING}/counts/{self.id}", str(sum(m.written for m in tasks)).encode())

    def abort(self, messages: list[_Task | None]) -> None:
        files, base = _open(self.root)
        if _there(files, f"{base}/{PENDING}/{self.id}"):
            files.delete_dir(f"{base}/{PENDING}/{self.id}")


class VaultSource(DataSource):
    """Options: path, and for writes mode (insert or update) and write (a name of this write)."""

    @classmethod
    def name(cls) -> str:
        return "vault"

    def schema(self) -> str:
        return "path string, text string"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> _Writer:
        mode = self.options.get("note_mode", "insert")
        if mode not in ("insert", "update"):
            raise ValueError(f"note_mode is insert or update, not {mode!r}")
        recover(self.options["path"])
        return _Writer(self.options["path"], mode, self.options.get("write", uuid.uuid4().hex))


def read_vault(spark: SparkSession, path: str) -> DataFrame:
    """path and text of all notes below the folder; none if there is no such folder."""
    spark.dataSource.register(VaultSource)
    return spark.read.format("vault").option("path", path).load()


def write_vault(notes: DataFrame, path: str, mode: str = "insert") -> int:
    """Write notes (path, text) and return how many files were written. Of rows of one path the smallest text counts."""
    from pyspark.sql import functions as F

    notes.sparkSession.dataSource.register(VaultSource)
    write = uuid.uuid4().hex
    one = notes.where("path is not null").groupBy("path").agg(F.min("text").alias("text"))
    one.write.format("vault").option("path", path).option("note_mode", mode).option("write", write).mode("append").save()
    files, base = _open(path)
    n = int(_read(files, f"{base}/{PENDING}/counts/{write}"))
    files.delete_file(f"{base}/{PENDING}/counts/{write}")
    return n
