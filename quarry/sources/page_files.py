"""SRC-1 / SRC-3 / SRC-4 / FLT-3 and SNK-3: trees of files of any name, listed, read and written by tasks.

Spark's own readers pass over names that start with '.' or '_', list trees on the driver, and write no file of a chosen
name.  Here folders are rows: a job lists the folders of one level, its subfolders are the next job's rows, so the driver
never holds a listing.  Name patterns are tested where a folder is listed, before a file is opened.

Pages are saved one file each in two jobs: tasks write into a folder of their own attempt, and only when all are done
does a second job rename the files of the attempts that succeeded into place.  Both can be repeated: a lost executor's
attempt is never renamed, a rename that was done already is passed over.  A failed first job leaves nothing.

Paths are those pyarrow can open on the executors (shared folders, hdfs://, s3://, gs://).
"""

from __future__ import annotations

import fnmatch
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.web import with_metadata_header
from quarry.session import reliable_checkpoint, remove_path

LISTED = "path string, name string, size long, folder boolean"
FOLDERS_PER_TASK = 16
BYTES_PER_TASK = 64 << 20
CHUNK_BYTES = 32 << 20


def _plain(path: str) -> str:
    """``file:/x`` and ``file:///x`` as ``/x``; other schemes as they are."""
    return "/" + path[5:].lstrip("/") if path.startswith("file:") else path


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(_plain(path))


def _entries(folder: str, name: str, glob: str | None) -> Iterator[tuple[str, str, int, bool]]:
    """(path, name, size, folder) of what lies in a folder; links to folders are not followed."""
    store, at = _open(folder)
    local = isinstance(store, pafs.LocalFileSystem)
    for info in store.get_file_info(pafs.FileSelector(at)):
        full, rel = f"{folder.rstrip('/')}/{info.base_name}", f"{name}/{info.base_name}" if name else info.base_name
        if info.type == pafs.FileType.Directory:
            if not (local and os.path.islink(info.path)):
                yield full, rel, 0, True
        elif info.type == pafs.FileType.File and (glob is None or fnmatch.fnmatchcase(info.base_name, glob)):
            yield full, rel, info.size, False


def list_tree(spark: SparkSession, root: str, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """path, name (relative to ``root``), size of every regular file, whatever its name.  A root that is missing, empty or
    no folder is an error."""
    if not root:
        raise ValueError("root must be a directory path")
    root = _plain(root).rstrip("/") or "/"
    if not root.startswith("/") and "://" not in root:
        root = os.path.abspath(root)
    store, at = _open(root)
    if store.get_file_info(at).type != pafs.FileType.Directory:
        raise ValueError(f"{root} is not a directory")

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = list(_entries(path, name, glob))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([e[i] for e in found], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.bool_()))],
                    names=["path", "name", "size", "folder"])

    folders, levels, count = spark.createDataFrame([(root, "")], "path string, name string"), [], 1
    while count:
        tasks = max(1, min(-(-count // FOLDERS_PER_TASK), 10_000))
        level = reliable_checkpoint(folders.repartition(tasks).mapInArrow(listing, LISTED), "listing")
        levels.append(level.where("NOT folder"))
        folders = level.where("folder").select("path", "name")
        count = folders.count() if recursive else 0
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.select("path", "name", "size")


def read_files(listed: DataFrame) -> DataFrame:
    """path, name, content of listed files; a file that cannot be read has null content.  Files are dealt out by their bytes."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.binary()))],
                                              names=["path", "name", "content"])
        for batch in batches:
            for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    store, at = _open(path)
                    with store.open_input_stream(at) as f:
                        data = f.read()
                except OSError:
                    data = None
                rows.append((path, name, data))
                held += len(data or b"")
                if held >= CHUNK_BYTES or len(rows) >= 1000:
                    yield batch_of()
                    rows, held = [], 0
        if rows:
            yield batch_of()

    files = reliable_checkpoint(listed.select("path", "name", "size"), "files")
    size = files.agg(F.coalesce(F.sum(F.col("size") + 4096), F.lit(0))).first()[0]
    return files.repartition(max(1, -(-size // BYTES_PER_TASK))).select("path", "name").mapInArrow(read, "path string, name string, content binary")


def save_page_files(fetched: DataFrame, root: str, uri_col: str = "uri", body_col: str = "body") -> DataFrame:
    """SNK-3: one file for each page, ``root/HOST/md5(uri)``, the metadata header before the body.  Returns host, page_key, uri
    of the files in place.  A page saved before is replaced; of several rows of one URI one is saved."""
    spark = fetched.sparkSession
    root = _plain(root).rstrip("/")
    attempts = f"{root}/.attempts-{uuid.uuid4().hex}"
    pages = with_metadata_header(fetched.dropDuplicates([uri_col]), uri_col, body_col).select("host", "page_key", "uri", "content")
    # A host is the name of a folder: an empty one, or one that would leave the tree, gets a name of its own.
    folder = F.when(F.col("host").rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$"), F.col("host")).otherwise(F.concat(F.lit("_"), F.md5("host")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = f"{attempts}/{uuid.uuid4().hex}"
        store, at = _open(mine)
        store.create_dir(at, recursive=True)
        for batch in batches:
            made = []
            for key, content in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                with store.open_output_stream(f"{at}/{key}") as f:
                    f.write((content or "").encode())
                made.append(f"{mine}/{key}")
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(made, pa.string())], names=["host", "folder", "uri", "page_key", "attempt"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, key, attempt in zip(*(batch.column(i).to_pylist() for i in (1, 3, 4)), strict=True):
                store, source = _open(attempt)
                target = _open(f"{root}/{folder}")[1]
                store.create_dir(target, recursive=True)
                if store.get_file_info(source).type == pafs.FileType.File:
                    store.move(source, f"{target}/{key}")
                elif store.get_file_info(f"{target}/{key}").type != pafs.FileType.File:
                    raise FileNotFoundError(attempt)
            yield batch.select([0, 3, 2])

    try:
        written = reliable_checkpoint(pages.select("host", folder.alias("folder"), "uri", "page_key", "content")
                                      .mapInArrow(write, "host string, folder string, uri string, page_key string, attempt string"), "attempts")
        return reliable_checkpoint(written.mapInArrow(place, "host string, page_key string, uri string"), "placed")
    finally:
        remove_path(spark, attempts)
