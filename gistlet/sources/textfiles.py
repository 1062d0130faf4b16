"""A12 on a file system that every task sees as local files: one file for each article, made and read by the tasks.

Hadoop's local file system starts a process (chmod) for each folder, file and checksum that it makes, and Spark's
scan keeps every file's status on the driver; with a file for each article that is nearly all of the time. Here each
task writes the files of its articles itself, into a folder that takes its name when all of them are there, and each
task that reads looks its folder up itself. Other file systems, and folders of another layout, are left to Spark.

Layout: ``task=<task>/part-<task>.id=<id>.txt``, the id escaped as Spark escapes a partition's value; an id that is null, empty
or too long for that stands as a folder, ``task=<task>/id=<id>/part-<task>.txt``.
"""

from __future__ import annotations

import os
import re
import shutil
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gistlet.session import BATCH_BYTES, bound_batches

#: What Spark escapes in a partition's value.
_ESCAPED = {c: f"%{c:02X}" for c in (*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^"))}
_NO_ID = "__HIVE_DEFAULT_PARTITION__"
_LONGEST_NAME = 255
#: Files that one reading task looks at together.
FILES = 2000
#: Names that Hadoop reads through a codec.
_PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".zstd", ".passthrough")


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system knows it; None where it is of another file system or has wildcards."""
    if re.search(r"[*?\[\]{}\\]", path):
        return None
    given = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = given.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(given).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _file_name(ident: str | None, task: int) -> str:
    value = ident.translate(_ESCAPED) if ident else _NO_ID
    name = f"part-{task:05d}.id={value}.txt"
    return name if ident and len(name.encode()) <= _LONGEST_NAME else f"id={value}/part-{task:05d}.txt"


def write_files(articles: DataFrame, folder: str) -> None:
    """A file for each id of (id, value), with a line for each of its values. A partition must have all rows of its ids."""
    bound_batches(articles.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        made, out, last, n = f"{folder}/_task-{task:05d}-{attempt}", None, None, 0
        try:
            for batch in batches:
                for ident, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if out is None or (ident or None) != last:
                        if out is not None:
                            out.close()
                        last = ident or None
                        name = f"{made}/{_file_name(last, task)}"
                        if not n or "/id=" in name[len(made):]:
                            os.makedirs(os.path.dirname(name), exist_ok=True)
                        out, n = open(name, "wb"), n + 1
                    if value.is_valid:
                        out.write(value.as_buffer())
                    out.write(b"\n")
        finally:
            if out is not None:
                out.close()
        if n:
            try:
                os.rename(made, f"{folder}/task={task:05d}")
            except OSError:      # another attempt at this task has done it
                if not os.path.isdir(f"{folder}/task={task:05d}"):
                    raise
                shutil.rmtree(made)
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})

    if os.path.isdir(folder):
        shutil.rmtree(folder)
    os.makedirs(folder)
    rows = articles.select("id", F.col("value").cast("binary").alias("value")).sortWithinPartitions("id")
    rows.mapInArrow(write, "files BIGINT").agg(F.sum("files")).collect()
    for name in os.listdir(folder):      # of attempts that failed
        if name.startswith("_task-"):
            shutil.rmtree(f"{folder}/{name}")
    open(f"{folder}/_SUCCESS", "w").close()


def _visible(name: str) -> bool:
    """As Spark's file index has it."""
    return not (name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_"))


def _article_id(folder: str, name: str) -> str | None:
    """The id in the place of an article's file; None for a file elsewhere."""
    top = os.path.basename(folder)
    if top.startswith("id=") and top != "id=":
        return unquote(top[3:])
    found = re.fullmatch(r"part-\d{5,}\.id=(.+)\.txt", name, re.S)
    return unquote(found[1]) if found else None


def article_folders(folder: str) -> list[tuple[str, int]] | None:
    """(folder, number of files) of each folder with articles; None if there are files that only Spark's reader can tell."""
    found, todo = [], [folder.rstrip("/") or "/"]
    while todo:
        here, n = todo.pop(), 0
        with os.scandir(here) as entries:
            for e in entries:
                if not _visible(e.name):
                    continue
                if e.is_dir():
                    todo.append(e.path)
                elif e.name.endswith(_PACKED) or _article_id(here, e.name) is None:
                    return None
                else:
                    n += 1
        if n:
            found.append((here, n))
    return found


def read_files(spark: SparkSession, folders: list[tuple[str, int]]) -> DataFrame:
    """(id, value) of every file in the folders; a large folder is read in parts."""
    bound_batches(spark)
    parts = [(f, k, m) for f, n in folders for m in [-(-n // FILES)] for k in range(m)]
    out = pa.schema([("id", pa.string()), ("value", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, values, held = [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                with os.scandir(row["folder"]) as entries:
                    names = [e.name for e in entries if _visible(e.name) and zlib.crc32(os.fsencode(e.name)) % row["parts"] == row["part"] and not e.is_dir()]
                for name in names:
                    with open(f"{row['folder']}/{name}", "rb") as f:
                        values.append(f.read())
                    ids.append(_article_id(row["folder"], name))
                    held += len(values[-1])
                    if held >= BATCH_BYTES or len(ids) >= FILES:
                        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(values, pa.binary())], schema=out)
                        ids, values, held = [], [], 0
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(values, pa.binary())], schema=out)

    tasks = max(1, min(len(parts), 4 * spark.sparkContext.defaultParallelism))
    rows = spark.createDataFrame(parts, "folder STRING, part INT, parts INT").repartition(tasks)
    return rows.mapInArrow(read, "id STRING, value BINARY").select("id", F.col("value").cast("string").alias("value"))
