"""Reads of parts of files: heads and tails of text, members of archives. Whole files never pass through a task.

Files are listed by Spark; tasks seek into them. Task functions carry their own code, so that workers need
not have the package installed.
"""

from __future__ import annotations

import builtins
from collections.abc import Callable, Iterator
from types import FunctionType

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FIRST_READ = 4_096


def own_copy(function: Callable) -> Callable:
    """The same function without its module, so that it travels to workers with its code."""
    return FunctionType(function.__code__, {"__builtins__": builtins}, function.__name__, function.__defaults__)


def listed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, file_name, size and `_path` of every file below `path` (folders, files or globs); no content is read.

    `_path` is the path as the metadata of other readers shows it, to join with.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select("path", name.alias("file_name"), F.col("length").alias("size"), F.col("_metadata.file_path").alias("_path"))


def opener() -> Callable:
    """Function that opens a file for random access, by the path Spark gives it."""

    def open_file(path: str):
        from urllib.parse import urlsplit

        from pyarrow import fs

        scheme, _, rest = path.partition(":")
        if not rest or scheme == "file":
            local = rest if rest else path
            return fs.LocalFileSystem().open_input_file("/" + local.lstrip("/"))
        parts = urlsplit(path)
        system, base = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{parts.netloc}/")
        return system.open_input_file(f"{base.rstrip('/')}/{path.split('://', 1)[1].split('/', 1)[1]}")

    return open_file


def creator() -> Callable:
    """Function that opens a new file for writing, by its path; folders of local files are made."""

    def create_file(path: str):
        from urllib.parse import urlsplit

        from pyarrow import fs

        scheme, _, rest = path.partition(":")
        if not rest or scheme == "file":
            local = "/" + (rest if rest else path).lstrip("/")
            fs.LocalFileSystem().create_dir(local.rsplit("/", 1)[0], recursive=True)
            return fs.LocalFileSystem().open_output_stream(local)
        parts = urlsplit(path)
        system, base = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{parts.netloc}/")
        return system.open_output_stream(f"{base.rstrip('/')}/{parts.path.lstrip('/')}")

    return create_file


def text_opener() -> Callable:
    """Function that gives (read(start, length), size) of a text file; a compressed one is unpacked first, since it cannot be seeked into."""
    open_file = opener()

    def opened(path: str):
        import pyarrow as pa

        file = open_file(path)
        packed = next((kind for end, kind in ((".gz", "gzip"), (".bz2", "bz2"), (".zst", "zstd")) if path.lower().endswith(end)), None)
        if packed is not None:
            content = pa.CompressedInputStream(file, packed).read()
            return (lambda start, length: content[start : start + length]), len(content)
        return (lambda start, length: file.read_at(length, start)), file.size()

    return opened


def heads(spark: SparkSession, path: str | list[str], take: Callable[[list[str], bool], list[str] | None]) -> DataFrame:
    """The columns of `listed`, bytes_read and `head`: the first lines of every file.

    `take(lines, whole)` gets the complete lines read so far and returns those wanted, or None for more: then twice as much is
    read. With `whole` the file has ended, and what it returns is final.
    """
    open_text = text_opener()
    first_read = _FIRST_READ

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        for batch in batches:
            found, done = [], []
            for name in batch.column(0).to_pylist():
                at, size = open_text(name)
                content, head = b"", None
                while head is None:
                    content += at(len(content), max(first_read, len(content)))
                    whole = len(content) >= size
                    lines = re.split("\r\n|\n|\r", content.decode("utf-8", errors="replace"))
                    if not whole or lines[-1] == "":
                        lines = lines[:-1]  # perhaps cut off
                    head = take(lines, whole)
                    if whole:
                        head = head or []
                found.append(head)
                done.append(len(content))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done, pa.int64()), pa.array(found, pa.list_(pa.string()))], names=["path", "file_name", "size", "_path", "bytes_read", "head"])

    return listed(spark, path).mapInArrow(read, "path string, file_name string, size long, _path string, bytes_read long, head array<string>")


def text_ends(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The columns of `listed`, bytes_read, and the first two and the last filled lines of every file, split at commas (line_1, line_2, line_n).

    What is read grows until the lines are complete, from both ends, so it depends on their length and not on the file's.
    """
    open_text = text_opener()
    first_read = _FIRST_READ

    def fields(line: str | None) -> list[str] | None:
        import csv

        return None if line is None else next(csv.reader([line]), [])

    def split(content: bytes) -> list[str]:
        import re

        return re.split("\r\n|\n|\r", content.decode("utf-8", errors="replace"))

    def ends(name: str) -> tuple:
        at, size = open_text(name)
        content = b""
        while True:
            content += at(len(content), max(first_read, len(content)))
            whole = len(content) >= size
            lines = split(content)
            filled = [line for line in (lines if whole else lines[:-1]) if line.strip()]
            if whole or len(filled) >= 2:
                break
        done = len(content)
        last = filled[-1] if filled else None
        if not whole:
            tail, length = b"", 0
            while True:
                more = min(size - length, max(first_read, length))
                tail = at(size - length - more, more) + tail
                length += more
                done += more
                lines = split(tail)
                kept = [line for line in (lines if length == size else lines[1:]) if line.strip()]
                if kept or length == size:
                    last = kept[-1] if kept else last
                    break
        first, second = (filled[k] if len(filled) > k else None for k in (0, 1))
        return done, fields(first), fields(second), fields(last)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = pa.list_(pa.string())
        for batch in batches:
            rows = [ends(name) for name in batch.column(0).to_pylist()]
            added = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate([pa.int64(), text, text, text])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=["path", "file_name", "size", "_path", "bytes_read", "line_1", "line_2", "line_n"])

    shape = "path string, file_name string, size long, _path string, bytes_read long, line_1 array<string>, line_2 array<string>, line_n array<string>"
    return listed(spark, path).mapInArrow(read, shape)
