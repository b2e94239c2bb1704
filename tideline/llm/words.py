"""Words of texts, and tables that keep what was worked out for a word. Used inside tasks."""

from __future__ import annotations

import re
import tempfile
import weakref
import zipfile
from collections.abc import Callable, Iterator
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# The six ASCII spaces that part words in every contract of this subpackage.
SPACE = r"\x20\x09-\x0D"
_WORD = re.compile(f"[^{SPACE}]+")
# What str.split() also splits at, besides the six.
_OTHER_SPACES = tuple("\x1c\x1d\x1e\x1f\x85\xa0     　") + tuple(map(chr, range(0x2000, 0x200B)))
_LOWER_ASCII = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_words(text: str | None) -> list[str]:
    """Maximal runs without the six ASCII spaces."""
    if not text:
        return []
    for space in _OTHER_SPACES[:4] if text.isascii() else _OTHER_SPACES:
        if space in text:
            return _WORD.findall(text)
    return text.split()


def lower_ascii(text: str) -> str:
    """Lower-case A-Z and nothing else."""
    return text.lower() if text.isascii() else text.translate(_LOWER_ASCII)


_kept: dict[str, list[Callable[[], Callable[[], None] | None]]] = {}
_turn: list[str] = [""]


def keep_while(group: str, clear: Callable[[], None]) -> None:
    """Have `clear` called once another group of tables is used in this worker, so that memory holds one group's."""
    # A table is held weakly: when its owner lets go of it, it is gone.
    _kept.setdefault(group, []).append(weakref.WeakMethod(clear) if hasattr(clear, "__func__") else lambda: clear)


def _take_turn(group: str) -> None:
    if _turn[0] != group:
        for other, clears in _kept.items():
            if other != group:
                for held in clears:
                    clear = held()
                    if clear is not None:
                        clear()
        _turn[0] = group


class WordTable:
    """Arrays by word, worked out once for each word a worker meets.

    `measure` gives one array (or one list) for each of a list of new words, or all arrays joined and their lengths. At `limit` words or
    `room` array items the table starts anew, so memory stays bounded whatever the corpus holds.
    Tables of another `group` are emptied when this one is used.
    """

    def __init__(self, group: str, measure: Callable[[list[str]], list], dtype, limit: int = 200_000, room: int = 4_000_000):
        self.group, self.measure, self.dtype, self.limit, self.room = group, measure, dtype, limit, room
        self.clear()
        keep_while(group, self.clear)

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.start = np.zeros(1024, np.int64)
        self.length = np.zeros(1024, np.int64)
        self.flat = np.zeros(4096, self.dtype)
        self.used = 0

    def rows(self, words: list[str]) -> np.ndarray:
        """Row of each word, new words measured first."""
        _take_turn(self.group)
        if len(self.index) > self.limit or self.used > self.room:
            self.clear()
        index = self.index
        found = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            unknown = [words[k] for k in missing.tolist()]
            self._add(list(dict.fromkeys(unknown)))
            found[missing] = np.fromiter(map(index.__getitem__, unknown), np.int64, len(unknown))
        return found

    def _add(self, new: list[str]) -> None:
        arrays = self.measure(new)
        joined = isinstance(arrays, tuple)
        lengths = arrays[1] if joined else np.fromiter(map(len, arrays), np.int64, len(arrays))
        at, total = len(self.index), int(lengths.sum())
        while at + len(new) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros(len(x), np.int64)]) for x in (self.start, self.length))
        if self.used + total > len(self.flat):
            bigger = np.zeros(max(2 * len(self.flat), self.used + total), self.dtype)
            bigger[: self.used] = self.flat[: self.used]
            self.flat = bigger
        self.length[at : at + len(new)] = lengths
        self.start[at : at + len(new)] = self.used + np.cumsum(lengths) - lengths
        if total:
            listed = isinstance(arrays[0], list)
            new_items = arrays[0] if joined else np.fromiter(chain.from_iterable(arrays), self.dtype, total) if listed else np.concatenate(arrays)
            self.flat[self.used : self.used + total] = new_items
        self.used += total
        self.index.update(zip(new, range(at, at + len(new)), strict=True))

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arrays of `rows` one after another, and their lengths."""
        lengths = self.length[rows]
        return self.flat[spans(self.start[rows], lengths)], lengths


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every span, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over consecutive groups of `counts` values; 0 for empty groups."""
    running = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    ends = np.cumsum(counts)
    return running[ends] - running[ends - counts]


def text_batches(batches: Iterator[pa.RecordBatch], characters: int = 1_000_000) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Record batches cut so that one holds about so many characters, with their texts (column `text`)."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        start = size = 0
        for k, text in enumerate(texts):
            size += len(text or "")
            if size >= characters or k + 1 == len(texts):
                yield batch.slice(start, k + 1 - start), texts[start : k + 1]
                start, size = k + 1, 0


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session; their workers then import it and keep its tables."""
    context = spark.sparkContext
    if getattr(context, "_tideline_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    name = Path(tempfile.mkdtemp(prefix="tideline-")) / "tideline.zip"
    with zipfile.ZipFile(name, "w") as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, file.relative_to(root.parent))
    context.addPyFile(str(name))
    context._tideline_shipped = True


def narrow_batches(spark: SparkSession, rows: int = 256) -> None:
    """Arrow batches of few rows, since a text may be very long; and the package on every executor."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(*columns) if columns else docs
