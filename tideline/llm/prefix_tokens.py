"""Token counts of every prefix (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm import bpe
from tideline.llm.words import WordTable, keep_while, narrow_batches, text_batches


@lru_cache(maxsize=2)
def _table(path: str) -> WordTable:
    counter = bpe.counter(path)
    keep_while("prefix tokens", counter.forget)
    return WordTable("prefix tokens", counter.chunks, np.int32, 900_000, 16_000_000)


def _prefix_arrays(texts: list[str | None], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every prefix of every text one after another, and each text's code points."""
    table = _table(path)
    chunks = [bpe.CHUNK.findall(t) if t else [] for t in texts]
    per_text = np.fromiter(map(len, chunks), np.int64, len(chunks))
    local, lengths = table.gather(table.rows([c for one in chunks for c in one]))
    ends = np.cumsum(lengths)
    of_chunk = local[ends - 1].astype(np.int64) if len(ends) else np.zeros(0, np.int64)
    before = np.cumsum(of_chunk) - of_chunk
    first = np.repeat(np.cumsum(per_text) - per_text, per_text)  # the first chunk of each chunk's text
    counts = local + np.repeat(before - before[first], lengths) if len(ends) else local
    return counts.astype(np.int32), np.fromiter((len(t or "") for t in texts), np.int64, len(texts))


def with_prefix_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "prefix_tokens") -> DataFrame:
    """Add `out`: array of the token counts of the text's prefixes of 1, 2, ... code points.

    The last entry is the count of the whole text under the tokenizer file at `path`,
    without added special tokens; special strings in the text count as the library
    takes them. Null and empty texts get an empty array. Code points that cannot be
    parted (a letter and its combining marks, a special token) share the count after them.
    All columns stay; a column named `out` is replaced. Rows never leave their partition.
    """
    narrow_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != out]
    shape = T.StructType([*(docs.schema[c] for c in keep), T.StructField(out, T.ArrayType(T.IntegerType()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            counts, sizes = _prefix_arrays(texts, path)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            arrays = pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts))
            columns = [batch.column(k) for k in range(batch.num_columns) if k != at]
            yield pa.RecordBatch.from_arrays([*columns, arrays], names=[*names, out])

    # The text goes along under a name of its own, since any column may be called `text`.
    names = [f"c{k}" for k in range(len(keep))]
    at = len(keep)
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").alias("text"))
    inside = T.StructType([*(T.StructField(n, f.dataType) for n, f in zip(names, shape, strict=False)), shape[-1]])
    return given.mapInArrow(count, inside).toDF(*shape.names)


def tokens_of(prefix: Column, characters: Column | None = None) -> Column:
    """Tokens of the whole text, or of its first so many code points."""
    size = F.size(prefix)
    at = size if characters is None else F.least(characters, size)
    return F.when(at > 0, F.element_at(prefix, at.cast("int"))).otherwise(F.lit(0)).cast("long")


def fitting_characters(prefix: Column, budget: int) -> Column:
    """Code points of the longest prefix that has at most `budget` tokens."""
    places = F.transform(prefix, lambda n, k: F.when(n <= budget, k + 1).otherwise(0))
    return F.when(tokens_of(prefix) <= budget, F.size(prefix)).otherwise(F.array_max(places)).cast("long")


def truncate(text: Column, prefix: Column, budget: int) -> Column:
    """The longest prefix within the budget, without encoding again."""
    return F.substring(text, F.lit(1), fitting_characters(prefix, budget).cast("int"))
