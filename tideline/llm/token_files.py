"""Token ids in ORC files (operator 10): whole texts encoded, written in id order, read back by stripe."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from tideline.llm.bpe import PLAIN_TEXT, SPACES, byte_texts, text_pieces
from tideline.llm.words import WordTable, narrow_batches, spans, sums, text_batches

_WORD = re.compile(f"[^{SPACES}]+")


_CONTROLS = ("\x1c", "\x1d", "\x1e", "\x1f")


def _split(text: str) -> list[str]:
    """Words at the tokenizer's white space, which is str.split()'s but for four control characters."""
    return _WORD.findall(text) if any(c in text for c in _CONTROLS) else text.split()


class _Encoder:
    """Ids by the tokenizers library, of pieces or, where a text has more than plain characters, of words; white space yields none."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # The vocabulary's model alone, for text that is split into pieces already.
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.pre_tokenizer = WhitespaceSplit()
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a piece
        self.ends[[number for token, number in vocab.items() if token.endswith("</w>")]] = True

    def pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and their numbers."""
        blocks = [byte_texts(" ".join(pieces[k : k + 1_000])) for k in range(0, len(pieces), 1_000)]
        encoded = self.merger.encode_batch_fast(blocks, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.int32) for e in encoded])
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)

    def words(self, words: list[str]) -> list[list[int]]:
        return [self.tokenizer.encode(word, add_special_tokens=False).ids for word in words]


@lru_cache(maxsize=2)
def _tables(path: str) -> tuple[WordTable, WordTable]:
    """Ids by piece and by word."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks take one core each
    encoder = _Encoder(path)
    return WordTable("token files", encoder.pieces, np.int32, 500_000, 5_000_000), WordTable("token files", encoder.words, np.int32, 100_000, 2_000_000)


def encode(texts: list[str | None], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every text one after another, and their numbers."""
    of_pieces, of_words = _tables(path)
    plain = [not t or ("<|" not in t and PLAIN_TEXT.match(t) is not None) for t in texts]
    parts = []
    for table, wanted, split in ((of_pieces, True, text_pieces), (of_words, False, _split)):
        items = [split(t) if t and is_plain == wanted else [] for t, is_plain in zip(texts, plain, strict=True)]
        ids, lengths = table.gather(table.rows([x for one in items for x in one]))
        parts.append((ids, sums(lengths, np.fromiter(map(len, items), np.int64, len(items)))))
    (ids, counts), (other_ids, other_counts) = parts
    if not len(other_ids):
        return ids, counts
    # Each text's ids come from one of the two; put them in the order of the texts.
    total = counts + other_counts
    out = np.zeros(int(total.sum()), np.int32)
    starts = np.cumsum(total) - total
    out[spans(starts, counts)] = ids
    out[spans(starts, other_counts)] = other_ids
    return out, total


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int, partitions: int | None = None) -> None:
    """Write one row per document, in ascending doc_id order over all files, as ORC.

    Columns: doc_id, n_tokens (with the end id), file_start (ids before it in its file),
    ids (array of int: run-length encoded stripes). Files carry row indexes and a Bloom
    filter on doc_id, so a reader skips stripes by metadata. Null texts count as empty;
    rows without doc_id come first; rows of one doc_id are ordered by a hash of the text, and by it
    spread over files where there are many.
    """
    spark = docs.sparkSession
    narrow_batches(spark)
    keys = [F.col("doc_id").asc_nulls_first(), F.col("_spread").asc()]
    given = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64(F.col("text")).alias("_spread"))
    ordered = (given.repartitionByRange(partitions, *keys) if partitions else given.repartitionByRange(*keys)).sortWithinPartitions(*keys)

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch, texts in text_batches(batches):
            ids, counts = encode(texts, path)
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id)
            counts = counts + 1
            ends = np.cumsum(counts)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            starts = before + ends - counts
            before += int(ends[-1]) if len(ends) else 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array(starts), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))],
                names=["doc_id", "n_tokens", "file_start", "ids"],
            )

    rows = ordered.mapInArrow(ids_of, "doc_id long, n_tokens long, file_start long, ids array<int>")
    writer = rows.write.mode("overwrite").option("maxRecordsPerFile", 0)
    # A file is what one task saw, so that file_start holds.
    for key, value in {
        "compression": "zstd",
        "orc.stripe.size": str(16 << 20),
        "orc.row.index.stride": "1000",
        "orc.create.index": "true",
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": "0.01",
    }.items():
        writer = writer.option(key, value)
    writer.orc(folder)


def _placed(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """`rows` (_file, file_start, ...) with start, the number of ids before them in all files.

    Files follow each other by part number; there are as many as writing tasks, so their order is a small table,
    and it is read from the column n_tokens only.
    """
    sizes = _files(spark, folder).groupBy("_file").agg(F.sum("n_tokens").alias("_ids"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_file", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_base"))
    return rows.join(bases, "_file").withColumn("start", F.col("_base") + F.col("file_start")).drop("_file", "_base", "file_start")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.orc(folder).withColumn("_file", F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int"))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids, from the files alone."""
    return _placed(spark, folder, _files(spark, folder)).select("doc_id", "start", "n_tokens", "ids")


def read_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of ids as little-endian unsigned 32-bit integers), from the files alone.

    The ids are reduced where they are read, so that only numbers are joined.
    """
    narrow_batches(spark)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            offsets = ids.offsets.to_numpy()
            flat = memoryview(ids.values.to_numpy().astype("<u4").tobytes())
            crc = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], batch.column(4), pa.array(crc, pa.int64())], names=["doc_id", "n_tokens", "file_start", "_file", "ids_crc32"])

    rows = _files(spark, folder).select("doc_id", "n_tokens", "file_start", "ids", "_file")
    checked = rows.mapInArrow(check, "doc_id long, n_tokens long, file_start long, _file int, ids_crc32 long")
    return _placed(spark, folder, checked).select("doc_id", "start", "n_tokens", "ids_crc32")
