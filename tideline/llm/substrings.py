"""Substring dedup (operator 11): documents are factored by a relative Lempel-Ziv parse against reference blocks.

Every window of `WINDOW` words has an anchor (see `repeats.anchors`), so equal windows have equal anchors. Where the
documents of an anchor differ, its first occurrence (least doc_id) makes a stretch of `BLOCK` words around it a
reference block, and every other occurrence sends the words around it to that block. So a document is factored against every
block that can share a window with it, and blocks never outgrow their size, however many documents meet them: the
documents of a block are rows of a join, which adaptive execution splits.

Windows whose anchor is shared but that are not in the anchor's block can only equal other such windows. They meet by their hash (128 bits,
of the window and of its anchor), first those of them whose half around the anchor is shared.

Texts that are equal as a whole stand as one row up to the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm import repeats
from tideline.llm.repeats import SEED, WINDOW
from tideline.llm.words import narrow_batches, text_batches

BLOCK = 256  # anchor places of a reference block
_NOTHING = hashlib.sha256(b"").hexdigest()
_SIDE = (WINDOW - SEED) // 2  # words beside the anchor that a half window has


def _hashes(text: Column) -> list[Column]:
    """Two independent hashes of a text."""
    return [F.xxhash64(F.lit(11), text).alias("h1"), F.xxhash64(F.lit(29), text).alias("h2")]


def _digest(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode()).hexdigest()


def _lists(counts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, h1, h2, n_words, whole (sha256 of all words), and anchors of the text: hash, place, first window."""
    for batch, texts in text_batches(batches):
        words = [repeats.words_of(t) for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        found, place, first, counts = repeats.anchors(repeats.word_hashes([w for one in words for w in one]), sizes)
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3],
                pa.array(sizes),
                pa.array([_digest(w) for w in words]),
                _lists(counts, found.view(np.int64), pa.int64()),
                _lists(counts, place.astype(np.int32), pa.int32()),
                _lists(counts, first.astype(np.int32), pa.int32()),
            ],
            names=["doc_id", "h1", "h2", "n_words", "whole", "anchor", "place", "first"],
        )


_SLICE = "is_reference boolean, ref long, block int, node long, doc_id long, start int, places array<int>, firsts array<int>, nexts array<int>, words string"


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a text around its anchors, by the reference block they go to, and the text's own blocks."""
    names = [column.split(" ")[0] for column in _SLICE.split(", ")]
    for batch, texts in text_batches(batches):
        rows: list[tuple] = []
        columns = [batch.column(k).to_pylist() for k in range(4)]
        for node, doc_id, routes, own, text in zip(*columns, texts, strict=True):
            words = repeats.words_of(text)
            for block in own or ():
                start = max(0, block * BLOCK - (WINDOW - SEED))
                end = min(len(words), (block + 1) * BLOCK - 1 + WINDOW)
                rows.append((True, node, block, node, doc_id, start, None, None, None, " ".join(words[start:end])))
            for route in routes or ():
                marks = sorted((m["place"], m["first"], m["next"]) for m in route["marks"])
                places, firsts, nexts = (np.array(m, np.int32) for m in zip(*marks, strict=True))
                for a, b, start, end in repeats.pieces(places, len(words)):
                    rows.append((False, route["ref"], route["block"], node, doc_id, start, places[a:b], firsts[a:b], nexts[a:b], " ".join(words[start:end])))
        kinds = [pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


_FOUND = "node long, doc_id long, start int, ends int, window long, half long"


def _factored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats of a slice in the block beside it (`ends` set), and its windows that the block lacks (`window` set).

    Rows of one block follow each other more often than not, so its index is kept from row to row.
    """
    key = block = None
    for batch in batches:
        found: list[tuple] = []
        columns = [batch.column(k).to_pylist() for k in range(10)]
        texts = [text.split(" ") for text in columns[8]]
        hashes = repeats.word_hashes([w for one in texts for w in one])
        at = 0
        for ref, number, node, doc_id, start, places, firsts, nexts, _, reference, ref_doc, words in zip(*columns, batch.column(10).to_pylist(), texts, strict=True):
            mine = hashes[at : at + len(words)]
            at += len(words)
            if key != (ref, number):
                key, block = (ref, number), repeats.Reference(reference.split(" "))
            spans = block.repeats(words)
            if ref_doc < doc_id:
                found += [(node, doc_id, start + a, start + b, None, None) for a, b in spans]
            left = ~repeats.window_starts(spans, len(words))
            if not left.any():
                continue
            windows, sides = repeats.rolling(mine, WINDOW).view(np.int64), repeats.rolling(mine, SEED + _SIDE).view(np.int64)
            for place, first, after in zip(places, firsts, nexts, strict=True):
                for s in range(first - start, after - start):
                    if left[s]:
                        p = place - start
                        # The half window: the anchor and the words before it, or behind it, whichever the window has more of.
                        half = sides[p - _SIDE] if p - s >= _SIDE else ~sides[p]
                        found.append((node, doc_id, start + s, None, int(windows[s]), int(half)))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)], names=[c.split(" ")[0] for c in _FOUND.split(", ")])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """h1, h2, n_removed, kept_sha256 and spans of texts with their repeats."""
    for batch, texts in text_batches(batches):
        removed, digests, shown = [], [], []
        for spans, text in zip(batch.column(2).to_pylist(), texts, strict=True):
            words = repeats.words_of(text)
            gone = repeats.covered([(s["start"], s["ends"]) for s in spans], len(words))
            removed.append(int(gone.sum()))
            digests.append(_digest([w for w, g in zip(words, gone.tolist(), strict=True) if not g]))
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2)
            shown.append(",".join(f"{a}:{b}" for a, b in edges.tolist()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(shown, pa.string())], names=["h1", "h2", "n_removed", "kept_sha256", "spans"])


def without_repeats(docs: DataFrame, scratch: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and spans for every row of `docs` (doc_id, text).

    A word goes if a window over it also starts in a document with a smaller doc_id; `spans` are the removed
    stretches (word numbers, end exclusive). Null and empty texts have no words. Rows without doc_id keep all words and cost
    others none; rows of one doc_id don't cost each other words; rows with equal text and id get equal results. Texts of any length are
    taken whole. Other columns play no part. Intermediate tables lie below `scratch`, on shared storage.
    """
    spark = docs.sparkSession
    narrow_batches(spark)

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_hashes(F.col("text")), "text")
    shape = "doc_id long, h1 long, h2 long, n_words long, whole string, anchor array<long>, place array<int>, first array<int>"
    profiles = stored(given.mapInArrow(_profiles, shape).withColumn("row", F.monotonically_increasing_id()), "profiles")

    usable = profiles.where(f"doc_id is not null and n_words >= {WINDOW}")
    least = usable.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "row")).alias("least"))
    nodes = stored(least.select("h1", "h2", F.col("least.doc_id").alias("doc_id"), F.col("least.row").alias("node")), "nodes")

    # Anchors of one row for each text, each with the first window of the next one.
    own = usable.withColumnRenamed("row", "node").join(nodes.select("node"), "node", "left_semi")
    after = F.concat(F.slice("first", 2, F.greatest(F.size("first"), F.lit(1))), F.array((F.col("n_words") - WINDOW + 1).cast("int")))
    zipped = F.arrays_zip(F.col("anchor"), F.col("place"), F.col("first"), after.alias("next"))
    placed = own.select("node", "doc_id", F.explode(zipped).alias("a")).select("node", "doc_id", "a.*")
    placed = stored(placed, "anchors")
    first = F.min(F.struct("doc_id", "node", "place")).alias("least")
    known = placed.groupBy("anchor").agg(first, F.max("doc_id").alias("most")).where("least.doc_id < most")
    # The least window hash tells occurrences apart: the first one is the block's.
    shared = known.select("anchor", F.col("least.node").alias("ref"), F.col("least.place").alias("ref_place"))
    shared = stored(shared.withColumn("block", F.floor(F.col("ref_place") / BLOCK).cast("int")), "shared")
    others = placed.join(shared, "anchor").where("node <> ref or place <> ref_place")
    routed = others.groupBy("node", "ref", "block").agg(F.collect_list(F.struct("place", "first", "next")).alias("marks"))
    routes = routed.groupBy("node").agg(F.collect_list(F.struct("ref", "block", "marks")).alias("routes"))
    blocks = shared.groupBy(F.col("ref").alias("node")).agg(F.collect_set("block").alias("own"))
    plan = stored(nodes.join(routes.join(blocks, "node", "full_outer"), "node"), "plan")

    wanted = given.join(plan, ["doc_id", "h1", "h2"]).select("node", "doc_id", "routes", "own", "text")
    slices = stored(wanted.mapInArrow(_slices, _SLICE), "slices")
    # Tables that hot keys meet are written first, so that adaptive execution can split those keys.
    once = slices.where("is_reference").dropDuplicates(["ref", "block"])
    reference = stored(once.select("ref", "block", F.col("words").alias("reference"), F.col("doc_id").alias("ref_doc")), "references")
    sent = slices.where("not is_reference").drop("is_reference")
    met = sent.join(reference, ["ref", "block"]).select("ref", "block", "node", "doc_id", "start", "places", "firsts", "nexts", "words", "reference", "ref_doc")
    found = stored(met.mapInArrow(_factored, _FOUND), "found")

    rest = found.where("window is not null")
    both = rest.groupBy("half").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("half")
    halves = stored(both, "halves")
    open_ = stored(rest.join(halves, "half", "left_semi").select("window", "half", "node", "doc_id", "start"), "open")
    twice = open_.groupBy("window", "half").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").drop("most")
    twice = stored(twice, "twice")
    again = open_.join(twice, ["window", "half"]).where("doc_id > least").select("node", "start", (F.col("start") + WINDOW).alias("ends"))
    spans = found.where("window is null").select("node", "start", "ends").unionByName(again)
    gone = stored(nodes.join(spans.groupBy("node").agg(F.collect_set(F.struct("start", "ends")).alias("spans")), "node"), "spans")

    cut = given.join(gone, ["doc_id", "h1", "h2"]).select("h1", "h2", "spans", "text")
    shorter = stored(cut.mapInArrow(_kept, "h1 long, h2 long, n_removed long, kept_sha256 string, spans string").dropDuplicates(["h1", "h2"]), "shorter")
    outcome = nodes.select("h1", "h2", F.col("doc_id").alias("least")).join(shorter, ["h1", "h2"], "left")
    rows = profiles.select("doc_id", "h1", "h2", "n_words", "whole").join(outcome, ["h1", "h2"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)) & (F.col("n_words") >= WINDOW)
    its = F.coalesce(F.col("doc_id") == F.col("least"), F.lit(False)) & F.col("n_removed").isNotNull()
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).when(its, F.col("n_removed")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(copy, F.lit(_NOTHING)).when(its, F.col("kept_sha256")).otherwise(F.col("whole")).alias("kept_sha256"),
        F.when(copy, F.concat(F.lit("0:"), F.col("n_words"))).when(its, F.col("spans")).otherwise(F.lit("")).alias("spans"),
    )
