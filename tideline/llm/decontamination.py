"""Benchmark decontamination (operator 4): pigeonhole pieces, then Myers' bit-parallel distance.

A benchmark item may differ by a budget of edits and still count as contained in a document. It is
cut into budget + 1 pieces, of which one must then stand unchanged. Of the two halves of a pair of
neighbouring pieces that one has an unchanged half and at most one edit in the other, for some pair;
only such places are verified.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.words import narrow_batches, text_batches

_GAPS = re.compile(r"[\W_]+")


@dataclass(frozen=True)
class Settings:
    edit_percent: int = 10  # edits allowed, in percent of the item's length
    exact_below: int = 20  # shorter items must be contained unchanged
    block_chars: int = 20_000_000  # characters of benchmark items that are searched for at a time


def normalized(text: str | None) -> str:
    """Lower case, letters and digits only, single spaces between words."""
    return _GAPS.sub(" ", text.lower()).strip() if text else ""


def budget(length: int, s: Settings) -> int:
    """Edits allowed: odd, so that the pieces come in pairs; 0 for short items."""
    return 0 if length < s.exact_below else (length * s.edit_percent // 100) | 1


def best_distance(item: str, text: str) -> int:
    """Least number of edits between the item and any part of the text (Myers' algorithm, one word of bits per row)."""
    mask, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    where: dict[str, int] = {}
    for k, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << k
    up, down, score = mask, 0, len(item)
    best = score
    for c in text:
        same = where.get(c, 0)
        vertical = same | down
        diagonal = (((same & up) + up) ^ up) | same
        rise, fall = down | ~(diagonal | up) & mask, up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
            best = min(best, score)
        rise, fall = rise << 1 & mask, fall << 1 & mask
        up, down = fall | ~(vertical | rise) & mask, rise & vertical
    return best


def _one_edit(piece: str, text: str) -> bool:
    """Whether the text starts with the piece but for at most one edit."""
    n = len(piece)
    if text.startswith(piece):
        return True
    k = 0
    while k < len(text) and k < n and piece[k] == text[k]:
        k += 1
    return piece[k + 1 :] == text[k + 1 : n] or piece[k:] == text[k + 1 : n + 1] or piece[k + 1 :] == text[k : n - 1]


class _Searcher:
    def __init__(self, items: list[tuple], s: Settings):
        self.items: list[tuple] = []  # (item_id, normalized text, budget)
        places: dict[str, list[tuple]] = {}
        for item_id, text in items:
            shown = normalized(text)
            if not shown:
                continue
            k = budget(len(shown), s)
            cuts = [j * len(shown) // (k + 1) for j in range(k + 2)]
            number = len(self.items)
            self.items.append((item_id, shown, k))
            for j in range(k + 1):
                mate = j ^ 1
                other = shown[cuts[mate] : cuts[mate + 1]] if k else ""
                # Read away from the piece: what follows it, or what precedes it backwards.
                places.setdefault(shown[cuts[j] : cuts[j + 1]], []).append((number, cuts[j], other if mate > j else other[::-1], mate > j))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()

    def search(self, text: str | None) -> list[tuple]:
        """(item_id, distance) of the items contained in the text within their budgets."""
        if not self.items:
            return []
        shown = normalized(text)
        best: dict[int, int] = {}
        tried: set[tuple[int, int]] = set()
        for end, (size, found) in self.automaton.iter(shown):
            start = end - size + 1
            for number, offset, mate, follows in found:
                item_id, item, k = self.items[number]
                if best.get(number) == 0:
                    continue
                reach = len(mate) + 1
                beside = shown[end + 1 : end + 1 + reach] if follows else shown[max(0, start - reach) : start][::-1]
                if k and not _one_edit(mate, beside):
                    continue
                begin = start - offset
                if (number, begin) in tried:
                    continue
                tried.add((number, begin))
                distance = best_distance(item, shown[max(0, begin - k) : begin + len(item) + k]) if k else 0
                if distance <= k:
                    best[number] = min(distance, best.get(number, distance))
        return sorted((self.items[number][0], distance) for number, distance in best.items())


_searchers: dict[str, _Searcher] = {}


def with_matches(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), text: str = "text", out: str = "matches") -> DataFrame:
    """Add `out`: array of (item_id, distance) of the benchmark items that the whole text contains.

    Items without letters or digits match nothing; null texts contain nothing. Items of one id are
    each searched. Other columns stay; a column named `out` is replaced. Rows never leave their partition.
    The items go to the tasks in blocks of at most `block_chars` characters (or one item),
    each block searched in all documents.
    """
    s = settings
    spark = docs.sparkSession
    narrow_batches(spark)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = total // s.block_chars + 1
    keep = [c for c in docs.columns if c != out]
    names = [f"c{k}" for k in range(len(keep))]
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.lit(None).cast("array<struct<item_id:string,distance:int>>").alias(out), F.col(f"`{text}`").alias("text"))
    shape = given.schema
    kind = pa.list_(pa.struct([("item_id", pa.string()), ("distance", pa.int32())]))
    for block in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        shared, fitted = spark.sparkContext.broadcast([tuple(r) for r in chosen.collect()]), uuid.uuid4().hex

        def search(batches: Iterator[pa.RecordBatch], shared=shared, fitted=fitted) -> Iterator[pa.RecordBatch]:
            if fitted not in _searchers:
                _searchers.clear()
                _searchers[fitted] = _Searcher(shared.value, s)
            find = _searchers[fitted].search
            for batch, texts in text_batches(batches):
                before = batch.column(len(names)).to_pylist()
                found = [(old or []) + [{"item_id": i, "distance": d} for i, d in find(t)] for old, t in zip(before, texts, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(found, kind), batch.columns[-1]], names=[*names, out, "text"])

        given = given.mapInArrow(search, shape)
    return given.drop("text").toDF(*keep, out)
