"""Words, their rolling hashes and window anchors, and a relative Lempel-Ziv parse. Used inside tasks (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import xxhash

from tideline.llm.words import WordTable, split_words

WINDOW = 50  # words that make a repeat
SEED = 16  # words by which a factor is found; a window has WINDOW - SEED + 1 of them
_BEFORE = WINDOW - SEED

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BASE = np.uint64(0xA24BAED4963EE407)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def _table() -> WordTable:
    return WordTable("repeats", lambda words: [[xxhash.xxh3_64_intdigest(w)] for w in words], np.uint64)


def word_hashes(words: list[str]) -> np.ndarray:
    table = _table()
    return _mixed(table.gather(table.rows(words))[0])


def rolling(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` items, put together from runs of half the length."""
    if len(h) < size:
        return h[:0]
    out, done, power, step = None, 0, _BASE, 1  # h: hashes of runs of `step`; power: the base to it
    while True:
        if size & step:
            tail = h[done : len(h)] if out is not None else h
            out = tail if out is None else out[: len(tail)] * power + tail[: len(out)]
            done += step
        if step * 2 > size:
            break
        with np.errstate(over="ignore"):
            h, power, step = h[:-step] * power + h[step:], power * power, step * 2
    return _mixed(out[: len(out)])


def anchors(h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, number of anchors by text) over texts of `sizes` words, one after another.

    The anchor of a window is its seed of the least hash, the leftmost of equal ones, so that equal windows have
    equal anchors. The windows of one anchor are consecutive. Places count from the start of the text.
    """
    none = np.zeros(0, np.int64)
    if len(h) < WINDOW:
        return np.zeros(0, np.uint64), none, none, np.zeros(len(sizes), np.int64)
    seeds = rolling(h, SEED)
    least, where, step = seeds, np.arange(len(seeds)), 1
    span = _BEFORE + 1
    while step * 2 <= span:
        right = least[step:] < least[:-step]
        least, where, step = np.where(right, least[step:], least[:-step]), np.where(right, where[step:], where[:-step]), step * 2
    more = span - step
    right = least[more:] < least[: len(least) - more]
    where = np.where(right, where[more:], where[: len(where) - more])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes - WINDOW + 1, 0))
    counts = np.bincount(owner, minlength=len(sizes))
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + (ends - sizes)[owner]
    place = where[starts]
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])) if len(place) else none
    base = (ends - sizes)[owner[new]]
    return seeds[place[new]], place[new] - base, starts[new] - base, np.bincount(owner[new], minlength=len(sizes))


class Reference:
    """A block of text indexed by its seeds."""

    def __init__(self, words: list[str]):
        self.ids: dict[str, int] = {}
        self.coded = np.array([self.ids.setdefault(w, len(self.ids)) for w in words], np.int64)
        self.seeds: dict[int, list[int]] = {}
        for place, seed in enumerate(self.keys(self.coded)):
            self.seeds.setdefault(seed, []).append(place)

    @staticmethod
    def keys(coded: np.ndarray) -> list[int]:
        return rolling(_mixed(coded.astype(np.uint64) + _ODD), SEED).tolist()

    def code(self, words: list[str]) -> np.ndarray:
        """Numbers of the words; words that the block lacks get -1, which equals nothing in it."""
        get = self.ids.get
        return np.array([get(w, -1) for w in words], np.int64)

    def right(self, text: np.ndarray, i: int, j: int) -> int:
        """Words from text[i] and block[j] on that agree."""
        n = min(len(text) - i, len(self.coded) - j)
        differ = text[i : i + n] != self.coded[j : j + n]
        first = int(differ.argmax()) if n else 0
        return first if n and differ[first] else n

    def left(self, text: np.ndarray, i: int, j: int) -> int:
        """Words before text[i] and block[j] that agree."""
        n = min(i, j, WINDOW)
        differ = (text[i - n : i] != self.coded[j - n : j])[::-1]
        first = int(differ.argmax()) if n else 0
        return first if n and differ[first] else n

    def repeats(self, words: list[str]) -> list[tuple[int, int]]:
        """Runs of at least WINDOW words of the text that stand in the block: every such window lies in one of them.

        The greedy parse takes the longest factor at each word; words without a factor of a seed's length are literals. Factors that are long
        enough are repeats. A window that starts inside a factor and ends behind it holds the start of the next one,
        or the seed before that start. So at each end of a factor the places of these two seeds are extended to both sides.
        """
        text = self.code(words)
        keys = self.keys(text)
        find = self.seeds.get
        known = [k for k, key in enumerate(keys) if key in self.seeds]
        found: set[tuple[int, int]] = set()
        at = i = 0
        while at < len(known):
            i = known[at]
            length = max(self.right(text, i, j) for j in find(keys[i]))
            if length < SEED:  # seeds of equal hash and different words
                at += 1
                continue
            end = i + length
            if length >= WINDOW:
                found.add((i, end))
            if end < len(text):
                for seed in (end - SEED, end):
                    if 0 <= seed < len(keys):
                        for j in find(keys[seed], ()):
                            before, after = self.left(text, seed, j), self.right(text, seed, j)
                            if before + after >= WINDOW:
                                found.add((seed - before, seed + after))
            while at < len(known) and known[at] < end:
                at += 1
        return sorted(found)


def covered(spans: list[tuple[int, int]], size: int) -> np.ndarray:
    """Which of `size` places lie in one of the spans."""
    steps = np.zeros(size + 1, np.int64)
    for a, b in spans:
        steps[min(a, size)] += 1
        steps[min(b, size)] -= 1
    return np.cumsum(steps[:-1]) > 0


def window_starts(spans: list[tuple[int, int]], size: int) -> np.ndarray:
    """Which windows of a text of `size` words lie within one of the spans."""
    return covered([(a, b - WINDOW + 1) for a, b in spans if b - a >= WINDOW], max(size - WINDOW + 1, 0))


def pieces(places: np.ndarray, size: int) -> Iterator[tuple[int, int, int, int]]:
    """(first place, last place, from, to): stretches of words around rising anchor places, with all windows around each; overlapping ones are one."""
    begin = 0
    while begin < len(places):
        last = begin
        while last + 1 < len(places) and places[last + 1] - _BEFORE < places[last] + WINDOW:
            last += 1
        yield begin, last + 1, max(0, int(places[begin]) - _BEFORE), min(size, int(places[last]) + WINDOW)
        begin = last + 1


def words_of(text: str | None) -> list[str]:
    return split_words(text)
