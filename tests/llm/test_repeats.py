"""Operator 11 against plain versions on small texts."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from llm_fixtures import scratch  # noqa: F401

from tideline.llm import repeats, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SIZE = repeats.WINDOW


def plain(rows):
    """doc_id, n_words, n_removed, kept_sha256 by looking every window up."""
    texts = [(d, WORD.findall(t or "")) for d, t in rows]
    least: dict = {}
    for d, words in texts:
        for k in range(len(words) - SIZE + 1 if d is not None else 0):
            window = tuple(words[k : k + SIZE])
            least[window] = min(d, least.get(window, d))
    out = []
    for d, words in texts:
        gone = [False] * len(words)
        for k in range(len(words) - SIZE + 1 if d is not None else 0):
            if least[tuple(words[k : k + SIZE])] < d:
                gone[k : k + SIZE] = [True] * SIZE
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((d, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def shuffled_passages(seed, n):
    """Documents put together from a few texts, cut anywhere, with words of their own in between, and runs of one word."""
    pick = random.Random(seed)
    base = [[f"w{pick.randrange(300)}" for _ in range(300)] for _ in range(5)]
    rows = []
    for k in range(n):
        words = []
        for _ in range(pick.randrange(6)):
            one, at = pick.choice(base), pick.randrange(250)
            words += one[at : at + pick.randrange(20, 130)] + [f"x{pick.randrange(10**6)}" for _ in range(pick.randrange(30))]
        words += ["a"] * pick.choice([0, 0, 49, 50, 90]) + ["b", "c"] * pick.choice([0, 0, 24, 60])
        text = " ".join(words)
        rows.append((pick.choice([k, k, k, k // 3, None]), text))
        if pick.random() < 0.2:
            rows += [(k + 50, text), (k, text.replace(" ", "\n")), (k, text)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_a_plain_version(spark, scratch, seed):
    rows = shuffled_passages(seed, 90)
    rows += [(1, None), (2, ""), (None, None), (3, " \n\t"), (-4, " ".join(["q"] * 60)), (2**62 + 5, " ".join(["q"] * 70)), (7, "\xa0".join(["q"] * 60))]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, anchor string, n_words int").repartition(6)
    found = substrings.without_repeats(docs, scratch)
    assert sorted((tuple(r)[:4] for r in found.collect()), key=str) == plain(rows)


def test_one_passage_in_many_documents_and_long_texts(spark, scratch):
    common = " ".join(f"c{k}" for k in range(60))
    rows = [(k, f"{' '.join(f'u{k}_{j}' for j in range(k % 40))} {common} {' '.join(f'v{k}_{j}' for j in range(30))}") for k in range(300)]
    rows += [(1000 + k, common) for k in range(100)]
    long = " ".join(f"l{k % 7919}" for k in range(60_000))  # repeats itself
    rows += [(2000, long), (2001, f"{long} end"), (2002, long)]
    found = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), scratch)
    got = sorted((tuple(r)[:4] for r in found.collect()), key=str)
    assert got == plain(rows)
    spans = {r["doc_id"]: r["spans"] for r in found.collect()}
    assert spans[0] == "" and spans[41] == "1:61" and spans[1099] == "0:60" and spans[2001] == "0:60000"


def test_no_documents(spark, scratch):
    assert substrings.without_repeats(spark.createDataFrame([], "doc_id long, text string"), scratch).count() == 0


def test_parse_finds_every_window():
    pick = random.Random(9)
    for trial in range(150):
        letters = pick.choice([2, 3, 1000])
        block = [str(pick.randrange(letters)) for _ in range(pick.randrange(40, 340))]
        text = []
        for _ in range(pick.randrange(1, 6)):
            at = pick.randrange(len(block))
            text += block[at : at + pick.randrange(10, 120)] + [str(pick.randrange(letters)) for _ in range(pick.randrange(5))]
        text = ["1"] * (trial % 3 * 70) + text
        inside = {tuple(block[k : k + SIZE]) for k in range(len(block) - SIZE + 1)}
        expected = [tuple(text[k : k + SIZE]) in inside for k in range(len(text) - SIZE + 1)]
        spans = repeats.Reference(block).repeats(text)
        assert repeats.window_starts(spans, len(text)).tolist() == expected
        assert all(b - a >= SIZE for a, b in spans)


def test_equal_windows_have_equal_anchors():
    pick = random.Random(10)
    codes = [np.array([pick.getrandbits(64) for _ in range(n)], np.uint64) for n in (0, 10, 49, 50, 200, 400)]
    codes[4][100:180] = codes[5][300:380]
    codes[5][:90] = codes[5][0]  # one word again and again
    sizes = np.array([len(c) for c in codes])
    found, place, first, counts = repeats.anchors(np.concatenate(codes), sizes)
    at = 0
    for code, count in zip(codes, counts, strict=True):
        seeds, expected = repeats.rolling(code, repeats.SEED), []
        for k in range(len(code) - SIZE + 1):
            p = k + int(seeds[k : k + SIZE - repeats.SEED + 1].argmin())
            if not expected or expected[-1][1] != p:
                expected.append((int(seeds[p]), p, k))
        assert list(zip(found[at : at + count].tolist(), place[at : at + count].tolist(), first[at : at + count].tolist(), strict=True)) == expected
        at += count
