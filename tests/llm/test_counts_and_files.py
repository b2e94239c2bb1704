from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_fixtures import make, scratch  # noqa: F401  (fixtures)

from tideline.llm import bpe, mixing, prefix_tokens, token_files

VOCABULARY = path("word_bpe_49k.json")
TEXTS = [
    None, "", "   \n\t ", "Hello, World! don't I'll 'rex 'L 's's x'S", "naïve café Ålesund façade été", "été Å 각 가",
    "İstanbul Σας ﬁ ½ ² ٣", "a\x1cb\x85c\xa0d e", "<|endoftext|>a<|startoftext|> b<|endof", "中文没有空格 🙂👍🏽", "word " * 3000, "x" * 5000, "1234 5,6.7 !!!''s",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_every_prefix_count_is_the_librarys(library):
    for text in TEXTS:
        counts, sizes = prefix_tokens._prefix_arrays([text], VOCABULARY)
        assert len(counts) == len(text or "") == sizes[0]
        places = range(1, len(text or "") + 1)
        for k in places if len(places) < 200 else [*list(places)[::397], len(text)]:
            inside_special = "<|" in text[:k] and len(library(text[:k])) != counts[k - 1]
            parts_a_unit = text[k : k + 1] in ("́", "̊", "ᅡ")
            if not inside_special and not parts_a_unit:
                assert counts[k - 1] == len(library(text[:k])), (text[:k][-20:], k)


def test_pieces_without_merges_across_borders():
    counter = bpe.counter(VOCABULARY)
    table = counter.pieces(["thethethe", "aaaaaaaa", "zzxqj"])
    for piece in ("thethethe", "aaaaaaaa", "zzxqj"):
        assert table[piece] == [len(counter.tokenizer.encode(piece[:k], add_special_tokens=False).ids) for k in range(1, len(piece) + 1)]


def test_prefix_table_keeps_rows_and_columns(make, library):
    docs = make([(k, t) for k, t in enumerate(TEXTS)] + [(3, TEXTS[3])]).withColumn("prefix_tokens", F.lit("clash")).withColumn("c0", F.lit(1))
    counted = prefix_tokens.with_prefix_tokens(docs, VOCABULARY)
    n = prefix_tokens.tokens_of(F.col("prefix_tokens"))
    rows = counted.select("doc_id", "c0", n.alias("n"), prefix_tokens.tokens_of(F.col("prefix_tokens"), F.lit(7)).alias("seven"), prefix_tokens.truncate(F.col("text"), F.col("prefix_tokens"), 5).alias("cut")).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        text = TEXTS[r["doc_id"]] or ""
        assert r["n"] == len(library(text)) and r["c0"] == 1
        if r["doc_id"] in (3, 4, 10):
            assert r["seven"] == len(library(text[:7]))
            assert len(library(r["cut"])) <= 5 and r["cut"] == max((text[:k] for k in range(len(text[:200]) + 1) if len(library(text[:k])) <= 5), key=len)
    assert prefix_tokens.with_prefix_tokens(make([]), VOCABULARY).count() == 0


def test_token_files_round_trip(spark, make, scratch, library):
    rows = [(k * 7 % 13, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (5, "again"), (5, "again")]
    folder = f"{scratch}/tokens"
    token_files.write_token_files(make(rows).withColumn("ids", F.lit(1)), folder, VOCABULARY, 2, partitions=3)
    read = token_files.read_token_files(spark, folder).orderBy("start").collect()
    assert len(read) == len(rows)
    assert [r["doc_id"] for r in read] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    total = 0
    for r in read:
        assert r["start"] == total and len(r["ids"]) == r["n_tokens"] and r["ids"][-1] == 2
        total += r["n_tokens"]
    assert sorted(map(tuple, ([*library(t), 2] for _, t in rows))) == sorted(tuple(r["ids"]) for r in read)
    checks = {(r["start"]): r for r in token_files.read_checksums(spark, folder).collect()}
    for r in read:
        assert checks[r["start"]]["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(r['ids'])}I", *r["ids"])) & 0xFFFFFFFF
    empty = f"{scratch}/none"
    token_files.write_token_files(make([]), empty, VOCABULARY, 2)
    assert np.sum([1 for _ in spark.read.schema("doc_id long").orc(empty).collect()]) == 0


def _levels(sizes):
    """Targets by resharing again and again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {n: mixing.WEIGHTS[k % 3] for k, n in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        whole = sum(weight[n] for n in open_)
        full = [n for n in open_ if left * weight[n] / whole > 3 * sizes[n]]
        if not full:
            return target | {n: left * weight[n] / whole for n in open_}
        spent = sum(3.0 * sizes[n] for n in full)
        target |= {n: 3.0 * sizes[n] for n in full}
        left, open_ = left - spent, open_ - set(full)
    return target


def test_mix_meets_targets_and_repeats(spark, make, scratch):
    rows = [(k, "w " * (k % 17 + 1), "en", f"s{k % 5}" if k % 11 else None) for k in range(400)]
    rows += [(1000 + k, "one two three", "en", "rare") for k in range(2)] + [(None, None, "en", "s1"), (3, "", "en", "empty"), (7, "w w", "en", "s2"), (7, "w w", "en", "s2")]
    docs = make(rows).withColumn("size", F.lit("clash"))
    got = mixing.mix(docs, f"{scratch}/mix").collect()
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    wanted = _levels(sizes)
    for source in sizes:
        assert abs(target[source] - wanted[source]) < 1e-6 and abs(taken[source] - wanted[source]) <= 1
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["taken"])
    again = mixing.mix(docs.repartition(5), f"{scratch}/again").collect()
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(make([]), f"{scratch}/nothing").count() == 0
