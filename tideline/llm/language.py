"""Language of a text (operator 2): per-language piece probabilities over a fixed public vocabulary.

The probability of a word is the sum over all its segmentations into pieces, found by the
forward algorithm. Piece probabilities come from expectation maximisation over the same sums.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.folds import held_out
from tideline.llm.words import WordTable, narrow_batches, split_words, sums, text_batches

UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_MARK = "▁"  # the vocabulary's sign for the start of a word


@dataclass(frozen=True)
class Settings:
    docs_per_language: int = 2_000  # training documents of a language, in the mean
    passes: int = 3  # of expectation maximisation
    smoothing: float = 0.05  # added to the count of every piece
    unknown: float = 1e-7  # probability of a letter outside the vocabulary, in every language


class Lattice:
    """Pieces of words: which vocabulary piece spans which letters."""

    def __init__(self, path: str, longest: int | None = None):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(k) for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
        self.vocab = {p: k for k, p in enumerate(p for p in names if p == p.lower() and (longest is None or len(p) <= longest))}
        self.size = len(self.vocab)  # the number of the unknown letter
        self.longest = max(map(len, self.vocab))
        self._grow()

    def _grow(self) -> None:
        """The prefix tree of the pieces as sorted keys (node, letter) with the node each leads to, and the piece each node ends."""
        letters = sorted({ord(c) for piece in self.vocab for c in piece})
        self.letters, place = np.array(letters, np.uint32), {c: k for k, c in enumerate(letters)}
        nodes: dict[tuple[int, int], int] = {}
        ends = [-1]
        for piece, number in self.vocab.items():
            node = 0
            for c in piece:
                step = (node, place[ord(c)])
                node = nodes.get(step, -1)
                if node < 0:
                    node = nodes[step] = len(ends)
                    ends.append(-1)
            ends[node] = number
        keys = np.array([node * len(letters) + c for node, c in nodes], np.int64)
        order = np.argsort(keys)
        self.keys, self.child, self.ends = keys[order], np.array(list(nodes.values()), np.int64)[order], np.array(ends, np.int64)

    def edges(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """(word, from, to, piece) by rising `to`, and the lengths of the words with their mark."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        codes = np.frombuffer((_MARK + _MARK.join(words)).encode("utf-32-le", "surrogatepass"), np.uint32) if words else np.zeros(0, np.uint32)
        known = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        letter = np.where(self.letters[known] == codes, known, -1)
        stop = np.cumsum(lengths)
        word = np.repeat(np.arange(len(words)), lengths)
        start = (stop - lengths)[word]
        # All places walk down the tree side by side, one letter at a time, until none has a way on.
        at, node, found = np.arange(len(codes)), np.zeros(len(codes), np.int64), []
        for size in range(1, self.longest + 1):
            inside = at + size <= stop[word[at]]
            at, node = at[inside], node[inside]
            c = letter[at + size - 1]
            key = node * len(self.letters) + c
            way = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = (self.keys[way] == key) & (c >= 0)
            at, node = at[on], self.child[way[on]]
            piece = self.ends[node]
            whole = piece >= 0
            found.append((at[whole], np.full(int(whole.sum()), size), piece[whole]))
            if size == 1:  # a letter that is no piece can stand alone as unknown
                alone = np.ones(len(codes), bool)
                alone[at[whole]] = False
                found.append((np.flatnonzero(alone), np.ones(int(alone.sum()), np.int64), np.full(int(alone.sum()), self.size)))
            if not len(at):
                break
        place, size, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        which, first = word[place], place - start[place]
        order = np.argsort(first + size, kind="stable")
        return which[order], first[order], (first + size)[order], piece[order], lengths


@lru_cache(maxsize=2)
def _lattice(path: str, longest: int | None = None) -> Lattice:
    return Lattice(path, longest)


def _sweep(which: np.ndarray, first: np.ndarray, after: np.ndarray, p: np.ndarray, lengths: np.ndarray, longest: int, scales: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all paths from the start of a word to each place, edges by rising `after`; and the log of what its end is divided by.

    So that long words don't vanish, every `block` letters the places that further edges can start from
    are divided by the last one. `scales` takes up the log of what each place is divided by.
    """
    block = 15
    offsets = np.cumsum(lengths + 1) - lengths - 1
    reached = np.zeros((int((lengths + 1).sum()), p.shape[1]))
    reached[offsets] = 1.0
    logs = np.zeros((len(lengths), p.shape[1]))
    source, target = offsets[which] + first, offsets[which] + after
    bounds = np.searchsorted(after, np.arange(1, (lengths.max() if len(lengths) else 0) + 2))
    for j in range(1, len(bounds)):
        a, b = bounds[j - 1], bounds[j]
        np.add.at(reached, target[a:b], reached[source[a:b]] * p[a:b])
        if scales is not None and j > block:
            scales[target[a:b]] = logs[which[a:b]]
        if j % block == 0:
            long = np.flatnonzero(lengths > j)
            if len(long):
                near = offsets[long][:, None] + np.arange(max(0, j - longest + 1), j + 1)
                last = reached[offsets[long] + j]
                reached[near] /= last[:, None, :]
                logs[long] += np.log(last)
                if scales is not None:
                    scales[near] += np.log(last)[:, None, :]
    return reached, logs


def log_probabilities(words: list[str], lattice: Lattice, table: np.ndarray) -> np.ndarray:
    """Log probability of each word (row) in each language (column of `table`, by piece)."""
    which, first, after, piece, lengths = lattice.edges(words)
    reached, logs = _sweep(which, first, after, table[piece], lengths, lattice.longest)
    return logs + np.log(reached[np.cumsum(lengths + 1) - 1])


def _expected(words: list[str], weights: np.ndarray, column: np.ndarray, lattice: Lattice, table: np.ndarray) -> np.ndarray:
    """Expected numbers of each piece (row) by language, each word segmented in the language `column`."""
    which, first, after, piece, lengths = lattice.edges(words)
    ends = np.cumsum(lengths + 1) - 1
    offsets = ends - lengths
    p = table[piece, column[which]]

    def logs(order: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        scales = np.zeros((int((lengths + 1).sum()), 1))
        reached, _ = _sweep(which[order], start[order], stop[order], p[order, None], lengths, lattice.longest, scales)
        return (np.log(reached) + scales)[:, 0]

    forward = logs(np.arange(len(which)), first, after)
    size = lengths[which]  # backward is forward in the mirrored word
    backward = logs(np.argsort(size - first, kind="stable"), size - after, size - first)
    share = np.exp(forward[offsets[which] + first] + np.log(p) + backward[ends[which] - after] - forward[ends][which]) * weights[which]
    flat = np.bincount(piece * table.shape[1] + column[which], weights=share, minlength=table.size)
    return flat.reshape(table.shape)


def _parts(words: list[str], letters: int = 40_000) -> Iterator[slice]:
    """Slices of the words that hold about so many letters."""
    start = size = 0
    for k, word in enumerate(words):
        size += len(word)
        if size >= letters or k + 1 == len(words):
            yield slice(start, k + 1)
            start, size = k + 1, 0


@dataclass(frozen=True)
class Model:
    languages: list[str]
    priors: np.ndarray  # log
    table: np.ndarray  # probability of piece (row; the last is the unknown letter) by language


def train(docs: DataFrame, vocabulary: str, scratch: str, settings: Settings = Settings()) -> Model:
    """Learn from text and lang of documents outside the held-out fold.

    About `docs_per_language` documents of each language are taken, by a hash of doc_id;
    their word counts are written to `scratch`, a folder on shared storage, and read once a pass.
    The model has as many numbers as pieces times languages.
    """
    s = settings
    narrow_batches(docs.sparkSession)
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, 0)))
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, s.docs_per_language / sizes[name]))])[F.col("lang")]
    place = F.pmod(F.xxhash64(F.lit(2), "doc_id", F.length("text")), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.where(place < share).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            found: dict[tuple[str, str], int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                for word in _LETTERS.findall(text.lower()):
                    found[lang, word] = found.get((lang, word), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())], names=["lang", "word", "n"])

    sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).write.parquet(scratch)
    words = docs.sparkSession.read.parquet(scratch)
    size = _lattice(vocabulary).size
    table = np.full((size + 1, len(languages)), 1.0 / size)
    for _ in range(s.passes):
        table[-1] = s.unknown
        current = docs.sparkSession.sparkContext.broadcast(table)

        def expect(batches: Iterator[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            lattice, p = _lattice(vocabulary), current.value
            total = np.zeros_like(p)
            for batch in batches:
                column = np.array([languages.index(x) for x in batch.column(0).to_pylist()], np.int64)
                found, often = batch.column(1).to_pylist(), batch.column(2).to_numpy().astype(float)
                for part in _parts(found):
                    total += _expected(found[part], often[part], column[part], lattice, p)
            piece, column = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(column, pa.int32()), pa.array(total[piece, column])], names=["piece", "lang", "n"])

        found = words.mapInArrow(expect, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros_like(table)
        counts[found.column("piece").to_numpy(), found.column("lang").to_numpy()] = found.column("n").to_numpy()
        counts = counts[:size] + s.smoothing
        table = np.vstack([counts / counts.sum(axis=0), np.full((1, len(languages)), s.unknown)])
    priors = np.log(np.array([sizes[name] for name in languages], float) / sum(sizes.values()))
    return Model(languages, priors, table)


def _rows(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the rows one after another, and how many a row has."""
    rows = np.concatenate(parts)
    return rows.ravel(), np.full(len(rows), rows.shape[1])


class _Scorer:
    """Log probabilities of raw words (the sum over their runs of letters) and whether they have letters."""

    def __init__(self, vocabulary: str, table: np.ndarray):
        lattice = _lattice(vocabulary)
        self.width = table.shape[1]
        self.runs = WordTable("language", lambda runs: _rows([log_probabilities(runs[part], lattice, table) for part in _parts(runs)]), np.float64, 200_000, 2_000_000)
        self.words = WordTable("language", self._measure, np.float64, 200_000, 2_000_000)

    def forget(self) -> None:
        self.runs.clear()
        self.words.clear()

    def _measure(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        runs = [_LETTERS.findall(w.lower()) for w in words]
        counts = np.fromiter(map(len, runs), np.int64, len(runs))
        values, _ = self.runs.gather(self.runs.rows([r for one in runs for r in one]))
        found = sums(values.reshape(-1, self.width), counts)
        return _rows([np.column_stack([found, counts])])

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        words = [split_words(t) for t in texts]
        values, _ = self.words.gather(self.words.rows([w for one in words for w in one]))
        found = sums(values.reshape(-1, self.width + 1), np.fromiter(map(len, words), np.int64, len(words)))
        return found[:, :-1], found[:, -1] > 0.5


_scorers: dict[str, _Scorer] = {}


def _scorer(fitted: str, vocabulary: str, model: Model) -> _Scorer:
    """The scorer of a fitted model; a worker holds that of one model, from task to task."""
    if fitted not in _scorers:
        for old in _scorers.values():
            old.forget()
        _scorers.clear()
        _scorers[fitted] = _Scorer(vocabulary, model.table)
    return _scorers[fitted]


def with_language(docs: DataFrame, model: Model, vocabulary: str, text: str = "text") -> DataFrame:
    """Add lang_pred, the likeliest learned language (ties: first by name), and score, its posterior probability.

    Null texts and texts without a letter get `und` and 0, as all do where no language was learned.
    Other columns stay; columns of these names are replaced. Rows never leave their partition.
    """
    spark = docs.sparkSession
    narrow_batches(spark)
    shared, fitted = spark.sparkContext.broadcast(model), uuid.uuid4().hex
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    names = [f"c{k}" for k in range(len(keep))]
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch, texts in text_batches(batches):
            best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if model.languages:
                # By a function of the module: what this one refers to itself travels with each task as a copy.
                found, lettered = _scorer(fitted, vocabulary, model).score(texts)
                found = found + model.priors
                top = found.argmax(axis=1)
                score = np.where(lettered, 1 / np.exp(found - found.max(axis=1, keepdims=True)).sum(axis=1), 0.0)
                best = [model.languages[k] if yes else UNKNOWN for k, yes in zip(top.tolist(), lettered.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(best, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

    shape = ", ".join([*(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, keep, strict=True)), "lang_pred string", "score double"])
    return given.mapInArrow(predict, shape).toDF(*keep, "lang_pred", "score")
