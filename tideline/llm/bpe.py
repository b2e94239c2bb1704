"""Byte-pair prefix tables: the exact token count of every prefix of a word.

The encoding of a prefix is the encoding of a shorter prefix plus one last token, and
a row of tokens is an encoding exactly where every two neighbours are (no merge goes
across their border). So one pass from left to right finds the last token and the
count at each place. Two passes run side by side: one for a prefix that goes on
within the word, one for a prefix that ends it and so carries the word's end mark.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

# White space of the vocabulary's normalizer: it parts words and yields no token.
SPACES = "\t-\r \x85\xa0  -     　"
CHUNK = re.compile(f"[^{SPACES}]+[{SPACES}]*|[{SPACES}]+")
_ALL_SPACES = "".join(re.findall(f"[{SPACES}]", "".join(map(chr, range(0x3001)))))
_END = "</w>"
_NEVER = 1 << 30
_SHORT = (2, 1)
# Letters that normalize one by one: ASCII and Latin letters without the dotted capital I.
_LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-įı-ɏ"
PLAIN = re.compile(rf"[!-~{_LETTER}]*$")
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")  # fixed values of the vocabulary
_PIECE = re.compile("|".join(_CONTRACTIONS) + rf"|[{_LETTER}]+|[0-9]|[^{_LETTER}0-9]+")


# Text of plain characters only, and its pieces in lower case: no piece goes across white space.
PLAIN_TEXT = re.compile(rf"[{SPACES}!-~{_LETTER}]*\Z")
_TEXT_PIECE = re.compile("|".join(_CONTRACTIONS) + rf"|[{_LETTER}]+|[0-9]|[^{_LETTER}0-9{SPACES}]+")


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = {b: chr(b) for b in shown}, 0x100
    for b in range(256):
        if b not in out:
            out[b] = chr(spare)
            spare += 1
    return out


_LETTERS = _byte_letters()
_LETTER_BYTES = {c: "".join(_LETTERS[b] for b in chr(c).encode()) for c in range(0x80, 0x3000)}  # lower-case forms lie beyond the letters themselves


def plain_pieces(word: str) -> list[str]:
    """Pieces of a word of plain characters, in lower case."""
    return _PIECE.findall(word.lower())


def text_pieces(text: str) -> list[str]:
    """Pieces of a text of plain characters, in lower case."""
    return _TEXT_PIECE.findall(text.lower())


def byte_texts(joined: str) -> str:
    """Pieces of plain characters, joined by blanks, as they stand in the vocabulary."""
    return joined if joined.isascii() else joined.translate(_LETTER_BYTES)


def byte_text(text: str) -> str:
    return text if text.isascii() else "".join(map(_LETTERS.__getitem__, text.encode()))


def _lengths(tokens: set[str]) -> dict[str, tuple[int, ...]]:
    """By their last three characters: lengths of the tokens that may end so, longest first."""
    found: dict[str, set[int]] = {}
    for t in tokens:
        if len(t) > 2:
            found.setdefault(t[-3:], set()).add(len(t))
    return {ending: (*sorted(lengths, reverse=True), *_SHORT) for ending, lengths in found.items()}


class PrefixCounter:
    """Prefix counts under a vocabulary of byte-level merges with an end-of-word mark."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {pair: k for k, pair in enumerate(pairs)}
        vocab = spec["model"]["vocab"]
        specials = [t["content"] for t in spec["added_tokens"]]
        self.inner = {t for t in vocab if not t.endswith(_END) and t not in specials}
        self.final = {t[: -len(_END)] for t in vocab if t.endswith(_END)}
        self.inner_lengths, self.final_lengths = _lengths(self.inner), _lengths(self.final)
        self.special = re.compile("|".join(sorted(map(re.escape, specials), key=len, reverse=True))) if specials else None
        self.edges: dict[str, tuple | None] = {}
        # Worked out so far: counts of pieces, and which two tokens can be neighbours.
        self.done: dict[str, list[int]] = {}
        self.apart: dict[tuple[str, str], bool] = {}
        self.whole: set[str] = set()

    def forget(self) -> None:
        """Drop what was worked out so far."""
        self.done.clear()
        self.apart.clear()

    def _grown(self, symbols: list[str]) -> tuple | None:
        """(left edge, right edge) of the merge tree of `symbols`, None if they don't merge to one.

        An edge lists the symbols that stand at that end in turn, each with the rank
        of the merge that takes it in.
        """
        nodes = [(s, ((s, _NEVER),), ((s, _NEVER),)) for s in symbols]
        while len(nodes) > 1:
            ranks = [self.rank.get((a[0], b[0]), _NEVER) for a, b in zip(nodes, nodes[1:], strict=False)]
            best = min(ranks)
            if best == _NEVER:
                return None
            merged, k = [], 0
            while k < len(nodes):
                if k + 1 < len(nodes) and ranks[k] == best and self.rank.get((nodes[k][0], nodes[k + 1][0])) == best:
                    a, b = nodes[k], nodes[k + 1]
                    name = a[0] + b[0]
                    left = (*a[1][:-1], (a[0], best), (name, _NEVER))
                    right = (*b[2][:-1], (b[0], best), (name, _NEVER))
                    merged.append((name, left, right))
                    k += 2
                else:
                    merged.append(nodes[k])
                    k += 1
            nodes = merged
        return nodes[0][1], nodes[0][2]

    def _edges(self, token: str) -> tuple | None:
        found = self.edges.get(token, 0)
        if found == 0:
            ended = token.endswith(_END)
            symbols = list(token.removesuffix(_END) if ended else token)
            if ended:
                symbols[-1] += _END
            found = self.edges[token] = self._grown(symbols)
            if found:
                self.whole.add(token)
        return found

    def _stay_apart(self, left: str, right: str) -> bool:
        """Whether no merge goes across the border of two neighbouring tokens."""
        a, b = self._edges(left)[1], self._edges(right)[0]
        rank = self.rank.get
        i = j = 0
        (x, until_x), (y, until_y) = a[0], b[0]
        while True:
            across = rank((x, y))
            # Equal ranks merge from the left: inside `left` first, then across, then inside `right`.
            if across is not None and across < until_x and across <= until_y:
                return False
            if until_x <= until_y:
                if until_x == _NEVER:
                    return True
                i += 1
                x, until_x = a[i]
            else:
                j += 1
                y, until_y = b[j]

    def pieces(self, words: Iterable[str]) -> dict[str, list[int]]:
        """For each byte-level piece: count for the prefix of each length, as if the word ended there.

        Pieces are taken in sorted order, so that neighbours share the pass over their common start.
        """
        if len(self.done) > 700_000:
            self.done.clear()
        if len(self.apart) > 2_000_000:
            self.apart.clear()
        done, apart, whole = self.done, self.apart, self.whole
        routes = ((self.inner, self.inner_lengths, ""), (self.final, self.final_lengths, _END))
        before, last, count, ended = "", [None], [0], [0]
        for piece in sorted({w for w in words if w not in done}):
            k, most = 0, min(len(before), len(piece))
            while k < most and before[k] == piece[k]:
                k += 1
            del last[k + 1 :], count[k + 1 :], ended[k + 1 :]
            for i in range(k + 1, len(piece) + 1):
                for vocab, lengths, mark in routes:
                    for m in lengths.get(piece[i - 3 : i] if i > 2 else "", _SHORT):
                        if m > i:
                            continue
                        part = piece[i - m : i]
                        if part not in vocab:
                            continue
                        token = part + mark
                        if m == i:
                            fits = token in whole or self._edges(token) is not None
                        else:
                            pair = (last[i - m], token)
                            fits = apart.get(pair)
                            if fits is None:
                                fits = apart[pair] = self._edges(token) is not None and self._stay_apart(*pair)
                        if fits:
                            break
                    else:
                        raise ValueError(f"no encoding of {piece[:i]!r}")
                    if mark:
                        ended.append(count[i - m] + 1)
                    else:
                        last.append(token)
                        count.append(count[i - m] + 1)
            done[piece] = ended[1:]
            before = piece
        return done

    def chunks(self, chunks: list[str]) -> list[list[int]]:
        """For each chunk (a word and the spaces after it): token count of each prefix, by code point.

        Code points that normalize together (a letter and its marks) and the text of a
        special token are one unit: each of their places holds the count after the unit.
        """
        parts: list[list[str] | None] = []
        wanted: set[str] = {"'", *"stmdrvl"}
        for chunk in chunks:
            word = chunk.rstrip(_ALL_SPACES)
            if PLAIN.match(word) and "<|" not in word:
                found = plain_pieces(word)
                wanted.update(found if word.isascii() else map(byte_text, found))
                parts.append(found)
            else:
                parts.append(None)
        table = self.pieces(wanted)
        out = []
        for chunk, pieces in zip(chunks, parts, strict=True):
            if pieces is None:
                counts = self._odd(chunk.rstrip(_ALL_SPACES)).tolist()
            elif len(pieces) == 1:
                counts = [*self._counts(pieces[0], table)]
            else:
                counts, base = [], 0
                for piece in pieces:
                    counts += [base + n for n in self._counts(piece, table)]
                    base = counts[-1]
            missing = len(chunk) - len(counts)
            if missing:
                counts += [counts[-1] if counts else 0] * missing
            out.append(counts)
        return out

    def _counts(self, piece: str, table: dict[str, list[int]]) -> list[int]:
        """Counts by code point within one piece of plain characters."""
        if piece.isascii() and piece[0] != "'":
            return table[piece]
        mapped = byte_text(piece)
        found = table[mapped]
        if piece in _CONTRACTIONS:  # a shorter prefix of it is an apostrophe and a letter
            return [table["'"][-1]] + [table["'"][-1] + table[piece[1]][-1]] * (len(piece) - 2) + [found[-1]]
        if len(mapped) == len(piece):
            return found
        counts, end = [], -1
        for c in piece:
            end += 1 if c < "\x80" else len(c.encode())
            counts.append(found[end])
        return counts

    def _odd(self, word: str) -> np.ndarray:
        """A word with special tokens or characters that may normalize together."""
        counts = np.zeros(len(word), np.int32)
        base = at = 0
        for found in [*(self.special.finditer(word) if self.special else []), None]:
            stop = found.start() if found else len(word)
            base = self._normalized(word, at, stop, base, counts)
            if found:
                base += 1
                counts[found.start() : found.end()] = base
                at = found.end()
        return counts

    def _normalized(self, word: str, start: int, stop: int, base: int, counts: np.ndarray) -> int:
        units: list[str] = []
        for c in word[start:stop]:
            if units and (unicodedata.combining(c) or unicodedata.normalize("NFC", units[-1] + c) != unicodedata.normalize("NFC", units[-1]) + unicodedata.normalize("NFC", c)):
                units[-1] += c
            else:
                units.append(c)
        shown = [self.tokenizer.normalizer.normalize_str(u) for u in units]
        whole = self.tokenizer.normalizer.normalize_str(word[start:stop])
        if "".join(shown) != whole:  # one unit
            units, shown = [word[start:stop]], [whole]
        pieces = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(whole)] if whole else []
        table = self.pieces(pieces + ["'", *"stmdrvl"])
        plain = {byte_text(c): c for c in _CONTRACTIONS}
        by_byte: list[int] = []  # count after each byte of the normalized text
        for piece in pieces:
            found = self._counts(plain[piece], table) if piece in plain else table[piece]
            by_byte += [base + n for n in found]
            base = by_byte[-1]
        if len(by_byte) != len(whole.encode()):  # the tokenizer left something out: one unit
            counts[start:stop] = base
            return base
        at = start
        done = 0
        for unit, text in zip(units, shown, strict=True):
            done += len(text.encode())
            counts[at : at + len(unit)] = by_byte[done - 1] if done else 0
            at += len(unit)
        return base


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)
