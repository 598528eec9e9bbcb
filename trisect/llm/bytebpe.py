"""Exact byte-pair encoding of a word tokenizer, vectorised over distinct words.

The vocabulary file is read from a path the caller gives. A text is cut into white-space-free pieces;
a piece is cut into words by the tokenizer's own pattern; a word is merged once and remembered.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from functools import lru_cache
from itertools import count as from_zero
from itertools import islice
from typing import NamedTuple

import numpy as np
import regex

END = "</w>"
NO_MERGE = np.int32(2**31 - 1)
# Words longer than this are merged one by one with a heap, which is not quadratic.
LONG_WORD = 96
# Distinct pieces remembered by one task; beyond it only those met first stay, the frequent ones among them. Results are the same.
MOST_REMEMBERED = 250_000
KEPT = 160_000

# Pieces of these characters need no library call: composed, lower-cased one to one, no white space.
PLAIN = regex.compile(r"[\x21-\x7e¡-įı-ɏ]*")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in printable}
    for spare, b in enumerate(b for b in range(256) if b not in names):
        names[b] = chr(256 + spare)
    return [names[b] for b in range(256)]


class Runs(NamedTuple):
    """Several id lists inside one array."""

    flat: np.ndarray
    start: np.ndarray
    length: np.ndarray


def gather(runs: Runs, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen lists end to end, and where each begins (one more entry than chosen)."""
    length = runs.length[index]
    stops = np.concatenate([[0], np.cumsum(length)])
    at = np.arange(int(stops[-1])) - np.repeat(stops[:-1] - runs.start[index], length)
    return runs.flat[at], stops


class Vocabulary:
    """Merge table and token strings of a word BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {**{i: s for s, i in ids.items()}, **{i: s for s, i in self.special.items()}}
        self.size = max(names) + 1
        self.tokens = [names.get(i, "") for i in range(self.size)]
        symbols = byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        self.inner = np.array([ids[s] for s in symbols], np.int32)
        self.final = np.array([ids[s + END] for s in symbols], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.byte_rank = np.full((512, 512), NO_MERGE, np.int32)
        both = np.concatenate([self.inner, self.final])
        if both.max() >= 512:
            raise ValueError("the ids below 512 must be the bytes, inside and at the end of a word")
        pair = np.arange(512)
        self.byte_rank[:] = self.rank(np.repeat(pair, 512), np.tile(pair, 512)).reshape(512, 512)
        self.product = np.array([ids[a + b] for a, b in merges], np.int32)
        pattern = next(
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        self.words = regex.compile(pattern)
        # The library's own normalizer and splitter serve the rare characters, so that they agree to the letter.
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where((self.keys[at] == pair) & (left >= 0) & (right >= 0), self.ranks[at], NO_MERGE)

    def split_piece(self, piece: str) -> list[bytes]:
        """Words of a piece as UTF-8, after the tokenizer's normalisation."""
        if PLAIN.fullmatch(piece):
            # Words of letters, alone or before one mark, are the bulk; they need no pattern.
            if piece.isalpha():
                return [piece.lower().encode()]
            if piece[-1:] in (",", ".") and piece[:-1].isalpha():
                return [piece[:-1].lower().encode(), piece[-1].encode()]
            return [w.encode() for w in self.words.findall(piece.lower())]
        parts = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(piece))
        return [bytes(self.byte_of[s] for s in word) for word, _ in parts]

    def merge(self, words: list[bytes]) -> Runs:
        """Ids of each word: always the merge of lowest rank, the leftmost of equals, until none applies."""
        length = np.zeros(len(words), np.int64)
        start = np.zeros(len(words), np.int64)
        flats: list[np.ndarray] = []
        base = 0
        widths = np.fromiter(map(len, words), np.int64, len(words))
        for width in np.unique(widths[(widths > 0) & (widths <= LONG_WORD)]):
            chosen = np.flatnonzero(widths == width)
            for part in np.array_split(chosen, -(-len(chosen) // 50_000)):
                for rows, ids, count in self._merge_equal([words[i] for i in part], int(width)):
                    at = part[rows]
                    length[at] = count
                    start[at] = base + np.cumsum(count) - count
                    flats.append(ids[np.arange(ids.shape[1]) < count[:, None]])
                    base += len(flats[-1])
        for i in np.flatnonzero(widths > LONG_WORD):
            flats.append(self._merge_long(words[i]))
            length[i], start[i] = len(flats[-1]), base
            base += len(flats[-1])
        return Runs(np.concatenate([np.empty(0, np.int32), *flats]).astype(np.uint32), start, length)

    def _merge_equal(self, words: list[bytes], width: int):
        """Merge words of one length together; yields (row numbers, ids, number of ids) as rows finish."""
        raw = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), width)
        ids = self.inner[raw]
        ids[:, -1] = self.final[raw[:, -1]]
        rows = np.arange(len(words))
        if width == 1:
            yield rows, ids, np.ones(len(words), np.int64)
            return
        ranks = self.byte_rank[ids[:, :-1], ids[:, 1:]]
        count = np.full(len(words), width)
        columns = np.arange(width)
        while len(rows):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            over = best == NO_MERGE
            if over.any():
                yield rows[over], ids[over], count[over]
                keep = ~over
                rows, ids, ranks, count, at, best = (x[keep] for x in (rows, ids, ranks, count, at, best))
                if not len(rows):
                    break
            lines = np.arange(len(rows))
            ids[lines, at] = self.product[best]
            # Close the gap right of each merge.
            gap = columns[1:] > at[:, None]
            np.copyto(ids[:, 1:-1], ids[:, 2:].copy(), where=gap[:, :-1])
            ids[:, -1] = -1
            np.copyto(ranks[:, 1:-1], ranks[:, 2:].copy(), where=gap[:, : width - 3] if width > 3 else gap[:, :0])
            ranks[:, -1] = NO_MERGE
            count -= 1
            right = np.where(at + 1 < count, ids[lines, np.minimum(at + 1, width - 1)], -1)
            here = np.minimum(at, width - 2)
            ranks[lines, here] = np.where(at <= width - 2, self.rank(ids[lines, at], right), ranks[lines, here])
            left = np.maximum(at - 1, 0)
            ranks[lines, left] = np.where(at > 0, self.rank(ids[lines, left], ids[lines, at]), ranks[lines, left])

    def _merge_long(self, word: bytes) -> np.ndarray:
        ids = self.inner[np.frombuffer(word, np.uint8)]
        ids[-1] = self.final[word[-1]]
        ids = ids.tolist()
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))
        first = self.rank(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NO_MERGE]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}

        def rank_of(a: int, b: int) -> int:
            if (a, b) not in known:
                known[a, b] = int(self.rank(np.array([a]), np.array([b]))[0])
            return known[a, b]

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.product[rank]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (r := rank_of(ids[left], ids[right])) != NO_MERGE:
                    heapq.heappush(heap, (r, left, ids[left], ids[right]))
        return np.array([x for x in ids if x >= 0], np.int32)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def numbering() -> defaultdict:
    """Numbers keys in the order they are first asked for; its keys stand in that order."""
    return defaultdict(from_zero().__next__)


class PieceEncoder:
    """Encodes whole texts; remembers the ids of pieces. ``words_to_ids`` may look words up elsewhere first."""

    def __init__(self, vocab: Vocabulary, words_to_ids=None):
        self.vocab = vocab
        self.words_to_ids = words_to_ids or vocab.merge
        self._forget()

    def _forget(self):
        self.numbers, self.learned = numbering(), 0
        self.start, self.length = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _forget_late(self):
        """Forget all but the pieces that were met first."""
        self.numbers = defaultdict(from_zero(KEPT).__next__, zip(islice(self.numbers, KEPT), from_zero()))
        self.learned = KEPT
        self.start, self.length = self.start[:KEPT].copy(), self.length[:KEPT].copy()
        # Ids of pieces stand in the order the pieces were met.
        self.flat = self.flat[: int(self.length.sum())].copy()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text begins (one more entry than texts)."""
        if len(self.numbers) > MOST_REMEMBERED:
            self._forget_late()
        look, special = self.numbers.__getitem__, self.vocab.specials
        pieces: list[int] = []
        ends = []
        for text in texts:
            if "<|" in text and special.search(text):
                for part in special.split(text):
                    # Special strings are known by a key that no piece can have.
                    pieces.extend([look((part,))] if part in self.vocab.special else map(look, self._pieces(part)))
            else:
                pieces.extend(map(look, self._pieces(text)))
            ends.append(len(pieces))
        self._learn()
        index = np.array(pieces, np.int64)
        ids, stops = gather(Runs(self.flat, self.start, self.length), index)
        return ids, stops[np.concatenate([[0], np.array(ends, np.int64)])]

    @staticmethod
    def _pieces(text: str) -> list[str]:
        return text.replace("\n", " ").split(" ")

    def _learn(self):
        new = list(islice(self.numbers, self.learned, None))
        if not new:
            return
        self.learned = len(self.numbers)
        word_number = numbering()
        number, split, special = word_number.__getitem__, self.vocab.split_piece, self.vocab.special
        words: list[int] = []
        ends, marked = [], False
        for piece in new:
            if isinstance(piece, tuple):
                # A special string is a "word" of its own that bypasses the merges.
                words.append(number(piece))
                marked = True
            elif piece.isascii() and piece.isalpha():
                # What split_piece makes of most pieces, without the calls.
                words.append(number(piece.lower().encode()))
            elif piece.isascii() and piece[:-1].isalpha() and piece[-1] in ",.":
                words.append(number(piece[:-1].lower().encode()))
                words.append(number(piece[-1].encode()))
            else:
                words.extend(map(number, split(piece)))
            ends.append(len(words))
        found = list(word_number)
        marks = [i for i, w in enumerate(found) if isinstance(w, tuple)] if marked else []
        runs = self.words_to_ids([b"" if isinstance(w, tuple) else w for w in found] if marked else found)
        if marked:
            flat = np.concatenate([runs.flat, np.array([special[found[i][0]] for i in marks], np.uint32)])
            runs.start[marks], runs.length[marks] = len(runs.flat) + np.arange(len(marks)), 1
            runs = Runs(flat, runs.start, runs.length)
        index = np.array(words, np.int64)
        learned, stops = gather(runs, index)
        stops = stops[np.concatenate([[0], np.array(ends, np.int64)])]
        self.start = np.concatenate([self.start, len(self.flat) + stops[:-1]])
        self.length = np.concatenate([self.length, np.diff(stops)])
        self.flat = np.concatenate([self.flat, learned])


def blocks(texts: list[str], most_chars: int = 2_000_000):
    """Consecutive runs of texts of about that many characters; a longer text is alone."""
    run: list[str] = []
    size = 0
    for text in texts:
        if run and size + len(text) > most_chars:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run
