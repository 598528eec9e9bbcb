"""Byte-pair encoding through a minimal acyclic transducer.

Frequent words of the corpus are compiled, with their ids, into an automaton that shares prefixes and
suffixes. The sum of the outputs along a word's path is the word's rank among all, and the rank points to its
ids. The automaton is one file in the shared folder; each executor fetches it once and its workers map it into
memory. Words it lacks are merged exactly, so the choice of words changes the speed and never the result.

Nulls count as empty texts and have no ids. Equal rows give equal rows. An empty table gives an empty table.
Texts of any length are encoded whole. Columns named like an output are replaced.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisect.llm.bytebpe import PieceEncoder, Runs, blocks, gather, vocabulary
from trisect.llm.tables import kept_between_tasks, local_file, most_frequent, shared_file, stored, texts_of, with_columns

# Distinct pieces a counting task holds before it passes its counts on.
MOST_COUNTED = 200_000


class Transducer:
    """Lookup of many words at once in the compiled automaton."""

    HEAD = 6

    def __init__(self, raw: np.ndarray):
        head = raw[: 8 * self.HEAD].view(np.int64)
        arcs, nodes, words, ids = (int(x) for x in head[:4])
        at = 8 * self.HEAD
        self.parts = []
        for kind, size in (
            (np.int64, arcs), (np.int64, words + 1), (np.int32, arcs), (np.int32, arcs), (np.uint32, ids), (np.uint8, nodes)
        ):
            self.parts.append(raw[at : at + size * np.dtype(kind).itemsize].view(kind))
            at += size * np.dtype(kind).itemsize
        self.keys, self.offsets, self.target, self.output, self.ids, self.final = self.parts

    @classmethod
    def mapped(cls, path: str) -> Transducer:
        return cls(np.memmap(path, np.uint8, "r"))

    def find(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, -1 for words that are not compiled in. All words take a step at a time."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(length) - length
        node = np.zeros(len(words), np.int64)
        rank = np.zeros(len(words), np.int64)
        alive = np.flatnonzero(length > 0)
        rank[length == 0] = -1
        step = 0
        while len(alive):
            if not len(self.keys):
                rank[alive] = -1
                break
            key = node[alive] * 256 + flat[begin[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            rank[alive[~hit]] = -1
            alive, at = alive[hit], at[hit]
            node[alive] = self.target[at]
            rank[alive] += self.output[at]
            step += 1
            ended = length[alive] == step
            last = alive[ended]
            rank[last[self.final[node[last]] == 0]] = -1
            alive = alive[~ended]
        return rank


def compile_words(words: list[bytes], ids: Runs) -> bytes:
    """The automaton of sorted distinct words, node by node, equal suffixes shared, as one block of bytes."""
    nodes: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    known: dict[tuple, int] = {}
    reach: list[int] = []

    def freeze(node: list) -> int:
        """The number of the one node with this end mark and these arcs."""
        shape = (node[0], tuple(node[1]))
        if shape not in known:
            known[shape] = len(nodes)
            nodes.append(shape)
            reach.append(node[0] + sum(reach[t] for _, t in node[1]))
        return known[shape]

    # The path of the last word, each node [is a word's end, arcs to frozen nodes].
    path: list[list] = [[0, []]]
    last = b""
    for word in words:
        shared = next((i for i, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
        while len(path) - 1 > shared:
            done = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(done)))
        path.extend([0, []] for _ in word[shared:])
        path[-1][0] = 1
        last = word
    while len(path) > 1:
        done = path.pop()
        path[-1][1].append((last[len(path) - 1], freeze(done)))
    root = freeze(path[0])
    # The root gets number 0; the frozen nodes follow in the order made.
    number = lambda n: 0 if n == root else n + 1
    keys, target, output = [], [], []
    for n, (final, arcs) in enumerate(nodes):
        before = final
        for label, child in arcs:
            keys.append(number(n) * 256 + label)
            target.append(number(child))
            output.append(before)
            before += reach[child]
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    final = np.zeros(len(nodes) + 1, np.uint8)
    for n, (end, _) in enumerate(nodes):
        final[number(n)] = end
    flat, offsets = gather(ids, np.arange(len(words)))
    head = np.array([len(keys), len(final), len(words), len(flat), 0, 0], np.int64)
    parts = [
        head, np.array(keys, np.int64)[order], offsets.astype(np.int64), np.array(target, np.int32)[order],
        np.array(output, np.int32)[order], flat.astype(np.uint32), final,
    ]
    return b"".join(p.tobytes() for p in parts)


def word_counts(documents: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(word, n): how often each word, in the tokenizer's sense, occurs in all texts."""

    def count(batches):
        vocab = vocabulary(tokenizer)
        pieces: Counter[str] = Counter()

        def flush():
            words: Counter[bytes] = Counter()
            for piece, n in pieces.items():
                for word in vocab.split_piece(piece):
                    words[word] += n
            pieces.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for value in texts_of(batch, text):
                # A special string inside a text is counted in parts; that costs a lexicon entry at most.
                pieces.update(value.replace("\n", " ").split(" "))
                if len(pieces) > MOST_COUNTED:
                    yield flush()
        yield flush()

    return documents.select(text).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(
    documents: DataFrame, tokenizer: str, most_words: int = 50_000, min_count: int = 3, text: str = "text"
) -> str:
    """Compile the most frequent words into a shared file and return its name.

    At most ``most_words`` words, those of ``min_count`` occurrences or more: all words down to a level of
    frequency that keeps within the bound. The driver sees these words only.
    """
    counts = stored(word_counts(documents, tokenizer, text).where(F.col("n") >= min_count), "word-counts")
    chosen = most_frequent(counts, "n", most_words).select("word").toArrow().column(0).to_pylist()
    words = sorted(chosen)
    return shared_file(documents.sparkSession, compile_words(words, vocabulary(tokenizer).merge(words)), "lexicon")


@kept_between_tasks
@lru_cache(maxsize=2)
def _encoder(tokenizer: str, lexicon: str) -> PieceEncoder:
    vocab = vocabulary(tokenizer)
    automaton = Transducer.mapped(local_file(lexicon))

    def words_to_ids(words: list[bytes]) -> Runs:
        rank = automaton.find(words)
        unseen = np.flatnonzero(rank < 0)
        merged = vocab.merge([words[i] for i in unseen])
        start = automaton.offsets[np.maximum(rank, 0)] + len(merged.flat)
        length = automaton.offsets[np.minimum(rank + 1, len(automaton.offsets) - 1)] - automaton.offsets[np.maximum(rank, 0)]
        start[unseen], length[unseen] = merged.start, merged.length
        return Runs(np.concatenate([merged.flat, automaton.ids]), start, length)

    return PieceEncoder(vocab, words_to_ids)


def _encoded(encoder: PieceEncoder, texts: list[str]) -> list[bytes]:
    ids = []
    for run in blocks(texts):
        flat, at = encoder.encode(run)
        raw = flat.astype("<u4").tobytes()
        ids += [raw[4 * a : 4 * b] for a, b in zip(at[:-1], at[1:], strict=True)]
    return ids


def encode(documents: DataFrame, tokenizer: str, lexicon: str, text: str = "text") -> DataFrame:
    """Add ``token_ids``: the ids of each text as little-endian unsigned 32-bit integers."""

    def make():
        encoder = _encoder(tokenizer, lexicon)
        return lambda batch: [_encoded(encoder, texts_of(batch, text))]

    return with_columns(documents, "token_ids binary", make)


def decoded_text(raw: bytes, names: list[str]) -> str:
    """The token strings of the ids with a space between, as the vocabulary has no decoder."""
    return " ".join(map(names.__getitem__, np.frombuffer(raw, "<u4").tolist()))


def decode(encoded: DataFrame, tokenizer: str, ids: str = "token_ids") -> DataFrame:
    """Add ``decoded``: the text that the ids stand for."""

    def make():
        names = vocabulary(tokenizer).tokens
        return lambda batch: [[decoded_text(raw or b"", names) for raw in batch.column(ids).to_pylist()]]

    return with_columns(encoded, "decoded string", make)


def round_trip(documents: DataFrame, tokenizer: str, lexicon: str, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass, so that the ids go through one Python worker and not two."""

    def make():
        encoder, names = _encoder(tokenizer, lexicon), vocabulary(tokenizer).tokens

        def columns(batch):
            ids = _encoded(encoder, texts_of(batch, text))
            return [ids, [decoded_text(raw, names) for raw in ids]]

        return columns

    return with_columns(documents, "token_ids binary, decoded string", make)
