"""Language-model scores by logistic context mixing over hashed contexts.

A text is lower-cased (A-Z only) and read as bytes. Bytes are coded as bits by a prefix code made from the corpus, so
that frequent bytes take few bits. Each bit is predicted by several predictors: counts of zeros and ones, hashed by
the last one to four bytes, and by the whole beginning of the current piece (the bytes since the last blank). Every context
of the training texts is counted, those seen once too. A slot keeps the counts of its most frequent context, with its check,
and those of all its other contexts added up; what the latter say has weights of its own. The
predictions are mixed in the logistic domain with weights that are gated by how much evidence a predictor and the
longest context have; the weights are learned online, bit by bit in small steps, each piece predicted without its own count.

Contexts do not reach across blanks, so a piece has one mixed probability and is computed once per task. Across pieces the
score is refined adaptively within the text: several experts, the mixed prediction and one for each of a few kinds of
documents that were found in the training texts, are weighed online by how well they did so far, and so is a share of the
text's own earlier pieces. It starts anew in every text; scoring learns nothing from the texts it scores.

Counts of pieces and words come from all training texts. Tables have a fixed number of slots, which bounds what is broadcast;
words too rare for the broadcast part are joined.

A null text is empty: it is one end mark. Equal rows get equal results, each its own row. An empty table gives an empty table;
without training texts all counts are 0. Long texts are scored whole. Other columns are not read.
"""

from __future__ import annotations

import heapq
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisect.llm.bytebpe import blocks
from trisect.llm.tables import fresh_worker, kept_between_tasks, most_frequent, stored, text_or_empty
from trisect.llm.weighted_minhash import GOLDEN, mixed, uniforms

# Predictors: how many bytes back they see; the last sees the piece from its beginning.
ORDERS = (1, 2, 3, 4, 0)
SLOT_BITS = (18, 20, 21, 22, 22)
EVIDENCE = 8
# Evidence from the slot's most frequent context, and from its others.
CLASSES = 2 * EVIDENCE
END = 0xFF  # never a byte of UTF-8
BLOCK_BITS = 13
MOST_COUNTED = 250_000
# (Context, byte) pairs whose bits are placed at once.
MOST_KEYS = 200_000
MOST_REMEMBERED = 200_000
# Stretched predictions of 16-bit counts are within this.
RANGE = 15.36
# The least weight of an expert.
FLOOR = 0.005

FIRST_SLOT = np.concatenate([[0], np.cumsum([1 << b for b in SLOT_BITS])])
SLOTS = int(FIRST_SLOT[-1])


def pieces_of(text: bytes) -> list[bytes]:
    """The pieces of a lower-cased text, each with the blank or the end mark that follows it."""
    parts = text.split(b" ")
    last = parts.pop()
    return [p + b" " for p in parts] + [last + b"\xff"]


class Code:
    """A prefix code for bytes: bits and tree nodes of each byte, padded to the longest code."""

    def __init__(self, counts: np.ndarray):
        heap = [(int(c) + 1, i, i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        parts: dict[int, tuple[int, int]] = {}
        number = 256
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            parts[number] = (a[2], b[2])
            heapq.heappush(heap, (a[0] + b[0], number, number))
            number += 1
        paths: dict[int, list[tuple[int, int]]] = {number - 1: []}
        for node in range(number - 1, 255, -1):
            for bit, child in enumerate(parts[node]):
                paths[child] = [*paths[node], (node, bit)]
        self.length = np.array([len(paths[i]) for i in range(256)], np.int64)
        self.nodes = np.zeros((256, self.length.max()), np.uint64)
        self.bits = np.zeros((256, self.length.max()), np.uint8)
        for i in range(256):
            for k, (node, bit) in enumerate(paths[i]):
                self.nodes[i, k], self.bits[i, k] = node, bit

    def bits_of(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each bit of bytes end to end: the byte's place, the node and the bit."""
        length = self.length[raw]
        byte = np.repeat(np.arange(len(raw)), length)
        step = np.arange(len(byte)) - np.repeat(np.cumsum(length) - length, length)
        return byte, self.nodes[raw[byte], step], self.bits[raw[byte], step]


def contexts_of(raw: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Per predictor a hash of what it sees before each byte of pieces that stand end to end; the low eight bits are 0."""
    at = np.arange(len(raw))
    inside = at - np.repeat(np.cumsum(size) - size, size)
    wide = raw.astype(np.uint64)
    hashes = []
    seen = np.zeros(len(raw), np.uint64)
    for back in range(1, max(ORDERS) + 1):
        byte = np.where(inside >= back, wide[np.maximum(at - back, 0)] + np.uint64(1), np.uint64(0))
        seen = seen * np.uint64(257) + byte
        hashes.append(seen)
    hashes = [hashes[order - 1] for order in ORDERS[:-1]] + [_beginnings(wide, inside, size)]
    return [mixed(h, k) & ~np.uint64(255) for k, h in enumerate(hashes)]


def place_of(context: np.ndarray, node: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot and check of a predictor's context at a node of the code."""
    # The context is mixed already; a multiplication spreads the node over it.
    key = (context ^ (node * np.uint64(GOLDEN))) * np.uint64(0xD6E8FEB86659FD93)
    return (
        (key >> np.uint64(64 - SLOT_BITS[k])).astype(np.int64) + FIRST_SLOT[k], (key >> np.uint64(24)).astype(np.uint8)
    )


class Bits:
    """The bits of many pieces: which piece, the bit, and per predictor the slot and the check."""

    def __init__(self, pieces: list[bytes], code: Code):
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        byte, node, self.bit = code.bits_of(raw)
        self.piece = np.repeat(np.arange(len(pieces)), size)[byte]
        places = [place_of(h[byte], node, k) for k, h in enumerate(contexts_of(raw, size))]
        self.slot, self.check = (np.stack(x) for x in zip(*places, strict=True))


def _beginnings(wide: np.ndarray, inside: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of the bytes of the piece before each byte: sums of mixed (place, byte) pairs, from the piece's start."""
    marks = mixed(wide + inside.astype(np.uint64) * np.uint64(256), 3)
    total = np.cumsum(marks, dtype=np.uint64)
    first = np.repeat(np.cumsum(size) - size, size)
    before = total - marks
    return before - before[first]


def piece_counts(texts: DataFrame) -> DataFrame:
    """(piece, n) over all texts."""

    def count(batches):
        fresh_worker()
        counts: Counter[bytes] = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["piece", "n"]
            )
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(pieces_of(text.encode("utf-8", "surrogatepass").lower()))
                if len(counts) > MOST_COUNTED:
                    yield flush()
        yield flush()

    return texts.select("text").mapInArrow(count, "piece binary, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def word_counts(pieces: DataFrame) -> DataFrame:
    """(word, c): words are runs of bytes that are not ASCII white space."""

    def split(batches):
        fresh_worker()
        for batch in batches:
            counts: Counter[bytes] = Counter()
            for piece, n in zip(batch.column("piece").to_pylist(), batch.column("n").to_pylist(), strict=True):
                for word in piece.rstrip(b"\xff").split():
                    counts[word] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"]
            )

    return pieces.mapInArrow(split, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def byte_counts(pieces: DataFrame) -> np.ndarray:
    def count(batches):
        fresh_worker()
        total = np.zeros(256, np.int64)
        for batch in batches:
            values, n = batch.column("piece").to_pylist(), batch.column("n").to_numpy()
            raw = np.frombuffer(b"".join(values), np.uint8)
            total += np.bincount(raw, np.repeat(n, [len(v) for v in values]), 256).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], names=["byte", "n"])

    total = np.zeros(256, np.int64)
    for row in pieces.mapInArrow(count, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        total[row["byte"]] = row["n"]
    return total


def _short(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(values.max())).tobytes()


def _long(short: bytes, n: int) -> np.ndarray:
    return np.frombuffer(short, f"<u{len(short) // n}").astype(np.int64)


def _scaled(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts in 16 bits; large ones keep their ratio."""
    scale = np.maximum(np.maximum(zeros, ones) / 60_000, 1.0)
    return np.ceil(zeros / scale), np.ceil(ones / scale)


def context_counts(pieces: DataFrame, code: Code) -> np.ndarray:
    """The table of ``counted_blocks`` as one array."""
    return counted_blocks(pieces, code)[0].opened()


def counted_blocks(pieces: DataFrame, code: Code) -> tuple[Blocks, Blocks]:
    """Per slot the check and the counts of its most frequent context, and the counts of all its others: a table of rows
    (check, zeros, ones, zeros of the others, ones of the others). With it, what the slots predict.

    A task sends what it counted block by block, each context's place once with its counts. Blocks are packed where they are
    made, and the driver passes them on as they are.
    """

    def count(batches):
        fresh_worker()
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in ORDERS]

        def fold(k):
            """Sum the counts of a predictor's (context, byte) pairs; one number holds both."""
            key, n = (np.concatenate(x) for x in zip(*held[k], strict=True))
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            held[k] = [(key[first], np.add.reduceat(n, first))]
            return len(first)

        def emitted(k):
            """What a predictor has counted, in slices: bits and their places take many times the room of their keys."""
            keys, n = held[k].pop()
            context = keys & ~np.uint64(255)
            # A context's bytes are neighbours, and stay in one slice.
            begins = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            cuts = np.unique(begins[np.searchsorted(begins, np.arange(0, len(keys), MOST_KEYS), side="right") - 1])
            del context, begins
            for a, b in zip(cuts, np.append(cuts[1:], len(keys)), strict=True):
                yield sent_as(k, keys[a:b], n[a:b])

        def sent_as(k, key, n):
            context = key & ~np.uint64(255)
            byte, node, bit = code.bits_of((key & np.uint64(255)).astype(np.uint8))
            slot, check = place_of(context[byte], node, k)
            place = slot * 256 + check
            order = np.argsort(place, kind="stable")
            place, bit, n = place[order], bit[order], n[byte][order]
            first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            zeros, ones = (np.add.reduceat(np.where(bit == b, n, 0), first) for b in (0, 1))
            place = place[first]
            block = place >> (BLOCK_BITS + 8)
            starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            spans = list(zip(starts, np.append(starts[1:], len(block)), strict=True))
            inside = (place & ((1 << (BLOCK_BITS + 8)) - 1)).astype("<u4")
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(block[starts]), pa.array([inside[a:b].tobytes() for a, b in spans], pa.binary()),
                    *(pa.array([_short(v[a:b]) for a, b in spans], pa.binary()) for v in (zeros, ones)),
                ],
                names=["block", "places", "zeros", "ones"],
            )

        added = 0
        for batch in batches:
            values, n = batch.column("piece").to_pylist(), batch.column("n").to_numpy()
            raw = np.frombuffer(b"".join(values), np.uint8)
            size = np.fromiter(map(len, values), np.int64, len(values))
            weight = np.repeat(n, size)
            for k, context in enumerate(contexts_of(raw, size)):
                held[k].append((context | raw, weight))
            added += len(raw)
            if added > 1_000_000:
                added = 0
                for k in range(len(ORDERS)):
                    if fold(k) > 1_500_000:
                        yield from emitted(k)
        for k in range(len(ORDERS)):
            if held[k]:
                fold(k)
                yield from emitted(k)

    # Pieces in order: those with a common beginning are counted in one task, and few contexts meet only in the shuffle.
    ordered = pieces.repartitionByRange("piece").sortWithinPartitions("piece")
    counts = ordered.mapInArrow(count, "block long, places binary, zeros binary, ones binary")

    def packed(key, sent):
        places = [np.frombuffer(b, "<u4") for b in sent.column("places").to_pylist()]
        place, which = np.unique(np.concatenate(places), return_inverse=True)
        zeros, ones = (
            np.bincount(which, np.concatenate([_long(b, len(p)) for b, p in zip(sent.column(c).to_pylist(), places, strict=True)]))
            for c in ("zeros", "ones")
        )
        slot = place >> 8
        # The last of each slot is its most frequent context.
        order = np.lexsort((zeros + ones, slot))
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        best = order[np.append(first[1:], len(slot)) - 1]
        out = np.zeros((1 << BLOCK_BITS, 5), np.uint16)
        out[slot[best], 0] = place[best] & 255
        others = [np.add.reduceat(v, first) - v[best] for v in (zeros, ones)]
        out[slot[best], 1:] = np.stack([*_scaled(zeros[best], ones[best]), *_scaled(*others)], axis=1)
        return pa.table(
            {
                "block": [key[0].as_py()],
                **{c: pa.array([packed_planes(x)], pa.binary()) for c, x in (("rows", out), ("predicted", Predictions(out).packed))},
            }
        )

    # A block has 2 ** 13 slots, and the number of blocks is fixed.
    made = stored(counts.groupBy("block").applyInArrow(packed, "block long, rows binary, predicted binary"), "context-blocks")
    empty = np.zeros((1, 5), np.uint16)
    table, predicted = Blocks(empty), Blocks(Predictions(empty).packed)
    for row in made.toLocalIterator():
        table.blocks[row["block"]], predicted.blocks[row["block"]] = bytes(row["rows"]), bytes(row["predicted"])
    return table, predicted


def packed_planes(array: np.ndarray) -> bytes:
    """An array compressed; most slots hold small numbers, many none, and the bytes of equal weight stand together, which packs them better."""
    return zlib.compress(np.ascontiguousarray(array.reshape(len(array), -1).view(np.uint8).T), 1)


class Blocks:
    """A table of all slots that stays packed, block by block, until a broadcast brings it to a worker; it is an array there, read-only.

    ``empty`` is a slot of which nothing is known.
    """

    def __init__(self, empty: np.ndarray):
        self.empty, self.blocks = empty, {}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.array = self.opened()
        self.array.flags.writeable = False
        self.blocks = {}

    def opened(self) -> np.ndarray:
        table = np.empty((SLOTS, *self.empty.shape[1:]), self.empty.dtype)
        table[:] = self.empty
        flat = table.view(np.uint8).reshape(SLOTS, -1)
        for block, packed in self.blocks.items():
            part = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(flat.shape[1], -1)
            flat[block << BLOCK_BITS : (block + 1) << BLOCK_BITS] = part.T
        return table


class Shipped:
    """An array of counts or codes that is small while it is shipped: every executor keeps a file of what is broadcast.

    Most slots hold small numbers, many none; the bytes of equal weight stand together, which packs them better. Arrays come back read-only.
    """

    def __init__(self, array: np.ndarray):
        self.array = array

    def __getstate__(self):
        planes = np.ascontiguousarray(self.array).reshape(len(self.array), -1).view(np.uint8).T
        return self.array.shape, self.array.dtype.str, [zlib.compress(np.ascontiguousarray(plane), 1) for plane in planes]

    def __setstate__(self, state):
        shape, kind, planes = state
        flat = np.empty((shape[0], len(planes)), np.uint8)
        for i, plane in enumerate(planes):
            flat[:, i] = np.frombuffer(zlib.decompress(plane), np.uint8)
        self.array = flat.view(kind).reshape(shape)
        self.array.flags.writeable = False


def others_of(table: np.ndarray) -> np.ndarray:
    """Zeros and ones of a slot's other contexts; a table may do without them."""
    return table[:, 3:] if table.shape[1] > 3 else np.zeros((len(table), 2), np.uint16)


def stretched(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(0.05)) / (zeros + np.float32(0.05)))


def evidence_of(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(zeros + ones + np.float32(1)).astype(np.uint8), EVIDENCE - 1)


class Predictions:
    """What each slot predicts, ready for scoring."""

    def __init__(self, table: np.ndarray):
        # One number holds all of a slot, so that a lookup is one access: check, prediction and evidence, those of the others.
        self.packed = table[:, 0].astype(np.uint32) & 255
        for counts, levels, shift in ((table[:, 1:3], 512, 8), (others_of(table), 128, 21)):
            zeros, ones = counts[:, 0].astype(np.float32), counts[:, 1].astype(np.float32)
            x = np.rint(stretched(zeros, ones) * (levels / RANGE)).astype(np.int32) + levels
            self.packed |= (x.astype(np.uint32) | evidence_of(zeros, ones).astype(np.uint32) * np.uint32(2 * levels)) << np.uint32(shift)

    @classmethod
    def made(cls, packed: np.ndarray) -> Predictions:
        predictions = cls.__new__(cls)
        predictions.packed = packed
        return predictions

    def __getstate__(self):
        return Shipped(self.packed)

    def __setstate__(self, shipped):
        self.packed = shipped.array

    def of(self, slot: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prediction and evidence class of a context, or of all contexts but the slot's most frequent one."""
        found = self.packed[slot]
        own = (found & np.uint32(255)) == check
        x = np.where(own, (found >> 8) & np.uint32(1023), ((found >> 21) & np.uint32(255)) << 2).astype(np.float32)
        return (x - 512) * np.float32(RANGE / 512), np.where(own, (found >> 18) & np.uint32(7), (found >> 29) + np.uint32(EVIDENCE))


class Mixer:
    """Static probabilities of pieces: predictors, gates and weights. ``table`` holds counts or what they predict."""

    def __init__(self, table: np.ndarray | Predictions, code: Code, weights: np.ndarray | None = None):
        self.table, self.code = table, code
        self.others = others_of(table) if isinstance(table, np.ndarray) else None
        self.weights = np.full((len(ORDERS), CLASSES, CLASSES), 0.3) if weights is None else weights

    def inputs(self, bits: Bits) -> tuple[np.ndarray, np.ndarray]:
        """Stretched predictions and evidence classes [predictors, bits]."""
        return self.table.of(bits.slot, bits.check)

    def inputs_without_own(self, bits: Bits) -> tuple[np.ndarray, np.ndarray]:
        """The same from counts, with each bit's own occurrence taken out."""
        known = self.table[bits.slot, 0] == bits.check
        zeros, ones = (
            np.maximum(
                np.where(known, self.table[bits.slot, 1 + b], self.others[bits.slot, b]).astype(np.float32) - (bits.bit == b), 0
            )
            for b in (0, 1)
        )
        return stretched(zeros, ones), evidence_of(zeros, ones) + np.where(known, 0, EVIDENCE)

    def gates(self, evidence: np.ndarray) -> np.ndarray:
        """Which weight each predictor uses for a bit: by its own evidence and that of the longest context."""
        k = np.arange(len(ORDERS))[:, None]
        return (k * CLASSES + evidence) * CLASSES + evidence[-1].astype(np.int64)

    def log_probabilities(self, pieces: list[bytes]) -> np.ndarray:
        """Natural logarithms of the static probabilities."""
        out = np.empty(len(pieces))
        for a in range(0, len(pieces), 5000):
            bits = Bits(pieces[a : a + 5000], self.code)
            x, evidence = self.inputs(bits)
            logit = (self.weights.ravel()[self.gates(evidence)] * x).sum(axis=0)
            cost = np.logaddexp(0, np.where(bits.bit, -logit, logit))
            out[a : a + 5000] = -np.bincount(bits.piece, cost, len(pieces[a : a + 5000]))
        return out

    def learn(self, pieces: list[bytes], n: np.ndarray) -> float:
        """One online pass of small steps; returns the weight of what was seen."""
        w = self.weights.reshape(-1)
        for a in range(0, len(pieces), 500):
            bits = Bits(pieces[a : a + 500], self.code)
            x, evidence = self.inputs_without_own(bits)
            gate = self.gates(evidence)
            p = 1 / (1 + np.exp(-np.clip((w[gate] * x).sum(axis=0), -30, 30)))
            weight = n[a : a + 500][bits.piece].astype(float)
            pull = weight * (p - bits.bit)
            grad = np.bincount(gate.ravel(), (pull * x).ravel(), len(w))
            bend = np.bincount(gate.ravel(), (weight * np.maximum(p * (1 - p), 0.01) * x * x).ravel(), len(w))
            w -= 0.1 * np.clip(grad / (bend + 50.0), -1, 1)
        return float(n.sum())


def learned_weights(pieces: DataFrame, table, code: Code) -> np.ndarray:
    """Weights learned online in each task over its pieces in random order, averaged by what each task saw."""

    def learn(batches):
        fresh_worker()
        mixer = Mixer(table.value.array, code)
        seen = 0.0
        for batch in batches:
            seen += mixer.learn(batch.column("piece").to_pylist(), batch.column("n").to_numpy())
        flat = mixer.weights.ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat))), pa.array(flat * seen), pa.array(np.full(len(flat), seen))], names=["at", "w", "seen"]
        )

    shuffled = pieces.repartition(F.xxhash64("piece")).sortWithinPartitions(F.xxhash64("piece", F.lit(1)), "piece")
    rows = shuffled.mapInArrow(learn, "at long, w double, seen double").groupBy("at").agg(
        F.sum("w").alias("w"), F.sum("seen").alias("seen")
    ).collect()
    weights = Mixer(np.empty((0, 3)), code).weights.ravel()
    for row in rows:
        if row["seen"] > 0:
            weights[row["at"]] = row["w"] / row["seen"]
    return weights.reshape(len(ORDERS), CLASSES, CLASSES)


def adapted(log_p: np.ndarray, piece: np.ndarray, document: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Log probabilities of pieces in their texts; documents stand end to end, ``log_p`` is [pieces, experts].

    Experts are weighed by the product of what they gave the earlier pieces, with a floor for each. The outcome is mixed
    with the text's own earlier pieces.
    """
    # Experts are rows from here on; sums within a document are exact enough in double precision, weights in single.
    given = np.ascontiguousarray(log_p.T)
    before = np.cumsum(given, axis=1, dtype=np.float64) - given
    before -= before[:, start][:, document]
    before -= before.max(axis=0)
    weight = np.exp(np.maximum(before, -80).astype(np.float32))
    weight /= weight.sum(axis=0)
    weight = weight * np.float32(1 - FLOOR * len(given)) + np.float32(FLOOR)
    top = given.max(axis=0)
    static = top + np.log((weight * np.exp(np.maximum(given - top, -80).astype(np.float32))).sum(axis=0).astype(np.float64))
    at = np.arange(len(piece)) - start[document]
    order = np.argsort(document * (int(piece.max()) + 1) + piece, kind="stable")
    same = (piece[order][1:] == piece[order][:-1]) & (document[order][1:] == document[order][:-1])
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    count = np.empty(len(piece), np.int64)
    count[order] = np.arange(len(piece)) - np.repeat(first, np.diff(np.append(first, len(piece))))
    own = count / np.maximum(at, 1)
    # What share of the credit the text's own pieces would have had at odds of one in eight.
    credit = 0.125 * own / (0.125 * own + 0.875 * np.exp(np.maximum(static, -700)) + 1e-300)
    summed = np.cumsum(credit)
    earlier = summed - credit
    earlier -= earlier[start[document]]
    share = np.where(at == 0, 0.0, (earlier + 0.25) / (at + 8.0))
    return np.logaddexp(np.log1p(-share) + static, np.log(np.maximum(share * own, 1e-320)))


class Kinds:
    """Kinds of documents: per kind the probabilities of frequent pieces, and the share of all others."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray):
        self.numbers = {p: i for i, p in enumerate(pieces)}
        self.log_p = log_p

    def of(self, index: np.ndarray, count: np.ndarray) -> int:
        """The kind that makes the frequent pieces of a document likeliest."""
        return int((self.log_p[:, index] @ count).argmax()) if len(index) else 0


def find_kinds(training: DataFrame, pieces: list[bytes], kinds: int, rounds: int = 25) -> Kinds:
    """A mixture of piece frequencies, fitted by expectation maximisation to all texts: one pass a round, sums per task.

    Shares are whole numbers of millionths, so that their sums are the same on any partitioning.
    """
    log_p = np.full((kinds, max(len(pieces), 1)), -np.log(max(len(pieces), 1)))
    if not pieces:
        return Kinds(pieces, log_p)
    context = training.sparkSession.sparkContext
    shared = context.broadcast({p: i for i, p in enumerate(pieces)})

    def number(batches):
        fresh_worker()
        numbers = shared.value
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                all_pieces = Counter(pieces_of(text.encode("utf-8", "surrogatepass").lower()))
                found.append(sorted((numbers[p], n) for p, n in all_pieces.items() if p in numbers))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("hash"), pa.array([[i for i, _ in f] for f in found], pa.list_(pa.int32())),
                    pa.array([[n for _, n in f] for f in found], pa.list_(pa.int64())),
                ],
                names=["hash", "at", "n"],
            )

    hashed = training.select(F.xxhash64("text").alias("hash"), "text")
    numbered = stored(hashed.mapInArrow(number, "hash long, at array<int>, n array<long>").where(F.size("at") > 0), "numbered")
    prior = None
    for _ in range(rounds):
        state = context.broadcast((log_p, prior))

        def add(batches, state=state):
            log_p, prior = state.value
            sums, members = np.zeros((kinds, len(pieces)), np.int64), np.zeros(kinds, np.int64)
            for batch in batches:
                if not batch.num_rows:
                    continue
                at, n = (batch.column(c).flatten().to_numpy() for c in ("at", "n"))
                row = np.repeat(np.arange(batch.num_rows), batch.column("at").value_lengths().to_numpy())
                if prior is None:
                    # Each text begins with shares of its own, which its hash decides.
                    key = batch.column("hash").to_numpy().view(np.uint64)
                    belongs = np.stack([-np.log(uniforms(key, 20 + z)[0]) for z in range(kinds)])
                else:
                    fit = np.stack([np.bincount(row, n * log_p[z, at], batch.num_rows) for z in range(kinds)]) + prior[:, None]
                    belongs = np.exp(fit - fit.max(axis=0))
                share = np.rint(1e6 * belongs / belongs.sum(axis=0)).astype(np.int64)
                members += share.sum(axis=1)
                for z in range(kinds):
                    np.add.at(sums[z], at, n * share[z, row])
            kind, at = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([kind, np.arange(kinds)])), pa.array(np.concatenate([at, np.full(kinds, -1)])),
                    pa.array(np.concatenate([sums[kind, at], members])),
                ],
                names=["kind", "at", "n"],
            )

        found = numbered.mapInArrow(add, "kind long, at long, n long").groupBy("kind", "at").agg(F.sum("n").alias("n")).toArrow()
        kind, at, n = (found.column(c).to_numpy() for c in ("kind", "at", "n"))
        share, members = np.full(log_p.shape, 0.05), np.zeros(kinds)
        share[kind[at >= 0], at[at >= 0]] += n[at >= 0] / 1e6
        members[kind[at < 0]] = n[at < 0]
        log_p = np.log(share / share.sum(axis=1, keepdims=True))
        prior = np.log(members / max(members.sum(), 1) + 1e-6)
        state.destroy()
    return Kinds(pieces, log_p)


def kind_counts(training: DataFrame, kinds: Kinds, head: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Per kind how often each head piece occurs in all training documents of the kind, and how many other pieces."""
    shared = training.sparkSession.sparkContext.broadcast((kinds, head))
    z = kinds.log_p.shape[0]

    def count(batches):
        fresh_worker()
        kinds, head = shared.value
        counts, others = np.zeros((z, len(head)), np.int64), np.zeros(z, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                pieces = Counter(pieces_of(text.encode("utf-8", "surrogatepass").lower()))
                known = [(kinds.numbers[p], n) for p, n in pieces.items() if p in kinds.numbers]
                kind = kinds.of(np.array([i for i, _ in known], int), np.array([n for _, n in known], float))
                found = [(head[p], n) for p, n in pieces.items() if p in head]
                np.add.at(counts[kind], [i for i, _ in found], [n for _, n in found])
                others[kind] += sum(pieces.values()) - sum(n for _, n in found)
        kind, at = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([kind, np.arange(z)])), pa.array(np.concatenate([at, np.full(z, -1)])),
                pa.array(np.concatenate([counts[kind, at], others])),
            ],
            names=["kind", "at", "n"],
        )

    rows = training.select("text").mapInArrow(count, "kind long, at long, n long").groupBy("kind", "at").agg(F.sum("n").alias("n"))
    table = rows.toArrow()
    kind, at, n = (table.column(c).to_numpy() for c in ("kind", "at", "n"))
    counts, others = np.zeros((z, len(head))), np.zeros(z)
    frequent = at >= 0
    counts[kind[frequent], at[frequent]] = n[frequent]
    others[kind[~frequent]] = n[~frequent]
    return counts, others


class Experts:
    """Log probabilities of pieces: the mixed prediction, and per kind the head's frequencies with the mixed one for the rest."""

    def __init__(self, mixer: Mixer, head: dict[bytes, int], counts: np.ndarray, others: np.ndarray):
        self.mixer, self.head = mixer, head
        total = counts.sum(axis=1)
        everywhere = (counts.sum(axis=0) + 1) / (counts.sum() + counts.shape[1]) if counts.shape[1] else counts.sum(axis=0)
        # Half a per cent is lent by all kinds together, so that a piece that is new in a kind is not impossible.
        inside = 0.995 * counts / np.maximum(total, 1)[:, None] + np.where(total > 0, 0.005, 1.0)[:, None] * everywhere
        self.head_share = (total + 1) / (total + others + 2)
        if not counts.shape[1]:
            self.head_share[:] = 0
        self.log_head = np.log(np.maximum(inside * self.head_share[:, None], 1e-300))
        # What the mixed prediction gives to pieces outside of the head.
        self.outside = 0.0

    def measure_outside(self) -> None:
        mass = sum(
            np.exp(self.mixer.log_probabilities(part)).sum() for part in np.array_split(np.array(list(self.head), object), 20)
            if len(part)
        )
        self.outside = float(np.log(max(1 - mass, 0.02)))

    def log_probabilities(self, pieces: list[bytes]) -> np.ndarray:
        mixed_p = self.mixer.log_probabilities(pieces)
        at = np.array([self.head.get(p, -1) for p in pieces], np.int64)
        rest = mixed_p[:, None] - self.outside + np.log(np.maximum(1 - self.head_share, 1e-9))
        kinds = np.where((at >= 0)[:, None], self.log_head[:, at].T, rest) if len(self.head) else rest
        return np.concatenate([mixed_p[:, None], kinds], axis=1)


class _Numbers(dict):
    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, piece):
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Scorer:
    """Scores texts; remembers pieces: their static log probability, and what the base score needs of their words."""

    def __init__(self, experts: Experts, words: dict[bytes, int]):
        self.experts, self.known_words = experts, words
        self._forget()

    def _forget(self):
        self.numbers = _Numbers()
        self.log_p = np.empty((0, 1 + len(self.experts.head_share)), np.float32)
        self.words = np.empty((0, 3))
        self.rare: dict[int, list[bytes]] = {}

    def _learn(self):
        new, self.numbers.new = self.numbers.new, []
        if not new:
            return
        facts = np.zeros((len(new), 3))
        for i, piece in enumerate(new):
            begin = len(self.log_p) + i
            for word in piece.rstrip(b"\xff").split():
                facts[i, 0] += 1
                c = self.known_words.get(word)
                if c is None:
                    self.rare.setdefault(begin, []).append(word)
                else:
                    facts[i, 1] += 1
                    facts[i, 2] += np.log10(c + 1)
        self.log_p = np.concatenate([self.log_p, self.experts.log_probabilities(new).astype(np.float32)])
        self.words = np.concatenate([self.words, facts])

    def score(self, texts: list[str]):
        """Per text: log10 probability, words, words of the head, their sum of log10(c + 1), and the other words."""
        if len(self.numbers) > MOST_REMEMBERED:
            self._forget()
        look = self.numbers.__getitem__
        piece: list[int] = []
        ends = []
        for text in texts:
            piece.extend(map(look, pieces_of(text.encode("utf-8", "surrogatepass").lower())))
            ends.append(len(piece))
        self._learn()
        index, stops = np.array(piece, np.int64), np.array([0, *ends], np.int64)
        document = np.repeat(np.arange(len(texts)), np.diff(stops))
        log_p = adapted(self.log_p[index], index, document, stops[:-1])
        score = np.add.reduceat(log_p, stops[:-1]) / np.log(10)
        facts_of = self.words[index]
        facts = np.add.reduceat(facts_of, stops[:-1], axis=0)
        places = np.flatnonzero(facts_of[:, 0] > facts_of[:, 1])
        rare: list[dict[bytes, int]] = [{} for _ in texts]
        for d, i in zip(document[places].tolist(), index[places].tolist(), strict=True):
            mine = rare[d]
            for word in self.rare[i]:
                mine[word] = mine.get(word, 0) + 1
        return score, facts, [[{"word": w, "n": n} for w, n in mine.items()] for mine in rare]


class _Scorers(dict):
    """The scorer of the latest run."""

    cache_clear = dict.clear


_KEPT: dict[str, Scorer] = kept_between_tasks(_Scorers())


def kept_scorer(run_id: str, make) -> Scorer:
    """This worker's scorer for a run; what it remembers of pieces serves the worker's later tasks too."""
    if run_id not in _KEPT:
        fresh_worker()
        _KEPT[run_id] = make()
    return _KEPT[run_id]


def score(
    documents: DataFrame, held_out: Column, text: str = "text", head_words: int = 150_000, head_pieces: int = 60_000,
    kinds: int = 5, kind_pieces: int = 4000,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Everything is learned from the documents where ``held_out`` is false, the kinds of documents from all of them.
    """
    spark = documents.sparkSession
    kind = dict(documents.dtypes)["doc_id"]
    table = documents.select("doc_id", held_out.alias("held_out"), text_or_empty(text).alias("text"))
    training = table.where("NOT held_out")
    pieces = stored(piece_counts(training), "pieces")
    words = stored(word_counts(pieces), "words")
    n_training = training.count()
    totals = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = totals[0] + n_training, totals[1] + (n_training > 0)
    code = Code(byte_counts(pieces))
    counted, predicted = counted_blocks(pieces, code)
    counts = spark.sparkContext.broadcast(counted)
    weights = learned_weights(pieces, counts, code)
    counts.destroy()
    # The destroyed broadcast still holds its value here.
    del counts, counted
    predictions = spark.sparkContext.broadcast(predicted)
    by_count = lambda t, c: t.sort_by([(c, "descending"), (t.column_names[0], "ascending")])
    top = by_count(most_frequent(pieces, "n", head_pieces).toArrow(), "n").column("piece").to_pylist()
    head = {p: i for i, p in enumerate(top)}
    found = find_kinds(training, top[:kind_pieces], kinds)
    piece_kinds = kind_counts(training, found, head)
    experts = Experts(Mixer(Predictions.made(predicted.opened()), code, weights), head, *piece_kinds)
    experts.measure_outside()
    outside = experts.outside
    del experts
    frequent = most_frequent(words, "c", head_words).toArrow()
    shared = spark.sparkContext.broadcast(
        (head, piece_kinds, dict(zip(frequent.column("word").to_pylist(), frequent.column("c").to_pylist(), strict=True)))
    )

    run_id = uuid.uuid4().hex

    def run(batches):
        def make():
            head, piece_kinds, known_words = shared.value
            experts = Experts(Mixer(Predictions.made(predictions.value.array), code, weights), head, *piece_kinds)
            experts.outside = outside
            return Scorer(experts, known_words)

        scorer = kept_scorer(run_id, make)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            at = 0
            for texts in blocks(batch.column("text").to_pylist(), 600_000):
                part = batch.slice(at, len(texts))
                at += len(texts)
                scores, facts, rare = scorer.score(texts)
                size = np.array([len(t.encode("utf-8", "surrogatepass")) for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(texts))), part.column("doc_id"), part.column("held_out"),
                        pa.array(facts[:, 0].astype(np.int64)), pa.array(facts[:, 1].astype(np.int64)), pa.array(facts[:, 2]),
                        pa.array(scores), pa.array(-scores / np.log10(2) / np.maximum(size, 1)),
                        pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
                    ],
                    names=["row", "doc_id", "held_out", "n_words", "n_head", "head_sum", "score", "bits_per_byte", "rare"],
                )
                row += len(texts)

    schema = (
        f"row long, doc_id {kind}, held_out boolean, n_words long, n_head long, head_sum double, score double, "
        "bits_per_byte double, rare array<struct<word: binary, n: long>>"
    )
    scored = stored(table.mapInArrow(run, schema), "scored")
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n").join(words, "word")
    sums = rare.groupBy("row").agg(F.sum("n").alias("n_rare"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_sum"))
    joined = scored.drop("rare").join(sums, "row", "left")
    n_tokens = F.col("n_words") + 1
    end = F.lit(float(np.log10(n_training + 1)))
    denominator = F.lit(float(np.log10(tokens + distinct + 1)))
    return joined.select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"),
        (F.col("n_head") + F.coalesce("n_rare", F.lit(0)) + F.lit(int(n_training > 0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("rare_sum", F.lit(0.0)) + end - n_tokens * denominator).alias("base_score"),
        "score", "bits_per_byte",
    )
