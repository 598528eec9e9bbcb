"""Packing of token sequences by non-negative least squares over shallow length combinations.

A document is its token ids and an end id. It is cut into whole windows and a remainder; a remainder is cut
into a body, a multiple of ``unit``, and a tail shorter than that. The bodies' lengths form one histogram.
Every combination of at most ``depth`` body lengths that fills a window exactly is a candidate; non-negative
least squares gives how often to use each so that the histogram is used up, and the counts are rounded down.
What is left, and all tails, are laid end to end and cut at window ends. Only the last sequence is not full.

Places are found by counting: a body's rank among those of its length fixes its combination and place in it.
Ranks need counts per task and length only. The driver sees one histogram; documents are not shuffled as long
as the table of counts is small enough for Spark to broadcast, otherwise they are joined to it.

Nulls count as empty texts: they hold the end id alone. Equal rows are packed separately. An empty table gives an
empty table. Columns of the input other than the id and text are not read.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trisect.llm.bytebpe import PieceEncoder, blocks, vocabulary
from trisect.llm.tables import kept_between_tasks, light, slices, stored, text_or_empty, texts_of, with_columns


def combinations(units: int, depth: int) -> np.ndarray:
    """All ways to write ``units`` as a sum of at most ``depth`` parts, as counts per part size (rows)."""
    found: list[list[int]] = []

    def extend(rest: int, most: int, parts: list[int]):
        if not rest:
            found.append(parts)
        elif len(parts) < depth:
            for part in range(min(rest, most), 0, -1):
                if part * (depth - len(parts)) < rest:
                    break
                extend(rest - part, part, [*parts, part])

    extend(units, units - 1, [])
    table = np.zeros((len(found), units), np.int64)
    for row, parts in enumerate(found):
        for part in parts:
            table[row, part] += 1
    return table


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that makes |a x - b| smallest, by coordinate descent on the normal equations."""
    gram, target = a.T @ a, a.T @ b
    x = np.zeros(a.shape[1])
    slope = -target.astype(float)
    diagonal = np.diag(gram)
    for _ in range(rounds):
        moved = 0.0
        for j in np.flatnonzero((x > 0) | (slope < 0)):
            new = max(0.0, x[j] - slope[j] / diagonal[j])
            if new != x[j]:
                slope += gram[:, j] * (new - x[j])
                moved = max(moved, abs(new - x[j]))
                x[j] = new
        if moved < 0.5:
            break
    return x


def plan(histogram: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Combinations and how often to use each; never more bodies of a length than there are."""
    table = combinations(len(histogram), depth)
    x = non_negative_least_squares(table.T.astype(float), histogram.astype(float))
    times = np.floor(x + 1e-9).astype(np.int64)
    # The least-squares fit may ask for more of a length than there is; take the surplus back.
    left = histogram - table.T @ times
    for size in np.flatnonzero(left < 0):
        for row in np.argsort(-times * (table[:, size] > 0), kind="stable"):
            if left[size] >= 0:
                break
            if not table[row, size]:
                continue
            less = min(times[row], -(left[size] // table[row, size]))
            times[row] -= less
            left += less * table[row]
    # Use up what still fits, largest bodies first.
    for row in range(len(table)):
        need = np.flatnonzero(table[row])
        more = int(min(left[need] // table[row, need]))
        if more > 0:
            times[row] += more
            left -= more * table[row]
    used = times > 0
    return table[used], times[used]


class Places:
    """Where the body with rank r among those of its size goes."""

    def __init__(self, table: np.ndarray, times: np.ndarray, unit: int):
        ends = np.cumsum(times)
        self.sequences = int(ends[-1]) if len(ends) else 0
        self.runs: dict[int, tuple[list[int], list[int], list[int]]] = {}
        for row, (count, first) in enumerate(zip(times, ends - times, strict=True)):
            offset = 0
            for size in np.flatnonzero(table[row])[::-1]:
                for _ in range(table[row, size]):
                    stops, starts, offsets = self.runs.setdefault(int(size), ([], [], []))
                    before = stops[-1] if stops else 0
                    stops.append(before + int(count))
                    starts.append(int(first) - before)
                    offsets.append(offset * unit)
                    offset += int(size)
        self.runs = {s: tuple(np.array(x, np.int64) for x in r) for s, r in self.runs.items()}

    def of(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset; sequence -1 for bodies that no combination takes."""
        sequence = np.full(len(size), -1, np.int64)
        offset = np.zeros(len(size), np.int64)
        for s in np.unique(size):
            if int(s) not in self.runs:
                continue
            stops, starts, offsets = self.runs[int(s)]
            chosen = np.flatnonzero(size == s)
            at = np.searchsorted(stops, rank[chosen], side="right")
            taken = at < len(stops)
            chosen, at = chosen[taken], at[taken]
            sequence[chosen] = starts[at] + rank[chosen]
            offset[chosen] = offsets[at]
        return sequence, offset


kept_between_tasks(vocabulary)


@kept_between_tasks
@lru_cache(maxsize=2)
def _encoder(tokenizer: str) -> PieceEncoder:
    return PieceEncoder(vocabulary(tokenizer))


def measured_ids(documents: DataFrame, tokenizer: str, end_id: int, window: int, unit: int, id_column: str, text: str):
    """One row per document: its ids with the end id, and what it holds of each kind of piece.

    ``part`` is the task; ``rank``, ``tail_before`` and ``whole_before`` count what came earlier in it.
    """
    end = np.array([end_id], "<u4").tobytes()

    def make():
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(window // unit, np.int64)
        tails = wholes = 0

        def columns(batch):
            nonlocal tails, wholes
            ids, n = [], []
            for run in blocks(texts_of(batch, "text")):
                flat, at = encoder.encode(run)
                raw = flat.astype("<u4").tobytes()
                ids += [raw[4 * a : 4 * b] + end for a, b in zip(at[:-1], at[1:], strict=True)]
                n.append(np.diff(at) + 1)
            tokens = np.concatenate([np.empty(0, np.int64), *n])
            rest = tokens % window
            size, tail, whole = rest // unit, rest % unit, tokens // window
            rank = rank_within(size, seen)
            seen[:] += np.bincount(size, minlength=len(seen))
            before = [tails + np.cumsum(tail) - tail, wholes + np.cumsum(whole) - whole]
            tails, wholes = tails + int(tail.sum()), wholes + int(whole.sum())
            return [ids, np.full(len(size), part), size, rank, tail, before[0], whole, before[1]]

        return columns

    chosen = documents.select(F.col(id_column).alias("doc_id"), text_or_empty(text).alias("text"))
    return with_columns(chosen, MEASURES, make).drop("text")


MEASURES = (
    "ids binary, part long, size long, rank long, tail long, tail_before long, whole long, whole_before long"
)
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    documents: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, unit: int = 32, depth: int = 4,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``window`` must be a multiple of ``unit``. Whole windows are sequences of their own.
    """
    if window % unit:
        raise ValueError("window must be a multiple of unit")
    units = window // unit
    # Ranks are fixed when the table is written; later passes may read it in any order.
    table = stored(measured_ids(documents, tokenizer, end_id, window, unit, id_column, text), "token-ids")
    counts = stored(
        table.groupBy("part", "size").agg(
            F.count(F.lit(1)).alias("n"), F.sum("tail").alias("tails"), F.sum("whole").alias("wholes")
        ),
        "body-counts",
    )
    totals = counts.groupBy("size").agg(F.sum("n").alias("n"), F.sum("wholes").alias("wholes")).collect()
    histogram = np.zeros(units, np.int64)
    for row in totals:
        histogram[row["size"]] = row["n"]
    histogram[0] = 0
    combos, times = plan(histogram, depth)
    places = Places(combos, times, unit)
    whole_first = places.sequences
    line_first = whole_first + sum(row["wholes"] for row in totals)
    used = combos.T @ times if len(combos) else np.zeros(units, np.int64)
    loose = (histogram - used) * np.arange(units) * unit
    body_line, tail_line = np.cumsum(loose) - loose, int(loose.sum())

    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    of_part = counts.groupBy("part").agg(F.sum("tails").alias("tails"), F.sum("wholes").alias("wholes")).select(
        "part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_first") for c in ("tails", "wholes")]
    )
    of_size = counts.select(
        "part", "size",
        F.coalesce(F.sum("n").over(earlier.partitionBy("size")), F.lit(0)).alias("rank_first"),
    )
    placed = table.join(of_size.join(of_part, "part"), ["part", "size"]).select(
        "doc_id", "ids", "size", "tail", "whole", (F.col("rank") + F.col("rank_first")).alias("rank"),
        (F.col("tail_before") + F.col("tails_first")).alias("tail_at"),
        (F.col("whole_before") + F.col("wholes_first")).alias("whole_at"),
    )

    # All texts are encoded by now, so workers give back what they remember of pieces.
    @light
    def place(batches):
        for batch in (part for given in batches for part in slices(given)):
            size, tail, whole, rank, tail_at, whole_at = (
                batch.column(c).to_numpy() for c in ("size", "tail", "whole", "rank", "tail_at", "whole_at")
            )
            raws = batch.column("ids").to_pylist()
            sequence, offset = places.of(size, rank)
            body_at = body_line[size] + (rank - used[size]) * size * unit
            out: list[tuple[int, int, int, int, int]] = []
            for i in range(len(raws)):
                start = 0
                for w in range(int(whole[i])):
                    out.append((i, start, window, whole_first + int(whole_at[i]) + w, 0))
                    start += window
                body = int(size[i]) * unit
                on_line = [(tail_line + int(tail_at[i]), int(tail[i]))]
                if body and sequence[i] >= 0:
                    out.append((i, start, body, int(sequence[i]), int(offset[i])))
                    start += body
                else:
                    on_line.insert(0, (int(body_at[i]), body))
                for at, left in on_line:
                    while left:
                        take = min(left, window - at % window)
                        out.append((i, start, take, line_first + at // window, at % window))
                        start, at, left = start + take, at + take, left - take
            crc = [zlib.crc32(raws[i][4 * s : 4 * (s + k)]) for i, s, k, _, _ in out]
            piece = np.array(out, np.int64).reshape(-1, 5)
            tokens = np.array([len(r) // 4 for r in raws], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(piece[:, 0])), pa.array(piece[:, 1]), pa.array(piece[:, 2]),
                    pa.array(crc, pa.int64()), pa.array(tokens[piece[:, 0]]), pa.array(piece[:, 3]), pa.array(piece[:, 4]),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    kind = dict(table.dtypes)["doc_id"]
    return placed.mapInArrow(place, f"doc_id {kind}, {PIECES}")


def rank_within(size: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Rank of each body among those of its size, counting the earlier ones."""
    order = np.argsort(size, kind="stable")
    inside = np.arange(len(size)) - np.searchsorted(size[order], size[order])
    rank = np.empty(len(size), np.int64)
    rank[order] = inside
    return rank + before[size]
