"""Near-duplicate vectors by E8 lattice hashing.

In each of several tables a vector is projected to eight random dimensions and decoded to the nearest point of the
E8 lattice, its home cell; it also probes the neighbouring cells that lie nearest. Two vectors meet where one's
home is the other's home or probe. Meetings are verified by cosine in double precision.

Equal vectors with equal labels are one class with a count. Only cells where two classes meet are kept, and only for
these are vectors brought along. Cells with many classes are split into blocks of pairs, so that no task gets
an unbounded group, and a block returns a count and a root per class, never pairs. A pair that meets in
several cells counts in one of them, the same for every task.

With the default four tables and eight probes, of pairs at cosine 0.98 exactly about 1 in 250 000 never meets, and of
pairs at 0.99 fewer than 1 in 10 ** 9; random pairs meet in a cell with probability 5e-4. ``scale`` sharpens the
cells for larger collections, at the price of more tables.

Rows whose label or vector is null, or whose vector is empty, zero, or holds nulls or non-finite numbers, link with nothing.
Repeated rows are vectors of their own. Vectors of other lengths never meet. An empty table gives an empty table.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisect.llm.components import connected_components
from trisect.llm.tables import stored

# Classes in one block of a crowded cell; a block of two chunks holds twice as many.
CHUNK = 1024
# Cells with fewer classes are verified together, pair by pair.
SMALL_CELL = 48
SLAB_ROWS = 20_000


def nearest_points(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row, doubled so that it is integral: an even-sum integer point, or one shifted by half."""
    best = None
    for shift in (0.0, 0.5):
        point = np.rint(x - shift) + shift
        odd = np.flatnonzero((point - shift).sum(axis=1).astype(np.int64) & 1)
        off = x[odd] - point[odd]
        worst = np.abs(off).argmax(axis=1)
        point[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
        distance = ((x - point) ** 2).sum(axis=1)
        if best is None:
            best, least = point, distance
        else:
            best = np.where((distance < least)[:, None], point, best)
    return np.rint(2 * best).astype(np.int64)


@lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of the lattice: two entries of size one, or eight halves with an even number of minus signs."""
    rows = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            row = [0.0] * 8
            row[i], row[j] = a, b
            rows.append(row)
    rows += [list(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(rows)


@lru_cache(maxsize=8)
def projections(dimensions: int, tables: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Per table orthonormal random directions times the scale, and a random shift."""
    rng = np.random.default_rng(8)
    made = []
    for _ in range(tables):
        axes = np.linalg.qr(rng.normal(size=(max(dimensions, 8), 8)))[0][:dimensions]
        # Projected lengths do not depend on the number of dimensions; ``scale`` is for 64 of them.
        made.append(axes * scale * np.sqrt(dimensions / 64))
    return np.stack(made), rng.uniform(-1, 1, (tables, 8))


def cells(unit: np.ndarray, salt: np.ndarray, tables: int, probes: int, scale: float) -> np.ndarray:
    """Hashed cells of unit vectors [rows, tables, 1 + probes], the home cell first. ``salt`` keeps labels apart."""
    axes, shift = projections(unit.shape[1], tables, scale)
    out = np.empty((len(unit), tables, 1 + probes), np.int64)
    roots = neighbours()
    doubled = np.rint(2 * roots).astype(np.int64)
    for t in range(tables):
        at = unit @ axes[t] + shift[t]
        home = nearest_points(at)
        nearness = (at - home / 2) @ roots.T
        # Ties are broken by the order of the neighbours.
        chosen = np.argsort(-nearness, axis=1, kind="stable")[:, :probes]
        points = np.concatenate([home[:, None, :], home[:, None, :] + doubled[chosen]], axis=1)
        hashed = salt[:, None] ^ np.uint64((t + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        hashed = np.repeat(hashed, 1 + probes, axis=1)
        for k in range(8):
            hashed = (hashed ^ points[:, :, k].astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
            hashed ^= hashed >> np.uint64(32)
        out[:, t] = hashed.view(np.int64)
    return out


def salts(labels: list[str], dimensions: int) -> np.ndarray:
    known = {label: zlib.crc32(f"{dimensions}:{label}".encode()) for label in set(labels)}
    return np.array([known[label] for label in labels], np.uint64)


def _keyed(embeddings: DataFrame) -> DataFrame:
    """(vec_id, key, label, vector): key is a digest of label and vector, null for rows that link with nothing."""
    kind = dict(embeddings.dtypes)["vec_id"]
    rows = embeddings.select(
        "vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    )

    def run(batches):
        for batch in batches:
            keys, vectors = [], []
            for label, vector in zip(batch.column("label").to_pylist(), batch.column("embedding"), strict=True):
                values = vector.values if vector.is_valid else None
                raw = None
                if label is not None and values is not None and len(values) and not values.null_count:
                    # Minus zero and zero are equal.
                    numbers = values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
                    if np.isfinite(numbers).all() and numbers.any():
                        raw = numbers.tobytes()
                keys.append(None if raw is None else hashlib.blake2b(f"{label}\n".encode() + raw, digest_size=16).digest())
                vectors.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(keys, pa.binary()), batch.column("label"), pa.array(vectors, pa.binary())],
                names=["vec_id", "key", "label", "vector"],
            )

    return rows.mapInArrow(run, f"vec_id {kind}, key binary, label string, vector binary")


def unit_rows(raws: list[bytes]) -> np.ndarray:
    """Rows of one length as unit vectors; they are scaled by their largest entry first, so that no square overflows."""
    x = np.frombuffer(b"".join(raws), "<f8").reshape(len(raws), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_length(raws: list[bytes]):
    lengths = np.array([len(r) for r in raws])
    for length in np.unique(lengths):
        yield np.flatnonzero(lengths == length)


def _cell_rows(classes: DataFrame, tables: int, probes: int, scale: float) -> DataFrame:
    def run(batches):
        for batch in batches:
            labels, raws = batch.column("label").to_pylist(), batch.column("vector").to_pylist()
            for rows in _by_length(raws):
                unit = unit_rows([raws[i] for i in rows])
                cell = cells(unit, salts([labels[i] for i in rows], unit.shape[1]), tables, probes, scale)
                each = cell.shape[1] * cell.shape[2]
                home = np.zeros(cell.shape, bool)
                home[:, :, 0] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.ravel()), batch.column("class").take(pa.array(np.repeat(rows, each))), pa.array(home.ravel())],
                    names=["cell", "class", "home"],
                )

    return classes.select("class", "label", "vector").mapInArrow(run, "cell long, class long, home boolean")


def near_duplicates(
    embeddings: DataFrame, similarity: float = 0.98, tables: int = 4, probes: int = 8, scale: float = 8.0
) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id, kept."""
    keyed = _keyed(embeddings)
    classes = stored(
        keyed.where("key IS NOT NULL AND vec_id IS NOT NULL").groupBy("key").agg(
            F.min(F.col("vec_id").cast("long")).alias("class"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"),
            F.first("vector").alias("vector"),
        ),
        "vector-classes",
    )
    met = stored(_cell_rows(classes, tables, probes, scale), "cells")
    crowded = met.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.max("home").alias("lived")).where(
        "size > 1 AND lived"
    )
    # A cell of up to CHUNK classes is one block; a larger one is a block for each pair of its chunks.
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    rows = met.join(crowded, "cell").withColumn("chunk", F.pmod(F.xxhash64("class"), chunks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), chunks - 1))
    )
    rows = rows.select(
        "cell", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "class", "home"
    )
    rows = rows.join(classes.drop("key"), "class")
    dealt = rows.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high", "class")
    verified = dealt.select(
        "cell", "low", "high", "chunk", "class", "home", "n", "label", "vector"
    ).mapInArrow(_verifier(similarity, tables, probes, scale), "class long, links long, root long")
    verified = stored(verified, "verified")
    links = verified.groupBy("class").agg(F.sum("links").alias("links"))
    roots = connected_components(verified.where("root < class").select(F.col("class").alias("a"), F.col("root").alias("b")))
    known = (
        classes.select("key", "class", "n").join(links, "class", "left")
        .join(roots, F.col("class") == F.col("node"), "left")
        .select(
            "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("_links"), F.coalesce("root", "class").alias("_root")
        )
    )
    component = F.coalesce(F.col("_root"), F.col("vec_id"))
    return keyed.select("vec_id", "key").join(known, "key", "left").select(
        "vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _verifier(similarity: float, tables: int, probes: int, scale: float):
    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < SLAB_ROWS:
                continue
            slab = pa.Table.from_batches(held)
            # The last block may go on in the next batch.
            block = np.stack([slab.column(c).to_numpy() for c in ("cell", "low", "high")])
            change = np.flatnonzero((block[:, 1:] != block[:, :-1]).any(axis=0))
            if not len(change):
                continue
            cut = int(change[-1]) + 1
            yield from _verify(slab.slice(0, cut), similarity, tables, probes, scale)
            held = slab.slice(cut).to_batches()
            size = slab.num_rows - cut
        if size:
            yield from _verify(pa.Table.from_batches(held), similarity, tables, probes, scale)

    return run


def _verify(slab: pa.Table, similarity: float, tables: int, probes: int, scale: float):
    """Counts and roots of the classes in a run of whole blocks."""
    label, raws = slab.column("label").to_pylist(), slab.column("vector").to_pylist()
    for rows in _by_length(raws):
        take = lambda name: slab.column(name).to_numpy()[rows]  # noqa: B023, E731
        unit = unit_rows([raws[i] for i in rows])
        labels = [label[i] for i in rows]
        codes = np.unique(labels, return_inverse=True)[1]
        cell, low, high, chunk, own, n = (take(c) for c in ("cell", "low", "high", "chunk", "class", "n"))
        home = np.asarray(slab.column("home").to_pylist(), bool)[rows]
        start = np.concatenate(
            [[0], 1 + np.flatnonzero((cell[1:] != cell[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])), [len(rows)]]
        )
        firsts, seconds = [], []
        for i, j in _candidates(start, home, chunk, low, high, unit, similarity):
            right = codes[i] == codes[j]
            firsts.append(i[right])
            seconds.append(j[right])
        if not firsts:
            continue
        i, j = np.concatenate(firsts), np.concatenate(seconds)
        swap = own[i] > own[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        used, place = np.unique(np.concatenate([i, j]), return_inverse=True)
        if not len(used):
            continue
        cell_of = cells(unit[used], salts([labels[k] for k in used], unit.shape[1]), tables, probes, scale)
        here = _counts_here(cell_of, place[: len(i)], place[len(i) :], cell[i])
        i, j = i[here], j[here]
        if not len(i):
            continue
        classes, number = np.unique(np.concatenate([own[i], own[j]]), return_inverse=True)
        a, b = number[: len(i)], number[len(i) :]
        links = np.bincount(a, n[j], len(classes)) + np.bincount(b, n[i], len(classes))
        root = _roots(a, b, len(classes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(classes), pa.array(np.rint(links).astype(np.int64)), pa.array(classes[root])],
            names=["class", "links", "root"],
        )


def _candidates(start, home, chunk, low, high, unit, similarity):
    """Pairs of rows of one block that may count here and are similar."""
    size = np.diff(start)
    group = np.repeat(np.arange(len(size)), size)
    small = np.flatnonzero(size[group] <= SMALL_CELL)
    for step in range(1, SMALL_CELL):
        i = small[small + step < len(group)]
        i = i[group[i] == group[i + step]]
        if not len(i):
            break
        j = i + step
        right = (home[i] | home[j]) & ((low[i] == high[i]) | (chunk[i] != chunk[j]))
        i, j = i[right], j[right]
        for part in np.array_split(np.arange(len(i)), max(1, len(i) // 20_000)):
            cosine = np.einsum("ij,ij->i", unit[i[part]], unit[j[part]])
            good = part[cosine >= similarity]
            yield i[good], j[good]
    for g in np.flatnonzero(size > SMALL_CELL):
        a, b = start[g], start[g + 1]
        rows = np.arange(a, b)
        one = low[a] == high[a]
        left = rows if one else rows[chunk[a:b] == low[a]]
        right = rows if one else rows[chunk[a:b] == high[a]]
        for part in np.array_split(left, max(1, len(left) // 512)):
            x, y = np.nonzero(unit[part] @ unit[right].T >= similarity)
            i, j = part[x], right[y]
            good = (home[i] | home[j]) & ((i < j) | (not one))
            yield i[good], j[good]


def _counts_here(cell_of: np.ndarray, a: np.ndarray, b: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Whether a pair counts in this cell: the first table where it meets, there the home of the smaller class if possible."""
    meeting = np.zeros(len(a), np.int64)
    found = np.zeros(len(a), bool)
    for t in range(cell_of.shape[1]):
        home_a, home_b = cell_of[a, t, 0], cell_of[b, t, 0]
        at_a = (cell_of[b, t] == home_a[:, None]).any(axis=1)
        at_b = (cell_of[a, t] == home_b[:, None]).any(axis=1)
        new = ~found & (at_a | at_b)
        meeting[new] = np.where(at_a[new], home_a[new], home_b[new])
        found |= new
    return found & (meeting == cell)


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node each node reaches."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


# All pairs of a label, for tables small enough for that.
ORACLE = """
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e,
           label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
    FROM embeddings
), links AS (
    SELECT a.r AS a, b.r AS b, b.vec_id AS other FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
    WHERE a.usable AND b.usable AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
    SELECT r, vec_id AS root FROM v
    UNION SELECT links.a, reach.root FROM reach JOIN links ON links.b = reach.r
)
SELECT v.vec_id AS vec_id, (SELECT count(*) FROM links WHERE links.a = v.r) AS n_links, c.root AS component_id,
       v.vec_id IS NOT DISTINCT FROM c.root AS kept
FROM v JOIN (SELECT r, min(root) AS root FROM reach GROUP BY r) c ON v.r = c.r
"""
