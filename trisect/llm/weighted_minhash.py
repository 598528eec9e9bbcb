"""Near-duplicate documents by consistent weighted sampling of TF-IDF shingles.

A text's shingles are its runs of five words; a shingle weighs 1 + ln(times in the text), times its idf. The documents that
hold it are counted for every shingle, over all documents. The idf is a smoothed one, ln((1 + n) / (1 + df)) plus a constant, and
falls from 1 for a shingle of one document to ``LEAST_IDF`` for one of all: a group of copies may hold a third of all documents, or
a whole table, and its own shingles must keep their weight against the edits.

Samples: every shingle falls into one bin, and each bin keeps the shingle that improved consistent weighted sampling
picks from it, with its rounded weight; empty bins borrow from others in a fixed random order. Two texts agree
in a bin with about the probability of their weighted Jaccard similarity. Bands of samples are the buckets.

Verification is exact and linear in crowded buckets. Each bucket compares its members with a pivot; what is linked is
contracted to components. After a few rounds with other pivots only buckets that still hold several components are
compared pair by pair, in blocks of bounded size, and only across components. Texts travel, not sets; a task gets a
bounded part of a group. A link that shares a bucket is never lost, so components are those of all such links.

Texts of equal words are one class from the start. A text of fewer than five words is one shingle. A text without words,
or a null, links with nothing but rows of its own id. Of rows equal in id and words one is kept. An empty table gives an empty table. Long texts are
compared whole. Other columns are not read, and stay as they are in ``keep_one_each``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisect.llm.components import connected_components
from trisect.llm.tables import SPACE_CLASS, light, stored, text_or_empty

WORDS = 5
BANDS, ROWS = 40, 6
BINS = BANDS * ROWS
# Texts of one side of a block in the pairwise rest, and members compared with one pivot in one group.
CHUNK = 256
PER_PIVOT = 2000
PIVOT_ROUNDS = 2
MOST_WORDS = 200_000
# With this least weight two texts of plain similarity 16 / 19 (0.842) reach 0.8 however common what they share is.
LEAST_IDF = 0.75
# Documents, and about how many shingles, of a run; shingles of a part of the hashes; letters of a word and its blank, at least.
RUN_TEXTS = 2000
RUN_SHINGLES = 600_000
PART_SHINGLES = 1_000_000
LETTERS = 5

GOLDEN = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit mix of unsigned integers."""
    x = (x + np.uint64((seed + 1) * GOLDEN & 0xFFFFFFFFFFFFFFFF)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniforms(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent numbers in (0, 1) for each hash, of 32 bits each."""
    both = mixed(x, seed)
    return ((both >> np.uint64(32)).astype(np.float64) + 0.5) / 2.0**32, ((both & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5) / 2.0**32


class Shingler:
    """Shingle hashes of normalised texts; remembers the hashes of words."""

    def __init__(self):
        self.hashes: dict[str, int] = {}

    def shingles(self, norm: str) -> np.ndarray:
        words = norm.split(" ") if norm else []
        if not words:
            return np.empty(0, np.uint64)
        known = self.hashes
        if len(known) > MOST_WORDS:
            known.clear()
        try:
            h = np.array([known[w] for w in words], np.uint64)
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
            h = np.array([known[w] for w in words], np.uint64)
        n = max(len(h) - WORDS + 1, 1)
        # A polynomial in the word hashes, with the number of words first.
        total = np.full(n, min(len(h), WORDS), np.uint64)
        for k in range(min(WORDS, len(h))):
            total = total * np.uint64(GOLDEN) + h[k : k + n]
        return mixed(total)

    def weighted(self, norm: str, held: np.ndarray, idf: Idf) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles in order and their weights; ``held`` says how many documents hold each."""
        shingle, times = np.unique(self.shingles(norm), return_counts=True)
        return shingle, (1 + np.log(times)) * idf.of(held)


class Idf:
    """Smoothed inverse document frequencies: 1 for a shingle of one document, LEAST_IDF for one of all documents."""

    def __init__(self, documents: int):
        self.documents = documents

    def of(self, held: np.ndarray) -> np.ndarray:
        """Weights of shingles by how many documents hold them."""
        if self.documents < 2:
            return np.ones(len(held))
        rarity = np.log((1 + self.documents) / (1 + held)) / math.log((1 + self.documents) / 2)
        return LEAST_IDF + (1 - LEAST_IDF) * rarity


def normalised(text: str = "text") -> Column:
    """Lower-case words with single spaces."""
    words = F.regexp_replace(F.lower(text_or_empty(text)), SPACE_CLASS + "+", " ")
    return F.trim(words)


def shingles_of(norms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of many texts, as ``Shingler`` has them, and the text of each; of all texts in no order."""
    words = pc.split_pattern(norms, " ")
    size = np.where(pc.equal(norms, "").to_numpy(zero_copy_only=False), 0, words.value_lengths().to_numpy())
    coded = words.flatten().dictionary_encode()
    values = coded.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, values), np.uint64, len(values))
    h = hashes[coded.indices.to_numpy()]
    # An empty text has one empty word in the list.
    start = np.cumsum(np.maximum(size, 1)) - np.maximum(size, 1)
    shingle, text = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for width in range(1, WORDS + 1):
        held = np.flatnonzero(size == width if width < WORDS else size >= width)
        n = size[held] - width + 1
        at = np.arange(n.sum()) + np.repeat(start[held] - (np.cumsum(n) - n), n)
        total = np.full(len(at), width, np.uint64)
        for k in range(width):
            total = total * np.uint64(GOLDEN) + h[at + k]
        shingle.append(mixed(total))
        text.append(np.repeat(held, n))
    return np.concatenate(shingle), np.concatenate(text)


class Run:
    """The shingles of a run of texts: each once, and which text holds which how often."""

    def __init__(self, norms: pa.Array):
        shingle, text = shingles_of(norms)
        order = np.argsort(shingle)
        same = np.append(False, shingle[order][1:] == shingle[order][:-1])
        # Equal shingles are as wide as each other, so that their texts rise with their places.
        again = np.flatnonzero(same | np.append(same[1:], False))
        order[again] = order[again][np.lexsort((order[again], shingle[order[again]]))]
        shingle, text = shingle[order], text[order]
        new = np.ones(len(shingle), bool)
        new[1:] = shingle[1:] != shingle[:-1]
        pair = new.copy()
        pair[1:] |= text[1:] != text[:-1]
        at = np.flatnonzero(pair)
        self.shingle, self.text = shingle[new], text[at]
        self.times = np.diff(np.append(at, len(shingle)))
        # Which of the run's shingles each pair of a text and a shingle is about, and how many texts hold a shingle.
        self.which = np.cumsum(new)[at] - 1
        self.n = np.bincount(self.which, minlength=len(self.shingle))


def common_shingles(norms: DataFrame, common: float) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that more than a share ``common`` of all documents hold, and their shares, counted over all documents."""

    @light
    def count(batches):
        for batch in slices(batches):
            run = Run(batch.column("norm"))
            yield pa.RecordBatch.from_arrays([pa.array(run.shingle.view(np.int64)), pa.array(run.n)], names=["shingle", "n"])

    documents = norms.count()
    counts = norms.select("norm").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    # At most (mean distinct shingles / common) of them.
    found = counts.where(F.col("n") > common * documents).collect()
    return np.array([r["shingle"] for r in found], np.int64).view(np.uint64), np.array([r["n"] / documents for r in found])


def _packed(values: np.ndarray) -> bytes:
    """Rising numbers as their gaps, in as few bytes each as the largest needs."""
    gaps = np.diff(values, prepend=np.uint64(0))
    width = (int(gaps.max()).bit_length() + 7) // 8 or 1
    return bytes([width]) + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    width = packed[0]
    wide = np.zeros(((len(packed) - 1) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(packed, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)


def fit_idf(documents: DataFrame, text: str = "text") -> tuple[Idf, DataFrame]:
    """Document frequencies of all shingles.

    Returns the idf, and (doc_id, node, row, held, buckets) of every document: how many documents hold each of its shingles, in the
    shingles' order, its bucket keys, and a number of its own. Documents are dealt to runs; a run sends each of its shingles once,
    with its number of texts, to the part of the hashes it falls into, where all runs are added up, and gets the sums back.
    Within a part 40 bits stand for a shingle, so one in a million shares its count with another.
    """
    total = documents.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length(text_or_empty(text))), F.lit(0)).alias("chars")).first()
    idf, shingles = Idf(total["n"]), total["chars"] // LETTERS
    runs = 1 + max(total["n"] // RUN_TEXTS, shingles // RUN_SHINGLES)
    bits = min(max(shingles // PART_SHINGLES, 1).bit_length() - 1, 24)
    dealt = documents.select(
        F.pmod(F.xxhash64(node_column(text), "doc_id"), F.lit(runs)).cast("int").alias("run"), "doc_id", node_column(text).alias("node"),
        normalised(text).alias("norm"),
    )

    def sent(key, texts):
        run = Run(texts.column("norm").combine_chunks())
        part = (run.shingle >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(run.shingle), np.int64)
        short = (run.shingle << np.uint64(bits)) >> np.uint64(24)
        ends = np.searchsorted(part, np.arange((1 << bits) + 1))
        spans = [(i, a, b) for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if a < b]
        return pa.table({
            "run": pa.array([key[0].as_py()] * len(spans), pa.int32()), "part": pa.array([i for i, _, _ in spans], pa.int32()),
            "shingles": pa.array([_packed(short[a:b]) for _, a, b in spans], pa.binary()),
            "n": pa.array([run.n[a:b].astype("<u4").tobytes() for _, a, b in spans], pa.binary()),
        })

    def added(key, table):
        parts = [_unpacked(s) for s in table.column("shingles").to_pylist()]
        n = np.concatenate([np.frombuffer(b, "<u4") for b in table.column("n").to_pylist()])
        _, which = np.unique(np.concatenate(parts), return_inverse=True)
        held = np.bincount(which, n).astype("<u4")[which]
        ends = np.cumsum([len(p) for p in parts])
        return pa.table({
            "run": table.column("run"), "part": table.column("part"),
            "held": pa.array([held[b - len(p) : b].tobytes() for p, b in zip(parts, ends, strict=True)], pa.binary()),
        })

    def weighed(key, texts, sums):
        run, n = Run(texts.column("norm").combine_chunks()), texts.num_rows
        sums = sums.sort_by("part").column("held").to_pylist()
        held = np.frombuffer(b"".join(sums), "<u4").astype(np.int64)[run.which]
        # Text by text, the shingles of each in order.
        order = np.argsort(run.text.astype(np.uint16) if n <= 1 << 16 else run.text, kind="stable")
        text, which, times, held = run.text[order], run.which[order], run.times[order], held[order]
        weight = (1 + np.log(times)) * idf.of(held)
        size = np.bincount(text, minlength=n)
        full = np.flatnonzero(size)
        keys = bands(run.shingle[which], weight, (np.cumsum(size > 0) - 1)[text], len(full), borrow_order()) if len(full) else np.empty(0, np.int64)
        return pa.table({
            "doc_id": texts.column("doc_id"), "node": texts.column("node"), "row": pa.array(np.arange(n) + (key[0].as_py() << 33)),
            "held": pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(held, pa.int32())),
            "buckets": pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum((size > 0) * BANDS)), pa.int32()), pa.array(keys.ravel())),
        })

    counted = dealt.groupBy("run").applyInArrow(sent, "run int, part int, shingles binary, n binary")
    sums = counted.groupBy("part").applyInArrow(added, "run int, part int, held binary")
    kind = documents.schema["doc_id"].dataType.simpleString()
    vectors = dealt.groupBy("run").cogroup(sums.groupBy("run")).applyInArrow(
        weighed, f"doc_id {kind}, node binary, row long, held array<int>, buckets array<long>"
    )
    return idf, stored(vectors, "vectors")


def borrow_order() -> np.ndarray:
    """For each bin the bins it borrows from, in order."""
    rng = np.random.default_rng(5)
    return np.stack([rng.permutation(BINS) for _ in range(BINS)])


def bands(shingle: np.ndarray, weight: np.ndarray, document: np.ndarray, n: int, order: np.ndarray) -> np.ndarray:
    """Bucket keys [documents, bands] of documents that have a shingle each, given end to end."""
    r, c = (-np.log(np.multiply(*uniforms(shingle, seed))) for seed in (1, 2))
    beta, place = uniforms(shingle, 3)
    t = np.floor(np.log(weight) / r + beta)
    # The smallest c / (y e^r) of each bin; positive single-precision numbers sort like their bits.
    a = np.minimum(c * np.exp(-r * (t - beta) - r), 1e30).astype(np.float32)
    at = document * BINS + (place * BINS).astype(np.int64)
    sort = np.argsort((at.astype(np.uint64) << np.uint64(32)) | a.view(np.uint32), kind="stable")
    first = sort[np.concatenate([[True], at[sort][1:] != at[sort][:-1]])]
    sample = np.zeros(n * BINS, np.uint64)
    filled = np.zeros(n * BINS, bool)
    sample[at[first]] = mixed(shingle[first] ^ t[first].astype(np.int64).view(np.uint64) * np.uint64(GOLDEN), 7)
    filled[at[first]] = True
    sample, filled = sample.reshape(n, BINS), filled.reshape(n, BINS)
    row, bin_ = np.nonzero(~filled)
    source = sample.copy()
    for step in range(BINS):
        if not len(row):
            break
        lender = order[bin_, step]
        has = filled[row, lender]
        sample[row[has], bin_[has]] = source[row[has], lender[has]]
        row, bin_ = row[~has], bin_[~has]
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (n, BANDS)).copy()
    for k in range(ROWS):
        key = mixed(key ^ sample[:, k::ROWS], 8)
    return key.view(np.int64)


def slices(batches, rows: int = 1000):
    """The batches in pieces, so that few texts at a time are Python strings."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts."""
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    both = a[0][at] == b[0]
    least = np.minimum(a[1][at[both]], b[1][both]).sum()
    return float(least / (a[1].sum() + b[1].sum() - least))


def _columns(batch: pa.RecordBatch, names: tuple[str, ...]):
    """The rows of a batch with these columns; lists of numbers are arrays."""
    lists = batch.column("held")
    ends = lists.offsets.to_numpy()
    held = np.split(lists.flatten().to_numpy(), (ends - ends[0])[1:-1]) if batch.num_rows else []
    return zip(*(batch.column(c).to_pylist() for c in names), held, strict=True)


def _linked_to_pivot(pairs: DataFrame, texts: DataFrame, idf: Idf, threshold: float) -> DataFrame:
    """Of (pivot, node) the pairs whose similarity reaches the threshold, as links (a, b).

    A pivot's members are dealt out in parts of bounded size; the pivot's text goes to each part.
    """
    sizes = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / PER_PIVOT).cast("int").alias("parts"))
    members = pairs.join(sizes, "pivot").select(
        "pivot", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node", F.lit(False).alias("is_pivot")
    )
    pivots = sizes.select(
        "pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("pivot").alias("node"),
        F.lit(True).alias("is_pivot"),
    )
    rows = members.unionAll(pivots).join(texts, "node")
    dealt = rows.repartition("pivot", "part").sortWithinPartitions("pivot", "part", F.desc("is_pivot"))

    @light
    def run(batches):
        shingler, pivot, own = Shingler(), None, None
        for batch in batches:
            a, b = [], []
            for p, node, is_pivot, norm, held in _columns(batch, ("pivot", "node", "is_pivot", "norm")):
                if is_pivot:
                    pivot, own = p, shingler.weighted(norm, held, idf)
                elif p == pivot and similarity(own, shingler.weighted(norm, held, idf)) >= threshold:
                    a.append(p)
                    b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return dealt.select("pivot", "node", "is_pivot", "norm", "held").mapInArrow(run, "a binary, b binary")


def _linked_in_blocks(members: DataFrame, texts: DataFrame, idf: Idf, threshold: float) -> DataFrame:
    """Links between members of a bucket (bucket, node, root) that are in different components, block by block."""
    sizes = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    rows = members.join(sizes, "bucket").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "bucket", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "node", "root"
    )
    dealt = rows.join(texts, "node").repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "node")

    def verify(group, shingler):
        nodes, roots = ([g[i] for g in group] for i in (4, 5))
        if len(set(roots)) < 2:
            return []
        vectors = [shingler.weighted(g[6], g[7], idf) for g in group]
        root = np.unique(roots, return_inverse=True)[1]
        total = np.array([w.sum() for _, w in vectors])
        shingle, inverse = np.unique(np.concatenate([s for s, _ in vectors]), return_inverse=True)
        weight = np.concatenate([w for _, w in vectors])
        ends = np.concatenate([[0], np.cumsum([len(s) for s, _ in vectors])])
        split = group[0][1] != group[0][2]
        chunk = np.array([g[3] for g in group])
        found = []
        dense = np.zeros(len(shingle))
        for i in range(len(group)):
            # Totals that differ too much cannot reach the threshold.
            near = (np.minimum(total, total[i]) >= threshold * np.maximum(total, total[i]) * (1 - 1e-9)) & (root != root[i])
            near[: i + 1] = False
            if split:
                near &= chunk != chunk[i]
            if not near.any():
                continue
            own = inverse[ends[i] : ends[i + 1]]
            dense[own] = weight[ends[i] : ends[i + 1]]
            for j in np.flatnonzero(near):
                least = np.minimum(dense[inverse[ends[j] : ends[j + 1]]], weight[ends[j] : ends[j + 1]]).sum()
                if least >= threshold * (total[i] + total[j] - least):
                    found.append((nodes[i], nodes[j]))
                    # Contract at once: members of one component need no more comparing.
                    root[root == root[j]] = root[i]
                    near &= root != root[i]
            dense[own] = 0
        return found

    columns = ("bucket", "low", "high", "chunk", "node", "root", "norm")

    @light
    def run(batches):
        shingler, group, last = Shingler(), [], None
        for batch in batches:
            found = []
            for row in _columns(batch, columns):
                if row[:3] != last:
                    found += verify(group, shingler) if group else []
                    group, last = [], row[:3]
                group.append(row)
            yield _links(found)
        if group:
            yield _links(verify(group, shingler))

    return dealt.select(*columns, "held").mapInArrow(run, "a binary, b binary")


def _links(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], names=["a", "b"]
    )


def _contracted(stars: DataFrame | None, found: DataFrame) -> DataFrame:
    """Components of new links and earlier components, which are stars already and settle at once."""
    if stars is not None and found.isEmpty():
        return stars
    return connected_components(found if stars is None else found.unionAll(stars.toDF("a", "b")))


def _with_roots(members: DataFrame, stars: DataFrame) -> DataFrame:
    roots = stars.toDF("_node", "_root")
    return members.join(roots, F.col("node") == F.col("_node"), "left").select(
        "bucket", "node", F.coalesce("_root", "node").alias("root")
    )


def class_roots(named: DataFrame, vectors: DataFrame, idf: Idf, threshold: float = 0.8) -> DataFrame:
    """(node, root) of the classes that are linked with another one, from (node, norm) and what ``fit_idf`` found of all documents."""
    # Copies have the same buckets and meet in them as one node.
    met = vectors.select(F.explode("buckets").alias("bucket"), "node").distinct()
    crowded = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket")
    members = stored(met.join(crowded, "bucket"), "crowded")
    # One text of each class that is in a crowded bucket.
    needed = members.select("node").distinct()
    chosen = vectors.select("node", "held").join(needed, "node").groupBy("node").agg(F.first("held").alias("held"))
    texts = named.join(needed, "node").groupBy("node").agg(F.first("norm").alias("norm"))
    texts = stored(texts.join(chosen, "node"), "texts")
    stars = None
    state = members.withColumn("root", F.col("node"))
    for turn in range(PIVOT_ROUNDS):
        # The first pivot is the same in all buckets of a group, so that few pairs differ; later ones vary by bucket.
        order = F.xxhash64("node") if turn == 0 else F.xxhash64("node", "bucket", F.lit(turn))
        pivots = state.groupBy("bucket").agg(
            F.min_by(F.struct("node", "root"), order).alias("p"), F.min("root").alias("least"), F.max("root").alias("most")
        ).where("least <> most")
        pairs = state.join(pivots, "bucket").where("root <> p.root").select(
            F.least("node", "p.node").alias("x"), F.greatest("node", "p.node").alias("y"), F.col("p.node").alias("pivot"), "node"
        )
        pairs = pairs.dropDuplicates(["x", "y"]).select("pivot", "node")
        stars = _contracted(stars, stored(_linked_to_pivot(pairs, texts, idf, threshold), "links"))
        state = stored(_with_roots(members, stars), "state")
    mixed_buckets = state.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most")).where(
        "least <> most"
    ).select("bucket")
    rest = state.join(mixed_buckets, "bucket")
    return _contracted(stars, stored(_linked_in_blocks(rest, texts, idf, threshold), "links"))


def node_column(text: str = "text") -> Column:
    """16 bytes that stand for the words of a text."""
    # Never null, which a join would test by making it twice.
    return F.coalesce(F.unhex(F.md5(normalised(text).cast("binary"))), F.lit(b""))


def _decided(documents: DataFrame, threshold: float, text: str) -> DataFrame:
    """One row per document: doc_id, node, class_id, class_size, kept."""
    idf, vectors = fit_idf(documents, text)
    named = documents.select(node_column(text).alias("node"), normalised(text).alias("norm"))
    roots = class_roots(named, vectors, idf, threshold).withColumnRenamed("node", "_node")
    grouped = vectors.join(roots, F.col("node") == F.col("_node"), "left").select(
        "doc_id", "node", "row", F.coalesce("root", "node").alias("root"),
        # Texts without words are groups by id.
        F.when(F.size("held") == 0, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("alone"),
    )
    # A null id counts as larger than any other.
    first = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")
    heads = grouped.groupBy("root", "alone").agg(F.min(first).alias("head"), F.count(F.lit(1)).alias("class_size"))
    same = (grouped["root"] == heads["root"]) & grouped["alone"].eqNullSafe(heads["alone"])
    return grouped.join(heads, same).select(
        "doc_id", "node", F.col("head.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("head.row")).alias("kept")
    )


def near_duplicates(documents: DataFrame, threshold: float = 0.8, text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (the smallest id of its group), class_size and kept."""
    return _decided(documents, threshold, text).drop("node")


def keep_one_each(documents: DataFrame, threshold: float = 0.8, text: str = "text") -> DataFrame:
    """The documents without the near duplicates of others, with their own columns."""
    kept = _decided(documents, threshold, text).where("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("node").alias("_kept_node")
    )
    named = documents.withColumn("_node", node_column(text))
    found = named.join(kept, named["doc_id"].eqNullSafe(kept["_kept_id"]) & (named["_node"] == kept["_kept_node"]))
    # Rows that are equal in id and words were one decision.
    return found.dropDuplicates(["doc_id", "_node"]).select(*documents.columns)
