"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree over exact block quotas.

Each source's texts are laid end to end in the order of a hash, measured in words, and the line is cut into blocks; the last
block is shorter. A source's target in words becomes an exact number of block draws: whole passes over its blocks, then blocks of
one more pass in a permuted order, the last draw cut so that the target is met to the word. No pass draws a block twice, so no
text is taken more often than there are passes.

A tree over output shards splits the quotas: at each node the draws of all sources are divided between the halves as if they were
dealt blindly, by a multivariate-hypergeometric draw that the node's own seed decides. A leaf is a shard with its exact number of
draws per source, and takes that many from where the shards before it stopped in the source's permuted draws; so shards are disjoint.
Inside a shard the draws are shuffled by a hash. Every task walks only the nodes above its own shards. Retried tasks and other partitionings
give the same mix.

Sources share at most ``GROUPS`` rows of quotas, each source on its own where there are no more than that; sources that share one have their draws permuted
together, which deals them as blindly as the tree would. So the tree's state is bounded, and the number of sources is not. A hot source spreads
over hash buckets, blocks and shards; the texts themselves are only measured.

Sources are in code point order, null last, and weigh 1, 2, 3, repeating. A target stops at ``cap`` times the source's size; the
excess goes to the others by weight until none is above. A null text has no words and is never taken; sources without words
have target 0. Repeated rows and null ids are rows of their own; rows equal in everything are interchangeable. An empty table gives an
empty table. Columns other than id, text and source are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trisect.llm.tables import stored, stored_in_order, text_or_empty
from trisect.session import lookup

WEIGHTS = (1, 2, 3)
GROUPS = 1024
# numpy draws from up to 1e9 items; blocks are doubled until there are fewer.
MOST_DRAWS = 1 << 28
BUCKET_DOCUMENTS = 4096
CHUNK = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"


def sized(documents: DataFrame, source: str, id_column: str, text: str) -> DataFrame:
    """(doc_id, source, size, tie): words of every text, and the hash that orders it within its source."""
    named = documents.select(
        F.col(id_column).alias("doc_id"), F.col(source).cast("string").alias("source"), text_or_empty(text).alias("text")
    )
    tie = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), F.col("doc_id").cast("string"), F.xxhash64("text")), 1)
    return named.select("doc_id", "source", F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"), tie.alias("tie"))


def water_level(sources: DataFrame, cap: int) -> float:
    """The level at which ``least(cap * source_size, level * weight)`` adds up to all words; rises until no target is above its cap."""
    level, capped = 0.0, -1
    while True:
        above = F.col("source_size") * cap <= F.lit(level) * F.col("weight")
        above = above if capped >= 0 else F.lit(False)
        row = sources.agg(
            F.sum("source_size").alias("words"), F.sum(F.when(above, F.col("source_size") * cap)).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"), F.count_if(above).alias("capped"),
        ).first()
        if not row["weight"] or row["capped"] == capped:
            return level
        level, capped = (row["words"] - (row["held"] or 0)) / row["weight"], row["capped"]


def quotas(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = 3, block_words: int = 1024
) -> tuple[DataFrame, int]:
    """One row per source with its target, blocks and draws, and the words of a block.

    ``draws`` is the source's exact quota; the last of them takes ``last_words`` words. ``group`` and ``group_from`` say where its
    draws stand among those it shares a group with.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("n_documents"))
    placed = stored_in_order(sums, [F.asc_nulls_last("source")], "sources")
    part = F.shiftrightunsigned("place", 33)
    before = placed.groupBy(part.alias("part")).count().select(
        "part", F.coalesce(F.sum("count").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    ranked = placed.withColumn("part", part).join(lookup(before), "part").withColumn(
        "rank", F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    )
    cycle = F.array(*map(F.lit, weights))
    ranked = ranked.select(
        "rank", "source", "source_size", "n_documents",
        F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"),
    )
    ranked = lookup(ranked)
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.count(F.lit(1))).first()
    while total[0] / block_words + 4 * total[1] > MOST_DRAWS and block_words < total[0]:
        block_words *= 2
    level = water_level(ranked, cap)
    size, block = F.col("source_size"), F.lit(block_words).cast("long")
    made = ranked.withColumn("target", F.least((size * cap).cast("double"), F.col("weight") * F.lit(level)))
    made = made.withColumn("words", F.least(F.round("target").cast("long"), size * cap))
    made = made.withColumns({
        "n_blocks": F.ceil(size / block), "passes": F.when(size > 0, F.expr("words div source_size")).otherwise(0),
    })
    made = made.withColumn("rest", F.col("words") - F.col("passes") * size)
    made = made.withColumn("rest_draws", F.ceil(F.col("rest") / block))
    made = made.withColumns({
        "draws": F.col("passes") * F.col("n_blocks") + F.col("rest_draws"),
        "last_words": F.when(F.col("rest") > 0, F.col("rest") - (F.col("rest_draws") - 1) * block),
        "group": F.col("rank") % GROUPS,
    })
    earlier = W.partitionBy("group").orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
    made = made.withColumn("group_from", F.coalesce(F.sum("draws").over(earlier), F.lit(0)))
    made = made.withColumn("group_draws", F.sum("draws").over(W.partitionBy("group")))
    # Stored without a broadcast hint, which would pass on to the draws that are made from it.
    return stored(made.drop("rest", "rest_draws", "passes", "words"), "quotas"), block_words


def permuted(index: np.ndarray, n: int, *key: int) -> np.ndarray:
    """A bijection of 0..n-1 chosen by the key: a four-round Feistel network, walked until it is back in range."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 1 << 63, 4, dtype=np.uint64) | np.uint64(1)

    def turn(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * k
            left, right = right, left ^ ((mixed >> np.uint64(32)) & low)
        return (left << np.uint64(half)) | right

    out = turn(index.astype(np.uint64))
    outside = np.flatnonzero(out >= n)
    while len(outside):
        out[outside] = turn(out[outside])
        outside = outside[out[outside] >= n]
    return out.astype(np.int64)


DRAWS = "rank long, group long, position long, block long, words long"


def source_draws(sources: DataFrame, block_words: int, seed: int) -> DataFrame:
    """Every draw of every source: its position in the group's permuted order, its block and how many of the block's words it takes."""
    chunks = sources.where("draws > 0").select(
        "rank", "source_size", "n_blocks", "draws", "last_words", "group", "group_from", "group_draws",
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(draws - 1) div {CHUNK}"))).alias("chunk"),
    ).repartition("rank", "chunk")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                draw = np.arange(row["chunk"] * CHUNK, min(row["draws"], (row["chunk"] + 1) * CHUNK))
                round_, at = np.divmod(draw, row["n_blocks"])
                end = row["n_blocks"] - 1
                block = np.full(len(draw), end)
                for r in np.unique(round_):
                    chosen = np.flatnonzero((round_ == r) & (at < end))
                    block[chosen] = permuted(at[chosen], end, seed, row["rank"], int(r)) if len(chosen) else 0
                words = np.where(block == end, row["source_size"] - end * block_words, block_words)
                if row["last_words"] is not None:
                    words[draw == row["draws"] - 1] = row["last_words"]
                position = permuted(row["group_from"] + draw, row["group_draws"], seed, row["group"])
                same = [np.full(len(draw), row[c], np.int64) for c in ("rank", "group")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (*same, position, block, words)], names=["rank", "group", "position", "block", "words"]
                )

    return chunks.mapInArrow(run, DRAWS)


def split_tree(counts: np.ndarray, shards: int, first: int, last: int, seed: int):
    """(shard, where each group's draws begin, how many it takes) for the shards from ``first`` to before ``last``."""
    total = int(counts.sum())

    def below(shard: int) -> int:
        return shard * total // shards

    todo = [(0, shards, counts, np.zeros_like(counts))]
    while todo:
        a, b, held, begin = todo.pop()
        if b <= first or a >= last:
            continue
        if b - a == 1:
            yield a, begin, held
            continue
        middle = (a + b) // 2
        rng = np.random.default_rng([seed, a, b])
        left = rng.multivariate_hypergeometric(held, below(middle) - below(a), method="marginals")
        todo.append((middle, b, held - left, begin + left))
        todo.append((a, middle, left, begin))


def shard_positions(sources: DataFrame, shard_blocks: int, seed: int) -> DataFrame:
    """(group, position, shard): which shard takes which position of a group's permuted draws."""
    spark = sources.sparkSession
    held = {r["group"]: r["n"] for r in sources.groupBy("group").agg(F.sum("draws").alias("n")).collect()}
    groups = sorted(g for g, n in held.items() if n)
    counts = np.array([held[g] for g in groups], np.int64)
    shards = math.ceil(int(counts.sum()) / shard_blocks)

    def run(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for shard, begin, taken in split_tree(counts, shards, int(ids[0]), int(ids[-1]) + 1, seed) if len(ids) else ():
                some = np.flatnonzero(taken)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(groups)[some]), pa.array(begin[some]), pa.array(taken[some]),
                     pa.array(np.full(len(some), shard))],
                    names=["group", "begin", "taken", "shard"],
                )

    table = spark.range(shards).mapInArrow(run, "group long, begin long, taken long, shard long")
    places = F.explode(F.sequence("begin", F.col("begin") + F.col("taken") - 1))
    return table.select("group", places.alias("position"), "shard")


def block_draws(sources: DataFrame, block_words: int, shard_blocks: int = 256, seed: int = 11) -> DataFrame:
    """(shard, place, rank, block, words): the mix as an ordered list of blocks per shard."""
    # Both sides grow out of a few rows, so that the optimizer would take them for small and broadcast one.
    drawn = source_draws(sources, block_words, seed).hint("merge").join(
        shard_positions(sources, shard_blocks, seed), ["group", "position"]
    )
    local = W.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "group", "position"), "group", "position")
    return drawn.select("shard", F.row_number().over(local).alias("place"), "rank", "block", "words")


def positions(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """The rows with their source's numbers and ``start``, their place on its line of words; null for rows without words."""
    digits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_documents") / BUCKET_DOCUMENTS))).cast("int")
    kept = lookup(sources.select("rank", F.col("source").alias("_source"), "source_size", "target", "n_documents"))
    table = rows.join(kept, F.col("source").eqNullSafe(F.col("_source"))).withColumn("digits", digits)
    table = table.withColumn("bucket", F.expr("shiftright(tie, 63 - digits)")).drop("_source", "n_documents", "digits")
    earlier = W.partitionBy("rank").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = table.groupBy("rank", "bucket").agg(F.sum("size").alias("held")).select(
        "rank", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before")
    )
    inside = W.partitionBy("rank", "bucket").orderBy("tie", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    table = table.join(sums, ["rank", "bucket"])
    start = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return table.withColumn("start", F.when(F.col("size") > 0, start)).drop("bucket", "before", "tie")


def taken_pieces(placed: DataFrame, draws: DataFrame, block_words: int) -> DataFrame:
    """(shard, place, rank, start, doc_id, first_word, length): the pieces of texts that each draw takes."""
    last = F.expr(f"(start + size - 1) div {block_words}")
    pieces = placed.where("start IS NOT NULL").select(
        "doc_id", "rank", "start", "size", F.explode(F.sequence(F.expr(f"start div {block_words}"), last)).alias("block")
    )
    low = F.col("block") * block_words
    begin, end = F.greatest("start", low), F.least(F.col("start") + F.col("size"), low + F.col("words"))
    joined = pieces.join(draws, ["rank", "block"])
    return joined.select(
        "shard", "place", "rank", "start", "doc_id", (begin - F.col("start")).alias("first_word"), (end - begin).alias("length")
    ).where("length > 0")


def mix(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = 3, block_words: int = 1024, shard_blocks: int = 256,
    seed: int = 11, source: str = "source", id_column: str = "doc_id", text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The placed rows, and the pieces of them that make up the mix, by shard and place."""
    rows = stored(sized(documents, source, id_column, text), "sizes")
    sources, block_words = quotas(rows, weights, cap, block_words)
    placed = stored(positions(rows, sources), "positions")
    draws = stored(block_draws(sources, block_words, shard_blocks, seed), "draws")
    return placed, taken_pieces(placed, draws, block_words)


def taken(documents: DataFrame, **parameters) -> DataFrame:
    """One row per document: its size, its source's size and target, and how many of its words the mix takes."""
    placed, pieces = mix(documents, **parameters)
    sums = pieces.groupBy("rank", "start").agg(F.sum("length").alias("taken"), F.countDistinct("shard").alias("n_shards"))
    return placed.join(sums, ["rank", "start"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "source",
        F.coalesce("n_shards", F.lit(0).cast("long")).alias("n_shards"),
    )
