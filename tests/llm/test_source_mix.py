import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.conftest import SF
from pyspark.sql import functions as F

from trisect.llm import source_mix
from trisect.llm.queries import QUERIES


def targets_plainly(sizes):
    """Targets by resharing what is above three times a source's size until nothing is."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        share = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if share * weight[s] >= 3 * sizes[s]}
        if not above:
            return target | {s: share * weight[s] for s in open_}
        for s in above:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
        open_ -= above
    return target


def check(found, rows):
    size = Counter()
    for source, n in rows:
        size[source] += n
    target = targets_plainly(size)
    assert Counter((r.source, r.size) for r in found) == Counter(rows)
    taken = Counter()
    for r in found:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source], rel=1e-12, abs=1e-9)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in size)


def plain_rows(table):
    return [(r.source, len(re.findall(r"[^\x20\x09-\x0d]+", r.text or ""))) for r in table.collect()]


def test_op11(spark, documents):
    found = QUERIES["op11_hypergeometric_mix"](spark, SF).collect()
    check(found, plain_rows(documents))
    again = source_mix.taken(documents.repartition(7).withColumn("rank", F.lit("x"))).collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, found)) == sorted(map(key, again))


@pytest.mark.parametrize("block_words,shard_blocks,groups", [(1, 4, 1024), (7, 3, 2), (64, 1, 1)])
def test_hard_rows(spark, hard, monkeypatch, block_words, shard_blocks, groups):
    monkeypatch.setattr(source_mix, "GROUPS", groups)
    monkeypatch.setattr(source_mix, "BUCKET_DOCUMENTS", 2)
    monkeypatch.setattr(source_mix, "CHUNK", 5)
    table = hard.withColumn("source", F.expr("CASE WHEN doc_id % 5 = 4 THEN NULL ELSE concat('s', doc_id % 5) END"))
    table = table.withColumns({c: F.lit(1) for c in ("rank", "start", "size", "tie", "target", "block", "place")})
    check(source_mix.taken(table, block_words=block_words, shard_blocks=shard_blocks).collect(), plain_rows(table))


def test_shards_are_disjoint_and_exact(spark, documents):
    placed, pieces = source_mix.mix(documents, block_words=64, shard_blocks=16)
    placed = {(r.rank, r.start): r for r in placed.collect()}
    passes = defaultdict(Counter)
    shards = defaultdict(set)
    for p in pieces.collect():
        row = placed[p.rank, p.start]
        assert 0 <= p.first_word and p.first_word + p.length <= row.size and p.doc_id == row.doc_id
        for w in range(p.first_word, p.first_word + p.length):
            passes[p.rank][p.start + w] += 1
        shards[p.shard].add(p.place)
    # Every word of a source is taken as often as another, give or take one pass.
    for rank, words in passes.items():
        size = next(r.source_size for r in placed.values() if r.rank == rank)
        counts = [words[i] for i in range(size)]
        assert max(counts) - min(counts) <= 1
    # Every shard has the same number of draws, give or take one, numbered from 1.
    assert {max(places) - len(places) for places in shards.values()} == {0}
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert len(shards) > 8


def test_tree_is_hypergeometric_and_the_same_from_any_part():
    counts = np.array([50, 0, 30, 20])
    whole = list(source_mix.split_tree(counts, 7, 0, 7, 5))
    parts = [x for a in range(7) for x in source_mix.split_tree(counts, 7, a, a + 1, 5)]
    assert [x[0] for x in whole] == list(range(7))
    for x, y in zip(whole, parts, strict=True):
        assert x[0] == y[0] and (x[1] == y[1]).all() and (x[2] == y[2]).all()
    assert (sum(x[2] for x in whole) == counts).all()
    ends = np.zeros(4, np.int64)
    for _, begin, held in whole:
        assert (begin == ends).all()
        ends = begin + held
    first = np.array([next(source_mix.split_tree(counts, 10, 0, 1, seed))[2] for seed in range(2000)])
    assert np.allclose(first.mean(axis=0), counts / 10, atol=0.1)
    p, n, m = counts / 100, 10, 100
    assert np.allclose(first.var(axis=0), n * p * (1 - p) * (m - n) / (m - 1), rtol=0.12)


def test_permutations_are_bijections():
    for n in (1, 2, 3, 17, 64, 1000):
        seen = {tuple(source_mix.permuted(np.arange(n), n, key, n)) for key in range(3)}
        assert all(sorted(s) == list(range(n)) for s in seen) and (len(seen) == 3 or n < 17)


def test_nothing_and_no_words(spark, nothing):
    assert source_mix.taken(nothing).count() == 0
    empty = spark.createDataFrame([(1, " ", "a"), (None, None, None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in source_mix.taken(empty).collect()] == [(0, 0.0, 0)] * 2


def test_one_very_long_text_and_a_small_source(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "doc_id long, source string").withColumn(
        "text", F.when(F.col("doc_id") == 1, F.repeat(F.lit("word "), 300_000)).otherwise("two words")
    )
    found = {r.doc_id: (r.size, r.target, r.taken) for r in source_mix.taken(rows).collect()}
    assert found == {1: (300_000, 299_992.0, 299_992), 2: (2, 12.0, 6), 3: (2, 12.0, 6)}
