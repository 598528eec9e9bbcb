import gc
import itertools

import numpy as np
import pytest
from llm.conftest import SF
from pyspark.sql import functions as F

from trisect.llm import components, lattice_dedup, tables, weighted_minhash
from trisect.llm.components import connected_components
from trisect.llm.queries import QUERIES


def roots_plainly(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)] + [(50, 60), (60, 70), (61, 70)],
    [(int(a), int(b)) for a, b in np.random.default_rng(3).integers(0, 300, (200, 2))],
])
def test_components(spark, links):
    table = spark.createDataFrame(links, "a long, b long")
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.root for r in connected_components(table).collect()} == roots_plainly([x for x in links if x[0] != x[1]], nodes)


def test_nearest_points_are_nearest():
    x = np.random.default_rng(0).uniform(-2, 2, (500, 8))
    point = lattice_dedup.nearest_points(x) / 2
    distance = ((x - point) ** 2).sum(axis=1)
    other = ((x[:, None] - (point[:, None] + lattice_dedup.neighbours()[None])) ** 2).sum(axis=2)
    assert (distance <= other.min(axis=1) + 1e-9).all() and (distance <= 1 + 1e-9).all()
    assert lattice_dedup.neighbours().shape == (240, 8) and ((lattice_dedup.neighbours() ** 2).sum(axis=1) == 2).all()


def unit(v):
    v = np.array(v, float) / np.abs(v).max()
    return v / np.linalg.norm(v)


def links_plainly(rows):
    """Per row: links and the smallest id it reaches, by comparing everything."""
    good = [
        (k, i, label, unit(v)) for k, (i, v, label) in enumerate(rows)
        if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    pairs = [
        (a[0], b[0]) for a, b in itertools.combinations(good, 2) if a[2] == b[2] and len(a[3]) == len(b[3]) and a[3] @ b[3] >= 0.98
    ]
    n = [0] * len(rows)
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    root = roots_plainly(pairs, range(len(rows)))
    least = {}
    for k, r in root.items():
        least[r] = min(least.get(r, rows[k][0]), rows[k][0])
    return sorted((rows[k][0], n[k], least[root[k]], rows[k][0] == least[root[k]]) for k in range(len(rows)))


def vectors():
    rng = np.random.default_rng(4)
    rows = []
    number = itertools.count()
    for group in range(12):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 40))):
            noise = rng.normal(size=16)
            rows.append((next(number), (base + rng.uniform(0, 0.16) * noise).astype(float).tolist(), int(group % 3)))
    copy = rows[0]
    rows += [(next(number), copy[1], copy[2]) for _ in range(5)] + [(next(number), copy[1], 9), copy]
    rows += [
        (next(number), None, 1), (next(number), [], 1), (next(number), [0.0] * 16, 1), (next(number), [1.0, None], 1),
        (next(number), [float("nan")] * 16, 1), (next(number), [float("inf")] * 16, 1), (next(number), copy[1], None),
        (next(number), [1.0, 2.0, 3.0], 1), (next(number), [1.0, 2.0, 3.0], 1), (next(number), [2e200, 4e200, 6e200], 1),
        (next(number), [-0.0, 1.0], 1), (next(number), [0.0, 1.0], 1),
    ]
    return rows


@pytest.mark.parametrize("chunk", [1024, 7])
def test_vectors(spark, monkeypatch, hard, chunk):
    monkeypatch.setattr(lattice_dedup, "CHUNK", chunk)
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("kept", F.lit(1))
    found = lattice_dedup.near_duplicates(table.repartition(3)).collect()
    assert sorted(map(tuple, found)) == links_plainly(rows)
    assert lattice_dedup.near_duplicates(table.limit(0)).count() == 0


def test_op2(spark, documents):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, QUERIES["op2_lattice_dedup"](spark, SF).collect())) == links_plainly(rows)


def jaccard_plainly(a, b):
    keys = set(a) | set(b)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)


def groups_plainly(rows, common=0.5):
    """Group of each row by comparing all texts, with plain word tuples as shingles."""
    words = [tuple(w for w in (t or "").lower().replace("\n", " ").replace("\t", " ").split(" ") if w) for _, t in rows]
    bags = []
    for w in words:
        bag = {}
        for i in range(max(len(w) - 4, 1) if w else 0):
            bag[w[i : i + 5]] = bag.get(w[i : i + 5], 0) + 1
        bags.append(bag)
    df = {}
    for bag in bags:
        for k in bag:
            df[k] = df.get(k, 0) + 1
    n = len(rows)
    weigh = lambda k: 1.0 if df[k] <= common * n else max(np.log(n / df[k]) / np.log(1 / common), 0.75)
    bags = [{k: (1 + np.log(v)) * weigh(k) for k, v in bag.items()} for bag in bags]
    links = []
    for a, b in itertools.combinations(range(n), 2):
        same = words[a] == words[b] and (words[a] or rows[a][0] == rows[b][0])
        if same or (bags[a] and bags[b] and words[a] and words[b] and jaccard_plainly(bags[a], bags[b]) >= 0.8):
            links.append((a, b))
    root = roots_plainly(links, range(n))
    groups = {}
    for k, r in root.items():
        groups.setdefault(r, []).append(rows[k][0])
    largest = 10**9
    least = {r: min(largest if i is None else i for i in ids) for r, ids in groups.items()}
    return sorted(
        (largest if rows[k][0] is None else rows[k][0], least[root[k]], len(groups[root[k]])) for k in range(n)
    ), len(groups)


def near_copies():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    number = itertools.count()
    for _ in range(12):
        base = rng.choice(vocabulary, int(rng.integers(60, 300))).tolist()
        for _ in range(int(rng.integers(1, 9))):
            copy = list(base)
            for at in rng.integers(0, len(copy), int(rng.integers(0, max(len(copy) // 60, 1) + 1))):
                copy[at] = str(rng.choice(vocabulary))
            rows.append((next(number), " ".join(copy)))
    shared = " ".join(rng.choice(vocabulary, 60))
    rows += [(next(number), shared + " " + " ".join(rng.choice(vocabulary, 80))) for _ in range(10)]
    return rows


@pytest.mark.parametrize("rounds,chunk,per_pivot", [(2, 48, 2000), (0, 5, 3)])
def test_documents(spark, hard, monkeypatch, rounds, chunk, per_pivot):
    for name, value in (("PIVOT_ROUNDS", rounds), ("CHUNK", chunk), ("PER_PIVOT", per_pivot)):
        monkeypatch.setattr(weighted_minhash, name, value)
    table = spark.createDataFrame(near_copies(), "doc_id long, text string").unionAll(
        hard.where("doc_id IS NULL OR doc_id < 14 OR doc_id > 14").withColumn("doc_id", F.col("doc_id") + 1000).select("doc_id", "text")
    )
    rows = [tuple(r) for r in table.collect()]
    expected, groups = groups_plainly(rows)
    found = weighted_minhash.near_duplicates(table.withColumn("kept", F.lit("clash"))).collect()
    largest = 10**9
    shown = sorted(
        (largest if r.doc_id is None else r.doc_id, largest if r.class_id is None else r.class_id, r.class_size) for r in found
    )
    assert shown == expected and sum(r.kept for r in found) == groups
    kept = weighted_minhash.keep_one_each(table.withColumn("node", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "node"] and kept.count() == groups


def test_common_shingles_weigh_less(spark, hard):
    norms = spark.createDataFrame([("a b c d e " + x,) for x in ("f", "g", "h", "i")] + [("x y z q r",)], "norm string").repartition(3)
    shingle, share = weighted_minhash.common_shingles(norms, 0.5)
    assert share.tolist() == [0.8]
    assert shingle[0] == weighted_minhash.Shingler().shingles("a b c d e")[0]


@pytest.mark.parametrize("run_texts,part_shingles", [(2000, 1_000_000), (7, 20)])
def test_document_frequencies_are_those_of_all_documents(spark, hard, monkeypatch, run_texts, part_shingles):
    for name, value in (("RUN_TEXTS", run_texts), ("PART_SHINGLES", part_shingles)):
        monkeypatch.setattr(weighted_minhash, name, value)
    table = spark.createDataFrame(near_copies(), "doc_id long, text string").unionAll(hard.select("doc_id", "text"))
    texts = table.select(weighted_minhash.node_column().alias("node"), weighted_minhash.normalised().alias("norm")).collect()
    shingler = weighted_minhash.Shingler()
    own = {bytes(r.node): np.unique(shingler.shingles(r.norm)) for r in texts}
    plain = {}
    for r in texts:
        for s in own[bytes(r.node)]:
            plain[s] = plain.get(s, 0) + 1
    idf, vectors = weighted_minhash.fit_idf(table.repartition(3))
    found = vectors.collect()
    assert len(found) == len(texts) == idf.documents == len({r.row for r in found})
    assert all(r.held == [plain[s] for s in own[bytes(r.node)]] for r in found)
    assert all(len(r.buckets) == (weighted_minhash.BANDS if r.held else 0) for r in found)


def test_rarer_shingles_weigh_more():
    weight = weighted_minhash.Idf(1000).of(np.array([1, 2, 10, 100, 500, 1000]))
    assert (np.diff(weight) < 0).all() and weight[0] == 1 and weight[-1] == weighted_minhash.LEAST_IDF
    assert weighted_minhash.Idf(1).of(np.array([1])).tolist() == [1]


@pytest.mark.parametrize("copies,others", [(2, 0), (8, 0), (8, 4)])
def test_near_copies_that_fill_a_table(spark, hard, copies, others):
    base = [f"w{i}" for i in range(100)]
    # One word changed near the end of each: 90 of 100 and more shingles are shared by all.
    rows = [(i, " ".join([*base, f"own{i}"])) for i in range(copies)]
    rows += [(100 + i, " ".join(f"o{i}x{k}" for k in range(100))) for i in range(others)]
    found = weighted_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in found) == [(i, 0, copies) for i in range(copies)] + [
        (100 + i, 100 + i, 1) for i in range(others)
    ]


def test_no_documents(nothing):
    assert weighted_minhash.near_duplicates(nothing).count() == 0 and weighted_minhash.keep_one_each(nothing).count() == 0


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(6)
    shingle = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = shingle[:2000], shingle[200:2200]
    one, two = np.ones(2000), np.where(np.arange(2000) < 1000, 1.0, 2.0)
    order = weighted_minhash.borrow_order()
    keys = weighted_minhash.bands(np.concatenate([a, a, b]), np.concatenate([one, one, one]), np.repeat([0, 1, 2], 2000), 3, order)
    assert (keys[0] == keys[1]).all()
    expected = (1800 / 2200) ** weighted_minhash.ROWS
    assert abs((keys[0] == keys[2]).mean() - expected) < 0.25
    assert weighted_minhash.bands(a[:1], one[:1], np.zeros(1, int), 1, order).shape == (1, weighted_minhash.BANDS)
    assert two.sum() == 3000


def test_stars_take_no_round(spark, monkeypatch):
    """Links that are stars already are only looked at; a chain of three takes one round."""
    rounds = []
    star = components._small_star
    monkeypatch.setattr(components, "_small_star", lambda edges: rounds.append(1) or star(edges))
    for links, most in (([(1, i) for i in range(2, 30)] + [(40, 41)], 0), ([(1, 2), (2, 3)], 1)):
        rounds.clear()
        found = connected_components(spark.createDataFrame(links, "a long, b long"))
        nodes = {x for pair in links for x in pair}
        assert {r.node: r.root for r in found.collect()} == roots_plainly(links, nodes) and len(rounds) <= most


def test_trimming_does_not_walk_through_imports():
    tables.trim_worker()
    assert gc.get_freeze_count() > 0
