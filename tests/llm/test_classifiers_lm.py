import math
import pickle
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import SF
from pyspark.sql import functions as F

from trisect.llm import context_mixing, quality_mil, toxicity_cnn
from trisect.llm.hashed_words import best_threshold, word_features
from trisect.llm.queries import QUERIES


@pytest.fixture(scope="module")
def marked(spark):
    """Documents with a clear sign of each label, in two languages."""
    rng = np.random.default_rng(0)
    words = ["the", "and", "house", "river", "garden", "slowly", "walks", "blue", "morning", "letter", "table", "und", "haus"]
    rows, labels = [], []
    for i in range(400):
        text = rng.choice(words, rng.integers(8, 120)).tolist()
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.7)
        if toxic:
            text[int(rng.integers(len(text)))] = "grumble" + str(rng.choice(["ing", "ed", "er"]))
        if not good:
            text = [t + " |" for t in text]
        rows.append((i, " ".join(text), ["en", "de"][i % 2]))
        labels.append((i, good, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"
    )


@pytest.mark.parametrize("module,target,divisor,held_out", [(toxicity_cnn, "toxic", 4, 2), (quality_mil, "quality", 5, 0)])
def test_classifiers_learn(marked, hard, nothing, module, target, divisor, held_out):
    documents, labels = marked
    model = module.fit(documents, labels)
    scored = module.score(documents.withColumn("score", F.lit("clash")), model).join(labels, "doc_id").collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % divisor == held_out]
    assert np.mean([(r.score >= 0.3) == bool(r[target]) for r in held]) > 0.93
    # A score depends on the text alone.
    rows = module.score(hard, model).select("text", "score").distinct().collect()
    assert len(rows) == hard.select("text").distinct().count() and all(0 <= r.score <= 1 for r in rows)
    assert module.score(nothing, model).count() == 0
    # Held-out labels are not learned from.
    others = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor != held_out)
    again = module.fit(documents, others)
    assert all((again.p[k] == model.p[k]).all() for k in model.p)


def test_classifiers_without_labels(marked, nothing):
    documents, labels = marked
    none = toxicity_cnn.fit(nothing, labels)
    assert toxicity_cnn.score(documents, none).where("toxic").count() == 0
    assert toxicity_cnn.keep_clean(documents, none).columns == documents.columns
    good = quality_mil.fit(documents, labels.where("quality = 1"))
    assert quality_mil.score(documents, good).where("score < 0.3").count() == 0


def test_word_features_are_the_same_in_any_company():
    flat, at = word_features(["Idiots,", "x", "", "Idiots,"])
    assert flat[at[0] : at[1]].tolist() == flat[at[3] : at[4]].tolist() and (np.diff(at) > 0).all()
    assert set(word_features(["idiot"])[0][1:].tolist()) <= set(flat[at[0] : at[1]].tolist())


def test_best_threshold():
    score, label = np.array([0.1, 0.2, 0.8, 0.9]), np.array([0, 0, 1, 1])
    assert best_threshold(score, label, np.ones(4)) == 0.5


def test_attention_is_a_weighted_mean():
    model = quality_mil.QualityModel()
    features, bags = quality_mil.Passages(model.p["rows"]).of(["w " * 200, "", "short text"])
    raw, (h, _, _, a, z) = model.forward(features, bags)
    assert bags.tolist() == [0, 4, 5, 6] and np.allclose(np.add.reduceat(a, bags[:-1]), 1, atol=1e-5) and len(raw) == 3
    assert np.allclose(z[0], (h[:4] * a[:4, None]).sum(axis=0), atol=1e-5)


@pytest.mark.parametrize("query,divisor,held_out", [("op6_toxicity_cnn", 4, 2), ("op8_quality_mil", 5, 0)])
def test_queries_return_every_document(spark, documents, query, divisor, held_out):
    found = QUERIES[query](spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in documents.collect())
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % divisor == held_out) and r.predicted == int(r.score >= 0.3)


def base_plainly(rows):
    """doc_id, text -> n_tokens, n_known, N, base score, with repeated ids allowed."""
    words = [(i, (t or "").encode().lower().split()) for i, t in rows]
    counts, ends = Counter(), 0
    for i, w in words:
        if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2:
            counts.update(w)
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = []
    for i, w in words:
        base = sum(math.log10(counts[x] + 1) for x in w) + math.log10(ends + 1) - (len(w) + 1) * math.log10(n + v + 1)
        out.append((i is None, i or 0, len(w) + 1, sum(counts[x] > 0 for x in w) + (ends > 0), n, round(base, 6)))
    return sorted(out)


def test_op1(spark, documents, hard, nothing):
    found = QUERIES["op1_context_mixing"](spark, SF).collect()
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    shown = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert shown == base_plainly(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


@pytest.mark.parametrize("head_words", [0, 10])
def test_lm_edges(hard, nothing, head_words):
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    found = context_mixing.score(hard, held_out, head_words=head_words, head_pieces=head_words).collect()
    shown = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert shown == base_plainly([(r.doc_id, r.text) for r in hard.collect()])
    assert context_mixing.score(nothing, held_out).count() == 0


def counted():
    pieces = [b"the ", b"then ", b"thing\xff", b"a ", b"\xff"]
    code = context_mixing.Code(np.bincount(np.frombuffer(b"".join(pieces), np.uint8), minlength=256))
    table = np.zeros((context_mixing.SLOTS, 3), np.uint16)
    bits = context_mixing.Bits(pieces, code)
    for k in range(len(context_mixing.ORDERS)):
        np.add.at(table, (bits.slot[k], 1 + bits.bit), 3)
        table[bits.slot[k], 0] = bits.check[k]
    return table, code, pieces


def test_mixed_probabilities_sum_to_one():
    table, code, _ = counted()
    mix = context_mixing.Mixer(context_mixing.Predictions(table), code)
    # All continuations of "th" by one byte: the probability of a piece is a product over bytes.
    whole = np.exp(mix.log_probabilities([b"th"]))[0]
    longer = np.exp(mix.log_probabilities([b"th" + bytes([b]) for b in range(256)])).sum()
    assert longer == pytest.approx(whole, rel=1e-4)


def test_learning_lowers_the_cost():
    """The cost of pieces that are predicted without their own occurrence."""
    table, code, pieces = counted()
    learner, bits = context_mixing.Mixer(table, code), context_mixing.Bits(pieces, code)

    def cost():
        x, evidence = learner.inputs_without_own(bits)
        logit = (learner.weights.ravel()[learner.gates(evidence)] * x).sum(axis=0)
        return np.logaddexp(0, np.where(bits.bit, -logit, logit)).sum()

    before = cost()
    for _ in range(50):
        learner.learn(pieces, np.full(len(pieces), 10))
    assert cost() < before


def test_adaptation_is_a_distribution():
    """Over all next pieces of a closed set of pieces the adapted probabilities sum to one."""
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.ones(6), 3).T
    past = [2, 2, 5, 0, 2]
    total = 0.0
    for piece in range(6):
        index = np.array([*past, piece])
        total += np.exp(context_mixing.adapted(np.log(p[index]), index, np.zeros(6, int), np.array([0]))[-1])
    assert total == pytest.approx(1, rel=1e-5)
    # Another document before it changes nothing.
    index = np.array([1, 3, *past])
    alone = context_mixing.adapted(np.log(p[past]), np.array(past), np.zeros(5, int), np.array([0]))
    both = context_mixing.adapted(np.log(p[index]), index, np.array([0, 0, 1, 1, 1, 1, 1]), np.array([0, 2]))
    assert np.allclose(alone, both[2:])


def test_rare_kinds_are_learned_from_all_texts(spark, nothing):
    common = [(f"red green blue red {'red ' * (i % 3)}x{i}",) for i in range(4000)]
    table = spark.createDataFrame(common + [("uno dos tres uno dos",)] * 4, "text string")
    pieces = [b"red ", b"green ", b"blue ", b"uno ", b"dos ", b"tres "]
    one, other = (context_mixing.find_kinds(table.repartition(n), pieces, 2).log_p for n in (2, 5))
    assert (one == other).all()
    # A text of the rare kind is likelier in one kind, and by far.
    rare = one[:, 3:].sum(axis=1)
    assert abs(rare[0] - rare[1]) > 3


def test_every_context_is_counted(spark, nothing):
    """Contexts seen once and contexts that meet in a slot are all in its counts, on any partitioning."""
    rng = np.random.default_rng(4)
    pieces = [b"%08x " % x for x in rng.integers(0, 1 << 32, 20_000)] + [b"the ", b"\xff"]
    n = np.append(rng.integers(1, 3, 20_000), [150_000, 7])
    code = context_mixing.Code(np.bincount(np.frombuffer(b"".join(pieces), np.uint8), minlength=256))
    rows = spark.createDataFrame(list(zip(map(bytearray, pieces), n.tolist(), strict=True)), "piece binary, n long").repartition(4)
    table = context_mixing.context_counts(rows, code).astype(np.int64)
    bits = context_mixing.Bits(pieces, code)
    expected = np.zeros((context_mixing.SLOTS, 2), np.int64)
    for k in range(len(context_mixing.ORDERS)):
        np.add.at(expected, (bits.slot[k], bits.bit), n[bits.piece])
    small = expected.max(axis=1) < 60_000
    assert (table[small, 1:3] + table[small, 3:] == expected[small]).all()
    assert (table[:, 3:].sum(axis=1) > 0).sum() > 1000 and (expected.sum(axis=1) == 1).sum() > 1000
    # The most frequent context of a slot has counts of its own, and its check.
    assert (table[:, 1:3].sum(axis=1) * 256 >= table[:, 3:].sum(axis=1)).all()


def test_packed_predictions_are_those_of_the_counts():
    table = np.zeros((4, 5), np.uint16)
    table[:, 0] = [7, 7, 9, 0]
    table[:, 1:] = [[3, 1, 0, 0], [0, 60_000, 5, 2], [60_000, 0, 0, 60_000], [0, 0, 0, 0]]
    x, evidence = context_mixing.Predictions(table).of(np.arange(4).repeat(2), np.array([7, 8, 7, 8, 9, 8, 0, 8]))
    counts = table[:, 1:].reshape(-1, 2).astype(np.float32)
    assert x == pytest.approx(context_mixing.stretched(counts[:, 0], counts[:, 1]), abs=0.0601)
    own = context_mixing.evidence_of(counts[:, 0], counts[:, 1])
    assert evidence.tolist() == [int(e) + (i % 2) * context_mixing.EVIDENCE for i, e in enumerate(own)]


def test_tables_are_shipped_small_and_whole():
    """A sparse table takes little room in a broadcast, and comes back as it was."""
    table, code, pieces = counted()
    table = np.concatenate([table, table[:, 1:] // 2], axis=1)
    table[:1000, 1:] = np.random.default_rng(3).integers(0, 1 << 16, (1000, 4))
    shipped = pickle.dumps(context_mixing.Shipped(table))
    again = pickle.loads(shipped).array
    assert again.dtype == table.dtype and (again == table).all()
    assert len(shipped) < table.nbytes / 50
    predictions = context_mixing.Predictions(table)
    small = pickle.dumps(predictions)
    assert len(small) < predictions.packed.nbytes / 50 and (pickle.loads(small).packed == predictions.packed).all()
    one, other = (context_mixing.Mixer(t, code).log_probabilities(pieces) for t in (predictions, pickle.loads(small)))
    assert (one == other).all()


def test_a_task_counts_contexts_in_bounded_memory():
    """What a task of many different pieces holds at once, its arrays taken together."""
    class Pieces:
        def repartitionByRange(self, *_):
            return self

        sortWithinPartitions = repartitionByRange

        def mapInArrow(self, run, _):
            raise StopIteration(run)

    rng = np.random.default_rng(5)
    pieces = [b"%012x " % x for x in rng.integers(0, 1 << 48, 120_000)]
    code = context_mixing.Code(np.bincount(np.frombuffer(b"".join(pieces), np.uint8), minlength=256))
    with pytest.raises(StopIteration) as caught:
        context_mixing.context_counts(Pieces(), code)
    batches = [
        pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array(np.ones(len(part), np.int64))], names=["piece", "n"])
        for part in (pieces[a : a + 10_000] for a in range(0, len(pieces), 10_000))
    ]
    tracemalloc.start()
    bits = 0
    for batch in caught.value.value(batches):
        for column in ("zeros", "ones"):
            for values, places in zip(batch.column(column).to_pylist(), batch.column("places").to_pylist(), strict=True):
                bits += int(context_mixing._long(values, len(places) // 4).sum())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert bits == len(context_mixing.ORDERS) * code.length[np.frombuffer(b"".join(pieces), np.uint8)].sum()
    assert peak < 260 * 2**20


def test_the_driver_holds_tables_packed(spark, nothing):
    """Counts and predictions of all slots pass the driver in little room, and are the same as from the whole table."""
    rng = np.random.default_rng(6)
    pieces = [(bytearray(b"%06x " % x), int(x % 5) + 1) for x in rng.integers(0, 1 << 24, 20_000)]
    code = context_mixing.Code(np.bincount(np.frombuffer(b"".join(bytes(p) for p, _ in pieces), np.uint8), minlength=256))
    rows = spark.createDataFrame(pieces, "piece binary, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    tracemalloc.start()
    counts, predicted = context_mixing.counted_blocks(rows, code)
    shared = pickle.dumps(counts), pickle.dumps(predicted)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * context_mixing.SLOTS
    table = counts.opened()
    assert (table == context_mixing.context_counts(rows, code)).all() and table[:, 1:].any()
    assert (predicted.opened() == context_mixing.Predictions(table).packed).all()
    # Workers get arrays.
    assert (pickle.loads(shared[0]).array == table).all() and (pickle.loads(shared[1]).array == predicted.opened()).all()
    # Blocks without a context are empty, and predict so.
    del counts.blocks[0], predicted.blocks[0]
    assert not counts.opened()[: 1 << context_mixing.BLOCK_BITS].any()
    assert (predicted.opened() == context_mixing.Predictions(counts.opened()).packed).all()
