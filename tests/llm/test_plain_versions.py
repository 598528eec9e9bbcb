"""Whole query results against plain versions that work text by text."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from llm.conftest import SF
from llm.test_duplicates import groups_plainly
from llm.test_rules_chat_secrets import measured_plainly

import corpus_pipeline
from trisect.llm import quality_mil, rule_ledger, secret_forest, toxicity_cnn
from trisect.llm.hashed_words import word_features
from trisect.llm.queries import QUERIES
from trisect.llm.tables import read


def logistic(x):
    return 1 / (1 + np.exp(-x))


def word_vector(rows, piece):
    slots, _ = word_features([piece])
    return rows[slots].astype(float).mean(axis=0)


def toxicity_plainly(model, text):
    """Every filter at every place, one at a time; beyond the end words answer nothing."""
    pieces = (text or "").split() or [""]
    vectors = [word_vector(model.p["rows"], p) if p else np.zeros(toxicity_cnn.DIMENSIONS) for p in pieces]
    vectors += [np.zeros(toxicity_cnn.DIMENSIONS)] * max(toxicity_cnn.WIDTHS)
    pooled, tap = [], 0
    for k, width in enumerate(toxicity_cnn.WIDTHS):
        best = [sum(vectors[a + j] @ model.p["taps"][tap + j] for j in range(width)) for a in range(len(pieces))]
        pooled.append(np.max(best, axis=0) + model.p["bias"][k * toxicity_cnn.FILTERS : (k + 1) * toxicity_cnn.FILTERS])
        tap += width
    raw = np.maximum(np.concatenate(pooled), 0) @ model.p["out"] + model.p["shift"][0]
    return logistic(model.slope * raw + model.base)


def toxic_plainly(model, row):
    return toxicity_plainly(model, row.text) >= model.by_language.get(row.lang, model.threshold)


def quality_plainly(model, text):
    """Passages of 64 words, encoded, weighed by gated attention, scored."""
    pieces, p = (text or "").split() or [""], model.p
    states, logits = [], []
    for begin in range(0, len(pieces), quality_mil.PASSAGE):
        part = pieces[begin : begin + quality_mil.PASSAGE]
        vector = np.mean([word_vector(p["rows"], x) for x in part], axis=0)
        shapes = quality_mil.word_shapes(part).astype(float).mean(axis=0)
        same = sum(a == b for a, b in zip(part, part[1:])) / len(part)
        h = np.tanh(np.concatenate([vector, shapes, [same, len(part) / quality_mil.PASSAGE]]) @ p["encode"] + p["encode_shift"])
        states.append(h)
        logits.append((np.tanh(h @ p["tanh"]) * logistic(h @ p["gate"])) @ p["attend"])
    weights = np.exp(np.array(logits) - max(logits))
    z = (np.array(states) * (weights / weights.sum())[:, None]).sum(axis=0)
    return logistic(model.slope * (z @ p["out"] + p["shift"][0]) + model.base)


@pytest.mark.parametrize("name,module,plainly", [
    ("op6_toxicity_cnn", toxicity_cnn, toxicity_plainly), ("op8_quality_mil", quality_mil, quality_plainly)
])
def test_scores_equal_plain_ones(spark, documents, name, module, plainly):
    model = module.fit(documents, read(spark, SF, "labels"))
    expected = {r.doc_id: plainly(model, r.text) for r in documents.collect()}
    found = {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}
    assert found.keys() == expected.keys()
    assert max(abs(found[k].score - expected[k]) for k in expected) < 1e-4
    assert all(r.predicted == int(expected[k] >= 0.3) for k, r in found.items() if abs(expected[k] - 0.3) > 1e-3)


@pytest.mark.parametrize("name,target,size,recall", [("op6_toxicity_cnn", "toxic", "0.1", 0.9), ("op8_quality_mil", "quality", "0.01", 0.9)])
def test_held_out_labels_of_a_given_table(spark, name, target, size, recall):
    folder = SF.replace("0.001", size)
    rows = QUERIES[name](spark, folder).join(read(spark, folder, "labels"), "doc_id").where("held_out").collect()
    hits = sum(r.predicted and r[target] for r in rows)
    called, there = sum(r.predicted for r in rows), sum(r[target] for r in rows)
    assert there > 10 and hits >= recall * there and hits >= 0.9 * called


def described_plainly(text, source, dictionary):
    """(start, value, features) of every candidate, with Python's own regular expressions."""
    out, found = [], list(re.finditer(secret_forest.CANDIDATE, text))
    words = set(dictionary)
    for i, m in enumerate(found):
        value, n = m[0], len(m[0])
        before = text[found[i - 1].start() if i else 0 : m.start()][-secret_forest.NEAR :]
        after = text[m.end() : found[i + 1].start() if i + 1 < len(found) else len(text)][: secret_forest.NEAR]
        share = lambda kept: sum(c in kept for c in value) / n  # noqa: B023, E731
        digits, upper, lower = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
        shape = "".join("a" if c in lower else "A" if c in upper else "9" if c in digits else "-" for c in value)
        known = sum(len(r) for r in re.findall("[a-z]{3,}", value.lower()) if r in words)
        last = re.search(r"([A-Za-z]{3,})[^A-Za-z]*$", before)
        features = {
            "length": n, "digits": share(digits), "uppers": share(upper), "lowers": share(lower),
            "symbols": 1 - share(digits + upper + lower), "transitions": sum(a != b for a, b in zip(shape, shape[1:])) / n,
            "distinct": len(set(value)) / n, "hexes": share("0123456789abcdef"), "covered": known / n, "vowels": share("aeiouAEIOU"),
            "secret_word": bool(re.search(secret_forest.SECRET_WORD, before)), "assigned": bool(re.search(r"[=:]\s*[\"']?$", before)),
            "quoted": before[-1:] in ("'", '"') and before != "", "test_path": bool(re.search(secret_forest.TEST_PATH, source or "")),
            "at_sign": "@" in value, "dots": value.count("."), "right_quote": after[:1] in ("'", '"') and after != "",
            "left_known": bool(last) and last[1].lower() in words,
        }
        features["label"] = format_plainly(value, before, after, features)
        out.append((m.start(), value, features))
    return out


def format_plainly(value, before, after, features):
    """1 or 0 where a known format settles it, else None."""
    letters = len(re.sub("[^A-Za-z]", "", value))
    named = re.search(secret_forest.NAMED_QUOTE, before) and after[:1] in tuple("\"'`") and after != ""
    if re.search(secret_forest.KEY_FORMAT, value):
        return 1
    if re.search(secret_forest.HARMLESS, value):
        return 0
    if re.search(secret_forest.OPAQUE, value) and re.search(secret_forest.ASSIGNED, before) or named and len(value) >= 8:
        return 1
    if not re.search("[0-9]", value) and not features["secret_word"] and letters and round(features["covered"] * len(value)) == letters:
        return 0
    return None


def votes_plainly(forest, features):
    if not forest.trees:
        return float(features["label"] or 0)

    def vote(tree):
        while isinstance(tree, tuple):
            at, limit, low, high = tree
            tree = low if features[secret_forest.FEATURES[at]] <= limit else high
        return tree

    return sum(map(vote, forest.trees)) / len(forest.trees)


def findings_plainly(forest, text, source):
    return [(start, value, votes_plainly(forest, f)) for start, value, f in described_plainly(text or "", source, forest.dictionary)]


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_findings_equal_plain_ones(spark, size):
    folder = SF.replace("0.001", size)
    documents = read(spark, folder, "documents")
    forest = secret_forest.fit(documents)
    assert bool(forest.trees) == (size == "0.01")
    expected = {}
    for r in documents.collect():
        for start, value, score in findings_plainly(forest, r.text, r.source):
            expected[r.doc_id, start] = (len(value), hashlib.sha256(value.encode()).hexdigest(), score, score > 0.5)
    found = {(r.doc_id, r.start): (r.length, r.value_sha256, r.score, r.is_secret) for r in QUERIES["op5_secret_forest"](spark, folder).collect()}
    assert found.keys() == expected.keys()
    wrong = [k for k in expected if found[k][:2] != expected[k][:2] or abs(found[k][2] - expected[k][2]) > 1e-9]
    assert not wrong


def test_planted_secrets_are_found(spark):
    """Precision and recall on secrets of known kinds among numbers, dates, addresses and long words."""
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
    random_key = lambda n: "".join(rng.choice(letters, n))
    plain = ["the report of 2024-01-05 came late", "call 030-555-0199 now", "write to jane.doe@example.org today",
             "internationalization of responsibilities", "version 10.0.19045 is out", "see section 12.3.4.5 of it"]
    rows, secret = [], {}
    for i in range(600):
        parts = [plain[int(k)] for k in rng.integers(0, len(plain), 3)]
        if i % 4 == 0:
            key = ["AKIA" + "".join(rng.choice(letters[26:], 16)), "ghp_" + random_key(36), random_key(24) + "7a"][i // 4 % 3]
            parts.insert(int(rng.integers(0, 3)), ["key AWS {}", "use {} there", 'api_key = "{}"'][i // 4 % 3].format(key))
            secret[i] = key
        rows.append((i, " ; ".join(parts)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = secret_forest.scan(table, secret_forest.fit(table, min_documents=5)).collect()
    called = {(r.doc_id, f.value) for r in found for f in r.findings if f.is_secret}
    hits = called & set(secret.items())
    assert len(hits) >= 0.98 * len(secret) and len(hits) >= 0.98 * len(called)
    # The same with a table of labelled findings, for the other half of the documents.
    marks = [(r.doc_id, f.start, (r.doc_id, f.value) in hits) for r in found for f in r.findings if r.doc_id < 300]
    labelled = spark.createDataFrame(marks, "doc_id long, start int, is_secret boolean")
    later = secret_forest.scan(table.where("doc_id >= 300"), secret_forest.fit(table, labelled, min_documents=5)).collect()
    called = {(r.doc_id, f.value) for r in later for f in r.findings if f.is_secret}
    wanted = {k for k in secret.items() if k[0] >= 300}
    assert len(called & wanted) >= 0.98 * len(wanted) and len(called & wanted) >= 0.98 * len(called)


def test_pipeline_equals_plain_stages(spark, documents, library):
    """Each stage again on the rows the plain stage before has kept; at the end the ids of every piece."""
    rows = documents.collect()
    model = toxicity_cnn.fit(documents, read(spark, SF, "labels"))
    rows = [r for r in rows if not toxic_plainly(model, r)]
    policy = rule_ledger.POLICIES[rule_ledger.CURRENT]

    def failed(text):
        values = measured_plainly(text)
        return any(
            eval(rule.replace("AND", "and").replace("OR", "or"), {}, values)
            for name, rule in rule_ledger.RULES if rule_ledger.BIT[name] & policy
        )

    rows = [r for r in rows if not failed(r.text)]
    groups, _ = groups_plainly([(r.doc_id, r.text) for r in rows])
    heads = {least for _, least, _ in groups}
    rows = [r for r in rows if r.doc_id in heads]
    forest = secret_forest.fit(spark.createDataFrame(rows, documents.schema))
    expected = {}
    for r in rows:
        text = r.text
        for start, value, score in reversed(findings_plainly(forest, text, r.source)):
            if score > 0.5:
                text = text[:start] + secret_forest.MASK + text[start + len(value) :]
        expected[r.doc_id] = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
    pieces = {}
    found = corpus_pipeline.run(spark, SF).collect()
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == expected.keys()
    for doc_id, ids in expected.items():
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    places = sorted((r.sequence_id, r.offset, r.length) for r in found)
    assert all(a[0] != b[0] or a[1] + a[2] == b[1] for a, b in zip(places, places[1:])) and all(p[1] + p[2] <= 2048 for p in places)
