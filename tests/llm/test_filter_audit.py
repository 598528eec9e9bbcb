import re
from collections import Counter
from itertools import permutations

import numpy as np
from compare import differences, oracle_connection
from llm.conftest import SF
from pyspark.sql import functions as F

from trisect.llm import filter_audit
from trisect.llm.queries import ORACLE, QUERIES


def failed(rows):
    """The letters each row fails, plainly."""
    found = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0d]+", text)
        letters = "A" if len(words) < 200 else ""
        letters += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        letters += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
        letters += "D" if re.search(r"[#$%&*|]", text) else ""
        smaller = [r[0] for r in rows if r[0] is not None and (r[1] or "") == text]
        letters += "E" if doc_id is not None and min(smaller) < doc_id else ""
        found.append(letters)
    return found


def steps_plainly(rows, labels):
    quality = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    letters = failed(rows)
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], x) for r, x in zip(rows, letters, strict=True) if (r[2] or "") == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [d for d, x in left if f in x]
                left = [(d, x) for d, x in left if f not in x]
                out[part, order, step] = [
                    len(left), len(gone), sum(f in x for _, x in mine) - len(gone), sum(x == f for _, x in mine),
                    sum(d in quality for d in gone), sum(d in toxic for d in gone), f,
                ]
                shapley[f] += len(gone)
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return out


def test_audit_equals_plain_orders(spark, hard):
    rows = [(r.doc_id, r.text, r.lang) for r in hard.collect()]
    labels = [(0, 1, 0), (4, 1, 1), (4, 0, None), (5, None, 1), (None, 1, 1), (6, 1, 0), (19, 0, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    clash = hard.withColumns({c: F.lit("x") for c in ("part", "digest", "mask", "n", "words", "kept", "good", "toxic", "spread")})
    found = filter_audit.audit(clash, table).collect()
    expected = steps_plainly(rows, labels)
    assert len(found) == len(expected) == 120 * 5 * len({r[2] or "" for r in rows})
    for r in found:
        assert [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] == expected[
            r.part, r.filter_order, r.step
        ]


def test_gray_walk_equals_counting():
    rng = np.random.default_rng(3)
    for filters in (1, 3, 6):
        counts = rng.integers(0, 9, (1 << filters, 2))
        states = filter_audit.gray_walk(counts, filters)
        for subset in range(1 << filters):
            assert (states[subset] == counts[(np.arange(1 << filters) & subset) == 0].sum(axis=0)).all()


def test_audit_of_nothing_and_without_labels(spark, hard, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(nothing, labels).count() == 0
    assert filter_audit.audit(hard, labels).agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_many_copies_of_a_very_long_text(spark):
    words = " ".join(f"w{i}" for i in range(200_000))
    rows = spark.range(6).select(F.col("id").alias("doc_id"), F.lit(words).alias("text"), F.lit(None).cast("string").alias("lang"))
    labels = spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int")
    found = filter_audit.audit(rows, labels).where("filter_order = 'EABCD' AND step = 1").collect()
    assert [(r.part, r.kept, r.removed, r.unique_fails, r.good_lost, r.shapley) for r in found] == [("", 1, 5, 5, 1, 600)]


def test_op13_equals_its_twin(spark):
    oracle = oracle_connection(SF)
    name = "op13_gray_audit"
    assert differences(QUERIES[name](spark, SF).toPandas(), oracle.sql(ORACLE[name]).df()) is None
