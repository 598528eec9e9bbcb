from collections import Counter

import pytest

from trisect.operators import cross_checks as rules

PARENTS = "id long, part string, total double"
CHILDREN = "pid long, part string, amount double, colour string"


@pytest.fixture(scope="module")
def tables(spark):
    parents = [(1, "a", 30.0), (2, "a", 5.0), (3, "b", None), (4, "b", 0.0), (None, "b", 1.0), (5, "a", 7.0)]
    children = [(1, "a", 10.0, "red"), (1, "a", 20.0, "red"), (2, "a", 4.0, "red"), (2, "a", None, "blue"), (2, "a", 0.5, None),
                (9, "a", 1.0, "red"), (9, "a", 1.0, "red"), (8, "b", 1.0, "red"), (None, "a", 1.0, "red"), (5, "b", 7.0, "red")]
    return spark.createDataFrame(parents, PARENTS).repartition(3), spark.createDataFrame(children, CHILDREN).repartition(3)


def row(table):
    r = table.first()
    return r.checked, r.violations, r.offenders, r.passed, [(s.key, s.n) for s in r["sample"]]


def test_references(tables):
    parents, children = tables
    assert row(rules.refers_to("x", children, ["pid"], parents, ["id"])) == (9, 3, 2, False, [("9", 2), ("8", 1)])
    two = rules.refers_to("x", children, ["pid", "part"], parents, ["id", "part"], samples=2)
    assert row(two) == (9, 4, 3, False, [("9|a", 2), ("5|b", 1)])
    assert row(rules.refers_to("x", parents, ["part"], children, ["part"])) == (6, 0, 0, True, [])


def test_dependencies(tables):
    _, children = tables
    assert row(rules.determines("x", children, ["pid"], ["colour"])) == (9, 2, 1, False, [("2", 2)])
    assert row(rules.determines("x", children, ["pid"], ["part"])) == (9, 0, 0, True, [])
    assert row(rules.determines("x", children, ["part"], ["colour", "pid"]))[1:3] == (7, 2)


def test_children(tables):
    parents, children = tables
    assert row(rules.has_children("x", parents, ["id"], children, ["pid"])) == (5, 2, 2, False, [("3", 1), ("4", 1)])
    assert row(rules.has_children("x", parents, ["id"], children, ["pid"], 0, 1)) == (5, 3, 2, False, [("2", 2), ("1", 1)])


def test_totals(tables):
    parents, children = tables
    found = rules.adds_up("x", parents, ["id"], "total", children, ["pid"], "amount", tolerance=0.4)
    assert row(found) == (5, 2, 2, False, [("2", 1), ("3", 1)])
    assert row(rules.adds_up("x", parents, ["id"], "total", children, ["pid"], "amount", tolerance=0.5))[1] == 1


def test_a_hot_key_and_random_tables(spark):
    child = spark.range(20_000).selectExpr("IF(id % 3 = 0, 7, id % 1000) AS k", "id % 4 AS v")
    parent = spark.range(500).selectExpr("id AS p")
    counts = Counter(7 if i % 3 == 0 else i % 1000 for i in range(20_000))
    bad = {k: n for k, n in counts.items() if k >= 500}
    found = rules.refers_to("x", child, ["k"], parent, ["p"]).first()
    assert (found.checked, found.violations, found.offenders) == (20_000, sum(bad.values()), len(bad))
    values = Counter((7 if i % 3 == 0 else i % 1000, i % 4) for i in range(20_000))
    most = Counter()
    for (k, _), n in values.items():
        most[k] = max(most[k], n)
    assert rules.determines("x", child, ["k"], ["v"]).first().violations == sum(counts[k] - most[k] for k in counts)


def test_nothing(spark, tables):
    parents, children = (t.where("false") for t in tables)
    every = rules.report(
        rules.refers_to("a", children, ["pid"], parents, ["id"]), rules.determines("b", children, ["pid"], ["part"]),
        rules.has_children("c", parents, ["id"], children, ["pid"]), rules.adds_up("d", parents, ["id"], "total", children, ["pid"], "amount"),
    ).collect()
    assert [(r.subject, r.checked, r.violations, r.passed, r["sample"]) for r in every] == [(s, 0, 0, True, []) for s in "abcd"]
    assert row(rules.refers_to("x", tables[1], ["pid"], parents, ["id"]))[:3] == (9, 9, 5)
