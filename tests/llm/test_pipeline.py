import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import SF
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from trisect.llm import toxicity_cnn
from trisect.llm.queries import QUERIES
from trisect.llm.tables import read, with_columns


def test_stages_keep_columns_and_filter(spark, documents):
    docs = documents.withColumn("score", F.lit("extra")).withColumn("n_words", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        after = after.cache()
        assert 0 < after.count() <= docs.count()
        assert after.join(docs, "doc_id", "left_anti").count() == 0
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_run(spark, documents):
    kept = {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").distinct().collect()}
    model = toxicity_cnn.fit(documents, read(spark, SF, "labels"))
    clean = {r.doc_id for r in toxicity_cnn.score(documents, model).where("NOT toxic").collect()}
    assert kept and kept <= clean


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_hard_and_empty_tables(spark, hard, nothing, name, stage):
    assert stage(spark, nothing, SF).count() == 0
    assert stage(spark, hard, SF).count() >= 0


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op")) == list(range(1, 14))


def test_columns_are_made_of_small_parts_of_a_batch():
    """Neither the function nor Spark, which reads what comes back, gets much of a large batch at once."""
    class Table:
        schema = T.StructType().add("text", "string")

        def drop(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    given = []

    def make():
        return lambda part: given.append(part.nbytes) or [np.array([len(t) for t in part.column("text").to_pylist()])]

    texts = ["x" * (20_000 + i) for i in range(1000)]
    batches = [pa.RecordBatch.from_pydict({"text": t}) for t in (texts, ["y" * 5_000_000, "z"], [], ["", "w"])]
    found = list(with_columns(Table(), "size long", make)(iter(batches)))
    assert sorted(given)[-2] < 2_500_000 and max(b.nbytes for b in found[:-2]) < 5_100_000
    rows = [r for b in found for r in b.to_pylist()]
    assert [r["text"] for r in rows] == [t for b in batches for t in b.column("text").to_pylist()]
    assert all(r["size"] == len(r["text"]) for r in rows)


def test_remembered_answers_outgrow_their_room(monkeypatch):
    model = toxicity_cnn.ToxicityModel()
    texts = [f"word{i} and word{i * 7} then {i}" for i in range(300)]
    whole = toxicity_cnn.Scorer(model).raw(texts)
    monkeypatch.setattr(toxicity_cnn, "MOST_REMEMBERED", 8)
    small = toxicity_cnn.Scorer(model)
    assert (np.concatenate([small.raw(texts[a : a + 50]) for a in range(0, 300, 50)]) == whole).all()
