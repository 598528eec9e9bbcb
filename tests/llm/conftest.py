import pytest

from trisect.llm.queries import word_tokenizer
from trisect.llm.tables import importable

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# Nulls, empty and odd texts, repeated rows, ties.
HARD_TEXTS = [
    None, "", " ", "\n\n", "one", "one", "two words", "a b c d e", "ZÜä İΣ 日本語 \U0001f44d\U0001f3fd", "é ṩ",
    "x" * 700, "ab" * 300 + " " + "the" * 90, "don't it's I'LL 12,3 ½", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>",
    "a\x1cb\x85c d　e", "w " * 3000, "line one here\nline one here\nother", "repeat this little text now " * 30,
    "!! ## $$ %% && ** | < >",
]


@pytest.fixture(scope="session")
def hard(spark):
    importable(spark)
    rows = [(i, t, ["en", None, "de"][i % 3], None, None) for i, t in enumerate(HARD_TEXTS)]
    rows += [rows[6], rows[6], (None, "no id at all", "en", "s", 12), (None, None, None, None, None), (6, "two words", "fr", "x", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    importable(spark)
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    importable(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def tokenizer():
    return word_tokenizer()


@pytest.fixture(scope="session")
def library(tokenizer):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer)
