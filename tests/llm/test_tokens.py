"""Encoding against the tokenizers library, packing as an exact round trip."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import SF

from trisect.llm import bytebpe, lexicon_bpe, packing
from trisect.llm.bytebpe import LONG_WORD, PieceEncoder, vocabulary
from trisect.llm.queries import QUERIES


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cn", "Cs"]), max_size=30), max_size=5))
def test_pieces_encode_like_the_library(texts):
    from tokenizers import Tokenizer

    from trisect.llm.queries import word_tokenizer

    library = Tokenizer.from_file(word_tokenizer())
    ids, at = PieceEncoder(vocabulary(word_tokenizer())).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids_of(library, t) for t in texts]


@pytest.mark.parametrize("most,kept", [(40, 10), (40, 40), (1, 0)])
def test_forgetting_changes_nothing(documents, tokenizer, library, monkeypatch, most, kept):
    monkeypatch.setattr(bytebpe, "MOST_REMEMBERED", most)
    monkeypatch.setattr(bytebpe, "KEPT", kept)
    encoder = PieceEncoder(vocabulary(tokenizer))
    texts = [r.text[:2000] for r in documents.orderBy("doc_id").limit(40).collect()] + ["", "a <|endoftext|> b", "a b"]
    for begin in range(0, len(texts), 5):
        run = texts[begin : begin + 5]
        ids, at = encoder.encode(run)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids_of(library, t) for t in run]


def test_long_words_are_merged_like_short_ones(tokenizer):
    vocab = vocabulary(tokenizer)
    word = b"theandingstthethe" * 5
    assert len(word) <= LONG_WORD
    assert vocab._merge_long(word).tolist() == vocab.merge([word]).flat.tolist()


def test_automaton_finds_its_words_and_no_others():
    words = sorted({b"a", b"ab", b"abc", b"b", b"bing", b"ting", b"thing", "ü".encode()})
    ids = lexicon_bpe.Runs(np.arange(2 * len(words), dtype=np.uint32), np.arange(len(words)) * 2, np.full(len(words), 2))
    automaton = lexicon_bpe.Transducer(np.frombuffer(lexicon_bpe.compile_words(words, ids), np.uint8))
    assert automaton.find(words).tolist() == list(range(len(words)))
    assert automaton.find([b"", b"abcd", b"thin", b"x", b"ing"]).tolist() == [-1] * 5
    # "ing" is shared: fewer nodes than a tree of all words would have.
    assert len(automaton.final) < sum(map(len, words))
    empty = lexicon_bpe.Transducer(np.frombuffer(lexicon_bpe.compile_words([], ids), np.uint8))
    assert empty.find([b"a"]).tolist() == [-1]


@pytest.mark.parametrize("min_count", [1, 10**9])
def test_round_trip_with_any_lexicon(hard, tokenizer, library, min_count):
    lexicon = lexicon_bpe.build_lexicon(hard, tokenizer, most_words=50, min_count=min_count)
    table = hard.withColumnRenamed("n_chars", "decoded")
    rows = lexicon_bpe.round_trip(table, tokenizer, lexicon).collect()
    apart = lexicon_bpe.decode(lexicon_bpe.encode(table, tokenizer, lexicon), tokenizer).collect()
    assert Counter(rows) == Counter(apart) and len(rows) == hard.count()
    for row in rows:
        ids = np.frombuffer(row.token_ids, "<u4").tolist()
        assert ids == ids_of(library, row.text)
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_op7(spark, documents, library):
    expected = {}
    for row in documents.collect():
        ids = ids_of(library, row.text)
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[row.doc_id] = (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        )
    found = QUERIES["op7_bpe_transducer"](spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == expected


def check_packing(rows, texts, library, window):
    """Each id in one piece, sequences without gaps, all full but the last."""
    left = Counter()
    documents = Counter()
    for text in texts:
        documents[np.array([*ids_of(library, text), 1], "<u4").tobytes()] += 1
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        left[at] += 1
    assert set(by_sequence) == set(range(len(by_sequence)))
    assert sum(left.values()) - left[window] <= 1 and max(left, default=window) <= window
    assert sum(r.length for r in rows) == sum(n * len(raw) // 4 for raw, n in documents.items())
    crcs = Counter()
    for r in rows:
        crcs[(r.doc_tokens, r.start, r.length, r.ids_crc32)] += 1
    for raw, n in documents.items():
        mine = [k for k in crcs if k[0] == len(raw) // 4 and zlib.crc32(raw[4 * k[1] : 4 * (k[1] + k[2])]) == k[3]]
        covered = sum(crcs[k] * k[2] for k in mine)
        assert covered >= n * len(raw) // 4


@pytest.mark.parametrize("window,unit,depth", [(2048, 32, 4), (64, 8, 3), (16, 16, 2)])
def test_packing(hard, documents, tokenizer, library, window, unit, depth):
    table = documents.limit(40).select("doc_id", "text").unionAll(hard.select("doc_id", "text"))
    rows = packing.pack(table, tokenizer, window=window, unit=unit, depth=depth).collect()
    check_packing(rows, [r.text for r in table.collect()], library, window)


def test_packing_nothing(nothing, tokenizer):
    found = packing.pack(nothing, tokenizer)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert found.count() == 0
    with pytest.raises(ValueError):
        packing.pack(nothing, tokenizer, window=100, unit=32)


def test_op10(spark, documents, library):
    rows = QUERIES["op10_nnls_packing"](spark, SF).collect()
    expected = {r.doc_id: np.array([*ids_of(library, r.text), 1], "<u4") for r in documents.collect()}
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(expected)
    for doc_id, ids in expected.items():
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    check_packing(rows, [r.text for r in documents.collect()], library, 2048)


def test_least_squares_uses_no_more_than_there_is():
    histogram = np.array([0, 50, 7, 300, 20, 0, 1, 90])
    table, times = packing.plan(histogram, 3)
    used = table.T @ times
    assert (used <= histogram).all() and (times > 0).all()
    # Nothing that still fits is left.
    for row in packing.combinations(8, 3):
        assert (histogram - used < row).any()
    a = np.array([[1.0, 0], [1, 1]])
    assert np.allclose(packing.non_negative_least_squares(a, np.array([3.0, 2.0])), [2.5, 0], atol=0.5)
