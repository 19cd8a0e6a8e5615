"""Packing and token files against the library, one text at a time."""

import itertools
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from payfeed.llm import packing, tokenfiles
from payfeed.llm.units import UnitEncoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ROWS = [(5, "One text, two words."), (1, None), (2, ""), (3, " a  b \n c\td "), (3, " a  b \n c\td "), (4, "word " * 5000), (None, "no id é ñ"), (9, "don't 's <|endoftext|> İ ΣΑΣ 12 x́")]


@pytest.fixture(scope="module")
def libraries():
    out = {}
    for path in (WORD, BYTE):
        out[path] = Tokenizer.from_file(path)
    return out


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,'abé́ßİ　\x1c\x85!1"), st.characters(exclude_categories=["Cs"]))))
def test_units_encode_like_the_whole_text(path, text):
    encoder = ENCODERS.setdefault(path, UnitEncoder(path))
    plain = LIBRARIES.setdefault(path, Tokenizer.from_file(path))
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=100, deadline=None)
@given(parts=st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", " ", "word", "\n", "é."]), max_size=8))
def test_strings_of_special_tokens(path, parts):
    test_units_encode_like_the_whole_text.hypothesis.inner_test(path, "".join(parts))


BREAKS = ["a\n b", "\n a", "\n", "a \nb", "x\ny.\nz", "x\n\ny", "x\r\ny", "x\n\ty z", "w$$$ w*** w's w'\ns -\nA_b\n1", "é##\nÉ.. ", "a  b\nc", " a\nb\x85 c", "don't\n's"]


def test_units_with_line_breaks_and_marks(libraries):
    encoder = UnitEncoder(BYTE)
    for size in (1, 2, 3):
        for parts in itertools.product([*BREAKS, " ", "\n", "$$$", "word", "'s", "é"], repeat=size):
            text = "".join(parts)
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == libraries[BYTE].encode(text, add_special_tokens=False).ids, text


def test_line_breaks_and_marks_are_not_sent_through_the_whole_chain(monkeypatch):
    """Of texts in lines only the marks are pre-tokenized by the library, once each; units that join two lines are not remembered."""
    encoder, sent = UnitEncoder(BYTE), []
    chain = encoder.library

    class Counted:
        @staticmethod
        def encode_batch_fast(texts, **more):
            sent.extend(texts)
            return chain.encode_batch_fast(texts, **more)

        model = chain.model

    for part in (encoder, encoder.first, encoder.inner):
        if hasattr(part, "library"):
            monkeypatch.setattr(part, "library", Counted)
    texts = [f"Head{x} one$$$ end{x}.\nNext{x}### last{x}" for x in "abcdefghijklmnopqrstuvwxyz"]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == chain.encode(text, add_special_tokens=False).ids
    assert sorted(sent) == ["###", "$$$", "."]
    assert not any("\n" in unit for unit in encoder.inner)


def test_full_units_start_anew(monkeypatch):
    monkeypatch.setattr("payfeed.llm.units.MAX_UNITS", 5)
    encoder, plain = UnitEncoder(BYTE), Tokenizer.from_file(BYTE)
    for text in ("a b c d e f g h, i.\nj k$ l", "l m n\no p. q r s", "a b"):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(encoder.inner) <= 7 and len(encoder.first) <= 7


LIBRARIES: dict = {}
ENCODERS: dict = {}


def test_pieces_and_places(spark, make_docs, libraries):
    got = packing.pack_documents(make_docs(ROWS), WORD, ids=True)
    rows = got.collect()
    want = Counter()
    for doc_id, text in ROWS:
        ids = libraries[WORD].encode(text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            want[doc_id, piece, at, len(ids[at : at + 2048]), crc(ids[at : at + 2048])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(by_sequence) == -(-total // 2048)
    whole = {r.sequence_id: r for r in packing.packed_sequences(got).collect()}
    assert all(len(r.ids) == 4 * r.length for r in whole.values()) and len(whole) == len(by_sequence)


def test_hot_length_is_ranked_in_chunks(spark):
    pieces = spark.range(5000).selectExpr("id AS doc_id", "0 AS piece", "CASE WHEN id % 3 = 0 THEN 7 ELSE 64 END AS length")
    rows = packing.pack(pieces, ["doc_id", "piece"], capacity=64, chunks=16).collect()
    places = {(r.sequence_id, r.offset) for r in rows}
    assert len(places) == 5000
    assert all(r.offset + r.length <= 64 for r in rows)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=25))
def test_plan_places_every_piece_once(counts):
    placed = Counter()
    for pattern, copies in packing.plan(counts, 40):
        assert sum(pattern) <= 40 and copies > 0
        for length in pattern:
            placed[length] += copies
    assert placed == Counter(counts)


def test_plan_finds_exact_complements():
    made = packing.plan({60: 4, 40: 1, 25: 1, 15: 1, 20: 1, 12: 1, 8: 1, 33: 1, 7: 1}, 100)
    full = sum(copies for pattern, copies in made if sum(pattern) == 100)
    assert full == 4


def test_empty_table(spark, make_docs):
    docs = make_docs([])
    assert packing.pack_documents(docs, WORD).count() == 0
    assert tokenfiles.token_documents(docs, BYTE).count() == 0


def test_token_files_round_trip(spark, make_docs, libraries, tmp_path):
    manifest = tokenfiles.write_token_files(make_docs(ROWS), BYTE, str(tmp_path / "files"), shards=3, file_ids=50)
    rows = tokenfiles.read_token_files(manifest).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted([d for d, _ in ROWS], key=lambda d: (d is not None, d))
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.n_tokens
    want = Counter((d, crc(libraries[BYTE].encode(t or "", add_special_tokens=False).ids + [0])) for d, t in ROWS)
    assert Counter((r.doc_id, r.ids_crc32) for r in rows) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1 << 40)), st.data())
def test_elias_fano_selects(values, data):
    values = np.sort(np.array(values, np.int64))
    coded = tokenfiles.EliasFano(tokenfiles.EliasFano.encode(values))
    a = data.draw(st.integers(0, len(values)))
    b = data.draw(st.integers(a, len(values)))
    assert coded.select(a, b).tolist() == values[a:b].tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.full(100_000, 1000))
    assert len(tokenfiles.EliasFano.encode(values)) < 100_000 * 1.7
