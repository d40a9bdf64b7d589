"""SentencePiece encoding and decoding against the library and a plain merge loop."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spark_elt.llm import sentencepieces as sp
from spark_elt.llm.queries import QUERIES

from .cases import SF, docs, empty, rows, texts  # noqa: F401

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def words():
    with open(PATH, "rb") as f:
        return sp.Vocabulary(f.read())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_pieces(vocabulary, symbols):
    """Merge the best adjacent pair of the whole text, again and again."""
    at = list(symbols)
    while True:
        best = None
        for i in range(len(at) - 1):
            score = vocabulary.scores.get(at[i] + at[i + 1])
            if score is not None and (best is None or score > best[0]):
                best = (score, i)
        if best is None:
            return at
        at[best[1] : best[1] + 2] = [at[best[1]] + at[best[1] + 1]]


TEXT = st.lists(
    st.one_of(
        st.text(max_size=6).filter(lambda t: not any("\ud800" <= c <= "\udfff" for c in t)),
        st.sampled_from(["  ", " the", "\n\n", "\t", sp.SPACE, "<s>", "</s>", "<0x41>", "1234", "é", "é", "漢字", "\U0001f600", "\x00", "ing", "    " * 9]),
    ), max_size=20,
).map("".join)


@given(TEXT)
@settings(max_examples=300, deadline=None)
def test_as_library(text):
    words = _words()
    ids = words.encode(text)
    assert ids == words.library.encode(text, add_eos=True)
    assert words.decode(ids) == words.library.decode(ids)
    symbols = words.prefix + text.replace(" ", sp.SPACE) if text else ""
    cuts = words.cuts.findall(symbols)
    assert [p for cut in cuts for p in words.pieces(cut)] == plain_pieces(words, symbols)
    words._learn(set(cuts))
    assert all(words.known[c] == words._tokens(words.pieces(c)) for c in cuts)


_KEPT = []


def _words():
    if not _KEPT:
        with open(PATH, "rb") as f:
            _KEPT.append(sp.Vocabulary(f.read()))
    return _KEPT[0]


@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 262)), max_size=12))
@settings(max_examples=400, deadline=None)
def test_any_ids(ids):
    words = _words()
    assert words.decode(ids) == words.library.decode(ids)


def test_long_texts(words):
    for text in ("a" * 300_000, " " * 100_000, "the thing " * 50_000, "ab\n" * 100_000, "漢" * 100_000):
        ids = words.encode(text)
        assert ids == words.library.encode(text, add_eos=True)
        assert words.decode(ids) == text


def test_memory_is_bounded(words, monkeypatch):
    monkeypatch.setattr(sp, "REMEMBERED", 10)
    words.known.clear()
    for i in range(100):
        text = " ".join(f"word{i}x{i * j}" for j in range(3))
        assert words.encode(text) == words.library.encode(text, add_eos=True)
        assert len(words.known) <= 40


def test_table(spark, docs):  # noqa: F811
    got = sp.decode(sp.encode(docs, PATH), PATH)
    found = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got.collect())
    library = _words().library
    want = Counter()
    for doc_id, text in texts(docs):
        ids = library.encode(text, add_eos=True)
        want[(doc_id, tuple(ids), library.decode(ids))] += 1
    assert found == want
    assert sp.encode(empty(spark), PATH).count() == 0
    assert sp.decode(sp.encode(empty(spark), PATH), PATH).count() == 0


def test_difference_fails(spark, monkeypatch):
    with pytest.raises(ValueError, match="differs from the library"):
        sp._same("encoding", ["a"], [[1]], [[2]])


def test_query(spark):
    library = _words().library
    got = {r.doc_id: r for r in QUERIES["op12_sentencepiece"](spark, SF).collect()}
    given = rows()
    assert len(got) == len(given)
    for doc_id, text, *_ in given:
        ids = library.encode(text or "", add_eos=True)
        r = got[doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
