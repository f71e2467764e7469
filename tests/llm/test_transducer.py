import codecs
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("tidemark.llm")
from tidemark.llm.encoding import VOCABULARY, count_tokens, decode_corpus, encode_corpus, transducer  # noqa: E402
from tidemark.llm.transducer import Transducer, Utf8Machine, decode, merge, read_ranks  # noqa: E402

if not os.path.exists(VOCABULARY):
    pytest.skip("no vocabulary here", allow_module_level=True)


@pytest.fixture(scope="module")
def machine():
    with open(VOCABULARY, "rb") as file:
        return transducer(file.read())


@pytest.fixture(scope="module")
def library():
    tiktoken = pytest.importorskip("tiktoken")
    from tidemark.llm.transducer import PATTERN

    with open(VOCABULARY, "rb") as file:
        ranks = read_ranks(file.read())
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    None, "", " ", "\n\n \t x  ", "<|endoftext|> is ordinary", "don't we'll I'VE 's", "naïve Straße ¿Qué?", "日本語のテキスト", "👍🏽‍🦰 ok",
    "a" * 20_000, "ab" * 5_000, " " * 3_000 + "x", "x\u0000y​z", "1234567890" * 50, "é́́",
]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_same_ids_as_the_library(machine, library, text):
    assert machine.encode(text) == (library.encode_ordinary(text) if text else [])


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(machine, library, text):
    ids = machine.encode(text)
    assert ids == library.encode_ordinary(text)
    tokens = {rank: token for token, rank in machine.ranks.items()}
    assert "".join(decode(ids, tokens)) == text


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcde ", max_size=80).map(str.encode))
def test_pieces_against_the_definition(machine, piece):
    assert machine.encode_piece(piece) == [machine.ranks[t] for t in merge(piece, machine.ranks)]


def test_states_may_be_forgotten_at_any_time(machine, monkeypatch):
    monkeypatch.setattr("tidemark.llm.transducer.MOST_STATES", 3)
    monkeypatch.setattr("tidemark.llm.transducer.MOST_PIECES", 2)
    small = Transducer(machine.ranks)
    for text in ("the unbelievable internationalization of things", "aaaaaaaaaaaaaaaaaaaaaaa bbbbbbbb"):
        assert small.encode(text) == machine.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40), st.integers(1, 5))
def test_utf8_machine(data, step):
    machine = Utf8Machine()
    out = "".join(machine.feed(data[i : i + step]) for i in range(0, len(data), step)) + machine.close()
    assert out == codecs.decode(data, "utf-8", "replace")


def test_characters_come_out_as_soon_as_they_are_whole():
    machine = Utf8Machine()
    assert [machine.feed(bytes([b])) for b in "é€😀".encode()] == ["", "é", "", "", "€", "", "", "", "😀"]


def test_corpus(spark, library):
    texts = [t for t in TEXTS if t is None or "\u0000" not in t]
    rows = [(i, t, [1], "clash") for i, t in enumerate(texts)] + [(None, "no id", [1], "c"), (1, "", [1], "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, n_tokens string")
    encoded = encode_corpus(frame)
    got = sorted((tuple(r) for r in encoded.collect()), key=repr)
    want = sorted(((i, library.encode_ordinary(t) if t else []) for i, t, *_ in rows), key=repr)
    assert got == want
    back = {r["doc_id"]: r["text"] for r in decode_corpus(encoded.where("doc_id > 1")).collect()}
    assert back == {i: t for i, t, *_ in rows if i is not None and i > 1}
    assert {r["doc_id"]: r["n_tokens"] for r in count_tokens(frame).where("doc_id > 1").collect()} == {i: len(x) for i, x in want if i is not None and i > 1}
    assert encode_corpus(frame.limit(0)).count() == 0
    assert decode_corpus(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first()["text"] is None
