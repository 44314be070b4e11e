"""Word by word, the tokenizer gives what it gives for whole texts."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from riskmill.llm import tokens

PATH = tokens.default_tokenizer("word_bpe_49k.json")
PARTS = [
    "a", "B", "é", "É", ".", ",", "!", "?", "'s", "'", "1", "½", "ﬁ", "<|endoftext|>", "<|ENDOFTEXT|>", ";", ":",
    "̱", "H", "İ", "\u0085", "\x1c", "ß", "Σ", "σ", "́", "|>", "<|", "-", "　", "中", " ", "\n",
]


def same(texts):
    rows = tokens.WordTable(PATH, list).rows([t.encode().split() for t in texts])
    whole = tokens.tokenizer(PATH)
    for text, row in zip(texts, rows, strict=True):
        assert sum(row, []) == whole.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text(texts):
    same(texts)


def test_awkward_texts():
    r = random.Random(1)
    same(["".join(r.choice(PARTS) for _ in range(r.randrange(60))) for _ in range(2000)])


def test_a_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_CACHED_WORDS", 10)
    table = tokens.WordTable(PATH, len)
    for k in range(5):
        words = [b"w%d" % (i * k) for i in range(30)]
        assert table.rows([words]) == [[len(x) for x in tokens.encode_words(PATH, words)]]


def test_packed():
    assert tokens.packed([1, 258, 49407]) == b"\x01\x00\x02\x01\xff\xc0"


def test_known_and_new_words_in_one_call(monkeypatch):
    encoded = []
    learn = tokens.encode_words
    monkeypatch.setattr(tokens, "encode_words", lambda path, words: encoded.extend(words) or learn(path, words))
    table = tokens.WordTable(PATH, list)
    table.rows([b"Hello world.".split()])
    texts = ["Hello again, world.", "", "again again new! Hello", "world. <|endoftext|>"]
    rows = table.rows([t.encode().split() for t in texts])
    assert [sum(r, []) for r in rows] == [tokens.tokenizer(PATH).encode(t, add_special_tokens=False).ids for t in texts]
    assert len(encoded) == len(set(encoded))
