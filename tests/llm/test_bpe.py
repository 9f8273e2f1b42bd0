import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
from homeledger.llm import bpe  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "'", "'s", "'ll", "'re", "'T", "!", "?", "é", "ß", "中", "文", "١", "½", "😀", " ", "　",
         "\x85", "\x1c", "0", "12", "<|endoftext|>", "ᾳ", "́", "_", "-", "don't", "\r\n", "​", "﻿", "\x00", "ⅷ", "²", "word", " the"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Codec(PATH)


def ids_of(own, text):
    return np.frombuffer(own.encode(text), dtype="<u4").tolist()


def test_equals_the_library_on_mixed_signs(own, library):
    rng = random.Random(3)
    for _ in range(5000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(14)))
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(own, text) == want, repr(text)
        assert own.decode(own.encode(text)) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs", "Cn")), max_size=60))
def test_equals_the_library_on_any_text(text):
    from tokenizers import Tokenizer
    own, library = bpe.codec(PATH), _library(Tokenizer)
    assert ids_of(own, text) == library.encode(text, add_special_tokens=False).ids


_cache = {}


def _library(kind):
    return _cache.setdefault("t", kind.from_file(PATH))


def test_long_texts_without_cuts(own, library):
    for text in ("a" * 50_000, "xyz" * 20_000, "ha" * 3000 + " " * 5000 + "é" * 4000):
        assert ids_of(own, text) == library.encode(text, add_special_tokens=False).ids


def test_forced_pairs_are_in_no_token(own):
    inside = {(b[i], b[i + 1]) for b in own.token_bytes.values() if b != b"<|endoftext|>" for i in range(len(b) - 1)}
    assert {(int(p) >> 8, int(p) & 255) for p in np.flatnonzero(~own.forced)} == inside


def test_memo_bound_does_not_change_results(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    texts = ["one two three four five", "six seven eight", "one two three four five six"]
    fresh = bpe.Codec(PATH)
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in fresh.encode_many(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_decode_of_broken_bytes(own):
    assert own.decode(own.encode("é")[:4]) == "é" or "�" in own.decode(own.encode("中")[:4])


def test_rows(frame, library):
    docs = frame([(1, "a b", "x"), (2, None, "y"), (2, "", "y"), (3, "a b", None)], "doc_id long, text string, ids string")
    got = sorted(tuple(r) for r in bpe.round_trip(docs, PATH).collect())
    ids = np.array(library.encode("a b").ids, dtype="<u4").tobytes()
    empty = (0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest())
    full = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(b"a b").hexdigest())
    assert got == sorted([(1, *full), (2, *empty), (2, *empty), (3, *full)])
    assert bpe.round_trip(docs.limit(0), PATH).collect() == []
