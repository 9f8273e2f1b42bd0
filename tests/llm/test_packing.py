import zlib
from collections import defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from homeledger.llm import packing  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_cut_lengths():
    assert packing.cut_lengths(1, 8) == [1] and packing.cut_lengths(8, 8) == [8]
    assert packing.cut_lengths(17, 8) == [1, 8, 8] and packing.cut_lengths(16, 8) == [8, 8]


def test_best_fit_takes_the_least_space_and_closes_the_fullest():
    p = packing.BestFit(10, 2, 100)
    assert p.place(6) == (100, 0)  # 4 left
    assert p.place(7) == (101, 0)  # 3 left
    assert p.place(3) == (101, 7)  # the tighter one, now full
    assert p.place(8) == (102, 0)  # 2 left; two are open
    assert p.place(9) == (103, 0)  # 102 closes, the fullest
    assert p.place(2) == (100, 6)  # 102 would have been tighter
    assert p.place(10) == (104, 0)  # full at once, needs no open bin


def check(rows, docs, library, window):
    pieces, placed = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text in docs.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        own, at = sorted(pieces[doc_id], key=lambda r: r["piece"]), 0
        assert [r["piece"] for r in own] == list(range(len(own)))
        if len(ids) <= window:
            assert len(own) == 1
        assert all(r["length"] == window for r in own[1:]) and own[0]["length"] <= window
        for r in own:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for spans in placed.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    return len(placed)


def test_documents(frame):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PATH)
    docs = {i: "word and more " * (i * 7 % 40) for i in range(300)} | {300: None, 301: "", 302: "long " * 5000}
    df = frame([(k, v, 1, 2) for k, v in docs.items()], "doc_id long, text string, piece int, length int")
    rows = packing.pack_documents(df, PATH, window=128).collect()
    n = check(rows, docs, library, 128)
    total = sum(r["length"] for r in rows)
    assert n <= 1.05 * -(-total // 128) + 1


def test_ids_are_returned_and_repeats_are_documents(frame):
    df = frame([(1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    rows = packing.pack_documents(df, PATH, with_ids=True).collect()
    assert sorted(len(r["ids"]) // 4 for r in rows) == sorted(r["length"] for r in rows) == [1, 3, 3]
    assert len({r["sequence_id"] for r in rows}) == 1
    assert packing.pack_documents(df.limit(0), PATH).collect() == []
