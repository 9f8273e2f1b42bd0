import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from homeledger.llm import digests


def entropies_by_hand(data):
    out = []
    for i in range(len(data) - 63):
        c = np.bincount(np.frombuffer(data[i:i + 64], np.uint8), minlength=256)
        out.append((int(digests.CLOGC[64]) - int(digests.CLOGC[c].sum())) * digests.CLASSES // int(digests.CLOGC[64]))
    return out


def starts_by_hand(data, rank):
    classes = entropies_by_hand(data)
    if not classes:
        return [0] if data else []
    votes = [0] * len(classes)
    runs = max(1, len(classes) - 63)
    for s in range(runs):
        near = range(s, min(s + 64, len(classes)))
        votes[min(near, key=lambda i: (rank[classes[i]], i))] += 1
    return [i for i, v in enumerate(votes) if v >= min(16, runs)]


RANK = np.random.default_rng(0).permutation(digests.CLASSES + 1).astype(np.int64)


def some_texts():
    rng = random.Random(1)
    words = ["alpha", "beta", "gamma", "été", "x", "1234", "zzzzzzzz", ",", "中文"]
    return [" ".join(rng.choice(words) for _ in range(n)).encode()[:m] for n, m in
            [(0, 9), (1, 9), (20, 63), (20, 64), (20, 65), (40, 126), (40, 127), (40, 128), (40, 143), (90, 400), (300, 2000), (700, 4000)]] + [b"a" * 500]


def test_entropies_and_features_equal_brute_force(monkeypatch):
    texts = some_texts()
    for t in texts:
        assert digests.entropy_classes(np.frombuffer(t, np.uint8)).tolist() == entropies_by_hand(t)
    want = [starts_by_hand(t, RANK) for t in texts]
    assert [s.tolist() for s in digests.many_feature_starts(texts, RANK)] == want
    monkeypatch.setattr(digests, "BLOCK", 300)  # long texts in blocks, short ones in several lots
    assert [s.tolist() for s in digests.many_feature_starts(texts, RANK)] == want


def test_likeness():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    a = " ".join(word() for _ in range(3000))
    b = " ".join(word() for _ in range(3000))
    half = digests.edited(a, b)
    fa, fb, fh, fe = digests.fingerprint_many([a, b, half, ""], RANK)
    assert len(fa) > 1
    assert digests.likeness(fa, fa) == 1.0 and digests.likeness(fa, fb) < 0.1 and 0.3 < digests.likeness(fa, fh) < 0.8
    assert digests.likeness(fa, fh) == digests.likeness(fh, fa)
    assert digests.likeness(fe, fe) == 1.0 and digests.likeness(fe, fa) == 0.0
    assert (digests.chain_of(digests.fingerprint_string(fa)) == fa).all()


@pytest.mark.parametrize("bucket_rows", [50_000, 7])
def test_rows(frame, bucket_rows):
    rng = random.Random(3)
    texts = {i * 3: " ".join(rng.choice(["one", "two", "three", "vier", "été"]) + str(rng.randrange(50)) for _ in range(rng.randrange(80)))
             for i in range(60)}
    texts[9], texts[12], texts[15] = None, "", texts[18]
    texts[30] = "long text " * 20_000
    df = frame([(k, v, 1) for k, v in texts.items()], "doc_id long, text string, bucket int")
    rarity = digests.window_rarity(df)
    assert rarity.sum() == sum(max(0, len((t or "").encode()) - 63) for t in texts.values())
    got = {r["doc_id"]: r for r in digests.compare_with_next(df, rarity, bucket_rows=bucket_rows).collect()}
    ids = sorted(texts, reverse=True)
    assert sorted(got, reverse=True) == ids
    for i, k in enumerate(ids):
        text, following = texts[k] or "", texts[ids[(i + 1) % len(ids)]] or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        r = got[k]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        chain = [digests.chain_of(got[j]["fingerprint"]) for j in (k, ids[(i + 1) % len(ids)])]
        assert r["near_next"] == digests.likeness(*chain)
        assert r["near_edited"] == digests.likeness(chain[0], digests.chain_of(r["edited_fingerprint"]))
    assert got[15]["fingerprint"] == got[18]["fingerprint"] and got[12]["fingerprint"] == got[9]["fingerprint"] == ""
    alone = {r["doc_id"]: r["fingerprint"] for r in digests.fingerprints(df, rarity).collect()}
    assert alone == {k: r["fingerprint"] for k, r in got.items()}


def test_one_row_repeats_and_empty(frame):
    schema = "doc_id long, text string"
    zero = np.zeros(digests.CLASSES + 1, dtype=np.int64)
    only = digests.compare_with_next(frame([(4, "abcd")], schema), zero).collect()
    assert [(r["doc_id"], r["edited_sha256"]) for r in only] == [(4, hashlib.sha256(b"abab").hexdigest())]
    again = digests.compare_with_next(frame([(4, "abcd")] * 3 + [(None, "x")], schema), zero).collect()
    assert sorted(str(r["doc_id"]) for r in again) == ["4", "4", "4", "None"]
    assert digests.compare_with_next(frame([], schema), zero).collect() == []


def test_a_hot_id_is_dealt_by_its_texts(frame):
    rows = [(5, f"hot text {i}") for i in range(600)] + [(i, "x") for i in range(10, 610)] + [(None, f"none {i}") for i in range(90)]
    dealt = digests.in_order(frame(rows, "doc_id long, text string"), "doc_id", "text", 50).collect()
    own = [r for r in dealt if not r["guest"]]
    sizes = Counter(r["bucket"] for r in own)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in own) == sorted((k is None, k or 0, t) for k, t in rows)
    assert max(sizes.values()) < 200 and len({r["bucket"] for r in own if r["doc_id"] == 5}) > 6
    ids = [r["doc_id"] for r in sorted(own, key=lambda r: r["bucket"])]
    by_bucket = [{i for i, b in zip(ids, sorted(r["bucket"] for r in own)) if b == n} for n in sorted(sizes)]
    low = lambda s: min(-1 if i is None else i for i in s)
    high = lambda s: max(-1 if i is None else i for i in s)
    assert all(low(a) >= high(b) for a, b in zip(by_bucket, by_bucket[1:]))
    assert Counter(r["bucket"] for r in dealt if r["guest"]) == dict.fromkeys(sizes, 1)


def test_the_most_voted_window_stands_in(monkeypatch):
    texts = [b"a" * 1000, b"ab" * 400, bytes(range(97, 105)) * 50, some_texts()[-2]]
    for block in (digests.BLOCK, 300):
        monkeypatch.setattr(digests, "BLOCK", block)
        for text in texts:
            classes = entropies_by_hand(text)
            votes = [0] * len(classes)
            for s in range(len(classes) - 63):
                votes[min(range(s, s + 64), key=lambda i: (RANK[classes[i]], i))] += 1
            want = min(range(len(classes)), key=lambda i: (-votes[i], RANK[classes[i]], i))
            assert digests.most_voted(text, RANK).tolist() == [want]


def test_every_text_that_is_not_empty_has_a_feature():
    assert [len(s) for s in digests.many_feature_starts([b"a" * 1000], RANK)] == [0]
    a, b, empty = digests.fingerprint_many(["a" * 1000, "b" * 1000, ""], RANK)
    assert len(a) and len(b) and (a != b).any()
    assert digests.likeness(a, empty) == 0.0 and digests.likeness(a, b) < 1.0 and digests.likeness(a, a) == 1.0
