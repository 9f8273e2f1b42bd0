import random

import numpy as np
import pytest

import corpus_pipeline
from homeledger.llm import copies


def corpus():
    """Groups of edited copies, exact copies, and texts that share half of their words."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts = []
    for size in (2, 3, 5, 40):
        base = [word() for _ in range(150)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(150)] = word()
            texts.append(" ".join(own))
    half = [word() for _ in range(80)]
    texts += [" ".join(half + [word() for _ in range(80)]) for _ in range(20)]
    return texts + [texts[0], texts[0].upper(), "", " ", "one two", "One  two", "two one"]


def by_hand(texts):
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(texts)))
    for _ in up:
        for i, a in enumerate(sets):
            for j in range(i):
                if a == sets[j] or len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                    up[i] = up[j] = min(up[i], up[j])
    return up


@pytest.mark.parametrize("sizes", [{}, {"part_bytes": 3000, "bucket_rows": 7}])
def test_components_equal_all_pairs(frame, sizes):
    texts = corpus()
    got = {r["doc_id"]: r["component_id"] for r in copies.near_copies(frame(list(enumerate(texts)), "doc_id long, text string"), **sizes).collect()}
    assert [got[i] for i in range(len(texts))] == by_hand(texts)


def test_pairs_at_the_limit_are_proposed():
    """Of pairs at a similarity of 0.80 to 0.82 the tables bring together as many as planned, of closer ones more."""
    rng = np.random.default_rng(8)
    width, tables = copies.plan(100_000)
    longs = -(-width * tables // 64)
    found = {0.8: 0, 0.9: 0}
    for like in found:
        for _ in range(400):
            n = int(rng.integers(60, 400))
            shared = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            own = [np.concatenate([shared, rng.integers(0, 1 << 63, int(n * (1 / like - 1) / 2), dtype=np.uint64)]) for _ in range(2)]
            a, b = (copies.code(x, longs) for x in own)
            near = int(np.bitwise_count(a[:2] ^ b[:2]).sum()) <= copies.RADIUS
            met = False
            for x, y in zip(copies.segments(a, width, tables), copies.segments(b, width, tables)):
                reach = lambda k: {k, *(k | 1 << i for i in range(width))}
                met |= bool(reach(x) & reach(y))
            found[like] += near and met
    assert found[0.8] >= 0.93 * 400 and found[0.9] >= 0.99 * 400


def test_forests_connect_what_pairs_connect():
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
    codes = np.array([centre ^ (np.uint64(1) << rng.integers(0, 64, 2, dtype=np.uint64)) for _ in range(300)] + list(rng.integers(0, 1 << 63, (300, 2), dtype=np.uint64)))
    pairs = copies.linked_pairs(codes)
    assert len(pairs) == 299 and all(i < 300 and j < 300 for i, j in pairs)
    assert len(copies.bucket_pairs(codes[200:400], 0)) == 99 and len(copies.bucket_pairs(codes[:200], 100)) == 199
    assert len(copies.linked_pairs(codes[:200], 100)) == 199


def test_odd_rows(frame):
    rows = [(7, "a b c d e f", 1), (7, "a b c d e f", 2), (None, "A b c d e f", 3), (3, None, 4), (None, "", 5), (7, "other text", 6)]
    df = frame(rows, "doc_id long, text string, row int")
    got = sorted(map(tuple, copies.near_copies(df).collect()), key=str)
    assert got == sorted([(7, 7), (7, 7), (None, 7), (3, 3), (None, 3), (7, 7)], key=str)
    left = copies.without_copies(df)
    assert left.columns == df.columns and sorted(map(tuple, left.collect()), key=str) == sorted([rows[0], rows[3], rows[5]], key=str)
    assert copies.without_copies(df.limit(0)).collect() == copies.near_copies(df.limit(0)).collect() == []


def test_the_stage_drops_edited_copies(frame, spark):
    words = [f"w{i}" for i in range(100)]
    edited = words[:50] + ["other"] + words[51:]
    far = words[:50] + [f"x{i}" for i in range(50)]
    docs = frame([(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(far))], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == [1, 3]
